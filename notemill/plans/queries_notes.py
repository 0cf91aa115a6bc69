"""Cleaning, references, sentences: queries on the note table and the SQL they must equal."""

from pyspark.sql import functions as F

from notemill.functions import sentences as sf, text as tx
from notemill.operators import cleaning, dedup, references, sentences, statistics
from notemill.plans import sql
from notemill.plans.registering import joined, register, rounded
from notemill.plans.standins import cleaned_rows, decorated, documents, reactions
from notemill.session import spread
from notemill.sources.tables import table

QUERIES, SQL, query = register()


# --- cleaning -----------------------------------------------------------------------------------

@query(f"""WITH {sql.only_links()}
SELECT doc_id, t AS clean_text, array_to_string(f, '|') AS removed FROM unlinked""")
def links_removed(spark, folder):
    out = cleaning.remove_links(decorated(spark, folder), "original_notes", "clean_text", "removed")
    return out.select("doc_id", "clean_text", joined("removed").alias("removed"))


@query(f"""WITH {sql.decorated()}
SELECT doc_id, array_to_string(regexp_extract_all(original_notes, {sql.quoted(sql.LINK)}, 0), '|') AS removed
FROM decorated""")
def links_removed_whole(spark, folder):
    out = cleaning.remove_links(decorated(spark, folder), "original_notes", "clean_text", "removed", capture="full")
    return out.select("doc_id", joined("removed").alias("removed"))


@query(f"""WITH {sql.only_citations()}
SELECT doc_id, t AS clean_text, array_to_string(f, '; ') AS citations FROM uncited""")
def citations_removed(spark, folder):
    out = cleaning.remove_citations(decorated(spark, folder), "original_notes", "clean_text", "citations")
    return out.select("doc_id", "clean_text", F.array_join("citations", "; ").alias("citations"))


@query(f"WITH {sql.reactions()} SELECT file_id, reaction_id, original_notes, notes, only_references, snippet FROM reactions")
def notes_cleaned(spark, folder):
    return cleaned_rows(spark, folder).drop("row_order")


@query(f"""WITH {sql.reactions()}
SELECT reaction_id, array_to_string({sql.reference_list('only_references')}, '|') AS refs FROM reactions""")
def reference_lists(spark, folder):
    return reactions(spark, folder).select(
        "reaction_id", joined(tx.reference_list(F.col("only_references"))).alias("refs"))


# --- references per file and reaction -----------------------------------------------------------

_REFS = f"refs AS (SELECT file_id, reaction_id, row_order, unnest({sql.reference_list('only_references')}) AS reference FROM reactions)"


@query(f"""WITH {sql.reactions()},
firsts AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY notes, only_references ORDER BY row_order) AS rn FROM reactions) WHERE rn = 1),
counts AS (SELECT source AS file_id, count(*) AS reaction_count FROM documents GROUP BY source),
refs AS (SELECT file_id, unnest({sql.reference_list('only_references')}) AS reference FROM firsts),
notes AS (SELECT file_id, count(notes) AS notes_count FROM firsts GROUP BY file_id),
totals AS (SELECT file_id, count(*) AS total_references, count(DISTINCT reference) AS unique_references FROM refs GROUP BY file_id)
SELECT counts.file_id, reaction_count, notes_count, coalesce(total_references, 0) AS total_references,
  coalesce(unique_references, 0) AS unique_references
FROM counts JOIN notes USING (file_id) LEFT JOIN totals USING (file_id)""")
def file_summary(spark, folder):
    """Flagship: reaction counts per file joined with note and reference counts of the distinct notes."""
    counts = table(spark, folder, "documents").groupBy(F.col("source").alias("file_id")).agg(
        F.count("*").alias("reaction_count"))
    rows = reactions(spark, folder, "file_id", "row_order", "notes", "only_references")
    return references.file_summary(counts, dedup.keep_first(rows, ["notes", "only_references"], "row_order"))


@query(f"""WITH {sql.reactions()}, {_REFS}
SELECT reaction_id, count(reference) AS total_references, count(DISTINCT reference) AS unique_references
FROM reactions LEFT JOIN refs USING (reaction_id) GROUP BY reaction_id""")
def references_per_reaction(spark, folder):
    out = references.group_references(reactions(spark, folder), "reaction_id")
    return out.select("reaction_id", "total_references", "unique_references")


@query(f"""WITH {sql.reactions()}
SELECT file_id, reaction_id, place - 1 AS place, r[place] AS reference
FROM (SELECT file_id, reaction_id, r, unnest(range(1, len(r) + 1)) AS place
      FROM (SELECT file_id, reaction_id, {sql.reference_list('only_references')} AS r FROM reactions))""")
def references_flattened(spark, folder):
    rows = references.reference_rows(reactions(spark, folder))
    return rows.select("file_id", "reaction_id", F.col("place").cast("long").alias("place"), "reference")


@query(f"""WITH {sql.reactions()},
flat AS (SELECT file_id, row_order, place, r[place] AS reference FROM (SELECT file_id, row_order, r, unnest(range(1, len(r) + 1)) AS place
  FROM (SELECT file_id, row_order, {sql.reference_list('only_references')} AS r FROM reactions)))
SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY row_order, place) - 1 AS place, reference FROM flat""")
def references_per_file(spark, folder):
    """The whole reference list of every file, one row per place."""
    return references.grouped_references(reactions(spark, folder, "file_id", "row_order", "only_references"), "file_id", "row_order")


@query(f"""WITH {sql.reactions()}, {_REFS},
per_file AS (SELECT file_id, count(*) AS total, count(DISTINCT reference) AS uniq FROM refs GROUP BY file_id)
SELECT sum(total)::BIGINT AS total_references, sum(uniq)::BIGINT AS unique_references FROM per_file""")
def reference_grand_totals(spark, folder):
    per_file = references.group_references(reactions(spark, folder), "file_id")
    return per_file.agg(F.sum("total_references").alias("total_references"),
                        F.sum("unique_references").alias("unique_references"))


_LINKS = {"Jones et al. 2009b": "https://example.org/jones", "Park 2005": "https://example.org/park"}


@query(f"""WITH {sql.reactions()}, {_REFS}
SELECT reference, count(*) AS citations,
  CASE reference WHEN 'Jones et al. 2009b' THEN 'https://example.org/jones' WHEN 'Park 2005' THEN 'https://example.org/park'
  ELSE 'not available' END AS link
FROM refs GROUP BY reference ORDER BY citations DESC, reference LIMIT 3""")
def most_cited_references(spark, folder):
    return references.most_cited(reactions(spark, folder), 3, tx.lookup(F.col("reference"), _LINKS, "not available"))


# --- sentences ----------------------------------------------------------------------------------

@query(f"""SELECT doc_id, len(s) AS num_sentences, array_to_string(s, '|') AS sentences
FROM (SELECT doc_id, {sql.sentences('text')} AS s FROM documents)""")
def sentences_split(spark, folder):
    docs = documents(spark, folder)
    out = docs.withColumn("s", sf.split_sentences(F.col("text")))
    return out.select("doc_id", F.size("s").cast("long").alias("num_sentences"), joined("s").alias("sentences"))


@query(f"""SELECT doc_id, len(s) AS num_sentences, array_to_string(s, '|') AS sentences
FROM (SELECT doc_id, list_filter({sql.sentences('text')}, lambda s: {sql.is_sentence('s')}) AS s FROM documents)""")
def sentences_kept(spark, folder):
    docs = documents(spark, folder)
    out = docs.withColumn("s", sf.kept_sentences(F.col("text")))
    return out.select("doc_id", F.size("s").cast("long").alias("num_sentences"), joined("s").alias("sentences"))


_NOTES = f"""note_rows AS (SELECT notes, original_notes, min(row_order) AS row_order FROM reactions GROUP BY notes, original_notes),
note_list AS (SELECT row_number() OVER (ORDER BY row_order) - 1 AS note_index, *, {sql.sentences('notes')} AS s FROM note_rows),
exploded AS MATERIALIZED (SELECT note_index, notes, original_notes, len(s) AS num_sentences,
  unnest(CASE WHEN len(s) = 0 THEN [NULL] ELSE s END) AS sentence FROM note_list)"""
_GOOD = f"""note_rows AS (SELECT notes, min(row_order) AS row_order FROM reactions GROUP BY notes),
kept AS (SELECT *, list_filter({sql.sentences('notes')}, lambda s: {sql.is_sentence('s')}) AS s FROM note_rows),
note_list AS (SELECT row_number() OVER (ORDER BY row_order) - 1 AS note_index, * FROM kept WHERE len(s) > 0),
unnested AS (SELECT note_index, notes, len(s) AS num_sentences, unnest(s) AS sentence FROM note_list),
exploded AS MATERIALIZED (SELECT * FROM unnested WHERE length(sentence) >= 5 AND regexp_matches(sentence, '[a-zA-Z]'))"""


@query(f"""WITH {sql.reactions()}, {_NOTES},
counts AS (SELECT sentence, count(*) AS count FROM exploded WHERE sentence IS NOT NULL GROUP BY sentence)
SELECT note_index, md5(notes) AS notes_md5, md5(original_notes) AS original_md5, sentence, num_sentences, count
FROM exploded LEFT JOIN counts USING (sentence)""")
def sentence_table(spark, folder):
    rows = reactions(spark, folder).select("notes", "original_notes", "row_order")
    shown = {"notes_md5": F.md5("notes"), "original_md5": F.md5("original_notes")}
    return sentences.sentence_table(rows, shown=shown).select(
        "note_index", *shown, "sentence", "num_sentences", "count")


@query(f"""WITH {sql.reactions()}, {_GOOD},
counts AS (SELECT sentence, count(*) AS count FROM exploded GROUP BY sentence)
SELECT note_index, md5(notes) AS notes_md5, sentence, num_sentences, count
FROM exploded LEFT JOIN counts USING (sentence)""")
def sentence_table_filtered(spark, folder):
    rows = reactions(spark, folder).select("notes", "row_order")
    return sentences.filtered_sentence_table(rows, shown={"notes_md5": F.md5("notes")}).select(
        "note_index", "notes_md5", "sentence", "num_sentences", "count")


@query(f"""WITH {sql.reactions()}, {_GOOD}
SELECT count(*) AS count, sentence, CASE WHEN length(sentence) > 80 THEN substr(sentence, 1, 80) || '...' ELSE sentence END AS preview
FROM exploded GROUP BY sentence ORDER BY count DESC, sentence LIMIT 10""")
def top_sentences(spark, folder):
    rows = reactions(spark, folder).select("notes", "row_order")
    kept = sentences.note_sentences(sentences.distinct_notes(rows, ("notes",)), filtered=True)
    exploded = kept.select(F.explode("sentences").alias("sentence"))
    return sentences.top_sentences(exploded.filter((F.length("sentence") >= 5) & tx.has_ascii_letter(F.col("sentence"))))


_RAW = f"exploded AS MATERIALIZED (SELECT doc_id AS note_index, text AS notes, text AS original_notes, unnest({sql.sentences('text')}) AS sentence FROM documents)"


def _raw_sentences(spark, folder):
    docs = documents(spark, folder)
    return docs.select(F.col("doc_id").alias("note_index"), F.col("text").alias("notes"),
                       F.col("text").alias("original_notes"), F.explode(sf.split_sentences(F.col("text"))).alias("sentence"))


@query(f"""WITH {_RAW},
short AS (SELECT sentence, count(*) AS count FROM exploded WHERE length(sentence) <= 3 GROUP BY sentence)
SELECT sentence, count, (SELECT count(*) FROM short) AS distinct_short, (SELECT sum(count) FROM short)::BIGINT AS short_rows
FROM short ORDER BY count DESC, sentence LIMIT 10""")
def short_sentences(spark, folder):
    return sentences.short_sentences(_raw_sentences(spark, folder).select("sentence"))


@query(f"""WITH {_RAW}
SELECT min(note_index) AS note_index, notes, arg_min(original_notes, note_index) AS original_notes,
  length(notes) AS notes_length, length(arg_min(original_notes, note_index)) AS original_length
FROM exploded WHERE sentence = 'A.' GROUP BY notes ORDER BY min(note_index) LIMIT 5""")
def notes_behind_sentence(spark, folder):
    return sentences.notes_behind(_raw_sentences(spark, folder), "A.")


#: Rows beside the given ones, so that every kind of note is met.
EDGE_NOTES = ((-4, None), (-3, ""), (-2, " . ;"), (-1, "Short one"))
_WITH_EDGES = f"""with_edges AS (SELECT row_order, notes FROM reactions UNION ALL VALUES
  {", ".join(f"({i}, {'NULL' if n is None else sql.quoted(n)})" for i, n in EDGE_NOTES)})"""


def _with_edges(spark, folder):
    """The notes of all rows, and four more."""
    edges = spark.createDataFrame(list(EDGE_NOTES), "row_order long, notes string")
    return reactions(spark, folder).select("row_order", "notes").unionByName(edges)


@query(f"""WITH {sql.reactions()}, {_WITH_EDGES}
SELECT count(*) AS notes, count(*) FILTER (length(n) <= 10) AS short_notes,
  count(*) FILTER (regexp_matches(n, '^[^\\p{{L}}\\p{{N}}_]+$')) AS punctuation_notes,
  count(*) FILTER (n IS NULL OR n = '') AS empty_notes
FROM (SELECT DISTINCT notes AS n FROM with_edges)""")
def note_diagnosis(spark, folder):
    return sentences.note_diagnosis(_with_edges(spark, folder))


@query(f"""WITH {sql.reactions()}, {_WITH_EDGES}
SELECT notes, length(notes) AS length FROM (SELECT notes, min(row_order) AS o FROM with_edges WHERE length(notes) <= 10 GROUP BY notes)
ORDER BY o LIMIT 10""")
def short_notes(spark, folder):
    return sentences.short_notes(_with_edges(spark, folder))


@query(f"""WITH {sql.reactions()}, {_WITH_EDGES}
SELECT notes FROM (SELECT notes, min(row_order) AS o FROM with_edges WHERE regexp_matches(notes, '^[^\\p{{L}}\\p{{N}}_]+$') GROUP BY notes)
ORDER BY o LIMIT 5""")
def punctuation_notes(spark, folder):
    return sentences.punctuation_notes(_with_edges(spark, folder))


@query(f"""WITH {sql.reactions()}, note_rows AS (SELECT notes, min(row_order) AS row_order FROM reactions GROUP BY notes)
SELECT notes, len({sql.sentences('notes')}) AS num_sentences FROM note_rows ORDER BY num_sentences DESC, row_order LIMIT 10""")
def longest_notes(spark, folder):
    rows = reactions(spark, folder).select("notes", "row_order")
    table_ = sentences.note_sentences(sentences.distinct_notes(rows, ("notes",)))
    return table_.orderBy(F.desc("num_sentences"), "row_order").limit(10).select("notes", "num_sentences")


@query(f"""WITH {sql.reactions()}, note_rows AS (SELECT DISTINCT notes, original_notes FROM reactions),
sizes AS (SELECT len({sql.sentences('notes')}) AS num_sentences FROM note_rows)
{sql.describe('sizes', 'num_sentences')}""")
def sentence_statistics(spark, folder):
    rows = reactions(spark, folder).select("notes", "original_notes", "row_order")
    sizes = sentences.note_sentences(sentences.distinct_notes(rows))
    return rounded(statistics.describe(sizes, "num_sentences").drop("total"))


@query(f"""WITH {_RAW} SELECT sentence, count(*) AS count FROM exploded GROUP BY sentence HAVING count(*) > 1""")
def repeated_sentences(spark, folder):
    return sentences.sentence_counts(_raw_sentences(spark, folder).select("sentence")).filter("count > 1")
