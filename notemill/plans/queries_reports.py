"""Duplicates, distributions, joins and top lists over the given tables."""

from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import text as tx
from notemill.operators import dedup, entities, joins, ranks, references, sampling, statistics
from notemill.plans import sql
from notemill.plans.registering import register, rounded
from notemill.plans.standins import documents, reactions
from notemill.session import materialise
from notemill.sources.tables import table

QUERIES, SQL, query = register()

_R = sql.reactions()


# --- duplicates -----------------------------------------------------------------------------------

@query("SELECT DISTINCT lang, source, n_chars, md5(text) AS text_md5 FROM documents")
def distinct_rows(spark, folder):
    return table(spark, folder, "documents").select("lang", "source", "n_chars", F.md5("text").alias("text_md5")).distinct()


@query(f"""WITH {_R}
SELECT file_id, row_order, reaction_id, original_notes, notes, only_references, snippet FROM (
  SELECT *, row_number() OVER (PARTITION BY snippet, notes ORDER BY row_order) AS rn FROM reactions) WHERE rn = 1""")
def first_of_duplicates(spark, folder):
    rows = reactions(spark, folder, "file_id", "row_order", "reaction_id", "original_notes", "notes", "only_references", "snippet")
    return dedup.keep_first(rows, ["snippet", "notes"], "row_order")


@query(f"""WITH {_R}
SELECT count(*) AS rows_before, count(DISTINCT (snippet, notes)) AS rows_after,
  count(*) - count(DISTINCT (snippet, notes)) AS removed FROM reactions""")
def duplicate_report(spark, folder):
    return dedup.duplicate_report(reactions(spark, folder), ["snippet", "notes"])


@query("SELECT count(*) AS rows_before, count(DISTINCT text) AS rows_after, count(*) - count(DISTINCT text) AS removed FROM documents")
def duplicate_report_texts(spark, folder):
    return dedup.duplicate_report(table(spark, folder, "documents"), ["text"])


@query("""SELECT count(DISTINCT doc_id) AS doc_id, count(DISTINCT text) AS text, count(DISTINCT lang) AS lang,
  count(DISTINCT source) AS source, count(DISTINCT n_chars) AS n_chars FROM documents""")
def distinct_counts(spark, folder):
    return dedup.distinct_counts(table(spark, folder, "documents"))


@query("""SELECT count(DISTINCT text) AS n, count(DISTINCT source) AS sketches, true AS within_five_percent FROM documents""")
def merged_sketches(spark, folder):
    """Distinct texts by a stored sketch per source, all put together, beside the exact number."""
    docs = table(spark, folder, "documents").select("source", "text")
    sketches = materialise(dedup.distinct_sketches(docs, "source", "text"), "sketches")
    exact = dedup.distinct_counts(docs.select("text")).select(F.col("text").alias("n"))
    estimate = dedup.merged_distinct(sketches).scalar()
    return exact.select("n", sketches.agg(F.count("source")).scalar().alias("sketches"),
                        (F.abs(estimate - F.col("n")) <= 0.05 * F.col("n")).alias("within_five_percent"))


@query(f"""WITH {_R}
SELECT count(*) AS reactions, count(*) FILTER (n > 1) AS with_several_notes
FROM (SELECT reaction_id, count(DISTINCT notes) AS n FROM reactions GROUP BY reaction_id)""")
def notes_per_reaction(spark, folder):
    per = dedup.group_distinct(reactions(spark, folder), "reaction_id", "notes", "n")
    return per.agg(F.count("*").alias("reactions"), F.count_if(F.col("n") > 1).alias("with_several_notes"))


@query("SELECT md5(text) AS text_md5, count(DISTINCT doc_id) AS n FROM documents GROUP BY text HAVING count(DISTINCT doc_id) > 1")
def texts_shared(spark, folder):
    docs = table(spark, folder, "documents").select(F.md5("text").alias("text_md5"), "doc_id")
    return dedup.group_distinct(docs, "text_md5", "doc_id", "n").filter("n > 1")


@query("""SELECT doc_id, source, lang, text FROM documents
WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(DISTINCT doc_id) > 1)""")
def rows_with_shared_text(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    return dedup.shared_rows(docs, "text", "doc_id")


@query("""SELECT count(DISTINCT doc_id) AS doc_id, count(DISTINCT source) AS source, count(DISTINCT lang) AS lang,
  count(DISTINCT text) AS text, count(*) AS rows FROM documents
WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(DISTINCT doc_id) > 1)""")
def shared_text_summary(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    shared = dedup.shared_rows(docs, "text", "doc_id")
    return shared.agg(*[F.count_distinct(c).alias(c) for c in ("doc_id", "source", "lang", "text")],
                      F.count("*").alias("rows"))


# --- projections, filters, frequencies --------------------------------------------------------------

@query("SELECT doc_id AS row_id, n_chars AS characters FROM documents WHERE lang = 'en'")
def renamed_projection(spark, folder):
    docs = table(spark, folder, "documents").filter(F.col("lang") == "en")
    return docs.select("doc_id", "n_chars").withColumnsRenamed({"doc_id": "row_id", "n_chars": "characters"})


@query("SELECT doc_id, length(text) AS characters FROM documents WHERE length(text) <= 60")
def short_texts(spark, folder):
    docs = table(spark, folder, "documents").filter(F.length("text") <= 60)
    return docs.select("doc_id", F.length("text").cast("long").alias("characters"))


@query(r"""SELECT count(*) FILTER (text IS NOT NULL) AS present, count(*) FILTER (text IS NULL OR text = '') AS blank,
  count(*) FILTER (regexp_matches(text, '[a-zA-Z]')) AS lettered, count(*) FILTER (length(text) >= 500) AS long_texts
FROM documents""")
def predicate_counts(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").agg(
        F.count_if(text.isNotNull()).alias("present"), F.count_if(tx.is_blank(text)).alias("blank"),
        F.count_if(tx.has_ascii_letter(text)).alias("lettered"), F.count_if(F.length(text) >= 500).alias("long_texts"))


@query("SELECT event_type AS value, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def frequency_counts(spark, folder):
    return statistics.value_counts(table(spark, folder, "events"), "event_type")


@query("SELECT source, count(text) AS notes_count FROM documents GROUP BY source")
def notes_per_file(spark, folder):
    return table(spark, folder, "documents").groupBy("source").agg(F.count("text").alias("notes_count"))


@query("SELECT doc_id, CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '...' ELSE text END AS preview FROM documents")
def text_previews(spark, folder):
    return table(spark, folder, "documents").select("doc_id", tx.preview(F.col("text")).alias("preview"))


@query(f"SELECT doc_id, {sql.word_count('text')} AS words, length({sql.strip('text')}) AS stripped_length FROM documents")
def word_counts(spark, folder):
    return documents(spark, folder).select(
        "doc_id", tx.word_count(F.col("text")).alias("words"),
        F.length(tx.strip(F.col("text"))).cast("long").alias("stripped_length"))


@query(rf"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda l: {sql.strip('l')}),
  lambda l: l <> ''), chr(10)) AS text FROM documents""")
def normalised_lines(spark, folder):
    return documents(spark, folder).select("doc_id", tx.normalise_lines(F.col("text")).alias("text"))


# --- statistics -------------------------------------------------------------------------------------

@query(sql.describe(f"(SELECT {sql.word_count('text')} AS words FROM documents)", "words"))
def word_count_statistics(spark, folder):
    docs = documents(spark, folder).select(tx.word_count(F.col("text")).alias("words"))
    return rounded(statistics.describe(docs, "words").drop("total"))


@query(sql.describe("documents", "n_chars", "lang"))
def length_statistics_by_language(spark, folder):
    return rounded(statistics.describe(table(spark, folder, "documents"), "n_chars", "lang").drop("total"))


@query(sql.describe("events", "value"))
def value_statistics(spark, folder):
    return rounded(statistics.describe_spread(table(spark, folder, "events"), "value").drop("total"))


@query(sql.describe("orders", "o_totalprice", population=True))
def price_statistics(spark, folder):
    orders = table(spark, folder, "orders")
    return rounded(statistics.describe_spread(orders, "o_totalprice", population=True).drop("total"))


_LINES = ("l_quantity", "l_extendedprice", "l_discount")


@query("WITH long AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", l_returnflag, {c}::DOUBLE AS value FROM lineitem" for c in _LINES) + ") " +
       sql.describe("long", "value", '"column"', "l_returnflag"))
def line_statistics(spark, folder):
    """Three columns per return flag, all quantiles in the same passes."""
    out = statistics.describe_columns(table(spark, folder, "lineitem"), _LINES, "l_returnflag")
    return rounded(out.drop("total"))


@query("""SELECT min(length(html)) AS snippet_min, max(length(html)) AS snippet_max, round(avg(length(html)), 6) AS snippet_mean,
  min(length(url)) AS notes_min, max(length(url)) AS notes_max, round(avg(length(url)), 6) AS notes_mean FROM pages""")
def column_lengths(spark, folder):
    lengths = table(spark, folder, "pages").select(F.length("html").cast("long").alias("snippet"),
                                                   F.length("url").cast("long").alias("notes"))
    return lengths.agg(*[f(c).alias(f"{c}_{n}") for c in ("snippet", "notes")
                         for f, n in ((F.min, "min"), (F.max, "max"), (lambda c: F.round(F.avg(c), 6), "mean"))])


@query("""SELECT event_id, value FROM events, (SELECT quantile_cont(value, 0.0) AS lo, quantile_cont(value, 0.9) AS hi FROM events)
WHERE value BETWEEN lo AND hi""")
def within_ninety_percent(spark, folder):
    return statistics.within_percentiles(table(spark, folder, "events").select("event_id", "value"), "value", 0, 90)


@query("SELECT event_id, round(log10(value), 6) AS log_value FROM events WHERE value > 0")
def log_values(spark, folder):
    out = statistics.log10_positive(table(spark, folder, "events").select("event_id", "value"), "value", "log_value")
    return out.select("event_id", F.round("log_value", 6).alias("log_value"))


_WORDS = f"(SELECT {sql.word_count('text')} AS value FROM documents)"


def _histogram_sql(values: str, bins: str = "greatest(ceil(log2(rows) + 1), coalesce(fd, 1))") -> str:
    return f"""WITH v AS MATERIALIZED (SELECT value::DOUBLE AS value FROM {values} WHERE value IS NOT NULL),
shape AS (SELECT count(*)::DOUBLE AS rows, min(value) AS low, max(value) AS high,
  quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM v),
s AS (SELECT rows, low, {bins} AS bins, (high - low) / {bins} AS width
      FROM (SELECT *, CASE WHEN iqr > 0 THEN ceil((high - low) / (2 * iqr / pow(rows, 1.0 / 3))) END AS fd FROM shape)),
filled AS (SELECT least(floor((value - low) / width) + 1, bins)::BIGINT AS bin, count(*) AS n FROM v, s GROUP BY 1)
SELECT bin, round(low + (bin - 1) * width, 6) AS bin_start, coalesce(n, 0) AS rows_in_bin,
  round(coalesce(n, 0) / (rows * width), 9) AS density
FROM (SELECT unnest(range(1, bins::BIGINT + 1)) AS bin, low, width, rows FROM s) LEFT JOIN filled USING (bin)"""


def _histogram(counts, bins=None):
    out = statistics.histogram(counts, bins)
    return out.withColumns({"bin_start": F.round("bin_start", 6), "density": F.round("density", 9)})


@query(_histogram_sql(_WORDS))
def word_count_histogram(spark, folder):
    return _histogram(statistics.value_counts(documents(spark, folder), tx.word_count(F.col("text"))))


@query(_histogram_sql("(SELECT log10(value) AS value FROM events WHERE value > 0)", "15.0"))
def log_value_histogram(spark, folder):
    events = statistics.log10_positive(table(spark, folder, "events").select("value"), "value", "log_value")
    return _histogram(statistics.value_counts(events, "log_value"), 15)


@query(f"""WITH v AS MATERIALIZED (SELECT value::DOUBLE AS value FROM {_WORDS}),
s AS (SELECT count(*) AS rows, min(value) AS low, max(value) AS high, stddev_samp(value) * pow(count(*), -0.2) AS width FROM v),
g AS (SELECT unnest(range(0, 40)) AS point)
SELECT point, round(low + (high - low) * point / 39, 6) AS x,
  round(sum(exp(-pow((low + (high - low) * point / 39 - value) / width, 2) / 2)) / (max(rows) * max(width) * sqrt(2 * pi())), 9) AS density
FROM v, s, g GROUP BY point, low, high""")
def word_count_density(spark, folder):
    counts = statistics.value_counts(documents(spark, folder), tx.word_count(F.col("text")))
    out = statistics.density_curve(counts, 40)
    return out.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})


_BOX = """q AS (SELECT quantile_cont(value, 0.25) AS q1, median(value) AS median, quantile_cont(value, 0.75) AS q3 FROM v)"""


@query(f"""WITH v AS MATERIALIZED {_WORDS}, {_BOX}
SELECT q1, median, q3, min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM v, q GROUP BY q1, median, q3""")
def word_count_box(spark, folder):
    return statistics.box_summary(statistics.value_counts(documents(spark, folder), tx.word_count(F.col("text"))))


@query(f"""WITH v AS (SELECT n_chars AS value FROM documents), {_BOX}
SELECT doc_id, n_chars FROM documents, q WHERE n_chars NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def length_outliers(spark, folder):
    return statistics.outliers(table(spark, folder, "documents").select("doc_id", "n_chars"), "n_chars")


# --- file table reports -----------------------------------------------------------------------------

_FILES = f"""refs AS (SELECT file_id, unnest({sql.reference_list('only_references')}) AS reference FROM reactions),
ref_counts AS (SELECT file_id, count(*) AS total_references, count(DISTINCT reference) AS unique_references FROM refs GROUP BY file_id),
files AS (SELECT file_id, count(*) AS reaction_count, count(notes) AS notes_count, coalesce(any_value(total_references), 0) AS total_references,
  coalesce(any_value(unique_references), 0) AS unique_references FROM reactions LEFT JOIN ref_counts USING (file_id) GROUP BY file_id)"""


def _files(spark, folder):
    return references.group_references(reactions(spark, folder), "file_id").withColumnRenamed("row_count", "reaction_count")


@query(f"WITH {_R}, {_FILES} SELECT * FROM files ORDER BY reaction_count DESC, file_id LIMIT 15")
def largest_files(spark, folder):
    return _files(spark, folder).orderBy(F.desc("reaction_count"), "file_id").limit(15)


@query(f"WITH {_R}, {_FILES} SELECT file_id, reaction_count FROM files ORDER BY reaction_count DESC, file_id LIMIT 1")
def largest_file(spark, folder):
    return _files(spark, folder).orderBy(F.desc("reaction_count"), "file_id").limit(1).select("file_id", "reaction_count")


@query(f"WITH {_R}, {_FILES} SELECT * FROM files ORDER BY unique_references, reaction_count DESC, file_id LIMIT 15")
def least_referenced_files(spark, folder):
    return _files(spark, folder).orderBy("unique_references", F.desc("reaction_count"), "file_id").limit(15)


@query(f"WITH {_R}, {_FILES} SELECT count(*) FILTER (total_references = 0) AS without_references, count(*) AS files FROM files")
def files_without_references(spark, folder):
    return _files(spark, folder).agg(F.count_if(F.col("total_references") == 0).alias("without_references"),
                                     F.count("*").alias("files"))


@query(f"WITH {_R}, {_FILES}, per_reaction AS (SELECT len({sql.reference_list('only_references')}) AS n FROM reactions)\n"
       + sql.describe("per_reaction", "n"))
def references_per_reaction_statistics(spark, folder):
    sizes = reactions(spark, folder).select(F.size(tx.reference_list(F.col("only_references"))).cast("long").alias("n"))
    return rounded(statistics.describe(sizes, "n").drop("total"))


# --- orders, slices, samples, positions ---------------------------------------------------------------

@query("SELECT row_number() OVER (ORDER BY event_id) - 1 AS position, event_id, event_type FROM events")
def numbered_rows(spark, folder):
    return ranks.dense_index(table(spark, folder, "events").select("event_id", "event_type"), ["event_id"], "position")


@query("SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 100")
def first_hundred(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "source", "n_chars").orderBy("doc_id").limit(100)


@query("SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 2 OFFSET 16")
def row_slice(spark, folder):
    return sampling.row_slice(table(spark, folder, "documents").select("doc_id", "text"), ["doc_id"], 16, 18)


@query("SELECT doc_id, source, text FROM documents ORDER BY text, doc_id LIMIT 20")
def first_by_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "source", "text").orderBy("text", "doc_id").limit(20)


@query("SELECT DISTINCT p_name FROM part ORDER BY p_name")
def sorted_names(spark, folder):
    return table(spark, folder, "part").select("p_name").distinct().orderBy("p_name")


@query("SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 30")
def seeded_sample(spark, folder):
    return sampling.seeded_sample(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id", 30)


# --- joins and sets -----------------------------------------------------------------------------------

@query("""SELECT d.doc_id, quality, toxic, lang FROM documents d JOIN labels USING (doc_id)""")
def labelled_documents(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return docs.join(table(spark, folder, "labels"), "doc_id")


@query("""WITH ids AS (SELECT 'P-' || p_partkey AS id FROM part WHERE p_type = 'ECONOMY'),
names AS (SELECT 'P-' || p_partkey || '.sbml' AS name FROM part WHERE p_size <= 20)
SELECT id FROM ids WHERE EXISTS (SELECT 1 FROM names WHERE starts_with(name, id))""")
def files_by_prefix(spark, folder):
    ids, names = _ids_and_names(spark, folder)
    return joins.prefix_matches(ids, "id", names, "name")


@query("""WITH ids AS (SELECT DISTINCT substr(text, 1, 1 + (doc_id % 50)::INTEGER) AS id FROM documents),
names AS (SELECT DISTINCT substr(text, 1, 40) AS name FROM documents WHERE doc_id % 3 = 0)
SELECT id FROM ids WHERE EXISTS (SELECT 1 FROM names WHERE starts_with(name, id))""")
def texts_by_prefix(spark, folder):
    """Beginnings of texts, of fifty lengths, against the first forty characters of a third of all texts."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ids = docs.select(F.expr("substring(text, 1, cast(1 + doc_id % 50 as int))").alias("id")).distinct()
    names = docs.filter("doc_id % 3 = 0").select(F.substring("text", 1, 40).alias("name")).distinct()
    return joins.prefix_matches(ids, "id", names, "name")


def _ids_and_names(spark, folder):
    part = table(spark, folder, "part").withColumn("id", F.concat(F.lit("P-"), F.col("p_partkey").cast("string")))
    names = part.filter("p_size <= 20").select(F.concat("id", F.lit(".sbml")).alias("name"))
    return part.filter("p_type = 'ECONOMY'").select("id"), names


@query("""SELECT 'P-' || p_partkey AS id FROM part WHERE p_type = 'ECONOMY' AND p_size <= 20""")
def files_by_name(spark, folder):
    ids, names = _ids_and_names(spark, folder)
    return joins.exact_matches(ids, "id", names, "name")


@query("""SELECT 'P-' || p_partkey AS id FROM part WHERE p_type = 'ECONOMY' AND p_size > 20""")
def pending_ids(spark, folder):
    ids, names = _ids_and_names(spark, folder)
    return joins.pending(ids, "id", names.select(F.regexp_replace("name", r"\.sbml$", "").alias("id")))


@query("""SELECT count(*) AS expected, count(*) FILTER (p_size <= 20) AS found,
  count(*) = count(*) FILTER (p_size <= 20) AS complete FROM part WHERE p_type = 'ECONOMY'""")
def completeness(spark, folder):
    ids, names = _ids_and_names(spark, folder)
    return joins.completeness(ids, joins.exact_matches(ids, "id", names, "name"))


_ENTITIES = """entities AS (SELECT user_id, CASE event_type WHEN 'view' THEN 'EntityWithAccessionedSequence' ELSE event_type END AS schema_class,
  p_name || CASE event_id % 4 WHEN 0 THEN ' [cytosol]' WHEN 1 THEN ' gene' ELSE '' END AS display_name
  FROM events JOIN part ON p_partkey = (props::JSON ->> 'k')::BIGINT)"""


def _entity_records(spark, folder):
    """Per event a JSON array of one entity record, named after a part."""
    key = F.from_json("props", "k bigint")["k"]
    kind = F.when(F.col("event_type") == "view", fv.ENTITY_CLASS).otherwise(F.col("event_type"))
    ending = F.when(F.col("event_id") % 4 == 0, " [cytosol]").when(F.col("event_id") % 4 == 1, " gene").otherwise("")
    named = joins.lookup_join(table(spark, folder, "events").withColumn("p_partkey", key),
                              table(spark, folder, "part").select("p_partkey", "p_name"), "p_partkey",
                              F.col("event_id"), how="inner")
    return named.select("user_id", F.to_json(F.array(F.struct(
        kind.alias("schemaClass"), F.concat("p_name", ending).alias("displayName")))).alias("records"))


@query(f"WITH {_ENTITIES} SELECT schema_class, display_name, count(*) AS n FROM entities GROUP BY ALL")
def json_entities(spark, folder):
    return entities.entity_rows(_entity_records(spark, folder), "records").groupBy(
        "schema_class", "display_name").agg(F.count("*").alias("n"))


@query(f"""WITH {_ENTITIES}, named AS (SELECT trim(string_split(display_name, ' [')[1]) AS name FROM entities
  WHERE schema_class = 'EntityWithAccessionedSequence')
SELECT DISTINCT name FROM named WHERE length(name) > 2 AND NOT name SIMILAR TO '[0-9]+' AND NOT ends_with(name, ' gene')
  AND NOT ends_with(name, ' activated') ORDER BY name""")
def entity_names(spark, folder):
    return entities.entity_names(_entity_records(spark, folder), "records")


@query("""SELECT 'document' AS kind, doc_id AS id, length(text) AS characters FROM documents
UNION ALL SELECT 'page', page_id, length(html) FROM pages""")
def records_together(spark, folder):
    docs = table(spark, folder, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.length("text").cast("long").alias("characters"))
    pages = table(spark, folder, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.length("html").cast("long").alias("characters"))
    return docs.unionByName(pages)


@query(f"""WITH {_R} SELECT reaction_id, len(list_distinct({sql.reference_list('only_references')})) AS n FROM reactions""")
def reference_set_sizes(spark, folder):
    refs = tx.reference_list(F.col("only_references"))
    return reactions(spark, folder).select("reaction_id", F.size(F.array_distinct(refs)).cast("long").alias("n"))


@query("""WITH c AS (SELECT text, count(*) AS count FROM documents GROUP BY text)
SELECT doc_id, count FROM documents JOIN c USING (text)""")
def copies_per_row(spark, folder):
    key = F.when(F.col("text").isNotNull(), dedup.fingerprint(["text"]))
    docs = table(spark, folder, "documents").select("doc_id", key.alias("text_key"))
    return joins.count_back(docs, "text_key", F.col("doc_id")).select("doc_id", "count")
