"""File sources and sinks. Every query writes the given rows to scratch, in parallel, and reads them back."""

from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.operators import dedup, splits
from notemill.plans import jobs, sql
from notemill.plans.queries_splits import CATEGORIES, split_sql
from notemill.plans.queries_tokens import _PAIRS
from notemill.plans.registering import register
from notemill.plans.standins import decorated, instruction_pairs, page_pairs
from notemill.session import drop_scratch, scratch_path, settings
from notemill.sources import files, sinks
from notemill.sources.tables import table

QUERIES, SQL, query = register()

RECORDS_PER_FILE = 100
MARKUP, PACKED_FAST = "*.txt.gz", {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _escaped(column: str):
    """Text as XML can hold it; the signs that XML has no place for become blanks."""
    plain = F.regexp_replace(column, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ")
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        plain = F.replace(plain, F.lit(sign), F.lit(name))
    return plain


def _markup_files(spark, folder, break_every: int = 0):
    """Writes documents as reaction elements, a hundred ids per packed file, and returns the folder.

    Every ``break_every``-th file lacks its last end tag. Texts are dealt out by file as they are; all that makes them
    longer comes after that.
    """
    path = scratch_path(spark, "markup")
    element = F.concat(
        F.lit('<sbml:reaction sbml:metaid="m'), F.col("doc_id"), F.lit('" id="R-'), F.col("doc_id"),
        F.lit('" name="'), F.col("source"), F.lit('"><sbml:notes><p xmlns="http://www.w3.org/1999/xhtml">'), _escaped("original_notes"),
        F.lit('<b>bold</b></p></sbml:notes><annotation>a</annotation><sbml:listOfReactants lang="'), F.col("lang"),
        F.lit('"></sbml:listOfReactants></sbml:reaction>'))
    number = F.floor(F.col("doc_id") / RECORDS_PER_FILE)
    file = decorated(spark, folder, number).groupBy(number.alias("file")).agg(
        F.array_sort(F.collect_list(F.struct("doc_id", element.alias("e")))).alias("all"))
    end = F.lit("</sbml:model></sbml:sbml>")
    if break_every:
        end = F.when(F.col("file") % break_every == 0, "</sbml:model>").otherwise(end)
    text = F.concat(F.lit('<sbml:sbml xmlns:sbml="urn:sbml"><sbml:model>'), F.array_join("all.e", "\n"), end)
    with settings(spark, sinks.WRITING):
        file.select(text.alias("value")).write.options(**PACKED_FAST).option("maxRecordsPerFile", 1).text(path)
    return path


_PLAIN = "regexp_replace(original_notes, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', ' ', 'g')"


@query(f"""WITH {sql.decorated()}
SELECT 'R-' || doc_id AS reaction_id, {sql.strip(_PLAIN)} AS original_notes,
  '<reaction id="R-' || doc_id || '" name="' || source || '"><listOfReactants lang="' || lang || '"></listOfReactants></reaction>' AS snippet
FROM decorated""")
def markup_file_records(spark, folder):
    """Files as whole texts, elements and their parts by expressions."""
    documents = files.markup_documents(spark, _markup_files(spark, folder), MARKUP)
    rows = jobs.reaction_rows(jobs.parsed_files(documents))
    return rows.select("reaction_id", "original_notes", "snippet")


@query(f"""WITH {sql.decorated()} SELECT 'R-' || doc_id AS reaction_id, source AS name, lang FROM decorated""")
def markup_file_elements(spark, folder):
    """Files read by the XML source with a given schema."""
    fields = "_id string, _name string, listOfReactants struct<_lang: string>"
    records = files.markup_records(spark, _markup_files(spark, folder), "reaction", fields, MARKUP)
    return records.filter(F.col(files.BROKEN).isNull()).select(F.col("_id").alias("reaction_id"), F.col("_name").alias("name"),
                       F.col("listOfReactants._lang").alias("lang"))


def _file_numbers(spark, path):
    """file_id and the number of each written file, out of the first id that its text holds."""
    documents = files.markup_documents(spark, path, MARKUP)
    first = F.regexp_extract("value", r' id="R-(\d+)"', 1).cast("long")
    return documents.select("file_id", F.floor(first / RECORDS_PER_FILE).alias("file"))


@query(f"""SELECT doc_id // {RECORDS_PER_FILE} AS file, count(*) AS reaction_count, count(*) OVER () AS listed
FROM documents GROUP BY 1""")
def markup_file_counts(spark, folder):
    """Elements per file, 0 included, beside the number of files in the folder's list."""
    path = _markup_files(spark, folder)
    records = files.markup_records(spark, path, "reaction", "_id string", MARKUP).filter("_id is not null")
    counts = files.record_counts(spark, path, records, MARKUP)
    listed = files.list_files(spark, path, MARKUP).agg(F.count("*").alias("n")).scalar()
    return _file_numbers(spark, path).join(counts, "file_id").select("file", "reaction_count", listed.alias("listed"))


@query(f"""SELECT file, file % 3 = 0 AS broken, CASE WHEN file % 3 = 0 THEN 0 ELSE n END AS reaction_count,
  CASE WHEN file % 3 = 0 THEN 0 ELSE n END AS reactions
FROM (SELECT doc_id // {RECORDS_PER_FILE} AS file, count(*) AS n FROM documents GROUP BY 1)""")
def broken_files(spark, folder):
    """Every third file is cut off: it gives no rows and is listed, the others are read. One row per file."""
    out, path = scratch_path(spark, "corpus"), _markup_files(spark, folder, 3)
    jobs.build_corpus(spark, path, out, MARKUP)
    broken = spark.read.parquet(f"{out}/broken_files").withColumn("broken", F.lit(True))
    rows = spark.read.parquet(f"{out}/reactions").groupBy("file_id").agg(F.count("*").alias("reactions"))
    found = (_file_numbers(spark, path).join(spark.read.parquet(f"{out}/file_counts"), "file_id")
             .join(broken, "file_id", "left").join(rows, "file_id", "left"))
    return found.select("file", F.coalesce("broken", F.lit(False)).alias("broken"), "reaction_count",
                        F.coalesce("reactions", F.lit(0)).alias("reactions"))


@query(f"""WITH {sql.decorated()},
bodies AS (SELECT doc_id // {RECORDS_PER_FILE} AS file, string_agg('<sbml:reaction sbml:metaid="m' || doc_id || '" id="R-' || doc_id || '" name="' || source ||
  '"><sbml:notes><p xmlns="http://www.w3.org/1999/xhtml">' || replace(replace(replace({_PLAIN}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') ||
  '<b>bold</b></p></sbml:notes><annotation>a</annotation><sbml:listOfReactants lang="' || lang || '"></sbml:listOfReactants></sbml:reaction>',
  chr(10) ORDER BY doc_id) AS body FROM decorated GROUP BY 1),
texts AS (SELECT file, string_split('<sbml:sbml xmlns:sbml="urn:sbml"><sbml:model>' || body || '</sbml:model>' || chr(10), chr(10)) AS lines FROM bodies WHERE file % 3 = 0)
SELECT file, 'no element found' AS message, len(lines)::INTEGER AS line, length(lines[-1])::INTEGER AS "column" FROM texts""")
def broken_file_messages(spark, folder):
    """What the parser says of every third file, which is cut off, and where it stopped."""
    out, path = scratch_path(spark, "corpus"), _markup_files(spark, folder, 3)
    jobs.build_corpus(spark, path, out, MARKUP)
    broken = spark.read.parquet(f"{out}/broken_files")
    return _file_numbers(spark, path).join(broken, "file_id").select("file", "message", "line", "column")


@query(f"""WITH {sql.decorated()}, texts AS (SELECT doc_id, nullif({sql.strip(_PLAIN)}, '') AS note FROM decorated)
SELECT 'R-' || doc_id AS id, 1 AS depth, note FROM texts UNION ALL SELECT 'S-' || doc_id, 3, nullif('own', '') FROM texts""")
def nested_file_records(spark, folder):
    """One file per row: a reaction within a reaction, its prefix bound anew to the same address, and a paragraph that
    follows a division with one of its own."""
    address = fv.PARAGRAPH_ADDRESS
    text = F.concat(
        F.lit('<model xmlns="urn:sbml"><t:reaction xmlns:t="urn:sbml" id="R-'), F.col("doc_id"), F.lit('"><list><reaction id="S-'), F.col("doc_id"),
        F.lit(f'"><notes><div>a<div>b</div><p xmlns="{address}">inner</p></div><h:p xmlns:h="{address}">own</h:p></notes></reaction></list><t:notes><p xmlns="{address}">'),
        _escaped("original_notes"), F.lit("</p></t:notes></t:reaction><reaction xmlns='urn:other'/></model>"))
    documents = decorated(spark, folder).select(F.col("doc_id").cast("string").alias("file_id"), text.alias("value"))
    return jobs.parsed_files(documents).select(F.inline("elements")).select("id", "depth", F.nullif("note", F.lit("")).alias("note"))


@query("SELECT p_partkey AS id, p_name AS name FROM part WHERE p_type = 'ECONOMY'")
def tab_separated(spark, folder):
    path = scratch_path(spark, "tsv")
    table(spark, folder, "part").select("p_partkey", "p_name", "p_type").write.csv(path, sep="\t", quote="")
    return files.read_tsv(spark, path, "id long, name string, species string").filter(
        F.col("species") == "ECONOMY").select("id", "name")


@query("SELECT DISTINCT p_name AS term FROM part")
def term_lines(spark, folder):
    path = scratch_path(spark, "terms")
    names = table(spark, folder, "part").select("p_name").distinct()
    sinks.write_terms(names.select(F.concat(F.lit("  "), "p_name").alias("p_name")).unionByName(
        names.select(F.lit(" ").alias("p_name"))), path, "p_name")
    return files.read_terms(spark, path)


@query(f"WITH {_PAIRS} SELECT instruction, output FROM asked")
def json_lines(spark, folder):
    path = scratch_path(spark, "jsonl")
    sinks.write_json_lines(instruction_pairs(spark, folder).select("instruction", "output"), path)
    return files.read_json(spark, path, "instruction string, output string")


@query(f"WITH {_PAIRS} SELECT pair_id, instruction FROM asked ORDER BY pair_id LIMIT 20")
def json_array_subset(spark, folder):
    """The first twenty rows as one JSON array, as a trial set."""
    path = scratch_path(spark, "array")
    sinks.write_json_array(instruction_pairs(spark, folder).select("pair_id", "instruction"), path, ["pair_id"], 20)
    return files.read_json(spark, path, "pair_id string, instruction string")


_SPLIT_PAGES = f"{CATEGORIES}, {split_sql('categorised', 'combined_category', 'page_id')}"


def _written_splits(spark, folder):
    parted = splits.stratified_split(splits.categorise(page_pairs(spark, folder)), "combined_category", "page_id")
    return sinks.write_splits(parted, scratch_path(spark, "splits"))


@query(f"""WITH {_SPLIT_PAGES}
SELECT split, 'Translate the following SBML code to English:' || chr(10) || chr(10) || snippet AS instruction, notes AS output FROM parted""")
def written_split_data(spark, folder):
    data, _ = _written_splits(spark, folder)
    return files.read_json_lines(spark, data, "split string, instruction string, output string").select(
        "split", "instruction", F.coalesce("output", F.lit("")).alias("output"))


@query(f"WITH {_SPLIT_PAGES} SELECT split, page_id, combined_category FROM parted")
def written_split_categories(spark, folder):
    _, categories = _written_splits(spark, folder)
    return files.read_json_lines(spark, categories, "split string, page_id long, combined_category string")


@query("SELECT doc_id, source, text FROM (SELECT *, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def loaded_or_built(spark, folder):
    """Built at the first call, read at the second."""
    path = scratch_path(spark, "train")
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")

    def build():
        return dedup.keep_first(docs, ["source", "text"], "doc_id")
    sinks.load_or_build(spark, path, build, docs.schema)
    return sinks.load_or_build(spark, path, lambda: None, docs.schema)


@query("SELECT 'R-' || p_partkey AS term FROM part WHERE p_size > 40")
def retry_list(spark, folder):
    path = scratch_path(spark, "retry")
    results = table(spark, folder, "part").select(
        F.concat(F.lit("R-"), F.col("p_partkey").cast("string")).alias("id"),
        F.when(F.col("p_size") > 40, "error").otherwise("success").alias("status"))
    sinks.write_failed(results, path, "id")
    return files.read_terms(spark, path)


@query(f"""WITH {sql.reactions()},
refs AS (SELECT row_order // {RECORDS_PER_FILE} AS file, unnest({sql.reference_list('only_references')}) AS reference FROM reactions),
cited AS (SELECT file, count(*) AS total_references, count(DISTINCT reference) AS unique_references FROM refs GROUP BY file),
files AS (SELECT row_order // {RECORDS_PER_FILE} AS file, count(*) AS reaction_count, count(notes) AS notes_count FROM reactions GROUP BY 1)
SELECT file, reaction_count, notes_count, coalesce(total_references, 0) AS total_references,
  coalesce(unique_references, 0) AS unique_references FROM files LEFT JOIN cited USING (file)""")
def corpus_job(spark, folder):
    """Files to reaction and count tables to the file summary, all written; one row per file."""
    out, path = scratch_path(spark, "corpus"), _markup_files(spark, folder)
    jobs.build_corpus(spark, path, out, MARKUP)
    jobs.summarise_files(spark, out)
    summary = files.read_if_there(spark, f"{out}/file_summary")
    return _file_numbers(spark, path).join(summary, "file_id").drop("file_id")


@query("""WITH s AS (SELECT n, ceil((0.15::DOUBLE + 0.05::DOUBLE) * n)::BIGINT AS held, round_even(0.15::DOUBLE * n, 0)::BIGINT AS val
  FROM (SELECT count(*) AS n FROM documents)),
sizes AS (SELECT unnest(['train', 'val', 'test']) AS split, unnest([n - held, val, held - val]) AS n FROM s)
SELECT split, n AS instructions, n AS categorised FROM sizes WHERE n > 0""")
def split_job(spark, folder):
    """Files to rows, without duplicates, to the six written files of the splits: their rows.

    The files stand in for given ones and are removed when all their rows are written.
    """
    out, path = scratch_path(spark, "corpus"), _markup_files(spark, folder)
    jobs.build_corpus(spark, path, out, MARKUP)
    drop_scratch(spark, path)
    data, categories = jobs.build_splits(spark, out)
    asked = files.read_json_lines(spark, data, "split string, instruction string, output string")
    known = files.read_json_lines(spark, categories, "split string, combined_category string").filter("combined_category is not null")
    counts = [rows.groupBy("split").agg(F.count("*").alias(name)) for rows, name in ((asked, "instructions"), (known, "categorised"))]
    return counts[0].join(counts[1], "split")
