"""Jobs that write tables: the whole way from files to splits.

Each job reads what the one before it wrote, so a lost executor repeats one stage and not the corpus.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import text as tx
from notemill.operators import cleaning, dedup, joins, parsing, references, splits
from notemill.session import settings
from notemill.sources import files, sinks

#: What opening a file counts for when files are dealt out: tasks of more small files write fewer and better packed ones.
SMALL_FILES = {"spark.sql.files.openCostInBytes": str(1 << 20)}
REACTION_COLUMNS = ("file_id", "reaction_id", "original_notes", "notes", "only_references", "snippet")


def parsed_files(documents: DataFrame, tag: str = "reaction", paragraph: str | None = fv.PARAGRAPH_ADDRESS) -> DataFrame:
    """file_id, and what ``parsing.parsed`` says of whole markup documents (file_id, value)."""
    read = documents.select("file_id", parsing.parsed(F.col("value"), tag, paragraph).alias("_read"))
    return read.select("file_id", "_read.*")


def reaction_rows(parsed: DataFrame) -> DataFrame:
    """Note rows out of the elements of parsed files, in document order by ``row_order``."""
    rows = parsed.select("file_id", F.inline("elements")).select(
        "file_id", "position", F.col("id").alias("reaction_id"), F.col("note").alias("original_notes"),
        tx.normalise_lines(F.col("element")).alias("snippet"))
    cleaned = cleaning.clean_notes(rows)
    order = F.concat_ws(":", "file_id", F.lpad(F.col("position").cast("string"), 9, "0"))
    return cleaned.select(*REACTION_COLUMNS, order.alias("row_order"))


def build_corpus(spark: SparkSession, folder: str, out: str, names: str = "*.sbml") -> None:
    """Markup files to ``reactions``, ``file_counts`` and ``broken_files``.

    A file that does not parse gives no rows and the count 0, and is listed with the parser's message and the line
    and column it stopped at; the others go on. Rows are written as they are parsed, so that no text lies on disk a
    second time; only the files without a row, of which some may be broken, are parsed again for the messages.
    """
    documents = files.markup_documents(spark, folder, names)
    with settings(spark, SMALL_FILES):
        sinks.write_table(reaction_rows(parsed_files(documents)), f"{out}/reactions")
    sinks.write_table(files.record_counts(spark, folder, spark.read.parquet(f"{out}/reactions"), names), f"{out}/file_counts")
    without = spark.read.parquet(f"{out}/file_counts").filter("reaction_count = 0").select("file_id")
    again = documents.join(F.broadcast(without) if joins.small_enough(without) else without, "file_id", "left_semi")
    # without such a file nothing is read at all
    read = parsed_files(documents.limit(0) if without.isEmpty() else again)
    sinks.write_table(read.filter("message is not null").select("file_id", "message", "line", "column"), f"{out}/broken_files")


def summarise_files(spark: SparkSession, out: str) -> None:
    """The two tables of ``build_corpus`` to ``file_summary``."""
    summary = references.file_summary(spark.read.parquet(f"{out}/file_counts"), spark.read.parquet(f"{out}/reactions"))
    sinks.write_table(summary, f"{out}/file_summary")


def build_splits(spark: SparkSession, out: str) -> tuple[str, str]:
    """Rows without duplicates (kept in ``reactions_train`` with their word counts), categorised, split and written as JSON.

    Quartiles, strata and both written tables ask for the categories; words are counted once, when the rows are kept.
    """
    def distinct():
        rows = files.read_if_there(spark, f"{out}/reactions")
        return None if rows is None else splits.word_counts(dedup.keep_first(rows, ["snippet", "notes"], "row_order"))

    train = sinks.load_or_build(spark, f"{out}/reactions_train", distinct, inputs=[f"{out}/reactions"])
    parted = splits.stratified_split(splits.categorise(train), "combined_category", "row_order")
    return sinks.write_splits(parted, f"{out}/splits")
