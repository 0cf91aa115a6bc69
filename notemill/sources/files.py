"""File sources: markup, JSON, tab separated and plain text."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from notemill.functions import text as tx

BROKEN = "_corrupt_record"


def _file_id() -> Column:
    """The file's own name, out of its address; a plus is a plus there."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("file_id")


def markup_documents(spark: SparkSession, folder: str, names: str = "*.sbml") -> DataFrame:
    """file_id, value: one row per file with its whole text."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=names)
    return files.select(_file_id(), "value")


def markup_records(spark: SparkSession, folder: str, tag: str, fields: str, names: str = "*.sbml") -> DataFrame:
    """One row per element of well-formed files, prefixes ignored; the columns are ``fields``.

    An attribute ``a`` is the field ``_a``. Where a file breaks, the records before are given and one
    row has all fields null and the text in the last column; ``split_broken`` tells whole files apart.
    """
    schema = f"{fields}, {BROKEN} string"
    reader = spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", True)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
    rows = reader.option("pathGlobFilter", names).schema(schema).load(folder)
    return rows.select(_file_id(), "*")


def well_formed(markup: Column) -> Column:
    """Whether a whole document parses, to its very end."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    return F.from_xml(markup, f"any string, {BROKEN} string", options)[BROKEN].isNull()


def split_broken(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that parse, and those that do not."""
    checked = documents.withColumn("_good", well_formed(F.col("value")))
    return checked.filter("_good").drop("_good"), checked.filter("not _good").drop("_good")


def record_counts(spark: SparkSession, folder: str, records: DataFrame, names: str = "*.sbml") -> DataFrame:
    """file_id, reaction_count for every file of the folder, 0 included."""
    counts = records.groupBy("file_id").agg(F.count("*").alias("n"))
    files = list_files(spark, folder, names).select("file_id")
    return files.join(counts, "file_id", "left").select("file_id", F.coalesce("n", F.lit(0)).alias("reaction_count"))


def list_files(spark: SparkSession, folder: str, names: str = "*") -> DataFrame:
    """file_id, length: the files of a folder. Contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(folder)
    return files.select(_file_id(), "length")


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab separated lines without header or quoting."""
    return spark.read.csv(path, sep="\t", schema=schema, quote="")


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """One stripped term per line; blank lines are left out."""
    terms = spark.read.text(path).select(tx.strip(F.col("value")).alias("term"))
    return terms.filter(F.col("term") != "")


def read_json_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """One JSON object per line; blank lines are left out."""
    return spark.read.schema(schema).json(path)


def read_json(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON lines, or one JSON array per file: the first sign that is no blank tells which."""
    first = spark.read.text(path).filter(F.trim("value") != "").select(F.substring(F.ltrim("value"), 1, 1).alias("c")).head()
    lines = first is None or first["c"] != "["
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_if_there(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A Parquet table, or None when there is none or, with a schema given, it has other columns."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException:
        return None
    return found if schema is None or set(schema.names) <= set(found.columns) else None
