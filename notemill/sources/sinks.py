"""Where results go. Every sink but ``write_json_array`` is written by the executors.

Tables of whole texts are many times as large as anything else a job leaves. They are written packed: Parquet by zstd,
lines by gzip, which Spark's readers tell by the files' names.
"""

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from notemill.functions import text as tx
from notemill.session import RELEASED, settings
from notemill.sources.files import read_if_there

PACKED_TABLE = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(8 << 20)}
PACKED_LINES = {"compression": "gzip", "zlib.compress.level": "FIVE"}
#: A task has the files of all splits open at a time, so that rows need not be sorted by split.
WRITING = RELEASED | {"spark.sql.maxConcurrentOutputFileWriters": "4"}


def write_table(df: DataFrame, path: str) -> None:
    with settings(df.sparkSession, WRITING):
        df.write.mode("overwrite").options(**PACKED_TABLE).parquet(path)


def write_splits(df: DataFrame, folder: str, snippet: str = "snippet", output: str = "notes") -> tuple[str, str]:
    """Packed JSON lines per split: instruction and output, and the rows with their categories.

    Returns the two paths; each holds one ``split=...`` folder per split.
    """
    data, categories = f"{folder}/data", f"{folder}/with_categories"
    asked = df.select("split", tx.instruction(F.col(snippet)).alias("instruction"), F.col(output).alias("output"))
    with settings(df.sparkSession, WRITING):
        for rows, path in ((asked, data), (df, categories)):
            rows.write.mode("overwrite").options(**PACKED_LINES).partitionBy("split").json(path)
    return data, categories


def write_json_array(df: DataFrame, path: str, order, rows: int) -> None:
    """The first ``rows`` rows as one JSON array in one file: a hand-sized subset."""
    first = df.orderBy(*order).limit(rows)
    array = first.agg(F.sort_array(F.collect_list(F.struct(*order, F.struct(*df.columns).alias("row")))).alias("all"))
    array.select(F.to_json(F.col("all.row")).alias("value")).write.mode("overwrite").text(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_terms(terms: DataFrame, path: str, column: str) -> None:
    """Sorted terms, one per line; the files in name order are the sorted list."""
    terms.select(column).orderBy(column).write.mode("overwrite").text(path)


def write_failed(results: DataFrame, path: str, column: str, status: str = "status") -> bool:
    """Ids with an error, one per line, for a second attempt; nothing is written when there are none."""
    failed = results.filter(F.col(status) == "error").select(column)
    if failed.isEmpty():
        return False
    failed.write.mode("overwrite").text(path)
    return True


def _input_key(spark: SparkSession, inputs: Sequence[str]) -> str:
    """Number of the input files and a mark of their names, lengths and times; contents are not read."""
    if not inputs:
        return ""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(inputs))
    mark = F.coalesce(F.bit_xor(F.xxhash64("path", "length", "modificationTime")), F.lit(0))
    found = files.agg(F.count("*").alias("n"), mark.alias("mark")).first()
    return f"{found['n']}:{found['mark']}"


def _manifest(spark: SparkSession, path: str) -> dict | None:
    """What was published last: the data's folder and the key of its inputs; None when nothing was, or not to its end."""
    try:
        lines = spark.read.text(f"{path}/manifest").collect()
        return json.loads(lines[0]["value"]) if len(lines) == 1 else None
    except (AnalysisException, ValueError):
        return None


def publish(df: DataFrame, path: str, key: str = "") -> None:
    """Write a table aside and then, in one small file, that it is whole. A write that is broken off leaves what was
    published before, or nothing."""
    folder = f"data-{uuid.uuid4().hex}"
    with settings(df.sparkSession, WRITING):
        df.write.options(**PACKED_TABLE).parquet(f"{path}/{folder}")
    line = json.dumps({"folder": folder, "key": key, "schema": df.schema.simpleString()})
    df.sparkSession.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def published(spark: SparkSession, path: str, schema: StructType | None = None, key: str | None = None) -> DataFrame | None:
    """The table last published at ``path``; None when there is none, its inputs had another key, or a column of ``schema`` is
    missing or of another type."""
    manifest = _manifest(spark, path)
    if manifest is None or key is not None and manifest["key"] != key:
        return None
    found = read_if_there(spark, f"{path}/{manifest['folder']}")
    if found is None or found.schema.simpleString() != manifest["schema"]:
        return None
    types = {field.name: field.dataType.simpleString() for field in found.schema}
    fits = schema is None or all(types.get(field.name) == field.dataType.simpleString() for field in schema)
    return found if fits else None


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame | None], schema: StructType | None = None,
                  again: bool = False, inputs: Sequence[str] = ()) -> DataFrame | None:
    """The table at ``path``, built and published first if it is not there, not whole, of other columns or types, made from
    other ``inputs`` (files or folders), or asked for again. Tables that were published before are left beside it."""
    key = _input_key(spark, inputs)
    found = None if again else published(spark, path, schema, key)
    if found is not None:
        return found
    built = build()
    if built is None:
        return None
    publish(built, path, key)
    return published(spark, path)
