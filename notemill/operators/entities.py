"""Names out of JSON entity records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import text as tx

RECORDS = "array<struct<schemaClass:string,displayName:string>>"


def entity_rows(df: DataFrame, column: str) -> DataFrame:
    """One row per record of a JSON array column; an absent display name is empty."""
    records = df.select(F.explode(F.from_json(F.col(column), RECORDS)).alias("record"))
    return records.select(F.col("record.schemaClass").alias("schema_class"),
                          F.coalesce("record.displayName", F.lit("")).alias("display_name"))


def entity_names(df: DataFrame, column: str, kind: str = fv.ENTITY_CLASS) -> DataFrame:
    """Sorted distinct usable names of one class over all records."""
    rows = entity_rows(df, column).filter(F.col("schema_class") == kind)
    names = rows.select(tx.entity_name(F.col("display_name")).alias("name"))
    return names.filter(tx.is_entity_name(F.col("name"))).distinct().orderBy("name")
