"""Reference lists per file and overall."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.functions import text as tx
from notemill.operators import joins, ranks


def reference_rows(rows: DataFrame, references: str = "only_references") -> DataFrame:
    """One row per reference with its place in the row: the flattened list in long form."""
    return rows.select("*", F.posexplode(tx.reference_list(F.col(references))).alias("place", "reference"))


def grouped_references(rows: DataFrame, group: str, order: str, references: str = "only_references") -> DataFrame:
    """group, place (from 0), reference: the lists of a group's rows put together in row order.

    One row per reference, whatever a group's size: no list is collected.
    """
    flat = rows.select(group, order, F.posexplode(tx.reference_list(F.col(references))).alias("_place", "reference"))
    numbered = ranks.dense_index(flat, [group, order, "_place"], "_index")
    starts = numbered.groupBy(group).agg(F.min("_index").alias("_start"))
    placed = joins.lookup_join(numbered, starts, group, F.col("_index"))
    return placed.select(group, (F.col("_index") - F.col("_start")).cast("long").alias("place"), "reference")


def group_references(rows: DataFrame, group: str, references: str = "only_references") -> DataFrame:
    """Rows, notes, references and distinct references per group.

    One pass: the first aggregate is by (group, reference) with map-side combining, the second sums
    numbers. No list is collected, so one file may hold any share of the rows.
    """
    exploded = rows.select(group, F.col("notes").isNotNull().cast("long").alias("_note"),
                           F.posexplode_outer(tx.reference_list(F.col(references))).alias("_place", "_ref"))
    first = F.coalesce(F.col("_place"), F.lit(0)) == 0
    pairs = exploded.groupBy(group, "_ref").agg(
        F.count("_ref").alias("_refs"), F.count_if(first).alias("_rows"),
        F.sum(F.when(first, F.col("_note")).otherwise(0)).alias("_notes"))
    return pairs.groupBy(group).agg(
        F.sum("_rows").alias("row_count"), F.sum("_notes").alias("notes_count"),
        F.sum("_refs").alias("total_references"), F.count("_ref").alias("unique_references"))


def file_summary(file_counts: DataFrame, rows: DataFrame) -> DataFrame:
    """The file table: reaction count joined with note and reference counts."""
    summary = group_references(rows, "file_id").drop("row_count")
    return file_counts.join(summary, "file_id")


def frequency(rows: DataFrame, references: str = "only_references") -> DataFrame:
    """How often each reference is cited; empty lists add nothing."""
    refs = rows.select(F.explode(tx.reference_list(F.col(references))).alias("reference"))
    return refs.groupBy("reference").agg(F.count("*").alias("citations"))


def most_cited(rows: DataFrame, top: int = 3, link: Column | None = None) -> DataFrame:
    ranked = frequency(rows).orderBy(F.desc("citations"), "reference").limit(top)
    return ranked if link is None else ranked.withColumn("link", link)
