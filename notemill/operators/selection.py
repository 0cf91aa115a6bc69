"""Values at given ranks of many groups at once, by bucket counts that close in on them.

Every group that still has a rank to find is a cell: a range of values with the number of rows below it. A round cuts
each cell into pieces, the first by the values' logarithms, later ones into equal widths, counts the rows of each, and keeps the piece that holds the rank with its least and
largest value. Counting is a hash aggregate with at most ``BUCKETS`` rows per cell, whatever the number of rows; no
value list of a group meets in one task, and nothing is sorted but the rows of pieces below ``LAST_ROWS``. The pieces'
rows are written after the first round, so that the input is read three times at most.
"""

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notemill.operators import joins
from notemill.session import materialise

BUCKETS = 4096
LAST_ROWS = 100_000
LARGEST = sys.float_info.max
#: Above the logarithm of the least positive double, with its sign turned.
LEAST_LOGARITHM = 746.0


def _logarithm(value: Column) -> Column:
    """A scale on which values of all sizes are spread evenly, in the order of the values."""
    return F.signum(value) * (F.coalesce(F.log(F.abs(value)), F.lit(0.0)) + LEAST_LOGARITHM)


def _bucket(value: Column, low: Column, high: Column, first: bool) -> Column:
    """Which of the pieces of a range a value lies in: by size at first, of equal width then. Rounding keeps the order of
    values; halves cannot overflow."""
    scale = [_logarithm(c) if first else c / 2 for c in (value, low, high)]
    share = (scale[0] - scale[1]) / (scale[2] - scale[1])
    return F.when(scale[2] == scale[1], 0).otherwise(F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))).cast("int")


def _finite(value: Column) -> Column:
    """Endless values as the largest of their sign, which have a middle; NaN as null."""
    return F.when(F.isnan(value), F.lit(None)).when(value > LARGEST, LARGEST).when(value < -LARGEST, -LARGEST).otherwise(value)


def _beside(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows of the cells: ``_group`` and the cell's number, range and rows below it."""
    small = F.broadcast(cells) if joins.small_enough(cells) else cells
    return rows.join(small, "_group").filter(F.col("_value").between(F.col("_low"), F.col("_high")))


def _cells(wanted: DataFrame) -> DataFrame:
    """The open cells of the ranks; several ranks may lie in one."""
    return materialise(wanted.filter("_low < _high").select("_group", "_low", "_high", "_before").distinct(), "cells")


def _narrowed(found: DataFrame, wanted: DataFrame, first: bool) -> DataFrame:
    """The ranks in the pieces of their cells."""
    pieces = found.groupBy("_group", "_low", "_before", _bucket(F.col("_value"), F.col("_low"), F.col("_high"), first).alias("_piece")).agg(
        F.count("*").alias("_rows"), F.min("_value").alias("_least"), F.max("_value").alias("_most"))
    order = Window.partitionBy("_group", "_low").orderBy("_piece")
    placed = pieces.withColumn("_upto", F.col("_before") + F.sum("_rows").over(order)).drop("_before", "_piece")
    closer = wanted.filter("_low < _high").select("_group", "_low", "_rank").join(placed, ["_group", "_low"])
    closer = closer.filter((F.col("_upto") - F.col("_rows") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto"))).select(
        "_group", "_rank", F.col("_least").alias("_low"), F.col("_most").alias("_high"), (F.col("_upto") - F.col("_rows")).alias("_before"), "_rows")
    return materialise(wanted.filter("_low = _high").unionByName(closer), "ranks")


def values_at(rows: DataFrame, value: str, ranks: DataFrame, *groups: str) -> DataFrame:
    """groups, rank, value (double): the value at every rank (from 0) of the sorted non-null values of its group.

    ``ranks`` has groups and rank; ranks beyond the group's rows give no row. Null groups are groups. NaN is no value, and endless
    values count as the largest finite ones.
    """
    group = F.to_json(F.struct(*groups), {"ignoreNullFields": "false"}) if groups else F.lit("")
    given = rows.select(group.alias("_group"), _finite(F.col(value).cast("double")).alias("_value"))
    given = given.filter(F.col("_value").isNotNull())
    ends = given.groupBy("_group").agg(F.min("_value").alias("_low"), F.max("_value").alias("_high"), F.count("*").alias("_rows"))
    asked = ranks.select(group.alias("_group"), F.col("rank").cast("long").alias("_rank"), *groups).distinct()
    wanted = asked.select("_group", "_rank").join(ends, "_group").filter(F.col("_rank").between(0, F.col("_rows") - 1))
    wanted = materialise(wanted.select("_group", "_rank", "_low", "_high", F.lit(0).cast("long").alias("_before"), "_rows"), "ranks")
    first = True
    while True:
        cells = _cells(wanted)
        if cells.isEmpty():
            break
        found = _beside(given, cells)
        largest = wanted.filter("_low < _high").agg(F.max("_rows").alias("n")).first()["n"]
        if not first and largest <= LAST_ROWS:
            place = F.row_number().over(Window.partitionBy("_group", "_low").orderBy("_value")) - 1 + F.col("_before")
            at = found.withColumn("_rank", place.cast("long")).join(wanted.filter("_low < _high").select("_group", "_rank"), ["_group", "_rank"])
            wanted = wanted.filter("_low = _high").select("_group", "_rank", "_low").unionByName(
                at.select("_group", "_rank", F.col("_value").alias("_low")))
            break
        if not first:
            given = materialise(found.select("_group", "_value"), "inside")
            found = _beside(given, cells)
        wanted, first = _narrowed(found, wanted, first), False
    return asked.join(wanted.select("_group", "_rank", F.col("_low").alias("value")), ["_group", "_rank"]).select(
        *groups, F.col("_rank").alias("rank"), "value")


def quantiles(rows: DataFrame, value: str, probabilities, *groups: str) -> DataFrame:
    """groups, n, and ``q``: an array of linearly interpolated quantiles of the non-null values of every group."""
    held = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    sizes = materialise(rows.filter(held).groupBy(*groups).agg(F.count("*").alias("n")).filter("n > 0"), "sizes")
    places = F.array(*[F.struct(F.lit(i).alias("i"), ((F.col("n") - 1) * F.lit(float(p))).alias("at")) for i, p in enumerate(probabilities)])
    wanted = sizes.select(*groups, "n", F.explode(places).alias("p")).select(*groups, "n", "p.i", "p.at")
    wanted = wanted.select("*", F.explode(F.array(F.struct(F.floor("at").alias("rank"), F.lit("low").alias("side")),
                                                  F.struct(F.ceil("at").alias("rank"), F.lit("high").alias("side")))).alias("r")).select("*", "r.*").drop("r")
    found = values_at(rows, value, wanted.select(*groups, "rank"), *groups)
    name = F.to_json(F.struct(*groups), {"ignoreNullFields": "false"}) if groups else F.lit("")
    both = wanted.withColumn("_name", name).join(found.select(name.alias("_name"), "rank", "value"), ["_name", "rank"])
    per = both.groupBy("_name", "i").agg(
        F.max(F.when(F.col("side") == "low", F.col("value"))).alias("low"), F.max(F.when(F.col("side") == "high", F.col("value"))).alias("high"),
        F.max("at").alias("at"), F.max("n").alias("n"), *[F.first(g).alias(g) for g in groups])
    between = F.col("low") + F.when(F.col("high") != F.col("low"), (F.col("high") - F.col("low")) * (F.col("at") - F.floor("at"))).otherwise(0)
    each = per.withColumn("_v", between).groupBy("_name").agg(
        F.array_sort(F.collect_list(F.struct("i", "_v"))).alias("_all"), F.max("n").alias("n"), *[F.first(g).alias(g) for g in groups])
    return each.select(*groups, F.transform("_all", lambda x: x["_v"]).alias("q"), "n")
