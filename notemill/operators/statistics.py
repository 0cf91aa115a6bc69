"""Descriptive statistics and distribution tables.

All aggregate value counts map-side. Lengths and counts have few distinct values, and Spark's exact
``percentile`` is enough for them. For columns where nearly every value differs use
``exact_quantiles`` and ``describe_spread``, which never bring the values into one task.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notemill.operators import selection
from notemill.session import materialise

QUARTILES = (0.25, 0.5, 0.75)
CUTS = (0.05, 0.25, 0.5, 0.75, 0.95)


def value_counts(df: DataFrame, column, *groups: str) -> DataFrame:
    value = F.col(column) if isinstance(column, str) else column
    rows = df.select(*groups, value.alias("value")).filter("value is not null")
    return rows.groupBy(*groups, "value").agg(F.count("*").alias("n"))


def _percentiles(probabilities):
    return F.percentile("value", F.array(*[F.lit(p) for p in probabilities]), F.col("n"))


def describe(df: DataFrame, column, *groups: str, population: bool = False) -> DataFrame:
    """Count, total, mean, median, deviation, extremes, percentiles and interquartile range.

    One aggregate: each task brings its sums and its value counts for the percentiles, of which
    lengths and counts have few.
    """
    value = F.col(column) if isinstance(column, str) else column
    rows = df.select(*groups, value.alias("value")).filter("value is not null")
    std = F.stddev_pop if population else F.stddev_samp
    base = rows.groupBy(*groups).agg(
        F.count("*").alias("count"), F.sum("value").alias("total"), F.avg("value").alias("mean"),
        std("value").alias("std"), F.min("value").alias("minimum"), F.max("value").alias("maximum"),
        F.percentile("value", F.array(*[F.lit(p) for p in CUTS])).alias("_p"))
    p = F.col("_p")
    return base.select(
        *groups, "count", "total", "mean", p[2].alias("median"), "std", "minimum", "maximum",
        p[0].alias("p5"), p[1].alias("p25"), p[3].alias("p75"), p[4].alias("p95"), (p[3] - p[1]).alias("iqr"))


def exact_quantiles(df: DataFrame, column: str, probabilities) -> DataFrame:
    """One row with ``q`` = array of linearly interpolated quantiles, and ``n``; see ``selection``."""
    return selection.quantiles(df, column, probabilities)


def describe_spread(df: DataFrame, column: str, population: bool = False) -> DataFrame:
    """``describe`` for a column of many distinct values."""
    return describe_columns(df, [column], population=population).drop("column")


def describe_columns(df: DataFrame, columns, *groups: str, population: bool = False) -> DataFrame:
    """column, groups and the figures of ``describe`` for several columns of many distinct values at once.

    The columns are one long table, and all quantiles of all groups and columns are closed in on together. A column
    without a value in a group gives no row there.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    long = df.select(*groups, pairs.alias("_pair")).select(*groups, "_pair.*").filter(F.col("value").isNotNull())
    deviation = F.stddev_pop if population else F.stddev_samp
    base = long.groupBy("column", *groups).agg(
        F.count("*").alias("count"), F.sum("value").alias("total"), F.avg("value").alias("mean"),
        deviation("value").alias("std"), F.min("value").alias("minimum"), F.max("value").alias("maximum"))
    found = selection.quantiles(long, "value", CUTS, "column", *groups).withColumnRenamed("n", "_n")
    for name in ("column", *groups):
        found = found.withColumnRenamed(name, f"_of_{name}")
    same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in ("column", *groups)]
    rows = base.join(found, reduce(lambda a, b: a & b, same), "left")
    q = F.col("q")
    return rows.select(
        "column", *groups, "count", "total", "mean", q[2].alias("median"), "std", "minimum", "maximum",
        q[0].alias("p5"), q[1].alias("p25"), q[3].alias("p75"), q[4].alias("p95"), (q[3] - q[1]).alias("iqr"))


def within_percentiles(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies between two percentiles (0 to 100), both included."""
    cuts = exact_quantiles(df, column, (low / 100, high / 100)).select("q").scalar()
    return df.filter(F.col(column).between(cuts[0], cuts[1]))


def log10_positive(df: DataFrame, column: str, name: str) -> DataFrame:
    """Positive values and their decimal logarithm."""
    return df.filter(F.col(column) > 0).withColumn(name, F.log10(column))


def _shape(counts: DataFrame, quartiles: bool) -> DataFrame:
    """One row: n, extremes, deviation and, if asked for, quartiles of a value count table.

    The deviation is taken around the mean, so the counts are read twice.
    """
    n, value = F.col("n"), F.col("value").cast("double")
    mean = counts.agg((F.sum(value * n) / F.sum("n")).alias("mean")).scalar()
    base = counts.withColumn("_off", value - mean).agg(
        F.sum("n").alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.sum(F.col("_off") * F.col("_off") * n).alias("_squares"),
        *([_percentiles(QUARTILES).alias("q")] if quartiles else []))
    return base.withColumn("std", F.when(F.col("rows") > 1, F.sqrt(F.col("_squares") / (F.col("rows") - 1)))).drop("_squares")


def histogram(counts: DataFrame, bins: int | None = None) -> DataFrame:
    """Equal-width histogram with densities, empty bins included, from a value count table.

    Without ``bins`` the number is the larger of the Sturges and Freedman-Diaconis ones; give it for a
    column of many distinct values, whose quartiles do not fit one task. A constant column gets one
    bin of width 1 around its value. The counts are written once, as several parts read them.
    """
    counts = materialise(counts, "counts")
    wanted = F.lit(bins).cast("long")
    if not bins:
        rows = F.col("rows").cast("double")
        iqr = F.col("q")[2] - F.col("q")[0]
        freedman = F.when(iqr > 0, F.ceil((F.col("high") - F.col("low")) / (2 * iqr / F.pow(rows, F.lit(1 / 3)))))
        wanted = F.greatest(F.ceil(F.log2(rows) + 1), F.coalesce(freedman, F.lit(1)))
    flat = F.col("high") == F.col("low")
    shape = (_shape(counts, quartiles=not bins).withColumn("bins", F.when(flat, 1).otherwise(wanted).cast("long"))
             .withColumn("left", F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")))
             .withColumn("width", F.when(flat, 1.0).otherwise((F.col("high") - F.col("low")) / F.col("bins"))))
    s = shape.select(F.struct("rows", "bins", "left", "width").alias("s")).scalar()
    value = F.col("value").cast("double")
    number = F.least(F.floor((value - s["left"]) / s["width"]) + 1, s["bins"]).cast("long")
    filled = counts.groupBy(number.alias("bin")).agg(F.sum("n").alias("rows_in_bin"))
    every = shape.select(F.explode(F.sequence(F.lit(1).cast("long"), F.col("bins"))).alias("bin"),
                         "left", "width", "rows")
    return every.join(filled, "bin", "left").select(
        "bin", (F.col("left") + (F.col("bin") - 1) * F.col("width")).alias("bin_start"),
        F.coalesce("rows_in_bin", F.lit(0)).cast("long").alias("rows_in_bin"),
        (F.coalesce("rows_in_bin", F.lit(0)) / (F.col("rows") * F.col("width"))).alias("density"))


def density_curve(counts: DataFrame, points: int = 40) -> DataFrame:
    """Gaussian density with Scott's bandwidth on an even grid between the extremes.

    Works on value counts: every distinct value adds to ``points`` grid places, summed map-side.
    """
    counts = materialise(counts, "counts")
    shape = _shape(counts, quartiles=False).withColumn("width", F.col("std") * F.pow(F.col("rows").cast("double"), F.lit(-0.2)))
    s = shape.select(F.struct("rows", "low", "high", "width").alias("s")).scalar()
    at = s["low"] + (s["high"] - s["low"]) * F.col("point") / (points - 1)
    z = (at - F.col("value").cast("double")) / s["width"]
    spread_out = counts.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    sums = spread_out.groupBy("point").agg(F.sum(F.col("n") * F.exp(-z * z / 2)).alias("_sum"))
    return sums.select(F.col("point").cast("long").alias("point"), at.alias("x"),
                       (F.col("_sum") / (s["rows"] * s["width"] * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"))


def box_summary(counts: DataFrame) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges, and the number of outliers."""
    counts = materialise(counts, "counts")
    q = counts.agg(_percentiles(QUARTILES).alias("q")).scalar()
    value, reach = F.col("value"), 1.5 * (q[2] - q[0])
    inside = value.between(q[0] - reach, q[2] + reach)
    return counts.agg(
        F.max(q[0]).alias("q1"), F.max(q[1]).alias("median"), F.max(q[2]).alias("q3"),
        F.min(F.when(inside, value)).alias("whisker_low"), F.max(F.when(inside, value)).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("outliers"))


def outliers(df: DataFrame, column: str) -> DataFrame:
    """Rows outside the whiskers."""
    q = value_counts(df, column).agg(_percentiles(QUARTILES).alias("q")).scalar()
    reach = 1.5 * (q[2] - q[0])
    return df.filter(~F.col(column).between(q[0] - reach, q[2] + reach))
