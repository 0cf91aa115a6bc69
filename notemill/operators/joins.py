"""Joins that stay balanced when a key is hot."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notemill.operators import ranks
from notemill.session import materialise

BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a written table is small enough to broadcast: all its rows are counted and their bytes summed.

    Numbers count 16 bytes, strings and binaries their own, lists, maps and structs those of their JSON form.
    Every task sends one row of sums.
    """
    def width(name: str, kind: str) -> Column:
        if kind.startswith(("array", "map", "struct")):
            return F.octet_length(F.to_json(F.struct(name)))
        return F.octet_length(F.col(name)) if kind in ("string", "binary") else F.lit(0)

    widths = [F.coalesce(width(name, kind), F.lit(0)) for name, kind in df.dtypes]
    total = sum(widths, F.lit(16 * len(df.columns)).cast("long"))
    found = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(total), F.lit(0)).alias("bytes")).first()
    return found["rows"] <= rows and found["bytes"] <= size


def lookup_join(rows: DataFrame, table: DataFrame, key: str, spread_by: Column, how: str = "left",
                small: bool | None = None, parts: int | None = None) -> DataFrame:
    """Join rows to a table with unique keys (``how``: left or inner).

    The table is written, measured and broadcast if it is small. Beyond that the rows are counted per key, and
    ``attach`` keeps the keys that hold many rows, known to the table or not, from meeting in one task.
    ``spread_by`` must differ between rows of one key.
    """
    if small is None:
        table = materialise(table, "lookup")
        small = small_enough(table)
    if small:
        return rows.join(F.broadcast(table), key, how)
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    weighted = counts.join(table.withColumn("_match", F.lit(True)), key, "left")
    found = attach(rows, weighted, key, "_n", spread_by, parts)
    return (found.filter("_match") if how == "inner" else found).drop("_match")


def _hot_join(rows: DataFrame, hot: DataFrame, key: str, spread_by: Column, parts: int) -> DataFrame:
    """Left join to the few hot keys: by broadcast, or with ``parts`` copies of them if their values are too long for that."""
    if small_enough(hot):
        return rows.join(F.broadcast(hot), key, "left")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int"))
    copies = hot.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def _own(key: str) -> Column:
    """The key as text, set apart from chance keys."""
    return F.concat(F.lit("k"), F.col(key).cast("string"))


def attach(rows: DataFrame, table: DataFrame, key: str, weight: str, spread_by: Column,
           parts: int | None = None) -> DataFrame:
    """Left join rows to a table with unique keys that says how many rows each key has (``weight``).

    Keys above the ``parts``-th share of all rows number fewer than ``parts``: these are looked up by
    broadcast (salted, should they be too long for that). The rest is joined by key. Rows that were
    looked up, or whose key is null, take a chance key instead of their own, so that they do not meet
    in one task. The weight is dropped.
    """
    parts = parts or min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1000)
    table = materialise(table, "keys")
    values = [c for c in table.columns if c not in (key, weight)]
    total = table.agg(F.sum(weight).alias("total")).scalar()
    is_hot = F.col(weight) * parts > total
    hot = table.filter(is_hot).select(key, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in values])
    cold = table.filter(~is_hot).select(_own(key).alias("_key"),
                                        *[F.col(c).alias(f"_cold_{c}") for c in values])
    flagged = _hot_join(rows, hot, key, spread_by, parts)
    chance = F.concat(F.lit("n"), F.xxhash64(spread_by).cast("string"))
    keyed = flagged.withColumn("_key", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), _own(key)).otherwise(chance))
    return keyed.join(cold, "_key", "left").select(
        *rows.columns, *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in values])


def count_back(rows: DataFrame, key: str, spread_by: Column, name: str = "count",
               parts: int | None = None) -> DataFrame:
    """Occurrences of ``key`` on every row; null keys keep a null count. For long texts give their fingerprint as key."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return attach(rows, counts.withColumn(name, F.col("_n")), key, "_n", spread_by, parts)


def prefix_matches(ids: DataFrame, id_column: str, names: DataFrame, name_column: str) -> DataFrame:
    """Rows of ``ids`` whose id some name starts with; null ids and names match nothing.

    In the order of their bytes the names that start with an id follow it without a gap, so the next name decides. Ids
    and names, each once, are sorted together by range; an id looks at the next name in its partition, or else at the
    first name of the partitions behind it, of which each has one row. Nothing depends on how many lengths ids have.
    """
    name = F.when(F.col("_kind") == 1, F.col("_value"))
    both = (ids.select(F.col(id_column).alias("_value")).distinct().withColumn("_kind", F.lit(0))
            .unionByName(names.select(F.col(name_column).alias("_value")).distinct().withColumn("_kind", F.lit(1))))
    rows = ranks.placed(materialise(both.filter(F.col("_value").isNotNull()), "names"), ["_value", "_kind"])
    behind = Window.partitionBy("_part").orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = rows.groupBy("_part").agg(F.min(name).alias("_least"))
    parts = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    carried = firsts.select("_part", F.last("_least", True).over(parts).alias("_carried"))
    following = rows.withColumn("_next", F.last(name, True).over(behind)).filter("_kind = 0").join(F.broadcast(carried), "_part")
    found = following.filter(F.startswith(F.coalesce("_next", "_carried"), F.col("_value")))
    return ids.join(found.select(F.col("_value").alias(id_column)), id_column, "left_semi")


def exact_matches(ids: DataFrame, id_column: str, names: DataFrame, name_column: str,
                  suffix: str = ".sbml") -> DataFrame:
    """Ids whose file is there under exactly that name."""
    files = names.select(F.regexp_replace(name_column, "\\Q" + suffix + "\\E\\z", "").alias(id_column)).distinct()
    return ids.join(files, id_column, "left_semi")


def pending(ids: DataFrame, id_column: str, done: DataFrame) -> DataFrame:
    """Ids that are not in ``done`` yet."""
    return ids.join(done.select(id_column).distinct(), id_column, "left_anti")


def completeness(ids: DataFrame, matched: DataFrame) -> DataFrame:
    """Expected and found ids, and whether all are there."""
    both = (ids.agg(F.count("*").alias("expected")).select("expected", F.lit(0).cast("long").alias("found"))
            .unionByName(matched.agg(F.count("*").alias("found")).select(F.lit(0).cast("long").alias("expected"), "found")))
    return both.agg(F.sum("expected").alias("expected"), F.sum("found").alias("found")).withColumn(
        "complete", F.col("expected") == F.col("found"))
