"""Duplicates. Copies meet only after each task has kept one of its own."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.operators import joins
from notemill.session import RELEASED, drop_scratch, materialise, scratch_path, settings

#: Registers of a distinct sketch: 2 ** 12.
SKETCH_BITS = 12
#: Bits that tell which rows may be later copies: 16 MB whatever the input.
FILTER_BITS = 1 << 27
_MARK = "_fingerprint"


def fingerprint(columns) -> Column:
    """A SHA-256 of the columns that takes a text's place as a key; nulls are equal to each other and to nothing else."""
    parts = [F.coalesce(F.concat(F.char_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
             for c in columns]
    return F.sha2(F.concat(*parts), 256)


def _may_be_in(rows: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """Adds whether a row's ``_place`` may be one of ``places``, by one bit per hash: false is certain, true is not."""
    number = F.pmod(F.xxhash64("_place"), F.lit(FILTER_BITS)) + 1
    bucket, position = F.bitmap_bucket_number(number), F.bitmap_bit_position(number)
    bits = places.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(position).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.withColumn("_bucket", bucket).join(F.broadcast(materialise(bits, "bits")), "_bucket", "left")
    return met.withColumn(name, F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))).drop("_bucket", "_bits")


def keep_first(df: DataFrame, subset, order: str) -> DataFrame:
    """One row per value of ``subset`` (nulls are equal): the one that is first by ``order``, which is unique and not null.

    Fingerprints and places are written, and the smallest place per fingerprint is found among them. The later copies
    are broadcast, 16 bytes each, to the rows, which stay where they are. Are they too many for that, a bitmap tells
    which rows may be copies, and these alone are moved to meet them, by a key that no two rows share. ``df`` is read
    twice, or three times; write it before if it is costly.
    """
    marked = df.withColumn(_MARK, fingerprint(subset))
    place = F.unhex(F.substring(fingerprint([_MARK, order]), 1, 32))
    spark = df.sparkSession
    written = scratch_path(spark, "keys")
    with settings(spark, RELEASED):
        keys = materialise(marked.select(F.unhex(_MARK).alias(_MARK), order), path=written, compression="zstd").withColumn(_MARK, F.lower(F.hex(_MARK)))
        copied = keys.groupBy(_MARK).agg(F.min(order).alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
        copies = joins.lookup_join(keys, copied, _MARK, F.col(order), "inner")
        later = materialise(copies.filter(F.col(order) > F.col("_first")).select(place.alias("_place")), "copies")
    drop_scratch(spark, written)
    rows = marked.withColumn("_place", place).filter(F.col(order).isNotNull()).drop(_MARK)
    if joins.small_enough(later):
        return rows.join(F.broadcast(later), "_place", "left_anti").select(*df.columns)
    maybe = _may_be_in(rows, later, "_maybe")
    moved = maybe.filter("_maybe").join(later, "_place", "left_anti")
    return maybe.filter("not _maybe").select(*df.columns).unionByName(moved.select(*df.columns))


def duplicate_report(df: DataFrame, subset) -> DataFrame:
    """Rows before and after removing duplicates, and how many go."""
    groups = df.groupBy(fingerprint(subset).alias(_MARK)).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after")) \
        .withColumn("removed", F.col("rows_before") - F.col("rows_after"))


def distinct_counts(df: DataFrame) -> DataFrame:
    """Distinct non-null values of every column, in one row.

    One row per column and value fingerprint, taken together first and counted then: no value is carried along, whatever its
    length, and no column meets in one task.
    """
    marks = F.array(*[F.struct(F.lit(i).alias("column"), F.when(F.col(c).isNotNull(), fingerprint([c])).alias("mark")) for i, c in enumerate(df.columns)])
    pairs = df.select(F.inline(marks)).filter(F.col("mark").isNotNull()).distinct()
    counts = pairs.groupBy("column").agg(F.count("*").alias("n"))
    return counts.agg(*[F.coalesce(F.max(F.when(F.col("column") == i, F.col("n"))), F.lit(0)).alias(c) for i, c in enumerate(df.columns)])


def distinct_sketches(df: DataFrame, group: str, value: str, bits: int = SKETCH_BITS) -> DataFrame:
    """group, sketch: a mergeable sketch of the distinct non-null values of each group. It is a few thousand bytes at most, may be
    stored, and sketches of any groups or days can be put together by ``merged_distinct``."""
    mark = F.when(F.col(value).isNotNull(), fingerprint([value]))
    return df.select(group, mark.alias("_mark")).groupBy(group).agg(F.hll_sketch_agg("_mark", F.lit(bits)).alias("sketch"))


def merged_distinct(sketches: DataFrame, *groups: str) -> DataFrame:
    """Estimated distinct values of all sketches, per ``groups`` if given. The standard error is 1.04 / sqrt(2 ** bits): 1.6 %."""
    return sketches.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))


def group_distinct(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Distinct non-null values per non-null group, in two aggregates so that a hot group is spread."""
    pairs = df.filter(F.col(group).isNotNull()).select(group, value).distinct()
    return pairs.groupBy(group).agg(F.count(value).alias(name))


def shared_rows(df: DataFrame, value: str, group: str) -> DataFrame:
    """Rows whose ``value`` belongs to more than one ``group``; a value may be on any share of the rows."""
    marked = df.withColumn(_MARK, F.when(F.col(value).isNotNull(), fingerprint([value])))
    pairs = marked.filter(F.col(_MARK).isNotNull()).groupBy(_MARK, group).agg(F.count("*").alias("_n"))
    sizes = pairs.groupBy(_MARK).agg(F.sum("_n").alias("_rows"), F.count(group).alias("_groups"))
    shared = sizes.filter("_groups > 1")
    return joins.attach(marked, shared, _MARK, "_rows", F.col(group)).filter("_groups > 1").drop("_groups", _MARK)
