"""A set of hashes as a bitmap of fixed size: it lets false ones through, but holds back none."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.session import materialise

BITS = 24


class HashSet:
    """Two probes per hash into 2 ** ``BITS`` bits (2 MB), whatever the number of hashes."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for shift in (0, 32):
            probe = (hashes >> np.uint64(shift)) & np.uint64((1 << BITS) - 1)
            found &= (self.words[probe >> np.uint64(6)] >> (probe & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def hash_set(hashes: DataFrame, column: str) -> HashSet:
    """The bitmap of a column of 64-bit hashes. What comes to the driver has 2 ** (BITS - 6) rows at most."""
    mask = (1 << BITS) - 1
    value = F.col(column)
    probes = hashes.select(F.explode(F.array(value.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(value, 32).bitwiseAND(F.lit(mask)))).alias("_p"))
    bits = probes.groupBy(F.shiftright("_p", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_p & 63 as int))")).alias("bits")).toArrow()
    words = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    words[bits.column("word").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return HashSet(words)


def may_hold(shared, hashes: Column) -> Column:
    """Whether the broadcast bitmap holds a hash; true for every hash that was put in."""
    def probe(values: pa.Array) -> pa.Array:
        return pa.array(shared.value.holds(values.to_numpy().view(np.uint64)))
    return F.arrow_udf(probe, "boolean")(hashes)


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``gone``. Only rows that the bitmap cannot clear are moved for the join; null keys stay."""
    spark = rows.sparkSession
    gone = materialise(gone.select(key).dropna().distinct(), "gone")
    shared = spark.sparkContext.broadcast(hash_set(gone.select(id_hash(F.col(key)).alias("h")), "h"))
    name = free_name(rows, "may")
    flagged = rows.withColumn(name, may_hold(shared, id_hash(F.col(key))))
    moved = flagged.filter(F.col(name)).drop(name).join(gone, key, "left_anti").select(*rows.columns)
    return flagged.filter(~F.col(name)).drop(name).unionByName(moved)


def free_name(rows: DataFrame, name: str) -> str:
    """A column name that ``rows`` does not have yet."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_hash(ids: Column) -> Column:
    return F.xxhash64(ids)
