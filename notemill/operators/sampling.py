"""Slices and repeatable samples."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill import fixed_values as fv


def hash_order(key: str, seed: int = fv.SPLIT_SEED) -> Column:
    """A string that orders rows by chance, but always in the same way for one seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = fv.SPLIT_SEED) -> DataFrame:
    """``n`` rows by chance, the same for every run and partitioning; all rows when there are fewer."""
    return df.orderBy(hash_order(key, seed), key).limit(n)


def row_slice(df: DataFrame, order, start: int, stop: int) -> DataFrame:
    """Rows ``start`` up to but not including ``stop`` in the given order."""
    return df.orderBy(*order).offset(start).limit(stop - start)
