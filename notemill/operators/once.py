"""Evaluate expensive columns exactly once."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` whose expressions later filters cannot copy.

    The optimizer moves a filter below a projection by putting the column's expression in place of
    its name; for a long chain of text steps that repeats the chain, and each step that reads its
    input twice doubles it. Columns that leave a one-row generator are not replaced that way, while
    filters on all other columns still reach the scan.
    """
    keep = [c for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))
