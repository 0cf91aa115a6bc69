"""Global positions and running totals without a one-task window."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notemill.session import materialise

_SLOT, _PART, _BEFORE = "_slot", "_part", "_part_before"
_ROWS_BITS = 33     # monotonically_increasing_id keeps the partition above, the row in these bits


def _ordered_slots(df: DataFrame, order) -> DataFrame:
    """Range-sorted rows with a slot number (partition and place in it), written once.

    The totals and the rows are both read from the written table, so that they agree on the
    partition bounds even when tasks are run again after an executor is lost. Finding the bounds reads
    what follows the input's last shuffle once more; materialise before when that is costly.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(ordered.withColumn(_SLOT, F.monotonically_increasing_id()), "ordered")


def _offsets(saved: DataFrame, weight) -> DataFrame:
    """Weight before each partition: one row per partition, so its window is small."""
    totals = saved.groupBy(F.shiftright(_SLOT, _ROWS_BITS).alias(_PART)).agg(weight.alias("_total"))
    return totals.select(_PART, (F.sum("_total").over(Window.orderBy(_PART)) - F.col("_total")).alias(_BEFORE))


def placed(df: DataFrame, order) -> DataFrame:
    """Range-sorted rows, written, with ``_slot`` (their place in the order) and ``_part`` (their partition)."""
    return _ordered_slots(df, order).withColumn(_PART, F.shiftright(_SLOT, _ROWS_BITS))


def dense_index(df: DataFrame, order, name: str, start: int = 0) -> DataFrame:
    """Consecutive numbers in the order of ``order``, whose values must be unique."""
    saved = _ordered_slots(df, order)
    place = F.col(_SLOT).bitwiseAND(F.lit((1 << _ROWS_BITS) - 1))
    rows = saved.withColumn(_PART, F.shiftright(_SLOT, _ROWS_BITS))
    return (rows.join(F.broadcast(_offsets(saved, F.count("*"))), _PART)
            .withColumn(name, F.col(_BEFORE) + place + start)
            .drop(_SLOT, _PART, _BEFORE))


def running_total(df: DataFrame, order, weight: str, name: str) -> DataFrame:
    """Sum of ``weight`` over all rows before this one; the values of ``order`` must be unique."""
    saved = _ordered_slots(df, order)
    rows = saved.withColumn(_PART, F.shiftright(_SLOT, _ROWS_BITS))
    before = Window.partitionBy(_PART).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(weight).over(before), F.lit(0))
    return (rows.withColumn("_inside", inside)
            .join(F.broadcast(_offsets(saved, F.sum(weight))), _PART)
            .withColumn(name, F.col(_BEFORE) + F.col("_inside"))
            .drop(_SLOT, _PART, _BEFORE, "_inside"))
