"""Column expressions shared by the operators that stay inside Spark's own functions."""

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHUNK = 256


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def starts_before(lengths: Column) -> Column:
    """Of a list of lengths, the sum of those before each place. Sums of chunks keep this far from quadratic."""
    def bounded(sums: Column) -> Column:
        return F.transform(lengths, lambda _, i: F.element_at(sums, (F.floor(i / _CHUNK) + 1).cast("int")) + F.aggregate(
            F.slice(lengths, (F.floor(i / _CHUNK) * _CHUNK + 1).cast("int"), (i % _CHUNK).cast("int")), F.lit(0), lambda a, b: a + b))

    chunks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _CHUNK).cast("int"))
    sums = F.transform(chunks, lambda c: F.aggregate(F.slice(lengths, F.lit(1), c * _CHUNK), F.lit(0), lambda a, b: a + b))
    return F.when(F.size(lengths) > 0, bounded(sums)).otherwise(F.array().cast("array<int>"))


def match_spans(text: Column, pattern: str | Column, kind: str, accepts) -> Column:
    """(kind, start, end, value) of all leftmost, non-overlapping matches that ``accepts`` (an expression of the
    matched text). Code points, end exclusive. The pieces between the matches give their places."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, pattern, -1)
    steps = F.zip_with(matches, pieces, lambda m, p: F.struct(
        m.alias("value"), F.length(p).alias("gap"), (F.length(p) + F.length(m)).alias("step")))
    kept = F.filter(steps, lambda s: s["value"].isNotNull())
    before = starts_before(F.transform(kept, lambda s: s["step"]))
    spans = F.zip_with(kept, before, lambda s, b: F.struct(
        F.lit(kind).alias("kind"), (b + s["gap"]).cast("int").alias("start"),
        (b + s["step"]).cast("int").alias("end"), s["value"].alias("value")))
    return F.filter(spans, lambda s: accepts(s["value"]))
