"""Small helpers for the query modules."""

from pyspark.sql import functions as F

_FRACTIONS = ("mean", "median", "std", "p5", "p25", "p75", "p95", "iqr")


def register():
    """The dictionaries of one area and the decorator that fills them."""
    queries, checks = {}, {}

    def query(check: str | None = None):
        def add(function):
            queries[function.__name__] = function
            if check:
                checks[function.__name__] = check
            return function
        return add

    return queries, checks, query


def joined(column):
    return F.array_join(column, "|")


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in (columns or _FRACTIONS)})
