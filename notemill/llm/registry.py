"""All registered queries of this folder, and their check SQL."""

from notemill.llm import checks, queries


def all_queries() -> dict:
    return dict(queries.QUERIES)


def all_sql() -> dict:
    return dict(checks.SQL)
