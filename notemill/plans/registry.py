"""Registered queries by area. Every entry takes (spark, folder) and reads whole tables."""

from notemill.plans import (queries_evaluation, queries_files, queries_notes, queries_reports,
                            queries_splits, queries_tokens)

AREAS = (queries_notes, queries_reports, queries_splits, queries_tokens, queries_evaluation, queries_files)


def all_queries() -> dict:
    found = {}
    for area in AREAS:
        for name in area.QUERIES:
            if name in found:
                raise ValueError(f"query {name} is registered twice")
        found.update(area.QUERIES)
    return found


def all_sql() -> dict:
    found = {}
    for area in AREAS:
        found.update(area.SQL)
    return found
