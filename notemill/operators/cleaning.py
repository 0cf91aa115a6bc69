"""Move links and citations out of a text column.

Every step reads the text of the step before it, once or twice. Steps are therefore successive
projections and not one nested expression: nesting would evaluate the first regex 2^n times. The
results leave through ``evaluate_once``, so that a filter on them does not nest the steps either.
"""

from functools import reduce
from itertools import groupby
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import regex, text as tx
from notemill.operators.once import evaluate_once

_TEXT, _FOUND, _HITS, _YEAR = "_text", "_found", "_hits", "_year"


def _none() -> Column:
    return F.array().cast("array<string>")


def _replace(text: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(text, regex.java(pattern), regex.java_replacement(replacement))


def _guard(pattern: str) -> Column | None:
    """A cheap test that must hold for the pattern to match at all: its year, literals and signs."""
    text = F.col(_TEXT)
    tests = [F.col(_YEAR)] if r"\d{4}" in pattern else []
    tests += [text.contains(sign) for sign, spelled in (("(", r"\("), (":", r"\s*:\s*"), ("..", r"\.\.+"))
              if pattern.startswith(spelled)]
    tests += [text.contains(word) for word in ("et al", "reviewed") if word in pattern]
    for words in (("No", "Yes"), ("RNA", "Protein", "No", "Yes")):
        if pattern.startswith(f"({words[0]}|{words[1]}"):
            tests.append(reduce(or_, [text.contains(word) for word in words]))
    return reduce(and_, tests) if tests else None


def _put(df: DataFrame, steps) -> DataFrame:
    """Replacements one after the other.

    Those without a guard read their input once and are nested; a guarded one reads it twice, so it
    starts a projection of its own.
    """
    text, open_steps = F.col(_TEXT), False
    for action, pattern, argument in steps:
        guard = _guard(pattern) if action == "put" else None
        if guard is not None:
            if open_steps:
                df = df.withColumn(_TEXT, text)
            text = F.when(guard, _replace(F.col(_TEXT), pattern, argument)).otherwise(F.col(_TEXT))
        else:
            text = _replace(text, pattern, argument) if action == "put" else tx.squeeze(text)
        open_steps = True
    return df.withColumn(_TEXT, text)


def _take(df: DataFrame, pattern: str, group: int) -> DataFrame:
    """Append the matches to the found list and delete them; text without a match is not rewritten."""
    hits = F.regexp_extract_all(_TEXT, F.lit(regex.java(pattern)), F.lit(group))
    df = df.withColumn(_HITS, F.when(_guard(pattern), hits).otherwise(_none()))
    return df.withColumns({
        _TEXT: F.when(F.size(_HITS) > 0, _replace(F.col(_TEXT), pattern, "")).otherwise(F.col(_TEXT)),
        _FOUND: F.concat(_FOUND, _HITS),
    })


def _finish(df: DataFrame, clean: str, found: str) -> DataFrame:
    df = evaluate_once(df, {clean: tx.strip(F.col(_TEXT)), found: F.col(_FOUND)})
    return df.drop(_TEXT, _FOUND, _HITS, _YEAR)


def remove_links(df: DataFrame, column: str, clean: str, removed: str, capture: str = "hit") -> DataFrame:
    """Drop parentheses that hold a URL, DOI or database name.

    ``removed`` lists the last link-like hit of each parenthesis; ``capture="full"`` lists the whole
    parenthesis.
    """
    df = df.withColumns({_TEXT: F.col(column), _FOUND: _none()})
    df = _take(df, fv.LINK_PARENTHESIS, 0 if capture == "full" else 1)
    repairs = (("put", fv.EMPTY_PARENTHESES, ""), ("put", fv.SPACE_BEFORE_PUNCTUATION, r"\1"),
               ("put", fv.BLANK_RUN, " "))
    return _finish(_put(df, repairs), clean, removed)


def remove_citations(df: DataFrame, column: str, clean: str, citations: str) -> DataFrame:
    """Move citations to an array column and repair the spacing they leave behind.

    Every citation holds a four digit number, so rows without one skip the extracting steps.
    """
    df = df.withColumns({_TEXT: F.col(column), _FOUND: _none()})
    df = df.withColumn(_YEAR, F.col(_TEXT).rlike(regex.DIGIT + "{4}"))
    for is_take, group in groupby(fv.CITATION_STEPS, key=lambda step: step[0] == "take"):
        steps = list(group)
        if is_take:
            for _, pattern, argument in steps:
                df = _take(df, pattern, argument)
        else:
            df = _put(df, steps)
    return _finish(df, clean, citations)


def clean_notes(df: DataFrame, column: str = "original_notes", notes: str = "notes",
                references: str = "only_references") -> DataFrame:
    """Links, then citations; ``references`` joins both lists and is null when there are none.

    A null or empty note gives null in both columns.
    """
    df = df.withColumn("_note", F.nullif(F.col(column), F.lit("")))
    df = remove_links(df, "_note", "_unlinked", "_links")
    df = remove_citations(df, "_unlinked", notes, "_citations")
    both = F.concat("_links", "_citations")
    return (df.withColumn(references, F.when(F.size(both) > 0, F.array_join(both, fv.REFERENCE_SEPARATOR)))
            .drop("_note", "_unlinked", "_links", "_citations"))
