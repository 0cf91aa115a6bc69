"""Building blocks of the check SQL: chains of common table expressions for DuckDB."""

from notemill import fixed_values as fv
from notemill.functions import regex, sentences as sf, tokens as tk
from notemill.plans.standins import DECORATIONS


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{regex.SPACES}|{regex.SPACES}$', '', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{regex.SPACES}', ' ', 'g'))"


def word_count(x: str) -> str:
    return f"coalesce(len(regexp_extract_all({x}, '{regex.NON_SPACES}', 0)), 0)"


def decorated() -> str:
    whens = " ".join(f"WHEN {i} THEN {quoted(d)}" for i, d in enumerate(DECORATIONS))
    return f"""decorated AS (
  SELECT doc_id, source, lang, text,
         CASE WHEN instr(text, '.') > 0 THEN substr(text, 1, instr(text, '.') - 1) || ending || substr(text, instr(text, '.'))
              ELSE text || ending END AS original_notes
  FROM (SELECT *, CASE doc_id % 6 {whens} END AS ending FROM documents))"""


def _chain(prefix: str, start: str, steps) -> str:
    ctes, last = [f"{prefix}0 AS MATERIALIZED ({start})"], f"{prefix}0"
    for i, (text, found) in enumerate(steps, 1):
        extra = f", list_concat(f, {found}) AS f" if found else ""
        drop = "t, f" if found else "t"
        ctes.append(f"{prefix}{i} AS MATERIALIZED (SELECT * EXCLUDE ({drop}), {text} AS t{extra} FROM {last})")
        last = f"{prefix}{i}"
    return ",\n".join(ctes), last


def _without(pattern: str, to: str = "") -> str:
    return f"regexp_replace(t, {quoted(pattern)}, {quoted(to)}, 'g')"


# the look-ahead scans the same stretch as the rest of the pattern, so it can be the pattern's own middle
LINK = regex.re2(fv.LINK_PARENTHESIS.replace("(?=", "").replace("}))", "})"))


def link_steps():
    return [(_without(LINK), f"regexp_extract_all(t, {quoted(LINK)}, 1)"),
            (_without(regex.re2(fv.EMPTY_PARENTHESES)), None),
            (_without(regex.re2(fv.SPACE_BEFORE_PUNCTUATION), r"\1"), None),
            (_without(regex.re2(fv.BLANK_RUN), " "), None), (strip("t"), None)]


def citation_steps():
    steps = []
    for action, pattern, argument in fv.CITATION_STEPS:
        if action == "take":
            p = regex.re2(pattern)
            steps.append((_without(p), f"regexp_extract_all(t, {quoted(p)}, {argument})"))
        elif action == "put":
            steps.append((_without(regex.re2(pattern), argument), None))
        else:
            steps.append((squeeze("t"), None))
    return steps + [(strip("t"), None)]


def cleaned() -> str:
    """decorated plus notes and only_references, as ``cleaned``."""
    chain, last = _chain("c", "SELECT *, nullif(original_notes, '') AS t, []::VARCHAR[] AS f FROM decorated",
                         link_steps() + citation_steps())
    return f"""{decorated()},
{chain},
cleaned AS (SELECT * EXCLUDE (t, f), t AS notes, CASE WHEN len(f) > 0 THEN array_to_string(f, '; ') END AS only_references FROM {last})"""


def only_links() -> str:
    chain, last = _chain("l", "SELECT *, original_notes AS t, []::VARCHAR[] AS f FROM decorated", link_steps())
    return f"{decorated()},\n{chain},\nunlinked AS (SELECT * FROM {last})"


def only_citations() -> str:
    chain, last = _chain("k", "SELECT *, original_notes AS t, []::VARCHAR[] AS f FROM decorated", citation_steps())
    return f"{decorated()},\n{chain},\nuncited AS (SELECT * FROM {last})"


def reactions() -> str:
    return f"""{cleaned()},
reactions AS MATERIALIZED (SELECT source AS file_id, doc_id AS row_order, 'R-' || doc_id AS reaction_id, original_notes, notes,
  only_references, text AS snippet FROM cleaned)"""


def reference_list(x: str) -> str:
    return (f"coalesce(list_filter(list_transform(string_split({x}, ';'), lambda p: trim({strip('p')}, '()')), "
            "lambda p: p <> ''), [])")


def sentences(x: str) -> str:
    held = rf"regexp_replace({x}, {quoted(sf.abbreviation_pattern())}, '\1\2.' || chr(64977), 'g')"
    marked = rf"regexp_replace({held}, {quoted(sf.boundary_pattern())}, '\1' || chr(64976) || '\2', 'g')"
    parts = f"list_transform(string_split({marked}, chr(64976)), lambda s: {strip('replace(s, chr(64977), chr(32))')})"
    return f"coalesce(list_filter({parts}, lambda s: s <> ''), [])"


def is_sentence(x: str) -> str:
    return (f"(length({x}) > 2 AND NOT regexp_matches({x}, '^[^{regex.WORD}]+$') AND regexp_matches({x}, '[a-zA-Z]') "
            f"AND ({word_count(x)} >= 2 OR length({x}) >= 10))")


def words(x: str) -> str:
    return f"coalesce(regexp_extract_all({x}, {quoted(tk.WORD_OR_SIGN)}, 0), [])"


def describe(source: str, column: str, *groups: str, population: bool = False) -> str:
    g = "".join(f"{c}, " for c in groups)
    std = "stddev_pop" if population else "stddev_samp"
    tail = f" GROUP BY {', '.join(groups)}" if groups else ""
    return f"""SELECT {g}count({column}) AS count, round(avg({column}), 6) AS mean, round(median({column}), 6) AS median,
  round({std}({column}), 6) AS std, min({column}) AS minimum, max({column}) AS maximum,
  round(quantile_cont({column}, 0.05), 6) AS p5, round(quantile_cont({column}, 0.25), 6) AS p25,
  round(quantile_cont({column}, 0.75), 6) AS p75, round(quantile_cont({column}, 0.95), 6) AS p95,
  round(quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25), 6) AS iqr
FROM {source}{tail}"""
