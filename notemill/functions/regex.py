"""One pattern, three engines: Python ``re`` notation to Java (Spark) and RE2 (the SQL oracle).

Python's ``\\s``, ``\\d`` and ``\\w`` are Unicode classes while Java's and RE2's are ASCII, so the
classes are spelled out. Both spellings below are accepted by Java and RE2 alike.
"""

SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"     # inside brackets: what str.isspace() accepts
WORD = r"\p{L}\p{N}_"                  # inside brackets: what \w accepts
DIGIT = r"\p{Nd}"

SPACE_CHARACTERS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
SPACES = f"[{SPACE}]+"
NON_SPACES = f"[^{SPACE}]+"


def _spell_out(pattern: str) -> str:
    return (pattern.replace(r"\s", f"[{SPACE}]").replace(r"\d", DIGIT).replace(r"\W", f"[^{WORD}]"))


def java(pattern: str) -> str:
    """Pattern for Spark's regexp functions.

    A leading or trailing ``\\b`` stands beside a word character, so it is a look-around for the
    absence of another one; before a capital it is tested after the capital was found, which is
    rarer. Repeated groups become possessive: nothing that follows a repeated group
    in our patterns can start inside it, and a plain one would recurse once per repetition.
    """
    body = pattern
    head = tail = ""
    if body.startswith(r"\b[A-Z]"):
        head, body = f"[A-Z](?<![{WORD}][A-Z])", body[len(r"\b[A-Z]"):]
    elif body.startswith(r"\b"):
        head, body = f"(?<![{WORD}])", body[2:]
    if body.endswith(r"\b"):
        tail, body = f"(?![{WORD}])", body[:-2]
    if body.endswith("$") and not body.endswith(r"\$"):
        tail, body = r"\z", body[:-1]
    return head + _spell_out(body).replace(")*", ")*+") + tail


def java_replacement(replacement: str) -> str:
    return replacement.replace("\\1", "$1").replace("\\2", "$2")


def re2(pattern: str) -> str:
    """Pattern for DuckDB, which has no look-around; ``\\b`` stays (ASCII there)."""
    return _spell_out(pattern)
