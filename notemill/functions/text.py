"""Column expressions on strings. All of them stay inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import regex


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.btrim(text, F.lit(regex.SPACE_CHARACTERS))


def squeeze(text: Column) -> Column:
    """Whitespace runs become one blank, ends are stripped."""
    return F.trim(F.regexp_replace(text, regex.SPACES, " "))


def word_count(text: Column, null_as_word: bool = False) -> Column:
    """Number of whitespace separated words; null counts 0, or 1 when it stands for a word."""
    words = F.size(F.regexp_extract_all(text, F.lit(regex.NON_SPACES), F.lit(0)))
    return F.coalesce(words, F.lit(1 if null_as_word else 0)).cast("long")


def is_blank(text: Column) -> Column:
    """Null or the empty string."""
    return text.isNull() | (text == "")


def only_punctuation(text: Column) -> Column:
    return F.coalesce(text.rlike(regex.java(fv.ONLY_PUNCTUATION)), F.lit(False))


def has_ascii_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(fv.ASCII_LETTER), F.lit(False))


def normalise_lines(text: Column) -> Column:
    """Strip every line and leave blank lines out."""
    lines = F.transform(F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), strip)
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def reference_list(references: Column) -> Column:
    """Split a reference string at ``;`` and drop surrounding blanks, parentheses and empties."""
    parts = F.transform(F.split(references, ";"), lambda part: F.btrim(strip(part), F.lit("()")))
    return F.coalesce(F.filter(parts, lambda part: part != ""), F.array().cast("array<string>"))


def entity_name(display_name: Column) -> Column:
    """Display name up to its bracketed qualifier, stripped."""
    return strip(F.substring_index(display_name, fv.ENTITY_QUALIFIER, 1))


def is_entity_name(name: Column) -> Column:
    keep = (F.length(name) > 2) & ~name.rlike(rf"^{regex.DIGIT}+\z")
    for ending in fv.ENTITY_STOP_ENDINGS:
        keep = keep & ~name.endswith(ending)
    return keep


def preview(text: Column, width: int = 80) -> Column:
    """The first ``width`` characters, with dots when something is left out."""
    return F.concat(F.substring(text, 1, width), F.when(F.length(text) > width, "...").otherwise(""))


def instruction(snippet: Column, template: str = fv.INSTRUCTION_TEMPLATE) -> Column:
    before, after = template.split("{snippet}")
    return F.concat(F.lit(before), snippet, F.lit(after))


def prompt(instruction_text: Column) -> Column:
    return F.concat(F.lit(fv.PROMPT_HEAD), strip(instruction_text), F.lit(fv.PROMPT_TAIL))


def target(output: Column) -> Column:
    return F.concat(output, F.lit("\n" + fv.END_OF_TURN))


def response(generated: Column) -> Column:
    """Text after the first response marker, stripped.

    ``locate`` is 0 without a marker, so the same arithmetic then starts at character 13.
    """
    start = F.locate(fv.RESPONSE_MARKER, generated) + len(fv.RESPONSE_MARKER)
    return strip(F.substring(generated, start, F.length(generated)))


def cut_at_first_listed_stop(text: Column, stops=fv.STOP_TOKENS) -> Column:
    """Cut at the first token of the list that occurs anywhere; later tokens are left alone."""
    result = text
    for stop in reversed(stops):
        result = F.when(text.contains(stop), strip(F.substring_index(text, stop, 1))).otherwise(result)
    return result


def cut_at_each_stop(text: Column, stops=fv.STOP_TOKENS) -> Column:
    """Cut at every token of the list in turn."""
    for stop in stops:
        text = strip(F.substring_index(text, stop, 1))
    return text


def lookup(key: Column, table: dict, default: str) -> Column:
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.lit(default))


def length_category(words: Column, cuts: Column) -> Column:
    """Category of a word count against an array of three cut points."""
    short, medium, long, very_long = fv.LENGTH_CATEGORIES
    return (F.when(words <= cuts[0], short).when(words <= cuts[1], medium)
            .when(words <= cuts[2], long).otherwise(very_long))
