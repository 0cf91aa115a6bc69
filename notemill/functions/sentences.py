"""Sentence splitting and filtering as column expressions.

The rule: a sentence ends at ``.``, ``!`` or ``?`` followed by whitespace and an upper-case letter or
an opening parenthesis, unless the word before is a listed abbreviation. It is a plain rule, not a
language model; every character but the whitespace between sentences is kept.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import regex, text as tx

ABBREVIATIONS = ("Dr", "Prof", "Mr", "Mrs", "Fig", "Eq", "al", "cf", "vs", "approx", "e.g", "i.e")
SENTENCE_END = "\ufdd0"      # non-characters: no text holds them, and no class counts them as space
HELD_SPACE = "\ufdd1"


def abbreviation_pattern() -> str:
    names = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
    return rf"(^|[^{regex.WORD}])({names})\.{regex.SPACES}"


def boundary_pattern() -> str:
    return rf"([.!?]){regex.SPACES}([\p{{Lu}}(])"


def split_sentences(text: Column) -> Column:
    """Sentences in order, stripped, without empty ones; null gives an empty list."""
    held = F.regexp_replace(text, abbreviation_pattern(), f"$1$2.{HELD_SPACE}")
    marked = F.regexp_replace(held, boundary_pattern(), f"$1{SENTENCE_END}$2")
    cleaned = F.transform(F.split(marked, SENTENCE_END),
                          lambda s: tx.strip(F.translate(s, HELD_SPACE, " ")))
    return F.coalesce(F.filter(cleaned, lambda s: s != ""), F.array().cast("array<string>"))


def is_sentence(text: Column) -> Column:
    """Whether a stripped string is worth keeping as a sentence."""
    two_words = text.rlike(rf"[^{regex.SPACE}]{regex.SPACES}[^{regex.SPACE}]")
    return ((F.length(text) > 2) & ~tx.only_punctuation(text) & tx.has_ascii_letter(text)
            & (two_words | (F.length(text) >= 10)))


def kept_sentences(text: Column) -> Column:
    return F.filter(split_sentences(text), is_sentence)
