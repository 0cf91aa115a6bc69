"""Token column expressions."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from notemill.functions import regex

WORD_OR_SIGN = rf"[\p{{L}}\p{{N}}]+|[^{regex.SPACE}\p{{L}}\p{{N}}]"
PIECE_LENGTH = 3


def words(text: Column, specials=()) -> Column:
    """Words and single signs, in order; null gives an empty list. ``specials`` stay whole."""
    pattern = "|".join([re.escape(token).replace("<", r"<") for token in specials] + [WORD_OR_SIGN])
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))


def pieces(word: Column, length: int = PIECE_LENGTH) -> Column:
    """A word cut into pieces of at most ``length`` characters."""
    return F.regexp_extract_all(word, F.lit(f"(?s).{{1,{length}}}"), F.lit(0))
