"""Hashtags in plain text, and keyword search over it."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import NOT_SPACE, ODD_SPACE, as_column, squeeze

# A word that starts with '#' and holds something else too; punctuation stays in the tag. The
# look-behind comes after the first character, so that it is tried at a '#' only.
TAG_WORD = rf"#(?<!{NOT_SPACE}#)#*[^# {ODD_SPACE}]{NOT_SPACE}*"


def hashtags(text: Column | str) -> Column:
    """Distinct hashtag words of a text, in order of first occurrence."""
    return F.array_distinct(F.regexp_extract_all(as_column(text), F.lit(TAG_WORD), F.lit(0)))


def format_description(text: Column | str) -> Column:
    """The text on single spaces, followed by its distinct hashtags with one more ``#`` each.

    NULL for a missing text.
    """
    marked = F.transform(hashtags(text), lambda tag: F.concat(F.lit("#"), tag))
    return F.btrim(F.concat(squeeze(text), F.lit(" "), F.array_join(marked, " ")))


def contains_all_terms(text: Column | str, query: str) -> Column:
    """Whether every term of ``query`` is in the text, whatever the letter case.

    A plain term matches anywhere in the text, a ``#term`` only as a whole word.
    """
    lowered = F.lower(as_column(text))

    def has(term: str) -> Column:
        if not term.startswith("#"):
            return F.contains(lowered, F.lit(term))
        word = re.escape(term)
        whole_word = rf"{word}(?<!{NOT_SPACE}{word})(?!{NOT_SPACE})"
        return F.contains(lowered, F.lit(term)) & lowered.rlike(whole_word)

    return reduce(lambda a, b: a & b, map(has, query.lower().split()), F.lit(True))
