"""Relative age labels such as ``5m`` or ``3h • Edited •``."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import SPACE, as_column

# Label grammar and unit factors.
COUNT_AND_UNIT = r"(\p{Nd}+)([mh])"
NOT_IN_A_WORD = r"(?![a-zA-Z])"
MINUTES_PER_HOUR = 60
MINUTES_PER_DAY = 1440
EDITED_SUFFIX = " • Edited • "
PLAIN_SUFFIX = " • "

UNKNOWN_AGE = float("inf")

#: All decimal digits beyond ASCII, and the ASCII ones they stand for.
OTHER_DIGITS = "".join(
    chr(i) for i in range(128, 0x110000) if unicodedata.decimal(chr(i), None) is not None
)
AS_ASCII = "".join(str(unicodedata.decimal(c)) for c in OTHER_DIGITS)


def age_minutes(label: Column | str, strict_units: bool = False) -> Column:
    """Minutes named by an age label; infinity where the label gives none.

    What follows the first bullet does not count. A bullet is neither space, digit nor unit, so
    a pattern anchored at the start reads the same with or without the rest of the label.
    The label is read by its prefix, so ``2mo`` counts as two minutes unless ``strict_units``.
    """
    pattern = f"^{SPACE}*{COUNT_AND_UNIT}" + (NOT_IN_A_WORD if strict_units else "")
    label = as_column(label)
    digits = F.regexp_extract(label, pattern, 1)
    plain = F.when(digits.rlike("[^0-9]"), F.translate(digits, OTHER_DIGITS, AS_ASCII)).otherwise(digits)
    count = plain.try_cast("double")
    hours = F.regexp_extract(label, pattern, 2) == "h"
    per_unit = F.when(hours, F.lit(float(MINUTES_PER_HOUR))).otherwise(F.lit(1.0))
    return F.coalesce(count * per_unit, F.lit(UNKNOWN_AGE))


def age_label(posted_at: Column | str, as_of: Column, edited: Column | None = None) -> Column:
    """Render the label a feed shows at ``as_of``; the reverse of :func:`age_minutes`."""
    minutes = F.timestamp_diff("MINUTE", as_column(posted_at), as_of)
    amount = (
        F.when(minutes < MINUTES_PER_HOUR, F.concat(minutes, F.lit("m")))
        .when(minutes < MINUTES_PER_DAY, F.concat(F.floor(minutes / MINUTES_PER_HOUR), F.lit("h")))
        .otherwise(F.concat(F.floor(minutes / MINUTES_PER_DAY), F.lit("d")))
    )
    if edited is None:
        return F.concat(amount, F.lit(PLAIN_SUFFIX))
    return F.concat(amount, F.when(edited, F.lit(EDITED_SUFFIX)).otherwise(F.lit(PLAIN_SUFFIX)))
