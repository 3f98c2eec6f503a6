"""Which records a search takes, and which are complete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.age import MINUTES_PER_HOUR, age_minutes
from feedloom.functions.tags import contains_all_terms


def matching(df: DataFrame, query: str, text: str = "description") -> DataFrame:
    """Records whose text has every term of the query."""
    return df.where(contains_all_terms(text, query))


def of_kind(df: DataFrame, kind: str) -> DataFrame:
    """Records of one content type, ``post`` or ``job``."""
    return df.where(F.col("kind") == kind)


def posted_within(
    df: DataFrame, as_of: Column, hours: int = 24, posted_at: str = "posted_at"
) -> DataFrame:
    """Records posted in the last ``hours`` before ``as_of``."""
    return df.where(F.col(posted_at) >= as_of - F.make_dt_interval(hours=F.lit(hours)))


def labelled_within(
    df: DataFrame, hours: int = 24, label: str = "time_posted", strict_units: bool = True
) -> DataFrame:
    """The same for records that only have an age label; an unknown age is not recent."""
    return df.where(age_minutes(label, strict_units) <= hours * MINUTES_PER_HOUR)


def check_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Set ``error`` to the names of missing required fields, NULL for a complete record.

    The message holds column names only, never values. An ``error`` that is there stays.
    """
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    found = F.when(missing != "", F.concat(F.lit("missing: "), missing))
    earlier = F.col("error") if "error" in df.columns else F.lit(None)
    return df.withColumn("error", F.coalesce(earlier, found))


def accepted(checked: DataFrame) -> DataFrame:
    """The complete records of :func:`check_required`."""
    return checked.where(F.col("error").isNull()).drop("error")


def rejected(checked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The quarantine table: where the rejected records were, and why."""
    return checked.where(F.col("error").isNotNull()).select(*keys, "error")


def non_empty(df: DataFrame, column: str = "content") -> DataFrame:
    """Records whose column has text."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))
