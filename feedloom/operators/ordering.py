"""Sort orders. ``seq`` breaks ties, so every order is total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.age import age_minutes


def with_age(df: DataFrame, strict_units: bool = False) -> DataFrame:
    """Add ``age_minutes`` from the age label."""
    return df.withColumn("age_minutes", age_minutes("time_posted", strict_units))


def by_age(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Youngest first, unknown ages last.

    The range partitioning uses both columns, so the many records of unknown age still spread.
    """
    return df.orderBy("age_minutes", seq)


def in_feed_order(df: DataFrame, seq: str = "seq") -> DataFrame:
    """As the feed showed them."""
    return df.orderBy(seq)


def feed_position(*place: str):
    """Feed order of a container, as one column that compares by these columns in turn.

    By default the page and the index there. Name the round, and the feed, before them where a
    page is captured more than once: ``feed_position("round", "page_id", "container_idx")``.
    """
    return F.struct(*(place or ("page_id", "container_idx")))


def check_order(df: DataFrame, seq: str = "seq") -> DataFrame:
    """The records, failing while they are read if two have the same place in the feed."""
    again = df.groupBy(seq).count().where("count > 1").select(
        F.raise_error(F.concat(F.lit("several records at "), F.to_json(F.struct(seq)))).cast("boolean").alias("_same")
    )
    return df.join(F.broadcast(again.limit(1)), F.lit(True), "left").where("_same IS NULL").drop("_same")
