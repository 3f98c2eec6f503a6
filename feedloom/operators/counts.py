"""Counts of containers and records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from feedloom.operators.numbering import number_rows


def containers_per_page(cards: DataFrame, page: str = "page_id") -> DataFrame:
    """Number of containers on each page."""
    return cards.groupBy(page).agg(F.count("*").alias("containers"))


def running_count(df: DataFrame, by: tuple[str, ...] = (), seq: str = "seq") -> DataFrame:
    """How many records were accepted up to and including each one."""
    numbered = number_rows(df, [seq], by=by, name="_position")
    return numbered.withColumn("accepted", F.col("_position") + 1).drop("_position")


def with_row_count(df: DataFrame, name: str = "containers") -> tuple[DataFrame, Observation]:
    """Count the rows while they pass; read ``observation.get`` after the write."""
    observation = Observation(name)
    return df.observe(observation, F.count("*").alias("rows")), observation
