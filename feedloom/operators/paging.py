"""Pages and rounds: ranges, the first gap, stagnation, and what is new.

Joins meet a table of one row per feed. Spark broadcasts it where it has seen that it is small;
else a feed with a large share of the rows is split by the skew handling of adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.numbering import number_rows

#: Rounds of a feed that are compared in one window.
CHUNK_WIDTH = 65_536


def page_range(df: DataFrame, last: int, first: int = 1, page_no: str = "page_no") -> DataFrame:
    """Pages ``first`` to ``last``, both included."""
    return df.where(F.col(page_no).between(first, last))


def contiguous_pages(
    pages: DataFrame, feed: str = "feed", page_no: str = "page_no", first: int = 1
) -> DataFrame:
    """For each feed that has page ``first``, the last page before one is missing.

    Every page marks itself as present and its predecessor as followed. The marks are
    aggregated per page before the shuffle and then per feed, so no feed is gathered anywhere.
    """
    here = F.struct(
        F.col(page_no).alias("page"), F.lit(True).alias("present"), F.lit(False).alias("followed")
    )
    previous = F.struct(
        (F.col(page_no) - 1).alias("page"),
        F.lit(False).alias("present"),
        F.lit(True).alias("followed"),
    )
    marks = (
        pages.where(F.col(page_no) >= first)
        .select(feed, F.inline(F.array(here, previous)))
        .groupBy(feed, "page")
        .agg(F.max("present").alias("present"), F.max("followed").alias("followed"))
        .where("present")
    )
    return (
        marks.groupBy(feed)
        .agg(
            F.min("page").alias("first_page"),
            F.min(F.when(~F.col("followed"), F.col("page"))).alias("last_page"),
        )
        .where(F.col("first_page") == first)
        .select(feed, "last_page")
    )


def page_prefix(
    df: DataFrame, feed: str = "feed", page_no: str = "page_no", first: int = 1
) -> DataFrame:
    """The records of a feed up to its first missing page."""
    last = contiguous_pages(df.select(feed, page_no), feed, page_no, first)
    kept = df.where(F.col(page_no) >= first).join(last, feed)
    return kept.where(F.col(page_no) <= F.col("last_page")).select(*[df[c] for c in df.columns])


def stop_rounds(
    rounds: DataFrame,
    after: int,
    feed: str = "feed",
    round_no: str = "round",
    height: str = "height",
    width: int = CHUNK_WIDTH,
) -> DataFrame:
    """For each feed, the round at which its height has stayed the same ``after`` times in a row.

    Rounds are numbered per feed and compared in chunks. The last ``after`` rounds of a chunk
    are also given to the next one as its past, so that no window holds more than a chunk.
    """
    placed = number_rows(rounds.select(feed, round_no, height), [round_no], by=[feed])
    own = F.expr(f"position div {width}")
    near_end = F.col("position") % width >= width - after
    spread = placed.withColumn("_own", own).withColumn(
        "_chunk",
        F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))),
    )
    past = Window.partitionBy(feed, "_chunk").orderBy("position")
    unchanged = F.lit(True)
    for back in range(1, after + 1):
        unchanged = unchanged & (F.lag(height, back).over(past) == F.col(height))
    return (
        spread.withColumn("_unchanged", unchanged)
        .where("_unchanged and _chunk = _own")
        .groupBy(feed)
        .agg(F.min(round_no).alias("stop_round"))
    )


def until_stopped(
    df: DataFrame, stops: DataFrame, feed: str = "feed", round_no: str = "round"
) -> DataFrame:
    """The records up to the stop round of their feed; all of a feed that never stops."""
    kept = df.join(stops, feed, "left")
    in_time = F.col("stop_round").isNull() | (F.col(round_no) <= F.col("stop_round"))
    return kept.where(in_time).select(*[df[c] for c in df.columns])


def new_since(
    df: DataFrame, progress: DataFrame, feed: str = "feed", seq: str = "seq"
) -> DataFrame:
    """The records beyond those taken before; ``progress`` has the feed's ``next_seq``."""
    kept = df.join(progress.select(feed, "next_seq"), feed, "left")
    unread = F.col("next_seq").isNull() | (F.col(seq) >= F.col("next_seq"))
    return kept.where(unread).select(*[df[c] for c in df.columns])
