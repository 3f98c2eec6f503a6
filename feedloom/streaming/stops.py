"""Sinks that know when a growing feed has given enough: after so many records, or when it stands still.

What they have to remember is written beside each round, in a folder that the round replaces when it
runs again. A round reads what the round before it has left, so nothing older is read again and a
run that was cut off goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from feedloom.operators.limits import cap
from feedloom.streaming.feed import read_rounds, round_folder


class _Ledger:
    """A small table per round, of which each round needs that of the one before."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def write(self, rows: DataFrame, round_no: int) -> None:
        rows.write.mode("overwrite").parquet(round_folder(self.path, round_no))

    def before(self, spark: SparkSession, round_no: int) -> DataFrame:
        """What the round before has left; no rows before the first one."""
        if round_no == 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(round_folder(self.path, round_no - 1))


class RowCap:
    """Take the first ``n`` records of a feed over all its rounds, in feed order, and stop there.

    Rounds follow one another; within a round ``seq`` is the order. Each round takes what the rounds before it have
    left of ``n``. :meth:`done` tells :func:`feedloom.streaming.feed.write_rounds` to stop.
    """

    def __init__(self, path: str, n: int, seq: str = "seq"):
        self.path, self.n, self.seq = f"{path}/records", n, seq
        self._taken = _Ledger(f"{path}/taken", StructType([StructField("taken", LongType())]))

    def taken(self, spark: SparkSession, round_no: int) -> int:
        """How many records the rounds before this one took."""
        row = self._taken.before(spark, round_no).first()
        return row.taken if row else 0

    def done(self, spark: SparkSession, round_no: int) -> bool:
        return self.taken(spark, round_no) >= self.n

    def __call__(self, records: DataFrame, round_no: int) -> None:
        spark = records.sparkSession
        taken = self.taken(spark, round_no)
        folder = round_folder(self.path, round_no)
        cap(records, self.n - taken, self.seq).write.mode("overwrite").parquet(folder)
        taken += spark.read.schema(records.schema).parquet(folder).count()
        self._taken.write(spark.range(1).select(F.lit(taken).cast("long").alias("taken")), round_no)

    def records(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """What was taken, with its round."""
        return read_rounds(spark, self.path, schema)


class StandStill:
    """Hand records on until their feed has shown the same height ``after`` rounds in a row.

    A feed's height in a round is the largest of its records' ``height``. A round in which the height is that of
    the feed's last round before counts as still; any other height starts the count anew. The
    records of the round in which the count is reached are the feed's last. Rounds in which a feed has no
    records say nothing about it. :meth:`done` holds once every feed that was seen has come to its end.

    Kept is one row per feed: its last height, how long it has been still, and its last round.
    """

    def __init__(
        self,
        path: str,
        write: Callable[[DataFrame, int], None],
        after: int = 1,
        feed: str = "feed",
        height: str = "height",
    ):
        self.path, self.write, self.after, self.feed, self.height = path, write, after, feed, height

    def _states(self, schema: StructType) -> _Ledger:
        """Feed and height have the types that the records give them."""
        kept = StructType(
            [
                StructField("feed", schema[self.feed].dataType),
                StructField("height", schema[self.height].dataType),
                StructField("still", LongType()),
                StructField("stop_round", LongType()),
            ]
        )
        return _Ledger(f"{self.path}/feeds", kept)

    def done(self, spark: SparkSession, round_no: int) -> bool:
        if round_no == 0:
            return False
        feeds = spark.read.parquet(round_folder(f"{self.path}/feeds", round_no - 1))
        seen, ended = feeds.agg(F.count("*"), F.count("stop_round")).first()
        return seen > 0 and seen == ended

    def __call__(self, records: DataFrame, round_no: int) -> None:
        states = self._states(records.schema)
        before = states.before(records.sparkSession, round_no)
        seen = records.where(F.col(self.feed).isNotNull())
        now = seen.groupBy(F.col(self.feed).alias("feed")).agg(F.max(self.height).alias("now"))
        both = before.join(now, "feed", "full")
        same = F.col("now").eqNullSafe(F.col("height")) & F.col("still").isNotNull()
        still = F.when(same, F.col("still") + 1).otherwise(0)
        shown = F.col("now").isNotNull() & F.col("stop_round").isNull()
        after = both.select(
            "feed",
            F.when(shown, F.col("now")).otherwise(F.col("height")).alias("height"),
            F.when(shown, still).otherwise(F.col("still")).cast("long").alias("still"),
            F.when(shown & (still >= self.after), F.lit(round_no)).otherwise(F.col("stop_round")).cast("long").alias("stop_round"),
        )
        ended = before.where("stop_round IS NOT NULL").select(F.col("feed").alias(self.feed))
        self.write(records.join(ended, self.feed, "left_anti").select(*records.columns), round_no)
        states.write(after, round_no)

    def stop_rounds(self, spark: SparkSession, rounds: int, schema: StructType) -> DataFrame:
        """``feed`` and ``stop_round`` of the feeds that came to their end in the first ``rounds`` rounds."""
        return self._states(schema).before(spark, rounds).where("stop_round IS NOT NULL").select("feed", "stop_round")


class PagePrefix:
    """Release the pages of a feed in order while they arrive in any.

    A page is handed on once all pages from ``first`` up to it are there; others are held back, in a table that each
    round replaces. A page that waits for ``patience`` rounds is given up and goes to :meth:`given_up`, so
    what is held stays bounded; pages that come again after their release are left out.
    """

    def __init__(
        self,
        path: str,
        write: Callable[[DataFrame, int], None],
        first: int = 1,
        patience: int | None = None,
        feed: str = "feed",
        page_no: str = "page_no",
    ):
        self.path, self.write, self.first, self.patience = path, write, first, patience
        self.feed, self.page_no = feed, page_no

    def __call__(self, records: DataFrame, round_no: int) -> None:
        spark = records.sparkSession
        since = StructField("_since", LongType())
        held = _Ledger(f"{self.path}/held", StructType([*records.schema.fields, since]))
        key = StructType([StructField("_feed", records.schema[self.feed].dataType), StructField("_next", LongType())])
        progress = _Ledger(f"{self.path}/progress", key)
        due = progress.before(spark, round_no)
        next_page = F.coalesce(F.col("_next"), F.lit(self.first).cast("long"))
        of_feed = F.col(self.feed) == F.col("_feed")
        waiting = (
            records.withColumn("_since", F.lit(round_no).cast("long"))
            .unionByName(held.before(spark, round_no))
            .join(due, of_feed, "left")
            .withColumn("_next", next_page)
            .where(F.col(self.page_no) >= F.col("_next"))
            .drop("_feed")
        )
        waiting.write.mode("overwrite").parquet(f"{self.path}/waiting")
        waiting = spark.read.schema(waiting.schema).parquet(f"{self.path}/waiting")
        reached = self._reached(waiting).withColumnRenamed("_feed", "_of")
        placed = waiting.join(reached, F.col(self.feed) == F.col("_of"), "left")
        ready = F.coalesce(F.col(self.page_no) <= F.col("_last"), F.lit(False))
        self.write(placed.where(ready).select(*records.columns), round_no)
        late = F.lit(False) if self.patience is None else F.col("_since") <= round_no - self.patience
        rest = placed.where(~ready).select(*records.columns, "_since")
        held.write(rest.where(~late), round_no)
        rest.where(late).drop("_since").write.mode("overwrite").parquet(round_folder(f"{self.path}/given-up", round_no))
        new = reached.select(F.col("_of").alias("_feed"), (F.col("_last") + 1).cast("long").alias("_next"))
        progress.write(due.unionByName(new).groupBy("_feed").agg(F.max("_next").alias("_next")), round_no)

    def _reached(self, waiting: DataFrame) -> DataFrame:
        """For each feed whose next page is there, the last page before one is missing.

        Every page marks itself as there and its predecessor as followed; marks are reduced before each shuffle.
        """
        page = F.col(self.page_no).cast("long")
        here = F.struct(page.alias("page"), F.lit(True).alias("there"), F.lit(False).alias("followed"))
        previous = F.struct((page - 1).alias("page"), F.lit(False).alias("there"), F.lit(True).alias("followed"))
        marks = (
            waiting.select(F.col(self.feed).alias("_feed"), "_next", F.inline(F.array(here, previous)))
            .groupBy("_feed", "page")
            .agg(F.max("there").alias("there"), F.max("followed").alias("followed"), F.max("_next").alias("_next"))
            .where("there")
        )
        return (
            marks.groupBy("_feed")
            .agg(
                F.min("page").alias("_first"),
                F.max("_next").alias("_next"),
                F.min(F.when(~F.col("followed"), F.col("page"))).alias("_last"),
            )
            .where("_first = _next")
            .select("_feed", "_last")
        )

    def given_up(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """Pages that waited in vain, with the round in which they were given up."""
        return read_rounds(spark, f"{self.path}/given-up", schema)

    def held(self, spark: SparkSession, rounds: int, schema: StructType) -> DataFrame:
        """Pages that still wait after so many rounds."""
        since = StructField("_since", LongType())
        return _Ledger(f"{self.path}/held", StructType([*schema.fields, since])).before(spark, rounds).drop("_since")
