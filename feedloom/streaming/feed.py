"""A feed that grows while it is read: rounds are micro-batches of a file source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from feedloom.operators.dedup import first_unseen
from feedloom.operators.filters import accepted, check_required, rejected
from feedloom.session import SMALL_GROUPS, WRITERS, setting

ROUND = "round"
REJECTED = "rejected"
#: Bytes of a batch that goes to Python in a round. Every task holds a few of them beside its heap.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BYTES = 8 << 20


def read_feed(
    spark: SparkSession, path: str, schema: StructType, files_per_round: int | None = None
) -> DataFrame:
    """Follow a folder of captured records; each file is read once."""
    reader = spark.readStream.schema(schema)
    if files_per_round:
        reader = reader.option("maxFilesPerTrigger", files_per_round)
    return reader.parquet(path)


def drop_seen(
    feed: DataFrame, key: str, seq: str = "seq", salts: int = 16, event_time: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """One record per key across all rounds, kept in the state store.

    A key is first reduced in ``salts`` separate tasks, so a key with a large share of the
    records does not meet in one. Which record of a round stays is open; use
    :class:`FirstSeen` where it must be the first. With ``event_time`` and ``delay`` the state
    is dropped once the watermark has passed.
    """
    salted = feed.withColumn("_salt", F.pmod(F.xxhash64(seq), F.lit(salts)))
    if event_time is None:
        return salted.dropDuplicates([key, "_salt"]).dropDuplicates([key]).drop("_salt")
    late = salted.withWatermark(event_time, delay)
    once = late.dropDuplicatesWithinWatermark([key, "_salt"])
    return once.dropDuplicatesWithinWatermark([key]).drop("_salt")


def append_available(feed: DataFrame, path: str, checkpoint: str) -> None:
    """Append what has arrived and end when nothing new is left."""
    query = (
        feed.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


class RoundLimit(Exception):
    """Raised in the round after the last one, before it writes."""


def write_rounds(
    feed: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    rounds: int | None = None,
    stop: Callable[[SparkSession, int], bool] | None = None,
) -> None:
    """Hand every available round to ``write(records, round)``, at most ``rounds`` of them.

    ``stop(session, round)`` is asked before each round whether what earlier rounds have committed
    ends the feed; the sinks of :mod:`feedloom.streaming.stops` have one. The round after the last one is
    refused before it is committed, so that a later run with the same checkpoint starts with it.
    """
    done, stopped = 0, False

    def step(records: DataFrame, round_no: int) -> None:
        nonlocal done, stopped
        over = rounds is not None and done >= rounds
        if over or (stop is not None and stop(records.sparkSession, round_no)):
            stopped = True
            raise RoundLimit
        write(records, round_no)
        done += 1

    # A stream runs with the settings that it was started with.
    with setting(feed.sparkSession, BATCH_BYTES, MOST_BYTES):
        query = (
            feed.writeStream.foreachBatch(step)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not stopped:
            raise


def round_folder(path: str, round_no: int) -> str:
    return f"{path}/{ROUND}={round_no}"


def read_rounds(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rounds written so far, with the round as a column."""
    with_round = StructType([*schema.fields, StructField(ROUND, LongType())])
    return spark.read.schema(with_round).parquet(path)


class FirstSeen:
    """Append the first record per key to a table, round by round.

    Each round is reduced to one record per key and compared with the keys of the rounds before
    it. A round replaces its own folder, so one that is run again after a failure gives the same.
    """

    def __init__(self, path: str, key: str, seq: str = "seq"):
        self.path, self.key, self.seq = path, key, seq

    def __call__(self, records: DataFrame, round_no: int) -> None:
        records.limit(0).write.mode("ignore").parquet(round_folder(self.path, -1))
        history = read_rounds(records.sparkSession, self.path, records.schema)
        earlier = history.where(F.col(ROUND) < round_no).select(self.key)
        new = first_unseen(records, earlier, self.key, self.seq)
        new.write.mode("overwrite").parquet(round_folder(self.path, round_no))


class Quarantine:
    """Write checked records in one pass, those that are complete apart from those that are not.

    Both are written as they come, without the sort that Spark puts before folders, which would hold or spill all
    texts of a task. A round replaces its own folder. :meth:`accepted` gives the complete records, :meth:`rejected`
    where and why others failed.
    """

    def __init__(self, path: str, required: tuple[str, ...], keys: tuple[str, ...]):
        self.path, self.required, self.keys = path, required, keys

    def __call__(self, records: DataFrame, round_no: int) -> None:
        checked = check_required(records, self.required)
        rows = checked.withColumn(REJECTED, F.col("error").isNotNull())
        spark = records.sparkSession
        with setting(spark, WRITERS, max(2, int(spark.conf.get(WRITERS)))):
            rows.write.mode("overwrite").options(**SMALL_GROUPS).partitionBy(REJECTED).parquet(
                round_folder(self.path, round_no), compression="zstd"
            )

    def _written(self, spark: SparkSession, schema: StructType, bad: bool) -> DataFrame:
        fields = [f for f in schema.fields if f.name != "error"]
        extra = [StructField("error", StringType()), StructField(REJECTED, BooleanType())]
        rows = read_rounds(spark, self.path, StructType([*fields, *extra]))
        return rows.where(F.col(REJECTED) == bad).drop(REJECTED)

    def accepted(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """The complete records of all rounds, with their round."""
        return accepted(self._written(spark, schema, False))

    def rejected(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """The keys and errors of the others."""
        return rejected(self._written(spark, schema, True), self.keys)

