"""The first record of each key over all rounds of a feed, kept in the state store."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from feedloom.operators.dedup import first_per_key

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state with values and timers is kept on disk, whatever its size."""
    spark.conf.set(PROVIDER, ROCKS_DB)


class _First(StatefulProcessor):
    """Holds the place of a key's first record; hands a record on if its place is before that."""

    def __init__(self, seq: str, place: StructType, names: list[str], event_time: str | None, keep_ms: int):
        self.seq, self.place, self.names = seq, place, names
        self.event_time, self.keep_ms = event_time, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", self.place)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = min(rows, key=lambda r: r[self.seq])
        held = self.first.get() if self.first.exists() else None
        if held is not None and held[0] <= best[self.seq]:
            return
        until = held[1] if held is not None else 0
        if self.event_time is not None:
            until = max(until, int(best[self.event_time].timestamp() * 1000) + self.keep_ms)
            self.handle.registerTimer(until)
        self.first.update((best[self.seq], until))
        yield Row(**{n: best[n] for n in self.names})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.first.exists() and expiredTimerInfo.getExpiryTimeInMs() >= self.first.get()[1]:
            self.first.clear()
        return iter(())

    def close(self) -> None:
        pass


def _first_of_batch(key: str, seq: str):
    """One row per key of each batch, so that a key with many records reaches its task as a few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = pc.sort_indices(batch, [(key, "ascending"), (seq, "ascending")])
            ordered = batch.take(order)
            keys = ordered.column(key)
            if len(keys) > 1:
                same = pc.fill_null(pc.equal(keys.slice(1), keys.slice(0, len(keys) - 1)), False)
                ordered = ordered.filter(pa.concat_arrays([pa.array([True]), pc.invert(same)]))
            yield ordered

    return run


def first_in_state(
    feed: DataFrame, key: str, seq: str = "seq", event_time: str | None = None, keep_seconds: int = 0,
    delay: str = "0 seconds",
) -> DataFrame:
    """The records that are the first of their key, as far as the rounds so far tell.

    The state store holds the place of each key's first record, no earlier round is read again. A record
    with a smaller ``seq`` that comes later replaces it and is handed on too; :func:`settled` leaves one of
    them. ``seq`` is a plain column without nulls; records without a key are left out.

    With ``event_time`` a key is forgotten ``keep_seconds`` after its first record, by the watermark,
    which bounds the state; a key that shows up again after that counts as new.
    """
    use_rocksdb(feed.sparkSession)
    schema = feed.schema
    reduced = feed.where(F.col(key).isNotNull()).mapInArrow(_first_of_batch(key, seq), schema)
    if event_time is not None:
        reduced = reduced.withWatermark(event_time, delay)
    place = StructType([StructField("seq", schema[seq].dataType), StructField("until", LongType())])
    return reduced.groupBy(key).transformWithState(
        statefulProcessor=_First(seq, place, schema.names, event_time, keep_seconds * 1000),
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime" if event_time is not None else "None",
    )


def settled(written: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """One record per key of what :func:`first_in_state` has handed on."""
    return first_per_key(written, key, seq)
