"""Counts of a running feed: how many records each round took and left out."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Name of the counts in the progress of a stream.
COUNTS = "records"
REPORT = "round bigint, accepted bigint, rejected bigint"


def counted(checked: DataFrame, name: str = COUNTS) -> DataFrame:
    """Count complete and other records of a checked feed while they pass."""
    return checked.observe(
        name,
        F.count(F.when(F.col("error").isNull(), 1)).alias("accepted"),
        F.count("error").alias("rejected"),
    )


class RoundReport(StreamingQueryListener):
    """Collects the counts of :func:`counted`, one row per round that had records.

    ``with RoundReport(spark) as report:`` listens to the streams that run inside; when it is left, all that ran
    have reported. A round that is run again after a failure replaces its row.
    """

    def __init__(self, spark: SparkSession, name: str = COUNTS):
        self.spark, self.name = spark, name
        self.rounds: dict[int, tuple[int, int]] = {}
        self._running: dict[str, threading.Event] = {}

    def __enter__(self) -> RoundReport:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        for ended in list(self._running.values()):
            ended.wait(60)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self._running[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        counts = event.progress.observedMetrics.get(self.name)
        if counts is not None and event.progress.numInputRows:
            self.rounds[event.progress.batchId] = (counts.accepted, counts.rejected)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if ended := self._running.get(str(event.runId)):
            ended.set()

    def table(self) -> DataFrame:
        """``round``, ``accepted`` and ``rejected``: one row per round."""
        rows = [(r, *counts) for r, counts in sorted(self.rounds.items())]
        return self.spark.createDataFrame(rows, REPORT)
