"""Repeated lines, by levelled sorted runs of line hashes that batches are joined with."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import shared_folder, staged

#: Runs of a level that are merged to one run of the next.
FANOUT = 2

#: A line counts from this many code points on, stripped.
LEAST_CHARS = 20

_BLANK = " \t\n\x0b\x0c\r"


def line_key(line: str) -> bytes | None:
    """What lines are compared by: stripped, A-Z lower-cased; none for short lines."""
    bare = line.strip(_BLANK)
    return bare.encode().lower() if len(bare) >= LEAST_CHARS else None


def _hash(key: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(key)
    return (
        int.from_bytes(digest[:8], "big", signed=True),
        int.from_bytes(digest[8:], "big", signed=True),
    )


class LineRuns:
    """A growing set of line hashes: sorted runs in levels, in the shared folder.

    A run has one row per hash: ``h1``, ``h2``, ``n`` (documents that hold the line, as far as
    the run knows), ``new`` (no earlier run had it) and ``owner`` (the largest document, of new ones).
    Runs are bucketed by hash and sorted, so a batch is shuffled once and merged with each run
    where it lies. ``fanout`` runs of a level are compacted to one of the next.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.fanout = fanout
        self.levels: list[list[str]] = []

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _store(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.repartition(self.buckets, "h1", "h2")
            .write.bucketBy(self.buckets, "h1", "h2")
            .sortBy("h1", "h2")
            .option("path", shared_folder(self.spark, "line-run"))
            .saveAsTable(name)
        )
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            merged = _merged([self.spark.table(t) for t in self.levels[level]])
            old, self.levels[level] = self.levels[level], []
            self._store(merged, level + 1)
            for table in old:
                self.spark.sql(f"DROP TABLE {table}")

    def flagged(self, keys: DataFrame) -> DataFrame:
        """Merge a batch (``h1``, ``h2``, ...) with all runs; ``seen`` tells which hashes are known."""
        seen = F.lit(False)
        for i, run in enumerate(self.runs()):
            keys = keys.join(run.select("h1", "h2", F.lit(True).alias(f"_in{i}")), ["h1", "h2"], "left")
            seen = seen | F.coalesce(f"_in{i}", F.lit(False))
        return keys.withColumn("seen", seen).drop(*[f"_in{i}" for i in range(len(self.runs()))])

    def add(self, lines: DataFrame) -> None:
        """Add a batch of ``h1``, ``h2``, ``doc_id``: one row for each line of a document.

        Hashes that no run has are new and get their owner, the largest document of the batch; the
        others only add to the number of documents.
        """
        unknown = F.max(F.col("doc_id").isNull().cast("int"))
        keys = lines.groupBy("h1", "h2").agg(
            (F.count_distinct("doc_id") + unknown).alias("n"), F.max("doc_id").alias("largest")
        )
        marked = self.flagged(keys)
        self._store(
            marked.select("h1", "h2", "n", F.when(~F.col("seen"), F.col("largest")).alias("owner"), (~F.col("seen")).alias("new")), 0
        )

    def merged(self) -> DataFrame:
        """All runs as one."""
        return _merged(self.runs())

    def drop(self) -> None:
        """Forget the runs; their files lie in the shared folder."""
        for name in [name for level in self.levels for name in level]:
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []


def _merged(runs: list[DataFrame]) -> DataFrame:
    """Runs as one: sorted buckets are merged where they lie, by a join of each run with the next.

    Not by a union, which of bucketed tables may be taken for one that is already dealt.
    """
    columns = ["h1", "h2", "n", "owner", "new"]
    out = runs[0].select(columns)
    for run in runs[1:]:
        later = run.select("h1", "h2", *[F.col(c).alias(f"_{c}") for c in columns[2:]])
        new, there = F.coalesce("_new", F.lit(False)), F.coalesce("new", F.lit(False))
        # The owner stands where the hash was new, which is in one run.
        out = out.join(later, ["h1", "h2"], "full").select(
            "h1",
            "h2",
            (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n"),
            F.when(new, F.col("_owner")).otherwise(F.col("owner")).alias("owner"),
            (new | there).alias("new"),
        )
    return out


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, h1, h2 = [], [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            lines = (text.as_py() or "").split("\n")
            for key in {k for k in map(line_key, lines) if k is not None}:
                a, b = _hash(key)
                ids.append(doc)
                h1.append(a)
                h2.append(b)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (ids, h1, h2)], ["doc_id", "h1", "h2"]
        )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, n_dropped, kept = [], [], []
        for text, drops in zip(batch.column(1), batch.column(2), strict=True):
            lines = (text.as_py() or "").split("\n")
            drop = {(d["h1"], d["h2"]) for d in drops.as_py() or ()}
            stay = lines
            if drop:
                stay = [x for x in lines if (k := line_key(x)) is None or _hash(k) not in drop]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
            kept.append("\n".join(stay))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(n_lines), pa.array(n_dropped), pa.array(kept)],
            ["doc_id", "n_lines", "n_dropped", "kept"],
        )


def drop_repeated_lines(
    docs: DataFrame,
    least_docs: int = 3,
    batches: int = 4,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each document without the lines that ``least_docs`` or more documents hold.

    A row per input row: ``doc_id``, ``n_lines``, ``n_dropped``, ``kept`` (the text left). The
    document with the largest id keeps its copies of a line. Lines are compared stripped and with
    A-Z lower-cased, through 128-bit hashes; shorter lines always stay.

    Documents are added to the runs in batches of descending id, so the first batch that brings
    a line has its owner. Then documents are joined with the lines to drop.

    Null and empty texts are one empty line. Rows of one ``doc_id`` are one document; rows
    without one are a document below all others. A table without rows gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shares = [i / batches for i in range(1, batches)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] or [] if shares else []
    above = sum((F.coalesce(F.col("doc_id") > c, F.lit(False)).cast("int") for c in cuts), F.lit(0))
    lines = staged(
        rows.mapInArrow(_keys, "doc_id long, h1 long, h2 long").withColumn("batch", above),
        "lines",
        by=["batch"],
    )
    runs = LineRuns(spark)
    for batch in reversed(range(batches)):
        runs.add(lines.where(F.col("batch") == batch).drop("batch"))
    drops = staged(runs.merged().where(F.col("n") >= least_docs).select("h1", "h2", "owner"), "drops")
    runs.drop()
    dropped = (
        lines.join(drops, ["h1", "h2"])
        .where(F.coalesce(F.col("doc_id") != F.col("owner"), F.lit(True)))
        .groupBy(F.col("doc_id").alias("of"))
        .agg(F.collect_set(F.struct("h1", "h2")).alias("drops"))
    )
    return (
        rows.join(dropped, F.col("doc_id").eqNullSafe(F.col("of")), "left")
        .select("doc_id", "text", "drops")
        .mapInArrow(_apply, "doc_id long, n_lines long, n_dropped long, kept string")
    )
