"""Streams against the batch result on the same files, for several ways to split them."""

import random

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from feedloom.streaming import feed as stream

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
SCHEMA = "seq bigint, link string, author string, posted_at timestamp"
ROWS = [
    (i, "hot" if i % 3 == 0 else f"l{i % 17}", None if i % 10 == 9 else f"a{i}") for i in range(200)
]


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "feed")

    def add(rows, files=1):
        rows = list(rows)
        random.Random(0).shuffle(rows)
        df = spark.createDataFrame(rows, "seq bigint, link string, author string").withColumn(
            "posted_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq"))
        )
        df.repartition(files).write.mode("append").parquet(path)
        return path

    return add


def follow(spark, path, files_per_round=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    return stream.read_feed(spark, path, schema, files_per_round)


@pytest.mark.parametrize("files,per_round", [(1, None), (4, 1), (8, 3)])
def test_append_reads_each_record_once(spark, folder, tmp_path, files, per_round):
    path, out, check = folder(ROWS[:100], files), str(tmp_path / "out"), str(tmp_path / "check")
    stream.append_available(follow(spark, path, per_round), out, check)
    assert spark.read.parquet(out).count() == 100
    folder(ROWS[100:], files)
    stream.append_available(follow(spark, path, per_round), out, check)
    stream.append_available(follow(spark, path, per_round), out, check)
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == list(range(200))


@pytest.mark.parametrize("files,per_round", [(1, None), (8, 2)])
@pytest.mark.parametrize("watermark", [False, True])
def test_drop_seen(spark, folder, tmp_path, files, per_round, watermark):
    feed = follow(spark, folder(ROWS, files), per_round)
    options = {"event_time": "posted_at", "delay": "1 hour"} if watermark else {}
    once = stream.drop_seen(feed, "link", salts=4, **options)
    out = str(tmp_path / "out")
    stream.append_available(once, out, str(tmp_path / "check"))
    links = [r.link for r in spark.read.parquet(out).collect()]
    assert sorted(links) == sorted({link for _, link, _ in ROWS})


def test_first_seen_keeps_the_first_of_each_round(spark, folder, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for start in (0, 50, 100):
        path = folder(ROWS[start:start + 50], 3)
        feed = follow(spark, path)
        stream.write_rounds(feed, stream.FirstSeen(out, "link"), check)
    first = {}
    for seq, link, _ in ROWS[:150]:
        first.setdefault(link, seq)
    rows = stream.read_rounds(spark, out, feed.schema).collect()
    assert {r.link: r.seq for r in rows} == first
    assert len(rows) == len(first)


def test_first_seen_round_can_run_again(spark, folder, tmp_path):
    batch = spark.read.parquet(folder(ROWS, 3))
    sink = stream.FirstSeen(str(tmp_path / "out"), "link")
    for _ in range(2):
        sink(batch.where("seq < 100"), 0)
        sink(batch, 1)
    assert stream.read_rounds(spark, sink.path, batch.schema).count() == len({r[1] for r in ROWS})


def test_stop_after_rounds_then_resume(spark, folder, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    feed = follow(spark, folder(ROWS, 6), files_per_round=1)
    seen = []

    def write(records, round_no):
        seen.append(round_no)
        records.write.mode("overwrite").parquet(stream.round_folder(out, round_no))

    stream.write_rounds(feed, write, check, rounds=2)
    assert seen == [0, 1]
    stream.write_rounds(feed, write, check)
    assert seen == [0, 1, 2, 3, 4, 5]
    rows = stream.read_rounds(spark, out, feed.schema)
    assert sorted(r.seq for r in rows.collect()) == list(range(200))


def test_a_failing_round_is_raised(spark, folder, tmp_path):
    def write(records, round_no):
        raise KeyError("broken sink, not RoundLimit")

    with pytest.raises(Exception, match="broken sink"):
        stream.write_rounds(follow(spark, folder(ROWS)), write, str(tmp_path / "check"))


def test_quarantine(spark, folder, tmp_path):
    feed = follow(spark, folder(ROWS, 4), files_per_round=2)
    sink = stream.Quarantine(str(tmp_path / "out"), ("author",), ("seq",))
    stream.write_rounds(feed, sink, str(tmp_path / "check"))
    passed = sink.accepted(spark, feed.schema)
    assert passed.columns == [*feed.columns, "round"]
    assert sorted(r.seq for r in passed.collect()) == [s for s, _, a in ROWS if a]
    failed = sink.rejected(spark, feed.schema).collect()
    assert sorted((r.seq, r.error) for r in failed) == [(s, "missing: author") for s, _, a in ROWS if not a]


def test_quarantine_writes_records_as_they_come(spark, tmp_path, monkeypatch):
    sink = stream.Quarantine(str(tmp_path / "out"), ("author",), ("seq",))
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else "x") for i in range(9)], "seq int, author string")
    before, write, writers = spark.conf.get(WRITERS), DataFrameWriter.parquet, []

    def noted(self, *args, **named):
        writers.append(int(spark.conf.get(WRITERS)))
        return write(self, *args, **named)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    sink(rows, 0)
    assert len(writers) == 1 and writers[0] >= 2 and spark.conf.get(WRITERS) == before
    assert sorted(r.seq for r in sink.accepted(spark, rows.schema).collect()) == [1, 2, 4, 5, 7, 8]
    assert sorted(r.seq for r in sink.rejected(spark, rows.schema).collect()) == [0, 3, 6]
