"""Caps, stagnation, page order, first records and reports of a feed that grows round by round."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import limits
from feedloom.operators.filters import check_required
from feedloom.streaming import feed as stream
from feedloom.streaming import keyed, reports, stops


@pytest.fixture
def rounds(spark, tmp_path):
    """Follow rows given round by round; more rounds can come later."""
    path = str(tmp_path / "feed")

    def add(given, schema):
        for rows in given:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        return stream.read_feed(spark, path, spark.createDataFrame([], schema).schema, files_per_round=1)

    return add


ROWS = [[(r * 10 + i, f"t{r}{i}") for i in random.Random(r).sample(range(10), 10)] for r in range(5)]


@pytest.mark.parametrize("n", [0, 1, 10, 23, 49, 500])
def test_row_cap_equals_the_cap_of_a_batch(spark, rounds, tmp_path, n):
    feed = rounds(ROWS, "seq bigint, text string")
    sink, checkpoint = stops.RowCap(str(tmp_path / "out"), n), str(tmp_path / "check")
    stream.write_rounds(feed, sink, checkpoint, rounds=2, stop=sink.done)
    stream.write_rounds(feed, sink, checkpoint, stop=sink.done)
    stream.write_rounds(feed, sink, checkpoint, stop=sink.done)
    whole = spark.createDataFrame([r for rows in ROWS for r in rows], "seq bigint, text string")
    want = sorted(tuple(r) for r in limits.cap(whole, n).collect())
    if n == 0:
        assert sink.done(spark, 0)
        return
    got = [(r.seq, r.text) for r in sink.records(spark, whole.schema).collect()]
    assert sorted(got) == want and len(got) == min(n, 50)
    if n > 30:
        assert sink.taken(spark, 3) == 30


def test_row_cap_round_can_run_again(spark, tmp_path):
    sink = stops.RowCap(str(tmp_path / "out"), 15)
    frames = [spark.createDataFrame(rows, "seq bigint, text string") for rows in ROWS[:2]]
    for _ in range(2):
        sink(frames[0], 0)
        sink(frames[1], 1)
    assert sorted(r.seq for r in sink.records(spark, frames[0].schema).collect()) == list(range(15))
    assert sink.done(spark, 2) and not sink.done(spark, 1)


HEIGHTS = [10, 20, 20, 30, 30, 30, 30]


@pytest.mark.parametrize("after, last", [(1, 2), (2, 5)])
def test_stand_still_ends_the_feed(spark, rounds, tmp_path, after, last):
    feed = rounds([[("a", h, i)] for i, h in enumerate(HEIGHTS)], "feed string, height bigint, i bigint")
    out, seen = str(tmp_path / "out"), []

    def write(records, round_no):
        seen.append(round_no)
        records.write.mode("overwrite").parquet(stream.round_folder(out, round_no))

    sink = stops.StandStill(str(tmp_path / "state"), write, after)
    stream.write_rounds(feed, sink, str(tmp_path / "check"), stop=sink.done)
    assert seen == list(range(last + 1))
    assert [tuple(r) for r in sink.stop_rounds(spark, last + 1, feed.schema).collect()] == [("a", last)]
    # A later run with the same checkpoint finds the feed at its end.
    stream.write_rounds(feed, sink, str(tmp_path / "check"), stop=sink.done)
    assert seen == list(range(last + 1))


def test_stand_still_of_several_feeds(spark, tmp_path):
    """Feeds end one by one; a round without a feed's records says nothing about it."""
    heights = {"a": [1, 1, 1, 1, 2], "b": [1, 2, None, 2, 3], "c": [None, 5, 6, 7, 7]}
    kept = []

    def write(records, round_no):
        kept.extend((r.feed, round_no) for r in records.collect())

    sink = stops.StandStill(str(tmp_path / "state"), write, 1)
    for i in range(5):
        rows = [(f, h[i]) for f, h in heights.items() if h[i] is not None] + [(None, i)]
        sink(spark.createDataFrame(rows, "feed string, height bigint"), i)
    assert sorted(kept, key=str) == sorted(
        [("a", 0), ("a", 1), ("b", 0), ("b", 1), ("b", 3), *[("c", i) for i in (1, 2, 3, 4)], *[(None, i) for i in range(5)]],
        key=str,
    )
    assert not sink.done(spark, 4) and sink.done(spark, 5)


def page_rows(pages, feed="a"):
    return [(feed, p, f"{feed}{p}{i}") for p in pages for i in range(2)]


def test_page_prefix_of_arriving_pages(spark, tmp_path):
    released = []

    def write(records, round_no):
        released.extend((r.feed, r.page_no, round_no) for r in records.collect())

    schema = "feed string, page_no int, text string"
    sink = stops.PagePrefix(str(tmp_path / "held"), write, patience=3)
    given = [page_rows([1]) + page_rows([2], "b"), page_rows([3]), page_rows([2, 2]), page_rows([5]), page_rows([1]), page_rows([1], "b"), [], []]
    for i, rows in enumerate(given):
        for _ in range(1 + (i == 2)):
            # A round that is run again gives the same.
            done = len(released)
            sink(spark.createDataFrame(rows, schema), i)
        if i == 2:
            del released[done:]
            sink(spark.createDataFrame(rows, schema), i)
    pages = sorted({r for r in released if r[0] == "a"}, key=lambda r: r[2])
    assert sorted(pages) == [("a", 1, 0), ("a", 2, 2), ("a", 3, 2)]
    # The second feed lacked its first page until its second one was given up; late pages are left out.
    assert {r for r in released if r[0] == "b"} == {("b", 1, 5)}
    lost = sink.given_up(spark, spark.createDataFrame([], schema).schema).collect()
    assert {(r.feed, r.page_no, r["round"]) for r in lost} == {("b", 2, 3), ("a", 5, 6)}
    assert sink.held(spark, 8, spark.createDataFrame([], schema).schema).isEmpty()


def test_first_record_in_state(spark, rounds, tmp_path):
    rnd = random.Random(4)
    given = [[(rnd.randrange(1000) * 10 + r, "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(30)}") for _ in range(60)] for r in range(3)]
    given[1].append((5, None))
    feed = rounds(given, "seq bigint, link string")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    stream.append_available(keyed.first_in_state(feed, "link"), out, check)
    first = {}
    for seq, link in sorted(r for rows in given for r in rows if r[1]):
        first.setdefault(link, seq)
    written = spark.read.schema(feed.schema).parquet(out)
    assert {r.link: r.seq for r in keyed.settled(written, "link").collect()} == first
    # What was handed on is only what came before all that was seen; one row per key and round at most.
    assert written.count() <= sum(len({link for _, link in rows if link}) for rows in given)
    rounds([[(1, "hot"), (99999, "k1"), (7, "new")]], "seq bigint, link string")
    stream.append_available(keyed.first_in_state(feed, "link"), out, check)
    first |= {"hot": min(1, first["hot"]), "new": 7}
    assert {r.link: r.seq for r in keyed.settled(spark.read.schema(feed.schema).parquet(out), "link").collect()} == first


def test_state_is_forgotten_behind_the_watermark(spark, rounds, tmp_path):
    schema = "seq bigint, link string, at bigint"
    feed = rounds([[(1, "a", 0), (2, "b", 500)], [(3, "c", 1000)], [(4, "c", 1001)], [(5, "a", 1002), (6, "b", 1002)]], schema)
    timed = feed.withColumn("at", F.timestamp_seconds(F.col("at") + 1_700_000_000))
    out = str(tmp_path / "out")
    first = keyed.first_in_state(timed, "link", event_time="at", keep_seconds=700)
    stream.append_available(first, out, str(tmp_path / "check"))
    # The state of "a" was 700 seconds old by the watermark of 1001, that of "b" was not.
    assert sorted((r.seq, r.link) for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, "b"), (3, "c"), (5, "a")]


def test_round_report(spark, rounds, tmp_path):
    given = [[(r, f"a{r}")] * (r + 1) + [(r, None)] * (2 * r) for r in range(3)]
    feed = check_required(rounds(given, "seq bigint, author string"), ["author"])
    with reports.RoundReport(spark) as report:
        stream.append_available(reports.counted(feed), str(tmp_path / "out"), str(tmp_path / "check"))
    assert [tuple(r) for r in report.table().orderBy("round").collect()] == [(r, r + 1, 2 * r) for r in range(3)]
