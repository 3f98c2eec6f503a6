"""Records with long texts get their numbers where they lie."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import numbering, places
from feedloom.plans import captures, catalog, jobs
from tests.test_captures import tables
from tests.test_operators import frame, plan_of


@pytest.mark.parametrize("sent", [0, 10**6])
@pytest.mark.parametrize("parts", [1, 7])
def test_long_rows_are_numbered_like_others(spark, sent, parts):
    rnd = random.Random(parts)
    rows = [(i, rnd.choice([None, 1.5, float("inf"), 7.0]), f"text {i}" if i % 5 else None) for i in range(3_000)]
    rnd.shuffle(rows)
    df = frame(spark, rows, "seq bigint, age double, text string").repartition(parts)
    got = numbering.number_long_rows(df, ["age", "seq"], sent=sent)
    want = numbering.number_rows(df, ["age", "seq"])
    assert got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert numbering.number_long_rows(df.where("seq < 0"), ["seq"], sent=sent).collect() == []


def test_places_of_equal_rows(spark):
    df = frame(spark, [(7, "a")] * 5 + [(None, "b")] * 2, "seq bigint, text string")
    got = numbering.number_long_rows(df, ["seq"]).collect()
    assert sorted((r.position, r.text) for r in got) == [(i, "b" if i < 2 else "a") for i in range(7)]


def test_brought_numbers_leave_texts_where_they_are(spark, capsys):
    kept = places.in_place(spark.range(5_000).select("id", F.lit("text").alias("text")), "kept")
    found = kept.select(places.PLACE, (F.col("id") * 2).alias("double"))
    plan = plan_of(places.brought(kept, found, ["double"]), capsys)
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan, plan
    assert {r.id: r.double for r in places.brought(kept, found, ["double"]).collect()} == {i: 2 * i for i in range(5_000)}


def test_jobs_in_feed_order_number_their_posts_without_texts(spark, monkeypatch):
    numbered, number = [], numbering.number_rows
    for module in (numbering, jobs):
        monkeypatch.setattr(module, "number_rows", lambda df, *a, **n: numbered.append(df.columns) or number(df, *a, **n))
    rows = [(i, f"a{i}", f"text {i}", "1h", f"l{i}") for i in (3, 1, 2)]
    cards = frame(spark, rows, "seq bigint, author string, description string, time_posted string, post_link string")
    got = jobs.all_posts(cards, numbered=True).collect()
    assert sorted((r.position, r.seq, r.description) for r in got) == [(i - 1, i, f"text {i}") for i in (1, 2, 3)]
    assert numbered and not any("description" in columns for columns in numbered)


def test_errors_of_a_job_with_repeated_events(spark, tmp_path, monkeypatch):
    """Cards meet the values of their events, of which one place may have several or none, without their texts."""
    texts = [(i, "word " * 400, "en", "web") for i in range(9)]
    tables(spark, str(tmp_path), [*range(70), 12, 12, None], texts, [(i, f"https://a.b/{i}", "") for i in range(5)])
    events = spark.read.parquet(f"{tmp_path}/events.parquet")
    low = events.withColumn("value", F.when(F.col("event_id") == 7, None).otherwise(F.col("user_id") % 20).cast("double"))
    low.write.parquet(f"{tmp_path}/low/events.parquet")
    for name in ("documents", "pages"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").write.parquet(f"{tmp_path}/low/{name}.parquet")
    folder, written = f"{tmp_path}/low", []
    monkeypatch.setattr(catalog, "shared_folder", lambda spark, purpose: written.append(f"{tmp_path}/kept/{len(written)}") or written[-1])
    got = sorted(tuple(r) for r in catalog.job_errors(spark, folder).collect())
    cards = [r for r in catalog._feed_cards(spark, folder, catalog.src.POST_CARD).collect()]
    values = {}
    for r in captures.posts(spark, folder).collect():
        values.setdefault((r.page_id, None if r.seq is None else r.seq % 25), []).append(r.value)
    want, complete = [], 0
    for c in cards:
        for value in values.get((c.page_id, c.container_idx), [None]):
            if value is not None and value >= 10:
                complete += 1
            else:
                want.append((c.page_id, c.container_idx, "missing: time_posted"))
    assert got == sorted(want) and len(got) > 30
    posts = spark.read.parquet(f"{written[-1]}/file.parquet")
    assert sorted(r.position for r in posts.collect()) == list(range(complete))
    assert {r.description for r in posts.collect()} == {("word " * 400).strip() + " #en #web"}
