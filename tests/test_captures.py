"""Captured pages put together from tables of the test's own."""

import csv
import glob
import gzip
from datetime import datetime

import pytest

from feedloom.plans import captures, catalog
from feedloom.session import shared_folder, staged

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def tables(spark, folder, ids, documents, pages):
    rows = [(i, datetime(2024, 1, 1, 0, k % 60), k, "click" if k % 2 else "purchase", 1.0) for k, i in enumerate(ids)]
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame(documents, captures.TABLES["documents"]).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(pages, captures.TABLES["pages"]).write.parquet(f"{folder}/pages.parquet")


def by_joining(spark, folder, mark):
    """The cards of each page from posts joined with their texts, in order."""
    from pyspark.sql import functions as F

    posts = captures.posts(spark, folder, text=True, link=True)
    post = F.struct(*posts.columns)
    cards = posts.select("page_id", "seq", captures.card_html(post, F.col("description"), mark).alias("card")).collect()
    found = {}
    for r in cards:
        found.setdefault(r.page_id, []).append((r.seq, r.card))
    order = lambda c: (c[0], c[1] is not None, c[1] or "")
    return {p: "".join(c for _, c in sorted(x, key=order) if c) for p, x in found.items()}


@pytest.mark.parametrize("documents", [3, 24, 25, 26, 130])
def test_pages_hold_the_cards_of_their_posts(spark, tmp_path, documents):
    ids = [*range(-60, 300), None, 7, 7, 251, 10_000_000_019]
    texts = [(i, None if i % 11 == 5 else f"text <{i}> & more", "en", "web") for i in range(documents)]
    texts += [(2, "again", "de", "web"), (None, "no id", "en", "web"), (10**15, "far", "en", "web"), (-1, "below", "en", "web")]
    tables(spark, str(tmp_path), ids, texts, [(i, f"https://a.b/{i}?x=1&y=2", "") for i in range(7)])
    got = captures.feed_pages(spark, str(tmp_path), "id").collect()
    want = by_joining(spark, str(tmp_path), "id")
    head, tail = "<!DOCTYPE html><html><body><main>", "</main></body></html>"
    assert {r.page_id: r.html for r in got} == {p: f"{head}{x}{tail}" for p, x in want.items()}
    assert len(got) == len(want) and all(r.url == f"{captures.SITE}/search?page={r.page_id}" for r in got)


def test_pages_are_put_together_without_a_copy_of_all_texts(spark, tmp_path):
    texts = [(i, f"{i:04d}" * 2_000, "en", "web") for i in range(50)]
    tables(spark, str(tmp_path), range(20_000), texts, [(i, f"https://a.b/{i}", "") for i in range(50)])
    folder = shared_folder(spark, "x").rsplit("/", 1)[0]
    before = set(glob.glob(f"{folder}/*"))
    pages = captures.feed_pages(spark, str(tmp_path))
    assert sum(len(r.html) for r in pages.where("page_id % 100 = 0").collect()) > 8 * 25 * 8_000
    assert set(glob.glob(f"{folder}/*")) == before


def test_texts_are_joined_last(spark, tmp_path):
    tables(spark, str(tmp_path), range(30), [(i, "text", "en", "web") for i in range(5)], [(i, "u", "") for i in range(5)])
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        posts = captures.posts(spark, str(tmp_path), text=True, link=True)
        plan = posts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    joins = [x for x in plan.splitlines() if "Join [" in x]
    assert len(joins) == 2 and "doc_id" in joins[0] and "link_id" in joins[1], plan
    assert posts.columns[-2:] == ["description", "post_link"]


def sent(plan) -> int:
    """Bytes that the exchanges of a plan have dealt out."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return sent(plan.executedPlan())
    below = [plan.plan()] if name.endswith("QueryStage") else [plan.children().apply(i) for i in range(plan.children().size())]
    own = plan.metrics().apply("dataSize").value() if name == "Exchange" else 0
    return own + sum(map(sent, below))


def test_texts_are_sent_to_the_pages_hardly_more_than_once(spark, tmp_path):
    texts = [(i, f"{i:05d}" * 200, "en", "web") for i in range(8_000)]
    tables(spark, str(tmp_path), range(100), texts, [(i, f"https://a.b/{i}", "") for i in range(5)])
    pages = captures.feed_pages(spark, str(tmp_path))
    assert len(pages.collect()) == 4
    assert sent(pages._jdf.queryExecution().executedPlan()) < 1.6 * 8_000 * 1_000


def test_cards_that_a_search_leaves_out_are_not_written(spark, tmp_path, monkeypatch):
    texts = [(i, "the end" if i % 2 else "an end", "en", "web") for i in range(40)]
    tables(spark, str(tmp_path), range(100), texts, [(i, f"https://a.b/{i}", "") for i in range(5)])
    written = []

    def kept(*args, **named):
        written.append(staged(*args, **named))
        return written[-1]

    monkeypatch.setattr(catalog, "staged", kept)
    for name, rows in (("recent_posts_sorted", 50), ("all_posts_compact_rounds", 5)):
        written.clear()
        assert catalog.QUERIES[name](spark, str(tmp_path)).count() == rows
        assert written[0].count() == 50


def test_texts_meet_their_posts_by_a_merge_at_any_size(spark, tmp_path):
    tables(spark, str(tmp_path), range(30), [(i, "text", "en", "web") for i in range(5)], [(i, "u", "") for i in range(5)])
    plan = captures.posts(spark, str(tmp_path), text=True, link=True)._jdf.queryExecution().executedPlan().toString()
    assert [x for x in plan.splitlines() if "SortMergeJoin [doc_id" in x], plan


def test_exported_texts_are_packed_while_they_are_put_in_order(spark, tmp_path, monkeypatch):
    texts = [(i, None if i == 3 else f"{i}\u2003\u00e9 \U0001f600  " + "a \"b\", c\n" * 2_000, "en", "web") for i in range(6)]
    tables(spark, str(tmp_path), range(40), texts, [(i, f"https://a.b/{i}", "") for i in range(5)])
    monkeypatch.setattr(catalog, "shared_folder", lambda spark, purpose: str(tmp_path / "out"))
    ordered, in_order = [], catalog.ordering.in_feed_order
    monkeypatch.setattr(catalog.ordering, "in_feed_order", lambda df: ordered.append(df) or in_order(df))
    got = [tuple(r) for r in catalog.export_csv(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(map(tuple, catalog.post_table(spark, str(tmp_path)).collect()), key=str)
    assert dict(ordered[0].dtypes)["description"] == "binary"
    parts = sorted(glob.glob(f"{tmp_path}/out/part-*"))
    assert parts and all(x.endswith(".csv.gz") for x in parts)
    assert [p for f in parts for p in read_authors(f)] == [f"user-{k}" for k in range(40)]


def read_authors(part):
    with gzip.open(part, "rt", newline="") as rows:
        return [r["Author"] for r in csv.DictReader(rows)]
