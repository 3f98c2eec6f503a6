"""Caps by selection, keys kept over runs, the search index, the store of pages, and SQL extraction."""

import random
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.tags import contains_all_terms
from feedloom.operators import limits, ordering
from feedloom.operators.extract import card_function, extract_cards
from feedloom.operators.history import KeyHistory
from feedloom.operators.search_index import SearchIndex
from feedloom.sinks import export
from feedloom.sources import pages as src
from feedloom.sources import store
from tests.test_operators import frame, plan_of


@pytest.mark.parametrize("n", [1, 39, 40, 41, 777, 2500, 2999, 3000, 4000])
@pytest.mark.parametrize("kind", ["plain", "ties", "one", "struct", "time", "text"])
def test_cap_by_selection(spark, monkeypatch, n, kind):
    """Small limits, so that the place is found in rounds of counts between sampled places."""
    monkeypatch.setattr(limits, "TAKE", 40)
    monkeypatch.setattr(limits, "SAMPLE", 60)
    rnd = random.Random(n)
    value = {
        "plain": lambda i: i * 7,
        "ties": lambda i: rnd.randrange(12),
        "one": lambda i: 5,
        "struct": lambda i: (i % 50, i // 50),
        "time": lambda i: i,
        "text": lambda i: f"{i:05d}é",
    }[kind]
    types = {"struct": "struct<a: bigint, b: int>", "text": "string"}
    rows = [(value(i), f"t{i}") for i in range(3000)]
    df = frame(spark, rows, f"seq {types.get(kind, 'bigint')}, text string")
    df = df.withColumn("seq", F.timestamp_seconds("seq")) if kind == "time" else df
    got = limits.cap(df, n).orderBy("seq").collect()
    order = sorted(tuple(r.seq) if kind == "struct" else r.seq for r in df.collect())
    assert [tuple(r.seq) if kind == "struct" else r.seq for r in got] == order[:n]
    assert len({r.text for r in got}) == min(n, 3000)


def test_cap_neither_sorts_nor_writes_the_feed(spark, capsys, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = plan_of(limits.cap(events.select("event_id", "props"), 10, "event_id"), capsys)
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan and "numbered" not in plan


def test_soft_cap_beyond_direct_comparison(spark, monkeypatch):
    monkeypatch.setattr(limits, "TAKE", 20)
    monkeypatch.setattr(limits, "SAMPLE", 50)
    df = frame(spark, [(i, i // 7) for i in range(500)], "seq bigint, batch bigint")
    assert sorted(r.seq for r in limits.soft_cap(df, 100, 300).collect()) == list(range(105))
    assert sorted(r.seq for r in limits.soft_cap(df, 100, 103).collect()) == list(range(103))


def test_keys_of_earlier_runs(spark, tmp_path, capsys):
    rnd = random.Random(2)
    path, seen = str(tmp_path / "keys"), {}
    runs = [[(run * 100 + i, None if i % 11 == 0 else f"k{rnd.randrange(60)}") for i in range(100)] for run in range(3)]
    for run, rows in enumerate(runs):
        history = KeyHistory(spark, "kept_keys", path, "link", buckets=4)
        for _ in range(2):
            # A run that is repeated gives the same and keeps the same.
            got = history.unseen(frame(spark, rows, "seq bigint, link string"), run)
            found = {r.link: r.seq for r in got.collect()}
            history.add(got, run)
        want = {}
        for seq, key in rows:
            if key and key not in seen:
                want.setdefault(key, seq)
        assert found == want
        seen |= want
    assert history.keys(99).count() == len(seen) == history.keys(99).distinct().count()
    capsys.readouterr()
    got.explain("formatted")
    plan = capsys.readouterr().out
    # The history comes from its buckets: all shuffles are on the side of the new records.
    tree = plan[plan.index("Final Plan") : plan.index("Initial Plan")].splitlines()
    scan = next(i for i, x in enumerate(tree) if "kept_keys" in x)
    join = next(i for i, x in enumerate(tree) if "SortMergeJoin" in x)
    depth = tree[join + 1].index(":-")
    side = [x for x in tree[join + 1 : scan + 1] if not x[depth:].startswith(":")]
    assert "Bucketed: true" in plan and "Scan parquet" in side[-1]
    assert not any("Exchange" in x for x in side) and any("Exchange" in x for x in tree)
    # A new session finds the table where it lies.
    spark.sql("DROP TABLE kept_keys")
    again = KeyHistory(spark, "kept_keys", path, "link", buckets=4)
    assert {r.link for r in again.keys(99).collect()} == set(seen)
    spark.sql("DROP TABLE kept_keys")


TEXTS = ["The cat", "a DOG sat", "x #en y", "#english", "zz", "", None, "straße İx", "the #EN end", "ca", "thé 😀😀😀"]


def test_search_by_index(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(i, " ".join(t for t in rnd.choices(TEXTS, k=3) if t) if i % 13 else None) for i in range(400)]
    rows += [(400 + i, f"only here: quetzal{i}") for i in range(3)]
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("description", T.StringType())])
    index = SearchIndex(str(tmp_path / "index"), schema, per_block=20)
    posts = frame(spark, rows, schema)
    index.add(posts.where("seq < 150"), 0)
    for _ in range(2):
        index.add(posts.where("seq >= 150"), 1)
    for query in ["cat", "the #en", "ca", "dog zz", "quetzal1", "straße", "😀😀😀", "nowhere", "", "#english sat"]:
        want = sorted(r.seq for r in posts.where(contains_all_terms("description", query)).collect())
        assert sorted(r.seq for r in index.search(spark, query).collect()) == want, query


def test_search_opens_the_files_that_can_hold_the_terms(spark, tmp_path):
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("description", T.StringType())])
    index = SearchIndex(str(tmp_path / "index"), schema, per_block=10)
    posts = spark.range(200).select(F.col("id").alias("seq"), F.concat(F.lit("word"), F.col("id").cast("string"), F.lit(" end")).alias("description"))
    index.add(posts, 0)
    assert {(r["round"], r.block) for r in index.blocks(spark, "word157").collect()} == {(0, 15)}
    found = index.search(spark, "word157")
    # What has to be read is one block of twenty: the others may be gone.
    others = [p for p in (tmp_path / "index/posts/round=0").iterdir() if p.name.startswith("block=") and p.name != "block=15"]
    assert len(others) == 19
    for folder in others:
        for file in folder.glob("*.parquet"):
            file.write_bytes(b"unreadable")
    assert [r.seq for r in found.collect()] == [157]


def captured_rows():
    return [(k, f, p, f"u{p}", f"<p>{f}{p}</p>") for k in ("post", "job") for f in ("a", "b/c", None) for p in range(1, 30)]


def test_store_of_pages(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = captured_rows()
    store.write_captures(frame(spark, rows, store.SCHEMA.replace("bigint", "long")), path, per_block=10)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in store.captured(spark, path, 10).collect()), key=key) == sorted(rows, key=key)
    wanted = store.captured(spark, path, 10).where("kind = 'job' AND feed = 'b/c' AND page_no >= 12 AND page_no < 18 AND url <> 'u15'")
    # Only the block of pages 10 to 19 of that feed is opened: the others cannot be read.
    broken = [p for p in (tmp_path / "store").rglob("*.parquet") if not ("kind=job" in str(p) and "b%2Fc" in str(p) and "first_page=10" in str(p))]
    assert len(broken) == 17
    for file in broken:
        file.write_bytes(b"unreadable")
    assert sorted(r.page_no for r in wanted.collect()) == [12, 13, 14, 16, 17]
    with pytest.raises(Exception):
        store.captured(spark, path, 10).where("page_no >= 20").collect()


def test_store_as_a_stream(spark, tmp_path):
    from feedloom.streaming.feed import append_available

    path, out, check = (str(tmp_path / x) for x in ("store", "out", "check"))
    rows = captured_rows()
    df = frame(spark, rows, store.SCHEMA.replace("bigint", "long"))
    for part in ("page_no < 10", "page_no between 10 and 19 or page_no >= 20 and kind = 'job'", "page_no >= 20 and kind = 'post'"):
        store.write_captures(df.where(part), path, per_block=10)
        append_available(store.follow_captured(spark, path, 10), out, check)
        append_available(store.follow_captured(spark, path, 10), out, check)
        so_far = spark.read.schema(store.SCHEMA).parquet(out)
        assert so_far.count() == so_far.distinct().count()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in so_far.collect()), key=key) == sorted(rows, key=key)


def test_extraction_from_sql(spark):
    html = '<ul class="{}"><li><strong>{}</strong></li><li><strong>x</strong></li></ul>'
    from feedloom import vocabulary as v

    rows = [(i, html.format(v.JOB_LIST_CLASS, f"job {i}")) for i in range(50)] + [(50, "<![broken"), (51, None)]
    pages = frame(spark, rows, "page_id bigint, html string")
    pages.createOrReplaceTempView("job_pages_for_sql")
    keep = T.StructType([T.StructField("page_id", T.LongType())])
    spark.udtf.register("job_cards", card_function(src.JOB_CARD, keep))
    got = spark.sql("SELECT * FROM job_cards(TABLE(job_pages_for_sql))")
    want = extract_cards(pages, src.JOB_CARD)
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_two_writers_get_two_names(spark, tmp_path):
    base, got = str(tmp_path / "out" / "file"), []
    start = threading.Barrier(4)

    def write(i):
        start.wait()
        got.append(export.export_versioned(spark.range(i + 1), base, ".parquet"))

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == [f"{base}(1).parquet", f"{base}(2).parquet", f"{base}(3).parquet", f"{base}.parquet"]
    assert sorted(spark.read.parquet(p).count() for p in got) == [1, 2, 3, 4]
    # A name that something else has taken is passed over.
    spark.range(1).write.parquet(f"{base}(4).parquet")
    assert export.export_versioned(spark.range(1), base, ".parquet") == f"{base}(5).parquet"


def test_errors_beside_a_job(spark, tmp_path):
    path, beside = export.export_with_errors(spark.range(3), spark.range(2), str(tmp_path / "job"), ".parquet")
    assert (path, beside) == (f"{tmp_path}/job.parquet", f"{tmp_path}/job-errors.parquet")
    assert spark.read.parquet(beside).count() == 2


def test_check_order_in_a_plan(spark):
    rows = frame(spark, [(i, f"t{i}") for i in range(20)], "seq bigint, text string")
    assert limits.cap(ordering.check_order(rows), 5).count() == 5


def test_search_in_posts_that_stay_as_they_lie(spark, tmp_path, capsys):
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("description", T.StringType())])
    index = SearchIndex(str(tmp_path / "index"), schema, per_block=10, as_they_lie=True)
    # A task has the posts of one remainder.
    posts = spark.range(5, numPartitions=5).select(
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(39)), lambda k: k * 5 + F.col("id"))).alias("seq")
    )
    posts = posts.select("seq", F.concat(F.lit("word"), F.col("seq").cast("string"), F.when(F.col("seq") != 9, F.lit(" end"))).alias("description"))
    index.add(posts.where("seq < 100"), 0)
    for _ in range(2):
        index.add(posts.where("seq >= 100"), 1)
    stored = index._posts(spark).groupBy("round", "block").agg(F.count("*").alias("n"), F.countDistinct(F.col("seq") % 5).alias("tasks")).collect()
    assert len(stored) == 20 and all(r.n == 10 and r.tasks == 1 for r in stored)
    assert sorted(r.seq for r in index.search(spark, "end").collect()) == [i for i in range(200) if i != 9]
    assert [r.seq for r in index.search(spark, "word157").collect()] == [157]
    assert index.blocks(spark, "word157").count() == 1
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
