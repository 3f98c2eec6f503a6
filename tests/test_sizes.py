"""What grows with the tables and what does not: files, rounds, calls of Python, texts held at once."""

import glob
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import markup
from feedloom.operators.search_index import SearchIndex
from feedloom.plans import captures, catalog
from feedloom.session import GROUP_PAGES, ROW_GROUP, staged
from feedloom.streaming import feed as stream
from tests.test_captures import tables
from tests.test_operators import plan_of

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def folders(monkeypatch, tmp_path):
    """Let the queries write below the test's own folder."""
    monkeypatch.setattr(catalog, "shared_folder", lambda spark, purpose: str(tmp_path / "kept" / purpose))
    return tmp_path / "kept"


def test_first_links_read_each_page_once(spark, tmp_path, capsys):
    rows = [(1, "https://a.b/c", "<p title='x'><a href=/d>"), (2, "https://a.b/c/", '<a href="e">'), (3, "https://a.b", "none")]
    spark.createDataFrame(rows, captures.TABLES["pages"]).write.parquet(f"{tmp_path}/pages.parquet")
    links = catalog.first_links(spark, str(tmp_path))
    assert {r.page_id: r.link for r in links.collect()} == {1: "https://a.b/d", 2: "https://a.b/c/e"}
    plan = plan_of(links, capsys)
    calls = [x for x in plan.splitlines() if "Arguments: [_first_links(" in x or "ArrowEvalPython [_first_links(" in x]
    assert calls and all(x.count("_first_links(") == 1 for x in calls), plan


def test_the_tree_cleaner_takes_pages_one_at_a_time():
    pages = pa.array(["<p>a<b>b</b>", None, ""])
    assert markup._tree_spaced.func(pages).to_pylist() == ["a b", None, ""]
    assert markup._tree_compact.func(pages).to_pylist() == ["ab", None, ""]


def test_long_feeds_have_larger_blocks(spark, tmp_path, monkeypatch):
    kept = folders(monkeypatch, tmp_path)
    rows = [(50 * i, f"job {i}", "brand", "ECONOMY" if i % 9 == 0 else "type") for i in range(300)]
    spark.createDataFrame(rows, captures.TABLES["part"]).write.parquet(f"{tmp_path}/part.parquet")
    got = catalog.captured_jobs(spark, str(tmp_path)).collect()
    assert sorted(r.page_no for r in got) == [2, 3, 4, 5]
    assert len(glob.glob(f"{kept}/captures/**/*.parquet", recursive=True)) <= catalog.BLOCKS_PER_FEED


def test_a_followed_store_gives_every_page_of_larger_blocks(spark, tmp_path, monkeypatch):
    folders(monkeypatch, tmp_path)
    rows = [(50 * i, f"job {i}", "brand", "type") for i in range(150)]
    spark.createDataFrame(rows, captures.TABLES["part"]).write.parquet(f"{tmp_path}/part.parquet")
    assert catalog._pages_per_block(spark, str(tmp_path)) == 4
    got = catalog.captured_jobs_followed(spark, str(tmp_path)).collect()
    assert sorted(r.page_no for r in got) == list(range(1, 151))


def test_a_larger_feed_comes_in_larger_files(spark, tmp_path, monkeypatch):
    kept = folders(monkeypatch, tmp_path)
    monkeypatch.setattr(catalog, "FILE_ROWS", 10)
    rows = [(i, datetime(2024, 1, 1), i % 70, "click", 1.0) for i in range(2_000)]
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{tmp_path}/events.parquet")
    followed = catalog._followed(spark, str(tmp_path))
    assert followed.isStreaming
    assert len(glob.glob(f"{kept}/feed/*.parquet")) <= catalog.MOST_FILES
    assert spark.read.parquet(f"{kept}/feed").count() == 2_000


def test_stored_posts_are_packed(spark, tmp_path):
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("description", T.StringType())])
    index = SearchIndex(str(tmp_path / "index"), schema, per_block=10)
    index.add(spark.range(30).select(F.col("id").alias("seq"), F.lit("some words").alias("description")), 0)
    files = glob.glob(f"{tmp_path}/index/posts/**/*.parquet", recursive=True)
    assert files and all(".zstd." in f for f in files)


def row_groups(folder):
    files = glob.glob(f"{folder}/**/*.parquet", recursive=True)
    found = [pq.ParquetFile(f).metadata for f in files]
    return [m.row_group(i).total_byte_size for m in found for i in range(m.num_row_groups)]


def long_texts(spark, rows):
    """Texts of 100 KB that are all different."""
    return spark.range(rows, numPartitions=1).select(
        F.col("id").alias("page_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(5_000)), lambda i: F.hex(F.xxhash64("id", i)))).alias("html")
    )


def test_long_texts_are_written_in_small_row_groups(spark, tmp_path):
    path = staged(long_texts(spark, 600), "pages").inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    checked = stream.Quarantine(str(tmp_path / "checked"), ("html",), ("page_id",))
    checked(long_texts(spark, 600).withColumn("error", F.lit(None).cast("string")), 0)
    for folder in (path, tmp_path / "checked"):
        sizes = row_groups(folder)
        assert len(sizes) >= 3 and max(sizes) < 2 * ROW_GROUP


def test_pages_that_pack_well_are_held_in_small_numbers_too(spark, tmp_path, monkeypatch):
    tables(spark, str(tmp_path), range(25_000), [(0, "word " * 100, "en", "web")], [(0, "https://a.b/0", "")])
    for query in (catalog.stream_extract, catalog.all_posts_followed):
        kept = folders(monkeypatch, tmp_path / query.__name__)
        query(spark, str(tmp_path))
        found = [pq.ParquetFile(f).metadata for f in glob.glob(f"{kept}/captured/*.parquet")]
        rows = [m.row_group(i).num_rows for m in found for i in range(m.num_row_groups)]
        assert sum(rows) >= 1_000 and max(rows) <= GROUP_PAGES


def test_rounds_hand_small_batches_to_python(spark, tmp_path):
    long_texts(spark, 300).write.parquet(str(tmp_path / "feed"))
    kept, seen = spark.conf.get(stream.BATCH_BYTES), []

    def lengths(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": pa.array([sum(len(x.as_py()) for x in batch.column(0))])})

    def write(records, round_no):
        seen.extend(r.size for r in records.select("html").mapInArrow(lengths, "size long").collect())

    feed = stream.read_feed(spark, str(tmp_path / "feed"), long_texts(spark, 1).schema)
    stream.write_rounds(feed, write, str(tmp_path / "checkpoint"))
    assert sum(seen) > 20_000_000 and max(seen) < 2 * stream.MOST_BYTES
    assert spark.conf.get(stream.BATCH_BYTES) == kept
