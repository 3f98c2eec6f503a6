"""The whole jobs on small captured pages."""

import pytest
from pyspark.sql import functions as F

from feedloom import vocabulary as v
from feedloom.operators.extract import extract_cards
from feedloom.operators.ordering import feed_position
from feedloom.plans import jobs
from feedloom.sinks.export import shown
from feedloom.sources import pages as src
from tests.test_extract import BUTTON, card

FEED = [
    ("Ann", 'Hiring <b>for</b> <span class="visually-hidden">hashtag</span>#servicenow', "3h •", "l1", ""),
    ("Bob", "Hiring for #ServiceNow devs", "5m •", "l2", BUTTON),
    ("Cid", "not a match", "1m •", "l3", ""),
    ("Dan", "hiring for #servicenow", "2d •", "l4", ""),
    ("Eve", "hiring for #servicenow", "7m • Edited •", "l2", ""),
]
SEARCH = jobs.Search(query="hiring for #servicenow")


def pages(spark, cards=FEED, mark='class="x fie-impression-container"', per_page=2):
    rows = []
    for at in range(0, len(cards), per_page):
        html = "".join(card(*c, mark=mark) for c in cards[at:at + per_page])
        rows.append((at // per_page, "https://feed.example/s?q=1", f"<main>{html}</main>"))
    schema = "page_id bigint, url string, html string"
    return spark.createDataFrame(rows, schema) if rows else spark.createDataFrame([], schema)


def cards(spark, rule, source=None, **kw):
    found = extract_cards(source or pages(spark, **kw), rule, keep=("page_id", "url"))
    return found.withColumn("seq", feed_position()).withColumn("round", F.col("page_id"))


def authors(df):
    return [r.author.split()[0] for r in df.collect()]


@pytest.mark.parametrize("rule", [src.POST_CARD, src.POST_HTML_CARD])
def test_recent_posts_sorted(spark, rule):
    found = cards(spark, rule)
    everything = jobs.recent_posts_sorted(found, SEARCH)
    assert authors(everything) == ["Bob", "Eve", "Ann", "Dan"]
    table = shown(everything, v.POST)
    assert table.columns == ["Author", "Description", "Time Posted", "Post Link"]
    assert tuple(table.collect()[2]) == ("Ann", "Hiring for #servicenow", "3h •", "l1")
    recent = jobs.Search(query=SEARCH.query, hours=24)
    assert authors(jobs.recent_posts_sorted(found, recent)) == ["Bob", "Eve", "Ann"]


def test_numbered_and_sorted_agree(spark):
    found = cards(spark, src.POST_CARD)
    numbered = jobs.recent_posts_sorted(found, numbered=True).orderBy("position")
    assert [r.position for r in numbered.collect()] == list(range(5))
    assert authors(numbered) == authors(jobs.recent_posts_sorted(found))


def test_capped_posts_sorted(spark):
    found = cards(spark, src.PLAIN_POST_CARD)
    assert authors(jobs.capped_posts_sorted(found, posts=2, rounds=9)) == ["Bob", "Ann"]
    assert authors(jobs.capped_posts_sorted(found, posts=9, rounds=2)) == ["Cid", "Bob", "Ann", "Dan"]


def test_feed_order_jobs(spark):
    found = cards(spark, src.PLAIN_POST_CARD)
    assert authors(jobs.all_posts(found)) == ["Ann", "Bob", "Cid", "Dan", "Eve"]
    assert authors(jobs.capped_posts(found, posts=3)) == ["Ann", "Bob", "Cid"]
    assert authors(jobs.all_posts_sorted(found)) == ["Cid", "Bob", "Eve", "Ann", "Dan"]
    links = jobs.post_links(cards(spark, src.LINK_CARD))
    assert [r.post_link for r in links.collect()] == ["l1", "l2", "l3", "l4", "l2"]
    counts = jobs.page_counts(cards(spark, src.LINK_CARD))
    assert {r.page_id: r.containers for r in counts.collect()} == {0: 2, 1: 2, 2: 1}


def test_incomplete_cards_are_left_out(spark):
    source = pages(spark).unionByName(
        spark.createDataFrame([(9, "u", '<div class="fie-impression-container">x</div>')], pages(spark).schema)
    )
    assert len(authors(jobs.all_posts(cards(spark, src.PLAIN_POST_CARD, source)))) == 5


@pytest.mark.parametrize("rule", [src.COMPACT_POST_CARD, src.POST_HTML_CARD])
def test_compact_posts_of_repeated_rounds(spark, rule):
    shown_twice = pages(spark).unionByName(pages(spark).withColumn("page_id", F.col("page_id") + 10))
    found = cards(spark, rule, shown_twice)
    once = jobs.all_posts_compact(found).collect()
    assert [r.post_link for r in once] == ["l1", "l2", "l3", "l4"]
    assert once[0].description == "Hiringforhashtag#servicenow"
    assert jobs.all_posts_compact(found, dedup=False).count() == 10


def test_profile_posts(spark):
    people = [(f"p{i % 4}", f"text {i}", "5m", f"l{i}", "") for i in range(8)]
    found = cards(spark, src.PROFILE_CARD, cards=people, mark='id="fie-impression-container"')
    found = found.withColumn("batch", F.col("page_id"))
    got = jobs.profile_posts(found, soft=3, hard=60).collect()
    assert [r.profile_link for r in got] == [f"https://feed.example/in/p{i}" for i in range(4)]
    assert [r.profile_link[-1] for r in jobs.profile_posts(found, soft=2).collect()] == ["0", "1"]
    assert jobs.profile_posts(found, soft=3, hard=3).count() == 3


def test_texts_do_not_wait_for_the_links_of_profiles(spark, tmp_path, monkeypatch):
    rows = [("a", f"text {i}", "5m", f"/in/user-{i % 4}", "https://a.b/c", i, i) for i in range(8)]
    columns = "author string, description string, time_posted string, first_href string, url string, batch bigint, seq bigint"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/cards")
    plans, first_per_key = [], jobs.first_per_key

    def noted(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return first_per_key(df, *args)

    monkeypatch.setattr(jobs, "first_per_key", noted)
    got = jobs.profile_posts(spark.read.parquet(f"{tmp_path}/cards"), soft=3).collect()
    assert [r.description for r in got] == ["text 0", "text 1", "text 2"]
    lines = plans[0].splitlines()
    at = next(i for i, x in enumerate(lines) if "ArrowEvalPython" in x)
    assert "first_href" in lines[at + 1] and "description" not in lines[at + 1], plans[0]


def test_job_branch(spark):
    found = cards(spark, src.JOB_BRANCH_CARD).withColumn("job_description", F.lit("the job"))
    got = {r.author: r.description for r in jobs.posts_with_job_branch(found).collect()}
    assert got["Bob View profile"] == "the job"
    assert got["Cid View profile"] == "not a match"
    content = jobs.job_or_post_content(found, posts=3).collect()
    assert [r.content for r in content][1:] == ["https://x.example/job/1", "not a match"]
    assert shown(jobs.job_or_post_content(found), v.VIEW_JOB_POST).columns == [
        "Author Name", "Post Link", "Time Posted", "Content",
    ]


def test_job_content_defaults(spark):
    html = '<div class="fie-impression-container"><p class="break-words">t</p></div>'
    source = spark.createDataFrame([(0, "u", html)], pages(spark).schema)
    (row,) = jobs.job_or_post_content(cards(spark, src.JOB_BRANCH_CARD, source)).collect()
    assert (row.author, row.post_link, row.time_posted, row.content) == ("N/A", "N/A", "N/A", "t")


def test_job_listings(spark):
    item = (
        "<li><strong>{0}</strong><p class='job-card-container__primary-description'>{1}</p>"
        "<p class='job-card-container__metadata-item'>{2}</p></li>"
    )
    rows = []
    for page in (1, 2, 4):
        items = item.format(f"Software Engineer {page}", "Co", "Rome") + "<li><strong>Half</strong></li>"
        rows.append(("f", page, f"<ul class='scaffold-layout__list-container'>{items}</ul>"))
    captured = spark.createDataFrame(rows, "feed string, page_no int, html string")
    assert [r.page_no for r in jobs.job_listings(captured).collect()] == [1]
    assert sorted(r.page_no for r in jobs.job_listings(captured, last=None).collect()) == [1, 2]
    assert jobs.job_listings(captured, last=9, query="software engineer 2").count() == 1
    assert shown(jobs.job_listings(captured), v.JOB).columns == ["Job Title", "Location", "Company_Name"]


def test_empty_feed(spark):
    found = cards(spark, src.POST_CARD, cards=[])
    assert shown(jobs.recent_posts_sorted(found), v.POST).columns == ["Author", "Description", "Time Posted", "Post Link"]
    assert jobs.recent_posts_sorted(found).count() == 0
    assert jobs.capped_posts_sorted(found).count() == 0
