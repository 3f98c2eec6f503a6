"""Every operator and job as a query over the given tables, with its result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import functions as fn
from feedloom import vocabulary as v
from feedloom.operators import branches, counts, dedup, filters, limits, ordering, paging
from feedloom.operators.extract import CardRule, Field, Match, card_function, extract_cards, may_hold
from feedloom.operators.history import KeyHistory
from feedloom.operators.numbering import number_rows
from feedloom.operators.places import PLACE, brought, in_place
from feedloom.operators.search_index import SearchIndex
from feedloom.plans import captures, jobs
from feedloom.plans import oracle as sql
from feedloom.session import PAGE_GROUPS, shared_folder, staged
from feedloom.sinks import export
from feedloom.sources import pages as src
from feedloom.sources import store
from feedloom.streaming import feed as stream
from feedloom.streaming import keyed, reports, stops

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

SEARCH = "the #en"
SEARCH_SQL = (
    "contains(lower(description), 'the') and "
    f"contains(concat(' ', {sql.squeezed('lower(description)')}, ' '), ' #en ')"
)
RECENT_SQL = "posted_at >= newest - interval 24 hours"
BY_AGE = f"row_number() over (order by {sql.minutes('time_posted')}, seq) - 1 as position"
BY_SEQ = "row_number() over (order by seq) - 1 as position"
POST_SQL = "author, description, time_posted, post_link, seq"


def query(oracle: str | None):
    """Register a query under its function name, with the SQL that gives the same rows."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if oracle is not None:
            ORACLE[build.__name__] = oracle
        return build

    return register


def _read(spark, sf_dir, name, *columns):
    return captures.table(spark, sf_dir, name, *columns)


def _pages(spark, sf_dir, *columns):
    return captures.table(spark, sf_dir, "pages", *columns)


# ---- ages and order ---------------------------------------------------------------------------


@query(f"with {sql.POSTS} select seq, time_posted, {sql.minutes('time_posted')} as age_minutes from posts")
def age_minutes(spark, sf_dir):
    posts = captures.posts(spark, sf_dir)
    return ordering.with_age(posts).select("seq", "time_posted", "age_minutes")


@query(f"with {sql.POSTS} select seq, author, time_posted, {BY_AGE} from posts")
def posts_by_age(spark, sf_dir):
    posts = captures.posts(spark, sf_dir).select("seq", "author", "time_posted")
    return number_rows(ordering.with_age(posts), ["age_minutes", "seq"]).drop("age_minutes")


@query(f"with {sql.POSTS} select seq, author, time_posted from posts")
def sorted_by_age(spark, sf_dir):
    posts = captures.posts(spark, sf_dir).select("seq", "author", "time_posted")
    return ordering.by_age(ordering.with_age(posts)).drop("age_minutes")


@query(f"with {sql.POSTS} select seq, page_id, {BY_SEQ} from posts")
def feed_order(spark, sf_dir):
    return number_rows(captures.posts(spark, sf_dir).select("seq", "page_id"), ["seq"])


@query(f"with {sql.POSTS} select seq, page_id from posts")
def checked_order(spark, sf_dir):
    """Posts in places that no two of them share."""
    return ordering.check_order(captures.posts(spark, sf_dir).select("seq", "page_id"))


# ---- filters ----------------------------------------------------------------------------------


@query(f"with {sql.POSTS} select seq, author, time_posted from posts where {RECENT_SQL}")
def recent_24h(spark, sf_dir):
    recent = filters.posted_within(captures.posts(spark, sf_dir), captures.latest(spark, sf_dir))
    return recent.select("seq", "author", "time_posted")


@query(
    f"with {sql.POSTS} select seq, time_posted from posts where {sql.minutes('time_posted')} <= 1440"
)
def recent_by_label(spark, sf_dir):
    return filters.labelled_within(captures.posts(spark, sf_dir)).select("seq", "time_posted")


@query(f"with {sql.POSTS} select seq, author, description from posts where {SEARCH_SQL}")
def keyword_posts(spark, sf_dir):
    posts = captures.posts(spark, sf_dir, text=True)
    return filters.matching(posts, SEARCH).select("seq", "author", "description")


@query(f"with {sql.POSTS} select seq, author, description from posts where {SEARCH_SQL}")
def keyword_posts_indexed(spark, sf_dir):
    """The same over posts that were stored and indexed in two rounds."""
    posts = captures.posts(spark, sf_dir, text=True).select("seq", "author", "description")
    index = SearchIndex(shared_folder(spark, "search"), posts.schema, as_they_lie=True)
    half = captures.rows_in(spark, sf_dir, "events") // 2
    index.add(posts.where(F.col("seq") < half), 0)
    index.add(posts.where(F.col("seq") >= half), 1)
    return index.search(spark, SEARCH).drop("round")


@query(f"with {sql.POSTS} select seq, author, kind from posts where kind = 'job'")
def content_type(spark, sf_dir):
    return filters.of_kind(captures.posts(spark, sf_dir), "job").select("seq", "author", "kind")


@query(f"with {sql.POSTS} select seq, author, trim(job_link) as job_link from posts where has_view_job")
def job_button(spark, sf_dir):
    posts = captures.posts(spark, sf_dir).where("has_view_job")
    return posts.select("seq", "author", fn.strip("job_link").alias("job_link"))


PARTIAL_SQL = (
    "case when event_type <> 'error' then author end as author, "
    "case when value >= 10 then time_posted end as time_posted"
)


def _partial_posts(spark, sf_dir):
    """Posts some of which lack the author or the time."""
    return captures.posts(spark, sf_dir).select(
        "page_id",
        "seq",
        F.when(F.col("event_type") != "error", F.col("author")).alias("author"),
        F.when(F.col("value") >= 10, F.col("time_posted")).alias("time_posted"),
    )


@query(
    f"with {sql.POSTS} select * from (select page_id, seq, {PARTIAL_SQL} from posts) "
    "where author is not null and time_posted is not null"
)
def required_fields(spark, sf_dir):
    checked = filters.check_required(_partial_posts(spark, sf_dir), ["author", "time_posted"])
    return filters.accepted(checked)


@query(
    f"with {sql.POSTS}, p as (select page_id, seq, {PARTIAL_SQL} from posts) "
    "select page_id, seq, concat('missing: ', concat_ws(', ', case when author is null then 'author' end, "
    "case when time_posted is null then 'time_posted' end)) as error "
    "from p where author is null or time_posted is null"
)
def error_report(spark, sf_dir):
    checked = filters.check_required(_partial_posts(spark, sf_dir), ["author", "time_posted"])
    return filters.rejected(checked, ["page_id", "seq"])


@query(
    f"with {sql.POSTS}, p as (select page_id, seq, {PARTIAL_SQL} from posts) "
    "select seq, coalesce(author, 'N/A') as author, coalesce(time_posted, 'N/A') as time_posted from p"
)
def defaults_na(spark, sf_dir):
    partial = _partial_posts(spark, sf_dir).drop("page_id")
    return branches.with_defaults(partial, ["author", "time_posted"])


# ---- the job branch ---------------------------------------------------------------------------


@query(
    f"with {sql.POSTS} select seq, case when has_view_job then trim(job_link) else description end "
    "as content from posts"
)
def job_or_post(spark, sf_dir):
    posts = captures.posts(spark, sf_dir, text=True)
    return branches.with_content(posts).select("seq", "content")


@query(
    f"with {sql.POSTS} select seq, content from (select seq, case when not has_view_job then null "
    "when value < 20 then '' else trim(job_link) end as content from posts) "
    "where content is not null and content <> ''"
)
def nonempty_content(spark, sf_dir):
    link = F.when(F.col("value") < 20, F.lit("")).otherwise(fn.strip("job_link"))
    posts = captures.posts(spark, sf_dir).withColumn(
        "content", F.when(F.col("has_view_job"), link)
    )
    return filters.non_empty(posts).select("seq", "content")


@query(
    f"with {sql.POSTS} select seq, author, trim(job_link) as content from posts where has_view_job "
    "union all select seq, author, time_posted as content from posts where not has_view_job"
)
def job_union(spark, sf_dir):
    posts = captures.posts(spark, sf_dir)
    job = posts.where("has_view_job").select("seq", "author", fn.strip("job_link").alias("content"))
    rest = posts.where("not has_view_job").select(
        F.col("time_posted").alias("content"), "seq", "author"
    )
    return branches.union_branches(job, rest)


@query(
    f"with {sql.POSTS} select seq, page_id, first_value(author) over (partition by page_id order by seq) "
    "as author from posts"
)
def page_scope_author(spark, sf_dir):
    posts = captures.posts(spark, sf_dir).select("seq", "page_id", "author")
    return branches.first_on_page(posts, ["author"], index="seq")


@query(f"with {sql.POSTS} select seq, author, kind from posts")
def union_pages(spark, sf_dir):
    posts = captures.posts(spark, sf_dir).select("seq", "author", "kind")
    return branches.union_branches(filters.of_kind(posts, "post"), filters.of_kind(posts, "job"))


# ---- first per link, counts -------------------------------------------------------------------

FIRST_SQL = "row_number() over (partition by post_link order by seq)"


@query(
    f"with {sql.POSTS} select seq, author, time_posted, post_link from posts qualify {FIRST_SQL} = 1"
)
def first_per_link(spark, sf_dir):
    posts = captures.posts(spark, sf_dir, link=True)
    return dedup.first_per_key(posts.select("seq", "author", "time_posted", "post_link"), "post_link")


@query(
    f"with {sql.POSTS}, h as (select post_link from posts where seq * 2 < (select count(*) from pages)) "
    "select seq, author, p.post_link from posts p anti join h on h.post_link = p.post_link "
    f"qualify row_number() over (partition by p.post_link order by seq) = 1"
)
def unseen_links(spark, sf_dir):
    posts = captures.posts(spark, sf_dir, link=True)
    # The links of the first posts; about half of all links come later.
    history = posts.where(F.col("seq") * 2 < captures.rows_in(spark, sf_dir, "pages"))
    return dedup.first_unseen(posts.select("seq", "author", "post_link"), history, "post_link")


#: Parts of the feed that are taken one after the other.
RUNS = 3
RUN_SQL = f"seq * {RUNS} // (select count(*) from events)"


@query(
    f"with {sql.POSTS} select {RUN_SQL} as run, seq, author, post_link from posts "
    f"qualify {FIRST_SQL} = 1"
)
def unseen_links_kept(spark, sf_dir):
    """Runs that keep the links they took, and leave out those of the runs before."""
    events = captures.rows_in(spark, sf_dir, "events")
    posts = captures.posts(spark, sf_dir, link=True).select("seq", "author", "post_link")
    folder = shared_folder(spark, "links")
    history = KeyHistory(spark, f"links_{folder.rsplit('-', 1)[1]}", folder, "post_link", buckets=8)
    taken = None
    for run in range(RUNS):
        part = posts.where(F.expr(f"seq * {RUNS} div {max(events, 1)}") == run)
        new = staged(history.unseen(part, run).select(F.lit(run).cast("long").alias("run"), *posts.columns), "unseen")
        history.add(new, run)
        taken = new if taken is None else branches.union_branches(taken, new)
    return taken


@query(f"with {sql.POSTS} select distinct post_link from posts")
def distinct_links(spark, sf_dir):
    return dedup.distinct_keys(captures.posts(spark, sf_dir, link=True), "post_link")


@query(
    f"with {sql.POSTS}, shown as (select 0 as round, * from posts union all select 1 as round, * from posts) "
    "select seq, author, round from shown qualify row_number() over (partition by seq order by round) = 1"
)
def rescan_first(spark, sf_dir):
    posts = captures.posts(spark, sf_dir).select("seq", "author")
    rounds = branches.union_branches(
        posts.withColumn("round", F.lit(0)), posts.withColumn("round", F.lit(1))
    )
    return dedup.first_per_key(rounds, "seq", "round")


@query(f"with {sql.POSTS} select page_id, count(*) as containers from posts group by page_id")
def container_count(spark, sf_dir):
    return counts.containers_per_page(captures.posts(spark, sf_dir))


@query(
    f"with {sql.POSTS} select author, seq, count(*) over (partition by author order by seq) as accepted "
    "from posts where event_type <> 'error'"
)
def running_count(spark, sf_dir):
    posts = captures.posts(spark, sf_dir).where("event_type <> 'error'").select("author", "seq")
    return counts.running_count(posts, by=("author",))


@query(
    f"with {sql.POSTS} select seq, count(*) over (order by seq) as accepted from posts "
    "where event_type <> 'error'"
)
def running_count_overall(spark, sf_dir):
    posts = captures.posts(spark, sf_dir).where("event_type <> 'error'").select("seq")
    return counts.running_count(posts)


# ---- caps -------------------------------------------------------------------------------------


@query(f"with {sql.POSTS} select seq, author, time_posted from posts order by seq limit 60")
def cap_posts(spark, sf_dir):
    return limits.cap(captures.posts(spark, sf_dir).select("seq", "author", "time_posted"), 60)


@query(
    f"with {sql.POSTS} select seq, author, time_posted, {BY_AGE} "
    "from (select * from posts order by seq limit 100)"
)
def cap_then_sort(spark, sf_dir):
    posts = captures.posts(spark, sf_dir).select("seq", "author", "time_posted")
    taken = ordering.with_age(limits.cap(posts, 100))
    return number_rows(taken, ["age_minutes", "seq"]).drop("age_minutes")


@query(
    f"with {sql.POSTS}, d as (select seq, author, batch from posts "
    "qualify row_number() over (partition by author order by seq) = 1), "
    "b as (select batch, count(*) as n from d group by batch), "
    "p as (select batch, coalesce(sum(n) over (order by batch rows between unbounded preceding "
    "and 1 preceding), 0) as before from b), "
    "x as (select d.*, row_number() over (order by d.seq) as pos from d join p on p.batch = d.batch "
    "where p.before < 5) select seq, author, batch from x where pos <= 60"
)
def soft_cap(spark, sf_dir):
    posts = captures.posts(spark, sf_dir).select("seq", "author", "batch")
    return limits.soft_cap(dedup.first_per_key(posts, "author"), soft=5, hard=60)


@query(
    f"with {sql.POSTS} select seq, author, time_posted from posts order by seq "
    "limit (select count(*) // 2 from events)"
)
def cap_large(spark, sf_dir):
    posts = captures.posts(spark, sf_dir).select("seq", "author", "time_posted")
    return limits.cap(posts, captures.rows_in(spark, sf_dir, "events") // 2)


@query(f"with {sql.POSTS} select seq, author, batch from posts where batch < 50")
def cap_rounds(spark, sf_dir):
    posts = captures.posts(spark, sf_dir).select("seq", "author", "batch")
    return limits.first_rounds(posts, 50, "batch")


# ---- pages and rounds -------------------------------------------------------------------------


@query(
    f"with {sql.JOBS} select feed, page_no, seq, job_title from jobs where page_no between 1 and 10"
)
def page_range(spark, sf_dir):
    cards = captures.job_cards(spark, sf_dir).select("feed", "page_no", "seq", "job_title")
    return paging.page_range(cards, 10)


@query(f"with {sql.JOBS} select feed, page_no, seq, job_title from ({sql.prefix('jobs', 'feed', 'page_no')})")
def page_prefix(spark, sf_dir):
    cards = captures.job_cards(spark, sf_dir).select("feed", "page_no", "seq", "job_title")
    return paging.page_prefix(cards)


@query(
    "with t as (select user_id, max(event_id) + 1 as next_seq from events "
    "where event_type = 'purchase' group by user_id) "
    "select e.user_id as feed, event_id as seq, event_type from events e left join t "
    "on t.user_id = e.user_id where next_seq is null or event_id >= next_seq"
)
def incremental_scan(spark, sf_dir):
    events = _read(spark, sf_dir, "events", "event_id", "user_id", "event_type").select(
        F.col("user_id").alias("feed"), F.col("event_id").alias("seq"), "event_type"
    )
    taken = events.where("event_type = 'purchase'")
    progress = taken.groupBy("feed").agg((F.max("seq") + 1).alias("next_seq"))
    return paging.new_since(events, progress)


@query(
    f"with {sql.JOBS} select feed, page_no, job_title, location, company_name from jobs "
    "where company_name is not null and page_no between 2 and 5"
)
def captured_jobs(spark, sf_dir):
    """Pages of a store, by a range of page numbers that chooses the files to open."""
    path, per_block = shared_folder(spark, "captures"), _pages_per_block(spark, sf_dir)
    _store_job_pages(spark, sf_dir, path, per_block)
    pages = store.captured(spark, path, per_block).where("kind = 'job' AND page_no BETWEEN 2 AND 5")
    return _stored_jobs(pages)


@query(
    f"with {sql.JOBS} select feed, page_no, job_title, location, company_name from jobs "
    "where company_name is not null"
)
def captured_jobs_followed(spark, sf_dir):
    """The same store as a stream, which is stopped and goes on where it was."""
    path, out, checkpoint = (shared_folder(spark, x) for x in ("captures", "followed", "checkpoint"))
    per_block = _pages_per_block(spark, sf_dir)
    # A block is written once, so the store stops at the end of one.
    for part in (F.col("page_no") < per_block, F.col("page_no") >= per_block):
        _store_job_pages(spark, sf_dir, path, per_block, part)
        stream.append_available(store.follow_captured(spark, path, per_block), out, checkpoint)
    return _stored_jobs(spark.read.schema(store.SCHEMA).parquet(out))


#: The fewest pages of a block, and the most blocks of a feed: each is a file, and longer feeds get larger ones.
PAGES_PER_BLOCK = 3
BLOCKS_PER_FEED = 40


def _pages_per_block(spark, sf_dir):
    last = captures.job_cards(spark, sf_dir).agg(F.max("page_no")).first()[0] or 0
    return max(PAGES_PER_BLOCK, last // BLOCKS_PER_FEED + 1)


def _store_job_pages(spark, sf_dir, path, per_block, part=None):
    pages = captures.job_pages(spark, sf_dir)
    pages = pages if part is None else pages.where(part)
    url = F.concat(F.lit(f"{captures.SITE}/jobs?page="), "page_no")
    store.write_captures(pages.withColumns({"kind": F.lit("job"), "url": url}), path, per_block)


def _stored_jobs(pages):
    cards = extract_cards(pages, src.JOB_CARD, keep=("feed", "page_no"))
    required = ["job_title", "location", "company_name"]
    return filters.accepted(filters.check_required(cards, required)).drop("container_idx")


def _rounds(spark, sf_dir):
    events = _read(spark, sf_dir, "events", "event_id", "user_id", "value")
    return events.select(
        F.col("user_id").alias("feed"),
        F.col("event_id").alias("round"),
        F.floor(F.col("value") / 10).cast("bigint").alias("height"),
    )


@query(f"with {sql.ROUNDS}, {sql.stagnant(1)} select feed, stop_round from stops")
def stagnation_stop(spark, sf_dir):
    return paging.stop_rounds(_rounds(spark, sf_dir), 1)


@query(f"with {sql.ROUNDS}, {sql.stagnant(2)} select feed, stop_round from stops")
def stagnation_stop_twice(spark, sf_dir):
    return paging.stop_rounds(_rounds(spark, sf_dir), 2)


@query(
    f"with {sql.ROUNDS}, {sql.stagnant(2)} select r.feed, round, height from rounds r "
    "left join stops s on s.feed = r.feed where stop_round is null or round <= stop_round"
)
def until_stagnant(spark, sf_dir):
    rounds = _rounds(spark, sf_dir)
    return paging.until_stopped(rounds, paging.stop_rounds(rounds, 2))


# ---- text -------------------------------------------------------------------------------------


@query(f"select page_id, {sql.page_text('html')} as text from pages")
def clean_text(spark, sf_dir):
    pages = _pages(spark, sf_dir, "page_id", "html")
    return fn.with_clean_text(pages, "html", "text").drop("html")


@query(f"select page_id, {sql.page_text_compact('html')} as text from pages")
def clean_text_compact(spark, sf_dir):
    pages = _pages(spark, sf_dir, "page_id", "html")
    return fn.with_clean_text(pages, "html", "text", compact=True).drop("html")


@query(f"select page_id, {sql.page_text('html')} as text from pages")
def clean_text_by_tree(spark, sf_dir):
    return _pages(spark, sf_dir, "page_id", "html").select(
        "page_id", fn.clean_html("html", "tree").alias("text")
    )


TITLE_SQL = "regexp_extract(html, '<title>(.*?)</title>', 1, 's')"


@query(f"select page_id, {sql.page_text(TITLE_SQL)} as title from pages")
def page_title(spark, sf_dir):
    return _pages(spark, sf_dir, "page_id", "html").select(
        "page_id", fn.title_text("html").alias("title")
    )


@query(
    f"select doc_id, {sql.squeezed('text')} as squeezed, {sql.stripped('text')} as stripped from documents"
)
def plain_spacing(spark, sf_dir):
    return _read(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", fn.squeeze("text").alias("squeezed"), fn.strip("text").alias("stripped")
    )


TAGGED_SQL = "(select doc_id, concat('#', lang, ' ', text, ' #', source, ' #', lang) as text from documents)"


def _tagged(spark, sf_dir):
    text = F.concat(F.lit("#"), "lang", F.lit(" "), "text", F.lit(" #"), "source", F.lit(" #"), "lang")
    documents = _read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return documents.select("doc_id", text.alias("text"))


@query(f"select doc_id, array_to_string({sql.tags('text')}, ' ') as tags from {TAGGED_SQL}")
def hashtags(spark, sf_dir):
    return _tagged(spark, sf_dir).select(
        "doc_id", F.array_join(fn.hashtags("text"), " ").alias("tags")
    )


@query(f"select doc_id, unnest({sql.tags('text')}) as tag from {TAGGED_SQL}")
def hashtag_rows(spark, sf_dir):
    return _tagged(spark, sf_dir).select("doc_id", F.explode(fn.hashtags("text")).alias("tag"))


MARKED_SQL = f"array_to_string(list_transform({sql.tags('text')}, lambda t: concat('#', t)), ' ')"


@query(
    f"select doc_id, trim(concat({sql.squeezed('text')}, ' ', {MARKED_SQL})) as formatted from {TAGGED_SQL}"
)
def format_description(spark, sf_dir):
    return _tagged(spark, sf_dir).select(
        "doc_id", fn.format_description("text").alias("formatted")
    )


# ---- links ------------------------------------------------------------------------------------

ITEM_SQL = "<li><a href=\"([^\"]*)\">([^<]*)</a></li>"
LINKS_SQL = (
    f"select page_id, unnest(regexp_extract_all(html, '{ITEM_SQL}', 1)) as href, "
    f"unnest(regexp_extract_all(html, '{ITEM_SQL}', 2)) as label from pages"
)


@query(LINKS_SQL)
def page_links(spark, sf_dir):
    links = F.inline(fn.list_item_links("html"))
    return _pages(spark, sf_dir, "page_id", "html").select("page_id", links)


@query(LINKS_SQL)
def page_links_extracted(spark, sf_dir):
    anchor = ((Match(tag="a", has_attr=("href",)),),)
    rule = CardRule(
        Match(tag="li"), {"href": Field(anchor, take="@href"), "label": Field(anchor)}
    )
    cards = extract_cards(_pages(spark, sf_dir, "page_id", "html"), rule)
    return filters.accepted(filters.check_required(cards, ["href"])).select("page_id", "href", "label")


@query(
    "select page_id, concat(regexp_extract(url, '^([a-z]+://[^/?#]+)', 1), "
    "regexp_extract(html, '<a href=\"([^\"]*)\"', 1)) as link from pages where html like '%<a href=%'"
)
def first_links(spark, sf_dir):
    pages = _pages(spark, sf_dir, "page_id", "url", "html")
    # In steps: the address names the link many times, and each would read the page again.
    linked = pages.select("page_id", "url", fn.first_href("html").alias("href"))
    return linked.select("page_id", fn.absolute_url("url", "href").alias("link")).where("link is not null")


# ---- extraction -------------------------------------------------------------------------------

DESCRIPTION_SQL = sql.squeezed("description")


def _feed_cards(spark, sf_dir, rule, mark="class"):
    pages = captures.feed_pages(spark, sf_dir, mark).where(may_hold(v.POST_CONTAINER))
    cards = extract_cards(pages, rule, keep=("page_id", "url"))
    per_page = F.col("page_id") * captures.CARDS_PER_PAGE + F.col("container_idx")
    return cards.withColumn("seq", per_page)


def _card_table(spark, sf_dir, rule, mark="class"):
    """The extracted cards as a written table, which the jobs start from."""
    return staged(_feed_cards(spark, sf_dir, rule, mark), "cards", compression="zstd")


@query(
    f"with {sql.POSTS} select page_id, seq % 25 as container_idx, author, {DESCRIPTION_SQL} as description, "
    "rtrim(time_posted) as time_posted, post_link, kind from posts"
)
def extract_posts(spark, sf_dir):
    return _feed_cards(spark, sf_dir, src.POST_CARD).select(
        "page_id",
        F.col("container_idx").cast("bigint").alias("container_idx"),
        "author",
        "description",
        "time_posted",
        "post_link",
        "kind",
    )


@query(
    f"with {sql.POSTS} select page_id, seq % 25 as container_idx, author, {DESCRIPTION_SQL} as description, "
    "rtrim(time_posted) as time_posted, post_link, kind from posts"
)
def extract_posts_sql(spark, sf_dir):
    """Extraction from SQL: pages go into a table function as a table."""
    pages = captures.feed_pages(spark, sf_dir).where(may_hold(v.POST_CONTAINER))
    pages.createOrReplaceTempView("captured_feed")
    keep = T.StructType([T.StructField("page_id", T.LongType())])
    spark.udtf.register("post_cards", card_function(src.POST_CARD, keep))
    return spark.sql(
        "SELECT page_id, CAST(container_idx AS BIGINT) AS container_idx, author, description, time_posted, "
        "post_link, kind FROM post_cards(TABLE(SELECT page_id, html FROM captured_feed))"
    )


@query(f"with {sql.POSTS} select page_id, author, rtrim(time_posted) as time_posted, {BY_AGE} from posts")
def posts_by_age_from_pages(spark, sf_dir):
    pages = captures.feed_pages(spark, sf_dir).where(may_hold(v.POST_CONTAINER))
    # Written first: putting rows in order reads its input twice.
    cards = extract_cards(pages, src.POST_CARD).withColumn("seq", ordering.feed_position())
    cards = staged(cards.select("page_id", "seq", "author", "time_posted"), "cards")
    aged = ordering.with_age(cards).select("page_id", "seq", "author", "time_posted", "age_minutes")
    return number_rows(aged, ["age_minutes", "seq"]).drop("age_minutes", "seq")


@query(
    f"with {sql.POSTS}, shown as (select r.round, posts.* from posts cross join (select unnest([0, 1]) as round) r) "
    "select round, page_id, author, row_number() over (order by round, page_id, seq) - 1 as position from shown"
)
def order_over_rounds(spark, sf_dir):
    pages = captures.feed_pages(spark, sf_dir).where(may_hold(v.POST_CONTAINER))
    rounds = pages.withColumn("round", F.explode(F.array(F.lit(0), F.lit(1))))
    cards = extract_cards(rounds, src.POST_CARD, keep=("round", "page_id"))
    cards = staged(cards.select("round", "page_id", "container_idx", "author"), "cards")
    placed = cards.withColumn("seq", ordering.feed_position("round", "page_id", "container_idx"))
    return number_rows(placed.select("round", "page_id", "author", "seq"), ["seq"]).drop("seq")


@query(f"with {sql.POSTS} select page_id, seq, {DESCRIPTION_SQL} as description from posts")
def extract_then_clean(spark, sf_dir):
    cards = _feed_cards(spark, sf_dir, src.POST_HTML_CARD)
    cleaned = fn.with_clean_text(cards, "description_html", "description")
    return cleaned.select("page_id", "seq", "description")


@query(
    f"with {sql.POSTS} select page_id, seq, author, {DESCRIPTION_SQL} as description, "
    f"concat(rtrim(time_posted), ' {captures.AGO}') as time_line, post_link, has_view_job, "
    "case when has_view_job then trim(job_link) end as job_link from posts"
)
def extract_job_branch(spark, sf_dir):
    cards = _feed_cards(spark, sf_dir, src.JOB_BRANCH_CARD)
    return cards.select(
        "page_id",
        "seq",
        "author",
        F.regexp_replace("description", f" {v.HIDDEN_LABEL}$", "").alias("description"),
        "time_line",
        "post_link",
        "has_view_job",
        fn.strip("job_link").alias("job_link"),
    )


@query(
    f"with {sql.POSTS} select page_id, seq, author, concat('{captures.SITE}', profile_href) as profile_link "
    "from posts"
)
def extract_profiles(spark, sf_dir):
    cards = _feed_cards(spark, sf_dir, src.PROFILE_CARD, mark="id")
    return cards.select(
        "page_id", "seq", "author", fn.absolute_url("url", "first_href").alias("profile_link")
    )


@query(
    f"with {sql.JOBS} select feed, page_no, job_title, location, company_name from jobs "
    "where company_name is not null"
)
def extract_jobs(spark, sf_dir):
    cards = extract_cards(captures.job_pages(spark, sf_dir), src.JOB_CARD, keep=("feed", "page_no"))
    complete = filters.accepted(
        filters.check_required(cards, ["job_title", "location", "company_name"])
    )
    return complete.drop("container_idx")


@query(
    f"with {sql.JOBS} select feed, page_no, job_title, location, company_name from jobs "
    "where company_name is not null"
)
def extract_unclosed_jobs(spark, sf_dir):
    """The same cards without end tags of items and paragraphs."""
    pages = captures.job_pages(spark, sf_dir).withColumn("html", F.regexp_replace("html", "</li>", "<p>"))
    cards = extract_cards(pages, src.JOB_CARD, keep=("feed", "page_no"))
    complete = filters.accepted(
        filters.check_required(cards, ["job_title", "location", "company_name"])
    )
    return complete.drop("container_idx")


@query(
    "select event_id as seq, concat('/in/', user_id, case when event_id % 3 = 2 then '?a=1&b=2' else '' end) as href "
    "from events"
)
def odd_links(spark, sf_dir):
    """First links that are unquoted, after a comment with another, or written with references."""
    to = F.concat(F.lit("/in/"), "user_id")
    html = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("<p>it's <a href="), to, F.lit(">x</a>")))
        .when(
            F.col("event_id") % 3 == 1,
            F.concat(F.lit('<!-- <a href="/hidden"> --><b title="1>0"></b><a href="'), to, F.lit('">x</a>')),
        )
        .otherwise(F.concat(F.lit('<a data-x="1" href="'), to, F.lit('?a=1&#38;b=2">x</a>')))
    )
    events = _read(spark, sf_dir, "events", "event_id", "user_id")
    return events.select(F.col("event_id").alias("seq"), fn.first_href(html).alias("href"))


HEADLINE_SQL = "regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')"


@query(
    f"select page_id, {sql.page_text(HEADLINE_SQL)} as headline, "
    "regexp_extract(html, 'lang=\"([a-z]*)\"', 1) as lang, contains(html, 'class=\"ad\"') as has_ad from pages"
)
def extract_articles(spark, sf_dir):
    rule = CardRule(
        Match(tag="html"),
        {
            "headline": Field(((Match(tag="article"), Match(tag="h1")),)),
            "lang": Field((), take="@lang"),
            "has_ad": Field(((Match(tag="div", css_class="ad"),),), take="exists"),
        },
    )
    cards = extract_cards(_pages(spark, sf_dir, "page_id", "html"), rule)
    return cards.select("page_id", "headline", "lang", "has_ad")


# ---- sinks ------------------------------------------------------------------------------------

POST_TABLE_SQL = (
    f"with {sql.POSTS} select author as \"Author\", {DESCRIPTION_SQL} as \"Description\", "
    "time_posted as \"Time Posted\", post_link as \"Post Link\" from posts"
)


def _post_table(spark, sf_dir):
    posts = captures.posts(spark, sf_dir, text=True, link=True)
    return posts.withColumn("description", fn.squeeze("description"))


@query(POST_TABLE_SQL)
def post_table(spark, sf_dir):
    return export.shown(_post_table(spark, sf_dir), v.POST)


@query(POST_TABLE_SQL)
def export_csv(spark, sf_dir):
    path = shared_folder(spark, "export-csv")
    # Ordering reads its input twice and moves all of it, so texts are packed until they are in order.
    posts = ordering.in_feed_order(captures.posts(spark, sf_dir, text=True, link=True, packed=True))
    plain = posts.withColumn("description", fn.squeeze(fn.unpacked("description")))
    export.export(export.shown(plain, v.POST), path, compression="gzip")
    return export.read_export(spark, path, v.POST)


@query(
    "select l.p_name as \"Job Title\", l.p_brand as \"Location\", l.p_type as \"Company_Name\", "
    "n.name as \"Export\" from part l cross join (select unnest(['job.parquet', 'job(1).parquet']) as name) n "
    "where l.p_type <> 'ECONOMY'"
)
def export_versioned(spark, sf_dir):
    base = f"{shared_folder(spark, 'export-versioned')}/job"
    listed = export.shown(captures.job_cards(spark, sf_dir).where("company_name is not null"), v.JOB)
    out = None
    for _ in range(2):
        path = export.export_versioned(listed, base, ".parquet")
        written = export.read_export(spark, path, v.JOB, "parquet")
        named = written.withColumn("Export", F.lit(path.rsplit("/", 1)[1]))
        out = named if out is None else branches.union_branches(out, named)
    return out


@query(f"with {sql.POSTS} select count(*) as rows from posts where kind = 'post'")
def row_count_report(spark, sf_dir):
    posts = filters.of_kind(captures.posts(spark, sf_dir), "post").select("seq", "author")
    counted, observation = counts.with_row_count(posts)
    export.export(counted, shared_folder(spark, "row-count"), "parquet")
    return spark.createDataFrame([(observation.get["rows"],)], "rows bigint")


# ---- streams ----------------------------------------------------------------------------------

#: Records in a file of a feed, and the least and most files. A round costs a task result for each
#: shuffle partition, so a larger feed comes in larger files, not in more rounds.
FILE_ROWS = 50_000
FEED_FILES = 8
MOST_FILES = 32
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("posted_at", T.TimestampType()),
    ]
)


def _followed(spark, sf_dir):
    """Lay the events down as the files of a growing feed, and follow them two by two."""
    path = shared_folder(spark, "feed")
    events = _read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts")
    columns = ["event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("posted_at")]
    files = min(MOST_FILES, max(FEED_FILES, captures.rows_in(spark, sf_dir, "events") // FILE_ROWS))
    events.select(*columns).repartition(files, "event_id").write.parquet(path)
    return stream.read_feed(spark, path, EVENTS, files_per_round=2)


@query("select event_id, user_id, event_type from events")
def stream_append(spark, sf_dir):
    out, checkpoint = shared_folder(spark, "appended"), shared_folder(spark, "checkpoint")
    followed = _followed(spark, sf_dir).drop("posted_at")
    stream.append_available(followed, out, checkpoint)
    return spark.read.parquet(out)


@query("select distinct user_id from events")
def stream_dedup(spark, sf_dir):
    out, checkpoint = shared_folder(spark, "deduped"), shared_folder(spark, "checkpoint")
    once = stream.drop_seen(_followed(spark, sf_dir), "user_id", "event_id")
    stream.append_available(once, out, checkpoint)
    return spark.read.parquet(out).select("user_id")


@query("select distinct user_id, cast(1 as bigint) as firsts from events")
def stream_first_seen(spark, sf_dir):
    out, checkpoint = shared_folder(spark, "first-seen"), shared_folder(spark, "checkpoint")
    followed = _followed(spark, sf_dir)
    stream.write_rounds(followed, stream.FirstSeen(out, "user_id", "event_id"), checkpoint)
    rows = stream.read_rounds(spark, out, EVENTS)
    return rows.groupBy("user_id").agg(F.count("*").alias("firsts"))


@query("select event_id, user_id, event_type from events")
def stream_stop_and_resume(spark, sf_dir):
    out, checkpoint = shared_folder(spark, "rounds"), shared_folder(spark, "checkpoint")
    followed = _followed(spark, sf_dir)

    def write(records, round_no):
        records.write.mode("overwrite").parquet(stream.round_folder(out, round_no))

    stream.write_rounds(followed, write, checkpoint, rounds=2)
    stream.write_rounds(followed, write, checkpoint)
    return stream.read_rounds(spark, out, EVENTS).select("event_id", "user_id", "event_type")


@query(
    "select event_id, case when event_type = 'error' then 'missing: event_type' end as error from events"
)
def stream_quarantine(spark, sf_dir):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    followed = _followed(spark, sf_dir).withColumn("event_type", kind)
    sink = stream.Quarantine(shared_folder(spark, "checked"), ("event_type",), ("event_id",))
    stream.write_rounds(followed, sink, shared_folder(spark, "checkpoint"))
    passed = sink.accepted(spark, EVENTS).select("event_id", F.lit(None).cast("string").alias("error"))
    return passed.unionByName(sink.rejected(spark, EVENTS))


@query(
    f"with {sql.POSTS} select page_id, seq % 25 as container_idx, author, {DESCRIPTION_SQL} as description, "
    "rtrim(time_posted) as time_posted, post_link from posts"
)
def stream_extract(spark, sf_dir):
    path = shared_folder(spark, "captured")
    # In small row groups, by as many tasks as put them together.
    captures.feed_pages(spark, sf_dir).write.options(**PAGE_GROUPS).parquet(path, compression="zstd")
    files = len(spark.read.schema(v.CAPTURED_PAGES).parquet(path).inputFiles())
    pages = stream.read_feed(spark, path, v.CAPTURED_PAGES, files_per_round=-(-files // 2))
    cards = extract_cards(pages.where(may_hold(v.POST_CONTAINER)), src.POST_CARD)
    required, keys = ("author", "post_link"), ("page_id", "container_idx")
    sink = stream.Quarantine(shared_folder(spark, "checked"), required, keys)
    stream.write_rounds(cards, sink, shared_folder(spark, "checkpoint"))
    written = sink.accepted(spark, cards.schema).drop("round", "kind")
    return written.withColumn("container_idx", F.col("container_idx").cast("bigint"))


#: Rounds of a feed that comes in order, and the files of each.
ROUNDS = 6
ROUND_FILES = 2
#: Captured pages of a feed for each file of a round.
FILE_PAGES = 5_000
ROUND_SQL = f"event_id * {ROUNDS} // (select max(event_id) + 1 from events)"


def _in_rounds(spark, sf_dir, records):
    """Lay records with an ``event_id`` down round by round, and follow them a round at a time."""
    path = shared_folder(spark, "rounds-of-feed")
    last = _read(spark, sf_dir, "events", "event_id").agg(F.max("event_id")).first()[0] or 0
    for i in range(ROUNDS):
        part = records.where(F.expr(f"event_id * {ROUNDS} div {last + 1}") == i)
        part.repartition(ROUND_FILES).write.mode("append").parquet(path)
    return stream.read_feed(spark, path, records.schema, files_per_round=ROUND_FILES)


@query(
    "select event_id, user_id, event_type from events order by event_id "
    "limit (select count(*) // 2 + 7 from events)"
)
def stream_row_cap(spark, sf_dir):
    """A feed that is cut after so many records, over rounds, a stop and a restart."""
    events = _read(spark, sf_dir, "events", "event_id", "user_id", "event_type")
    followed = _in_rounds(spark, sf_dir, events)
    n = captures.rows_in(spark, sf_dir, "events") // 2 + 7
    sink, checkpoint = stops.RowCap(shared_folder(spark, "capped"), n, "event_id"), shared_folder(spark, "checkpoint")
    stream.write_rounds(followed, sink, checkpoint, rounds=2, stop=sink.done)
    stream.write_rounds(followed, sink, checkpoint, stop=sink.done)
    return sink.records(spark, events.schema).drop("round")


STILL_SQL = f"""
  e as (select event_id, event_type as feed, user_id % 7 as u, {ROUND_SQL} as round from events),
  firsts as (select feed, u, min(round) as round from e group by feed, u),
  rounds as (select r.feed, r.round, count(f.u) as height from (select distinct feed, round from e) r
    join firsts f on f.feed = r.feed and f.round <= r.round group by r.feed, r.round)"""


@query(
    f"with {STILL_SQL}, {sql.stagnant(2)} select e.feed, e.round, event_id, height from e "
    "join rounds r on r.feed = e.feed and r.round = e.round left join stops s on s.feed = e.feed "
    "where stop_round is null or e.round <= stop_round"
)
def stream_until_stagnant(spark, sf_dir):
    """Feeds that end when nothing new shows up in two rounds; the height counts who was seen."""
    last = _read(spark, sf_dir, "events", "event_id").agg(F.max("event_id")).first()[0] or 0
    events = _read(spark, sf_dir, "events", "event_id", "user_id", "event_type").select(
        F.col("event_type").alias("feed"),
        F.expr(f"event_id * {ROUNDS} div {last + 1}").alias("round"),
        (F.col("user_id") % 7).alias("u"),
        "event_id",
    )
    firsts = events.groupBy("feed", "u").agg(F.min("round").alias("first"))
    shown = events.select("feed", "round").distinct()
    heights = (
        shown.join(firsts, "feed").where("first <= round").groupBy("feed", "round").agg(F.count("*").alias("height"))
    )
    records = events.drop("u").join(heights, ["feed", "round"])
    followed = _in_rounds(spark, sf_dir, records)
    out = shared_folder(spark, "until-stagnant")

    def write(kept, round_no):
        kept.write.mode("overwrite").parquet(stream.round_folder(out, round_no))

    sink = stops.StandStill(shared_folder(spark, "heights"), write, after=2)
    stream.write_rounds(followed.withColumnRenamed("round", "shown"), sink, shared_folder(spark, "checkpoint"), stop=sink.done)
    schema = followed.withColumnRenamed("round", "shown").schema
    return stream.read_rounds(spark, out, schema).select("feed", F.col("shown").alias("round"), "event_id", "height")


@query("select user_id, min(event_id) as event_id from events group by user_id")
def stream_first_in_state(spark, sf_dir):
    """The first event of each user, from a feed whose files come in any order."""
    out, checkpoint = shared_folder(spark, "first-in-state"), shared_folder(spark, "checkpoint")
    followed = _followed(spark, sf_dir).select("user_id", "event_id")
    stream.append_available(keyed.first_in_state(followed, "user_id", "event_id"), out, checkpoint)
    return keyed.settled(spark.read.schema(followed.schema).parquet(out), "user_id", "event_id")


@query(f"with {sql.JOBS} select feed, page_no, seq, job_title from ({sql.prefix('jobs', 'feed', 'page_no')})")
def stream_page_prefix(spark, sf_dir):
    """Pages that arrive out of order and are released when the gap before them closes."""
    path, out = shared_folder(spark, "arriving"), shared_folder(spark, "released")
    cards = captures.job_cards(spark, sf_dir).select("feed", "page_no", "seq", "job_title")
    for i in (1, 0, 2):
        cards.where(F.col("page_no") % 3 == i).repartition(ROUND_FILES).write.mode("append").parquet(path)

    def write(released, round_no):
        released.write.mode("overwrite").parquet(stream.round_folder(out, round_no))

    sink = stops.PagePrefix(shared_folder(spark, "held"), write)
    followed = stream.read_feed(spark, path, cards.schema, files_per_round=ROUND_FILES)
    stream.write_rounds(followed, sink, shared_folder(spark, "checkpoint"))
    return stream.read_rounds(spark, out, cards.schema).drop("round")


@query(
    f"select {ROUND_SQL} as round, count(*) filter (where event_type <> 'error') as accepted, "
    "count(*) filter (where event_type = 'error') as rejected from events group by 1"
)
def stream_report(spark, sf_dir):
    """How many records each round took and left out, as its stream reported them."""
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    events = _read(spark, sf_dir, "events", "event_id", "event_type").withColumn("event_type", kind)
    checked = filters.check_required(_in_rounds(spark, sf_dir, events), ("event_type",))
    with reports.RoundReport(spark) as report:
        stream.append_available(
            reports.counted(checked), shared_folder(spark, "reported"), shared_folder(spark, "checkpoint")
        )
    return report.table()


#: The page behind a job button.
JOB_PAGE = CardRule(Match(css_class="job"), {"job_description": Field(((Match(tag="h1"),),))})

# ---- whole jobs -------------------------------------------------------------------------------


def _cards(spark, sf_dir, rule=src.POST_CARD, search=None, rounds=None):
    """Cards taken from captured pages, with the round that showed them.

    All cards are taken; those that the search or the number of rounds leaves out are not written.
    """
    round_of = F.expr(f"seq div {captures.CARDS_PER_ROUND}")
    cards = _feed_cards(spark, sf_dir, rule).withColumn("round", round_of)
    if rounds is not None:
        cards = limits.first_rounds(cards, rounds)
    if search is not None:
        cards = search.on_text(search.before_text(cards))
    return staged(cards, "cards", compression="zstd")


#: What a job shows of a post: cleaned text, and the age without the spaces around it.
SHOWN_SQL = (
    f"author, {DESCRIPTION_SQL} as description, rtrim(time_posted) as time_posted, post_link, seq"
)
AGE_SQL = f"{sql.minutes('time_posted')} <= 1440"


@query(
    f"with {sql.POSTS} select {SHOWN_SQL}, {BY_AGE} from posts where {SEARCH_SQL} and {AGE_SQL} and kind = 'post'"
)
def recent_posts_sorted(spark, sf_dir):
    search = jobs.Search(query=SEARCH, kind="post", hours=24)
    found = jobs.recent_posts_sorted(_cards(spark, sf_dir, search=search), search, numbered=True)
    path = export.export_versioned(found, f"{shared_folder(spark, 'recent')}/file", ".parquet")
    return spark.read.schema(found.schema).parquet(path)


@query(
    f"with {sql.POSTS} select {SHOWN_SQL}, {BY_AGE} from (select * from posts where kind = 'post' "
    "and batch < 110 order by seq limit 100)"
)
def capped_posts_sorted(spark, sf_dir):
    search, rounds = jobs.Search(kind="post"), 110
    cards = _cards(spark, sf_dir, search=search, rounds=rounds)
    return jobs.capped_posts_sorted(cards, search, posts=100, rounds=rounds, numbered=True)


@query(
    f"with {sql.POSTS} select {SHOWN_SQL}, {BY_SEQ} from posts where kind = 'post' and {SEARCH_SQL}"
)
def all_posts(spark, sf_dir):
    search = jobs.Search(query=SEARCH, kind="post")
    return jobs.all_posts(_cards(spark, sf_dir, search=search), search, numbered=True)


@query(
    f"with {sql.POSTS} select {SHOWN_SQL}, {BY_SEQ} from posts where kind = 'post' and {SEARCH_SQL}"
)
def all_posts_followed(spark, sf_dir):
    """The same from pages that are captured round by round: extracted, checked, and then the job.

    The last round shows nothing new, where the feed ends; what is incomplete goes to the quarantine.
    """
    path = shared_folder(spark, "captured")
    # Put together once, not for each round.
    made = staged(captures.feed_pages(spark, sf_dir), "pages", compression="zstd", groups=PAGE_GROUPS)
    pages = made.withColumns({"feed": F.lit("search"), "height": F.col("page_id")})
    last = made.agg(F.max("page_id")).first()[0] or 0
    files = min(FEED_FILES, max(ROUND_FILES, made.count() // FILE_PAGES))

    def lay_down(part, n):
        # A few pages are dealt out, so that no file goes without. Many stay where they are: that spares the shuffle of
        # all of them, and the sort that evens it out.
        laid = part.repartition(n) if files == ROUND_FILES else part.coalesce(n)
        laid.write.mode("append").options(**PAGE_GROUPS).parquet(path, compression="zstd")

    for i in range(ROUNDS):
        lay_down(pages.where(F.expr(f"page_id * {ROUNDS} div {last + 1}") == i), files)
    for _ in range(2):
        lay_down(pages.where(F.col("page_id") == last), 1)
    required, keys = ("author", "post_link"), ("page_id", "container_idx")
    checked = stream.Quarantine(shared_folder(spark, "checked"), required, keys)
    schema = None

    def extract(kept, round_no):
        nonlocal schema
        cards = extract_cards(kept.where(may_hold(v.POST_CONTAINER)), src.POST_CARD)
        schema = cards.schema
        checked(cards, round_no)

    sink = stops.StandStill(shared_folder(spark, "heights"), extract, after=1)
    followed = stream.read_feed(spark, path, pages.schema, files_per_round=files)
    stream.write_rounds(followed, sink, shared_folder(spark, "checkpoint"), stop=sink.done)
    per_page = F.col("page_id") * captures.CARDS_PER_PAGE + F.col("container_idx")
    cards = checked.accepted(spark, schema).withColumn("seq", per_page)
    # The round that showed nothing new has shown a page again.
    return jobs.all_posts(dedup.first_long_per_key(cards, "seq", "round"), jobs.Search(query=SEARCH, kind="post"), numbered=True)


@query(
    f"with {sql.POSTS} select {SHOWN_SQL}, {BY_AGE} from posts where kind = 'post' and {AGE_SQL}"
)
def all_posts_sorted(spark, sf_dir):
    search = jobs.Search(kind="post", hours=24)
    return jobs.all_posts_sorted(_cards(spark, sf_dir, search=search), search, numbered=True)


@query(
    f"with {sql.POSTS}, d as (select author, concat({sql.stripped('description')}, 'hashtag') as description, "
    "rtrim(time_posted) as time_posted, post_link, seq from posts "
    f"qualify {FIRST_SQL} = 1) select *, {BY_SEQ} from d"
)
def all_posts_compact(spark, sf_dir):
    cards = _card_table(spark, sf_dir, src.COMPACT_POST_CARD)
    return jobs.all_posts_compact(cards, numbered=True)


@query(
    f"with {sql.POSTS}, d as (select author, concat({sql.stripped('description')}, 'hashtag') as description, "
    f"rtrim(time_posted) as time_posted, post_link, seq from posts where kind = 'post' and {AGE_SQL} and {SEARCH_SQL} "
    f"qualify {FIRST_SQL} = 1) select author, description, time_posted, post_link, {BY_SEQ} from d"
)
def all_posts_compact_rounds(spark, sf_dir):
    """A search whose rounds each show the whole feed again, written under a free name."""
    search = jobs.Search(query=SEARCH, kind="post", hours=24)
    shown = _cards(spark, sf_dir, src.COMPACT_POST_CARD, search).drop("round")
    # The second round shows the first page once more, in another place.
    rounds = shown.withColumn("round", F.explode(F.array(F.lit(0), F.lit(1))))
    placed = rounds.withColumn("seq", ordering.feed_position("round", "seq"))
    found = jobs.all_posts_compact(placed, search, numbered=True).drop("seq")
    path = export.export_versioned(found, f"{shared_folder(spark, 'compact')}/file", ".parquet")
    return spark.read.schema(found.schema).parquet(path)


@query(
    f"with {sql.POSTS} select {SHOWN_SQL} from posts where {SEARCH_SQL} and batch < 70 order by seq limit 60"
)
def capped_posts(spark, sf_dir):
    search, rounds = jobs.Search(query=SEARCH), 70
    return jobs.capped_posts(_cards(spark, sf_dir, search=search, rounds=rounds), search, rounds=rounds)


@query(f"with {sql.POSTS} select page_id, count(*) as containers from posts group by page_id")
def post_counts(spark, sf_dir):
    return jobs.page_counts(_card_table(spark, sf_dir, src.LINK_CARD))


#: Markup that no reader accepts.
BROKEN = "<![broken"


@query(
    f"with {sql.POSTS} select page_id, cast(-1 as bigint) as container_idx, 'AssertionError' as error from posts "
    "where page_id % 10 = 3 group by page_id "
    "union all select page_id, seq % 25, 'missing: time_posted' from posts where page_id % 10 <> 3 and value < 10"
)
def job_errors(spark, sf_dir):
    pages = captures.feed_pages(spark, sf_dir)
    html = F.when(F.col("page_id") % 10 == 3, F.concat(F.lit(BROKEN), "html")).otherwise(F.col("html"))
    cards = extract_cards(pages.withColumn("html", html), src.POST_CARD).withColumn(
        "seq", F.col("page_id") * captures.CARDS_PER_PAGE + F.col("container_idx")
    )
    values = captures.posts(spark, sf_dir).select(
        F.col("page_id").alias("of_page"), (F.col("seq") % captures.CARDS_PER_PAGE).alias("at"), "value"
    )
    there = (F.col("page_id") == F.col("of_page")) & (F.col("container_idx") == F.col("at"))
    # Cards meet the values without their texts: how often each is found with its time, and how often without.
    kept, timed = in_place(cards, "cards"), F.coalesce(F.col("value") >= 10, F.lit(False))
    met = kept.select(PLACE, "page_id", "container_idx").join(values, there, "left")
    met = met.groupBy(PLACE).agg(F.count_if(timed).alias("timed"), F.count_if(~timed).alias("untimed"))
    times = F.concat(F.array_repeat(F.lit(True), F.col("timed").cast("int")), F.array_repeat(F.lit(False), F.col("untimed").cast("int")))
    partial = (
        brought(kept, met, ["timed", "untimed"])
        .withColumn("timed", F.explode(times))
        .withColumn("time_posted", F.when(F.col("timed"), F.col("time_posted")))
    )
    # A page that was not read has no containers.
    left_out = jobs.incomplete(partial, v.POST).withColumn(
        "container_idx", F.coalesce("container_idx", F.lit(-1)).cast("bigint")
    )
    found = jobs.all_posts(partial, numbered=True)
    _, errors = export.export_with_errors(found, left_out, f"{shared_folder(spark, 'job')}/file", ".parquet", "zstd")
    return spark.read.schema(left_out.schema).parquet(errors)


@query(f"with {sql.POSTS} select author as \"Author\", description as \"Description\", time_posted as \"Time Posted\", "
       "post_link as \"Post Link\" from posts where author = 'nobody'")
def empty_feed(spark, sf_dir):
    none = captures.posts(spark, sf_dir, text=True, link=True).where("author = 'nobody'")
    path = shared_folder(spark, "empty")
    export.export(export.shown(jobs.all_posts(none), v.POST), path)
    return export.read_export(spark, path, v.POST)


@query(f"with {sql.POSTS} select post_link, seq, {BY_SEQ} from posts")
def post_links(spark, sf_dir):
    return jobs.post_links(_card_table(spark, sf_dir, src.LINK_CARD), numbered=True)


@query(
    f"with {sql.POSTS}, d as (select author, concat({DESCRIPTION_SQL}, ' hashtag') as description, "
    f"rtrim(time_posted) as time_posted, concat('{captures.SITE}', profile_href) as profile_link, seq, batch "
    "from posts qualify row_number() over (partition by profile_href order by seq) = 1), "
    "x as (select *, rank() over (order by batch) - 1 as before, row_number() over (order by seq) as pos "
    "from d) select author, description, time_posted, profile_link, seq from x where before < 5 and pos <= 60"
)
def profile_posts(spark, sf_dir):
    cards = _card_table(spark, sf_dir, src.PROFILE_CARD, mark="id")
    batch = F.expr(f"seq div {captures.CARDS_PER_ROUND}")
    return jobs.profile_posts(cards.withColumn("batch", batch))


@query(
    f"with {sql.POSTS}, d as (select author, case when has_view_job then concat('Job of ', author) "
    f"else concat({DESCRIPTION_SQL}, ' hashtag') end as description, rtrim(time_posted) as time_posted, "
    "post_link, seq from posts "
    f"where batch < 50 order by seq limit 50) select *, {BY_AGE} from d"
)
def posts_with_job_branch(spark, sf_dir):
    rounds = 50
    cards = _cards(spark, sf_dir, src.JOB_BRANCH_CARD, rounds=rounds)
    # The pages behind the buttons, captured by their link.
    job_pages = captures.posts(spark, sf_dir).where("has_view_job").select(
        fn.strip("job_link").alias("page_link"),
        F.concat(F.lit('<div class="job"><h1>Job of '), "author", F.lit("</h1></div>")).alias("html"),
    )
    described = extract_cards(job_pages, JOB_PAGE, keep=("page_link",))
    joined = cards.join(
        described.select("page_link", "job_description"),
        fn.strip("job_link") == F.col("page_link"),
        "left",
    )
    return jobs.posts_with_job_branch(joined, rounds=rounds, numbered=True)


@query(
    f"with {sql.POSTS} select author, post_link, concat(rtrim(time_posted), ' {captures.AGO}') as time_posted, "
    f"case when has_view_job then trim(job_link) else concat({DESCRIPTION_SQL}, ' hashtag') end as content, seq "
    "from posts order by seq limit 20"
)
def job_or_post_content(spark, sf_dir):
    rounds = 50
    return jobs.job_or_post_content(_cards(spark, sf_dir, src.JOB_BRANCH_CARD, rounds=rounds), rounds=rounds)


@query(
    f"with {sql.JOBS} select feed, page_no, job_title, location, company_name "
    f"from ({sql.prefix('jobs', 'feed', 'page_no')}) where company_name is not null and contains(job_title, 'red')"
)
def job_listings(spark, sf_dir):
    pages = captures.job_pages(spark, sf_dir)
    return jobs.job_listings(pages, last=None, query="red").drop("container_idx")
