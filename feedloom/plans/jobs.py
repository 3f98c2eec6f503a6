"""The whole jobs: from captured pages or card tables to an ordered table.

The post jobs take ``cards``, records of :func:`feedloom.operators.extract.extract_cards` or a
table like it, with ``seq`` for the feed order. Sorting and numbering read their input twice, so
write extracted cards to a table first (:func:`feedloom.session.staged`).

The columns of a result are internal names; write it with :func:`feedloom.sinks.export.shown` and
the matching column list of the vocabulary. With ``numbered`` a result carries its ``position``
instead of being sorted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import vocabulary as v
from feedloom.functions.links import absolute_url
from feedloom.functions.markup import with_clean_text
from feedloom.operators.branches import job_or_post, with_content, with_defaults
from feedloom.operators.counts import containers_per_page
from feedloom.operators.dedup import first_long_per_key, first_per_key
from feedloom.operators.extract import extract_cards
from feedloom.operators.filters import (
    accepted,
    check_required,
    labelled_within,
    matching,
    non_empty,
    of_kind,
    posted_within,
    rejected,
)
from feedloom.operators.limits import cap, first_rounds, soft_cap
from feedloom.operators.numbering import number_long_rows, number_rows
from feedloom.operators.ordering import by_age, in_feed_order, with_age
from feedloom.operators.paging import page_prefix, page_range
from feedloom.session import staged
from feedloom.sources.pages import JOB_CARD


@dataclass(frozen=True)
class Search:
    """What the feed was asked for. ``None`` leaves a condition out.

    With ``as_of`` recency is read from ``posted_at``, else from the age label.
    """

    query: str | None = None
    kind: str | None = None
    hours: int | None = None
    as_of: Column | None = None

    def before_text(self, cards: DataFrame) -> DataFrame:
        """The conditions that need no text; apply them first, they reach the scan."""
        if self.kind is not None:
            cards = of_kind(cards, self.kind)
        if self.hours is None:
            return cards
        if self.as_of is not None:
            return posted_within(cards, self.as_of, self.hours)
        return labelled_within(cards, self.hours)

    def on_text(self, cards: DataFrame, text: str = "description") -> DataFrame:
        return cards if self.query is None else matching(cards, self.query, text)


def _names(columns) -> list[str]:
    return [name for name, _ in columns]


def _complete(cards: DataFrame, columns) -> DataFrame:
    return accepted(check_required(cards, _names(columns)))


def _described(cards: DataFrame, compact: bool = False) -> DataFrame:
    """Cards with a description: as extracted, or cleaned here from ``description_html``."""
    if "description" in cards.columns:
        return cards
    return with_clean_text(cards, "description_html", "description", compact)


def _sorted_by_age(posts: DataFrame, columns, numbered: bool) -> DataFrame:
    aged = with_age(posts).select(*_names(columns), "seq", "age_minutes")
    if not numbered:
        return by_age(aged).drop("age_minutes")
    return number_rows(aged, ["age_minutes", "seq"]).drop("age_minutes")


def _feed_order(posts: DataFrame, columns, numbered: bool) -> DataFrame:
    plain = posts.select(*_names(columns), "seq")
    if not numbered:
        return in_feed_order(plain)
    return (number_long_rows if "description" in plain.columns else number_rows)(plain, ["seq"])


def recent_posts_sorted(
    cards: DataFrame, search: Search = Search(), numbered: bool = False
) -> DataFrame:
    """All posts with cleaned descriptions, youngest first."""
    posts = _complete(search.on_text(_described(search.before_text(cards))), v.POST)
    return _sorted_by_age(posts, v.POST, numbered)


def capped_posts_sorted(
    cards: DataFrame,
    search: Search = Search(),
    posts: int = 5,
    rounds: int = 5,
    numbered: bool = False,
) -> DataFrame:
    """The first posts of the first rounds, then youngest first."""
    taken = capped_posts(cards, search, posts, rounds, ordered=False)
    return _sorted_by_age(taken, v.POST, numbered)


def all_posts(cards: DataFrame, search: Search = Search(), numbered: bool = False) -> DataFrame:
    """All posts in feed order."""
    found = _complete(search.on_text(search.before_text(cards)), v.POST)
    return _feed_order(found, v.POST, numbered)


def all_posts_sorted(
    cards: DataFrame, search: Search = Search(), numbered: bool = False
) -> DataFrame:
    """All posts, youngest first."""
    found = _complete(search.on_text(search.before_text(cards)), v.POST)
    return _sorted_by_age(found, v.POST, numbered)


def all_posts_compact(
    cards: DataFrame, search: Search = Search(), dedup: bool = True, numbered: bool = False
) -> DataFrame:
    """All posts of rounds that each show the whole feed again, with compact text.

    ``dedup`` keeps the first showing of each link; without it every showing is kept.
    """
    found = _described(search.before_text(cards), compact=True)
    complete = _complete(search.on_text(found), v.POST)
    if dedup:
        complete = first_long_per_key(complete.select(*_names(v.POST), "seq"), "post_link")
    return _feed_order(complete, v.POST, numbered)


def capped_posts(
    cards: DataFrame,
    search: Search = Search(),
    posts: int = 60,
    rounds: int = 70,
    ordered: bool = True,
) -> DataFrame:
    """The first posts of the first rounds, in feed order."""
    early = first_rounds(search.before_text(cards), rounds)
    taken = cap(_complete(search.on_text(early), v.POST), posts)
    return _feed_order(taken, v.POST, False) if ordered else taken


def post_links(cards: DataFrame, numbered: bool = False) -> DataFrame:
    """The permalink of every post, in feed order."""
    return _feed_order(_complete(cards, v.LINK_ONLY), v.LINK_ONLY, numbered)


def incomplete(cards: DataFrame, columns, keys=("page_id", "container_idx")) -> DataFrame:
    """The error table of a job: where cards and pages are that it left out, and why.

    ``columns`` is the column list of the job, as ``POST``.
    """
    return rejected(check_required(cards, _names(columns)), keys)


def page_counts(cards: DataFrame) -> DataFrame:
    """How many containers each page showed."""
    return containers_per_page(cards)


def profile_posts(
    cards: DataFrame, search: Search = Search(), soft: int = 5, hard: int = 60
) -> DataFrame:
    """First post per profile link, whole batches until ``soft``, at most ``hard``.

    Needs ``first_href`` and the ``url`` of the page, and ``batch`` for the round.
    """
    own = [name for name in _names(v.PROFILE_POST) if name != "profile_link"]
    ready = accepted(check_required(search.on_text(search.before_text(cards)), own))

    def linked(found: DataFrame) -> DataFrame:
        resolved = found.withColumn("profile_link", absolute_url("url", "first_href"))
        return resolved.where("profile_link IS NOT NULL")

    # The posts are chosen without their texts, which only those chosen bring along. That begins before the links:
    # rows wait for Python in a queue that goes to disk.
    places = linked(ready.select("url", "first_href", "batch", "seq")).select("profile_link", "batch", "seq")
    taken = staged(soft_cap(staged(first_per_key(places, "profile_link"), "firsts"), soft, hard), "taken")
    chosen = F.broadcast(taken.select(*[F.col(c).alias(f"_{c}") for c in taken.columns]))

    def there(*columns: str) -> list[Column]:
        return [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]

    near = linked(ready.join(chosen, there("batch", "seq"), "left_semi"))
    found = first_per_key(near.join(chosen, there(*taken.columns), "left_semi"), "profile_link")
    return _feed_order(found, v.PROFILE_POST, False)


def posts_with_job_branch(
    cards: DataFrame,
    search: Search = Search(),
    posts: int = 50,
    rounds: int = 50,
    numbered: bool = False,
) -> DataFrame:
    """Job cards described by their job page, the others by their own text; capped, then sorted.

    Job cards need ``job_description``, the text of the page behind the button.
    """
    branched = cards.withColumn(
        "description", job_or_post("has_view_job", "job_description", "description")
    )
    return capped_posts_sorted(branched, search, posts, rounds, numbered)


def job_or_post_content(
    cards: DataFrame, search: Search = Search(), posts: int = 20, rounds: int = 50
) -> DataFrame:
    """Job link or description as content, ``N/A`` for missing fields; capped in feed order.

    The time is all of the card's time line, what is only read out included.
    """
    early = first_rounds(search.before_text(cards), rounds).withColumn("time_posted", F.col("time_line"))
    filled = with_defaults(early, ["author", "post_link", "time_posted"])
    found = non_empty(with_content(search.on_text(filled)))
    return _feed_order(cap(found, posts), v.VIEW_JOB_POST, False)


def job_listings(
    pages: DataFrame, last: int | None = 1, query: str | None = None
) -> DataFrame:
    """Complete job cards of the result pages 1 to ``last`` before the first missing one.

    Takes captured pages (``feed, page_no, html``): what comes after a gap is not parsed.
    """
    read = pages if last is None else page_range(pages, last)
    cards = extract_cards(page_prefix(read), JOB_CARD, keep=("feed", "page_no"))
    listed = _complete(cards, v.JOB)
    return listed if query is None else matching(listed, query, "job_title")
