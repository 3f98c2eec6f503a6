"""Defaults, the job branch, and values looked up on the page instead of the card."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import strip
from feedloom.vocabulary import NOT_AVAILABLE

#: Containers of a page that meet its first one in one piece.
PIECE_WIDTH = 65_536


def with_defaults(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Show ``N/A`` where a field is missing."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(NOT_AVAILABLE)) for c in columns})


def job_or_post(flag: str, job: str | Column, post: str | Column) -> Column:
    """The value of a job card where the card has a job button, else that of the post."""
    as_col = [F.col(c) if isinstance(c, str) else c for c in (job, post)]
    return F.when(F.col(flag), as_col[0]).otherwise(as_col[1])


def with_content(df: DataFrame) -> DataFrame:
    """``content``: the link of the job for job cards, the description for the others."""
    link = F.coalesce(strip("job_link"), F.lit(NOT_AVAILABLE))
    return df.withColumn("content", job_or_post("has_view_job", link, "description"))


def union_branches(jobs: DataFrame, posts: DataFrame) -> DataFrame:
    """Job and ordinary records in one table, matched by column name."""
    return jobs.unionByName(posts)


def first_on_page(
    df: DataFrame,
    columns: Sequence[str],
    page: str = "page_id",
    index: str = "container_idx",
    width: int = PIECE_WIDTH,
) -> DataFrame:
    """Replace columns by the value of the first container of the same page.

    The first containers are found by an aggregate, so no page is gathered. The join back meets
    a page in pieces of ``width`` index values, so that a page with very many containers spreads;
    ``index`` counts the containers of a page and has no wide gaps.
    """
    first, piece = "_first", "_piece"
    pieces = F.sequence(F.expr(f"_low div {width}"), F.expr(f"_high div {width}"))
    firsts = (
        df.groupBy(page)
        .agg(
            F.min_by(F.struct(*columns), index).alias(first),
            F.min(index).alias("_low"),
            F.max(index).alias("_high"),
        )
        .select(page, first, F.explode(pieces).alias(piece))
    )
    rest = df.drop(*columns).withColumn(piece, F.expr(f"{index} div {width}"))
    return rest.join(firsts, [page, piece]).select(
        *[F.col(first)[c].alias(c) if c in columns else F.col(c) for c in df.columns]
    )
