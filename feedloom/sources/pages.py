"""Captured pages, and the rules that read the known kinds of cards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import vocabulary as v
from feedloom.operators.extract import CardRule, Field, Match

_VISIBLE = Match(tag="span", attr_equals=(("aria-hidden", "true"),))
_LEFT_TO_RIGHT = Match(tag="span", attr_equals=(("dir", "ltr"),))
_TIME_LINE = Match(css_class=v.TIME_CLASS)
_AUTHOR = Match(css_class=v.AUTHOR_CLASS)
_BODY = Match(css_class=v.BODY_CLASS)

HAS_JOB_BUTTON = Field(
    (
        (
            Match(
                tag="span",
                attr_contains=(("class", v.BUTTON_TEXT_CLASS),),
                text_equals=v.VIEW_JOB_LABEL,
            ),
        ),
    ),
    take="exists",
)
AUTHOR_TEXT = Field(((_AUTHOR,),))
AUTHOR_VISIBLE = Field(((_AUTHOR,), (_LEFT_TO_RIGHT, _VISIBLE)))
BODY_TEXT = Field(((_BODY,),))
_DESCRIPTION = ((Match(css_class=v.DESCRIPTION_CLASS),),)
DESCRIPTION_HTML = Field(_DESCRIPTION, take="inner_html")
DESCRIPTION_TEXT = Field(_DESCRIPTION, take="clean_text")
DESCRIPTION_COMPACT = Field(_DESCRIPTION, take="compact_text")
TIME_VISIBLE = Field(((_TIME_LINE,), (_VISIBLE,)))
TIME_LINE = Field(((_TIME_LINE,),))
FIRST_LINK = Field(((Match(tag="a", has_attr=("href",)),),), take="@href")
#: The permalink travels with the captured card, as do the links behind its buttons.
PERMALINK = Field(((Match(has_attr=("data-permalink",)),),), take="@data-permalink")
JOB_LINK = Field(((Match(has_attr=("data-job-link",)),),), take="@data-job-link")
#: ``post`` or ``job``, as the search that showed the card had it.
KIND = Field(((Match(has_attr=("data-kind",)),),), take="@data-kind")

_POST_CONTAINER = Match(css_class=v.POST_CONTAINER)

_POST_FIELDS = {
    "author": AUTHOR_VISIBLE,
    "time_posted": TIME_VISIBLE,
    "post_link": PERMALINK,
    "kind": KIND,
}

#: Posts with the description cleaned.
POST_CARD = CardRule(_POST_CONTAINER, {**_POST_FIELDS, "description": DESCRIPTION_TEXT})

#: Posts with the description as compact text.
COMPACT_POST_CARD = CardRule(_POST_CONTAINER, {**_POST_FIELDS, "description": DESCRIPTION_COMPACT})

#: Posts with the description as markup, to be cleaned later.
POST_HTML_CARD = CardRule(_POST_CONTAINER, {**_POST_FIELDS, "description_html": DESCRIPTION_HTML})

#: Posts with the description as shown.
PLAIN_POST_CARD = CardRule(
    _POST_CONTAINER,
    {
        "author": AUTHOR_TEXT,
        "description": BODY_TEXT,
        "time_posted": TIME_VISIBLE,
        "post_link": PERMALINK,
        "kind": KIND,
    },
)

#: Posts that may carry a job button.
JOB_BRANCH_CARD = CardRule(
    _POST_CONTAINER,
    {
        **PLAIN_POST_CARD.fields,
        "has_view_job": HAS_JOB_BUTTON,
        "time_line": TIME_LINE,
        "job_link": JOB_LINK,
    },
)

#: Posts whose container is marked by an id, with the first link in it.
PROFILE_CARD = CardRule(
    Match(element_id=v.POST_CONTAINER),
    {
        "author": AUTHOR_TEXT,
        "description": BODY_TEXT,
        "time_posted": TIME_VISIBLE,
        "first_href": FIRST_LINK,
    },
)

#: The permalink alone.
LINK_CARD = CardRule(_POST_CONTAINER, {"post_link": PERMALINK})

#: Cards of a job result list.
JOB_CARD = CardRule(
    Match(tag="li"),
    {
        "job_title": Field(((Match(tag="strong"),),)),
        "location": Field(((Match(css_class=v.JOB_LOCATION_CLASS),),)),
        "company_name": Field(((Match(css_class=v.JOB_COMPANY_CLASS),),)),
    },
    within=Match(css_class=v.JOB_LIST_CLASS),
)


def spread(table: DataFrame) -> DataFrame:
    """Even out a table of long texts over the tasks of the session.

    For work on long texts, whose files may be few and uneven. Rows are dealt by all they hold,
    so the rows of one feed, host or page number spread.
    """
    return table.repartition(*[F.xxhash64(*table.columns)])


def read_pages(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Captured pages ready for extraction, in the tasks that the files make.

    ``spark.sql.files.maxPartitionBytes`` sets the size of those; :func:`spread` evens out files
    that are few and uneven.
    """
    return spark.read.parquet(path).select(*(columns or ("page_id", "url", "html")))
