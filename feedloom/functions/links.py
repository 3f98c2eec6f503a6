"""Links: the first one in a fragment, and absolute form."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import tree
from feedloom.functions.text import as_column

#: What holds text that only looks like markup, and what stands before all of it.
NO_MARKUP = r"(?is)<!--.*?-->|<(script|style|title|textarea)\b[^>]*>.*?</\1\s*>|^\s*<!doctype[^<>]*>"
ANCHOR = r"(?i)<a[\s/>]"
PLAIN_LINK = r'''(?i)^<a\s+href="([^"&<>]*)"'''
SITE_ROOT = r"(?i)^([a-z][a-z0-9+.-]*://[^/?#]*)"
HAS_SCHEME = r"(?i)^[a-z][a-z0-9+.-]*:"


def _joined(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series(
        [None if h is None or b is None else urljoin(b, h) for b, h in zip(base, href)],
        dtype=object,
    )


# Declared nondeterministic so that conditions on a link do not make the optimizer resolve it again.
_join_url = F.pandas_udf(_joined, T.StringType()).asNondeterministic()


def _first_links(html: pd.Series) -> pd.Series:
    def first(text):
        links = (e for e in tree.parse(text).walk() if e.tag == "a" and "href" in e.attrs)
        return next((e.attrs["href"] for e in links), None)

    return pd.Series([None if t is None else first(t) for t in html], dtype=object)


_first_link = F.pandas_udf(_first_links, T.StringType()).asNondeterministic()


def first_href(fragment: Column | str) -> Column:
    """The ``href`` of the first link in a piece of HTML, NULL without one.

    Read by expressions where everything before the link is plain markup and the link is written
    ``<a href="...">`` without references. Other rows with an anchor go through the element tree.
    """
    html = as_column(fragment)
    bare = F.regexp_replace(html, NO_MARKUP, "")
    at = F.regexp_instr(bare, F.lit(ANCHOR))
    before = F.substr(bare, F.lit(1), at - 1)
    link = F.substr(bare, at)
    # Outside of attributes: quotes are paired and every tag is closed.
    plain = (
        ~before.rlike(r"(?i)<[!?]|<[^>]*'|<(?:script|style|title|textarea|template|xmp|plaintext|noscript)\b")
        & (F.pmod(F.regexp_count(before, F.lit('"')), F.lit(2)) == 0)
        & (F.regexp_count(before, F.lit("<")) == F.regexp_count(before, F.lit(">")))
        & link.rlike(PLAIN_LINK)
    )
    none = ~html.rlike(ANCHOR)
    return F.coalesce(
        F.when(~none & plain, F.regexp_extract(link, PLAIN_LINK, 1)),
        _first_link(F.when(~none & ~plain, html)),
    )


def site_root(url: Column | str) -> Column:
    """Scheme and host, ``https://example.org``."""
    return F.regexp_extract(as_column(url), SITE_ROOT, 1)


def absolute_url(base: Column | str, href: Column | str) -> Column:
    """Resolve ``href`` against the address of its page.

    Full and root-relative links are resolved by expressions. Only the others (paths relative
    to the page, ``..`` segments, ``//host``) reach Python; all other rows pass it as NULL.
    """
    base, href = as_column(base), as_column(href)
    rooted = href.rlike(r"^/(?!/)") & ~href.contains("/.")
    full = href.rlike(HAS_SCHEME) & ~href.contains("/.")
    simple = rooted | full
    return F.coalesce(
        F.when(rooted, F.concat(site_root(base), href)).when(full, href),
        _join_url(base, F.when(~simple, href)),
    )
