"""Captured pages to records, by declarative rules.

A rule names the repeated container and, for each field, the way from the container to the
element and what to take from it. Parsing runs in Arrow batches, one page at a time, and is the
only Python on this path: filter and prune the pages before, clean the text by expressions after.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import tree
from feedloom.vocabulary import HIDDEN_CLASS, HIDDEN_LABEL

#: Records gathered before a batch is handed back; one batch also ends after this much text.
BATCH_ROWS = 4096
BATCH_CHARS = 16 << 20


@dataclass(frozen=True)
class Match:
    """What an element must look like; every condition given has to hold."""

    tag: str | None = None
    css_class: str | None = None
    element_id: str | None = None
    attr_equals: tuple[tuple[str, str], ...] = ()
    attr_contains: tuple[tuple[str, str], ...] = ()
    has_attr: tuple[str, ...] = ()
    text_equals: str | None = None
    text_contains: str | None = None

    def holds(self, element) -> bool:
        if self.tag is not None and element.tag != self.tag:
            return False
        attrs = element.attrs
        if self.css_class is not None and not tree.has_class(element, self.css_class):
            return False
        if self.element_id is not None and attrs.get("id") != self.element_id:
            return False
        if self.attr_equals and not all(attrs.get(k) == v for k, v in self.attr_equals):
            return False
        if self.attr_contains and not all(v in attrs.get(k, "") for k, v in self.attr_contains):
            return False
        if self.has_attr and not all(k in attrs for k in self.has_attr):
            return False
        if self.text_equals is None and self.text_contains is None:
            return True
        own = [c for c in element.children if isinstance(c, str)]
        return (self.text_equals is None or self.text_equals in own) and (
            self.text_contains is None or any(self.text_contains in t for t in own)
        )


#: Elements nested in one another, outermost first; what counts is the last.
Selector = tuple[Match, ...]


@dataclass(frozen=True)
class Field:
    """One column of the record.

    ``steps`` are followed one after the other, each looking below the element found before and
    taking match number ``nth`` (of the last step). ``take`` is ``text`` (readable text on single
    spaces), ``clean_text`` (the same without hidden labels), ``compact_text`` (text nodes put
    together as they are), ``inner_html``, ``exists``, or ``@name`` for an attribute. With
    ``scope='page'`` the way starts at the page instead of the container.
    """

    steps: tuple[Selector, ...]
    take: str = "text"
    nth: int = 0
    scope: str = "container"

    @property
    def data_type(self) -> T.DataType:
        return T.BooleanType() if self.take == "exists" else T.StringType()


@dataclass(frozen=True)
class CardRule:
    """The repeated container, looked up within ``within`` where given, and its fields."""

    container: Match
    fields: dict[str, Field] = field(default_factory=dict)
    within: Match | None = None


class _Below(list):
    """The elements of a container in document order, found by class without a look at each."""

    def of_class(self, token: str) -> list:
        try:
            return self.classes.get(token, [])
        except AttributeError:
            self.classes: dict[str, list] = {}
            for element in self:
                names = element.attrs.get("class")
                if names:
                    for name in dict.fromkeys(names.split()):
                        self.classes.setdefault(name, []).append(element)
            return self.classes.get(token, [])


def _matching(elements, selector: Selector) -> Iterator:
    outer, holds = selector[:-1], selector[-1].holds
    if isinstance(elements, _Below) and selector[-1].css_class is not None:
        elements = elements.of_class(selector[-1].css_class)
    for element in elements:
        if holds(element) and (not outer or _inside(element, outer)):
            yield element


def _inside(element, outer) -> bool:
    wanted = list(outer)
    parent = element.parent
    while wanted and parent is not None:
        if wanted[-1].holds(parent):
            wanted.pop()
        parent = parent.parent
    return not wanted


def _nth(elements: Iterator, nth: int):
    return next((e for i, e in enumerate(elements) if i == nth), None)


def _take(fld: Field, container, below, page):
    """The value of a field; ``below`` holds the elements of the container."""
    element, elements = container, below
    if fld.scope == "page":
        element, elements = page, page.walk()
    for i, selector in enumerate(fld.steps):
        nth = fld.nth if i == len(fld.steps) - 1 else 0
        element = _nth(_matching(elements, selector), nth)
        if element is None:
            return False if fld.take == "exists" else None
        elements = element.walk()
    if fld.take == "exists":
        return True
    if fld.take == "inner_html":
        return element.inner_html()
    if fld.take == "text":
        return tree.spaced_text(element)
    if fld.take == "clean_text":
        return tree.spaced_text(element, HIDDEN_CLASS, HIDDEN_LABEL)
    if fld.take == "compact_text":
        return tree.compact_text(element)
    return element.attrs.get(fld.take[1:])


def _containers(page, rule: CardRule):
    scope = page if rule.within is None else _nth(_matching(page.walk(), (rule.within,)), 0)
    return () if scope is None else _matching(scope.walk(), (rule.container,))


def _card_schema(rule: CardRule, kept: list[T.StructField]) -> T.StructType:
    return T.StructType(
        [
            *kept,
            T.StructField("container_idx", T.IntegerType()),
            *[T.StructField(name, f.data_type) for name, f in rule.fields.items()],
            T.StructField("error", T.StringType()),
        ]
    )


def _card_reader(rule: CardRule, keep: tuple[str, ...], html: str):
    """Batches of pages to batches of cards, in columns of ``_card_schema``."""
    names = [*keep, "container_idx", *rule.fields, "error"]

    def run(batches):
        for batch in batches:
            html_at = batch.schema.names.index(html)
            kept_types = [batch.schema.field(name) for name in keep]
            own_types = [pa.field("container_idx", pa.int32())]
            own_types += [
                pa.field(n, pa.bool_() if f.take == "exists" else pa.string())
                for n, f in rule.fields.items()
            ]
            schema = pa.schema(kept_types + own_types + [pa.field("error", pa.string())])
            values = {name: batch.column(name).to_pylist() for name in keep}
            columns, size = {n: [] for n in names}, 0

            def flush():
                return pa.RecordBatch.from_pydict(columns, schema=schema)

            def add(row, record):
                for name in keep:
                    columns[name].append(values[name][row])
                for name in names[len(keep):]:
                    columns[name].append(record.get(name))

            for row, markup in enumerate(batch.column(html_at)):
                text = markup.as_py()
                try:
                    page = tree.parse(text or "")
                    for index, container in enumerate(_containers(page, rule)):
                        below = _Below(container.walk())
                        record = {
                            n: _take(f, container, below, page) for n, f in rule.fields.items()
                        }
                        record["container_idx"] = index
                        add(row, record)
                except (AssertionError, ValueError, RecursionError) as problem:
                    add(row, {"error": type(problem).__name__})
                size += len(text or "")
                if len(columns["error"]) >= BATCH_ROWS or size >= BATCH_CHARS:
                    yield flush()
                    columns, size = {n: [] for n in names}, 0
            if columns["error"]:
                yield flush()

    return run


def extract_cards(
    pages: DataFrame, rule: CardRule, keep: tuple[str, ...] = ("page_id",), html: str = "html"
) -> DataFrame:
    """One row per container: the kept page columns, ``container_idx``, and the rule's fields.

    A field that is not found is NULL. ``error`` is NULL, or says why a page could not be read;
    such a page gives one row without an index, and the other pages are not affected.
    """
    out = _card_schema(rule, [pages.schema[name] for name in keep])
    return pages.select(*keep, html).mapInArrow(_card_reader(rule, keep, html), out)


def card_function(rule: CardRule, keep: T.StructType, html: str = "html"):
    """:func:`extract_cards` as an Arrow table function, to be registered for SQL.

    ``spark.udtf.register("post_cards", card_function(POST_CARD, keep))`` makes
    ``SELECT * FROM post_cards(TABLE(SELECT page_id, html FROM pages))`` work, with the columns of
    ``keep`` and the markup in the table handed over.
    """
    names = tuple(keep.fieldNames())
    read = _card_reader(rule, names, html)

    class Cards:
        def eval(self, pages: pa.RecordBatch) -> Iterator[pa.Table]:
            for cards in read(iter([pages])):
                yield pa.Table.from_batches([cards])

    return F.arrow_udtf(Cards, returnType=_card_schema(rule, keep.fields))


def may_hold(token: str, html: Column | str = "html") -> Column:
    """False only for pages that cannot hold ``token`` in an attribute.

    A plain filter ahead of :func:`extract_cards` that spares parsing pages without containers;
    a page with character references inside a tag is kept, as the token may be written in them.
    """
    html = F.col(html) if isinstance(html, str) else html
    return html.contains(token) | html.rlike(r"<[a-zA-Z][^>]*&")
