"""Caps on records and rounds. All of them follow feed order, not age."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType, TimestampType

from feedloom.operators.ordering import by_age

#: So many first records are found by comparing records directly.
TAKE = 65_536

#: A larger cap is narrowed down by counts between places of a sample of about so many records.
SAMPLE = 8_192


def cap(df: DataFrame, n: int, seq: str | Sequence[str] = "seq") -> DataFrame:
    """The first ``n`` records in feed order, never more.

    The place at which to stop is found from the order columns alone: every task keeps its first
    ``n`` places, and the last of them all is the place. Then the records up to it are read; with one
    order column the condition reaches the scan, so files that start later are skipped. Nothing is
    sorted as a whole or written. A cap beyond ``TAKE`` is narrowed down first: records are counted
    between places of a sample, those that are surely within are taken by a condition, and the cap goes on
    between the two places around the end.

    Records without a place in the feed are not taken. Of records in the same place any are.
    """
    order = [seq] if isinstance(seq, str) else list(seq)
    known = df.dropna(subset=order)
    if n <= 0:
        return known.limit(0)
    place = _place(order)
    before, around = None, known
    if n > TAKE:
        size = known.count()
        if n >= size:
            return known
        low, high, below = _around(known, order, n, size)
        if low is not None and high is not None and low is high:
            # The cap ends amid records in one place.
            return known.where(place < low).union(known.where(place == low).limit(n - below))
        if low is not None:
            before, around = known.where(place <= low), around.where(place > low)
        if high is not None:
            around = around.where(place < high)
        n -= below
    first = _first(around, order, n)
    return first if before is None else before.union(first)


def _place(order: list[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _first(df: DataFrame, order: list[str], n: int) -> DataFrame:
    top = df.select(*order).orderBy(*order).limit(n)
    if set(df.columns) == set(order):
        return top.select(*df.columns)
    last = top.agg(F.max(_place(order))).scalar()
    return df.where(_place(order) <= last).orderBy(*order).limit(n)


def _literal(value, kind: DataType) -> Column:
    if isinstance(kind, StructType) and value is not None:
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    if isinstance(value, datetime):
        if isinstance(kind, TimestampType):
            return F.timestamp_micros(F.lit(round(value.timestamp() * 1_000_000)))
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value).cast(kind)


def _sampled(df: DataFrame, order: list[str], size: int) -> list[Row]:
    """Some places in order; their number follows ``SAMPLE``, not the table."""
    fraction = SAMPLE / size
    while True:
        places = df.select(_place(order).alias("p"))
        rows = (places.sample(fraction) if fraction < 1 else places).orderBy("p").collect()
        if rows or fraction >= 1:
            return rows
        fraction *= 16


def _around(df: DataFrame, order: list[str], n: int, size: int) -> tuple[Column | None, Column | None, int]:
    """Two places around the ``n``-th record with few records between, and how many records reach the lower.

    Where both are the same place, the record is in it, and the number is of those before it. Each
    round reads the order columns twice and narrows the rest about hundredfold.
    """
    kind = df.select(_place(order).alias("p")).schema["p"].dataType
    place = _place(order)
    low, high, below = None, None, 0
    while n - below > TAKE:
        inside = df if low is None else df.where(place > low)
        inside = inside if high is None else inside.where(place < high)
        rows = _sampled(inside, order, size)
        at = (n - below) * len(rows) // size
        near = {at} | {at + sign * 2**k for k in range(len(rows).bit_length()) for sign in (-1, 1)}
        values: list = []
        for i in sorted(i for i in near if 0 <= i < len(rows)):
            if not values or values[-1] != rows[i].p:
                values.append(rows[i].p)
        cuts = [_literal(v, kind) for v in values]

        def side(first: int, last: int) -> Column:
            """Twice the number of cuts before a place, and one more if it is at one."""
            if first > last:
                return F.lit(2 * first)
            mid = (first + last) // 2
            return (
                F.when(place < cuts[mid], side(first, mid - 1))  # noqa: B023
                .when(place == cuts[mid], F.lit(2 * mid + 1))  # noqa: B023
                .otherwise(side(mid + 1, last))
            )

        found = inside.groupBy(side(0, len(cuts) - 1).alias("side")).count().collect()
        for r in sorted(found, key=lambda r: r.side):
            if below + r["count"] >= n:
                break
            below += r["count"]
        if r.side % 2:
            return cuts[r.side // 2], cuts[r.side // 2], below
        low = cuts[r.side // 2 - 1] if r.side else low
        high = cuts[r.side // 2] if r.side // 2 < len(cuts) else high
        size = r["count"]
    return low, high, below


def cap_then_sort(df: DataFrame, n: int, seq: str = "seq") -> DataFrame:
    """Cap in feed order, then sort by age; not the same as the n youngest."""
    return by_age(cap(df, n, seq), seq)


def soft_cap(
    df: DataFrame, soft: int, hard: int, batch: str = "batch", seq: str = "seq"
) -> DataFrame:
    """Take whole batches until ``soft`` records are there, but never more than ``hard``.

    A batch is taken if fewer than ``soft`` records precede it. Whatever is taken lies within
    the first ``hard`` records, and of those the first ``soft`` end in the last batch to take.
    """
    last = cap(df.select(batch, seq), min(soft, hard), [batch, seq]).agg(F.max(batch)).scalar()
    return cap(df.where(F.col(batch) <= last), hard, [batch, seq])


def first_rounds(df: DataFrame, rounds: int, column: str = "round") -> DataFrame:
    """The records of the first rounds, counted from 0."""
    return df.where(F.col(column) < rounds)
