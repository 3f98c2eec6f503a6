"""Row positions under a total order, without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.places import PLACE, SENT, brought, in_place
from feedloom.session import staged

#: ``monotonically_increasing_id`` holds the partition above this many bits, the row below.
ROW_BITS = 33


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str = "position",
) -> DataFrame:
    """Add the 0-based position of each row in ``order``, for each group of ``by``.

    One range shuffle puts the table in order, whatever the values are and however many rows
    share a group. It is written to the shared folder with the place of each row in its
    partition. What has to meet in one place is one count per partition and group in it, so
    neither a large group nor a long run of equal leading values makes a large task. Rows that
    are equal in all of ``order`` are numbered in any order.
    """
    row, part, first, count, before = "_row", "_part", "_first", "_count", "_before"
    keys = [*by, *order]
    placed = staged(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(row, F.monotonically_increasing_id()),
        "numbered",
        compression="zstd",
    ).withColumn(part, F.shiftright(row, ROW_BITS))

    earlier = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*by, part)
        .agg(F.count("*").alias(count), F.min(row).alias(first))
        .withColumn(before, F.coalesce(F.sum(count).over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_of_{k}") for k in [*by, part]], first, before)
    )
    same = [placed[k].eqNullSafe(offsets[f"_of_{k}"]) for k in by]
    return placed.join(offsets, [*same, placed[part] == offsets[f"_of_{part}"]]).select(
        *[placed[c] for c in df.columns],
        (F.col(row) - F.col(first) + F.col(before)).alias(name),
    )


def number_long_rows(df: DataFrame, order: Sequence[str], name: str = "position", sent: int = SENT) -> DataFrame:
    """The same for records with long texts, over the whole table: they are written as they come, and numbered apart.

    Only the order columns are shuffled; the positions are sent to the records (:func:`feedloom.operators.places.brought`).
    """
    kept = in_place(df, "kept")
    numbered = number_rows(kept.select(*order, PLACE), order, name=name)
    return brought(kept, numbered, [name], sent)
