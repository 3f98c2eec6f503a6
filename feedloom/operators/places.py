"""Numbers brought to long records that stay where they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import staged

#: The place of a record in a table written by :func:`in_place`.
PLACE = "_place"
#: Records in a block of places, as a power of two, and the most records whose numbers are sent to all tasks.
BLOCK_BITS = 10
SENT = 40_000_000


def in_place(df: DataFrame, purpose: str) -> DataFrame:
    """Write records as they come, each with its :data:`PLACE`: the task that wrote it, and the row there."""
    return staged(df.withColumn(PLACE, F.monotonically_increasing_id()), purpose, compression="zstd")


def brought(kept: DataFrame, found: DataFrame, names: Sequence[str], sent: int = SENT) -> DataFrame:
    """The records of :func:`in_place` with the numbers found for them, without their place.

    ``found`` has one row for every place, with whole numbers in the columns ``names``. The places of a task have no
    gaps, so the numbers of a block of neighbours are one array, four bytes a record, and go to the records; the
    texts are not shuffled. With more than ``sent`` records the two are joined like any other tables.
    """
    own = [c for c in kept.columns if c != PLACE]
    if kept.count() > sent:
        return kept.join(found.select(PLACE, *names), PLACE).select(*own, *names)
    at = (F.col(PLACE).bitwiseAND((1 << BLOCK_BITS) - 1)).cast("int")
    rows = F.array_sort(F.collect_list(F.struct(at.alias("at"), *[F.col(c).cast("int").alias(c) for c in names])))
    blocks = found.groupBy(F.shiftright(PLACE, BLOCK_BITS).alias("_block")).agg(rows.alias("_rows"))
    blocks = staged(blocks.select("_block", *[F.col("_rows")[c].alias(f"_of_{c}") for c in names]), "found", compression="zstd")
    met = kept.withColumn("_block", F.shiftright(PLACE, BLOCK_BITS)).join(F.broadcast(blocks), "_block")
    return met.select(*own, *[F.get(f"_of_{c}", at).cast(found.schema[c].dataType).alias(c) for c in names])
