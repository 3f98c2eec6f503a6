"""Shards of near equal size by longest-processing-time scheduling of groups."""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.numbering import number_rows
from feedloom.session import staged


def deal(loads: list[int], size: int, count: int) -> list[int]:
    """How many of ``count`` groups of one size each shard gets; the loads grow by them.

    A heap of loads (ties by shard) would give each group to its top, one after the other. A shard comes up at
    its load, then at ``size`` more and so on, so the groups go to the ``count`` least of all these
    values. They are found by halving, whatever the count is.
    """

    def below(level: int) -> list[int]:
        return [max(0, -(-(level - load) // size)) for load in loads]

    low, high = min(loads), min(loads) + size * count + 1
    while low < high:
        level = (low + high + 1) // 2
        if sum(below(level)) <= count:
            low = level
        else:
            high = level - 1
    out = below(low)
    # Those that come up right at the level, in the order of shards.
    left = count - sum(out)
    for shard, load in enumerate(loads):
        if left and load + out[shard] * size == low:
            out[shard] += 1
            left -= 1
    for shard, n in enumerate(out):
        loads[shard] += n * size
    return out


def schedule(sizes: list[tuple[int, int]], shards: int) -> list[list[int]]:
    """For each size and its number of groups, largest size first, how many go to each shard."""
    loads = [0] * shards
    return [deal(loads, size, count) for size, count in sizes]


def shards(
    docs: DataFrame,
    n: int = 8,
    doc_id: str = "doc_id",
    text: str = "text",
    group: str | None = None,
) -> DataFrame:
    """The shard and the slot in it of each document; one row per input row.

    Columns ``doc_id``, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``shard`` and ``slot``
    (0, 1, 2 ... in each shard). Rows of one ``group`` stay together; without that column, rows
    of equal text do. Groups go largest first to the least loaded shard, each as through a heap of loads.

    Groups of equal size may change places, so the schedule needs the sizes and how often each
    occurs: the driver holds one row per distinct size, at most the root of twice all bytes. It says how
    many groups of a size a shard gets; which ones, their place among those of their size says. Texts are read once.

    A null text is an empty one, a null group a group of its own. Equal rows stay in one shard
    and get different slots. Fewer groups than shards leave shards empty; an empty table gives
    an empty result.
    """
    known = F.coalesce(F.col(text), F.lit(""))
    key = F.md5(known) if group is None else F.coalesce(F.md5(F.col(group).cast("string")), F.lit(""))
    rows = staged(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            (F.octet_length(known) + 1).cast("long").alias("size"),
            F.crc32(known).alias("text_crc32"),
            key.alias("group"),
        ),
        "sizes",
    )
    groups = staged(rows.groupBy("group").agg(F.sum("size").alias("group_size")), "groups")
    counts = groups.groupBy("group_size").count().orderBy(F.desc("group_size")).toArrow()
    sizes = counts.column("group_size").to_pylist()
    dealt = schedule(list(zip(sizes, counts.column("count").to_pylist(), strict=True)), n)
    ends = pa.array([list(accumulate(of)) for of in dealt], pa.list_(pa.int64()))
    plan = docs.sparkSession.createDataFrame(pa.table({"group_size": pa.array(sizes, pa.int64()), "ends": ends}))
    ranked = number_rows(groups, ["group"], by=["group_size"], name="rank").join(plan, "group_size")
    # The first shard whose groups end beyond the rank.
    before = F.size(F.filter("ends", lambda end: end <= F.col("rank")))
    of = ranked.select("group", before.cast("int").alias("shard"))
    placed = rows.join(of, "group").select("doc_id", "size", "text_crc32", "group", "shard")
    return number_rows(placed, ["group", "doc_id"], by=["shard"], name="slot").drop("group")
