"""Connected components of a link table, by rounds of star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import staged


def _both(links: DataFrame) -> DataFrame:
    return links.union(links.select("b", "a")).toDF("a", "b")


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is hung on the node's smallest neighbour."""
    both = _both(links)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m")
    )
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each smaller neighbour, and the node, are hung on the node's smallest neighbour."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    hung = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least).where("a <> b").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node that links lead to, of all linked nodes.

    ``links`` has two integer columns ``a`` and ``b`` in any order and number; rows with a null
    and loops are left out. Both kinds of star take a minimum per node, which is reduced before
    the shuffle, and join it back, so a hub is no group in one task. Each round is written to the
    shared folder. No links give an empty table.
    """
    links = staged(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "links",
    )
    mark = _mark(links)
    while mark[0]:
        links = staged(_small_star(_large_star(links)), "links")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.toDF("node", "component").union(roots.select("node", F.col("node")))
