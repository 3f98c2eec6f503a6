"""Mixing sources to target weights by Efraimidis-Spirakis sampling; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.numbering import number_rows
from feedloom.session import staged

#: Words are maximal runs of anything but white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Keys of a source are cut into this many slices; only one slice per source is put in order.
SLICES = 65_536


def quality_weight(text: str | Column = "text") -> Column:
    """A weight between 0.25 and 1 that grows with the share of letters and blanks in a text."""
    known = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    plain = F.length(F.regexp_replace(known, r"[^\p{L} ]", ""))
    share = plain / F.greatest(F.length(known), F.lit(1))
    return F.lit(0.25) + F.lit(0.75) * share


def sampling_key(doc_id: Column, place: Column, weight: Column, seed: int = 0) -> Column:
    """``1 - u^(1/w)`` for a uniform ``u`` from a hash: as ``-ln(u) / w``, smaller goes first.

    ``place`` tells rows of one id apart, so each is drawn by itself.
    """
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    hashed = F.md5(F.concat(name, F.lit(f":{seed}:"), place.cast("string")))
    u = (F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    return F.lit(1.0) - F.exp(F.ln(u) / weight)


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Add ``target`` to a table of ``source`` and ``source_size``, a row per source.

    Sources in code point order, null last, weigh 1, 2, 3 and so on again. They share the whole
    size by weight; a source gets at most ``most`` times its own size, and what is left over is
    shared again by weight. That is one level: with the sources sorted by size for their weight,
    those before some point get their most, the others share the rest. The windows run over one
    row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), place % len(weights) + 1)
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    ranked = (
        sources.withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("limit", F.lit(most).cast("long") * F.col("source_size"))
        .withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("sharing", F.sum("weight").over(after))
        .withColumn("free", F.col("limit") * F.col("sharing") > F.col("weight") * F.col("rest"))
    )
    # The first source below its limit fixes the level for itself and all after it.
    first_free = F.min(F.when(F.col("free"), F.struct(F.col("limit") / F.col("weight"), "place", "rest", "sharing"))).over(everything)
    return (
        ranked.withColumn("level", first_free)
        .withColumn(
            "target",
            F.when(
                F.col("free"),
                (F.col("weight") * F.col("level.rest")).cast("double") / F.col("level.sharing").cast("double"),
            ).otherwise(F.col("limit").cast("double")),
        )
        .select("source", "source_size", "target")
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weight: Column | None = None,
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    seed: int = 0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """How much of each document a mix takes; one row per input row.

    Columns ``doc_id``, ``size`` (words), ``source_size``, ``target`` (of its source), ``copies``
    and ``taken`` (words, repeats counted). A source first goes in whole as often as fits its
    target; the rest is filled by documents in the order of exponential keys scaled by
    ``weight``, as far as their prefix sum comes nearest to it.

    Keys are cut into slices, whose sums fix the slice in which a source fills up. Slices before
    it go in whole, and only that one is put in order, so a source with any share of the rows is
    spread over all tasks. Equal keys go by ``doc_id`` and size. Texts are read once; what is needed of
    them is written as narrow rows.

    Every row is drawn by itself: rows of one id, and rows without one, are numbered by source
    and MD5 of the text, and the number is part of the key; which of equal rows gets which does not
    matter. Null and empty texts have no words and are never taken; a null source is a source; an empty table
    gives an empty result. Columns named in ``carry`` come along, and order what is still equal.
    """
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    own = quality_weight(text) if weight is None else weight
    narrow = staged(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            F.col(source).alias("source"),
            words.alias("size"),
            own.alias("quality"),
            F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"),
            *carry,
        ),
        "sizes",
    )
    numbered = number_rows(narrow, ["source", "digest"], by=["doc_id"], name="place")
    rows = staged(
        numbered.select(
            "doc_id", "source", "size",
            sampling_key(F.col("doc_id"), F.col("place"), F.col("quality"), seed).alias("key"),
            *carry,
        ).withColumn("slice", F.floor(F.col("key") * SLICES)),
        "keys",
    )
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    goal = (
        targets(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, most)
        .withColumn("epochs", F.floor(F.col("target") / F.greatest("source_size", F.lit(1))))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    so_far = slices.withColumn("before", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)))
    same = so_far["source"].eqNullSafe(goal["source"])
    spread = so_far.join(goal, same).select(
        so_far["source"].alias("of_source"), F.col("slice").alias("of_slice"),
        "slice_size", "before", "source_size", "target", "epochs", "budget",
    )
    joined = rows.join(
        spread, rows["source"].eqNullSafe(F.col("of_source")) & (F.col("slice") == F.col("of_slice"))
    )
    # All of a slice is in if its end is within the budget, none if its start is beyond.
    inside = F.col("before") + F.col("slice_size") <= F.col("budget")
    cut = ~inside & (F.col("before") < F.col("budget"))
    in_order = Window.partitionBy("source", "slice").orderBy("key", "doc_id", "size", *carry).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ahead = F.col("before") + F.coalesce(F.sum("size").over(in_order), F.lit(0))
    columns = ["doc_id", "size", "source_size", "target", "epochs", *carry]
    settled = joined.where(~cut).select(*columns, inside.cast("long").alias("part"))
    ordered = joined.where(cut).select(
        *columns, (ahead + F.col("size") / 2 <= F.col("budget")).cast("long").alias("part")
    )
    copies = F.when(F.col("size") > 0, F.col("epochs") + F.col("part")).otherwise(F.lit(0))
    return (
        settled.union(ordered)
        .withColumn("copies", copies.cast("long"))
        .select(
            "doc_id", "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).alias("taken"), *carry,
        )
    )
