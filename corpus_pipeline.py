"""The stages that turn raw documents into shards of a training corpus.

Each stage takes ``(spark, docs, sf_dir)`` and gives the documents it keeps; its result is written
as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import lpt_shards, phrase_index, sketch_dedup, string_kernel, weighted_mix
from feedloom.session import shared_folder, staged


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of the documents has."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def _with_hash(docs: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    """Add 128 bits of hash over some columns, in two halves; only rows that are equal in them share it."""
    values = [F.array(*[F.col(f"`{c}`").isNull() for c in columns]), *[F.col(f"`{c}`") for c in columns]]
    return docs.withColumns({name: F.xxhash64(F.lit(i), *values) for i, name in enumerate(names)})


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic. The model is fitted on the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return string_kernel.drop_toxic(docs, string_kernel.fit_labelled(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the least id; those without an id are last.

    Each row is a document of its own, without an id or of a repeated one too, and equal rows are a
    group. Rows without shingles are in no group and stay.
    """
    first, second, node, twin = _free(docs, "_row1", "_row2", "_node", "_twin")
    rows = _with_hash(docs, [first, second], docs.columns)
    distinct = staged(rows.groupBy(first, second).agg(F.min("doc_id").alias("id"), F.count("*").alias("n")), "rows")
    # Half of the hash is the number of a row in the search; different rows that share it get another one.
    twins = distinct.groupBy(first).agg(F.count("*").alias(twin)).where(F.col(twin) > 1)
    some = not twins.isEmpty()

    def numbered(table: DataFrame) -> DataFrame:
        if not some:
            return table.withColumn(node, F.col(first))
        own = F.when(F.col(twin).isNull(), F.col(first)).otherwise(F.xxhash64(first, second))
        return table.join(twins, first, "left").withColumn(node, own).drop(twin)

    rows = numbered(rows)
    groups = sketch_dedup.near_duplicates(rows.select(node, "text"), doc_id=node).groupBy(F.col("doc_id").alias(node)).agg(
        F.first("component_id").alias("component_id"), F.first("n_shingles").alias("n_shingles")
    )
    of = groups.join(numbered(distinct), node)
    least = F.min(F.struct(F.col("id").isNull().alias("last"), "id", node, "n"))
    kept = staged(
        of.where("n_shingles > 0").groupBy("component_id").agg(least.alias("kept")).select(f"kept.{node}", "kept.n")
        .union(of.where("n_shingles = 0").select(node, F.lit(1).cast("long"))),
        "kept",
    )
    out = rows.join(kept.where("n = 1").select(node), node)
    more = kept.where("n > 1").select(node)
    if not more.isEmpty():
        out = out.unionByName(rows.join(more, node).dropDuplicates([first, second]))
    return out.select(*[f"`{c}`" for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    # What a document holds depends on its text alone, whatever its id is and however often it occurs.
    first, second = _free(docs, "_text1", "_text2")
    texts = _with_hash(docs, [first, second], ["text"])

    def hit(table: DataFrame, name: str) -> DataFrame:
        found = phrase_index.contamination(table.select(name, "text"), items, doc_id=name)
        return found.where("contaminated").select(F.col("doc_id").alias(name)).distinct()

    # One half of the hash tells which texts may be hit; of those few the other half tells which are.
    maybe = staged(texts.join(hit(texts, first), first).dropDuplicates([first, second]), "hit")
    sure = maybe.join(hit(maybe, second), second).select(first, second)
    return texts.join(sure, [first, second], "left_anti").select(*[f"`{c}`" for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, rows without an id or of a repeated one by themselves."""
    first, second, copies, copy = _free(docs, "_row1", "_row2", "_copies", "_copy")
    rows = _with_hash(docs, [first, second], docs.columns)
    taken = staged(
        weighted_mix.mix(rows.select("doc_id", "text", "source", first, second), carry=[first, second])
        .groupBy(first, second)
        .agg(F.sum("copies").alias("all"), F.count("*").alias("n"))
        .where("all > 0")
        .select(first, second, F.expr("all div n").alias(copies), F.expr("all % n").alias("more")),
        "taken",
    )
    each = rows.join(taken.where(F.col(copies) > 0).drop("more"), [first, second])
    more = taken.where("more > 0").select(first, second, F.col("more").alias(copies))
    if not more.isEmpty():
        # A source fills up amid rows that are equal as a whole: some of them are taken once more.
        each = each.unionByName(rows.join(more, [first, second]).dropDuplicates([first, second]))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    return each.withColumn(copy, times).select(*[f"`{c}`" for c in docs.columns])


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each document; copies of a text stay together."""
    return lpt_shards.shards(docs, 8)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
