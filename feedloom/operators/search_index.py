"""Keyword search over stored posts that opens only the files that can hold the terms.

Posts lie in blocks, and the index has, for every three characters in a row, the blocks whose texts have them. A term can
only be in a block that has all of its threes, so the others are not opened; what is left is searched as
ever. Posts and index grow by rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from feedloom.operators.filters import matching
from feedloom.operators.numbering import ROW_BITS
from feedloom.session import SMALL_GROUPS, WRITERS, setting

#: Characters have 21 bits, so three of them fit in a long one after the other.
BITS = 21
PIECE = 1 << 21
#: Where posts stay as they lie: the blocks of a task are numbered in so many bits, and so many are written at once.
TASK_BITS = 20
OPEN_BLOCKS = 16


def threes(text: str) -> np.ndarray:
    """The distinct runs of three characters of a text, as numbers."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    if len(codes) < 3:
        return np.empty(0, np.int64)
    return np.unique((codes[:-2] << (2 * BITS)) | (codes[1:-1] << BITS) | codes[2:])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The threes of the texts of each block in a batch, each once."""
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        for block in np.unique(blocks):
            texts = batch.column(1).filter(pa.array(blocks == block))
            found, held, size = [np.empty(0, np.int64)], [], 0
            for text in texts:
                held.append(text.as_py() or "")
                size += len(held[-1])
                if size >= PIECE:
                    found.append(threes("\0\0\0".join(held)))
                    held, size = [], 0
            found.append(threes("\0\0\0".join(held)))
            grams = np.unique(np.concatenate(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams), pa.array(np.full(len(grams), block, np.int64))], ["three", "block"]
            )


class SearchIndex:
    """Posts in blocks of ``per_block`` places in the feed, and the blocks of every three characters.

    ``seq`` is a number. A round replaces what it stored before. Text is compared in lower case, as
    :func:`feedloom.operators.filters.matching` does it. With ``as_they_lie`` a block is so many posts of one task as
    they come, whatever their places are: no text is shuffled, and posts that lie together are stored together.
    """

    def __init__(
        self,
        path: str,
        schema: StructType,
        text: str = "description",
        seq: str = "seq",
        per_block: int = 10_000,
        as_they_lie: bool = False,
    ):
        self.path, self.text, self.seq, self.per_block = path, text, seq, per_block
        self.schema, self.as_they_lie = schema, as_they_lie

    def add(self, posts: DataFrame, round_no: int) -> None:
        """Store the posts of a round and index them."""
        folder = f"{self.path}/posts/round={round_no}"
        if self.as_they_lie:
            row = F.monotonically_increasing_id()
            of_task = F.floor(row.bitwiseAND((1 << ROW_BITS) - 1) / self.per_block)
            dealt = posts.select(*self.schema.names, (F.shiftleft(F.shiftright(row, ROW_BITS), TASK_BITS) + of_task).alias("block"))
        else:
            block = F.floor(F.col(self.seq) / self.per_block).cast("long")
            dealt = posts.select(self.schema.names).withColumn("block", block).repartition("block")
        kept = int(posts.sparkSession.conf.get(WRITERS))
        with setting(posts.sparkSession, WRITERS, max(OPEN_BLOCKS, kept) if self.as_they_lie else kept):
            dealt.write.mode("overwrite").options(**SMALL_GROUPS).partitionBy("block").parquet(folder, compression="zstd")
        stored = self._posts(posts.sparkSession).where(F.col("round") == round_no)
        found = stored.select("block", F.lower(self.text)).mapInArrow(_postings, "three long, block long")
        # In order, so that a search reads a few row groups of it.
        found.distinct().repartitionByRange("three").sortWithinPartitions("three").write.mode("overwrite").parquet(
            f"{self.path}/index/round={round_no}"
        )

    def _posts(self, spark: SparkSession) -> DataFrame:
        extra = [StructField("round", LongType()), StructField("block", LongType())]
        return spark.read.schema(StructType([*self.schema.fields, *extra])).parquet(f"{self.path}/posts")

    def blocks(self, spark: SparkSession, query: str) -> DataFrame | None:
        """``round`` and ``block`` of the blocks that can hold all terms; None if any can."""
        wanted = {int(x) for term in query.lower().split() for x in threes(term)}
        if not wanted:
            return None
        index = spark.read.schema("three long, block long, round long").parquet(f"{self.path}/index")
        return (
            index.where(F.col("three").isin(sorted(wanted)))
            .groupBy("round", "block")
            .agg(F.count("*").alias("held"))
            .where(F.col("held") == len(wanted))
            .select("round", "block")
        )

    def search(self, spark: SparkSession, query: str) -> DataFrame:
        """The stored posts that have every term of the query, with their round.

        The blocks that can hold them are joined to the folders of the posts; Spark prunes the others
        at run time.
        """
        posts = self._posts(spark)
        blocks = self.blocks(spark, query)
        if blocks is not None:
            posts = posts.join(blocks, ["round", "block"], "left_semi")
        return matching(posts, query, self.text).drop("block")
