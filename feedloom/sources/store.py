"""A store of captured pages, and a data source that reads it by kind, feed and page.

Pages lie in one folder per kind, feed and block of pages. The source opens the blocks that a query
asks for; as a stream it gives each block once, by the page that a feed has come to.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

FORMAT = "captured_pages"
SCHEMA = "kind string, feed string, page_no bigint, url string, html string"
PER_BLOCK = 100
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

_FOLDER = re.compile(r"kind=([^/]*)/feed=([^/]*)/first_page=(-?\d+)/[^/._][^/]*\.parquet$")


def write_captures(pages: DataFrame, path: str, per_block: int = PER_BLOCK, mode: str = "append") -> None:
    """Store captured pages (``kind, feed, page_no, url, html``) in blocks of so many page numbers.

    A block is written once: a stream that has passed it does not look at it again.
    """
    first = (F.floor(F.col("page_no") / per_block) * per_block).cast("long")
    blocks = pages.select("kind", "feed", F.col("page_no").cast("long").alias("page_no"), "url", "html")
    keys = ["kind", "feed", "first_page"]
    blocks.withColumn("first_page", first).repartition(*keys).sortWithinPartitions(*keys, "page_no").write.mode(
        mode
    ).partitionBy(*keys).parquet(path)


def captured(spark: SparkSession, path: str, per_block: int = PER_BLOCK) -> DataFrame:
    """The stored pages; conditions on ``kind``, ``feed`` and ``page_no`` choose the files to open."""
    spark.dataSource.register(CapturedPages)
    spark.conf.set(PUSHDOWN, "true")
    return spark.read.format(FORMAT).option("per_block", per_block).load(path)


def follow_captured(spark: SparkSession, path: str, per_block: int = PER_BLOCK) -> DataFrame:
    """The stored pages as a stream; a round has what has come since the one before."""
    spark.dataSource.register(CapturedPages)
    return spark.readStream.format(FORMAT).option("per_block", per_block).load(path)


@dataclass
class Block(InputPartition):
    """A file of pages ``first`` to ``first + per_block - 1``, and the conditions on its page numbers."""

    file: str
    kind: str | None
    feed: str | None
    first: int
    pages: list[tuple[str, int]]


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _name(folder: str) -> str | None:
    return None if folder == NULL_FOLDER else unquote(folder)


def _blocks(path: str) -> list[Block]:
    """The files of the store, by their names alone."""
    files, root = _open(path)
    found = []
    for info in files.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        if info.type == pafs.FileType.File and (m := _FOLDER.search(info.path)):
            found.append(Block(info.path, _name(m[1]), _name(m[2]), int(m[3]), []))
    return sorted(found, key=lambda b: (b.first, b.kind or "", b.feed or "", b.file))


#: What a condition on page numbers means for a page, and for the first and last page of a block.
_PAGE_TESTS = {
    "=": (pc.equal, lambda first, last, x: first <= x <= last),
    "<": (pc.less, lambda first, last, x: first < x),
    "<=": (pc.less_equal, lambda first, last, x: first <= x),
    ">": (pc.greater, lambda first, last, x: last > x),
    ">=": (pc.greater_equal, lambda first, last, x: last >= x),
}
_SIGNS = {EqualTo: "=", LessThan: "<", LessThanOrEqual: "<=", GreaterThan: ">", GreaterThanOrEqual: ">="}


def _read(path: str, block: Block) -> Iterator[pa.RecordBatch]:
    files, _ = _open(path)
    with files.open_input_file(block.file) as source:
        for batch in pq.ParquetFile(source).iter_batches(columns=["page_no", "url", "html"], batch_size=256):
            for sign, page in block.pages:
                batch = batch.filter(_PAGE_TESTS[sign][0](batch.column("page_no"), page))
            names = [pa.array([x] * batch.num_rows, pa.string()) for x in (block.kind, block.feed)]
            yield pa.RecordBatch.from_arrays([*names, *batch.columns], ["kind", "feed", *batch.schema.names])


class CapturedPages(DataSource):
    """``spark.read.format("captured_pages")`` and ``spark.readStream`` over a store of pages."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _PageStream(self.options)


class _PageReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.per_block = options["path"], int(options.get("per_block", PER_BLOCK))
        self.names: list[tuple[str, set]] = []
        self.pages: list[tuple[str, int]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column == "page_no" and type(f) in _SIGNS:
                self.pages.append((_SIGNS[type(f)], f.value))
            elif column in ("kind", "feed") and isinstance(f, EqualTo | In):
                self.names.append((column, set(f.value) if isinstance(f, In) else {f.value}))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        kept = []
        for block in _blocks(self.path):
            last = block.first + self.per_block - 1
            of_names = all(getattr(block, column) in values for column, values in self.names)
            if of_names and all(_PAGE_TESTS[sign][1](block.first, last, page) for sign, page in self.pages):
                block.pages = self.pages
                kept.append(block)
        return kept

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)


class _PageStream(DataSourceStreamReader):
    """Offsets name, for each kind and feed, the first page that was not given yet."""

    def __init__(self, options):
        self.path, self.per_block = options["path"], int(options.get("per_block", PER_BLOCK))

    @staticmethod
    def _of(block: Block) -> str:
        return f"{block.kind}/{block.feed}"

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        last: dict[str, int] = {}
        for block in _blocks(self.path):
            last[self._of(block)] = max(last.get(self._of(block), block.first), block.first + self.per_block)
        return dict(sorted(last.items()))

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [
            b for b in _blocks(self.path)
            if self._of(b) in end and b.first < end[self._of(b)] and b.first >= start.get(self._of(b), b.first)
        ]

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass
