"""A stored positional inverted index of documents, searched for phrases and proximity.

The index is cut by documents: each row holds the whole inverted index of a block of them, with
the sorted terms, how often each occurs and all its positions. A search reads blocks by
themselves, so any number of executors can work on it and a frequent term is spread over all
blocks. Terms are 64-bit hashes of lower-cased words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.text import ALPHANUMERIC, hash_words, pieces, utf8
from feedloom.session import shared_folder

#: Bytes of text in a block of the index. A longer text is a block of its own.
BLOCK = 4 << 20

#: Query windows that are searched together.
QUERY_BLOCK = 1 << 15

_INDEX = "doc_ids array<long>, bounds binary, terms binary, counts binary, positions binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in pieces(batch.column(1), BLOCK):
            words, bounds = hash_words(*utf8(batch.column(1).slice(a, b - a)), ALPHANUMERIC)
            order = np.argsort(words, kind="stable")
            terms, counts = np.unique(words, return_counts=True)
            parts = (
                bounds.astype(np.int32),
                terms,
                counts.astype(np.int32),
                order.astype(np.int32),
            )
            ids = batch.column(0).slice(a, b - a).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids),
                    *[pa.array([x.tobytes()], pa.binary()) for x in parts],
                ],
                ["doc_ids", "bounds", "terms", "counts", "positions"],
            )


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Store the postings of all tokens in the shared folder; the index as a table.

    Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased. A
    null text has no words; a null id stays null.
    """
    spark = docs.sparkSession
    path = shared_folder(spark, "phrase-index")
    rows = docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(_blocks, _INDEX)
    rows.withColumn("block", F.monotonically_increasing_id()).write.option(
        "compression", "zstd"
    ).parquet(path)
    return spark.read.schema(f"{_INDEX}, block long").parquet(path)


def _windows(size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1), BLOCK):
                words, bounds = hash_words(*utf8(batch.column(1).slice(a, b - a)), ALPHANUMERIC)
                lengths = np.diff(bounds)
                windows = np.where(lengths > 0, np.maximum(lengths - size + 1, 1), 0)
                item = np.repeat(np.arange(b - a), windows)
                nth = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
                width = np.minimum(lengths[item], size)
                where = (bounds[item] + nth)[:, None] + np.arange(size)
                there = np.arange(size) < width[:, None]
                terms = np.where(there, words[np.where(there, where, 0)], 0) if len(item) else there
                names = batch.column(0).slice(a, b - a).cast(pa.string())
                for lo in range(0, len(item), QUERY_BLOCK):
                    part = slice(lo, lo + QUERY_BLOCK)
                    named = names.take(pa.array(item[part]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.ListArray.from_arrays(pa.array([0, len(named)], pa.int32()), named),
                            pa.array([width[part].astype(np.int32).tobytes()], pa.binary()),
                            pa.array([terms[part].astype(np.uint64).tobytes()], pa.binary()),
                        ],
                        ["items", "widths", "wanted"],
                    )

    return pack


def query_blocks(
    items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = 10
) -> DataFrame:
    """All windows of ``size`` consecutive words of the items, packed into blocks.

    An item of fewer words, but not none, is one window.
    """
    rows = items.select(F.col(item_id).cast("string"), F.col(text))
    return rows.mapInArrow(
        _windows(size), "items array<string>, widths binary, wanted binary"
    ).withColumn("size", F.lit(size))


class _Block:
    """One block of the index, as arrays."""

    def __init__(self, bounds: bytes, terms: bytes, counts: bytes, positions: bytes):
        self.bounds = np.frombuffer(bounds, np.int32).astype(np.int64)
        self.terms = np.frombuffer(terms, np.uint64)
        self.ends = np.cumsum(np.frombuffer(counts, np.int32), dtype=np.int64)
        self.positions = np.frombuffer(positions, np.int32)

    def places(self, wanted: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows whose terms all occur here, and where their terms stand in the list."""
        if not len(self.terms):
            return np.empty(0, np.int64), np.empty((0, wanted.shape[1]), np.int64)
        at = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
        beyond = np.arange(wanted.shape[1]) >= widths[:, None]
        possible = np.flatnonzero(((self.terms[at] == wanted) | beyond).all(axis=1))
        return possible, at[possible]

    def postings(self, place: int) -> np.ndarray:
        return self.positions[self.ends[place - 1] if place else 0 : self.ends[place]]

    def phrase(self, places: np.ndarray) -> np.ndarray:
        """Where the terms follow each other: offset-adjusted lists, the rarest first."""
        lists = sorted(((self.postings(p), i) for i, p in enumerate(places)), key=lambda x: len(x[0]))
        starts = lists[0][0] - lists[0][1]
        for postings, offset in lists[1:]:
            if not len(starts):
                break
            at = np.minimum(np.searchsorted(postings, starts + offset), len(postings) - 1)
            starts = starts[postings[at] == starts + offset]
        return starts[starts >= 0]

    def near(self, places: np.ndarray, span: int) -> np.ndarray:
        """Least starts of runs of ``span`` words that hold all the terms, in any order.

        One start for each posting of the rarest term that has such a run around it.
        """
        lists = sorted((self.postings(p) for p in set(places.tolist())), key=len)
        starts = lists[0][:, None].astype(np.int64) + np.arange(1 - span, 1)
        fits = starts >= 0
        doc = np.searchsorted(self.bounds, starts, side="right") - 1
        fits &= doc == np.searchsorted(self.bounds, lists[0], side="right")[:, None] - 1
        stop = np.minimum(starts + span, self.bounds[np.minimum(doc + 1, len(self.bounds) - 1)])
        for postings in lists[1:]:
            at = np.searchsorted(postings, starts)
            fits &= (at < len(postings)) & (postings[np.minimum(at, len(postings) - 1)] < stop)
        some = fits.any(axis=1)
        return np.unique(starts[np.arange(len(starts)), fits.argmax(axis=1)][some])

    def documents(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, starts, side="right") - 1


def _search(slop: int | None):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cell = {c: batch.column(c)[row] for c in batch.schema.names}
                block = _Block(
                    *[cell[c].as_buffer() for c in ("bounds", "terms", "counts", "positions")]
                )
                size = cell["size"].as_py()
                widths = np.frombuffer(cell["widths"].as_buffer(), np.int32)
                wanted = np.frombuffer(cell["wanted"].as_buffer(), np.uint64).reshape(-1, size)
                windows, places = block.places(wanted, widths)
                starts, which = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                for window, at in zip(windows.tolist(), places, strict=True):
                    terms = at[: widths[window]]
                    found = (
                        block.phrase(terms)
                        if slop is None
                        else block.near(terms, int(widths[window]) + slop)
                    )
                    starts.append(found.astype(np.int64))
                    which.append(np.full(len(found), window))
                start, window = np.concatenate(starts), np.concatenate(which)
                doc = block.documents(start)
                width = widths[window].astype(np.int64) + (slop or 0)
                stop = start + width
                if slop is None:
                    inside = stop <= block.bounds[doc + 1]
                    start, window, doc, stop = (x[inside] for x in (start, window, doc, stop))
                else:
                    stop = np.minimum(stop, block.bounds[doc + 1])
                order = np.lexsort((stop, start, doc))
                start, window, doc, stop = (x[order] for x in (start, window, doc, stop))
                docs, first = np.unique(doc, return_index=True)
                cuts = pa.array(np.append(first, len(doc)).astype(np.int32))
                base = block.bounds[doc]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(docs), cell["block"].as_py()), pa.int64()),
                        pa.array(docs, pa.int64()),
                        pa.ListArray.from_arrays(cuts, pa.array(start - base, pa.int64())),
                        pa.ListArray.from_arrays(cuts, pa.array(stop - base, pa.int64())),
                        pa.ListArray.from_arrays(
                            cuts, cell["items"].values.take(pa.array(window)).cast(pa.string())
                        ),
                    ],
                    ["block", "nth", "starts", "stops", "items"],
                )

    return search


def search(index: DataFrame, queries: DataFrame, slop: int | None = None) -> DataFrame:
    """Matches of query blocks in an index, a row per document and query block that has some.

    Columns ``block`` and ``nth`` name the document; ``starts``, ``stops`` (word positions in
    it) and ``items`` are parallel arrays. Without ``slop`` the terms follow each other exactly;
    with it they stand in any order within ``slop`` more words than they are. Matches never
    cross documents. The query set is held against all blocks of the index, one block of
    queries at a time.
    """
    return index.drop("doc_ids").crossJoin(queries).mapInArrow(
        _search(slop),
        "block long, nth long, starts array<long>, stops array<long>, items array<string>",
    )


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            bounds = np.frombuffer(batch.column("bounds")[row].as_buffer(), np.int32)
            n = len(bounds) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, batch.column("block")[row].as_py()), pa.int64()),
                    pa.array(np.arange(n), pa.int64()),
                    batch.column("doc_ids")[row].values.cast(pa.int64()),
                    pa.array(np.diff(bounds), pa.int64()),
                ],
                ["block", "nth", "doc_id", "n_words"],
            )


def indexed_documents(index: DataFrame) -> DataFrame:
    """The documents of an index: ``block``, ``nth``, ``doc_id``, ``n_words``."""
    return index.select("block", "doc_ids", "bounds").mapInArrow(
        _lengths, "block long, nth long, doc_id long, n_words long"
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, hit = [], np.zeros(batch.num_rows, np.int64)
        for row in range(batch.num_rows):
            starts = np.array([x for part in batch.column("starts")[row].as_py() for x in part])
            stops = np.array([x for part in batch.column("stops")[row].as_py() for x in part])
            order = np.argsort(starts, kind="stable")
            starts, reach = starts[order], np.maximum.accumulate(stops[order])
            new = np.append(True, starts[1:] > reach[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:] - 1, len(starts) - 1)
            hit[row] = int((reach[last] - starts[first]).sum())
            spans.append(
                [{"start": int(a), "stop": int(b)} for a, b in zip(starts[first], reach[last], strict=True)]
            )
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("block"),
                batch.column("nth"),
                batch.column("items"),
                pa.array(hit),
                pa.array(spans, kind),
            ],
            ["block", "nth", "items", "n_hit", "spans"],
        )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    size: int = 10,
    slop: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """What of each document is covered by windows of the items; one row per input row.

    Columns ``doc_id``, ``n_words``, ``n_hit`` (words within any match), ``items`` (ids of items
    with matching windows as sorted strings, null ids left out), ``spans`` (merged matches as
    word positions) and ``contaminated``.

    Null and empty texts have no words and are clean. No items, or items without words, leave
    all documents clean. Equal items are each named; rows of one ``doc_id`` are each reported.
    """
    index = build_index(docs, doc_id, text)
    found = (
        search(index, query_blocks(items, item_id, item_text, size), slop)
        .groupBy("block", "nth")
        .agg(
            F.array_sort(F.array_compact(F.array_distinct(F.flatten(F.collect_list("items"))))).alias("items"),
            F.collect_list("starts").alias("starts"),
            F.collect_list("stops").alias("stops"),
        )
        .mapInArrow(
            _merged,
            "block long, nth long, items array<string>, n_hit long, "
            "spans array<struct<start: long, stop: long>>",
        )
    )
    n_hit = F.coalesce("n_hit", F.lit(0))
    return indexed_documents(index).join(found, ["block", "nth"], "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start: long, stop: long>>")).alias("spans"),
        (n_hit > 0).alias("contaminated"),
    )
