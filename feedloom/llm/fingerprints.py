"""Document fingerprints: one-permutation MinHash with optimal densification, few bits a bin."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.text import mix, pieces, shingle_sets
from feedloom.session import staged

#: Bins of a fingerprint, a power of two, and the bits stored of each.
BINS = 512
BITS = 2

#: Fingerprint of a text without words.
EMPTY = "empty"


def _probes() -> tuple[np.ndarray, np.ndarray]:
    """Where an empty bin looks: from a start by an odd step, so it gets to all bins."""
    drawn = mix(np.arange(BINS, dtype=np.uint64), 11)
    start = (drawn & np.uint64(BINS - 1)).astype(np.int64)
    step = ((drawn >> np.uint64(20)) & np.uint64(BINS - 1)).astype(np.int64) | 1
    return start, step


def bins(sets: list[np.ndarray]) -> np.ndarray:
    """The least value of each bin for non-empty sets, with empty bins filled.

    Each hash is used once: its low bits name the bin, the rest is the value. An empty bin takes
    the value of the first filled bin on a path of its own, the same in all documents.
    """
    none = np.uint64(2**64 - 1)
    out = np.full((len(sets), BINS), none)
    if not sets:
        return out
    hashes = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = owner * BINS + (hashes & np.uint64(BINS - 1)).astype(np.int64)
    np.minimum.at(out.reshape(-1), at, hashes >> np.uint64(BINS.bit_length() - 1))
    filled = out != none
    row, bin_ = np.nonzero(~filled)
    start, step = _probes()
    source = start[bin_]
    while len(row):
        hit = filled[row, source]
        out[row[hit], bin_[hit]] = out[row[hit], source[hit]]
        miss = ~hit
        row, bin_, source = row[miss], bin_[miss], source[miss]
        source = (source + step[bin_]) & (BINS - 1)
    return out


def fingerprint_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The packed bits of each text of a piece, and which texts have words."""
    sets = shingle_sets(column)
    some = np.array([len(s) > 0 for s in sets], dtype=bool)
    # Bits are drawn anew in each bin, so that bins filled with one value differ by chance alone.
    values = mix(bins([s for s in sets if len(s)]) ^ mix(np.arange(BINS, dtype=np.uint64), 13), 17)
    low = (values & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    bits = (low[:, :, None] >> np.arange(BITS - 1, -1, -1, dtype=np.uint8)) & 1
    packed = np.zeros((len(sets), BINS * BITS // 8), np.uint8)
    packed[some] = np.packbits(bits.reshape(len(low), BINS * BITS), axis=1)
    return packed, some


def as_strings(packed: np.ndarray, some: np.ndarray) -> list[str]:
    return [row.tobytes().hex() if there else EMPTY for row, there in zip(packed, some, strict=True)]


def likeness(a: np.ndarray, some_a: np.ndarray, b: np.ndarray, some_b: np.ndarray) -> np.ndarray:
    """Estimated likeness of fingerprints, row by row.

    Different values agree in their low bits by chance once in ``2^BITS``; that share is taken
    off. Two texts without words are alike, one without is unlike any with words.
    """
    differs = np.unpackbits(a ^ b, axis=1).reshape(len(a), BINS, BITS).any(axis=2)
    chance = 1 / (1 << BITS)
    alike = np.clip((1 - differs.mean(axis=1) - chance) / (1 - chance), 0, 1)
    return np.where(some_a & some_b, alike, (some_a == some_b).astype(float))


def _parse(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    values = column.to_pylist()
    some = np.array([v not in (EMPTY, None) for v in values], dtype=bool)
    width = BINS * BITS // 8
    raw = b"".join(bytes.fromhex(v) if s else bytes(width) for v, s in zip(values, some, strict=True))
    return np.frombuffer(raw, np.uint8).reshape(len(values), width), some


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` of each row; null and empty texts get ``empty``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                packed, some = fingerprint_texts(batch.column(1).slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array(as_strings(packed, some))],
                    ["doc_id", "fingerprint"],
                )

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        run, "doc_id long, fingerprint string"
    )


def compare(pairs: DataFrame, left: str, right: str, name: str = "likeness") -> DataFrame:
    """Add the likeness of two fingerprint columns; a null fingerprint counts as ``empty``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = likeness(*_parse(batch.column(left)), *_parse(batch.column(right)))
            yield batch.append_column(name, pa.array(alike, pa.float64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)
    return pairs.mapInArrow(run, f"{fields}, `{name}` double")


_TRIAL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _trial(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    """The columns of the trial for texts and the text after each."""
    cut = [len(t) // 4 for t in texts]
    edited = [t[: len(t) - n] + f[:n] for t, n, f in zip(texts, cut, following, strict=True)]
    own, after, changed = (
        fingerprint_texts(pa.array(x, pa.large_string())) for x in (texts, following, edited)
    )
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([sha256(t.encode()).hexdigest() for t in edited]),
        pa.array(as_strings(*own)),
        pa.array(as_strings(*changed)),
        pa.array(likeness(*own, *changed)),
        pa.array(likeness(*own, *after)),
    ]


_NAMES = [field.split()[0] for field in _TRIAL.split(", ")]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trial within one sorted partition.

    Besides the finished rows come the first text of the partition and its last row, whose
    following text is in another partition.
    """
    last_id: list = []
    last_text: list[str] = []
    part = None

    def edge(what: str, doc_id, text: str) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
        nulls = [pa.nulls(1, t) for t in types]
        nulls[0] = pa.array([doc_id], pa.int64())
        return pa.RecordBatch.from_arrays(
            [*nulls, pa.array([part], pa.int32()), pa.array([what]), pa.array([text])],
            [*_NAMES, "part", "what", "text"],
        )

    for batch in batches:
        for a, b in pieces(batch.column(1)):
            ids = batch.column(0).slice(a, b - a).to_pylist()
            texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
            if part is None:
                part = batch.column(2)[0].as_py()
                yield edge("first", ids[0], texts[0])
            ids, texts = last_id + ids, last_text + texts
            last_id, last_text = ids[-1:], texts[-1:]
            if len(ids) > 1:
                done = _trial(ids[:-1], texts[:-1], texts[1:])
                n = len(ids) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        *done,
                        pa.array([part] * n, pa.int32()),
                        pa.array(["done"] * n),
                        pa.nulls(n, pa.string()),
                    ],
                    [*_NAMES, "part", "what", "text"],
                )
    if last_id:
        yield edge("last", last_id[0], last_text[0])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, following = (batch.column(c).to_pylist() for c in ("text", "following"))
        if texts:
            yield pa.RecordBatch.from_arrays(
                _trial(batch.column("doc_id").to_pylist(), texts, following), _NAMES
            )


def edit_trial(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint each text, and the text with its last quarter replaced from the next one.

    Next is by ascending ``doc_id`` (null first, ties by a hash of the text); after the last comes the first.
    Null texts are empty; a single document follows itself. The table is put in order by one range
    shuffle. Within a partition the next text is at hand; only one row per partition has to meet
    the first row of the next partition.
    """
    rows = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
        .withColumn("part", F.spark_partition_id())
    )
    made = staged(rows.mapInArrow(_in_order, f"{_TRIAL}, part int, what string, text string"), "trial")
    first = made.where("what = 'first'").select(
        F.col("part").alias("next_part"), F.col("text").alias("following")
    )
    # One row per partition, without its text.
    parts = Window.orderBy("next_part")
    after = first.select("next_part").select(
        F.col("next_part").alias("part"),
        F.coalesce(
            F.lead("next_part").over(parts),
            F.min("next_part").over(parts.rowsBetween(Window.unboundedPreceding, 0)),
        ).alias("next_part"),
    )
    open_ = made.where("what = 'last'").select("part", "doc_id", "text")
    closed = (
        open_.join(after, "part")
        .join(first, "next_part")
        .select("doc_id", "text", "following")
        .mapInArrow(_finish, _TRIAL)
    )
    return made.where("what = 'done'").select(_NAMES).union(closed)
