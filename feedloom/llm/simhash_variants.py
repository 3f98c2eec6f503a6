"""Near-duplicate documents by SimHash, found over one-wildcard variants of segments.

Two fingerprints that differ in at most four bits differ in at most one bit in one of three segments.
So each segment is stored once for each of its bits with that bit blanked out; such fingerprints share
one of those variants. What shares one is compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.components import components
from feedloom.session import staged

#: Bits of a fingerprint, and by how many two may differ.
BITS = 64
DISTANCE = 4

#: One segment of so many has at most one of the differing bits.
SEGMENTS = DISTANCE // 2 + 1

#: Words in a shingle, and the seed of its hash.
SHINGLE = 4
SEED = 42

#: A text is hashed in blocks of about as many bytes.
BLOCK = 1 << 20

#: Members of a variant that are compared in one task at most; those of larger ones are linked over what lies
#: between two fingerprints.
MANY = 1 << 17

#: Up to this size all pairs of a variant are tried at once, in larger ones a tree of links is grown.
PAIRS = 16

_U = np.uint64


def _blocks(text: bytes) -> Iterator[bytes]:
    """Parts of a text that end at white space."""
    start = 0
    while start < len(text):
        stop = start + BLOCK
        while stop < len(text) and not text[stop : stop + 1].isspace():
            stop += 1
        yield text[start:stop]
        start = stop


def _shingle_hashes(text: bytes) -> Iterator[list[int]]:
    """XXH64 of the shingles of a text, repeats included; fewer words are one shingle."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    held: list[bytes] = []
    long_enough = False
    # For bytes, lower() and split() know ASCII only: A-Z, and blank, tab and the four line ends.
    for block in _blocks(text):
        words = held + block.lower().split()
        if len(words) >= SHINGLE:
            long_enough = True
            joined = b" ".join(words)
            stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.append(0, stops[:-1] + 1)
            spans = zip(starts[: len(words) - SHINGLE + 1].tolist(), stops[SHINGLE - 1 :].tolist(), strict=True)
            yield [digest(joined[a:b], SEED) for a, b in spans]
            words = words[1 - SHINGLE :]
        held = words
    if held and not long_enough:
        yield [digest(b" ".join(held), SEED)]


def fingerprint(text: bytes | None) -> int:
    """A bit is 1 if it is so in over half of the shingles' hashes; no words give zero."""
    votes, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in _shingle_hashes(text or b""):
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        found = [fingerprint(x.as_buffer().to_pybytes() if x.is_valid else None) for x in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])


def _spans() -> list[tuple[int, int]]:
    """First bit and number of bits of each segment."""
    cuts = [BITS * i // SEGMENTS for i in range(SEGMENTS + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _segments(fingerprints: DataFrame) -> DataFrame:
    """``fp``, ``part`` and ``value``: the segments of each fingerprint."""
    values = [
        F.struct(F.lit(i).alias("part"), F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << size) - 1)).alias("value"))
        for i, (start, size) in enumerate(_spans())
    ]
    return fingerprints.select("fp", F.inline(F.array(*values)))


def _per_part(what) -> Column:
    """An array for the segment in question; ``what(start, i)`` is its element for each bit of it."""
    out = F.lit(None)
    for part, (start, size) in enumerate(_spans()):
        out = F.when(F.col("part") == part, F.array(*[what(start, i) for i in range(size)])).otherwise(out)
    return out


def _variants(segments: DataFrame) -> DataFrame:
    """``key`` and ``fp``: every segment with every bit blanked out once; the bit is the upper half of the key."""
    keys = _per_part(lambda start, i: F.col("value").bitwiseAND(F.lit(~(1 << i))).bitwiseOR(F.lit((start + i) << 32)))
    return segments.select("fp", F.explode(keys).alias("key"))


def _between(fingerprints: DataFrame) -> DataFrame:
    """Links of fingerprints that meet half way.

    Two fingerprints differ in at most four bits just if some value differs from both in at most two. All that
    share such a value are close to each other, so each is linked to the least of them and no two
    are compared: the entries are as many as the fingerprints, times a constant.
    """
    masks = [0, *[1 << i for i in range(BITS)], *[(1 << i) | (1 << j) for i in range(BITS) for j in range(i)]]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    fp = F.col("fp")
    near = fingerprints.select("fp", F.explode(F.array(*[fp.bitwiseXOR(F.lit(m)) for m in signed])).alias("key"))
    least = near.groupBy("key").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1")
    return near.join(least, "key").where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct()


def _first_meeting(apart: np.ndarray, key: int) -> np.ndarray:
    """Whether two members of a variant that differ by ``apart`` share no variant before this one.

    So a pair is taken up once: in the first segment with at most one differing bit, in its variant
    without that bit, or in the first one where the segments are equal.
    """
    bit = key >> 32
    first = np.ones(apart.shape, dtype=bool)
    for start, size in _spans():
        inside = apart & _U(((1 << size) - 1) << start)
        if bit < start + size:
            return first & ((inside != 0) if bit > start else True)
        first &= np.bitwise_count(inside) > 1
    return first


def _tree(values: np.ndarray, key: int) -> np.ndarray:
    """Links that join what is connected among the members of a variant: at most one less than they are."""
    found: list[np.ndarray] = []
    waiting, pool = [], values
    while len(pool) or waiting:
        if not waiting:
            waiting.append(pool[0])
            pool = pool[1:]
        one = waiting.pop()
        apart = pool ^ one
        near = np.bitwise_count(apart) <= DISTANCE
        near[near] = _first_meeting(apart[near], key)
        if near.any():
            hits = pool[near]
            pool = pool[~near]
            waiting.extend(hits)
            found.append(np.stack((np.full(len(hits), one), hits), axis=1))
    return np.concatenate(found) if found else np.empty((0, 2), _U)


def _pairs(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """All close pairs within each row of a table of fingerprints, one row per variant."""
    i, j = np.triu_indices(rows.shape[1], 1)
    a, b = rows[:, i], rows[:, j]
    near = np.bitwise_count(a ^ b) <= DISTANCE
    found = [
        np.stack((a[r][near[r]], b[r][near[r]]), axis=1)[_first_meeting((a[r] ^ b[r])[near[r]], int(keys[r]))]
        for r in np.flatnonzero(near.any(axis=1))
    ]
    return np.concatenate(found) if found else np.empty((0, 2), _U)


def _links(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """Links within the runs of equal keys."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    sizes = np.diff(np.append(starts, len(keys)))
    found = [np.empty((0, 2), _U)]
    for size in np.unique(sizes[sizes > 1]).tolist():
        of = starts[sizes == size]
        if size <= PAIRS:
            found.append(_pairs(values[of[:, None] + np.arange(size)], keys[of]))
        else:
            found += [_tree(values[a : a + size], int(keys[a])) for a in of.tolist()]
    pairs = np.sort(np.concatenate(found).view(np.int64), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries come sorted by key; the last key of a batch may go on in the next one."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, values = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(_U)
        if held and keys[-1] == held[0][0][0]:
            held.append((keys, values))
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        held.append((keys[:last], values[:last]))
        yield _links(*map(np.concatenate, zip(*held, strict=True)))
        held = [(keys[last:], values[last:])]
    if held:
        yield _links(*map(np.concatenate, zip(*held, strict=True)))


def fingerprint_links(fingerprints: DataFrame, many: int = MANY) -> DataFrame:
    """Links ``a``, ``b`` between the distinct fingerprints of column ``fp`` that differ in at most four bits.

    Not every such pair is a link, but what such pairs connect, links connect. Entries are put in order of
    their variant by one shuffle and compared where they lie, each pair once; what is linked
    already is not compared again in a larger variant. Only links leave the task.

    A segment that more than ``many / 2`` fingerprints have makes no variants, so none has over ``many`` members.
    Those fingerprints, and all whose segment is at most one bit away, are linked over the values between them.
    """
    segments = _segments(fingerprints.select("fp"))
    crowded = staged(
        segments.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > many // 2).drop("n"), "crowded"
    )
    aside = None
    if not crowded.isEmpty():
        near = F.concat(F.array("value"), _per_part(lambda _, i: F.col("value").bitwiseXOR(F.lit(1 << i))))
        around = crowded.select("part", F.explode(near).alias("value")).distinct()
        aside = _between(segments.join(around, ["part", "value"]).select("fp").distinct())
        segments = segments.join(crowded, ["part", "value"], "left_anti")
    entries = _variants(segments).select("key", "fp").repartition("key").sortWithinPartitions("key")
    found = entries.mapInArrow(_linked, "a long, b long")
    return staged((found if aside is None else found.union(aside)).distinct(), "links")


def simhash_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of each row.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space. A fingerprint takes the majority of the bits of
    XXH64 over all shingles of four words, repeats included; fewer words are one shingle, and no words (null, empty or
    blank texts) give zero. Fingerprints that differ in at most four bits are linked, zero like any other;
    ``component_id`` is the least id that links lead to, its own included. Rows of one id are each judged by
    their text. Rows without an id link others as any; where no row reached has one, ``component_id`` is null.
    An empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    marked = staged(rows.mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    classes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    of = staged(components(fingerprint_links(classes)), "components")
    linked = classes.join(of.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = staged(linked.join(least, "component").select("fp", "component_id"), "classes")
    return marked.join(of_class, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
