"""Near-duplicate documents by fast similarity sketches, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.components import components
from feedloom.llm.text import digest_pair, mix, pieces, shingle_sets
from feedloom.session import staged

#: Coordinates of a sketch; a power of two.
COORDINATES = 128

#: Coordinates in a band. With 32 bands of 4, documents of likeness 0.75 share no band with a
#: chance of 5 in a million, and more alike ones with less.
BAND_ROWS = 4

#: Bits of the map of a set that bounds likeness from above, and members of a bucket that are
#: compared in one task.
MAP_BITS = 4096
BLOCK = 2048

#: Pairs of a bucket that are tried in blocks at most, where no component has half of it.
CROWD = 1 << 21

#: Bits of the table that tells frequent shingles from rare ones; its size is fixed.
COUNT_BITS = 20


def fast_sketch(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """Sketches of non-empty sets, one row of ``t`` values each.

    In round ``i`` every element falls into one bin with a value between ``i`` and ``i + 1``; a
    bin keeps its least value. In the first ``t`` rounds the bin is drawn by hash, in round
    ``t + j`` it is bin ``j`` for all, so after ``2 t`` rounds no bin is empty. Values of later
    rounds are larger, so a sketch whose bins are full is done.
    """
    bits = t.bit_length() - 1
    empty = np.uint64(2**64 - 1)
    out = np.full((len(sets), t), empty)
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets], np.int64)
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    open_ = np.ones(len(sets), dtype=bool)
    for i in range(2 * t):
        hashed = mix(elements, 1000 + i)
        bins = (hashed & np.uint64(t - 1)).astype(np.int64) if i < t else i - t
        values = (np.uint64(i) << np.uint64(54)) | (hashed >> np.uint64(max(bits, 10)))
        np.minimum.at(flat, owner * t + bins, values)
        filled = (out != empty).all(axis=1)
        if filled.all():
            break
        if (filled != ~open_).any():
            open_ = ~filled
            still = open_[owner]
            elements, owner = elements[still], owner[still]
    return out


def band_keys(sketches: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One key per band and sketch; the band is part of the key."""
    n, t = sketches.shape
    keys = np.zeros((n, t // rows), dtype=np.uint64)
    for j in range(rows):
        keys = mix(keys + mix(sketches[:, j::rows], 50 + j))
    return mix(keys ^ mix(np.arange(t // rows, dtype=np.uint64), 90))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in pieces(batch.column(1)):
            sets = shingle_sets(batch.column(1).slice(a, b - a))
            some = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(fast_sketch([sets[i] for i in some])).view(np.int64)
            bands: list = [None] * len(sets)
            pairs: list = [(None, None)] * len(sets)
            for row, i in zip(keys, some, strict=True):
                bands[i] = row
                pairs[i] = digest_pair(sets[i])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([p[0] for p in pairs], pa.int64()),
                    pa.array([p[1] for p in pairs], pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array([bit_map(s) for s in sets], pa.binary()),
                ],
                ["doc_id", "n_shingles", "d1", "d2", "bands", "map"],
            )


def bit_map(values: np.ndarray) -> bytes:
    """A bit for each value of a set, by hash; values may share bits."""
    bits = np.zeros(MAP_BITS, bool)
    bits[(values >> np.uint64(40)) % np.uint64(MAP_BITS)] = True
    return np.packbits(bits).tobytes()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in pieces(batch.column(1)):
            sets = shingle_sets(batch.column(1).slice(a, b - a))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a).cast(pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["node", "hashes"],
            )


def _verified(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            left, right = batch.column("left"), batch.column("right")
            for i in range(batch.num_rows):
                x = np.frombuffer(left[i].as_buffer(), np.uint64)
                y = np.frombuffer(right[i].as_buffer(), np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return verify


def _links(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those pairs ``a``, ``b`` whose full sets are alike enough; the sets are made here."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # The list of nodes grows with the corpus, so it is never broadcast to meet the texts.
    texts = docs.join(nodes.hint("merge"), "doc_id", "left_semi")
    sets = staged(
        texts.mapInArrow(_sets, "node long, hashes binary").where("length(hashes) > 0"), "sets"
    )
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("right"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", "left", "right")
        .mapInArrow(_verified(percent), "a long, b long")
    )


def _possible(percent: int, best: bool):
    """Pairs in a block of a bucket that may be alike enough, between different components.

    A bit that only one of two maps has stands for a value that only one of two sets has, so
    the maps bound the number of shared values from above. With ``best`` each member gives its
    most promising partner in each other component, else all partners that the bound allows.
    """

    def run(ours: pa.Table, others: pa.Table) -> pa.Table:
        def read(table: pa.Table, prefix: str = "") -> tuple[np.ndarray, ...]:
            maps = b"".join(x.as_py() for x in table.column(f"{prefix}map"))
            columns = [table.column(prefix + c).to_numpy() for c in ("node", "n", "component")]
            return *columns, np.frombuffer(maps, np.uint64).reshape(-1, MAP_BITS // 64)

        node, n, component, maps = read(ours)
        other, m, of_other, other_maps = read(others, "other_")
        found: list[np.ndarray] = [np.empty((0, 2), np.int64)]
        for i in range(len(node)):
            mine = n[i] - np.bitwise_count(maps[i] & ~other_maps).sum(axis=1, dtype=np.int64)
            theirs = m - np.bitwise_count(other_maps & ~maps[i]).sum(axis=1, dtype=np.int64)
            shared = np.minimum(mine, theirs)
            union = n[i] + m - shared
            fits = np.flatnonzero((100 * shared >= percent * union) & (of_other != component[i]))
            if best and len(fits):
                ranked = fits[np.lexsort((-shared[fits] / union[fits], of_other[fits]))]
                fits = ranked[np.unique(of_other[ranked], return_index=True)[1]]
            found.append(np.stack((np.full(len(fits), node[i]), other[fits]), axis=1))
        pairs = np.sort(np.concatenate(found), axis=1)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _open_pairs(entries: DataFrame, of: DataFrame, maps: DataFrame, percent: int, best: bool) -> DataFrame:
    """Candidates between different components of a bucket.

    Members outside the largest component of a bucket are compared with all members, in blocks
    of bounded size; nothing is made of pairs that cannot be alike enough.
    """
    member = entries.join(of, "node", "left").select(
        "key", "members", "node", "n", F.coalesce("component", "node").alias("component")
    )
    split = (
        member.groupBy("key", "component")
        .agg(F.count("*").alias("size"))
        .groupBy("key")
        .agg(F.max_by("component", "size").alias("main"), F.count("*").alias("components"))
        .where("components > 1")
        .select("key", "main")
    )
    live = member.join(split, "key").join(maps, "node")
    blocks = F.ceil(F.col("members") / BLOCK)
    each = F.sequence(F.lit(0).cast("long"), blocks - 1)
    own = F.pmod(F.xxhash64("node"), blocks)
    columns = ["node", "n", "component", "map"]
    renamed = [F.col(c).alias(f"other_{c}") for c in columns]
    ours = live.where("component <> main").select(
        "key", own.alias("row"), F.explode(each).alias("column"), *columns
    )
    others = live.select(
        F.col("key").alias("other_key"), F.explode(each).alias("other_row"), own.alias("other_column"), *renamed
    )
    return (
        ours.groupBy("key", "row", "column")
        .cogroup(others.groupBy("other_key", "other_row", "other_column"))
        .applyInArrow(_possible(percent, best), "a long, b long")
        .distinct()
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.concatenate([np.empty(0, np.uint64), *[np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("hashes")]])
        places, counts = np.unique(values >> np.uint64(64 - COUNT_BITS), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int64)), pa.array(counts)], ["place", "n"])


def _rare_first(counts, percent: int):
    """The shingles of each set that come first, from rare to frequent, and of which alike sets share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = np.frombuffer(counts.value, np.uint8)
        for batch in batches:
            nodes, sizes, found = [], [], [np.empty(0, np.uint64)]
            for node, x in zip(batch.column("node").to_pylist(), batch.column("hashes"), strict=True):
                values = np.frombuffer(x.as_buffer(), np.uint64)
                order = np.lexsort((values, frequency[values >> np.uint64(64 - COUNT_BITS)]))
                first = values[order[: len(values) - -(-percent * len(values) // 100) + 1]]
                nodes.append(np.full(len(first), node))
                sizes.append(np.full(len(first), len(values)))
                found.append(first)
            columns = [np.concatenate(found).view(np.int64), *[np.concatenate([np.empty(0, np.int64), *x]) for x in (nodes, sizes)]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["key", "node", "n"])

    return run


def _one_per_members(entries: DataFrame) -> DataFrame:
    """Entries ``key``, ``node``, ``n`` of the buckets with several members, one bucket for the same members."""
    buckets = (
        entries.groupBy("key")
        .agg(
            F.count("*").alias("members"),
            F.min("node").alias("leader"),
            F.bit_xor(F.xxhash64("node")).alias("s1"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("s2"),
        )
        .where("members > 1")
        # Buckets of the same members are one.
        .groupBy("members", "leader", "s1", "s2")
        .agg(F.min("key").alias("key"))
        .select("key", "members", "leader")
    )
    return entries.join(buckets, "key")


def _crowded(entries: DataFrame, of: DataFrame) -> DataFrame:
    """Keys of buckets in which no component has half of the members and the others make more than ``CROWD`` pairs."""
    member = entries.join(of, "node", "left").select("key", F.coalesce("component", "node").alias("component"))
    sizes = member.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.sum("n").alias("members"), F.max("n").alias("main")
    )
    apart = F.col("members") - F.col("main")
    return sizes.where((F.col("main") * 2 < F.col("members")) & (apart * F.col("members") > CROWD)).select("key")


def _shared_rare(entries: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Buckets of the shingles that the documents of some buckets have first, from rare to frequent.

    Two sets that are alike enough share so many shingles that the first common one, in any order of all shingles, is among
    the first quarter of either. With rare shingles first, pages of one template, which share
    only what all of them have, do not meet. How frequent a shingle is is told by a table of fixed size; another
    order would give the same links.
    """
    nodes = entries.select(F.col("node").alias("doc_id")).distinct()
    texts = docs.join(nodes.hint("merge"), "doc_id", "left_semi")
    sets = staged(texts.mapInArrow(_sets, "node long, hashes binary").where("length(hashes) > 0"), "sets")
    found = sets.mapInArrow(_counted, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(1 << COUNT_BITS, np.uint8)
    frequency[found.column("place").to_numpy()] = np.minimum(4 * np.log2(found.column("n").to_numpy() + 1), 255)
    counts = docs.sparkSession.sparkContext.broadcast(frequency.tobytes())
    first = sets.mapInArrow(_rare_first(counts, percent), "key long, node long, n long").distinct()
    return staged(_one_per_members(staged(first, "rare")).drop("leader"), "rare")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 75
) -> DataFrame:
    """The near-duplicate group of each document: one row per input row.

    Columns ``doc_id``, ``n_shingles``, ``component_id`` (least document linked, itself
    included) and ``kept`` (it is that least document). Two documents are linked if
    ``100 * |A & B| >= percent * |A | B|`` over their sets of distinct five-word shingles.

    Equal sets are one class from the start, so copies of any number are one node. Classes that
    share a band are candidates. In a bucket, first the least member is held against all others,
    which joins most buckets to one component. Where several components remain, members outside
    the largest one are held against all others, in blocks and by bit maps that bound their
    likeness: first the most promising pair with each other component goes to verification,
    then every pair that the bound allows and that is still not linked. Large buckets in which no component has half of the
    members give way to buckets of the shingles that these have first, from rare to frequent, which
    no two that are alike enough miss. So no pair of candidates
    in different components is left out, but what belongs together never makes all pairs, and pages that
    share no more than a template do not meet.

    Null or empty texts have no shingles: they are linked with nothing and kept. Rows of one
    ``doc_id`` are one document. Rows without ``doc_id`` are linked with nothing and kept, with
    null as ``component_id``. An empty table gives an empty result.
    """
    pairs_of = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketched = staged(
        pairs_of.mapInArrow(
            _sketches, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, map binary"
        ),
        "sketches",
    )
    linkable = sketched.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = staged(
        linkable.groupBy("d1", "d2").agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.first("map").alias("map"),
        ),
        "classes",
    )
    entries = classes.select("node", "n", F.explode("bands").alias("key"))
    entries = staged(_one_per_members(entries), "buckets")
    close_sizes = f"100 * least(n, m) >= {percent} * greatest(n, m)"

    sizes = entries.select(F.col("node").alias("leader"), F.col("n").alias("m")).distinct()
    pairs = (
        entries.where("node <> leader")
        .select("node", "leader", "n")
        .distinct()
        .join(sizes, "leader")
        .where(close_sizes)
        .select(F.col("leader").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    tested = staged(pairs, "pairs")
    links = staged(_links(tested, pairs_of, percent), "links")
    of = staged(components(links), "components")
    maps = classes.select("node", "map")
    crowded = staged(_crowded(entries, of), "crowded")
    if not crowded.isEmpty():
        rare = _shared_rare(entries.join(crowded, "key"), pairs_of, percent)
        columns = ["key", "members", "node", "n"]
        entries = entries.join(crowded, "key", "left_anti").select(columns).union(rare.select(columns))
    for best in (True, False):
        pairs = _open_pairs(entries, of, maps, percent, best).join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        found = staged(_links(pairs, pairs_of, percent), "links")
        if not found.isEmpty():
            links = staged(links.union(found), "links")
            of = staged(components(links), "components")
        tested = tested.union(pairs)

    members = classes.join(of, "node", "left").select(
        "d1", "d2", F.coalesce("component", "node").alias("component")
    )
    return sketched.join(members, ["d1", "d2"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
