"""Repeated byte strings across documents, found by merging Burrows-Wheeler transforms of shards.

Equal strings have to meet, and no task may see all the text, so the corpus is first cut by
content. Each window of ``LENGTH`` bytes belongs to its anchor, the string of ``ANCHOR`` bytes in
it with the least hash. Equal windows have equal anchors in the same place. Neighbouring windows of
one anchor make a segment; segments of one anchor meet in one bucket. Segments whose anchor
occurs once are done, and of equal segments all but the first are repeats as a whole. What is left
are segments with the same anchor and different text around it: their transforms are
built in shards and merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.text import _P, _P_INVERSE, _powers, mix, utf8
from feedloom.session import staged

#: Bytes of a string that counts as repeated, and of the anchor in it.
LENGTH = 100
ANCHOR = 48

#: Text in one bucket, on average.
BUCKET_BYTES = 32 << 20

#: Share of the documents from which frequent anchors are estimated. It balances the work only.
SAMPLE = 0.02

#: Text of a shard whose transform is built at once, and of shards that are merged at once.
SHARD_BYTES = 1 << 18
MERGE_BYTES = 1 << 21

_PIECE = 1 << 19
_POSITION = np.uint64(20)  # bits; a piece and the windows that leave it are shorter than this
_NO_ID = -(1 << 63)


class _Tables:
    made = False
    up: np.ndarray
    down: np.ndarray
    values: np.ndarray

    @classmethod
    def get(cls) -> type[_Tables]:
        if not cls.made:
            size = 1 << int(_POSITION)
            cls.up, cls.down = _powers(_P, size), _powers(_P_INVERSE, size)
            cls.values = mix(np.arange(256, dtype=np.uint64), 21)
            cls.made = True
        return cls


def _sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    tables = _Tables.get()
    np.cumsum(tables.values[data] * tables.up[: len(data)], out=out[1:])
    return out


def _hashes(sums: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int) -> np.ndarray:
    return mix((sums[stops] - sums[starts]) * _Tables.get().down[starts], seed)


def segments(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """All segments of a piece: anchor hash, hash, text number, start, number of windows.

    The piece has less than ``2^20`` bytes. Of equal least anchors in a window the first counts.
    """
    n = len(data)
    if n < LENGTH:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    sums = _sums(data)
    at = np.arange(n - ANCHOR + 1)
    anchors = _hashes(sums, at, at + ANCHOR, 5)
    least = (anchors >> _POSITION << _POSITION) | at.astype(np.uint64)
    width, size = LENGTH - ANCHOR + 1, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        least = np.minimum(least[: size - width], least[width - size :])
    place = (least & np.uint64((1 << int(_POSITION)) - 1)).astype(np.int64)
    m = len(place)
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    inside = doc[LENGTH - 1 : LENGTH - 1 + m] == doc[:m]
    new = np.ones(m, bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:m] != doc[: m - 1]) | (inside[1:] != inside[:-1])
    start = np.flatnonzero(new)
    stop = np.append(start[1:], m)
    start, stop = start[inside[start]], stop[inside[start]]
    own = doc[start]
    return (
        anchors[place[start]],
        _hashes(sums, start, stop + LENGTH - 1, 6),
        own,
        start - ends[own],
        stop - start,
    )


def _windows_alone(data: np.ndarray, ends: np.ndarray, parts: tuple, heavy: np.ndarray) -> tuple:
    """Segments of heavy anchors taken apart: each window is a segment with a key of its own."""
    anchor, own_hash, own, start, count = parts
    hot = np.isin(anchor, heavy)
    if not hot.any():
        return parts
    n = count[hot]
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = np.repeat(start[hot] + ends[own[hot]], n) + nth
    sums = _sums(data)
    alone = (
        _hashes(sums, first, first + LENGTH, 8),
        _hashes(sums, first, first + LENGTH, 9),
        np.repeat(own[hot], n),
        np.repeat(start[hot], n) + nth,
        np.ones(len(nth), np.int64),
    )
    return tuple(np.concatenate((a[~hot], b)) for a, b in zip(parts, alone, strict=True))


def _text_pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, ends, row and offset in the row's text, in pieces of bounded size.

    A long text is given in overlapping parts, so that each window is whole in just one.
    """
    data, ends = utf8(column)
    row = 0
    while row < len(ends) - 1:
        if ends[row + 1] - ends[row] > _PIECE:
            for a in range(int(ends[row]), int(ends[row + 1]) - LENGTH + 1, _PIECE):
                b = min(a + _PIECE + LENGTH - 1, int(ends[row + 1]))
                yield data[a:b], np.array([0, b - a]), np.array([row]), np.array([a - ends[row]])
            row += 1
            continue
        last = int(np.searchsorted(ends, ends[row] + _PIECE, side="right")) - 1
        cut = ends[row : last + 1]
        yield data[cut[0] : cut[-1]], cut - cut[0], np.arange(row, last), np.zeros(last - row, np.int64)
        row = last


def _less(*keys: np.ndarray) -> np.ndarray:
    """Stable order by the keys, the first leading."""
    return np.lexsort(keys[::-1])


def _cut_by(key: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    order = np.argsort(key, kind="stable")
    values, first = np.unique(key[order], return_index=True)
    stops = np.append(first, len(key))[1:]
    return order, list(zip(values.tolist(), first.tolist(), stops.tolist(), strict=True))


def _rows(names: list[str], columns: list[list], first: str) -> pa.RecordBatch:
    kinds = [pa.int32() if n == first else pa.binary() for n in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


_MAPPED = ["bucket", "ids", "ties", "homes", "which", "start", "count", "anchor", "hash", "sure"]
_FOUND = ["home", "ids", "ties", "start", "count", "anchor", "sure"]
_CUT = ["bucket", "ids", "ties", "homes", "start", "count", "anchor", "lengths", "text"]


def _schema(names: list[str]) -> str:
    return ", ".join(f"{n} {'int' if i == 0 else 'binary'}" for i, n in enumerate(names))


def _map_segments(buckets: int, heavy: np.ndarray):
    """Documents to packed segments by bucket; a local repeat is told to be sure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []
            for data, ends, rows, offset in _text_pieces(batch.column(3)):
                anchor, own_hash, own, start, count = _windows_alone(
                    data, ends, segments(data, ends), heavy
                )
                parts.append((anchor, own_hash, rows[own], start + offset[own], count))
            if not parts:
                continue
            anchor, own_hash, own, start, count = (np.concatenate(x) for x in zip(*parts, strict=True))
            ids, ties = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            homes = batch.column(2).to_numpy(zero_copy_only=False)
            sure = np.zeros(len(anchor), bool)
            order = np.argsort(own_hash, kind="stable")
            equal = own_hash[order][1:] == own_hash[order][:-1]
            many = np.zeros(len(order), bool)
            many[1:] |= equal
            many[:-1] |= equal
            some = order[many]
            of, tie = ids[own], ties[own]
            some = some[_less(anchor[some], own_hash[some], of[some], tie[some], start[some])]
            new = np.ones(len(some), bool)
            new[1:] = (anchor[some[1:]] != anchor[some[:-1]]) | (own_hash[some[1:]] != own_hash[some[:-1]])
            head = some[new][np.cumsum(new) - 1]
            # Equal rows are one document, so the same place in them is no repeat.
            sure[some] = (of[some] != of[head]) | (tie[some] != tie[head]) | (start[some] != start[head])
            order, cuts = _cut_by((anchor % np.uint64(buckets)).astype(np.int64))
            columns: list[list] = [[] for _ in _MAPPED]
            for bucket, a, b in cuts:
                take = order[a:b]
                docs, which = np.unique(own[take], return_inverse=True)
                values = (
                    bucket,
                    ids[docs],
                    ties[docs],
                    homes[docs].astype(np.int32),
                    which.astype(np.int32),
                    start[take].astype(np.int32),
                    count[take].astype(np.int32),
                    # What is sure needs no hashes.
                    anchor[take][~sure[take]],
                    own_hash[take][~sure[take]],
                    sure[take],
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value if column is columns[0] else value.tobytes())
            yield _rows(_MAPPED, columns, "bucket")

    return run


def _unpack(table: pa.Table, kinds: dict[str, type]) -> dict[str, list[np.ndarray]]:
    return {
        name: [np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]
        for name, kind in kinds.items()
    }


def _found(home, ids, ties, start, count, anchor, sure) -> pa.Table:
    """Packed by the home of the documents."""
    order, cuts = _cut_by(home)
    columns: list[list] = [[] for _ in _FOUND]
    for value, a, b in cuts:
        take = order[a:b]
        columns[0].append(value)
        packed = (ids, ties, start.astype(np.int32), count.astype(np.int32), anchor, sure)
        for column, x in zip(columns[1:], packed, strict=True):
            column.append(x[take].tobytes())
    return pa.Table.from_batches([_rows(_FOUND, columns, "home")])


def _resolve(table: pa.Table) -> pa.Table:
    """A bucket of segments: repeats of equal ones, and those whose anchor has several texts."""
    read = _unpack(
        table,
        {
            "ids": np.int64, "ties": np.int64, "homes": np.int32, "which": np.int32, "start": np.int32,
            "count": np.int32, "anchor": np.uint64, "hash": np.uint64, "sure": np.bool_,
        },
    )
    ids, ties, homes = (
        np.concatenate([x[w] for x, w in zip(read[c], read["which"], strict=True)])
        for c in ("ids", "ties", "homes")
    )
    start, count, sure = (np.concatenate(read[c]) for c in ("start", "count", "sure"))
    anchor, own = (np.zeros(len(sure), np.uint64) for _ in range(2))
    anchor[~sure], own[~sure] = np.concatenate(read["anchor"]), np.concatenate(read["hash"])
    there = np.flatnonzero(~sure)
    order = there[np.argsort(anchor[there], kind="stable")]
    same = anchor[order][1:] == anchor[order][:-1]
    shared = np.zeros(len(order), bool)
    shared[1:] |= same
    shared[:-1] |= same
    rows = order[shared]
    rows = rows[_less(anchor[rows], own[rows], ids[rows], ties[rows], start[rows])]
    new_anchor = np.ones(len(rows), bool)
    new_anchor[1:] = anchor[rows][1:] != anchor[rows][:-1]
    new = new_anchor.copy()
    new[1:] |= own[rows][1:] != own[rows][:-1]
    group = np.cumsum(new_anchor) - 1
    texts = np.bincount(group, weights=new).astype(np.int64) if len(rows) else np.empty(0, np.int64)
    asked = rows[new & (texts[group] > 1)]
    head = rows[new][np.cumsum(new) - 1] if len(rows) else rows
    at_head = (ids[rows] == ids[head]) & (ties[rows] == ties[head]) & (start[rows] == start[head])
    sure[rows[~new & ~at_head]] = True
    out = np.concatenate((np.flatnonzero(sure), asked))
    return _found(homes[out], ids[out], ties[out], start[out], count[out], anchor[out], sure[out])


def _spans(table: pa.Table) -> dict[str, np.ndarray]:
    kinds = {"ids": np.int64, "ties": np.int64, "start": np.int32, "count": np.int32, "anchor": np.uint64, "sure": np.bool_}
    return {
        name: np.concatenate(parts) if parts else np.empty(0, kinds[name])
        for name, parts in _unpack(table, kinds).items()
    }


def _by_document(spans: dict[str, np.ndarray]) -> dict[tuple[int, int], np.ndarray]:
    order = _less(spans["ids"], spans["ties"], spans["start"])
    ids, ties = spans["ids"][order], spans["ties"][order]
    new = np.ones(len(order), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])
    first = np.flatnonzero(new)
    return {
        (int(ids[a]), int(ties[a])): part
        for a, part in zip(first, np.split(order, first[1:]), strict=True)
    }


def _cut_texts(buckets: int):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        """The bytes of the segments that are asked for, packed by the bucket of their anchor."""
        spans = _spans(found)
        spans = {k: v[~spans["sure"]] for k, v in spans.items()}
        wanted = _by_document(spans) if len(spans["ids"]) else {}
        texts: dict[int, bytes] = {}
        if wanted:
            ids, ties = docs.column("id").to_pylist(), docs.column("tie").to_pylist()
            column = docs.column("text")
            for i, key in enumerate(zip(ids, ties, strict=True)):
                rows = wanted.pop(key, None)
                if rows is None:
                    continue
                data = np.frombuffer((column[i].as_py() or "").encode(), np.uint8).tobytes()
                for r in rows.tolist():
                    a = int(spans["start"][r])
                    texts[r] = data[a : a + int(spans["count"][r]) + LENGTH - 1]
        order, cuts = _cut_by((spans["anchor"] % np.uint64(buckets)).astype(np.int64))
        home = docs.column("home")[0].as_py() if docs.num_rows else 0
        columns: list[list] = [[] for _ in _CUT]
        for bucket, a, b in cuts:
            take = order[a:b]
            cut = [texts[r] for r in take.tolist()]
            packed = (
                spans["ids"][take],
                spans["ties"][take],
                np.array([home], np.int32),
                spans["start"][take],
                spans["count"][take],
                spans["anchor"][take],
                np.array([len(t) for t in cut], np.int32),
            )
            columns[0].append(bucket)
            for column, x in zip(columns[1:], packed):
                column.append(x.tobytes())
            columns[-1].append(b"".join(cut))
        return pa.Table.from_batches([_rows(_CUT, columns, "bucket")])

    return run


class Transform:
    """The Burrows-Wheeler transform of a shard of strings.

    Of each suffix in sorted order: how many bytes it has, whether two bytes precede it in its
    string, and those two bytes as one symbol; and where it starts.
    """

    def __init__(self, text: np.ndarray, ends: np.ndarray):
        lengths = np.diff(ends)
        width = int(lengths.max())
        # Each string followed by zeros: a suffix is compared as a fixed width of bytes.
        padded = np.zeros((len(lengths), 2 * width), np.uint8)
        row = np.repeat(np.arange(len(lengths)), lengths)
        padded[row, np.arange(len(text)) - ends[row]] = text
        # All suffixes, the empty one included.
        owner = np.repeat(np.arange(len(lengths)), lengths + 1)
        offset = np.arange(len(owner)) - (ends[:-1] + np.arange(len(lengths)))[owner]
        suffixes = np.lib.stride_tricks.sliding_window_view(padded, width, axis=1)[owner, offset]
        order = np.argsort(suffixes.view(f"S{width}").ravel(), kind="stable")
        owner, offset = owner[order], offset[order]
        self.start = ends[owner] + offset
        self.remaining = lengths[owner] - offset
        self.preceded = offset >= 2
        two = np.where(self.preceded, self.start, 2)
        self.symbol = (text[two - 2].astype(np.uint16) << 8) | text[two - 1]


def merge_transforms(shards: list[Transform], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave sorted shards up to ``depth`` (even) bytes, without sorting suffixes again.

    The interleave starts as shard after shard. A round goes through it, takes the next suffix of
    the shard it names and puts the suffix two bytes longer behind those with a smaller
    symbol; that is a stable sort of symbols. The result is the interleave by two more bytes. Two
    neighbours have so many bytes in common if their symbols are equal and the suffixes
    they came from had all in common so far. Suffixes that have become too short leave.

    Returns the shard of each suffix of at least ``depth`` bytes in merged order, and a number
    that neighbours share if they have ``depth`` bytes in common: the repeated intervals.
    """
    active = [s.remaining >= 0 for s in shards]
    shard = np.concatenate([np.full(len(s.start), k, np.uint8) for k, s in enumerate(shards)])
    block = np.zeros(len(shard), np.int32)
    for done in range(0, depth, 2):
        symbol = np.empty(len(shard), np.uint16)
        goes_on = np.empty(len(shard), bool)
        for k, s in enumerate(shards):
            mine = shard == k
            symbol[mine] = s.symbol[active[k]]
            goes_on[mine] = s.preceded[active[k]]
        shard, block, symbol = shard[goes_on], block[goes_on], symbol[goes_on]
        order = np.argsort(symbol, kind="stable")
        shard, block, symbol = shard[order], block[order], symbol[order]
        new = np.zeros(len(block), np.int32)
        new[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(new, dtype=np.int32)
        active = [s.remaining >= done + 2 for s in shards]
    return shard, block


def _repeated_windows(text: np.ndarray, ends: np.ndarray, counts: np.ndarray, rank: np.ndarray):
    """For each window of segments in one chunk: is there an equal one of smaller rank?

    ``rank`` orders segments by place, without ties between different places; of windows in one
    segment the earlier is smaller. Returns flags in the order of segments and windows.
    """
    lengths = np.diff(ends)
    groups = max(1, -(-len(text) // SHARD_BYTES))
    cuts = np.unique(np.searchsorted(ends, np.arange(groups + 1) * SHARD_BYTES))
    cuts = np.unique(np.append(cuts[cuts <= len(lengths)], [0, len(lengths)]))
    if len(cuts) < 3 and len(lengths) > 1:
        cuts = np.array([0, len(lengths) // 2, len(lengths)])
    shards = [
        Transform(text[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]
    shard, block = merge_transforms(shards, LENGTH)
    start = np.empty(len(shard), np.int64)
    for k, s in enumerate(shards):
        start[shard == k] = s.start[s.remaining >= LENGTH] + ends[cuts[k]]
    segment = np.searchsorted(ends, start, side="right") - 1
    place = rank[segment] * (int(lengths.max()) + 1) + (start - ends[segment])
    first = np.full(int(block[-1]) + 1 if len(block) else 0, np.iinfo(np.int64).max)
    np.minimum.at(first, block, place)
    window0 = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), bool)
    out[window0[segment] + start - ends[segment]] = place != first[block]
    return out


def _repeated_by_hash(text: np.ndarray, ends: np.ndarray, counts: np.ndarray, rank: np.ndarray):
    """The same for the segments of one anchor that are too many to merge, by window hashes."""
    n = int(counts.sum())
    first = np.repeat(ends[:-1], counts) + np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    one, two = np.empty(n, np.uint64), np.empty(n, np.uint64)
    segment = np.repeat(np.arange(len(counts)), counts)
    step = 1 << (int(_POSITION) - 1)
    for a in range(0, len(text), step):
        sums = _sums(text[a : a + step + LENGTH])
        here = np.flatnonzero((first >= a) & (first < a + step))
        one[here] = _hashes(sums, first[here] - a, first[here] - a + LENGTH, 8)
        two[here] = _hashes(sums, first[here] - a, first[here] - a + LENGTH, 9)
    place = rank[segment] * (1 << 32) + (first - ends[segment])
    order = _less(one, two, place)
    out = np.zeros(n, bool)
    a, b = order[1:], order[:-1]
    out[a] = (one[a] == one[b]) & (two[a] == two[b])
    return out


def _merge(table: pa.Table) -> pa.Table:
    """A bucket of segments with shared anchors: the windows that occur before."""
    read = _unpack(
        table,
        {
            "ids": np.int64, "ties": np.int64, "homes": np.int32, "start": np.int32, "count": np.int32,
            "anchor": np.uint64, "lengths": np.int32, "text": np.uint8,
        },
    )
    homes = np.concatenate([np.full(len(i), h[0]) for i, h in zip(read["ids"], read["homes"], strict=True)])
    ids, ties, start, count, anchor, lengths = (
        np.concatenate(read[c]).astype(np.uint64 if c == "anchor" else np.int64)
        for c in ("ids", "ties", "start", "count", "anchor", "lengths")
    )
    text = np.concatenate(read["text"])
    ends = np.append(0, np.cumsum(lengths))
    order = _less(anchor, ids, ties, start)
    new = np.ones(len(order), bool)
    new[1:] = anchor[order][1:] != anchor[order][:-1]
    bounds = np.append(np.flatnonzero(new), len(order))
    size = np.append(0, np.cumsum(lengths[order]))
    pieces = []
    g = 0
    while g < len(bounds) - 1:
        # Whole anchors, as many as may be merged at once.
        h = int(np.searchsorted(size[bounds], size[bounds[g]] + MERGE_BYTES, side="right")) - 1
        h = min(max(h, g + 1), len(bounds) - 1)
        rows = order[bounds[g] : bounds[h]]
        if len(rows):
            cut = np.append(0, np.cumsum(lengths[rows]))
            index = np.repeat(ends[rows] - cut[:-1], lengths[rows]) + np.arange(cut[-1])
            find = _repeated_windows if cut[-1] <= 2 * MERGE_BYTES else _repeated_by_hash
            flags = find(text[index], cut, count[rows], np.arange(len(rows)))
            segment = np.repeat(rows, count[rows])
            nth = np.arange(len(segment)) - np.repeat(np.cumsum(count[rows]) - count[rows], count[rows])
            begins, same = flags.copy(), segment[1:] == segment[:-1]
            begins[1:] &= ~(flags[:-1] & same)
            stops = flags.copy()
            stops[:-1] &= ~(flags[1:] & same)
            a, b = np.flatnonzero(begins), np.flatnonzero(stops)
            pieces.append((segment[a], start[segment[a]] + nth[a], b - a + 1))
        g = h
    segment, begin, windows = (np.concatenate(x) for x in zip(*pieces, strict=True))
    return _found(
        homes[segment], ids[segment], ties[segment], begin, windows, anchor[segment], np.ones(len(segment), bool)
    )


def _remove(docs: pa.Table, found: pa.Table) -> pa.Table:
    """Each document without the bytes of its repeated windows."""
    spans = _spans(found)
    spans = {k: v[spans["sure"]] for k, v in spans.items()}
    repeated = _by_document(spans) if len(spans["ids"]) else {}
    keys = zip(docs.column("id").to_pylist(), docs.column("tie").to_pylist(), strict=True)
    n_bytes, removed, kept = [], [], []
    column = docs.column("text")
    for i, key in enumerate(keys):
        data = (column[i].as_py() or "").encode()
        rows = repeated.get(key)
        n_bytes.append(len(data))
        if rows is None:
            removed.append([])
            kept.append(data)
            continue
        start = spans["start"][rows].astype(np.int64)
        reach = np.maximum.accumulate(start + spans["count"][rows] + LENGTH - 1)
        new = np.append(True, start[1:] > reach[:-1])
        a = start[new]
        b = reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]
        removed.append([{"start": int(x), "stop": int(y)} for x, y in zip(a, b, strict=True)])
        left = np.append(0, b), np.append(a, len(data))
        kept.append(b"".join(data[x:y] for x, y in zip(*left, strict=True)))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    return pa.table(
        {
            "doc_id": docs.column("doc_id").cast(pa.int64()),
            "n_bytes": pa.array(n_bytes, pa.int64()),
            "removed": pa.array(removed, kind),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def _heavy(rows: DataFrame, buckets: int) -> np.ndarray:
    """Anchors with more segments than a fourth of a bucket, as estimated from a sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, ends, _, _ in _text_pieces(batch.column(0)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segments(data, ends)[0].view(np.int64))], ["anchor"]
                )

    sampled = rows.sample(SAMPLE, seed=1).select("text").mapInArrow(run, "anchor long")
    limit = BUCKET_BYTES // (LENGTH - ANCHOR) / 4 * SAMPLE
    counts = sampled.groupBy("anchor").count().where(F.col("count") >= limit)
    # At most four for each bucket.
    found = counts.orderBy(F.col("count").desc()).limit(8 * buckets).select("anchor").collect()
    return np.array([r[0] for r in found], np.int64).view(np.uint64)


def repeated_strings(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    buckets: int | None = None,
    heavy: np.ndarray | None = None,
) -> DataFrame:
    """Each document without the bytes of 100-byte strings that also start earlier.

    A row per input row: ``doc_id``, ``n_bytes``, ``removed`` (maximal removed spans as byte
    positions) and ``kept`` (the other bytes). Earlier is a smaller ``doc_id`` or an earlier start in
    the same document; strings are judged on the input and never cross documents.

    Null texts are empty; texts under 100 bytes stay whole. Rows without ``doc_id`` come before all
    others. Rows of one ``doc_id`` are told apart by a hash of their text; equal rows are one
    document and stay equal. An empty table gives an empty result.

    The number of buckets follows the size of the corpus. Anchors with so many segments that they
    would fill a bucket are estimated from a sample and their segments are taken apart into
    windows, which spread by their own hash.
    """
    known = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("id"),
        F.xxhash64(known).alias("tie"),
        F.col(doc_id).cast("long").alias("doc_id"),
        known.alias("text"),
    )
    if buckets is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(least, -(-size // BUCKET_BYTES))
    if heavy is None:
        heavy = _heavy(rows, buckets)
    rows = rows.withColumn("home", F.pmod(F.xxhash64("id", "tie"), F.lit(buckets)).cast("int"))
    found = staged(
        rows.select("id", "tie", "home", "text")
        .mapInArrow(_map_segments(buckets, heavy), _schema(_MAPPED))
        .groupBy("bucket")
        .applyInArrow(_resolve, _schema(_FOUND)),
        "segments",
    )
    at_home = rows.groupBy("home")
    merged = (
        at_home.cogroup(found.groupBy("home"))
        .applyInArrow(_cut_texts(buckets), _schema(_CUT))
        .groupBy("bucket")
        .applyInArrow(_merge, _schema(_FOUND))
    )
    return at_home.cogroup(found.union(merged).groupBy("home")).applyInArrow(
        _remove,
        "doc_id long, n_bytes long, removed array<struct<start: long, stop: long>>, kept binary",
    )
