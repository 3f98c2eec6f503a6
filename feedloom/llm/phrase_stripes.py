"""Collocations: phrases whose words keep company more often than chance, by stripes.

A stripe belongs to a phrase, its prefix: it counts each word that comes next. Tasks make stripes of
the text they hold; stripes of one prefix are merged by adding them word by word. Merged stripes give all that
is asked for: the counter of a word is the number of occurrences of the prefix with that word, the
sum of a stripe is that of the prefix itself, and its largest counter tells whether a longer
phrase is as frequent. The stripe of the empty prefix counts the words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.text import hash_words, mix, utf8
from feedloom.session import staged

#: Bytes that end a piece of text, and those that are in words: all but blanks, tabs and the former.
BREAKS = np.zeros(256, dtype=bool)
BREAKS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD = ~BREAKS
WORD[[0x20, 0x09]] = False

_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32

#: Text that one set of stripes is made of, in bytes; it is cut between pieces only.
CHUNK = 1 << 22

#: Bits of the filter of frequent phrases, and entries of the table of long stripes. Both are of this size for
#: any input; a fuller filter lets more rare phrases through, which the merged counts then drop.
FILTER_BITS = 26
TABLE_BITS = 16

#: A stripe of more occurrences is cut by the hash of the next word into slices of about as many.
SLICE = 1 << 20

#: Stripes of a language travel together by the hash of their prefix, so many occurrences in a bucket; those of the
#: empty prefix, whose number nobody knows yet, in a fixed number of buckets by the word, as a power of two.
BUCKET = 1 << 19
WORD_BUCKETS = 8

#: Bytes of stripes that a task holds before it hands them on, one row per bucket, and of those of a bucket after which they are
#: added up, before the others have come.
GATHERED = 1 << 25
HELD = 1 << 24

_STRIPE = "lang string, bucket int, prefixes string, cut binary, rest binary, sizes binary, words string, counts binary"
_MERGED = "lang string, size int, prefix string, total long, best long, words array<string>, counts array<long>"

_U = np.uint64


def _chunks(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about ``CHUNK`` bytes that end at a text's end or after a break."""
    start = 0
    while start < len(data):
        stop = start + CHUNK
        if stop >= len(data):
            stop = len(data)
        else:
            text = int(ends[np.searchsorted(ends, stop, side="right") - 1])
            breaks = np.flatnonzero(BREAKS[data[max(start, text) : stop]])
            if len(breaks):
                stop = max(start, text) + int(breaks[-1]) + 1
            elif text > start:
                stop = text
            else:
                text = int(ends[np.searchsorted(ends, stop)])
                breaks = np.flatnonzero(BREAKS[data[stop:text]])
                stop = stop + int(breaks[0]) + 1 if len(breaks) else text
        yield start, stop
        start = stop


def _key(lang: np.ndarray, *words: np.ndarray) -> np.ndarray:
    """A hash of a language and some words in order."""
    out = lang
    for word in words:
        out = mix(out ^ word, 11)
    return out


def _lang_hashes(langs: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in langs], dtype=_U)


class _Words:
    """The words of a stretch of text, as numbers of a dictionary of its own."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, langs: np.ndarray):
        is_word = WORD[data]
        change = np.empty(len(data), dtype=bool)
        change[:1] = True
        np.not_equal(is_word[1:], is_word[:-1], out=change[1:])
        inner = ends[1:-1]
        change[inner[inner < len(data)]] = True
        cuts = np.flatnonzero(change)
        kept = is_word[cuts]
        starts, stops = cuts[kept], np.append(cuts[1:], len(data))[kept]
        text = np.searchsorted(ends, starts, side="right") - 1
        piece = np.cumsum(BREAKS[data], dtype=np.int64)[starts] + text
        #: Whether the word after each is in the same piece.
        self.joined = np.append(piece[1:] == piece[:-1], False)[: len(starts)]
        self.hashes = hash_words(data, ends, WORD)[0]
        self.lang = langs[text]
        distinct, first, self.ids = np.unique(self.hashes, return_index=True, return_inverse=True)
        self.of_id = distinct
        size = stops[first] - starts[first]
        offsets = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(starts[first] - offsets[:-1], size) + np.arange(offsets[-1])
        self.words = pa.StringArray.from_buffers(
            len(first), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(_FOLDED[data[at]])
        )


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of numbers as one binary value each."""
    bounds = np.concatenate(([0], ends)) * values.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    )


def _joined(words: pa.Array, ends: np.ndarray, by: str) -> pa.Array:
    bounds = pa.array(np.concatenate(([0], ends)).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(bounds, words), by)


def _stripes(
    text: _Words,
    langs: list[str],
    at: np.ndarray,
    parts: list[np.ndarray],
    follows: np.ndarray,
    keys: np.ndarray,
    power: np.ndarray,
    buckets: int,
) -> pa.RecordBatch:
    """One row per language and bucket: the stripes of some prefixes, with their counters.

    ``at`` are places in the text, ``parts`` the words of the prefix there, ``follows`` the next word
    or -1 where the stripe does not tell it apart, ``keys`` the hash of the prefix and ``power`` its slices as
    a power of two.
    """
    v = len(text.of_id) + 1
    prefix = text.lang[at].astype(np.int64)
    for part in parts:
        prefix = np.unique(prefix * v + part, return_inverse=True)[1]
    entries, first, counts = np.unique(prefix * v + follows + 1, return_index=True, return_counts=True)
    prefix, following = entries // v, entries % v - 1
    bits = power[first].astype(_U)
    cut = (text.of_id[np.maximum(following, 0)] >> (_U(63) - bits)) >> _U(1)
    cut[following < 0] = 0
    bucket = (mix(keys[first] + cut) % _U(buckets)).astype(np.int64)
    row_of = text.lang[at][first] * buckets + bucket
    order = np.argsort(row_of, kind="stable")
    row_of, prefix, following, counts, first, bits = (x[order] for x in (row_of, prefix, following, counts, first, bits))

    new_row = np.append(True, row_of[1:] != row_of[:-1])
    new = new_row.copy()
    new[1:] |= prefix[1:] != prefix[:-1]
    starts, group = np.flatnonzero(new), np.cumsum(new) - 1
    rows = np.flatnonzero(new_row)
    named = following >= 0
    rest = np.zeros(len(starts), dtype=np.int64)
    np.add.at(rest, group[~named], counts[~named])
    sizes = np.bincount(group[named], minlength=len(starts)).astype(np.int32)
    place = first[starts]
    if parts:
        words = [text.words.take(pa.array(p[place])) for p in parts]
        prefixes = pc.binary_join_element_wise(*words, " ") if len(parts) > 1 else words[0]
    else:
        prefixes = pa.array([""] * len(starts), pa.string())
    # Ends of the rows, in prefixes and in entries that name a word.
    prefix_ends = np.append(group[rows[1:]], len(starts))
    entry_ends = np.append(0, np.cumsum(named))[np.append(rows[1:], len(named))]
    names = pa.array(langs, pa.string()).take(pa.array(row_of[rows] // buckets))
    return pa.RecordBatch.from_arrays(
        [
            names,
            pa.array((row_of[rows] % buckets).astype(np.int32)),
            _joined(prefixes, prefix_ends, "\n"),
            _packed((bits[starts] > 0).astype(np.uint8), prefix_ends),
            _packed(rest, prefix_ends),
            _packed(sizes, prefix_ends),
            _joined(text.words.take(pa.array(following[named])), entry_ends, " "),
            _packed(counts[named].astype(np.int64), entry_ends),
        ],
        ["lang", "bucket", "prefixes", "cut", "rest", "sizes", "words", "counts"],
    )


def _level_words(text: _Words, langs: list[str], hashes: np.ndarray, known, buckets: int) -> Iterator[pa.RecordBatch]:
    at = np.arange(len(text.ids))
    yield _stripes(text, langs, at, [], text.ids, hashes[text.lang], np.full(len(at), WORD_BUCKETS), buckets)


def _frequent(known: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    bit = keys >> _U(64 - FILTER_BITS)
    return (known[0][(bit >> _U(6)).astype(np.int64)] >> (bit & _U(63))) & _U(1) == 1


def _slices(known: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    return known[1][(keys & _U((1 << TABLE_BITS) - 1)).astype(np.int64)]


def _level(base: int, sizes: range) -> Callable:
    def run(text: _Words, langs: list[str], hashes: np.ndarray, known, buckets: int) -> Iterator[pa.RecordBatch]:
        """Stripes of prefixes of some sizes, all of whose ``base`` words in a row are frequent phrases; a next word
        is told apart where the last ones of the prefix are such a phrase together with it."""
        at = np.arange(max(len(text.ids) - base + 1, 0))
        for j in range(base - 1):
            at = at[text.joined[at + j]]
        keys = _key(hashes[text.lang[at]], *[text.hashes[at + j] for j in range(base)])
        ok = _frequent(known, keys)
        at, keys = at[ok], keys[ok]
        frequent = np.zeros(len(text.ids) + 1, dtype=bool)
        frequent[at] = True
        for size in sizes:
            if not len(at):
                return
            last = at + size - 1
            goes_on = text.joined[last] & frequent[at + size - base + 1]
            follows = np.full(len(at), -1, dtype=np.int64)
            follows[goes_on] = text.ids[last[goes_on] + 1]
            # A longer prefix is at most as frequent as its first words, whose slices will do.
            power = _slices(known, keys)
            whole = keys if size == base else _key(hashes[text.lang[at]], *[text.hashes[at + j] for j in range(size)])
            yield _stripes(text, langs, at, [text.ids[at + j] for j in range(size)], follows, whole, power, buckets)
            at, keys = at[goes_on], keys[goes_on]

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same stripes with one row per language and bucket, for as many batches as a task can hold."""

    def put_together(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        keys = pa.table({name: table.column(name) for name in ("lang", "bucket")})
        table = table.take(pc.sort_indices(keys, [("lang", "ascending"), ("bucket", "ascending")])).combine_chunks()
        n = table.num_rows
        same = np.ones(n - 1, dtype=bool)
        for name in ("lang", "bucket"):
            column = table.column(name)
            same &= pc.equal(column.slice(1), column.slice(0, n - 1)).to_numpy()
        starts = np.flatnonzero(np.append(True, ~same))
        bounds = np.append(starts, n).astype(np.int32)

        def join(name: str, by: str | bytes) -> pa.Array:
            column = table.column(name).combine_chunks()
            if name == "words":
                # A row without words adds none, so no separator either.
                some = pc.greater(pc.binary_length(column), 0)
                ends = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))[bounds].astype(np.int32)
                return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), column.filter(some)), by)
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), column), by)

        first = table.take(pa.array(starts)).combine_chunks()
        columns = [first.column("lang").combine_chunks(), first.column("bucket").combine_chunks()]
        by = {"prefixes": "\n", "words": " "}
        columns += [join(name, by.get(name, b"")) for name in table.column_names[2:]]
        return pa.RecordBatch.from_arrays(columns, table.column_names)

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GATHERED:
            yield put_together(held)
            held, size = [], 0
    if held:
        yield put_together(held)


def _map_texts(level: Callable, buckets: int, known=None) -> Callable:
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = known and [np.frombuffer(x, t) for x, t in zip(known.value, (np.uint64, np.uint8), strict=True)]
        for batch in batches:
            data, ends = utf8(batch.column(1))
            coded = batch.column(0).dictionary_encode()
            langs = coded.dictionary.to_pylist()
            codes = coded.indices.to_numpy()
            hashes = _lang_hashes(langs)
            for a, b in _chunks(data, ends):
                first = int(np.searchsorted(ends, a, side="right")) - 1
                last = int(np.searchsorted(ends, b, side="left"))
                text = _Words(data[a:b], np.clip(ends[first : last + 1], a, b) - a, codes[first:last])
                if len(text.ids):
                    yield from level(text, langs, hashes, tables, buckets)

    return lambda batches: _gathered(chunks(batches))


class _Sum:
    """The stripes of a bucket, added word by word."""

    def __init__(self, rows: pa.Table):
        def numbers(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(x.as_buffer() for x in rows.column(name)), kind)

        prefixes = pc.split_pattern(rows.column("prefixes"), "\n").combine_chunks().flatten().dictionary_encode()
        of = prefixes.indices.to_numpy().astype(np.int64)
        n = len(prefixes.dictionary)
        self.prefixes = prefixes.dictionary
        self.rest = np.zeros(n, dtype=np.int64)
        np.add.at(self.rest, of, numbers("rest", np.int64))
        self.cut = np.zeros(n, dtype=np.uint8)
        np.maximum.at(self.cut, of, numbers("cut", np.uint8))
        counts = numbers("counts", np.int64)
        # A row without any word has the empty text, which is no word.
        some = rows.filter(pc.greater(pc.binary_length(rows.column("words")), 0)).column("words")
        words = pc.split_pattern(some, " ").combine_chunks().flatten().dictionary_encode()
        v = max(len(words.dictionary), 1)
        key = np.repeat(of, numbers("sizes", np.int32)) * v + words.indices.to_numpy()
        entries, place = np.unique(key, return_inverse=True)
        self.sums = np.zeros(len(entries), dtype=np.int64)
        np.add.at(self.sums, place, counts)
        self.prefix, self.word, self.words = entries // v, entries % v, words.dictionary

    def row(self) -> dict:
        """As one row of stripes."""
        return {
            "prefixes": "\n".join(self.prefixes.to_pylist()),
            "cut": self.cut.tobytes(),
            "rest": self.rest.tobytes(),
            "sizes": np.bincount(self.prefix, minlength=len(self.rest)).astype(np.int32).tobytes(),
            "words": " ".join(self.words.take(pa.array(self.word)).to_pylist()),
            "counts": self.sums.tobytes(),
        }

    def out(self, lang: str, min_count: int) -> pa.RecordBatch:
        """The stripes with counters of at least ``min_count``; those of rare prefixes are asked for by nobody."""
        n = len(self.rest)
        total = self.rest.copy()
        np.add.at(total, self.prefix, self.sums)
        kept = self.sums >= min_count
        prefix, word, sums = self.prefix[kept], self.word[kept], self.sums[kept]
        best = np.zeros(n, dtype=np.int64)
        np.maximum.at(best, prefix, sums)
        ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(prefix, minlength=n)))).astype(np.int32))
        # A stripe in slices has only part of its sum here.
        used = pa.array((total >= min_count) | (self.cut > 0))
        size = pc.add(pc.count_substring(self.prefixes, " "), pc.cast(pc.greater(pc.binary_length(self.prefixes), 0), pa.int32()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * n, pa.string()),
                size,
                self.prefixes,
                pa.array(total),
                pa.array(best),
                pa.ListArray.from_arrays(ends, self.words.take(pa.array(word))),
                pa.ListArray.from_arrays(ends, pa.array(sums)),
            ],
            ["lang", "size", "prefix", "total", "best", "words", "counts"],
        ).filter(used)


def _merge(min_count: int) -> Callable:
    """Add up stripes that come sorted by language and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            langs, numbers = batch.column("lang").to_pylist(), batch.column("bucket").to_pylist()
            table = pa.Table.from_batches([batch]).drop(["lang", "bucket"])
            at = list(zip(langs, numbers, strict=True))
            start = 0
            while start < len(at):
                stop = start
                while stop < len(at) and at[stop] == at[start]:
                    stop += 1
                rows = table.slice(start, stop - start)
                if at[start] == key:
                    held = pa.concat_tables([held, rows])
                    if held.nbytes > HELD and held.num_rows > 1:
                        held = pa.Table.from_pylist([_Sum(held).row()], held.schema)
                else:
                    if key is not None:
                        yield _Sum(held).out(key[0], min_count)
                    key, held = at[start], rows
                start = stop
        if key is not None:
            yield _Sum(held).out(key[0], min_count)

    return run


def _merged(docs: DataFrame, level: Callable, min_count: int, buckets: int, known=None) -> DataFrame:
    made = docs.mapInArrow(_map_texts(level, buckets, known), _STRIPE)
    dealt = made.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket")
    return staged(dealt.mapInArrow(_merge(min_count), _MERGED), "stripes")


def _extensions(stripes: DataFrame) -> DataFrame:
    """The phrases that a stripe counts: its prefix and one word more."""
    longer = F.when(F.col("size") == 0, F.col("e.words")).otherwise(F.concat("prefix", F.lit(" "), "e.words"))
    return stripes.select("lang", "size", "prefix", F.explode(F.arrays_zip("words", "counts")).alias("e")).select(
        "lang", (F.col("size") + 1).alias("size"), longer.alias("phrase"), F.col("e.counts").alias("a")
    )


def _phrase_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each frequent phrase its bit in the filter, and the slices of its stripe."""
    for batch in batches:
        data, ends = utf8(batch.column(1))
        hashes, bounds = hash_words(data, ends, WORD)
        coded = batch.column(0).dictionary_encode()
        lang = _lang_hashes(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        size = int(bounds[1]) if batch.num_rows else 0
        keys = _key(lang, *[hashes[bounds[:-1] + j] for j in range(size)])
        bit = (keys >> _U(64 - FILTER_BITS)).astype(np.int64)
        power = np.ceil(np.log2(np.maximum(batch.column(2).to_numpy() / SLICE, 1))).astype(np.int64)
        entry = (keys & _U((1 << TABLE_BITS) - 1)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bit, entry, power)], ["bit", "entry", "power"])


def _known(phrases: DataFrame):
    """Two tables of fixed size for all tasks: which phrases may be frequent, which stripes are long; None without any."""
    keys = staged(phrases.select("lang", "phrase", "a").mapInArrow(_phrase_keys, "bit long, entry long, power long"), "keys")
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    found = (
        keys.groupBy(F.shiftright("bit", 6).alias("at"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("mask"))
        .toArrow()
    )
    if not found.num_rows:
        return None
    bits[found.column("at").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    powers = np.zeros(1 << TABLE_BITS, dtype=np.uint8)
    found = keys.where("power > 0").groupBy("entry").agg(F.max("power").alias("power")).toArrow()
    powers[found.column("entry").to_numpy()] = np.minimum(found.column("power").to_numpy(), 30)
    return phrases.sparkSession.sparkContext.broadcast((bits.tobytes(), powers.tobytes()))


def _whole(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def phrase_stripes(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = 100, longest: int = 5):
    """The merged stripes of the frequent phrases of up to ``longest`` - 1 words, in ``size`` words.

    Columns ``lang``, ``size``, ``prefix``, ``total``, ``best`` (largest counter) and the lists ``words`` and
    ``counts`` of counters of at least ``min_count``. A stripe of very many occurrences comes in slices,
    one row each; sums and maxima over them are those of the stripe.

    The texts are read for words, for one, for two, and for more words together. A phrase is only as frequent
    as its parts, so stripes are made of what the time before found frequent, as far as a filter of fixed
    size tells; counts that matter are exact.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    found = stripes = _merged(texts, _level_words, min_count, 1 << WORD_BUCKETS)
    n = stripes.agg(F.sum("total")).first()[0] or 0
    for base, sizes in ((1, range(1, 2)), (2, range(2, 3)), (3, range(3, longest))):
        known = _known(_extensions(found)) if base < longest else None
        if known is None:
            break
        found = _merged(texts, _level(base, sizes), min_count, 1 + n // BUCKET, known)
        stripes = stripes.union(found)
    return stripes


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    min_count: int = 100,
    longest: int = 5,
    percent: int = 100,
    most: int = 2000,
) -> DataFrame:
    """The ``most`` best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line ends, pieces into words at
    blanks and tabs. Phrases are two to ``longest`` words in a row in a piece with ``a >= min_count``
    occurrences; overlapping ones count. ``n`` is the number of words of the language. A cut after k words
    with ``l`` and ``r`` occurrences of its sides has the score ``floor(1000 a n / (l r))``; the lowest cut counts, the
    first of equal ones. Phrases inside a longer one with at least ``percent`` per cent of their occurrences
    are left out. Order: score, then ``a``, both descending, then phrase by bytes.

    A null language is ``und``; null and empty texts have no words; equal rows count each. An empty table
    gives no rows.
    """
    stripes = phrase_stripes(docs, lang, text, min_count, longest)
    totals = stripes.groupBy("lang", "prefix").agg(F.sum("total").alias("f"), F.max("best").alias("best"))
    totals = staged(totals.where((F.col("f") >= min_count) | (F.col("prefix") == "")), "totals")
    phrases = staged(_extensions(stripes.where("size > 0")), "phrases")
    # Of all longer phrases around one, some with just one word more is the most frequent.
    tails = phrases.groupBy("lang", F.expr("substring(phrase, instr(phrase, ' ') + 1)").alias("phrase")).agg(
        F.max("a").alias("before")
    )
    after = totals.select("lang", F.col("prefix").alias("phrase"), F.col("best").alias("after"))
    whole = (
        phrases.join(tails, ["lang", "phrase"], "left")
        .join(after, ["lang", "phrase"], "left")
        .where(100 * F.coalesce(F.greatest("before", "after"), F.lit(0)) < percent * F.col("a"))
    )
    words = F.split("phrase", " ")
    sides = whole.select("lang", "phrase", "a", "size", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    sides = sides.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    of = lambda side, f: totals.select("lang", F.col("prefix").alias(side), F.col("f").alias(f))
    n = totals.where("prefix = ''").select("lang", F.col("f").alias("n"))
    scored = sides.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"]).join(n, "lang")
    scored = scored.withColumns({"_top": 1000 * _whole(F.col("a")) * _whole(F.col("n")), "_under": _whole(F.col("l")) * _whole(F.col("r"))})
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct(F.expr("_top div _under").alias("score"), "k", "a", "l", "r", "n")).alias("b")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("b.score"), F.desc("b.a"), "phrase")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= most)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")
    )
