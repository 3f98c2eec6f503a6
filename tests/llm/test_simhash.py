"""SimHash fingerprints and their groups against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from feedloom.llm import simhash_variants
from feedloom.llm.components import components
from tests.llm.conftest import ODD


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values):
    """The least member that steps of at most four bits lead to, for each value."""
    values, out = sorted(set(values)), {}
    while values:
        least, waiting = values[0], [values.pop(0)]
        while waiting:
            one = waiting.pop()
            out[one] = least
            near = [v for v in values if (v ^ one).bit_count() <= 4]
            waiting += near
            values = [v for v in values if (v ^ one).bit_count() > 4]
    return out


def copies(rnd):
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(10):
        base = rnd.choices(vocabulary, k=rnd.choice([2, 60, 400]))
        for _ in range(6):
            words = list(base)
            for _ in range(rnd.randrange(3)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            out.append(rnd.choice([" ", "\t", "\n "]).join(words) if rnd.random() < 0.7 else " ".join(words).upper())
    return out + ODD


@pytest.mark.parametrize("block", [1 << 20, 50])
def test_fingerprints(monkeypatch, block):
    monkeypatch.setattr(simhash_variants, "BLOCK", block)
    for text in [*copies(random.Random(5)), "x" * 200 + " b c d", "a b c", "\x1f a\x85b c d e"]:
        got = simhash_variants.fingerprint(None if text is None else text.encode()) % 2**64
        assert got == brute_fingerprint(text)


def test_groups_of_documents(table):
    texts = copies(random.Random(6))
    got = {r.doc_id: r for r in simhash_variants.simhash_duplicates(table(texts)).collect()}
    marks = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{m:016x}" for i, m in marks.items()}
    of = brute_groups(marks.values())
    least = {}
    for i, m in sorted(marks.items()):
        least.setdefault(of[m], i)
    assert {i: r.component_id for i, r in got.items()} == {i: least[of[m]] for i, m in marks.items()}


def signed(value):
    return value - 2**64 if value >= 2**63 else value


def crowd(rnd, n, spread):
    """Fingerprints around a few centres, linked and not."""
    centres = [rnd.getrandbits(64) for _ in range(4)]
    out = set()
    while len(out) < n:
        value = rnd.choice(centres)
        for _ in range(rnd.randrange(spread)):
            value ^= 1 << rnd.randrange(64)
        out.add(value)
    return sorted(out)


@pytest.mark.parametrize("many, pairs", [(1 << 17, 16), (1 << 17, 3), (40, 3), (2, 16)])
def test_crowded_variants_lose_no_link(spark, monkeypatch, many, pairs):
    monkeypatch.setattr(simhash_variants, "PAIRS", pairs)
    values = crowd(random.Random(many), 200, 12) + [0, 2**64 - 1, 1, 15, 31]
    table = spark.createDataFrame([(signed(v),) for v in values], "fp long").distinct()
    links = simhash_variants.fingerprint_links(table, many)
    assert links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 4).isEmpty()
    of = {r.node % 2**64: r.component % 2**64 for r in components(links).collect()}
    want = brute_groups(values)
    groups = {}
    for v in values:
        groups.setdefault(of.get(v, v), set()).add(v)
    brute = {}
    for v, least in want.items():
        brute.setdefault(least, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, brute.values()))


def test_pairs_meet_once():
    """Of all variants that two fingerprints share, one takes them up."""
    rnd = random.Random(1)
    spans = simhash_variants._spans()
    assert spans[0][0] == 0 and sum(size for _, size in spans) == 64
    for _ in range(300):
        apart = 0
        for _ in range(rnd.randrange(1, 5)):
            apart |= 1 << rnd.randrange(64)
        shared = [
            (start + i) << 32
            for start, size in spans for i in range(size)
            if (apart >> start) % (1 << size) & ~(1 << i) == 0
        ]
        meets = [simhash_variants._first_meeting(np.array([apart], np.uint64), key)[0] for key in shared]
        assert sum(meets) == 1


def test_entries_over_batches():
    rnd = random.Random(2)
    values = crowd(rnd, 60, 6)
    entries = sorted((k << 32, v) for k in (0, 1, 30) for v in values)
    whole = simhash_variants._links(*(np.array(x) for x in zip(*[(k, np.uint64(v)) for k, v in entries])))
    keys, fps = (pa.array(x, pa.int64()) for x in zip(*[(k, signed(v)) for k, v in entries]))
    for size in (1, 7, 60, 1000):
        batches = pa.table({"key": keys, "fp": fps}).to_batches(max_chunksize=size)
        got = {tuple(r.values()) for b in simhash_variants._linked(iter(batches)) for r in b.to_pylist()}
        assert got == {tuple(r.values()) for r in whole.to_pylist()}


def test_rows_without_ids_and_of_repeated_ones(table):
    long = "one two three four five six"
    rows = [(5, long), (5, "other words here now"), (None, long), (3, long), (None, "alone and without any id"), (9, None), (8, "")]
    got = sorted(((r.doc_id, r.component_id) for r in simhash_variants.simhash_duplicates(table(rows)).collect()), key=repr)
    assert got == sorted([(5, 3), (5, 5), (None, 3), (3, 3), (None, None), (9, 8), (8, 8)], key=repr)
    assert simhash_variants.simhash_duplicates(table([])).collect() == []
