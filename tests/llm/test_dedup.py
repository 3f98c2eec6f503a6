"""Near duplicates, repeated lines and repeated strings against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import bwt_dedup, components, line_runs, sketch_dedup
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def near_copies(rnd, groups=12, copies=8):
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(groups):
        base = rnd.choices(vocabulary, k=rnd.choice([3, 40, 120]))
        for _ in range(copies):
            words = list(base)
            for _ in range(rnd.randrange(0, 1 + len(base) // 25 + 1)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            out.append(" ".join(words).upper() if rnd.random() < 0.2 else "\t".join(words))
    return out


def shingle_set(text):
    words = WORD.findall(lower(text))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(sets):
    least = {i: i for i in sets}
    changed = True
    links = [
        (i, j) for i in sets for j in sets
        if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    while changed:
        changed = False
        for i, j in links:
            low = min(least[i], least[j])
            if (least[i], least[j]) != (low, low):
                least[i] = least[j] = low
                changed = True
    return least


@pytest.mark.parametrize("seed", [0, 1])
def test_near_duplicates(table, seed):
    rnd = random.Random(seed)
    texts = near_copies(rnd) + ODD
    rnd.shuffle(texts)
    got = {r.doc_id: r for r in sketch_dedup.near_duplicates(table(texts)).collect()}
    sets = {i: shingle_set(t) for i, t in enumerate(texts)}
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in got.items()} == brute_components(sets)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def template_pages(rnd, n, own=55, shared=60):
    """Pages that share well over half of their words in a row, and some with a near copy."""
    template = [f"t{i}" for i in range(shared)]
    pages = []
    for i in range(n):
        words = template + [f"p{i}w{rnd.randrange(10**6)}" for _ in range(own)]
        pages.append(" ".join(words))
        if i % 40 == 0:
            pages.append(" ".join([*words[:-2], "changed", "end"]))
    return pages


@pytest.mark.parametrize("crowd", [1 << 21, 50])
def test_pages_of_one_template_do_not_meet(spark, table, monkeypatch, crowd):
    """They fill buckets together, but have no rare shingle in common; their near copies do."""
    met = []
    whole = sketch_dedup._open_pairs

    def counted(entries, *args):
        met.append(entries.count())
        return whole(entries, *args)

    monkeypatch.setattr(sketch_dedup, "_open_pairs", counted)
    monkeypatch.setattr(sketch_dedup, "CROWD", crowd)
    texts = template_pages(random.Random(1), 200)
    got = {r.doc_id: r.component_id for r in sketch_dedup.near_duplicates(table(texts)).collect()}
    assert got == brute_components({i: shingle_set(t) for i, t in enumerate(texts)})
    assert len(set(got.values())) == 200
    assert crowd > 50 or max(met) < 3 * len(texts)


@pytest.mark.parametrize("seed", [0, 1])
def test_near_duplicates_of_crowded_buckets(table, monkeypatch, seed):
    monkeypatch.setattr(sketch_dedup, "CROWD", 1)
    texts = near_copies(random.Random(seed), copies=12) + template_pages(random.Random(seed), 30) + ODD
    got = {r.doc_id: r.component_id for r in sketch_dedup.near_duplicates(table(texts)).collect()}
    assert got == brute_components({i: shingle_set(t) for i, t in enumerate(texts)})


def test_recall_on_the_given_documents(spark):
    """Groups of the tables at hand are those of all pairs: no link is lost there."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {r.doc_id: shingle_set(r.text) for r in docs.collect()}
    holders = {}
    for i, s in sets.items():
        for shingle in s:
            holders.setdefault(shingle, []).append(i)
    shared = Counter(pair for of in holders.values() for pair in itertools.combinations(sorted(of), 2))
    least = {i: i for i in sets}
    links = [(i, j) for (i, j), n in shared.items() if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n)]
    for _ in range(len(sets)):
        before = dict(least)
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
        if least == before:
            break
    got = {r.doc_id: r.component_id for r in sketch_dedup.near_duplicates(docs).collect()}
    assert len(links) > 50 and got == least


def test_near_duplicates_without_ids_and_with_repeated_rows(table):
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (None, text), (7, text + " "), (None, None), (9, "other")]
    got = sorted(map(tuple, sketch_dedup.near_duplicates(table(rows)).collect()), key=repr)
    assert got == sorted(
        [(5, 3, 5, True), (5, 3, 5, True), (None, 3, None, True), (7, 3, 5, False), (None, 0, None, True), (9, 1, 9, True)],
        key=repr,
    )
    assert sketch_dedup.near_duplicates(table([])).collect() == []


def test_sketches_fill_every_bin_and_estimate():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 600).astype(np.uint64)
    sets = [a, np.concatenate([a[:480], rng.integers(0, 2**63, 120).astype(np.uint64)]), a[:1]]
    sketch = sketch_dedup.fast_sketch([np.unique(s) for s in sets], 512)
    assert (sketch != np.uint64(2**64 - 1)).all()
    assert abs((sketch[0] == sketch[1]).mean() - 480 / 720) < 0.08


def test_components(spark):
    rnd = random.Random(4)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    least = {n: n for pair in links for n in pair}
    for _ in range(500):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.component for r in got} == {n: least[n] for n in linked}
    assert len(got) == len(linked)


LINES = ["A repeated line of enough length", "  a REPEATED line of enough length\t", "short", "", "unique enough line number {}"]


@pytest.mark.parametrize("batches", [1, 3])
def test_repeated_lines(table, batches):
    rnd = random.Random(batches)
    texts = ["\n".join(rnd.choices(LINES, k=rnd.randrange(1, 6))).format(i, i, i, i, i) for i in range(40)] + ODD
    rows = [(i * 3 % 1000, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in line_runs.drop_repeated_lines(table(rows), batches=batches).collect()}

    def key(line):
        bare = line.strip(" \t\n\x0b\x0c\r")
        return lower(bare) if len(bare) >= 20 else None

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) is None or len(holders[key(x)]) < 3 or doc == max(holders[key(x)])]
        assert (got[doc].n_lines, got[doc].n_dropped, got[doc].kept) == (len(lines), len(lines) - len(kept), "\n".join(kept))


def test_lines_without_ids(table):
    line = LINES[0]
    rows = [(None, line), (None, line), (1, line), (2, line + "\nx"), (2, line + "\nx")]
    got = sorted(map(tuple, line_runs.drop_repeated_lines(table(rows)).collect()), key=repr)
    assert got == sorted([(None, 1, 1, ""), (None, 1, 1, ""), (1, 1, 1, ""), (2, 2, 0, line + "\nx"), (2, 2, 0, line + "\nx")], key=repr)
    assert line_runs.drop_repeated_lines(table([])).collect() == []


def test_runs_know_what_they_hold(spark):
    runs = line_runs.LineRuns(spark, buckets=2, fanout=2)
    for batch in ([1, 2, 3], [3, 4], [4, 5, 6]):
        rows = [(h, -h, 10 - h) for h in batch]
        lines = spark.createDataFrame(rows, "h1 long, h2 long, doc_id long")
        known = {r.h1 for r in runs.merged().collect()} if runs.levels else set()
        assert {r.h1 for r in runs.flagged(lines).where("not seen").collect()} == set(batch) - known
        runs.add(lines)
    rows = runs.merged().collect()
    assert len(rows) == 6
    assert {r.h1: (r.n, r.owner) for r in rows} == {
        1: (1, 9), 2: (1, 8), 3: (2, 7), 4: (2, 6), 5: (1, 5), 6: (1, 4)
    }


    names = [name for level in runs.levels for name in level]
    assert names and all(spark.catalog.tableExists(name) for name in names)
    runs.drop()
    assert not any(spark.catalog.tableExists(name) for name in names)


def test_lines_are_counted_over_batches(table):
    """Two documents of one batch and one of another: each run alone has too few of them."""
    rows = [(i, f"{LINES[4].format(i)}\n{LINES[4].format('x') if i in (3, 4, 28) else ''}") for i in range(30)]
    for batches in (2, 3, 5):
        got = {r.doc_id: r.n_dropped for r in line_runs.drop_repeated_lines(table(rows), batches=batches).collect()}
        assert got == {i: int(i in (3, 4)) for i in range(30)}


def test_the_merge_with_the_runs_decides_the_owner(table, monkeypatch):
    """Without it every batch would name an owner of its own."""
    rows = [(i, LINES[0]) for i in range(30)]

    def kept():
        return {r.doc_id for r in line_runs.drop_repeated_lines(table(rows), batches=3).collect() if r.kept}

    assert kept() == {29}
    monkeypatch.setattr(line_runs.LineRuns, "flagged", lambda self, keys: keys.withColumn("seen", F.lit(False)))
    assert kept() != {29}


def brute_strings(rows, length=bwt_dedup.LENGTH):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        cover = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                cover[i : i + length] = True
            seen.add(window)
        out[doc] = bytes(np.frombuffer(data, np.uint8)[~cover])
    return out


def passages(rnd):
    words = [f"{rnd.randrange(10**6):x}" for _ in range(3000)]
    shared = [" ".join(rnd.choices(words, k=30)) for _ in range(5)]
    out = []
    for _ in range(60):
        parts = [" ".join(rnd.choices(words, k=rnd.randrange(1, 25)))]
        for _ in range(rnd.randrange(3)):
            cut = rnd.choice(shared)
            parts += [cut[rnd.randrange(20) :], " ".join(rnd.choices(words, k=rnd.randrange(8)))]
        out.append(" ".join(parts))
    return out + out[:4] + ["ab" * 400, "x" * 350, "é" * 200 + shared[0] + "\0" * 150, shared[1] + "\0" * 150]


@pytest.mark.parametrize("buckets", [1, 4])
@pytest.mark.parametrize("heavy", [False, True])
def test_repeated_strings(table, monkeypatch, buckets, heavy):
    rnd = random.Random(buckets)
    rows = [(i * 7 % 997, t) for i, t in enumerate(passages(rnd) + ODD)]
    chosen = None
    if heavy:  # take some anchors apart into windows
        found = [bwt_dedup.segments(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]
                 for _, t in rows if t and len(t.encode()) >= bwt_dedup.LENGTH]
        chosen = np.unique(np.concatenate(found))[::3]
    got = bwt_dedup.repeated_strings(table(rows), buckets=buckets, heavy=chosen).collect()
    want = brute_strings(rows)
    assert {r.doc_id: bytes(r.kept) for r in got} == want
    for r in got:
        assert r.n_bytes - sum(s.stop - s.start for s in r.removed) == len(r.kept)
        assert all(a.stop < b.start for a, b in zip(r.removed, r.removed[1:]))


def test_long_texts_and_large_anchors(monkeypatch):
    """Pieces, shards and the way for anchors with too much text, on one machine."""
    rnd = random.Random(8)
    text = " ".join(f"{rnd.randrange(10**5):x}" for _ in range(6000)) + " q" * 300
    data = np.frombuffer(text.encode(), np.uint8)
    ends = np.arange(0, 30_001, 150)
    counts = np.full(len(ends) - 1, 51)
    strings = np.concatenate([data[:15_000], data[7_500 : 22_500]])[: ends[-1]]
    monkeypatch.setattr(bwt_dedup, "SHARD_BYTES", 4000)
    merged = bwt_dedup._repeated_windows(strings, ends, counts, np.arange(len(counts)))
    hashed = bwt_dedup._repeated_by_hash(strings, ends, counts, np.arange(len(counts)))
    seen, want = set(), []
    for a in ends[:-1]:
        for i in range(51):
            window = strings[a + i : a + i + 100].tobytes()
            want.append(window in seen)
            seen.add(window)
    assert merged.tolist() == hashed.tolist() == want


def test_repeated_strings_of_equal_ids(table):
    text = "".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(6))
    rows = [(None, text), (3, text), (3, text), (4, None)]
    got = {(r.doc_id, len(r.kept)) for r in bwt_dedup.repeated_strings(table(rows)).collect()}
    assert got == {(None, len(text)), (3, 0), (4, 0)}
    assert bwt_dedup.repeated_strings(table([])).collect() == []


@pytest.mark.parametrize("parts", [1, 2])
@pytest.mark.parametrize("doc", [3, None])
def test_repeated_strings_of_equal_rows(table, doc, parts):
    """However equal rows are split, they keep what nothing starts before."""
    text = "".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(6))
    rows = [(doc, text), (doc, text)]
    got = bwt_dedup.repeated_strings(table(rows, parts)).collect()
    assert [bytes(r.kept) for r in got] == [text.encode()] * 2
    more = bwt_dedup.repeated_strings(table([*rows, (7, text), (7, text), (7, text[:90])], parts)).collect()
    assert sorted((r.doc_id or 0, len(r.kept)) for r in more) == sorted(
        [(doc or 0, 384)] * 2 + [(7, 0)] * 2 + [(7, 90)]
    )
