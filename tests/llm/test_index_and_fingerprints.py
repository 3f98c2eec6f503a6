"""The phrase index and the fingerprints against brute force."""

import random
import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from feedloom.llm import fingerprints, phrase_index
from tests.llm.conftest import ODD
from tests.llm.test_dedup import lower, shingle_set

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(lower(text))


def corpus(rnd):
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "日本", "x9"]
    items = [" ".join(rnd.choices(vocabulary, k=k)) for k in (25, 12, 10, 3, 1)] + ["", None, "- !", "w1, W2. w3"]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randrange(40))) for _ in range(40)]
    for i in range(0, 40, 3):
        asked = words(items[i % 4])
        a = rnd.randrange(max(len(asked) - 11, 1))
        texts[i] += " " + "; ".join(w.upper() for w in asked[a : a + 14]) + " " + texts[(i + 1) % 40]
    return texts + ODD, items


def brute(texts, items, size=10):
    windows = {}
    for i, item in items:
        w = words(item)
        n = min(size, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a : a + n]), set()).add(i)
    out = {}
    for doc, text in enumerate(texts):
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[a : a + n])):
                    hit |= set(range(a, a + n))
                    found |= owners
        out[doc] = (len(w), len(hit), sorted(str(i) for i in found if i is not None), bool(hit))
    return out


@pytest.mark.parametrize("block", [200, 4 << 20])
def test_contamination(spark, table, monkeypatch, block):
    monkeypatch.setattr(phrase_index, "BLOCK", block)
    texts, items = corpus(random.Random(block))
    rows = [(i if i != 2 else None, t) for i, t in enumerate(items)]
    asked = spark.createDataFrame(rows, "item_id long, text string")
    got = phrase_index.contamination(table(texts), asked).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got} == brute(texts, rows)
    for r in got:
        assert sum(s.stop - s.start for s in r.spans) == r.n_hit


def test_nothing_to_look_for(spark, table):
    none = spark.createDataFrame([], "item_id long, text string")
    got = phrase_index.contamination(table(["a b", None, (None, "c")]), none).collect()
    assert sorted((r.n_words, r.n_hit, r.contaminated) for r in got) == [(0, 0, False), (1, 0, False), (2, 0, False)]
    assert phrase_index.contamination(table([]), none).collect() == []


def test_proximity(spark, table):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choices("a b c d e f g".split(), k=30)) for _ in range(20)] + ["a", "c b a", "a x x x b c"]
    asked = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    index = phrase_index.build_index(table(texts))
    queries = phrase_index.query_blocks(asked, size=3)
    for slop in (0, 2):
        found = phrase_index.search(index, queries, slop).join(
            phrase_index.indexed_documents(index), ["block", "nth"]
        ).collect()
        span = 3 + slop
        want = set()
        for doc, text in enumerate(texts):
            w = text.split()
            if any({"a", "b", "c"} <= set(w[a : a + span]) for a in range(len(w))):
                want.add(doc)
        assert {r.doc_id for r in found} == want
        for r in found:
            for a, b in zip(r.starts, r.stops):
                assert {"a", "b", "c"} <= set(texts[r.doc_id].split()[a:b]) and b - a <= span


def test_edit_trial(table):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choices([f"v{i}" for i in range(500)], k=rnd.randrange(400))) for _ in range(30)] + ODD
    rows = [(i * 11 % 401, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in fingerprints.edit_trial(table(rows, parts=5)).collect()}
    ordered = sorted(rows)
    close = []
    for (doc, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = text or "", after or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha256(edited.encode()).hexdigest())
        for estimate, other in ((r.near_edited, edited), (r.near_next, after)):
            a, b = shingle_set(text), shingle_set(other)
            true = len(a & b) / len(a | b) if a or b else 1.0
            close.append(abs(estimate - true))
            assert abs(estimate - true) < 0.16 and 0 <= estimate <= 1
    assert np.mean(close) < 0.03 and len(got) == len(rows)
    same = [got[d].fingerprint for d, t in rows if t == "same text twice " * 9]
    assert len(same) == 2 and len(set(same)) == 1


def test_edit_trial_of_few_rows(table):
    one = fingerprints.edit_trial(table(["one two three four five six seven eight"])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprints.edit_trial(table([])).collect() == []
    twice = fingerprints.edit_trial(table([(1, "a b"), (1, "a b"), (None, None)])).collect()
    assert sorted((r.n_chars, r.fingerprint == "empty") for r in twice) == [(0, True), (3, False), (3, False)]


def test_fingerprints_compare(table):
    texts = [" ".join(f"a{i}" for i in range(300)), " ".join(f"a{i}" for i in range(150, 450)), "", None]
    found = fingerprints.fingerprints(table(texts)).collect()
    by = {r.doc_id: r.fingerprint for r in found}
    assert by[2] == by[3] == "empty" and len(by[0]) == fingerprints.BINS * fingerprints.BITS // 4
    packed, some = fingerprints.fingerprint_texts(pa.array(texts, pa.large_string()))
    assert fingerprints.as_strings(packed, some) == [by[i] for i in range(4)]
    alike = fingerprints.likeness(packed[:1], some[:1], packed[1:2], some[1:2])[0]
    assert abs(alike - 146 / 446) < 0.1
