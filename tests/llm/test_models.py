"""The trained operators by held-out accuracy, and the pipeline by a brute-force version."""

import os
import random
import zlib

import numpy as np
import pytest

from feedloom.llm import cotraining, string_kernel
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.01"


def read(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def explicit_kernel(a, b):
    """The kernel by counting subsequences one by one."""

    def vector(word):
        out = {}
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + string_kernel.SPAN)):
                    u = word[i] + word[j] + word[k]
                    out[u] = out.get(u, 0) + string_kernel.DECAY ** (k - i + 1)
        return out

    def dot(x, y):
        return sum(v * y.get(u, 0) for u, v in x.items())

    x, y = vector(a), vector(b)
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


def test_kernel_against_counting():
    rnd = random.Random(0)
    for _ in range(30):
        a, b = ("".join(rnd.choices("abcd", k=rnd.randrange(3, 10))) for _ in range(2))
        assert string_kernel.kernel(a, b) == pytest.approx(explicit_kernel(a, b), abs=1e-5)
    assert string_kernel.kernel("blockhead", "bloxckhead") > 0.6 > string_kernel.kernel("blockhead", "seventeen")


def test_decisions_skip_nothing_that_counts():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=string_kernel.ALPHABET**3)
    words = ["".join(rng.choice(list("abcdefgh"), n)) for n in range(1, 40)]
    marks = string_kernel.Landmarks(["abcdef"])
    assert marks.kernel(["abcdef"])[0, 0] == pytest.approx(1)
    for word, found in zip(words, string_kernel.decisions(words, weights, 0.1)):
        parts = string_kernel._parts([word])[1]
        best = string_kernel.FLOOR
        for part in parts:
            if len(part) >= 3:
                total = sum(w * weights[c].sum() for c, w in string_kernel._subsequences([part]))
                if total > 0:
                    best = max(best, total / string_kernel.norms([part])[0] + 0.1)
        assert found == pytest.approx(best)


def test_toxicity_learns_from_sentences(table):
    rnd = random.Random(3)
    plain = ["".join(rnd.choices("aeioulmnrst", k=rnd.randrange(3, 9))) for _ in range(800)]
    bad = ["blockhead", "numbskull", "scoundrel"]

    def document(toxic, changed=False):
        words = rnd.choices(plain, k=60)
        if toxic:
            for _ in range(5):
                word = rnd.choice(bad)
                if changed:
                    at = rnd.randrange(2, len(word) - 2)
                    word = word[:at] + rnd.choice(["-", "x", ".", "_"]) + word[at:]
                words.insert(rnd.randrange(len(words)), word)
        return ". ".join(" ".join(words[i : i + 8]) for i in range(0, len(words), 8))

    labels = np.array([i % 4 == 0 for i in range(600)], int)
    model = string_kernel.fit([document(t) for t in labels], labels)
    texts = [document(i % 2) for i in range(100)] + [document(i % 2, True) for i in range(100)] + ODD
    got = {r.doc_id: r for r in string_kernel.toxicity(table(texts), model).collect()}
    said = [got[i].predicted == i % 2 for i in range(200)]
    assert np.mean(said[:100]) > 0.97 and np.mean(said[100:]) > 0.8
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert not any(got[i].predicted for i in range(200, 205))
    kept = string_kernel.drop_toxic(table(texts), model)
    assert kept.columns == table(texts).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    assert string_kernel.toxicity(table([]), model).collect() == []


def test_toxicity_without_labels(spark, table):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = string_kernel.fit_labelled(table(["a b c"]), none)
    assert [r.predicted for r in string_kernel.toxicity(table(["a b c", None]), model).collect()] in ([0, 0], [1, 1])


def test_held_out_toxicity(spark):
    docs, labels = read(spark, "documents", "/root/testdata/sf0.1"), read(spark, "labels", "/root/testdata/sf0.1")
    model = string_kernel.fit_labelled(docs, labels)
    held = docs.join(labels, "doc_id").where("crc32(cast(doc_id AS string)) % 5 = 0")
    got = {r.doc_id: r.predicted for r in string_kernel.toxicity(held, model).collect()}
    true = {r.doc_id: r.toxic for r in held.select("doc_id", "toxic").collect()}
    hits = [got[i] for i, t in true.items() if t]
    alarms = [got[i] for i, t in true.items() if not t]
    assert np.mean(hits) > 0.85 and np.mean(alarms) < 0.01
    # Long texts that are clean stay, those that were fitted on or not.
    long = docs.join(labels.where("toxic = 0"), "doc_id").where("octet_length(text) > 5000")
    said = [r.predicted for r in string_kernel.toxicity(long, model).collect()]
    assert len(said) > 300 and np.mean(said) < 0.01


def test_long_labelled_texts_are_fitted_on(spark, monkeypatch):
    """Of a text beyond the bound whole sentences from all over it take part."""
    fitted = []
    monkeypatch.setattr(string_kernel, "fit", lambda texts, toxic: fitted.extend(texts))
    long = "".join(f"sentence number {i} here. " for i in range(4000))
    docs = spark.createDataFrame([(1, long), (2, "short one."), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    string_kernel.fit_labelled(docs, labels)
    assert "short one." in fitted and len(fitted) == 2
    shown = next(t for t in fitted if t != "short one.")
    numbers = [int(x) for x in shown.replace("sentence number ", "").replace(" here.", "").split()]
    assert string_kernel.SAMPLE_BYTES / 2 < len(shown) <= string_kernel.SAMPLE_BYTES + 50
    assert numbers[0] == 0 and numbers[-1] > 3980 and shown.startswith("sentence number 0 here. sentence number")


def test_held_out_quality(spark):
    docs, labels = read(spark, "documents", "/root/testdata/sf0.1"), read(spark, "labels", "/root/testdata/sf0.1")
    known = labels.where("crc32(cast(doc_id AS string)) % 5 <> 0")
    model = cotraining.fit_quality(docs, known)
    held = docs.join(labels.where("crc32(cast(doc_id AS string)) % 5 = 0"), "doc_id")
    got = {r.doc_id: r for r in cotraining.quality(held, model).collect()}
    true = {r.doc_id: r.quality for r in held.select("doc_id", "quality").collect()}
    right = np.mean([got[i].predicted == t for i, t in true.items()])
    assert right > 0.97
    assert np.mean([got[i].predicted for i, t in true.items() if t]) > 0.99


def test_views_teach_each_other():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 2000)
    views = [rng.normal(size=(2000, 6)) + (y[:, None] - 0.5) * np.array([2.2, 1.2, 0, 0, 0, 0]) for _ in range(2)]
    few, many, held = slice(0, 60), slice(60, 1200), slice(1200, 2000)
    rest = [v[many] for v in views]
    find = lambda found, given: cotraining.surest(found, np.arange(len(rest[0])), rest, given)
    model = cotraining.cotrain([v[few] for v in views], y[few], find)
    score, each = model.scores([v[held] for v in views])
    right = ((score >= 0.5) == y[held]).mean()
    assert right > 0.88 and right >= max(((s >= 0.5) == y[held]).mean() for s in each) - 0.02


def test_quality_of_odd_rows(spark, table):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    docs = table([("good words " if i % 2 else "### ||| ") * (i + 3) for i in range(60)] + ODD + [(None, "x")])
    model = cotraining.fit_quality(docs, labels)
    got = cotraining.quality(docs, model).collect()
    assert len(got) == 60 + len(ODD) + 1 and all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 60]) > 0.9
    assert cotraining.quality(table([]), model).collect() == []


def test_a_round_of_exchange_sees_all_documents(spark):
    """The surest of each view and label, over batches and tasks, against a plain sort."""
    rng = np.random.default_rng(5)
    n = 3000
    features = [rng.normal(size=(n, w)).astype(np.float32) for w in cotraining.WIDTHS]
    turns = rng.permutation(10 * n)[:n].astype(np.int64)
    views = [
        cotraining.View(np.append(rng.normal(size=w), 0.3), np.zeros(w), np.ones(w), np.array([0.4, 0.1]))
        for w in cotraining.WIDTHS
    ]
    stored = [cotraining.packed(x) for x in features]
    features = [cotraining.unpacked(x, w) for x, w in zip(stored, cotraining.WIDTHS)]
    rows = [(int(t), *[x[i].as_py() for x in stored]) for i, t in enumerate(turns)]
    table = spark.createDataFrame(rows, "turn long, text binary, page binary").repartition(5)
    given = [turns[:500], turns[200:900]]
    got = cotraining.surest_of(table, views, given, most=40)
    taken = sorted(zip(got.view.tolist(), got.label.tolist(), got.turn.tolist()))
    want = []
    for v in (0, 1):
        p = 1 / (1 + np.exp(-views[v].log_odds(features[v])))
        for label, sure in ((1, p), (0, 1 - p)):
            open_ = [i for i in range(n) if sure[i] >= cotraining.SURE and turns[i] not in set(given[1 - v])]
            best = sorted(open_, key=lambda i: (-sure[i], turns[i]))[:40]
            want += [(v, label, int(turns[i])) for i in best]
    assert len(want) == 160 and taken == sorted(want)
    place = {t: i for i, t in enumerate(turns.tolist())}
    for k, t in enumerate(got.turn.tolist()):
        assert all(np.array_equal(got.features[v][k], features[v][place[t]]) for v in (0, 1))


def test_quality_without_labels_or_documents(spark, table):
    none = spark.createDataFrame([], "doc_id long, quality int")
    some = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    docs = table(["a b", "c", None, (None, "d")])
    for rows, labels in ((docs, none), (docs.limit(0), some), (docs.limit(0), none)):
        model = cotraining.fit_quality(rows, labels)
        got = cotraining.quality(docs, model).collect()
        assert [(r.score, r.text_score, r.page_score) for r in got] == [(0.5, 0.5, 0.5)] * 4
    model = cotraining.fit_quality(docs, some)
    assert all(0 <= r.score <= 1 for r in cotraining.quality(docs, model).collect())


def test_the_driver_gives_back_what_the_fit_has_used(spark, monkeypatch):
    kept = []

    def fit(texts, toxic):
        used = [bytes(2_000) for _ in range(150_000)]
        kept.extend(used[::1_000])

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    monkeypatch.setattr(string_kernel, "fit", fit)
    docs = spark.createDataFrame([(1, "text"), (2, "text")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    before = resident()
    string_kernel.fit_labelled(docs, labels)
    assert len(kept) == 150 and resident() - before < 100 << 20
