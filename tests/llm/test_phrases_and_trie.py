"""Collocations and the trie of conversations against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from feedloom.llm import phrase_stripes, prefix_trie
from tests.llm.conftest import ODD


def brute_collocations(rows, min_count, longest, percent, most):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < min_count:
            continue
        inside = any(
            q_lang == lang and len(q) > len(p) and c >= min_count and 100 * c >= percent * a
            and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for (q_lang, q), c in f.items()
        )
        if inside:
            continue
        cuts = [
            (1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
            for k in range(1, len(p))
        ]
        score, _, l, r = min(cuts)
        out.append((lang, " ".join(p), a, l, r, n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(x[0], i + 1, *x[1:]) for i, x in enumerate(mine[:most])]
    return sorted(ranked)


def phrase_rows(seed):
    rnd = random.Random(seed)
    words = ["The", "cat", "sat", "on", "é", "MAT", "x", "d\x00g", "-"]
    out = []
    for i in range(120):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t ", ". ", "\n", ",", " ? "]) for _ in range(rnd.randrange(30)))
        out.append((rnd.choice(["en", "de", None, "und", ""]), text + rnd.choice(["", "the cat sat on é mat"])))
    return out + [("en", t) for t in ODD] + [("en", "the cat sat"), ("en", "the cat sat")]


@pytest.mark.parametrize("percent", [100, 60])
@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, monkeypatch, small, percent):
    if small:
        # Chunks of a few pieces, every stripe in slices, and a filter that is all but full.
        monkeypatch.setattr(phrase_stripes, "CHUNK", 40)
        monkeypatch.setattr(phrase_stripes, "SLICE", 2)
        monkeypatch.setattr(phrase_stripes, "FILTER_BITS", 7)
        monkeypatch.setattr(phrase_stripes, "BUCKET", 100)
        monkeypatch.setattr(phrase_stripes, "HELD", 200)
        monkeypatch.setattr(phrase_stripes, "GATHERED", 3000)
    rows = phrase_rows(3)
    columns = "lang string, text string, phrase string, prefix string, total string, size string"
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], columns).repartition(3)
    got = phrase_stripes.collocations(docs, min_count=5, longest=4, percent=percent, most=40)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 5, 4, percent, 40)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert phrase_stripes.collocations(docs).collect() == []
    docs = spark.createDataFrame([("en", None), ("en", " . ")], "lang string, text string")
    assert phrase_stripes.collocations(docs, min_count=1).collect() == []


def test_stripes_are_whole(spark):
    docs = spark.createDataFrame([("en", "a b. a c. a b c"), ("en", "a")], "lang string, text string")
    got = {r.prefix: r for r in phrase_stripes.phrase_stripes(docs, min_count=2).where("size > 0").collect()}
    assert (got["a"].total, got["a"].best, got["a"].words, got["a"].counts) == (4, 2, ["b"], [2])
    assert (got["a b"].total, got["a b"].best, got["a b"].words) == (2, 0, [])
    assert set(got) == {"a", "b", "c", "a b"}


def brute_trie(rows):
    """Rows are (conversation, turn, role, text), no two of a conversation with the same turn."""
    turns = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1])):
        turns[conv].append((role or "", text or ""))
    built = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 6
        head = conv - int(abs(conv) % 100 * (1 if conv > 0 else -1))
        built[conv] = tuple(turns.get(head, [])[:h] + own[h:])
    members = defaultdict(list)
    for conv in sorted(built):
        for d in range(len(built[conv]) + 1):
            members[built[conv][:d]].append(conv)
    children, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        children[p[:-1]] += bool(p)
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, of in members.items():
        ends = ",".join(str(c) for c in of if built[c] == p)
        parent = members[p[:-1]][0] if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((of[0], len(p), parent, len(of), children[p], leaves[p], saved[p], digest))
    return sorted(out)


def trie_of(spark, rows, parts=3):
    columns = "conv_id long, turn long, role string, text string, node string, depth string, weight string"
    table = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], columns).repartition(parts)
    digests = prefix_trie.turn_digests(table)
    trie, ends = prefix_trie.prefix_trie(*prefix_trie.share_openings(digests))
    done = trie.join(prefix_trie.ends_digest(ends), ["conv_id", "depth"], "left")
    got = done.select(*trie.columns, F.coalesce("sha256", prefix_trie.no_ids()).alias("ends_sha256"))
    return sorted(map(tuple, got.collect()))


def test_trie(spark):
    rnd = random.Random(1)
    rows = []
    for conv in [0, 1, 2, 5, 7, 8, 9, 10, 11, 12, 100, 101, 102, 103, 104, 205, -7, -100, -130]:
        turns = [(t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "é😀", "", None, "long text"])) for t in range(rnd.randrange(1, 9))]
        if rnd.random() < 0.4:
            turns[0] = (None, *turns[0][1:])
        rows += [(conv, *t) for t in turns]
    # Copies of a whole conversation, one that goes on far below the others, and one without turns of its own.
    rows += [(conv, t, "user", f"t{t}") for conv in range(300, 325) for t in range(7)]
    rows += [(400, t, "user", f"t{t}") for t in range(20)] + [(433, t, "user", f"t{t % 15}") for t in range(40)]
    rows += [(599, 0, "user", "x")]
    got = trie_of(spark, rows)
    assert got == brute_trie(rows)
    assert any(r[1] > 35 for r in got)


def test_trie_of_odd_rows(spark):
    assert trie_of(spark, []) == []
    assert trie_of(spark, [(None, 0, "user", "a")]) == []
    # Rows without an id are left out; turns of one number come in a fixed order, whatever the order of rows.
    tied = [(200, 1, "user", "b"), (200, 1, "user", "a"), (200, 1, "user", "b"), (None, 0, "user", "c"), (250, None, None, None)]
    got = trie_of(spark, tied)
    assert got == trie_of(spark, tied[::-1], parts=1)
    assert [r[1] for r in got if r[0] == 200][:4] == [0, 1, 2, 3]


def test_rollup_over_a_path_and_a_star(spark):
    """A conversation of many turns beside many short ones: rounds follow the logarithm."""
    rows = [(0, t, "user", str(t)) for t in range(100)] + [(c * 100, 0, "user", f"s{c}") for c in range(1, 50)]
    got = {(r[0], r[1]): r for r in trie_of(spark, rows)}
    assert len(got) == 1 + 100 + 49
    assert got[0, 0][3:7] == (50, 50, 50, 0)
    assert all(got[0, d][3:7] == (1, int(d < 100), 1, 0) for d in range(1, 101))
