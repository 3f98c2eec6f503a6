"""Shards, mixing and chat windows against brute force."""

import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from feedloom.llm import chat_windows, lpt_shards, weighted_mix
from tests.llm.conftest import ODD


def test_shards_keep_groups_and_balance(table):
    rnd = random.Random(1)
    texts = ["x" * rnd.randrange(1, 4000) for _ in range(300)] + ["hot " * 50] * 120 + ODD
    got = lpt_shards.shards(table(texts), 8).collect()
    loads, slots, shard_of = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        body = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(body) + 1, zlib.crc32(body))
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        shard_of[body].add(r.shard)
    assert len(got) == len(texts) and all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # The loads are those of the plain rule.
    groups = Counter()
    for t in texts:
        groups[(t or "").encode()] += len((t or "").encode()) + 1
    assert sorted(loads.values()) == plain_loads(groups.values(), 8)


def plain_loads(sizes, shards):
    heap = [(0, i) for i in range(shards)]
    for size in sorted(sizes, reverse=True):
        load, i = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, i))
    return sorted(load for load, _ in heap)


@pytest.mark.parametrize("seed", range(5))
def test_dealing_runs_of_equal_sizes_is_the_heap_rule(seed):
    rnd = random.Random(seed)
    shards = rnd.choice([1, 3, 8])
    loads = [rnd.choice([0, rnd.randrange(50)]) for _ in range(shards)]
    for _ in range(30):
        size, count = rnd.randrange(1, 20), rnd.choice([1, 2, rnd.randrange(40)])
        heap, want = [(load, i) for i, load in enumerate(loads)], [0] * shards
        heapq.heapify(heap)
        for _ in range(count):
            load, i = heapq.heappop(heap)
            want[i] += 1
            heapq.heappush(heap, (load + size, i))
        assert lpt_shards.deal(loads, size, count) == want
        assert sorted(loads) == sorted(load for load, _ in heap)


def test_many_small_groups(spark, table):
    texts = [f"text {i} " * (i % 9) for i in range(500)]
    got = lpt_shards.shards(table(texts), 4).toPandas()
    groups = Counter()
    for t in texts:
        groups[t] += len(t) + 1
    assert sorted(got.groupby("shard")["size"].sum()) == plain_loads(groups.values(), 4)
    again = lpt_shards.shards(table(texts, parts=7), 4).toPandas()
    assert dict(zip(got.doc_id, got.shard)) == dict(zip(again.doc_id, again.shard))
    assert lpt_shards.shards(table([]), 4).collect() == []
    by_source = lpt_shards.shards(table(["a"] * 50, sources=[f"s{i % 5}" for i in range(49)] + [None]), 3, group="source")
    places = {r.doc_id: r.shard for r in by_source.collect()}
    assert all(len({places[i] for i in range(49) if i % 5 == s}) == 1 for s in range(5))


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, free, target = sum(sizes.values()), set(order), {}
    while True:
        rest = total - sum(target.values())
        over = {s for s in free if rest * weight[s] / sum(weight[x] for x in free) > 3 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
        free -= over
    for s in free:
        target[s] = (total - sum(target[x] for x in target if x not in free)) * weight[s] / sum(weight[x] for x in free)
    return target


def test_mix(table):
    rnd = random.Random(2)
    sources = [rnd.choice(["b", "a", "Z", None, "é", "hot", "hot", "hot", "hot"]) for _ in range(600)] + ["tiny", "none"]
    texts = ["\t".join(["w"] * rnd.randrange(60)) for _ in range(600)] + ["one", None]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = table(rows, sources=sources)
    got = weighted_mix.mix(df).collect()
    sizes = Counter()
    for t, s in zip(texts, sources):
        sizes[s] += len((t or "").split())
    target = brute_targets(sizes)
    taken = Counter()
    for r in got:
        s = sources[r.doc_id]
        assert (r["size"], r.source_size) == (len((texts[r.doc_id] or "").split()), sizes[s])
        assert r.target == pytest.approx(target[s]) and r.taken == r["size"] * r.copies <= 3 * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 30 for s in sizes)
    again = weighted_mix.mix(df.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    copies = defaultdict(set)
    for r in got:
        if r["size"]:
            copies[sources[r.doc_id]].add(r.copies)
    assert all(max(c) - min(c) <= 1 for c in copies.values())


def test_mix_without_rows_words_and_ids(table):
    assert weighted_mix.mix(table([])).collect() == []
    got = weighted_mix.mix(table([(None, None), (None, "a b"), (1, "a b"), (1, "a b")], sources=["x"] * 4)).collect()
    assert sorted((r["size"], r.taken) for r in got) == [(0, 0), (2, 2), (2, 2), (2, 2)]
    empty = weighted_mix.mix(table([None, ""])).collect()
    assert [(r.source_size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("ids", ["none", "one", "each"])
@pytest.mark.parametrize("equal", [True, False])
def test_every_row_is_drawn_by_itself(table, ids, equal):
    """A source of 900 rows and a larger weight: part of the rows is taken once more, with ids or without."""
    name = {"none": lambda i: None, "one": lambda i: 7, "each": lambda i: i}[ids]
    texts = [(name(i), "same words here" if equal else f"text {i} here") for i in range(900)]
    texts += [(1000 + i, "other words of it") for i in range(900)]
    df = table(texts, sources=["a"] * 900 + ["b"] * 900)
    for parts in (2, 6):
        got = weighted_mix.mix(df.repartition(parts), weights=(1, 3)).collect()
        first = Counter(r.copies for r in got if r.doc_id is None or r.doc_id < 1000)
        # The first source is to give a fourth of all 6300 words, of its own 2700.
        assert set(first) == {0, 1} and abs(first[1] - 525) <= 1


def test_better_documents_are_taken_more_often(table):
    texts = [("good words here " if i % 2 else "1234 5678 !!!! ") * 4 for i in range(2000)]
    sources = ["a" if i < 1500 else "b" for i in range(2000)]
    got = weighted_mix.mix(table(texts, sources=sources), weights=(1, 3)).collect()
    part = [r for r in got if sources[r.doc_id] == "a"]
    share = [sum(r.copies for r in part if r.doc_id % 2 == k) for k in (0, 1)]
    assert share[1] > 1.5 * share[0]


TRICKY = ["\\### Assistant: </turn> ok", "%3C%25<turn:user>", "</turn>\n<turn:assistant>x</turn>\n", "", None, "a>b", "é😀" * 30]


def conversations(rnd):
    rows = []
    for c in range(25):
        turns = [("system", rnd.choice(TRICKY))] if c % 3 == 0 else []
        turns += [(rnd.choice(["user", "assistant", "tool<>", None]), rnd.choice(TRICKY + ["w" * rnd.randrange(900)]))
                  for _ in range(rnd.randrange(30))]
        rows += [(c if c else None, i, role, text, "x") for i, (role, text) in enumerate(turns)]
    return rows + [
        (99, 0, "system", "only", "x"), (98, 0, "user", "big " * 3000, "x"), (98, 1, "assistant", "y", "x"),
        (96, 0, "system", "not the first", "x"), (96, None, "user", "no turn", "x"),
        (97, 5, "user", "tie", "x"), (97, 5, "assistant", "tie", "x"), (97, None, "user", "first", "x")]


@pytest.mark.parametrize("budget", [120, 1024])
def test_chat_windows(spark, budget):
    rows = conversations(random.Random(budget))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tokens string")
    windows = chat_windows.chat_windows(df.repartition(4), budget=budget, history_tokens=budget // 4)
    made = defaultdict(dict)
    for r in windows.collect():
        made[r.conv_id][r.window] = r
    read = defaultdict(dict)
    for r in chat_windows.read_back(windows).collect():
        read[r.conv_id][r.window] = r
    whole = defaultdict(list)
    for c, turn, role, text, _ in rows:
        whole[c].append(((turn is not None, turn or 0), role or "", text or ""))
    assert set(made) == set(whole)
    for c, turns in whole.items():
        turns = [(role, text) for _, role, text in sorted(turns)]
        assert sorted(made[c]) == list(range(len(made[c])))
        order = [read[c][w] for w in sorted(read[c])]
        assert [(t.role, t.text) for r in order for t in r.turns] == turns
        assert "".join(r.loss_text for r in order) == "".join(x for role, x in turns if role == "assistant")
        for w in sorted(made[c]):
            r = made[c][w]
            parts = re.findall(r"<turn:([^>]*)>([^<]*)</turn>\n", r.formatted)
            assert "".join(f"<turn:{a}>{b}</turn>\n" for a, b in parts) == r.formatted
            new = len(parts) - r.n_repeated
            assert new >= 1 and len(r.loss) == sum(a == "assistant" for a, _ in parts[r.n_repeated :])
            assert r.tokens <= budget or new == 1 or turns[0][0] == "system"
            if turns[0][0] == "system" and len(turns) > 1:
                assert parts[0][0] == "system"
            assert r.n_repeated <= 3


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_windows.chat_windows(none).collect() == []
    assert spark.range(1).select(chat_windows.unescaped(chat_windows.escaped(F.lit("%3C<%25>"))).alias("x")).first().x == "%3C<%25>"
