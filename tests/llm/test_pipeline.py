"""Queries against their SQL, and the pipeline stage by stage."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm import queries, string_kernel, weighted_mix
from tests.llm.test_dedup import brute_components, shingle_set

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_against_sql(spark, sql, name):
    found = queries.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    got = sorted(map(repr, (tuple(r) for r in found.select(columns).collect())))
    result = sql.execute(queries.ORACLE[name])
    place = [[d[0] for d in result.description].index(c) for c in columns]
    want = sorted(repr(tuple(row[i] for i in place)) for row in result.fetchall())
    assert got == want


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    stage = dict(corpus_pipeline.STAGES)

    def rows(df):
        return [tuple(r) for r in df.collect()]

    clean = stage["toxicity"](spark, docs, sf)
    assert clean.columns == columns
    model = string_kernel.fit_labelled(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    said = {r.doc_id for r in string_kernel.toxicity(docs, model).where("predicted = 1").collect()}
    assert sorted(rows(clean)) == sorted(r for r in rows(docs) if r[0] not in said)

    single = stage["near_dedup"](spark, docs, sf)
    sets = {r[0]: shingle_set(r[1]) for r in rows(docs)}
    first = brute_components(sets)
    assert single.columns == columns
    assert sorted(r[0] for r in rows(single)) == sorted(i for i in sets if first[i] == i)

    free = stage["decontamination"](spark, docs, sf)
    hit = {r.doc_id for r in queries.contamination(spark, sf).where("contaminated").collect()}
    assert hit and sorted(rows(free)) == sorted(r for r in rows(docs) if r[0] not in hit)

    mixed = stage["mixing"](spark, docs, sf)
    times = {r.doc_id: r.taken // max(r["size"], 1) for r in queries.mixed(spark, sf).collect()}
    assert mixed.columns == columns
    assert Counter(r[0] for r in rows(mixed)) == Counter({i: int(t) for i, t in times.items() if t})

    shards = stage["sharding"](spark, mixed, sf).collect()
    assert sum(times.values()) == len(shards)


def test_whole_run(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert len(got) > 50 and {r.shard for r in got} == set(range(8))


def test_stages_without_rows_and_with_odd_ones(spark, table):
    sf = "/root/testdata/sf0.001"
    odd = table([None, "", "a", "a", (None, "x " * 30), (None, None), (3, "y " * 30), (3, "y " * 30)])
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, odd.limit(0)):
            out = stage(spark, docs, sf)
            n = len(out.collect())
            assert n == 0 or docs is odd
            assert name == "sharding" or out.columns == docs.columns


def odd_rows():
    """Clean and contaminated texts without an id and of a repeated one, and equal rows."""
    clean = [f"clean text {i} " + "word " * (3 * i + 1) for i in range(12)]
    rows = [(None, t) for t in clean[:6]] + [(7, t) for t in clean[6:9]]
    return rows + [(i + 20, t) for i, t in enumerate(clean[9:])] + [(None, "equal rows here")] * 5 + [(None, None)]


def test_rows_of_one_id_are_judged_by_themselves(spark, table, tmp_path):
    phrase = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, phrase)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    bad = [(None, f"see {phrase} there"), (7, phrase), (30, phrase), (30, "another clean one")]
    docs = table(odd_rows() + bad)
    free = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    want = [*odd_rows(), bad[-1]]
    assert Counter((r.doc_id, r.text) for r in free.collect()) == Counter(want)


def test_mixing_takes_each_row_as_the_mix_does(spark, table):
    rows = odd_rows()
    flat = table(rows, sources=[f"s{i % 4}" for i in range(len(rows))]).drop("map").fillna("en", ["lang"])
    docs = spark.createDataFrame(flat.collect(), flat.schema)
    mix = weighted_mix.mix(docs.withColumn("own", F.concat_ws("|", "source", "text")), carry=["own"]).collect()
    want = Counter()
    for r in mix:
        want[r.doc_id, r.own] += r.copies
    got = corpus_pipeline.mixing(spark, docs, "")
    assert got.columns == docs.columns
    assert Counter((r.doc_id, f"{r.source}|{r.text}") for r in got.collect()) == +want
    assert len({r.copies for r in mix if r.doc_id is None and r.size}) > 1


def test_mixing_splits_equal_rows(spark, table):
    """A source that fills up amid equal rows takes only some of them."""
    docs = table([(None, "alike " * 3)] * 9 + [(1, "other " * 40)], sources=["a"] * 9 + ["b"])
    want = Counter({i: 0 for i in (None, 1)})
    for r in weighted_mix.mix(docs).collect():
        want[r.doc_id] += r.copies
    assert want[None] % 9
    docs = spark.createDataFrame(docs.withColumn("lang", F.lit("en")).collect(), docs.schema)
    assert Counter(r.doc_id for r in corpus_pipeline.mixing(spark, docs, "").collect()) == want


def test_near_copies_without_an_id_or_of_a_repeated_one(spark, table):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, text + " end"), (None, "quite another text of six words"), (5, text), (5, text), (5, "five of another kind altogether here")]
    rows += [(3, text + " stop"), (3, text + " stop"), (None, ""), (None, ""), (None, None), (4, "no id and id alike here"), (None, "no id and id alike here")]
    want = [rows[2], rows[5], rows[6], *rows[8:12]]
    flat = table(rows, sources=["s"] * len(rows)).fillna("en", ["lang"])
    for parts in (1, 5):
        out = corpus_pipeline.near_dedup(spark, flat.repartition(parts), "")
        assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(want)
    equal = table([(None, text)] * 4, sources=["s"] * 4).fillna("en", ["lang"])
    assert corpus_pipeline.near_dedup(spark, equal, "").count() == 1


CLASHING = ["_row1", "_ROW2", "_node", "_twin", "_text1", "_text", "_copies", "_copy", "component_id", "n", "all", "more", "kept", "id"]


def clashing(df):
    """Documents with columns that the stages use names like."""
    return df.withColumns({c: F.concat(F.lit(f"{c}-"), F.coalesce("text", F.lit("null"))) for c in CLASHING})


def test_stages_with_clashing_names(spark, table, tmp_path):
    phrase = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, phrase)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    flat = table(odd_rows() + [(50, phrase)], sources=[f"s{i % 4}" for i in range(len(odd_rows()) + 1)])
    plain = spark.createDataFrame(flat.drop("map").fillna("en", ["lang"]).collect(), flat.drop("map").schema)
    for stage in (corpus_pipeline.near_dedup, corpus_pipeline.decontamination, corpus_pipeline.mixing):
        want = stage(spark, plain, str(tmp_path))
        got = stage(spark, clashing(plain), str(tmp_path))
        assert got.columns == clashing(plain).columns
        # Of equal texts without an id any may stay, whatever source it has.
        assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((r.doc_id, r.text) for r in want.collect())
        assert all(r[c] == f"{c}-{r.text if r.text is not None else 'null'}" for r in got.collect() for c in CLASHING)


def test_rows_whose_hashes_are_half_equal(spark, table, tmp_path, monkeypatch):
    """Different rows that share one half of their hash are still told apart."""
    whole = corpus_pipeline._with_hash

    def weak(docs, names, columns):
        return whole(docs, names, columns).withColumn(names[0], F.pmod(F.col(names[0]), F.lit(3)))

    phrase = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, phrase)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"text of number {i} and more words") for i in range(8)] + [(20, text), (21, text + " end"), (30, phrase), (31, None)]
    docs = table(rows, sources=["s"] * len(rows)).fillna("en", ["lang"])
    monkeypatch.setattr(corpus_pipeline, "_with_hash", weak)
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert kept == {r[0] for r in rows} - {21}
    free = {r.doc_id for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()}
    assert free == {r[0] for r in rows} - {30}


def plain_run(docs, items, toxic, sf):
    """The pipeline in plain Python on rows; what the trained model says is given."""
    rows = [r for r in docs if not toxic(r)]
    # Near copies: equal rows are one; then the least id of each group, rows without one last.
    distinct = sorted(set(rows), key=lambda r: (r.doc_id is None, r.doc_id or 0, str(r)))
    sets = {i: shingle_set(r.text) for i, r in enumerate(distinct)}
    first = brute_components(sets)
    times = Counter(rows)
    rows = [r for i, r in enumerate(distinct) for _ in range(1 if sets[i] else times[r]) if first[i] == i]

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = set()
    for item in items:
        w = words(item.text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(len(w) - 9, 1))} if w else set()
    sizes = {len(w) for w in windows}

    def hit(r):
        w = words(r.text)
        return any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    return [r for r in rows if not hit(r)]


def test_the_chain_against_plain_python(spark, tmp_path):
    """Toxicity, near copies and contamination one after the other; then what mixing and sharding say of the rest."""
    sf, small = "/root/testdata/sf0.001", str(tmp_path)
    whole = spark.read.parquet(f"{sf}/documents.parquet")
    odd = [Row(doc_id=i, text=t, lang="en", source=s, n_chars=n) for i, t, s, n in (
        (None, "no id here at all now", "src1", 1), (None, "no id here at all now", "src1", 1), (None, None, None, None),
        (7, "an id of two rows " * 4, "src2", 2), (7, "another row of that id " * 3, None, 3), (None, "", "src1", 0),
    )]
    docs = whole.unionByName(spark.createDataFrame(odd, whole.schema)).repartition(3)
    docs.write.parquet(f"{small}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{small}/{name}.parquet")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = string_kernel.fit_labelled(docs, spark.read.parquet(f"{small}/labels.parquet"))
    texts = [r.text for r in docs.select("text").distinct().collect()]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    said = {texts[r.doc_id]: r.predicted for r in string_kernel.toxicity(rows, model).collect()}
    items = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    want = plain_run(docs.collect(), items, lambda r: said[r.text], small)
    assert 20 < len(want) < len(docs.collect()) - 20
    left = spark.createDataFrame(want, whole.schema)
    taken = Counter()
    for r in weighted_mix.mix(left.withColumn("own", F.to_json(F.struct("*"))), carry=["own"]).collect():
        taken[r.own] += r.copies
    sizes = {r.own: (r.doc_id, r.size) for r in left.withColumn("own", F.to_json(F.struct("*"))).select(
        "own", "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("size")).collect()}
    got = corpus_pipeline.run(spark, small).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == sum((Counter({sizes[o]: n}) for o, n in taken.items()), Counter())
    slots = Counter((r.shard, r.slot) for r in got)
    assert set(slots.values()) == {1}
    assert all(max(s for d, s in slots if d == shard) == sum(d == shard for d, _ in slots) - 1 for shard in {d for d, _ in slots})


def test_only_the_entry_guards_imports():
    text = open(corpus_pipeline.__file__).read()
    assert not re.search(r"except\s+(Import|ModuleNotFound)Error", text)
