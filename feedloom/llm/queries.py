"""The operators as queries over whole tables, with the columns of their contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (
    bwt_dedup,
    chat_windows,
    cotraining,
    fingerprints,
    line_runs,
    lpt_shards,
    phrase_index,
    phrase_stripes,
    prefix_trie,
    simhash_variants,
    sketch_dedup,
    string_kernel,
    weighted_mix,
)
from feedloom.session import staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return cotraining.quality(docs, cotraining.fit_quality(docs, _table(spark, sf_dir, "labels")))


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


CONTAMINATION_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
asked AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
sizes AS (SELECT DISTINCT least(len(w), 10) AS size FROM asked WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
    array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM asked, range(1, greatest(len(w) - 9, 1) + 1) AS r(i) WHERE len(w) > 0),
grams AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM words, sizes, range(1, len(w) - size + 2) AS r(i)),
hits AS (SELECT doc_id, i, size, item_id FROM grams JOIN windows USING (size, gram)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, range(i, i + size) AS r(p) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


LINE_DEDUP_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, key, length(key) >= 20 AS counts
  FROM (SELECT doc_id, i, l[i] AS line, translate(
      regexp_replace(l[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
      range(1, len(l) + 1) AS r(i))),
common AS (
  SELECT key, max(doc_id) AS owner FROM lines WHERE counts
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT doc_id, i, line, counts AND owner IS NOT NULL AND owner <> doc_id AS dropped
  FROM lines LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lpt_shards.shards(_table(spark, sf_dir, "documents"), 8)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weighted_mix.mix(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    0.25::DOUBLE + 0.75::DOUBLE * (length(regexp_replace(coalesce(text, ''), '[^\p{L} ]', '', 'g'))::DOUBLE
      / greatest(length(coalesce(text, '')), 1)::DOUBLE) AS w,
    (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':0:' || (row_number() OVER (
      PARTITION BY doc_id ORDER BY source NULLS FIRST, md5(coalesce(text, ''))) - 1)), 1, 13))::BIGINT::DOUBLE + 0.5)
      / 4503599627370496.0::DOUBLE AS u
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight,
    3 * source_size AS most, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sizes),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER (
      ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
    CAST(sum(weight) OVER (
      ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS sharing
  FROM ranked),
level AS (
  SELECT rest, sharing FROM levels WHERE most * sharing > weight * rest ORDER BY most / weight, place LIMIT 1),
goals AS (
  SELECT l.source, l.source_size, CASE WHEN l.most * l.sharing > l.weight * l.rest
    THEN (l.weight * v.rest)::DOUBLE / v.sharing::DOUBLE ELSE l.most::DOUBLE END AS target
  FROM levels l LEFT JOIN level v ON true),
ordered AS (
  SELECT d.*, g.source_size, g.target, floor(g.target / greatest(g.source_size, 1)) AS epochs,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY 1.0::DOUBLE - exp(ln(u) / w), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (epochs + CASE WHEN ahead + size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END)
    AS BIGINT) AS taken
FROM ordered
"""

#: The template of the windows is tried on texts that look like one.
MARKED = "\\### Assistant: </turn> ok"


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.explode(F.array(*[
            F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(MARKED).alias("text"))
            for i, r in enumerate(("user", "assistant"))
        ])).alias("row"),
    ).select("conv_id", "row.*")
    # Written once, as they are read back and measured.
    windows = staged(chat_windows.chat_windows(turns.unionByName(marked)), "windows")
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    # Windows of a conversation in order; its whole text is what the digests are of.
    read = chat_windows.read_back(windows).select(
        "conv_id",
        "window",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(lines, "").alias("turns"),
        "loss_text",
    )
    sizes = windows.select("conv_id", F.length("formatted").alias("chars"))
    back = read.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss_text"))).alias("parts"),
    )
    loss = F.array_join(F.col("parts.loss_text"), "")
    return (
        back.join(
            sizes.groupBy(F.col("conv_id").alias("of")).agg(F.sum("chars").alias("formatted_chars")),
            F.col("conv_id").eqNullSafe(F.col("of")),
        )
        .select(
            "conv_id",
            "n_turns",
            F.sha2(F.array_join(F.col("parts.turns"), ""), 256).alias("turns_sha256"),
            F.length(loss).cast("long").alias("loss_chars"),
            F.sha2(loss, 256).alias("loss_sha256"),
            F.col("formatted_chars").cast("long").alias("formatted_chars"),
        )
    )


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
sized AS (
  SELECT *, CAST(ceil(strlen(text) / 4.0) AS BIGINT) + 4 AS tokens,
    15 + length(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '>', '%3E'))
      + length(replace(replace(replace(text, '%', '%25'), '<', '%3C'), '>', '%3E')) AS chars,
    row_number() OVER w AS nth, first(role) OVER w AS first_role
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
heads AS (
  SELECT conv_id, tokens AS system_tokens, chars AS system_chars FROM sized WHERE nth = 1 AND role = 'system'),
counted AS (
  SELECT s.*, h.system_tokens, h.system_chars, s.nth = 1 AND s.role = 'system' AS is_system,
    CASE WHEN s.nth = 1 AND s.role = 'system' THEN 0 ELSE tokens END AS own,
    greatest(floor((1024 - 256 - coalesce(system_tokens, 0)) / 2), 1) AS step
  FROM sized s LEFT JOIN heads h ON s.conv_id IS NOT DISTINCT FROM h.conv_id),
slots AS (
  SELECT *, own > step AS large, floor((sum(own) OVER w - 1) / step) AS slot
  FROM counted WINDOW w AS (PARTITION BY conv_id ORDER BY nth ROWS UNBOUNDED PRECEDING)),
marked AS (
  SELECT *, NOT is_system AND (lag(nth) OVER w IS NULL OR lag(is_system) OVER w OR large
    OR lag(large) OVER w OR slot <> lag(slot) OVER w) AS starts
  FROM slots WINDOW w AS (PARTITION BY conv_id ORDER BY nth)),
spans AS (
  SELECT *, greatest(sum(starts::INT) OVER (PARTITION BY conv_id ORDER BY nth ROWS UNBOUNDED PRECEDING) - 1, 0) AS span
  FROM marked),
carried AS (
  SELECT *, NOT is_system AND row_number() OVER w <= 2 AND sum(tokens) OVER w <= 256
    AND span < max(span) OVER (PARTITION BY conv_id) AS again
  FROM spans WINDOW w AS (PARTITION BY conv_id, span ORDER BY nth DESC ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) + coalesce(sum(chars) FILTER (WHERE again), 0)
    + coalesce(max(system_chars), 0) * max(span) AS BIGINT) AS formatted_chars
FROM carried GROUP BY conv_id
"""


def fingerprint_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_trial(_table(spark, sf_dir, "documents"))


def repeats_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bwt_dedup.repeated_strings(_table(spark, sf_dir, "documents"))
    lengths = F.transform("removed", lambda s: s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = string_kernel.fit_labelled(docs, _table(spark, sf_dir, "labels"))
    return string_kernel.toxicity(docs, model).select(
        "doc_id",
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0).alias("held_out"),
        "score",
        "predicted",
    )


def near_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_stripes.collocations(_table(spark, sf_dir, "documents"))


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, w[i:i + k - 1] AS p FROM words, range(1, 6) AS s(k), range(1, len(w) - k + 2) AS r(i)),
phrases AS (SELECT lang, p, count(*) AS a FROM grams GROUP BY lang, p HAVING count(*) >= 100),
longer AS (
  SELECT DISTINCT s.lang, s.p FROM phrases s JOIN (
    SELECT lang, a, unnest([p[1:len(p) - 1], p[2:]]) AS inner_p FROM phrases WHERE len(p) > 2) q
    ON s.lang = q.lang AND s.p = q.inner_p AND 100 * q.a >= 100 * s.a),
whole AS (SELECT * FROM phrases ANTI JOIN longer USING (lang, p) WHERE len(p) > 1),
cuts AS (
  SELECT c.lang, c.p, c.a, k, x.a AS l, y.a AS r, n,
    CAST((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM whole c, range(1, len(c.p)) AS s(k), phrases x, phrases y, sizes
  WHERE x.lang = c.lang AND x.p = c.p[1:k] AND y.lang = c.lang AND y.p = c.p[k + 1:] AND sizes.lang = c.lang),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
  array_to_string(p, ' ') AS phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= 2000
"""


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = prefix_trie.turn_digests(_table(spark, sf_dir, "conversations"))
    trie, ends = prefix_trie.prefix_trie(*prefix_trie.share_openings(digests))
    return trie.join(prefix_trie.ends_digest(ends), ["conv_id", "depth"], "left").select(
        *trie.columns, F.coalesce("sha256", prefix_trie.no_ids()).alias("ends_sha256")
    )


TRIE_SQL = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT list(v ORDER BY i) AS steps FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i))),
sizes AS (
  SELECT conv_id, own, conv_id - conv_id % 100 AS head,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT conv_id, count(*) AS own FROM turns GROUP BY conv_id), crc),
built AS (
  SELECT s.conv_id, t.i AS d, t.role, t.text FROM sizes s JOIN turns t ON t.conv_id = s.head AND t.i <= s.h
  UNION ALL
  SELECT s.conv_id, t.i - s.h + least(s.h, coalesce(b.own, 0)), t.role, t.text
  FROM sizes s JOIN turns t ON t.conv_id = s.conv_id AND t.i > s.h LEFT JOIN sizes b ON b.conv_id = s.head),
whole AS (
  SELECT s.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY d) FILTER (WHERE d IS NOT NULL), []) AS w
  FROM sizes s LEFT JOIN built b ON b.conv_id = s.conv_id GROUP BY s.conv_id),
places AS (
  SELECT conv_id, d, w[1:d] AS p, len(w) = d AS ends, CASE WHEN d > 0 THEN length(w[d].text) ELSE 0 END AS chars
  FROM whole, range(0, len(w) + 1) AS r(d)),
nodes AS (
  SELECT d, p, min(conv_id) AS node, count(*) AS n_convs, max(chars) AS chars,
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends) AS ids
  FROM places GROUP BY d, p),
through AS (SELECT conv_id, d, node FROM places JOIN nodes USING (d, p)),
own AS (
  SELECT n.*, t.node AS parent FROM nodes n LEFT JOIN through t ON t.conv_id = n.node AND t.d = n.d - 1),
kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM own WHERE d > 0 GROUP BY ALL),
valued AS (
  SELECT o.*, coalesce(n_children, 0) AS n_children, (n_children IS NULL)::INT AS leaf, (n_convs - 1) * chars AS saved
  FROM own o LEFT JOIN kids k ON k.node = o.node AND k.d = o.d),
totals AS (
  SELECT t.node, t.d, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM valued v JOIN through t ON t.conv_id = v.node AND t.d <= v.d GROUP BY ALL)
SELECT v.node AS conv_id, CAST(v.d AS BIGINT) AS depth, v.parent AS parent_conv_id, v.n_convs, v.n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM valued v JOIN totals t ON t.node = v.node AND t.d = v.d
"""


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_variants.simhash_duplicates(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cotraining": quality,
    "op2_phrase_index": contamination,
    "op3_line_runs": line_dedup,
    "op4_oph_fingerprints": fingerprint_trial,
    "op5_lpt_shards": shards,
    "op6_weighted_mix": mixed,
    "op7_chat_windows": chat_formatting,
    "op8_bwt_dedup": repeats_removed,
    "op9_string_kernel": toxicity,
    "op10_sketch_dedup": near_duplicate_groups,
    "op11_phrase_stripes": collocations,
    "op12_prefix_trie": conversation_trie,
    "op13_simhash_variants": simhash_groups,
}

ORACLE: dict[str, str] = {
    "op2_phrase_index": CONTAMINATION_SQL,
    "op3_line_runs": LINE_DEDUP_SQL,
    "op6_weighted_mix": MIX_SQL,
    "op7_chat_windows": CHAT_SQL,
    "op11_phrase_stripes": COLLOCATIONS_SQL,
    "op12_prefix_trie": TRIE_SQL,
}
