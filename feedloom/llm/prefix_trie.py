"""The trie of the prefixes of conversations, with totals over subtrees by centroid decomposition.

Texts are read once and replaced by 128 bits of hash; all else works on narrow rows of integers, one per
turn. A node is known by the least conversation that goes through it and by its depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.numbering import ROW_BITS, number_rows
from feedloom.session import staged


def turn_digests(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id``, ``depth`` (from 1), ``h1``, ``h2`` (hash of role and text) and ``chars`` of each turn.

    Turns come by number, null first; those of one number in a fixed order that depends on their roles
    and texts alone. A null role or text is empty. Rows without ``conv_id`` belong to no conversation
    and are left out.
    """
    of = [F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))]
    narrow = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.xxhash64(*of).alias("h1"),
        F.xxhash64(F.lit(1), *of).alias("h2"),
        F.length(of[1]).cast("long").alias("chars"),
    )
    placed = number_rows(narrow, ["turn", "h1", "h2"], by=["conv_id"], name="place")
    return placed.select("conv_id", (F.col("place") + 1).alias("depth"), "h1", "h2", "chars")


def share_openings(digests: DataFrame, family: int = 100, openings: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that open like the first one of their family: their turns, and their lengths.

    Conversation c takes the first h turns of conversation ``c - c % family`` (all if it has
    fewer, none if there is no such one), then its own after its first h, with h the CRC-32 of c in decimal
    modulo ``openings``. The second table has ``conv_id`` and ``length``, also of those without any turn left.
    """
    digests = staged(digests, "turns")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % openings
    sizes = digests.groupBy("conv_id").agg(F.count("*").alias("own"))
    sizes = sizes.select("conv_id", "own", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("head"))
    heads = sizes.select(F.col("conv_id").alias("head"), F.least("own", F.lit(openings)).alias("there"))
    lengths = sizes.join(heads, "head", "left").withColumn("b", F.least("h", F.coalesce("there", F.lit(0).cast("long"))))
    lengths = staged(
        lengths.withColumn("length", F.col("b") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("long"))), "lengths"
    )
    first = digests.where(F.col("depth") < openings).withColumnRenamed("conv_id", "head")
    opening = lengths.select("conv_id", "head", "b").join(first, "head").where("depth <= b")
    own = digests.join(lengths.select("conv_id", "h", "b"), "conv_id").where("depth > h")
    own = own.withColumn("depth", F.col("depth") - F.col("h") + F.col("b"))
    columns = ["conv_id", "depth", "h1", "h2", "chars"]
    return opening.select(columns).union(own.select(columns)), lengths.select("conv_id", "length")


def _prefixes(digests: DataFrame, lengths: DataFrame) -> DataFrame:
    """Each conversation at each depth from 0, with ``x1``, ``x2``: 128 bits of hash over all turns so far.

    Every turn gives a hash with its depth in it; those of a prefix are combined by exclusive or, which
    is a running sum. It is taken over one range partitioning, so a conversation of very many turns is
    spread over many tasks; one value per partition is carried on.
    """
    at = ["depth", "h1", "h2"]
    rows = digests.select(
        "conv_id", "depth", "chars", F.xxhash64(*at).alias("t1"), F.xxhash64(F.lit(1), *at).alias("t2")
    ).join(lengths, "conv_id")
    zero = F.lit(0).cast("long")
    roots = lengths.select(
        "conv_id", zero.alias("depth"), zero.alias("chars"), zero.alias("t1"), zero.alias("t2"), "length"
    )
    order = ["conv_id", "depth"]
    placed = staged(
        rows.select(roots.columns)
        .union(roots)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.shiftright(F.monotonically_increasing_id(), ROW_BITS)),
        "prefixes",
    )
    inside = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("conv_id", "part").agg(F.bit_xor("t1").alias("t1"), F.bit_xor("t2").alias("t2"))
    before = parts.select("conv_id", "part", *[F.coalesce(F.bit_xor(f"t{i}").over(earlier), zero).alias(f"b{i}") for i in (1, 2)])
    within = placed.select(
        "conv_id", "depth", "chars", "length", "part", *[F.bit_xor(f"t{i}").over(inside).alias(f"w{i}") for i in (1, 2)]
    )
    return within.join(before, ["conv_id", "part"]).select(
        "conv_id", "depth", "chars", "length", *[F.col(f"w{i}").bitwiseXOR(F.col(f"b{i}")).alias(f"x{i}") for i in (1, 2)]
    )


def _steps(prefixes: DataFrame) -> DataFrame:
    """Each conversation at each depth, with its node there, that node's parent and figures.

    ``node`` and ``parent`` are the least conversations through them. ``weight`` adds up, over the subtree of
    the node, the conversations through each node: a conversation counts once for each of its depths below.
    """
    prefixes = staged(prefixes, "prefixes")
    key = ["depth", "x1", "x2"]
    nodes = prefixes.groupBy(*key).agg(
        F.min("conv_id").alias("node"),
        F.count("*").alias("n_convs"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
        F.max("chars").alias("chars"),
    )
    # The shorter of the two rows of figures stays with the node's own conversation only.
    own = F.col("conv_id") == F.col("node")
    at = staged(
        prefixes.join(nodes.withColumnRenamed("chars", "size"), key).select(
            "conv_id", "depth", "node", (F.col("depth") == F.col("length")).alias("last"),
            *[F.when(own, F.col(c)).alias(c) for c in ("n_convs", "weight", "size")],
        ),
        "places",
    )
    up = at.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    return staged(at.join(up, ["conv_id", "depth"], "left"), "steps")


def rollup(nodes: DataFrame, steps: DataFrame, values: list[str]) -> DataFrame:
    """Sums of ``values`` over the subtree of each node, its own included: ``node``, ``depth`` and the sums.

    Centroid decomposition of the parent edges. A component of the forest has a top; its nodes that hold
    over half of the component's weight below them are a path from the top down, and the last of that path is
    the centroid. The sum over the centroid's subtree within the component is added to each node of
    the path. Then the path's edges below the centroid and above it are cut, so each child of it becomes the
    top of a component, and the rest of the component is another; all weigh half at most. A node gets what lies
    below it exactly once, in the round in which a centroid parts the two. So the rounds are
    the logarithm of the turns, also where one conversation has most of them.

    ``steps`` tells on which side of the centroid a node is: it is below if its conversation goes through it.
    """
    root = nodes.where("depth = 0").select("node", "weight").first()
    zero = [F.lit(0).cast("decimal(38,0)").alias(v) for v in values]
    if root is None:
        return nodes.select("node", "depth", *zero)
    top = ["top", "top_depth"]
    state = nodes.select(
        F.lit(root.node).cast("long").alias("top"),
        F.lit(0).cast("long").alias("top_depth"),
        F.lit(root.weight).cast("long").alias("total"),
        "node", "depth", "weight", *values,
    )
    paths = steps.select(
        F.col("conv_id").alias("node"), F.col("depth").alias("child_depth"),
        F.col("node").alias("child"), F.col("parent").alias("through"),
    )
    on_path = F.col("weight") * 2 > F.col("total")
    found = None
    while True:
        centroids = (
            state.where(on_path)
            .groupBy(*top)
            .agg(F.max(F.struct("depth", "node", "weight")).alias("c"))
            .select(*top, F.col("c.depth").alias("c_depth"), F.col("c.node").alias("c"), F.col("c.weight").alias("c_weight"))
        )
        here = state.join(centroids, top).withColumn("child_depth", F.col("c_depth") + 1)
        below = F.col("depth") > F.col("c_depth")
        # A node below the centroid's depth asks its conversation for the step there.
        asked = here.where(below).join(paths, ["node", "child_depth"])
        cut = F.col("through") == F.col("c")
        parted = asked.select(*here.columns, F.when(cut, F.col("child")).alias("child")).union(
            here.where(~below).withColumn("child", F.lit(None).cast("long"))
        )
        parted = staged(parted, "parted")
        is_centroid = (F.col("node") == F.col("c")) & (F.col("depth") == F.col("c_depth"))
        under = parted.where(F.col("child").isNotNull() | is_centroid).groupBy(*top).agg(
            *[F.sum(v).alias(f"s_{v}") for v in values]
        )
        added = staged(
            parted.where(on_path).join(under, top).select("node", "depth", *[F.col(f"s_{v}").alias(v) for v in values]), "added"
        )
        found = added if found is None else found.union(added)
        upper = parted.where(F.col("child").isNull() & ~is_centroid).select(
            *top,
            (F.col("total") - F.col("c_weight")).alias("total"),
            "node", "depth",
            F.when(on_path, F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"),
            *values,
        )
        lower = parted.where(F.col("child").isNotNull())
        tops = lower.where((F.col("node") == F.col("child")) & (F.col("depth") == F.col("child_depth")))
        lower = lower.drop(*top, "total").join(
            tops.select("child", "child_depth", F.col("weight").alias("total")), ["child", "child_depth"]
        )
        state = staged(
            upper.union(
                lower.select(
                    F.col("child").alias("top"), F.col("child_depth").alias("top_depth"), "total", "node", "depth", "weight", *values
                )
            ),
            "state",
        )
        if state.isEmpty():
            break
    return found.groupBy("node", "depth").agg(*[F.sum(v).alias(v) for v in values])


def prefix_trie(digests: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie, and the conversations that end at each.

    ``digests`` has the turns of ``turn_digests``, ``lengths`` the ``conv_id`` and ``length`` of all
    conversations, those without turns too. A node stands for all conversations that begin with the same turns
    (role and text); the root for all. Nodes have ``conv_id`` (least conversation through it), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in the
    subtree, itself included) and ``saved_tokens`` (what its subtree saves where turns of several
    conversations are stored once, in code points). The second table has ``conv_id``, ``depth`` and
    ``ended``, one row per conversation. Equal conversations are members of the same nodes. No conversations
    give two empty tables.
    """
    steps = _steps(_prefixes(digests, lengths))
    nodes = steps.where(F.col("conv_id") == F.col("node")).drop("conv_id")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children")
    )
    nodes = staged(
        nodes.join(children, ["node", "depth"], "left").select(
            "node", "depth", "parent", "n_convs", "weight",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            F.col("n_children").isNull().cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
        ),
        "nodes",
    )
    values = ["n_leaves", "saved_tokens"]
    totals = rollup(nodes, steps, values)
    trie = nodes.drop(*values).join(totals, ["node", "depth"]).select(
        F.col("node").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        *[F.col(v).cast("long").alias(v) for v in values],
    )
    ends = steps.where("last").select(F.col("node").alias("conv_id"), "depth", F.col("conv_id").alias("ended"))
    return trie, ends


def _id_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node as text, at most a batch of ids each."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        ids = pc.cast(table.column("ended"), pa.string()).combine_chunks()
        same = pc.and_(
            pc.equal(table.column("conv_id").slice(1), table.column("conv_id").slice(0, len(ids) - 1)),
            pc.equal(table.column("depth").slice(1), table.column("depth").slice(0, len(ids) - 1)),
        ).to_pylist()
        starts = [0, *[i + 1 for i, equal in enumerate(same) if not equal]] if len(ids) else []
        lists = pa.ListArray.from_arrays(pa.array([*starts, len(ids)], pa.int32()), ids) if starts else None
        if lists is not None:
            first = table.take(pa.array(starts)).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays([*first.columns, pc.binary_join(lists, ",")], ["conv_id", "depth", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the blocks of each node, which come in order; no list is held."""
    key, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"conv_id": key[0], "depth": key[1], "sha256": state.hexdigest()}])

    for batch in batches:
        done = {"conv_id": [], "depth": [], "sha256": []}
        conv, depth, ids = (batch.column(i).to_pylist() for i in (0, 1, 3))
        for at, block in zip(zip(conv, depth, strict=True), ids, strict=True):
            if at == key:
                state.update(b",")
            else:
                if key is not None:
                    for name, value in zip(done, (*key, state.hexdigest()), strict=True):
                        done[name].append(value)
                key, state = at, hashlib.sha256()
            state.update(block.encode())
        yield pa.RecordBatch.from_pydict(done, pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("sha256", pa.string())]))
    if key is not None:
        yield row()


def ends_digest(ends: DataFrame) -> DataFrame:
    """``sha256`` of the ids that end at each node, in decimal, ascending, with commas between.

    Ids are put in order by one range shuffle and reach the digest in blocks, so a node with very many of them is
    sorted by many tasks; only the digest itself goes through its text in one.
    """
    order = ["conv_id", "depth", "ended"]
    blocks = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _id_blocks, "conv_id long, depth long, first long, ids string"
    )
    return (
        blocks.repartition("conv_id", "depth")
        .sortWithinPartitions("conv_id", "depth", "first")
        .mapInArrow(_digests, "conv_id long, depth long, sha256 string")
    )


def no_ids() -> Column:
    """The digest of a node where no conversation ends."""
    return F.sha2(F.lit(""), 256)
