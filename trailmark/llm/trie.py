"""The prefix trie of conversations, with totals of every subtree.

A node is a distinct sequence of first turns. It is known by the prefix hash of scans.py, two numbers
modulo 2^61 - 1 of its turns' MD5 digests, so texts are read once and never shuffled; that two nodes
differ rests on these 122 bits.

Subtree totals come from a centroid decomposition. A node's weight is the number of its members, so the
weight of its subtree is the turns that its members have from there on: an aggregate, no rollup, gives
it. A component's centroid is the deepest node whose subtree holds half of its weight. What the
subtree holds is added to every node on the path from the centroid to the component's top; then the
component falls into what lies above the centroid and the subtrees of its children, each of at
most half the weight. So a chain of a million turns or a node of a million children takes some
twenty rounds, whatever the depth. Whether a node lies below a centroid is looked up along one of its
members. Components of a stated weight or less are gathered many to a task and split on there by the
same rule.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from trailmark.llm.common import stored
from trailmark.llm.scans import scanned

#: Components of this weight or less are split within a task.
LOCAL_WEIGHT = 1 << 14
#: Places of a path that are made at once.
PATH_BLOCK = 4096
NODE = ["a", "b"]


def turn_keys(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, place, va, vb, n_bytes) of every turn: its number in the conversation, two halves of the MD5
    digest of role and text, and the text's UTF-8 bytes.

    Turns are ordered by `turn`, null first; equal ones by the digest, so the order of rows does not
    matter. A null role or text is empty. Rows without a conversation are left out. Other columns are
    left out, so their names do not matter.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.md5(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_).cast("binary"))
    keys = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv"),
        F.col(turn).alias("turn"),
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("va"),
        F.conv(F.substring(digest, 18, 15), 16, 10).cast("long").alias("vb"),
        F.octet_length(text_).cast("long").alias("n_bytes"),
    )
    return scanned(keys, "conv", ["turn", "va", "vb"]).drop("turn", "total")


def forked(keys: DataFrame, kept: Column, base: Column, most: int) -> DataFrame:
    """Turn keys of conversations rebuilt from another's: the first `kept` (at most `most`) turns come
    from conversation `base`, both expressions of conv; then follow the own turns after the first `kept`.
    """
    keys = stored(keys, "turn-keys")
    convs = keys.select("conv").distinct().select("conv", base.alias("base"), kept.alias("kept")).where("base <> conv")
    own = keys.where((base == F.col("conv")) | (F.col("place") >= kept))
    heads = keys.where(F.col("place") < most).withColumnRenamed("conv", "base")
    taken = convs.join(heads, "base").where("place < kept").select(own.columns)
    return own.unionByName(taken)


def hashes_of_ids(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of (a, b, conv): the SHA-256 of a node's ids, rising, with commas between.

    Ids are sorted by ranges over all nodes and joined to text in batches, so that one node's ids may
    span partitions; only those texts come together in a task, one after the other.
    """
    text = StructType([*(StructField(n, LongType()) for n in (*NODE, "first")), StructField("ids", StringType())])
    digest = StructType([*(StructField(n, LongType()) for n in NODE), StructField("ends_sha256", StringType())])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ids = batch.columns
            if not len(ids):
                continue
            x, y = a.to_numpy(), b.to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
            edges = pa.array(np.append(starts, len(ids)), pa.int32())
            lists = pa.ListArray.from_arrays(edges, ids.cast(pa.string()))
            at = pa.array(starts)
            yield pa.RecordBatch.from_arrays(
                [a.take(at), b.take(at), ids.take(at), pc.binary_join(lists, ",")], names=text.names
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((r, t) for batch in batches for r, t in zip(zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True), batch.column(3).to_pylist(), strict=True))
        out: list[tuple] = []
        for node, texts in groupby(rows, key=lambda x: x[0]):
            sha, between = hashlib.sha256(), b""
            for _, ids in texts:
                sha.update(between + ids.encode())
                between = b","
            out.append((*node, sha.hexdigest()))
            if len(out) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=digest.names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=digest.names)

    ordered = ends.select(*NODE, "conv").repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    texts = ordered.mapInArrow(joined, text)
    return texts.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digests, digest)


def split_totals(parent: Sequence[int], weight: Sequence[int], values: Sequence[Sequence[int]]) -> list[list[int]]:
    """Sums of the values over each node's subtree, by centroids. Parents come before their children;
    weight is that of the whole subtree.
    """
    weight = list(weight)
    sums = [list(v) for v in values]
    work = [list(range(len(parent)))]
    while work:
        part = work.pop()
        if len(part) == 1:
            continue
        top = part[0]
        half = weight[top] / 2
        centre = min((i for i in part if weight[i] >= half), key=weight.__getitem__)
        branch: dict[int, int] = {}  # of a node below the centroid, the child of the centroid above it
        below: dict[int, list[int]] = {}
        above = []
        for i in part:
            if i == centre:
                continue
            up = parent[i]
            child = i if up == centre else branch.get(up)
            if child is None:
                above.append(i)
            else:
                branch[i] = child
                below.setdefault(child, []).append(i)
        gone = weight[centre]
        for v, s in zip(values, sums, strict=True):
            under = sum(v[i] for i in branch)
            s[centre] += under
            i = centre
            while i != top:
                i = parent[i]
                s[i] += under + v[centre]
        i = centre
        while i != top:
            i = parent[i]
            weight[i] -= gone
        work += [part for part in (above, *below.values()) if part]
    return sums


def _split_in_tasks(components: DataFrame, values: Sequence[str]) -> DataFrame:
    """(a, b, values) of whole components, gathered."""
    schema = StructType([StructField(n, LongType()) for n in (*NODE, *values)])
    columns = [*NODE, "pa", "pb", "weight", *values, *[f"added_{v}" for v in values]]

    def totals(rows: list[tuple]) -> Iterator[tuple]:
        at = {r[:2]: i for i, r in enumerate(rows)}
        parent = [at.get(r[2:4], -1) for r in rows]
        n = len(values)
        sums = split_totals(parent, [r[4] for r in rows], [[r[5 + k] for r in rows] for k in range(n)])
        for i, r in enumerate(rows):
            yield (*r[:2], *(sums[k][i] + r[5 + n + k] for k in range(n)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        out: list[tuple] = []
        for _, part in groupby(rows, key=lambda r: r[:2]):
            out += totals([r[2:] for r in part])
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=schema.names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=schema.names)

    gathered = components.repartition("ca", "cb").sortWithinPartitions("ca", "cb", "depth")
    return gathered.select("ca", "cb", *columns).mapInArrow(run, schema)


def subtree_totals(nodes: DataFrame, rows: DataFrame, values: Sequence[str], local_weight: int = LOCAL_WEIGHT) -> DataFrame:
    """(a, b, values): each value summed over the node's subtree, its top included.

    nodes: a, b, pa, pb (the parent's), depth, conv (a member), weight (of the subtree; each node's own
    is positive) and the values, of one tree whose root is (0, 0). rows: conv, depth, a, b, pa, pb of
    every node on the path of every conv.
    """
    added = [f"added_{v}" for v in values]
    alive = nodes.select(
        *NODE, "pa", "pb", "depth", "conv", "weight", *values,
        *[F.lit(0).cast("long").alias(n) for n in added], F.lit(0).cast("long").alias("ca"), F.lit(0).cast("long").alias("cb"),
    )
    comp = ["ca", "cb"]
    finished, small = [], []
    while True:
        alive = stored(alive, "components")
        sizes = alive.groupBy(*comp).agg(F.max("weight").alias("whole"), F.min("depth").alias("top"))
        sizes = stored(sizes, "component-sizes")
        is_small = F.col("whole") <= local_weight
        if sizes.where(is_small).limit(1).count():
            small.append(alive.join(sizes.where(is_small).select(*comp), comp))
        if not sizes.where(~is_small).limit(1).count():
            break
        big = alive.join(sizes.where(~is_small), comp)
        centroids = stored(
            big.where(2 * F.col("weight") >= F.col("whole"))
            .groupBy(*comp, "top")
            .agg(*[F.min_by(c, "weight").alias(f"c_{c}") for c in (*NODE, "conv", "depth")], F.min("weight").alias("c_weight")),
            "centroids",
        )
        met = alive.join(centroids, comp)
        below = F.col("depth") > F.col("c_depth")
        step = rows.select("conv", (F.col("depth") - 1).alias("c_depth"), F.col("a").alias("na"), F.col("b").alias("nb"), F.col("pa").alias("c_a"), F.col("pb").alias("c_b"))
        asked = met.where(below).select(*comp, "conv", "c_depth", "c_a", "c_b").distinct()
        branch = asked.join(step, ["conv", "c_depth", "c_a", "c_b"]).select(*comp, "conv", "na", "nb")
        met = stored(
            met.join(branch, [*comp, "conv"], "left")
            .withColumns({n: F.when(below, F.col(n)) for n in ("na", "nb")})
            .withColumn("is_centre", (F.col("a") == F.col("c_a")) & (F.col("b") == F.col("c_b"))),
            "branches",
        )
        in_subtree = F.col("is_centre") | F.col("na").isNotNull()
        sums = met.where(in_subtree).groupBy(*comp).agg(*[F.sum(v).alias(f"sum_{v}") for v in values])
        sums = stored(sums, "component-totals")
        finished.append(
            met.where("is_centre").join(sums, comp).select(*NODE, *[(F.col(f"added_{v}") + F.col(f"sum_{v}")).alias(v) for v in values])
        )
        # The path from the centroid's parent to the top, along a member of the centroid.
        blocks = centroids.where("c_depth > top").join(sums, comp).select(
            F.col("c_conv").alias("conv"), F.col("c_weight").alias("cut"), *[f"sum_{v}" for v in values], "c_depth",
            F.explode(F.sequence("top", F.col("c_depth") - 1, F.lit(PATH_BLOCK))).alias("from"),
        )
        last = F.least(F.col("from") + PATH_BLOCK, "c_depth") - 1
        path = blocks.select("*", F.explode(F.sequence("from", last)).alias("depth"))
        path = path.join(rows.select("conv", "depth", *NODE), ["conv", "depth"], "left")
        path = path.select(*[F.coalesce(n, F.lit(0)).alias(n) for n in NODE], "cut", *[f"sum_{v}" for v in values])
        rest = met.where("NOT is_centre").join(path, NODE, "left")
        alive = rest.select(
            *NODE, "pa", "pb", "depth", "conv", (F.col("weight") - F.coalesce("cut", F.lit(0))).alias("weight"), *values,
            *[(F.col(f"added_{v}") + F.coalesce(f"sum_{v}", F.lit(0))).alias(f"added_{v}") for v in values],
            F.coalesce("na", "ca").alias("ca"), F.coalesce("nb", "cb").alias("cb"),
        )
    if not (small or finished):  # no nodes at all
        return nodes.select(*NODE, *values)
    if small:
        gathered = small[0]
        for more in small[1:]:
            gathered = gathered.unionByName(more)
        finished.append(_split_in_tasks(gathered, values))
    found = finished[0]
    for more in finished[1:]:
        found = found.unionByName(more)
    return found


def prefix_trie(keys: DataFrame, conversations: DataFrame, local_weight: int = LOCAL_WEIGHT) -> DataFrame:
    """A row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.

    keys: (conv, place, va, vb, n_bytes) of turns, as turn_keys gives them; places need not be gapless.
    conversations: (conv) of all conversations, once each, those without turns included. Members of a node
    are the conversations that start with its turns; its subtree includes it. n_leaves counts nodes
    without children; saved_tokens sums (members - 1) x bytes of the last turn's text; ends_sha256
    hashes the ids of the members that end at the node. Without conversations there are no nodes.
    """
    walked = scanned(keys.withColumnRenamed("place", "turn"), "conv", ["turn"], ["va", "vb"])
    rows = stored(
        walked.select(
            "conv", (F.col("place") + 1).alias("depth"), F.col("hash_va").alias("a"), F.col("hash_vb").alias("b"),
            F.col("before_va").alias("pa"), F.col("before_vb").alias("pb"), "n_bytes", "total",
        ),
        "trie-rows",
    )
    members = rows.groupBy(*NODE).agg(
        F.min("conv").alias("conv"), F.max("depth").alias("depth"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
        F.max("n_bytes").alias("n_bytes"), F.count("*").alias("n_convs"), F.sum(F.col("total") - F.col("depth") + 1).alias("weight"),
    )
    zero = F.lit(0).cast("long")
    turns = rows.count()
    root = conversations.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(
        zero.alias("a"), zero.alias("b"), "conv", zero.alias("depth"), F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"),
        zero.alias("n_bytes"), "n_convs", (F.col("n_convs") + turns).alias("weight"),
    )
    nodes = stored(members.unionByName(root), "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    turnless = conversations.join(rows.where("depth = 1").select("conv"), "conv", "left_anti")
    ends = rows.where("depth = total").select(*NODE, "conv").unionByName(turnless.select(zero.alias("a"), zero.alias("b"), "conv"))
    nodes = nodes.join(children, NODE, "left").withColumns({
        "n_children": F.coalesce("n_children", zero),
        "n_leaves": F.col("n_children").isNull().cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes"),
    })
    nodes = stored(nodes, "trie-children")
    totals = subtree_totals(nodes, rows, ["n_leaves", "saved_tokens"], local_weight)
    named = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("parent_conv_id"))
    # The root's children may be many: a join of two stored tables, which adaptive execution splits.
    found = stored(nodes.drop("n_leaves", "saved_tokens").join(named, ["pa", "pb"], "left"), "trie-parents")
    found = found.join(totals, NODE).join(hashes_of_ids(ends), NODE, "left")
    return found.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
