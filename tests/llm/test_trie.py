import hashlib
import random

import pytest
from pyspark.sql import functions as F

from trailmark.llm.scans import BASES, PRIME, scanned
from trailmark.llm.trie import prefix_trie, split_totals, turn_keys

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(conversations):
    """conversations: {id: [(role, text)]}."""
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[:-1] == n for m in below)]
        ends = sorted(c for c in ids if len(conversations[c]) == len(node))
        rows.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
            sum(len(n) == len(node) + 1 for n in below), len(leaves),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def trie(spark, conversations, **options):
    rows = [(c, n, *t) for c, turns in conversations.items() for n, t in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    convs = spark.createDataFrame([(c,) for c in conversations], "conv long")
    return sorted((tuple(r) for r in prefix_trie(turn_keys(frame), convs, **options).select(COLUMNS).collect()), key=str)


def grown(chance, n, width, depth):
    words = ["ja", "né", "oui", "nö"][:width]
    return {c: [(chance.choice(["user", "bot"]), chance.choice(words)) for _ in range(chance.randrange(depth))] for c in range(n)}


@pytest.mark.parametrize("local_weight", [1, 7, 1 << 14])
def test_equals_brute_force(spark, local_weight):
    chance = random.Random(4)
    conversations = grown(chance, 60, 2, 6)
    same = [("user", f"turn {i}") for i in range(30)]
    conversations |= {100 + c: same[: chance.randrange(10, 30)] + [("bot", str(c))] for c in range(8)}
    assert trie(spark, conversations, local_weight=local_weight) == brute(conversations)


def test_centroids_give_subtree_sums():
    chance = random.Random(1)
    for n in (1, 2, 3, 50, 400):
        for reach in (1, 5, n):  # a chain, a narrow tree, a flat one
            parent = [-1] + [chance.randrange(max(0, i - reach), i) for i in range(1, n)]
            own = [chance.randrange(1, 9) for _ in range(n)]
            value = [chance.randrange(100) for _ in range(n)]
            weight, want = list(own), list(value)
            for i in range(n - 1, 0, -1):
                weight[parent[i]] += weight[i]
                want[parent[i]] += want[i]
            assert split_totals(parent, weight, [value]) == [want]


def test_scan_across_partitions(spark):
    """One key holds most rows and spans partitions; places and hashes are those of one pass."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(k, o, (k * 7 + o * o) % 1_000_003) for k, n in ((1, 3), (2, 900), (3, 1), (5, 40)) for o in range(n)]
        frame = spark.createDataFrame(rows, "k long, o long, v long").repartition(7)
        found = scanned(frame, "k", ["o"], ["v"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == len(rows)
    prefix = {}
    for k, o, v in rows:
        prefix[k, o] = (prefix.get((k, o - 1), 0) + (v + 1) * pow(BASES[0], o, PRIME)) % PRIME
    for r in found:
        assert (r.place, r.total) == (r.o, sum(k == r.k for k, _, _ in rows))
        assert (r.hash_v, r.before_v) == (prefix[r.k, r.o], prefix.get((r.k, r.o - 1), 0))


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first", 0), (1, 0, None, None, 0), (1, 0, None, None, 0), (2, None, "user", "first", 0),
        (2, 5, "", "", 0), (2, 6, None, "", 0), (3, 1, "user", "x" * 300_000, 0), (None, 1, "user", "nobody's", 0),
        (4, 2, "b", "a", 0), (4, 2, "a", "b", 0), (5, 9, "a", "b", 0), (5, 9, "b", "a", 0), (6, 1, "us", "er", 0), (7, 1, "use", "r", 0),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place int")
    convs = spark.createDataFrame([(c,) for c in (1, 2, 3, 4, 5, 6, 7, 8)], "conv long")
    found = [tuple(r) for r in prefix_trie(turn_keys(frame), convs).select(COLUMNS).collect()]

    def ordered(c):
        turns = [((-1 if t is None else t), hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode()).digest(), (r or "", x or "")) for k, t, r, x, _ in rows if k == c]
        return [t[2] for t in sorted(turns)]

    conversations = {c: ordered(c) for c in range(1, 9)}
    # Equal turns, rows in any order: 1 and 2 are the same conversation, and so are 4 and 5.
    assert conversations[1] == conversations[2] and conversations[4] == conversations[5]
    assert sorted(found, key=str) == brute(conversations)
    assert prefix_trie(turn_keys(frame.limit(0)), convs.limit(0)).count() == 0
    turnless = prefix_trie(turn_keys(frame.limit(0)), convs).select(COLUMNS).collect()
    assert [tuple(r) for r in turnless] == brute({c: [] for c in range(1, 9)})
    assert turn_keys(frame).select(F.sum("n_bytes")).first()[0] == 300_000 + 2 * 5 + 4 + 3
