"""The prefix tree against a dictionary of all prefixes in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import prefix_trie, queries
from kpiloom.llm.common import table
from tests.conftest import SF_DIR

TURNS = "conv_id long, turn long, role string, text string"


def grouped(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    """(conv_id, depth, parent, convs, children, leaves, saved, ends) of every prefix."""
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves, saved = {}, {}
    for node in members:
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] = saved.get(node[:d], 0) + own
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), children.get(node, 0), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
        for node, m in members.items())


def plain(df):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in df.select(*prefix_trie.NODE_COLUMNS).collect())


def conversations(seed, n=120):
    """Chats with shared openings: copies, a long common prefix, prefixes of others, ids out of order."""
    rng = random.Random(seed)
    opening = [("user", f"common {k}") for k in range(40)]
    pool = [[(rng.choice("ua"), rng.choice(["x", "yé", "z" * 20, ""])) for _ in range(rng.randint(1, 6))] for _ in range(15)]
    rows = []
    for c in rng.sample(range(1000), n):
        kind = rng.random()
        turns = list(pool[0]) if kind < 0.3 else opening[: rng.randint(20, 40)] + rng.choice(pool) if kind < 0.6 else rng.choice(pool)
        rows += [(c, k, role, text) for k, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [1, 30, 400, 10**6])
def test_nodes_at_every_container_size(spark, limit):
    rows = conversations(limit)
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumn("depth", F.lit("mine"))
    got = prefix_trie.nodes(prefix_trie.sequences(df), prefix_trie.Settings(container_turns=limit))
    assert plain(got) == brute(grouped(rows))


def test_checksum_of_many_copies(spark):
    n = 3 * prefix_trie.PIECE + 7
    df = spark.range(n).select(F.col("id").alias("conv_id"), F.array(F.lit(1), F.lit(2)).cast("array<bigint>").alias("ids"),
                               F.array(F.lit(5), F.lit(6)).cast("array<bigint>").alias("sizes")).repartition(7)
    got = {r.depth: r for r in prefix_trie.nodes(df).collect()}
    assert got[2].ends_sha256 == hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest()
    assert (got[0].n_convs, got[0].n_leaves, got[0].saved_tokens, got[2].parent_conv_id) == (n, 1, 11 * (n - 1), 0)


ODD = [
    (1, None, "user", "null first"), (1, 0, None, "b"), (1, 0, "a", None), (1, 5, "a", None), (1, 5, "a", None), (2, 1, None, None),
    (None, 1, "user", "no conversation"), (3, 0, "user", "long " * 50000), (4, 0, "user", "é\x00 漢"), (5, None, None, None),
    (7, 0, "ab", "c"), (8, 0, "a", "bc"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, TURNS).withColumn("ids", F.lit(1))
    assert plain(prefix_trie.nodes(prefix_trie.sequences(df))) == brute(grouped(ODD))
    assert plain(prefix_trie.nodes(queries.regrown(df), prefix_trie.Settings(2))) == brute(rebuilt(grouped(ODD)))
    assert prefix_trie.nodes(prefix_trie.sequences(df.limit(0))).count() == 0


@pytest.mark.parametrize("limit", [20, 4096])
def test_rebuilt_conversations(spark, limit):
    rows = [(c // 3, 100 * (c % 3) + k, r, t) for c, k, r, t in conversations(5, 300)]
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    got = prefix_trie.nodes(queries.regrown(df), prefix_trie.Settings(limit))
    assert plain(got) == brute(rebuilt(grouped(rows)))


def test_registered_query(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert plain(queries.op13_prefix_trie(spark, SF_DIR)) == brute(rebuilt(grouped(rows)))
