"""The prefix tree of all conversations, with what each shared prefix saves.

Method (burst trie). Conversations become sequences of turn ids; equal sequences are one entry with
a count. A container holds the entries below one trie head. All entries start in the container of
the root; a container of more than ``container_turns`` turns bursts: its head becomes a trie node
and its entries move to containers of their next turn id. Every round looks twice as many turns
ahead as the one before and places entries at the first depth whose container is small enough, so
a long prefix that everything shares costs a few rounds. Containers are dealt to shards by head,
sorted by turn ids and swept once: the common prefix with the entry before tells which nodes close.
What containers report is summed up over the heads above them.

Copies are counted before anything moves: the ids of a group of copies are cut into pieces that
many tasks join to text, and one task feeds the pieces, not the rows, to the checksum. No step
puts a node's members into one task: counts combine before the shuffle, containers are bounded,
and what an entry adds to the heads above it is spread by entry.

A turn id is a 64-bit hash of role and text, an entry's key a 128-bit one of its turn ids.

Results of odd rows: NULL role or text counts as empty. Turns are ordered by ``turn`` (NULL first);
ties by role, then turn id. Repeated rows are turns of their own. Rows without ``conv_id`` belong to
no conversation and take no part. Texts have any length. A conversation without turns is a member
of the root. Extra columns are ignored. An empty table gives no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import stored

PIECE = 1024  # ids that are joined to one piece of text
NO_ENDS = hashlib.sha256(b"").hexdigest()

PIECE_SCHEMA = "key string, first bigint, n bigint, text string, ids array<bigint>, sizes array<bigint>"
ENTRY_SCHEMA = (
    "key string, conv_id bigint, n bigint, ends string, ids array<bigint>, sizes array<bigint>, paths array<bigint>")
NODE_SCHEMA = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, top boolean, paths array<bigint>, sizes array<bigint>")
NODE_COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@dataclass(frozen=True)
class Settings:
    """``container_turns``: a container of several entries with more turns than this bursts."""

    container_turns: int = 4096


def turn(order: Column, role: Column, text: Column) -> Column:
    """A turn as it travels: its place, its id, and the bytes of its text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.struct(
        order.alias("turn"), role.alias("role"), F.xxhash64(role, text).alias("id"),
        F.octet_length(text).cast("bigint").alias("size"))


def as_sequence(turns: Column) -> list[Column]:
    """``ids`` and ``sizes`` of an array of ordered turns."""
    return [F.transform(turns, lambda t: t["id"]).alias("ids"), F.transform(turns, lambda t: t["size"]).alias("sizes")]


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, ids, sizes): one row per conversation, its turns in order."""
    turns = conversations.where("conv_id is not null").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(turn(F.col("turn"), F.col("role"), F.col("text")))).alias("_turns"))
    return turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), *as_sequence(F.col("_turns")))


# -- equal sequences -----------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and conversation to pieces of at most ``PIECE`` ids."""
    schema = pa.schema([
        ("key", pa.string()), ("first", pa.int64()), ("n", pa.int64()), ("text", pa.string()),
        ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))])
    key, held, shape = None, [], None

    def piece() -> list:
        return [(key, held[0], len(held), ",".join(map(str, held)), *shape)] if held else []

    for batch in batches:
        rows = []
        keys, convs = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
        ids, sizes = batch.column("ids"), batch.column("sizes")
        for k, (now, conv) in enumerate(zip(keys, convs)):
            if now != key or len(held) == PIECE:
                rows += piece()
                key, held, shape = now, [], (ids[k].as_py(), sizes[k].as_py())
            held.append(conv)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    rows = piece()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def path_keys(ids: list[int]) -> list[int]:
    """A key of each prefix, the empty one first."""
    keep, state = (1 << 64) - 1, 0x243F6A8885A308D3
    out = [state]
    for turn_id in ids:
        state = ((state ^ (turn_id & keep)) * 0x9E3779B97F4A7C15) & keep
        state ^= state >> 29
        state = (state * 0xBF58476D1CE4E5B9) & keep
        state ^= state >> 32
        out.append(state)
    return [s - (1 << 64) if s >> 63 else s for s in out]


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by key and first id to one entry per key."""
    longs = pa.list_(pa.int64())
    schema = pa.schema([
        ("key", pa.string()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string()),
        ("ids", longs), ("sizes", longs), ("paths", longs)])
    key = conv = shape = checksum = None
    n = 0

    def entry() -> list:
        return [(key, conv, n, checksum.hexdigest(), *shape, path_keys(shape[0]))] if n else []

    def packed(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        rows = []
        for k, now in enumerate(batch.column("key").to_pylist()):
            text = batch.column("text")[k].as_py()
            if now != key:
                rows += entry()
                key, n, conv, checksum = now, 0, batch.column("first")[k].as_py(), hashlib.sha256()
                shape = batch.column("ids")[k].as_py(), batch.column("sizes")[k].as_py()
            else:
                checksum.update(b",")
            checksum.update(text.encode())
            n += batch.column("n")[k].as_py()
        if rows:
            yield packed(rows)
    rows = entry()
    if rows:
        yield packed(rows)


def entries(seqs: DataFrame) -> DataFrame:
    """One row per distinct sequence: smallest conversation, copies, checksum of their ids, prefix keys."""
    keyed = stored(seqs.select(F.md5(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("key"), "conv_id", "ids", "sizes"))
    pieces = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_pieces, PIECE_SCHEMA)
    return stored(pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_entries, ENTRY_SCHEMA))


# -- bursting ------------------------------------------------------------------------


def _placed(found: DataFrame, settings: Settings) -> DataFrame:
    """Entries with the depth of their container; NULL for those that end at a trie head."""
    waiting, rounds, depth, ahead = found, [], 0, 1
    while True:
        looked = waiting.select(
            "key", F.size("ids").alias("turns"), F.posexplode(F.slice("paths", depth + 1, ahead)).alias("at", "path"))
        burst = stored(
            looked.groupBy("at", "path").agg(F.sum("turns").alias("turns"), F.count(F.lit(1)).alias("held"))
            .where((F.col("turns") > settings.container_turns) & (F.col("held") > 1)).select("at", "path"))
        if burst.isEmpty():
            rounds.append(waiting.withColumn("home", F.lit(depth)))
            break
        # An entry passes the heads on its way from the top, so their number is the way it goes.
        passed = looked.join(burst, ["at", "path"], "left_semi").groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("passed"))
        moved = stored(waiting.join(passed, "key", "left").withColumn("passed", F.coalesce("passed", F.lit(0))))
        seen = F.least(F.lit(ahead), F.size("paths") - depth)
        ended = (F.col("passed") == seen) & (F.size("paths") <= depth + ahead)
        at_home = F.col("passed") < seen
        rounds.append(moved.where(at_home).withColumn("home", F.col("passed") + depth).drop("passed"))
        rounds.append(moved.where(ended).withColumn("home", F.lit(None).cast("int")).drop("passed"))
        waiting = moved.where(~at_home & ~ended).drop("passed")
        depth, ahead = depth + ahead, 2 * ahead
    return reduce(DataFrame.unionByName, rounds)


# -- containers ----------------------------------------------------------------------


class _Node:
    __slots__ = ("depth", "size", "conv", "n", "children", "leaves", "saved", "ends")

    def __init__(self, depth: int, size: int):
        self.depth, self.size = depth, size
        self.conv, self.n, self.children, self.leaves, self.saved, self.ends = None, 0, [], 0, 0, NO_ENDS

    def add(self, conv: int, n: int) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.n += n


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by container and turn ids to the nodes of each container."""
    longs = pa.list_(pa.int64())
    schema = pa.schema([
        ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
        ("top", pa.bool_()), ("paths", longs), ("sizes", longs)])
    stack: list[_Node] = []
    rows: list[tuple] = []
    container, before, above = None, [], None

    def close(depth: int) -> None:
        """Close all open nodes deeper than ``depth``."""
        while stack and stack[-1].depth > depth:
            node = stack.pop()
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.n - 1) * node.size
            # The smallest member of a node is known once it closes; its children waited for it.
            rows.extend((c[0], c[1], node.conv, *c[2:], False, None, None) for c in node.children)
            row = (node.conv, node.depth, node.n, len(node.children), leaves, saved, node.ends)
            if stack:
                parent = stack[-1]
                parent.add(node.conv, node.n)
                parent.children.append(row)
                parent.leaves += leaves
                parent.saved += saved
            else:
                rows.append((row[0], row[1], None, *row[2:], True, *above))

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        data = batch.to_pydict()
        for home, path, conv, n, ends, ids, sizes, paths in zip(
                *(data[c] for c in ("home", "container", "conv_id", "n", "ends", "ids", "sizes", "paths"))):
            if (home, path) != container:
                close(-1)
                container, above = (home, path), (paths[:home], sizes[:home])
                stack.append(_Node(home, sizes[home - 1] if home else 0))
                shared = home
            else:
                shared, most = home, min(len(ids), len(before))
                while shared < most and ids[shared] == before[shared]:
                    shared += 1
                close(shared)
            for depth in range(shared, len(ids)):
                stack.append(_Node(depth + 1, sizes[depth]))
            stack[-1].add(conv, n)
            stack[-1].ends = ends
            before = ids
        if rows:
            yield packed()
            rows.clear()
    close(-1)
    if rows:
        yield packed()


# -- trie heads ----------------------------------------------------------------------


def _heads(tops: DataFrame, ended: DataFrame) -> DataFrame:
    """Nodes of the trie above the containers, from the containers' tops and the entries that end in it.

    A head's own saving is added to the one entry that holds its smallest member: from there it
    reaches all heads above, like the sums of the containers do.
    """
    reports = tops.select(
        "conv_id", F.col("n_convs").alias("n"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"),
        F.lit(None).cast("string").alias("ends"), "paths", "sizes",
    ).unionByName(ended.select(
        "conv_id", "n", F.lit(0).cast("bigint").alias("leaves"), F.lit(0).cast("bigint").alias("saved"), "ends", "paths", "sizes"))
    last = F.size("paths") - 1
    way = stored(reports.select(
        "conv_id", "n", "leaves", "saved", "ends", "paths", "sizes", F.posexplode("paths").alias("depth", "path"), last.alias("last"),
    ).select(
        "conv_id", "n", "leaves", "saved", "depth", "path", F.when(F.col("depth") == F.col("last"), F.col("ends")).alias("ends"),
        F.when(F.col("depth") > 0, F.expr("paths[depth - 1]")).alias("parent"),
        F.when(F.col("depth") > 0, F.expr("sizes[depth - 1]")).otherwise(F.lit(0)).alias("size")))
    heads = stored(way.groupBy("depth", "path").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("leaves").alias("n_leaves"),
        F.max("ends").alias("ends"), F.min("parent").alias("parent"), F.min("size").alias("size")))
    own = heads.select("conv_id", "depth", "path", ((F.col("n_convs") - 1) * F.col("size")).alias("_own"))
    down = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    sums = (
        way.join(own, ["conv_id", "depth", "path"], "left")
        .withColumn("_below", F.col("saved") + F.sum(F.coalesce("_own", F.lit(0))).over(down))
        .groupBy("depth", "path").agg(F.sum("_below").alias("saved_tokens")))
    children = (
        tops.select((F.col("depth") - 1).cast("int").alias("depth"), F.element_at("paths", -1).alias("path"))
        .unionByName(heads.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("parent").alias("path")))
        .groupBy("depth", "path").agg(F.count(F.lit(1)).alias("n_children")))
    return heads.join(sums, ["depth", "path"]).join(children, ["depth", "path"])


def _with_parents(nodes: DataFrame, heads: DataFrame) -> DataFrame:
    """Nodes below a trie head learn its smallest member; ``parent`` is the head's path."""
    above = heads.select((F.col("depth") + 1).alias("depth"), F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(above, ["depth", "parent"], "left").select(*NODE_COLUMNS)


def nodes(seqs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All nodes of the prefix tree of ``seqs`` (conv_id, ids, sizes), the root included."""
    placed = _placed(entries(seqs), settings)
    swept = stored(
        placed.where("home is not null").withColumn("container", F.expr("paths[home]"))
        .repartition("home", "container").sortWithinPartitions("home", "container", "ids")
        .mapInArrow(_sweep, NODE_SCHEMA))
    inner = swept.where("not top or depth = 0").select(*NODE_COLUMNS)
    tops = swept.where("top and depth > 0")
    heads = stored(_heads(tops, placed.where("home is null")))
    below = tops.withColumn("parent", F.element_at("paths", -1)).drop("parent_conv_id")
    own = heads.select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), "parent", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
    return inner.unionByName(_with_parents(below, heads)).unionByName(_with_parents(own, heads))
