"""Exact top-k inner-product search: a ball tree per shard, branch and bound.

Vectors are dealt into shards of about ``shard_rows`` rows by a hash of their id. A task builds
the ball tree of one shard (split at the median along the widest direction, a centre and a radius
per node) and walks it for a block of queries: a node with centre ``c`` and radius ``r`` scores
at most ``q.c + |q| r``, children are visited in the order of that bound, and a query leaves a
subtree whose bound is below its current kth score. Every query first searches one shard, its
home; the kth score found there is shared with all other shards as their starting bound.

Queries meet the shards in blocks of ``block`` queries: a task holds one shard and one block. The
results of a query, at most k from each shard, are ranked by a window.

Scores are integer inner products of ``floor(scale * x)``, exact at any size; one that no long
holds counts as the long nearest to it. Ties go to the smaller id. Defined
results: vectors that are NULL or hold NULL or non-finite components, and rows without an id,
take no part; rows that agree in id and vector count once; only vectors of a query's length are
its candidates; a query with fewer candidates returns them all; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import cut


@dataclass(frozen=True)
class Settings:
    k: int = 5
    scale: int = 256
    shard_rows: int = 8192
    block: int = 2048
    leaf: int = 64


#: Below every score.
NOTHING = int(np.iinfo(np.int64).min)


def exact_type(*scaled: np.ndarray) -> type:
    """What holds all inner products of integral vectors exactly: doubles (fast), longs, or integers of any size."""
    most = max((float(np.abs(x).max()) for x in scaled if x.size), default=0.0)
    largest = most * most * scaled[0].shape[1]
    return float if largest < 2.0**53 else np.int64 if largest < 2.0**62 else object


def whole(scaled: np.ndarray, kind: type) -> np.ndarray:
    if kind is object:
        return np.array([[int(x) for x in row] for row in scaled], dtype=object).reshape(scaled.shape)
    return scaled.astype(kind)


class BallTree:
    """Arrays of nodes: centre, radius, children, and the row range of leaves."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, leaf: int):
        self.order = np.arange(len(rows))
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.children: list[tuple[int, int] | None] = []
        self.ranges: list[tuple[int, int]] = []
        self._build(rows, 0, len(rows), leaf)
        for a, z in (r for r, c in zip(self.ranges, self.children) if c is None):
            part = self.order[a:z]
            self.order[a:z] = part[np.argsort(ids[part], kind="stable")]
        self.rows, self.ids = rows[self.order], ids[self.order]
        self.centre = np.array(self.centres)
        self.radius = np.array(self.radii)

    def _build(self, rows: np.ndarray, a: int, z: int, leaf: int) -> int:
        node = len(self.ranges)
        part = rows[self.order[a:z]]
        centre = part.mean(axis=0)
        self.centres.append(centre)
        self.radii.append(float(np.sqrt(((part - centre) ** 2).sum(axis=1).max())))
        self.ranges.append((a, z))
        self.children.append(None)
        spread = part.max(axis=0) - part.min(axis=0) if z - a > leaf else np.zeros(1)
        if spread.max() > 0:
            wide = part[:, int(spread.argmax())]
            middle = (z - a) // 2
            self.order[a:z] = self.order[a:z][np.argpartition(wide, middle)]
            left = self._build(rows, a, a + middle, leaf)
            right = self._build(rows, a + middle, z, leaf)
            self.children[node] = (left, right)
        return node

    def search(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Best (scores, ids) per query; ``NOTHING`` where there are fewer than k. ``floor``: known kth scores.

        Bounds are doubles with some slack; scores are exact in the type that holds them.
        """
        kind = exact_type(self.rows, queries)
        rows, asked = (whole(x, kind) for x in (self.rows, queries))
        best = np.full((len(ids), k), NOTHING, dtype=float if kind is float else np.int64)
        names = np.full((len(ids), k), np.iinfo(np.int64).max)
        length = np.sqrt((queries**2).sum(axis=1))
        bounds = queries @ self.centre.T + length[:, None] * self.radius[None, :]
        slack = 1e-9 * (np.abs(bounds) + 1)
        bounds = np.nan_to_num(np.maximum(bounds + slack, float(NOTHING)), nan=np.inf, posinf=np.inf)

        def walk(node: int, active: np.ndarray) -> None:
            active = active[bounds[active, node] >= np.maximum(best[active, -1].astype(float), floor[active])]
            if not len(active):
                return
            below = self.children[node]
            if below is None:
                a, z = self.ranges[node]
                scores = asked[active] @ rows[a:z].T
                if kind is object:
                    scores = np.array([[min(max(s, NOTHING + 1), -NOTHING - 1) for s in row] for row in scores], dtype=np.int64)
                scores[ids[active][:, None] == self.ids[a:z][None, :]] = NOTHING
                scores = np.concatenate((best[active], scores), axis=1)
                those = np.concatenate((names[active], np.broadcast_to(self.ids[a:z], (len(active), z - a))), axis=1)
                place = -scores if kind is float else -np.unique(scores, return_inverse=True)[1].reshape(scores.shape)
                order = np.lexsort((those, place), axis=-1)[:, :k]
                best[active] = np.take_along_axis(scores, order, axis=1)
                names[active] = np.take_along_axis(those, order, axis=1)
                return
            for child in sorted(below, key=lambda c: -bounds[active, c].mean()):
                walk(child, active)

        walk(0, np.arange(len(ids)))
        return best, names


def _search(candidates: pd.DataFrame, queries: pd.DataFrame, settings: Settings) -> pd.DataFrame:
    """One shard and one block; queries: vec_id, vector, bound."""
    columns = ["query_id", "vec_id", "score"]
    if not len(candidates) or not len(queries):
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in columns})
    scaled = [np.floor(np.stack(f["vector"].tolist()) * settings.scale) for f in (candidates, queries)]
    ids, bound = queries["vec_id"].to_numpy(np.int64), queries["bound"].to_numpy(np.int64)
    tree = BallTree(scaled[0], candidates["vec_id"].to_numpy(np.int64), settings.leaf)
    best, names = tree.search(ids, scaled[1], bound.astype(float), settings.k)
    at, rank = np.nonzero((best > NOTHING) & (best >= bound[:, None]))
    return pd.DataFrame({"query_id": ids[at], "vec_id": names[at, rank], "score": best[at, rank].astype(np.int64)})


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (double), dim of the vectors that take part."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .where((F.size("vector") > 0) & finite).dropDuplicates(["vec_id", "vector"])
        .withColumn("dim", F.size("vector"))
    )


def top_k(vectors: DataFrame, is_query: Column, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's best rows other than its own."""
    rows = cut(usable(vectors))
    queries = rows.where(is_query)
    counts = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    shards = max(1, -(-counts[0] // settings.shard_rows))
    blocks = max(1, -(-counts[1] // settings.block))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards))
    home = F.pmod(F.xxhash64("vec_id", F.lit("home")), F.lit(shards))
    shape = "query_id long, vec_id long, score long"

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _search(left, right, settings)

    def paired(candidates: DataFrame, asked: DataFrame, *by: str) -> DataFrame:
        asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])
        return candidates.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(run, shape)

    dealt = rows.withColumn("_shard", shard)
    first = cut(paired(
        dealt, queries.select("vec_id", "vector", "dim", F.lit(NOTHING).alias("bound"), home.alias("_shard")),
        "dim", "_shard"))
    kth = first.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= settings.k, F.min("score")).alias("_kth"))
    known = queries.join(kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").select(
        "vec_id", "vector", "dim", F.coalesce("_kth", F.lit(NOTHING)).alias("bound"),
        home.alias("_home"), F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).alias("_block"))
    others = known.withColumn("_shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).where("_shard <> _home")
    copied = dealt.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    found = first.union(paired(copied, others, "dim", "_shard", "_block"))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= settings.k).select(
        "query_id", "rank", "vec_id", "score")
