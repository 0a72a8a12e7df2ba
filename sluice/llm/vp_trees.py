"""Nearest neighbours by vantage-point trees, one for each shard of the vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import staged
from sluice.llm.ranks import runs_for
from sluice.llm.vectors import finite, kept_vectors, matrix

#: Vectors in one tree, and queries that one task puts to it, on average; they bound its memory.
SHARD_ROWS, QUERY_ROWS = 8192, 4096
LEAF = 64
#: Rounding of distances, as a share of them, that pruning leaves room for.
SLACK = 1e-9


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of one matrix from all of the other, in doubles.

    Squares are added from the first component to the last for every pair alike, so that equal
    pairs have equal distances, whichever batch they are in.
    """
    out = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, b.T, strict=True):
        apart = x[:, None] - y[None, :]
        apart *= apart
        out += apart
    return np.sqrt(out, out=out)


class VantagePointTree:
    """A tree over points: a node's points are halved by their distance from its vantage point.

    ``relax`` tunes pruning. A child is passed over if the least distance that its points may
    have, times ``relax``, is above the distance of the k-th point found so far. At 1 the triangle
    inequality proves that nothing is lost; above 1 more is passed over, and a few may be.
    """

    def __init__(self, points: np.ndarray, ids: np.ndarray, seed: int = 3):
        self.points, self.ids = points, ids
        self.rng = np.random.default_rng(seed)
        self.compared = 0
        # Inner nodes: vantage point, the two children, and their points' distances from it.
        self.vantage: list[int] = []
        self.children: list[tuple[int, int]] = []
        self.shells: list[tuple[float, float, float, float]] = []
        self.leaves: dict[int, np.ndarray] = {}
        self._grow(np.arange(len(points)))

    def _grow(self, rows: np.ndarray) -> int:
        node = len(self.vantage)
        self.vantage.append(-1)
        self.children.append((-1, -1))
        self.shells.append((0.0, 0.0, 0.0, 0.0))
        if len(rows) <= LEAF:
            self.leaves[node] = rows
            return node
        vantage = int(rows[self.rng.integers(len(rows))])
        away = distances(self.points[rows], self.points[vantage: vantage + 1])[:, 0]
        order = np.argsort(away, kind="stable")
        half = len(rows) // 2
        near, far = order[:half], order[half:]
        self.vantage[node] = vantage
        self.shells[node] = (away[near[0]], away[near[-1]], away[far[0]], away[far[-1]])
        # The vantage point is among its own points, so every point is in one leaf.
        inner = self._grow(rows[near])
        outer = self._grow(rows[far])
        self.children[node] = (inner, outer)
        return node

    def nearest(self, queries: np.ndarray, k: int, relax: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest points' rows and distances for each query, ties to the smaller id.

        Places that no point fills have row -1 and an infinite distance.
        """
        found = _Nearest(len(queries), k, self.ids)
        first = np.empty(len(queries), np.int64)
        self._descend(0, queries, np.arange(len(queries)), found, first)
        self._visit(0, queries, np.arange(len(queries)), found, first, relax)
        return found.rows, found.away

    def _from_vantage(self, node: int, queries: np.ndarray, active: np.ndarray) -> np.ndarray:
        self.compared += len(active)
        vantage = self.vantage[node]
        return distances(queries[active], self.points[vantage: vantage + 1])[:, 0]

    def _scan(self, node: int, queries: np.ndarray, active: np.ndarray, found: _Nearest) -> None:
        rows = self.leaves[node]
        self.compared += len(active) * len(rows)
        found.add(active, rows, distances(queries[active], self.points[rows]))

    def _descend(self, node: int, queries: np.ndarray, active: np.ndarray, found: _Nearest,
                 first: np.ndarray) -> None:
        """Send each query to the leaf that it would lie in, for a first bound."""
        if not len(active):
            return
        if node in self.leaves:
            first[active] = node
            self._scan(node, queries, active, found)
            return
        away = self._from_vantage(node, queries, active)
        inside = away <= (self.shells[node][1] + self.shells[node][2]) / 2
        for child, own in zip(self.children[node], (inside, ~inside), strict=True):
            self._descend(child, queries, active[own], found, first)

    def _visit(self, node: int, queries: np.ndarray, active: np.ndarray, found: _Nearest,
               first: np.ndarray, relax: float) -> None:
        if not len(active):
            return
        if node in self.leaves:
            self._scan(node, queries, active[first[active] != node], found)
            return
        away = self._from_vantage(node, queries, active)
        low_in, high_in, low_out, high_out = self.shells[node]
        room = SLACK * (away + high_out)
        for child, low, high in zip(self.children[node], (low_in, low_out), (high_in, high_out), strict=True):
            least = np.maximum(np.maximum(away - high, low - away) - room, 0.0)
            self._visit(child, queries, active[least * relax <= found.bound(active)], found, first, relax)


class _Nearest:
    """The k nearest points that each query has met, by distance, then id."""

    def __init__(self, queries: int, k: int, ids: np.ndarray):
        self.k, self.ids = k, ids
        self.rows = np.full((queries, k), -1, np.int64)
        self.away = np.full((queries, k), np.inf)

    def bound(self, active: np.ndarray) -> np.ndarray:
        return self.away[active, -1]

    def add(self, active: np.ndarray, rows: np.ndarray, away: np.ndarray) -> None:
        better = (away <= self.bound(active)[:, None]).any(axis=1)
        active, away = active[better], away[better]
        if not len(active):
            return
        all_rows = np.concatenate([self.rows[active], np.broadcast_to(rows, away.shape)], axis=1)
        all_away = np.concatenate([self.away[active], away], axis=1)
        ids = np.where(all_rows < 0, np.iinfo(np.int64).max, self.ids[all_rows])
        order = np.lexsort((ids, all_away), axis=1)[:, : self.k]
        self.rows[active] = np.take_along_axis(all_rows, order, axis=1)
        self.away[active] = np.take_along_axis(all_away, order, axis=1)


def _search(k: int, relax: float, dim: int):
    """Answers of one shard to one block of queries: up to k points with their ids for each."""
    def answer(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asked = table["asked"].to_numpy()
        is_query = table["is_query"].to_numpy(zero_copy_only=False)
        vectors, ids = matrix(table["v"], dim), table["ids"]
        points = np.flatnonzero(~is_query)
        queries = np.flatnonzero(is_query)
        empty = np.empty(0, np.int64)
        query, row, away = empty, empty, np.empty(0)
        if len(points) and len(queries):
            # Points by their smallest id, so that the tree doesn't depend on the order of rows.
            points = points[np.argsort(asked[points], kind="stable")]
            tree = VantagePointTree(vectors[points], asked[points])
            rows, found = tree.nearest(vectors[queries], k, relax)
            query, place = np.nonzero(rows >= 0)
            row, away = points[rows[query, place]], found[query, place]
        return pa.table({"asked": pa.array(asked[queries[query]]), "away": pa.array(away),
                         "ids": ids.take(pa.array(row))})

    return answer


def nearest_vectors(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                    k: int = 10, relax: float = 1.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other vectors of each query, nearest first.

    Score is the Euclidean distance in doubles, ties go to the smaller id. Vectors are dealt over
    shards by hash, queries over blocks; each shard's tree answers each block in a task of its
    own, so a task's memory doesn't grow with the tables. Equal vectors are one point with its
    k + 1 smallest ids, more of which no answer can hold, and equal queries are asked once; so a
    vector that many rows share is no more work than another. ``relax`` 1 is exact; above 1 the
    trees prune more than the triangle inequality allows (see ``VantagePointTree``).

    Cases: vectors that are null, empty, zero or have null or non-finite parts take no part, nor
    do those without id or of another length than the vector with the smallest id. Rows of one
    id are one, with the smallest of their vectors. With fewer candidates than k, all are
    returned. An empty table gives an empty one; other columns don't matter, the result's are
    always these four.
    """
    kept, dim = kept_vectors(vectors, vec_id, embedding, F.lit(None).cast("int"))
    # Adding zero makes both zeros one, as vectors are compared by their parts.
    usable = F.col("id").isNotNull() & F.exists("v", lambda x: x != 0)

    def by_ids(df: DataFrame) -> DataFrame:
        return df.groupBy("id").agg(F.min(F.transform("v", lambda x: x + F.lit(0.0))).alias("v"))

    rows = by_ids(kept.where(usable))
    by_id = Window.partitionBy("v").orderBy("id")
    # The limit on the row number is applied before the shuffle too, so a vector that many rows
    # share sends k + 1 of them from each task.
    points = staged(
        rows.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1)
        .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "points")
    asked = queries.select(F.col(vec_id).alias("id"), finite(F.col(embedding)).alias("v"))
    asked = staged(by_ids(asked.where(usable & (F.size("v") == dim))), "asked")
    each = staged(asked.groupBy("v").agg(F.min("id").alias("asked")), "queries")
    shards = runs_for(points.count(), SHARD_ROWS)
    blocks = runs_for(each.count(), QUERY_ROWS)

    def everywhere(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def one_of(n: int, key: str):
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    point = points.select(F.col("ids")[0].alias("asked"), "v", "ids")
    dealt = point.select(
        one_of(shards, "asked").alias("shard"), everywhere(blocks).alias("block"), "asked", F.lit(False).alias("is_query"),
        "v", "ids").unionByName(each.select(
            everywhere(shards).alias("shard"), one_of(blocks, "asked").alias("block"), "asked",
            F.lit(True).alias("is_query"), "v", F.lit(None).cast("array<bigint>").alias("ids")))
    found = dealt.groupBy("shard", "block").applyInArrow(
        _search(k + 1, relax, max(dim, 1)), "asked long, away double, ids array<bigint>")
    best = Window.partitionBy("asked").orderBy("away", F.col("ids")[0])
    nearest = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    # One row for each query vector: its k + 1 nearest rows, of which one may be the query itself.
    listed = F.flatten(F.transform("points", lambda p: F.transform(
        p["ids"], lambda i: F.struct(p["away"].alias("score"), i.alias("vec_id")))))
    answers = nearest.groupBy("asked").agg(F.collect_list(F.struct("away", "ids")).alias("points")).select(
        "asked", F.slice(F.array_sort(listed), 1, k + 1).alias("near"))
    # Which answer each query row gets; the join can be split where many rows ask the same.
    same = asked.join(each, "v").select("id", "asked").join(answers, "asked")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, k)
    return same.select(F.col("id").alias("query_id"), F.posexplode(others).alias("n", "x")).select(
        "query_id", (F.col("n") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
