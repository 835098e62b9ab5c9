"""Approximate nearest neighbours by vantage-point trees, one tree per shard.

Vectors are dealt to shards of bounded size by a hash, queries to blocks of bounded
size. A tree splits its points by their distance to a vantage point into a nearer
and a farther half; each child keeps the least and the greatest of these distances.
By the triangle inequality no point of a child is nearer to a query than the gap
between the query's distance and that range. A child is skipped where the gap exceeds
`factor` times the distance of the query's tenth neighbour so far: a factor of one
is exact, smaller ones skip more. Children nearer to the query come first. Searching
runs on all queries of a block at once.

How much a factor loses depends on the vectors, so unless one is given it is fitted to
the table: some queries (parameter `trial`) search one shard by each factor, and the
least one is taken whose recall against factor one, less two standard errors, reaches
the parameter `recall`. One shard's share of the neighbours is harder to find than
the whole table's, to which every shard adds its own best. The trial holds
a shard and a bounded number of queries, whatever the table's size; only sums a
factor reach the driver. All vectors are indexed and searched in any case.

Every shard gives each query its best; a ranking per query merges them. Candidates
are every vector but the query's own; distances are computed in double precision
from the original vectors, and ties go to the smaller id.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without an id; queries meet vectors of their own
length only; rows that repeat with one id are one candidate each, but none is its own
neighbour, and as a query an id has the least of its vectors; an empty table gives an empty result; other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import stored

NEIGHBOURS = 10
QUERY_EVERY = 100
FACTORS = (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.85)
RECALL = 0.95
TRIAL = 200
SHARD = 8_192
BLOCK = 4_096
LEAF = 256
CHUNK = 4_000_000


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows."""
    return np.sqrt(np.square(a - b).sum(axis=-1))


class Tree:
    """A balanced vantage-point tree over the rows of a matrix."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF, seed: int = 5):
        self.points, self.ids, self.leaf = points, ids, leaf
        self.squares = np.square(points).sum(axis=1)
        self.root = self._build(np.arange(len(ids)), np.random.default_rng(seed))

    def _build(self, rows: np.ndarray, rng: np.random.Generator) -> dict:
        if len(rows) <= self.leaf:
            return {"rows": rows}
        vantage = self.points[rng.choice(rows)]
        d = distances(self.points[rows], vantage)
        # Halves by rank, so that equal distances cannot unbalance the tree.
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        parts = [order[:half], order[half:]]
        return {
            "vantage": vantage,
            "ranges": [(d[p].min(), d[p].max()) for p in parts],
            "children": [self._build(rows[p], rng) for p in parts],
        }

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Distances and ids of the k nearest found for each query, padded by infinity and -1."""
        best = Best(queries, own, k)
        self._visit(self.root, np.arange(len(queries)), best, factor)
        return best.distance, best.ids

    def _visit(self, node: dict, active: np.ndarray, best: Best, factor: float) -> None:
        if not active.size:
            return
        if "rows" in node:
            rows = node["rows"]
            step = max(1, CHUNK // max(1, len(rows)))
            for i in range(0, active.size, step):
                best.offer(active[i:i + step], self.points[rows], self.squares[rows], self.ids[rows])
            return
        d = distances(best.queries[active], node["vantage"])
        gaps = [np.maximum(np.maximum(low - d, d - high), 0) for low, high in node["ranges"]]
        near_first = gaps[0] <= gaps[1]
        for first, some in ((0, near_first), (1, ~near_first)):
            for child in (first, 1 - first):
                reach = gaps[child][some] <= factor * best.distance[active[some], -1] + 1e-12
                self._visit(node["children"][child], active[some][reach], best, factor)


class Best:
    """The k best candidates of each query so far, by distance, then id."""

    def __init__(self, queries: np.ndarray, own: np.ndarray, k: int):
        self.queries, self.own, self.k = queries, own, k
        self.squares = np.square(queries).sum(axis=1)
        self.distance = np.full((len(queries), k), np.inf)
        self.ids = np.full((len(queries), k), -1, np.int64)

    def offer(self, active: np.ndarray, points: np.ndarray, squares: np.ndarray, ids: np.ndarray) -> None:
        """Compare some queries with some points.

        Products give distances up to rounding; only points that may be among the
        best are measured exactly.
        """
        q = self.queries[active]
        rough = self.squares[active, None] + squares[None, :] - 2 * q @ points.T
        slack = 1e-9 * (self.squares[active, None] + squares.max() + 1)
        bound = self.distance[active, -1:]
        limit = np.where(np.isfinite(bound), np.square(bound), np.inf)
        if len(ids) > self.k + 1:
            # The query itself may be among the points, so one more is needed.
            limit = np.minimum(limit, np.partition(rough, self.k, axis=1)[:, self.k:self.k + 1] + slack)
        at, hit = np.nonzero(rough <= limit + slack)
        keep = ids[hit] != self.own[active[at]]
        at, hit = at[keep], hit[keep]
        if not at.size:
            return
        exact = distances(q[at], points[hit])
        touched = np.unique(at)
        old_d, old_i = self.distance[active[touched]], self.ids[active[touched]]
        row = np.concatenate([np.repeat(np.arange(len(touched)), self.k), np.searchsorted(touched, at)])
        d = np.concatenate([old_d.ravel(), exact])
        i = np.concatenate([old_i.ravel(), ids[hit]])
        order = np.lexsort((i, d, row))
        row, d, i = row[order], d[order], i[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        first = rank < self.k
        self.distance[active[touched]] = d[first].reshape(-1, self.k)
        self.ids[active[touched]] = i[first].reshape(-1, self.k)


def _searcher(k: int, factor: float):
    def run(keys: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        vectors = vectors.sort_values("id", kind="stable")
        points = np.vstack(vectors["v"].to_numpy()).astype(np.float64)
        tree = Tree(points, vectors["id"].to_numpy(np.int64))
        asked = np.vstack(queries["v"].to_numpy()).astype(np.float64)
        own = queries["id"].to_numpy(np.int64)
        d, ids = tree.search(asked, own, k, factor)
        found = np.isfinite(d)
        return pd.DataFrame({
            "query_id": np.repeat(own, k)[found.ravel()], "vec_id": ids[found], "score": d[found],
        })

    return run


def _trial(k: int, factors: tuple[float, ...]):
    """Per factor the number of queries, and the sum and squares of their recall against factor one."""
    def run(keys: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(vectors) and len(queries):
            vectors = vectors.sort_values("id", kind="stable")
            tree = Tree(np.vstack(vectors["v"].to_numpy()).astype(np.float64), vectors["id"].to_numpy(np.int64))
            asked, own = np.vstack(queries["v"].to_numpy()).astype(np.float64), queries["id"].to_numpy(np.int64)
            exact, _ = tree.search(asked, own, k, 1.0)
            wanted = np.isfinite(exact).sum(axis=1)
            some = wanted > 0
            last = exact[np.arange(len(exact)), np.maximum(wanted, 1) - 1]
            for factor in factors:
                d, _ = tree.search(asked, own, k, factor)
                found = (np.isfinite(d) & (d <= last[:, None])).sum(axis=1)[some] / wanted[some]
                rows.append((factor, int(some.sum()), float(found.sum()), float(np.square(found).sum())))
        return pd.DataFrame(rows, columns=["factor", "n", "total", "squares"])

    return run


def fitted_factor(
    points: DataFrame, asked: DataFrame, n_asked: int, k: int = NEIGHBOURS, recall: float = RECALL, trial: int = TRIAL,
    factors: tuple[float, ...] = FACTORS,
) -> float:
    """The least factor that reaches the recall on one shard's points; one if none does.

    Points and queries have the columns id, v, dim; vectors of other lengths count together.
    """
    cells = 1 << 30
    drawn = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(cells)) < int(min(1.0, trial / max(1, n_asked)) * cells)
    sums = (
        points.select("dim", "id", "v").groupBy("dim").cogroup(asked.where(drawn).select("dim", "id", "v").groupBy("dim"))
        .applyInPandas(_trial(k, factors), "factor double, n long, total double, squares double")
        .groupBy("factor").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))
        .where("n > 1").collect()
    )
    for r in sorted(sums, key=lambda r: r.factor):
        mean = r.total / r.n
        spread = max(0.0, r.squares / r.n - mean * mean) / (r.n - 1)
        if mean - 2 * spread ** 0.5 >= recall:
            return r.factor
    return 1.0


def usable(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Ids and vectors as doubles (columns id, v) of the rows that take part."""
    v = F.col(vector_column).cast("array<double>")
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (
        df.select(F.col(id_column).cast("long").alias("id"), v.alias("v"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & whole & F.exists("v", lambda x: x != 0))
    )


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, factor: float | None = None,
    id_column: str = "vec_id", vector_column: str = "embedding", shard: int = SHARD, block: int = BLOCK,
    recall: float = RECALL, trial: int = TRIAL,
) -> DataFrame:
    """The k nearest found vectors of each query: query_id, rank, vec_id, score.

    A task holds one shard and one block of queries, whatever the table's size. The
    numbers of shards and blocks come from the row counts.
    """
    points = stored(usable(vectors, id_column, vector_column).withColumn("dim", F.size("v")))
    asked = stored(
        usable(queries, id_column, vector_column).groupBy("id").agg(F.min("v").alias("v"))
        .withColumn("dim", F.size("v")))
    shards = max(1, ceil(points.count() / shard))
    n_asked = asked.count()
    groups = max(1, ceil(n_asked / block))
    shard_of = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    block_of = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int")
    if factor is None:
        factor = fitted_factor(points.where(shard_of == 0), asked, n_asked, k, recall, trial)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = points.select("id", "v", "dim", shard_of.alias("shard"), every(groups).alias("part"))
    right = asked.select("id", "v", "dim", block_of.alias("part"), every(shards).alias("shard"))
    keys = ["dim", "shard", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _searcher(k, factor), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
