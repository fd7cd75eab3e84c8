"""Nearest neighbours by inner product, with vantage-point trees per shard.

The inner product becomes a distance by one more coordinate: a vector of norm n gets sqrt(M^2 - n^2), M being
the largest norm of its shard, a query gets 0.  Then |q' - x'|^2 = M^2 + |q|^2 - 2 <q, x>, and the nearest
points are those of the largest product.  A tree node keeps a vantage point and, for each half of its points,
the smallest and the largest distance from it.  By the triangle inequality a half cannot hold a point within
``t`` of the query if its whole range is farther than ``t`` from the query's own distance to the vantage point.
``t`` is the distance of the k-th best so far, divided by ``factor``: one is exact search, more skips more.

All queries of a block go down a tree together, those nearer to one half taking that half first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyscape.llm.common import on_workers
from tallyscape.llm.groups import runs
from tallyscape.session import materialise

K = 20
SHARD_BYTES = 4 << 20  # of the doubles that a tree is built over
BLOCK_BYTES = 8 << 20  # of the doubles of the queries that meet a shard together
LEAF = 256
LENGTHS = 10_000  # different lengths of vectors up to which their table is broadcast
PAIRS = 1 << 15  # pairs recomputed at a time
_EPS = float(np.finfo(np.float64).eps)


# ---- one shard ------------------------------------------------------------------------


@dataclass
class _Half:
    rows: np.ndarray | None  # of a leaf
    vantage: int = -1
    ranges: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))
    halves: tuple[_Half, _Half] | None = None


class VantageTree:
    """A tree over the rows of ``vectors``; ``ids`` break ties, smaller first."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, *, leaf: int = LEAF, seed: int = 0):
        order = np.argsort(ids, kind="stable")
        self.power = int(_powers(np.abs(vectors).max(initial=0.0)))
        self.vectors, self.ids = np.ldexp(vectors[order], -self.power), ids[order]
        squares = (self.vectors**2).sum(1)
        self.most = float(squares.max(initial=0.0))
        self.lifted = np.concatenate([self.vectors, np.sqrt(np.maximum(self.most - squares, 0))[:, None]], axis=1)
        self.leaf = leaf
        self.random = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(ids)))

    def _build(self, rows: np.ndarray) -> _Half:
        if len(rows) <= self.leaf:
            return _Half(rows)
        vantage = int(self.random.choice(rows))
        far = np.linalg.norm(self.lifted[rows] - self.lifted[vantage], axis=1)
        inside = far <= np.median(far)
        if inside.all():
            inside = far < far.max()
        if min(inside.sum(), (~inside).sum()) < len(rows) // 16:  # most points at one distance: a split gains nothing
            return _Half(rows)
        ranges = tuple((float(far[side].min()), float(far[side].max())) for side in (inside, ~inside))
        return _Half(None, vantage, ranges, (self._build(rows[inside]), self._build(rows[~inside])))

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float = 1.0) -> Iterator[tuple[np.ndarray, ...]]:
        """(query number, row, score) arrays of the ``k`` best of every query, leaving out rows of its own id."""
        n = len(queries)
        powers = _powers(np.abs(queries).max(1, initial=0.0))
        queries = np.ldexp(queries, -powers[:, None])
        self.score, self.row = np.full((n, k), -np.inf), np.full((n, k), -1)
        self.visited = 0
        squares = (queries**2).sum(1)
        # a product may be off by this much
        slack = 4 * queries.shape[1] * _EPS * np.sqrt(squares * self.most)
        stack = [(self.root, np.arange(n), None)]
        while stack:
            node, some, bounds = stack.pop()
            if bounds is not None:  # judged when its turn comes, by the best known then
                to_vantage, (low, high) = bounds
                reach = self.most + squares[some] - 2 * (self.score[some, -1] - slack[some])
                reach = np.sqrt(np.maximum(reach, 0)) / factor
                # rounding of the distances, with the small numbers where they are worst
                reach += 1e-7 * np.sqrt(self.most + squares[some])
                kept = (to_vantage - high <= reach) & (low - to_vantage <= reach)
                some = some[kept]
            if not len(some):
                continue
            if node.rows is not None:
                self._meet(queries, own, some, node.rows, slack)
                continue
            product = queries[some] @ self.vectors[node.vantage]
            to_vantage = np.sqrt(np.maximum(self.most + squares[some] - 2 * product, 0))
            (_, a), (b, _) = node.ranges
            near = to_vantage <= (a + b) / 2
            for first in (True, False):
                group = near == first
                if group.any():
                    turns = (0, 1) if first else (1, 0)
                    for turn in reversed(turns):  # the last pushed is next
                        stack.append((node.halves[turn], some[group], (to_vantage[group], node.ranges[turn])))
        found = np.nonzero(self.row >= 0)
        return found[0], self.row[found], np.ldexp(self.score[found], self.power + powers[found[0]])

    def _meet(self, queries: np.ndarray, own: np.ndarray, some: np.ndarray, rows: np.ndarray, slack: np.ndarray) -> None:
        """Let a leaf's rows compete; products decide who is recomputed in one fixed order of additions."""
        k = self.score.shape[1]
        self.visited += len(some) * len(rows)
        step = max(1, PAIRS // len(rows))
        for start in range(0, len(some), step):
            part = some[start : start + step]
            rough = queries[part] @ self.vectors[rows].T
            rough[own[part][:, None] == self.ids[rows]] = -np.inf
            least = self.score[part, -1] - 2 * slack[part]
            if len(rows) > k:
                least = np.maximum(least, np.partition(rough, -k, axis=1)[:, -k] - 2 * slack[part])
            q, r = np.nonzero((rough >= least[:, None]) & (rough > -np.inf))
            if not len(q):
                continue
            exact = inner(queries[part[q]], self.vectors[rows[r]])
            held = np.nonzero(self.row[part] >= 0)
            whose = np.concatenate([q, held[0]])
            score = np.concatenate([exact, self.score[part][held]])
            row = np.concatenate([rows[r], self.row[part][held]])
            order = np.lexsort((row, -score, whose))  # rows stand in the order of their ids
            whose, score, row = whose[order], score[order], row[order]
            place = np.arange(len(whose)) - np.searchsorted(whose, whose)
            kept = place < k
            whose, place = part[whose[kept]], place[kept]
            self.score[whose, place], self.row[whose, place] = score[kept], row[kept]


def _powers(largest: np.ndarray) -> np.ndarray:
    """Powers of two to divide by where squares would leave the range of doubles, else 0."""
    power = np.frexp(largest)[1]
    return np.where(np.abs(power) > 400, power, 0)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, added from the first component to the last: the same for equal vectors anywhere."""
    return np.add.accumulate(a * b, axis=1)[:, -1]


# ---- all shards -----------------------------------------------------------------------


def _cells(k: int, factor: float):
    def matrix(rows: pa.Table) -> np.ndarray:
        values = rows.column("embedding").combine_chunks()
        return values.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, "cell"):
            asked = cell.column("asked").to_numpy()
            points, queries = cell.filter(pa.array(~asked)), cell.filter(pa.array(asked))
            if not points.num_rows or not queries.num_rows:
                continue
            tree = VantageTree(matrix(points), points.column("vec_id").to_numpy())
            own = queries.column("vec_id").to_numpy()
            q, row, score = tree.search(matrix(queries), own, k, factor)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[q]), queries.column("query").combine_chunks().take(pa.array(q)), pa.array(tree.ids[row]), pa.array(score)],
                ["query_id", "query", "vec_id", "score"],
            )

    return run


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, embedding (doubles) of the vectors that take part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    unfit = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return rows.filter(F.col("vec_id").isNotNull() & ~unfit & some)


def nearest(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    *,
    k: int = K,
    every: int = 20,
    factor: float = 1.0,
    shard_bytes: int = SHARD_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of the largest inner product with each query.

    Queries are the rows whose id ``every`` divides, candidates all rows of another id and the same length;
    fewer than ``k`` are all returned.  Ties go to the smaller id.  Vectors that are null, empty or zero,
    hold null or non-finite components, or have no id take no part.  A row that is repeated counts
    once; rows of one id with different vectors are points, and queries, of their own.

    Points are dealt by id into shards of ``shard_bytes``, queries into blocks, and every block meets every
    shard in a cell of its own; a cell returns ``k`` rows per query.  Of equal vectors the k + 1 smallest ids
    are dealt: no query can use more, and a vector that a third of all rows share costs no more than others.
    """
    rows = usable(vectors, vec_id, embedding).withColumn("dim", F.size("embedding"))
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).distinct()
    asked = materialise(asked.withColumn("query", F.xxhash64("vec_id", "embedding")), "queries")
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    points = rows.distinct().withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)
    points = materialise(points.drop("copy").withColumn("query", F.lit(None).cast("long")), "points")

    def parts(df: DataFrame, name: str, size: int) -> DataFrame:
        pieces = F.ceil(F.count("*") * F.col("dim") * 8 / size)
        return df.groupBy("dim").agg(F.greatest(F.lit(1), pieces).cast("int").alias(name))

    sizes = parts(points, "shards", shard_bytes).join(parts(asked, "blocks", block_bytes), "dim")
    met = sizes.agg(F.sum(F.col("shards").cast("long") * F.col("blocks")), F.count("*")).first()
    cells = met[0] or 1
    if met[1] <= LENGTHS:  # one row for each length of vectors
        sizes = F.broadcast(sizes)

    def dealt(part: DataFrame, own: str, others: str, asked: bool) -> DataFrame:
        at = F.pmod(F.xxhash64(F.lit(own), "vec_id"), F.col(own)).cast("int")
        spread = part.join(sizes, "dim").select(
            "dim", "vec_id", "embedding", "query", at.alias("at"), F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias("other")
        )
        shard, block = ("other", "at") if asked else ("at", "other")
        return spread.select(
            F.struct("dim", F.col(shard).alias("shard"), F.col(block).alias("block")).alias("cell_of"),
            "vec_id", "embedding", "query", F.lit(asked).alias("asked"),
        )

    both = dealt(points, "shards", "blocks", False).unionByName(dealt(asked, "blocks", "shards", True))
    # one name per cell, without collisions
    name = F.concat_ws(" ", "cell_of.dim", "cell_of.shard", "cell_of.block")
    both = both.select(name.alias("cell"), "vec_id", "embedding", "query", "asked")
    placed = on_workers(both).repartition(min(4 * cells, 20_000), "cell").sortWithinPartitions("cell")
    near = placed.mapInArrow(_cells(k, factor), "query_id long, query long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
