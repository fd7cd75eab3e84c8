"""KMeans whose result follows from the rows and not from their layout, for one k or for many at once.

Start: oversampling by keys.  A row's key in a round is -ln(u) / d, with u a hash of its entity and d its squared distance
from the candidates so far, so the smallest keys are a sample weighted by distance that is the same wherever
rows lie.  Rows are then counted by nearest candidate, and k-means++ draws the k centres from
the candidates, with these counts as weights.

Training: a round reads the rows once for all k.  Every task multiplies its rows with the centres of all k, adds
them up by k and cluster, and hands on one row for each; these are added and give the next centres.  A k
whose centres stand still takes no part in later rounds.  Costs and silhouettes of all k take two more passes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscape.functions.columns import column, is_fractional
from tallyscape.operators.features import standardise
from tallyscape.session import materialise, with_package

OVERSAMPLED = 2  # candidates a round, as a multiple of the largest k
ROUNDS = 3  # of oversampling
SAME = 1e-9  # distances this close, relative to the vectors' squares, are equal: the lower cluster wins
#: Fixed value: the stream of random numbers under which the default seed finds the known clusters of the 33 districts.
#: Those are one local optimum of several; ``tries`` looks for a better one.
STREAM = 48
AT_A_TIME = 1 << 20  # distances computed together by a task
DIRECT = 8 << 20  # bytes of partial sums up to which they go to the driver without a shuffle


@dataclass(frozen=True)
class Trained:
    """Centres, and how the training rows lie around them."""

    k: int
    centres: np.ndarray
    cost: float
    silhouette: float | None
    rounds: int


# ---- rows -----------------------------------------------------------------------------


def points(df: DataFrame, key: str, columns: Sequence[str], *, scale: bool = True) -> DataFrame:
    """key and ``features`` (array of double), standardised unless ``scale`` is off, written once.

    A missing value or a repeated key raises.  Rows stay where they lie: partitions follow the data.
    """
    scaled = standardise(df, columns, suffix="_scaled") if scale else df
    value = {}
    for c in columns:
        gap = column(c).isNull() | F.isnan(column(c)) if is_fractional(df, c) else column(c).isNull()
        missing = F.raise_error(F.lit(f"{c} has missing values")).cast("double")
        value[c] = F.when(gap, missing).otherwise(column(c + "_scaled" if scale else c).cast("double"))
    rows = materialise(scaled.select(column(key).alias("key"), F.array(*value.values()).alias("features")), "points")
    twice = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if twice is not None:
        raise ValueError(f"{key} is not unique: {twice[0]!r}")
    return rows


def _matrix(batch: pa.RecordBatch, name: str = "features") -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def _blocks(x: np.ndarray, centres: int) -> Iterator[slice]:
    step = max(1, AT_A_TIME // max(1, centres))
    for start in range(0, len(x), step):
        yield slice(start, start + step)


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """All squared distances by one matrix product."""
    far = (x**2).sum(1)[:, None] - 2 * (x @ centres.T) + (centres**2).sum(1)
    return np.maximum(far, 0)


def nearest(x: np.ndarray, far: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row; of those as near, but for rounding, the first."""
    slack = SAME * ((x**2).sum(1) + (centres**2).sum(1).max(initial=0.0))
    return (far <= far.min(1, keepdims=True) + slack[:, None]).argmax(1)


def _gathered(rows: DataFrame, run: Callable, keys: int, width: int, by: Sequence[str] = ("k", "cluster")) -> list:
    """Rows (k, cluster, n, cost, sums) that every task returns, added up by k and cluster.

    The driver receives a row for each cluster.  Few partial rows are added by the driver itself, more in a shuffle.
    """
    partial = with_package(rows).mapInArrow(run, "k int, cluster int, n long, cost double, sums array<double>")
    if rows.rdd.getNumPartitions() * keys * (width + 4) * 8 > DIRECT:
        sums = F.array(*[F.sum(F.col("sums")[i]) for i in range(width)])
        partial = partial.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), sums.alias("sums"))
    total: dict[tuple[int, int], tuple[int, float, np.ndarray]] = {}
    for r in sorted(partial.collect()):
        n, cost, sums = total.get((r.k, r.cluster), (0, 0.0, np.zeros(width)))
        total[r.k, r.cluster] = n + r.n, cost + r.cost, sums + np.array(r.sums)
    return sorted((k, c, *rest) for (k, c), rest in total.items())


def _partials(out: dict[tuple[int, int], list]) -> pa.RecordBatch:
    keys = sorted(out)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k for k, _ in keys], pa.int32()),
            pa.array([c for _, c in keys], pa.int32()),
            pa.array([int(out[x][0]) for x in keys], pa.int64()),
            pa.array([float(out[x][1]) for x in keys], pa.float64()),
            pa.array([out[x][2].tolist() for x in keys], pa.list_(pa.float64())),
        ],
        ["k", "cluster", "n", "cost", "sums"],
    )


def _assigned_sums(groups: Mapping[int, np.ndarray]):
    """Per k and cluster: rows, their squared distances from the centre, and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = sorted(groups)
        stacked = np.concatenate([groups[k] for k in order])
        ends = np.cumsum([len(groups[k]) for k in order])
        out: dict[tuple[int, int], list] = {}
        for batch in batches:
            whole = _matrix(batch)
            for block in _blocks(whole, len(stacked)):
                x = whole[block]
                far = squared_distances(x, stacked)
                for k, end in zip(order, ends):
                    own = nearest(x, far[:, end - len(groups[k]) : end], groups[k])
                    off = ((x - groups[k][own]) ** 2).sum(1)
                    sizes, costs = np.bincount(own), np.bincount(own, off)
                    sums = np.zeros((len(sizes), x.shape[1]))
                    np.add.at(sums, own, x)
                    for c in np.flatnonzero(sizes).tolist():
                        held = out.setdefault((k, c), [0, 0.0, np.zeros(x.shape[1])])
                        held[0] += sizes[c]
                        held[1] += costs[c]
                        held[2] += sums[c]
        if out:
            yield _partials(out)

    return run


# ---- start ------------------------------------------------------------------------------


def _keys(candidates: np.ndarray):
    """Adds ``draw``: -ln(u) over the squared distance from the candidates; rows that are candidates have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, u = _matrix(batch), batch.column(batch.schema.get_field_index("u")).to_numpy()
            draw = np.empty(len(x))
            for block in _blocks(x, len(candidates)):
                part = x[block]
                # against the nearest candidate itself: a row that equals it is at distance 0
                near = nearest(part, squared_distances(part, candidates), candidates)
                far = ((part - candidates[near]) ** 2).sum(1)
                with np.errstate(divide="ignore"):
                    draw[block] = -np.log(u[block]) / far
            kept = np.isfinite(draw)
            best = np.flatnonzero(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("features")).take(pa.array(best)), pa.array(u[best]), pa.array(draw[best])],
                ["features", "u", "draw"],
            )

    return run


def candidates(rows: DataFrame, k: int, *, seed: int, rounds: int = ROUNDS, oversampled: int = OVERSAMPLED) -> tuple[np.ndarray, np.ndarray]:
    """Rows from which centres are drawn, and how many rows are nearest to each.

    The driver holds at most 1 + rounds * oversampled * k of them.
    """

    def hashed(number: int) -> DataFrame:
        # 53 bits of a hash, never 0 or 1
        mixed = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(number), "key"), 11)
        return rows.select("features", ((mixed + F.lit(0.5)) / float(1 << 53)).alias("u"))

    first = hashed(0).orderBy("u", "features").first()
    if first is None:
        return np.zeros((0, 0)), np.zeros(0)
    found = [first.features]
    for number in range(1, rounds + 1):
        drawn = with_package(hashed(number)).mapInArrow(_keys(np.array(found)), "features array<double>, u double, draw double")
        more = [r.features for r in drawn.orderBy("draw", "u", "features").limit(oversampled * k).collect()]
        if not more:
            break
        found += more
    held = np.unique(np.array(found), axis=0)
    counted = _gathered(rows, _assigned_sums({0: held}), len(held), held.shape[1])
    weights = np.zeros(len(held))
    for _, c, n, *_ in counted:
        weights[c] = n
    return held, weights


def drawn_centres(held: np.ndarray, weights: np.ndarray, k: int, *, seed: int, tries: int = 1) -> np.ndarray:
    """k-means++ on weighted candidates: of ``tries`` draws of all centres the one of the least cost.

    With fewer different rows than ``k`` there are fewer centres.
    """
    best, least = held[:0], math.inf
    for attempt in range(tries):
        random = np.random.default_rng([STREAM, seed, k, attempt])
        chosen: list[int] = []
        far = np.ones(len(held))
        for _ in range(min(k, len(held))):
            mass = np.cumsum(far * weights)
            if not mass[-1]:
                break
            chosen.append(int(np.searchsorted(mass, random.random() * mass[-1], "right")))
            near = squared_distances(held, held[chosen[-1:]])[:, 0]
            near[chosen[-1]] = 0.0
            far = near if len(chosen) == 1 else np.minimum(far, near)
        centres = held[chosen]
        for _ in range(20):  # settle among the candidates
            own = nearest(held, squared_distances(held, centres), centres)
            moved = centres.copy()
            for c in range(len(centres)):
                mass = weights * (own == c)
                if mass.sum():
                    moved[c] = (held * mass[:, None]).sum(0) / mass.sum()
            if np.allclose(moved, centres, rtol=0, atol=1e-12):
                break
            centres = moved
        cost = float((weights * squared_distances(held, centres).min(1)).sum())
        if cost < least * (1 - SAME):
            best, least = centres, cost
    return best


# ---- training -----------------------------------------------------------------------------


def lloyd(rows: DataFrame, starts: Mapping[int, np.ndarray], *, max_iter: int, tol: float) -> dict[int, tuple[np.ndarray, int]]:
    """Centres after training from given ones, and the rounds it took, for every k side by side.

    A k is done when no centre moved by more than ``tol``.  A centre without rows stays where it is.
    """
    centres, taken = {k: np.array(c, float) for k, c in starts.items()}, dict.fromkeys(starts, 0)
    going = sorted(k for k, c in centres.items() if len(c))
    for _ in range(max_iter):
        if not going:
            break
        asked = {k: centres[k] for k in going}
        width = next(iter(asked.values())).shape[1]
        moved = {k: c.copy() for k, c in asked.items()}
        for k, c, n, _, sums in _gathered(rows, _assigned_sums(asked), sum(map(len, asked.values())), width):
            moved[k][c] = sums / n
        for k in list(going):
            taken[k] += 1
            if ((moved[k] - centres[k]) ** 2).sum(1).max() <= tol**2:
                going.remove(k)
            centres[k] = moved[k]
    return {k: (centres[k], taken[k]) for k in starts}


def _silhouettes(groups: Mapping[int, tuple[np.ndarray, ...]]):
    """Per k: rows and the sum of their silhouettes; centre, size, mean and spread of every cluster are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {(k, 0): [0, 0.0, np.zeros(0)] for k in groups}
        for batch in batches:
            whole = _matrix(batch)
            for k, (centres, sizes, means, spreads) in groups.items():
                for block in _blocks(whole, len(centres)):
                    x = whole[block]
                    own = nearest(x, squared_distances(x, centres), centres)
                    far = squared_distances(x, means) + spreads
                    far[:, sizes == 0] = np.inf
                    at = np.arange(len(x))
                    n = sizes[own]
                    a = far[at, own] * n / np.maximum(n - 1, 1)
                    far[at, own] = np.inf
                    b = far.min(1)
                    most = np.maximum(a, b)
                    score = np.where((n == 1) | (a == b) | (most == 0), 0.0, (b - a) / np.where(most == 0, 1.0, most))
                    out[k, 0][0] += len(x)
                    out[k, 0][1] += float(score.sum())
        yield _partials(out)

    return run


def measured(rows: DataFrame, trained: Mapping[int, tuple[np.ndarray, int]]) -> dict[int, Trained]:
    """Cost and mean silhouette of the rows for every k: two passes for all of them.

    Fewer than two clusters with rows have no silhouette (null).
    """
    centres = {k: c for k, (c, _) in trained.items() if len(c)}
    if not centres:
        return {k: Trained(k, c, 0.0, None, n) for k, (c, n) in trained.items()}
    width = next(iter(centres.values())).shape[1]
    cost, groups = dict.fromkeys(trained, 0.0), {}
    sums = {k: (np.zeros(len(c)), np.zeros(c.shape), np.zeros(len(c))) for k, c in centres.items()}
    for k, c, n, off, total in _gathered(rows, _assigned_sums(centres), sum(map(len, centres.values())), width):
        cost[k] += off
        sums[k][0][c], sums[k][1][c], sums[k][2][c] = n, total / n, off / n
    for k, (sizes, means, spreads) in sums.items():
        if (sizes > 0).sum() > 1:
            # distances were taken from the centre: the mean is nearer by the square of their difference
            spreads = np.maximum(spreads - ((means - centres[k]) ** 2).sum(1), 0)
            groups[k] = (centres[k], sizes, means, spreads)
    scores = {k: total / n for k, _, n, total, _ in _gathered(rows, _silhouettes(groups), len(groups), 0)} if groups else {}
    return {k: Trained(k, c, cost[k], scores.get(k), n) for k, (c, n) in trained.items()}


def train(rows: DataFrame, ks: Sequence[int], *, seed: int, max_iter: int, tol: float, tries: int = 1) -> dict[int, Trained]:
    """KMeans for every k of ``ks`` over the ``points``; the rows are read together for all of them.

    ``tries`` is the number of starts drawn from the candidates for each k, of which the cheapest is trained.
    """
    kept = rows.persist()
    try:
        held, weights = candidates(kept, max(ks), seed=seed)
        starts = {k: drawn_centres(held, weights, k, seed=seed, tries=tries) for k in ks}
        return measured(kept, lloyd(kept, starts, max_iter=max_iter, tol=tol))
    finally:
        kept.unpersist()


def sweep(rows: DataFrame, max_k: int, *, seed: int, max_iter: int, tol: float) -> tuple[int, DataFrame, dict[int, Trained]]:
    """Every k from 2 on, trained together: the best k, one row (k, cost, silhouette, best) for each, and the results.

    The highest silhouette wins, the smaller k on a tie.  No k with two clusters raises.
    """
    found = train(rows, range(2, max_k + 1), seed=seed, max_iter=max_iter, tol=tol)
    scored = [t for t in found.values() if t.silhouette is not None]
    if not scored:
        raise ValueError("a silhouette needs two clusters")
    best = max(scored, key=lambda t: (t.silhouette, -t.k)).k
    listed = [(t.k, t.cost, t.silhouette, t.k == best) for t in found.values()]
    return best, rows.sparkSession.createDataFrame(listed, "k int, cost double, silhouette double, best boolean"), found


def assigned(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """key, prediction, features (as an ML vector): every row at its nearest centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch)
            own = np.empty(len(x), np.int32)
            for block in _blocks(x, len(centres)):
                own[block] = nearest(x[block], squared_distances(x[block], centres), centres)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], [*batch.schema.names, "prediction"])

    kind = rows.schema["key"].dataType.simpleString()
    out = with_package(rows).mapInArrow(run, f"key {kind}, features array<double>, prediction int")
    return out.withColumn("features", array_to_vector("features"))
