"""Nearest of any number of centres: blocks of bounded size, batch products, bounds from lengths.

The centres come to the driver one block at a time, in order of length.  A pass over the rows compares them with one
block, in the tasks, and keeps the best so far.  As a distance is never less than the difference of the lengths, a
row skips the parts of a block whose lengths are too far from its own.  What is left is compared through one matrix
product; the centres that come within rounding of the least are then measured exactly, so results do not depend on
how centres were cut into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyscape.session import materialise, with_package

BLOCK_BYTES = 16 << 20  # of the centres a task holds at a time
PART = 2048  # centres in one product, whose lengths give one bound
ROWS = 512  # rows in one product
SLACK = 1e-9  # relative width within which products are measured again

_INNER = ("_x", "_best", "_best_id", "_own", "_own_value", "_own_size")


@dataclass
class Block:
    """Centres in order of length; ``extra`` is added to the squared distance."""

    ids: pa.Array
    points: np.ndarray
    extra: np.ndarray
    sizes: np.ndarray


def _blocks(centres: DataFrame, kind: T.DataType, block_bytes: int) -> Iterator[Block]:
    """The centres in blocks of at most ``block_bytes``; the driver holds one block and one partition."""
    length = F.aggregate("centre", F.lit(0.0), lambda total, v: total + v * v)
    usable = centres.filter("cluster_id is not null and size(centre) > 0").filter(
        F.forall("centre", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    )
    placed = materialise(usable.select("cluster_id", "centre", "extra", "size").orderBy(length, "cluster_id"), "centres")
    held, used, dim = [], 0, None
    arrow = _arrow(kind)

    def block() -> Block:
        return Block(
            pa.array([r.cluster_id for r in held], arrow),
            np.array([r.centre for r in held], np.float64),
            np.array([r.extra for r in held], np.float64),
            np.array([r.size for r in held], np.int64),
        )

    for row in placed.orderBy(length, "cluster_id").toLocalIterator():
        dim = len(row.centre) if dim is None else dim
        if len(row.centre) != dim:
            raise ValueError(f"centres of {dim} and {len(row.centre)} numbers")
        if held and used + 8 * dim > block_bytes:
            yield block()
            held, used = [], 0
        held.append(row)
        used += 8 * dim
    if held:
        yield block()


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _points(x: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rows with ``dim`` finite numbers, and their values."""
    lengths = np.diff(x.offsets.to_numpy())
    whole = np.flatnonzero((lengths == dim) & x.is_valid().to_numpy(zero_copy_only=False))
    values = x.take(pa.array(whole)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), dim)
    good = np.isfinite(values).all(1)
    return whole[good], values[good]


def _exact(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of pairs of rows, added from the first number to the last."""
    return np.cumsum((x - c) ** 2, axis=1)[:, -1]


def _improve(x: np.ndarray, own: np.ndarray, block: Block, best: np.ndarray, best_at: np.ndarray, better) -> None:
    """Lowers ``best`` (and sets ``best_at``) where a centre of the block other than ``own`` is nearer."""
    lengths = np.sqrt((block.points**2).sum(1))
    xx = np.sqrt((x**2).sum(1))
    for start in range(0, len(lengths), PART):
        part = slice(start, start + PART)
        points, extra = block.points[part], block.extra[part]
        low, high = lengths[part].min(), lengths[part].max()
        gap = np.maximum(0, np.maximum(low - xx, xx - high))
        near = np.flatnonzero(~(gap**2 * (1 - SLACK) + extra.min() > best * (1 + SLACK)))
        for some in (near[i : i + ROWS] for i in range(0, len(near), ROWS)):
            d = xx[some, None] ** 2 + lengths[None, part] ** 2 - 2 * (x[some] @ points.T) + extra[None, :]
            scale = xx[some] ** 2 + high**2 + np.abs(extra).max()
            # numbers too large for products are measured one by one
            d[~np.isfinite(d)] = -np.inf
            mine = own[some] - start
            held = (mine >= 0) & (mine < len(points))
            d[np.flatnonzero(held), mine[held]] = np.inf
            edge = np.minimum(d.min(1), best[some]) + SLACK * scale
            edge[~np.isfinite(edge)] = np.inf
            at, centre = np.nonzero((d <= edge[:, None]) & (d < np.inf))
            for pairs in (slice(i, i + 65536) for i in range(0, len(at), 65536)):
                rows, columns = some[at[pairs]], centre[pairs]
                value = _exact(x[rows], points[columns]) + extra[columns]
                order = np.lexsort((value, rows))
                rows, columns, value = rows[order], columns[order], value[order]
                first = np.r_[True, rows[1:] != rows[:-1]] if len(rows) else np.zeros(0, bool)
                # a row's least value of this part; of equal ones the lowest id
                least = value[first][np.cumsum(first) - 1]
                for r, c, v in zip(*(a[value == least].tolist() for a in (rows, columns, value)), strict=True):
                    if v < best[r] or (v == best[r] and better(start + c, r)):
                        best[r], best_at[r] = v, start + c


def _compare(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        ids = block.ids.to_pylist()
        place = {c: i for i, c in enumerate(ids)}
        for batch in batches:
            at = {n: batch.schema.get_field_index(n) for n in _INNER}
            columns = list(batch.columns)
            good, x = _points(columns[at["_x"]], block.points.shape[1])
            before = columns[at["_best_id"]].to_pylist()
            best = columns[at["_best"]].to_numpy(zero_copy_only=False).astype(np.float64)[good]
            best[np.isnan(best)] = np.inf
            own = np.array([place.get(v, -1) for v in columns[at["_own"]].take(pa.array(good)).to_pylist()], np.int64)
            found = np.full(len(good), -1)

            def better(c: int, r: int) -> bool:
                other = ids[found[r]] if found[r] >= 0 else before[good[r]]
                return other is None or ids[c] < other

            with np.errstate(over="ignore", invalid="ignore"):
                _improve(x, own, block, best, found, better)
            value = np.full(len(batch), np.nan)
            value[good] = best
            known = np.zeros(len(batch), bool)
            known[good] = np.isfinite(best) | (found >= 0)
            names = before
            for r in np.flatnonzero(found >= 0).tolist():
                names[good[r]] = ids[found[r]]
            columns[at["_best"]] = pa.array(value, mask=~known)
            columns[at["_best_id"]] = pa.array(names, columns[at["_best_id"]].type)
            mine = np.flatnonzero(own >= 0)
            if len(mine):
                values, sizes = columns[at["_own_value"]].to_pylist(), columns[at["_own_size"]].to_pylist()
                with np.errstate(over="ignore"):
                    measured = _exact(x[mine], block.points[own[mine]]) + block.extra[own[mine]]
                for r, v, n in zip(good[mine].tolist(), measured.tolist(), block.sizes[own[mine]].tolist(), strict=True):
                    values[r], sizes[r] = v, n
                columns[at["_own_value"]], columns[at["_own_size"]] = pa.array(values, pa.float64()), pa.array(sizes, pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def compared(
    df: DataFrame,
    features: Column,
    centres: DataFrame,
    *,
    own: Column | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, Sequence[str]]:
    """``df`` with the least squared distance plus ``extra`` over all centres but the row's own.

    ``centres`` has columns cluster_id, centre, extra and size; those without id or with a missing or infinite number
    are left out, and centres of different lengths raise.  Added are ``_best`` and ``_best_id`` (ties: lowest id), and for the centre whose id is
    ``own`` ``_own_value`` and ``_own_size``; a row with a missing or infinite feature, or one of another length, has none.
    All added columns are named in the second value.  With several blocks the rows are written between passes.
    """
    kind = centres.schema["cluster_id"].dataType
    name = kind.simpleString()
    rows = df.select(
        "*",
        features.cast("array<double>").alias("_x"),
        F.lit(None).cast("double").alias("_best"),
        F.lit(None).cast(kind).alias("_best_id"),
        (F.lit(None) if own is None else own).cast(name).alias("_own"),
        F.lit(None).cast("double").alias("_own_value"),
        F.lit(None).cast("long").alias("_own_size"),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
    out, passes = rows, 0
    for block in _blocks(centres, kind, block_bytes):
        if passes:
            out = materialise(out, "nearest")
        shared = df.sparkSession.sparkContext.broadcast(block)  # at most ``block_bytes`` of centres
        out = with_package(out).mapInArrow(_compare(shared), schema)
        passes += 1
    return out, _INNER
