"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is rotated at random and stored as the signs of its coordinates, with the inner product of
the vector and its code as correction factor.  Codes give two things.  Slices of their bits, longer and more of them
the more vectors there are, are the buckets in which vectors meet.  And <code of a, b> divided by a's factor is an unbiased estimate of <a, b>, with a
known error bound; pairs whose upper bound falls short of the threshold are done, the others are recomputed
exactly in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscape.llm.common import on_workers
from tallyscape.llm.graph import components
from tallyscape.llm.groups import lowest, runs
from tallyscape.session import materialise

THRESHOLD = 0.98
BITS, CROWD = 11, 512  # bits of a bucket up to so many vectors of a label; one more each time they double
MISSED = 4e-4  # probability that two vectors at the threshold share no bucket
SIGMAS = 4.0  # width of the confidence bound
TILE = 256  # vectors on one side of a tile
SEED = 11


@lru_cache
def rotations(dim: int, count: int, seed: int = SEED) -> np.ndarray:
    """(count, dim, dim) random orthogonal matrices."""
    rng = np.random.default_rng([seed, dim])
    out = []
    for _ in range(count):
        q, r = np.linalg.qr(rng.normal(size=(dim, dim)))
        out.append(q * np.sign(np.diag(r)))
    return np.array(out)


def shape(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Tables and bits of a table for labels of up to ``n`` vectors.

    Bits follow log2 of the vectors, so that what meets by chance in a bucket does not grow with them; tables
    follow the bits, so that a pair at the threshold meets as surely whatever their number.
    """
    bits = BITS + max(0, math.ceil(math.log2(max(n, 1) / CROWD)))
    alike = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(MISSED) / math.log1p(-alike)), bits


def encode(vectors: np.ndarray, tables: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signs (n, rotations, dim), correction factors (n, rotations) and bucket of each table (n, tables)."""
    n, dim = vectors.shape
    turned = np.einsum("rij,nj->nri", rotations(dim, -(-tables * bits // dim)), vectors)
    signs = turned > 0
    factors = np.abs(turned).sum(2) / np.sqrt(dim)
    slices = signs.reshape(n, -1)[:, : tables * bits].reshape(n, tables, bits)
    return signs, factors, slices @ (1 << np.arange(bits))


def upper_bounds(signs: np.ndarray, factors: np.ndarray, right: np.ndarray, sigmas: float = SIGMAS) -> np.ndarray:
    """Upper confidence bounds of all <left, right>, from the codes and factors of the left unit vectors."""
    dim = right.shape[1]
    turn = rotations(dim, factors.shape[1])
    total = np.zeros((len(signs), len(right)))
    for r in range(len(turn)):
        code = np.where(signs[:, r], 1.0, -1.0) / np.sqrt(dim) / factors[:, r : r + 1]
        total += code @ (turn[r] @ right.T)
    spread = np.sqrt(np.maximum(1 - factors**2, 0) / factors**2 / max(dim - 1, 1))
    width = sigmas * np.sqrt((spread**2).sum(1)) / len(turn)
    return total / len(turn) + width[:, None]


def _unit(raw: list[bytes]) -> np.ndarray:
    v = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    v = v / np.abs(v).max(1, keepdims=True)  # no overflow of squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _coded(tables: int, bits: int):
    """vec_id, label, embedding (doubles) to codes and buckets; unusable vectors have no dim."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield one(batch)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, labels, vectors = (batch.column(i) for i in range(3))
        rows = [None if v is None or None in v else np.array(v, np.float64) for v in vectors.to_pylist()]
        good = [
            i for i, v in enumerate(rows)
            if v is not None and len(v) and np.isfinite(v).all() and v.any() and labels[i].is_valid and ids[i].is_valid
        ]
        dims, raw, codes, factors, buckets = ([None] * len(rows) for _ in range(5))
        by_dim: dict[int, list[int]] = {}
        for i in good:
            by_dim.setdefault(len(rows[i]), []).append(i)
        for dim, some in by_dim.items():
            held = [(rows[i] + 0.0).tobytes() for i in some]  # + 0.0: one zero only
            signs, lengths, places = encode(_unit(held), tables, bits)
            packed = np.packbits(signs.reshape(len(some), -1), axis=1)
            for i, *own in zip(some, held, packed, lengths.astype("<f8"), places.astype("<i8"), strict=True):
                dims[i], raw[i] = dim, own[0]
                codes[i], factors[i], buckets[i] = (x.tobytes() for x in own[1:])
        binaries = [pa.array(x, pa.binary()) for x in (raw, codes, factors, buckets)]
        return pa.RecordBatch.from_arrays(
            [ids, labels, pa.array(dims, pa.int32()), *binaries],
            ["vec_id", "label", "dim", "vec", "code", "factors", "buckets"],
        )

    return run


def _tiles(threshold: float, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "tile"):
            if rows.num_rows < 2:
                continue
            t = rows.column("number")[0].as_py()
            ids, copies = rows.column("rep").to_numpy(), rows.column("copies").to_numpy()
            side, low, high = (rows.column(c).to_numpy() for c in ("chunk", "low", "high"))
            unit = _unit(rows.column("vec").to_pylist())
            places = np.frombuffer(b"".join(rows.column("buckets").to_pylist()), "<i8").reshape(len(ids), tables)
            a, b = np.flatnonzero(side == low), np.flatnonzero(side == high)
            if not len(a) or not len(b):
                continue
            factors = np.frombuffer(b"".join(rows.column("factors").to_pylist()), "<f8").reshape(len(ids), -1)
            packed = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
            dim = unit.shape[1]
            signs = np.unpackbits(packed, axis=1)[:, : factors.shape[1] * dim].reshape(len(ids), -1, dim)
            near = upper_bounds(signs[a], factors[a], unit[b]) >= threshold
            if low[0] == high[0]:
                near = np.triu(near | near.T, 1)
            i, j = np.nonzero(near)
            i, j = a[i], b[j]
            first = ~(places[i, :t] == places[j, :t]).any(1) if t else np.ones(len(i), bool)  # met in an earlier table
            i, j = i[first], j[first]
            hit = (unit[i] * unit[j]).sum(1) >= threshold
            i, j = i[hit], j[hit]
            if not len(i):
                continue
            linked = np.zeros((len(ids), len(ids)), bool)
            linked[i, j] = linked[j, i] = True
            more = linked @ copies
            label = lowest(linked)
            own = np.flatnonzero(linked.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[own]), pa.array(ids[label[own]]), pa.array(more[own].astype(np.int64))], ["a", "b", "links"]
            )

    return run


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    *,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector.

    Vectors are compared where labels are equal and lengths too.  Null, empty and zero vectors, those with null
    or non-finite components, and those without label or id link with nothing.  Equal vectors are compared once and
    counted as often as they occur.  A bucket with many vectors is cut into tiles of bounded size that meet in
    pairs; a tile returns counts and a few links, never its pairs.  ``kept`` is vec_id = component_id.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).alias("label"),
        F.col(embedding).cast("array<double>").alias("embedding"),
    )
    kind = rows.schema["label"].dataType.simpleString()
    most = rows.filter("label is not null").groupBy("label").count().agg(F.max("count")).first()[0] or 0
    tables, bits = shape(most, threshold)
    coded = materialise(
        on_workers(rows).mapInArrow(
            _coded(tables, bits), f"vec_id long, label {kind}, dim int, vec binary, code binary, factors binary, buckets binary"
        ),
        "codes",
    )
    usable = coded.filter("dim is not null").withColumn("same", F.sha2("vec", 256))
    classes = materialise(
        usable.groupBy("label", "same").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("dim").alias("dim"),
            *[F.first(c).alias(c) for c in ("vec", "code", "factors", "buckets")],
        ).withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    at = F.expr(f"transform(sequence(0, {tables - 1}), t -> substring(buckets, 8 * t + 1, 8))")
    # Buckets are met without the vectors; those go only where a bucket holds others too.
    met = classes.select("class", "rep", "label", "dim", F.posexplode(at).alias("number", "bucket")).withColumn(
        "place", F.xxhash64("label", "dim", "number", "bucket")
    )
    crowds = met.groupBy("place").agg(F.count("*").alias("n")).filter("n > 1")
    crowds = crowds.select("place", F.ceil(F.col("n") / TILE).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64(F.lit(1), "rep"), F.col("chunks")).cast("int")
    dealt = met.join(crowds, "place").withColumn("chunk", chunk)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    # Label, length and bucket decide; the hash only names the group.
    tile = F.xxhash64("place", "label", "dim", "number", "bucket", "low", "high")
    tiled = dealt.select(tile.alias("tile"), "number", "class", "chunk", "low", "high").join(
        classes.select("class", "rep", "copies", "vec", "code", "factors", "buckets"), "class"
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiled = tiled.repartition(parts, "tile").sortWithinPartitions("tile", "rep")
    found = materialise(tiled.mapInArrow(_tiles(threshold, tables), "a long, b long, links long"), "links")
    joined = components(found)
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    known = (
        classes.select("label", "same", "rep", "copies")
        .join(counts, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            F.col("label").alias("_label"), F.col("same").alias("_same"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    alone = coded.filter("dim is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    others = usable.join(known, (F.col("label") == F.col("_label")) & (F.col("same") == F.col("_same"))).select(
        "vec_id", "n_links", "component_id"
    )
    return others.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
