"""Similarity join on word 5-grams: Jaccard of 0.8 or more.

Documents with equal gram sets are one class, and only classes are compared.  Classes meet in buckets by min-hash:
each of 24 keys holds three minima, so two sets of Jaccard 0.8 share a key with a probability of 1 - 3e-8.
Buckets are compared in tiles of bounded size.  A crowded bucket is dealt by bands of set size, such that similar sets
stand in one band or in neighbouring ones, and only such bands meet in tiles.  A set's hashed bitmap gives an upper bound of each overlap: grams of one set whose
bits the other lacks cannot be common.  Pairs that pass are decided by intersecting the sorted arrays, unless
links already found join them.

First every class is compared with the smallest class of its buckets (and those that come to the same one), which
finds most links; then the buckets whose classes are still not all joined are compared in full.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscape.llm import rolling
from tallyscape.llm.buffers import slices
from tallyscape.llm.common import on_workers
from tallyscape.llm.graph import components
from tallyscape.llm.groups import runs
from tallyscape.llm.repeats import Ids
from tallyscape.session import materialise

N = 5  # words in a gram
PERCENT = 80
KEYS, MINIMA = 24, 3
TILE = 256  # classes on one side of a tile
BAND = 1.26  # ratio of sizes in a band: over 100 / PERCENT, so similar sets are at most one band apart
_ODD = np.random.default_rng(99).integers(0, 2**63, KEYS * MINIMA, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def gram_sets(offsets: np.ndarray, data: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the grams of each text, and the first of each text (with a last entry for the end).

    A text with fewer words has its whole sequence as one gram, one without words none.
    """
    low = rolling.LOWER[data]
    start, end, bounds = rolling.words(offsets, low)
    values = rolling.word_hashes(low, start, end)
    sums = rolling.running(values)
    count = np.diff(bounds)
    grams = np.where(count == 0, 0, np.maximum(count - n + 1, 1))
    first = np.concatenate([[0], np.cumsum(grams)])
    begin = np.arange(first[-1]) + np.repeat(bounds[:-1] - first[:-1], grams)
    return rolling.ranges(sums, begin, begin + np.repeat(np.minimum(count, n), grams)), first


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, offsets, data in slices(batch.column(1), 1 << 20):
            hashes, first = gram_sets(offsets, data)
            filled = np.flatnonzero(np.diff(first))
            keys = np.zeros((len(filled), KEYS), np.uint64)
            if len(filled):
                least = np.array([np.minimum.reduceat(hashes * odd, first[filled]) for odd in _ODD])
                for k in range(KEYS):
                    h = np.full(len(filled), k, np.uint64)
                    for m in range(MINIMA):
                        h = rolling.mix(h * np.uint64(31) + least[k * MINIMA + m])
                    keys[:, k] = h
            sizes, digests = [], []
            for t in range(len(offsets) - 1):
                own = np.unique(hashes[first[t] : first[t + 1]])
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            at = np.zeros(len(offsets), np.int32)
            at[1:] = np.cumsum(np.diff(first) > 0) * KEYS
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(row, len(offsets) - 1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(keys.ravel().view(np.int64))),
                ],
                ["id", "n", "digest", "keys"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rep, digest, text to rep, digest, grams: sorted hashes of texts whose digest is the class's."""
    for batch in batches:
        for row, offsets, data in slices(batch.column(2), 1 << 20):
            hashes, first = gram_sets(offsets, data)
            ids, digests, sets = [], [], []
            for t in range(len(offsets) - 1):
                own = np.unique(hashes[first[t] : first[t + 1]])
                digest = batch.column(1)[row + t].as_py()
                if hashlib.blake2b(own.tobytes(), digest_size=16).digest() == digest:
                    ids.append(batch.column(0)[row + t].as_py())
                    digests.append(digest)
                    sets.append(own.tobytes())
            columns = [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "digest", "grams"])


def overlap_bounds(sets: list[np.ndarray]) -> np.ndarray:
    """Upper bounds of the overlaps of all pairs, from bitmaps."""
    size = np.array([len(s) for s in sets])
    width = 1 << int(np.clip(np.ceil(np.log2(4 * np.median(size))), 9, 13))
    bits = np.zeros((len(sets), width), np.float32)
    for i, s in enumerate(sets):
        bits[i, (s & np.uint64(width - 1)).astype(np.int64)] = 1
    both = np.rint(bits @ bits.T).astype(np.int64)
    own = np.diag(both)
    left = size[:, None] - (own[:, None] - both)  # grams whose bits the other set lacks are not common
    return np.minimum(left, left.T)


def similar(common, a, b):
    return 100 * common >= PERCENT * (a + b - common)


def links_of(ids: np.ndarray, sets: list[np.ndarray], group: np.ndarray, sides: tuple[np.ndarray, np.ndarray] | None = None):
    """Links that join what is similar and not joined yet; ``group`` holds what is already joined."""
    size = np.array([len(s) for s in sets])
    bound = overlap_bounds(sets)
    fits = similar(bound, size[:, None], size[None, :])
    if sides is not None:
        fits &= sides[0][:, None] & sides[1][None, :]
        fits |= fits.T
    i, j = np.nonzero(np.triu(fits, 1))
    order = np.argsort(-bound[i, j] / size[i], kind="stable")
    label = np.unique(group, return_inverse=True)[1]
    for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True):
        if label[a] == label[b]:
            continue
        x, y = (a, b) if len(sets[a]) <= len(sets[b]) else (b, a)
        at = np.searchsorted(sets[y], sets[x])
        at[at == len(sets[y])] = 0
        if similar(int((sets[y][at] == sets[x]).sum()), size[a], size[b]):
            label[label == label[b]] = label[a]
            yield int(ids[a]), int(ids[b])


def _tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in runs(batches, "tile"):
        if rows.num_rows < 2:
            continue
        ids, group, side, low, high = (rows.column(c).to_numpy() for c in ("rep", "joined", "chunk", "low", "high"))
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("grams").to_pylist()]
        found = list(links_of(ids, sets, group, (side == low, side == high)))
        if found:
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _compare(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """Links found in tiles; rows hold tile, rep, joined, chunk, low, high."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = rows.join(grams, "rep").repartition(parts, "tile").sortWithinPartitions("tile", "rep")
    columns = ["tile", "rep", "joined", "chunk", "low", "high", "grams"]
    return materialise(on_workers(held.select(columns)).mapInArrow(_tile, "a long, b long"), "links")


def _stars(met: DataFrame, grams: DataFrame) -> DataFrame:
    """Every class with the smallest class of its buckets, in tiles of those that come to the same one."""
    least = met.groupBy("bucket").agg(F.min("rep").alias("centre"))
    pairs = met.join(least, "bucket").groupBy("rep").agg(F.min("centre").alias("centre")).filter("rep > centre")
    pairs = materialise(pairs, "stars")
    crowds = pairs.groupBy("centre").agg(F.ceil(F.count("*") / TILE).cast("int").alias("chunks"))
    part = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    members = pairs.join(crowds, "centre").select("centre", "rep", part.alias("part"))
    centres = crowds.select("centre", F.col("centre").alias("rep"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("part"))
    zero = F.lit(0)
    rows = members.unionByName(centres).select(
        F.xxhash64("centre", "part").alias("tile"), "rep", F.col("rep").alias("joined"),
        zero.alias("chunk"), zero.alias("low"), zero.alias("high"),
    )
    return _compare(rows, grams)


def _rest(met: DataFrame, joined: DataFrame, grams: DataFrame) -> DataFrame:
    """Buckets whose classes are not all joined, in full: each band with itself and with the one above."""
    known = met.join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn("joined", F.coalesce("component", "rep"))
    known = materialise(known.select("bucket", "size", "rep", "joined"), "known")
    mixed = known.groupBy("bucket").agg(F.count("*").alias("n"), F.min("joined").alias("x"), F.max("joined").alias("y"))
    mixed = mixed.filter("x < y").select("bucket", "n")
    # What fits in one tile needs no bands.
    band = F.when(F.col("n") > TILE, F.floor(F.log("size") / F.log(F.lit(BAND)))).otherwise(0).cast("int")
    rows = known.join(mixed, "bucket").select("bucket", "rep", "joined", band.alias("band"))
    cells = rows.groupBy("bucket", "band").agg(F.ceil(F.count("*") / TILE).cast("int").alias("chunks"))
    cells = materialise(cells, "cells")
    rows = rows.join(cells, ["bucket", "band"])
    rows = rows.withColumn("own", F.pmod(F.xxhash64(F.lit(1), "rep"), F.col("chunks")).cast("int")).drop("chunks")

    def meeting(step: int, chunk: Column, low: Column, high: Column) -> DataFrame:
        """Rows with each chunk (``other``) of the band ``step`` above; a tile is named by its lower band."""
        there = cells.select("bucket", (F.col("band") - step).alias("band"), F.sequence(F.lit(0), F.col("chunks") - 1).alias("all"))
        pairs = rows.join(there, ["bucket", "band"]).withColumn("other", F.explode("all"))
        pairs = pairs.withColumns({"chunk": chunk, "low": low, "high": high, "lower": F.col("band") + min(step, 0)})
        tile = F.xxhash64("bucket", "lower", "low", "high")
        return pairs.select(tile.alias("tile"), "rep", "joined", "chunk", "low", "high")

    own, other = F.col("own"), F.col("other")
    met_all = meeting(0, own, F.least(own, other), F.greatest(own, other))
    # Chunks of the upper band count down from -1, so the two sides of a tile differ.
    met_all = met_all.unionByName(meeting(1, own, own, -1 - other)).unionByName(meeting(-1, -1 - own, other, -1 - own))
    return _compare(met_all, grams)


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: every document with the smallest id it reaches by links.

    A-Z are lower-cased; words are runs of anything but white space.  Null and empty texts, and those of white
    space, have no grams and link with nothing.  Repeated rows link with each other.  A null id counts as larger
    than all others; a group of null ids alone has a null component.  An empty table gives no rows.
    """
    ids = Ids.of(docs, doc_id)
    rows = docs.select(ids.hidden(doc_id, text).alias("id"), F.col(text).alias("text"))
    signed = materialise(
        on_workers(rows).mapInArrow(_signed, "id long, n long, digest binary, keys array<long>"), "signed"
    )
    filled = signed.filter("n > 0")
    classes = materialise(
        filled.groupBy("digest").agg(F.min("id").alias("rep"), F.first("n").alias("size"), F.first("keys").alias("keys")),
        "classes",
    )
    keyed = classes.select("rep", "size", F.explode("keys").alias("bucket"))
    crowded = keyed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    met = materialise(keyed.join(crowded, "bucket"), "buckets")
    wanted = met.select("rep").distinct().join(classes.select("rep", "digest"), "rep")
    texts = rows.select(F.col("id").alias("rep"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(wanted.hint("shuffle_hash"), "rep").select("rep", "digest", "text")
    grams = materialise(texts.mapInArrow(_sets, "rep long, digest binary, grams binary").dropDuplicates(["rep", "digest"]), "grams")
    first = _stars(met, grams)
    second = _rest(met, components(first), grams)
    joined = components(first.unionByName(second)).withColumnRenamed("node", "rep")
    known = classes.select("digest", "rep").join(joined, "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component")
    )
    alone = signed.filter("n = 0").select("id", "n", F.col("id").alias("component"))
    both = filled.select("id", "n", "digest").join(known, "digest").select("id", "n", "component").unionByName(alone)
    return both.select(
        ids.shown("id").alias("doc_id"), F.col("n").alias("n_shingles"), ids.shown("component").alias("component_id")
    )


def drop_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, all columns as they were; null ids stay."""
    kept = similar_groups(docs, doc_id, text).filter("doc_id = component_id").select(F.col("doc_id").alias("_id")).distinct()
    stay = docs.join(kept.hint("shuffle_hash"), docs[doc_id] == kept["_id"], "left_semi")
    return stay.unionByName(docs.filter(F.col(doc_id).isNull()))
