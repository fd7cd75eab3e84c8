"""Finding text that occurs more than once, without moving every window of every text.

Step 1, where texts are read: a text's digest, its symbol count and its anchors (short runs chosen by content,
such that equal windows choose equal anchors).  Step 2, small rows only: texts equal as a whole become one class;
anchors that occur once in the corpus are dropped.  Step 3: the texts of classes that hold other anchors, the
candidates, go on to the operator that compares them exactly.  Everything is over all texts, whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscape.llm import rolling
from tallyscape.llm.buffers import slices
from tallyscape.llm.common import on_workers
from tallyscape.llm.spans import covered, runs_of
from tallyscape.session import materialise


@dataclass(frozen=True)
class Ids:
    """Ids of the whole long range, and above the largest of them numbers for rows without one.

    Where rows without id would find no room, all ids move down by ``shift``; ``shown`` gives them back as they were.
    Only a table with null ids that holds both ends of the long range has no room left: its largest id is then shown
    as null.
    """

    shift: int = 0
    top: int = 2**63 - 1  # the largest known id, after the shift

    @classmethod
    def of(cls, docs: DataFrame, doc_id: str) -> Ids:
        known = F.col(doc_id).cast("long")
        low, high, unknown = docs.agg(F.min(known), F.max(known), F.count_if(known.isNull())).first()
        if not unknown:
            return cls()
        if high is None:
            return cls(top=0)
        shift = 0 if high < 1 << 62 else min(low + 2**63, 2**63 - 1)
        return cls(shift, min(high - shift, 2**63 - 2))

    def hidden(self, doc_id: str, text: str) -> Column:
        """The id, moved; for a null one a number above all ids that depends on the text alone."""
        room = min(2**63 - 1 - self.top, 1 << 62)
        drawn = F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(room))
        beyond = F.lit(min(self.top + 1, 2**63 - 1)) + drawn
        known = F.col(doc_id).cast("long")
        return F.when(known.isNull(), beyond).otherwise(known - F.lit(self.shift))

    def shown(self, name: str) -> Column:
        return F.when(F.col(name) <= F.lit(self.top), F.col(name) + F.lit(self.shift))


@dataclass(frozen=True)
class Symbols:
    """What windows are made of."""

    by_word: bool
    window: int  # symbols in a window
    gram: int  # symbols in an anchor

    @property
    def reach(self) -> int:
        """Symbols before or after an anchor that a window with it can hold."""
        return self.window - self.gram

    def read(self, offsets: np.ndarray, data: np.ndarray):
        """(values, first symbol of each text, start and end byte of each symbol)."""
        if self.by_word:
            start, end, bounds = rolling.words(offsets, data)
            return rolling.word_hashes(data, start, end), bounds, start, end
        at = np.arange(len(data))
        return rolling.VALUES[data], offsets, at, at + 1


def whole_text(symbols: Symbols, data: np.ndarray, start: np.ndarray, end: np.ndarray, keep: np.ndarray | None = None) -> bytes:
    """The kept symbols: words joined by one space, or bytes."""
    if not symbols.by_word:
        return data.tobytes() if keep is None else data[keep].tobytes()
    if keep is not None:
        start, end = start[keep], end[keep]
    if not len(start):
        return b""
    # Bytes of words are copied together with the byte behind each, which then becomes the space.
    sizes = end - start + 1
    ends = np.cumsum(sizes)
    index = np.arange(int(ends[-1])) + np.repeat(start - (ends - sizes), sizes)
    out = np.append(data, np.uint8(32))[np.minimum(index, len(data))]
    out[ends - 1] = 32
    return out[:-1].tobytes()


def signatures(docs: DataFrame, ids: Ids, doc_id: str, text: str, symbols: Symbols) -> DataFrame:
    """id, n, digest (of the symbols), sha (of the whole text as kept), anchors, twice (anchors met twice)."""
    rows = docs.select(ids.hidden(doc_id, text).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, data in slices(batch.column(1)):
                values, bounds, start, end = symbols.read(offsets, data)
                texts, _, found = rolling.anchors(values, bounds, symbols.gram, symbols.window)
                cut = np.searchsorted(texts, np.arange(len(offsets)))
                digests, shas, once, twice = [], [], [], []
                for t in range(len(offsets) - 1):
                    a, b = bounds[t], bounds[t + 1]
                    held = whole_text(symbols, data[offsets[t] : offsets[t + 1]], start[a:b] - offsets[t], end[a:b] - offsets[t])
                    sha = hashlib.sha256(held).digest()
                    shas.append(sha)
                    digests.append(sha[:16])
                    own, count = np.unique(found[cut[t] : cut[t + 1]].view(np.int64), return_counts=True)
                    once.append(own)
                    twice.append(own[count > 1])
                rows = len(offsets) - 1
                lists = [
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum([len(x) for x in part])]).astype(np.int32)),
                        pa.array(np.concatenate(part)),
                    )
                    for part in (once, twice)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows),
                        pa.array(np.diff(bounds)),
                        pa.array(digests, pa.binary()),
                        pa.array(shas, pa.binary()),
                        *lists,
                    ],
                    ["id", "n", "digest", "sha", "anchors", "twice"],
                )

    schema = "id long, n long, digest binary, sha binary, anchors array<long>, twice array<long>"
    return materialise(on_workers(rows).mapInArrow(run, schema), "signatures")


def classes_of(signed: DataFrame) -> DataFrame:
    """digest, first_id, copies, n, sha: one row per different text."""
    grouped = signed.groupBy("digest").agg(
        F.min("id").alias("first_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sha").alias("sha")
    )
    return materialise(grouped, "classes")


def candidates(
    docs: DataFrame, ids: Ids, doc_id: str, text: str, signed: DataFrame, classes: DataFrame, *, by_owner: bool
) -> DataFrame:
    """digest, first_id, copies, text, shared (anchor, place, crowd): classes with anchors that occur elsewhere too.

    ``place`` names where an anchor's texts are compared: the anchor itself, or its owner, the smallest first_id
    that has it.  ``crowd`` is how many classes come to that place.
    """
    firsts = signed.join(classes.select("digest", "first_id", "copies"), "digest").filter("id = first_id")
    one = firsts.groupBy("digest").agg(  # rows repeated with one id are one
        *[F.first(c).alias(c) for c in ("first_id", "copies", "anchors", "twice")]
    )
    rows = one.filter("size(anchors) > 0").select("digest", "first_id", F.explode("anchors").alias("anchor"), "twice")
    more = F.array_contains("twice", F.col("anchor")).cast("int")
    rows = materialise(rows.select("digest", "first_id", "anchor", more.alias("more")), "anchors")
    shared = rows.groupBy("anchor").agg(
        F.min("first_id").alias("owner"), F.sum(F.col("more") + 1).alias("met"), F.count("*").alias("crowd")
    )
    shared = shared.filter("met > 1").drop("met")
    met = rows.join(shared, "anchor")
    if by_owner:
        met = materialise(met.select("digest", "first_id", "anchor", F.col("owner").alias("place")), "shared")
        crowd = met.groupBy("place", "digest").agg(F.lit(1).alias("one")).groupBy("place").agg(F.count("*").alias("crowd"))
        met = met.join(materialise(crowd, "crowds"), "place")
    else:
        met = met.withColumn("place", F.col("anchor"))
    held = met.groupBy("digest").agg(
        F.first("first_id").alias("first_id"), F.collect_list(F.struct("anchor", "place", "crowd")).alias("shared")
    )
    held = held.join(classes.select("digest", "copies"), "digest")
    wanted = held.select("first_id", "digest", "copies", "shared")
    texts = docs.select(ids.hidden(doc_id, text).alias("first_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The small side is hashed, so the texts need no sort.
    return materialise(texts.join(wanted.hint("shuffle_hash"), "first_id"), "candidates")


def read_candidates(batches: Iterator[pa.RecordBatch], symbols: Symbols):
    """(digest, first_id, bytes, values, positions, anchors, places, crowds) of every candidate's shared anchors."""
    for batch in batches:
        columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for first, offsets, data in slices(columns["text"]):
            for t in range(len(offsets) - 1):
                own = data[offsets[t] : offsets[t + 1]]
                values, bounds, start, end = symbols.read(np.array([0, len(own)]), own)
                digest = columns["digest"][first + t].as_py()
                if hashlib.sha256(whole_text(symbols, own, start, end)).digest()[:16] != digest:
                    continue  # another text with the same id
                shared = columns["shared"][first + t].values
                known, place, crowd = (shared.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                order = np.argsort(known)
                _, at, found = rolling.anchors(values, bounds, symbols.gram, symbols.window)
                found = found.view(np.int64)
                near = np.minimum(np.searchsorted(known, found, sorter=order), len(known) - 1)
                hit = known[order[near]] == found
                pick = order[near[hit]]
                yield digest, columns["first_id"][first + t].as_py(), own, values, at[hit], known[pick], place[pick], crowd[pick]


def open_windows(found: DataFrame, keep: list[str]) -> DataFrame:
    """The windows, with their hashes h1 and h2, that may occur in more than one task.

    A task hands on what it found once as classes of neighbouring windows, cut at places that the text itself
    determines.  All windows of a class hold its core; a core that one task alone has rules them out together.
    """
    classes = found.filter("core is not null")
    met = classes.groupBy("core").agg(F.min("tile").alias("a"), F.max("tile").alias("b")).filter("a < b").select("core")
    each = F.explode(F.arrays_zip("starts", "h1s", "h2s")).alias("w")
    left = classes.join(materialise(met, "cores"), "core").select(*keep, each)
    return left.select(*keep, F.col("w.starts").alias("start"), F.col("w.h1s").alias("h1"), F.col("w.h2s").alias("h2"))


#: Columns in which a task hands on runs, or (with a core) classes of open windows.
OPEN_COLUMNS = "tile long, core long, starts array<long>, h1s array<long>, h2s array<long>"


def remove(found: DataFrame, texts: DataFrame, symbols: Symbols) -> DataFrame:
    """digest, n_removed, n_spans, sha: candidates without what the runs (digest, start, end) cover."""
    runs = found.groupBy("digest").agg(
        F.collect_list(F.struct(F.col("start").cast("int"), F.col("end").cast("int"))).alias("runs")
    )
    rows = texts.select("digest", "text").join(runs.hint("shuffle_hash"), "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, removed, spans, shas = [], [], [], []
            runs = batch.column(2)
            for first, offsets, data in slices(batch.column(1)):
                for t in range(len(offsets) - 1):
                    own = data[offsets[t] : offsets[t + 1]]
                    _, bounds, start, end = symbols.read(np.array([0, len(own)]), own)
                    digest = batch.column(0)[first + t].as_py()
                    if hashlib.sha256(whole_text(symbols, own, start, end)).digest()[:16] != digest:
                        continue
                    covers = runs[first + t].values
                    gone = covered(len(start), covers.field(0).to_numpy(), covers.field(1).to_numpy())
                    digests.append(digest)
                    removed.append(int(gone.sum()))
                    spans.append(len(runs_of(gone)[0]))
                    shas.append(hashlib.sha256(whole_text(symbols, own, start, end, ~gone)).digest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(shas, pa.binary())],
                ["digest", "n_removed", "n_spans", "sha"],
            )

    done = on_workers(rows).mapInArrow(run, "digest binary, n_removed long, n_spans long, sha binary")
    return done.dropDuplicates(["digest"])
