"""Repeated byte strings by column-wise construction over many segments.

The collection is the bytes around every anchor that occurs more than once.  It is inserted column by column,
from the right: each round takes one symbol of every segment, sorts the segments stably by it, and so has the
column of the collection's Burrows-Wheeler transform (the symbols in suffix order) and, from range minima over
the last round's values, the common prefixes of neighbours.  A round needs the columns of the round before and
nothing else.  Anchors align the segments, so a string that occurs twice stands in the same column of both: it is
found when neighbours in that round share at least the wanted length.

A crowded anchor is dealt to several tasks; windows found once in a task are then compared across tasks by
128-bit hashes, which settles them exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscape.llm import repeats, rolling
from tallyscape.llm.common import on_workers
from tallyscape.llm.groups import runs

WINDOW = 400  # bytes
SYMBOLS = repeats.Symbols(by_word=False, window=WINDOW, gram=64)
REACH, GRAM = SYMBOLS.reach, SYMBOLS.gram
WIDTH = 2 * REACH + GRAM
CROWD = 4096  # segments of an anchor that meet in one task: 3 MB
STEP = 16  # neighbouring windows that are handed on together
BATCH = 8192  # segments whose columns are inserted together


def shared_windows(
    segments: np.ndarray, left: np.ndarray, right: np.ndarray, group: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(m, REACH + 1) flags: [i, l] if the window that starts l bytes before the anchor of segment i occurs in
    another segment of its group.  And flags of the same shape for all but the first such segment in suffix order.

    ``segments`` is (m, WIDTH) bytes with the anchor at REACH; ``left`` and ``right`` say how many bytes before and
    behind the anchor belong to the text.  ``group`` is sorted.
    """
    m = len(segments)
    order = np.arange(m)
    common = np.zeros(m + 1, np.int32)  # [t]: common prefix of the segments ranked t - 1 and t
    flags, later = np.zeros((m, REACH + 1), bool), np.zeros((m, REACH + 1), bool)
    base = (np.cumsum(np.concatenate([[0], group[1:] != group[:-1]])) * 257).astype(np.int64)

    def insert(column: int) -> None:
        nonlocal order, common
        there = (column >= REACH - left) & (column < REACH + GRAM + right)
        symbol = np.where(there, segments[:, column].astype(np.int64), -1)[order]  # the column of the transform
        key = base[order] + symbol + 1
        if (key[1:] >= key[:-1]).all():
            rank = np.arange(m)
        else:
            rank = np.argsort(key, kind="stable")
        key, symbol = key[rank], symbol[rank]
        same = (key[1:] == key[:-1]) & (symbol[1:] >= 0)
        new = np.zeros(m + 1, np.int32)
        if same.any():
            a, b = rank[:-1][same] + 1, rank[1:][same] + 1
            pairs = np.empty(2 * len(a), np.int64)
            pairs[::2], pairs[1::2] = a, b
            if b[-1] > m:
                pairs[-1] = m
            least = np.minimum.reduceat(np.append(common, 0), pairs)[::2]
            new[1:m][same] = least + 1
        order, common = order[rank], new

    def look(back: int) -> None:
        full = common >= WINDOW
        flags[order, back] = full[:-1] | full[1:]
        later[order, back] = full[:-1]

    for column in range(WIDTH - 1, REACH + GRAM - 1, -1):
        insert(column)
    within = np.zeros(m + 1, bool)
    within[1:m] = group[1:] == group[:-1]
    common[within] += GRAM  # the anchor itself, equal in a group, changes no rank
    look(0)
    for back in range(1, REACH + 1):
        insert(REACH - back)
        look(back)
    return flags, later


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates to the bytes around their anchors; equal segments of one text are settled here."""
    for digest, _, data, _, at, anchors, _, _ in repeats.read_candidates(batches, SYMBOLS):
        n, k = len(data), len(at)
        if not k:
            continue
        for first in range(0, k, 4096):
            some = slice(first, first + 4096)
            place, anchor = at[some], anchors[some]
            index = place[:, None] + np.arange(-REACH, GRAM + REACH)
            inside = (index >= 0) & (index < n)
            around = np.where(inside, data[np.clip(index, 0, n - 1)], 0).astype(np.uint8)
            left, right = np.minimum(place, REACH), np.minimum(n - place - GRAM, REACH)
            raw = [x.tobytes() for x in around]
            seen: dict[tuple, list[int]] = {}
            for i in range(len(place)):
                seen.setdefault((raw[i], int(left[i]), int(right[i])), []).append(i)
            keep = [v[0] for v in seen.values()]
            again = [i for v in seen.values() if len(v) > 1 and left[v[0]] + GRAM + right[v[0]] >= WINDOW for i in v]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digest] * (len(keep) + len(again)), pa.binary()),
                    pa.array([*anchor[keep].tolist(), *[None] * len(again)], pa.int64()),
                    pa.array([*place[keep].tolist(), *(place[again] - left[again]).tolist()], pa.int64()),
                    pa.array([*[None] * len(keep), *(place[again] + GRAM + right[again]).tolist()], pa.int64()),
                    pa.array([*left[keep].tolist(), *[None] * len(again)], pa.int32()),
                    pa.array([*right[keep].tolist(), *[None] * len(again)], pa.int32()),
                    pa.array([*[raw[i] for i in keep], *[None] * len(again)], pa.binary()),
                ],
                ["digest", "anchor", "start", "end", "left", "right", "bytes"],
            )


def _compare(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Groups of segments to runs that occur again, and for dealt anchors each different window once."""
    held: list[pa.Table] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        group = np.repeat(np.arange(len(held)), [t.num_rows for t in held])
        rows = pa.concat_tables(held).combine_chunks()
        held.clear()
        raw = rows.column("bytes").to_pylist()
        segments = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, WIDTH)
        left, right, start = (rows.column(c).to_numpy().astype(np.int64) for c in ("left", "right", "start"))
        flags, later = shared_windows(segments, left, right, group)
        step = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        at, low = np.nonzero(step == 1)
        _, high = np.nonzero(step == -1)
        digests = rows.column("digest").to_pylist()
        out = [
            (digests[i], int(start[i] - b + 1), int(start[i] - a + WINDOW), *[None] * 5)
            for i, a, b in zip(at.tolist(), low.tolist(), high.tolist(), strict=True)
        ]
        tiles = rows.column("tile").to_pylist()
        for i in np.flatnonzero(rows.column("crowd").to_numpy() > most).tolist():
            first = REACH - left[i]
            values = rolling.VALUES[segments[i, first : REACH + GRAM + right[i]]]
            h1, h2 = (rolling.grams(values, WINDOW, b).view(np.int64) for b in rolling.BASES)
            back = left[i] - np.arange(len(h1))  # window j starts so many bytes before the anchor
            mine = np.flatnonzero(back >= 0)
            mine = mine[~later[i, back[mine]]]
            if not len(mine):
                continue
            sums, step = rolling.running(values), back[mine] // STEP
            begin = left[i] - step * STEP
            end = left[i] - np.minimum(step * STEP + STEP - 1, REACH) + WINDOW
            core = (rolling.ranges(sums, begin, end) + step.astype(np.uint64)).view(np.int64)
            for part in np.split(np.arange(len(mine)), np.flatnonzero(np.diff(step)) + 1):
                at = mine[part]
                starts = (start[i] - back[at]).tolist()
                out.append((digests[i], None, None, tiles[i], int(core[part[0]]), starts, h1[at].tolist(), h2[at].tolist()))
        if out:
            kinds = (pa.binary(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                ["digest", "start", "end", "tile", "core", "starts", "h1s", "h2s"],
            )

    size = 0
    for rows in runs(batches, "tile"):
        if rows.num_rows < 2 and rows.column("crowd")[0].as_py() <= most:
            continue
        held.append(rows)
        size += rows.num_rows
        if size >= BATCH:
            yield from flush()
            size = 0
    yield from flush()


def deal(segments: DataFrame, crowd: int) -> DataFrame:
    """``segments`` with the tile that compares them, and for anchors dealt to several tiles ``crowd``, their segments, else 0.

    Segments of a crowd are dealt by their places, so that a text that holds an anchor many times is dealt too.
    """
    sizes = segments.groupBy("anchor").agg(F.count("*").alias("crowd")).filter(F.col("crowd") > crowd)
    sized = segments.join(F.broadcast(sizes), "anchor", "left")  # a row for more than ``crowd`` segments
    chunk = F.coalesce(F.pmod(F.xxhash64("digest", "start"), F.ceil(F.col("crowd") / crowd)), F.lit(0))
    return sized.withColumns({"tile": F.xxhash64("anchor", chunk), "crowd": F.coalesce("crowd", F.lit(0).cast("long"))})


def repeated_runs(texts: DataFrame, crowd: int = CROWD) -> DataFrame:
    """digest, start, end of bytes covered by strings that occur anywhere else."""
    made = on_workers(texts).mapInArrow(
        _segments,
        "digest binary, anchor long, start long, end long, left int, right int, bytes binary",
    )
    made = repeats.materialise(made, "segments")
    again = made.filter("anchor is null").select("digest", "start", "end")
    dealt = deal(made.filter("anchor is not null"), crowd)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "tile").sortWithinPartitions("tile")
    found = repeats.materialise(
        dealt.drop("anchor", "end").mapInArrow(
            partial(_compare, most=crowd), "digest binary, start long, end long, " + repeats.OPEN_COLUMNS
        ),
        "matches",
    )
    # A window with several anchors is handed on by each, so places are told apart, not rows.
    place = F.struct("digest", "start")
    open_ = repeats.materialise(repeats.open_windows(found, ["digest"]), "open")
    met = open_.groupBy("h1", "h2").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a < b").select("h1", "h2")
    settled = open_.join(met, ["h1", "h2"]).select("digest", "start", (F.col("start") + WINDOW).alias("end"))
    return again.unionByName(found.filter("core is null").select("digest", "start", "end")).unionByName(settled)


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: each document without bytes that recur in 400-byte strings.

    Texts are UTF-8 bytes, null ones empty.  All occurrences go, in whichever document, the same one included.
    Repeated rows are further occurrences.  An empty table gives no rows.
    """
    ids = repeats.Ids.of(docs, doc_id)
    signed = repeats.signatures(docs, ids, doc_id, text, SYMBOLS)
    classes = repeats.classes_of(signed)
    texts = repeats.candidates(docs, ids, doc_id, text, signed, classes, by_owner=False)
    done = repeats.remove(repeated_runs(texts, crowd), texts, SYMBOLS).select(
        "digest", F.col("n_removed").alias("gone"), "n_spans", F.col("sha").alias("new")
    )
    known = classes.select("digest", "copies").join(done, "digest", "left")
    rows = signed.select("id", "n", "digest", "sha").join(known, "digest")
    copy = (F.col("copies") > 1) & (F.col("n") >= WINDOW)
    kept = F.when(copy, F.unhex(F.sha2(F.lit(""), 256))).otherwise(F.coalesce("new", "sha"))
    zero = F.lit(0).cast("long")
    return rows.select(
        ids.shown("id").alias("doc_id"),
        F.col("n").alias("n_bytes"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("gone", zero)).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.lower(F.hex(kept)).alias("kept_sha256"),
    )
