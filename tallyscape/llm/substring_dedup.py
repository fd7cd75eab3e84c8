"""Substring dedup by suffix automata.

Documents that share anchors with an earlier one meet at that one, its owner: the reference shard.  The
words around those anchors are streamed through a suffix automaton of all that smaller ids brought to the shard;
the matching statistic of a word is the length of the longest match that ends there, and where it reaches the
threshold the words of the match go.  What is new is then added to the automaton, so it grows with distinct
text, not with copies.

A crowded shard is dealt to several tasks.  Windows that no smaller id of the same task holds are then compared
across tasks by 128-bit hashes, which settles them exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscape.llm import repeats, rolling
from tallyscape.llm.common import on_workers
from tallyscape.llm.groups import runs
from tallyscape.llm.spans import covered, runs_of

WINDOW = 50  # words
SYMBOLS = repeats.Symbols(by_word=True, window=WINDOW, gram=16)
CROWD = 256  # classes that meet in one task
STEP = 8  # windows whose anchor lies within so many words are handed on together


class Automaton:
    """Suffix automaton of several sequences, built symbol by symbol."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]

    def _state(self, size: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """A copy of q for what is reached by the shorter contexts of p."""
        copy = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, symbols: Sequence[int]) -> None:
        last = 0
        for c in symbols:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.size[q] == self.size[last] + 1 else self._split(last, q, c)
                continue
            new = self._state(self.size[last] + 1, {}, 0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, c)
            last = new

    def lengths(self, symbols: Sequence[int]) -> list[int]:
        """Matching statistics: for each symbol the longest match that ends with it."""
        out, state, length = [], 0, 0
        for c in symbols:
            to = self.next[state].get(c)
            while to is None and state:
                state = self.link[state]
                length = self.size[state]
                to = self.next[state].get(c)
            if to is not None:
                state, length = to, length + 1
            out.append(length)
        return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates to the words around their anchors, one row per shard and unbroken stretch."""
    for digest, first_id, _, values, at, _, places, crowds in repeats.read_candidates(batches, SYMBOLS):
        rows: list[tuple] = []
        for place in np.unique(places):
            mine = places == place
            n = len(values)
            near = covered(
                n, np.maximum(at[mine] - SYMBOLS.reach, 0), np.minimum(at[mine] + SYMBOLS.gram + SYMBOLS.reach, n)
            )
            rows += [
                (int(place), int(crowds[mine][0]), int(a), values[a:b].astype("<u8").tobytes())
                for a, b in zip(*runs_of(near), strict=True)
            ]
        if rows:
            place, crowd, start, words = zip(*rows, strict=True)
            k = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digest] * k, pa.binary()), pa.array([first_id] * k, pa.int64()), pa.array(place, pa.int64()),
                    pa.array(crowd, pa.int64()), pa.array(start, pa.int64()), pa.array(words, pa.binary()),
                ],
                ["digest", "first_id", "place", "crowd", "start", "words"],
            )


def _classes(values: np.ndarray, windows: np.ndarray) -> Iterator[tuple[int, list[int], list[int], list[int]]]:
    """(core, starts, h1, h2) of windows that choose one anchor and hold it at nearly the same place."""
    sums = rolling.running(values)
    anchor = rolling.window_minima(values, SYMBOLS.gram, WINDOW)[windows]
    step = (anchor - windows) // STEP
    begin = anchor - step * STEP
    end = anchor - np.minimum(step * STEP + STEP - 1, SYMBOLS.reach) + WINDOW
    core = (rolling.ranges(sums, begin, end) + step.astype(np.uint64)).view(np.int64)
    h1, h2 = (rolling.grams(values, WINDOW, b).view(np.int64)[windows] for b in rolling.BASES)
    for part in np.split(np.arange(len(windows)), np.flatnonzero(np.diff(core) != 0) + 1):
        yield int(core[part[0]]), windows[part].tolist(), h1[part].tolist(), h2[part].tolist()


def _match(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Shards to runs found in them, and in dealt shards the windows still open."""
    for rows in runs(batches, "tile"):
        dealt = rows.column("crowd")[0].as_py() > most
        tile = rows.column("tile")[0].as_py()
        automaton = Automaton()
        ids = rows.column("first_id").to_pylist()
        digests, starts = rows.column("digest").to_pylist(), rows.column("start").to_pylist()
        words = rows.column("words")
        out: list[tuple] = []
        for first_id, same in groupby(range(len(ids)), key=ids.__getitem__):
            fresh: list[list[int]] = []
            for i in same:
                values = np.frombuffer(words[i].as_py(), "<u8")
                sequence = values.tolist()
                if len(sequence) < WINDOW:
                    continue
                ends = np.array(automaton.lengths(sequence)) >= WINDOW
                hit = ends[WINDOW - 1 :]  # windows by their start
                for a, b in zip(*runs_of(hit), strict=True):
                    out.append((digests[i], first_id, starts[i] + a, starts[i] + b - 1 + WINDOW, *[None] * 5))
                for a, b in zip(*runs_of(~hit), strict=True):
                    fresh.append(sequence[a : b - 1 + WINDOW])
                if dealt and not hit.all():
                    for core, at, h1, h2 in _classes(values, np.flatnonzero(~hit)):
                        at = [starts[i] + a for a in at]
                        out.append((digests[i], first_id, None, None, tile, core, at, h1, h2))
            for sequence in fresh:
                automaton.add(sequence)
        if out:
            columns = zip(*out, strict=True)
            kinds = (pa.binary(), *[pa.int64()] * 5, *[pa.list_(pa.int64())] * 3)
            names = ["digest", "first_id", "start", "end", "tile", "core", "starts", "h1s", "h2s"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def repeated_runs(texts: DataFrame, crowd: int = CROWD) -> DataFrame:
    """digest, start, end of words covered by windows that a smaller id holds."""
    pieces = on_workers(texts).mapInArrow(
        _pieces, "digest binary, first_id long, place long, crowd long, start long, words binary"
    )
    chunk = F.when(F.col("crowd") > crowd, F.pmod(F.xxhash64("digest"), F.ceil(F.col("crowd") / crowd))).otherwise(0)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("tile", F.xxhash64("place", chunk)).repartition(parts, "tile")
    sorted_ = dealt.sortWithinPartitions("tile", "first_id", "digest", "start")
    found = repeats.materialise(
        sorted_.mapInArrow(
            partial(_match, most=crowd), "digest binary, first_id long, start long, end long, " + repeats.OPEN_COLUMNS
        ),
        "matches",
    )
    open_ = repeats.open_windows(found, ["digest", "first_id"])
    least = open_.groupBy("h1", "h2").agg(F.min("first_id").alias("least"))
    settled = open_.join(least, ["h1", "h2"]).filter("least < first_id")
    settled = settled.select("digest", "start", (F.col("start") + WINDOW).alias("end"))
    return found.filter("core is null").select("digest", "start", "end").unionByName(settled)


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: each document without words of windows that a smaller id holds.

    Words are runs of anything but white space, kept ones are joined by one space.  Null and empty texts have no
    words.  Documents with one id do not shorten each other; a null id counts as larger than all others.  An empty
    table gives no rows.
    """
    ids = repeats.Ids.of(docs, doc_id)
    signed = repeats.signatures(docs, ids, doc_id, text, SYMBOLS)
    classes = repeats.classes_of(signed)
    texts = repeats.candidates(docs, ids, doc_id, text, signed, classes, by_owner=True)
    done = repeats.remove(repeated_runs(texts, crowd), texts, SYMBOLS).select(
        "digest", F.col("n_removed").alias("gone"), F.col("sha").alias("new")
    )
    known = classes.select("digest", "first_id").join(done, "digest", "left")
    rows = signed.select("id", "n", "digest", "sha").join(known, "digest")
    copy = (F.col("id") > F.col("first_id")) & (F.col("n") >= WINDOW)  # all its windows are in the first copy
    kept = F.when(copy, F.unhex(F.sha2(F.lit(""), 256))).otherwise(F.coalesce("new", "sha"))
    return rows.select(
        ids.shown("id").alias("doc_id"),
        F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.lower(F.hex(kept)).alias("kept_sha256"),
    )
