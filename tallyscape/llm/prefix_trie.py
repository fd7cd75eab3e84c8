"""Conversations as a trie of their prefixes, with totals over the subtree of every prefix.

Turns are put in order by range partitions, so a conversation of any length is split like any other rows.  The
name of a prefix is a polynomial of its turns modulo a prime of 255 bits; polynomials of neighbouring pieces
combine, so each piece is summed where it lies.  Grouping by name gives the distinct prefixes: the nodes.

Totals over subtrees need a node and all below it in one place.  A round takes the largest subtrees that
hold at most ``limit`` nodes, and leaves the nodes above them, whose subtrees are larger, to the next round.  Every
task builds node tables: a minimal perfect hash gives each name a slot, which is verified against the name that
stands there; counts are scattered into flat arrays by slot, and each depth, the deepest first, adds its
numbers to its parents' slots.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType
from pyspark.sql.window import Window

from tallyscape.llm.common import WORD, on_workers, whole
from tallyscape.llm.groups import runs
from tallyscape.session import materialise

EVERY, HEAD = 20, 4  # conversations that share a beginning, and turns (less one) they share at most
LIMIT = 1 << 16  # nodes of a subtree that is handled in one piece
TABLE = 1 << 16  # nodes of small subtrees that share a node table
PIECE = 1 << 16  # bytes of the lists of members that are hashed in pieces
_PRIME = (1 << 255) - 19
_BASE = int.from_bytes(hashlib.sha256(b"prefixes of conversations").digest(), "big") % _PRIME
ROOT = bytes(32)
_NOTHING = hashlib.sha256(b"").hexdigest()


def _number(name: bytes) -> int:
    return int.from_bytes(name, "big")


def _name(number: int) -> bytes:
    return number.to_bytes(32, "big")


# ---- turns in order -----------------------------------------------------------------------


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order to position, name of the prefix, within the part of a conversation that lies in this partition."""
    conv, position, total, power = None, 0, 0, 1
    for batch in batches:
        out: tuple[list, list] = ([], [])
        for c, turn in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if c != conv:
                conv, position, total, power = c, 0, 0, 1
            position += 1
            power = power * _BASE % _PRIME
            total = (total + _number(turn) * power) % _PRIME
            out[0].append(position)
            out[1].append(_name(total))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())],
            ["part", "conv_id", "turn_sha", "words", "position", "prefix"],
        )


@F.udf(BinaryType(), useArrow=True)
def _after(before: bytes | None, size: int | None, here: bytes, less: bytes | None, dropped: int) -> bytes:
    """Name of a sequence: ``size`` turns named ``before``, then ``here`` without its first ``dropped``, named ``less``."""
    number = _number(here) - (_number(less) if less else 0)
    moved = (size or 0) - dropped
    number = number * pow(_BASE, moved, _PRIME) + (_number(before) if before else 0)
    return _name(number % _PRIME)


@F.udf(BinaryType(), useArrow=True)
def _without_last(name: bytes, depth: int, turn: bytes) -> bytes:
    return _name((_number(name) - _number(turn) * pow(_BASE, depth, _PRIME)) % _PRIME)


def ordered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, position (from 1), prefix (the name of the turns so far), turn_sha, words, for every turn.

    Order: turn (null first), then role, then the SHA-256 of the text.  Null roles and texts count as empty; rows
    without conversation belong to none and are left out.  Turns of equal role and text have one name.
    """
    said = whole(text)
    rows = turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        whole(role).alias("role"),
        F.unhex(F.sha2(said, 256)).alias("text_sha"),
        F.regexp_count(said, F.lit(WORD)).cast("long").alias("words"),
    )
    order = ["conv_id", "turn", "role", "text_sha"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # the first byte of a hash is dropped, so that it stays below the prime
    name = F.substring(F.unhex(F.sha2(F.concat(F.col("text_sha"), F.encode("role", "utf-8")), 256)), 2, 31)
    parts = materialise(
        on_workers(placed.select(F.spark_partition_id().alias("part"), "conv_id", name.alias("turn_sha"), "words")).mapInArrow(
            _positions, "part int, conv_id long, turn_sha binary, words long, position long, prefix binary"
        ),
        "turns",
    )
    # Conversations that lie in more than one partition: at most two ends a partition.
    pieces = parts.groupBy("conv_id", "part").agg(
        F.max("position").alias("size"), F.max_by("prefix", "position").alias("name")
    )
    split = pieces.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1").select("conv_id")
    several = pieces.join(split, "conv_id")
    later = F.row_number().over(Window.partitionBy("conv_id").orderBy("part"))
    several = materialise(several.withColumn("no", later), "pieces")
    listed = several.orderBy("conv_id", "no").toLocalIterator()  # at most two rows a partition
    found, conv, offset, total = [], None, 0, 0
    for piece in listed:
        if piece.conv_id != conv:
            conv, offset, total = piece.conv_id, 0, 0
        found.append((piece.conv_id, piece.part, offset, bytearray(_name(total))))
        total = (total + _number(piece.name) * pow(_BASE, offset, _PRIME)) % _PRIME
        offset += piece.size
    if not found:
        return parts.drop("part")
    offsets = turns.sparkSession.createDataFrame(found, "conv_id long, part int, offset long, before binary")
    joined = parts.join(offsets, ["conv_id", "part"], "left")
    whole_prefix = F.when(F.col("offset") > 0, _after("before", "offset", "prefix", F.lit(None), F.lit(0))).otherwise(F.col("prefix"))
    return materialise(
        joined.select(
            "conv_id", "turn_sha", "words", (F.col("position") + F.coalesce("offset", F.lit(0))).alias("position"), whole_prefix.alias("prefix")
        ),
        "turns",
    )


def rebuilt(turns: DataFrame, *, every: int = EVERY, head: int = HEAD, **columns: str) -> DataFrame:
    """conv_id, depth, prefix, parent, words, size for every turn of the rebuilt conversations, and one row of depth 0 each.

    Conversation c becomes the first h turns of conversation c - c % every, then its own turns after its
    first h, with h the crc32 of its number, in decimal, modulo ``head``.  ``size`` is the number of its turns.
    """
    rows = ordered(turns, **columns)
    base = F.col("conv_id") - F.col("conv_id") % every
    h = (F.crc32(F.col("conv_id").cast("string")) % head).cast("int")
    convs = rows.groupBy("conv_id").agg(F.max("position").alias("own"))
    convs = convs.select("conv_id", "own", base.alias("base"), h.alias("h"))
    first = rows.filter(F.col("position") < head)
    heads = first.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.col("position").alias("depth"), "prefix", "turn_sha", "words"
    )
    begun = convs.join(heads, "base").filter(F.col("depth") <= F.col("h"))
    begins = begun.groupBy("conv_id").agg(F.max("depth").alias("begin"), F.max_by("prefix", "depth").alias("before"))
    at_h = first.withColumn("at", F.col("position").cast("int")).select("conv_id", "at", F.col("prefix").alias("less"))
    known = (
        convs.withColumn("at", F.least("h", "own").cast("int"))
        .join(begins, "conv_id", "left")
        .join(at_h, ["conv_id", "at"], "left")
        .select(
            "conv_id", "h", F.coalesce("begin", F.lit(0)).alias("begin"), "before", "less",
            (F.coalesce("begin", F.lit(0)) + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size"),
        )
    )
    known = materialise(known, "conversations")
    of_head = begun.join(known.select("conv_id", "size"), "conv_id").select("conv_id", "depth", "prefix", "turn_sha", "words", "size")
    of_own = (
        rows.join(known, "conv_id")
        .filter(F.col("position") > F.col("h"))
        .select(
            "conv_id", (F.col("position") - F.col("h") + F.col("begin")).alias("depth"),
            _after("before", "begin", "prefix", "less", "h").alias("prefix"), "turn_sha", "words", "size",
        )
    )
    deep = of_head.unionByName(of_own).select(
        "conv_id", "depth", "prefix", _without_last("prefix", "depth", "turn_sha").alias("parent"), "words", "size"
    )
    top = known.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("prefix"), F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("words"), "size",
    )
    return materialise(deep.unionByName(top), "rebuilt")


# ---- node tables -----------------------------------------------------------------------------


class Slots:
    """A minimal perfect hash of distinct 32-byte names.

    Level by level, names that fall alone into a place of a table of twice their number keep it; the others go
    on to the next level.  A name's slot is the number of kept places before its own.
    """

    def __init__(self, names: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        offset, left = 0, self._words(names)
        while len(left):
            place = self._place(left, len(self.levels), 2 * len(left))
            alone = np.bincount(place, minlength=2 * len(left)) == 1
            self.levels.append((alone, offset + np.cumsum(alone) - alone))
            offset += int(alone.sum())
            left = left[~alone[place]]
        self.names = np.empty((len(names), 4), np.uint64)
        if len(names):
            words = self._words(names)
            self.names[self._find(words)] = words

    @staticmethod
    def _words(names: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(names).view(np.uint64).reshape(-1, 4)

    @staticmethod
    def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = words[:, level % 4] ^ (words[:, (level + 1) % 4] >> np.uint64(7)) ^ np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def _find(self, words: np.ndarray) -> np.ndarray:
        slot = np.full(len(words), -1, np.int64)
        open_ = np.arange(len(words))
        for level, (alone, before) in enumerate(self.levels):
            place = self._place(words[open_], level, len(alone))
            hit = alone[place]
            slot[open_[hit]] = before[place[hit]]
            open_ = open_[~hit]
        return slot

    def of(self, names: np.ndarray) -> np.ndarray:
        """Slots of names; -1 for one that is not in the table, told by comparing it with the name at its slot."""
        words = self._words(names)
        slot = self._find(words)
        right = slot >= 0
        right[right] = (self.names[slot[right]] == words[right]).all(1)
        return np.where(right, slot, -1)


_SUMS = ("n_children", "n_leaves", "saved_tokens")


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole subtrees in, the totals of their nodes out; small subtrees share a table."""
    held: list[pa.Table] = []
    for subtree in runs(batches, "top"):
        if held and sum(t.num_rows for t in held) + subtree.num_rows > TABLE:
            yield _summed(pa.concat_tables(held))
            held = []
        held.append(subtree)
    if held:
        yield _summed(pa.concat_tables(held))


def _summed(rows: pa.Table) -> pa.RecordBatch:
    def names(column: str) -> np.ndarray:
        return np.frombuffer(b"".join(rows.column(column).to_pylist()), np.uint8).reshape(-1, 32)

    def numbers(column: str) -> np.ndarray:
        return rows.column(column).to_numpy()

    slots = Slots(names("prefix"))
    slot, up = slots.of(names("prefix")), slots.of(names("parent"))
    if (slot < 0).any() or len(np.unique(slot)) < len(slot):
        raise ValueError("a prefix has no slot of its own")
    n = len(slot)
    table = {c: np.zeros(n, np.int64) for c in ("conv_id", *_SUMS)}
    for c in table:
        table[c][slot] = numbers(c)  # of what rounds before found below a node, but for its conversation
    table["saved_tokens"][slot] += (numbers("n_convs") - 1) * numbers("words")
    depth = numbers("depth")
    order = np.argsort(-depth, kind="stable")
    steps = np.flatnonzero(np.diff(depth[order], prepend=depth[order[0]] + 1))
    for start, end in zip(steps, [*steps[1:], n]):
        level = order[start:end]
        own, above = slot[level], up[level]
        leaf = own[table["n_children"][own] == 0]
        table["n_leaves"][leaf] = 1
        inside = above >= 0
        own, above = own[inside], above[inside]
        np.add.at(table["n_children"], above, 1)
        for c in ("n_leaves", "saved_tokens"):
            np.add.at(table[c], above, table[c][own])
    known = up >= 0
    parents = pa.array(np.where(known, table["conv_id"][up], 0), mask=~known)
    kept = [rows.column(c).combine_chunks() for c in ("prefix", "parent", "conv_id", "depth", "n_convs")]
    sums = [pa.array(table[c][slot]) for c in _SUMS]
    return pa.RecordBatch.from_arrays([*kept, *sums, parents], ["prefix", "parent", "conv_id", "depth", "n_convs", *_SUMS, "parent_conv_id"])


# ---- members that end at a node ---------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted prefix, conv_id to runs of conversation numbers joined by commas, at most PIECE bytes or one batch each."""
    name, first, held, size, rows = None, 0, [], 0, []

    def flush() -> None:
        if held:
            rows.append((name, first, ",".join(held)))

    for batch in batches:
        for prefix, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if prefix != name or size > PIECE:
                flush()
                name, first, held, size = prefix, conv, [], 0
            held.append(str(conv))
            size += len(held[-1]) + 1
        if rows:
            yield _piece_batch(rows)
            rows.clear()
    flush()
    if rows:
        yield _piece_batch(rows)


def _piece_batch(rows: list[tuple[bytes, int, str]]) -> pa.RecordBatch:
    names, first, texts = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.binary()), pa.array(first, pa.int64()), pa.array(texts)], ["prefix", "first", "piece"]
    )


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to one hash a node; only the state of the hash is held."""
    name, state, out = None, None, []

    def result() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.binary()), pa.array([s for _, s in out])], ["prefix", "ends_sha256"])

    for batch in batches:
        for prefix, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if prefix != name:
                if state is not None:
                    out.append((name, state.hexdigest()))
                name, state = prefix, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if out:
            yield result()
            out = []
    if state is not None:
        out.append((name, state.hexdigest()))
        yield result()


def _ends(turns: DataFrame) -> DataFrame:
    """prefix, ends_sha256: members that end at a prefix, sorted across partitions and hashed piece by piece."""
    last = turns.filter(F.col("depth") == F.col("size")).select("prefix", "conv_id")
    placed = on_workers(last).repartitionByRange("prefix", "conv_id").sortWithinPartitions("prefix", "conv_id")
    pieces = placed.mapInArrow(_pieces, "prefix binary, first long, piece string")
    return pieces.repartition("prefix").sortWithinPartitions("prefix", "first").mapInArrow(_hashes, "prefix binary, ends_sha256 string")


# ---- the trie -----------------------------------------------------------------------------------


def nodes(turns: DataFrame, *, limit: int = LIMIT) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node.

    ``turns`` is what ``rebuilt`` returns.  A node is a distinct prefix, named by its smallest member and its
    depth.  No conversations, no nodes.  Rounds grow with the number of nodes of the longest conversation over ``limit``.
    """
    found = materialise(
        turns.groupBy("prefix").agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
            *[F.any_value(c).alias(c) for c in ("depth", "parent", "words")],
        ),
        "nodes",
    )
    deep = found.filter("depth > 0").withColumns({c: F.lit(0).cast("long") for c in _SUMS})
    # A node belongs to its smallest member, and so do all nodes below it on that conversation's path.
    owners = found.filter("depth > 0").groupBy("conv_id").agg(F.min("depth").alias("from"), F.max("depth").alias("to"))
    ways = turns.filter("depth > 0").select("conv_id", "depth", "prefix").join(owners, "conv_id")
    summed: list[DataFrame] = []
    crown = None  # all nodes that the first round leaves
    while True:
        ways = materialise(ways, "ways")
        below = F.col("to") - F.greatest("depth", "from") + 1
        large = (
            ways.groupBy("prefix").agg(F.sum(F.greatest(below, F.lit(0))).alias("nodes")).filter(F.col("nodes") > limit).select("prefix")
        )
        large = materialise(large, "large")
        crown = crown or large
        above = ways.join(large, "prefix", "left_semi")
        tops = above.groupBy("conv_id").agg(F.max("depth").alias("upper"))
        cut = ways.join(tops, "conv_id", "left").withColumn("upper", F.coalesce("upper", F.lit(0).cast("long")))
        cut = materialise(cut, "cut")
        named = cut.filter(F.col("depth") == F.col("upper") + 1).select("conv_id", F.col("prefix").alias("top"))
        now = deep.join(large, "prefix", "left_anti").join(named, "conv_id")
        columns = ["top", "prefix", "parent", "conv_id", "depth", "n_convs", "words", *_SUMS]
        placed = on_workers(now.select(*columns)).repartition("top").sortWithinPartitions("top")
        totals = placed.mapInArrow(
            _subtrees,
            "prefix binary, parent binary, conv_id long, depth long, n_convs long, n_children long, n_leaves long, "
            "saved_tokens long, parent_conv_id long",
        )
        totals = materialise(totals, "totals")
        summed.append(totals)
        upward = totals.filter("parent_conv_id is null").groupBy(F.col("parent").alias("prefix")).agg(
            F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
        if large.isEmpty():
            break
        deep = deep.join(large, "prefix", "left_semi").join(upward, "prefix", "left")
        deep = materialise(
            deep.select(
                "prefix", "parent", "conv_id", "depth", "n_convs", "words",
                *[(F.col(c) + F.coalesce(more, F.lit(0))).alias(c) for c, more in zip(_SUMS, ("children", "leaves", "saved"))],
            ),
            "upper",
        )
        ways = cut.filter((F.col("depth") <= F.col("upper")) & (F.col("from") <= F.col("upper"))).select("conv_id", "depth", "prefix", "from", F.col("upper").alias("to"))
    every = reduce(DataFrame.unionByName, summed)
    # parents beyond their table: the root, or nodes of a later round
    smallest = found.filter("depth = 0").agg(F.max("conv_id")).scalar()
    upper = found.join(crown, "prefix", "left_semi").select(F.col("prefix").alias("parent"), F.col("conv_id").alias("upper_conv_id"))
    beyond = F.when(F.col("depth") == 1, smallest).otherwise(F.col("parent_conv_id"))
    every = every.withColumn("parent_conv_id", beyond)
    inner = every.filter("parent_conv_id is not null")
    outer = every.filter("parent_conv_id is null").drop("parent_conv_id").join(upper, "parent")
    deep_nodes = inner.unionByName(outer.withColumnRenamed("upper_conv_id", "parent_conv_id")).drop("parent")
    below = every.filter("depth = 1").agg(
        F.struct(F.count("*").alias("n"), F.coalesce(F.sum("n_leaves"), F.lit(1)).alias("leaves"), F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved"))
    )
    top = found.filter("depth = 0").select("prefix", "conv_id", "depth", "n_convs").withColumn("below", below.scalar())
    top = top.select(
        "prefix", "conv_id", "depth", "n_convs", F.col("below.n").alias("n_children"), F.col("below.leaves").alias("n_leaves"),
        F.col("below.saved").alias("saved_tokens"), F.lit(None).cast("long").alias("parent_conv_id"),
    )
    return (
        deep_nodes.unionByName(top)
        .join(_ends(turns), "prefix", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", *_SUMS, F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256")
        )
    )
