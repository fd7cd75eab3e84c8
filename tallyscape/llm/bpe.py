"""Byte-level BPE by segment trees.

A piece of text is a row of bytes, each a token at first.  A leaf of the tree stands for a byte
position and holds the rank of the pair that the live token there forms with the next live token;
an inner node holds the smaller of its children, ties to the left.  The root names the next merge.
A merge ends one leaf and changes two, and each is carried up in as many steps as the tree is high.

Trees of short pieces are kept side by side in arrays and merge in step; a long piece has its own.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, StructField, StructType

from tallyscape.llm.common import on_workers

SHORT = 64  # bytes up to which pieces share arrays
SLICE = 1 << 19  # characters split, encoded and handed on at a time, or one text if that is longer
TOGETHER = 4_000  # short pieces whose trees stand side by side
MEMORY = 12 << 20  # bytes of pieces remembered, twice; forgetting changes no result
ENTRY = 200  # bytes that a remembered piece takes besides its characters and ids
_NONE = np.int64(1) << 62


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Ranks from lines of base64 bytes and rank."""
    split = (line.split() for line in lines if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in split}


class Merges:
    """The merges that a vocabulary allows, and the pieces met so far."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {
            (ranks[token[:k]] << 32) | ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        self.of_pair = pairs
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[p] for p in self.pairs.tolist()], np.int64)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.known: dict[str, bytes] = {}  # of this and of the last slices
        self.before: dict[str, bytes] = {}  # of those before, taken over when met again
        self.held = 0

    def remember(self, piece: str, ids: bytes) -> None:
        self.known[piece] = ids
        self.held += ENTRY + len(piece) + len(ids)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.full(len(left), _NONE)
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.merged[at], _NONE)

    def encode_short(self, pieces: list[bytes]) -> list[bytes]:
        """Pieces of at most SHORT bytes, their trees merging in step."""
        n, longest = len(pieces), max(map(len, pieces))
        size = 1 << max(1, (longest - 1).bit_length())
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(n, size)
        token = np.full((n, size + 1), -1, np.int64)
        inside = np.arange(size) < lengths[:, None]
        token[:, :size] = np.where(inside, self.single[raw], -1)
        after = np.tile(np.minimum(np.arange(1, size + 2), size), (n, 1))
        before = np.tile(np.arange(-1, size), (n, 1))
        tree = np.full((n, 2 * size), _NONE)
        row, at = np.nonzero(inside[:, 1:])
        rank = self.rank_of(token[row, at], token[row, at + 1])
        found = rank < _NONE
        tree[row[found], size + at[found]] = (rank[found] << 7) | at[found]
        half = size >> 1
        while half:
            tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])
            half >>= 1

        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            best = tree[rows, 1]
            at, gone = best & 127, after[rows, best & 127]
            right, left = after[rows, gone], before[rows, at]
            token[rows, at] = best >> 7
            token[rows, gone] = -1
            after[rows, at] = right
            before[rows, right] = at
            self._set(tree, size, rows, gone, np.full(len(rows), _NONE))
            has = token[rows, right] >= 0
            rank = np.full(len(rows), _NONE)
            rank[has] = self.rank_of(token[rows[has], at[has]], token[rows[has], right[has]])
            self._set(tree, size, rows, at, np.where(rank < _NONE, (rank << 7) | at, _NONE))
            has = left >= 0
            some, to = rows[has], left[has]
            rank = self.rank_of(token[some, to], token[some, at[has]])
            self._set(tree, size, some, to, np.where(rank < _NONE, (rank << 7) | to, _NONE))
            rows = rows[tree[rows, 1] < _NONE]
        live = token[:, :size] >= 0
        ids = token[:, :size][live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(1)) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    @staticmethod
    def _set(tree: np.ndarray, size: int, rows: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        node = leaf + size
        tree[rows, node] = value
        while size > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            size >>= 1

    def encode_long(self, piece: bytes) -> bytes:
        """One piece of any length."""
        n = len(piece)
        size = 1 << (n - 1).bit_length()
        token = [int(self.single[b]) for b in piece]
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        none = (1 << 62, 0)
        pair = self.of_pair.get
        tree = [none] * (2 * size)
        for i in range(n - 1):
            rank = pair((token[i] << 32) | token[i + 1])
            if rank is not None:
                tree[size + i] = (rank, i)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: tuple[int, int]) -> None:
            node = i + size
            tree[node] = value
            while node > 1:
                node >>= 1
                best = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == best:
                    break
                tree[node] = best

        while tree[1] != none:
            rank, i = tree[1]
            gone = after[i]
            right, left = after[gone], before[i]
            token[i], token[gone], after[i] = rank, -1, right
            put(gone, none)
            if right < n:
                before[right] = i
            more = pair((rank << 32) | token[right]) if right < n else None
            put(i, none if more is None else (more, i))
            if left >= 0:
                more = pair((token[left] << 32) | rank)
                put(left, none if more is None else (more, left))
        return np.array([t for t in token if t >= 0], "<u4").tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces not remembered.  Memory is given back by halves, the longer unused one first."""
        if self.held > MEMORY:
            self.known, self.before, self.held = {}, self.known, 0
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces - self.known.keys():
            met = self.before.get(piece)
            if met is not None:
                self.remember(piece, met)
                continue
            raw = piece.encode()
            if raw in self.ranks:  # a piece that is a token stays whole
                self.remember(piece, self.ranks[raw].to_bytes(4, "little"))
            elif len(raw) > SHORT:
                self.remember(piece, self.encode_long(raw))
            else:
                by_size.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for group in by_size.values():
            for k in range(0, len(group), TOGETHER):
                part = group[k : k + TOGETHER]
                for (piece, _), ids in zip(part, self.encode_short([r for _, r in part]), strict=True):
                    self.remember(piece, ids)

    def encode(self, texts: list[str], split) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        start = 0
        while start < len(texts):
            end, held = start, 0
            while end < len(texts) and (end == start or held + len(texts[end]) <= SLICE):
                held += len(texts[end])
                end += 1
            pieces = [split(t) for t in texts[start:end]]
            self.learn(set().union(*pieces))
            known = self.known.__getitem__
            for parts in pieces:
                yield b"".join(map(known, parts))
            start = end

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_READY: dict[tuple[int, int], Merges] = {}  # of the vocabulary a worker used last


def encode_decode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    *,
    ids: str = "ids",
    decoded: str = "decoded",
    round_trip: str | None = None,
) -> DataFrame:
    """Adds ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` (binary, the ids' bytes).

    With ``round_trip`` a column of that name takes the place of ``decoded``: whether the ids' bytes are the text's.

    Each match of ``pattern`` is encoded by itself, without special tokens.  Null and empty texts
    have no ids.  A column of the same name is replaced.  Works row by row, in no order, with no
    shuffle; ``ranks`` is the vocabulary, about a megabyte, sent with the function.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    last = StructField(round_trip, BooleanType()) if round_trip else StructField(decoded, BinaryType())
    kept = [c for c in docs.columns if c not in (ids, last.name)]
    base = docs.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (len(shared.value), hash(frozenset(shared.value.items())))
        if key not in _READY:
            _READY.clear()
            _READY[key] = Merges(shared.value)
        merges = _READY[key]
        split = regex.compile(pattern).findall
        for batch in batches:
            texts = batch.column(kept.index(text))
            lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            rows, start = batch.num_rows, 0
            while start < rows:
                end, held = start, 0
                while end < rows and (end == start or held + lengths[end] <= SLICE):
                    held += lengths[end]
                    end += 1
                part = batch.slice(start, end - start)
                given = [t or "" for t in part.column(kept.index(text)).to_pylist()]
                coded = list(merges.encode(given, split))
                back = map(merges.decode, coded)
                if round_trip:
                    found = pa.array([b == t.encode() for b, t in zip(back, given, strict=True)], pa.bool_())
                else:
                    found = pa.array(list(back), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(coded, pa.binary()), found], [*kept, ids, last.name])
                start = end
            pa.default_memory_pool().release_unused()

    schema = StructType([*base.schema.fields, StructField(ids, BinaryType()), last])
    return on_workers(base).mapInArrow(run, schema)
