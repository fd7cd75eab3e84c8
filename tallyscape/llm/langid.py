"""Language of a text by a small convolutional network over bytes.

Bytes are embedded, filters of several widths slide over a window of fixed length, the largest answer of
each filter goes to a softmax.  The network is trained in numpy on a bounded sample of windows of labelled
texts.  A text of any length is cut into windows without gaps; its answer is their mean, by bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from tallyscape.llm.buffers import slices
from tallyscape.llm.common import on_workers, whole

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
EMBEDDED, FILTERS = 8, 10
SAMPLE = 8192  # windows the network is trained on, at most
EPOCHS = 6
BLOCK = 512  # windows judged at a time
UNKNOWN = "und"

#: Upper case, digits and white space say nothing about a language.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[48:58] = 48
_FOLD[9:14] = 32


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # (256, EMBEDDED)
    filters: list[np.ndarray]  # per width (width, EMBEDDED, FILTERS)
    bias: np.ndarray  # (len(WIDTHS) * FILTERS,)
    weights: np.ndarray  # (len(WIDTHS) * FILTERS, languages)
    offset: np.ndarray

    def tables(self) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Answers of each width as sums over byte pairs, and over a last byte or pair."""
        out = []
        for width, w in zip(WIDTHS, self.filters, strict=True):
            one = [(self.embedding @ w[k]).astype(np.float32) for k in range(width)]
            pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, -1)
            rest = None if width == 2 else one[2] if width == 3 else pair(one[2], one[3])
            out.append((pair(one[0], one[1]), rest))
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 5) -> Network:
    """Fit by Adam on (n, WINDOW) bytes and language numbers."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.5, (256, EMBEDDED))]
    params += [rng.normal(0, 0.3, (w, EMBEDDED, FILTERS)) for w in WIDTHS]
    params += [
        np.zeros(len(WIDTHS) * FILTERS),
        rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(languages))),
        np.zeros(len(languages)),
    ]
    params = [p.astype(np.float32) for p in params]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    share = np.bincount(labels, minlength=len(languages))
    weight = (len(labels) / np.maximum(share, 1) / len(languages)).astype(np.float32)
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), 64):
            some = order[start : start + 64]
            x, y = windows[some], labels[some]
            emb, rows = params[0], np.arange(len(some))
            seen = emb[x]
            tops, where = [], []
            for width, w in zip(WIDTHS, params[1 : 1 + len(WIDTHS)], strict=True):
                reach = WINDOW - width + 1
                a = sum(seen[:, k : k + reach] @ w[k] for k in range(width))
                at = a.argmax(1)
                where.append(at)
                tops.append(np.take_along_axis(a, at[:, None], 1)[:, 0])
            raw = np.concatenate(tops, 1) + params[-3]
            hidden = np.maximum(raw, 0)
            p = _softmax(hidden @ params[-2] + params[-1])
            p[rows, y] -= 1
            d = p * weight[y][:, None] / len(some)
            grads = [np.zeros_like(v) for v in params]
            grads[-2], grads[-1] = hidden.T @ d, d.sum(0)
            back = (d @ params[-2].T) * (raw > 0)
            grads[-3] = back.sum(0)
            for n, width in enumerate(WIDTHS):
                g = back[:, n * FILTERS : (n + 1) * FILTERS]
                for k in range(width):
                    byte = x[rows[:, None], where[n] + k]  # (rows, FILTERS)
                    grads[1 + n][k] = np.einsum("bfe,bf->ef", emb[byte], g)
                    np.add.at(grads[0], byte, g[:, :, None] * params[1 + n][k].T[None])
            step += 1
            for v, g, m, s in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Network(languages, params[0], params[1:-3], params[-3], params[-2], params[-1])


def window_probabilities(net: Network, tables, windows: np.ndarray) -> np.ndarray:
    """(n, languages) for (n, WINDOW) folded bytes."""
    n = len(windows)
    flat = np.concatenate([windows.ravel(), np.zeros(4, np.uint8)]).astype(np.int32)
    pairs = (flat[:-1] << 8) | flat[1:]
    tops = []
    for width, (head, rest) in zip(WIDTHS, tables, strict=True):
        a = head[pairs[: n * WINDOW]]
        if width == 3:
            a += rest[flat[2 : 2 + n * WINDOW]]
        elif width == 4:
            a += rest[pairs[2 : 2 + n * WINDOW]]
        tops.append(a.reshape(n, WINDOW, FILTERS)[:, : WINDOW - width + 1].max(1))
    hidden = np.maximum(np.concatenate(tops, 1) + net.bias, 0)
    return _softmax(hidden @ net.weights + net.offset)


def cut(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of each text, filled up with zeros: (windows, first window of each text, bytes in each window)."""
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-sizes // WINDOW))
    start = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(int(start[-1]) * WINDOW, np.uint8)
    shift = np.repeat(start[:-1] * WINDOW - offsets[:-1], sizes)
    out[np.arange(len(data)) + shift] = _FOLD[data]
    held = np.full(int(start[-1]), WINDOW, np.int64)
    held[start[1:] - 1] = sizes - (count - 1) * WINDOW
    return out.reshape(-1, WINDOW), start[:-1], held


def sample_windows(docs: DataFrame, text: str, lang: str, key: Column, size: int = SAMPLE) -> DataFrame:
    """At most ``size`` rows lang, window: for each language the texts whose key hashes lowest.

    A window starts at a place given by the hash.  Ranks are taken in 64 parts of a language, so a
    language with most rows is no single group, and only the parts' best rows are shuffled.
    """
    n = max(1, docs.filter(F.col(lang).isNotNull()).select(lang).distinct().count())
    each = max(1, size // n // 64)
    mixed = F.xxhash64(F.lit("sample"), key)
    at = F.pmod(F.shiftrightunsigned(mixed, 20), F.greatest(F.length(text) - WINDOW // 2, F.lit(1))) + 1
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"),
        mixed.alias("mixed"),
        F.pmod(mixed, F.lit(64)).alias("part"),
        F.substring(F.col(text), at.cast("int"), F.lit(WINDOW)).alias("window"),
    )
    best = Window.partitionBy("lang", "part").orderBy("mixed", "window")
    ranked = rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= each)
    # With very many languages one window for each part is still too many: those that hash lowest are taken.
    return ranked.orderBy("rank", "mixed", "lang", "window").limit(size).select("lang", "mixed", "window")


def learn(docs: DataFrame, text: str, lang: str, key: Column, size: int = SAMPLE) -> Network | None:
    """Train on a sample of labelled texts; None if there are none.  The sample is at most ``size`` windows of 1 kB."""
    rows = sorted((r["lang"], r["mixed"], r["window"]) for r in sample_windows(docs, text, lang, key, size).collect())
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    raw = [r[2].encode()[:WINDOW].ljust(WINDOW, b"\0") for r in rows]
    windows = _FOLD[np.frombuffer(b"".join(raw), np.uint8).reshape(-1, WINDOW)]
    return train(windows, np.array([languages.index(r[0]) for r in rows]), languages)


def predict(
    docs: DataFrame, net: Network | None, text: str = "text", *, lang_pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1, the mean probability of the language over the whole text).

    A text that is null or has no letter is ``und`` with score 0, and so is every text where nothing could be
    learned.  Ties go to the language first in code point order.  Columns of these names are replaced.
    """
    kept = [c for c in docs.columns if c not in (lang_pred, score)]
    base = docs.select(*[F.col(f"`{c}`") for c in kept])
    lettered = F.regexp_like(whole(f"`{text}`"), F.lit(r"\p{L}"))
    if net is None:
        return base.withColumns({lang_pred: F.lit(UNKNOWN), score: F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables()
        for batch in batches:
            best = np.zeros(batch.num_rows, np.int64)
            sure = np.zeros(batch.num_rows)
            for first, offsets, data in slices(batch.column(kept.index(text)), 1 << 20):
                windows, start, held = cut(offsets, data)
                p = np.concatenate(
                    [window_probabilities(net, tables, windows[k : k + BLOCK]) for k in range(0, len(windows), BLOCK)]
                )
                held = np.maximum(held, 1)
                mean = np.add.reduceat(p * held[:, None], start) / np.add.reduceat(held, start)[:, None]
                rows = slice(first, first + len(offsets) - 1)
                best[rows], sure[rows] = mean.argmax(1), mean.max(1)
            names = pa.array(net.languages).take(pa.array(best))
            values = pa.array(np.clip(sure, 0.0, 1.0))
            yield pa.RecordBatch.from_arrays([*batch.columns, names, values], [*kept, lang_pred, score])

    schema = StructType([*base.schema.fields, StructField(lang_pred, StringType()), StructField(score, DoubleType())])
    out = on_workers(base).mapInArrow(run, schema)
    return out.withColumns(
        {
            lang_pred: F.when(lettered, F.col(lang_pred)).otherwise(UNKNOWN),
            score: F.when(lettered, F.col(score)).otherwise(0.0),
        }
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents kept from training: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from labelled documents that are not held out."""
    net = learn(docs.filter(~held_out(doc_id)), text, lang, F.col(doc_id))
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    return predict(rows, net).drop("text")
