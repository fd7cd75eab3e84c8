"""Spelling variants: words one edit apart, found by walking a trie kept as a table.

The trie is a table of edges (node, label, child).  A state is a word, the node it has reached, the rest of the
word that must still be read, and the one edit it has made.  Every round joins the states with the edges of
their nodes; a state that has read its word to the end at a node where a word ends has found a neighbour.

Two tries, of the words and of the reversed words, share the work: an edit in the second half of a word is
sought in the first, one in the first half in the second.  So a walk starts below the middle of its word,
where nodes have few children, and no word is followed from the root.  Nodes where no path branches and
no word ends are left out and their characters joined into one label, so the number of rounds follows the branches
below the middle and not the length of the words.  An insertion is a deletion seen from the other word.

Nodes are named by 64-bit hashes of their path.  Names that coincide could only add states; every pair found
is compared as text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscape.llm.common import ascii_lower, on_workers, whole
from tallyscape.session import materialise

LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
CHARS = 1 << 16  # code points hashed at a time, or one word if that is longer
_SEEDS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)  # forwards, backwards


def words(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    letters: str = r"A-Za-zÀ-ÿ",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    drop_every: int | None = None,
) -> DataFrame:
    """word, n: the distinct runs of ``letters`` of at least ``least_length``, A-Z lower-cased.

    With ``drop_every`` a run loses the code point h % length if that number divides h, the crc32 of ``<doc_id>:<run>``:
    misspellings made on purpose.  A null text has no runs; a null id counts as an empty one.
    """
    found = F.regexp_extract_all(whole(text), F.lit(f"[{letters}]{{{least_length},}}"), F.lit(0))
    rows = docs.select(F.col(doc_id).alias("id"), F.explode(found).alias("run"))
    rows = rows.select("id", ascii_lower(F.col("run")).alias("word"))
    if drop_every:
        name = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), "word")
        rows = rows.withColumn("h", F.crc32(name))
        at = (F.col("h") % F.length("word")).cast("int")
        shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        rows = rows.withColumn("word", F.when(F.col("h") % drop_every == 0, shorter).otherwise(F.col("word")))
        rows = rows.filter(F.length("word") >= least_length)
    return rows.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


# ---- paths ----------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, word to (id, back, p, node, next): the nodes of every word from its middle on, in both directions.

    ``next`` is the code point read at the node, 0 at the end of the word.
    """
    for batch in batches:
        ids, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        start = 0
        while start < len(texts):
            end, held = start, 0
            while end < len(texts) and (end == start or held + len(texts[end]) <= CHARS):
                held += len(texts[end])
                end += 1
            for back in (0, 1):
                some = [t[::-1] for t in texts[start:end]] if back else texts[start:end]
                size = np.fromiter(map(len, some), np.int64, len(some))
                codes = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).astype(np.uint64)
                first = np.cumsum(size) - size
                at = np.arange(len(codes)) - np.repeat(first, size)
                # the name of a node is the sum of a hash of each place and its character
                step = _mixed((codes << np.uint64(40)) ^ at.astype(np.uint64) ^ np.uint64(_SEEDS[back]))
                total = np.concatenate([[np.uint64(0)], np.cumsum(step, dtype=np.uint64)])
                middle = (size + back) // 2
                count = size - middle + 1
                word = np.repeat(np.arange(len(some)), count)
                p = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + middle[word]
                place = first[word] + p
                node = _mixed(total[place] - total[first[word]] + np.uint64(_SEEDS[back]))
                follows = np.concatenate([codes, [np.uint64(0)]])[place].astype(np.int64)
                follows[p == size[word]] = 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[start:end][word]),
                        pa.array(np.full(len(word), back, np.int32)),
                        pa.array(p.astype(np.int32)),
                        pa.array(node.view(np.int64)),
                        pa.array(follows.astype(np.int32)),
                    ],
                    ["id", "back", "p", "node", "next"],
                )
            start = end


def _trie(known: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The paths of the words over kept nodes, the edges, and where words end.

    paths: id, back, s (the word in that direction), stops (p and node of the kept nodes on its path, in order).
    edges: node, label, child, lens (bit i: a word ends i code points, modulo 64, below the child).
    ends: node, id.
    """
    rows = on_workers(known.select("id", "word")).mapInArrow(_paths, "id long, back int, p int, node long, next int")
    rows = materialise(rows, "paths")
    kept = (
        rows.groupBy("node")
        .agg(F.min("next").alias("least"), F.max("next").alias("most"))
        .filter("least <> most or least = 0")
        .select("node")
    )
    stops = (
        rows.select("id", "back", "p", "node")
        .join(kept, "node")
        .groupBy("id", "back")
        .agg(F.sort_array(F.collect_list(F.struct("p", "node"))).alias("stops"))
    )
    s = F.when(F.col("back") == 1, F.reverse("word")).otherwise(F.col("word"))
    paths = materialise(stops.join(known.select("id", "word"), "id").select("id", "back", s.alias("s"), "stops"), "stops")
    step = paths.filter(F.size("stops") > 1).select(
        "s", F.explode(F.expr("transform(sequence(1, size(stops) - 1), i -> struct(stops[i - 1] AS a, stops[i] AS b))")).alias("e")
    )
    edges = (
        step.select(
            F.col("e.a.node").alias("node"),
            F.substring("s", F.col("e.a.p") + 1, F.col("e.b.p") - F.col("e.a.p")).alias("label"),
            F.col("e.b.node").alias("child"),
            _bit(F.length("s") - F.col("e.b.p")).alias("lens"),
        )
        .groupBy("node", "label", "child")
        .agg(F.bit_or("lens").alias("lens"))
    )
    ends = rows.filter("next = 0").select("node", F.col("id").alias("other"))
    return paths, materialise(edges.withColumn("first", F.substring("label", 1, 1)), "trie"), ends


def _bit(length: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(length, F.lit(64)).cast("int"))


def _fits(rest: Column) -> Column:
    """Some word ends where this rest would."""
    return F.col("lens").bitwiseAND(_bit(F.length(rest))) != 0


# ---- walks ----------------------------------------------------------------------------


def near_pairs(known: DataFrame) -> DataFrame:
    """id, other: each unordered pair of different words, once, one code point inserted, deleted or replaced apart.

    ``known`` has id (long, unique) and word.  Work and rows grow with the words: a state meets at most the
    children of one node, and never the other words below it.
    """
    paths, edges, ends = _trie(known)
    # An edit happens at a kept node: elsewhere a changed word leaves the trie at once.
    starts = paths.select("id", "s", F.explode("stops").alias("stop")).filter(F.col("stop.p") < F.length("s"))
    starts = starts.select(
        "id",
        F.col("stop.node").alias("node"),
        F.substring("s", F.col("stop.p") + 1, F.lit(1)).alias("own"),
        F.substring("s", F.col("stop.p") + 2, F.length("s")).alias("rest"),
    )
    # of equal neighbouring characters the last one goes
    deleted = starts.filter(F.substring("rest", 1, 1) != F.col("own")).select("id", "node", "rest")
    more = F.expr("substring(label, 2)")
    replaced = (
        starts.join(edges, "node")
        .filter((F.col("first") < F.col("own")) & F.startswith("rest", more))
        .select("id", F.col("child").alias("node"), F.substring("rest", F.length("label"), F.length("rest")).alias("rest"), "lens")
        .filter(_fits(F.col("rest")))
        .drop("lens")
    )
    states = materialise(deleted.unionByName(replaced), "states")
    done: list[DataFrame] = []
    while True:
        done.append(states.filter("rest = ''").select("id", "node"))
        going = states.filter("rest <> ''").withColumn("first", F.substring("rest", 1, 1))
        walked = (
            going.join(edges, ["node", "first"])
            .filter(F.startswith("rest", "label"))
            .select("id", F.col("child").alias("node"), F.substring("rest", F.length("label") + 1, F.length("rest")).alias("rest"), "lens")
            .filter(_fits(F.col("rest")))
            .drop("lens")
        )
        states = materialise(walked, "states")
        if states.isEmpty():
            break
    return reduce(DataFrame.unionByName, done).join(ends, "node").filter("id <> other").select("id", "other").distinct()


def variants(counted: DataFrame, *, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n from word and n, words being distinct.

    A word's form is its near word of the largest n (ties: the smallest in code-point order), if that n is
    at least ``ratio`` times the word's, else null.  Its root is where its forms lead; counts grow
    by ``ratio`` with every form, so the way there is short.  A null or empty word is near to none.
    """
    given = materialise(counted.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    known = given.filter("word <> ''")
    pairs = near_pairs(known.select("id", "word"))
    left = known.select("id", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = known.select(F.col("id").alias("other"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    pairs = pairs.join(left, "id").join(right, "other").filter(F.levenshtein("a", "b", 1) == 1)
    both = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("id").alias("id"), F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("word")).alias("near")),
                F.struct(F.col("other").alias("id"), F.struct((-F.col("n_a")).alias("n"), F.col("a").alias("word")).alias("near")),
            )
        ).alias("e")
    ).select("e.*")
    best = both.groupBy("id").agg(F.count("*").alias("n_near"), F.min("near").alias("best"))
    enough = -F.col("best.n") >= ratio * F.col("n")
    judged = known.join(best, "id", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"),
        F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    judged = materialise(judged.unionByName(_unusable(given)), "judged")
    most = judged.agg(F.max("n")).first()[0] or 1
    roots = judged.filter("form is not null").select("word", F.col("form").alias("root"))
    steps, reach = 0, ratio
    while reach <= most:  # longest possible way
        steps, reach = steps + 1, reach * ratio
    for _ in range(max(steps - 1, 0).bit_length()):  # each join doubles the way gone
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = materialise(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _unusable(counted: DataFrame) -> DataFrame:
    return counted.filter("word is null or word = ''").select(
        "word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("string").alias("form"), F.lit(None).cast("long").alias("form_n")
    )
