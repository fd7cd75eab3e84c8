"""Spelling variants, nearest neighbours and the prefix trie against brute force and SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest

from tallyscape.llm import prefix_trie, queries, spelling, vantage
from tallyscape.llm.checks import CHECKS

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_nearest_neighbours", "op13_prefix_trie"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.execute(CHECKS[name])
    columns = [c[0] for c in want.description]
    df = queries.QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, want.fetchall()))


# ---- spelling ----------------------------------------------------------------------------


def edit(a, b):
    """Whether one code point inserted, deleted or replaced makes a into b."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p:] == b[p + 1 :] if len(a) < len(b) else a[p + 1 :] == b[p + 1 :]


def brute_variants(counts, ratio):
    near = {w: [o for o in counts if edit(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            form[w] = best
    out = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, counts[w], len(near[w]), counts[form[w]] if w in form else None))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_variants_of_words(spark, seed):
    rng = random.Random(seed)
    counts = {"".join(rng.choices("abé", k=rng.randint(1, 6))): rng.choice([2, 3, 20, 30, 400, 9000]) for _ in range(250)}
    counts |= {"a" * n: 2 ** (n % 9) * 3 for n in range(1, 25)}  # words within words
    long = "".join(rng.choices("abcdefgh", k=3000))
    counts |= {long: 50, long[:700] + "x" + long[701:]: 2, long[:2500] + long[2501:]: 3, long + "z": 600, "𝔞bcdefg": 2, "abcdefg": 20}
    df = spark.createDataFrame([(w, n, "extra") for w, n in counts.items()], "word string, n long, id string").repartition(3)
    got = spelling.variants(df, ratio=10)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_variants(counts, 10), key=repr)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_variants_of_few_and_of_no_words(spark):
    none = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(none).count() == 0
    odd = spark.createDataFrame([(None, 3), ("", 4), ("b", 1), ("c", 1)], "word string, n long")
    got = {r.word: tuple(r)[1:] for r in spelling.variants(odd).collect()}
    assert got == {None: (None, None, 3, 0, None), "": (None, "", 4, 0, None), "b": (None, "b", 1, 1, None), "c": (None, "c", 1, 1, None)}


def test_words_of_documents(docs, no_docs, rows_in):
    want = Counter()
    for i, text, *_ in rows_in:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    got = spelling.words(docs, drop_every=3)
    assert {r.word: r.n for r in got.collect()} == {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    assert spelling.words(no_docs).count() == 0


# ---- neighbours ------------------------------------------------------------------------------


def brute_nearest(rows, k, every):
    usable = {
        (i, tuple(v)) for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    out = []
    for i, q in usable:
        if i % every == 0:
            met = [(-sum_in_order(q, v), j) for j, v in usable if j != i and len(v) == len(q)]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(sorted(met)[:k], 1)]
    return sorted(out)


def sum_in_order(a, b):
    total = a[0] * b[0]
    for x, y in zip(a[1:], b[1:]):
        total += x * y
    return total


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(0, 400)]
    rows += [(i, np.eye(8)[i % 8].tolist()) for i in range(400, 500)]  # ties
    rows += [(i, rows[20][1]) for i in range(500, 560)]  # copies of a query
    rows += [(600, None), (601, []), (602, [0.0] * 8), (603, [None] + [1.0] * 7), (604, [float("nan")] * 8), (605, [float("inf")] * 8)]
    rows += [(None, [1.0] * 8), (-20, [2.0] * 8), rows[3], (606, [1.0, 2.0]), (620, [3.0, 1.0]), (640, [1.0]), (607, [-0.0, 0.0])]
    rows += [(660, [1e200] * 8), (661, [1e150] * 8), (680, [1e-200] * 8)]
    return rows


@pytest.mark.parametrize("seed,sizes", [(0, {}), (1, {"shard_bytes": 4096, "block_bytes": 256})])
def test_nearest_neighbours(spark, seed, sizes):
    rows = vectors(seed)
    df = spark.createDataFrame([(*r, 1, 1.0) for r in rows], "vec_id long, embedding array<double>, rank int, score double").repartition(4)
    got = vantage.nearest(df, k=5, **sizes)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_nearest(rows, 5, 20)


def test_no_vectors_and_one(spark):
    schema = "vec_id long, embedding array<float>"
    assert vantage.nearest(spark.createDataFrame([], schema)).count() == 0
    assert vantage.nearest(spark.createDataFrame([(20, [1.0])], schema)).count() == 0


def test_a_relaxed_factor_skips_more_and_keeps_its_recall():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16)) * 3
    points = centres[rng.integers(40, size=8000)] + rng.normal(size=(8000, 16)) * 0.3
    queries = points[:200]
    tree = vantage.VantageTree(points, np.arange(8000), leaf=64)
    product = queries @ points.T
    product[np.arange(200), np.arange(200)] = -np.inf
    best = np.argsort(-product, axis=1, kind="stable")[:, :20]
    recall, visited = [], []
    for factor in (1.0, 1.1, 3.0):
        q, row, _ = tree.search(queries, np.arange(200), 20, factor)
        recall.append(sum(len(set(row[q == i]) & set(best[i])) for i in range(200)) / 4000)
        visited.append(tree.visited)
    assert recall[0] == 1.0 and recall[1] >= 0.9
    assert visited[2] < visited[1] < visited[0] < 200 * 8000  # exact search prunes too


# ---- prefix trie --------------------------------------------------------------------------------


def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    said = {c: [(r[2], r[4]) for r in sorted(v)] for c, v in convs.items()}
    members = defaultdict(list)
    for c in said:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        made = said.get(base, [])[:h] + said[c][h:]
        for d in range(len(made) + 1):
            members[tuple(made[:d])].append((c, d == len(made)))
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) if children[node] else 1
        saved[node] = own + sum(saved[x] for x in children[node])
        ends = ",".join(str(c) for c, last in sorted(members[node]) if last)
        smallest = min(c for c, _ in members[node])
        parent = min(c for c, _ in members[node[:-1]]) if node else None
        out.append((smallest, len(node), parent, len(members[node]), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed):
    rng = random.Random(seed)
    say = lambda: rng.choice(["hi there", "yes", "no", "", "a longer\tanswer with words", None])
    role = lambda: rng.choice(["user", "assistant", None])
    rows = [(c, t, role(), say()) for c in range(-45, 90) for t in range(rng.randint(1, 6)) if c not in (0, 60)]
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(3)]  # copies
    rows += [(300, t, "user", f"turn {t}") for t in range(400)] + [(307, t, "user", f"turn {t}") for t in range(390)]
    rows += [(400, None, "b", "x"), (400, None, "a", "y"), (400, 1, "a", "y"), (400, 1, "a", "y"), (None, 1, "a", "lost")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,limit", [(0, prefix_trie.LIMIT), (1, 100)])
def test_trie_of_conversations(spark, seed, limit):
    rows = conversations(seed)
    df = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, prefix string").repartition(5)
    got = prefix_trie.nodes(prefix_trie.rebuilt(df), limit=limit)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(rows)


def test_conversations_of_few_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.nodes(prefix_trie.rebuilt(spark.createDataFrame([], schema))).count() == 0
    lone = [(c, 1, None, None) for c in range(41, 60)]  # without a base, those with h > 0 have no turns
    got = prefix_trie.nodes(prefix_trie.rebuilt(spark.createDataFrame(lone, schema)))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(lone)


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_every_name_has_a_slot_of_its_own(n):
    rng = np.random.default_rng(n)
    names = rng.integers(0, 256, size=(n, 32)).astype(np.uint8)
    slots = prefix_trie.Slots(names)
    assert sorted(slots.of(names)) == list(range(n))
    others = rng.integers(0, 256, size=(50, 32)).astype(np.uint8)
    assert (slots.of(others) == -1).all()
