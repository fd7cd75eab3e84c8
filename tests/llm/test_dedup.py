"""Exact, near and substring duplicates against brute force."""

import random

import numpy as np
import pytest
from text_cases import exact, gram_groups, repeated_bytes, repeated_words

from tallyscape.llm import column_bwt, exact_dedup, graph, ngram_join, rolling, substring_dedup


@pytest.mark.parametrize("counters", [1, 3, 256])
def test_exact_copies(docs, rows_in, counters):
    got = exact_dedup.copies(docs, counters=counters).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in got), key=repr) == exact(rows_in)
    assert sum(r.kept for r in got) == len({r.digest for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_copies_are_dropped_and_columns_stay(docs, no_docs, rows_in):
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert left.count() == len({h for *_, h in exact(rows_in)})
    assert exact_dedup.copies(no_docs).count() == 0 and exact_dedup.drop_copies(no_docs).count() == 0


def test_summary_finds_what_is_frequent():
    rng = random.Random(1)
    stream = [b"hot"] * 400 + [str(rng.randrange(500)).encode() for _ in range(600)]
    rng.shuffle(stream)
    counts = {}
    for k in range(0, 1000, 50):
        part = {}
        for x in stream[k : k + 50]:
            part[x] = part.get(x, 0) + 1
        counts = exact_dedup.summarise(counts, part, 4)
    assert len(counts) <= 4 and counts[b"hot"] >= 400 - 1000 / 5


def test_gram_groups(docs, no_docs, rows_in):
    got = ngram_join.similar_groups(docs)
    known = sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.distinct().collect() if r.doc_id is not None)
    assert known == gram_groups(rows_in)
    unknown = sorted((r.n_shingles, r.component_id) for r in got.filter("doc_id is null").collect() if r.component_id)
    assert len(unknown) == 1  # the copy of a text with id joins it
    assert ngram_join.similar_groups(no_docs).count() == 0


def test_one_of_each_group_stays(docs, no_docs, rows_in):
    left = ngram_join.drop_similar(docs)
    assert left.columns == docs.columns
    kept = {i for i, _, c in gram_groups(rows_in) if i == c}
    assert {r.doc_id for r in left.collect()} == kept | {None}
    assert ngram_join.drop_similar(no_docs).count() == 0


def test_crowded_buckets_give_the_same_groups(docs, rows_in, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 2)
    got = ngram_join.similar_groups(docs).filter("doc_id is not null").distinct().collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == gram_groups(rows_in)


def test_bitmaps_bound_overlaps_from_above():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 4000, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n in (5, 80, 300, 900, 880)]
    bound = ngram_join.overlap_bounds(sets)
    assert all(len(np.intersect1d(a, b)) <= bound[i, j] for i, a in enumerate(sets) for j, b in enumerate(sets))


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    pairs += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)]
    found = dict(graph.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    from text_cases import groups

    ids = {x for p in pairs for x in p if p[0] != p[1]}
    assert found == {i: c for i, c in groups(sorted({x for p in pairs for x in p}), pairs).items() if i in ids}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("crowd", [256, 3, 1])
def test_word_windows(docs, no_docs, rows_in, crowd):
    got = substring_dedup.drop_repeats(docs, crowd=crowd)
    known = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect() if r.doc_id is not None)
    assert known == repeated_words(rows_in)
    assert got.filter("doc_id is null").count() == 2
    assert substring_dedup.drop_repeats(no_docs).count() == 0


@pytest.mark.parametrize("crowd", [256, 3, 1])
def test_byte_strings(docs, no_docs, rows_in, crowd):
    got = column_bwt.drop_repeats(docs, crowd=crowd).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == repeated_bytes(rows_in)
    assert column_bwt.drop_repeats(no_docs).count() == 0


def test_passages_below_400_bytes_stay_whatever_their_words(spark):
    """Sixty words of 359 bytes: for the windows of 50 words a repeat, for the strings of 400 bytes none."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    passage = " ".join(word(5) for _ in range(60))
    longer = " ".join(word(7) for _ in range(50))  # 399 bytes
    surrounded = lambda p: f"{word(90)} {p} {word(90)}"
    rows = [(1, surrounded(passage)), (2, surrounded(passage)), (3, word(90) + longer + "1"), (4, word(90) + longer + "2")]
    rows += [(5, word(90) + "0" + longer), (6, word(90) + "0" + longer)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(column_bwt.drop_repeats(docs).collect())
    assert [r.n_removed for r in got] == [0, 0, 0, 0, 400, 400]
    assert [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == repeated_bytes(rows)
    assert [r.n_removed for r in sorted(substring_dedup.drop_repeats(docs).collect())][:2] == [0, 60]


def test_anchors_that_one_text_holds_often_are_dealt(spark):
    """A line between other lines, often in three texts: few classes, many segments."""
    rng = random.Random(10)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    line = word(420)
    rows = [(i, "\n".join(x for _ in range(80) for x in (line, word(rng.randint(200, 500))))) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = column_bwt.drop_repeats(docs, crowd=16).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == repeated_bytes(rows)
    assert all(r.n_spans >= 80 for r in got)
    places = [(bytes([t]), 7, 1000 * k) for t in range(3) for k in range(400)] + [(b"other", 8, 5)]
    dealt = column_bwt.deal(spark.createDataFrame(places, "digest binary, anchor long, start long"), 64)
    tiles = {tuple(r) for r in dealt.groupBy("anchor", "tile", "crowd").count().collect()}
    assert sum(n for *_, n in tiles) == 1201 and len([t for t in tiles if t[0] == 7]) == 19
    assert all(crowd == 1200 and n < 128 for anchor, _, crowd, n in tiles if anchor == 7)
    assert [(crowd, n) for anchor, _, crowd, n in tiles if anchor == 8] == [(0, 1)]


def test_automaton_gives_matching_statistics():
    rng = random.Random(5)
    known = [[rng.randrange(3) for _ in range(40)] for _ in range(3)]
    automaton = substring_dedup.Automaton()
    for k in known:
        automaton.add(k)
    text = [rng.randrange(3) for _ in range(80)]
    inside = lambda s: any(k[i : i + len(s)] == s for k in known for i in range(len(k) - len(s) + 1))
    want = [max(n for n in range(i + 2) if inside(text[i + 1 - n : i + 1])) for i in range(80)]
    assert automaton.lengths(text) == want


def test_columns_find_shared_windows():
    rng = np.random.default_rng(6)
    base = rng.integers(97, 100, column_bwt.WIDTH).astype(np.uint8)
    rows = np.tile(base, (6, 1))
    rows[1, 100] = rows[2, 700] = rows[4, 0] = 65
    rows[3] = rng.integers(97, 123, column_bwt.WIDTH)
    rows[3, column_bwt.REACH : column_bwt.REACH + column_bwt.GRAM] = base[column_bwt.REACH : column_bwt.REACH + column_bwt.GRAM]
    left = np.array([336, 336, 336, 336, 200, 336])
    right = np.array([336, 336, 336, 336, 336, 90])
    group = np.array([0, 0, 0, 0, 0, 1])
    flags, later = column_bwt.shared_windows(rows, left, right, group)
    assert not (later & ~flags).any()
    for i in range(6):
        for back in range(column_bwt.REACH + 1):
            a = column_bwt.REACH - back
            fits = lambda j: back <= left[j] and 400 - back - column_bwt.GRAM <= right[j]
            same = any(
                j != i and group[i] == group[j] and fits(i) and fits(j) and (rows[i, a : a + 400] == rows[j, a : a + 400]).all()
                for j in range(6)
            )
            assert flags[i, back] == same


def test_equal_windows_choose_equal_anchors():
    rng = np.random.default_rng(7)
    shared = rng.integers(0, 2**62, 60).astype(np.uint64)
    found = []
    for n in (3, 90):
        values = np.concatenate([rng.integers(0, 2**62, n).astype(np.uint64), shared, rng.integers(0, 2**62, 40).astype(np.uint64)])
        _, at, keys = rolling.anchors(values, np.array([0, len(values)]), 16, 50)
        found.append({(int(a) - n, int(k)) for a, k in zip(at, keys) if n <= a <= n + 60 - 16})
    for first in range(11):
        inside = [{x for x in f if first <= x[0] <= first + 34} for f in found]
        assert inside[0] & inside[1]


def thue_morse(n, first):
    return "".join("ab"[(bin(i).count("1") + first) % 2] for i in range(n))


def test_words_made_to_coincide_stay_apart(spark):
    """Long words of two letters, whose polynomials modulo any power of two up to 2^64 are equal."""
    one, two = thue_morse(2048, 0), thue_morse(2048, 1)
    rest = " ".join(f"w{i}" for i in range(60))
    rows = [(1, " ".join([one] * 50)), (2, " ".join([two] * 50)), (3, f"{one} {rest}"), (4, f"{two} {rest}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.drop_repeats(docs).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == repeated_words(rows)
    got = ngram_join.similar_groups(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == gram_groups(rows)
    assert gram_groups(rows)[1][2] == 2


BIG = [2**62 + 5, 2**63 - 1, -(2**62), 0, 2**62 + 1000, -(2**63) + 7]


@pytest.mark.parametrize("unknown", [0, 2])
def test_ids_of_the_whole_long_range(spark, unknown):
    words_ = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*words_[:-1], f"end{k}"])) for k, i in enumerate(BIG)]
    rows += [(None, " ".join([*words_[:-1], f"none{k}"])) for k in range(unknown)] + [(2**62 + 9, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.drop_repeats(docs).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got if r.doc_id is not None) == repeated_words(rows)
    assert [r.n_removed for r in got if r.doc_id is None] == [119] * unknown  # after all known ids
    got = column_bwt.drop_repeats(docs).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == repeated_bytes(rows)
    got = ngram_join.similar_groups(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == gram_groups(rows)
    assert [r.component_id for r in got if r.doc_id is None] == [min(BIG)] * unknown
    assert sorted(r.doc_id for r in ngram_join.drop_similar(docs).collect() if r.doc_id is not None) == [min(BIG), 2**62 + 9]


def test_texts_of_one_id_link_each(spark):
    left, right = ([f"{c}{i}" for i in range(60)] for c in "ab")
    rows = [(5, " ".join(left)), (5, " ".join(right)), (8, " ".join([*left, "z"])), (9, " ".join([*right, "z"]))]
    got = ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(5, 5), (5, 5), (8, 5), (9, 5)]


def test_similar_sizes_are_at_most_one_band_apart():
    band = lambda n: int(np.floor(np.log(n) / np.log(ngram_join.BAND)))
    for n in [*range(1, 5000), 10**6, 10**9]:
        most = 100 * n // ngram_join.PERCENT
        assert band(most) - band(n) in (0, 1)


def test_crowded_buckets_of_many_sizes(spark, monkeypatch):
    """Prefixes of one text fall into common buckets: chains of links over bands of size."""
    monkeypatch.setattr(ngram_join, "TILE", 3)
    rng = random.Random(4)
    words_ = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(k, " ".join(words_[: 12 + k * 9])) for k in range(43)] + [(100 + k, " ".join(words_[k * 7 :])) for k in range(30)]
    got = ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == gram_groups(rows)
