"""Multi-index Hamming join of MinHash signatures against all pairs of full sets."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, documents, empty, words

from wayfact.llm import minhash


def set_by_hand(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    found = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in lowered).split(" ") if w]
    return {tuple(found[i : i + 2]) for i in range(len(found) - 1)} or ({tuple(found)} if found else set())


def components_by_hand(rows):
    sets = [(i, set_by_hand(text)) for i, text in rows]
    group = {i: i for i, _ in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            low, high = sorted((root(a), root(b)))
            group[high] = low
    return {i: (len(s), root(i), root(i) == i) for i, s in sets}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in frame.collect()}


def changed(draw, text, share):
    return " ".join(w if draw.random() > share else f"n{draw.randrange(10**9)}" for w in text.split(" "))


def test_same_as_all_pairs(spark):
    draw = random.Random(3)
    rows = [(0, None), (1, ""), (2, "One"), (3, "one"), (4, "one two"), (5, "one\ttwo "), (6, "one two three")]
    for seed in range(12):
        base = words(draw.choice([4, 6, 9, 40, 150]), seed)
        for share in (0, 0.01, 0.03, 0.05, 0.06, 0.08, 0.1, 0.3):
            rows.append((len(rows), changed(draw, base, share)))
    draw.shuffle(rows)
    assert found(minhash.minhash_components(documents(spark, rows))) == components_by_hand(rows)


def test_lone_pairs_just_above_the_bound_are_found(spark):
    """100 pairs of 90 and 100 shingles each: 80 and 81 percent of the union shared."""
    rows, expected = [], {}
    for seed in range(100):
        whole = words(101, seed).split(" ")
        cut = 80 + seed % 2
        rows += [(2 * seed, " ".join(whole)), (2 * seed + 1, " ".join(whole[: cut + 1]))]
        expected |= {2 * seed: 2 * seed, 2 * seed + 1: 2 * seed}
    got = found(minhash.minhash_components(documents(spark, rows)))
    assert {i: c for i, (_, c, _) in got.items()} == expected


def test_a_pair_below_the_bound_is_not_linked(spark):
    whole = words(101, 1).split(" ")
    got = found(minhash.minhash_components(documents(spark, [(1, " ".join(whole)), (2, " ".join(whole[:80]))])))
    assert got == {1: (100, 1, True), 2: (79, 2, True)}


def test_links_past_the_smallest_member_count(spark):
    """Each is like its neighbours only, so groups come from chains."""
    whole = words(400, 5).split(" ")
    rows = [(100 - i, " ".join(whole[8 * i : 8 * i + 101])) for i in range(30)]
    assert components_by_hand(rows)[100][1] == 71
    assert found(minhash.minhash_components(documents(spark, rows))) == components_by_hand(rows)


def test_a_large_group_makes_few_pairs(spark, monkeypatch):
    draw = random.Random(9)
    base = words(120, 7)
    rows = [(i, changed(draw, base, 0.015)) for i in range(400)]
    sizes = []
    confirm = minhash.confirmed

    def counted(pairs, *rest):
        sizes.append(pairs.count())
        return confirm(pairs, *rest)

    monkeypatch.setattr(minhash, "confirmed", counted)
    got = found(minhash.minhash_components(documents(spark, rows)))
    assert got == components_by_hand(rows)
    assert sum(sizes) < 10 * len(rows)


def test_guaranteed_distance(spark):
    """Signatures that differ in ``GUARANTEED`` positions share a key, however they are placed."""
    draw = random.Random(4)
    rows = []
    for i in range(200):
        lanes = [draw.randrange(1 << minhash.BITS) for _ in range(minhash.POSITIONS)]
        other = list(lanes)
        for at in draw.sample(range(minhash.POSITIONS), minhash.GUARANTEED):
            other[at] ^= draw.randrange(1, 1 << minhash.BITS)
        for values in (lanes, other):
            chunks = [values[a : a + minhash.CHUNK] for a in range(0, minhash.POSITIONS, minhash.CHUNK)]
            rows.append((i, *(sum(v << (minhash.BITS * s) for s, v in enumerate(c)) for c in chunks)))
    frame = spark.createDataFrame(rows, "i bigint, " + ", ".join(f"{c} bigint" for c in minhash.SIGNATURE))
    keyed = frame.select("i", minhash.keys().alias("k"))
    pairs = keyed.groupBy("i").agg({"k": "collect_list"}).toDF("i", "both").collect()
    assert all(set(a) & set(b) for a, b in (r.both for r in pairs))
    a, b = frame.alias("a"), frame.alias("b")
    far = a.join(b, "i").select(minhash.distance("a", "b").alias("d")).collect()
    assert sorted({r.d for r in far}) == [0, minhash.GUARANTEED]


def test_signatures_estimate_the_similarity():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 3000).astype(np.uint64)
    left, right = hashes[:2700], hashes[300:]  # 0.8 of the union
    packed = [minhash.minima(h, np.array([0, len(h)]))[0] for h in (left, right)]
    lanes = [[(v >> (minhash.BITS * s)) & minhash.LANE for v in p.tolist() for s in range(minhash.CHUNK)] for p in packed]
    assert 0.6 < np.mean([x == y for x, y in zip(*lanes)]) < 0.97


@pytest.mark.parametrize("size", [1, 2, 3])
def test_shingles_of_short_texts(size):
    texts = pa.array(["", " \t", "a", "a b", "a b c", "A  B\nC"])
    hashes, bounds = minhash.shingles(texts, size)
    sets = [set(hashes[a:b].tolist()) for a, b in itertools.pairwise(bounds)]
    assert [len(s) for s in sets] == [0, 0, *(max(1, n - size + 1) for n in (1, 2, 3, 3))]
    assert sets[4] == sets[5] and not sets[2] & sets[3] - (sets[2] if size == 1 else set())


def test_awkward_rows(spark):
    rows = minhash.minhash_components(awkward(spark)).collect()
    assert len(rows) == 11 and set(rows[0].asDict()) == {"doc_id", "n_shingles", "component_id", "kept"}
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by_id[i].component_id for i in range(1, 9)] == [1, 2, 3, 4, 4, 6, 7, 8]
    assert [by_id[i].n_shingles for i in (1, 2, 3, 7)] == [0, 0, 0, 1] and by_id[6].n_shingles == 29_999
    assert not by_id[5].kept and by_id[4].kept and by_id[2].kept
    assert all(r.component_id is None and not r.kept for r in rows if r.doc_id is None)
    assert minhash.minhash_components(empty(spark)).count() == 0


def test_a_repeated_id_joins_its_texts(spark):
    rows = [(4, words(30, 1)), (4, words(30, 2)), (7, words(30, 1)), (5, words(30, 2)), (9, words(30, 3)), (9, words(30, 2)), (8, words(30, 3))]
    got = minhash.minhash_components(documents(spark, rows)).collect()
    assert {r.component_id for r in got} == {4} and sum(r.kept for r in got) == 2
