"""Importance resampling against a plain computation, and CRC matrices against zlib."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import awkward, documents, empty, words
from hypothesis import given, settings, strategies as st

from wayfact.llm import importance


def features_by_hand(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = [" ".join(found[i : i + k]) for k in (1, 2, 3) for i in range(len(found) - k + 1)]
    return len(found), Counter(zlib.crc32(r.encode()) % 10_000 for r in runs)


def by_hand(rows, target):
    raw, wanted = Counter(), Counter()
    each = [(i, *features_by_hand(text)) for i, text in rows]
    for _, _, found in each:
        raw.update(found)
    for text in target:
        wanted.update(features_by_hand(text)[1])
    s_all, t_all = raw.total(), wanted.total()

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((raw[b] + 1) * (t_all + 10_000))))

    result, candidates = {}, []
    for i, n_words, found in each:
        weight = sum(n * gain(b) for b, n in found.items())
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        result[i] = [found.total(), weight, score, None]
        if n_words >= 20:
            candidates.append((-score, i))
    for rank, (_, i) in enumerate(sorted(candidates)[: 5 * len(candidates) // 100], 1):
        result[i][3] = rank
    return {i: tuple(r) for i, r in result.items()}


def found(frame):
    return {r.doc_id: (r.n_features, r.weight, r.score, r.rank) for r in frame.collect()}


def benchmark(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id bigint, text string")


def test_same_as_by_hand(spark):
    draw = random.Random(8)
    vocabulary = ["Alpha", "beta", "42", "é", "Ünd", "x_y", "a-b", "　", " z", "#", "Q" * 40] + [f"w{i}" for i in range(60)]
    target = [" ".join(draw.choices(vocabulary[:30], k=30)) for _ in range(8)] + [None, "", "!!"]
    rows = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(0, 60)))) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(2000, None), (2001, "\x00\x01 ?")]
    got = found(importance.importance_resampling(documents(spark, rows), benchmark(spark, target)))
    assert got == by_hand(rows, target)
    assert sum(v[3] is not None for v in got.values()) > 10


def test_ranks_over_many_ranges_with_ties(spark):
    rows = [(i, i % 7, 1, 30) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, score bigint, n_features bigint, n_words bigint")
    got = importance.ranked(frame, 20, "n_words >= 20").where("rank is not null").orderBy("rank").collect()
    expected = sorted(((-s, i) for i, s, _, _ in rows))[:600]
    assert [(-r.score, r.doc_id) for r in got] == expected
    assert [r["rank"] for r in got] == list(range(1, 601))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=12), max_size=20))
def test_crc_matrices(values):
    array = pa.array([*values, "x" * 3000], pa.string())
    assert importance.crc32s(array).tolist() == [zlib.crc32(v.encode()) for v in [*values, "x" * 3000]]
    assert importance.crc32s(array.slice(1)).tolist() == [zlib.crc32(v.encode()) for v in [*values, "x" * 3000][1:]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x2FF, exclude_categories=["Cs"]), max_size=30), max_size=8))
def test_words(values):
    got = importance.plain_words(pa.array(values, pa.string())).to_pylist()
    lowered = ("".join(c.lower() if c.isascii() else c for c in v) for v in values)
    assert got == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", v) for v in lowered]


def test_matrices_of_bounded_size(monkeypatch):
    monkeypatch.setattr(importance, "CELLS", 16)
    values = [f"{i:06d}" for i in range(50)]
    assert importance.crc32s(pa.array(values)).tolist() == [zlib.crc32(v.encode()) for v in values]
    assert importance.TABLE.dtype == np.uint32


def test_awkward_rows(spark):
    target = benchmark(spark, [words(40, 1)])
    rows = importance.importance_resampling(awkward(spark), target, percent=50).collect()
    assert len(rows) == 11
    assert set(rows[0].asDict()) == {"doc_id", "n_words", "n_features", "weight", "score", "rank"}
    nothing = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert all((r.n_features, r.weight, r["rank"]) == (0, 0, None) for r in nothing)
    assert all(r.score is None and r["rank"] is None for r in rows if r.doc_id is None)
    # 4 twice, 5, 6 and 8 have twenty words: two are drawn
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2]
    assert importance.importance_resampling(empty(spark), target).count() == 0
    none = importance.importance_resampling(awkward(spark), benchmark(spark, ["x"]).limit(0))
    assert none.count() == 11
