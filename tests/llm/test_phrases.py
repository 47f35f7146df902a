"""Collocations by shards against counting everything in one place."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import SCHEMA, awkward, empty
from hypothesis import given, settings, strategies as st

from wayfact.llm import phrases


def by_hand(rows, support, longest, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\v\f\r]", lowered):
            found = [w for w in re.split(r"[ \t]", piece) if w]
            totals[lang] += len(found)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(found[i : i + k])) for i in range(len(found) - k + 1))
    result = {}
    frequent = {key: n for key, n in counts.items() if n >= support}
    for (lang, phrase), a in frequent.items():
        if len(phrase) < 2:
            continue
        longer = (
            n for (other, p), n in frequent.items()
            if other == lang and len(p) > len(phrase)
            and any(p[i : i + len(phrase)] == phrase for i in range(len(p)))
        )
        if any(n >= a for n in longer):
            continue
        cuts = []
        for k in range(1, len(phrase)):
            l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        result.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), l, r, totals[lang]))
    return {
        (lang, rank): (phrase.decode(), -a, l, r, n, -score)
        for lang, found in result.items()
        for rank, (score, a, phrase, l, r, n) in enumerate(sorted(found)[:top], 1)
    }


def found(frame):
    return {(r.lang, r.rank): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect()}


def table(spark, rows, ids=None):
    full = [(ids(i) if ids else i * 1500, text, lang, "s", None) for i, (lang, text) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def texts(seed, n=60):
    draw = random.Random(seed)
    vocabulary = ["a", "B", "c", "dd", "é", "Ü", "e f", "\x00", "x" * 300]
    ends = [" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\r\n", "\x0b", "!?", " "]
    rows = []
    for _ in range(n):
        found = (draw.choice(vocabulary[: draw.randint(2, 9)]) + draw.choice(ends) for _ in range(draw.randint(0, 60)))
        rows.append((draw.choice(["en", "en", "de", None, ""]), "".join(found)))
    return rows + [("en", None), (None, ""), ("fr", "never often")]


@pytest.mark.parametrize("seed, support, longest", [(1, 5, 5), (2, 12, 4), (3, 1, 3), (4, 30, 2)])
def test_same_as_counting_everything(spark, seed, support, longest):
    rows = texts(seed)
    got = phrases.collocations(table(spark, rows), support=support, longest=longest, top=40)
    assert found(got) == by_hand(rows, support, longest, 40)


def test_a_phrase_of_one_shard_and_one_spread_over_all(spark):
    """Both have just the support; neither's place in the table matters."""
    rows = [("en", "only here " + " ".join(f"f{i}x{j}" for j in range(9)) + (". all over" if i % 4 == 0 else "")) for i in range(120)]
    rows = [(lang, text if i < 30 else text.replace("only here", "else")) for i, (lang, text) in enumerate(rows)]
    got = found(phrases.collocations(table(spark, rows, lambda i: i * 4096), support=30))
    assert {v[0] for v in got.values()} == {"only here", "all over"}
    assert got == by_hand(rows, 30, 5, 2000)


def test_a_longer_phrase_takes_the_place_of_its_parts(spark):
    rows = [("en", "one two three four five six")] * 7 + [("en", "two three")]
    got = found(phrases.collocations(table(spark, rows), support=7))
    assert sorted(v[0] for v in got.values()) == ["one two three four five", "two three", "two three four five six"]


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000
    rows = [("en", "a", big, 1), ("en", "b", 3, 1), ("en", "a b", 3, 2)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, f bigint, size int")
    totals = spark.createDataFrame([("en", big + 3)], "lang string, n bigint")
    row = phrases.scored(frame, totals).first()
    assert (row.a, row.l, row.r, row.score) == (3, big, 3, 1000 * 3 * (big + 3) // (big * 3))
    rows = [("en", "a", big, 1), ("en", "b", big - 1, 1), ("en", "a b", big - 7, 2)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, f bigint, size int")
    row = phrases.scored(frame, totals).first()
    assert row.score == 1000 * (big - 7) * (big + 3) // (big * (big - 1))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=3, max_size=3), max_size=30))
def test_keys_are_equal_for_equal_rows_only(rows):
    columns = [np.array([r[i] for r in rows], np.int64) for i in range(3)]
    for width in (6, 1 << 40):  # the latter does not fit in one number
        keys = phrases.run_keys(columns[0], 6, columns[1:], width).tolist()
        assert len(set(zip(keys, map(tuple, rows)))) == len(set(keys)) == len(set(map(tuple, rows)))


def test_the_bit_table_holds_all_that_is_in_it(spark):
    draw = np.random.default_rng(2)
    values = draw.integers(-(1 << 63), (1 << 63) - 1, 5000)
    known = phrases.filter_of(spark.createDataFrame([(v,) for v in values.tolist()], "h bigint"))
    assert known.holds(values.view(np.uint64)).all()
    assert known.holds(draw.integers(0, 1 << 63, 5000).astype(np.uint64)).mean() < 0.1


def test_hashed_counts_are_those_of_the_words(spark):
    rows = texts(6)
    hashed = phrases.hashed_counts(phrases.prepared(table(spark, rows)))
    words = hashed.where("h = l").agg({"n": "sum"}).first()[0]
    lowered = [re.split(r"[.,;:!?\n\v\f\r]", t.lower()) for _, t in rows if t]
    sizes = [len([w for w in re.split(r"[ \t]", p) if w]) for t in lowered for p in t]
    assert words == sum(sizes)
    assert hashed.where("h <> l").agg({"n": "sum"}).first()[0] == sum(2 * n - 1 for n in sizes if n)


def test_awkward_rows(spark):
    got = phrases.collocations(awkward(spark), support=2)
    # the one text of 60 words that occurs three times, in runs of five; no text else repeats
    rows = got.collect()
    assert len(rows) == 56 and {(r.lang, r.a, r.l, r.r) for r in rows} == {("en", 3, 3, 3)}
    assert phrases.collocations(empty(spark), support=1).count() == 0
    assert phrases.collocations(awkward(spark)).count() == 0
