"""Toxic segments and positive-unlabelled learning: brute force and held-out labels."""

import os
import zlib

import numpy as np
import pytest
from helpers import awkward, empty
from hypothesis import given, settings, strategies as st

import __spark_entry__ as entry
from wayfact.llm import common, folds, pu_quality, toxicity

DIRECTORY = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int, score string"
needs_data = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no test tables")


def segments_by_hand(scores):
    """Takes the best segment (leftmost, shortest), then does the same on either side."""
    best, spot = 0, None
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best:
                best, spot = total, (i, j + 1)
    if spot is None:
        return []
    i, j = spot
    return (
        segments_by_hand(scores[:i])
        + [(i, j, best)]
        + [(a + j, b + j, s) for a, b, s in segments_by_hand(scores[j:])]
    )


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-4, 4), max_size=24))
def test_maximal_segments(scores):
    # Distinct running totals, so that the maximal segments are unique.
    values = [1000 * s + (i * i) % 7 + 0.5 * (i % 3) + 0.001 * i + 0.3 for i, s in enumerate(scores)]
    got = toxicity.maximal_segments(np.array(values))
    expected = segments_by_hand(values)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
    assert np.allclose([s for *_, s in got], [s for *_, s in expected])


def test_folds(spark):
    rows = spark.range(-5, 50).select(folds.held_out(common.F.col("id")).alias("h"), "id").collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def judged(spark, name, label):
    labels = {r.doc_id: r[label] for r in common.table(spark, DIRECTORY, "labels").collect()}
    rows = entry.queries()[name](spark, DIRECTORY).collect()
    assert len(rows) == common.table(spark, DIRECTORY, "documents").count()
    assert all(0 <= r.score <= 1 for r in rows)
    return [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]


def area(pairs):
    good = [r.score for r, y in pairs if y == 1]
    bad = [r.score for r, y in pairs if y == 0]
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


@needs_data
def test_toxicity_on_held_out_rows(spark):
    pairs = judged(spark, "op3_toxicity", "toxic")
    assert area(pairs) > 0.85
    assert np.mean([r.predicted == y for r, y in pairs]) > 0.9
    assert all(r.predicted == (r.score >= 0.5) for r, _ in pairs)


@needs_data
def test_quality_on_held_out_rows(spark):
    pairs = judged(spark, "op6_pu_quality", "quality")
    assert area(pairs) > 0.9
    assert np.mean([r.predicted == y for r, y in pairs]) > 0.85
    assert all(r.predicted == (r.score >= 0.3) for r, _ in pairs)


def test_risk_finds_the_positives():
    draw = np.random.default_rng(1)
    shape = pu_quality.WIDTH
    positive = draw.normal(1.0, 1, (400, shape))
    unlabelled = np.concatenate((draw.normal(1.0, 1, (600, shape)), draw.normal(-1.0, 1, (400, shape))))
    model = pu_quality.fit_risk(positive, unlabelled, 0.6)
    scores = model(unlabelled)
    assert (scores[:600] > 0.5).mean() > 0.95 and (scores[600:] < 0.5).mean() > 0.95


@pytest.mark.parametrize("prior", [0.6, None])
def test_risk_over_all_rows_is_that_of_the_matrix(spark, prior):
    draw = np.random.default_rng(2)
    positive = draw.normal(0.5, 1, (200, pu_quality.WIDTH))
    unlabelled = draw.normal(0.0, 1, (900, pu_quality.WIDTH))
    rows = spark.createDataFrame([(row.tolist(),) for row in unlabelled], "features array<double>").repartition(7)
    whole, spread = (pu_quality.fit_risk(positive, u, prior) for u in (unlabelled, rows))
    assert np.allclose(whole.weights, spread.weights, atol=1e-6) and abs(whole.bias - spread.bias) < 1e-6


def test_descent_finds_the_least_value():
    draw = np.random.default_rng(3)
    root = draw.normal(size=(6, 6))
    square, at = root @ root.T + np.eye(6), draw.normal(size=6)
    found = pu_quality.descend(lambda x: ((x - at) @ square @ (x - at) / 2, square @ (x - at)), np.zeros(6))
    assert np.abs(square @ (found - at)).max() <= pu_quality.TOLERANCE


@pytest.mark.parametrize("operator", [toxicity.toxicity, pu_quality.pu_quality])
def test_models_awkward_rows(spark, operator):
    docs = awkward(spark)
    none = spark.createDataFrame([], LABELS)
    some = spark.createDataFrame(
        [(1, 1, 0, "x"), (4, 1, 1, "x"), (4, 1, 1, "x"), (5, 0, None, "x"), (None, 1, 1, "x"), (6, 1, 0, "x")], LABELS
    )
    for labels in (none, some):
        rows = operator(docs, labels).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
        assert not any(r.held_out for r in rows if r.doc_id is None)
        assert operator(empty(spark), labels).collect() == []
