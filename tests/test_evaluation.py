import itertools
import math
import random

import duckdb
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Window, functions as F

from wayfact.operators import evaluation

SCORED = "label double, first double, second double"


def by_pairs(rows, column):
    """The area by comparing every pair."""
    above = [math.inf if math.isnan(r[column]) else r[column] for r in rows if r[0] == 1 and r[column] is not None]
    below = [math.inf if math.isnan(r[column]) else r[column] for r in rows if r[0] == 0 and r[column] is not None]
    wins = sum((a > b) + (a == b) / 2 for a, b in itertools.product(above, below))
    return len(above), len(below), wins / (len(above) * len(below))


@pytest.mark.parametrize("seed, distinct", [(1, 3), (2, 40), (3, 10_000)])
def test_area_is_that_of_all_pairs(spark, seed, distinct):
    draw = random.Random(seed)
    rows = []
    for _ in range(400):
        label = float(draw.random() < 0.3)
        value = draw.choice([None, math.nan, 0.0]) if draw.random() < 0.1 else draw.randrange(distinct) / 7 + label
        rows.append((label, value, -draw.random()))
    frame = spark.createDataFrame([*rows, (None, 1.0, 1.0)], SCORED)
    found = {r.score: r for r in evaluation.areas_under_roc(frame, "label", ["first", "second"]).collect()}
    for i, name in enumerate(("first", "second"), 1):
        positives, negatives, area = by_pairs(rows, i)
        assert (found[name].positives, found[name].negatives) == (positives, negatives)
        assert abs(found[name].area - area) < 1e-12


def test_area_of_one_class_and_of_nothing(spark):
    frame = spark.createDataFrame([(1.0, 1.0, 2.0)], SCORED)
    assert [r.area for r in evaluation.areas_under_roc(frame, "label", ["first"]).collect()] == [None]
    assert evaluation.areas_under_roc(frame.limit(0), "label", ["first"]).count() == 0


def test_area_agrees_with_the_evaluator(spark):
    draw = random.Random(4)
    rows = [(float(draw.random() < 0.4), draw.gauss(0, 1), 0.0) for _ in range(3000)]
    rows = [(y, round(x + y, 2), z) for y, x, z in rows]
    frame = spark.createDataFrame(rows, SCORED)
    area = evaluation.areas_under_roc(frame, "label", ["first"]).first().area
    other = BinaryClassificationEvaluator(rawPredictionCol="first", numBins=0).evaluate(frame)
    assert abs(area - other) < 1e-9


def test_running_totals(spark):
    rows = spark.range(500).select(F.expr("id * 37 % 500").alias("k"), F.expr("id % 11").alias("v"))
    window = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    expected = rows.withColumn("v_before", F.coalesce(F.sum("v").over(window), F.lit(0)))
    got = evaluation.running_totals(rows, ["k"], ["v"])
    assert sorted(got.select("k", "v", "v_before").collect()) == sorted(expected.collect())


def test_certificate_against_sql_over_stored_probabilities(spark, tmp_path):
    draw = random.Random(5)
    rows = []
    for _ in range(500):
        a, b = draw.gauss(0, 1), draw.gauss(0, 2)
        rows.append((float(draw.random() < 1 / (1 + math.exp(-a + 0.3 * b))), a, b))
    frame = VectorAssembler(inputCols=["first", "second"], outputCol="x").transform(spark.createDataFrame(rows, SCORED))
    model = LogisticRegression(featuresCol="x", regParam=0.1, standardization=False, tol=1e-10).fit(frame)
    scored = model.transform(frame)
    weights = model.coefficients.toArray().tolist()
    row = evaluation.logistic_certificate(scored, "x", "label", weights, 0.1).first()
    assert row.gradient < 1e-5 and (row.row_count, row.feature_count) == (500, 2)
    assert abs(row.loss - model.summary.objectiveHistory[-1]) < 1e-9

    path = str(tmp_path / "scored")
    p = evaluation.vector_to_array("probability")[1]
    scored.select("label", "first", "second", p.alias("p")).write.parquet(path)
    loss, slope = duckdb.sql(
        f"""SELECT avg(-CASE WHEN label = 1 THEN ln(p) ELSE ln(1 - p) END) + 0.05 * {sum(w * w for w in weights)},
            avg((p - label) * first) + 0.1 * {weights[0]} FROM '{path}/*.parquet'"""
    ).fetchall()[0]
    assert abs(loss - row.loss) < 1e-12 and abs(slope) <= row.gradient + 1e-12
    far = evaluation.logistic_certificate(scored, "x", "label", [w + 1 for w in weights], 0.1).first()
    assert far.gradient > 0.05


def test_shuffling_deals_every_value_once(spark, monkeypatch):
    monkeypatch.setattr(evaluation, "SHUFFLE_ROWS", 100)
    rows = spark.range(1000).select("id", (F.col("id") * 3).alias("a"), F.when(F.col("id") % 4 > 0, F.col("id")).alias("b"))
    got = evaluation.shuffled(rows, ["id"], ["a", "b"], 1)
    again = evaluation.shuffled(rows.repartition(5), ["id"], ["a", "b"], 1)
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    plain = got.collect()
    for column in ("a", "b"):
        values = sorted(str(r[f"shuffled_{column}"]) for r in plain)
        assert values == sorted(str(r[column]) for r in plain)
    assert sum(r.a == r.shuffled_a for r in plain) < 20


def test_a_split_keeps_rows_of_one_key_together(spark):
    rows = spark.range(900).select((F.col("id") % 30).alias("k"), F.lit(None).cast("string").alias("n"))
    split = evaluation.keyed_split(rows, ["k", "n"], 0.5, 3)
    assert split.select("k", "dataset_split").distinct().count() == 30
    assert evaluation.keyed_split(rows, ["k"], 1.0, 3).where("dataset_split = 'test'").count() == 0
