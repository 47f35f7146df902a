import datetime as dt

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wayfact.operators import models


def labelled(spark, rows=240):
    hour = F.col("id") % 24
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") / 24).cast("int"))
    busy = hour.between(8, 18)
    return spark.range(rows).select(
        F.date_format(day, "EEEE").alias("pickup_day_of_week"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("pickup_borough"),
        F.when(F.col("id") % 5 == 0, "Rain").otherwise("Dry").alias("weather_condition"),
        *[
            (F.when(F.col("id") % 11 == 0, None).otherwise(hour + i)).cast("double").alias(name)
            for i, name in enumerate(models.NUMERIC)
        ],
        F.when(busy, 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("id") < rows * 0.75, "train").otherwise("test").alias("dataset_split"),
    )


@pytest.fixture(scope="module")
def fitted(spark):
    return models.fit_demand_models(labelled(spark), trees=8, depth=4, max_iter=20)


def test_both_models_are_scored(spark, fitted):
    rows = models.model_comparison(spark, fitted).collect()
    assert {r.model for r in rows} == {models.LOGISTIC, models.FOREST}
    assert rows[0].f1_score >= rows[1].f1_score
    assert all(r.test_rows == 60 and 0.0 <= r.roc_auc <= 1.0 for r in rows)
    times = models.runtimes(spark, fitted).collect()
    assert len(times) == 2 and all(t.runtime_seconds > 0 for t in times)
    forest = next(r for r in rows if r.model == models.FOREST)
    assert forest.accuracy > 0.9


def test_features_are_named_and_ranked(spark, fitted):
    names = [name for _, name, _, _ in fitted[0].weights]
    assert names[:2] == ["temperature_c_imputed", "precipitation_mm_imputed"]
    assert "weather_condition_ohe_Dry" in names and len(names) == len(set(names))
    ranked = models.feature_weights(spark, fitted)
    top = ranked.where(F.col("model") == models.FOREST).orderBy("rank").collect()
    assert [r.rank for r in top] == list(range(1, len(names) + 1))
    assert top[0].importance == max(r.importance for r in top)
    assert all(r.signed_coefficient is None for r in top)
    signed = ranked.where(F.col("model") == models.LOGISTIC).collect()
    assert all(r.importance == abs(r.signed_coefficient) for r in signed)


def test_model_can_be_saved_and_read(spark, fitted, tmp_path):
    path = str(tmp_path / "m")
    fitted[1].model.write().overwrite().save(path)
    test = labelled(spark).where("dataset_split = 'test'")
    again = PipelineModel.load(path).transform(test)
    once = fitted[1].model.transform(test)
    assert [r.prediction for r in again.collect()] == [r.prediction for r in once.collect()]


def test_split_is_the_same_for_any_partitioning(spark):
    rows = spark.range(0, 1000, 1, 4)
    train, test = models.split_rows(rows, ["id"])
    again, _ = models.split_rows(rows.repartition(7).orderBy(F.desc("id")), ["id"])
    assert sorted(train.collect()) == sorted(again.collect())
    assert 750 < train.count() < 850 and train.unionByName(test).distinct().count() == 1000
    assert models.split_rows(rows, ["id"], seed=7)[0].exceptAll(train).count() > 0


def test_fit_is_near_its_optimum(spark, fitted):
    row = models.logistic_optimum(fitted[0], labelled(spark).where("dataset_split = 'train'")).first()
    assert row.row_count == 180 and row.feature_count == len(fitted[0].weights)
    assert row.gradient < 1e-2 and 0 < row.loss < 0.7


def test_every_input_is_ranked_and_a_number_first_by_the_forest(spark, fitted):
    """The label follows the hour, which all numbers carry, and nothing else."""
    test = labelled(spark).withColumn("pickup_hour", F.monotonically_increasing_id())
    rows = models.permutation_ranks(fitted, test).collect()
    for fit in fitted:
        own = [r for r in rows if r.model == fit.name]
        assert sorted(r["rank"] for r in own) == list(range(1, len(models.NUMERIC) + len(models.CATEGORICAL) + 1))
        if fit.name == models.FOREST:  # a linear model cannot follow hours in the middle of the day
            assert min(own, key=lambda r: r["rank"]).feature in models.NUMERIC


def test_prepared_features_hold_every_slot(spark):
    rows = labelled(spark).withColumn("pickup_hour", F.monotonically_increasing_id())
    found = models.prepared_features(rows)
    per_key = found.groupBy("pickup_hour", "pickup_borough").count().collect()
    assert len(per_key) == 240 and len({r["count"] for r in per_key}) == 1
    assert found.where("value is null").count() == 0


def test_metrics_are_zero_on_empty_denominators(spark):
    nothing = spark.createDataFrame([(0.0, 0.0)], "label double, prediction double")
    row = models.binary_metrics(nothing, "label", "prediction").first()
    assert (row.accuracy, row.precision, row.recall, row.f1_score) == (1.0, 0.0, 0.0, 0.0)
    empty = models.binary_metrics(nothing.limit(0), "label", "prediction").first()
    assert (empty.test_rows, empty.accuracy) == (0, 0.0)


def test_confusion_rows(spark, fitted):
    metrics = models.model_comparison(spark, fitted)
    rows = models.confusion_long(metrics).collect()
    assert len(rows) == 8 and sum(r["count"] for r in rows) == 120


def test_tip_classifier(spark):
    trips = spark.range(400).select(
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("pickup_timestamp"),
        F.col("id").alias("pickup_location_id"),
        F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz").alias("dropoff_timestamp"),
        F.lit(1).alias("payment_type"),
        (F.col("id") % 50 + 1).cast("double").alias("fare_amount"),
        (F.col("id") % 9 + 1).cast("double").alias("trip_distance_miles"),
        F.when(F.col("id") % 10 != 0, 1.0).alias("passenger_count"),
        F.when(F.col("id") % 50 > 20, 1.0).otherwise(0.0).alias("tip_amount"),
    )
    rows = models.tip_target(trips, models.TIP_KEYS)
    assert models.tip_target(trips).columns == [*models.TIP_FEATURES, "tipped"]
    assert rows.count() == 360
    assert [r.tipped for r in models.class_balance(rows, "tipped").collect()] == [0, 1]
    found = {(r.kind, r.name): r.value for r in models.fit_tip_classifier(rows).collect()}
    assert found["metric", "auc"] > 0.95 and found["coefficient", "fare_amount"] > 0
    assert len(found) == 6
