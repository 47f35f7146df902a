"""Classifiers on the demand table and on trips, fitted by Spark ML."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wayfact.functions import conditions, exact
from wayfact.operators import evaluation
from wayfact.operators.clean import drop_nulls
from wayfact.operators.demand import HIGH, NORMAL
from wayfact.session import materialize

# Fixed values.
CATEGORICAL = ("pickup_day_of_week", "pickup_borough", "weather_condition")
NUMERIC = (
    "temperature_c",
    "precipitation_mm",
    "relative_humidity_pct",
    "wind_speed_mps",
    "pickup_hour_of_day",
    "pickup_month",
    "is_weekday",
    "rush_hour_indicator",
    "snow_indicator",
    "heavy_rain_indicator",
    "precipitation_trace_indicator",
)
TIP_FEATURES = ("trip_distance_miles", "fare_amount", "passenger_count", "hour")
TIP_KEYS = ("pickup_timestamp", "dropoff_timestamp", "pickup_location_id")
DEMAND_KEYS = ("pickup_hour", "pickup_borough")
REGULARIZATION = 0.05
LOGISTIC, FOREST = "Logistic Regression", "Random Forest"
SEED = 42
METRICS_SCHEMA = (
    "model string, test_rows bigint, true_positive bigint, true_negative bigint, "
    "false_positive bigint, false_negative bigint, accuracy double, precision double, "
    "recall double, f1_score double, roc_auc double"
)
FEATURE_SCHEMA = "model string, feature string, value double, signed boolean"


def preparation_stages(
    categorical: Sequence[str] = CATEGORICAL, numeric: Sequence[str] = NUMERIC
) -> list:
    """Index and encode categories, impute numbers by median, assemble features."""
    indexed = [f"{name}_index" for name in categorical]
    encoded = [f"{name}_ohe" for name in categorical]
    imputed = [f"{name}_imputed" for name in numeric]
    return [
        StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep", dropLast=True),
        Imputer(inputCols=list(numeric), outputCols=imputed, strategy="median"),
        VectorAssembler(inputCols=imputed + encoded, outputCol="features", handleInvalid="keep"),
    ]


def logistic_pipeline(max_iter: int = 100, reg: float = REGULARIZATION) -> Pipeline:
    return Pipeline(
        stages=[
            *preparation_stages(),
            StandardScaler(
                inputCol="features", outputCol="scaled_features", withMean=False, withStd=True
            ),
            LogisticRegression(
                labelCol="label",
                featuresCol="scaled_features",
                maxIter=max_iter,
                regParam=reg,
                elasticNetParam=0.0,
                standardization=False,
            ),
        ]
    )


def forest_pipeline(trees: int = 150, depth: int = 12) -> Pipeline:
    return Pipeline(
        stages=[
            *preparation_stages(),
            RandomForestClassifier(
                labelCol="label",
                featuresCol="features",
                numTrees=trees,
                maxDepth=depth,
                maxBins=64,
                featureSubsetStrategy="sqrt",
                seed=SEED,
            ),
        ]
    )


def confusion_counts(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """The four outcome counts in one pass."""
    actual, guess = F.col(label) == 1, F.col(prediction) == 1
    return predictions.agg(
        F.count_if(actual & guess).alias("true_positive"),
        F.count_if(~actual & ~guess).alias("true_negative"),
        F.count_if(~actual & guess).alias("false_positive"),
        F.count_if(actual & ~guess).alias("false_negative"),
    )


def binary_metrics(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts, accuracy, precision, recall and F1; zero on an empty denominator."""
    counts = confusion_counts(predictions, label, prediction)
    everything = "(true_positive + true_negative + false_positive + false_negative)"

    def rate(part: str, whole: str) -> Column:
        return F.coalesce(exact.ratio(part, whole, 6), F.lit(0.0))

    return counts.select(
        F.expr(everything).alias("test_rows"),
        "*",
        rate("true_positive + true_negative", everything).alias("accuracy"),
        rate("true_positive", "true_positive + false_positive").alias("precision"),
        rate("true_positive", "true_positive + false_negative").alias("recall"),
        # harmonic mean of precision and recall, in counts
        rate("2 * true_positive", "2 * true_positive + false_positive + false_negative").alias(
            "f1_score"
        ),
    )


def confusion_long(metrics: DataFrame, positive: str = HIGH, negative: str = NORMAL) -> DataFrame:
    """One row per actual and predicted class."""
    cells = (
        (positive, positive, "true_positive"),
        (positive, negative, "false_negative"),
        (negative, positive, "false_positive"),
        (negative, negative, "true_negative"),
    )
    rows = [
        F.struct(
            F.lit(actual).alias("actual"),
            F.lit(predicted).alias("predicted"),
            F.col(name).alias("count"),
        )
        for actual, predicted, name in cells
    ]
    return metrics.select("model", F.inline(F.array(*rows)))


def area_under_roc(predictions: DataFrame, label: str = "label") -> float:
    """The exact area; zero if a class is absent."""
    scored = predictions.select(label, vector_to_array("rawPrediction")[1].alias("score"))
    row = evaluation.areas_under_roc(scored, label, ["score"]).first()
    return float(row["area"] or 0.0) if row else 0.0


def feature_names(predictions: DataFrame, column: str = "features") -> list[str]:
    """Names of the slots of an assembled vector, from the column's metadata."""
    groups = predictions.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = {slot["idx"]: slot["name"] for group in groups for slot in group}
    return [slots[index] for index in sorted(slots)]


def ranked_features(weights: DataFrame) -> DataFrame:
    """Rank features of each model by absolute weight."""
    order = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return weights.select(
        "model",
        "feature",
        F.round(F.abs("value"), 8).alias("importance"),
        F.when(F.col("signed"), F.round("value", 8)).alias("signed_coefficient"),
    ).withColumn("rank", F.row_number().over(order))


@dataclass
class Fitted:
    """A fitted model with its metrics row and feature weights."""

    name: str
    model: PipelineModel
    metrics: tuple
    weights: list[tuple]
    seconds: float  # wall time, kept out of the result tables


def fit_and_score(
    name: str, pipeline: Pipeline, train: DataFrame, test: DataFrame
) -> Fitted:
    """Fit on ``train`` and score on ``test``; both are demand tables."""
    started = time.perf_counter()
    model = pipeline.fit(train)
    scored = model.transform(test).select("features", "label", "rawPrediction", "prediction")
    predictions = materialize(scored, "predictions")
    row = binary_metrics(predictions, "label", "prediction").first()
    seconds = round(time.perf_counter() - started, 3)
    auc = round(float(area_under_roc(predictions)), 6) if row["test_rows"] else 0.0
    stage = model.stages[-1]
    signed = hasattr(stage, "coefficients")
    values = stage.coefficients if signed else stage.featureImportances
    names = feature_names(scored)
    order = (
        "test_rows",
        "true_positive",
        "true_negative",
        "false_positive",
        "false_negative",
        "accuracy",
        "precision",
        "recall",
        "f1_score",
    )
    return Fitted(
        name,
        model,
        (name, *[row[key] for key in order], auc),
        [(name, slot, float(value), signed) for slot, value in zip(names, values.toArray())],
        seconds,
    )


def fit_demand_models(
    labelled: DataFrame, trees: int = 150, depth: int = 12, max_iter: int = 100
) -> list[Fitted]:
    """Both classifiers on the labelled demand table."""
    labelled = materialize(labelled, "labelled")
    train, test = (labelled.where(F.col("dataset_split") == part) for part in ("train", "test"))
    return [
        fit_and_score(LOGISTIC, logistic_pipeline(max_iter), train, test),
        fit_and_score(FOREST, forest_pipeline(trees, depth), train, test),
    ]


def model_comparison(spark: SparkSession, fitted: Sequence[Fitted]) -> DataFrame:
    """Metrics of the fitted models, best F1 first."""
    rows = [f.metrics for f in fitted]
    return spark.createDataFrame(rows, METRICS_SCHEMA).orderBy(F.desc("f1_score"), "model")


def feature_weights(spark: SparkSession, fitted: Sequence[Fitted]) -> DataFrame:
    rows = [row for f in fitted for row in f.weights]
    return ranked_features(spark.createDataFrame(rows, FEATURE_SCHEMA))


def score_stored(path: str, rows: DataFrame) -> DataFrame:
    """``rows`` with the probability and prediction of a stored pipeline; it may come from another job."""
    scored = PipelineModel.load(path).transform(rows)
    return scored.select(*rows.columns, vector_to_array("probability")[1].alias("probability"), "prediction")


def runtimes(spark: SparkSession, fitted: Sequence[Fitted]) -> DataFrame:
    """Wall time of each fit with its scoring."""
    return spark.createDataFrame([(f.name, f.seconds) for f in fitted], "model string, runtime_seconds double")


def permutation_ranks(fitted: Sequence[Fitted], test: DataFrame) -> DataFrame:
    """Importance of each input column by shuffling it, ranked for each model."""
    columns = [*NUMERIC, *CATEGORICAL]
    found = None
    for fit in fitted:
        ranks = evaluation.permutation_importance(fit.model, test, DEMAND_KEYS, columns, "label", SEED)
        ranks = ranks.select(F.lit(fit.name).alias("model"), "*")
        found = ranks if found is None else found.unionByName(ranks)
    return found


def logistic_optimum(fit: Fitted, train: DataFrame, reg: float = REGULARIZATION) -> DataFrame:
    """Loss and gradient of a fitted logistic model over the rows it was fitted on."""
    scored = fit.model.transform(train)
    weights = fit.model.stages[-1].coefficients.toArray().tolist()
    return evaluation.logistic_certificate(scored, "scaled_features", "label", weights, reg)


def prepared_features(labelled: DataFrame, keys: Sequence[str] = DEMAND_KEYS) -> DataFrame:
    """Keys, feature and scaled value of every row and slot, fitted on the training rows."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled_features", withMean=False, withStd=True)
    fitted = Pipeline(stages=[*preparation_stages(), scaler]).fit(labelled.where("dataset_split = 'train'"))
    assembled = fitted.transform(labelled)
    return evaluation.feature_rows(assembled, keys, feature_names(assembled), "scaled_features")


def tip_target(trips: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Card trips with known features and whether any tip was given, and the ``keys`` if named."""
    rows = (
        trips.where(F.col("payment_type") == conditions.CARD)
        .where("fare_amount > 0 and trip_distance_miles > 0")
        .withColumns(
            {
                "hour": F.hour("pickup_timestamp"),
                "tipped": (F.col("tip_amount") > 0).cast("int"),
            }
        )
    )
    return drop_nulls(rows, [*TIP_FEATURES, "tipped"]).select(*keys, *TIP_FEATURES, "tipped")


def class_balance(rows: DataFrame, *targets: str) -> DataFrame:
    return rows.groupBy(*targets).agg(F.count(F.lit(1)).alias("count")).orderBy(*targets)


def tip_pipeline(max_iter: int = 10) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(TIP_FEATURES), outputCol="features"),
            LogisticRegression(featuresCol="features", labelCol="tipped", maxIter=max_iter),
        ]
    )


def split_rows(rows: DataFrame, keys: Sequence[str], train: float = 0.8, seed: int = SEED) -> list[DataFrame]:
    """Training and test rows by a hash of the keys."""
    split = evaluation.keyed_split(rows, keys, train, seed)
    return [split.where(F.col("dataset_split") == part).drop("dataset_split") for part in ("train", "test")]


def fit_tip_classifier(rows: DataFrame, keys: Sequence[str] = TIP_KEYS) -> DataFrame:
    """Fit on 80 percent of the rows; coefficients, intercept and test AUC as rows."""
    rows = materialize(rows, "tips")
    train, test = split_rows(rows, keys)
    model = tip_pipeline().fit(train)
    auc = area_under_roc(model.transform(test), "tipped")
    stage = model.stages[-1]
    found = [("coefficient", n, float(c)) for n, c in zip(TIP_FEATURES, stage.coefficients)]
    found += [("intercept", "intercept", float(stage.intercept)), ("metric", "auc", float(auc))]
    return rows.sparkSession.createDataFrame(found, "kind string, name string, value double")
