"""Quality by positive-unlabelled learning.

A linear model is fitted to trusted positives and unlabelled web text by minimising the
non-negative unbiased risk. The class prior is the least ratio of the two samples'
upper score shares. No text labelled as bad is ever used.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayfact.llm.common import byte_texts, ids_and_texts, map_batches, with_ids
from wayfact.llm.folds import held_out, training_labels
from wayfact.llm.quality_rules import repeated_words
from wayfact.session import materialize

GRAM_BUCKETS = 256
MAX_POSITIVE = 4_000  # labelled rows a model is fitted on; of unlabelled ones all count
MIN_POSITIVES_ABOVE = 0.2
PASSES = 30  # at most so many sums over all unlabelled rows a fit
TOLERANCE = 1e-2  # an early stop, which keeps scores near the threshold from saturating
SHORTEST = 1e-2
SMOOTH = 0.03
BINS = 1000
DENSE = 12
WIDTH = DENSE + GRAM_BUCKETS

_IS = {
    "symbol": b"#*$%&|<>@^~{}[]\\/_=+",
    "stop": b".!?",
    "comma": b",;:",
    "digit": b"0123456789",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
}


def text_features(text: bytes) -> np.ndarray:
    """Shares that describe a text's form, and its hashed pairs of bytes; all finite."""
    out = np.zeros(WIDTH, np.float32)
    words = text.split()
    joined = b"".join(words)
    n, size = max(1, len(words)), max(1, len(joined))
    lines = [line for line in text.split(b"\n") if line.strip()]
    shares = [(len(joined) - len(joined.translate(None, chars))) / size for chars in _IS.values()]
    out[:DENSE] = (
        *(np.sqrt(share) for share in shares),
        np.log1p(len(words)) / 10,
        size / n / 20,
        len(set(words)) / n,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        repeated_words(words) / n,
        max(map(len, words), default=0) / size,
        float(len(words) < 20),
    )
    data = np.frombuffer(text.lower(), np.uint8)
    if len(data) > 1:
        pairs = data[:-1].astype(np.uint16) * np.uint16(31421) + data[1:].astype(np.uint16) * np.uint16(6927)
        counts = np.bincount(pairs >> 8, minlength=GRAM_BUCKETS)
        out[DENSE:] = np.sqrt(counts / counts.sum())
    return out


def _features(batches):
    for batch in batches:
        rows = [text_features(text) for text in byte_texts(batch)]
        flat = np.concatenate(rows) if rows else np.zeros(0, np.float32)
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * WIDTH
        features = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "features": features})


def matrix(features: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    chunks = features.chunks if isinstance(features, pa.ChunkedArray) else [features]
    flat = np.concatenate([np.asarray(chunk.flatten()) for chunk in chunks] or [np.zeros(0)])
    return flat.reshape(-1, WIDTH).astype(np.float64)


def sample_matrix(rows: DataFrame, limit: int) -> np.ndarray:
    """At most ``limit`` feature rows, those of smallest hash of their doc_id."""
    n = rows.count()
    order = F.xxhash64("doc_id")
    if n > limit:  # a little over the share, so that few rows are ordered and sent
        share = min(1.0, 1.1 * limit / n)
        rows = rows.where(order <= int((2 * share - 1) * ((1 << 63) - 1)))
    return matrix(rows.orderBy(order, "doc_id").limit(limit).select("features").toArrow().column("features"))


class Linear:
    """Standardised features times weights; the sigmoid of the value is the score."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, bias: float) -> None:
        self.weights = weights / scale
        self.bias = bias - float(mean @ self.weights)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights + self.bias, -40, 40)))


def summed(rows: DataFrame | np.ndarray, values: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all ``rows`` of ``values``, which gives ``width`` sums for a matrix of them.

    Each task sends one sum a position, and Spark adds them by position, so the driver gets
    ``width`` numbers whatever the number of rows. A matrix is summed where it is.
    """
    if isinstance(rows, np.ndarray):
        return values(rows)

    def scan(batches):
        total = np.zeros(width)
        for batch in batches:
            total += values(matrix(batch.column("features")))
        yield pa.record_batch({"place": pa.array(range(width), pa.int32()), "total": pa.array(total)})

    found = map_batches(rows.select("features"), scan, "place int, total double").groupBy("place").agg(F.sum("total"))
    out = np.zeros(width)
    for place, total in found.collect():
        out[place] = total
    return out


def descend(function: Callable[[np.ndarray], tuple[float, np.ndarray]], point: np.ndarray) -> np.ndarray:
    """Where ``function`` (value and gradient) is least, by L-BFGS.

    A step is halved while it does not lower the value enough; ends at a small gradient,
    a short step, or after ``PASSES`` calls.
    """
    value, gradient = function(point)
    known: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=10)
    calls = 1
    while np.abs(gradient).max() > TOLERANCE:
        move, parts = -gradient, []
        for step, change in reversed(known):
            parts.append((step @ move) / (step @ change))
            move = move - parts[-1] * change
        if known:
            step, change = known[-1]
            move = move * ((step @ change) / (change @ change))
        for (step, change), part in zip(known, reversed(parts)):
            move = move + (part - (change @ move) / (step @ change)) * step
        length = 1.0 if known else min(1.0, 1 / float(np.linalg.norm(gradient)))
        while True:
            if calls >= PASSES or length < SHORTEST:
                return point
            after, slope = function(point + length * move)
            calls += 1
            if after <= value + 1e-4 * length * float(gradient @ move):
                break
            length /= 2
        if (slope - gradient) @ move > 0:
            known.append((length * move, slope - gradient))
        point, value, gradient = point + length * move, after, slope
    return point


def fit_risk(
    positive: np.ndarray, unlabelled: DataFrame | np.ndarray, prior: float | None, decay: float = 1e-3
) -> Linear:
    """Minimises the non-negative risk with logistic loss over all rows, by full-batch steps.

    With prior p the risk is p * loss(positive, +) + max(0, loss(unlabelled, -) -
    p * loss(positive, -)); where the second part is negative its gradient is reversed, by
    counting its size (within ``SMOOTH`` of 0 as a curve, so that steps can follow it).
    Without a prior the two samples are simply told apart. ``unlabelled`` are stored rows
    with ``features``, read once a step, or a matrix; the result is the same but for the
    last digits, which follow the order of sums.
    """
    sums = summed(unlabelled, lambda x: np.concatenate((x.sum(axis=0), (x * x).sum(axis=0), [len(x)])), 2 * WIDTH + 1)
    n = sums[-1]
    mean = sums[:WIDTH] / n
    scale = np.sqrt(np.maximum(0, sums[WIDTH:-1] / n - mean**2)) + 0.02
    share, opposed = (1.0, 0.0) if prior is None else (prior, prior)

    def standard(rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - mean) / scale, -8, 8)

    def pulled(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
        """Gradient of the summed loss of rows taken as negative, and that loss."""
        values = rows @ point[:-1] + point[-1]
        scores = 1 / (1 + np.exp(-np.clip(values, -40, 40)))
        return np.concatenate((scores @ rows, [scores.sum(), np.logaddexp(0, values).sum()]))

    p_rows = standard(positive)
    # The logistic losses of the two labels differ by the value itself.
    p_mean = np.append(p_rows.mean(axis=0), 1.0)

    def risk(point: np.ndarray) -> tuple[float, np.ndarray]:
        u = summed(unlabelled, lambda rows: pulled(standard(rows), point), WIDTH + 2) / n
        p = pulled(p_rows, point) / len(p_rows)
        negative = u - opposed * p
        size = np.hypot(negative[-1], SMOOTH)
        weights = np.append(point[:-1], 0.0)
        value = share * (p[-1] - p_mean @ point) + size + decay / 2 * (weights @ weights)
        gradient = share * (p[:-1] - p_mean) + negative[:-1] * (negative[-1] / size) + decay * weights
        return float(value), gradient

    point = descend(risk, np.zeros(WIDTH + 1))
    return Linear(mean, scale, point[:-1], float(point[-1]))


def scored(rows: DataFrame, model: Linear, columns: str) -> DataFrame:
    """``columns`` (a schema) of the rows with their score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [column.split()[0] for column in columns.split(", ")]

    def score(batches):
        for batch in batches:
            out = {name: batch.column(name) for name in names}
            yield pa.record_batch({**out, "score": pa.array(shared.value(matrix(batch.column("features"))))})

    return map_batches(rows.select(*names, "features"), score, f"{columns}, score double")


def class_prior(model: Linear, positive: DataFrame, unlabelled: DataFrame) -> float:
    """Share of positives among the unlabelled rows, by a model that was not fitted on them.

    Above any cut-off the unlabelled share is at least the prior times the positive share;
    the least ratio, with a margin for few rows, is the prior.
    """
    counts = np.zeros((2, BINS + 1))
    for kind, rows in enumerate((positive, unlabelled)):
        place = (F.col("score") * BINS).cast("int")
        for at, n in scored(rows, model, "doc_id bigint").groupBy(place).count().collect():
            counts[kind][at] = n
    above = np.cumsum(counts[:, ::-1], axis=1)
    n_p, n_u = above[:, -1]
    if not n_p or not n_u:
        return 0.5
    q_p, q_u = above[0] / n_p, above[1] / n_u
    margin = np.sqrt(np.log(20) / (2 * n_u)) + np.sqrt(np.log(20) / (2 * n_p))
    usable = q_p > MIN_POSITIVES_ABOVE
    bound = (q_u[usable] + margin) / q_p[usable]
    best = int(np.argmin(bound))
    return float(np.clip((q_u[usable] / q_p[usable])[best], 0.01, 0.99))


def pu_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (score of 0.3 or more), one row per row of ``docs``.

    Positives are the texts labelled good outside the held-out fold; unlabelled are the
    texts without any label. One half of both serves to tell them apart, the other half to
    estimate the prior; the model is then fitted on all unlabelled texts and at most
    ``MAX_POSITIVE`` positives. Where either is missing, every score is 0.5. Null and empty
    texts are scored by their form. Rows without a doc_id are scored and not held out;
    repeated rows are scored alike.
    """
    rows = materialize(map_batches(ids_and_texts(docs), _features, "doc_id bigint, features array<float>"), "features")
    good = training_labels(labels, "quality").where("label = 1").select("doc_id")
    positive = with_ids(rows, good, "left_semi")
    labelled = labels.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
    unlabelled = with_ids(rows.where("doc_id is not null"), labelled, "left_anti").where(~held_out(F.col("doc_id")))
    unlabelled = materialize(unlabelled, "unlabelled")  # read once a step
    p = sample_matrix(positive, MAX_POSITIVE)
    if len(p) and not unlabelled.isEmpty():
        half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0
        a = sample_matrix(positive.where(half), MAX_POSITIVE)
        b = unlabelled.where(half)
        prior = 0.5
        if len(a) and not b.isEmpty():
            prior = class_prior(fit_risk(a, b, None), positive.where(~half), unlabelled.where(~half))
        model = fit_risk(p, unlabelled, prior)
    else:
        model = Linear(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), 0.0)
    judged = scored(rows, model, "doc_id bigint")
    return judged.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
