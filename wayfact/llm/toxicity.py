"""Toxic passages as maximum-scoring segments of token log-odds.

Token log-odds between toxic and other labelled texts carry a Dirichlet prior. A linear
scan finds every maximal segment of positive score; extreme-value statistics of clean
texts say how many segments that good a text of this length would have by chance, and a
two-parameter fit turns the evidence of all significant segments into a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wayfact.llm.common import Memo, byte_texts, ids_and_texts, map_batches, with_ids
from wayfact.llm.folds import held_out, training_labels
from wayfact.session import materialize

BUCKETS = 1 << 18  # two counts a bucket; the model's size does not follow the vocabulary
PREFIXES = (4, 5, 6)
PRIOR_TOKENS = 10_000.0
MIN_Z = 4.0
DRIFT = 0.7  # taken from every token, so that a random text drifts downwards
MAX_CHANCE = 0.05  # expected segments as good by chance, for a segment to be significant
BINS = 64
BIN_WIDTH = 0.125

_TRIM = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


def features(word: bytes) -> tuple[int, ...]:
    """Buckets of a word, lower-cased and without punctuation at its ends, and of its beginnings."""
    text = word.strip(_TRIM).decode("utf-8", "replace").lower()
    if not text:
        return ()
    names = [f"w {text}", *(f"{n} {text[:n]}" for n in PREFIXES if len(text) >= n)]
    return tuple(xxhash.xxh32_intdigest(name) & (BUCKETS - 1) for name in names)


def _count(batches):
    """Per bucket the occurrences in clean and in toxic texts, at most one row a task."""
    counts = np.zeros((2, BUCKETS), np.int64)
    tokens = np.zeros(2, np.int64)
    memo = Memo(features)
    for batch in batches:
        for label, text in zip(batch.column("label").to_pylist(), byte_texts(batch)):
            found = [f for f in map(memo.__getitem__, text.split()) if f]
            tokens[label] += len(found)
            flat = np.fromiter((b for own in found for b in own), np.int64)
            np.add.at(counts[label], flat, 1)
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.record_batch(
        {
            "bucket": pa.array(np.append(used, -1).astype(np.int32)),
            "clean": pa.array(np.append(counts[0][used], tokens[0])),
            "toxic": pa.array(np.append(counts[1][used], tokens[1])),
        }
    )


def log_odds(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds per bucket and their z-scores, the prior being the buckets' common share."""
    prior = PRIOR_TOKENS * (clean + toxic + 0.01) / (n_clean + n_toxic + 1)
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (n_toxic + PRIOR_TOKENS)) - np.log(b / (n_clean + PRIOR_TOKENS))
    return odds, odds / np.sqrt(1 / a + 1 / b)


@dataclass
class TokenModel:
    odds: np.ndarray
    z: np.ndarray

    def score(self, word: bytes) -> float:
        """Log-odds of the word's clearest feature less the drift; unclear ones count nothing."""
        buckets = features(word)
        if not buckets:
            return 0.0
        clearest = max(buckets, key=lambda b: abs(self.z[b]))
        value = float(self.odds[clearest]) if abs(self.z[clearest]) >= MIN_Z else 0.0
        return min(value, BINS * BIN_WIDTH) - DRIFT


def fit_tokens(texts: DataFrame, labels: DataFrame) -> TokenModel:
    """Counts over all labelled texts; neutral where one label is missing."""
    rows = (
        map_batches(
            with_ids(texts, labels, "inner", F.lit(2)).select("label", "text"),
            _count,
            "bucket int, clean bigint, toxic bigint",
        )
        .groupBy("bucket")
        .agg(F.sum("clean"), F.sum("toxic"))
        .collect()
    )
    clean, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    n_clean = n_toxic = 0
    for bucket, a, b in rows:
        if bucket < 0:
            n_clean, n_toxic = a, b
        else:
            clean[bucket], toxic[bucket] = a, b
    if not n_clean or not n_toxic:
        return TokenModel(np.zeros(BUCKETS), np.zeros(BUCKETS))
    odds, z = log_odds(clean, toxic, n_clean, n_toxic)
    return TokenModel(odds.astype(np.float32), z.astype(np.float32))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in linear time.

    Each positive run starts as a segment; a new one is joined to the nearest earlier one
    that begins lower and ends lower in the running total, and the search goes on with the
    joined segment. Segments do not overlap and their scores are positive.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    totals = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[list] = []  # start, end, total before it, total at its end, nearest lower start
    for place in positive.tolist():
        new = [place, place + 1, totals[place], totals[place + 1]]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= new[3]:
                break
            new = [stack[j][0], new[1], stack[j][2], new[3]]
            del stack[j:]
        stack.append([*new, j])
    return [(start, end, float(high - low)) for start, end, low, high, _ in stack]


def scan_texts(texts: DataFrame, model: TokenModel) -> DataFrame:
    """doc_id, n_tokens, the scores and places of all maximal segments, and counts of token scores."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        model = shared.value
        memo = Memo(model.score)
        for batch in batches:
            n, starts, ends, scores, bins = [], [], [], [], []
            for text in byte_texts(batch):
                words = text.split()
                values = np.fromiter(map(memo.__getitem__, words), np.float64, len(words))
                found = maximal_segments(values)
                n.append(len(words))
                starts.append([s for s, _, _ in found])
                ends.append([e for _, e, _ in found])
                scores.append([x for _, _, x in found])
                own = values[values > 0]
                counts = np.bincount(np.minimum(own / BIN_WIDTH, BINS - 1).astype(int), minlength=BINS)
                bins.append(counts.tolist() if len(own) else [])
            longs, doubles = pa.list_(pa.int64()), pa.list_(pa.float64())
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array(n, pa.int64()),
                    "starts": pa.array(starts, longs),
                    "ends": pa.array(ends, longs),
                    "scores": pa.array(scores, doubles),
                    "bins": pa.array(bins, longs),
                }
            )

    schema = (
        "doc_id bigint, n_tokens bigint, starts array<bigint>, ends array<bigint>, "
        "scores array<double>, bins array<bigint>"
    )
    return map_batches(texts, scan, schema)


def extreme_value_fit(scanned_clean: DataFrame) -> tuple[float, float]:
    """lambda and K of the extreme-value law of clean texts.

    lambda makes the mean of exp(lambda * score) over their tokens one; K makes the
    expected number of segments above zero the number found.
    """
    totals = scanned_clean.agg(
        F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.size("scores")), F.lit(0)).alias("segments"),
    ).first()
    counts = np.zeros(BINS)
    binned = scanned_clean.select(F.posexplode("bins").alias("bin", "n")).groupBy("bin").agg(F.sum("n"))
    for place, n in binned.collect():
        counts[place] = n
    n = max(1, totals["n"])
    shares = (counts + 0.5 / BINS) / (n + 0.5)
    values = (np.arange(BINS) + 0.5) * BIN_WIDTH
    rest = max(1e-9, 1 - shares.sum())

    def excess(rate: float) -> float:
        return float((shares * np.exp(rate * values)).sum() + rest * math.exp(-rate * DRIFT) - 1)

    low, high = 1e-3, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high, (totals["segments"] + 0.5) / n


def with_evidence(scanned: DataFrame, rate: float, k: float) -> DataFrame:
    """Adds the significant passages and evidence: minus log of the chance of segments as good.

    Significant segments add up; a text without one keeps that of its best segment.
    """
    size = F.greatest("n_tokens", F.lit(1)) * F.lit(k)
    chance = F.transform("scores", lambda s: size * F.exp(-F.lit(rate) * s))
    significant = F.filter(
        F.arrays_zip("starts", "ends", "scores"),
        lambda x: size * F.exp(-F.lit(rate) * x["scores"]) <= MAX_CHANCE,
    )
    log_chance = F.transform(chance, lambda e: -F.log(-F.expm1(-F.greatest(e, F.lit(1e-300)))))
    best = F.coalesce(F.array_max(log_chance), F.lit(0.0))
    total = F.aggregate(
        F.filter(log_chance, lambda v: v >= -math.log(-math.expm1(-MAX_CHANCE))),
        F.lit(0.0),
        lambda a, v: a + v,
    )
    return scanned.withColumns({"passages": significant, "evidence": F.least(F.greatest(best, total), F.lit(400.0))})


def fit_scores(judged: DataFrame) -> tuple[float, float]:
    """Slope and intercept of the score's log-odds, from counts of labelled texts by evidence."""
    place = F.least((F.log1p("evidence") * 40).cast("int"), F.lit(300))
    rows = judged.groupBy(place.alias("place"), "label").count().collect()
    if not rows:
        return 1.0, -3.0
    x = np.array([(place + 0.5) / 40 for place, _, _ in rows])
    y, n = np.array([label for _, label, _ in rows]), np.array([float(c) for _, _, c in rows])
    slope, intercept = 1.0, -3.0
    for _ in range(100):  # Newton steps with a weak prior on the slope
        p = 1 / (1 + np.exp(-(slope * x + intercept)))
        weight = n * p * (1 - p)
        gradient = np.array([(n * (y - p) * x).sum() - 0.01 * slope, (n * (y - p)).sum() - 0.01 * intercept])
        hessian = np.array(
            [[(weight * x * x).sum() + 0.01, (weight * x).sum()], [(weight * x).sum(), weight.sum() + 0.01]]
        )
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        slope, intercept = slope + step[0], intercept + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(slope), 1e-3), float(intercept)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and passages (starts, ends in words, scores).

    One row per row of ``docs``. Only labels outside the held-out fold are learned from.
    Null and empty texts have no passage and the score of no evidence. Without labels of
    both kinds no token counts and every score is that of no evidence. Rows without a
    doc_id are scored and not held out; repeated rows are scored alike.
    """
    texts = ids_and_texts(docs)
    known = materialize(training_labels(labels, "toxic"), "labels")
    scanned = materialize(scan_texts(texts, fit_tokens(texts, known)), "scanned")
    labelled = with_ids(scanned, known, "inner", F.lit(2))
    rate, k = extreme_value_fit(labelled.where("label = 0"))
    slope, intercept = fit_scores(with_evidence(labelled, rate, k))
    judged = with_evidence(scanned, rate, k)
    score = 1 / (1 + F.exp(-(F.lit(slope) * F.log1p("evidence") + F.lit(intercept))))
    scored = judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), "passages")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")
