"""Quality rules: simple text measures and a hashed n-gram likelihood ratio.

The ratio compares two multinomials over hashed character n-grams: one counted over
trusted texts, one over all texts. A text's score is the mean log ratio of its n-grams;
texts below a fixed score are rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayfact.llm.common import byte_texts, ids_and_texts, keep_rows, map_batches, prepare, with_ids

GRAM = 4
BUCKETS = 1 << 16  # the model: two counts a bucket, whatever the size of the corpus
FACTORS = (44235, 13849, 40503, 1)  # weights of the code points of one n-gram
PRIOR_GRAMS = 2000.0
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_SCORE = -0.25
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text.

    Windows are named exactly: equal pairs of words get one number, then equal pairs
    of pairs, until a number stands for a whole window.
    """
    if len(words) <= window:
        return 0
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}
    if len(number) == len(words):
        return 0
    names = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    counts, span = np.bincount(names), 1
    while span < window:
        step = min(span, window - span)
        pairs = names[:-step] * (int(names.max()) + 1) + names[step:]
        _, names, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        span += step
        if counts.max() == 1:
            return 0
    starts = np.flatnonzero(counts[names] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def text_stats(text: bytes) -> tuple[int, int, int, int, int]:
    """The five measures named in ``STATS`` of one text."""
    words = text.split()
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(joined.decode("utf-8", "replace")),
        len(joined) - len(joined.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def gram_buckets(text: bytes) -> np.ndarray:
    """Bucket of each n-gram of code points; empty for shorter texts."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(points) < GRAM:
        return np.zeros(0, np.uint32)
    n = len(points) - GRAM + 1
    total = np.zeros(n, np.uint32)
    for k, factor in enumerate(FACTORS):
        total += points[k : k + n] * np.uint32(factor)  # wraps; only the low bits count
    return total & np.uint32(BUCKETS - 1)


def _count_grams(batches):
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text in byte_texts(batch):
            np.add.at(counts, gram_buckets(text), 1)
    found = np.flatnonzero(counts)
    yield pa.record_batch({"bucket": pa.array(found.astype(np.int32)), "n": pa.array(counts[found])})


def gram_counts(texts: DataFrame) -> np.ndarray:
    """n-grams per bucket over all ``texts``; each task sends at most one row a bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    rows = (
        map_batches(texts.select("text"), _count_grams, "bucket int, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    for bucket, n in rows:
        counts[bucket] = n
    return counts


def log_ratios(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio per bucket of the two multinomials.

    The trusted one has the raw one as its prior, worth ``PRIOR_GRAMS`` n-grams, so that
    few trusted texts say little. All zero when there is no trusted n-gram: no text is
    then rejected by its score.
    """
    if not trusted.sum():
        return np.zeros(len(raw))
    share = (raw + 1.0) / (raw.sum() + len(raw))
    return np.log((trusted + PRIOR_GRAMS * share) / (trusted.sum() + PRIOR_GRAMS)) - np.log(share)


def fit(docs: DataFrame, trusted_ids: DataFrame) -> np.ndarray:
    """The log ratios, from every text and from those whose doc_id is in ``trusted_ids``."""
    texts = ids_and_texts(docs)
    ids = trusted_ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    trusted = with_ids(texts, ids, "left_semi")
    return log_ratios(gram_counts(trusted), gram_counts(texts))


def judge_texts(texts: list[bytes], ratios: np.ndarray, min_score: float) -> dict[str, np.ndarray]:
    """The measures, score, base_failed and kept of each text."""
    columns = np.array([text_stats(text) for text in texts], np.int64).reshape(-1, len(STATS))
    named = {name: np.ascontiguousarray(column) for name, column in zip(STATS, columns.T)}
    score = np.zeros(len(texts))
    for i, text in enumerate(texts):
        buckets = gram_buckets(text)
        if len(buckets):
            score[i] = ratios[buckets].sum() / len(buckets)
    failed = (named["n_words"] < MIN_WORDS) | (
        100 * named["n_repeat_words"] > MAX_REPEAT_PERCENT * named["n_words"]
    )
    return {**named, "score": score, "base_failed": failed, "kept": ~failed & (score >= min_score)}


def score_documents(docs: DataFrame, ratios: np.ndarray, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures, score, base_failed, kept.

    A null text counts as empty. Texts of fewer than four characters score 0. Repeated
    rows are judged alike; a null doc_id is passed on; an empty table gives no rows.
    """
    texts = ids_and_texts(docs)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def judge(batches):
        for batch in batches:
            judged = judge_texts(byte_texts(batch), shared.value, min_score)
            columns = {name: pa.array(values) for name, values in judged.items()}
            yield pa.record_batch({"doc_id": batch.column("doc_id"), **columns})

    schema = "doc_id bigint, " + ", ".join(f"{name} bigint" for name in STATS)
    return map_batches(texts, judge, f"{schema}, score double, base_failed boolean, kept boolean")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the texts that people marked as good."""
    prepare(labels.sparkSession)
    return labels.where("quality = 1").select("doc_id").where("doc_id is not null")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document judged against the trusted ones; see ``score_documents``."""
    return score_documents(docs, fit(docs, trusted_ids(labels)))


def keep_good(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, trusted_ids(labels)))
    return keep_rows(docs, lambda texts: judge_texts(texts, shared.value, min_score)["kept"].tolist())
