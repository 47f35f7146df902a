"""Importance resampling towards a target distribution over hashed word runs.

The features of a text are its runs of one to three words; a feature's bucket is its CRC-32
modulo ``BUCKETS``. In a batch of texts the distinct features are grouped by equal length into
two-dimensional byte arrays, the CRCs of a group are updated column by column, and the buckets
are scattered back to where the features occur. Log ratios of the smoothed bucket shares of
target and raw texts weigh the documents, and noise from a hash of the id makes the highest
scores a sample without replacement in proportion to the weights.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from wayfact.llm.common import ids_and_texts, map_batches, prepare, split_words
from wayfact.llm.phrases import gathered, run_keys
from wayfact.session import materialize

LONGEST = 3
BUCKETS = 10_000
SCALE = 1000
SEED = 42
LEAST_WORDS = 20
PERCENT = 5
FLUSH = 4 << 20  # bytes of text hashed at once in a task
CELLS = 8 << 20  # bytes of a matrix of features
POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected


def crc_table() -> np.ndarray:
    """The change of a CRC-32 by each value of a byte."""
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(POLYNOMIAL), values >> 1).astype(np.uint32)
    return values


def byte_map() -> np.ndarray:
    """A-Z to a-z; every other byte below 0x80 that is no letter or digit to a blank."""
    lower = bytes(range(256)).lower()
    return np.array([b if b >= 0x80 or bytes([b]).isalnum() else 0x20 for b in lower], np.uint8)


TABLE, PLAIN = crc_table(), byte_map()


def raw(values: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and where each begins; the last entry is their end."""
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data, offsets


def plain_words(texts: pa.StringArray) -> pa.ListArray:
    """Lower-cased words of letters, digits and characters beyond ASCII."""
    if not len(texts):
        return split_words(texts)
    data, offsets = raw(texts)
    data = PLAIN[data[offsets[0] : offsets[-1]]]
    offsets = (offsets - offsets[0]).astype(np.int32)
    return split_words(pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(data)))


def crc32s(values: pa.StringArray) -> np.ndarray:
    """CRC-32 of each value: one matrix for all of a length, column by column."""
    if not len(values):
        return np.zeros(0, np.uint32)
    data, offsets = raw(values)
    lengths = np.diff(offsets)
    order = np.argsort(lengths, kind="stable")
    found = np.zeros(len(values), np.uint32)
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, cuts):
        length = int(lengths[group[0]])
        step = max(1, CELLS // max(length, 1))
        for a in range(0, len(group), step):
            rows = group[a : a + step]
            starts = offsets[rows]
            crcs = np.full(len(rows), 0xFFFFFFFF, np.uint32)
            for column in range(length):
                crcs = TABLE[(crcs ^ data[starts + column]) & np.uint32(0xFF)] ^ (crcs >> np.uint32(8))
            found[rows] = ~crcs
    return found


def buckets(texts: pa.StringArray, longest: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of each feature, the row of each, and the number of words of each text."""
    words = plain_words(texts)
    counts = np.asarray(pc.list_value_length(words), np.int64)
    rows = np.repeat(np.arange(len(texts)), counts)
    coded = words.flatten().dictionary_encode()
    vocabulary, codes = coded.dictionary, np.asarray(coded.indices, np.int64)
    hashed, owners = [], []
    for size in range(1, longest + 1):
        starts = np.flatnonzero(rows[: len(rows) - size + 1] == rows[size - 1 :]) if len(rows) >= size else np.zeros(0, np.int64)
        if not len(starts):
            continue
        columns = [codes[starts + i] for i in range(size)]
        keys = run_keys(np.zeros(len(starts), np.int64), 1, columns, len(vocabulary))
        _, first, place = np.unique(keys, return_index=True, return_inverse=True)
        parts = [vocabulary.take(pa.array(column[first])) for column in columns]
        features = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]
        hashed.append((crc32s(features) % n_buckets).astype(np.int64)[place])
        owners.append(rows[starts])
    nothing = [np.zeros(0, np.int64)]
    return np.concatenate(hashed or nothing), np.concatenate(owners or nothing), counts


def bucket_counts(docs: DataFrame, longest: int, n_buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket; a task sends one row a bucket."""

    def scan(batches):
        total = np.zeros(n_buckets, np.int64)
        for batch in gathered(batches, "text", FLUSH):
            total += np.bincount(buckets(batch.column("text"), longest, n_buckets)[0], minlength=n_buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(used), "n": pa.array(total[used])})

    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = map_batches(texts, scan, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(n_buckets, np.int64)
    counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return counts


def bucket_gains(raw_counts: np.ndarray, target_counts: np.ndarray) -> np.ndarray:
    """Floor of ``SCALE`` times the log of smoothed target share over smoothed raw share, by bucket."""
    size = len(raw_counts)
    s_all, t_all = float(raw_counts.sum()) + size, float(target_counts.sum()) + size
    ratios = (((t + 1.0) * s_all) / ((s + 1.0) * t_all) for s, t in zip(raw_counts.tolist(), target_counts.tolist()))
    return np.array([math.floor(SCALE * math.log(ratio)) for ratio in ratios], np.int64)


def weights(docs: DataFrame, gains: np.ndarray, longest: int) -> DataFrame:
    """doc_id, n_words, n_features and weight, one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def scan(batches):
        known = shared.value
        for batch in gathered(batches, "text", FLUSH):
            found, owners, counts = buckets(batch.column("text"), longest, len(known))
            order = np.argsort(owners, kind="stable")
            bounds = np.searchsorted(owners[order], np.arange(batch.num_rows + 1))
            sums = np.concatenate(([0], np.cumsum(known[found[order]])))[bounds]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_words": pa.array(counts),
                    "n_features": pa.array(np.diff(bounds).astype(np.int64)),
                    "weight": pa.array(np.diff(sums)),
                }
            )

    return map_batches(ids_and_texts(docs), scan, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def ranked(rows: DataFrame, percent: int, drawn: str) -> DataFrame:
    """``rows`` with rank: 1, 2, ... over the best ``percent`` of those that ``drawn`` holds for, else null.

    The candidates are dealt to tasks by ranges of score and numbered within each; the sizes
    of the ranges, one number a task, give the rest of the rank.
    """
    spark = rows.sparkSession
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_features")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.where(drawn).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = materialize(dealt.withColumn("at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("at", 33)  # the number of the task; below it the number of the row
    sizes = sorted((r["part"], r["n"]) for r in dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    limit = percent * sum(n for _, n in sizes) // 100
    ends = np.cumsum([n for _, n in sizes]).tolist()
    begins = [(p, end - n) for (p, n), end in zip(sizes, ends)]
    offsets = F.broadcast(spark.createDataFrame(begins, "part bigint, begin bigint"))
    rank = F.col("begin") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    placed = dealt.withColumn("part", part.cast("bigint")).join(offsets, "part").withColumn("rank", rank)
    placed = placed.withColumn("rank", F.when(F.col("rank") <= limit, F.col("rank"))).select(*rows.columns, "rank")
    others = rows.where(~F.coalesce(F.expr(drawn), F.lit(False)))
    return placed.unionByName(others.withColumn("rank", F.lit(None).cast("bigint")))


def importance_resampling(
    docs: DataFrame,
    target: DataFrame,
    longest: int = LONGEST,
    n_buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank, one row per row of ``docs``.

    Drawn are the best ``percent`` of the documents with ``least_words`` words, by score, ties
    to the smaller doc_id, then to fewer features; rank is null for all others. Null texts
    have no words, features or weight. A row without a doc_id has no noise: its score is null
    and it is not a candidate. Repeated rows are candidates each. Without target texts all
    gains come from the raw texts alone; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    gains = bucket_gains(bucket_counts(docs, longest, n_buckets), bucket_counts(target, longest, n_buckets))
    rows = weights(docs, gains, longest)
    digits = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digits, 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    rows = materialize(rows.withColumn("score", (F.col("weight") + noise).cast("bigint")), "scores")
    return ranked(rows, percent, f"n_words >= {least_words} and doc_id is not null")
