"""Collocations by partitioned mining (SON): shards first, then the union of what they found.

Documents are dealt to ``SHARDS`` shards. A phrase that occurs ``support`` times in a language
occurs in some shard at least in proportion to the shard's share of the words, so each shard
is mined completely at that lowered support; the union of what any shard found holds every
frequent phrase, and all of it is counted over all shards. Shards are groups of rows, not
tasks: their counts are made in batches, summed by Spark, and grow with the input.

The texts are read twice. First every word and pair of words is counted as a 64-bit hash, by
shard, and a bit table of bounded size takes the pairs and words that some shard found. Then
these, and the longer runs all of whose pairs are in the table, are counted as they are
written, so no hash enters a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from wayfact.llm.common import map_batches, prepare, split_words
from wayfact.session import materialize

SUPPORT = 100
LONGEST = 5
SCALE = 1000
ABSORB = 100  # percent of a phrase's count at which a longer one takes its place
TOP = 2000
SHARDS = 16  # a phrase needs some 6 of its 100 occurrences in one of them
ID_BLOCK = 4096  # documents with neighbouring ids share a shard, so batches count much at once
FLUSH = 4 << 20  # bytes of text counted at once in a task
OUT = 1 << 16  # rows a task hands over at once
BITS_EACH = 32  # bits of the table for each frequent phrase ...
LOG_BITS = (16, 27)  # ... within these powers of two: 16 MB at most
UNKNOWN = "und"

MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd numbers


def prepared(docs: DataFrame) -> DataFrame:
    """shard, lang, l (a hash of lang) and text; a null text is empty, a null lang is ``und``."""
    prepare(docs.sparkSession)
    doc_id = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    return docs.select(
        F.pmod(F.floor(doc_id / ID_BLOCK), F.lit(SHARDS)).cast("int").alias("shard"),
        lang.alias("lang"),
        F.xxhash64(lang).alias("l"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int = FLUSH) -> Iterator[pa.RecordBatch]:
    """The rows in larger batches, ended when the texts of one reach ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(column).nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _hashes(values: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, values.cast(pa.binary()).to_pylist()), np.uint64, len(values))


def _extend(runs: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (runs ^ (runs >> np.uint64(31))) * MIX + words * STEP


class Words:
    """All words of some texts: their codes, pieces and rows, and the hashes of runs of them."""

    def __init__(self, texts: pa.StringArray, l: np.ndarray, pieces: bool = True) -> None:
        if pieces:  # a full stop cannot be part of a word, so it stands for every end of a piece
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), r"[.,;:!?\n\v\f\r]+", " . ")
        found = split_words(texts)
        rows = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(found), np.int64))
        words = found.flatten()
        ends = np.asarray(pc.equal(words, ".")) if pieces else np.zeros(len(words), bool)
        coded = words.filter(pa.array(~ends)).dictionary_encode()
        self.vocabulary = coded.dictionary
        self.codes = np.asarray(coded.indices, np.int64)
        self.rows = rows[~ends]
        self.pieces = (np.cumsum(ends) + rows)[~ends]
        self._words = _hashes(self.vocabulary)[self.codes]
        self._start = l.view(np.uint64)[self.rows]

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of ``size`` words of one piece start, and a hash of each with its language's."""
        hashes = self._start
        for i in range(size):
            hashes = _extend(hashes[: len(hashes) - bool(i)], self._words[i:])
        starts = np.flatnonzero(self.pieces[: len(hashes)] == self.pieces[size - 1 :])
        return starts, hashes

    def phrases(self, starts: np.ndarray, size: int) -> pa.Array:
        words = [self.vocabulary.take(pa.array(self.codes[starts + i])) for i in range(size)]
        return pc.binary_join_element_wise(*words, " ")


class Filter:
    """Bits of hashes: what was put in is found, other hashes rarely are."""

    def __init__(self, log_bits: int, rows: pa.Table) -> None:
        self.shift = np.uint64(64 - log_bits)
        self.bits = np.zeros(1 << (log_bits - 6), np.uint64)
        self.bits[rows["slot"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> self.shift
        return (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def filter_of(frequent: DataFrame) -> Filter:
    """The bit table of the hashes h; its size follows their number."""
    log_bits = min(max((BITS_EACH * frequent.count()).bit_length(), LOG_BITS[0]), LOG_BITS[1])
    place = F.shiftrightunsigned("h", 64 - log_bits)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - log_bits}) & 63 as int))")
    rows = frequent.groupBy(F.shiftright(place, 6).alias("slot")).agg(F.bit_or(bit).alias("bits"))
    return Filter(log_bits, rows.toArrow())


def run_keys(groups: np.ndarray, n_groups: int, columns: list[np.ndarray], width: int) -> np.ndarray:
    """A number for each row of ``groups`` and ``columns`` (values below ``width``), the same for equal rows only."""
    key, size = groups, max(n_groups, 1)
    for column in columns:
        if size * width >= 1 << 62:
            seen, key = np.unique(key, return_inverse=True)
            size = len(seen)
        key, size = key * width + column, size * width
    return key


def by_group(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, list[tuple[int, int, int, int]]]:
    """The rows ordered by shard and language, and (shard, l, first row, end) of each group."""
    shards, l = (batch.column(name).to_numpy() for name in ("shard", "l"))
    order = np.lexsort((l, shards))
    shards, l = shards[order], l[order]
    cuts = np.flatnonzero((np.diff(shards) != 0) | (np.diff(l) != 0)) + 1
    firsts = [0, *cuts.tolist()]
    groups = [(int(shards[a]), int(l[a]), a, b) for a, b in zip(firsts, [*firsts[1:], len(order)])]
    return batch.take(pa.array(order)), groups


def hashed_counts(texts: DataFrame) -> DataFrame:
    """shard, l, h and n: how often each word and pair occurs in a shard; h is l for all words together."""

    def scan(batches):
        for batch in gathered(batches, "text"):
            batch, groups = by_group(batch)
            words = Words(batch.column("text"), batch.column("l").to_numpy())
            ones = words.runs(1)
            twos = words.runs(2)
            for shard, l, a, b in groups:
                low, high = np.searchsorted(words.rows, (a, b))
                found, counts = [np.array([l]).view(np.uint64)], [np.array([high - low])]
                for starts, hashes in (ones, twos):
                    cut = slice(*np.searchsorted(starts, (low, high)))
                    h, n = np.unique(hashes[starts[cut]], return_counts=True)
                    found.append(h)
                    counts.append(n)
                found, counts = np.concatenate(found).view(np.int64), np.concatenate(counts)
                for at in range(0, len(found), OUT):
                    h = found[at : at + OUT]
                    yield pa.record_batch(
                        {
                            "shard": pa.array(np.full(len(h), shard, np.int32)),
                            "l": pa.array(np.full(len(h), l, np.int64)),
                            "h": pa.array(h),
                            "n": pa.array(counts[at : at + OUT].astype(np.int64)),
                        }
                    )

    # A hash is there once a batch at most, so no task gets more of one than there are batches.
    rows = map_batches(texts.select("shard", "l", "text"), scan, "shard int, l bigint, h bigint, n bigint")
    return rows.repartition("h").groupBy("shard", "l", "h").agg(F.sum("n").alias("n"))


def written_counts(texts: DataFrame, longest: int, pairs: Filter) -> DataFrame:
    """shard, lang, size, phrase and n: occurrences in a shard of what the table holds.

    Runs of three words or more are counted if it holds all their pairs.
    """
    shared = texts.sparkSession.sparkContext.broadcast(pairs)

    def scan(batches):
        known = shared.value
        for batch in gathered(batches, "text"):
            batch, groups = by_group(batch)
            words = Words(batch.column("text"), batch.column("l").to_numpy())
            group = np.repeat(np.arange(len(groups)), [b - a for _, _, a, b in groups])
            good = np.zeros(len(words.codes), bool)  # whether the table holds the pair that starts here
            for size in range(1, longest + 1):
                starts, hashes = words.runs(size)
                if size <= 2:
                    starts = starts[known.holds(hashes[starts])]
                    if size == 2:
                        good[starts] = True
                else:
                    for i in range(size - 1):
                        starts = starts[good[starts + i]]
                if not len(starts):
                    continue
                columns = [words.codes[starts + i] for i in range(size)]
                keys = run_keys(group[words.rows[starts]], len(groups), columns, len(words.vocabulary))
                _, first, counts = np.unique(keys, return_index=True, return_counts=True)
                row = words.rows[starts[first]]
                phrases = words.phrases(starts[first], size)
                found = batch.select(["shard", "lang"]).take(pa.array(row))
                for at in range(0, len(first), OUT):
                    cut = found.slice(at, OUT)
                    yield pa.record_batch(
                        {
                            "shard": cut.column("shard"),
                            "lang": cut.column("lang"),
                            "size": pa.array(np.full(cut.num_rows, size, np.int32)),
                            "phrase": phrases.slice(at, OUT),
                            "n": pa.array(counts[at : at + OUT].astype(np.int64)),
                        }
                    )

    rows = map_batches(texts, scan, "shard int, lang string, size int, phrase string, n bigint")
    return rows.groupBy("shard", "lang", "size", "phrase").agg(F.sum("n").alias("n"))


def united(counts: DataFrame, weights: DataFrame, by: list[str], keys: list[str], support: int) -> DataFrame:
    """``keys`` and f of all that some shard found at its share of the support and that has it over all."""
    # n >= support * part / whole, in whole numbers
    enough = F.col("n").cast("decimal(19,0)") * F.col("whole").cast("decimal(19,0)") >= F.lit(support).cast(
        "decimal(9,0)"
    ) * F.col("part").cast("decimal(19,0)")
    local = counts.join(weights, ["shard", *by]).select(*keys, "n", enough.alias("found"))
    sums = local.groupBy(*keys).agg(F.sum("n").alias("f"), F.max("found").alias("found"))
    return sums.where(F.col("found") & (F.col("f") >= support)).drop("found")


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words with ``support`` occurrences in a language, and the words of each language.

    The first has lang, size, phrase and f, the second lang and n.
    """
    texts = prepared(docs)
    langs = texts.select("lang", "l").distinct()
    hashed = materialize(hashed_counts(texts), "hashed")
    parts = hashed.where("h = l").join(langs, "l").select("shard", "lang", "l", F.col("n").alias("part"))
    parts = materialize(parts, "parts")
    totals = materialize(parts.groupBy("lang").agg(F.sum("part").alias("n")), "totals")
    weights = materialize(parts.join(totals.withColumnRenamed("n", "whole"), "lang"), "weights")
    likely = materialize(united(hashed.where("h <> l"), weights, ["l"], ["l", "h"], support), "likely")
    written = written_counts(texts, longest, filter_of(likely))
    phrases = united(written, weights.drop("l"), ["lang"], ["lang", "size", "phrase"], support)
    return materialize(phrases, "phrases"), totals


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases of two words or more with the lowest score of their cuts: lang, phrase, size, a, l, r, n, score."""
    counts = phrases.select("lang", "phrase", "f")
    cuts = phrases.where("size > 1").withColumnRenamed("f", "a")
    cuts = cuts.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.withColumns(
        {
            "first": F.expr("array_join(slice(split(phrase, ' '), 1, k), ' ')"),
            "rest": F.expr("array_join(slice(split(phrase, ' '), k + 1, size - k), ' ')"),
        }
    )
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang")
    # Products of up to 37 digits; the quotient is at most ten times the words of the language.
    cuts = cuts.withColumn(
        "score",
        F.expr(
            f"(cast({SCALE} * a as decimal(18,0)) * cast(n as decimal(18,0)))"
            " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
        ),
    )
    lowest = cuts.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score")


def absorbed(phrases: DataFrame, percent: int = ABSORB) -> DataFrame:
    """lang and phrase of those that lie in a longer one with ``percent`` of their count."""
    longer = phrases.where("size > 2").select("lang", "f", "size", F.split("phrase", " ").alias("words"))
    longer = longer.withColumn("length", F.explode(F.expr("sequence(2, size - 1)")))
    longer = longer.withColumn("start", F.explode(F.expr("sequence(1, size - length + 1)")))
    inner = longer.select("lang", "f", F.expr("array_join(slice(words, start, length), ' ')").alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    both = most.join(phrases.select("lang", "phrase", F.col("f").alias("own")), ["lang", "phrase"])
    # f(longer) is at most own, so no product passes 64 bits
    return both.where(F.lit(100) * F.col("longest") >= F.lit(percent) * F.col("own")).select("lang", "phrase")


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n and score.

    A-Z is lower-cased; pieces end at ``.,;:!?`` and line ends, words at blanks and tabs. A
    phrase is two to ``longest`` words of one piece, occurring ``support`` times in its
    language, overlaps included. Its score is that of its lowest cut. Order: score and count
    descending, then the phrase's bytes. Null texts are empty, rows without a language are
    ``und``, rows without a doc_id and repeated rows count like any others. A table without
    frequent phrases gives no rows.
    """
    phrases, totals = frequent_phrases(docs, support, longest)
    ranked = scored(phrases, totals).join(absorbed(phrases), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
