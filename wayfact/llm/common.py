"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from wayfact.session import configure, materialize

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Texts differ in length by orders of magnitude, so batches are bounded by bytes too.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20
MAX_BROADCAST = 2_000_000  # numbers of eight bytes: some 64 MB once hashed

# Python workers live on from stage to stage. These allocator settings make them give back
# what one stage used, so that it doesn't add to what the next one needs.
WORKER_MEMORY = {
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(1 << 20),
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}

# Splitting a byte string without an argument cuts at 0x20 and 0x09 to 0x0D, which
# is the word rule [^\x20\x09-\x0D]+ used throughout.


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings of the text operators on an existing session.

    Python workers look for this package where the driver found it; on a cluster that
    installs or ships it, the extra path does no harm. They also get ``WORKER_MEMORY``,
    where the session does not say otherwise.
    """
    configure(spark)
    environment = spark.sparkContext.environment
    known = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if PACKAGE_ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *known])
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, so that other columns cannot clash; a null text is empty."""
    prepare(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def byte_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; a null text is empty."""
    return [value or b"" for value in batch.column(name).cast(pa.binary()).to_pylist()]


class Memo(dict):
    """Results of ``function`` by key, for the keys met most recently.

    It is emptied when it has grown to ``limit`` entries, so memory stays bounded
    whatever the vocabulary; ``long`` keys are computed and not stored.
    """

    def __init__(self, function: Callable, limit: int = 150_000, long: int = 64) -> None:
        super().__init__()
        self.function, self.limit, self.long = function, limit, long

    def __missing__(self, key):
        value = self.function(key)
        if len(key) <= self.long:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


class IdTable(dict):
    """Ids of words met lately: a number for each word, all ids in one array.

    ``encode`` gives the ids of new words, many at a time, as one array and the lengths.
    When what is held takes ``limit`` bytes, all is dropped: memory is bounded by that and
    one batch.
    """

    ENTRY = 160  # bytes of a dictionary's entry, a number and two offsets

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 64 << 20) -> None:
        super().__init__()
        self.encode, self.limit = encode, limit
        self._new: list[str] = []
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.held = 0
        self._ids, self._ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self._new.append(word)
        return number

    def _learn(self) -> None:
        ids, lengths = self.encode(self._new)
        self._ids = np.concatenate((self._ids, ids))
        self._ends = np.concatenate((self._ends, self._ends[-1] + np.cumsum(lengths)))
        self.held += sum(map(len, self._new)) + self.ENTRY * len(lengths) + 4 * len(ids)
        self._new.clear()

    def rows(self, words: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all lists of words, and where each list's ids begin and end.

        Each distinct word of the lists is looked up once.
        """
        if self.held > self.limit:
            self._reset()
        coded = words.flatten().dictionary_encode()
        numbers = np.fromiter(map(self.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False)), np.int64)
        if self._new:
            self._learn()
        numbers = numbers[np.asarray(coded.indices, np.int64)]
        starts = self._ends[numbers]
        counts = self._ends[numbers + 1] - starts
        ends = np.concatenate(([0], np.cumsum(counts)))
        flat = self._ids[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], counts)]
        offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(words)))).astype(np.int64)
        return flat, ends[offsets]


def joined_ids(ids: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """One array of all ids, and the length of each list."""
    return np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids))


def split_words(texts: pa.StringArray) -> pa.ListArray:
    """Words between ASCII white space; a text without any gives an empty list."""
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    full = np.asarray(pc.not_equal(words, ""))
    lengths = np.asarray(pc.list_value_length(split), np.int64)
    kept = np.concatenate(([0], np.cumsum(full)))
    offsets = kept[np.concatenate(([0], np.cumsum(lengths)))]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.filter(pa.array(full)))


_kept: tuple[object, object] = (None, None)


def kept(key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by a worker until another key is asked for or it is released."""
    global _kept
    if _kept[0] != key:
        release()
        _kept = key, make()
    return _kept[1]


def release() -> None:
    global _kept
    _kept = None, None


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
    keeps: bool = False,
) -> DataFrame:
    """``function`` over Arrow batches. Unless it ``keeps`` one itself, it first frees what a worker still keeps."""

    def run(batches):
        release()
        yield from function(batches)

    return df.mapInArrow(function if keeps else run, schema)


def with_ids(rows: DataFrame, ids: DataFrame, how: str, values: Column | None = None) -> DataFrame:
    """Join of ``rows`` to ``ids`` on doc_id.

    ``ids`` is stored and its numbers are counted (``values`` of them a row, one if not
    given). Up to ``MAX_BROADCAST`` it is sent to the executors, so the texts stay where
    they are; beyond that both sides are shuffled and merged.
    """
    ids = materialize(ids.where("doc_id is not null"), "ids")
    total = ids.agg(F.sum(F.lit(1) if values is None else values)).first()[0] or 0
    if total <= MAX_BROADCAST:
        ids = F.broadcast(ids)
    return rows.join(ids, "doc_id", how)


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` less the rows whose doc_id is in ``dropped``; rows without an id stay."""
    return with_ids(docs, dropped.select("doc_id").distinct(), "left_anti").select(*docs.columns)


def keep_rows(docs: DataFrame, verdicts: Callable[[list[bytes]], list[bool]]) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns and no shuffle."""
    prepare(docs.sparkSession)

    def scan(batches):
        for batch in batches:
            yield batch.filter(pa.array(verdicts(byte_texts(batch)), pa.bool_()))

    return map_batches(docs, scan, docs.schema)


def are_stars(edges: DataFrame) -> bool:
    """Whether each node of the distinct edges (u, v), v < u, has one smaller neighbour at most, itself without any."""
    above = edges.select(F.col("u").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below"))
    ends = above.union(edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg((F.sum("above") + F.max("below")).alias("roles"))
    return not ends.where("roles > 1").agg(F.count("*")).first()[0]


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected ``links`` (src, dst).

    Returns (node, component) for every linked node, the component being its smallest
    node. Alternates two steps that hang nodes on smaller neighbours: each round is
    aggregations and joins on a node's key with partial sums first, and is stored in
    the shared folder. They end when all edges are stars, so links that are make none. Nodes of many links are split by adaptive execution. Loops,
    repeated links and nulls are ignored.
    """
    edges = materialize(
        links.where("src <> dst")
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct(),
        "edges",
    )
    while not are_stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
