"""Benchmark decontamination: a BM25 index of test items searched with block-max WAND.

Every passage of every document is a query against the index; all items whose score
reaches the threshold are retrieved, and so are all questions that do so alone. They are
then verified by how many of their words stand in three-word runs that the passage has too,
which a changed word hardly lowers.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayfact.llm.common import Memo, byte_texts, ids_and_texts, keep_rows, map_batches
from wayfact.session import materialize

K1, B = 1.2, 0.75
BLOCK = 64
THRESHOLD = 0.6  # share of an item's own full score
COMMON_SHARE = 0.5  # of the threshold: what an item's commonest terms may make up unseen
SHINGLE = 3
MIN_OVERLAP = 0.8  # of a question's words
MIN_WHOLE = 0.7  # of an item's words
MIN_QUESTION = 8  # words from which a question is a leak without its answer
MIN_PASSAGE = 64
ITEMS_PER_INDEX = 20_000  # larger sets of items are searched index by index
ITEM_BYTES_PER_INDEX = 64 << 20

_EDGES = bytes(b for b in range(128) if not chr(b).isalnum())
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def term(word: bytes) -> bytes:
    """A word in lower case without ASCII punctuation at its ends."""
    word = word.strip(_EDGES)
    return word.lower() if word.isascii() else word.decode("utf-8", "replace").lower().encode()


def terms(text: bytes) -> list[bytes]:
    return [t for t in map(term, text.split()) if t]


def question_and_answer(text: str) -> tuple[bytes, bytes]:
    """The last sentence of an item is its answer, what precedes it the question.

    With one sentence only, the last third of the words is the answer.
    """
    parts = _SENTENCE.split(text.strip())
    if len(parts) > 1:
        return " ".join(parts[:-1]).encode(), parts[-1].encode()
    words = text.split()
    cut = max(1, 2 * len(words) // 3) if len(words) > 1 else len(words)
    return " ".join(words[:cut]).encode(), " ".join(words[cut:]).encode()


def shingles(words: list[bytes], size: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """Runs of ``size`` words; all words if they are fewer; none without words."""
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def coverage(part: list[bytes], here: set[tuple[bytes, ...]], size: int = SHINGLE) -> int:
    """How many words of ``part`` lie in runs of ``size`` words that ``here`` has."""
    covered = bytearray(len(part))
    for i in range(len(part) - size + 1):
        if tuple(part[i : i + size]) in here:
            covered[i : i + size] = b"\1" * size
    return sum(covered)


def share_of(part: list[bytes], passage: list[bytes], here: set[tuple[bytes, ...]]) -> float:
    """The covered share of ``part``; shorter parts stand in the passage or do not; 1 without words."""
    if not part:
        return 1.0
    if len(part) >= SHINGLE:
        return coverage(part, here) / len(part)
    return float(any(passage[i : i + len(part)] == part for i in range(len(passage) - len(part) + 1)))


@dataclass
class Item:
    item_id: int
    words: list[bytes]
    question: list[bytes]
    answer: list[bytes]


@dataclass
class Index:
    """Postings per term: items in ascending order, their impacts, the maximum of each block and of all."""

    items: list[Item]
    number: dict[bytes, int] = field(default_factory=dict)
    postings: list[tuple[list[int], list[float], list[float], float]] = field(default_factory=list)
    threshold: float = THRESHOLD
    passage: int = MIN_PASSAGE
    whole: dict[int, int] = field(default_factory=dict)  # the item's place for each question of its own

    @classmethod
    def build(
        cls,
        items: list[Item],
        frequency: dict[bytes, int],
        n_items: int,
        mean_length: float,
        threshold: float = THRESHOLD,
    ) -> Index:
        """``frequency``: in how many of all ``n_items`` a term occurs, for these items' terms."""
        index = cls([item for item in items if item.words], threshold=threshold)
        rare: dict[bytes, list[tuple[int, float]]] = {}
        index.need = np.zeros(len(index.items))
        gathered: dict[bytes, list[tuple[int, float]]] = {}
        for k, item in enumerate(index.items):
            norm = K1 * (1 - B + B * len(item.words) / mean_length)
            weights = {}
            for word, count in Counter(item.words).items():
                idf = math.log(1 + (n_items - frequency[word] + 0.5) / (frequency[word] + 0.5))
                weights[word] = idf * count * (K1 + 1) / (count + norm)
            whole = sum(weights.values())
            for word, weight in weights.items():
                gathered.setdefault(word, []).append((k, weight / whole))
            unseen = 0.0
            for word in sorted(weights, key=lambda w: (-frequency[w], w)):
                if unseen + weights[word] / whole <= COMMON_SHARE * threshold:
                    unseen += weights[word] / whole
                else:
                    rare.setdefault(word, []).append((k, weights[word] / whole))
            index.need[k] = threshold - unseen - 1e-6
        for word, found in gathered.items():
            index.number[word] = len(index.postings)
            ids, impacts = [k for k, _ in found], [w for _, w in found]
            blocks = [max(impacts[i : i + BLOCK]) for i in range(0, len(impacts), BLOCK)]
            index.postings.append((ids, impacts, blocks, max(blocks)))
        # The last place stands for words outside the index.
        counts = [len(rare.get(word, ())) for word in index.number] + [0]
        index.rare_starts = np.concatenate(([0], np.cumsum(counts)))
        listed = [entry for word in index.number for entry in rare.get(word, ())]
        index.rare_items = np.array([k for k, _ in listed], np.int64)
        index.rare_impacts = np.array([w for _, w in listed], np.float64)
        longest = max((len(item.words) for item in index.items), default=0)
        index.passage = max(MIN_PASSAGE, 2 * longest)
        return index

    def hopeful(self, ids: np.ndarray, step: int, windows: int) -> np.ndarray:
        """Windows (two steps of words each) in which some item can reach the threshold.

        Only postings of an item's rarer terms are read. Its common terms could add a
        fixed share at most, so the rarer ones must make up the rest.
        """
        places = np.flatnonzero(self.rare_starts[ids + 1] > self.rare_starts[ids])
        if not len(places):
            return places
        # A term counts once a window, however often it stands there.
        at, own = places // step, ids[places]
        both = (at > 0) & (at < windows)
        pairs = np.unique(
            np.concatenate((own * windows + np.minimum(at, windows - 1), own[both] * windows + at[both] - 1))
        )
        own, window = pairs // windows, pairs % windows
        counts = self.rare_starts[own + 1] - self.rare_starts[own]
        first = np.repeat(self.rare_starts[own] - np.cumsum(counts) + counts, counts)
        entries = first + np.arange(len(first))
        impacts = self.rare_impacts[entries]
        if impacts.sum() < self.need.min():
            return places[:0]
        keys, inverse = np.unique(self.rare_items[entries] * windows + np.repeat(window, counts), return_inverse=True)
        sums = np.bincount(inverse, weights=impacts)
        return np.unique(keys[sums >= self.need[keys // windows]] % windows)

    def search(self, query: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose score for the distinct terms of ``query`` reaches ``threshold``.

        Lists stand sorted by their current item. The pivot is the first list at which the
        sum of list maxima reaches the threshold; block maxima then decide whether the
        pivot is scored or skipped to the end of the nearest block.
        """
        lists = [[self.postings[t], 0] for t in set(query)]
        found = []
        while lists:
            lists.sort(key=lambda x: x[0][0][x[1]])
            bound, pivot = 0.0, -1
            for i, (posting, _) in enumerate(lists):
                bound += posting[3]
                if bound >= threshold - 1e-9:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = lists[pivot][0][0][lists[pivot][1]]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][0][lists[pivot + 1][1]] == item:
                pivot += 1
            bound, edge = 0.0, math.inf
            for entry in lists[: pivot + 1]:
                (ids, _, blocks, _), at = entry
                block = _block_of(ids, at, item)
                if block < len(blocks):
                    bound += blocks[block]
                    edge = min(edge, ids[min(len(ids), (block + 1) * BLOCK) - 1])
            if bound >= threshold - 1e-9:
                score = 0.0
                for entry in lists[: pivot + 1]:
                    ids, impacts, _, _ = entry[0]
                    entry[1] = _seek(ids, entry[1], item)
                    if entry[1] < len(ids) and ids[entry[1]] == item:
                        score += impacts[entry[1]]
                        entry[1] += 1
                if score >= threshold - 1e-9:
                    found.append((item, score))
            else:
                after = edge + 1
                if pivot + 1 < len(lists):
                    after = min(after, lists[pivot + 1][0][0][lists[pivot + 1][1]])
                after = max(after, item + 1)
                for entry in lists[: pivot + 1]:
                    entry[1] = _seek(entry[0][0], entry[1], after)
            lists = [entry for entry in lists if entry[1] < len(entry[0][0])]
        return found


def _seek(ids: list[int], at: int, item: int) -> int:
    """The first place from ``at`` on whose item is ``item`` or later."""
    while at < len(ids) and ids[at] < item:
        block_end = (at // BLOCK + 1) * BLOCK
        if block_end <= len(ids) and ids[block_end - 1] < item:
            at = block_end
        else:
            at += 1
    return at


def _block_of(ids: list[int], at: int, item: int) -> int:
    block = at // BLOCK
    while block * BLOCK < len(ids) and ids[min(len(ids), (block + 1) * BLOCK) - 1] < item:
        block += 1
    return block


_numbers: tuple[Index | None, Memo | None] = (None, None)


def word_numbers(index: Index) -> Memo:
    """Numbers of words as they stand in texts; kept by a worker for the index used last."""
    global _numbers
    if _numbers[0] is not index:
        outside = len(index.postings)
        _numbers = index, Memo(lambda word: index.number.get(term(word), outside))
    return _numbers[1]


def matches_in(text: bytes, index: Index, numbers: Memo, min_overlap: float = MIN_OVERLAP):
    """(item, score, question overlap, answer overlap) for each item found in the text."""
    words = text.split()
    if not words:
        return
    outside = len(index.postings)
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    step = index.passage // 2
    windows = max(1, -(-len(words) // step) - 1)
    best: dict[int, tuple[float, float, float]] = {}
    for k in index.hopeful(ids, step, windows).tolist():
        span = slice(k * step, k * step + index.passage)
        own = np.unique(ids[span])
        found = index.search(own[own < outside].tolist(), index.threshold)
        if not found:
            continue
        passage = [t for t in map(term, words[span]) if t]
        here = shingles(passage)
        for item, score in found:
            whole = index.whole.get(item, item)
            entry = index.items[whole]
            question = share_of(entry.question, passage, here)
            leaked = len(entry.question) >= MIN_QUESTION and question >= min_overlap
            if leaked or share_of(entry.words, passage, here) >= min(MIN_WHOLE, min_overlap):
                match = score, question, share_of(entry.answer, passage, here)
                best[whole] = max(match, best.get(whole, match))
    for item, match in sorted(best.items()):
        yield item, *match


def _items(rows) -> list[Item]:
    found = []
    for item_id, text in rows:
        question, answer = question_and_answer(text or "")
        found.append(Item(item_id, terms((text or "").encode()), terms(question), terms(answer)))
    return found


def with_questions(index_of, items: list[Item]) -> Index:
    """The index of the items and, as entries of their own, the questions that can stand alone."""
    items = [item for item in items if item.words]
    alone = [k for k, item in enumerate(items) if item.answer and len(item.question) >= MIN_QUESTION]
    questions = [Item(items[k].item_id, items[k].question, items[k].question, items[k].answer) for k in alone]
    index = index_of(items + questions)
    index.whole = {len(items) + i: k for i, k in enumerate(alone)}
    return index


def _item_words(batches):
    """One row per item and distinct term, with its count."""
    for batch in batches:
        rows = [
            (item_id, word.decode(), n)
            for item_id, text in zip(batch.column("item_id").to_pylist(), byte_texts(batch))
            for word, n in Counter(terms(text)).items()
        ]
        ids, found, counts = zip(*rows) if rows else ((), (), ())
        yield pa.record_batch(
            {
                "item_id": pa.array(list(ids), pa.int64()),
                "word": pa.array(list(found), pa.string()),
                "n": pa.array(list(counts), pa.int64()),
            }
        )


def indexes(benchmark: DataFrame, threshold: float = THRESHOLD):
    """One index after another, each over a bounded number of items and bytes.

    Term frequencies and the mean length are those of all items. Null and empty items
    are never found.
    """
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text is not null and item_id is not null")
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if not size["n"]:
        return
    parts = max(math.ceil(size["n"] / ITEMS_PER_INDEX), math.ceil(size["bytes"] / ITEM_BYTES_PER_INDEX))
    if parts == 1:
        read = _items(items.orderBy("item_id").collect())
        counts = Counter(word for item in read for word in set(item.words))
        length = sum(len(item.words) for item in read) / size["n"]
        yield with_questions(lambda all: Index.build(all, counts, size["n"], max(1.0, length), threshold), read)
        return
    words = materialize(map_batches(items, _item_words, "item_id bigint, word string, n bigint"), "item-words")
    length = words.agg(F.sum("n")).first()[0] / size["n"]
    frequency = words.groupBy("word").agg(F.count("*").alias("df"))
    for part in range(parts):
        mine = F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part
        here = words.where(mine).select("word").distinct()
        counts = {word.encode(): n for word, n in frequency.join(here, "word").collect()}
        read = _items(items.where(mine).orderBy("item_id").collect())
        yield with_questions(lambda all: Index.build(all, counts, size["n"], max(1.0, length), threshold), read)


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_overlap: float = MIN_OVERLAP
) -> DataFrame:
    """One row per document and test item found in it; other documents have no row.

    doc_id, item_id, score (best passage, 1 is a whole item), question_overlap,
    answer_overlap. An item counts when it, or its question, scores ``threshold`` or more in a
    passage and ``min_overlap`` of the question's words or ``MIN_WHOLE`` of the item's lie in
    three-word runs of that passage. Null and empty texts match nothing, nor
    does an empty benchmark. Repeated rows are reported for each row.
    """
    texts = ids_and_texts(docs)
    spark = docs.sparkSession
    schema = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"
    result = None
    for index in indexes(benchmark, threshold):
        shared = spark.sparkContext.broadcast(index)

        def scan(batches, shared=shared):
            index = shared.value
            numbers = word_numbers(index)
            for batch in batches:
                rows = [
                    (doc_id, index.items[item].item_id, *rest)
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch))
                    for item, *rest in matches_in(text, index, numbers, min_overlap)
                ]
                names = ("doc_id", "item_id", "score", "question_overlap", "answer_overlap")
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                columns = zip(*rows) if rows else [()] * 5
                yield pa.record_batch({n: pa.array(list(c), t) for n, c, t in zip(names, columns, kinds)})

        part = map_batches(texts, scan, schema)
        result = part if result is None else result.union(part)
    return spark.createDataFrame([], schema) if result is None else result


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_overlap: float = MIN_OVERLAP
) -> DataFrame:
    """The rows of ``docs`` without a test item in their text, with all their columns."""
    for index in indexes(benchmark, threshold):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def clean(texts, shared=shared):
            index = shared.value
            numbers = word_numbers(index)
            return [next(matches_in(text, index, numbers, min_overlap), None) is None for text in texts]

        docs = keep_rows(docs, clean)
    return docs
