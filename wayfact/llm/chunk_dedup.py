"""Substring de-duplication by content-defined chunks.

A gear rolling hash over the last eight bytes decides where a chunk ends, so equal
passages fall into equal chunks wherever they stand in a text. From every chunk on, as many
chunks as have enough words make a stretch, known by a 128-bit digest; a stretch is a repeat
if the same digest occurs earlier, by doc_id and place, so its chunks stood together there.
Repeated stretches are cut out of the text; the first copy stays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from wayfact.llm.common import byte_texts, ids_and_texts, map_batches, prepare, with_ids

GEAR_STEPS = 3  # the hash spans 2 ** 3 bytes
CUT_BELOW = (1 << 16) // 6  # of 65536: about one white space in six ends a chunk
RARE_CUT_BELOW = (1 << 16) // 512  # elsewhere, for texts without white space
MAX_CHUNK = 4096
MIN_WORDS = 20
FLUSH_CHUNKS = 500_000  # stretches held in a task, 20 MB and as much again to sort them

#: One fixed 16-bit number per byte.
GEAR = np.frombuffer(
    b"".join(hashlib.sha256(f"gear {byte}".encode()).digest()[:2] for byte in range(256)), "<u2"
)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
PLACE_BITS = 32  # of a chunk's place in its text
TAG_BITS = 24


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte: each step back shifts a byte's number by one bit."""
    total = GEAR[data]
    span = 1
    for _ in range(GEAR_STEPS):
        longer = total.copy()
        longer[span:] += total[:-span] << np.uint16(span) if len(total) > span else 0
        total, span = longer, 2 * span
    return total


def chunk_ends(text: bytes) -> np.ndarray:
    """Ends of the chunks of a text; they cover it and never split a character.

    A chunk ends after white space chosen by the rolling hash, after each line break,
    and, rarely, elsewhere; one of ``MAX_CHUNK`` bytes is cut. Empty texts have none.
    """
    if not text:
        return np.zeros(0, np.int64)
    data = np.frombuffer(text, np.uint8)
    hashes = gear_hashes(data)
    mixed = (hashes ^ (hashes >> np.uint16(7))) * np.uint16(40503)
    cut = np.where(_SPACE[data], mixed < CUT_BELOW, mixed < RARE_CUT_BELOW)
    cut |= data == 0x0A
    starts = np.append((data[1:] & 0xC0) != 0x80, True)  # a character starts after this byte
    cut &= starts
    cut[-1] = True
    ends = np.flatnonzero(cut) + 1
    if np.diff(ends, prepend=0).max() <= MAX_CHUNK:
        return ends
    whole, last = [], 0
    for end in ends.tolist():
        while end - last > MAX_CHUNK:
            last += MAX_CHUNK
            while not starts[last - 1]:
                last -= 1
            whole.append(last)
        whole.append(end)
        last = end
    return np.array(whole, np.int64)


def chunk_words(text: bytes, ends: np.ndarray) -> np.ndarray:
    """Words that start in each chunk."""
    space = _SPACE[np.frombuffer(text, np.uint8)]
    starts = ~space
    starts[1:] &= space[:-1]
    return np.diff(np.cumsum(starts)[ends - 1], prepend=0)


def stretches(words: np.ndarray, min_words: int) -> np.ndarray:
    """From each chunk the number of chunks that first have ``min_words``; fewer where the text ends before."""
    totals = np.concatenate(([0], np.cumsum(words)))
    last = np.searchsorted(totals, totals[:-1] + min_words)
    starts = np.arange(len(words))
    found = last <= len(words)
    return (np.maximum(last, starts + 1) - starts)[found]


def text_tag(text: bytes) -> int:
    """Tells the texts of one doc_id apart: it stands above the places of their chunks."""
    return xxhash.xxh3_64_intdigest(text) >> (64 - TAG_BITS)


def _digests(batches, min_words: int):
    """One row per stretch: its digest, document, place and chunks, and whether the task has an earlier one."""
    rows: list[np.ndarray] = []
    held = 0

    def flush():
        nonlocal held
        found = np.concatenate(rows)
        rows.clear()
        held = 0
        order = np.lexsort((found["place"], found["doc_id"], found["low"], found["high"]))
        found = found[order]
        same = np.zeros(len(found), bool)
        same[1:] = (found["high"][1:] == found["high"][:-1]) & (found["low"][1:] == found["low"][:-1])
        first = found[np.maximum.accumulate(np.where(same, 0, np.arange(len(found))))]
        again = (found["doc_id"] != first["doc_id"]) | (found["place"] != first["place"])
        # A repeat needs no company: it is dealt by its own place, not by its digest.
        found["high"][again], found["low"][again] = found["doc_id"][again], found["place"][again]
        for start in range(0, len(found), 1 << 16):
            part = slice(start, start + (1 << 16))
            yield pa.record_batch(
                {
                    **{name: pa.array(np.ascontiguousarray(found[name][part])) for name in found.dtype.names},
                    "again": pa.array(again[part]),
                }
            )

    kind = np.dtype([("high", "i8"), ("low", "i8"), ("doc_id", "i8"), ("place", "i8"), ("chunks", "i4")])
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch)):
            cuts = chunk_ends(text)
            ends = cuts.tolist()
            if not ends:
                continue
            counts = stretches(chunk_words(text, cuts), min_words)
            if not len(counts):
                continue
            own = np.zeros(len(counts), kind)
            chunks = b"".join([digest(text[a:b].strip()) for a, b in zip([0, *ends], ends)])
            packed = b"".join([digest(chunks[16 * i : 16 * (i + n)]) for i, n in enumerate(counts.tolist())])
            halves = np.frombuffer(packed, "<i8").reshape(-1, 2)
            own["high"], own["low"] = halves[:, 0], halves[:, 1]
            own["doc_id"], own["place"] = doc_id, (text_tag(text) << PLACE_BITS) + np.arange(len(counts))
            own["chunks"] = counts
            rows.append(own)
            held += len(own)
            if held >= FLUSH_CHUNKS:
                yield from flush()
    if rows:
        yield from flush()


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, firsts and lasts: runs of chunks, each in a stretch of ``min_words`` or more that occurs earlier.

    Earlier is in a smaller doc_id or earlier in the text; a doc_id with several texts has
    them one after the other. Documents without such a run are left out. Within a task all copies of a stretch but the
    first are marked at once, so a stretch of any number of copies sends one row a task (and
    million stretches) to its digest.
    """
    texts = ids_and_texts(docs).where("doc_id is not null")
    schema = "high bigint, low bigint, doc_id bigint, place bigint, chunks int, again boolean"
    chunks = map_batches(texts, lambda batches: _digests(batches, min_words), schema)
    here = F.struct("doc_id", "place")
    chunks = chunks.withColumn("first", F.min(here).over(Window.partitionBy("again", "high", "low")))
    repeats = chunks.where("again or doc_id <> first.doc_id or place <> first.place")
    repeats = repeats.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("place", "chunks"))).alias("chunks"))

    def runs(batches):
        for batch in batches:
            out = [], [], []
            for doc_id, chunks in zip(batch.column("doc_id").to_pylist(), batch.column("chunks").to_pylist()):
                places = np.array([chunk["place"] for chunk in chunks])
                ends = np.maximum.accumulate(places + [chunk["chunks"] for chunk in chunks])
                parted = places[1:] > ends[:-1]
                out[0].append(doc_id)
                out[1].append(places[np.append(True, parted)].tolist())
                out[2].append((ends[np.append(parted, True)] - 1).tolist())
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            columns = [pa.array(values, kind) for values, kind in zip(out, kinds)]
            yield pa.record_batch(columns, ["doc_id", "firsts", "lasts"])

    return map_batches(repeats, runs, "doc_id bigint, firsts array<bigint>, lasts array<bigint>")


def run_spans(text: bytes, firsts: list[int], lasts: list[int]) -> list[tuple[int, int, int]]:
    """(start, end, words) in bytes of each run of chunks; runs of other texts of the doc_id are passed over."""
    tag, mask = text_tag(text), (1 << PLACE_BITS) - 1
    own = [(first & mask, last & mask) for first, last in zip(firsts, lasts) if first >> PLACE_BITS == tag]
    ends = [0, *chunk_ends(text).tolist()] if own else []
    spans = []
    for first, last in own:
        start, end = ends[min(first, len(ends) - 1)], ends[min(last + 1, len(ends) - 1)]
        if start < end:
            spans.append((start, end, len(text[start:end].split())))
    return spans


def cut_spans(text: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    kept, last = [], 0
    for start, end, _ in spans:
        kept.append(text[last:start])
        last = end
    return b"".join([*kept, text[last:]])


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document that loses a passage: the spans cut out and the text that is left.

    doc_id, starts and ends (in bytes of the UTF-8 text), n_words_removed, text. Documents
    that lose nothing have no row. Null and empty texts have no chunks. Rows of one doc_id
    are each judged by their own text; equal ones are one. Rows without a doc_id are not compared.
    """
    texts = ids_and_texts(docs)
    found = repeated_runs(docs, min_words)

    def cut(batches):
        for batch in batches:
            out = {"doc_id": [], "starts": [], "ends": [], "n_words_removed": [], "text": []}
            names = ("doc_id", "firsts", "lasts")
            for text, doc_id, firsts, lasts in zip(
                byte_texts(batch), *(batch.column(name).to_pylist() for name in names)
            ):
                spans = run_spans(text, firsts, lasts)
                if spans:
                    values = (
                        doc_id,
                        [s for s, _, _ in spans],
                        [e for _, e, _ in spans],
                        sum(w for _, _, w in spans),
                        cut_spans(text, spans).decode("utf-8", "replace"),
                    )
                    for column, value in zip(out.values(), values):
                        column.append(value)
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.string())
            yield pa.record_batch({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})

    joined = with_ids(texts, found, "inner", F.size("firsts") + 1).select("doc_id", "text", "firsts", "lasts")
    schema = "doc_id bigint, starts array<bigint>, ends array<bigint>, n_words_removed bigint, text string"
    return map_batches(joined, cut, schema)


def cut_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut out of their texts; no row is lost or added.

    An n_chars column follows the new text. Rows that lose nothing are passed on as they are.
    """
    prepare(docs.sparkSession)
    names = {name.lower() for name in docs.columns}
    held = next(name for name in (f"runs{i}" for i in range(len(names) + 1)) if name not in names)
    found = repeated_runs(docs, min_words).select("doc_id", F.struct("firsts", "lasts").alias(held))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, runs: pd.DataFrame) -> pd.Series:
        rows = []
        for text, firsts, lasts in zip(texts, runs["firsts"], runs["lasts"]):
            data = (text or "").encode()
            rows.append(cut_spans(data, run_spans(data, firsts, lasts)).decode("utf-8", "replace"))
        return pd.Series(rows, dtype=object)

    joined = with_ids(docs, found, "left", F.size(f"{held}.firsts") + 1).select(*docs.columns, held)
    untouched = joined.where(f"{held} is null").select(*docs.columns)
    touched = joined.where(f"{held} is not null").withColumn("text", cut("text", held))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        touched = touched.withColumn("n_chars", F.length("text").cast(kind))
    return untouched.union(touched.select(*docs.columns))
