"""Token ids in binary files of compressed byte or bit planes.

Ids are cut into blocks of fixed size. A block's bytes (or bits) are transposed, so that
plane k holds byte (bit) k of every id, and each plane is compressed with zstandard: the
high planes are almost constant. A file is

    magic | block 0 | block 1 | ... | chunk index | document index | footer

where a block is its planes one after another, the chunk index has for every block its
offset, number of ids and plane lengths, the document index has every document's doc_id
and number of ids, and the footer has the sizes and checksums of both indexes.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from wayfact.llm.bpe import Bpe, TextIds
from wayfact.llm.common import ids_and_texts, map_batches
from wayfact.session import materialize, scratch_path

MAGIC = b"WFPLANE1"
BLOCK = 1 << 16
LEVEL = 3
END_ID = 1
NULL_ID = -(1 << 63)  # stands for a null doc_id in the document index
FOOTER = struct.Struct("<QQQIIBxxx8s")


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """The planes of a block, lowest first: 4 of bytes or 32 of bits."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(octets[:, k]).tobytes() for k in range(4)]
    single = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(single[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).reshape(-1).view("<u4")
    single = np.stack(
        [np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little", count=n) for p in planes], axis=1
    )
    return np.packbits(single, axis=1, bitorder="little").reshape(-1).view("<u4")


class PlaneWriter:
    """Appends documents; holds one unfinished block and the two indexes."""

    def __init__(self, stream, block: int = BLOCK, bits: bool = False) -> None:
        self._stream, self._block, self._bits = stream, block, bits
        self._pack = zstandard.ZstdCompressor(level=LEVEL)
        self._held: list[np.ndarray] = []
        self._n_held = 0
        self._chunks: list[tuple[int, ...]] = []
        self._doc_ids: list[int] = []
        self._sizes: list[int] = []
        self._at = stream.write(MAGIC) or len(MAGIC)
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._doc_ids.append(NULL_ID if doc_id is None else doc_id)
        self._sizes.append(len(ids))
        self.n_ids += len(ids)
        self._held.append(ids)
        self._n_held += len(ids)
        if self._n_held >= self._block:
            whole = np.concatenate(self._held)
            last = len(whole) - len(whole) % self._block
            for start in range(0, last, self._block):
                self._write(whole[start : start + self._block])
            self._held, self._n_held = [whole[last:]], len(whole) - last

    def _write(self, ids: np.ndarray) -> None:
        packed = [self._pack.compress(plane) for plane in to_planes(ids, self._bits)]
        self._chunks.append((self._at, len(ids), *map(len, packed)))
        for plane in packed:
            self._stream.write(plane)
        self._at += sum(map(len, packed))

    def close(self) -> None:
        if self._n_held:
            self._write(np.concatenate(self._held))
        planes = 32 if self._bits else 4
        chunks = self._pack.compress(np.array(self._chunks, "<u8").reshape(-1, 2 + planes).tobytes())
        docs = self._pack.compress(np.array([self._doc_ids, self._sizes], "<i8").tobytes())
        self._stream.write(chunks + docs)
        footer = (self._at, len(chunks), len(docs), zlib.crc32(chunks), zlib.crc32(docs), planes, MAGIC)
        self._stream.write(FOOTER.pack(*footer))


class PlaneReader:
    """Random access to blocks and documents of one file (an object with seek and read)."""

    def __init__(self, stream, size: int) -> None:
        self._stream = stream
        if size < len(MAGIC) + FOOTER.size:
            raise ValueError("not a plane file: too short")
        at, n_chunks, n_docs, chunk_sum, doc_sum, planes, magic = FOOTER.unpack(
            self._read(size - FOOTER.size, FOOTER.size)
        )
        if magic != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a plane file: no magic")
        chunks, docs = self._read(at, n_chunks), self._read(at + n_chunks, n_docs)
        if (zlib.crc32(chunks), zlib.crc32(docs)) != (chunk_sum, doc_sum):
            raise ValueError("plane file with a damaged index")
        self._unpack = zstandard.ZstdDecompressor()
        self.chunks = np.frombuffer(self._unpack.decompress(chunks), "<u8").reshape(-1, 2 + planes).astype(np.int64)
        self.doc_ids, self.sizes = np.frombuffer(self._unpack.decompress(docs), "<i8").reshape(2, -1)
        self.starts = np.concatenate(([0], np.cumsum(self.chunks[:, 1])))

    def _read(self, at: int, size: int) -> bytes:
        self._stream.seek(at)
        return self._stream.read(size)

    def block(self, number: int) -> np.ndarray:
        at, n, *lengths = self.chunks[number].tolist()
        data = self._read(at, sum(lengths))
        edges = np.cumsum([0, *lengths]).tolist()
        return from_planes([self._unpack.decompress(data[a:b]) for a, b in zip(edges, edges[1:])], n)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids from place ``start`` up to ``end``; reads only the blocks they lie in."""
        first = int(np.searchsorted(self.starts, start, "right")) - 1
        parts, number = [np.zeros(0, "<u4")], first
        while number < len(self.chunks) and self.starts[number] < end:
            low = self.starts[number]
            parts.append(self.block(number)[max(0, start - low) : end - low])
            number += 1
        return np.concatenate(parts)

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """doc_id, number of ids and their CRC-32, one block in memory at a time."""
        number, block, at = 0, np.zeros(0, "<u4"), 0
        for doc_id, size in zip(self.doc_ids.tolist(), self.sizes.tolist()):
            left, checksum = size, 0
            while left:
                if at == len(block):
                    block, at = self.block(number), 0
                    number += 1
                part = block[at : at + left]
                checksum = zlib.crc32(part.tobytes(), checksum)
                left -= len(part)
                at += len(part)
            yield (None if doc_id == NULL_ID else doc_id), size, checksum


class LibraryEncoder:
    """Ids by the tokenizers library, each distinct word encoded once in a while.

    The tokenizer drops white space and splits at it, so a text's words give its ids. New
    words go to the library in a few long texts; the number of the word that each id belongs
    to tells them apart. Texts that need normalising go piece by piece.
    """

    JOINED = 64

    def __init__(self, spec: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_str(spec)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self.encode_all = TextIds(Bpe.parse(spec).pattern, self._word_ids, self._piece_ids)

    def _piece_ids(self, pieces: list[str]) -> list[list[int]]:
        return [one.ids for one in self._tokenizer.encode_batch(pieces, add_special_tokens=False)]

    def _word_ids(self, words: list[str]) -> list[list[int]]:
        parts = [words[i : i + self.JOINED] for i in range(0, len(words), self.JOINED)]
        out: list[list[int]] = [[] for _ in words]
        coded = self._tokenizer.encode_batch([" ".join(part) for part in parts], add_special_tokens=False)
        for i, one in enumerate(coded):
            for number, word in zip(one.ids, one.word_ids):
                out[i * self.JOINED + word].append(number)
        return out

    def __call__(self, texts: pa.StringArray, end_id: int | None = END_ID) -> list[np.ndarray]:
        tail = np.array([] if end_id is None else [end_id], np.int32)
        return [np.concatenate((ids, tail)).astype("<u4") for ids in self.encode_all(texts)]


_encoder: tuple[str, LibraryEncoder | None] = ("", None)


def encoder(spec: str) -> LibraryEncoder:
    """The encoder of a tokenizer's file; a worker keeps the one used last."""
    global _encoder
    if _encoder[0] != spec:
        _encoder = spec, LibraryEncoder(spec)
    return _encoder[1]


def write_token_files(docs: DataFrame, tokenizer_path: str, bits: bool = False) -> DataFrame:
    """Writes all documents' ids in ascending doc_id order; one row per file.

    part, path, n_docs, n_ids and start (ids in all earlier files), ordered by part. Each
    attempt of a task writes a file of its own; only that of the attempt whose row counts
    is named, so lost executors do no harm. Files lie under the shared folder. A null text
    has the end id alone; rows without a doc_id come first; rows of one doc_id are ordered
    by text.
    """
    spark = docs.sparkSession
    root = scratch_path(spark, "token-files")
    filesystem, base = pafs.FileSystem.from_uri(root)
    filesystem.create_dir(base)
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())

    def write(batches):
        first = next(batches, None)
        if first is None:
            return
        task = TaskContext.get()
        filesystem, base = pafs.FileSystem.from_uri(root)
        path = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        n_docs, encode = 0, encoder(shared.value)
        with filesystem.open_output_stream(f"{base}/{path}") as stream:
            writer = PlaneWriter(stream, bits=bits)
            for batch in chain([first], batches):
                coded = encode(batch.column("text"))
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coded):
                    writer.add(doc_id, ids)
                n_docs += len(coded)
            writer.close()
        row = (task.partitionId(), f"{root}/{path}", n_docs, writer.n_ids)
        yield pa.record_batch({k: pa.array([v]) for k, v in zip(("part", "path", "n_docs", "n_ids"), row)})

    ordered = ids_and_texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = materialize(map_batches(ordered, write, "part bigint, path string, n_docs bigint, n_ids bigint"), "files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from the files."""

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                filesystem, name = pafs.FileSystem.from_uri(path)
                size = filesystem.get_file_info(name).size
                with filesystem.open_input_file(name) as stream:
                    rows = []
                    for doc_id, n, checksum in PlaneReader(stream, size).documents():
                        rows.append((doc_id, start, n, checksum))
                        start += n
                        if len(rows) == 10_000:
                            yield _batch(rows)
                            rows = []
                    yield _batch(rows)

    n_files = max(1, files.count())
    dealt = files.select("path", "start").repartition(n_files)
    return map_batches(dealt, read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * 4
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    return pa.record_batch({name: pa.array(list(c), pa.int64()) for name, c in zip(names, columns)})
