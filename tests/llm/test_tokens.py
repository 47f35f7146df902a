"""BPE streaming, decoding and token files against the tokenizers library."""

import hashlib
import io
import random
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import awkward, empty, words
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from wayfact.llm import bpe, queries, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@cache
def library() -> Tokenizer:
    return Tokenizer.from_file(PATH)


@cache
def own() -> bpe.Bpe:
    return bpe.Bpe.read(PATH)


def library_ids(text: str) -> list[int]:
    return library().encode(text, add_special_tokens=False).ids


def check(text: str) -> None:
    ids = own().encode(text)
    assert ids.tolist() == library_ids(text)
    assert bpe.decode(own(), ids) == library().decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x2FFF), max_size=40))
def test_any_text(text):
    check(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["the", "ing", " ", "'s", "'LL", "ß", "İ", "Σ", "é", "é", "12", "!?", "\x1f", "\x85", " ", "　", "<|endoftext|>", "<|", "日本", "🙂", "\n", "\x00"]), max_size=20))
def test_awkward_pieces(parts):
    check("".join(parts))


@pytest.mark.parametrize("seed", range(8))
def test_long_pre_tokens_leave_as_they_come(seed):
    draw = random.Random(seed)
    parts = [p for pair in list(own().ranks)[: 50 * (seed + 1)] for p in pair if p.isalpha() and p.isascii()]
    text = "".join(draw.choice(parts) for _ in range(20_000)) if seed else "ab" * 15_000
    model = own()
    taken = 0

    def symbols():
        nonlocal taken
        for byte in text.encode():
            taken += 1
            yield byte

    got, held, emitted = [], 0, 0
    for number in model.stream(symbols()):
        held = max(held, taken - emitted)
        emitted += model._length[number]
        got.append(number)
    assert got == library_ids(text)
    assert held <= model.lookahead + bpe.FLUSH + 1


def test_short_and_long_merges_agree():
    model = own()
    draw = random.Random(4)
    for _ in range(200):
        parts = [model.vocab[draw.choice("theinganrstoe")] for _ in range(draw.randrange(2, 120))]
        limit, bpe.SHORT = bpe.SHORT, 10_000
        short = model.merge(list(parts))
        bpe.SHORT = limit
        assert short == model._merge_long(list(parts))


def test_every_plain_character():
    for start in range(0, 0x300, 16):
        run = [chr(c) for c in range(start, start + 16)]
        check("".join(run))
        check("a".join(run) + " " + " ".join(run))
        check("'s".join(run))


def test_every_code_point():
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 50_000):
        texts = [f"a{chr(c)}b" for c in points[start : start + 50_000]]
        expected = library().encode_batch(texts, add_special_tokens=False)
        rows = own().encode_all(pa.array(texts, pa.string()))
        assert all(row.tolist() == other.ids for row, other in zip(rows, expected))


def test_texts_of_rare_blocks():
    draw = random.Random(7)
    blocks = [(0x80, 0x600), (0x530, 0x560), (0x880, 0xD00), (0x1C80, 0x1D00), (0xA700, 0xA800), (0xD7B0, 0xD800)]
    blocks += [(0xF900, 0x10000), (0x10000, 0x11000), (0x1E000, 0x1F000), (0xE000, 0x110000)]
    parts = ["the", " ", "'s", "\u0301", "\u3099", "1"]
    texts = [
        "".join(draw.choice([chr(draw.randrange(*draw.choice(blocks))), draw.choice(parts)]) for _ in range(30))
        for _ in range(6_000)
    ]
    expected = library().encode_batch(texts, add_special_tokens=False)
    rows = own().encode_all(pa.array(texts, pa.string()))
    assert all(row.tolist() == other.ids for row, other in zip(rows, expected))


def test_batches_of_mixed_texts():
    texts = ["", "plain words", " spaced  out\n", "odd　space", "x<|endoftext|>y", "É'LL", "日本"] * 3
    rows = own().encode_all(pa.array(texts, pa.string()).slice(2))
    assert [r.tolist() for r in rows] == [library_ids(t) for t in texts[2:]]


def test_decoder_is_incremental():
    ids = own().encode("naïve café 日本 " * 50).tolist()
    decoder = bpe.TextDecoder(own())
    text = "".join(decoder.push([i]) for i in ids) + decoder.end()
    assert text == library().decode(ids, skip_special_tokens=False)
    assert bpe.decode(own(), np.array([320, 10**6, 321])) == "a</w> b</w>"


def test_digests(spark):
    docs = awkward(spark)
    rows = queries.token_digests(docs).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is not None:
            ids = library_ids(texts[r.doc_id])
            assert r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            decoded = library().decode(ids, skip_special_tokens=False)
            assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert queries.token_digests(empty(spark)).collect() == []


# files


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=50), max_size=20), st.booleans(), st.integers(1, 40))
def test_file_round_trip(documents, bits, block):
    stream = io.BytesIO()
    writer = token_files.PlaneWriter(stream, block=block, bits=bits)
    for i, ids in enumerate(documents):
        writer.add(None if i == 3 else i, np.array(ids, "<u4"))
    writer.close()
    reader = token_files.PlaneReader(stream, len(stream.getvalue()))
    flat = [x for ids in documents for x in ids]
    assert list(reader.documents()) == [
        (None if i == 3 else i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in enumerate(documents)
    ]
    assert reader.ids(0, len(flat)).tolist() == flat
    third = len(flat) // 3
    assert reader.ids(third, 2 * third).tolist() == flat[third : 2 * third]


def test_damaged_files_are_refused():
    stream = io.BytesIO()
    writer = token_files.PlaneWriter(stream)
    writer.add(1, np.arange(10, dtype="<u4"))
    writer.close()
    data = bytearray(stream.getvalue())
    for broken in (data[:10], data[:-1], bytes(len(data))):
        with pytest.raises(ValueError):
            token_files.PlaneReader(io.BytesIO(broken), len(broken))
    data[-token_files.FOOTER.size - 1] ^= 1
    with pytest.raises(ValueError):
        token_files.PlaneReader(io.BytesIO(data), len(data))


@pytest.mark.parametrize("bits", [False, True])
def test_files_of_awkward_documents(spark, bits):
    docs = awkward(spark).repartition(3)
    files = token_files.write_token_files(docs, PATH, bits=bits)
    rows = token_files.read_token_files(files).collect()
    keys = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect()))
    expected, start = [], 0
    for known, doc_id, text in keys:
        ids = np.array(library_ids(text) + [token_files.END_ID], "<u4")
        expected.append((doc_id if known else None, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == expected
    assert token_files.read_token_files(token_files.write_token_files(empty(spark), PATH)).collect() == []


def test_many_documents_in_order(spark):
    docs = spark.createDataFrame([(i, words(i % 50, i)) for i in range(2000, 0, -1)], "doc_id bigint, text string")
    rows = token_files.read_token_files(token_files.write_token_files(docs, PATH)).collect()
    rows.sort(key=lambda r: r.doc_id)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert len(rows) == 2000
