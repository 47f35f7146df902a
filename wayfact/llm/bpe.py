"""BPE as a streaming transducer with bounded lookahead, and its incremental decoder.

Symbols of a pre-token are pushed in; a token leaves once no later symbol can change
it. How many symbols that takes is computed from the merge list: whether a merge
happens depends, to the right, only on merges of earlier rank that overlap its end, on
those that overlap theirs, and so on with ever earlier ranks. The decoder turns tokens
into text byte by byte, holding back an unfinished character.
"""

from __future__ import annotations

import codecs
import heapq
import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers, pre_tokenizers

from wayfact.llm.common import IdTable, Memo, ids_and_texts, joined_ids, kept, map_batches, split_words

FLUSH = 4096  # symbols by which a long pre-token's buffer exceeds the lookahead
SHORT = 48
NEVER = 1 << 60
WIDE = 20  # bits of an id where two numbers are packed into one
MASK = (1 << WIDE) - 1
MEMO_WORDS = 50_000
TABLE_BYTES = 24 << 20  # of each table of ids of words met lately


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the others for the code points
    from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


#: Pieces with other characters, or a special token's first one, are normalised in Python:
#: from U+0300 on normal forms matter; the rest are white space beyond ASCII and one capital
#: that becomes two characters.
AWKWARD = r"[^\x{0}-\x{2FF}]|[\x1C-\x1F\x{85}\x{A0}\x{130}<]"


class TextIds:
    """Ids of whole texts, by pieces between white space and the words within them.

    New pieces are lower-cased and split into pre-tokens by Arrow, many at a time, and their
    words looked up; awkward ones go to ``pieces``. ``words`` and ``pieces`` encode lists.
    """

    def __init__(self, pattern: str, words: Callable, pieces: Callable, limit: int = 64 << 20) -> None:
        # The same pattern with white space spelt out, as the expression engine here knows less.
        spelt = pattern.replace(r"\s", r"\x09-\x0D\x20")
        self._pattern, self._other = f"({spelt})", pieces
        self._words = IdTable(lambda new: joined_ids(words(new)), limit)
        self._pieces = IdTable(self._encode, limit)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = pa.array(pieces, pa.string())
        awkward = pc.match_substring_regex(texts, AWKWARD)
        plain = pc.utf8_lower(texts.filter(pc.invert(awkward)))
        mixed = pc.invert(pc.utf8_is_alpha(plain))  # letters alone are one pre-token
        cut = pc.replace_substring_regex(plain.filter(mixed), self._pattern, r" \1 ")
        ids, cuts = self._words.rows(split_words(pc.replace_with_mask(plain, mixed, cut)))
        if not awkward.true_count:
            return ids, np.diff(cuts)
        rows = iter([ids[a:b] for a, b in zip(cuts, cuts[1:])])
        others = iter(self._other(texts.filter(awkward).to_pylist()))
        return joined_ids([next(others if odd else rows) for odd in awkward.to_pylist()])

    def __call__(self, texts: pa.StringArray) -> list[np.ndarray]:
        ids, cuts = self._pieces.rows(split_words(texts))
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


@dataclass
class Bpe:
    """A vocabulary with merges, read from a tokenizers file with word ends and no options."""

    vocab: dict[str, int]
    ranks: dict[tuple[str, str], int]
    suffix: str
    pattern: str
    special: dict[str, int]

    def __post_init__(self) -> None:
        self.lookahead = self._lookahead()
        self.token_bytes = {
            number: token.encode() for token, number in (self.vocab | self.special).items()
        }
        self._words = regex.compile(self.pattern)
        # Case, normal forms, letters and numbers beyond ASCII are those of the library's own Unicode tables.
        self._normal = normalizers.Sequence(
            [normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()]
        )
        self._split = pre_tokenizers.Split(Regex(self.pattern), "removed", invert=True)
        if any(regex.search(r"\s", mark) for mark in self.special):
            raise ValueError("special tokens with white space are not supported")
        self._marks = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        if max(self.token_bytes) > MASK:
            raise ValueError(f"ids above {MASK} are not supported")
        symbols = byte_symbols()
        self._inner = [self.vocab[s] for s in symbols]
        self._final = [self.vocab[s + self.suffix] for s in symbols]
        self._length = {number: len(self._parts(token)) for token, number in self.vocab.items()}
        self._pairs = {
            self.vocab[a] << WIDE | self.vocab[b]: rank << WIDE | self.vocab[a + b]
            for (a, b), rank in self.ranks.items()
        }
        self._heads = {mark[:1] for mark in self.special}
        self._known = Memo(self.word_ids, MEMO_WORDS)
        self.encode_all = TextIds(
            self.pattern,
            lambda words: [self.word_ids(word) for word in words],
            lambda pieces: [self.piece_ids(piece) for piece in pieces],
            TABLE_BYTES,
        )

    @classmethod
    def read(cls, path: str) -> Bpe:
        with open(path, encoding="utf-8") as file:
            return cls.parse(file.read())

    @classmethod
    def parse(cls, text: str) -> Bpe:
        spec = json.loads(text)
        model = spec["model"]
        kinds = [step["type"] for step in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE":
            raise ValueError("this tokenizer's normalisation is not supported")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return cls(
            vocab=model["vocab"],
            ranks={pair: rank for rank, pair in enumerate(pairs)},
            suffix=model["end_of_word_suffix"] or "",
            pattern=spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"],
            special={t["content"]: t["id"] for t in spec["added_tokens"]},
        )

    def _parts(self, token: str) -> tuple[str, ...]:
        """The symbols of a token; the last may carry the word end."""
        if self.suffix and token.endswith(self.suffix):
            body = token[: -len(self.suffix)]
            return (*body[:-1], body[-1:] + self.suffix)
        return tuple(token)

    def _lookahead(self) -> int:
        """Symbols after a token that suffice to make it final.

        ``reach`` of a merge is how far beyond its end symbols can matter to whether it
        happens: a merge of earlier rank may begin inside it and end beyond it, with its
        own reach; and both operands must come about. Ranks only fall along the way, so
        one pass in rank order finds it. A token is final when no merge can cross its
        end: longest token plus greatest reach.
        """
        reach: dict[tuple[str, ...], int] = {}
        beyond: dict[tuple[str, ...], int] = {}  # per prefix: most symbols to the end of a merge, and its reach
        longest = greatest = 1
        for left, right in self.ranks:
            a, b = self._parts(left), self._parts(right)
            whole = a + b
            far = max(reach.get(b, 0), reach.get(a, 0) - len(b), 0)
            for start in range(len(whole)):
                tail = whole[start:]
                far = max(far, beyond.get(tail, 0) - len(tail))
            reach[whole] = max(far, reach.get(whole, 0))
            for end in range(1, len(whole)):
                head = whole[:end]
                beyond[head] = max(beyond.get(head, 0), len(whole) + far)
            longest, greatest = max(longest, len(whole)), max(greatest, far)
        return longest + greatest

    def merge(self, ids: list[int]) -> list[int]:
        """Merges applied in rank order, leftmost first, until none is left."""
        if len(ids) > SHORT:
            return self._merge_long(ids)
        pair = self._pairs.get
        found = [pair(a << WIDE | b, NEVER) for a, b in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best == NEVER:
                break
            i = found.index(best)
            ids[i] = new = best & MASK
            del ids[i + 1], found[i]
            if i < len(found):
                found[i] = pair(new << WIDE | ids[i + 1], NEVER)
            if i:
                found[i - 1] = pair(ids[i - 1] << WIDE | new, NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of pairs over linked places."""
        pair, n = self._pairs.get, len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(pair(a << WIDE | b, NEVER), i) for i, (a, b) in enumerate(zip(ids, ids[1:]))]
        heap = [entry for entry in heap if entry[0] != NEVER]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or pair(ids[i] << WIDE | ids[j], NEVER) != best:
                continue
            ids[i], ids[j] = best & MASK, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0:
                    new = pair(ids[k] << WIDE | ids[after[k]], NEVER)
                    if new != NEVER:
                        heapq.heappush(heap, (new, k))
        return [number for number in ids if number >= 0]

    def stream(self, data: Iterable[int]) -> Iterator[int]:
        """Ids of one pre-token's bytes, each as soon as it is final.

        Holds lookahead plus ``FLUSH`` symbols, whatever the length of the pre-token.
        """
        held: list[int] = []
        limit = self.lookahead + FLUSH
        source = iter(data)
        ahead = next(source, None)
        while ahead is not None:
            byte, ahead = ahead, next(source, None)
            held.append(byte)
            if len(held) < limit or ahead is None:
                continue
            sure = 0
            for number in self.merge([self._inner[b] for b in held]):
                if sure + self._length[number] > len(held) - self.lookahead:
                    break
                sure += self._length[number]
                yield number
            held = held[sure:]
        if held:
            yield from self._last(held)

    def _last(self, data: Sequence[int]) -> list[int]:
        """Ids of what ends a pre-token: its end is known, so all of them are final."""
        ids = [*map(self._inner.__getitem__, data)]
        ids[-1] = self._final[data[-1]]
        return self.merge(ids)

    def word_ids(self, word: str) -> tuple[int, ...]:
        data = word.encode()
        return tuple(self._last(data) if len(data) <= self.lookahead + FLUSH else self.stream(data))

    def piece_ids(self, piece: str) -> Sequence[int]:
        """Ids of a text without white space, not yet normalised."""
        if not self.has_special(piece):
            return self._plain_ids(piece)
        out: list[int] = []
        start = 0
        for mark in self._marks.finditer(piece):
            out.extend(self._plain_ids(piece[start : mark.start()]))
            out.append(self.special[mark.group()])
            start = mark.end()
        return [*out, *self._plain_ids(piece[start:])]

    def has_special(self, piece: str) -> bool:
        for head in self._heads:
            if head in piece:
                return self._marks.search(piece) is not None
        return False

    def _plain_ids(self, piece: str) -> Sequence[int]:
        known, words = self._known, self.words(piece)
        if len(words) == 1:
            return known[words[0]]
        return [number for word in words for number in known[word]]

    def words(self, piece: str) -> list[str]:
        """Pre-tokens of a text without special tokens, normalised."""
        if piece.isascii():
            return self._words.findall(piece.lower())
        return [word for word, _ in self._split.pre_tokenize_str(self._normal.normalize_str(piece))]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]


def opened(spec: str) -> Bpe:
    """The vocabulary of a tokenizer's file; a worker keeps it, with its memory of words, for its next task."""
    return kept(("bpe", spec), lambda: Bpe.parse(spec))


class TextDecoder:
    """Tokens in, text out: bytes are held only while they form an unfinished character.

    Tokens are separated by one space, as decoding without a decoder joins them; ids
    outside the vocabulary give nothing.
    """

    def __init__(self, bpe: Bpe) -> None:
        self._tokens = bpe.token_bytes
        self._first = True
        self._utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, numbers: Iterable[int]) -> str:
        """The text that the next tokens complete."""
        try:
            known = [*map(self._tokens.__getitem__, numbers)]
        except KeyError:
            known = [token for token in map(self._tokens.get, numbers) if token is not None]
        if not known:
            return ""
        lead = b"" if self._first else b" "
        self._first = False
        return self._utf8.decode(lead + b" ".join(known))

    def end(self) -> str:
        return self._utf8.decode(b"", True)


def decode(bpe: Bpe, ids: np.ndarray, step: int = 1 << 16) -> str:
    decoder = TextDecoder(bpe)
    parts = [decoder.push(ids[i : i + step].tolist()) for i in range(0, len(ids), step)]
    return "".join([*parts, decoder.end()])


def transcode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the text decoded from them, one row per row of ``docs``.

    ``path`` names the tokenizer's file. A null text is empty: no ids, empty text.
    Repeated rows and null ids are passed on; an empty table gives no rows.
    """
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def scan(batches):
        bpe = opened(shared.value)
        for batch in batches:
            rows = bpe.encode_all(batch.column("text"))
            offsets = np.cumsum([0, *map(len, rows)], dtype=np.int32)
            values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                    "decoded": pa.array([decode(bpe, row) for row in rows], pa.string()),
                }
            )

    return map_batches(ids_and_texts(docs), scan, "doc_id bigint, ids array<int>, decoded string", keeps=True)
