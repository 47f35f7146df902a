"""SimHash fingerprints linked through tables of distances to reference fingerprints.

By the triangle inequality two fingerprints within ``radius`` differ by at most
``radius`` in their distance to any reference. Each fingerprint carries its distances
to sixteen references; pairs whose distances differ by more are discarded, the rest
are verified bit by bit. Pairs meet where they agree on enough of the five bit groups:
``radius`` 2 leaves three of five groups equal, so no pair is missed.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from wayfact.llm.common import byte_texts, components, ids_and_texts, map_batches, without
from wayfact.llm.minhash import connecting_links
from wayfact.session import materialize

SEED = 42
RADIUS = 2
GROUPS = 5
REFERENCES = 16

# Near-duplicate stage: texts meet on their rarest five-word shingles, enough of them that
# no pair of ``STAGE_SIMILARITY`` is missed; then sizes, references and 128-bit fingerprints
# discard, and all shingles verify.
STAGE_WORDS = 5
STAGE_WIDTH = 2
STAGE_RADIUS = 44  # copies at 0.8 differ in about 19 bits (deviation 4), strangers in 64
STAGE_SIMILARITY = 0.8
LOG_COUNTERS = 20  # shingles share this many counters, as a power of two; they only order shingles
LOG_BLOCK = 10  # this many of them travel in one row, as a power of two


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _numbers(name: str, count: int) -> list[int]:
    """Fixed 64-bit numbers made from a name."""
    return [
        int.from_bytes(hashlib.sha256(f"{name} {i}".encode()).digest()[:8], "little") for i in range(count)
    ]


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` lower-cased words; of all words if they are fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes; zero without any."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = np.ascontiguousarray(hashes[start : start + (1 << 16)])
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little")
    return int(packed.view("<u8")[0])


def fingerprint(text: bytes, size: int = 3) -> int:
    return majority_bits(shingle_hashes(text, size))


def fingerprints(docs: DataFrame, size: int = 3, width: int = 1) -> DataFrame:
    """doc_id and fingerprint columns f0, f1, ... of 64 bits each, one row per row of ``docs``.

    The first takes the shingle hashes themselves, each further one a fixed mixing of
    them. Null and empty texts have fingerprint zero.
    """
    mixers = np.array(_numbers("mix", width), np.uint64) | np.uint64(1)

    def scan(batches):
        for batch in batches:
            columns = [[] for _ in range(width)]
            for text in byte_texts(batch):
                hashes = shingle_hashes(text, size)
                for k in range(width):
                    mixed = hashes
                    if k:
                        mixed = (hashes ^ (hashes >> np.uint64(31))) * mixers[k]
                        mixed ^= mixed >> np.uint64(29)
                    columns[k].append(_signed(majority_bits(mixed)))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    **{f"f{k}": pa.array(column, pa.int64()) for k, column in enumerate(columns)},
                }
            )

    schema = ", ".join(["doc_id bigint", *(f"f{k} bigint" for k in range(width))])
    return map_batches(ids_and_texts(docs), scan, schema)


def _distance(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, (F.bit_count(a.bitwiseXOR(b)) for a, b in zip(left, right)))


def with_references(prints: DataFrame, width: int = 1) -> DataFrame:
    """Adds r0 and r1: the distances to sixteen references, a byte each."""
    numbers = iter(_numbers("reference", REFERENCES * width))
    mine = [F.col(f"f{k}") for k in range(width)]
    for half in range(2):
        packed = F.lit(0).cast("bigint")
        for slot in range(REFERENCES // 2):
            reference = [F.lit(_signed(next(numbers))) for _ in range(width)]
            packed = packed.bitwiseOR(F.shiftleft(_distance(mine, reference).cast("bigint"), 8 * slot))
        prints = prints.withColumn(f"r{half}", packed)
    return prints


def references_allow(radius: int) -> Column:
    """Whether all sixteen distances of a and b differ by ``radius`` at most."""
    tests = []
    for half, slot in itertools.product(range(2), range(REFERENCES // 2)):
        a, b = (
            F.shiftrightunsigned(F.col(f"{side}.r{half}"), 8 * slot).bitwiseAND(F.lit(255)) for side in "ab"
        )
        tests.append(F.abs(a - b) <= radius)
    return reduce(lambda x, y: x & y, tests)


def group_masks(keep: int, groups: int = GROUPS) -> list[int]:
    """A mask for every choice of ``keep`` of ``groups`` groups of the 64 bits."""
    cuts = [64 * i // groups for i in range(groups + 1)]
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in itertools.combinations(single, keep)]


def links_between(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs (src, dst) of the distinct fingerprints (id, f0) within ``radius`` bits.

    Fingerprints within radius r share at least GROUPS - r whole groups, so an equality
    join on every such choice of groups brings each pair together. Every fingerprint is
    there once whatever the number of its texts; a crowded key is split by adaptive
    execution.
    """
    if not 0 < radius < GROUPS:
        raise ValueError(f"radius must lie between 1 and {GROUPS - 1}")
    keys = F.array(
        *(
            F.struct(F.lit(i).alias("choice"), F.col("f0").bitwiseAND(F.lit(_signed(mask))).alias("bits"))
            for i, mask in enumerate(group_masks(GROUPS - radius))
        )
    )
    tabled = with_references(prints)
    keyed = tabled.select("id", "f0", "r0", "r1", F.explode(keys).alias("key")).select(
        "id", "f0", "r0", "r1", "key.choice", "key.bits"
    )
    a, b = keyed.alias("a"), keyed.alias("b")
    close = _distance([F.col("a.f0")], [F.col("b.f0")]) <= radius
    on = (
        (F.col("a.choice") == F.col("b.choice"))
        & (F.col("a.bits") == F.col("b.bits"))
        & (F.col("a.f0") < F.col("b.f0"))
        & references_allow(radius)
        & close
    )
    return a.join(b, on).select(F.col("a.id").alias("src"), F.col("b.id").alias("dst")).distinct()


def simhash_components(docs: DataFrame, radius: int = RADIUS, size: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; a component is named by the
    smallest doc_id in it. Null and empty texts share fingerprint zero. Repeated rows
    appear repeatedly. Rows without a doc_id get the component of their fingerprint,
    null if no row of it has an id. An empty table gives no rows.
    """
    prints = materialize(fingerprints(docs, size), "fingerprints")
    classes = materialize(prints.groupBy("f0").agg(F.min("doc_id").alias("first_id")), "classes")
    named = classes.where("first_id is not null")
    groups = components(links_between(named.select(F.col("first_id").alias("id"), "f0"), radius))
    classes = named.join(groups, named["first_id"] == groups["node"], "left").select(
        "f0", F.coalesce("component", "first_id").alias("component_id")
    )
    return prints.join(classes, "f0", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id"
    )


# near duplicates of whole texts


def shingle_counters(docs: DataFrame, size: int) -> np.ndarray:
    """How many texts hold the shingles of each counter, over all rows with a doc_id.

    Any order of shingles brings all pairs together; this one only keeps keys small, so a
    table of fixed size does. It reaches the driver in blocks, and neither there nor in
    the result a counter takes more bytes than the largest one needs.
    """
    shift = np.uint64(64 - LOG_COUNTERS)

    def scan(batches):
        held = np.zeros(1 << LOG_COUNTERS, np.int64)
        for batch in batches:
            for text in byte_texts(batch):
                places = (np.unique(shingle_hashes(text, size)) >> shift).astype(np.int64)
                np.add.at(held, places, 1)
        used = np.flatnonzero(held)
        yield pa.record_batch({"place": pa.array(used), "n": pa.array(held[used])})

    def pack(block):
        places, n = block["place"].to_numpy(), block["n"].to_numpy()
        held = np.zeros(1 << LOG_BLOCK, np.min_scalar_type(n.max()))
        held[places % (1 << LOG_BLOCK)] = n
        return pa.table({"block": places[:1] >> LOG_BLOCK, "held": pa.array([held.tobytes()], pa.binary())})

    texts = ids_and_texts(docs).where("doc_id is not null")
    counts = map_batches(texts, scan, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    blocks = counts.groupBy(F.shiftright("place", LOG_BLOCK)).applyInArrow(pack, "block bigint, held binary")
    blocks = [(row["block"], row["held"]) for row in blocks.toArrow().to_pylist()]
    width = max((len(held) for _, held in blocks), default=1 << LOG_BLOCK) >> LOG_BLOCK
    counters = np.zeros((1 << LOG_COUNTERS - LOG_BLOCK, 1 << LOG_BLOCK), f"u{width}")
    for place, held in blocks:
        counters[place] = np.frombuffer(held, f"u{len(held) >> LOG_BLOCK}")
    return counters.ravel()


def prefix_length(shingles: int, similarity: float) -> int:
    """How many of a set's first elements, in one order for all, meet those of any similar set."""
    return shingles - math.ceil(similarity * shingles - 1e-9) + 1 if shingles else 0


def signatures(docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """One row per row of ``docs``, about its set of shingles.

    doc_id, d0 and d1 (a digest of the set), n (its size), f0, f1 (its fingerprint) and
    prefix, the first of its shingles by rarity.
    """
    shared = docs.sparkSession.sparkContext.broadcast(shingle_counters(docs, size))
    shift = np.uint64(64 - LOG_COUNTERS)
    mixer = np.uint64(_numbers("mix", 2)[1] | 1)
    names = ("doc_id", "d0", "d1", "n", "f0", "f1", "prefix")
    kinds = (*[pa.int64()] * 3, pa.int32(), *[pa.int64()] * 2, pa.list_(pa.int64()))

    def scan(batches):
        counters = shared.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch)):
                own = np.unique(shingle_hashes(text, size))
                mixed = (own ^ (own >> np.uint64(31))) * mixer
                mixed ^= mixed >> np.uint64(29)
                rarity = counters[(own >> shift).astype(np.int64)]
                first = own[np.argsort(rarity, kind="stable")[: prefix_length(len(own), similarity)]]
                digest = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64).tolist()
                bits = [_signed(majority_bits(hashes)) for hashes in (own, mixed)]
                rows.append((doc_id, *digest, len(own), *bits, first.view(np.int64)))
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.record_batch([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], list(names))

    schema = "doc_id bigint, d0 bigint, d1 bigint, n int, f0 bigint, f1 bigint, prefix array<bigint>"
    return map_batches(ids_and_texts(docs).where("doc_id is not null"), scan, schema)


def near_duplicate_links(
    docs: DataFrame, size: int = STAGE_WORDS, similarity: float = STAGE_SIMILARITY, radius: int = STAGE_RADIUS
) -> DataFrame:
    """Links (src, dst) that join all near copies which are connected: shingles alike as sets.

    Texts of one set of shingles are linked to the first of them. Of the others, any two
    that are similar share a key, one of the rarest shingles of each. The members of a key
    first meet its smallest one: each is compared with the one it shares most keys with, then
    with all whose group is still another. Keys that then hold several groups are resolved by
    the exact distances of their members to a text of reference: pairs whose distances differ
    by more than a link allows are discarded, and what the others differ in decides. A pair
    is passed over only where links already connect it or cannot link it, so a crowd makes
    rows by its members, not its square.
    """
    percent = round(100 * similarity)
    words = [f"f{k}" for k in range(STAGE_WIDTH)]
    prints = materialize(signatures(docs, size, similarity), "signatures")
    first = prints.groupBy("d0", "d1").agg(F.min("doc_id").alias("id"))
    same = prints.select("doc_id", "d0", "d1").join(first, ["d0", "d1"]).where("doc_id <> id")
    same = materialize(same.select(F.col("id").alias("src"), F.col("doc_id").alias("dst")), "same")
    single = without(prints, same.select(F.col("dst").alias("doc_id"))).withColumnRenamed("doc_id", "id")
    facts = with_references(single.select("id", "n", *words), STAGE_WIDTH)
    facts = materialize(facts.select("id", F.struct("n", *words, "r0", "r1").alias("facts")), "facts")
    close = _distance([F.col(f"a.{w}") for w in words], [F.col(f"b.{w}") for w in words]) <= radius
    sizes = 100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")
    keyed = single.select("id", F.explode("prefix").alias("key"))
    return same.union(connecting_links(keyed, facts, sizes & references_allow(radius) & close, docs, size, percent))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of near copies, the one of smallest doc_id.

    A doc_id that occurs in several rows keeps one of them, that of the smallest digest of
    its text. Rows without a doc_id stay.
    """
    groups = components(near_duplicate_links(docs, **options))
    kept = without(docs, groups.where("node <> component").select(F.col("node").alias("doc_id")))
    repeated = docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    repeated = materialize(repeated, "repeated")
    many = kept.join(repeated, "doc_id", "left_semi").select(*docs.columns)
    order = Window.partitionBy("doc_id").orderBy(F.sha2(F.coalesce("text", F.lit("")), 256), F.to_json(F.struct(*docs.columns)))
    names = {name.lower() for name in docs.columns}
    place = next(name for name in (f"place{i}" for i in range(len(names) + 1)) if name not in names)
    many = many.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return without(kept, repeated).unionByName(many)
