"""Near copies by a multi-index Hamming join of b-bit MinHash signatures.

A signature holds ``POSITIONS`` minima of ``BITS`` bits each; the distance of two is the
number of positions that differ. It is split into ``CHUNKS`` chunks. By the pigeonhole
principle two signatures within ``CHUNKS * (ERRORS + 1) - 1`` positions have a chunk with at
most ``ERRORS`` differing ones, so every choice of positions to leave out of a chunk is
enumerated as a key, and equal keys bring all such pairs together. All pairs that meet are
confirmed on the full sets of shingles.
"""

from __future__ import annotations

import hashlib
import itertools
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wayfact.llm.common import components, ids_and_texts, map_batches, split_words, with_ids
from wayfact.session import materialize

SIZE = 2  # words of a shingle
PERCENT = 80  # of the union that the intersection must reach
BITS = 12
CHUNK = 5  # positions of a chunk: 60 bits, one number
CHUNKS = 10
ERRORS = 1
POSITIONS = CHUNK * CHUNKS
GUARANTEED = CHUNKS * (ERRORS + 1) - 1  # all pairs that differ in so many positions meet
# Pairs that meet are passed over beyond this distance, which links at 0.8 reach with a
# probability below 1e-9 (10 positions differ on average, deviation 2.8).
FARTHEST = 30
CROWD = 16  # members of a key up to which all its open pairs are tried
PORTION = 1 << 20  # bytes of text whose shingles are held at once
LANE = (1 << BITS) - 1
SIGNATURE = [f"s{i}" for i in range(CHUNKS)]


def _odd_numbers(name: str, count: int) -> np.ndarray:
    digests = (hashlib.sha256(f"{name} {i}".encode()).digest()[:8] for i in range(count))
    return np.array([int.from_bytes(d, "little") | 1 for d in digests], np.uint64)


FACTORS = _odd_numbers("minimum", POSITIONS)
MIX, STEP, SPREAD = _odd_numbers("mix", 3)


def shingles(texts: pa.StringArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all texts' runs of ``size`` lower-cased words, and where each text's begin.

    A text of fewer words has one run, all of them; one without words has none.
    """
    words = split_words(pc.ascii_lower(texts))
    counts = np.asarray(pc.list_value_length(words), np.int64)
    coded = words.flatten().dictionary_encode()
    known = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64)
    one = known[np.asarray(coded.indices, np.int64)]
    firsts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    found = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(found)))
    place = np.arange(bounds[-1]) + np.repeat(firsts - bounds[:-1], found)
    width = np.repeat(np.minimum(counts, size), found)
    runs, hashes = one, np.zeros(bounds[-1], np.uint64)
    for w in range(1, size + 1):
        if w > 1:
            runs = (runs[:-1] ^ (runs[:-1] >> np.uint64(31))) * MIX + one[w - 1 :] * STEP
        chosen = width == w
        hashes[chosen] = runs[place[chosen]]
    return hashes ^ (hashes >> np.uint64(29)), bounds


def portions(batches, columns: tuple[str, ...] = ("left", "right"), limit: int = PORTION):
    """Rows of the batches, few enough at once that their texts take ``limit`` bytes or are one row's."""
    for batch in batches:
        sizes = sum(np.asarray(pc.fill_null(pc.binary_length(batch.column(c)), 0), np.int64) for c in columns)
        part = np.cumsum(sizes) // limit
        starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist()] if len(part) else []
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(a, b - a)


def minima(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The chunks of each text's signature, as rows of numbers; zeros without shingles."""
    full = np.flatnonzero(np.diff(bounds))
    packed = np.zeros((len(bounds) - 1, CHUNKS), np.int64)
    if len(full):
        starts = bounds[full]
        for position, factor in enumerate(FACTORS):
            least = np.minimum.reduceat(hashes * factor, starts)
            lane = ((least * SPREAD) >> np.uint64(64 - BITS)).astype(np.int64)
            chunk, slot = divmod(position, CHUNK)
            packed[full, chunk] |= lane << (BITS * slot)
    return packed


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, d0 and d1 (a digest of the set), n (its size) and the signature, a row a row."""

    def scan(batches):
        for batch in portions(batches, ("text",)):
            hashes, bounds = shingles(batch.column("text"), size)
            digests, sizes = [], []
            for a, b in itertools.pairwise(bounds.tolist()):
                own = np.unique(hashes[a:b])
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()))
            pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            chunks = minima(hashes, bounds)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "d0": pa.array(pairs[:, 0]),
                    "d1": pa.array(pairs[:, 1]),
                    "n": pa.array(sizes, pa.int64()),
                    **{name: pa.array(chunks[:, i]) for i, name in enumerate(SIGNATURE)},
                }
            )

    columns = ("doc_id", "d0", "d1", "n", *SIGNATURE)
    return map_batches(ids_and_texts(docs), scan, ", ".join(f"{c} bigint" for c in columns))


def keys() -> Column:
    """Of each chunk, what is left with any ``ERRORS`` positions left out, and which they are.

    The number of the key takes the place of the first position that is left out.
    """
    found = []
    for chunk, name in enumerate(SIGNATURE):
        for number, out in enumerate(itertools.combinations(range(CHUNK), ERRORS)):
            mask = sum(LANE << (BITS * slot) for slot in range(CHUNK) if slot not in out)
            tag = (chunk * CHUNK + number) << (BITS * out[0])
            found.append(F.col(name).bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(tag)))
    return F.array(*found)


def distance(left: str, right: str) -> Column:
    """Number of positions in which two signatures differ."""
    lows = F.lit(sum(1 << (BITS * slot) for slot in range(CHUNK)))

    def chunk(name: str) -> Column:
        bits = F.col(f"{left}.{name}").bitwiseXOR(F.col(f"{right}.{name}"))
        for shift in (6, 3):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift))
        bits = bits.bitwiseOR(F.shiftrightunsigned(bits, 1)).bitwiseOR(F.shiftrightunsigned(bits, 2))
        return F.bit_count(bits.bitwiseAND(lows))

    return reduce(lambda a, b: a + b, map(chunk, SIGNATURE))


def may_link(left: str, right: str, percent: int) -> Column:
    """Sizes near enough for ``percent`` of the union, and signatures not too far."""
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (distance(left, right) <= FARTHEST)


def with_texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (src, dst) with the texts of both, left and right."""
    pairs = materialize(pairs.select("src", "dst"), "pairs")
    ends = pairs.select(F.col("src").alias("doc_id")).union(pairs.select("dst")).distinct()
    texts = with_ids(ids_and_texts(docs), ends, "left_semi")
    left = texts.select(F.col("doc_id").alias("src"), F.col("text").alias("left"))
    right = texts.select(F.col("doc_id").alias("dst"), F.col("text").alias("right"))
    return pairs.join(left, "src").join(right, "dst").select("src", "dst", "left", "right")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (src, dst) whose full sets share at least ``percent`` of their union."""

    def verify(batches):
        for batch in portions(batches):
            left, at = shingles(batch.column("left"), size)
            right, to = shingles(batch.column("right"), size)
            keep = []
            for a, b, c, d in zip(at[:-1].tolist(), at[1:].tolist(), to[:-1].tolist(), to[1:].tolist()):
                x, y = np.unique(left[a:b]), np.unique(right[c:d])
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["src", "dst"])

    return materialize(map_batches(with_texts(pairs, docs), verify, "src bigint, dst bigint"), "links")


def differences(pairs: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """Of pairs (ref, id): n and m, the sizes of the sets of id and ref, and delta, in which they differ.

    What id has and ref lacks comes first, then what it lacks, each by value: one order of all
    elements for all sets compared with the same ref.
    """

    def scan(batches):
        for batch in portions(batches):
            own, at = shingles(batch.column("right"), size)
            ref, to = shingles(batch.column("left"), size)
            n, m, deltas = [], [], []
            for a, b, c, d in zip(at[:-1].tolist(), at[1:].tolist(), to[:-1].tolist(), to[1:].tolist()):
                x, y = np.unique(own[a:b]), np.unique(ref[c:d])
                n.append(len(x))
                m.append(len(y))
                more = np.setdiff1d(x, y, assume_unique=True)
                deltas.append(np.concatenate((more, np.setdiff1d(y, x, assume_unique=True))).view(np.int64))
            yield pa.record_batch(
                {
                    "ref": batch.column("src"),
                    "id": batch.column("dst"),
                    "n": pa.array(n, pa.int64()),
                    "m": pa.array(m, pa.int64()),
                    "delta": pa.array(deltas, pa.list_(pa.int64())),
                }
            )

    joined = with_texts(pairs.select(F.col("ref").alias("src"), F.col("id").alias("dst")), docs)
    return map_batches(joined, scan, "ref bigint, id bigint, n bigint, m bigint, delta array<bigint>")


def links_by_differences(members: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """All links between members (ref, id, label) of one ref, and to it, that lie in different labels.

    Two sets x and y differ in |dx| + |dy| - 2 |dx and dy| elements, dx and dy being their
    differences to ref. So, unless both are linked to ref, they link only if dx and dy share
    at least ``need`` elements, one at least, and then also one of the first elements of each
    in the common order. Random edits of copies seldom share any, so copies that are too
    different to link make few pairs, not their square.
    """
    deltas = differences(members.select("ref", "id"), docs, size).withColumn("d", F.size("delta").cast("bigint"))
    low, high = 100 - percent, 100 + percent  # sets link if high * (elements they differ in) <= low * (n + m)
    deltas = deltas.withColumn("close", high * F.col("d") <= low * (F.col("n") + F.col("m")))
    deltas = materialize(deltas.join(members, ["ref", "id"]), "deltas")
    to_ref = deltas.where("close and id <> ref").select(F.col("ref").alias("src"), F.col("id").alias("dst"))

    # Fewest elements shared with any partner that links: a partner's difference is itself
    # bounded, from above by what is shared, or is that of a set not linked to ref.
    excess = high * F.col("d") - low * (F.col("n") + F.col("m"))
    fewest = F.when(F.col("close"), F.floor((high - low) * F.col("d") / (2 * high))).otherwise(
        F.ceil(excess / F.lit(high + low))
    )
    firsts = F.expr("slice(delta, 1, cast(d - greatest(1, fewest) + 1 as int))")
    spread = deltas.where("d > 0").withColumn("fewest", fewest)
    spread = spread.select("ref", "id", "label", "n", "d", "close", F.posexplode(firsts).alias("at", "element"))
    a, b = spread.alias("a"), spread.alias("b")

    def need(x: str, y: str) -> Column:  # twice ``high`` times what both differences must share
        sizes = F.col(f"{x}.n") + F.col(f"{y}.n")
        return high * (F.col(f"{x}.d") + F.col(f"{y}.d")) - low * sizes

    most = F.least(F.col("a.d") - F.col("a.at"), F.col("b.d") - F.col("b.at"))  # if this is the first shared
    on = (F.col("a.ref") == F.col("b.ref")) & (F.col("a.element") == F.col("b.element"))
    on &= (F.col("a.id") < F.col("b.id")) & (F.col("a.label") != F.col("b.label"))
    on &= ~(F.col("a.close") & F.col("b.close")) & (need("a", "b") <= 2 * high * most)
    pairs = a.join(b, on).select("a.ref", F.col("a.id").alias("src"), F.col("b.id").alias("dst")).distinct()
    x = deltas.select("ref", F.col("id").alias("src"), F.struct("n", "d", "delta").alias("x"))
    y = deltas.select("ref", F.col("id").alias("dst"), F.struct("n", "d", "delta").alias("y"))
    shared = F.size(F.array_intersect("x.delta", "y.delta"))
    linked = pairs.join(x, ["ref", "src"]).join(y, ["ref", "dst"]).where(need("x", "y") <= 2 * high * shared)
    return to_ref.union(linked.select("src", "dst"))


def connecting_links(
    keyed: DataFrame, facts: DataFrame, may: Column, docs: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links (src, dst) that join all of (id, key) which links between members of a key connect.

    ``facts`` has id and facts, a struct; ``may`` tells of two of them, a and b, whether the
    pair is worth comparing. The members of a key first meet the
    key's smallest one: each is confirmed against the one it shares most keys with, then
    against all whose group is still another. Of keys whose other members then lie in
    different groups, those of up to ``CROWD`` members try all their pairs; the members of
    larger ones that have anyone worth comparing in another group are resolved by their
    differences to the smallest group's text. A pair is passed over
    only where links already connect it or cannot link it, so the groups are those of all
    links, while a key of g near copies makes g pairs or a few times that, not its square.
    """
    shared = keyed.groupBy("key").agg(F.count("*").alias("members"), F.min("id").alias("pivot"))
    shared = shared.where("members > 1").select("key", "pivot")
    members = materialize(keyed.join(shared, "key"), "members")

    def possible(pairs: DataFrame) -> DataFrame:
        a = facts.select(F.col("id").alias("src"), F.col("facts").alias("a"))
        b = facts.select(F.col("id").alias("dst"), F.col("facts").alias("b"))
        return pairs.join(a, "src").join(b, "dst").where(may).select("src", "dst")

    def labelled(rows: DataFrame, node: str, groups: DataFrame, label: str) -> DataFrame:
        named = groups.select(F.col("node").alias(node), F.col("component").alias(label))
        return rows.join(named, node, "left").withColumn(label, F.coalesce(label, node))

    stars = members.where("id <> pivot").groupBy(F.col("pivot").alias("src"), F.col("id").alias("dst"))
    stars = materialize(stars.agg(F.count("*").alias("common")), "stars")
    best = stars.groupBy("dst").agg(F.max_by("src", "common").alias("src"))
    best = materialize(best, "best")
    first = confirmed(possible(best), docs, size, percent)

    groups = materialize(components(first), "groups")
    rest = stars.join(best, ["src", "dst"], "left_anti").select("src", "dst")
    rest = labelled(labelled(rest, "src", groups, "a"), "dst", groups, "b").where("a <> b")
    second = confirmed(possible(rest.select("src", "dst")), docs, size, percent)

    found = first.union(second)
    groups = materialize(components(found), "groups")
    tagged = materialize(labelled(members, "id", groups, "label"), "tagged")
    others = tagged.where("id <> pivot")  # every pair with the pivot was compared or is connected
    mixed = others.groupBy("key").agg(
        F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    mixed = mixed.where("low <> high").select("key", "members")
    left = materialize(others.join(mixed, "key").select("key", "members", "id", "label"), "left")
    few, crowded = left.where(F.col("members") <= CROWD), left.where(F.col("members") > CROWD)
    a, b = few.alias("a"), few.alias("b")
    apart = (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.label") != F.col("b.label"))
    pairs = a.join(b, apart).select(F.col("a.id").alias("src"), F.col("b.id").alias("dst")).distinct()
    third = confirmed(possible(pairs), docs, size, percent)
    crowded = materialize(crowded.join(facts, "id").select("key", "id", "label", "facts"), "crowded")
    a = crowded.select("key", "id", "label", F.col("facts").alias("a"))
    b = crowded.select(F.col("key").alias("k"), F.col("label").alias("other"), F.col("facts").alias("b"))
    met = a.join(b, (F.col("key") == F.col("k")) & (F.col("label") != F.col("other")) & may, "left_semi")
    met = materialize(met.select("key", "id", "label"), "met")
    refs = met.groupBy("key").agg(F.min("label").alias("ref"))
    crowded = materialize(met.join(refs, "key").select("ref", "id", "label").distinct(), "crowded")
    return found.union(third).union(links_by_differences(crowded, docs, size, percent))


def links_between(classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (src, dst) that join all classes (id, n, signature) which links connect."""
    facts = classes.select("id", F.struct("n", *SIGNATURE).alias("facts"))
    keyed = classes.select("id", F.explode(keys()).alias("key"))
    return connecting_links(keyed, facts, may_link("a", "b", percent), docs, size, percent)


def minhash_components(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of ``docs``.

    Texts are sets of runs of ``size`` words, A-Z lower-cased; two link if the intersection
    is at least ``percent`` of the union. The component is named by the smallest doc_id that
    links reach, and kept says whether the row has that id. Copies of one set are one class.
    Null texts and texts without words have no shingles and link with nothing. Rows of one
    doc_id are one document, linked to whatever any of them is linked to. Rows without a
    doc_id get the component of the same set, null if no row of it has an id, and are not
    kept; they link no others. An empty table gives no rows.
    """
    rows = materialize(signatures(docs, size), "signatures")
    named = rows.where("n > 0 and doc_id is not null")
    classes = named.groupBy("d0", "d1").agg(
        F.min("doc_id").alias("id"), *(F.min(c).alias(c) for c in ("n", *SIGNATURE))
    )
    classes = materialize(classes, "classes")
    links = links_between(classes.drop("d0", "d1"), docs, size, percent)

    # A doc_id with several sets connects their classes.
    owned = named.select("doc_id", "d0", "d1").join(classes.select("d0", "d1", "id"), ["d0", "d1"])
    owned = materialize(owned.select("doc_id", "id"), "owned")
    several = owned.groupBy("doc_id").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    several = several.where("low <> high").select("doc_id")
    bridges = owned.join(several, "doc_id", "left_semi").select(F.col("id").alias("src"), F.col("doc_id").alias("dst"))

    groups = components(links.union(bridges))
    of_class = classes.join(groups, classes["id"] == groups["node"], "left").select(
        "d0", "d1", F.coalesce("component", "id").alias("found")
    )
    component = F.when(F.col("n") > 0, F.col("found")).otherwise(F.col("doc_id"))
    judged = rows.join(of_class, ["d0", "d1"], "left").withColumn("component_id", component)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return judged.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))
