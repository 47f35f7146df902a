"""SimHash components, near copies and chunk de-duplication against brute force."""

import os
import random

import numpy as np
import pytest
from helpers import awkward, documents, empty, words
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wayfact.llm import chunk_dedup, common, simhash

DIRECTORY = "/root/testdata/sf0.001"


def components_by_hand(prints: dict[int, int], radius: int) -> dict[int, int]:
    ids = sorted(prints)
    group = {i: i for i in ids}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return {i: root(i) for i in ids}


def fingerprint_by_hand(text: str) -> int:
    import xxhash

    lowered = "".join(c.lower() if c.isascii() else c for c in text)
    found = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in lowered).split(" ") if w]
    if not found:
        return 0
    spans = [found[i : i + 3] for i in range(len(found) - 2)] or [found]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no test tables")
def test_components_of_the_given_documents(spark):
    docs = common.table(spark, DIRECTORY, "documents")
    prints = {r.doc_id: fingerprint_by_hand(r.text or "") for r in docs.collect()}
    expected = components_by_hand(prints, 2)
    rows = simhash.simhash_components(docs).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows} == prints
    assert {r.doc_id: r.component_id for r in rows} == expected


def test_links_find_every_close_pair(spark):
    draw = random.Random(5)
    centres = [draw.getrandbits(64) for _ in range(40)]
    prints = {}
    for i in range(600):
        value = centres[i % 40]
        for _ in range(draw.randrange(5)):
            value ^= 1 << draw.randrange(64)
        prints[i] = value
    first = {}
    for i, value in prints.items():
        first.setdefault(value, i)
    distinct = {i: v for v, i in first.items()}
    rows = [(i, simhash._signed(v)) for i, v in distinct.items()]
    found = {tuple(sorted(r)) for r in simhash.links_between(spark.createDataFrame(rows, "id bigint, f0 bigint")).collect()}
    expected = {
        (a, b) for a in distinct for b in distinct if a < b and (distinct[a] ^ distinct[b]).bit_count() <= 2
    }
    assert found == expected and len(expected) > 100


def test_radius_is_checked(spark):
    with pytest.raises(ValueError):
        simhash.links_between(spark.createDataFrame([], "id bigint, f0 bigint"), radius=5)


def test_long_chains_and_stars_of_links(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1300)]
    links = spark.createDataFrame(chain + star + chain[:5] + [(7, 7)], "src bigint, dst bigint")
    got = {r.node: r.component for r in common.components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}}
    assert common.components(links.limit(0)).collect() == []


def test_simhash_awkward_rows(spark):
    docs = awkward(spark)
    rows = simhash.simhash_components(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].fingerprint == "0" * 16 and by_id[2].component_id == by_id[3].component_id == 1
    assert by_id[4].component_id == by_id[5].component_id == 4
    nulls = [r for r in rows if r.doc_id is None]
    assert sorted(str(r.component_id) for r in nulls) == ["1", "None"]
    assert simhash.simhash_components(empty(spark)).collect() == []


def near_copies(seed: int, n: int, changes: int) -> list[str]:
    draw = random.Random(seed)
    base = words(200, seed).split()
    out = [" ".join(base)]
    for k in range(n):
        copy = list(base)
        for _ in range(changes):
            copy[draw.randrange(len(copy))] = f"new{k}x{draw.randrange(9999)}"
        out.append(" ".join(copy))
    return out


def test_one_of_each_group_of_near_copies_stays(spark):
    groups = [near_copies(s, 12, 2) for s in range(10)]
    rows = [(100 * g + i, text) for g, texts in enumerate(groups) for i, text in enumerate(texts)]
    rows += [(5000 + i, words(150, 50 + i)) for i in range(20)]
    kept = [r.doc_id for r in simhash.drop_near_duplicates(documents(spark, rows)).collect()]
    assert sorted(kept) == [100 * g for g in range(10)] + [5000 + i for i in range(20)]


def test_drop_near_duplicates_awkward_rows(spark):
    docs = awkward(spark)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 4, 6, 7, 8]
    assert sum(r.doc_id is None for r in kept.collect()) == 2
    assert simhash.drop_near_duplicates(empty(spark)).collect() == []


def shingle_sets(rows: list[tuple[int, str]]) -> dict[int, set[int]]:
    return {i: set(simhash.shingle_hashes(text.encode(), simhash.STAGE_WORDS).tolist()) for i, text in rows}


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b)


def one_end_changed(seed: int, changed: int, n: int = 204) -> list[str]:
    """Two texts of 200 shingles of which the last ``changed`` differ."""
    base = words(n, seed).split()
    return [" ".join(base), " ".join(base[: n - changed] + [f"z{seed}x{k}" for k in range(changed)])]


def test_every_lone_pair_just_above_the_threshold_is_found(spark):
    pairs = [one_end_changed(s, 17 + s % 6) for s in range(150)]  # 0.80 to 0.84
    rows = [(2 * s + k, text) for s, two in enumerate(pairs) for k, text in enumerate(two)]
    sets = shingle_sets(rows)
    assert all(0.8 <= jaccard(sets[2 * s], sets[2 * s + 1]) < 0.85 for s in range(150))
    links = {tuple(r) for r in simhash.near_duplicate_links(documents(spark, rows)).collect()}
    assert links == {(2 * s, 2 * s + 1) for s in range(150)}
    below = [(2 * s + k, t) for s in range(20) for k, t in enumerate(one_end_changed(s, 23))]
    assert simhash.drop_near_duplicates(documents(spark, below)).count() == 40


def test_crowded_keys_lose_no_near_copy(spark):
    # Texts that are mostly one passage share all their keys; only some are near copies.
    passage, rows = words(150, 7), []
    for s in range(60):
        own = f"{passage} {words(50, 100 + s)}".split()
        rows.append((2 * s, " ".join(own)))
        if s % 3 == 0:
            rows.append((2 * s + 1, " ".join(own[:-10] + [f"y{s}x{k}" for k in range(10)])))
    sets = shingle_sets(rows)
    copies = {i for i in sets if any(j < i and jaccard(sets[i], sets[j]) >= 0.8 for j in sets)}
    assert copies == {2 * s + 1 for s in range(0, 60, 3)}
    kept = {r.doc_id for r in simhash.drop_near_duplicates(documents(spark, rows)).collect()}
    assert kept == sets.keys() - copies


def test_counters_count_every_text(spark):
    rows = [(i, f"the same five words here {words(30, i + 1)}") for i in range(120)]
    rows += [(7, words(20, 500)), (7, words(20, 500)), (None, words(20, 501)), (200, None), (201, "")]
    expected = np.zeros(1 << simhash.LOG_COUNTERS, np.int64)
    for doc_id, text in rows:
        if doc_id is not None:
            for shingle in set(simhash.shingle_hashes((text or "").encode(), simhash.STAGE_WORDS).tolist()):
                expected[shingle >> 64 - simhash.LOG_COUNTERS] += 1
    counters = simhash.shingle_counters(documents(spark, rows).repartition(5), simhash.STAGE_WORDS)
    assert expected.max() >= 120 and (counters == expected).all()


def test_counters_reach_the_driver_packed(spark, monkeypatch):
    docs = documents(spark, [(i, f"{words(30_000, i)} the same five words here") for i in range(12)])
    frame, got = type(docs), []
    collect = frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda self: got.append(collect(self)) or got[-1])
    counters = simhash.shingle_counters(docs, simhash.STAGE_WORDS)
    assert np.count_nonzero(counters) > 250_000 and counters.sum() > 359_000
    assert sum(table.nbytes for table in got) < 2 << simhash.LOG_COUNTERS
    assert counters.nbytes <= 2 << simhash.LOG_COUNTERS


@pytest.mark.parametrize("pairs, stored", [([], 1), ([(1, 2), (3, 1), (9, 7), (1, 2), (4, 4)], 1), ([(1, 2), (2, 3)], 2)])
def test_components_end_with_stars(spark, monkeypatch, pairs, stored):
    calls, store = [], common.materialize
    monkeypatch.setattr(common, "materialize", lambda *args: calls.append(args) or store(*args))
    links = spark.createDataFrame(pairs, "src bigint, dst bigint")
    got = {r.node: r.component for r in common.components(links).collect()}
    near = {i: {i} for pair in pairs for i in pair if pair[0] != pair[1]}
    for a, b in 3 * [pair for pair in pairs if pair[0] != pair[1]]:
        near[a] = near[b] = near[a] | near[b]
    assert len(calls) == stored and got == {i: min(near[i]) for i in near}


# chunks


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=300))
def test_chunks_cover_a_text_and_split_no_character(text):
    data = text.encode("utf-8", "replace")
    ends = chunk_dedup.chunk_ends(data)
    assert (ends[-1] if len(ends) else 0) == len(data)
    assert "".join(data[a:b].decode() for a, b in zip([0, *ends], ends)) == data.decode()
    if len(data):
        assert chunk_dedup.chunk_words(data, ends).sum() == len(data.split())


def test_long_runs_without_white_space_are_cut():
    for text in (b"a" * 100_000, "日".encode() * 40_000):
        ends = chunk_dedup.chunk_ends(text)
        assert np.diff(ends, prepend=0).max() <= chunk_dedup.MAX_CHUNK and ends[-1] == len(text)
        text[: ends[0]].decode()


def test_gear_hash_by_hand():
    data = np.frombuffer(words(50).encode(), np.uint8)
    span = 1 << chunk_dedup.GEAR_STEPS
    got = chunk_dedup.gear_hashes(data)
    for i in range(len(data)):
        total = sum(int(chunk_dedup.GEAR[data[i - k]]) << k for k in range(min(span, i + 1)))
        assert got[i] == total & 0xFFFF


def test_insertions_do_not_shift_later_chunks():
    text = words(500)

    def chunks(value):
        ends = chunk_dedup.chunk_ends(value.encode()).tolist()
        return {value.encode()[a:b] for a, b in zip([0, *ends], ends)}

    whole, moved = chunks(text), chunks("something put in before " + text)
    assert len(whole - moved) <= 3


def test_repeated_passages_are_cut_once(spark):
    passage = words(80, 99)
    rows = [(i, f"{words(60, i)}\n{passage} {words(60, 200 + i)}") for i in range(30)]
    rows += [(100 + i, words(120, 400 + i)) for i in range(10)]
    docs = documents(spark, rows).repartition(5)
    cut = {r.doc_id: r for r in chunk_dedup.repeated_passages(docs).collect()}
    assert sorted(cut) == list(range(1, 30))
    out = {r.doc_id: r for r in chunk_dedup.cut_repeats(docs).collect()}
    assert len(out) == 40 and out[0].text == rows[0][1]
    for i in range(1, 30):
        assert out[i].text == cut[i].text and out[i].n_chars == len(out[i].text)
        assert cut[i].n_words_removed >= 60
        assert words(60, i) in out[i].text and words(60, 200 + i).split(" ", 12)[-1] in out[i].text
    assert all(out[100 + i].text == rows[30 + i][1] for i in range(10))


def test_phrases_of_different_documents_are_no_passage(spark):
    rows, pieces = [(i, words(120, i)) for i in range(6)], []
    for _, text in rows:
        ends = chunk_dedup.chunk_ends(text.encode()).tolist()
        own = next(piece for a, b in zip(ends, ends[1:]) if len((piece := text[a:b]).split()) in range(4, 12))
        pieces.append(own)
    mixed = words(40, 50) + " \n" + "".join(pieces) + words(40, 51)
    assert sum(len(piece.split()) for piece in pieces) >= 24
    rows += [(10, mixed), (11, f"{words(30, 60)}\n{words(120, 3)} {words(30, 61)}")]
    out = {r.doc_id: r.text for r in chunk_dedup.cut_repeats(documents(spark, rows)).collect()}
    assert out[10] == mixed and len(out[11].split()) < 100
    assert all(out[i] == text for i, text in rows[:6])


def test_same_result_in_any_partitioning(spark):
    passage = words(80, 99)
    rows = [(i, f"{words(30, i)} {passage}" * 2) for i in range(20)]
    results = [
        sorted((r.doc_id, r.text) for r in chunk_dedup.cut_repeats(documents(spark, rows).repartition(n)).collect())
        for n in (1, 7)
    ]
    assert results[0] == results[1]


def test_chunk_dedup_awkward_rows(spark):
    docs = awkward(spark)
    out = chunk_dedup.cut_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    rows = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert rows[1].text is None and rows[2].text == "" and rows[3].text == " \n\t "
    assert rows[4].text == words(60, 1) and rows[5].text == ""
    assert rows[6].text == words(30_000, 2)
    assert chunk_dedup.cut_repeats(empty(spark)).collect() == []
    assert chunk_dedup.repeated_passages(empty(spark)).collect() == []


def test_texts_of_one_doc_id_are_judged_apart(spark):
    shared = words(60, 1)
    rows = [(1, shared), (2, words(120, 2)), (2, shared + " " + words(40, 3)), (2, words(120, 2))]
    docs = documents(spark, rows, extra=True).withColumn("runs0", F.lit("x"))
    out = chunk_dedup.cut_repeats(docs)
    assert out.columns == docs.columns and out.count() == 4
    texts = sorted(r.text for r in out.collect())
    assert texts.count(words(120, 2)) == 2 and shared in texts
    [cut] = [t for t in texts if t not in (shared, words(120, 2))]
    assert words(30, 3).split(" ")[-1] in cut and len(cut.split()) < 60
    assert [r.doc_id for r in chunk_dedup.repeated_passages(docs).collect()] == [2]


def test_many_strangers_in_one_key_make_few_pairs(spark, monkeypatch):
    """Unlike texts that share one shingle, all of whose shingles count alike."""
    monkeypatch.setattr(simhash, "shingle_counters", lambda *_: np.zeros(1 << simhash.LOG_COUNTERS, np.uint32))
    rows = [(i, "one two three four five " + words(60, i + 1)) for i in range(400)]
    rows.append((1000, rows[7][1] + " more"))
    links = {tuple(r) for r in simhash.near_duplicate_links(documents(spark, rows)).collect()}
    assert links == {(7, 1000)}
