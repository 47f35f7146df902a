"""Block-max WAND and the licence scan against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, documents, empty, words

from wayfact.llm import decontaminate, licences


def build(items: dict[int, str], threshold: float = 0.6) -> decontaminate.Index:
    read = decontaminate._items(sorted(items.items()))
    counts = Counter(w for item in read for w in set(item.words))
    length = sum(len(item.words) for item in read) / max(1, len(read))
    return decontaminate.Index.build(read, counts, len(read), max(1.0, length), threshold)


def random_items(n: int, seed: int) -> dict[int, str]:
    draw = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return {i: " ".join(draw.choices(vocabulary, weights, k=draw.randrange(3, 25))) for i in range(n)}


def scores_by_hand(items: dict[int, str], query: list[str]) -> dict[int, float]:
    split = {i: text.split() for i, text in items.items()}
    mean = sum(map(len, split.values())) / len(split)
    frequency = Counter(w for own in split.values() for w in set(own))
    out = {}
    for i, own in split.items():
        norm = decontaminate.K1 * (1 - decontaminate.B + decontaminate.B * len(own) / mean)
        weights = {
            w: math.log(1 + (len(items) - frequency[w] + 0.5) / (frequency[w] + 0.5))
            * n * (decontaminate.K1 + 1) / (n + norm)
            for w, n in Counter(own).items()
        }
        out[i] = sum(v for w, v in weights.items() if w in query) / sum(weights.values())
    return out


@pytest.mark.parametrize("seed", range(12))
def test_wand_finds_all_above_the_threshold(seed):
    items = random_items(400, seed)
    index = build(items)
    draw = random.Random(seed + 100)
    for threshold in (0.2, 0.5, 0.8):
        query = draw.sample([f"t{i}" for i in range(60)], draw.randrange(1, 30))
        numbers = [index.number[w.encode()] for w in query if w.encode() in index.number]
        found = {index.items[k].item_id: score for k, score in index.search(numbers, threshold)}
        expected = {i: s for i, s in scores_by_hand(items, query).items() if s >= threshold - 1e-9}
        assert found.keys() == expected.keys()
        assert all(abs(found[i] - expected[i]) < 1e-9 for i in found)


@pytest.mark.parametrize("seed", range(6))
def test_no_hopeful_passage_is_passed_over(seed):
    items = random_items(150, seed)
    index = build(items, 0.6)
    draw = random.Random(seed)
    text = " ".join(f"t{int(60 * draw.random() ** 2)}" for _ in range(700)).split()
    outside = len(index.postings)
    ids = np.array([index.number.get(w.encode(), outside) for w in text])
    step = index.passage // 2
    windows = max(1, -(-len(text) // step) - 1)
    hopeful = set(index.hopeful(ids, step, windows).tolist())
    for k in range(windows):
        own = ids[k * step : k * step + index.passage]
        if index.search([t for t in set(own.tolist()) if t < outside], 0.6):
            assert k in hopeful


def test_items_are_found_wherever_they_stand(spark):
    items = [(i, f"{words(20, 1000 + i)}. {words(8, 3000 + i)}") for i in range(30)]
    benchmark = spark.createDataFrame(items + [(98, None), (99, "")], "item_id bigint, text string")
    draw = random.Random(2)
    rows, expected = [], set()
    for d in range(60):
        text = words(300, d).split()
        if d % 3 == 0:
            at = draw.randrange(len(text))
            text[at:at] = items[d % 30][1].upper().split() if d % 2 else items[d % 30][1].split()
            expected.add((d, d % 30))
        if d % 3 == 1:  # half of an item is no leak
            text[5:5] = items[d % 30][1].split()[:14]
        rows.append((d, " ".join(text)))
    docs = documents(spark, rows, extra=True)
    found = decontaminate.benchmark_matches(docs, benchmark)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in expected}


def test_several_indexes_find_what_one_finds(spark, monkeypatch):
    items = [(i, f"{words(20, i)}. {words(8, 500 + i)}") for i in range(25)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(spark, [(i, f"{words(50, 900 + i)} {text} {words(50, 990 + i)}") for i, text in items])
    one = {tuple(r) for r in decontaminate.benchmark_matches(docs, benchmark).collect()}
    monkeypatch.setattr(decontaminate, "ITEMS_PER_INDEX", 7)
    many = {tuple(r) for r in decontaminate.benchmark_matches(docs, benchmark).collect()}
    assert {r[:2] for r in one} == {r[:2] for r in many} == {(i, i) for i in range(25)}
    assert decontaminate.drop_contaminated(docs, benchmark).count() == 0


def test_edited_and_partial_items_are_found(spark):
    items = [(i, f"{words(25, 1000 + i)}. {words(13, 3000 + i)}.") for i in range(40)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    draw, rows = random.Random(4), []
    for i, text in items:
        own = text.split()
        for changes in (1, 2):
            edited = list(own)
            for at in draw.sample(range(len(own)), changes):
                edited[at] = f"other{at}"
            rows.append((1000 * changes + i, edited))
        rows.append((3000 + i, own[:25]))  # the question without its answer
        at = draw.randrange(8)
        rows.append((4000 + i, own[at : at + 30]))  # four fifths in one piece
        rows.append((5000 + i, own[:12]))  # half of the question is no leak
        rows.append((6000 + i, draw.sample(own, len(own))))  # nor are the same words in any order
    docs = [(d, f"{words(70, 9000 + d)} {' '.join(own)} {words(70, 17000 + d)}") for d, own in rows]
    found = {(r.doc_id, r.item_id) for r in decontaminate.benchmark_matches(documents(spark, docs), benchmark).collect()}
    assert found == {(d, d % 1000) for d, _ in rows if d < 5000}


def test_question_is_found_beside_a_long_answer(spark):
    items = [(i, f"{words(12, i)}. {words(60, 100 + i)}.") for i in range(10)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(spark, [(i, f"{words(50, 900 + i)} {words(12, i)} {words(50, 990 + i)}") for i, _ in items])
    found = decontaminate.benchmark_matches(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i in range(10)}


def test_decontamination_awkward_rows(spark):
    docs = awkward(spark)
    benchmark = spark.createDataFrame([(1, words(60, 1)), (1, words(60, 1))], "item_id bigint, text string")
    found = decontaminate.benchmark_matches(docs, benchmark).collect()
    assert {r.doc_id for r in found} == {4, 5}
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.count() == docs.count() - 3
    nothing = benchmark.limit(0)
    assert decontaminate.benchmark_matches(docs, nothing).collect() == []
    assert decontaminate.drop_contaminated(docs, nothing).count() == docs.count()
    assert decontaminate.benchmark_matches(empty(spark), benchmark).collect() == []


# licences


def test_spelling_case_and_copyright_lines_do_not_matter(spark):
    mit = dict((name, text) for name, text in licences.KNOWN if len(text) > 500 and name == "MIT")["MIT"]
    changed = "  copyright (c) 2020 Somebody\n" + mit.upper().replace("LICENSE", "LICENCE").replace(",", " ;")
    rows = [
        (1, changed),
        (2, mit + " and more"),
        (3, "first line\nReleased under the MIT licence\nlast line"),
        (4, "Released under the MIT License."),
    ]
    found = {(r.doc_id, r.place, r.licence) for r in licences.licences(documents(spark, rows, extra=True)).collect()}
    assert found == {(1, 0, "MIT"), (3, 2, "MIT"), (4, 0, "MIT")}


def test_licences_awkward_rows(spark):
    docs = awkward(spark)
    assert licences.licences(docs).collect() == []
    assert licences.licences(empty(spark)).collect() == []
    twice = documents(spark, [(1, "Licensed under CC BY 4.0.")] * 2 + [(None, "licensed under cc by 4 0")])
    assert sorted(str(r.doc_id) for r in licences.licences(twice).collect()) == ["1", "1", "None"]
    none = spark.createDataFrame([], "digest string, licence string")
    assert licences.licences(twice, none).collect() == []


def test_licence_text_that_begins_with_copyright_stays(spark):
    isc = dict(licences.KNOWN)["ISC"].replace("above copyright notice", "above\ncopyright notice")
    rows = [
        (1, isc),
        (2, "Copyright (c) 2020 Jane Doe\n" + isc),
        (3, "Copyright 1999, 2001 by J. Doe and others\nAll rights reserved.\n\nReleased under the MIT Licence"),
        (4, "Released under the MIT licence licence"),
        (5, "copyright notice\nReleased under the MIT License."),
    ]
    found = {(r.doc_id, r.place, r.licence) for r in licences.licences(documents(spark, rows)).collect()}
    assert found == {(1, 0, "ISC"), (2, 0, "ISC"), (3, 0, "MIT"), (3, 4, "MIT"), (5, 2, "MIT")}


def test_neighbouring_spellings_are_all_replaced(spark):
    frame = spark.createDataFrame([("Licence licence, LICENCE  sub\nlicence sub license",)], "t string")
    row = frame.select(licences.canonical(frame.t).alias("c")).first()
    assert row.c == "license license license sublicense sublicense"
