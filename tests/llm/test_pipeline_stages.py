"""The pipeline as a whole, and what each stage keeps."""

import os

import pytest
from helpers import awkward, documents, empty

import corpus_pipeline
from wayfact.llm import common

DIRECTORY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no test tables")


def test_stages_by_hand_equal_run(spark):
    docs = common.table(spark, DIRECTORY, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIRECTORY)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        counts.append(len(rows))
        if name != "bpe":
            assert docs.columns == columns
    assert counts == sorted(counts, reverse=True) and counts[1] < counts[0]
    run = corpus_pipeline.run(spark, DIRECTORY).collect()
    assert sorted(map(tuple, run)) == sorted(map(tuple, rows))


def test_stages_on_awkward_and_empty_tables(spark):
    for start in (awkward(spark), empty(spark)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, DIRECTORY)
            if name != "bpe":
                assert docs.columns == start.columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)


def test_planted_cases(spark):
    labels = common.table(spark, DIRECTORY, "labels").where("quality = 1").limit(40)
    docs = common.table(spark, DIRECTORY, "documents")
    kept = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, DIRECTORY).collect()}
    good = [r for r in docs.join(labels, "doc_id").collect() if r.doc_id in kept]
    items = common.table(spark, DIRECTORY, "benchmark").collect()
    long = [r for r in good if len(set(r.text.split())) > 250]
    passage = " ".join(long[0].text.split()[20:100])

    def around(i: int, middle: str) -> str:
        own = long[i].text.split()
        return " ".join(own[100:160]) + f" {middle} " + " ".join(own[160:230])

    rows = [(r.doc_id, r.text) for r in good if r not in long[:11]]
    rows += [(10_000 + i, around(1 + i, passage)) for i in range(5)]
    rows += [(20_000 + i, around(6 + i, item.text)) for i, item in enumerate(items[:5])]
    rows += [(30_000, " ".join(["again"] * 100)), (30_001, "too short")]
    docs = documents(spark, rows)
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DIRECTORY)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    assert not {30_000, 30_001} & seen["quality_rules"].keys()
    planted = sorted(i for i in seen["simhash_near_dedup"] if 10_000 <= i < 20_000)
    whole = [i for i, text in seen["substring_dedup"].items() if passage in text]
    assert len(planted) >= 4 and whole == planted[:1]
    assert not {20_000 + i for i in range(5)} & seen["benchmark_decontamination"].keys()
    assert set(planted) <= seen["benchmark_decontamination"].keys()
