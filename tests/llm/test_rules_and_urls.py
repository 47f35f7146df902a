"""Quality rules and URL filters against brute force, and their SQL."""

import os
import random
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, documents, empty, words
from hypothesis import given, settings, strategies as st

import __spark_entry__ as entry
from oracle_check import compare, duck
from wayfact.llm import quality_rules, url_filter

DIRECTORY = "/root/testdata/sf0.001"
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no test tables")
@pytest.mark.parametrize("name", ["op1_quality_rules", "op2_url_filter", "op7_licences"])
def test_matches_sql(spark, name):
    frame = entry.queries()[name](spark, DIRECTORY)
    assert compare(frame, duck(DIRECTORY), entry.oracle_sql()[name]) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40), st.integers(1, 9))
def test_repeated_words(sequence, window):
    spots = Counter(tuple(sequence[i : i + window]) for i in range(len(sequence) - window + 1))
    covered = {
        i + k
        for i in range(len(sequence) - window + 1)
        if spots[tuple(sequence[i : i + window])] > 1
        for k in range(window)
    }
    assert quality_rules.repeated_words(sequence, window) == len(covered)


def test_gram_buckets_by_code_point():
    text = "aé日🙂b#"
    points = [ord(c) for c in text]
    expected = [
        sum(p * f for p, f in zip(points[i : i + 4], quality_rules.FACTORS)) % quality_rules.BUCKETS
        for i in range(3)
    ]
    assert quality_rules.gram_buckets(text.encode()).tolist() == expected
    assert len(quality_rules.gram_buckets(b"abc")) == 0


def test_ratio_rejects_texts_unlike_the_trusted(spark):
    draw, vocabulary = random.Random(1), words(200).split()
    good = [(i, " ".join(draw.choices(vocabulary, k=60))) for i in range(20)]
    bad = [(100 + i, " ".join(f"$$%{i}#{k}&" for k in range(40))) for i in range(5)]
    docs = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], LABELS)
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs, labels).collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in bad)
    stage = quality_rules.keep_good(docs, labels)
    assert stage.columns == docs.columns
    assert {r.doc_id for r in stage.collect()} == {i for i, _ in good}


def test_quality_rules_awkward_rows(spark):
    docs = awkward(spark)
    none = spark.createDataFrame([], LABELS)
    rows = quality_rules.quality_rules(docs, none).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_words == by_id[2].n_words == by_id[3].n_words == 0
    assert by_id[1].base_failed and not by_id[1].kept and by_id[1].score == 0
    assert by_id[6].n_words == 30_000 and by_id[6].kept  # nothing trusted: no score rejects
    assert quality_rules.quality_rules(empty(spark), none).collect() == []
    assert quality_rules.keep_good(empty(spark), none).columns == docs.columns


def test_log_ratios_without_trusted_texts():
    assert not quality_rules.log_ratios(np.zeros(4), np.ones(4)).any()


# URL filters

HOSTS = ["a.com", "example.com", "www.example.com", "x.www.example.com", "b.net", "casino.org", "m.casino.org", "o.org"]


def verdict_of(url):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    stops = [rest.find(c) for c in "/?#" if c in rest]
    host = rest[: min(stops)] if stops else rest
    tail = rest[len(host) :]
    stops = [tail.find(c) for c in "?#" if c in tail]
    path = tail[: min(stops)] if stops else tail
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [
        (len(h + p), h + p, a)
        for a, h, p in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    return host, path, None, "block" if host.endswith("casino.org") else "allow"


def pages(spark, urls):
    rows = [(i, url, "<p>", "clash", "clash") for i, url in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, rule string, verdict string")


def test_rules_and_listed_hosts(spark):
    draw = random.Random(3)
    urls = [
        f"http://{draw.choice(HOSTS).upper() if draw.random() < 0.2 else draw.choice(HOSTS)}"
        f"{draw.choice(['', '/', '/en/1', '/en', '/es/x?y=/fr/', '/fr/#a', '?q', '#h', '/de/://x'])}"
        for _ in range(300)
    ]
    urls += [None, "", "no scheme", "://", "http://", "a://b.com/en/", "http://www.example.com/en/", urls[0]]
    hosts = spark.createDataFrame([("casino.org",), (None,), ("casino.org",), ("unseen.org",)], "host string")
    for max_bits in (url_filter.MAX_BITS, 0):  # the cascade, and the join beyond its bound
        rows = url_filter.filter_urls(pages(spark, urls), hosts, max_bits=max_bits).collect()
        assert len(rows) == len(urls)
        for row in rows:
            assert (row.host, row.path, row.rule, row.verdict) == verdict_of(urls[row.page_id]), urls[row.page_id]


def test_cascade_is_exact(spark):
    universe = spark.range(20_000).selectExpr("concat('k', id) key")
    listed = spark.range(0, 20_000, 13).selectExpr("concat('k', id) key")
    cascade = url_filter.build_cascade(listed, universe)
    assert len(cascade.levels) > 1
    found = universe.where(cascade.contains(universe["key"]))
    assert found.count() == listed.count() == found.join(listed, "key").count()


def test_url_filter_empty(spark):
    assert url_filter.url_filter(pages(spark, [])).collect() == []
    assert url_filter.url_filter(pages(spark, [None])).first().verdict == "allow"
