"""URL filters by a Bloom filter cascade, with DataFrame functions only.

Level 0 encodes the listed keys; over the complete set of keys in the corpus it also
passes some others. Level 1 encodes those, level 2 the listed keys that level 1 passes,
and so on until a level passes nothing wrong. A key's first missing level then tells
exactly whether it is listed, without a join.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wayfact.llm.common import prepare
from wayfact.session import materialize

MAX_BITS = 1 << 26  # all levels of a cascade together, 8 MB; larger lists are joined
MAX_HASHES = 16

#: Fixed values: (action, host, path) of the rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Words between dots and hyphens that mark a host as unwanted.
BLOCKED_WORDS = ("casino", "bets", "pills", "ads", "spam", "adult")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """page_id, host and path; both are empty for a null url or one without ``://``."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise("")
    return pages.select(
        "page_id",
        F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER).alias("host"),
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def host_and_parents(host: Column) -> Column:
    """The host and every domain above it, longest first; none for an empty host."""
    labels = F.split(host, "\\.")
    ends = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(ends)


def rule_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Keys of all rules that could fit: parents of the host with beginnings of the path.

    ``lengths`` are the path lengths that rules have. A rule's key is its text, host and
    path joined; the host holds no slash and the path starts with one, so they don't mix.
    """
    none = F.array().cast("array<string>")

    def beginning(length: int) -> Column:
        start = F.substring(path, 1, length)
        keys = F.transform(host_and_parents(host), lambda parent: F.concat(parent, start))
        return F.when(F.length(path) >= length, keys).otherwise(none)

    return F.concat(none, *map(beginning, lengths))


@dataclass
class Cascade:
    """Levels of (words of 64 bits, bits, hashes); level i encodes listed keys if i is even."""

    levels: list[tuple[list[int], int, int]]

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        listed = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            listed = F.when(passes(key, i, *self.levels[i]), listed).otherwise(F.lit(i % 2 == 1))
        return listed


def positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits).cast("bigint")) for i in range(hashes)]


def passes(key: Column, level: int, words: list[int], bits: int, hashes: int) -> Column:
    """Whether all bits of a key are set in a level."""
    held = F.from_json(F.lit(json.dumps(words)), "array<bigint>")
    test = F.lit(True)
    for place in positions(key, level, bits, hashes):
        word = F.element_at(held, (F.floor(place / 64) + 1).cast("int"))
        test = test & (F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1)
    return test


def encode(keys: DataFrame, level: int, bits: int, hashes: int) -> list[int]:
    """The words of a filter over ``keys``: at most bits / 64 rows reach the driver."""
    place = F.explode(F.array(*positions(F.col("key"), level, bits, hashes)))
    rows = (
        keys.select(place.alias("place"))
        .groupBy(F.floor(F.col("place") / 64).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(place, 64) as int))")).alias("bits"))
        .collect()
    )
    words = [0] * math.ceil(bits / 64)
    for word, value in rows:
        words[word] = value
    return words


def build_cascade(listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS) -> Cascade | None:
    """A cascade telling the keys of ``listed`` from the rest of ``universe`` (columns key).

    ``universe`` must hold each key once. None if the filters would exceed ``max_bits``.
    """
    encoded, others = materialize(listed.join(universe, "key", "left_semi").distinct(), "listed"), universe
    n_listed = encoded.count()
    n_others = max(0, universe.count() - n_listed)
    levels: list[tuple[list[int], int, int]] = []
    rate = min(0.5, max(2.0**-MAX_HASHES, n_listed * math.sqrt(0.5) / max(1, n_others)))
    n, used = n_listed, 0
    while n:
        hashes = max(1, round(math.log2(1 / rate)))
        bits = max(64, math.ceil(n * hashes / math.log(2)))
        used += bits
        if used > max_bits:
            return None
        level = len(levels)
        words = encode(encoded, level, bits, hashes)
        levels.append((words, bits, hashes))
        wrong = others.where(passes(F.col("key"), level, words, bits, hashes))
        if not level:
            wrong = wrong.join(encoded, "key", "left_anti")
        wrong = materialize(wrong.select("key"), "wrong")
        encoded, others, rate = wrong, encoded, 0.5
        n = wrong.count()
    return Cascade(levels)


def unwanted_hosts(pages: DataFrame) -> DataFrame:
    """Hosts of the pages that hold one of ``BLOCKED_WORDS`` between dots and hyphens."""
    words = "|".join(BLOCKED_WORDS)
    hosts = with_host_and_path(pages).select("host").where(F.col("host").rlike(f"(^|[.-])({words})([.-]|$)"))
    return hosts.distinct()


def _parts(path_column: Column, lengths: list[int]) -> Column:
    return F.substring(path_column, 1, max(lengths)) if lengths else F.lit("")


def filter_urls(
    pages: DataFrame,
    hosts: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """page_id, host, path, rule and verdict, one row per row of ``pages``.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest
    fitting rule decides, of equal ones that of the longer host. Where none fits, a page is
    blocked if its host or a domain above it is one of ``hosts`` (column host), else allowed.
    Rules and hosts are keys of one cascade; if that would grow beyond ``max_bits``, the
    hosts are joined instead. Null urls have empty host and path and are allowed. Repeated
    rows are judged alike; an empty table gives no rows. Null ``hosts`` are ignored.
    """
    prepare(pages.sparkSession)
    judged = with_host_and_path(pages)
    lengths = sorted({len(path) for _, _, path in rules}, reverse=True)
    host, path = F.col("host"), F.col("path")

    def named(kind: str, keys: Column) -> Column:
        return F.transform(keys, lambda key: F.concat(F.lit(f"{kind} "), key))

    parts = judged.select("host", _parts(path, lengths).alias("path")).distinct()
    keys = F.concat(
        *(named(action, rule_keys(host, path, lengths)) for action in ("allow", "block")),
        named("host", host_and_parents(host)),
    )
    universe = materialize(parts.select(F.explode(keys).alias("key")).distinct(), "keys")
    spark = pages.sparkSession
    texts = [(f"{action} {host}{path}",) for action, host, path in rules]
    listed = spark.createDataFrame(texts, "key string")
    asked = hosts.where("host is not null and host <> ''").select(F.concat(F.lit("host "), "host").alias("key"))
    cascade = build_cascade(listed.union(asked.distinct()), universe, max_bits)
    joined = cascade is None
    if joined:
        cascade = build_cascade(listed, universe, max_bits=1 << 62)
    actions = F.flatten(
        F.transform(
            rule_keys(host, path, lengths),
            lambda key: F.array(
                *(F.struct(key.alias("rule"), F.lit(action).alias("action")) for action in ("block", "allow"))
            ),
        )
    )
    fitting = F.filter(actions, lambda x: cascade.contains(F.concat(x["action"], F.lit(" "), x["rule"])))
    best = F.array_max(
        F.transform(
            fitting,
            lambda x: F.struct(
                F.length(x["rule"]).alias("length"),
                F.instr(x["rule"], "/").alias("host_length"),
                x["rule"].alias("rule"),
                x["action"].alias("action"),
            ),
        )
    )
    judged = judged.withColumn("best", best)
    if joined:
        judged = judged.withColumn("__row", F.monotonically_increasing_id())
        judged = materialize(judged, "judged")
        blocked = (
            judged.select("__row", F.explode(host_and_parents(host)).alias("host"))
            .join(hosts.select("host").distinct(), "host", "left_semi")
            .select("__row")
            .distinct()
            .withColumn("unwanted", F.lit(True))
        )
        judged = judged.join(blocked, "__row", "left")
        unwanted = F.coalesce(F.col("unwanted"), F.lit(False))
    else:
        unwanted = F.exists(host_and_parents(host), lambda p: cascade.contains(F.concat(F.lit("host "), p)))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.when(unwanted, "block").otherwise("allow")).alias("verdict"),
    )


def url_filter(pages: DataFrame) -> DataFrame:
    """All pages under the fixed rules and the unwanted hosts among them."""
    return filter_urls(pages, unwanted_hosts(pages))
