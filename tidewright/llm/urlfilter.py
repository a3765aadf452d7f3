"""Allow and block rules on urls by a Bloom filter cascade, without joins on the main path.

A rule is a host and the beginning of a path. A url's keys are the suffixes of its host, at label
borders, each with the beginnings of its path of the lengths that rules have. Level 0 of the
cascade encodes the listed keys; level 1 the keys of the corpus that pass level 0 without being
listed; level 2 the listed keys that pass level 1; and so on until no false positive is left. As
all keys of the corpus went into it, membership is exact for every one of them.

Everything is DataFrame expressions. Only bit arrays reach the driver, of bounded size: where a corpus leaves more false
positives of level 0 than level 1 can hold, level 0 is built again for as much lower a rate. A list that the bound can't hold
is looked up by a join of the distinct keys instead, with the same verdicts. The
corpus is read once for the false positives of a level 0; they are made distinct with partial
aggregation, so that a host with a third of all rows sends one row from each task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import common

MAX_BITS = 1 << 24  # of a level: 2 MiB
FIRST_BITS = 1 << 16  # of level 0 at least, as far as the bound allows: so few bits of a small list leave it hardly a false positive
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    """Bit array of one level: bits of them in 64-bit words, hashes of them set for a key."""

    words: tuple[int, ...]
    bits: int
    hashes: int
    seed: int

    def positions(self, key: Column) -> list[Column]:
        size = F.lit(self.bits).cast("long")
        first, step = F.pmod(F.xxhash64(F.lit(self.seed), key), size), F.pmod(F.xxhash64(key, F.lit(self.seed + 1)), size)
        return [(first + F.lit(i) * step) % size for i in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        array = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        return _all(F.call_function("shiftright", F.get(array, F.floor(p / 64).cast("int")), (p % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1 for p in self.positions(key))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


class Cascade:
    """Exact membership in the listed keys for every key of the universe."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame, first_rate: float = 0.01, rate: float = 0.5, max_bits: int = MAX_BITS) -> Cascade:
        """listed and universe have a column key. max_bits bounds every level (2 MiB each as set); TooLarge where they can't hold the list."""
        levels: list[Level] = []
        include = common.durable(listed.filter("key is not null").distinct())
        n_in, exclude = include.count(), None
        while n_in:
            own, n_own = include, n_in
            level = _level(own, n_own, rate if levels else first_rate, len(levels) * 2 + 1, max_bits, 64 if levels else min(FIRST_BITS, max_bits))
            if exclude is None:
                passing = universe.select("key").filter(F.col("key").isNotNull() & level.passes(F.col("key")))
                wrong = passing.distinct().join(own, "key", "left_anti")
            else:
                wrong = exclude.filter(level.passes(F.col("key")))
            found = common.durable(wrong)
            n_in = found.count()
            if exclude is None and _bits(n_in, rate) > max_bits:
                # so many false positives: level 0 once more, at the rate that leaves half of what level 1 holds
                first_rate *= max_bits / (2 * _bits(n_in, rate))
                n_in = n_own
                continue
            levels.append(level)
            include, exclude = found, own
        return cls(levels)

    def contains(self, key: Column) -> Column:
        """Passing an odd number of levels in a row, counted from level 0, means listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[i].passes(key), out).otherwise(F.lit(i % 2 == 1))
        return out


class TooLarge(ValueError):
    """A level needs more bits than are allowed."""


def _level(keys: DataFrame, n: int, rate: float, seed: int, max_bits: int, least: int = 64) -> Level:
    hashes = max(1, round(-math.log2(rate)))
    bits = max(least // 64 * 64, _bits(n, rate))
    if bits > max_bits:
        raise TooLarge(f"a level needs {bits} bits; max_bits is {max_bits}")
    level = Level((), bits, hashes, seed)
    at = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("p"))
    rows = at.groupBy(F.floor(F.col("p") / 64).cast("int").alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("b")).collect()
    words = [0] * (bits // 64)
    for r in rows:
        words[r["w"]] = r["b"]
    return Level(tuple(words), bits, hashes, seed)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ? or #, its A-Z lower-cased. Path: from there up to ? or #.

    Null, or no ://: both empty.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """The url's keys. A rule's path is empty or begins with /, so that a key has one reading."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat_ws(".", F.slice(labels, i, n)))
    fit = F.filter(F.array(*[F.lit(x) for x in lengths]), lambda x: F.char_length(path) >= x)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.flatten(F.transform(suffixes, lambda s: F.transform(fit, lambda x: F.concat(s, F.substring(path, F.lit(1), x))))))


def _bits(n: int, rate: float) -> int:
    """Of a level for n keys."""
    return max(64, 64 * math.ceil(n * max(1, round(-math.log2(rate))) / math.log(2) / 64))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", first_rate: float = 0.01, max_bits: int = MAX_BITS) -> DataFrame:
    """page_id, host, path, rule, verdict for every url; rules are (verdict, host, path) rows.

    A rule fits its host and all subdomains, if the path begins with the rule's. The longest fitting
    rule (of host and path together; then of host) decides. Of one host and path with both verdicts
    block counts. Where no rule fits, so where the cascade lists none of the url's keys, rule is null and
    the verdict is default. Null urls and urls without :// have no host and fit no rule. Very long urls are read as a whole; repeated
    rows stay repeated; an empty table gives no rows; extra columns are ignored. Where levels of max_bits can't hold the rules
    or their false positives, the rules are joined.
    """
    for verdict, _, path in rules:
        if verdict not in ("allow", "block") or (path and not path.startswith("/")):
            raise ValueError("a rule is allow or block, a host, and a path that is empty or begins with /")
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = common.pick(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    if not rules:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    lengths = sorted({len(p) for _, _, p in rules})
    listed = _table(spark, sorted({h.translate(str.maketrans(UPPER, LOWER)) + p for _, h, p in rules}))
    blocked = _table(spark, sorted({h.translate(str.maketrans(UPPER, LOWER)) + p for v, h, p in rules if v == "block"}))
    own = keys(F.col("host"), F.col("path"), lengths)
    if _bits(len({h + p for _, h, p in rules}), first_rate) > max_bits:
        return _joined(urls, own, listed, blocked, default)
    try:
        member = Cascade.build(listed, urls.select(F.explode(own).alias("key")), first_rate, max_bits=max_bits)
        barred = Cascade.build(blocked, listed, first_rate, max_bits=max_bits)
    except TooLarge:
        return _joined(urls, own, listed, blocked, default)
    fitting = F.filter(own, member.contains)
    best = F.array_max(F.transform(fitting, lambda k: F.struct(F.char_length(k).alias("n"), F.char_length(F.substring_index(k, "/", 1)).alias("h"), k.alias("key"))))
    found = urls.withColumn("rule", best["key"])
    return found.withColumn("verdict", F.when(F.col("rule").isNull(), default).when(barred.contains(F.col("rule")), "block").otherwise("allow"))


def _joined(urls: DataFrame, own: Column, listed: DataFrame, blocked: DataFrame, default: str) -> DataFrame:
    """judge() by joins: of the distinct hosts and paths the keys meet the list, and the longest one goes back to the urls."""
    marked = listed.distinct().join(blocked.distinct().withColumn("barred", F.lit(True)), "key", "left")
    exploded = urls.select("host", "path").distinct().select("host", "path", F.explode(own).alias("key"))
    order = F.struct(F.char_length("key").alias("n"), F.char_length(F.substring_index("key", "/", 1)).alias("h"), "key", F.coalesce("barred", F.lit(False)).alias("barred"))
    best = exploded.join(marked, "key").groupBy("host", "path").agg(F.max(order).alias("best"))
    found = urls.join(best, ["host", "path"], "left")
    verdict = F.when(F.col("best").isNull(), default).when(F.col("best.barred"), "block").otherwise("allow")
    return found.select("page_id", "host", "path", F.col("best.key").alias("rule"), verdict.alias("verdict"))


def _table(spark: SparkSession, values: list[str]) -> DataFrame:
    return spark.createDataFrame([Row(key=v) for v in values], "key string")
