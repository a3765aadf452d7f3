"""Text functions: normal forms, comparison keys, word similarity, rendering, key encoding."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from urllib.parse import quote_from_bytes

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from tidewright.functions.matching import matched

PUNCTUATION = ",.;:!?%)]}"
WORD = re.compile(r"\w+")  # letters, digits and numerals of any script, underscores


def _key(text: str | None) -> str:
    return " ".join(WORD.findall(unicodedata.normalize("NFKC", text or "").casefold()))


@F.pandas_udf(StringType())
def nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(StringType())
def comparison_key(texts: pd.Series) -> pd.Series:
    """NFKC and case-folded, everything but word characters a space, spaces collapsed."""
    return texts.map(_key)


def normalize_text(text: Column) -> Column:
    """NFC, white space collapsed and stripped, none before closing punctuation."""
    one = F.trim(F.regexp_replace(nfc(text), r"(?U)\s+", " "))
    return F.regexp_replace(one, r" +([,.;:!?%)\]}])", "$1")


def word_count(key: Column) -> Column:
    return F.when(F.coalesce(key, F.lit("")) == "", 0).otherwise(F.size(F.split(key, " ")))


def _ratio(a: str, b: str) -> int:
    x, y = a.split(), b.split()
    if not x or not y:
        return 1000 if not x and not y else 0
    return int(2.0 * min(matched(x, y)) / (len(x) + len(y)) * 1000 + 0.5)


@F.pandas_udf(IntegerType())
def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Permille of the word-level matching ratio of comparison keys, the lesser of both directions. Rows in order of the left text are cheaper."""
    out, last, key, known = [], object(), "", {}
    for a, b in zip(left, right, strict=True):
        if a != last:
            last, key, known = a, _key(a), {}
        if b not in known:
            known[b] = _ratio(key, _key(b))
        out.append(known[b])
    return pd.Series(out, dtype="int32")


def contains_words(outer: Column, inner: Column) -> Column:
    """Whether the words of inner stand in a row within the more words of outer."""
    n, m = F.size(outer), F.size(inner)
    return (m > 0) & (n > m) & F.exists(F.sequence(F.lit(0), F.greatest(n - m, F.lit(0))), lambda i: F.slice(outer, i + 1, F.greatest(m, F.lit(1))) == inner)


def _hashes(words: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of size words, and the place of each one's row. Words are known by 64 bits, a run by those of its words, each times another odd factor."""
    flat = words.flatten().dictionary_encode()
    own = pd.util.hash_array(np.array(flat.dictionary.to_pylist(), object), categorize=False) if len(flat.dictionary) else np.zeros(0, np.uint64)
    codes = flat.indices.fill_null(len(own)).to_numpy(zero_copy_only=False)
    each = np.append(own, np.uint64(0x9E3779B97F4A7C15))[codes]  # a null word has a hash as well
    lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    row, ends = np.repeat(np.arange(len(lengths)), lengths), np.cumsum(lengths)
    runs = np.zeros(max(0, len(each) - size + 1), np.uint64)
    for k in range(size):
        runs = runs * np.uint64(0xD6E8FEB86659FD93) + each[k : k + len(runs)]
    runs ^= runs >> np.uint64(32)
    row = row[: len(runs)]
    whole = np.arange(size, size + len(runs)) <= ends[row] if len(runs) else np.zeros(0, bool)
    return runs[whole], row[whole]


def shingles(words: Column, size: int) -> Column:
    """Hashes of all runs of size words, each once; none in fewer words."""

    @F.arrow_udf("array<bigint>")
    def of(rows: pa.Array) -> pa.Array:
        runs, row = _hashes(rows, size)
        order = np.lexsort((runs, row))
        runs, row = runs[order], row[order]
        once = np.append(True, (runs[1:] != runs[:-1]) | (row[1:] != row[:-1]))[: len(runs)]
        offsets = np.append(0, np.cumsum(np.bincount(row[once], minlength=len(rows))))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(runs[once].view(np.int64)))

    return of(words)


def _planes(numbers: np.ndarray) -> bytes:
    """First bytes of all numbers, then second ones and so on: planes of zeros take next to no room in a shuffle."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


SHARDS_LOG = 11  # runs are dealt to so many shards by the first bits of their hash
AT_ONCE = 1 << 20  # words hashed at once, about, unless one row has more


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    words = np.cumsum(batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.append(np.flatnonzero(np.diff(words // AT_ONCE, prepend=-1)), len(words)).tolist()
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(start, end - start)


def shingle_pairs(rows: DataFrame, size: int) -> DataFrame:
    """Pairs (a, b), a < b, of rows (id, words), ids being whole numbers: b shares a run of size words with a, and a is the least id that has the run. Each pair once.

    So a run in a third of all rows gives a pair for each row, not for any two of them. Runs travel by shard, sorted and as differences,
    as rows of single runs would take twice the room.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole)):
            runs, row = _hashes(batch.column(1), size)
            order = np.argsort(runs, kind="stable")
            runs, row = runs[order], row[order]
            once = np.append(True, (runs[1:] != runs[:-1]) | (row[1:] != row[:-1]))[: len(runs)]
            runs, ids = runs[once], batch.column(0).to_numpy(zero_copy_only=False)[row[once]]
            shard = (runs >> np.uint64(64 - SHARDS_LOG)).astype(np.int64)
            cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
            out = []
            for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                least = int(ids[start:end].min())
                out.append((int(shard[start]), least, _planes(np.diff(runs[start:end], prepend=np.uint64(0))), _planes((ids[start:end] - least).view(np.uint64))))
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["shard", "least", "runs", "ids"])

    def join(table: pa.Table) -> pa.Table:
        runs = np.concatenate([np.cumsum(_from_planes(r), dtype=np.uint64) for r in table.column("runs").to_pylist()])
        ids = np.concatenate([_from_planes(r).view(np.int64) + k for r, k in zip(table.column("ids").to_pylist(), table.column("least").to_pylist(), strict=True)])
        order = np.argsort(runs)
        runs, ids = runs[order], ids[order]
        starts = np.flatnonzero(np.append(True, runs[1:] != runs[:-1]))
        least = np.repeat(np.minimum.reduceat(ids, starts), np.diff(np.append(starts, len(ids))))
        two = np.stack((least, ids), 1)[least < ids]
        two = np.unique(two, axis=0) if len(two) else two
        return pa.table({"a": pa.array(np.ascontiguousarray(two[:, 0])), "b": pa.array(np.ascontiguousarray(two[:, 1]))})

    own = rows.filter("id is not null").select(F.col("id").cast("long").alias("id"), "words")
    shards = own.mapInArrow(deal, "shard long, least long, runs binary, ids binary")
    return shards.groupBy("shard").applyInArrow(join, "a long, b long").distinct()


def similar(pairs: DataFrame, texts: DataFrame, share: int = 32) -> DataFrame:
    """Pairs (a, b) with permille, by similarity() of the texts (id, text) of both.

    A row with many partners is dealt out: its text goes along once for about so many of them, each partner's once for each pair.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / share).alias("parts"))
    x = parts.join(texts.select(F.col("id").alias("a"), F.col("text").alias("_x")), "a").select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "_x")
    y = pairs.join(parts, "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("_y")), "b")
    y = y.select("a", F.pmod(F.xxhash64("_y"), F.col("parts")).alias("part"), "b", "_y")  # equal texts meet, and are compared once
    # a pair's time is known by its lengths, not its bytes: small partitions aren't put together
    tasks = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * pairs.sparkSession.sparkContext.defaultParallelism)
    both = y.repartition(tasks, "a", "part").join(x.repartition(tasks, "a", "part"), ["a", "part"])
    return both.select("a", "b", similarity("_x", "_y").alias("permille"))


def passages_within(inner: DataFrame, outer: DataFrame, inner_id: str, outer_id: str, size: int = 8) -> DataFrame:
    """(outer_id, inner_id) where the words of an inner row stand in a row within the more words of an outer row.

    Rows have words. An inner row is looked up by its first size words among all runs of the outer rows, then compared whole;
    one with fewer words is left out.
    """
    first = inner.filter(F.size("words") >= size).select(F.col(inner_id), F.col("words").alias("_inner"), shingles(F.slice("words", 1, size), size)[0].alias("_h"))
    runs = outer.select(F.col(outer_id), F.explode(shingles(F.col("words"), size)).alias("_h"))
    hits = runs.join(first.select(inner_id, "_h"), "_h").select(outer_id, inner_id).distinct()
    both = hits.join(outer.select(outer_id, F.col("words").alias("_outer")), outer_id).join(first.select(inner_id, "_inner"), inner_id)
    return both.filter(contains_words(F.col("_outer"), F.col("_inner"))).select(outer_id, inner_id)


def timestamp(ms: Column) -> Column:
    """HH:MM:SS.mmm"""
    part = lambda div, mod, width: F.lpad((F.floor(ms / div) % mod).cast("string"), width, "0")
    return F.concat(F.lpad(F.floor(ms / 3600000).cast("string"), 2, "0"), F.lit(":"), part(60000, 60, 2), F.lit(":"), part(1000, 60, 2), F.lit("."), part(1, 1000, 3))


def md_escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\`*_\[\]<>])", r"\\$1")


@F.pandas_udf(StringType())
def percent_encode(parts: pd.Series) -> pd.Series:
    """File-system bytes with all but unreserved ones percent-encoded, uppercase hex."""
    return parts.map(lambda p: None if p is None else quote_from_bytes(os.fsencode(p), safe=""))


def without_paths(text: Column) -> Column:
    """Absolute paths in a message become <path>."""
    return F.regexp_replace(text, r"(^|[\s'\"(=])/[^\s'\")]+", "$1<path>")


def redact(message: str) -> str:
    """without_paths() for a driver's message."""
    return re.sub(r"(^|[\s'\"(=])/[^\s'\")]+", r"\1<path>", message)
