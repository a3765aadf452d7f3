"""Stupid-backoff language-model scores of documents, by joins of n-gram counts partitioned by hash.

The count of an n-gram is over the whole corpus. S(w | context) is count(context w) / count(context) if
count(context w) reaches `least`; else ALPHA times S(w | shorter context); at last count(w) / tokens. A
document's score is the sum of the natural logarithms.

Rows for single n-grams would make the shuffle many times the text. So documents are taken in shards of bounded
bytes (a longer text goes on in the next shard). A shard explodes its words into the distinct n-grams of
all orders, known by their hashes; each bucket of the hash space gets those of its range from the shard as one
packed row, with the shard's counts. A bucket adds up its table of counts, joins it to the n-grams of each shard, and
answers with their totals. The answers meet the shard's words, where the scores are summed for each text. An n-gram
that a third of all words belong to is one entry from each shard.

Buckets are as many as the text has portions of BUCKET bytes, so that a bucket's table stays of one size; rows are at most
the n-grams that are distinct within shards. Hashes have as many bits as keep the chance that an n-gram shares
its hash with another under about one in a million, 64 at most, whatever the corpus' size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import common

ALPHA = 0.4
#: Characters of text in a shard, and bytes of the corpus for each bucket of hashes.
SHARD, BUCKET = 16 << 20, 4 << 20
#: Characters split into words at once, about.
BLOCK = 1 << 20
TOTAL, BEGIN = np.uint64(0), np.uint64(1)  # stand-ins for the empty n-gram and for what precedes a text
_SCHEMA = "part string, shard long, bucket long, rows array<long>, docs array<long>, lengths array<int>, context array<int>, a binary, b binary"
_FIELDS = [f.split()[0] for f in _SCHEMA.split(", ")]
_KINDS = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "binary": pa.binary()}
_TYPES = pa.schema([(f.split()[0], _KINDS[f.split()[1]]) for f in _SCHEMA.split(", ")])


def _pack(x: np.ndarray) -> bytes:
    """Byte planes, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def _unpack(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of an n-gram from those of all but its last word and of its last word."""
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b << np.uint64(31) | b >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(32)


class _Ids(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Shard:
    """Words of whole texts and of parts of texts.

    A part that goes on with a text begins with the order - 1 words before it: as context, they are neither counted nor scored.
    """

    def __init__(self, order: int):
        self.order, self.ids, self.size = order, _Ids(), 0
        self.words: list[np.ndarray] = []  # word numbers, by part of a text
        self.rows, self.docs, self.lengths = [], [], []  # of the parts; lengths without context
        self.context: list[int] = []  # words of context in front; -1 where a text begins

    def put(self, row: int, doc: int | None, words: list[str], context: list[str] | None) -> None:
        own = [*(context or ()), *words]
        ids = self.ids
        self.words.append(np.fromiter((ids[w] for w in own), np.uint32, len(own)))
        self.rows.append(row)
        self.docs.append(doc)
        self.lengths.append(len(words))
        self.context.append(-1 if context is None else len(context))

    def exploded(self, number: int, width: int, bits: int) -> Iterator[pa.RecordBatch]:
        """A row of n-grams for each bucket that has some, and the shard's words as one row."""
        words = np.concatenate(self.words)
        hashes = np.fromiter((xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in self.ids), np.uint64, len(self.ids))
        self.ids.clear()
        self.words.clear()
        lengths, context = np.array(self.lengths, np.int64), np.array(self.context, np.int64)
        levels, fits, own = gram_hashes(words, hashes, lengths, context, self.order)
        asked = _narrow(levels, fits, width)
        counted = None if own.all() else _narrow(levels, [f & own for f in fits], width)
        del levels, fits
        asked.sort()
        first = _first(asked)
        keys = np.concatenate([np.array([TOTAL, BEGIN], np.uint64), asked[first]])
        if counted is None:
            n = np.diff(np.append(first, len(asked)))
        else:
            counted.sort()
            n = np.searchsorted(counted, keys[2:], "right") - np.searchsorted(counted, keys[2:], "left")
        del asked, counted, first
        n = np.concatenate([[own.sum(), (context < 0).sum()], n]).astype(np.uint64)
        bucket = keys >> np.uint64(width - bits)
        starts = _first(bucket)
        own_buckets, a, b = bucket[starts].astype(np.int64).tolist(), [], []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True):
            steps = np.diff(keys[s:e], prepend=bucket[s] << np.uint64(width - bits))
            a.append(_pack(steps))
            b.append(_pack(n[s:e]))
        m = len(a)
        yield _batch([["count"] * m, [number] * m, own_buckets, *[[None] * m] * 4, a, b])
        yield _batch([["words"], [number], [None], [self.rows], [self.docs], [self.lengths], [self.context], [_pack(words)], [_pack(hashes)]])


def _batch(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TYPES, strict=True)], schema=_TYPES)


def gram_hashes(words: np.ndarray, hashes: np.ndarray, lengths: np.ndarray, context: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each level the hashes of the n-grams that end at each word, and which of them are whole; which words are the parts' own.

    A text begins with BEGIN once, and n-grams don't reach further back.
    """
    given = np.maximum(context, 0)
    sizes = lengths + given
    at = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    room = at + np.repeat(context < 0, sizes)  # words before it that are known, a text's beginning included
    own = at >= np.repeat(given, sizes)
    h = hashes[words] if len(words) else np.zeros(0, np.uint64)
    levels, fits = [h], [np.ones(len(words), bool)]
    for level in range(2, order + 1):
        before = np.roll(levels[-1], 1)
        levels.append(_mix(np.where(at > 0, before, BEGIN) if level == 2 else before, h))
        fits.append(room >= level - 1)
    return levels, fits, own


def _narrow(levels: list[np.ndarray], fits: list[np.ndarray], width: int) -> np.ndarray:
    """Hashes of the whole n-grams of all levels in one array, of so many bits; TOTAL and BEGIN stay free."""
    every = np.concatenate([h[f] for h, f in zip(levels, fits, strict=True)])
    every >>= np.uint64(64 - width)
    return np.maximum(every, np.uint64(2), out=every)


def _first(ascending: np.ndarray) -> np.ndarray:
    """Where another value begins."""
    return np.flatnonzero(np.concatenate([[True], ascending[1:] != ascending[:-1]])) if len(ascending) else np.zeros(0, np.int64)


def _explode(batches: Iterator[pa.RecordBatch], order: int, width: int, bits: int) -> Iterator[pa.RecordBatch]:
    first, row, count = TaskContext.get().partitionId() << 32, 0, 0
    shard = Shard(order)
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            last = None  # the words before, once there are some
            for part in common.blocks(text.as_py() or "", BLOCK):
                words = part.lower().split()
                if not words:
                    continue
                if shard.size and shard.size + len(part) > SHARD:
                    yield from shard.exploded(first | count, width, bits)
                    shard, count = Shard(order), count + 1
                shard.put(first | row, doc, words, last)
                shard.size += len(part)
                last = [*(last or ()), *words][1 - order :] if order > 1 else []
            if last is None:
                shard.put(first | row, doc, [], None)
            row += 1
    if shard.rows:
        yield from shard.exploded(first | count, width, bits)


def _total(table: pa.Table) -> pa.Table:
    """Adds up a bucket's counts and answers each shard; rows of words pass."""
    if table.column("part")[0].as_py() != "count":
        return table
    keys = [np.cumsum(_unpack(x, np.uint64), dtype=np.uint64) for x in table.column("a").to_pylist()]
    counts = [_unpack(x, np.uint64) for x in table.column("b").to_pylist()]
    edges = np.cumsum([0, *map(len, keys)])
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    sums = np.zeros(int(place.max()) + 1, np.uint64)
    np.add.at(sums, place, np.concatenate(counts))
    answers = [_pack(sums[place[s:e]]) for s, e in zip(edges[:-1], edges[1:], strict=True)]
    table = table.set_column(_FIELDS.index("part"), "part", pa.array(["total"] * len(answers)))
    table = table.set_column(_FIELDS.index("a"), "a", pa.array([b""] * len(answers), pa.binary()))
    return table.set_column(_FIELDS.index("b"), "b", pa.array(answers, pa.binary()))


def _sum(table: pa.Table, order: int, least: int, width: int) -> pa.Table:
    """The scores of a shard's texts, or parts of texts, from its answers."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["part"] == "words")
    logs = np.concatenate([np.log(np.maximum(np.uint64(1), _unpack(r["b"], np.uint64))) for r in sorted((r for r in rows if r["part"] == "total"), key=lambda r: r["bucket"])])
    tokens, begins = logs[:2]
    lengths, context = np.array(head["lengths"], np.int64), np.array(head["context"], np.int64)
    levels, fits, own = gram_hashes(_unpack(head["a"], np.uint32), _unpack(head["b"], np.uint64), lengths, context, order)
    every = _narrow(levels, fits, width)
    del levels
    by = np.argsort(every)
    new = np.zeros(len(every), np.int8)
    new[_first(every[by])] = 1
    del every
    place = np.empty(len(by), np.int32)
    place[by] = np.cumsum(new, dtype=np.int32) + 1  # TOTAL and BEGIN stand in front
    del by, new
    ends = np.cumsum([0, *(int(f.sum()) for f in fits)])
    starts = np.zeros(len(own), bool)  # words that begin a text
    sizes = lengths + np.maximum(context, 0)
    starts[(np.cumsum(sizes) - sizes)[(context < 0) & (lengths > 0)]] = True
    below, score = np.zeros(0), np.zeros(0)
    for level in range(1, order + 1):
        whole = fits[level - 1]
        n = np.full(len(own), -np.inf)
        n[whole] = logs[place[ends[level - 1] : ends[level]]]
        if level == 1:
            score = n - tokens
        else:
            before = np.roll(below, 1)
            if level == 2:
                before[starts] = begins
            with np.errstate(invalid="ignore"):
                score = np.where(n >= np.log(least), n - before, np.where(whole, np.log(ALPHA) + score, score))
        below = n
    sums = np.bincount(np.repeat(np.arange(len(lengths)), lengths), score[own], len(lengths)).astype(float)
    return pa.table({"row": pa.array(head["rows"], pa.int64()), "doc_id": pa.array(head["docs"], pa.int64()), "n_tokens": pa.array(lengths), "score": pa.array(sums)})


def score_documents(documents: DataFrame, order: int = 3, least: int = 1) -> DataFrame:
    """doc_id, n_tokens, score (sum of natural logarithms), mean (score for each word; null without one).

    Words are what white space separates in the lower-cased text. A text begins with one mark that is
    context for its first word; n-grams don't reach further back. An n-gram that is counted less than `least` times
    backs off. The counts hold the scored documents themselves, so with one each of their n-grams is found; two lets those back off that occur nowhere else.
    Null and empty texts have no word and score 0. Very long texts are split at white space and summed
    up again. Repeated rows count and stay repeated. An empty table gives no rows.
    """
    own = common.pick(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits, width = max(2, (size // BUCKET).bit_length()), min(64, size.bit_length() + 24)
    exploded = own.mapInArrow(lambda batches: _explode(batches, order, width, bits), _SCHEMA)
    keyed = exploded.withColumn("key", F.when(F.col("part") == "words", F.xxhash64(F.lit("words"), "shard")).otherwise(F.xxhash64("bucket")))
    parts = min(2**bits, 1 << 16)  # tasks alone: a task takes its buckets, or shards, one after another
    answered = keyed.repartition(parts, "key").groupBy("part", "key").applyInArrow(lambda t: _total(t.select(_FIELDS)), _SCHEMA)
    scored = answered.repartition(parts, "shard").groupBy("shard").applyInArrow(lambda t: _sum(t, order, least, width), "row long, doc_id long, n_tokens long, score double")
    whole = scored.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.sum("score").alias("score"))
    return whole.select("doc_id", "n_tokens", "score", F.when(F.col("n_tokens") > 0, F.col("score") / F.col("n_tokens")).alias("mean"))
