"""Packing documents into token windows by multiway Karmarkar-Karp differencing.

A document longer than a window is cut into full windows and a remainder. Remainders are packed in
batches: each starts as a partial partition with itself in one of n parts; the two partial partitions with
the greatest imbalance are merged, the large parts of one with the small parts of the other, until one is
left. A few documents' remainders are cut into chips, as fine material for the last differences. The window count n begins at the least that could hold the batch and rises as long as a part exceeds the
capacity. Tokens don't travel: a piece is cut and its checksum taken where its document is tokenized.
"""

from __future__ import annotations

import heapq
import os
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import common

CAPACITY, END = 2048, 1
BATCH = 1024  # pieces packed together
#: The remainder of one document in so many is cut into chips of so many tokens: small parts let differencing end level.
EVERY, CHIP = 24, 48
CACHE = 600_000  # words whose tokens a Python worker remembers, at most
#: Texts of these characters only are split here; others go to the tokenizer as they are.
PLAIN = re.compile(r"[\t\n\r -~¡-ÿ]*")
#: How the tokenizer cuts lower-cased text into words, for those characters. Fixed pattern of its vocabulary file.
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\sa-zªµºß-öø-ÿ0-9²³¹¼-¾]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


class Words:
    """Token ids of texts. Words are tokenized once each and remembered; a full memory is emptied."""

    _shared: dict[str, Words] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    @classmethod
    def of(cls, path: str) -> Words:
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def ids(self, texts: list[str], remember: int = CACHE) -> Iterator[np.ndarray]:
        """For each text its ids and END."""
        end = np.array([END], "<u4").tobytes()
        split = [SPLIT.findall(t.lower()) if "<|" not in t and PLAIN.fullmatch(t) else None for t in texts]
        words = [s for s in split if s is not None]
        new = set(filterfalse(self.known.__contains__, chain.from_iterable(words)))
        if len(self.known) + len(new) > remember:
            self.known.clear()
            new = set(chain.from_iterable(words))
        self._learn(new)
        for t, s in zip(texts, split, strict=True):
            if s is None:
                raw = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                raw = b"".join(map(self.known.__getitem__, s))
            yield np.frombuffer(raw + end, "<u4")

    def _learn(self, words: Iterable[str]) -> None:
        """Words of ASCII go to the model straight, as normalizing and splitting leave them as they are, each whole; others all the way."""
        model, known, others = self.tokenizer.model, self.known, []
        for w in words:
            if w.isascii():
                ids = [t.id for t in model.tokenize(w)]
                known[w] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                others.append(w)
        for at in range(0, len(others), 1000):
            part = others[at : at + 1000]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.last[ids]) + 1
            if len(cuts) != len(part):
                pieces = [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4") for w in part]
            else:
                pieces = np.split(ids, cuts[:-1])
            known.update((w, p.tobytes()) for w, p in zip(part, pieces, strict=True))


def pieces(documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, remember: int = CACHE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, copy: every document cut into pieces of at most capacity ids.

    copy counts the rows of a task that are alike, so that rows repeated without end can be dealt to many tasks.
    """
    path = vocabulary or default_vocabulary()
    seen: Counter[tuple] = Counter()  # begins empty in every task

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        texts, docs = common.texts_of(batch.column(1)), batch.column(0).to_pylist()
        for at in range(0, len(texts), 500):
            for doc, ids in zip(docs[at : at + 500], Words.of(path).ids(texts[at : at + 500], remember), strict=True):
                alike = doc, len(ids), zlib.crc32(ids.tobytes())
                copy = seen[alike]
                seen[alike] += 1
                starts = list(range(0, len(ids), capacity))
                if len(ids) % capacity and alike[2] % EVERY == 0:
                    starts += range(starts[-1] + CHIP, len(ids), CHIP)
                for start, end in zip(starts, [*starts[1:], len(ids)], strict=True):
                    own = ids[start:end]
                    out.append((doc, start, len(own), zlib.crc32(own.tobytes()), len(ids), copy))
        columns = list(zip(*out, strict=True)) if out else [()] * 6
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "copy"])

    own = common.pick(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return common.map_arrow(own, each, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, copy long")


def karmarkar_karp(sizes: list[int], parts: int) -> list[list[int]]:
    """The places of the sizes, dealt to so many parts with near-equal sums."""
    if parts <= 1:
        return [list(range(len(sizes)))]
    heap = []
    for i, s in enumerate(sizes):
        sums = np.zeros(parts, np.int64)
        sums[0] = s
        heap.append((-s, i, sums, [(i, None), *[None] * (parts - 1)]))
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, a, own = heapq.heappop(heap)
        _, _, b, other = heapq.heappop(heap)
        sums = a + b[::-1]  # both descend: the largest part meets the smallest
        order = np.argsort(-sums, kind="stable")
        held = [x if y is None else y if x is None else (x, y) for x, y in zip(own, reversed(other), strict=True)]
        sums = sums[order]
        least = sums[-1]
        heapq.heappush(heap, (-int(sums[0] - least), count, sums - least, [held[i] for i in order.tolist()]))
        count += 1
    return [_members(x) for x in heap[0][3]]


def _members(tree) -> list[int]:
    out, stack = [], [tree]
    while stack:
        x = stack.pop()
        if x is None:
            continue
        if isinstance(x[0], int):
            out.append(x[0])
        else:
            stack += [x[1], x[0]]
    return out


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Parts of at most capacity, from the least count on that differencing can fill without exceeding it."""
    if not sizes:
        return []
    parts = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = [p for p in karmarkar_karp(sizes, parts) if p]
        if max(sum(sizes[i] for i in p) for p in dealt) <= capacity:
            return dealt
        parts += 1


def pack(cut: DataFrame, capacity: int = CAPACITY, batch_size: int = BATCH) -> DataFrame:
    """The pieces with sequence_id and offset. A sequence's pieces follow each other from offset 0.

    Pieces are dealt to tasks by hash and taken in order of their hash, so that the result doesn't depend on how
    documents that differ were split; a task holds one batch at a time. Rows that repeat are dealt apart by their copy.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count, held = TaskContext.get().partitionId() << 36, 0, []

        def out(table: pa.Table, sequence: np.ndarray, offset: np.ndarray) -> pa.RecordBatch:
            own = [table.column(c).combine_chunks() for c in columns]
            return pa.RecordBatch.from_arrays([*own, pa.array(sequence.astype(np.int64)), pa.array(offset.astype(np.int64))], names=[*columns, "sequence_id", "offset"])

        def flush(table: pa.Table) -> pa.RecordBatch:
            nonlocal count
            dealt = windows(table.column("length").to_pylist(), capacity)
            sizes = [len(w) for w in dealt]
            table = table.take(pa.array([i for w in dealt for i in w]))
            before = np.cumsum([0, *table.column("length").to_pylist()])[:-1]
            firsts = np.cumsum([0, *sizes])[:-1]
            number, count = base + count + np.repeat(np.arange(len(dealt)), sizes), count + len(dealt)
            return out(table, number, before - np.repeat(before[firsts], sizes))

        for batch in batches:
            table = pa.Table.from_batches([batch]).select(columns)
            full = pa.compute.greater_equal(table.column("length"), capacity)
            whole = table.filter(full)
            if len(whole):
                yield out(whole, base + count + np.arange(len(whole)), np.zeros(len(whole)))
                count += len(whole)
            held.append(table.filter(pa.compute.invert(full)))
            if sum(map(len, held)) >= batch_size:
                rows = pa.concat_tables(held)
                for at in range(0, len(rows) - len(rows) % batch_size, batch_size):
                    yield flush(rows.slice(at, batch_size))
                held = [rows.slice(len(rows) - len(rows) % batch_size)]
        if sum(map(len, held)):
            yield flush(pa.concat_tables(held))

    keyed = cut.withColumn("key", F.xxhash64("doc_id", "start", "ids_crc32", "copy"))
    ordered = keyed.repartition("key").sortWithinPartitions("key", "doc_id", "start", "ids_crc32", "doc_tokens")
    return ordered.mapInArrow(run, schema)


def pack_documents(documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, batch: int = BATCH, remember: int = CACHE) -> DataFrame:
    """Every document's tokens in sequences of at most capacity tokens; a row for each piece.

    Null texts count as empty and have the end token alone. Repeated rows are packed as often as they stand
    there. An empty table has no sequence; extra columns are ignored. A very long text is cut over as many sequences as it fills. remember bounds the words whose tokens a worker keeps: memory against time, with the same result.
    """
    return pack(pieces(documents, vocabulary, capacity, remember), capacity, batch)
