"""Language identification by rank-order profiles of character n-grams.

A profile is a language's TOP most frequent n-grams in rank order. A document's own TOP n-grams are
compared to each profile: the out-of-place distance sums how far each n-gram's rank in the document is
from its rank in the profile, or TOP where the profile lacks it. The least distance names the language.
N-grams have one to three letters and know word borders; they are counted over whole texts, as
63-bit numbers in numpy.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm import common

TOP = 300
#: Documents for each language to learn from, about: those whose hash falls under the language's share.
SAMPLE = 1000
BLOCK = 1 << 20  # characters decoded at once


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's n-grams, ascending, and how often each occurs; none without a letter.

    Counted by blocks, each with the two letters before it, so that memory grows with the distinct n-grams only.
    """
    grams, n, before, left = [], [], np.array([32]), len(text)
    for part in common.blocks(text, BLOCK, 4096):
        left -= len(part)
        code = np.frombuffer(part.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        x = np.concatenate([before, np.where(_letters()[code], code, 32), [] if left else [32]]).astype(np.int64)
        x = x[np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])]  # one border between words
        new = len(before)
        if len(x) == new:
            continue
        two = x[:-1] << 21 | x[1:]
        three = two[:-1] << 21 | x[2:]
        own = [x[new:][x[new:] != 32], two[new - 1 :], three[max(0, new - 2) :][x[1:-1][max(0, new - 2) :] != 32]]
        found = np.unique(np.concatenate(own), return_counts=True)
        grams.append(found[0])
        n.append(found[1])
        before = x[-2:]
        if len(grams) > 8:
            grams, n = ([a] for a in _merged(grams, n))
    if not grams:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return (grams[0], n[0]) if len(grams) == 1 else _merged(grams, n)


def _merged(grams: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, at = np.unique(np.concatenate(grams), return_inverse=True)
    return every, np.bincount(at, np.concatenate(n), len(every)).astype(np.int64)


def ranked(grams: np.ndarray, n: np.ndarray, top: int) -> np.ndarray:
    """The top n-grams, most frequent first; ties by n-gram."""
    return grams[np.argsort(-n, kind="stable")[:top]]


@dataclass
class Profiles:
    langs: list[str]
    grams: np.ndarray  # of all profiles, ascending
    ranks: np.ndarray  # by language and n-gram; the last column is for n-grams in no profile
    top: int

    @classmethod
    def of(cls, orders: dict[str, np.ndarray], top: int) -> Profiles:
        langs = sorted(orders)
        grams = np.unique(np.concatenate([orders[k] for k in langs])) if langs else np.zeros(0, np.int64)
        ranks = np.full((len(langs), len(grams) + 1), -1, np.int64)
        for i, k in enumerate(langs):
            ranks[i, np.searchsorted(grams, orders[k])] = np.arange(len(orders[k]))
        return cls(langs, grams, ranks, top)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language (ties: the first by name) and how far it is ahead of the next, 0 to 1."""
        grams, n = counts(text) if text else (np.zeros(0, np.int64),) * 2
        if not len(grams) or not self.langs:
            return "und", 0.0
        own = ranked(grams, n, self.top)
        at = np.searchsorted(self.grams, own)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != own)] = len(self.grams)
        ranks = self.ranks[:, at]
        out = np.where(ranks < 0, self.top, np.abs(ranks - np.arange(len(own)))).sum(1)
        best = int(out.argmin())
        others = np.delete(out, best)
        return self.langs[best], 1.0 if not len(others) else float(others.min() / max(1, others.min() + out[best]))


def train(documents: DataFrame, modulus: int = 5, held: int = 0, sample: int = SAMPLE, top: int = TOP) -> Profiles:
    """Profiles from documents outside the held-out fold with a language.

    How many documents a language has is counted over all; its share of them that is about `sample` is
    chosen by hash, and their n-grams are counted on the executors.
    """
    own = common.pick(documents, "doc_id", "text", "lang").filter("lang is not null and text is not null").filter(common.remainder(F.col("doc_id"), modulus) != held)
    sizes = own.groupBy("lang").agg(F.count("*").alias("size"))
    h = F.pmod(F.xxhash64(F.lit("langid"), F.col("doc_id")), F.lit(1 << 20)).cast("double") / (1 << 20)
    chosen = own.join(F.broadcast(sizes), "lang").filter(h * F.col("size") < sample).select("lang", "text")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        held: dict[str, list] = defaultdict(list)
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held[lang].append(counts(text))
        langs, grams, n = [], [], []
        for lang, parts in held.items():
            g, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            langs += [lang] * len(g)
            grams.append(g)
            n.append(np.bincount(at, np.concatenate([p[1] for p in parts]), len(g)).astype(np.int64))
        join = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))
        return pa.record_batch([pa.array(langs, pa.string()), join(grams), join(n)], ["lang", "gram", "n"])

    total = common.map_arrow(chosen, each, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = total.withColumn("place", place).filter(F.col("place") <= top).collect()
    orders = {k: np.array([r["gram"] for r in sorted((r for r in rows if r["lang"] == k), key=lambda r: r["place"])]) for k in {r["lang"] for r in rows}}
    return Profiles.of(orders, top)


def predicted(text: Column, profiles: Profiles) -> Column:
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        common.let_go()
        return pa.array([dict(zip(("lang_pred", "score"), profiles.predict(t.as_py()), strict=True)) for t in texts], kind)

    return predict(text)


def identify(documents: DataFrame, modulus: int = 5, held: int = 0, sample: int = SAMPLE, top: int = TOP) -> DataFrame:
    """doc_id, held_out, lang_pred, score, of every document.

    Null texts and texts without a letter are 'und' with score 0, as is every text when there is nothing to learn
    from. Whole texts count, however long. Repeated rows stay repeated; an empty table gives no rows; extra columns are ignored.
    """
    profiles = train(documents, modulus, held, sample, top)
    own = common.pick(documents, "doc_id", "text")
    rows = own.select("doc_id", (common.remainder(F.col("doc_id"), modulus) == held).alias("held_out"), predicted(F.col("text"), profiles).alias("p"))
    return rows.select("doc_id", "held_out", F.col("p.lang_pred").alias("lang_pred"), F.col("p.score").alias("score"))
