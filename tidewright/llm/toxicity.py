"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is logistic in its distinct words and their beginnings of four and five
letters (inflected and compound words share those); a document's is the noisy-or of its sentences. Weights are fitted from document labels alone, by proximal gradient steps on the
noisy-or likelihood over a bounded sample; the l1 penalty leaves few words with a weight. A
sentence without any such word carries no evidence and has probability zero, so a long clean
document doesn't add up to a toxic one. Sentences of probability 0.5 or more are located.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm import common
from tidewright.llm.quality import labelled

#: Labelled documents to fit on, at most; every sentence of theirs counts.
SAMPLE = 4000
#: Features in fewer of these documents are left out.
RAREST = 5
WORDS = re.compile(r"[^\W_]+")
SENTENCES = re.compile(r"[^.!?\n]+[.!?\n]*|[.!?\n]+")


def features(sentence: str) -> set[str]:
    """Its lower-cased words; of longer ones also the beginnings, marked by a trailing hyphen."""
    words = set(WORDS.findall(sentence.lower()))
    return words | {w[:4] + "-" for w in words if len(w) > 4} | {w[:5] + "-" for w in words if len(w) > 5}


@dataclass
class Evidence:
    """Weights of features of a sentence, and the weight of any sentence."""

    weights: dict[str, float]
    bias: float

    def __post_init__(self):
        self.beginnings = {w[:-1] for w in self.weights if w.endswith("-")}

    def concerns(self, text: str) -> bool:
        """Whether some word of the text has a weight, or a beginning with one."""
        for part in common.blocks(text, reach=4096):
            words = set(WORDS.findall(part.lower()))
            if not self.weights.keys().isdisjoint(words) or any(w[:4] in self.beginnings or w[:5] in self.beginnings for w in words if len(w) > 4):
                return True
        return False

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, probability) of the sentences that hold a word with a weight."""
        if not self.concerns(text):
            return []
        found = []
        for m in SENTENCES.finditer(text):
            own = self.weights.keys() & features(m[0])
            if own:
                z = self.bias + sum(self.weights[w] for w in sorted(own))
                found.append((m.start(), m.end(), 1 / (1 + np.exp(-z))))
        return found

    def score(self, text: str) -> float:
        """Noisy-or over the sentences."""
        none = 1.0
        for _, _, p in self.sentences(text):
            none *= 1 - p
        return 1 - none


def bag(text: str, known: frozenset[str] | None = None) -> list[str]:
    """The features (of the known ones, if they are given) of each sentence that has some, as one text with spaces between."""
    own = (features(m[0]) for m in SENTENCES.finditer(text))
    return [" ".join(sorted(x)) for x in (o if known is None else o & known for o in own) if x]


def fit(bags: list[list[str]], y: np.ndarray, times: list[list[int]] | None = None, rounds: int = 120, rate: float = 0.1, l1: float = 4e-4, bias: float = -6.0, rarest: int = RAREST, smallest: float = 2.0) -> Evidence:
    """Weights from each document's bag() and its label; times says how often a document has each of its sentences (unset: once).

    Words in fewer than `rarest` documents, and weights under `smallest`, are left out. As in scoring, a sentence without any word left has probability zero.
    """
    ids: dict[str, int] = {}
    word, sentence, document, often = array("i"), array("i"), array("i"), array("i")  # a few bytes each, as there are millions
    df: list[int] = []
    for d, own in enumerate(bags):
        seen: set[int] = set()
        for i, features_ in enumerate(own):
            numbers = [ids.setdefault(w, len(ids)) for w in features_.split(" ")]
            seen.update(numbers)
            word.extend(numbers)
            sentence.extend([len(document)] * len(numbers))
            document.append(d)
            often.append(times[d][i] if times else 1)
        df += [0] * (len(ids) - len(df))
        for w in seen:
            df[w] += 1
    if not word or y.min() == y.max():
        return Evidence({}, bias)
    w, s, d, c = np.array(word), np.array(sentence), np.array(document), np.array(often, float)
    kept = np.array(df) >= rarest
    new = np.cumsum(kept) - 1
    s, w = s[kept[w]], new[w[kept[w]]]
    names = np.array(list(ids), object)[kept]
    v, n, docs = len(names), len(document), len(bags)
    told = np.zeros(n)
    told[s] = 1.0
    theta, m1, m2 = np.zeros(v), np.zeros(v), np.zeros(v)
    weight = np.where(y == 1, 1.0, 2.0) / docs  # a clean document taken for toxic counts twice
    for t in range(1, rounds + 1):
        z = bias + np.bincount(s, theta[w], n)
        p = told / (1 + np.exp(-np.clip(z, -30, 30)))
        log_none = np.bincount(d, c * np.log1p(-np.minimum(p, 1 - 1e-12)), docs)
        doc = -np.expm1(log_none)
        # derivative of the log likelihood: toxic documents pull by (1-P)/P, clean ones push by -1
        pull = np.where(y == 1, (1 - doc) / np.maximum(doc, 1e-12), -1.0) * weight
        grad = np.bincount(w, (pull[d] * p * c)[s], v)
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        step = rate / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-4)
        theta = theta + step * m1 / (1 - 0.9**t)
        theta = np.sign(theta) * np.maximum(np.abs(theta) - step * l1, 0)
    big = np.abs(theta) >= smallest
    return Evidence(dict(zip(names[big].tolist(), theta[big].tolist(), strict=True)), bias)


def train(documents: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, sample: int = SAMPLE) -> Evidence:
    """Weights from at most `sample` labelled documents, with all their sentences.

    Spark counts first in how many of them each feature is. Then each document sends its sentences, reduced to the features of enough documents;
    equal ones are counted, those that keep none are nothing to the fit. So what a long document sends is bounded by its different sentences.
    """
    own = common.durable(labelled(documents, labels, "toxic", sample, modulus, held))

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        every = [sorted(set().union(*(b.split(" ") for b in bag(t)))) for t in common.texts_of(batch.column(1))]
        return pa.record_batch([pa.array([w for e in every for w in e], pa.string())], ["feature"])

    counted = common.map_arrow(own, words, "feature string").groupBy("feature").count().filter(F.col("count") >= RAREST)
    known = frozenset(r["feature"] for r in counted.select("feature").collect())

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        bags = [Counter(bag(t, known)) for t in common.texts_of(batch.column(1))]
        return pa.record_batch([batch.column(0), batch.column(2).cast(pa.int32()), pa.array([list(b) for b in bags], pa.list_(pa.string())), pa.array([list(b.values()) for b in bags], pa.list_(pa.int32()))], ["doc_id", "y", "bag", "times"])

    rows = common.map_arrow(own, each, "doc_id long, y int, bag array<string>, times array<int>").toPandas().sort_values("doc_id")
    if rows.empty:
        return Evidence({}, -6.0)
    bags, times, y = [list(x) for x in rows["bag"]], [list(x) for x in rows["times"]], rows["y"].to_numpy(int)
    del rows
    return fit(bags, y, times)


def scored(text: Column, evidence: Evidence) -> Column:
    """A column of document scores; null counts as empty, an empty text has the score 0."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        common.let_go()
        return pa.array([float(evidence.score(x.as_py() or "")) for x in texts], pa.float64())

    return score(text)


def located(text: Column, evidence: Evidence, least: float = 0.5) -> Column:
    """The document's score and its offending sentences, as offsets in characters."""

    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))])

    @F.arrow_udf("score double, spans array<struct<start:int,end:int,score:double>>")
    def locate(texts: pa.Array) -> pa.Array:
        common.let_go()
        out = []
        for t in texts:
            found = evidence.sentences(t.as_py() or "")
            spans = [{"start": a, "end": b, "score": float(p)} for a, b, p in found if p >= least]
            out.append({"score": 1 - float(np.prod([1 - p for _, _, p in found])), "spans": spans})
        return pa.array(out, kind)

    return locate(text)


def score_documents(documents: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted, spans, of every document.

    Null, empty and very long texts are scored like others, as a whole; repeated rows stay repeated; an empty table gives no rows; extra columns are
    ignored. Without labels of both kinds every score is 0.
    """
    evidence = train(documents, labels, modulus, held, sample)
    own = common.pick(documents, "doc_id", "text")
    rows = own.select("doc_id", (common.remainder(F.col("doc_id"), modulus) == held).alias("held_out"), located(F.col("text"), evidence).alias("found"))
    return rows.select("doc_id", "held_out", F.col("found.score").alias("score"), (F.col("found.score") >= 0.5).cast("int").alias("predicted"), F.col("found.spans").alias("spans"))


def keep_clean(documents: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, sample: int = SAMPLE) -> DataFrame:
    """The documents with a score under 0.5, all their columns, also those whose names differ in case only.

    A null or empty text has score 0 and stays; very long ones are scored as a whole; repeated rows stay or go together; an empty table stays empty.
    """
    evidence = train(documents, labels, modulus, held, sample)
    plain, at = common.numbered(documents)
    return plain.withColumn("score", scored(F.col(at["text"]), evidence)).filter("score < 0.5").drop("score").toDF(*documents.columns)
