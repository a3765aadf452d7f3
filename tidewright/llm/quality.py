"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Trees are fitted on the driver from a bounded sample of labelled rows (SAMPLE of them at most) and
flattened into arrays, so that a batch of rows goes down all trees in a few numpy steps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm import common

#: Labelled rows to fit on, at most: those with the least hashes of doc_id.
SAMPLE = 8000
#: Frequent function words of the corpus languages. Fixed values, as text.
FUNCTION_WORDS = frozenset(
    "the of and to in a is that it for on was with be as by this are or at from he an not "
    "de la le les et des un une en du que qui dans pour par sur au "
    "der die das und ist von zu den mit auf für ein eine im nicht sich "
    "el los las y se una del con no es lo su".split()
)
FEATURES = (
    "log_bytes", "upper", "lower", "digit", "space", "newline", "stop", "loud", "pipe", "symbol", "high",
    "word_bytes", "log_words", "distinct_words", "function_words", "lines_repeated", "words_a_line", "longest_word",
)
_CLASS = np.full(256, 9, np.uint8)  # symbol
for _i in range(256):
    _c = chr(_i)
    _CLASS[_i] = 10 if _i > 127 else 1 if "A" <= _c <= "Z" else 2 if "a" <= _c <= "z" else 3 if _c.isdigit() else 5 if _c == "\n" else 4 if _c.isspace() else 6 if _c in ".,;:'\"-()" else 7 if _c in "!?" else 8 if _c == "|" else 9


def statistics(texts: list[str]) -> np.ndarray:
    """A row of FEATURES for each text; an empty text has zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    codes = _CLASS[np.frombuffer(b"".join(raw), np.uint8)]
    ends = np.cumsum(lengths)
    for i, b in enumerate(raw):
        if not b:
            continue
        n = len(b)
        out[i, 1:11] = np.bincount(codes[ends[i] - n : ends[i]], minlength=11)[1:11] / n
        words = b.split()
        lines = [x for x in b.split(b"\n") if x.strip()]
        m = max(1, len(words))
        out[i, 0] = np.log1p(n)
        out[i, 11:] = (
            sum(map(len, words)) / m, np.log1p(len(words)), len(set(words)) / m, sum(w in _FUNCTION for w in words) / m,
            1 - len(set(lines)) / max(1, len(lines)), np.log1p(len(words) / max(1, len(lines))), np.log1p(max(map(len, words), default=0)),
        )
    return out


_FUNCTION = frozenset(w.encode() for w in FUNCTION_WORDS)


@dataclass
class Forest:
    """Complete binary trees of one depth: feature, threshold by inner node; value by leaf, of each tree."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        n = len(x)
        total = np.full(n, self.base)
        rows = np.arange(n)
        inner = self.feature.shape[1] if len(self.feature) else 0
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(n, np.int64)
            while len(at) and at[0] < inner:  # all rows are at the same depth
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += v[at - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: int = 10) -> Forest:
    """Boosting on the logistic loss with second-order gains over feature histograms.

    Ties between splits go to the lower feature, then the lower bin. One class only, or no row,
    gives no tree: the score is that class's smoothed share.
    """
    p = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    base = float(np.log(p / (1 - p)))
    empty = Forest(base, np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1)), np.zeros((0, 2**depth)))
    if len(y) < 2 * least or y.min() == y.max():
        return empty
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    b = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)  # bin k: cut k-1 < x <= cut k
    f0 = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        prob = 1 / (1 + np.exp(-f0))
        g, h = y - prob, prob * (1 - prob)
        feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best, bf, bb = np.full(width, 1e-6), np.zeros(width, np.int64), np.full(width, -1)
            local = at - first
            for j in range(d):
                k = local * bins + b[:, j]
                gs, hs, cs = (np.bincount(k, w, width * bins).reshape(width, bins).cumsum(1) for w in (g, h, None))
                gt, ht, ct = gs[:, -1:], hs[:, -1:], cs[:, -1:]
                gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                gain[(cs < least) | (ct - cs < least)] = 0
                gain[:, len(cuts[j]) :] = 0
                top = gain.argmax(1)
                gain = gain[np.arange(width), top]
                better = gain > best
                best[better], bf[better], bb[better] = gain[better], j, top[better]
            for node in np.flatnonzero(bb >= 0):
                feature[first + node], threshold[first + node] = bf[node], cuts[bf[node]][bb[node]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        leaf = at - (2**depth - 1)
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        f0 += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Forest(base, np.array(features), np.array(thresholds), np.array(values))


def labelled(documents: DataFrame, labels: DataFrame, label: str, limit: int, modulus: int, held: int) -> DataFrame:
    """doc_id, text, y: a bounded sample of labelled documents outside the held-out fold.

    A doc_id with several labels counts once, with the larger; of several texts with its least. The ids alone are
    sampled, so at most limit of them are joined to the texts.
    """
    ids = common.pick(labels, "doc_id", label).filter(f"{label} in (0, 1) and doc_id is not null").filter(common.remainder(F.col("doc_id"), modulus) != held)
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).alias("y"))
    ids = common.bounded_sample(ids, "doc_id", limit, label)
    own = common.pick(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return own.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))


def train(documents: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, sample: int = SAMPLE) -> Forest:
    """A forest fitted on statistics of at most `sample` labelled documents; only their numbers are collected."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(common.texts_of(batch.column(1)))
        return pa.record_batch([batch.column(0), batch.column(2).cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    rows = common.map_arrow(labelled(documents, labels, "quality", sample, modulus, held), each, "doc_id long, y int, x array<double>").toPandas().sort_values("doc_id")
    if rows.empty:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.stack(rows["x"].to_numpy()), rows["y"].to_numpy(float))


def scored(text: Column, forest: Forest) -> Column:
    """The score of a column of whole texts; null counts as empty."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        common.let_go()
        parts = [forest.score(statistics(common.texts_of(texts[a : a + 500]))) for a in range(0, len(texts), 500)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score(text)


def score_documents(documents: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score (0 to 1; higher: label 1 likelier), predicted, of every document.

    Null and empty texts have the score of a text without any byte; very long ones are read as a whole. Repeated rows stay repeated; an
    empty table gives no rows; extra columns are ignored. Without labels every score is 0.5.
    """
    forest = train(documents, labels, modulus, held, sample)
    own = common.pick(documents, "doc_id", "text")
    rows = own.select("doc_id", (common.remainder(F.col("doc_id"), modulus) == held).alias("held_out"), scored(F.col("text"), forest).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(documents: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, sample: int = SAMPLE) -> DataFrame:
    """The documents with a score of 0.5 or more, all their columns, also those whose names differ in case only.

    Null, empty and very long texts are scored as in score_documents(); rows that repeat a text stay or go together; an empty table stays empty. Without
    labels every document stays.
    """
    forest = train(documents, labels, modulus, held, sample)
    plain, at = common.numbered(documents)
    return plain.withColumn("score", scored(F.col(at["text"]), forest)).filter("score >= 0.5").drop("score").toDF(*documents.columns)
