"""Nearest neighbours by inner product with vantage-point trees, one for each shard of the vectors.

Largest inner product is least distance once each vector has one more component, which brings all of
them to the greatest length M: |q - x|^2 = |q|^2 + M^2 - 2 q.x. A node of a shard's tree has several vantage points
and halves its vectors by the distance from the first; it keeps for each half the ranges of these distances, and
each vector keeps its distances from all vantage points above it. By the triangle inequality |d(q, v) - d(x, v)|
is at most d(q, x) for each vantage point v, so the root mean square over v is, too. With tau the k-th best distance so far,
a vector (or a half, by its ranges) is left out if this bound exceeds factor * tau. Factor one is exact; less prunes more.

The mean square of many differences comes close to a fixed share of the distance itself, so a factor well under one loses little.
Where none is given it is fitted on a bounded sample: the one that would keep `recall` of the sample's own neighbours.

A shard's tree is built once; the queries stream through it. Each first goes down to one leaf, for a tau that rules halves
out, then meets the vectors left best first, in rounds: those with the least bounds make tau small before the many others are judged by it.
Equal vectors are one entry of the tree with all their ids: a vector that a third of the rows share costs one comparison in
each shard, and its ids take part by size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidewright.llm import common

#: Vectors in a shard, about, and bytes of them at most; entries of a leaf, at most; vantage points of the root and of other nodes.
SHARD, BYTES, LEAF, ROOT, EACH = 32_768, 64 << 20, 128, 64, 4
#: Vectors to fit the factor on, at most, and how many of them are queries there.
SAMPLE, TRIALS = 2048, 256
#: Rounds of 4k vectors, four times as many, and so on, before the rest.
ROUNDS = 4
#: Share of neighbours that the fitted factor is to keep.
RECALL = 0.93
_QUERIES = 128  # compared at once


@dataclass
class Node:
    lo: int
    hi: int
    vantage: np.ndarray  # points; none at a leaf
    halves: tuple[Node, Node] | None = None
    low: np.ndarray | None = None  # ranges of the distances from the parent's vantage points
    high: np.ndarray | None = None
    path: np.ndarray | None = None  # of a leaf: its entries' distances from all vantage points above


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.column_stack([np.sqrt(((a - v) ** 2).sum(1)) for v in b])


def _spread(x: np.ndarray, n: int) -> np.ndarray:
    """Up to n of at most 512 rows, each the farthest from those before it."""
    some = x[np.unique(np.linspace(0, len(x) - 1, 512).astype(np.int64))]
    far = ((some - some.mean(0)) ** 2).sum(1)
    chosen = []
    for _ in range(min(n, len(some))):
        at = int(far.argmax())
        if chosen and far[at] <= 0:
            break
        own = ((some - some[at]) ** 2).sum(1)
        far = np.minimum(far, own) if chosen else own
        chosen.append(some[at])
    return np.array(chosen)


class Tree:
    """Vectors of one length, in tree order; `order` has their places in x."""

    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.root = Node(0, len(x), np.zeros((0, x.shape[1])))
        stack = [(self.root, np.zeros((len(x), 0)), ROOT)]
        while stack:
            node, path, n = stack.pop()
            own = self.order[node.lo : node.hi]
            if len(own) <= (2 * ROOT if node is self.root else LEAF):
                node.path = path
                continue
            node.vantage = _spread(x[own], n)
            d = _distances(x[own], node.vantage)
            by = np.argsort(d[:, 0], kind="stable")
            self.order[node.lo : node.hi], d, path = own[by], d[by], np.column_stack([path, d])[by]
            mid = len(own) // 2 if len(own) > LEAF else len(own)
            halves = []
            for a, b in ((0, mid), (mid, len(own))):
                half = Node(node.lo + a, node.lo + b, np.zeros((0, x.shape[1])), low=d[a:b].min(0, initial=np.inf), high=d[a:b].max(0, initial=-np.inf))
                halves.append(half)
                if b > a:
                    stack.append((half, path[a:b], EACH))
                else:
                    half.path = path[a:b]
            node.halves = tuple(halves)

    def homes(self, q: np.ndarray) -> list[tuple[Node, np.ndarray]]:
        """Leaves, and the queries that lead there when each goes to the half it is nearer to."""
        out, stack = [], [(self.root, np.arange(len(q)))]
        while stack:
            node, who = stack.pop()
            if node.halves is None:
                out.append((node, who))
                continue
            a, b = node.halves
            inner = _distances(q[who], node.vantage[:1])[:, 0] <= (a.high[0] + b.low[0]) / 2
            stack += [(half, some) for half, some in ((a, who[inner]), (b, who[~inner])) if len(some)]
        return out

    def bounds(self, q: np.ndarray, tau: np.ndarray, factor: float) -> tuple[np.ndarray, int]:
        """For each query and entry (in tree order) the lower bound of the distance, inf in halves that are left out; distances taken."""
        out, taken = np.full((len(q), len(self.order)), np.inf), 0
        who = np.arange(len(q))
        stack = [(self.root, who, np.zeros((len(q), 0)), np.zeros(len(q)))]
        while stack:
            node, who, path, gaps = stack.pop()
            if not len(who):
                continue
            if node.halves is None:
                own = path > 0  # a vantage point that is the query itself tells each distance in full, unlike the others
                square = (path**2).sum(1)[:, None] - 2 * path @ node.path.T + ((node.path**2).sum(1)[None] if own.all() else own.astype(float) @ (node.path**2).T)
                low = np.sqrt(np.maximum(0, square) / np.maximum(1, own.sum(1))[:, None])
                low[:, (node.path == 0).any(1)] = 0  # vantage points are met anyway
                out[who, node.lo : node.hi] = low
                continue
            d = _distances(q[who], node.vantage)
            taken += d.size
            path = np.column_stack([path, d])
            for half in node.halves:
                if half.hi > half.lo:
                    own = gaps + (np.maximum(0, np.maximum(half.low - d, d - half.high)) ** 2).sum(1)
                    near = np.sqrt(own / path.shape[1]) <= np.where(np.isfinite(tau[who]), factor * tau[who], np.inf)
                    stack.append((half, who[near], path[near], own[near]))
        return out, taken


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """With the component that brings each vector to the greatest length."""
    return np.column_stack([x, np.sqrt(np.maximum(0, longest**2 - (x**2).sum(1)))])


class Shard:
    """A shard's distinct vectors with their ids, and the tree over them."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, longest: float):
        entries, inverse = np.unique(x + 0.0, axis=0, return_inverse=True)  # no negative zeros
        self.longest, self.tree = longest, Tree(lifted(entries, longest))
        self.entries = entries[self.tree.order]
        place = np.empty(len(entries), np.int64)
        place[self.tree.order] = np.arange(len(entries))
        inverse = place[inverse.ravel()]
        by = np.lexsort((ids, inverse))
        self.ids, self.begins = ids[by], np.searchsorted(inverse[by], np.arange(len(entries) + 1))
        self.compared = self.taken = 0  # inner products, and distances from vantage points

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query_id, vec_id, score of the k nearest found for each query."""
        q = q + 0.0
        square = (q**2).sum(1) + self.longest**2
        tau_of = lambda s: np.where(np.isfinite(s), np.sqrt(np.maximum(0, square - 2 * s)) * (1 + 1e-7) + 1e-7 * (1 + self.longest), np.inf)
        best = np.full((len(q), k + 1), -np.inf)  # one more: one may be the query itself
        found: list[list[np.ndarray]] = [[] for _ in q]  # entries and their scores, step by step
        raised = np.column_stack([q, np.zeros(len(q))])

        def meet(i: int, j: np.ndarray) -> None:
            s = self.entries[j] @ q[i]
            self.compared += len(j)
            found[i] += [j, s]
            top = np.concatenate([best[i], s])
            best[i] = np.partition(top, len(top) - k - 1)[len(top) - k - 1 :]

        for leaf, who in self.tree.homes(raised):
            for i in who:
                meet(i, np.arange(leaf.lo, leaf.hi))
        tau = tau_of(best[:, 0])
        low, taken = self.tree.bounds(raised, tau, factor)
        self.taken += taken
        for i, own in enumerate(found):
            low[i, own[0]] = np.inf
        n = low.shape[1]
        cuts = [c for c in (4 * k * 4**r for r in range(ROUNDS)) if c < n]
        order = np.argpartition(low, [c - 1 for c in cuts], axis=1) if cuts else np.broadcast_to(np.arange(n), low.shape)
        for a, b in zip([0, *cuts], [*cuts, n], strict=True):  # best first: each round has greater bounds than those before
            own = order[:, a:b]
            lows = np.take_along_axis(low, own, 1)
            near = np.isfinite(lows) & (lows <= np.where(np.isfinite(tau), factor * tau, np.inf)[:, None])
            for i in range(len(q)):
                meet(i, own[i, near[i]])
            tau = tau_of(best[:, 0])
        out: list[tuple] = []
        slack = 1e-9 * (1 + self.longest**2)  # sums in another order differ by less
        for i, (qid, x) in enumerate(zip(query_ids, q, strict=True)):
            j, s = np.concatenate(found[i][::2]), np.concatenate(found[i][1::2])
            j = j[s >= best[i, 0] - slack]
            s = (self.entries[j] * x).sum(1)
            members = [self.ids[self.begins[e] : min(self.begins[e + 1], self.begins[e] + k + 1)] for e in j]
            ids, scores = np.concatenate([np.zeros(0, np.int64), *members]), np.repeat(s, [len(m) for m in members])
            other = ids != qid
            ids, scores = ids[other], scores[other]
            top = np.lexsort((ids, -scores))[:k]
            out.append((np.full(len(top), qid), ids[top], scores[top]))
        cat = lambda c, kind: np.concatenate([np.zeros(0, kind), *(o[c] for o in out)]).astype(kind)
        return cat(0, np.int64), cat(1, np.int64), cat(2, float)


def fitted(x: np.ndarray, longest: float, k: int, recall: float = RECALL) -> float:
    """The factor that keeps this share of the sample's own neighbours; one where the sample is too small to say."""
    if len(x) < 4 * k:
        return 1.0
    tree = Tree(lifted(x, longest))
    own = x[tree.order]
    ratios = []
    for at in np.unique(np.linspace(0, len(x) - 1, TRIALS).astype(np.int64)):
        d = np.sqrt(np.maximum(0, (own[at] ** 2).sum() + longest**2 - 2 * own @ own[at]))
        low, _ = tree.bounds(np.append(own[at], 0.0)[None], np.array([np.inf]), 1.0)
        d[at] = np.inf
        near = np.argpartition(d, k - 1)[:k]
        tau, near = d[near].max(), near[low[0, near] > 0]  # bounds of zero keep a vector with any factor
        if tau > 0:
            ratios.append(low[0, near] / tau)
    told = np.concatenate([np.zeros(0), *ratios])
    return float(min(1.0, np.quantile(told, recall))) if len(told) >= 4 * k else 1.0


def usable(vector: Column) -> Column:
    """Not null, with some component, all of them finite, not all zero."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(F.exists(vector, bad), F.lit(True)) & F.exists(vector, lambda v: v != 0)


def _vectors(embeddings: DataFrame) -> DataFrame:
    return common.pick(embeddings, "vec_id", "embedding").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))


def left_out(embeddings: DataFrame) -> DataFrame:
    """(reason, n): rows that take no part in nearest(), by reason; 'dimension' are those of another than the most common one."""
    own = _vectors(embeddings).select(F.col("vec_id").isNull().alias("nameless"), F.when(usable(F.col("v")), F.size("v")).alias("size"))
    top = own.filter("not nameless and size is not null").groupBy("size").count().orderBy(F.desc("count"), "size").first()
    reason = F.when(F.col("nameless"), "no vec_id").when(F.col("size").isNull(), "vector").when(F.col("size") != (top["size"] if top else 0), "dimension")
    return own.groupBy(reason.alias("reason")).agg(F.count("*").alias("n")).filter("reason is not null")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def nearest(embeddings: DataFrame, is_query: Column | None = None, k: int = 20, factor: float | None = None, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest other vectors by inner product.

    is_query is a condition on vec_id; unset, those divisible by 20. factor relaxes the pruning; unset, it is fitted for
    RECALL on SAMPLE rows; one is exact. Ties go to the smaller vec_id. Vectors that are null, zero, not finite, or not of the
    most common dimension take no part, as rows without a vec_id (left_out() counts them); of rows that repeat a vec_id
    the least vector does. Fewer candidates than k: all of them. An empty table: no rows.

    Every query meets every shard: a task builds the shard's tree and lets the queries stream through it.
    """
    is_query = F.col("vec_id") % 20 == 0 if is_query is None else is_query
    own = _vectors(embeddings)
    own = own.filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).groupBy("vec_id").agg(F.min("v").alias("v"))
    own = common.durable(own.withColumn("size", F.size("v")))
    common_size = own.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    spark = embeddings.sparkSession
    if common_size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = common_size["size"]
    own = own.filter(F.col("size") == size)
    longest = float(own.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, b: a + b * b)))).first()[0])
    sample = common.bounded_sample(own, "vec_id", max(64, min(SAMPLE, BYTES // (32 * size))), "vptree").select("vec_id", "v").collect()
    factor = fitted(np.array([r["v"] for r in sample]), longest, k) if factor is None else factor

    shards = -(-common_size["count"] // max(1, min(shard, BYTES // (8 * size))))
    vectors = own.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asked"), "vec_id", "v")
    asked = own.filter(is_query).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asked"), "vec_id", "v")
    met = vectors.unionByName(asked).repartition(4 * shards, "shard").sortWithinPartitions("shard", "asked", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a shard's vectors come before those of its queries."""
        number, ids, parts, tree = None, [], [], None
        for batch in batches:
            key = batch.column(0).to_numpy().astype(np.int64) * 2 + batch.column(1).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if e == s:
                    continue
                own_ids, x = batch.column(2).to_numpy()[s:e], _matrix(batch.column(3).slice(s, e - s))
                if key[s] // 2 != number:
                    number, ids, parts, tree = key[s] // 2, [], [], None
                if key[s] % 2 == 0:
                    ids.append(own_ids)
                    parts.append(x)
                    continue
                if tree is None and parts:
                    tree = Shard(np.concatenate(ids), np.concatenate(parts), longest)
                    parts.clear()
                for at in range(0, e - s if tree else 0, _QUERIES):
                    found = tree.search(own_ids[at : at + _QUERIES], x[at : at + _QUERIES], k, factor)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
