"""Vectors compressed to codes of a few bytes: each of PARTS parts is known by its nearest codebook entry.

Components become integers, so that distances, sums and thus codebooks are exact and don't depend on how rows are
dealt to tasks. The nearest entry is found by segment-mean lower bounds: of a part v and an entry c, cut into blocks,

    |v - c|^2 >= sum over blocks of size * (mean(v) - mean(c))^2 + (residual norm of v - residual norm of c)^2

where the residual is what the block means leave. One block comes first, then ever finer ones; an entry goes as soon as
a bound lies above the distance to the entry of the least first bound. Bounds are lowered by more than their rounding can be,
so that no nearest entry and no tie is lost. Those that are left get exact integer distances.

A round adds up parts by entry within each task and then in Spark; the driver gets one row for each component of each entry.
The table is read once a round: hand in one that is cheap to read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import common, vectors

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integer components beyond count as that: distances of parts with up to 16 components then fit in 63 bits, sums of 2^35 rows too.
LIMIT = 1 << 28


def _edges(size: int, blocks: int) -> np.ndarray:
    return np.arange(blocks + 1) * size // blocks


def profile(v: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block means times the root of the block's size, and the norm of what they leave, of each row."""
    edges = _edges(v.shape[1], blocks)
    sizes = np.diff(edges)
    means = np.add.reduceat(v, edges[:-1], axis=1) / sizes
    rest = v - np.repeat(means, sizes, axis=1)
    return means * np.sqrt(sizes), np.sqrt((rest**2).sum(1))


def nearest(v: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties: the lower one), its squared distance, and how many exact distances that took, of each row."""
    n, size = v.shape
    if not size:
        return np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    a, c = v.astype(float), entries.astype(float)
    slack = 1e-12 * (np.sqrt((a**2).sum(1))[:, None] + np.sqrt((c**2).sum(1))) ** 2 + 1e-6

    def square(d: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", d, d)

    exact = lambda r, e: square(np.take(v, r, 0) - np.take(entries, e, 0))
    best = rows = at = None
    blocks = 1
    while True:
        own, other = profile(a, blocks), profile(c, blocks)
        if best is None:
            low = (own[0] - other[0].T) ** 2 + (own[1][:, None] - other[1]) ** 2 - slack  # one block: one mean
            best = exact(np.arange(n), low.argmin(1))
            rows, at = np.nonzero(low <= best[:, None])
        else:
            low = square(own[0][rows] - other[0][at]) + (own[1][rows] - other[1][at]) ** 2 - slack[rows, at]
            near = low <= best[rows]
            rows, at = rows[near], at[near]
        if blocks * 4 > size:
            break
        blocks *= 2
    found = np.full((n, len(entries)), np.iinfo(np.int64).max)
    found[rows, at] = exact(rows, at)
    index = found.argmin(1)
    return index, found[np.arange(n), index], np.bincount(rows, minlength=n)


@dataclass
class Codebooks:
    """entries[part, entry] are the integer components; size is that of the vectors."""

    entries: np.ndarray
    size: int

    def split(self, column: pa.Array) -> np.ndarray:
        """Integer components by part and row, ended with zeros up to parts of equal size."""
        x = vectors.whole(vectors.matrix(column, self.size), SCALE, LIMIT)
        each = self.entries.shape[2]
        x = np.pad(x, ((0, 0), (0, PARTS * each - x.shape[1])))
        return x.reshape(len(x), PARTS, each).transpose(1, 0, 2)

    def sha256(self) -> str:
        """Of all integer components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def sums(self, rows: DataFrame) -> DataFrame:
        """part, entry, place, total: sums of the parts nearest to each entry; at place -1 their number."""
        own = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts, k, each = own.entries.shape
            total = np.zeros((parts, k, each + 1), np.int64)
            for batch in batches:
                for s in range(0, batch.num_rows, 2000):
                    for p, v in enumerate(own.split(batch.column("v").slice(s, 2000))):
                        index, _, _ = nearest(v, own.entries[p])
                        of = np.arange(k)[:, None] == index
                        total[p, :, 0] += of.sum(1)
                        total[p, :, 1:] += of.astype(np.int64) @ v
            part, entry, place = np.nonzero(np.broadcast_to(total[:, :, :1] > 0, total.shape))
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array((place - 1).astype(np.int32)), pa.array(total[part, entry, place])], ["part", "entry", "place", "total"])
            common.let_go()

        found = rows.select("v").mapInArrow(run, "part int, entry int, place int, total long")
        return found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))

    def refined(self, rows: DataFrame) -> Codebooks:
        """Each entry replaced by the floor of its parts' mean; one that no part is nearest to stays."""
        told = self.sums(rows).collect()
        count = {(r["part"], r["entry"]): int(r["total"]) for r in told if r["place"] < 0}
        entries = self.entries.copy()
        for r in told:
            if r["place"] >= 0:
                entries[r["part"], r["entry"], r["place"]] = int(r["total"]) // count[r["part"], r["entry"]]
        return Codebooks(entries, self.size)

    def encoded(self, rows: DataFrame, *others: str) -> DataFrame:
        """vec_id, the others, code (two hex digits for each part), error (squared distances summed), evaluated (exact distances taken)."""
        own = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in range(0, batch.num_rows, 2000):
                    some = batch.slice(s, 2000)
                    found = [nearest(v, own.entries[p]) for p, v in enumerate(own.split(some.column("v")))]
                    code = np.stack([f[0] for f in found], 1).astype(np.uint8)
                    columns = [*(some.column(c) for c in ("vec_id", *others)), pa.array([x.tobytes().hex() for x in code], pa.string()), pa.array(sum(f[1] for f in found)), pa.array(sum(f[2] for f in found))]
                    yield pa.RecordBatch.from_arrays(columns, ["vec_id", *others, "code", "error", "evaluated"])
                common.let_go()

        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select("vec_id", *others).schema)
        return rows.select("vec_id", *others, "v").mapInArrow(run, f"{kept}, code string, error long, evaluated long")


def first(rows: DataFrame, most: int) -> list[list[float]]:
    """The vectors of the smallest distinct vec_ids, a null one last; of a repeated vec_id the least vector.

    A look for the next ids takes the least rows only; it is repeated where they repeat an id.
    """
    out: dict = {}
    while len(out) < most:
        rest = rows.filter(F.col("vec_id") > max(out)) if out else rows.filter("vec_id is not null")
        found = rest.orderBy("vec_id", "v").select("vec_id", "v").limit(most).collect()
        if not found:
            break
        for r in found:
            if len(out) < most:
                out.setdefault(r["vec_id"], r["v"])
    nameless = rows.filter("vec_id is null").orderBy("v").select("v").limit(1).collect() if len(out) < most else []
    return [*out.values(), *(r["v"] for r in nameless)]


def fit(rows: DataFrame, size: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks that start as the parts of the vectors with the least vec_ids, refined in so many rounds over all rows."""
    each = -(-size // PARTS)
    start = pa.array(first(rows, entries), pa.list_(pa.float64()))
    books = Codebooks(np.zeros((PARTS, len(start), each), np.int64), size)
    books.entries = np.ascontiguousarray(books.split(start))
    for _ in range(rounds):
        books = books.refined(rows)
    return books


def compress(embeddings: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """vec_id, label, code, error, label_error, evaluated of every vector, and the codebooks.

    label_error is the error summed over equal labels, null ones together. Rows whose vector is null or holds a null or non-finite
    component are left out. Vectors shorter than the longest one count as ended by zeros, as do sizes that PARTS doesn't divide;
    an empty vector is all zeros. Components beyond LIMIT / SCALE count as that. A null vec_id comes last; repeated
    rows are coded and counted each; with fewer vec_ids than entries there are as many entries. An empty table gives no rows. Extra columns are ignored.
    """
    rows = vectors.finite(embeddings, "label")
    n, size = vectors.width(rows)
    if not n:
        none = embeddings.sparkSession.createDataFrame([], "vec_id long, label int, code string, error long, label_error long, evaluated long")
        return none, Codebooks(np.zeros((PARTS, 0, 0), np.int64), 0)
    books = fit(rows, size, entries, rounds)
    coded = common.durable(books.encoded(rows, "label"))
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "own")
    few = by_label.limit(common.FEW + 1).count() <= common.FEW
    joined = coded.join(F.broadcast(by_label) if few else by_label, F.col("label").eqNullSafe(F.col("own")))
    return joined.select("vec_id", "label", "code", "error", "label_error", "evaluated"), books
