"""Whitening of vectors by a covariance that is put together from tiles.

A vector's components become integers x. Rows are taken in blocks; each block of rows is cut into blocks of TILE columns, which
are shuffled by their block of rows. There every pair of column blocks i <= j is multiplied; a task adds up its products of a
tile (i, j), Spark those of all tasks. The driver gets one number for each pair of dimensions, never a row of the table.

What is multiplied are differences from the rounded mean, small integers. Their products and sums are exact, whatever order
they are added in; the rest of the mean is taken off as a fraction, so the covariance is rounded once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import common, vectors

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Columns of a tile, and rows of a block.
TILE, ROWS = 32, 1024
#: Integers beyond (before SHIFT) count as that.
LIMIT = 1 << 46
#: Dimensions, at most: the driver holds a square of them, 8 bytes for each pair.
MOST = 8192
_EXACT = 1 << 53


def _narrow(q: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as hold them all."""
    if q.dtype.kind == "f" or not q.size:
        return q
    return q.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= q.min() and q.max() <= np.iinfo(t).max))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The transpose of a times b; of integers exactly."""
    if a.dtype.kind == "f":
        return a.T @ b
    peak = lambda x: int(abs(x.astype(np.int64)).max(initial=0))
    if peak(a) * peak(b) * max(1, len(a)) < _EXACT:
        return (a.astype(float).T @ b.astype(float)).astype(np.int64).astype(object)
    return a.astype(object).T @ b.astype(object)


def products(rows: DataFrame, columns: int, to: Callable[[pa.RecordBatch], np.ndarray], exact: bool = True) -> np.ndarray:
    """The matrix of the sums over all rows of column i times column j, for what to() makes of the rows: integers if exact."""
    kind, number = ("decimal(38,0)", object) if exact else ("double", float)
    tile = TILE

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                q = to(batch.slice(s, ROWS))
                parts = [_narrow(q[:, c : c + tile]) for c in range(0, columns, tile)]
                m = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * m), pa.array(range(m), pa.int32()), pa.array([x.dtype.str for x in parts]), pa.array([len(q)] * m, pa.int32()), pa.array([np.ascontiguousarray(x).tobytes() for x in parts], pa.binary())],
                    ["block", "i", "kind", "n", "x"],
                )
                block += 1
            common.let_go()

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        read = lambda r, x, k: np.frombuffer(r[x], np.dtype(r[k])).reshape(r["n"], -1)
        for batch in batches:
            for s in range(batch.num_rows):
                r = batch.slice(s, 1).to_pylist()[0]
                found = _product(read(r, "x", "kind"), read(r, "y", "kind_y"))
                at = (r["i"], r["j"])
                sums[at] = sums[at] + found if at in sums else found
            common.let_go()
        for (i, j), total in sums.items():
            p, q = np.indices(total.shape)
            cells = pa.array([Decimal(int(v)) for v in total.ravel()], pa.decimal128(38, 0)) if exact else pa.array(total.ravel().astype(float))
            yield pa.RecordBatch.from_arrays([pa.array((p.ravel() + i * tile).astype(np.int32)), pa.array((q.ravel() + j * tile).astype(np.int32)), cells], ["p", "q", "total"])

    blocks = rows.mapInArrow(cut, "block long, i int, kind string, n int, x binary")
    others = blocks.select("block", F.col("i").alias("j"), F.col("kind").alias("kind_y"), F.col("x").alias("y"))
    # sort-merge: two equal shuffles, of which Spark makes one
    pairs = blocks.hint("merge").join(others, "block").filter("i <= j")
    cells = pairs.select("i", "j", "n", "kind", "x", "kind_y", "y").mapInArrow(multiply, f"p int, q int, total {kind}").groupBy("p", "q").agg(F.sum("total").alias("total"))
    out = np.zeros((columns, columns), number)
    for r in cells.collect():
        out[r["p"], r["q"]] = out[r["q"], r["p"]] = int(r["total"]) if exact else r["total"]
    return out


@dataclass
class Whitening:
    """n vectors with component sums (of x), their rounded mean and what is left of the mean; axes scaled to unit variance, eigenvalues by falling size."""

    n: int
    sums: list[int]
    middle: np.ndarray
    rest: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = float("nan")

    def offsets(self, column: pa.Array) -> np.ndarray:
        """x less the rounded mean, of each row and dimension."""
        return _integers(column, len(self.sums)) - self.middle

    def project(self, offsets: np.ndarray) -> np.ndarray:
        return (offsets - self.rest) @ self.axes

    def deviations(self, offsets: np.ndarray) -> list[int | None]:
        """The sums over all dimensions of (n x - sum)^2; null beyond 63 bits."""
        left = [s - self.n * int(m) for s, m in zip(self.sums, self.middle, strict=True)]
        most = self.n * int(abs(offsets).max(initial=0)) + max(map(abs, left), default=0)
        if most * most * max(1, len(left)) < 1 << 63:
            return ((self.n * offsets - np.array(left, np.int64)) ** 2).sum(1).tolist()
        exact = ((self.n * offsets.astype(object) - np.array(left, object)) ** 2).sum(1)
        return [int(v) if v < 1 << 63 else None for v in exact]

    def applied(self, rows: DataFrame) -> DataFrame:
        """vec_id, deviation, whitened (a number for each component)."""
        own = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in range(0, batch.num_rows, 2000):
                    some = batch.slice(s, 2000)
                    q = own.offsets(some.column("v"))
                    w = own.project(q)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1], pa.int32()), pa.array(w.ravel()))
                    yield pa.RecordBatch.from_arrays([some.column("vec_id"), pa.array(own.deviations(q), pa.int64()), lists], ["vec_id", "deviation", "whitened"])
                common.let_go()

        return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def _integers(column: pa.Array, size: int) -> np.ndarray:
    return vectors.whole(vectors.matrix(column, size), SCALE, LIMIT) + SHIFT


def _sums(rows: DataFrame, size: int) -> list[int]:
    """Of x in each dimension: added up in each task, then in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object)
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                total = total + _integers(batch.column("v").slice(s, 2000), size).sum(0).astype(object)
            common.let_go()
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))], ["at", "total"])

    found = rows.select("v").mapInArrow(run, "at int, total decimal(38,0)").groupBy("at").agg(F.sum("total").alias("total")).collect()
    out = [0] * size
    for r in found:
        out[r["at"]] = int(r["total"])
    return out


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """From all rows (of vectors.finite); None without any component to whiten."""
    n, size = vectors.width(rows)
    if size > MOST:
        raise ValueError(f"{size} dimensions; at most {MOST}")
    if not n or not size:
        return None
    sums = _sums(rows, size)
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    left = [s - n * int(m) for s, m in zip(sums, middle, strict=True)]
    model = Whitening(n, sums, middle, np.array([float(Fraction(x, n)) for x in left]), np.zeros((size, 0)), np.zeros(0), 0.0)
    only = rows.select("v")
    total = products(only, size, lambda batch: model.offsets(batch.column("v")))
    gap = n * total - np.outer(np.array(left, object), np.array(left, object))
    covariance = np.array([[float(Fraction(int(v), n * n)) for v in row] for row in gap])
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    model.trace = float(Fraction(sum(int(gap[i, i]) for i in range(size)), n * n))
    kept = min(components, int((values > model.trace * size * 2.0**-50).sum()))
    if not kept:
        return None
    model.values, model.axes = values[:kept].copy(), axes[:, :kept] / np.sqrt(values[:kept])
    measured = products(only, kept, lambda batch: model.project(model.offsets(batch.column("v"))), exact=False) / n
    model.identity_error = float(abs(measured - np.eye(kept)).max())
    return model


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """vec_id, deviation, whitened of every vector, and the model, which is fitted on all of them; its identity_error is measured on the whitened rows.

    Rows whose vector is null or holds a null or non-finite entry are left out. Vectors shorter than the longest one count as ended
    by zeros. A component without variance can't be whitened and isn't returned; equal vectors only, or an empty table, give no rows.
    Entries beyond LIMIT / SCALE count as that; a deviation beyond 63 bits is null. Null and repeated vec_ids are rows like others. Extra columns are ignored.
    """
    rows = vectors.finite(embeddings)
    model = fit(rows, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], "vec_id long, deviation long, whitened array<double>"), None
    return model.applied(rows), model
