"""What the operators on vectors share: which rows take part, and their vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import common


def finite(embeddings: DataFrame, *others: str) -> DataFrame:
    """vec_id, the others, and v: the vector as floats or doubles, of the rows whose vector isn't null and has no null or non-finite component."""
    kind = common.pick(embeddings, "embedding").dtypes[0][1]
    wanted = kind if kind == "array<float>" else "array<double>"
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    own = common.pick(embeddings, "vec_id", *others, "embedding").select(F.col("vec_id").cast("long").alias("vec_id"), *others, F.col("embedding").cast(wanted).alias("v"))
    return own.filter(F.col("v").isNotNull() & ~F.coalesce(F.exists("v", bad), F.lit(False)))


def width(vectors: DataFrame) -> tuple[int, int]:
    """How many vectors there are, and the components of the longest one."""
    n, most = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    return n, most or 0


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A row for each vector; shorter ones end in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    if (lengths == size).all():
        return flat.reshape(len(lengths), size)
    out = np.zeros((len(lengths), size))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def whole(x: np.ndarray, scale: float, limit: int) -> np.ndarray:
    """floor(scale * x) as integers; what lies beyond the limit counts as the limit."""
    return np.clip(np.floor(scale * x), -limit, limit).astype(np.int64)
