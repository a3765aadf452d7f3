"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns, also where others differ from them in case only, or repeat them.

    Of columns with the very same name the first one counts.
    """
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*names)
    at = [df.columns.index(n) for n in names]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{i}").alias(n) for i, n in zip(at, names, strict=True)])


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with its columns named by their places, and what each name is called there (of repeated names the first).

    However its names clash, the columns can be addressed; toDF(*df.columns) gives the names back.
    """
    places = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*places), dict(reversed(list(zip(df.columns, places, strict=True))))


#: Rows of keys that are broadcast to filter a larger table; beyond, the join shuffles.
FEW = 200_000


def members(df: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """df's rows with (how: left_semi) or without (left_anti) a row in keys, which is broadcast if it has been counted to be small."""
    few = keys.limit(FEW + 1).count() <= FEW
    return df.join(F.broadcast(keys) if few else keys, on, how)


def blocks(text: str, size: int = 1 << 20, reach: int | None = None) -> Iterator[str]:
    """The text in parts of about size characters, cut at the next white space, or after reach more characters without any."""
    at = 0
    while at < len(text):
        end = at + size
        last = len(text) if reach is None else min(len(text), end + reach)
        while end < last and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the one that the cluster names in spark.checkpoint.dir.

    Where that is unset, as in tests on one machine, it is set to a temporary folder; a cluster has to name one.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if named is None and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """The table, written once to the shared folder; its lineage ends there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def map_arrow(df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """each() for every Arrow batch. Batches are bounded by rows and, in Spark, by bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                if (out := each(batch.slice(start, 2000))) is not None:
                    yield out
            del batch
            let_go()

    return df.mapInArrow(run, schema)


def let_go() -> None:
    """Gives freed memory of Arrow back to the system: a Python worker lives on between stages, and its pool would keep it."""
    pa.default_memory_pool().release_unused()


def texts_of(column: pa.Array) -> list[str]:
    """Python texts; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def bounded_sample(rows: DataFrame, key: str, limit: int, salt: str) -> DataFrame:
    """At most limit rows with the least hashes of their key: the same ones in any partitioning."""
    return rows.orderBy(F.xxhash64(F.lit(salt), F.col(key)), F.col(key)).limit(limit)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder through Spark's file system, wherever it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
