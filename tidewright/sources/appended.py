"""Tables in a shared folder that runs append to in two phases: readers see all of a run's rows or none.

A run writes its rows aside and renames them into the table when they are whole; one that dies leaves a folder that nobody reads.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Appended:
    """A table with a key; of a key that several runs brought the least row counts."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: str):
        self.spark, self.folder, self.schema, self.key = spark, folder.rstrip("/"), schema, key
        self.columns = [f.name for f in spark.createDataFrame([], schema).schema if f.name != key]
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def known(self) -> DataFrame:
        """The rows of all runs that were committed, one for each key."""
        there = self._fs.globStatus(self._path("part-*")) or []
        if not len(there):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*[str(s.getPath()) for s in there])
        least = rows.groupBy(self.key).agg(F.min(F.struct(*self.columns)).alias("_row"))
        return least.select(self.key, *[F.col(f"_row.{n}").alias(n) for n in self.columns])

    def append(self, rows: DataFrame) -> None:
        """No rows, no part."""
        name = uuid4().hex
        rows.select(self.key, *self.columns).write.parquet(f"{self.folder}/staged-{name}")
        if self.spark.read.parquet(f"{self.folder}/staged-{name}").isEmpty():
            self._fs.delete(self._path(f"staged-{name}"), True)
        elif not self._fs.rename(self._path(f"staged-{name}"), self._path(f"part-{name}")):
            raise RuntimeError("the rows couldn't be committed")
