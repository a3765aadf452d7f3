"""A sink for windows of samples: tasks write their ranges aside, the commit publishes the file, an abort removes it.

    df.write.format("tidewright_wav").option("samples", n).option("rate", 48000).option("size", window).mode("append").save(path)

df has window (from 0) and samples (float); all windows but the last hold size samples. The path lies in a folder that all executors mount.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tidewright.sources.files import sync_folder
from tidewright.sources.riff import wav_header


class Refused(ValueError):
    """What was written isn't the file that was announced."""


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: runs of windows as (first, last), and a checksum of their bytes."""

    runs: list[tuple[int, int]]
    crc: int


class WavSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidewright_wav"

    def schema(self) -> str:
        return "window long, samples array<float>"

    def writer(self, schema: StructType, overwrite: bool) -> WavWriter:
        return WavWriter(self.options, overwrite)


class WavWriter(DataSourceArrowWriter):
    """A task that is tried again writes the same bytes to the same place; what a failed try has left is overwritten or never published."""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].removeprefix("file://").removeprefix("file:")
        self.n, self.rate, self.size = (int(options[k]) for k in ("samples", "rate", "size"))
        if not overwrite and os.path.exists(self.path):
            raise Refused(f"{os.path.basename(self.path)} is there already")
        self.head = wav_header(self.n, self.rate)
        self.staged = f"{self.path}.staged-{uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        runs: list[tuple[int, int]] = []
        crc = 0
        handle = os.open(self.staged, os.O_CREAT | os.O_WRONLY, 0o644)
        try:
            for batch in iterator:
                for window, samples in zip(batch.column("window").to_pylist(), batch.column("samples"), strict=True):
                    x = np.asarray(samples.values.to_numpy(zero_copy_only=False), "<f4")
                    if not 0 <= window * self.size < max(self.n, 1) or len(x) != min(self.size, self.n - window * self.size):
                        raise Refused(f"window {window} has {len(x)} samples")
                    data = x.tobytes()
                    os.pwrite(handle, data, len(self.head) + 4 * window * self.size)
                    crc = zlib.crc32(data, crc)
                    if runs and runs[-1][1] == window - 1:
                        runs[-1] = (runs[-1][0], window)
                    else:
                        runs.append((window, window))
            os.fsync(handle)
        finally:
            os.close(handle)
        return Written(runs, crc)

    def commit(self, messages: list[Written | None]) -> None:
        """Only if every window was written once: header, length, rename, and the folder's entry on disk."""
        runs = sorted(r for m in messages if m for r in m.runs)
        after = 0
        for first, last in runs:
            if first != after:
                self.abort(messages)
                raise Refused(f"window {min(first, after)} is {'missing' if first > after else 'there twice'}")
            after = last + 1
        if after != -(-self.n // self.size):
            self.abort(messages)
            raise Refused(f"{after} windows instead of {-(-self.n // self.size)}")
        handle = os.open(self.staged, os.O_CREAT | os.O_WRONLY, 0o644)
        try:
            os.pwrite(handle, self.head, 0)
            os.ftruncate(handle, len(self.head) + 4 * self.n)
            os.fsync(handle)
        finally:
            os.close(handle)
        os.replace(self.staged, self.path)
        sync_folder(os.path.dirname(os.path.abspath(self.path)))

    def abort(self, messages: list[Written | None]) -> None:
        if os.path.exists(self.staged):
            os.unlink(self.staged)


def save(windows: DataFrame, path: str, n: int, rate: int, size: int) -> None:
    """The windows as one WAV file, which appears whole or not at all; one that is there is replaced."""
    spark = windows.sparkSession
    register(spark)
    rows = windows.selectExpr("cast(window as long) as window", "cast(samples as array<float>) as samples").sortWithinPartitions("window")
    rows.write.format(WavSink.name()).option("samples", n).option("rate", rate).option("size", size).mode("overwrite").save(path)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WavSink)
