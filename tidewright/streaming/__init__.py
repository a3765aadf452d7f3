"""Structured Streaming forms of the operators that carry state."""

from __future__ import annotations

import re
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewright.sources.shared import shared_folder


def read_stream(spark: SparkSession, path: str, files: int = 1, closing: DataFrame | None = None) -> DataFrame:
    """A Parquet table as a stream, so many files in a batch. closing: rows that come after all others, from the shared folder.

    Both must lie in one file system. A closing row far in the future moves the watermark past everything that is awaited.
    """
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    own = f"{folder}/{name[:-1]}[{name[-1]}]"
    if closing is not None:
        at = f"{shared_folder(spark)}/closing-{uuid4().hex}"
        closing.select(*[F.col(f.name).cast(f.dataType) for f in schema]).coalesce(1).write.parquet(at)
        roots = [re.fullmatch(r"(?:([a-z][a-z0-9+.-]*):(?://([^/]*))?)?(/.*)", p).groups(default="") for p in (own, at)]
        if roots[0][0] not in ("", "file") and roots[0][:2] != roots[1][:2]:
            raise ValueError("the table and the shared folder are in different file systems")
        scheme = f"{roots[0][0]}://{roots[0][1]}" if roots[0][0] else ""
        own = f"{scheme}/{{{roots[0][2][1:]},{roots[1][2][1:]}}}"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(own)


def closing_row(table: DataFrame, at: str, beyond: str) -> DataFrame:
    """One row, null but for a time so far behind the table's last one."""
    last = table.agg(F.max(F.col(at).cast("timestamp")).alias(at)).select((F.col(at) + F.expr(f"interval {beyond}")).alias(at))
    return last.select(*[F.col(at) if f.name == at else F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema])


def windowed(stream: DataFrame, at: str, late: str, size: str, by: str) -> DataFrame:
    """Counts and sums of tumbling windows, once no row for them is awaited."""
    return stream.withWatermark(at, late).groupBy(F.window(at, size), by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), by, "n", "total")


def sessions(stream: DataFrame, at: str, late: str, gap: str, by: str) -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap), by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), by, "n")


def hysteresis(stream: DataFrame, by: str, frame: str, p: str, opens: int, closes: int) -> DataFrame:
    """(by, frame, active) with the open or closed state carried from batch to batch.

    A frame at or before one that was already taken is an error, as the order of frames is part of the meaning.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, active = state.get if state.exists else (-(2**62), False)
        rows = pd.concat(list(frames)).sort_values(frame)
        if len(rows) and rows[frame].iloc[0] <= last:
            raise ValueError("a frame came out of order")
        out = []
        for value in rows[p]:
            active = True if value >= opens else False if value < closes else active
            out.append(active)
        if len(rows):
            state.update((int(rows[frame].iloc[-1]), bool(active)))
            yield pd.DataFrame({by: key[0], frame: rows[frame].to_numpy(), "active": out})

    return stream.groupBy(by).applyInPandasWithState(run, f"{by} long, {frame} long, active boolean", "last long, active boolean", "append", GroupStateTimeout.NoTimeout)


def slew(stream: DataFrame, by: str, frame: str, target: str, rise: float, fall: float) -> DataFrame:
    """(by, frame, applied): the target held within fall below and rise above the frame before; the last one is carried.

    Frames must come in order, as for hysteresis().
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, last = state.get if state.exists else (-(2**62), 0.0)
        rows = pd.concat(list(frames)).sort_values(frame)
        if len(rows) and rows[frame].iloc[0] <= seen:
            raise ValueError("a frame came out of order")
        out = []
        for t in rows[target].tolist():
            last = min(max(t, last - fall), last + rise)
            out.append(last)
        if len(rows):
            state.update((int(rows[frame].iloc[-1]), float(last)))
            yield pd.DataFrame({by: key[0], frame: rows[frame].to_numpy(), "applied": out})

    return stream.groupBy(by).applyInPandasWithState(run, f"{by} long, {frame} long, applied double", "seen long, last double", "append", GroupStateTimeout.NoTimeout)


def filtered(stream: DataFrame, by: str, taps: np.ndarray, factor: int = 3) -> DataFrame:
    """(by, start, samples): every factor-th sample of the filtered track, from rows (by, window, samples, last).

    The last samples that the filter still needs are carried. Output lags behind by half a filter until the window marked
    last, with which the rest comes. Over all batches it is what operators.signal.decimate makes of the whole track.
    """
    half = len(taps) // 2

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, start, done, held = state.get if state.exists else (-1, -half, 0, [0.0] * half)
        held = np.asarray(held, float)
        out = []
        for row in pd.concat(list(frames)).sort_values("window").itertuples(index=False):
            if row.window != seen + 1:
                raise ValueError("a window is missing or came out of order")
            seen = row.window
            held = np.concatenate([held, np.asarray(row.samples, float), np.zeros(half if row.last else 0)])
            ready = start + len(held) - half  # outputs before this place have all their samples
            places = np.arange(done * factor, ready, factor)
            if len(places):
                first = int(places[0]) - half - start
                made = np.convolve(held[first:], taps, "valid")[::factor][: len(places)]
                out.append((done, made.tolist()))
                done += len(places)
            keep = max(0, min(done * factor - half - start, len(held)))
            held, start = held[keep:], start + keep
        state.update((int(seen), int(start), int(done), held.tolist()))
        yield pd.DataFrame({by: [key[0]] * len(out), "start": [o[0] for o in out], "samples": [o[1] for o in out]})

    return stream.groupBy(by).applyInPandasWithState(run, f"{by} long, start long, samples array<double>", "seen long, start long, done long, held array<double>", "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame) -> DataFrame:
    """Runs the stream over what is there, writes to the shared folder, and reads the result."""
    spark = stream.sparkSession
    folder = f"{shared_folder(spark)}/stream-{uuid4().hex}"
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/out")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
