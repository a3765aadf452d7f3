"""Synchronization checks by cross-correlation against a reference track. They report and never move a sample."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

RATE = 16_000
LEAST_WINDOW = 1600  # samples: a tenth of a second
LAG = StructType([StructField("lag", LongType()), StructField("correlation", DoubleType())])


def measure(x: np.ndarray, y: np.ndarray, most: int) -> tuple[int, float]:
    """The lag of y against x of the greatest absolute correlation within most samples (of equals the first), and that over both energies."""
    energy = float(np.linalg.norm(x) * np.linalg.norm(y))
    if not energy:
        return 0, 0.0
    size = 1 << (len(x) + len(y) - 1).bit_length()
    full = np.fft.irfft(np.conj(np.fft.rfft(x, size)) * np.fft.rfft(y, size), size)
    low, high = -min(most, len(x) - 1), min(most, len(y) - 1)
    window = np.concatenate([full[low:] if low else full[:0], full[: high + 1]])
    at = int(np.abs(window).argmax())
    return low + at, float(abs(window[at]) / energy)


def lags(windows: DataFrame, reference: Column, max_lag: int) -> DataFrame:
    """track, position, lag, correlation, has_signal of every track's windows but the reference's.

    windows: track, position ("start" or "end"), samples. The reference's two windows meet the others by position.
    """

    @F.pandas_udf(LAG)
    def lag(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        found = [measure(np.asarray(a, float), np.asarray(b, float), max_lag) for a, b in zip(left, right, strict=True)]
        return pd.DataFrame(found, columns=["lag", "correlation"])

    loud = lambda c: F.exists(c, lambda v: v != 0)
    anchors = windows.filter(F.col("track") == reference).select("position", F.col("samples").alias("anchor"))
    both = windows.filter(F.col("track") != reference).join(anchors, "position")
    found = both.select("track", "position", lag("anchor", "samples").alias("m"), (loud("anchor") & loud("samples")).alias("has_signal"))
    return found.select("track", "position", "m.lag", "m.correlation", "has_signal")


def outcome(has_signal: Column, correlation: Column, minimum: float) -> Column:
    """no_signal (a silent window), low_confidence (kept as evidence, raises nothing) or measured."""
    return F.when(~has_signal, "sync_qa_no_signal").when(correlation >= minimum, "sync_qa_measured").otherwise("sync_qa_low_confidence")


def threshold(milliseconds: int, rate: int = RATE) -> int:
    """In whole samples, rounded up: never stricter than what was asked for."""
    return -(-milliseconds * rate // 1000)


def assess(measured: DataFrame, minimum: float, offset: int, drift: int) -> DataFrame:
    """track, code: the warnings that two measurements of a track give.

    Only confident lags disagree: with the timecode if one of them is beyond offset, between themselves beyond drift.
    """
    m = measured.withColumn("outcome", outcome(F.col("has_signal"), F.col("correlation"), minimum))
    sure = F.col("outcome") == "sync_qa_measured"
    at = lambda p: F.max(F.when(sure & (F.col("position") == p), F.col("lag")))
    t = m.groupBy("track").agg(at("start").alias("a"), at("end").alias("b"), F.collect_set("outcome").alias("seen"))
    far = lambda c: F.coalesce(F.abs(c) > offset, F.lit(False))
    codes = F.array(
        F.when(F.array_contains("seen", "sync_qa_low_confidence"), "sync_qa_low_confidence"), F.when(F.array_contains("seen", "sync_qa_no_signal"), "sync_qa_no_signal"),
        F.when(far(F.col("a")) | far(F.col("b")), "timecode_disagreement"), F.when(F.abs(F.col("b") - F.col("a")) > drift, "clock_drift_suspected"),
    )
    return t.select("track", F.explode(F.array_compact(codes)).alias("code"))


def end_windows(windows: DataFrame, size: int, rate: int = RATE, seconds: int = 60) -> DataFrame:
    """track, position, samples: both ends of tracks held as windows (track, window, samples) of one length, none longer than half of it.

    Only windows that touch an end are read. Too short a session gives no row.
    """
    duration = windows.agg(F.max(F.col("window") * size + F.size("samples"))).first()[0] or 0
    n = min(seconds * rate, duration // 2)
    if n < LEAST_WINDOW:
        return windows.sparkSession.createDataFrame([], "track long, position string, samples array<double>")
    parts = []
    for name, a in (("start", 0), ("end", duration - n)):
        own = windows.filter((F.col("window") * size < a + n) & ((F.col("window") + 1) * size > a))
        skip = F.greatest(F.lit(0), F.lit(a) - F.col("window") * size).cast("int")
        keep = (F.least(F.lit(a + n) - F.col("window") * size, F.size("samples")) - skip).cast("int")
        cut = own.select("track", "window", F.slice("samples", skip + 1, F.greatest(keep, F.lit(0))).alias("x"))
        joined = cut.groupBy("track").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("window", "x"))), lambda r: r["x"])).alias("samples"))
        parts.append(joined.select("track", F.lit(name).alias("position"), F.col("samples").cast("array<double>").alias("samples")))
    return parts[0].unionByName(parts[1])
