"""Speech activity: detector plugins, frames of tracks held as windows, regions, and the graph of candidates with its evidence."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions import quantize as Q
from tidewright.operators import attribution as A
from tidewright.operators import intervals as I
from tidewright.operators import syncqa as Y
from tidewright.sources.recordings import cut, powers
from tidewright.sources.shared import durable

RATE, FRAME = 16_000, 512


class ActivityDetector(Protocol):
    """Plugin. One instance serves a Python worker; a window's frames must not depend on other windows."""

    def probabilities(self, track: int, start: int, samples: np.ndarray) -> np.ndarray:
        """Of each frame of FRAME samples (the last one may be short), 0 to 1; start is the window's first sample in the session."""


@dataclass(frozen=True)
class Energy:
    """A ramp between two levels (decibels of a frame's mean square)."""

    low: float = -50.0
    high: float = -30.0

    def probabilities(self, track: int, start: int, samples: np.ndarray) -> np.ndarray:
        x = np.concatenate([samples, np.zeros(-len(samples) % FRAME, samples.dtype)]).astype(float).reshape(-1, FRAME)
        db = 10 * np.log10(np.maximum((x**2).mean(1), 1e-12))
        return np.clip((db - self.low) / (self.high - self.low), 0, 1)


@dataclass(frozen=True)
class Spans:
    """From a script of (track, start, end, probability): a frame's share that spans cover, by their probability."""

    spans: tuple[tuple[int, int, int, float], ...]

    def probabilities(self, track: int, start: int, samples: np.ndarray) -> np.ndarray:
        out = np.zeros(-(-len(samples) // FRAME))
        for t, a, b, p in self.spans:
            if t == track and a < start + len(samples) and b > start:
                for i in range(max(0, a - start) // FRAME, min(len(out), -(-(b - start) // FRAME))):
                    shared = min(b, start + (i + 1) * FRAME) - max(a, start + i * FRAME)
                    out[i] += p * shared / FRAME
        return np.minimum(out, 1)


def frames(windows: DataFrame, size: int, factory: Callable[[], ActivityDetector]) -> DataFrame:
    """track, frame, p (permille) of windows (track, window, samples) of `size` samples, a multiple of FRAME."""
    if size % FRAME:
        raise ValueError("a window is a multiple of a frame")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for batch in batches:
            for r in batch.itertuples(index=False):
                p = np.asarray(model.probabilities(r.track, r.window * size, np.asarray(r.samples)), float)
                if len(p) != -(-len(r.samples) // FRAME) or not ((p >= 0) & (p <= 1)).all():
                    raise ValueError("detector_contract: one probability for each frame, 0 to 1")
                yield pd.DataFrame({"track": r.track, "frame": r.window * (size // FRAME) + np.arange(len(p)), "p": np.floor(p * 1000 + 0.5).astype(np.int32)})

    return windows.select("track", "window", "samples").mapInPandas(run, "track long, frame long, p int")


def detect(windows: DataFrame, size: int, factory: Callable[[], ActivityDetector], opens: int = 500, closes: int = 350, min_silence_ms: int = 100, min_speech_ms: int = 250, merge_gap_ms: int = 200, pad_ms: int = 30) -> DataFrame:
    """track, start, end (samples), mean and most (permille) of every speech region."""
    f = durable(frames(windows, size, factory))
    ms = lambda n: -(-n * RATE // (1000 * FRAME))
    limit = windows.agg(F.max(F.col("window") * size + F.size("samples"))).first()[0] or 0
    end = F.lit(-(-limit // FRAME)).cast("long")
    regions = I.assemble_regions(f, ["track"], "frame", "p", opens, closes, ms(min_silence_ms), ms(min_speech_ms), ms(merge_gap_ms), ms(pad_ms), end)
    # frames know their region by the last start before them, as regions of a track are apart
    inside = I.point_join(f, regions.select("track", "start", "end"), "frame", 4096, ["track"])
    summed = inside.groupBy("track", F.col("r.start").alias("start"), F.col("r.end").alias("end")).agg(Q.round_half_away(F.sum("p"), F.count("*")).cast("int").alias("mean"), F.max("p").alias("most"))
    return summed.select("track", (F.col("start") * FRAME).alias("start"), F.least(F.col("end") * FRAME, F.lit(limit)).alias("end"), "mean", "most")


def graph(regions: DataFrame, windows: DataFrame, size: int, max_lag_ms: int = 30, window_ms: int = 2000, min_reference: int = 3) -> tuple[DataFrame, DataFrame]:
    """(decisions, pairs): candidates with their level and verdict, and the correlation of every two that overlap on different tracks.

    A candidate's id is its track and start. Correlation is that of the middle of what they share, within the lag.
    """
    own = regions.select(F.xxhash64("track", "start").alias("id"), "track", F.col("mean").alias("p"), "start", "end")
    level = powers(own, windows, size).select("id", Q.millibels(F.col("power")).alias("level"))
    candidates = durable(own.join(level, "id"))
    half = I.overlap_join(candidates, candidates, 16 * RATE, on=(F.col("l.id") < F.col("r.id")) & (F.col("l.track") != F.col("r.track")))
    start, end = F.greatest("l.start", "r.start"), F.least("l.end", "r.end")
    n = F.least(end - start, F.lit(window_ms * RATE // 1000))
    middle = half.select(F.col("l.id").alias("x"), F.col("r.id").alias("y"), F.col("l.track").alias("xt"), F.col("r.track").alias("yt"), (start + Q.floor_div(end - start - n, 2)).alias("start"), n.alias("n"))
    middle = durable(middle.withColumns({"end": F.col("start") + F.col("n"), "pair": F.xxhash64("x", "y")}))
    side = lambda track, name: cut(middle.select(F.col("pair").alias("id"), F.col(track).alias("track"), "start", "end"), windows, size).select(F.col("id").alias("pair"), F.col("samples").alias(name))
    lag = max_lag_ms * RATE // 1000

    @F.pandas_udf("int")
    def permille(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([min(1000, int(Y.measure(np.asarray(x, float), np.asarray(y, float), lag)[1] * 1000 + 0.5)) for x, y in zip(a, b, strict=True)], dtype="int32")

    met = middle.select("pair", "x", "y").join(side("xt", "a"), "pair").join(side("yt", "b"), "pair").select("x", "y", permille("a", "b").alias("correlation"))
    pairs = met.select(F.col("x").alias("id"), F.col("y").alias("other"), "correlation").unionByName(met.select(F.col("y").alias("id"), F.col("x").alias("other"), "correlation"))
    pairs = durable(pairs)
    verdicts = A.attribute(candidates.select("id", "track", "p", "level"), pairs, min_reference)
    return verdicts.join(candidates.select("id", "start", "end", "p"), "id"), pairs


def requests(retained: DataFrame, length: int, gap_ms: int = 1500, most_ms: int = 30_000, pad_ms: int = 500) -> DataFrame:
    """request_id, track_id, core_start, core_end, padded_start, padded_end of retained candidates (track, start, end), in samples.

    Those with at most the gap between them are asked for together, in pieces no longer than most.
    """
    from tidewright.operators.sequences import divide

    ms = lambda n: n * RATE // 1000
    merged = I.islands(retained.select("track", "start", "end"), ["track"], "start", "end", ms(gap_ms))
    p = divide(merged, "start", "end", ms(most_ms) - 2 * ms(pad_ms))
    zero = F.lit(0).cast("long")
    return p.select(
        F.concat_ws("-", F.lit("req"), "track", "piece_start").alias("request_id"), F.col("track").cast("string").alias("track_id"), F.col("piece_start").alias("core_start"), F.col("piece_end").alias("core_end"),
        F.greatest(zero, F.col("piece_start") - ms(pad_ms)).alias("padded_start"), F.least(F.lit(length).cast("long"), F.col("piece_end") + ms(pad_ms)).alias("padded_end"),
    )


def with_audio(asked: DataFrame, windows: DataFrame, size: int, keys: Sequence[str] = ("request_id",)) -> DataFrame:
    """The requests with the samples of their padded windows."""
    spans = asked.select(F.col("request_id").alias("id"), F.col("track_id").cast("long").alias("track"), F.col("padded_start").alias("start"), F.col("padded_end").alias("end"))
    return asked.join(cut(spans, windows, size).select(F.col("id").alias("request_id"), "samples"), list(keys))
