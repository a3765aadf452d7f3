"""The gains of a mix: weighted spans of speech, a presence held to rise and fall, shares of one signal, level corrections.

A track's presence follows its target by at most rise up and fall down from one control frame to the next. Between two changes of the
target it is a line and then level: so the state is carried from change to change, one row each, and every frame between follows from
its row alone. Windows of frames are then independent of each other, whatever their length; shares need all tracks of a window, and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.quantize import ceil_div, floor_div
from tidewright.operators import intervals as I
from tidewright.operators import sequences as S

SLACK = 1e-9


@dataclass(frozen=True)
class Shape:
    """Per control frame: how much presence rises and falls; the room's share; the least weight of one who speaks; the bound of corrections."""

    rise: float = 0.1
    fall: float = 1 / 300
    room: float = 0.005
    least_weight: float = 0.5
    most_correction_db: float = 6.0


def corrections(references: DataFrame, tracks: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """track, reference, correction_mb, gain, note: each track brought to the median reference, within the bound.

    A track without a reference isn't touched (mix_level_uncorrected); one that would need more is clamped (mix_level_correction_clamped).
    """
    clamp = round(shape.most_correction_db * 100)
    middle = I.nearest_rank(references.withColumn("_all", F.lit(0)), ["_all"], "reference", 0.5, "_target").select("_target")
    own = tracks.select("track").join(references.select("track", "reference"), "track", "left").withColumn("_all", F.lit(0))
    own = own.join(F.broadcast(middle.withColumn("_all", F.lit(0))), "_all", "left").drop("_all")
    wanted = F.col("_target") - F.col("reference")
    held = F.when(wanted.isNotNull(), F.greatest(F.lit(-clamp), F.least(F.lit(clamp), wanted))).cast("int")
    note = F.when(wanted.isNull(), "mix_level_uncorrected").when(held != wanted, "mix_level_correction_clamped")
    mb = F.coalesce(held, F.lit(0))
    return own.select("track", "reference", mb.alias("correction_mb"), F.pow(F.lit(10.0), mb / 2000).alias("gain"), note.alias("note"))


def spans(retained: DataFrame, per: int, shape: Shape = Shape()) -> DataFrame:
    """track, start, end (control frames that cover the candidate), weight: more for a better score. retained: track, start, end, total (permille)."""
    weight = F.lit(shape.least_weight) + F.lit(1 - shape.least_weight) * (F.col("total") / 1000)
    return retained.select("track", floor_div(F.col("start"), per).alias("start"), ceil_div(F.col("end"), per).alias("end"), weight.alias("weight"))


def segments(active: DataFrame, tracks: DataFrame, count: int, block: int, shape: Shape = Shape()) -> DataFrame:
    """track, start, end, weight, before: the frames of each track between two changes of its target, and its presence before the first of them.

    They tile 0 to count. Where spans of a track share frames the greatest weight counts.
    """
    zero, last = F.lit(0).cast("long"), F.lit(count).cast("long")
    inside = active.select("track", F.greatest(zero, F.least("start", last)).alias("start"), F.greatest(zero, F.least("end", last)).alias("end"), "weight").filter("end > start")
    edges = inside.select("track", F.explode(F.array("start", "end")).alias("start")).unionByName(tracks.select("track", F.explode(F.array(zero, last)).alias("start"))).distinct()
    pieces = edges.withColumn("end", F.lead("start").over(Window.partitionBy("track").orderBy("start"))).filter("end is not null")
    met = I.overlap_join(pieces, inside, block, on=F.col("l.track") == F.col("r.track")).groupBy("l.track", "l.start").agg(F.max("r.weight").alias("weight"))
    own = pieces.join(met, ["track", "start"], "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))

    def step(rows: dict[str, np.ndarray], state: float | None) -> tuple[np.ndarray, float]:
        p, out = state or 0.0, []
        for a, b, w in zip(rows["start"].tolist(), rows["end"].tolist(), rows["weight"].tolist(), strict=True):
            out.append(p)
            p = float(presence(p, w, np.array([b - a]), shape)[0])
        return np.array(out), p

    return S.fold(own.select("track", "start", "end", "weight"), ["track"], ["start", "end", "weight"], step, "before", "double")


def presence(before: float, weight: float, steps: np.ndarray, shape: Shape) -> np.ndarray:
    """After so many frames of a target, from what it was before the first of them."""
    return np.minimum(weight, before + shape.rise * steps) if weight >= before else np.maximum(weight, before - shape.fall * steps)


def applied(parts: DataFrame, levels: DataFrame, count: int, per: int, shape: Shape = Shape()) -> DataFrame:
    """track, window, before, gains: of windows of per control frames what each track is multiplied by, and the frame before it.

    parts: segments(). levels: corrections(). Bounds are held where they are made: shares of a frame sum to one, applied gains to what
    corrections allow, presence moves no faster than its shape; else the job fails with envelope_invariant_violated.
    """
    clamp = 10 ** (round(shape.most_correction_db * 100) / 2000)
    # the last frame of a segment is the one before the frame at its end
    touched = parts.withColumn("window", F.explode(F.sequence(floor_div(F.col("start"), per), F.least(floor_div(F.col("end"), per), F.lit((count - 1) // per).cast("long")))))
    rows = touched.join(F.broadcast(levels.select("track", "gain")), "track")  # a row for each track

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        window = int(frame["window"].iloc[0])
        first, n = window * per, min(per, count - window * per)
        tracks = sorted(frame["track"].unique())
        p = np.zeros((len(tracks), n + 1))  # the frame before comes first
        gain = np.ones(len(tracks))
        for r in frame.itertuples(index=False):
            i = tracks.index(r.track)
            gain[i] = r.gain
            a, b = max(r.start, first - 1), min(r.end, first + n)
            if b > a:
                p[i, a - first + 1 : b - first + 1] = presence(r.before, r.weight, np.arange(a, b) - r.start + 1, shape)
        share = np.maximum(p, shape.room)
        share = share / share.sum(0)
        out = share * gain[:, None]
        steps = np.diff(p, axis=1)
        total = out.sum(0)
        if (abs(share.sum(0) - 1) > SLACK).any() or (total > clamp + SLACK).any() or (total < 1 / clamp - SLACK).any() or (steps > shape.rise + SLACK).any() or (steps < -shape.fall - SLACK).any():
            raise ValueError(f"envelope_invariant_violated: in window {window}")
        return pd.DataFrame({"track": tracks, "window": window, "before": out[:, 0], "gains": list(out[:, 1:])})

    return rows.select("track", "window", "start", "end", "weight", "before", "gain").groupBy("window").applyInPandas(run, "track long, window long, before double, gains array<double>")


def envelope(retained: DataFrame, tracks: DataFrame, levels: DataFrame, samples: int, frame: int, per: int, shape: Shape = Shape()) -> DataFrame:
    """applied() for candidates given in samples; samples are the session's, frame those of a control frame."""
    count = -(-samples // frame)
    return applied(segments(spans(retained, frame, shape), tracks, count, 16 * per, shape), levels, count, per, shape)


def guaranteed_gain(tracks: Column, least_weight: float, room: float, clamp_db: float) -> Column:
    """The least gain in dB of one of two speakers at once: the least weight, the other full, the rest at room tone, cut by the clamp."""
    share = F.lit(least_weight) / (F.lit(1 + least_weight) + F.lit(room) * F.greatest(tracks - 2, F.lit(0)))
    return F.log10(share) * 20 - clamp_db
