"""Finding markers in tracks held as windows of samples.

A table of windows has the track's columns, window (from 0) and samples; all windows but the last have the same size. Each
window is scored on its own, with the beginning of the next one as halo, so that no task depends on another's state.
What is found at two windows' border is one peak, by the greater score.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions import waveform as W
from tidewright.operators import intervals as I

# Permilles and samples at 48 kHz.
LEAST_CHIRP = LEAST_SEQUENCE = 300
SEPARATION = 50
TOLERANCE = 1440
RADIUS, SEQUENCE_RADIUS = 2400, 7200
CLIPPING, WEAK, FULL_SCALE = 10, 1, 990


def match(x: np.ndarray, template: np.ndarray) -> np.ndarray:
    """Permille of the normalized match at every offset, by FFT; a silent stretch matches by 0."""
    n, m = len(x), len(template)
    if n < m:
        return np.zeros(0, np.int64)
    size = 1 << (n + m - 1).bit_length()
    x, t = np.asarray(x, float), np.asarray(template, float)
    dot = np.fft.irfft(np.fft.rfft(x, size) * np.conj(np.fft.rfft(t, size)), size)[: n - m + 1]
    sums = np.concatenate([[0.0], np.cumsum(x * x)])
    norm = np.sqrt(np.maximum(sums[m:] - sums[:-m], 0) * (t @ t))
    share = np.divide(np.abs(dot), norm, out=np.zeros_like(dot), where=norm > 1e-9 * np.sqrt(t @ t))
    return np.floor(np.clip(share, 0, 1) * 1000 + 0.5).astype(np.int64)


def peaks_of(scores: np.ndarray, least: int, radius: int) -> list[tuple[int, int]]:
    """(place, score): the greatest, then none within radius of it, and so on. Only places at or above least are visited."""
    places = np.flatnonzero(scores >= least)
    order = places[np.lexsort((places, -scores[places]))]
    taken = np.zeros(len(scores), bool)
    out = []
    for p in order.tolist():
        if not taken[p]:
            out.append((p, int(scores[p])))
            taken[max(0, p - radius) : p + radius + 1] = True
    return out


def with_halo(windows: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """samples are followed by the first n of the next window: an equi-join, no order needed."""
    lead = windows.select(*by, (F.col("window") - 1).alias("window"), F.slice("samples", 1, n).alias("_lead"))
    joined = windows.join(lead, [*by, "window"], "left")
    return joined.select(*by, "window", F.size("samples").alias("own"), F.concat("samples", F.coalesce("_lead", F.array().cast(windows.schema["samples"].dataType))).alias("samples"))


def chirp_peaks(windows: DataFrame, by: Sequence[str], size: int, marker: W.Marker, least: int = LEAST_CHIRP, radius: int = RADIUS) -> DataFrame:
    """by, chirp, at, score: local maxima of each chirp's match. A window must be longer than a chirp."""
    if size <= marker.length:
        raise ValueError("a window is longer than a chirp")
    ready = with_halo(windows, by, marker.length - 1)
    types = {f.name: f.dataType.simpleString() for f in windows.schema.fields}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in by), "chirp int, at long, score int"])
    name = marker.name

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes = W.templates(W.marker(name))
        for frame in frames:
            rows = []
            for r in frame.to_dict("records"):
                for i, shape in enumerate(shapes):
                    scores = match(r["samples"], shape)[: r["own"]]
                    rows += [(*(r[c] for c in by), i, r["window"] * size + p, s) for p, s in peaks_of(scores, least, radius)]
            yield pd.DataFrame(rows, columns=[*by, "chirp", "at", "score"])

    found = ready.mapInPandas(run, schema)
    # two windows' peaks within the radius of each other are one: the greater, then the earlier
    other = found.select(*[F.col(c).alias(f"o_{c}") for c in by], F.col("chirp").alias("o_chirp"), F.col("at").alias("o_at"), F.col("score").alias("o_score"))
    near = I.band_join(found, other, "at", "o_at", radius, [("chirp", "o_chirp"), *((c, f"o_{c}") for c in by)])
    better = (F.col("o_score") > F.col("score")) | ((F.col("o_score") == F.col("score")) & (F.col("o_at") < F.col("at")))
    beaten = near.filter(better & (F.expr(f"o_at div {size}") != F.expr(f"at div {size}"))).select(*by, "chirp", "at").distinct()
    return found.join(beaten, [*by, "chirp", "at"], "left_anti")


def sequences(peaks: DataFrame, by: Sequence[str], marker: W.Marker, tolerance: int = TOLERANCE, least: int = LEAST_SEQUENCE) -> DataFrame:
    """by, anchor, score, hits (array of (at, score)), gap_errors: a first chirp with all others where they should be.

    Of several candidates for a chirp the best score counts, then the nearest, then the earliest. The
    sequence is as good as its weakest chirp. Gaps are held to the tolerance as well as places.
    """
    first = peaks.filter("chirp = 0").select(*by, F.col("at").alias("anchor"), F.struct("at", "score").alias("hit_0"))
    places = [a - marker.intervals[0][0] for a, _ in marker.intervals]
    out = first
    for i in range(1, len(places)):
        later = peaks.filter(F.col("chirp") == i).select(*[F.col(c).alias(f"p_{c}") for c in by], F.col("at").alias("p_at"), F.col("score").alias("p_score"))
        want = first.select(*by, "anchor", (F.col("anchor") + places[i]).alias("expected"))
        near = I.band_join(want, later, "expected", "p_at", tolerance, [(c, f"p_{c}") for c in by])
        key = F.struct("p_score", -F.abs(F.col("p_at") - F.col("expected")), -F.col("p_at"))
        best = near.groupBy(*by, "anchor").agg(F.max_by(F.struct(F.col("p_at").alias("at"), F.col("p_score").alias("score")), key).alias(f"hit_{i}"))
        out = out.join(best, [*by, "anchor"])
    hits = [F.col(f"hit_{i}") for i in range(len(places))]
    errors = [hits[i + 1]["at"] - hits[i]["at"] - marker.length - gap for i, gap in enumerate(marker.gaps)]
    out = out.select(*by, "anchor", F.least(*[h["score"] for h in hits]).alias("score"), F.array(*hits).alias("hits"), F.array(*errors).alias("gap_errors"))
    return out.filter((F.col("score") >= least) & F.forall("gap_errors", lambda e: F.abs(e) <= tolerance))


def sequence_nms(found: DataFrame, by: Sequence[str], radius: int = SEQUENCE_RADIUS, at: str = "anchor", score: str = "score") -> DataFrame:
    """The best of the sequences within each radius, greedily; ties go to the lower place.

    Sequences further apart than the radius from all others can't touch them, so the fold runs over clusters of near ones, not
    over tracks. Clusters are dealt to tasks by hash and come in greedy order; a task holds what it kept of one.
    """
    order = Window.partitionBy(*by).orderBy(at)
    fresh = F.when(F.col(at) - F.lag(at).over(order) <= radius, 0).otherwise(1)
    runs = found.withColumn("_fresh", fresh).withColumn("_run", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_fresh")
    keys = [*by, "_run"]

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, kept = None, []
        for frame in frames:
            chosen = np.zeros(len(frame), bool)
            for i, (*key, place) in enumerate(zip(*(frame[c].tolist() for c in (*keys, at)), strict=True)):
                if key != current:
                    current, kept = key, []
                j = bisect_left(kept, place)
                if (j == 0 or place - kept[j - 1] > radius) and (j == len(kept) or kept[j] - place > radius):
                    kept.insert(j, place)
                    chosen[i] = True
            yield frame[chosen]

    ordered = runs.repartition(*keys).sortWithinPartitions(*keys, F.col(score).desc(), at)
    return ordered.mapInPandas(keep, runs.schema).drop("_run")


def runner_up(kept: DataFrame, peaks: DataFrame, by: Sequence[str], radius: int = RADIUS, around: int = SEQUENCE_RADIUS, separation: int = SEPARATION) -> DataFrame:
    """Adds runner_up (0: none) and ambiguous: the best peak of a chirp near its hit that no kept sequence claims."""
    hits = kept.select(*by, "anchor", F.posexplode("hits").alias("h_chirp", "hit")).select(*by, "anchor", "h_chirp", F.col("hit.at").alias("h_at"))
    own = peaks.select(*[F.col(c).alias(f"p_{c}") for c in by], F.col("chirp").alias("p_chirp"), F.col("at").alias("p_at"), F.col("score").alias("p_score"))
    same = [("h_chirp", "p_chirp"), *((c, f"p_{c}") for c in by)]
    keys = [*(f"p_{c}" for c in by), "p_chirp", "p_at"]
    claimed = I.band_join(hits, own, "h_at", "p_at", radius, same).select(*keys).distinct()
    free = I.band_join(hits, own.join(claimed, keys, "left_anti"), "h_at", "p_at", around, same)
    best = free.groupBy(*by, "anchor").agg(F.max("p_score").alias("runner_up"))
    out = kept.join(best, [*by, "anchor"], "left").withColumn("runner_up", F.coalesce("runner_up", F.lit(0)))
    return out.withColumn("ambiguous", (F.col("runner_up") > 0) & (F.col("score") - F.col("runner_up") < separation))


def describe(kept: DataFrame, windows: DataFrame, by: Sequence[str], size: int, marker: W.Marker) -> DataFrame:
    """Adds peak, rms (permille), clipped and weak, from partial sums of the windows that a sequence touches."""
    span = kept.select(*by, "anchor", F.explode(F.sequence(F.expr(f"anchor div {size}"), F.expr(f"(anchor + {marker.total - 1}) div {size}"))).alias("window"))
    cut = span.join(windows, [*by, "window"]).withColumn("_from", F.greatest(F.lit(0), F.col("anchor") - F.col("window") * size))
    part = F.slice("samples", (F.col("_from") + 1).cast("int"), F.greatest(F.lit(0), F.least(F.lit(size), F.col("anchor") + marker.total - F.col("window") * size) - F.col("_from")).cast("int"))
    cut = cut.select(*by, "anchor", F.transform(part, lambda v: v.cast("double")).alias("x"))
    sums = cut.select(*by, "anchor", F.size("x").alias("n"), F.array_max(F.transform("x", lambda v: F.abs(v))).alias("top"), F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v).alias("power"), F.size(F.filter("x", lambda v: F.abs(v) >= FULL_SCALE / 1000)).alias("full"))
    whole = sums.groupBy(*by, "anchor").agg(F.max("top").alias("top"), F.sqrt(F.sum("power") / F.sum("n")).alias("root"), (F.sum("full") / F.sum("n")).alias("share"))
    p = lambda c: F.least(F.lit(1000), F.floor(F.col(c) * 1000 + 0.5)).cast("int")
    flags = whole.select(*by, "anchor", p("top").alias("peak"), p("root").alias("rms"), (p("share") >= CLIPPING).alias("clipped"), (p("root") < WEAK).alias("weak"))
    return kept.join(flags, [*by, "anchor"], "left")


def detect(windows: DataFrame, by: Sequence[str], size: int, marker: W.Marker | None = None) -> DataFrame:
    """Every occurrence of the marker: by, anchor, score, hits, gap_errors, runner_up, ambiguous, peak, rms, clipped, weak."""
    m = marker or W.marker()
    peaks = chirp_peaks(windows, by, size, m)
    kept = sequence_nms(sequences(peaks, by, m), by)
    return describe(runner_up(kept, peaks, by), windows, by, size, m)
