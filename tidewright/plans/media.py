"""Queries of signal kernels, streaming forms and constraints on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewright import streaming
from tidewright.operators import activity as D
from tidewright.operators import intervals as I
from tidewright.operators import rules as R
from tidewright.functions import quantize as Q
from tidewright.operators import signal as G
from tidewright.operators import syncqa as Y
from tidewright.plans.intervals import REGIONS_SQL, regions
from tidewright.plans.registry import FRAMES_SQL, GRID_SQL, frames, grid, islands_sql, query, read
from tidewright.sources.shared import durable


def _vectors(spark, d):
    return read(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))


@query("xcorr_lag")
def xcorr_lag(spark, d):
    v = _vectors(spark, d)
    pairs = v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y")), "vec_id")
    return pairs.select("vec_id", G.xcorr_lag(16)("x", "y").alias("r")).select("vec_id", "r.lag", "r.permille")


@query("matched_filter")
def matched_filter(spark, d):
    return _vectors(spark, d).select("vec_id", G.matched_filter([1.0, -1.0, 2.0, 0.5])("x").alias("scores"))


@query("band_limit")
def band_limit(spark, d):
    return _vectors(spark, d).select("vec_id", G.filtered(G.low_pass(15, 0.2))("x").alias("y"))


@query("decimate_3to1")
def decimate(spark, d):
    return _vectors(spark, d).select("vec_id", G.filtered(G.low_pass(31, 1 / 6), 3)("x").alias("y"))


@query("sync_qa")
def sync_qa(spark, d):
    """Every embedding as a track's audio: its two halves are the windows at both ends, and the least vec_id is the reference.

    Warnings and measurements of every other track; tests hold them to brute force.
    """
    v = _vectors(spark, d)
    least = v.agg(F.min("vec_id")).first()[0]
    half = lambda n, a: F.struct(F.lit(n).alias("position"), F.slice("x", a, 32).alias("samples"))
    windows = v.select(F.col("vec_id").alias("track"), F.explode(F.array(half("start", 1), half("end", 33))).alias("w")).select("track", "w.position", "w.samples")
    found = durable(Y.lags(windows, F.lit(least), 8))
    codes = Y.assess(found, 0.4, 2, 4).groupBy("track").agg(F.array_join(F.array_sort(F.collect_set("code")), ",").alias("codes"))
    p = Q.to_permille(F.col("correlation") * 1000)
    return found.join(codes, "track", "left").select("track", "position", "lag", p.alias("permille"), Y.outcome(F.col("has_signal"), F.col("correlation"), 0.4).alias("outcome"), F.coalesce("codes", F.lit("")).alias("codes"))


@query("rms_peak", "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / len(embedding)), 6) AS rms, round(list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))), 6) AS peak FROM embeddings")
def rms_peak(spark, d):
    return _vectors(spark, d).select("vec_id", F.round(F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, b: a + b * b) / F.size("x")), 6).alias("rms"), F.round(F.array_max(F.transform("x", F.abs)), 6).alias("peak"))


@query("stream_windows", """SELECT epoch_us(ts) // 600000000 * 600 AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def stream_windows(spark, d):
    """Every window of the stream, the last ones too: a closing row moves the watermark past them."""
    events = streaming.read_stream(spark, f"{d}/events.parquet", closing=streaming.closing_row(read(spark, d, "events"), "ts", "3 days"))
    out = streaming.drain(streaming.windowed(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "10 minutes", "10 minutes", "event_type"))
    return out.select(F.unix_seconds("start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("stream_sessions", """WITH o AS (SELECT user_id, epoch_us(ts) AS t, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
s AS (SELECT *, sum(CASE WHEN before IS NULL OR t - before > 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t) AS session FROM o)
SELECT user_id, min(t) AS start, max(t) + 1800000000 AS "end", count(*) AS n FROM s GROUP BY user_id, session""")
def stream_sessions(spark, d):
    events = streaming.read_stream(spark, f"{d}/events.parquet", closing=streaming.closing_row(read(spark, d, "events"), "ts", "3 days"))
    out = streaming.drain(streaming.sessions(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "10 minutes", "30 minutes", "user_id"))
    return out.select("user_id", F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"), "n")


@query("vad_state", "WITH " + FRAMES_SQL + " SELECT track, frame, coalesce(last_value(CASE WHEN p >= 300 THEN 1 WHEN p < 100 THEN 0 END IGNORE NULLS) OVER (PARTITION BY track ORDER BY frame ROWS UNBOUNDED PRECEDING), 0) = 1 AS active FROM frames")
def vad_state(spark, d):
    """The batch form; its streaming twin is streaming.hysteresis, which tests hold to the same rows."""
    return I.hysteresis(frames(spark, d), ["track"], "frame", "p", 300, 100).select("track", "frame", "active")


@query("constraint_tiling", "WITH " + REGIONS_SQL + """, o AS (SELECT *, lag("end") OVER (PARTITION BY track ORDER BY start) AS before FROM regions)
SELECT track, count(*) FILTER (WHERE "end" <= start OR before >= start) AS violations, count(*) FILTER (WHERE start - before < 40) AS near FROM o GROUP BY track""")
def constraint_tiling(spark, d):
    """Regions of a track are in order, apart and not empty: none may break that. near counts those closer than 40 frames, which may be."""
    o = regions(spark, d).withColumn("before", F.lag("end").over(Window.partitionBy("track").orderBy("start")))
    return o.groupBy("track").agg(F.count_if(F.expr("end <= start or before >= start")).alias("violations"), F.count_if(F.expr("start - before < 40")).alias("near"))


@query("ceilings", "WITH " + GRID_SQL + " SELECT track, count(*) FILTER (WHERE p >= 900) AS peaks, count(*) FILTER (WHERE p >= 900) > 32 AS over FROM grid GROUP BY track")
def ceilings(spark, d):
    return R.ceiling(grid(spark, d), "track", F.col("p") >= 900, 32)


# ---- steps of the chain on driver tables


@query("detect_frames", """WITH e AS (SELECT vec_id // 8 AS frame, sum(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) * pow(10.0, -(vec_id // 8 % 40) / 10.0)) AS power FROM embeddings GROUP BY 1)
SELECT 7::BIGINT AS track, frame, floor(least(1, greatest(0, (10 * log10(greatest(power / 512, 1e-12)) + 50) / 40)) * 1000 + 0.5)::INTEGER AS p FROM e""")
def detect_frames(spark, d):
    """Embeddings one behind another as a track's audio, weaker and weaker over 40 frames; the detector is a ramp of a frame's level."""
    e = read(spark, d, "embeddings")
    gain = F.pow(F.lit(10.0), -(F.expr("vec_id div 8 % 40")) / 20.0)
    x = e.select("vec_id", F.transform("embedding", lambda v: (v.cast("double") * gain).cast("float")).alias("x"))
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "x"))), lambda r: r["x"]))
    windows = x.groupBy(F.expr("vec_id div 64").alias("window")).agg(joined.alias("samples")).withColumn("track", F.lit(7).cast("long"))
    return D.frames(windows, 4096, lambda: D.Energy(-50.0, -10.0))


@query("speech_requests", "WITH " + REGIONS_SQL + ', s AS (SELECT track, start * 16000 AS start, "end" * 16000 AS "end" FROM regions), merged AS (' + islands_sql("s", "track", 24000, False) + """),
cut AS (SELECT track, start, "end" - start AS total, ("end" - start + 463999) // 464000 AS k, unnest(range(("end" - start + 463999) // 464000)) AS i FROM merged),
p AS (SELECT track, start + i * total // k AS a, start + (i + 1) * total // k AS b FROM cut)
SELECT 'req-' || track || '-' || a AS request_id, track::VARCHAR AS track_id, a AS core_start, b AS core_end, greatest(0, a - 8000) AS padded_start, least(100000000000, b + 8000) AS padded_end FROM p""")
def speech_requests(spark, d):
    """Regions, a second for each of their frames, as requests of at most half a minute."""
    s = regions(spark, d).select("track", (F.col("start") * 16_000).alias("start"), (F.col("end") * 16_000).alias("end"))
    return D.requests(s, 100_000_000_000)
