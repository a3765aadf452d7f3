"""Registration of queries over the driver tables, and the rows they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Frames: six tracks, five minutes each, the greatest value as permille of 490.

FRAMES_SQL = "frames AS (SELECT user_id % 6 AS track, epoch_us(ts) // 300000000 AS frame, least(1000, floor(max(value) / 490.0 * 1000 + 0.5))::INTEGER AS p FROM events GROUP BY 1, 2)"
#: The dense grid of frames of each track: what isn't observed has probability 0.
GRID_SQL = FRAMES_SQL + ", ends AS (SELECT track, min(frame) AS a, max(frame) AS b FROM frames GROUP BY track), grid AS (SELECT g.track, g.frame, coalesce(f.p, 0) AS p FROM (SELECT track, unnest(range(a, b + 1)) AS frame FROM ends) g LEFT JOIN frames f ON f.track = g.track AND f.frame = g.frame)"


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    frame = F.expr("unix_micros(cast(ts as timestamp)) div 300000000")
    p = F.least(F.lit(1000), F.floor(F.max("value") / 490.0 * 1000 + 0.5)).cast("int")
    return e.groupBy((F.col("user_id") % 6).alias("track"), frame.alias("frame")).agg(p.alias("p"))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = frames(spark, sf_dir)
    ends = own.groupBy("track").agg(F.min("frame").alias("a"), F.max("frame").alias("b"))
    every = ends.select("track", F.explode(F.sequence("a", "b")).alias("frame"))
    return every.join(own, ["track", "frame"], "left").select("track", "frame", F.coalesce("p", F.lit(0)).alias("p"))


# Intervals: an event of a user from its time on, a second for each unit of value, in milliseconds.

SPANS_SQL = "spans AS (SELECT event_id, user_id, user_id % 6 AS track, epoch_us(ts) // 1000 AS start, epoch_us(ts) // 1000 + floor(value * 1000)::BIGINT AS \"end\", least(1000, floor(value / 490.0 * 1000 + 0.5))::INTEGER AS p, event_type FROM events)"


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.expr("unix_micros(cast(ts as timestamp)) div 1000")
    return read(spark, sf_dir, "events").select(
        "event_id", "user_id", (F.col("user_id") % 6).alias("track"), start.alias("start"), (start + F.floor(F.col("value") * 1000)).alias("end"),
        F.least(F.lit(1000), F.floor(F.col("value") / 490.0 * 1000 + 0.5)).cast("int").alias("p"), "event_type",
    )


def islands_sql(source: str, by: str, gap: int, strict: bool, extra: str = "") -> str:
    """DuckDB SQL of operators.intervals.islands."""
    return f"""SELECT {by}, min(start) AS start, max("end") AS "end"{extra} FROM (SELECT *, sum(fresh) OVER (PARTITION BY {by} ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM (
      SELECT *, CASE WHEN reach IS NULL OR start - reach {'>=' if strict else '>'} {gap} THEN 1 ELSE 0 END AS fresh FROM (
        SELECT *, max("end") OVER (PARTITION BY {by} ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source}))) GROUP BY {by}, island"""
