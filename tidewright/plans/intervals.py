"""Queries of interval, window and timecode operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewright.functions import quantize as Q
from tidewright.functions import timecode as T
from tidewright.operators import intervals as I
from tidewright.operators import rules as R
from tidewright.plans.registry import FRAMES_SQL, GRID_SQL, SPANS_SQL, SQL, frames, grid, islands_sql, query, read, spans

# ---- frames to regions

HYST_SQL = GRID_SQL + """, state AS (SELECT track, frame, p, coalesce(last_value(CASE WHEN p >= 300 THEN 1 WHEN p < 100 THEN 0 END IGNORE NULLS) OVER (PARTITION BY track ORDER BY frame ROWS UNBOUNDED PRECEDING), 0) = 1 AS active FROM grid),
runs AS (SELECT track, min(frame) AS start, max(frame) + 1 AS "end" FROM (SELECT track, frame, frame - row_number() OVER (PARTITION BY track ORDER BY frame) AS run FROM state WHERE active) GROUP BY track, run)"""
REGIONS_SQL = HYST_SQL + f""", r1 AS (SELECT * FROM ({islands_sql("runs", "track", 2, True)}) WHERE "end" - start >= 2), r2 AS ({islands_sql("r1", "track", 3, True)}),
r3 AS (SELECT track, greatest(0, start - 1) AS start, "end" + 1 AS "end" FROM r2), regions AS ({islands_sql("r3", "track", 0, False)})"""


def regions(spark, d):
    return I.assemble_regions(grid(spark, d), ["track"], "frame", "p", 300, 100, 2, 2, 3, 1)


@query("span_frames", "WITH " + FRAMES_SQL + " SELECT track, frame, p FROM frames")
def span_frames(spark, d):
    return frames(spark, d)


@query("hysteresis", "WITH " + HYST_SQL + " SELECT track, frame, p, active FROM state")
def hysteresis(spark, d):
    return I.hysteresis(grid(spark, d), ["track"], "frame", "p", 300, 100)


@query("merge_gap", "WITH " + HYST_SQL + " " + islands_sql("runs", "track", 2, True))
def merge_gap(spark, d):
    return I.islands(I.active_runs(I.hysteresis(grid(spark, d), ["track"], "frame", "p", 300, 100), ["track"], "frame"), ["track"], "start", "end", 2, strict=True)


@query("drop_short", "WITH " + HYST_SQL + f' SELECT * FROM ({islands_sql("runs", "track", 2, True)}) WHERE "end" - start >= 2')
def drop_short(spark, d):
    return merge_gap(spark, d).filter("end - start >= 2")


@query("assemble_regions", "WITH " + REGIONS_SQL + ' SELECT track, start, "end" FROM regions')
def assemble(spark, d):
    return regions(spark, d)


@query("region_summary", "WITH " + REGIONS_SQL + """ SELECT r.track, r.start, r."end", least(1000, floor(sum(g.p)::DOUBLE / count(*) + 0.5))::INTEGER AS mean_p, max(g.p) AS peak_p FROM regions r JOIN grid g ON g.track = r.track AND g.frame >= r.start AND g.frame < r."end" GROUP BY 1, 2, 3""")
def region_summary(spark, d):
    inside = I.point_join(grid(spark, d), regions(spark, d), "frame", 16, ["track"])
    return inside.groupBy("track", F.col("r.start").alias("start"), F.col("r.end").alias("end")).agg(Q.to_permille(F.sum("p").cast("double") / F.count("*")).alias("mean_p"), F.max("p").alias("peak_p"))


@query("sessionization", "WITH " + SPANS_SQL + " " + islands_sql("spans", "user_id", 1800000, False, ", count(*) AS n"))
def sessionization(spark, d):
    return I.islands(spans(spark, d), ["user_id"], "start", "end", 1_800_000, aggs=[F.count("*").alias("n")])


@query("merge_islands", "WITH " + SPANS_SQL + " " + islands_sql("spans", "track", 0, False))
def merge_islands(spark, d):
    return I.islands(spans(spark, d), ["track"], "start", "end")


COVER_SQL = "WITH " + SPANS_SQL + """, t AS (SELECT track, p, start, "end", unnest(range(start // 60000, ("end" - 1) // 60000 + 1)) AS frame FROM spans)
SELECT track, frame, least(1000, floor(sum(p * (least("end", (frame + 1) * 60000) - greatest(start, frame * 60000)))::DOUBLE / 60000 + 0.5))::INTEGER AS p FROM t GROUP BY 1, 2"""


@query("span_coverage", COVER_SQL)
def span_coverage(spark, d):
    return I.span_coverage(spans(spark, d).withColumnRenamed("p", "probability"), ["track"], 60000)


# ---- joins

OVERLAP = 'a.start < b."end" AND b.start < a."end"'


@query("overlap_join", "WITH " + SPANS_SQL + f' SELECT a.event_id AS first, b.event_id AS second, greatest(a.start, b.start) AS overlap_start, least(a."end", b."end") AS overlap_end FROM spans a JOIN spans b ON a.event_id < b.event_id AND a.track != b.track AND {OVERLAP}')
def overlap_join(spark, d):
    s = spans(spark, d)
    pairs = I.overlap_join(s, s, 60000, on=(F.col("l.event_id") < F.col("r.event_id")) & (F.col("l.track") != F.col("r.track")))
    return pairs.select(F.col("l.event_id").alias("first"), F.col("r.event_id").alias("second"), F.greatest("l.start", "r.start").alias("overlap_start"), F.least("l.end", "r.end").alias("overlap_end"))


@query("draft_pairs", "WITH " + SPANS_SQL + f' SELECT a.event_id AS first, b.event_id AS second, least(1000, (least(a."end", b."end") - greatest(a.start, b.start)) * 1000 // least(a."end" - a.start, b."end" - b.start)) AS overlap_permille FROM spans a JOIN spans b ON a.event_id < b.event_id AND a.track != b.track AND {OVERLAP}')
def draft_pairs(spark, d):
    """A span of no length within another one is all of it: 1000."""
    s = spans(spark, d)
    pairs = I.overlap_join(s, s, 60000, on=(F.col("l.event_id") < F.col("r.event_id")) & (F.col("l.track") != F.col("r.track")))
    shared, shorter = F.least("l.end", "r.end") - F.greatest("l.start", "r.start"), F.least(F.col("l.end") - F.col("l.start"), F.col("r.end") - F.col("r.start"))
    return pairs.select(F.col("l.event_id").alias("first"), F.col("r.event_id").alias("second"), F.least(F.lit(1000), Q.floor_div(shared * 1000, F.nullif(shorter, F.lit(0)))).alias("overlap_permille"))


@query("overlap_flag", "WITH " + SPANS_SQL + f' SELECT a.event_id, EXISTS (SELECT 1 FROM spans b WHERE b.user_id != a.user_id AND {OVERLAP} AND least(a."end", b."end") - greatest(a.start, b.start) >= 5000) AS overlap FROM spans a')
def overlap_flag(spark, d):
    s = spans(spark, d)
    shared = F.least("l.end", "r.end") - F.greatest("l.start", "r.start")
    hit = I.overlap_join(s, s, 60000, on=(F.col("l.user_id") != F.col("r.user_id")) & (shared >= 5000)).select(F.col("l.event_id").alias("event_id")).distinct()
    return s.select("event_id").join(hit.withColumn("overlap", F.lit(True)), "event_id", "left").select("event_id", F.coalesce("overlap", F.lit(False)).alias("overlap"))


POINTS = "points AS (SELECT event_id, user_id % 6 AS track, epoch_us(ts) // 300000000 AS at FROM events WHERE event_type = 'click')"


def points(spark, d):
    return read(spark, d, "events").filter("event_type = 'click'").select("event_id", (F.col("user_id") % 6).alias("track"), F.expr("unix_micros(cast(ts as timestamp)) div 300000000").alias("at"))


@query("word_ownership", "WITH " + REGIONS_SQL + ", " + POINTS + ' SELECT w.event_id, w.track, w.at, r.start, r."end" FROM points w JOIN regions r ON r.track = w.track AND w.at >= r.start AND w.at < r."end"')
def word_ownership(spark, d):
    return I.point_join(points(spark, d), regions(spark, d), "at", 16, ["track"]).select("event_id", "track", "at", "r.start", "r.end")


@query("source_coordinate", "WITH " + REGIONS_SQL + ", " + POINTS + ' SELECT w.event_id, w.at - r.start AS source_at FROM points w LEFT JOIN regions r ON r.track = w.track AND w.at >= r.start AND w.at < r."end"')
def source_coordinate(spark, d):
    return I.point_join(points(spark, d), regions(spark, d), "at", 16, ["track"], "left").select("event_id", (F.col("at") - F.col("r.start")).alias("source_at"))


DROPPED = "WITH " + REGIONS_SQL + ", " + POINTS + """, lost AS (SELECT * FROM points w WHERE NOT EXISTS (SELECT 1 FROM regions r WHERE r.track = w.track AND w.at >= r.start AND w.at < r."end")),
edges AS (SELECT track, start AS edge, 'before' AS side, start AS region FROM regions UNION ALL SELECT track, "end", 'after', start FROM regions),
near AS (SELECT l.event_id, l.track, abs(l.at - e.edge) AS distance, e.region, e.side, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(l.at - e.edge), e.region, e.side) AS place FROM lost l LEFT JOIN edges e ON e.track = l.track)"""


def dropped(spark, d):
    """Points in no region, with the nearest edge: the last region that ends before, or the first that starts after; null on a track without one."""
    r, w = regions(spark, d), points(spark, d)
    lost = I.point_join(w, r, "at", 16, ["track"], "left_anti")
    marks = r.select("track", F.col("start").alias("at"), F.lit(None).cast("long").alias("event_id"), F.col("start").alias("next_start"), F.lit(None).cast("long").alias("prev_end"), F.lit(None).cast("long").alias("prev_start"))
    ends = r.select("track", F.col("end").alias("at"), F.lit(None).cast("long").alias("event_id"), F.lit(None).cast("long").alias("next_start"), F.col("end").alias("prev_end"), F.col("start").alias("prev_start"))
    null = F.lit(None).cast("long")
    both = marks.unionByName(ends).unionByName(lost.select("track", "at", "event_id", null.alias("next_start"), null.alias("prev_end"), null.alias("prev_start")))
    back = Window.partitionBy("track").orderBy("at", F.col("event_id").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("track").orderBy(F.desc("at"), F.col("event_id").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumns({
        "prev": F.last(F.when(F.col("prev_end").isNotNull(), F.struct("prev_end", "prev_start")), ignorenulls=True).over(back),
        "next": F.last("next_start", ignorenulls=True).over(ahead),
    }).filter("event_id is not null")
    best = F.array_min(F.filter(F.array(
        F.when(F.col("prev").isNotNull(), F.struct((F.col("at") - F.col("prev.prev_end")).alias("distance"), F.col("prev.prev_start").alias("region"), F.lit("after").alias("side"))),
        F.when(F.col("next").isNotNull(), F.struct((F.col("next") - F.col("at")).alias("distance"), F.col("next").alias("region"), F.lit("before").alias("side"))),
    ), lambda x: x.isNotNull()))
    return found.withColumn("best", best).select("event_id", "track", "best.distance", "best.region", "best.side")


@query("dropped_words", DROPPED + " SELECT event_id, track, distance, region, side FROM near WHERE place = 1")
def dropped_words(spark, d):
    return dropped(spark, d)


@query("dropped_histogram", DROPPED + " SELECT track, side, distance, count(*) AS n, count(DISTINCT region) AS regions FROM near WHERE place = 1 GROUP BY 1, 2, 3")
def dropped_histogram(spark, d):
    return dropped(spark, d).groupBy("track", "side", "distance").agg(F.count("*").alias("n"), F.countDistinct("region").alias("regions"))


PEAKS = "peaks AS (SELECT event_id, event_type, epoch_us(ts) // 1000000 AS at, least(1000, floor(value / 490.0 * 1000 + 0.5))::INTEGER AS score FROM events)"


def peaks(spark, d, kind, prefix):
    own = spans(spark, d).filter(F.col("event_type") == kind)
    return own.select(F.col("event_id").alias(f"{prefix}_id"), F.expr("start div 1000").alias(f"{prefix}_at"), F.col("p").alias(f"{prefix}_score"))


@query("band_join_chirps", "WITH " + PEAKS + """, k1 AS (SELECT a.event_id AS anchor_id, b.event_id AS second_id, b.score, row_number() OVER (PARTITION BY a.event_id ORDER BY b.score DESC, abs(b.at - a.at - 600), b.event_id) AS place FROM peaks a JOIN peaks b ON a.event_type = 'view' AND b.event_type = 'click' AND abs(b.at - (a.at + 600)) <= 300),
k2 AS (SELECT a.event_id AS anchor_id, b.event_id AS third_id, b.score, row_number() OVER (PARTITION BY a.event_id ORDER BY b.score DESC, abs(b.at - a.at - 1200), b.event_id) AS place FROM peaks a JOIN peaks b ON a.event_type = 'view' AND b.event_type = 'purchase' AND abs(b.at - (a.at + 1200)) <= 300)
SELECT p.event_id AS anchor_id, second_id, third_id, least(p.score, k1.score, k2.score) AS score FROM peaks p JOIN k1 ON k1.anchor_id = p.event_id AND k1.place = 1 JOIN k2 ON k2.anchor_id = p.event_id AND k2.place = 1 WHERE p.event_type = 'view'""")
def band_join_chirps(spark, d):
    anchors = peaks(spark, d, "view", "anchor")

    def best(kind, prefix, offset):
        at = anchors.select((F.col("anchor_at") + offset).alias("expected"))
        near = I.band_best(at, peaks(spark, d, kind, "peak").toDF("id", "at", "score"), "expected", 300)
        return near.select((F.col("expected") - offset).alias("anchor_at"), F.col("best.id").alias(f"{prefix}_id"), F.col("best.score").alias(f"{prefix}_score"))

    joined = anchors.join(best("click", "second", 600), "anchor_at").join(best("purchase", "third", 1200), "anchor_at")
    return joined.select("anchor_id", "second_id", "third_id", F.least("anchor_score", "second_score", "third_score").alias("score"))


@query("associate", "WITH " + PEAKS + """, n AS (SELECT a.event_id AS anchor_id, count(b.event_id) AS near, min(b.event_id) AS one FROM peaks a LEFT JOIN peaks b ON b.event_type = 'error' AND abs(b.at - a.at) <= 120 WHERE a.event_type = 'signup' GROUP BY a.event_id),
c AS (SELECT *, count(*) FILTER (WHERE near = 1) OVER (PARTITION BY one) AS claims FROM n)
SELECT anchor_id, CASE WHEN near = 0 THEN 'missing' WHEN near > 1 OR claims > 1 THEN 'ambiguous' ELSE 'matched' END AS outcome, CASE WHEN near = 1 AND claims = 1 THEN one END AS match_id FROM c""")
def associate(spark, d):
    """Both anchors are ambiguous when they would claim the same peak."""
    near = I.band_join(peaks(spark, d, "signup", "anchor"), peaks(spark, d, "error", "peak"), "anchor_at", "peak_at", 120, how="left")
    n = near.groupBy("anchor_id").agg(F.count("peak_id").alias("near"), F.min("peak_id").alias("one"))
    claims = F.count(F.when(F.col("near") == 1, 1)).over(Window.partitionBy("one"))
    n = n.withColumn("claims", claims)
    outcome = F.when(F.col("near") == 0, "missing").when((F.col("near") > 1) | (F.col("claims") > 1), "ambiguous").otherwise("matched")
    return n.select("anchor_id", outcome.alias("outcome"), F.when((F.col("near") == 1) & (F.col("claims") == 1), F.col("one")).alias("match_id"))


@query("role_assignment", "WITH " + PEAKS + """, w AS (SELECT a.event_id AS event, b.event_id AS grp FROM peaks a JOIN peaks b ON a.event_type = 'signup' AND b.event_type = 'purchase' AND b.at >= a.at AND b.at < a.at + 900),
c AS (SELECT *, count(*) OVER (PARTITION BY event) AS n FROM w), s AS (SELECT *, count(*) OVER (PARTITION BY grp) AS m FROM c WHERE n = 1) SELECT event, grp FROM s WHERE m = 1""")
def role_assignment(spark, d):
    windows = peaks(spark, d, "signup", "e").select(F.col("e_id").alias("id"), F.col("e_at").alias("start"))
    found = I.counted_after(windows, peaks(spark, d, "purchase", "g").select(F.col("g_id").alias("id"), F.col("g_at").alias("at")), 900)
    single = found.filter("n = 1").select(F.col("id").alias("event"), F.col("one").alias("grp"))
    return single.groupBy("grp").agg(F.count("*").alias("m"), F.min("event").alias("event")).filter("m = 1").select("event", "grp")


# ---- ordered operators


@query("layout", """WITH c AS (SELECT l_orderkey, l_linenumber, date_diff('day', DATE '1995-01-01', l_shipdate::DATE) AS start, l_quantity::BIGINT AS n, l_partkey, l_suppkey FROM lineitem),
b AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY l_orderkey ORDER BY start, l_linenumber, l_partkey, l_suppkey, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS done FROM c),
p AS (SELECT *, done + max(start - done) OVER (PARTITION BY l_orderkey ORDER BY start, l_linenumber, l_partkey, l_suppkey, n ROWS UNBOUNDED PRECEDING) AS placed FROM b),
q AS (SELECT *, lag(placed + n) OVER (PARTITION BY l_orderkey ORDER BY start, l_linenumber, l_partkey, l_suppkey, n) AS behind FROM p)
SELECT l_orderkey, l_linenumber, placed, placed - start AS shift, coalesce(placed - behind, 0) AS gap, greatest(0, coalesce(behind - start, 0)) AS overlap FROM q""")
def layout(spark, d):
    c = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")).cast("long").alias("start"), F.col("l_quantity").cast("long").alias("n"), "l_partkey", "l_suppkey")
    return I.layout(c, ["l_orderkey"], ["start", "l_linenumber", "l_partkey", "l_suppkey", "n"], "start", "n").select("l_orderkey", "l_linenumber", "placed", "shift", "gap", "overlap")


@query("sequence_gaps", "SELECT o_custkey, o_orderkey, nxt - o_orderkey AS step FROM (SELECT *, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nxt FROM orders) WHERE nxt - o_orderkey > 1")
def sequence_gaps(spark, d):
    step = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - F.col("o_orderkey")
    return read(spark, d, "orders").select("o_custkey", "o_orderkey", step.alias("step")).filter("step > 1")


@query("rollover_gap", """WITH t AS (SELECT user_id, event_id, epoch_us(ts) // 1000000 % 86400 AS "at" FROM events),
g AS (SELECT *, lead("at") OVER (PARTITION BY user_id ORDER BY "at") - "at" AS gap, min("at") OVER (PARTITION BY user_id) + 86400 - max("at") OVER (PARTITION BY user_id) AS wrap FROM t),
w AS (SELECT *, max(gap) OVER (PARTITION BY user_id) AS widest FROM g), c AS (SELECT *, sum(CASE WHEN gap = widest THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS ties, max(CASE WHEN gap = widest THEN "at" END) OVER (PARTITION BY user_id) AS cut FROM w),
v AS (SELECT *, CASE WHEN widest IS NULL OR wrap > widest THEN 'none' WHEN wrap = widest OR ties > 1 THEN 'ambiguous' ELSE 'wrapped' END AS verdict FROM c)
SELECT user_id, event_id, "at", verdict, CASE WHEN verdict = 'wrapped' AND "at" <= cut THEN 1 ELSE 0 END AS turns FROM v""")
def rollover_gap(spark, d):
    t = read(spark, d, "events").select("user_id", "event_id", F.expr("unix_micros(cast(ts as timestamp)) div 1000000 % 86400").alias("at"))
    return I.widest_gap(t, ["user_id"], "at", 86400)


@query("rollover_gap_all", SQL["rollover_gap"])
def rollover_gap_all(spark, d):
    """Another name of rollover_gap, from when that one judged a fortieth of the events."""
    return rollover_gap(spark, d)


@query("session_zero", "SELECT user_id, min(epoch_us(ts)) AS zero, greatest(0, 1704070000000000 - min(epoch_us(ts))) AS shift FROM events GROUP BY user_id")
def session_zero(spark, d):
    us = F.expr("unix_micros(cast(ts as timestamp))")
    return read(spark, d, "events").groupBy("user_id").agg(F.min(us).alias("zero")).withColumn("shift", F.greatest(F.lit(0).cast("long"), F.lit(1704070000000000) - F.col("zero")))


@query("segment_id", "SELECT conv_id, turn, 'seg_' || lpad((row_number() OVER (ORDER BY conv_id, turn) - 1)::VARCHAR, 6, '0') AS segment_id FROM conversations")
def segment_id(spark, d):
    """Ranks without one sorted partition: counts of conversations before it, and the rank within."""
    c = read(spark, d, "conversations").select("conv_id", "turn")
    sizes = c.groupBy("conv_id").agg(F.count("*").alias("n"))
    ranges = sizes.withColumn("block", Q.floor_div(F.col("conv_id"), 1024))
    blocks = ranges.groupBy("block").agg(F.sum("n").alias("block_n"))
    blocks = blocks.withColumn("block_before", F.coalesce(F.sum("block_n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("block_n")
    inner = F.coalesce(F.sum("n").over(Window.partitionBy("block").orderBy("conv_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = ranges.withColumn("inner", inner).join(blocks, "block").select("conv_id", (F.col("inner") + F.col("block_before")).alias("before"))
    own = c.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1).join(before, "conv_id")
    return own.select("conv_id", "turn", F.concat(F.lit("seg_"), F.lpad((F.col("before") + F.col("place")).cast("string"), 6, "0")).alias("segment_id"))


# ---- statistics


def rank_sql(by, value, share, least):
    return f"""SELECT {by}, CASE WHEN n >= {least} THEN v END AS reference, n FROM (SELECT {by}, {value} AS v, row_number() OVER (PARTITION BY {by} ORDER BY {value}) - 1 AS i, count(*) OVER (PARTITION BY {by}) AS n FROM lineitem) WHERE i = round_even((n - 1) * {share}, 0)"""


@query("speech_reference", rank_sql("l_suppkey", "round(l_extendedprice * 100)::BIGINT", 0.75, 3))
def speech_reference(spark, d):
    cents = read(spark, d, "lineitem").select("l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("long").alias("v"))
    return I.nearest_rank(cents, ["l_suppkey"], "v", 0.75, "reference", 3)


@query("attributed_reference", f"""WITH a AS ({rank_sql("l_suppkey", "round(l_extendedprice * 100)::BIGINT", 0.75, 3)}), w AS ({rank_sql("l_suppkey", "round(l_extendedprice * 100)::BIGINT", 0.75, 1).replace("FROM lineitem)", "FROM lineitem WHERE l_returnflag = 'R')")})
SELECT a.l_suppkey, coalesce(w.reference, a.reference) AS reference, coalesce(w.n, 0) AS attributed FROM a LEFT JOIN w USING (l_suppkey)""")
def attributed_reference(spark, d):
    cents = read(spark, d, "lineitem").select("l_suppkey", "l_returnflag", F.round(F.col("l_extendedprice") * 100).cast("long").alias("v"))
    boot = I.nearest_rank(cents, ["l_suppkey"], "v", 0.75, "boot", 3).drop("n")
    won = I.nearest_rank(cents.filter("l_returnflag = 'R'"), ["l_suppkey"], "v", 0.75, "won", 1)
    return boot.join(won, "l_suppkey", "left").select("l_suppkey", F.coalesce("won", "boot").alias("reference"), F.coalesce("n", F.lit(0)).alias("attributed"))


@query("level_median", rank_sql("l_returnflag", "l_quantity::BIGINT", 0.5, 1))
def level_median(spark, d):
    return I.nearest_rank(read(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity").cast("long").alias("v")), ["l_returnflag"], "v", 0.5, "reference")


@query("duration", "WITH " + SPANS_SQL + ' SELECT track, max("end") AS duration FROM spans GROUP BY track')
def duration(spark, d):
    return spans(spark, d).groupBy("track").agg(F.max("end").alias("duration"))


# ---- timecode and quantizers

RATES_SQL = "rates(label, num, den, nominal, is_drop) AS (VALUES " + ", ".join(f"('{k}', {n}, {den}, {nom}, {str(drop).lower()})" for k, (n, den, nom, drop) in T.FRAME_RATES.items()) + ")"
CODES_SQL = RATES_SQL + """, codes AS (SELECT event_id, label, num, den, nominal, is_drop, strftime(ts, '%H:%M:%S') || CASE WHEN is_drop THEN ';' ELSE ':' END || lpad((event_id % 32)::VARCHAR, 2, '0') AS code FROM events, rates),
parsed AS (SELECT *, substr(code, 1, 2)::INTEGER AS h, substr(code, 4, 2)::INTEGER AS m, substr(code, 7, 2)::INTEGER AS s, substr(code, 10, 2)::INTEGER AS f FROM codes),
checked AS (SELECT *, CASE WHEN f >= nominal THEN 'out_of_range' WHEN is_drop AND s = 0 AND f < 2 AND m % 10 != 0 THEN 'dropped_frame' END AS error FROM parsed),
indexed AS (SELECT *, CASE WHEN error IS NULL THEN (h * 3600 + m * 60 + s) * nominal + f - CASE WHEN is_drop THEN nominal // 15 * (h * 60 + m - (h * 60 + m) // 10) ELSE 0 END END::BIGINT AS idx FROM checked)"""


def codes(spark, d):
    """Timecodes of all rates. What two generators make are columns: nothing above them repeats the texts' making or parsing.

    A row becomes eight, so rows are dealt evenly to all cores first.
    """
    e = read(spark, d, "events").select("event_id", F.date_format(F.col("ts").cast("timestamp"), "HH:mm:ss").alias("t")).repartition(spark.sparkContext.defaultParallelism)
    rates = F.array(*[F.struct(F.lit(k).alias("label"), T.frame_rate(F.lit(k)).alias("rate")) for k in T.FRAME_RATES])
    e = e.select("event_id", "t", F.explode(rates).alias("x")).select("event_id", "t", "x.label", "x.rate")
    e = e.withColumn("code", F.concat("t", F.when(F.col("rate.drop"), ";").otherwise(":"), F.lpad((F.col("event_id") % 32).cast("string"), 2, "0")))
    parsed = e.select("*", F.inline(F.array(T.parse(F.col("code"), F.col("rate")))))
    return parsed.withColumn("tc", F.struct("hours", "minutes", "seconds", "frames", "error")).drop("hours", "minutes", "seconds", "frames", "error")


@query("parse_timecode", "WITH " + CODES_SQL + " SELECT event_id, label, code, h AS hours, m AS minutes, s AS seconds, f AS frames, error FROM checked")
def parse_timecode(spark, d):
    return codes(spark, d).select("event_id", "label", "code", "tc.hours", "tc.minutes", "tc.seconds", "tc.frames", "tc.error")


@query("frame_index", "WITH " + CODES_SQL + " SELECT event_id, label, idx AS frame_index FROM indexed")
def frame_index(spark, d):
    return codes(spark, d).select("event_id", "label", T.frame_index(F.col("tc"), F.col("rate")).alias("frame_index"))


LABELS_SQL = RATES_SQL + ", labelled AS (SELECT event_id, [" + ", ".join(f"'{k}'" for k in T.FRAME_RATES) + f", 'unknown'][event_id % {len(T.FRAME_RATES) + 1} + 1] AS label FROM events)"


def labels(spark, d):
    """Every event with a label of a frame rate, of which one is unknown."""
    names = F.array(*map(F.lit, (*T.FRAME_RATES, "unknown")))
    e = read(spark, d, "events").select("event_id", F.get(names, (F.col("event_id") % (len(T.FRAME_RATES) + 1)).cast("int")).alias("label"))
    return e.withColumn("r", T.frame_rate(F.col("label")))


@query("frame_rate_lookup", "WITH " + LABELS_SQL + " SELECT event_id, label, num::BIGINT AS num, den::BIGINT AS den, nominal, coalesce(is_drop, false) AS is_drop, (nominal * 86400 - CASE WHEN is_drop THEN nominal // 15 * 1296 ELSE 0 END)::BIGINT AS per_day FROM labelled LEFT JOIN rates USING (label)")
def frame_rate_lookup(spark, d):
    return labels(spark, d).select("event_id", "label", "r.num", "r.den", "r.nominal", F.coalesce("r.drop", F.lit(False)).alias("is_drop"), F.when(F.col("r").isNotNull(), T.frames_per_day(F.col("r"))).alias("per_day"))


@query("session_position", "WITH " + CODES_SQL + " SELECT event_id, label, ((2 * idx::HUGEINT * den * 48000 + num) // (2 * num))::BIGINT AS position FROM indexed WHERE idx IS NOT NULL")
def session_position(spark, d):
    c = codes(spark, d).filter("tc.error is null").withColumn("idx", T.frame_index(F.col("tc"), F.col("rate")))
    return c.select("event_id", "label", Q.round_half_away(F.col("idx") * F.col("rate.den") * 48000, F.col("rate.num")).alias("position"))


@query("evidence_seconds", "WITH " + CODES_SQL + " SELECT event_id, label, (idx * den)::BIGINT AS num, num::BIGINT AS den FROM indexed WHERE idx IS NOT NULL")
def evidence_seconds(spark, d):
    c = codes(spark, d).withColumn("idx", T.frame_index(F.col("tc"), F.col("rate"))).filter("idx is not null")
    return c.select("event_id", "label", (F.col("idx") * F.col("rate.den")).alias("num"), F.col("rate.num").alias("den"))


@query("evidence_quantum", "WITH " + LABELS_SQL + " SELECT event_id, label, CASE WHEN (48000 * den) % num = 0 THEN 48000 * den // num ELSE 48000 * den // num + 1 END::BIGINT AS quantum FROM labelled LEFT JOIN rates USING (label)")
def evidence_quantum(spark, d):
    return labels(spark, d).select("event_id", "label", Q.ceil_div(F.col("r.den") * 48000, F.col("r.num")).alias("quantum"))


@query("to_ms", "SELECT l_orderkey, l_linenumber, CASE WHEN n < 0 THEN -((2 * -n + 48) // 96) ELSE (2 * n + 48) // 96 END AS ms FROM (SELECT l_orderkey, l_linenumber, round(l_extendedprice * 100)::BIGINT - 3000000 AS n FROM lineitem)")
def to_ms(spark, d):
    n = F.round(F.col("l_extendedprice") * 100).cast("long") - 3_000_000
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", Q.round_half_away(n, F.lit(48)).alias("ms"))


@query("grid_maps", 'WITH ' + SPANS_SQL + ' SELECT event_id, start // 3 AS d_start, ("end" + 2) // 3 AS d_end FROM spans')
def grid_maps(spark, d):
    return spans(spark, d).select("event_id", Q.floor_div(F.col("start"), 3).alias("d_start"), Q.ceil_div(F.col("end"), 3).alias("d_end"))


@query("frame_interval", 'WITH ' + SPANS_SQL + ' SELECT event_id, start // 512 AS first, ("end" + 511) // 512 AS last FROM spans')
def frame_interval(spark, d):
    return spans(spark, d).select("event_id", Q.floor_div(F.col("start"), 512).alias("first"), Q.ceil_div(F.col("end"), 512).alias("last"))


@query("permille", "SELECT l_orderkey, l_linenumber, least(1000, greatest(0, floor((l_extendedprice / 50000.0 - 0.1) * 1000 + 0.5)))::INTEGER AS p, CASE WHEN x >= 0 THEN floor(x + 0.5) ELSE -floor(-x + 0.5) END::INTEGER AS signed_p FROM (SELECT *, (l_extendedprice / 50000.0 - 0.5) * 1000 AS x FROM lineitem)")
def permille(spark, d):
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", Q.to_permille((F.col("l_extendedprice") / 50000.0 - 0.1) * 1000).alias("p"), Q.signed_permille(F.col("l_extendedprice") / 50000.0 - 0.5).alias("signed_p"))


@query("rms_millibels", "SELECT l_orderkey, greatest(-12000, round(1000 * log10(avg((l_discount - 0.05) * (l_discount - 0.05)) + 1e-9)))::INTEGER AS mb FROM lineitem GROUP BY l_orderkey")
def rms_millibels(spark, d):
    x = F.col("l_discount") - 0.05
    return read(spark, d, "lineitem").groupBy("l_orderkey").agg(Q.millibels(F.avg(x * x) + 1e-9).alias("mb"))


@query("db_gain", "SELECT p_partkey, round(pow(10.0, (p_size * 10 - 250) / 2000.0), 6) AS gain FROM part")
def db_gain(spark, d):
    return read(spark, d, "part").select("p_partkey", F.round(Q.gain_of_millibels(F.col("p_size") * 10 - 250), 6).alias("gain"))


@query("quantum_floor", "SELECT l_suppkey, coalesce(max(l_quantity) FILTER (WHERE l_returnflag = 'R'), 1)::BIGINT AS quantum FROM lineitem GROUP BY l_suppkey")
def quantum_floor(spark, d):
    rows = read(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_quantity")
    return R.quantum(rows, "l_suppkey", F.col("l_returnflag") != "R", "l_quantity")


@query("centred_window", 'WITH ' + SPANS_SQL + ' SELECT event_id, start + ("end" - start - least("end" - start, 2000)) // 2 AS start, least("end" - start, 2000) AS n FROM spans')
def centred_window(spark, d):
    n = F.least(F.col("end") - F.col("start"), F.lit(2000))
    return spans(spark, d).select("event_id", (F.col("start") + Q.floor_div(F.col("end") - F.col("start") - n, 2)).alias("start"), n.alias("n"))


@query("bounded_windows", "WITH " + SPANS_SQL + " SELECT track, start // 3600000 AS window_idx, count(*) AS n, sum(p)::BIGINT AS p FROM spans GROUP BY 1, 2")
def bounded_windows(spark, d):
    return spans(spark, d).groupBy("track", Q.floor_div(F.col("start"), 3_600_000).alias("window_idx")).agg(F.count("*").alias("n"), F.sum("p").alias("p"))
