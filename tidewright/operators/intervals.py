"""Interval algebra: islands, hysteresis, range joins, nearest-rank statistics.

Intervals are half-open and integer. Ordered operators are window functions over one entity's rows; range
joins are equi-joins on buckets, so that no plan holds a nested loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.quantize import floor_div
from tidewright.sources.shared import durable


def _prior(by: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def islands(df: DataFrame, by: Sequence[str], start: str, end: str, gap: int = 0, strict: bool = False, aggs: Sequence[Column] = ()) -> DataFrame:
    """Merges an entity's intervals whose distance is at most gap (strict: less than gap).

    gap 0 merges those that overlap or touch. aggs are aggregates over an island's rows.
    """
    reach = F.max(end).over(_prior(by, (start, end)))
    apart = (F.col(start) - reach >= gap) if strict else (F.col(start) - reach > gap)
    upto = Window.partitionBy(*by).orderBy(start, end).rowsBetween(Window.unboundedPreceding, 0)
    fresh = df.withColumn("_new", F.when(reach.isNull() | apart, 1).otherwise(0))
    return fresh.withColumn("_island", F.sum("_new").over(upto)).groupBy(*by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), *aggs).drop("_island")


def island_starts(df: DataFrame, start: str, end: str, block: int, gap: int = 0) -> DataFrame:
    """Adds island: the start of the island (as islands() makes them) that a row is in, over one time line without an entity to part it by.

    Rows are ordered within blocks of the time line; what reaches from earlier blocks comes from one row for each block.
    """
    own = df.withColumn("_block", floor_div(F.col(start), block))
    w = Window.partitionBy("_block").orderBy(start, end)
    ends = own.groupBy("_block").agg(F.max(end).alias("_last"))
    reach = F.max("_last").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    own = own.join(ends.select("_block", reach.alias("_reach")), "_block")
    before = F.greatest(F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("_reach"))
    own = own.withColumn("_new", F.when(before.isNull() | (F.col(start) - before > gap), F.col(start)))
    news = own.groupBy("_block").agg(F.max("_new").alias("_newest"))
    carried = F.last("_newest", ignorenulls=True).over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    own = own.join(news.select("_block", carried.alias("_open")), "_block")
    # with its equals: rows of the same start and end may come in another order than above
    island = F.coalesce(F.max("_new").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)), F.col("_open"))
    return own.withColumn("island", island).drop("_block", "_reach", "_new", "_open")


def hysteresis(frames: DataFrame, by: Sequence[str], frame: str, p: str, opens: int, closes: int) -> DataFrame:
    """Adds active: opened at p >= opens, closed at p < closes, else as before; closed at the beginning."""
    state = F.when(F.col(p) >= opens, 1).when(F.col(p) < closes, 0)
    upto = Window.partitionBy(*by).orderBy(frame).rowsBetween(Window.unboundedPreceding, 0)
    return frames.withColumn("active", F.coalesce(F.last(state, ignorenulls=True).over(upto), F.lit(0)) == 1)


def active_runs(frames: DataFrame, by: Sequence[str], frame: str) -> DataFrame:
    """Half-open frame intervals of consecutive active frames."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(frame))
    runs = frames.filter("active").withColumn("_run", F.col(frame) - place)
    return runs.groupBy(*by, "_run").agg(F.min(frame).alias("start"), (F.max(frame) + 1).alias("end")).drop("_run")


def assemble_regions(frames: DataFrame, by: Sequence[str], frame: str, p: str, opens: int, closes: int, min_silence: int, min_frames: int, merge_gap: int, pad: int, limit: Column | None = None) -> DataFrame:
    """Speech regions of frame probabilities, in frames.

    Runs with less than min_silence between them are one; shorter than min_frames they go; those with less than
    merge_gap between them are one; they are padded, held within 0 and limit, and merged where they touch.
    """
    runs = active_runs(hysteresis(frames, by, frame, p, opens, closes), by, frame)
    runs = islands(runs, by, "start", "end", min_silence, strict=True).filter(F.col("end") - F.col("start") >= min_frames)
    runs = islands(runs, by, "start", "end", merge_gap, strict=True)
    end = F.col("end") + pad if limit is None else F.least(F.col("end") + pad, limit)
    padded = runs.withColumns({"start": F.greatest(F.lit(0).cast("long"), F.col("start") - pad), "end": end})
    return islands(padded.filter("end > start"), by, "start", "end")


def _buckets(start: Column, end: Column, width: int) -> Column:
    return F.explode(F.sequence(floor_div(start, width), floor_div(end - 1, width)))


def overlap_join(left: DataFrame, right: DataFrame, width: int, equal: Sequence[str] = (), on: Column | None = None) -> DataFrame:
    """Pairs of intervals that share a point. Both sides have start and end; results are l and r structs.

    An interval is one row for each bucket of width that it touches; a pair is kept in the bucket in which the
    later of them starts, so it comes once. width should be near the usual length: a row is copied length / width
    times. on is a further condition on l and r.
    """
    side = lambda df, n: df.select(F.struct("*").alias(n), *[F.col(c).alias(f"{n}_{c}") for c in equal], _buckets(F.col("start"), F.col("end"), width).alias(f"{n}_bucket"))
    cond = F.col("l_bucket") == F.col("r_bucket")
    for c in equal:
        cond &= F.col(f"l_{c}") == F.col(f"r_{c}")
    cond &= (F.col("l.start") < F.col("r.end")) & (F.col("r.start") < F.col("l.end")) & (F.col("l_bucket") == floor_div(F.greatest("l.start", "r.start"), width))
    if on is not None:
        cond &= on
    return side(left, "l").join(side(right, "r"), cond).select("l", "r")


def overlap_within(rows: DataFrame, width: int, order: Sequence[str], on: Column) -> DataFrame:
    """overlap_join() of a table with itself, for results that are many: rows are dealt to the buckets once, in order, and written there; pairs are made where they lie.

    In each bucket the pairs of one l follow each other, in the order of r; l's that are alike follow each other too. So columns of the result hold long runs and
    repeats, which column formats store in little. on is the further condition on l and r.
    """
    held = rows.select(F.struct("*").alias("x"), _buckets(F.col("start"), F.col("end"), width).alias("bucket"))
    dealt = durable(held.repartition("bucket").sortWithinPartitions("bucket", *[f"x.{c}" for c in order]))
    side = lambda n: dealt.select(F.col("x").alias(n), F.col("bucket").alias(f"{n}_bucket"))
    cond = (F.col("l_bucket") == F.col("r_bucket")) & (F.col("l.start") < F.col("r.end")) & (F.col("r.start") < F.col("l.end")) & (F.col("l_bucket") == floor_div(F.greatest("l.start", "r.start"), width))
    return side("l").join(side("r"), cond & on).select("l", "r")


def point_join(points: DataFrame, intervals: DataFrame, at: str, width: int, equal: Sequence[str] = (), how: str = "inner") -> DataFrame:
    """Points within intervals: the points' columns and the interval as struct r. how: inner, left, left_semi or left_anti."""
    left = points.withColumn("_bucket", floor_div(F.col(at), width))
    right = intervals.select(F.struct("*").alias("r"), *[F.col(c).alias(f"_r_{c}") for c in equal], _buckets(F.col("start"), F.col("end"), width).alias("_r_bucket"))
    cond = F.col("_bucket") == F.col("_r_bucket")
    for c in equal:
        cond &= F.col(c) == F.col(f"_r_{c}")
    cond &= (F.col(at) >= F.col("r.start")) & (F.col(at) < F.col("r.end"))
    joined = left.join(right, cond, how)
    return joined.drop("_bucket", "_r_bucket", *[f"_r_{c}" for c in equal])


def band_join(left: DataFrame, right: DataFrame, left_at: str, right_at: str, tolerance: int, equal: Sequence[tuple[str, str]] = (), how: str = "inner") -> DataFrame:
    """Rows whose positions differ by at most tolerance. Column names of the sides must differ."""
    width = 2 * tolerance + 1
    near = F.array_distinct(F.array(floor_div(F.col(right_at) - tolerance, width), floor_div(F.col(right_at) + tolerance, width)))
    a, b = left.withColumn("_a", floor_div(F.col(left_at), width)), right.withColumn("_b", F.explode(near))
    cond = (F.col("_a") == F.col("_b")) & (F.abs(F.col(left_at) - F.col(right_at)) <= tolerance)
    for x, y in equal:
        cond &= F.col(x) == F.col(y)
    return a.join(b, cond, how).drop("_a", "_b")


def band_best(queries: DataFrame, points: DataFrame, at: str, tolerance: int) -> DataFrame:
    """(at, best): for each distinct position of queries the point (at, id, score) within tolerance with the greatest score, then the nearest, then of least id.

    No pair is made: the time line is cut into blocks of tolerance + 1, so that either side of a position is the end of one block and the
    beginning of the next. The best from a block's beginning, and to its end, run along its rows. best is a struct of score, id.
    """
    width = tolerance + 1
    one = points.filter(F.col("at").isNotNull()).groupBy("at").agg(F.max(F.struct("score", (-F.col("id")).alias("neg"))).alias("k")).select("at", "k.score", "k.neg")
    q = queries.select(F.col(at).alias("q")).filter("q is not null").distinct()
    edges = F.explode(F.array(*[F.struct(F.lit(n).alias("edge"), (F.col("q") + d).alias("at")) for n, d in (("a", -tolerance), ("b", 0), ("c", tolerance))])).alias("e")
    rows = one.select("at", "score", "neg").unionByName(q.select("q", edges).select("q", "e.edge", "e.at"), allowMissingColumns=True).withColumn("_block", floor_div(F.col("at"), width))
    before, after = F.when(F.col("q").isNull(), F.struct("score", "at", "neg")), F.when(F.col("q").isNull(), F.struct("score", (-F.col("at")).alias("at"), "neg"))
    up = Window.partitionBy("_block").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy("_block").orderBy(F.col("at").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    near = {"up_before": F.max(before).over(up), "up_after": F.max(after).over(up), "down_before": F.max(before).over(down), "down_after": F.max(after).over(down)}
    found = rows.withColumns(near).filter("q is not null")
    key = lambda c, d: F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.score").alias("score"), d.alias("d"), F.col(f"{c}.neg").alias("neg")))
    left, right = lambda c: key(c, F.col(f"{c}.at") - F.col("q")), lambda c: key(c, F.col(f"{c}.at") + F.col("q"))
    here = F.when(F.col("edge") == "a", left("down_before")).when(F.col("edge") == "c", right("up_after")).otherwise(F.greatest(left("up_before"), right("down_after")))
    return found.groupBy(F.col("q").alias(at)).agg(F.max(here).alias("k")).filter("k is not null").select(at, F.struct(F.col("k.score").alias("score"), (-F.col("k.neg")).alias("id")).alias("best"))


def counted_after(windows: DataFrame, points: DataFrame, length: int) -> DataFrame:
    """(id, n, one): how many points (at, id) stand within length from the start of each window (id, start) on, and the least of their ids; windows without any have no row.

    No pair is made: on a time line cut into blocks of length, a window is the end of one block and the beginning of the next.
    """
    edges = F.explode(F.array(F.struct(F.lit("a").alias("edge"), F.col("start").alias("at")), F.struct(F.lit("b").alias("edge"), (F.col("start") + length).alias("at")))).alias("e")
    asked = windows.filter(F.col("start").isNotNull()).select(F.col("id").alias("q"), edges).select("q", "e.edge", "e.at")
    own = points.filter(F.col("at").isNotNull()).select("at", F.col("id").alias("point"))
    rows = own.unionByName(asked, allowMissingColumns=True).withColumn("_block", floor_div(F.col("at"), length))
    up = Window.partitionBy("_block").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("_block").orderBy((-F.col("at"))).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    pick = lambda f: F.when(F.col("edge") == "a", F.col(f"{f}_down")).otherwise(F.col(f"{f}_up"))
    found = rows.withColumns({"n_up": F.count("point").over(up), "p_up": F.min("point").over(up), "n_down": F.count("point").over(down), "p_down": F.min("point").over(down)}).filter("edge is not null")
    return found.groupBy(F.col("q").alias("id")).agg(F.sum(pick("n")).alias("n"), F.min(pick("p")).alias("one")).filter("n > 0")


def nearest_rank(df: DataFrame, by: Sequence[str], value: str, share: float, name: str, least: int = 1) -> DataFrame:
    """The element at rint((n - 1) * share) of each group's sorted values (ties of the rank to even); null under `least` values.

    Equal values are counted first, so that a group is sorted by its distinct values only.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*by).orderBy(value)
    total = F.sum("_n").over(Window.partitionBy(*by))
    placed = counted.withColumn("_upto", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_total", total)
    rank = F.rint((F.col("_total") - 1) * share)
    hit = placed.filter((rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("_n")))
    return hit.select(*by, F.when(F.col("_total") >= least, F.col(value)).alias(name), F.col("_total").alias("n"))


def span_coverage(spans: DataFrame, by: Sequence[str], size: int) -> DataFrame:
    """(by, frame, p): permille of each frame of `size` samples, from spans with start, end and probability."""
    touched = spans.withColumn("frame", _buckets(F.col("start"), F.col("end"), size))
    shared = F.least("end", (F.col("frame") + 1) * size) - F.greatest("start", F.col("frame") * size)
    summed = touched.withColumn("_w", F.col("probability") * shared).groupBy(*by, "frame").agg(F.sum("_w").alias("_w"))
    return summed.select(*by, "frame", F.least(F.lit(1000), F.floor(F.col("_w") / size + 0.5)).cast("int").alias("p"))


def layout(chunks: DataFrame, by: Sequence[str], order: Sequence[str], start: str, length: str) -> DataFrame:
    """Places an entity's chunks one behind another without overlap: placed, shift, gap, overlap.

    The place of chunk i is the sum of the lengths before it and the most, over chunks up to i, of start less the lengths
    before that chunk: two windows, no recursion. gap is the silence before the chunk, overlap what it was shifted by
    the chunk before.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    before = F.coalesce(F.sum(length).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    df = chunks.withColumn("_before", before)
    df = df.withColumn("placed", F.col("_before") + F.max(F.col(start) - F.col("_before")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    behind = F.lag(F.col("placed") + F.col(length)).over(w)
    return df.withColumns({"shift": F.col("placed") - F.col(start), "gap": F.coalesce(F.col("placed") - behind, F.lit(0)), "overlap": F.greatest(F.lit(0), F.coalesce(behind - F.col(start), F.lit(0)))}).drop("_before")


def widest_gap(points: DataFrame, by: Sequence[str], at: str, cycle: int) -> DataFrame:
    """On a circle of length cycle: how many turns each point gains when it is cut in its widest gap.

    verdict: none (the gap across the origin is widest), wrapped, or ambiguous (a tie for the widest).
    Adds turns: 1 for points up to the cut of a wrapped group, else 0.
    """
    w = Window.partitionBy(*by).orderBy(at)
    whole = Window.partitionBy(*by)
    df = points.withColumn("_gap", F.lead(at).over(w) - F.col(at))
    df = df.withColumn("_wrap", F.min(at).over(whole) + cycle - F.max(at).over(whole)).withColumn("_widest", F.max("_gap").over(whole))
    df = df.withColumn("_ties", F.sum(F.when(F.col("_gap") == F.col("_widest"), 1).otherwise(0)).over(whole))
    verdict = F.when(F.col("_widest").isNull() | (F.col("_wrap") > F.col("_widest")), "none").when((F.col("_wrap") == F.col("_widest")) | (F.col("_ties") > 1), "ambiguous").otherwise("wrapped")
    df = df.withColumn("verdict", verdict)
    cut = F.max(F.when(F.col("_gap") == F.col("_widest"), F.col(at))).over(whole)
    return df.withColumn("turns", F.when((F.col("verdict") == "wrapped") & (F.col(at) <= cut), 1).otherwise(0)).drop("_gap", "_wrap", "_widest", "_ties")
