"""What markers found on a session's tracks say: groups by a reference track, roles from a log, arrivals and timecode compared.

Tables are by session. found: session, track, anchor, score, ambiguous, clipped, weak. Nothing is resolved that isn't decided by the data: what
two events, or two occurrences, could claim is told of and left open.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators import intervals as I

RATE = 48_000
TASKS = 256  # that sessions are dealt to; where Spark would make fewer, larger ones, a task's memory grows with the tables
MEMBERS = "session string, anchor long, track string, outcome string, at long, lag long, score int"


def usable() -> Column:
    return ~F.col("ambiguous") & ~F.col("clipped") & ~F.col("weak")


def reference_tracks(found: DataFrame, configured: DataFrame | None = None) -> DataFrame:
    """session, track: the configured one, else the one with the most usable occurrences, then the least name. A policy, no inference about who was near."""
    n = found.groupBy("session", "track").agg(F.sum(usable().cast("long")).alias("n"))
    best = n.groupBy("session").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("track").alias("track"))).alias("b")).select("session", F.col("b.track").alias("track"))
    if configured is None:
        return best
    return best.join(configured.select("session", F.col("track").alias("_own")), "session", "left").select("session", F.coalesce("_own", "track").alias("track"))


def members(found: DataFrame, tracks: DataFrame, references: DataFrame, tolerance: int) -> DataFrame:
    """MEMBERS of the group of each usable occurrence (anchor) of the reference track: one row for each of the session's tracks.

    outcome: detected, weak, clipped, ambiguous (also where two occurrences are near), missing. Groups claim in the order of time, and an occurrence
    serves one group only. lag is only that of a clean detection. A track's occurrences near groups are few: they are taken in order in one task.
    """
    own = references.withColumnRenamed("track", "_reference")
    anchors = found.join(own, "session").filter((F.col("track") == F.col("_reference")) & usable()).select("session", "anchor", F.col("score").alias("own_score"), "_reference")
    every = anchors.join(tracks.select("session", "track"), "session")
    mine = every.filter(F.col("track") == F.col("_reference")).select("session", "anchor", "track", F.lit("detected").alias("outcome"), F.col("anchor").alias("at"), F.lit(0).cast("long").alias("lag"), F.col("own_score").cast("int").alias("score"))
    others = every.filter(F.col("track") != F.col("_reference")).select("session", "anchor", "track")
    heard = found.select(F.col("session").alias("_session"), F.col("track").alias("_track"), F.col("anchor").alias("at"), "score", "ambiguous", "clipped", "weak")
    near = I.band_join(others, heard, "anchor", "at", tolerance, [("session", "_session"), ("track", "_track")], how="left")

    def claim(rows: pd.DataFrame) -> pd.DataFrame:
        used: set[int] = set()
        out = []
        for anchor, own_rows in rows.sort_values(["anchor", "at"]).groupby("anchor", sort=True):
            free = own_rows[own_rows["at"].notna() & ~own_rows["at"].isin(used)]
            key = (rows["session"].iloc[0], int(anchor), rows["track"].iloc[0])
            if len(free) != 1:
                out.append((*key, "missing" if free.empty else "ambiguous", None, None, None))
                continue
            r = free.iloc[0]
            used.add(r["at"])
            outcome = "ambiguous" if r["ambiguous"] else "clipped" if r["clipped"] else "weak" if r["weak"] else "detected"
            out.append((*key, outcome, int(r["at"]), int(r["at"]) - int(anchor) if outcome == "detected" else None, int(r["score"])))
        frame = pd.DataFrame(out, columns=["session", "anchor", "track", "outcome", "at", "lag", "score"])
        return frame.astype({"at": "Int64", "lag": "Int64", "score": "Int32"})

    return mine.unionByName(near.groupBy("session", "track").applyInPandas(claim, MEMBERS))


def roles(groups: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(session, anchor, role, geometry of each group; notes: session, code, at): groups and logged events are matched one to one.

    events: session, role, start, end (samples, half-open), geometry. An event that holds no group, or several, names none; a group that several
    events hold alone stays unassigned. Scores have no say.
    """
    own = events.withColumn("_e", F.struct("start", "end", "role", F.coalesce("geometry", F.lit("")).alias("geometry")))
    own = own.filter(F.col("session").isNotNull() & F.col("start").isNotNull() & F.col("end").isNotNull())
    edges = F.explode(F.array(F.struct(F.lit(1).alias("sign"), F.col("start").alias("at")), F.struct(F.lit(-1).alias("sign"), F.col("end").alias("at")))).alias("edge")
    asked = own.select("session", "_e", "geometry", edges).select("session", "_e", "geometry", "edge.sign", "edge.at")
    placed = groups.select("session", "anchor").distinct().withColumn("at", F.col("anchor")).unionByName(asked, allowMissingColumns=True).repartition(TASKS, "session")
    # groups from each edge on, in order: no event meets each group of its session
    on = Window.partitionBy("session").orderBy(F.col("at").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = placed.withColumns({"_n": F.count("anchor").over(on), "_first": F.min("anchor").over(on)}).filter("sign is not null")
    held = counted.groupBy("session", "_e", "geometry").agg(F.sum(F.col("sign") * F.col("_n")).alias("n"), F.min(F.when(F.col("sign") == 1, F.col("_first"))).alias("anchor"))
    void = events.filter(F.col("session").isNull() | F.col("start").isNull() | F.col("end").isNull()).select("session", F.col("role"), "geometry", "start", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("anchor"))
    held = held.select("session", F.col("_e.role").alias("role"), "geometry", F.col("_e.start").alias("start"), F.greatest(F.col("n"), F.lit(0)).alias("n"), "anchor").unionByName(void)
    alone = held.filter("n = 1").withColumn("claims", F.count("*").over(Window.partitionBy("session", "anchor")))
    told = alone.filter("claims = 1").select("session", "anchor", "role", "geometry")
    code = F.when(F.col("n") == 0, "marker_event_without_occurrence").otherwise("marker_event_ambiguous")
    notes = held.filter("n != 1").select("session", code.alias("code"), F.col("start").alias("at"))
    notes = notes.unionByName(alone.filter("claims > 1").select("session", F.lit("marker_event_overlap").alias("code"), F.col("anchor").alias("at")).distinct())
    return groups.select("session", "anchor").distinct().join(told, ["session", "anchor"], "left"), notes


def default_roles(groups: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """roles() without a log: a start and an end are named only where each of the session's windows (session, opens, closes) holds exactly one group, and not the same one.

    opens: the end of the opening window; closes: the start of the closing one.
    """
    own = groups.select("session", "anchor").distinct().join(windows, "session")
    first, last = F.col("anchor") < F.col("opens"), F.col("anchor") >= F.col("closes")
    per = own.groupBy("session").agg(F.count("*").alias("n"), F.sum(first.cast("long")).alias("a"), F.sum(last.cast("long")).alias("b"), F.min(F.when(first, F.col("anchor"))).alias("_start"), F.min(F.when(last, F.col("anchor"))).alias("_end"))
    clear = (F.col("a") == 1) & (F.col("b") == 1) & (F.col("_start") != F.col("_end"))
    named = groups.select("session", "anchor").distinct().join(per.withColumn("_clear", clear), "session", "left")
    role = F.when(F.col("_clear") & (F.col("anchor") == F.col("_start")), "start").when(F.col("_clear") & (F.col("anchor") == F.col("_end")), "end")
    notes = per.filter(~F.coalesce(clear, F.lit(False)) & (F.col("n") > 0)).select("session", F.lit("marker_roles_unassigned").alias("code"), F.col("n").alias("at"))
    return named.select("session", "anchor", role.alias("role"), F.lit(None).cast("string").alias("geometry")), notes


def arrivals(group_members: DataFrame, named: DataFrame, material: int) -> tuple[DataFrame, DataFrame]:
    """(session, track, start_lag, end_lag, change, outcome; notes): what changed between the one start and the one end of a session.

    outcome: clock_drift_evidence where both ends carry the same geometry, which someone asserted; else differential_arrival; inconclusive where an end
    has no clean detection. Sessions with another number of starts or ends have no rows and a note.
    """
    n = named.filter("role in ('start', 'end')").groupBy("session").agg(
        F.sum((F.col("role") == "start").cast("long")).alias("a"), F.sum((F.col("role") == "end").cast("long")).alias("b"),
        F.min(F.when(F.col("role") == "start", F.struct("anchor", "geometry"))).alias("s"), F.min(F.when(F.col("role") == "end", F.struct("anchor", "geometry"))).alias("e"),
    )
    pair = n.filter("a = 1 and b = 1")
    lag = lambda at, name: group_members.join(pair.select("session", F.col(f"{at}.anchor").alias("anchor")), ["session", "anchor"]).select("session", "track", F.col("lag").alias(name))
    both = lag("e", "end_lag").join(lag("s", "start_lag"), ["session", "track"], "left").join(pair.select("session", F.coalesce(F.col("s.geometry") == F.col("e.geometry"), F.lit(False)).alias("fixed")), "session")
    change = F.col("end_lag") - F.col("start_lag")
    outcome = F.when(change.isNull(), "inconclusive").when(F.col("fixed"), "clock_drift_evidence").otherwise("differential_arrival")
    rows = both.select("session", "track", "start_lag", "end_lag", change.alias("change"), outcome.alias("outcome"))
    notes = n.filter("not (a = 1 and b = 1)").select("session", F.lit("marker_arrival_pair_ambiguous").alias("code"), (F.col("a") * 1000 + F.col("b")).alias("at"))
    drift = rows.filter((F.col("outcome") == "clock_drift_evidence") & (F.abs("change") >= material)).groupBy("session").agg(F.max(F.abs("change")).alias("at"))
    return rows, notes.unionByName(drift.select("session", F.lit("marker_material_clock_drift").alias("code"), "at"))


def timecode(group_members: DataFrame, named: DataFrame, floors: DataFrame) -> DataFrame:
    """session, track, lag, floor, beyond: the lags of the first group without the role end, against what the session's evidence (floors: session, floor) can tell apart.

    The time line has placed every track by its own evidence, so that any lag is the disagreement.
    """
    first = named.filter(F.col("role").isNull() | (F.col("role") == "start")).groupBy("session").agg(F.min("anchor").alias("anchor"))
    rows = group_members.join(first, ["session", "anchor"]).filter("lag is not null").join(floors, "session")
    return rows.select("session", "track", "lag", "floor", (F.abs("lag") > F.col("floor")).alias("beyond"))
