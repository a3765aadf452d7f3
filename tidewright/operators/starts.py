"""Where recordings begin: start-time strategies, the origin of a session, the layout of a track's chunks.

Times are exact: whole flicks, of which a second has 705,600,000, so that samples at the usual rates and frames at every rate of
functions.timecode are whole numbers of them. A position is rounded once, at the end. Each step takes the
sources of any number of sessions; a refusal is a code in a session's rows, beside which the others go on.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions import quantize as Q
from tidewright.functions import timecode as C
from tidewright.operators import intervals as I

FLICK = 705_600_000
RATE = 48_000
DAY = 86_400 * FLICK
#: Sessions longer than this many seconds are warned of.
PLAUSIBLE = 12 * 3600
#: In the order in which they are asked. Fixed names.
STRATEGIES = ("recovery_override_offset", "recovery_override_timecode", "bwf_time_reference", "timecode_tag")
_EVIDENCE = "struct<kind:string,count:bigint,flicks:bigint,day:bigint,quantum:bigint>"


def _evidence(kind: str, count: Column, flicks: Column, day: Column, quantum: Column) -> Column:
    """kind, count (in its own units), flicks since its own origin, the length of its day, its resolution in samples."""
    return F.struct(F.lit(kind).alias("kind"), count.cast("long").alias("count"), flicks.cast("long").alias("flicks"), day.cast("long").alias("day"), quantum.cast("long").alias("quantum"))


def _attempt(reason: Column, evidence: Column) -> Column:
    """An answer, or why there is none: the reason decides."""
    return F.struct(F.when(reason.isNull(), evidence).otherwise(F.lit(None).cast(_EVIDENCE)).alias("evidence"), reason.alias("declined"))


def _timecode(text: Column, rate: Column, missing: Column) -> Column:
    code = C.parse(text, rate)
    frames = C.frame_index(code, rate)
    frame = rate["den"] * Q.floor_div(F.lit(FLICK), rate["num"])
    reason = F.coalesce(missing, F.when(rate.isNull(), "unknown_frame_rate"), code["error"])
    return _attempt(reason, _evidence("timecode", frames, frames * frame, C.frames_per_day(rate) * frame, Q.ceil_div(F.lit(RATE) * rate["den"], rate["num"])))


def start_times(sources: DataFrame, frame_rate: Column, bwf_quantum: Column) -> DataFrame:
    """Adds start (kind, count, flicks, day, quantum), strategy, declined, asserted, override_reason, refusal to sources.

    sources: sha256, rate, time_reference, timecode, date (tags as texts; null where a file has none), and of its override, if it has
    one: override_sha256, recording_date, start_timecode, start_offset, reason, overridden (whether there is one). No name and no time of a
    file is looked at. A strategy answers, or declines with a reason; the first answer counts, those asked before it are kept in declined (name, reason).

    An override written for other bytes is refused before anything is asked (override_hash_mismatch); a source that no strategy
    answers for has no start (no_start_time). A date is asserted only by an override that supplied the start.
    """
    c = {n: F.col(n) for n in ("sha256", "rate", "time_reference", "timecode", "override_sha256", "recording_date", "start_timecode", "start_offset", "reason")}
    overridden = F.coalesce(F.col("overridden"), F.lit(False))
    rate = C.frame_rate(frame_rate)
    nobody = F.when(~overridden, "no_override")
    number = F.trim(c["time_reference"])
    samples = F.when(number.rlike(r"^[+-]?[0-9]+$"), number.try_cast("long"))
    flicks = Q.floor_div(F.lit(FLICK), c["rate"])
    attempts = {
        "recovery_override_offset": _attempt(F.coalesce(nobody, F.when(c["start_offset"].isNull(), "no_start_offset")), _evidence("offset", c["start_offset"], c["start_offset"] * (FLICK // RATE), F.lit(None), F.lit(1))),
        "recovery_override_timecode": _timecode(c["start_timecode"], rate, F.coalesce(nobody, F.when(c["start_timecode"].isNull(), "no_start_timecode"))),
        "bwf_time_reference": _attempt(
            F.when(c["time_reference"].isNull(), "no_tag").when(samples.isNull(), "not_an_integer").when(samples < 0, "negative").when(c["rate"].isNull() | (c["rate"] <= 0), "no_rate").when(F.pmod(F.lit(FLICK), F.when(c["rate"] > 0, c["rate"])) != 0, "rate_not_exact"),
            _evidence("reference", samples, samples * flicks, F.lit(DAY), Q.ceil_div(bwf_quantum.cast("long") * RATE, c["rate"])),
        ),
        "timecode_tag": _timecode(c["timecode"], rate, F.when(c["timecode"].isNull(), "no_tag")),
    }
    named = F.array(*[F.struct(F.lit(n).alias("name"), attempts[n]["evidence"].alias("evidence"), attempts[n]["declined"].alias("reason")) for n in STRATEGIES])
    out = sources.withColumn("_asked", named)
    out = out.withColumn("_first", F.get(F.filter("_asked", lambda a: a["evidence"].isNotNull()), 0))
    place = F.coalesce(F.array_position(F.transform("_asked", lambda a: a["name"]), F.col("_first.name")), F.lit(len(STRATEGIES) + 1)).cast("int") - 1
    wrong = overridden & c["override_sha256"].isNotNull() & ~c["override_sha256"].eqNullSafe(c["sha256"])
    refusal = F.when(wrong, "override_hash_mismatch").when(F.col("_first").isNull(), "no_start_time")
    ours = F.col("strategy").startswith("recovery_")
    declined = F.transform(F.slice("_asked", F.lit(1), place), lambda a: F.struct(a["name"].alias("name"), a["reason"].alias("reason")))
    out = out.withColumns({"start": F.when(~wrong, F.col("_first.evidence")), "strategy": F.when(~wrong, F.col("_first.name")), "declined": F.when(wrong, F.array().cast("array<struct<name:string,reason:string>>")).otherwise(declined), "refusal": refusal})
    return out.withColumns({"asserted": F.when(ours, c["recording_date"]), "override_reason": F.when(ours, c["reason"])}).drop("_asked", "_first")


def identity(track: Column, elapsed: Column) -> Column:
    """The warp of a clock that doesn't drift."""
    return elapsed


def origin(starts: DataFrame, by: list[str], track: str, path: str, warp: Callable[[Column, Column], Column] = identity) -> DataFrame:
    """Adds cycles, position, rule, refusal, notes to each source: the day it belongs to and its place in the session, in samples.

    starts: start and asserted as start_times() gives them, zero (flicks; null where none is configured), origin_date, rollover
    ('infer_forward' or 'reject'). The days come from asserted dates where every source with a time of day has one; else from a
    configured zero, before which a source belongs to the next day; else from the widest gap on the circle of a day, which needs days of one length.
    Offsets are places already, and have no say in it. rule: dates, zero, gap, or null without any time of day.

    refusal, one for a session, the first that holds: origin_after_earliest_source, rollover_rejected, rollover_ambiguous (a tie, or days of
    several lengths), audio_before_session_zero (only where zero is configured; else all are shifted). A refused session has no positions.
    notes: rollover_from_recorded_dates, rollover_inferred (of those that gain a day), midnight_rollover_inferred, timeline_shifted_to_earliest_source, mixed_time_domains.

    warp gets the track and the exact elapsed flicks, and returns flicks; it stands before the one rounding.
    Memory of a task is bounded: a session's sources stream through windows by their time.
    """
    whole = Window.partitionBy(*by)
    at, day = F.col("start.flicks"), F.col("start.day")
    timed = F.col("start.kind") != "offset"
    df = starts.withColumns({"_timed": F.coalesce(timed, F.lit(False)), "_at": F.when(timed, at), "_day": F.when(timed, day)})
    df = df.withColumns({
        "_dated": F.coalesce(F.bool_and(F.when(F.col("_timed"), F.col("asserted").isNotNull())).over(whole), F.lit(False)),
        "_n": F.sum(F.col("_timed").cast("long")).over(whole), "_least_date": F.min(F.when(F.col("_timed"), F.col("asserted"))).over(whole),
        "_least": F.min("_at").over(whole), "_most": F.max("_at").over(whole), "_short": F.min("_day").over(whole), "_long": F.max("_day").over(whole),
        "_kinds": F.size(F.collect_set(F.when(F.col("_timed"), F.col("start.kind"))).over(whole)),
    })
    order = Window.partitionBy(*by, "_timed").orderBy("_at", path)
    df = df.withColumn("_gap", F.when(F.col("_timed"), F.lead("_at").over(order) - F.col("_at")))
    df = df.withColumn("_widest", F.max("_gap").over(whole))
    df = df.withColumns({
        "_ties": F.sum(F.when(F.col("_gap") == F.col("_widest"), 1).otherwise(0)).over(whole), "_cut": F.max(F.when(F.col("_gap") == F.col("_widest"), F.col("_at"))).over(whole),
        "_wrap": F.col("_least") + F.col("_short") - F.col("_most"),
    })
    rule = F.when(F.col("_n") == 0, F.lit(None)).when(F.col("_dated"), "dates").when(F.col("zero").isNotNull(), "zero").otherwise("gap")
    crosses = (F.col("_n") > 1) & (F.col("_wrap") <= F.col("_widest"))
    tie = crosses & ((F.col("_wrap") == F.col("_widest")) | (F.col("_ties") > 1))
    by_date = F.datediff("asserted", F.coalesce("origin_date", "_least_date"))
    cycles = F.when(~F.col("_timed"), 0).when(rule == "dates", by_date).when(rule == "zero", (F.col("_at") < F.col("zero")).cast("int")).when(crosses & (F.col("_at") <= F.col("_cut")), 1).otherwise(0)
    df = df.withColumns({"rule": rule, "cycles": cycles.cast("int"), "_crosses": crosses, "_tie": tie})
    df = df.withColumn("_turned", F.max("cycles").over(whole)).withColumn("_early", F.min("cycles").over(whole) < 0)
    df = df.withColumn("_seconds", F.col("_at") + F.col("cycles") * F.col("_day"))
    df = df.withColumn("_zero", F.coalesce("zero", F.min("_seconds").over(whole), F.lit(0).cast("long")))
    elapsed = F.when(F.col("_timed"), F.col("_seconds") - F.col("_zero")).otherwise(at)
    df = df.withColumn("_place", Q.round_half_away(warp(F.col(track), elapsed), F.lit(FLICK // RATE)))
    df = df.withColumn("_first", F.min("_place").over(whole))
    rejects = F.col("rollover") == "reject"
    refusal = (
        F.when((F.col("rule") == "dates") & F.col("_early"), "origin_after_earliest_source")
        .when((F.col("rule") == "zero") & rejects & (F.col("_turned") > 0), "rollover_rejected")
        .when((F.col("rule") == "gap") & ((F.col("_short") != F.col("_long")) | F.col("_tie")), "rollover_ambiguous")
        .when((F.col("rule") == "gap") & rejects & F.col("_crosses"), "rollover_rejected")
        .when(F.col("zero").isNotNull() & (F.col("_first") < 0), "audio_before_session_zero")
    )
    df = df.withColumn("refusal", refusal)
    turned = F.col("_turned") > 0
    notes = F.when(F.col("refusal").isNull(), F.array_compact(F.array(
        F.when((F.col("rule") == "dates") & turned, "rollover_from_recorded_dates"), F.when(F.col("rule").isin("zero", "gap") & (F.col("cycles") > 0), "rollover_inferred"),
        F.when((F.col("rule") == "gap") & turned, "midnight_rollover_inferred"), F.when(F.col("zero").isNull() & (F.col("_first") < 0), "timeline_shifted_to_earliest_source"),
        F.when((F.col("_kinds") > 1) & (F.col("_short") != F.col("_long")), "mixed_time_domains"),
    ))).otherwise(F.array().cast("array<string>"))
    position = F.when(F.col("refusal").isNull(), F.col("_place") - F.when(F.col("zero").isNull(), F.least(F.col("_first"), F.lit(0))).otherwise(0))
    df = df.withColumns({"notes": notes, "position": position.cast("long")})
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def lay_out(placed: DataFrame, by: list[str], track: str, path: str, length: str, policy: Column) -> DataFrame:
    """Adds placed, shift, gap, overlap, tolerance, verdict to each source with a position; a track's chunks lie one behind another.

    A chunk that would begin before the end of the one before, as that one was placed, begins at that end; no sample is cut. An overlap
    up to the coarser resolution of the two chunks' evidence is its rounding (chunk_overlap_quantization); beyond it the
    policy decides: 'reject' is the error chunk_overlap, 'nudge_later' the warning chunk_overlap_nudged. verdict: one of these, chunk_gap_preserved
    where silence precedes, or null. Chunks go by position, then by path; names and counters have no say.
    """
    own = I.layout(placed, [*by, track], ["position", path], "position", length)
    before = F.lag("start.quantum").over(Window.partitionBy(*by, track).orderBy("position", path))
    own = own.withColumn("tolerance", F.greatest(F.lit(1).cast("long"), F.col("start.quantum"), before))
    beyond = F.when(policy == "reject", "chunk_overlap").otherwise("chunk_overlap_nudged")
    return own.withColumn("verdict", F.when(F.col("gap") > 0, "chunk_gap_preserved").when(F.col("overlap") == 0, F.lit(None)).when(F.col("overlap") <= F.col("tolerance"), "chunk_overlap_quantization").otherwise(beyond))


def unfit(sources: DataFrame, by: list[str], track: str, codecs: tuple[str, ...] = ("pcm_f32le", "pcm_s24le", "pcm_s16le")) -> DataFrame:
    """Adds unfit to sources (rate, channels, codec, samples): why one can't be laid out, the first reason that holds, or null.

    inconsistent_sample_rate (of its track), source_not_inspected, unsupported_sample_rate, undecodable_source, unknown_sample_count.
    """
    over = Window.partitionBy(*by, track)
    rates = F.min("rate").over(over) != F.max("rate").over(over)
    conditions = [
        (rates, "inconsistent_sample_rate"), (F.col("rate").isNull(), "source_not_inspected"), (F.col("rate") != RATE, "unsupported_sample_rate"),
        (F.coalesce(F.col("channels"), F.lit(0)) != 1, "undecodable_source"), (~F.coalesce(F.col("codec"), F.lit("")).isin(*codecs), "undecodable_source"), (F.col("samples").isNull(), "unknown_sample_count"),
    ]
    return sources.withColumn("unfit", reduce(lambda rest, x: F.when(x[0], x[1]).otherwise(rest), reversed(conditions), F.lit(None).cast("string")))


def span_note(length: Column) -> Column:
    """Of a session that many samples long."""
    return F.when(length > PLAUSIBLE * RATE, "implausible_session_span")
