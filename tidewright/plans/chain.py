"""The whole way of a session: recordings below a folder become a transcript, a mix and a report.

Every step is a table; what later steps share is kept by its identity in a StageCache, so that a run that was cut short goes on where
it stopped. Transcript and mix are independent of each other: one of them failing leaves the other, and the report says so.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import asdict, dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tidewright.functions import text as X
from tidewright.functions import timecode as C
from tidewright.operators import activity as D
from tidewright.operators import answers as N
from tidewright.operators import assembly as B
from tidewright.operators import discovery as V
from tidewright.operators import envelope as E
from tidewright.operators import intervals as I
from tidewright.operators import loudness as L
from tidewright.operators import rules as R
from tidewright.operators import sequences as S
from tidewright.operators import signal as G
from tidewright.operators import starts as O
from tidewright.operators import syncqa as Y
from tidewright.operators import transcript as T
from tidewright.plans.stages import Report, StageCache, identity
from tidewright.sources.files import write_json
from tidewright.sources.recordings import Captures, inspect, inventory, track_windows
from tidewright.sources.shared import durable, importable
from tidewright.sources.wavsink import save

RATE = 48_000
#: Samples of a window at 48 kHz: whole seconds' worth of steps of loudness, frames of detection and control frames.
WINDOW = 460_800
CONTROL = 48  # samples of a control frame of the mix
TAPS = G.low_pass(127, 0.9 / 6)


@dataclass(frozen=True)
class Settings:
    """Fields that change results. The plugins' version stands for what they would answer."""

    opens: int = 500
    closes: int = 350
    min_reference: int = 3
    room: float = 0.005
    #: Presence by control frame: up within 10, down within 300 of them.
    rise: float = 0.1
    fall: float = 1 / 300
    join_gap_ms: int = 350
    overlap_ms: int = 250
    grace_ms: int = 20
    models: str = "scripted"
    #: Directories of the tracks, in their order; none: a track for each transmitter that file names tell of.
    tracks: tuple[str, ...] = ()
    active: tuple[int, ...] | None = None
    allow_processed: bool = False
    frame_rate: str = "30F"
    origin_timecode: str | None = None
    origin_date: str | None = None
    rollover: str = "infer_forward"
    overlap: str = "reject"
    bwf_quantum: int = 1600
    #: path (below the folder), and of sha256, recording_date, start_timecode, start_offset, reason those that are stated.
    overrides: tuple[dict, ...] = ()


def discovered(spark: SparkSession, folder: str, settings: Settings, captures: Captures | None = None) -> tuple[DataFrame, V.Discovery]:
    """(facts of every .wav file with its relative path, what discovery decides about them). captures: what is known of files already.

    Tracks are the configured directories; without any, each transmitter of a file name is one, as if its files lay in a directory of their own.
    """
    own = captures.inspect(folder)[0] if captures else inspect(spark, folder)
    found = durable(own.join(inventory(spark, folder).select("path", "relative"), "path"))
    every = inventory(spark, folder).join(found.select("path", "sha256", "tx"), "path", "left")
    if settings.tracks:
        tracks = spark.createDataFrame([("session", i + 1, t) for i, t in enumerate(settings.tracks)], "session string, track long, input string")
    else:
        every = every.withColumn("relative", F.when(F.col("tx").isNull(), F.col("relative")).otherwise(F.concat(F.lit("TX"), F.col("tx"), F.lit("/"), F.col("relative"))))
        found = found.withColumn("relative", F.when(F.col("tx").isNull(), F.col("relative")).otherwise(F.concat(F.lit("TX"), F.col("tx"), F.lit("/"), F.col("relative"))))
        tracks = found.filter("tx is not null").select(F.lit("session").alias("session"), F.col("tx").cast("long").alias("track"), F.concat(F.lit("TX"), "tx").alias("input")).distinct()
    rules = spark.createDataFrame([("session", settings.allow_processed, list(settings.active) if settings.active is not None else None)], "session string, allow_processed boolean, active array<long>")
    files = every.select(F.lit("session").alias("session"), F.col("relative").alias("path"), "sha256")
    told = _overrides(spark, settings)
    if not settings.tracks:  # an override names the file where it really is
        told = told.join(every.select(F.substring_index("path", "/", -1).alias("_name"), F.col("relative").alias("_relative")), F.col("path") == F.col("_name"), "left").withColumn("path", F.coalesce("_relative", "path")).drop("_name", "_relative")
    return found, V.discover(files, tracks, rules, told.select(F.lit("session").alias("session"), "path"))


def _overrides(spark: SparkSession, settings: Settings) -> DataFrame:
    rows = [(o["path"], o.get("sha256"), o.get("recording_date"), o.get("start_timecode"), o.get("start_offset"), o.get("reason"), True) for o in settings.overrides]
    return spark.createDataFrame(rows, "path string, override_sha256 string, recording_date date, start_timecode string, start_offset long, reason string, overridden boolean")


def sources_of(spark: SparkSession, folder: str, report: Report, settings: Settings | None = None, captures: Captures | None = None) -> DataFrame:
    """Selected, usable sources with their track; each other file is a decision of the report. What can't go on is refused by its code."""
    found, told = discovered(spark, folder, settings or Settings(), captures)
    refused(told.refusals, "code", "subject")
    roles = told.sources.select(F.col("path").alias("relative"), "track", "role", "reason")
    own = durable(found.join(roles, "relative", "left"))
    good = own.filter((F.col("role") == "selected") & R.usable([F.array_contains("wrong", "unreadable"), F.col("samples") == 0]))
    why = F.when(F.size("wrong") > 0, F.concat_ws(",", "wrong")).otherwise(F.coalesce("reason", F.lit("empty")))
    for r in own.join(good.select("path"), "path", "left_anti").select("name", why.alias("wrong")).toLocalIterator():
        report.decide("source_ignored", name=r["name"], wrong=r["wrong"])
    codec = F.when(F.col("floating") & (F.col("bits") == 32), "pcm_f32le").when(~F.col("floating"), F.concat(F.lit("pcm_s"), F.col("bits").cast("string"), F.lit("le")))
    checked = O.unfit(good.withColumns({"codec": codec, "session": F.lit("session")}), ["session"], "track")
    refused(checked.filter("unfit is not null"), "unfit", "name")
    return good.drop("role", "reason")


def refused(rows: DataFrame, code: str, subject: str) -> None:
    """Raises by the first code, with how many rows there are and some of their subjects."""
    n = rows.groupBy(code).agg(F.count("*").alias("n"), F.min(subject).alias("first")).orderBy(code).limit(1).collect()
    if n:
        raise ValueError(f"{n[0][code]}: {n[0]['n']}, such as {n[0]['first']}")


def started(sources: DataFrame, settings: Settings) -> DataFrame:
    """Adds the start of each source, by the strategies that the settings and its own tags give."""
    relative = F.col("relative") if "relative" in sources.columns else F.substring_index("path", "/", -1)
    told = _overrides(sources.sparkSession, settings).withColumnRenamed("path", "_path")
    named = sources.withColumn("_relative", relative)
    if not settings.tracks:
        named = named.withColumn("_relative", F.substring_index("_relative", "/", -1))
    joined = named.join(told, F.col("_relative") == F.col("_path"), "left").drop("_path", "_relative")
    return O.start_times(joined.withColumn("time_reference", F.col("reference").cast("string")), F.lit(settings.frame_rate), F.lit(settings.bwf_quantum))


def timeline(sources: DataFrame, settings: Settings | None = None, report: Report | None = None, warp: Callable[[Column, Column], Column] = O.identity) -> tuple[DataFrame, int]:
    """(entries, length): every file's place in the session, in samples.

    Its start is what the first strategy with an answer says; the day it belongs to is settled by the origin rules; chunks that overlap within
    their evidence's resolution are shifted, others by policy. What can't be settled is refused by its code.
    """
    settings = settings or Settings()
    begun = durable(started(sources, settings))
    refused(begun.filter("refusal is not null"), "refusal", "name")
    rate = C.frame_rate(F.lit(settings.frame_rate))
    code = C.parse(F.lit(settings.origin_timecode).cast("string"), rate)
    zero = C.frame_index(code, rate) * rate["den"] * F.expr(f"{O.FLICK}L") / rate["num"]
    own = begun.drop("refusal").withColumns({"session": F.lit("session"), "zero": zero.cast("long"), "origin_date": F.lit(settings.origin_date).cast("date"), "rollover": F.lit(settings.rollover)})
    placed = durable(O.origin(own, ["session"], "track", "path", warp))
    refused(placed.filter("refusal is not null").select("refusal", "name"), "refusal", "name")
    laid = durable(O.lay_out(placed, ["session"], "track", "path", "samples", F.lit(settings.overlap)))
    refused(laid.filter("verdict = 'chunk_overlap'"), "verdict", "name")
    length = laid.agg(F.max(F.col("placed") + F.col("samples"))).first()[0]
    if length is None:
        raise ValueError("no_sources: nothing to lay out")
    if report:
        for r in placed.select("name", F.explode("notes").alias("code")).union(laid.filter("verdict is not null").select("name", "verdict")).groupBy("code").agg(F.count("*").alias("n"), F.min("name").alias("first")).collect():
            report.decide(r["code"], sources=r["n"], first=r["first"])
        if length > O.PLAUSIBLE * RATE:
            report.decide("implausible_session_span", samples=length)
    return laid.drop("session"), int(length)


def derived(windows: DataFrame) -> DataFrame:
    """The tracks at 16 kHz, in windows of a third of the samples."""
    return G.decimate_windows(windows.select("track", "window", F.col("samples").cast("array<double>").alias("samples")), ["track"], WINDOW, TAPS, 3).select("track", "window", F.col("samples").cast("array<float>").alias("samples"))


@dataclass(frozen=True)
class Spoken:
    """drafts with their verdicts, turns for presentation, words that no piece of ownership claimed, requests whose answers are told of, how many were submitted."""

    drafts: DataFrame
    turns: DataFrame
    lost: DataFrame
    notes: DataFrame
    submitted: int


def transcribed(verdicts: DataFrame, pairs: DataFrame, windows: DataFrame, length: int, models: Callable[[], T.Transcriber], settings: Settings, answers: N.Answers) -> Spoken:
    """The session's words: what the kept answers lack is asked for; words belong to the piece of a candidate that they begin in.

    A truncated answer that no cut could mend keeps its text. Copies of an utterance on other tracks go, by the evidence of the graph.
    """
    kept = verdicts.filter("decision = 'retained'")
    ms = lambda n: n * D.RATE // 1000
    asked = durable(D.with_audio(D.requests(kept, length), windows, WINDOW // 3))
    got, submitted = answers.of(asked, models, settings.models, length, ms(500), ms(2000))
    got = durable(got)
    block = 16 * D.RATE
    pieces = durable(B.effective(B.ownership(asked.drop("samples"), kept, block), ms(settings.grace_ms)))
    if pieces.filter("overlapping").limit(1).count():
        raise ValueError("overlapping_ownership: pieces of a track overlap")
    drafts = durable(B.verdicts(B.drafts(got, pieces), verdicts, pairs, block, ms(settings.overlap_ms)))
    retained = drafts.filter("decision = 'retained'").withColumn("session", F.lit(0))
    turns = B.presentation(retained, ["session"], ms(settings.join_gap_ms), block, ms(settings.overlap_ms))
    key = F.concat_ws("-", F.lit("seg"), F.lpad(F.col("start").cast("string"), 12, "0"), "track_id")
    turns = turns.select(key.alias("segment_id"), F.col("track_id").alias("speaker_id"), "start", "end", "text", "words", "overlap")
    notes = got.filter(F.col("truncated") | F.col("note").isNotNull() | (F.col("alignment") == "segment_only")).select("request_id", "truncated", "note", "alignment")
    return Spoken(drafts, turns, B.dropped(got, pieces), notes, submitted)


def told(spoken: Spoken, report: Report) -> None:
    """What was left out or mended, as decisions of the report."""
    for r in B.dropped_notes(spoken.lost).collect():
        report.decide("words_dropped_outside_ownership", track=r["track_id"], words=r["words"], before=r["before"], after=r["after"], leading=r["leading"], farthest=r["farthest"])
    for r in spoken.drafts.filter("decision = 'duplicate'").groupBy("track_id", "contained").agg(F.count("*").alias("n"), F.min("n").alias("first")).collect():
        report.decide("contained_fragment" if r["contained"] else "duplicate_collapsed", track=r["track_id"], drafts=r["n"], first=r["first"])
    for r in spoken.notes.groupBy("truncated", "note", "alignment").agg(F.count("*").alias("n"), F.min("request_id").alias("first")).collect():
        report.decide("answer_truncated" if r["truncated"] else "answer_not_aligned", requests=r["n"], first=r["first"], note=r["note"])
    report.decide("requests_submitted", requests=spoken.submitted)


def gains(verdicts: DataFrame, tracks: DataFrame, length: int, settings: Settings, report: Report | None = None) -> DataFrame:
    """track, window, before, gains: of every window the gains of its control frames and the one before them.

    Retained candidates count by their score; each track is brought to the median level of the tracks' own speech.
    """
    kept = verdicts.filter("decision = 'retained'")
    own = tracks.select(F.col("track").cast("long").alias("track"))
    references = I.nearest_rank(kept.select("track", "level"), ["track"], "level", 0.75, "reference").drop("n")
    shape = E.Shape(settings.rise, settings.fall, settings.room)
    levels = durable(E.corrections(references, own, shape))
    if report:
        for r in levels.filter("note is not null").collect():  # a row for each track
            report.decide(r["note"], track=r["track"], reference=r["reference"], correction=r["correction_mb"])
    # a candidate's samples at 16 kHz are three each at 48 kHz
    spoken = kept.select("track", (F.col("start") * 3).alias("start"), (F.col("end") * 3).alias("end"), "total")
    return E.envelope(spoken, own, levels, length, CONTROL, WINDOW // CONTROL, shape)


def mix(windows: DataFrame, envelope: DataFrame) -> DataFrame:
    """window, samples: the sum of all tracks under their gains, which run in a line from one control frame to the next."""

    @F.pandas_udf(ArrayType(FloatType()))
    def gained(samples: pd.Series, before: pd.Series, gains: pd.Series) -> pd.Series:
        out = []
        for x, b, g in zip(samples, before, gains, strict=True):
            g = np.concatenate([[b], np.asarray(g, float)])
            ramp = (g[:-1, None] + (g[1:] - g[:-1])[:, None] * (np.arange(1, CONTROL + 1) / CONTROL)).ravel()
            out.append((np.asarray(x, float) * ramp[: len(x)]).astype(np.float32))
        return pd.Series(out)

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("track")
        return pd.DataFrame({"window": rows["window"].iloc[:1], "samples": [np.sum(np.stack(rows["samples"].tolist()).astype(float), 0).astype(np.float32)]})

    parts = windows.join(envelope, ["track", "window"]).select("track", "window", gained("samples", "before", "gains").alias("samples"))
    return parts.groupBy("window").applyInPandas(total, "window long, samples array<float>")


def normalized(mixed: DataFrame) -> tuple[DataFrame, dict[str, Any]]:
    """The mix brought to its loudness, and what was measured and decided."""
    heard = L.measure(mixed.withColumn("mix", F.lit(0)), ["mix"], WINDOW)
    gain, code = R.initial_gain(F.col("lufs_mb"), F.col("peak_mb"))
    r = heard.select("lufs_mb", "peak_mb", gain.alias("gain"), code.alias("code")).first()
    facts = {"lufs_mb": r["lufs_mb"], "peak_mb": r["peak_mb"], "gain_mb": r["gain"], "note": r["code"]}
    factor = F.lit(float(10 ** (r["gain"] / 2000)))
    return mixed.select("window", F.transform("samples", lambda v: (v * factor).cast("float")).alias("samples")), facts


def run(spark: SparkSession, folder: str, out: str, detector: Callable[[], D.ActivityDetector], models: Callable[[], T.Transcriber], settings: Settings | None = None, session: str = "session", check_sync: bool = True) -> dict:
    """The session's report, written as report.json below out beside transcript (JSON lines), transcript.md (text) and mix.wav.

    out lies in a folder that all executors mount. A failure of a step that everything needs is raised; then the report tells of it, too.
    """
    importable(spark)
    settings, report = settings or Settings(), Report(session)
    cache = StageCache(spark, os.path.join(out, "cache"))
    os.makedirs(out, exist_ok=True)
    state: dict[str, Any] = {}

    def prepare() -> None:
        sources = sources_of(spark, folder, report, settings, Captures(spark, os.path.join(out, "captures")))
        entries, length = timeline(sources, settings, report)
        known = sorted((r["name"], r["sha256"], r["placed"]) for r in entries.select("name", "sha256", "placed").collect())
        state.update(entries=entries, length=length, key=[list(k) for k in known])

    def kept(name: str, build: Callable[[], DataFrame], **more: Any) -> DataFrame:
        return cache.of(identity(name, 1, "", sources=state["key"], **more), build)

    def derivatives() -> None:
        state["windows"] = kept("windows", lambda: track_windows(state["entries"], WINDOW, state["length"]))
        state["low"] = kept("derivative", lambda: derived(state["windows"]))

    def sync() -> None:
        reference = state["entries"].agg(F.min("track")).first()[0]
        ends = Y.end_windows(state["low"], WINDOW // 3)
        found = durable(Y.lags(ends, F.lit(reference), Y.threshold(100)))
        for r in Y.assess(found, 0.5, 1, Y.threshold(5)).collect():
            report.decide(r["code"], track=r["track"])

    def activity() -> None:
        regions = kept("regions", lambda: D.detect(state["low"], WINDOW // 3, detector, settings.opens, settings.closes), settings=asdict(settings))
        made: list[DataFrame] = []

        def graph(i: int) -> DataFrame:
            if not made:
                made.extend(D.graph(regions, state["low"], WINDOW // 3, min_reference=settings.min_reference))
            return made[i]

        state["verdicts"] = kept("verdicts", lambda: graph(0), settings=asdict(settings))
        state["pairs"] = kept("pairs", lambda: graph(1), settings=asdict(settings))

    def write_mix() -> None:
        envelope = gains(state["verdicts"], state["entries"].select("track").distinct(), state["length"], settings, report)
        mixed = kept("mix", lambda: mix(state["windows"], envelope), settings=asdict(settings))
        final, facts = normalized(mixed)
        report.decide("mix_loudness", **facts)
        save(final, os.path.join(out, "mix.wav"), state["length"], RATE, WINDOW)
        report.deliver("mix.wav", _sha(os.path.join(out, "mix.wav")))

    def write_transcript() -> None:
        answers = N.Answers(spark, os.path.join(out, "answers"))
        spoken = transcribed(state["verdicts"], state["pairs"], state["low"], -(-state["length"] // 3), models, settings, answers)
        turns = durable(spoken.turns)
        told(spoken, report)
        path = os.path.join(out, "transcript")
        T.transcript_json(turns, D.RATE).orderBy("segment_id").select("document").write.mode("overwrite").text(path)
        line = F.concat(F.lit("**["), X.timestamp(F.expr(f"start * 1000 div {D.RATE}")), F.lit("] "), "speaker_id", F.lit(":** "), X.md_escape(F.col("text")))
        turns.orderBy("segment_id").select(line).write.mode("overwrite").text(os.path.join(out, "transcript.md"))
        report.deliver("transcript", turns.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.sha2(F.concat_ws("|", "segment_id", "text"), 256))), ""), 256)).first()[0])

    try:
        for name, step in (("timeline", prepare), ("derivatives", derivatives), *((("sync_qa", sync),) if check_sync else ()), ("activity", activity)):
            report.stage(name, step)
        for name, step in (("mix", write_mix), ("transcript", write_transcript)):
            try:
                report.stage(name, step)
            except Exception as x:  # noqa: BLE001  the other branch goes on; the report has the error
                report.decide("branch_failed", branch=name, error=type(x).__name__)
    finally:
        document = report.document()
        write_json(os.path.join(out, "report.json"), document)
    return document


def _sha(path: str) -> str:
    from tidewright.sources.recordings import file_sha256

    return file_sha256(path)
