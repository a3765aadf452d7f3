"""From requests to a transcript: transcription with retries, drafts, groups, boundary repeats, documents.

A request is one row with its audio and the runs of candidates it owns. Models are plugins; those given here answer from
a script, so that everything around them can be run and tested.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from fractions import Fraction
from typing import Any, NamedTuple, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.quantize import floor_div
from tidewright.functions.text import _key

RATE = 16_000
SPLIT_FRAME = 512


class Word(NamedTuple):
    start: int
    end: int
    text: str


@dataclass(frozen=True)
class Request:
    """A core within its padded window, in samples of the session at RATE."""

    request_id: str
    track_id: str
    core: tuple[int, int]
    padded: tuple[int, int]
    audio: np.ndarray


@dataclass(frozen=True)
class Answer:
    """alignment: aligned, segment_only (an aligner failed) or not_attempted."""

    text: str
    words: tuple[Word, ...] = ()
    truncated: bool = False
    alignment: str = "not_attempted"


class Transcriber(Protocol):
    """Plugin. One instance serves a Python worker; the same request must get the same answer."""

    def transcribe(self, request: Request) -> Answer: ...


@dataclass
class Scripted:
    """Answers by request_id; an unknown request is silence."""

    answers: dict[str, Answer]

    def transcribe(self, request: Request) -> Answer:
        return self.answers.get(request.request_id, Answer("", (), False, "aligned"))


@dataclass
class Script:
    """Answers with the scripted words (track, start, end, text) that start in the padded window; too many are truncated."""

    words: list[tuple[str, int, int, str]]
    most: int = 10**9

    def transcribe(self, request: Request) -> Answer:
        a, b = request.padded
        own = [Word(max(s, a), min(e, b), t) for track, s, e, t in self.words if track == request.track_id and s < b and e > a]
        return Answer(" ".join(w.text for w in own[: self.most]), tuple(own[: self.most]), len(own) > self.most, "aligned")


def looks_truncated(text: Column, tokens: Column, ceiling: int, margin: int) -> Column:
    """A text, as long as the model may write less a margin."""
    return (F.length(F.trim(F.coalesce(text, F.lit("")))) > 0) & (tokens >= ceiling - margin)


def quietest(audio: np.ndarray, start: int, core: tuple[int, int], least: int, frame: int = SPLIT_FRAME) -> int | None:
    """Where to cut a core so that both halves have more than nothing beyond `least`; None if it is too short.

    Cuts lie on multiples of frame. The one before the quietest frame counts, of equals the one nearest the middle, then the
    earlier. Where no multiple fits, it is the middle between the bounds.
    """
    low, high = core[0] + max(1, least), core[1] - max(1, least)
    if high <= low:
        return None
    cuts = np.arange(-(-low // frame) * frame, high + 1, frame)
    if not len(cuts):
        return (low + high) // 2
    sums = np.concatenate([[0.0], np.cumsum(np.square(audio.astype(np.float64)))])
    a = np.clip(cuts - start, 0, len(audio))
    b = np.minimum(a + frame, len(audio))
    power = np.where(b > a, (sums[b] - sums[a]) / np.maximum(b - a, 1), 0.0)
    return int(cuts[np.lexsort((cuts, np.abs(cuts - sum(core) // 2), power))[0]])


@dataclass
class Outcome:
    text: str
    words: tuple[Word, ...]
    alignment: str
    truncated: bool
    ids: list[str] = field(default_factory=list)
    spent: int = 0
    note: str | None = None


def without_repeat(left: Sequence[Word], right: Sequence[Word]) -> Sequence[Word]:
    """The right piece without a first word that is the left's last one, heard again: the same key, and overlapping in time."""
    if left and right:
        a, b = left[-1], right[0]
        if _key(a.text) == _key(b.text) and b.start < a.end and a.start < b.end:
            return right[1:]
    return right


def resolve(request: Request, model: Transcriber, limit: int, pad: int, least_core: int, retries: int) -> Outcome:
    """The request's answer. A truncated one is cut at a quiet point and both halves are asked for, again and again.

    Each cut spends two of the retries, which one original request's cuts share. If any half stays truncated, the
    original answer stands as it was: a stitch with a hole would look whole.
    """
    left_over = [retries]

    def ask(r: Request) -> Outcome:
        got = model.transcribe(r)
        own = Outcome(got.text, got.words, got.alignment, got.truncated, [r.request_id])
        if not got.truncated:
            return own
        a, b = r.core
        at = quietest(r.audio, r.padded[0], r.core, least_core)
        if at is None:
            own.note = "too_short_to_split"
            return own
        if left_over[0] < 2:
            own.note = "retries_spent"
            return own
        left_over[0] -= 2
        halves = [ask(_half(r, i, cut, pad, limit)) for i, cut in enumerate(((a, at), (at, b)))]
        own.ids += [i for h in halves for i in h.ids]
        own.spent = 2 + sum(h.spent for h in halves)
        if any(h.truncated for h in halves):
            own.note = "retries_spent"
            return own
        return _stitch(*halves, own)

    return ask(request)


def _half(r: Request, i: int, core: tuple[int, int], pad: int, limit: int) -> Request:
    a, b = max(0, core[0] - pad, r.padded[0]), min(limit, core[1] + pad, r.padded[1])
    return Request(f"{r.request_id}.{i}", r.track_id, core, (a, b), r.audio[a - r.padded[0] : b - r.padded[0]])


def _stitch(left: Outcome, right: Outcome, own: Outcome) -> Outcome:
    kinds = {left.alignment, right.alignment}
    text = " ".join(t for t in (left.text.strip(), right.text.strip()) if t)
    alignment = "aligned" if kinds == {"aligned"} else "segment_only" if "segment_only" in kinds else "not_attempted"
    words = (*left.words, *without_repeat(left.words, right.words)) if alignment == "aligned" else ()
    return Outcome(text, words, alignment, False, own.ids, own.spent)


WORDS = "array<struct<start:long,end:long,text:string>>"
OUTCOMES = f"request_id string, track_id string, text string, words {WORDS}, alignment string, truncated boolean, request_ids array<string>, spent int, note string"


def transcribe(requests: DataFrame, factory: Callable[[], Transcriber], limit: int, pad: int, least_core: int, retries: int = 4) -> DataFrame:
    """OUTCOMES for requests (request_id, track_id, core_start, core_end, padded_start, padded_end, samples).

    Requests are independent; each is resolved where it lies. One model is made for each task.
    """
    columns = [c.split()[0] for c in OUTCOMES.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                request = Request(r.request_id, r.track_id, (r.core_start, r.core_end), (r.padded_start, r.padded_end), np.asarray(r.samples, np.float32))
                o = resolve(request, model, limit, pad, least_core, retries)
                rows.append((r.request_id, r.track_id, o.text, [w._asdict() for w in o.words], o.alignment, o.truncated, o.ids, o.spent, o.note))
            yield pd.DataFrame(rows, columns=columns)

    names = ["request_id", "track_id", "core_start", "core_end", "padded_start", "padded_end", "samples"]
    return requests.select(*names).mapInPandas(run, OUTCOMES)


def request_identity(samples: Column, *parts: Column) -> Column:
    """sha256 over the very bytes submitted and what else the answer depends on, each part with its length before it."""
    framed = [F.concat(F.octet_length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")) for p in parts]
    return F.sha2(F.concat(F.sha2(samples, 256), *framed), 256)


def audio_sha256(samples: np.ndarray) -> str:
    return hashlib.sha256(np.ascontiguousarray(samples, "<f4").tobytes()).hexdigest()


def decode_alignment(items: Sequence[tuple[Any, Any, str]], start: int, end: int, rate: int = RATE) -> list[Word]:
    """Words of an aligner's (start seconds, end seconds, text), on the session's grid; [] if one item is impossible.

    Seconds are the decimals they print as. Empty texts go; an item without length has one sample.
    """
    out: list[Word] = []
    for a, b, text in items:
        text = text.strip()
        if not text:
            continue
        at = []
        for seconds in (a, b):
            if not np.isfinite(seconds) or seconds < 0:
                return []
            scaled = Fraction(str(seconds)) * rate
            at.append(start + (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator))
        if at[1] < at[0] or at[1] > end or at[0] > end or (out and at[0] < out[-1].start):
            return []
        out.append(Word(at[0], max(at[1], at[0] + 1), text))
    return out


def alignment(items: DataFrame, by: str, ordinal: str, start: Column, end: Column, rate: int = RATE) -> DataFrame:
    """decode_alignment() as columns: items have by, ordinal, start_s and end_s (decimal texts) and text."""
    sample = lambda c: floor_div((F.col(c).try_cast("decimal(18,6)") * (2 * rate) * 1_000_000 + 1_000_000).cast("decimal(38,0)"), F.lit(2_000_000).cast("decimal(38,0)")).cast("long")
    used = items.filter(F.trim("text") != "").withColumns({"_a": start + sample("start_s"), "_b": start + sample("end_s"), "_end": end, "_start": start})
    before = F.lag("_a").over(Window.partitionBy(by).orderBy(ordinal))
    bad = F.col("_a").isNull() | F.col("_b").isNull() | (F.col("_a") < F.col("_start")) | (F.col("_b") < F.col("_a")) | (F.greatest("_a", "_b") > F.col("_end")) | F.coalesce(F.col("_a") < before, F.lit(False))
    judged = used.withColumn("_bad", bad).withColumn("_void", F.bool_or("_bad").over(Window.partitionBy(by)))
    return judged.filter("not _void").select(by, ordinal, F.col("_a").alias("start"), F.greatest(F.col("_b"), F.col("_a") + 1).alias("end"), F.trim("text").alias("text"))


def candidate_groups(ownership: DataFrame, track: str, rank: str, request: str, wordless: str) -> DataFrame:
    """Adds group_rank: the least rank of the candidates that must share a segment with this one.

    A request owns a run of consecutive candidates of its track. One without words can't be divided, so its run is one
    group, and runs that share a candidate are one by way of it: islands of rank intervals, without an iteration.
    """
    runs = ownership.filter(F.col(wordless)).groupBy(track, request).agg(F.min(rank).alias("_a"), F.max(rank).alias("_b"))
    reach = F.max("_b").over(Window.partitionBy(track).orderBy("_a", "_b").rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("_fresh", F.when(F.col("_a") <= reach, 0).otherwise(1))
    numbered = marked.withColumn("_island", F.sum("_fresh").over(Window.partitionBy(track).orderBy("_a", "_b").rowsBetween(Window.unboundedPreceding, 0)))
    islands = numbered.groupBy(track, "_island").agg(F.min("_a").alias("_low"), F.max("_b").alias("_high")).select(F.col(track).alias("_t"), "_low", "_high")
    # islands are disjoint: the last one that begins at or before a rank is the only one that can hold it
    points = ownership.select(track, rank).distinct()
    both = points.select(track, F.col(rank).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_high")).unionByName(
        islands.select(F.col("_t").alias(track), F.col("_low").alias("_at"), F.lit(0).alias("_kind"), F.col("_high").cast("long").alias("_high"))
    )
    last = lambda c: F.last(c, ignorenulls=True).over(Window.partitionBy(track).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0))
    held = both.withColumns({"_lo": last(F.when(F.col("_kind") == 0, F.col("_at"))), "_hi": last(F.col("_high"))}).filter("_kind = 1")
    return held.select(track, F.col("_at").alias(rank), F.when(F.col("_at") <= F.col("_hi"), F.col("_lo")).otherwise(F.col("_at")).alias("group_rank"))


def boundary_repeats(pieces: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Pieces (with words) without the words that repeat the piece before; a trimmed piece's last word counts as it stands.

    One group is the pieces of one candidate: bounded by its length over the cap.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        out, left = [], []
        for words in rows["words"]:
            own = [Word(int(w["start"]), int(w["end"]), w["text"]) for w in words]
            left = list(without_repeat(left, own))
            out.append([w._asdict() for w in left])
        return rows.assign(words=out)

    return pieces.groupBy(*by).applyInPandas(run, pieces.schema)


def drafts(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """One draft for each group of contributions, from rows with ordinal, ownership_start, ownership_end, alignment, text, words.

    All aligned: the words' text, from the first start to the last end. Else the whole text over the ownership. A draft
    without text goes.
    """
    listed = parts.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("ordinal", "text", "words"))).alias("_parts"), F.min("ownership_start").alias("ownership_start"), F.max("ownership_end").alias("ownership_end"),
        F.bool_and(F.col("alignment") == "aligned").alias("_aligned"), F.bool_or(F.col("alignment") == "segment_only").alias("_failed"),
    )
    words = F.flatten(F.transform("_parts", lambda p: p["words"]))
    tidy = lambda t: F.trim(F.regexp_replace(t, r"\s+", " "))
    spoken, whole = tidy(F.array_join(F.transform(words, lambda w: w["text"]), " ")), tidy(F.array_join(F.transform("_parts", lambda p: p["text"]), " "))
    out = listed.withColumns({"text": F.when(F.col("_aligned"), spoken).otherwise(whole), "words": F.when(F.col("_aligned"), words).otherwise(F.slice(words, 1, 0))})
    start, end = F.array_min(F.transform("words", lambda w: w["start"])), F.array_max(F.transform("words", lambda w: w["end"]))
    status = F.when(F.col("_aligned"), "aligned").when(F.col("_failed"), "segment_only").otherwise("not_attempted")
    return out.filter(F.col("text") != "").select(
        *by, F.when(F.col("_aligned"), start).otherwise(F.col("ownership_start")).alias("start"), F.when(F.col("_aligned"), end).otherwise(F.col("ownership_end")).alias("end"),
        "ownership_start", "ownership_end", "text", "words", status.alias("alignment"),
    )


def seconds(sample: Column, rate: int) -> Column:
    """Samples as seconds, to the millisecond, half away from zero."""
    return floor_div(sample * 2000 + rate, 2 * rate).cast("double") / 1000


def transcript_json(turns: DataFrame, rate: int) -> DataFrame:
    """segment_id, document: a public segment as JSON, of turns with start, end, speaker_id, text, overlap and words."""
    words = F.transform("words", lambda w: F.struct(seconds(w["start"], rate).alias("start_s"), seconds(w["end"], rate).alias("end_s"), w["text"].alias("text")))
    body = F.struct("segment_id", seconds(F.col("start"), rate).alias("start_s"), seconds(F.col("end"), rate).alias("end_s"), "speaker_id", "text", "overlap", words.alias("words"))
    return turns.select("segment_id", F.to_json(body).alias("document"))
