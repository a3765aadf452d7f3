"""Scripted models from a file: what a detector and a transcriber would answer, on the session's own grid.

The file asks for these very answers; so whatever is wrong with it is an error, and nothing stands in for it.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

from tidewright.operators.activity import RATE, Spans
from tidewright.operators.transcript import Script
from tidewright.sources.files import canonical_json

VERSION = 1


class ScriptError(ValueError):
    """A file of scripted models that can't be used; the message names the place."""


@dataclass(frozen=True)
class Scripted:
    """Plugins of a session and the sha256 of what they were made from, whichever way it was written."""

    detector: Spans
    transcriber: Script
    digest: str


def _whole(value: Any, place: str) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < 0:
        raise ScriptError(f"{place}: a sample is needed, not {value!r}")
    return value


def _interval(a: Any, b: Any, scale: int, place: str) -> tuple[int, int]:
    """On the derived grid, covering: the start is rounded down, the end up."""
    start, end = _whole(a, place), _whole(b, place)
    if end < start:
        raise ScriptError(f"{place}: it ends before it begins")
    return start // scale, -(-end // scale)


def parse(text: str) -> Scripted:
    """From JSON with fake_models_version, sample_rate (a multiple of the derived rate), activity (track: pairs of samples) and asr (utterances with words)."""
    try:
        doc = json.loads(text)
    except ValueError as x:
        raise ScriptError(f"no JSON: {x}") from None
    if not isinstance(doc, dict) or doc.get("fake_models_version") != VERSION:
        raise ScriptError(f"fake_models_version {VERSION} is needed")
    rate = doc.get("sample_rate")
    if isinstance(rate, bool) or not isinstance(rate, int) or rate < RATE or rate % RATE:
        raise ScriptError(f"sample_rate: a multiple of {RATE} is needed, not {rate!r}")
    scale = rate // RATE
    activity, asr = doc.get("activity", {}), doc.get("asr", [])
    if not isinstance(activity, dict) or not isinstance(asr, list):
        raise ScriptError("activity is a mapping of tracks, asr a list")
    spans = []
    for track, own in sorted(activity.items()):
        if not track.isdigit() or not isinstance(own, list):
            raise ScriptError(f"activity[{track!r}]: a track's number and a list of intervals are needed")
        for i, pair in enumerate(own):
            if not isinstance(pair, list) or len(pair) != 2:
                raise ScriptError(f"activity[{track!r}][{i}]: two samples are needed")
            a, b = _interval(*pair, scale, f"activity[{track!r}][{i}]")
            if b > a:
                spans.append((int(track), a, b, 1.0))
    words = []
    for i, item in enumerate(asr):
        if not isinstance(item, dict) or not isinstance(item.get("track_id"), str) or not isinstance(item.get("text"), str):
            raise ScriptError(f"asr[{i}]: track_id and text are needed")
        _interval(item.get("start_sample"), item.get("end_sample"), scale, f"asr[{i}]")
        for j, w in enumerate(item.get("words", [])):
            if not isinstance(w, dict) or not isinstance(w.get("text"), str):
                raise ScriptError(f"asr[{i}].words[{j}]: a text is needed")
            a, b = _interval(w.get("start_sample"), w.get("end_sample"), scale, f"asr[{i}].words[{j}]")
            words.append((item["track_id"], a, b, w["text"]))
    words.sort(key=lambda w: (w[1], w[0], w[2], w[3]))
    return Scripted(Spans(tuple(spans)), Script(words), hashlib.sha256(canonical_json(doc).encode()).hexdigest())


def load_scripts(spark: SparkSession, path: str) -> Scripted:
    """A session's file, wherever Spark reads from. It is one session's script: a few rows."""
    found = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(found) != 1:
        raise ScriptError(f"{len(found)} files at {path}; one is needed")
    return parse(found[0][0])
