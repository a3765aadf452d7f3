"""Marker waveforms in exact integers, their offline page, and seeded test sounds."""

from __future__ import annotations

import base64
import functools
import hashlib
import html
import io
import json
import math
import os
import re
import struct
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

RATE = 48_000
#: A quarter turn of the sine in so many steps, scaled to integers. Fixed values.
STEPS, SCALE = 1024, 1 << 30
PEAK = 1 << 14

#: name: (low Hz, high Hz, chirp ms, direction of each chirp, gaps ms). Fixed values.
SHAPES = {
    "cand-a": (500, 8000, 180, "uuu", (150, 250)),
    "cand-b": (800, 6000, 250, "uuu", (200, 320)),
    "cand-c": (400, 10000, 120, "udu", (90, 160)),
    "v1": (800, 6000, 250, "uuu", (200, 320)),
}
FADE_MS, SILENCE_MS = 10, 100


@dataclass(frozen=True)
class Marker:
    """Lengths in samples; every chirp is (first Hz, last Hz)."""

    name: str
    chirps: tuple[tuple[int, int], ...]
    length: int
    gaps: tuple[int, ...]
    fade: int
    silence: int

    @property
    def intervals(self) -> tuple[tuple[int, int], ...]:
        """Half-open intervals of the chirps from the file's beginning."""
        starts = [self.silence]
        for gap in self.gaps:
            starts.append(starts[-1] + self.length + gap)
        return tuple((s, s + self.length) for s in starts)

    @property
    def anchor(self) -> int:
        return self.silence

    @property
    def total(self) -> int:
        return self.intervals[-1][1] + self.silence


def marker(name: str | None = None) -> Marker:
    """The named marker, v1 by default. Gaps must differ, or a reversed sequence would fit too."""
    name = name or "v1"
    if name not in SHAPES:
        raise ValueError(f"no marker {name!r}; there are {', '.join(sorted(SHAPES))}")
    low, high, ms, directions, gaps = SHAPES[name]
    if len(set(gaps)) != len(gaps) or len(gaps) != len(directions) - 1 or max(low, high) * 2 >= RATE:
        raise ValueError("a marker has different gaps between its chirps and stays below half the rate")
    samples = RATE // 1000
    chirps = tuple((low, high) if d == "u" else (high, low) for d in directions)
    return Marker(name, chirps, ms * samples, tuple(g * samples for g in gaps), FADE_MS * samples, SILENCE_MS * samples)


@functools.cache
def _quarter() -> tuple[int, ...]:
    return tuple(math.floor(math.sin(i * math.pi / 2 / STEPS) * SCALE + 0.5) for i in range(STEPS + 1))


def _entry(step: int) -> int:
    half, at = divmod(step % (4 * STEPS), 2 * STEPS)
    value = _quarter()[min(at, 2 * STEPS - at)]
    return -value if half else value


def sine(num: int, den: int) -> int:
    """The sine of num / den turns times SCALE * den: interpolated between table entries, not rounded."""
    step, rest = divmod(num * 4 * STEPS, den)
    a, b = _entry(step), _entry(step + 1)
    return a * den + (b - a) * rest


def rounded(num: int, den: int) -> int:
    """To the nearest integer, ties away from zero."""
    whole = (2 * abs(num) + den) // (2 * den)
    return -whole if num < 0 else whole


@functools.cache
def chirp(first: int, last: int, n: int, fade: int) -> tuple[int, ...]:
    """A linear sweep with raised-cosine ends. Phase, envelope and peak are one fraction, rounded once."""
    out, den = [], RATE * (n - 1)
    for i in range(n):
        phase = i * first * (n - 1) + (last - first) * (i * (i - 1) // 2)
        edge = min(i, n - 1 - i)
        top, bottom = 1, 1
        if edge < fade:  # (1 - cos(pi edge / fade)) / 2, the cosine as a sine a quarter turn on
            top, bottom = 4 * fade * SCALE - sine(2 * edge + fade, 4 * fade), 8 * fade * SCALE
        out.append(rounded(PEAK * sine(phase, den) * top, den * SCALE * bottom))
    return tuple(out)


def marker_samples(m: Marker) -> np.ndarray:
    out = np.zeros(m.total, np.int32)
    for (first, last), (a, b) in zip(m.chirps, m.intervals, strict=True):
        out[a:b] = chirp(first, last, m.length, m.fade)
    return out


def templates(m: Marker) -> list[np.ndarray]:
    """The chirps as they are played: slices of the one waveform."""
    whole = marker_samples(m)
    return [whole[a:b] for a, b in m.intervals]


def marker_table(spark: SparkSession) -> DataFrame:
    """A row for each chirp of each marker: marker, chirp, start, end, first_hz, last_hz."""
    rows = [(m.name, i, a, b, *m.chirps[i]) for m in map(marker, SHAPES) for i, (a, b) in enumerate(m.intervals)]
    return spark.createDataFrame(rows, "marker string, chirp int, start long, end long, first_hz int, last_hz int")


def wav_bytes(samples: np.ndarray) -> bytes:
    """16-bit mono WAV."""
    data = np.asarray(samples, "<i2").tobytes()
    out = io.BytesIO()
    out.write(b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, 2 * RATE, 2, 16))
    out.write(b"data" + struct.pack("<I", len(data)) + data)
    return out.getvalue()


def page(m: Marker, wav: bytes) -> str:
    """One offline page with the WAV in it, once; its policy lets nothing else load."""
    policy = "default-src 'none'; media-src data:; style-src 'unsafe-inline'"
    payload = base64.b64encode(wav).decode()
    name = html.escape(m.name)
    return (
        f'<!doctype html><html lang="en"><head><meta charset="utf-8"><meta http-equiv="Content-Security-Policy" content="{policy}"><title>{name}</title></head>'
        f'<body><h1>{name}</h1><audio controls src="data:audio/wav;base64,{payload}"></audio></body></html>\n'
    )


def page_payload(text: str) -> bytes:
    """The WAV of a page; a page with none or several is refused."""
    found = re.findall(r"data:audio/wav;base64,([A-Za-z0-9+/=]*)", text)
    if len(found) != 1:
        raise ValueError(f"refused: {len(found)} payloads in the page")
    return base64.b64decode(found[0], validate=True)


def build_marker(folder: str, name: str | None = None) -> dict:
    """Writes name.wav, name.html and name.json below the folder; returns the manifest."""
    from tidewright.sources.files import write_json

    m = marker(name)
    wav = wav_bytes(marker_samples(m))
    text = page(m, wav)
    for suffix, data in (("wav", wav), ("html", text.encode())):
        with open(os.path.join(folder, f"{m.name}.{suffix}.partial"), "wb") as f:
            f.write(data)
        os.replace(f.name, os.path.join(folder, f"{m.name}.{suffix}"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    manifest = {
        "name": m.name, "rate": RATE, "samples": m.total, "anchor": m.anchor, "chirps": [list(i) for i in m.intervals],
        "table_sha256": sha(json.dumps(_quarter()).encode()), "wav_sha256": sha(wav), "page_sha256": sha(text.encode()),
    }
    write_json(os.path.join(folder, f"{m.name}.json"), manifest)
    return manifest


# Test sounds: the same for the same seed, on any machine with the same numpy generator.


def speech_like(n: int, seed: int, rate: int = RATE) -> np.ndarray:
    """Noise under a spectral slope between 100 and 4000 Hz with four syllables a second; peak 0.5."""
    rng = np.random.default_rng(seed)
    spectrum = np.fft.rfft(rng.standard_normal(n))
    hz = np.fft.rfftfreq(n, 1 / rate)
    spectrum *= np.where((hz > 100) & (hz < 4000), 1 / np.sqrt(np.maximum(hz, 1)), 0)
    x = np.fft.irfft(spectrum, n) * (0.6 + 0.4 * np.sin(2 * np.pi * 4 * np.arange(n) / rate))
    return (0.5 * x / max(np.abs(x).max(initial=0), 1e-12)).astype(np.float32)


def clap(n: int, seed: int, rate: int = RATE) -> np.ndarray:
    """A burst of noise that decays by half every 5 ms."""
    x = np.random.default_rng(seed).standard_normal(n) * 0.5 ** (np.arange(n) / (0.005 * rate))
    return (0.9 * x / max(np.abs(x).max(initial=0), 1e-12)).astype(np.float32)


def bleed(x: np.ndarray, delay: int, db: float) -> np.ndarray:
    """The signal as another microphone hears it: later and weaker, of the same length."""
    out = np.zeros_like(x)
    out[delay:] = x[: len(x) - delay] * 10 ** (db / 20)
    return out


def floor_noise(n: int, seed: int, db: float = -70) -> np.ndarray:
    return (np.random.default_rng(seed).standard_normal(n) * 10 ** (db / 20)).astype(np.float32)
