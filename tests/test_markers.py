"""Marker waveforms and their detection, against exact arithmetic and planted occurrences."""

from fractions import Fraction

import numpy as np
import pytest

from tidewright.functions import waveform as W
from tidewright.operators import markers as K


def test_waveform_is_a_sweep_of_integers():
    m = W.marker()
    x = W.marker_samples(m)
    assert len(x) == m.total and np.abs(x).max() <= W.PEAK and x[: m.anchor].any() == False  # noqa: E712
    one = W.templates(m)[0]
    assert one[0] == one[-1] == 0
    n = np.arange(m.length)
    f0, f1 = m.chirps[0]
    phase = 2 * np.pi * (n * f0 / W.RATE + (f1 - f0) * n * (n - 1) / 2 / (W.RATE * (m.length - 1)))
    middle = slice(m.fade, m.length - m.fade)
    assert np.abs(one[middle] - W.PEAK * np.sin(phase)[middle]).max() < 2
    assert (W.marker_samples(W.marker("cand-b")) == x).all()


def test_sine_and_rounding():
    for k in range(-9, 40):
        assert abs(Fraction(W.sine(k, 16), 16 * W.SCALE) - Fraction(np.sin(2 * np.pi * k / 16))) < Fraction(1, 10**6)
    assert [W.rounded(n, 2) for n in (-3, -1, 0, 1, 3)] == [-2, -1, 0, 1, 2]


def test_unknown_marker():
    with pytest.raises(ValueError):
        W.marker("none")


def test_page_holds_the_wav_once(tmp_path):
    manifest = W.build_marker(str(tmp_path), "cand-c")
    wav = (tmp_path / "cand-c.wav").read_bytes()
    assert W.page_payload((tmp_path / "cand-c.html").read_text()) == wav
    assert manifest["samples"] * 2 + 44 == len(wav)
    assert W.build_marker(str(tmp_path), "cand-c") == manifest
    with pytest.raises(ValueError):
        W.page_payload("<p>")


def test_occurrences_are_found_where_they_were_planted(spark):
    m = W.marker("cand-c")
    x = W.marker_samples(m) / 32768
    size, rows, want = 30_000, [], set()
    for track, places in (("a", (11_000, 141_234)), ("b", (95_111,)), ("c", ())):
        y = W.floor_noise(240_000, ord(track), -50).astype(float)
        for p in places:
            y[p : p + len(x)] += 0.3 * x
            want.add((track, p + m.anchor))
        rows += [(track, i, y[s : s + size].astype(np.float32).tolist()) for i, s in enumerate(range(0, len(y), size))]
    windows = spark.createDataFrame(rows, "track string, window long, samples array<float>")
    got = K.detect(windows, ["track"], size, m).collect()
    assert {(r["track"], r["anchor"]) for r in got} == want
    assert all(max(map(abs, r["gap_errors"])) <= 1 and r["score"] > 900 and not r["clipped"] and not r["ambiguous"] for r in got)


def test_nms_like_the_greedy_fold(spark):
    rng = np.random.default_rng(3)
    rows = [(int(t), int(a), int(s)) for t, a, s in zip(rng.integers(0, 3, 300), rng.choice(200_000, 300, replace=False), rng.integers(300, 400, 300), strict=True)]
    got = {tuple(r) for r in K.sequence_nms(spark.createDataFrame(rows, "track long, anchor long, score long"), ["track"]).select("track", "anchor", "score").collect()}
    want = set()
    for t, a, s in sorted(rows, key=lambda r: (-r[2], r[1])):
        if all(o[0] != t or abs(o[1] - a) > K.SEQUENCE_RADIUS for o in want):
            want.add((t, a, s))
    assert got == want


def test_seeded_sounds():
    a = W.speech_like(4800, 1)
    assert (a == W.speech_like(4800, 1)).all() and abs(np.abs(a).max() - 0.5) < 1e-6
    assert np.abs(W.clap(4800, 2)[:240]).max() > 10 * np.abs(W.clap(4800, 2)[-240:]).max()
    b = W.bleed(a, 100, -20)
    assert (b[:100] == 0).all() and np.allclose(b[100:], a[:-100] * 0.1)
