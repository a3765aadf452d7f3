"""A generated session from its WAV files to transcript, mix and report, against what is true of it."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.operators import activity as D
from tidewright.operators import transcript as T
from tidewright.plans import chain
from tidewright.sources import fixtures, recordings, riff

N = fixtures.RATE


@pytest.fixture(scope="module")
def session(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("session"))
    spec = fixtures.canonical()
    return spec, folder, fixtures.write(spec, folder)


def models(truth):
    script = [(str(t), a // 3, b // 3, w) for t, a, b, w in truth["words"]]
    return lambda: T.Script(script)


@pytest.fixture(scope="module")
def run(spark, session, tmp_path_factory):
    _, folder, truth = session
    out = str(tmp_path_factory.mktemp("out"))
    return chain.run(spark, folder, out, D.Energy, models(truth)), out


def read_wav(path):
    with open(path, "rb") as f:
        rate, channels, bits, floating, offset, size = riff.head(f.read(4096))
        assert (rate, channels, bits, floating) == (N, 1, 32, True)
        return riff.read_samples(f, offset, bits, floating, channels, 0, size // 4)


def test_sources_and_timeline(spark, session):
    spec, folder, truth = session
    found = recordings.inspect(spark, folder)
    assert all(not r["wrong"] and r["rate"] == N and r["variant"] == "orig" for r in found.collect())
    entries, length = chain.timeline(found.withColumn("track", F.col("tx").cast("long")))
    assert sorted((r["track"], r["placed"], r["samples"]) for r in entries.collect()) == truth["placements"] and length == spec.seconds * N


def test_windows_hold_what_the_microphones_heard(spark, session):
    """Over chunk borders and gaps, every sample in its place; silence where a track has no file."""
    spec, folder, _ = session
    entries, length = chain.timeline(recordings.inspect(spark, folder).withColumn("track", F.col("tx").cast("long")))
    got = {}
    for r in recordings.track_windows(entries, 100_000, length).collect():
        got.setdefault(r["track"], {})[r["window"]] = np.array(r["samples"], np.float32)
    for track in (1, 2, 3):
        want = np.zeros(length, np.float32)
        heard = fixtures.render(spec, track)
        for c in (c for c in spec.chunks if c.track == track):
            want[c.start : c.start + c.length] = heard[c.start : c.start + c.length]
        np.testing.assert_array_equal(np.concatenate([got[track][i] for i in sorted(got[track])]), want)


def test_cut_and_powers_match_the_samples(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2, 1000)).astype(np.float32)
    windows = spark.createDataFrame([(t, i, x[t, i * 300 : (i + 1) * 300].tolist()) for t in (0, 1) for i in range(4)], "track long, window long, samples array<float>")
    spans = [(0, 0, 0, 1), (1, 1, 250, 950), (2, 0, 299, 301), (3, 1, 300, 600)]
    df = spark.createDataFrame(spans, "id long, track long, start long, end long")
    got = {r["id"]: r["samples"] for r in recordings.cut(df, windows, 300).collect()}
    power = {r["id"]: r["power"] for r in recordings.powers(df, windows, 300).collect()}
    for i, t, a, b in spans:
        np.testing.assert_array_equal(np.array(got[i], np.float32), x[t, a:b])
        assert power[i] == pytest.approx(float((x[t, a:b].astype(float) ** 2).mean()))


def test_speech_is_found_and_bleed_is_not_kept(run, session):
    report, out = run
    _, _, truth = session
    docs = [json.loads(line) for name in sorted(os.listdir(f"{out}/transcript")) if name.endswith(".txt") for line in open(f"{out}/transcript/{name}")]
    said = {}
    for d in docs:
        said.setdefault(int(d["speaker_id"]), []).extend((w["start_s"], w["text"]) for w in d["words"])
    want = {}
    for t, a, _, w in truth["words"]:
        want.setdefault(t, []).append((a / N, w))
    assert {t: [w for _, w in sorted(v)] for t, v in said.items()} == {t: [w for _, w in sorted(v)] for t, v in want.items()}
    for t, v in said.items():
        assert all(abs(a - b) <= 0.001 for (a, _), (b, _) in zip(sorted(v), sorted(want[t]), strict=True))
    assert any(d["overlap"] for d in docs) and not all(d["overlap"] for d in docs)
    assert report["status"] == "complete" and report["exit_code"] == 0 and set(report["deliverables"]) == {"mix.wav", "transcript"}


def test_mix_follows_the_speakers(run, session):
    report, out = run
    spec, _, truth = session
    x = read_wav(f"{out}/mix.wav").astype(float)
    assert len(x) == spec.seconds * N
    loud = [d for d in report["decisions"] if d["code"] == "mix_loudness"]
    assert loud and loud[0]["lufs_mb"] is not None
    rms = lambda a, b: np.sqrt((x[a:b] ** 2).mean())
    for t, a, b in truth["speech"]:
        assert rms(a + N // 2, b) > 20 * rms(20 * N, 22 * N)
        own = fixtures.render(spec, t)[a + N // 2 : b].astype(float)
        part = x[a + N // 2 : b]
        assert abs(own @ part) / np.sqrt((own @ own) * (part @ part)) > 0.6


def test_a_second_run_takes_what_is_there_and_a_failed_branch_leaves_the_other(spark, session, run):
    _, folder, truth = session
    report, out = run

    class Broken:
        def transcribe(self, request):
            raise RuntimeError("no model")

    class Never:
        def probabilities(self, track, start, samples):
            raise AssertionError("the detector's result is cached")

    again = chain.run(spark, folder, out, Never, models(truth))
    assert again["deliverables"] == report["deliverables"]
    other = chain.run(spark, folder, out + "-broken", D.Energy, Broken)
    assert other["status"] == "partial" and set(other["deliverables"]) == {"mix.wav"} and other["exit_code"] == 2
    assert {s["stage"]: s["status"] for s in other["stages"]}["transcript"] == "failed"
    assert json.load(open(f"{out}-broken/report.json"))["status"] == "partial"


def test_detectors(spark):
    size = D.FRAME * 4
    windows = spark.createDataFrame([(7, i, [0.1 if i else 0.0] * size) for i in range(3)], "track long, window long, samples array<float>")
    p = {r["frame"]: r["p"] for r in D.frames(windows, size, D.Energy).collect()}
    assert [p[i] for i in range(12)] == [0] * 4 + [1000] * 8
    spans = D.Spans(((7, 100, 100 + 2 * D.FRAME, 0.5), (8, 0, 10**6, 1.0)))
    p = {r["frame"]: r["p"] for r in D.frames(windows, size, lambda: spans).collect()}
    assert [p[i] for i in range(4)] == [402, 500, 98, 0]
    with pytest.raises(Exception, match="detector_contract"):
        D.frames(windows, size, lambda: type("Bad", (), {"probabilities": lambda self, t, a, x: np.array([2.0])})()).count()


def test_odd_sources_are_told_of_and_left_out(spark, session, tmp_path):
    spec, folder, truth = session
    for name in os.listdir(folder):
        os.link(f"{folder}/{name}", tmp_path / name)
    (tmp_path / "TX09_MIC001_20240101_100000_orig.wav").write_bytes(b"RIFF....")
    (tmp_path / "holiday.wav").write_bytes(open(f"{folder}/{sorted(os.listdir(folder))[0]}", "rb").read())
    report = chain.Report("s")
    kept = chain.sources_of(spark, str(tmp_path), report)
    assert kept.count() == len(spec.chunks) and sorted(d["name"] for d in report.decisions) == ["TX09_MIC001_20240101_100000_orig", "holiday"]
