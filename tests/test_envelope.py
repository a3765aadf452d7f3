"""The envelope against a walk over every control frame, for any length of window; corrections against the rule."""

import numpy as np
import pytest

from tidewright.operators import envelope as E

SHAPE = E.Shape(rise=0.25, fall=0.04)


def walk(spans, tracks, gains, count, shape):
    """All frames' applied gains, one frame after another."""
    p, out = np.zeros(len(tracks)), []
    for k in range(count):
        target = np.array([max((w for t, a, b, w in spans if t == track and a <= k < b), default=0.0) for track in tracks])
        p = np.minimum(np.maximum(target, p - shape.fall), p + shape.rise)
        share = np.maximum(p, shape.room)
        out.append(share / share.sum() * gains)
    return np.array(out)


def made(spark, spans, tracks, gains, count, per, shape=SHAPE):
    active = spark.createDataFrame(spans, "track long, start long, end long, weight double")
    own = spark.createDataFrame([(t,) for t in tracks], "track long")
    levels = spark.createDataFrame(list(zip(tracks, gains.tolist(), strict=True)), "track long, gain double")
    got, before = np.full((count, len(tracks)), np.nan), {}
    for r in E.applied(E.segments(active, own, count, 64, shape), levels, count, per, shape).collect():
        i = tracks.index(r["track"])
        got[r["window"] * per : r["window"] * per + len(r["gains"]), i] = r["gains"]
        before[r["window"], i] = r["before"]
    return got, before


@pytest.mark.parametrize("per", [1, 7, 50, 1000])
def test_any_window_gives_the_gains_of_a_walk(spark, per):
    rng = np.random.default_rng(4)
    tracks, count = [3, 5, 9], 211 if per > 1 else 40
    spans = [(t, a, a + int(rng.integers(1, 30)), float(w)) for t in tracks[:2] for a, w in zip(np.sort(rng.integers(0, count, 9)).tolist(), rng.uniform(0.5, 1, 9), strict=True)]
    gains = np.array([1.0, 1.3, 0.8])
    want = walk(spans, tracks, gains, count, SHAPE)
    got, before = made(spark, spans, tracks, gains, count, per)
    np.testing.assert_allclose(got, want, atol=1e-12)
    rest = np.maximum(np.zeros(3), SHAPE.room)
    for (w, i), b in before.items():
        assert b == pytest.approx(want[w * per - 1, i] if w else (rest / rest.sum() * gains)[i], abs=1e-12)


def test_nobody_speaks(spark):
    got, _ = made(spark, [(1, 500, 600, 1.0)], [1, 2], np.ones(2), 100, 30)
    np.testing.assert_allclose(got, 0.5)


def test_gains_beyond_the_bound_are_an_error(spark):
    with pytest.raises(Exception, match="envelope_invariant_violated"):
        made(spark, [(1, 0, 50, 1.0)], [1, 2], np.array([4.0, 1.0]), 100, 30)


def test_corrections(spark):
    tracks = spark.createDataFrame([(i,) for i in range(1, 6)], "track long")
    references = spark.createDataFrame([(1, -2000), (2, -2300), (3, -3500), (4, -1900)], "track long, reference int")
    got = {r["track"]: (r["correction_mb"], r["note"]) for r in E.corrections(references, tracks).collect()}
    # of four the upper one of the two in the middle
    assert got == {1: (0, None), 2: (300, None), 3: (600, "mix_level_correction_clamped"), 4: (-100, None), 5: (0, "mix_level_uncorrected")}
    assert {r["gain"] for r in E.corrections(references.limit(0), tracks).collect()} == {1.0}


def test_spans_cover_their_samples_and_weigh_by_score(spark):
    r = E.spans(spark.createDataFrame([(1, 47, 97, 800)], "track long, start long, end long, total int"), 48).first()
    assert (r["start"], r["end"]) == (0, 3) and r["weight"] == pytest.approx(0.9)


def test_a_session_is_one_signal(spark):
    """From candidates in samples: one speaker gets all but the room's share, two share by their scores, and every frame is covered."""
    tracks = spark.createDataFrame([(1,), (2,)], "track long")
    retained = spark.createDataFrame([(1, 0, 48000, 1000), (2, 24000, 48000, 1000)], "track long, start long, end long, total int")
    levels = E.corrections(spark.createDataFrame([], "track long, reference int"), tracks)
    got = {(r["track"], r["window"]): r["gains"] for r in E.envelope(retained, tracks, levels, 50_000, 48, 500).collect()}
    assert sum(len(v) for (t, _), v in got.items() if t == 1) == -(-50_000 // 48)
    assert got[1, 0][400] == pytest.approx(1 / 1.005) and got[1, 1][400] == pytest.approx(0.5)
