"""Stateful processors give what the batch operators give, wherever the input is cut; order is held."""

import random

import pytest

from tests.test_streaming import write
from tidewright.operators import intervals as I
from tidewright.operators import sequences as S
from tidewright.streaming import processors as P

FRAMES = "track long, frame long, p int, last boolean"
SCORES = "track long, at long, score int, last boolean"


def cut(rows, seed, n=4):
    """The rows in their order, in n batches."""
    rng = random.Random(seed)
    edges = [0, *sorted(rng.sample(range(1, len(rows)), n - 1)), len(rows)]
    return [rows[a:b] for a, b in zip(edges, edges[1:], strict=False)]


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_of_speech(spark, tmp_path, seed):
    rng = random.Random(seed)
    n = {1: 40, 2: 25, 3: 1}
    rows = [(t, f, rng.choice([0, 200, 400, 600, 1000]), f == n[t] - 1) for f in range(40) for t in (1, 2, 3) if f < n[t]]
    got = P.drained(P.speech_runs(write(spark, str(tmp_path / "in"), cut(rows, seed), FRAMES), "track", "frame", "p", 500, 350))
    batch = I.active_runs(I.hysteresis(spark.createDataFrame(rows, FRAMES), ["track"], "frame", "p", 500, 350), ["track"], "frame")
    want = sorted((r["track"], r["start"], r["end"]) for r in batch.collect())
    assert sorted((r["track"], r["start"], r["end"]) for r in got.collect()) == want and want


@pytest.mark.parametrize("seed", [3, 4])
def test_peaks(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(t, at, rng.randint(0, 999), False) for t in (1, 2) for at in sorted(rng.sample(range(0, 900), 60))] + [(t, 1000, 0, True) for t in (1, 2)]
    rows.sort(key=lambda r: (r[1], r[0]))
    got = P.drained(P.peaks(write(spark, str(tmp_path / "in"), cut(rows, seed), SCORES), "track", "at", "score", 300, 20))
    batch = S.peak_pick(spark.createDataFrame(rows, SCORES), ["track"], "at", "score", 300, 20)
    want = sorted((r["track"], r["at"], r["score"]) for r in batch.collect())
    assert sorted((r["track"], r["at"], r["score"]) for r in got.collect()) == want and len(want) > 20


@pytest.mark.parametrize(("batches", "code"), [
    ([[(1, 0, 0, False)], [(1, 2, 0, True)]], "a gap"), ([[(1, 0, 0, False), (1, 1, 0, False)], [(1, 1, 0, True)]], "came again"), ([[(1, 0, 0, True)], [(1, 1, 0, False)]], "after the end"),
])
def test_order_is_held(spark, tmp_path, batches, code):
    with pytest.raises(Exception, match=f"(?s)stream_order.*{code}"):
        P.drained(P.speech_runs(write(spark, str(tmp_path / "in"), batches, FRAMES), "track", "frame", "p", 500, 350)).count()


def test_the_session_is_as_it_was(spark):
    before = spark.conf.get(P._PROVIDER, None)
    with P.rocksdb(spark):
        assert spark.conf.get(P._PROVIDER).endswith("RocksDBStateStoreProvider")
    assert spark.conf.get(P._PROVIDER, None) == before
