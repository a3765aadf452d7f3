"""Operators of the session analytics against brute force, and round trips of sources and sinks."""

import itertools
import json
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright import streaming
from tidewright.functions import quantize as Q
from tidewright.functions import text as X
from tidewright.functions import timecode as T
from tidewright.operators import intervals as I
from tidewright.operators import sequences as S
from tidewright.operators import signal as G
from tidewright.plans import queries, registry
from tidewright.sources import files, riff


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_islands_and_hysteresis(spark):
    rng = random.Random(0)
    data = [(k, f, rng.randrange(1000)) for k in range(5) for f in range(200)]
    got = rows(I.hysteresis(spark.createDataFrame(data, "k long, f long, p int"), ["k"], "f", "p", 700, 300).select("k", "f", "active"))
    want, active, last = [], False, None
    for k, f, p in data:
        active = False if k != last else active
        active, last = (True if p >= 700 else False if p < 300 else active), k
        want.append((k, f, active))
    assert sorted(got) == want


@pytest.mark.parametrize(("gap", "strict"), [(0, False), (5, False), (5, True)])
def test_islands_match_a_sweep(spark, gap, strict):
    rng = random.Random(gap)
    data = [(rng.randrange(3), a, a + rng.randrange(1, 20)) for a in (rng.randrange(500) for _ in range(150))]
    want = []
    for k in range(3):
        for _, a, b in sorted(x for x in data if x[0] == k):
            if want and want[-1][0] == k and ((a - want[-1][2] < gap) if strict else (a - want[-1][2] <= gap)):
                want[-1][2] = max(want[-1][2], b)
            else:
                want.append([k, a, b])
    got = rows(I.islands(spark.createDataFrame(data, "k long, start long, end long"), ["k"], "start", "end", gap, strict))
    assert sorted(got) == [tuple(w) for w in want]


def test_overlap_join_matches_all_pairs_and_has_no_nested_loop(spark):
    rng = random.Random(1)
    data = [(i, a, a + rng.choice([1, 3, 40, 400])) for i, a in enumerate(rng.randrange(-500, 2000) for _ in range(200))]
    df = spark.createDataFrame(data, "id long, start long, end long")
    pairs = I.overlap_join(df, df, 32, on=F.col("l.id") < F.col("r.id"))
    want = sorted((a[0], b[0]) for a, b in itertools.combinations(data, 2) if a[1] < b[2] and b[1] < a[2])
    assert sorted(rows(pairs.select("l.id", "r.id"))) == want
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nearest_rank(spark):
    rng = random.Random(2)
    data = [(k, rng.randrange(50)) for k in range(1, 40) for _ in range(k)]
    got = {k: v for k, v, _ in rows(I.nearest_rank(spark.createDataFrame(data, "k long, v long"), ["k"], "v", 0.75, "r"))}
    assert got == {k: sorted(v for j, v in data if j == k)[int(np.rint((k - 1) * 0.75))] for k in range(1, 40)}


def test_layout_matches_a_sequential_placement(spark):
    rng = random.Random(3)
    data = [(k, i, rng.randrange(60), rng.randrange(1, 15)) for k in range(20) for i in range(6)]
    got = sorted(rows(I.layout(spark.createDataFrame(data, "k long, i long, s long, n long"), ["k"], ["s", "i"], "s", "n").select("k", "s", "i", "placed", "gap", "overlap")))
    want = []
    for k in range(20):
        end = None
        for _, i, s, n in sorted((x for x in data if x[0] == k), key=lambda x: (x[2], x[1])):
            placed = s if end is None else max(s, end)
            want.append((k, s, i, placed, 0 if end is None else placed - end, 0 if end is None else max(0, end - s)))
            end = placed + n
    assert got == sorted(want)


def test_quantizers(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (7, 3), (-7, 3), (0, 9)], "a long, b long")
    assert rows(df.select(Q.round_half_away(F.col("a"), F.col("b")), Q.floor_div(F.col("a"), F.col("b")), Q.ceil_div(F.col("a"), F.col("b")))) == [(3, 2, 3), (-3, -3, -2), (2, 2, 3), (-2, -3, -2), (0, 0, 0)]
    big = spark.createDataFrame([(2**61 + 1, 3)], "a long, b long")
    assert rows(big.select(Q.floor_div(F.col("a"), F.col("b")), Q.round_half_away(F.col("a"), F.col("b"), wide=True))) == [((2**61 + 1) // 3, (2**61 + 1) // 3)]
    p = spark.createDataFrame([(0.0005,), (-0.0005,), (float("nan"),), (2.0,)], "x double")
    assert [r[0] for r in rows(p.select(Q.signed_permille(F.col("x"))))] == [1, -1, 0, 2000]


def test_timecode_errors(spark):
    cases = [("01:02:03:04", "25F", None), ("01:02:03;04", "25F", "drop_notation"), ("1:2:3:4", "25F", "malformed"), ("24:00:00:00", "30F", "out_of_range"), ("00:01:00;01", "29.97DF", "dropped_frame"), ("00:10:00;01", "29.97DF", None), (None, "30F", "malformed"), ("01:02:03,04", "30F", "malformed"), ("01:02:03:04", "29.97DF", None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i long, t string, r string, e string").withColumn("rate", T.frame_rate(F.col("r"))).withColumn("tc", T.parse(F.col("t"), F.col("rate")))
    got = df.orderBy("i").select("tc.error", "e", T.frame_index(F.col("tc"), F.col("rate"))).collect()
    assert all(r[0] == r[1] for r in got) and got[0][2] == 3723 * 25 + 4 and got[5][2] == 600 * 30 + 1 - 2 * 9


def test_pack_and_slew(spark):
    got = sorted(rows(S.pack_cap(spark.createDataFrame([(1, 0, 5), (1, 6, 9), (1, 9, 14), (2, 3, 4)], "k long, s long, e long"), ["k"], "s", "e", 10)))
    assert [r[3] for r in got] == [0, 0, 1, 0]
    slew = sorted(rows(S.slew_limit(spark.createDataFrame([(1, i, v) for i, v in enumerate([1.0, 1.0, 0.0])], "k long, f long, t double"), ["k"], "f", "t", 0.6, 0.25)))
    assert [r[3] for r in slew] == [0.6, 1.0, 0.75]


def test_collapse_keeps_its_two_guards(spark):
    pair = lambda w, l, score, sim, margin, contains: (1, w, l, score, 900, sim, 600, margin, True, contains)
    data = [pair(1, 2, 900, 900, 50, False), pair(2, 3, 800, 990, 50, True), pair(4, 5, 700, 900, 50, False), pair(6, 4, 600, 900, 50, False), pair(6, 4, 600, 0, 400, True)]
    df = spark.createDataFrame(data, "island long, winner long, loser long, winner_score int, overlap_permille int, similarity int, correlation int, margin int, long_enough boolean, contains boolean")
    assert sorted(rows(S.collapse(df))) == [(1, 2, 1, False), (1, 4, 6, True), (1, 5, 4, False)]


def test_peaks(spark):
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate([5, 9, 8, 1, 9, 7])], "k long, at long, p int")
    assert sorted(r[1] for r in rows(S.peak_pick(df, ["k"], "at", "p", 5, 2))) == [1, 4]


def test_text(spark):
    df = spark.createDataFrame([("Straße,  ＡＢ c", "strasse ab c")], "a string, b string")
    assert rows(df.select(X.comparison_key("a"), X.similarity("a", "b"), X.normalize_text(F.lit("é   x ,y ! ")), X.percent_encode(F.lit("a b/ü")), X.md_escape(F.lit("a*b_[c]")), X.timestamp(F.lit(3723004)))) == [
        ("strasse ab c", 1000, "é x,y!", "a%20b%2F%C3%BC", r"a\*b\_\[c\]", "01:02:03.004")
    ]


def wav(samples, bits=16):
    raw = (np.asarray(samples) * (1 << (bits - 1))).astype("<i4")
    data = raw.astype("<i2").tobytes() if bits == 16 else b"".join(int(x).to_bytes(3, "little", signed=True) for x in raw)
    info = b"LIST" + struct.pack("<I", 4 + 8 + 6) + b"INFO" + b"ICMT" + struct.pack("<I", 5) + b"hello\0"
    body = b"WAVE" + b"fmt " + struct.pack("<IHHIIHH", 16, 1, 1, 48000, 48000 * bits // 8, bits // 8, bits) + info + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def test_riff_wav_and_listing(spark, tmp_path):
    samples = np.arange(-50, 50) / 64
    (tmp_path / "a.WAV").write_bytes(wav(samples))
    (tmp_path / "b.wav").write_bytes(wav(samples, 24))
    (tmp_path / "note.txt").write_text("x")
    inventory = rows(riff.riff_walk(spark, str(tmp_path)).filter("path like '%a.WAV'").orderBy("ordinal").select("depth", "chunk_id", "text"))
    assert [(d, c) for d, c, _ in inventory] == [(0, "fmt "), (0, "LIST"), (1, "ICMT"), (0, "data")] and inventory[2][2] == "hello"
    spark.dataSource.register(riff.WavSource)
    read = spark.read.format("wav").option("paths", "\n".join(str(tmp_path / n) for n in ("a.WAV", "b.wav"))).option("window", "30").load()
    for name in ("a.WAV", "b.wav"):
        got = [x for r in sorted(read.filter(F.col("path").endswith(name)).collect(), key=lambda r: r["window"]) for x in r["samples"]]
        assert np.array_equal(got, samples)
    kinds = {r["name"]: r["kind"] for r in files.scan_files(spark, str(tmp_path)).collect()}
    assert kinds == {"a.WAV": "source", "b.wav": "source", "note.txt": "unexpected_file_type"}
    assert riff.chunks(b"junk") == [] and riff.chunks(wav(samples)[:60])[0][2] == "fmt "


def test_wav_writer_and_json(tmp_path):
    path = str(tmp_path / "out.wav")
    riff.write_wav(path, iter([np.ones(3), np.zeros(2)]), 5, 16000)
    data = (tmp_path / "out.wav").read_bytes()
    rate, _, bits, floating, at, size = riff.head(data)
    assert (rate, bits, floating, size) == (16000, 32, True, 20) and riff.decode(data[at:], 32, True).tolist() == [1, 1, 1, 0, 0]
    with pytest.raises(ValueError, match="refused"):
        riff.write_wav(path, iter([np.ones(3)]), 5, 16000)
    files.write_json(str(tmp_path / "x.json"), {"b": 1, "a": [2]})
    assert json.loads((tmp_path / "x.json").read_text()) == {"a": [2], "b": 1} and [p.name for p in tmp_path.iterdir()].count("x.json") == 1


def test_signal_kernels(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal(64)
    assert G.correlate(x, np.roll(x, 3), 8)[0] == 3 and G.correlate(np.zeros(4), np.zeros(4), 2) == (0, 0)
    assert G.matched(np.concatenate([np.zeros(5), x, np.zeros(5)]), x).argmax() == 5
    taps = G.low_pass(21, 1 / 6)
    whole = rng.standard_normal(100)
    want = G.decimate(whole, taps)
    assert len(want) == 34
    df = spark.createDataFrame([("t", i, whole[i * 30 : i * 30 + 30].tolist()) for i in range(4)], "track string, window long, samples array<double>")
    got = [y for r in sorted(G.decimate_windows(df, ["track"], 30, taps).collect(), key=lambda r: r["window"]) for y in r["samples"]]
    assert np.allclose(got, want)


def test_streaming_hysteresis_equals_batch(spark, tmp_path):
    rng = random.Random(4)
    data = [(k, f, rng.randrange(1000)) for k in range(3) for f in range(90)]
    for part in range(3):
        spark.createDataFrame([r for r in data if r[1] // 30 == part], "k long, f long, p int").coalesce(1).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    stream = streaming.hysteresis(streaming.read_stream(spark, str(tmp_path / "t.parquet")), "k", "f", "p", 700, 300)
    want = rows(I.hysteresis(spark.createDataFrame(data, "k long, f long, p int"), ["k"], "f", "p", 700, 300).select("k", "f", "active"))
    assert sorted(rows(streaming.drain(stream))) == sorted(want)


def test_every_sql_has_a_query():
    assert registry.SQL.keys() <= queries().keys() and len(queries()) > 100


def test_rollover_gap_all_judges_every_event(spark, tmp_path):
    """No event is left out, and a series over midnight turns where its widest gap is."""
    at = [(1, 1, "2024-01-01 23:00:00"), (2, 1, "2024-01-01 23:30:00"), (3, 1, "2024-01-01 01:00:00"), (4, 2, "2024-01-01 08:00:00"), (5, 2, "2024-01-01 09:00:00"), (6, 3, "2024-01-01 00:00:00"), (7, 3, "2024-01-01 12:00:00")]
    spark.createDataFrame(at, "event_id long, user_id long, ts string").withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "events.parquet"))
    got = rows(queries()["rollover_gap_all"](spark, str(tmp_path)).select("event_id", "verdict", "turns"))
    assert sorted(map(tuple, got)) == [(1, "wrapped", 0), (2, "wrapped", 0), (3, "wrapped", 1), (4, "none", 0), (5, "none", 0), (6, "ambiguous", 0), (7, "ambiguous", 0)]
    sf = "/root/testdata/sf0.001"
    assert queries()["rollover_gap_all"](spark, sf).count() == spark.read.parquet(f"{sf}/events.parquet").count()
