"""Transcription around its plugin: retries, stitches, alignment, groups, drafts, documents."""

import json
import math
import random

import numpy as np

from tidewright.operators import transcript as T
from tidewright.plans import queries

SECOND = T.RATE


def request(n=40 * SECOND, pad=SECOND // 2):
    return T.Request("r", "a", (pad, n - pad), (0, n), np.ones(n, np.float32))


def words(n, step=SECOND):
    return [("a", i * step, i * step + step - 1, f"w{i}") for i in range(n)]


def test_a_truncated_request_is_split_until_it_fits():
    out = T.resolve(request(), T.Script(words(40), 15), 40 * SECOND, SECOND // 2, 2 * SECOND, 8)
    assert not out.truncated and {w.text for w in out.words} == {f"w{i}" for i in range(40)} and out.spent == 6 and len(out.ids) == 7


def test_the_original_stands_when_retries_end():
    model = T.Script(words(40), 3)
    out = T.resolve(request(), model, 40 * SECOND, SECOND // 2, 2 * SECOND, 4)
    assert out.truncated and out.text == "w0 w1 w2" and out.note == "retries_spent" and out.spent == 4
    short = T.Request("r", "a", (0, SECOND), (0, SECOND), np.ones(SECOND, np.float32))
    out = T.resolve(short, T.Script(words(40, 100), 3), SECOND, 0, 2 * SECOND, 4)
    assert out.truncated and out.note == "too_short_to_split" and out.spent == 0


def test_it_splits_where_it_is_quiet():
    audio = np.ones(20 * SECOND, np.float32)
    audio[7 * SECOND : 7 * SECOND + 1024] = 0
    assert T.quietest(audio, 0, (0, 20 * SECOND), 2 * SECOND) in range(7 * SECOND - 512, 7 * SECOND + 640)
    assert T.quietest(np.ones(20 * SECOND, np.float32), 0, (0, 20 * SECOND), 2 * SECOND) == 312 * 512
    assert T.quietest(audio, 0, (0, 4 * SECOND), 2 * SECOND) is None


def test_transcribe_in_spark(spark):
    rows = [(f"r{i}", t, 0, 4 * SECOND, 0, 4 * SECOND, [0.0] * (4 * SECOND)) for i, t in enumerate("ab")]
    df = spark.createDataFrame(rows, "request_id string, track_id string, core_start long, core_end long, padded_start long, padded_end long, samples array<float>")
    script = words(4)
    got = {r["request_id"]: r for r in T.transcribe(df, lambda: T.Script(script), 4 * SECOND, 0, SECOND).collect()}
    assert got["r0"]["text"] == "w0 w1 w2 w3" and got["r1"]["text"] == "" and got["r0"]["words"][1]["start"] == SECOND


def test_alignment_columns_and_values(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(60):
        t, own = 0.0, []
        for j in range(rng.randrange(6)):
            t += rng.choice([0.08, 0.1234, 1.0, 0.0, 0.0, -0.05 if i % 7 == 0 else 0.3])
            own.append((round(t, 4), round(t + rng.choice([0, 0.08, 0.5]), 4), rng.choice(["x", " y ", "", "z"])))
        if i % 11 == 0 and own:
            own[-1] = (99.0, 99.5, "late")
        want |= {(i, j): w for j, w in enumerate(T.decode_alignment(own, 100, 100 + 5 * T.RATE))}
        rows += [(i, j, str(a), str(b), w) for j, (a, b, w) in enumerate(own)]
    df = spark.createDataFrame(rows, "i long, j long, start_s string, end_s string, text string")
    from pyspark.sql import functions as F

    got: dict = {}
    for r in T.alignment(df, "i", "j", F.lit(100), F.lit(100 + 5 * T.RATE)).orderBy("i", "j").collect():
        got.setdefault(r["i"], []).append(T.Word(r["start"], r["end"], r["text"]))
    assert {(i, j): w for i, ws in got.items() for j, w in enumerate(ws)} == want
    assert T.decode_alignment([(math.nan, 1, "a")], 0, 10**6) == [] and T.decode_alignment([(1.0, 1.0, "a")], 0, 10**6) == [T.Word(16000, 16001, "a")]


def test_groups_like_union_find(spark):
    rng = random.Random(2)
    rows = []
    for t in "ab":
        for r in range(40):
            first = rng.randrange(60)
            rows += [(t, k, f"{t}{r}", r % 3 == 0) for k in range(first, first + rng.randrange(1, 5))]
    parent = {(t, k): (t, k) for t, k, _, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for t, k, r, wordless in rows:
        if wordless:
            a, b = sorted((find((t, k)), find((t, min(q for u, q, s, _ in rows if s == r)))))
            parent[b] = a
    got = {(x["t"], x["k"]): x["group_rank"] for x in T.candidate_groups(spark.createDataFrame(rows, "t string, k long, r string, w boolean"), "t", "k", "r", "w").collect()}
    assert got == {x: find(x)[1] for x in parent}


def test_boundary_repeats(spark):
    w = lambda a, b, t: {"start": a, "end": b, "text": t}
    rows = [(1, 0, [w(0, 10, "No"), w(10, 22, "Zephyr,")]), (1, 1, [w(20, 30, "zephyr")]), (1, 2, [w(25, 40, "zephyr")]), (1, 3, [w(41, 50, "zephyr")]), (2, 0, []), (2, 1, [w(1, 2, "a")])]
    got = T.boundary_repeats(spark.createDataFrame(rows, f"c long, o long, words {T.WORDS}"), ["c"], "o").collect()
    assert {(r["c"], r["o"]): [x["text"] for x in r["words"]] for r in got} == {(1, 0): ["No", "Zephyr,"], (1, 1): [], (1, 2): ["zephyr"], (1, 3): ["zephyr"], (2, 0): [], (2, 1): ["a"]}


def test_drafts_and_document(spark):
    w = lambda a, b, t: {"start": a, "end": b, "text": t}
    rows = [
        ("g", 1, 0, 50, "aligned", "x", [w(30, 45, "there")]), ("g", 0, 0, 50, "aligned", "x", [w(5, 20, "hello ")]),
        ("h", 0, 7, 90, "segment_only", "two  words", []), ("h", 1, 90, 95, "aligned", "more", [w(91, 92, "more")]), ("i", 0, 0, 5, "aligned", "lost", []),
    ]
    df = spark.createDataFrame(rows, f"g string, ordinal long, ownership_start long, ownership_end long, alignment string, text string, words {T.WORDS}")
    got = {r["g"]: r for r in T.drafts(df, ["g"]).collect()}
    assert set(got) == {"g", "h"}
    assert (got["g"]["start"], got["g"]["end"], got["g"]["text"], got["g"]["alignment"]) == (5, 45, "hello there", "aligned")
    assert (got["h"]["start"], got["h"]["end"], got["h"]["text"], got["h"]["alignment"], got["h"]["words"]) == (7, 95, "two words more", "segment_only", [])
    from pyspark.sql import functions as F

    turns = T.drafts(df, ["g"]).withColumns({"segment_id": F.col("g"), "speaker_id": F.lit("s"), "overlap": F.lit(False)})
    doc = {r["segment_id"]: json.loads(r["document"]) for r in T.transcript_json(turns, 1000).collect()}
    assert doc["g"]["start_s"] == 0.005 and doc["g"]["words"][1] == {"start_s": 0.03, "end_s": 0.045, "text": "there"}


def test_draft_segment_takes_every_turn(spark, tmp_path):
    turns = [(1, i, "user", f"w{i}") for i in range(50)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    (got,) = queries()["draft_segment"](spark, str(tmp_path)).collect()
    assert tuple(got) == (1, 5, 4985, " ".join(f"w{i}" for i in range(50)), "aligned")
