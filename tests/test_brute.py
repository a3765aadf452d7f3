"""Registered queries that SQL can't state, over their whole tables, against plain versions."""

import difflib
import unicodedata

import numpy as np
import pytest

from tidewright.operators import signal as G
from tidewright.operators import syncqa as Y
from tidewright.plans import queries
from tidewright.plans.registry import read

SF = "/root/testdata/sf0.001"


def rows(spark, name):
    return [r.asDict(recursive=True) for r in queries()[name](spark, SF).collect()]


@pytest.fixture(scope="module")
def turns(spark):
    return {(r["conv_id"], r["turn"]): r["text"] for r in read(spark, SF, "conversations").collect()}


@pytest.fixture(scope="module")
def vectors(spark):
    return {r["vec_id"]: np.array(r["embedding"], float) for r in read(spark, SF, "embeddings").collect()}


def key_of(text):
    out = []
    for c in unicodedata.normalize("NFKC", text or "").casefold():
        out.append(c if c.isalnum() or c == "_" else " ")
    return " ".join("".join(out).split())


def test_keys_and_word_counts(spark, turns):
    assert {(r["conv_id"], r["turn"]): r["key"] for r in rows(spark, "comparison_key")} == {k: key_of(t) for k, t in turns.items()}
    assert {(r["conv_id"], r["turn"]): r["n"] for r in rows(spark, "word_count")} == {k: len(key_of(t).split()) for k, t in turns.items()}


def test_similarity_of_documents_that_share_eight_words(spark):
    docs = {r["doc_id"]: r["text"] for r in read(spark, SF, "documents").collect() if r["text"] is not None}
    least = {}
    runs = {i: {tuple(w[k : k + 8]) for k in range(len(w) - 7)} for i, w in ((i, key_of(t).split()) for i, t in docs.items())}
    for i in sorted(runs):
        for run in runs[i]:
            least.setdefault(run, i)
    pairs = {(least[run], i) for i in runs for run in runs[i] if least[run] != i}
    want = {}
    for a, b in pairs:
        x, y = key_of(docs[a]).split(), key_of(docs[b]).split()
        want[a, b] = int(min(difflib.SequenceMatcher(None, p, q, autojunk=False).ratio() for p, q in ((x, y), (y, x))) * 1000 + 0.5)
    assert {(r["a"], r["b"]): r["permille"] for r in rows(spark, "similarity")} == want and want


def permille(v):
    return int(np.floor(abs(v) * 1000 + 0.5))


def test_lags(spark, vectors):
    for r in rows(spark, "xcorr_lag"):
        x, y = vectors[r["vec_id"]], vectors[r["vec_id"] + 1]
        norm = np.sqrt((x @ x) * (y @ y))
        best = max(range(-16, 17), key=lambda k: (permille(sum(x[i] * y[i + k] for i in range(64) if 0 <= i + k < 64) / norm), -k))
        assert r["lag"] == best


def test_filters(spark, vectors):
    t = np.array([1.0, -1.0, 2.0, 0.5])
    for r in rows(spark, "matched_filter"):
        x = vectors[r["vec_id"]]
        want = [permille((x[i : i + 4] @ t) / np.sqrt((x[i : i + 4] @ x[i : i + 4]) * (t @ t))) for i in range(61)]
        assert all(abs(a - b) <= 1 for a, b in zip(r["scores"], want, strict=True))
    for name, taps, factor in (("band_limit", G.low_pass(15, 0.2), 1), ("decimate_3to1", G.low_pass(31, 1 / 6), 3)):
        half = len(taps) // 2
        for r in rows(spark, name):
            x = vectors[r["vec_id"]]
            want = [sum(taps[j] * x[i + half - j] for j in range(len(taps)) if 0 <= i + half - j < 64) for i in range(0, 64, factor)]
            np.testing.assert_allclose(r["y"], want, atol=1e-12)


def test_peaks_of_whole_time_lines(spark):
    best = {}
    for r in read(spark, SF, "events").selectExpr("user_id % 6 as track", "unix_micros(cast(ts as timestamp)) div 60000000 as at", "cast(least(1000, floor(value / 490.0 * 1000 + 0.5)) as int) as p").collect():
        best[r["track"], r["at"]] = max(best.get((r["track"], r["at"]), 0), r["p"])
    want = set()
    for track in range(6):
        kept = []
        for p, at in sorted(((p, at) for (t, at), p in best.items() if t == track and p >= 100), key=lambda x: (-x[0], x[1])):
            if all(abs(at - k) > 30 for k in kept):
                kept.append(at)
                want.add((track, at, p))
    assert {(r["track"], r["at"], r["p"]) for r in rows(spark, "peak_pick")} == want


def test_sync_checks(spark, vectors):
    ids = sorted(vectors)
    want = {}
    for v in ids[1:]:
        found = []
        for position, a in (("start", 0), ("end", 32)):
            x, y = vectors[ids[0]][a : a + 32], vectors[v][a : a + 32]
            c = {k: sum(x[i] * y[i + k] for i in range(32) if 0 <= i + k < 32) for k in range(-8, 9)}
            lag = max(c, key=lambda k: (round(abs(c[k]), 12), -k))
            r = abs(c[lag]) / np.sqrt((x @ x) * (y @ y))
            found.append((position, lag, r, "sync_qa_measured" if r >= 0.4 else "sync_qa_low_confidence"))
        sure = [f[1] for f in found if f[3] == "sync_qa_measured"]
        codes = {"sync_qa_low_confidence"} if len(sure) < 2 else set()
        codes |= {"timecode_disagreement"} if any(abs(k) > 2 for k in sure) else set()
        codes |= {"clock_drift_suspected"} if len(sure) == 2 and abs(sure[1] - sure[0]) > 4 else set()
        for position, lag, r, outcome in found:
            want[v, position] = (lag, int(np.floor(r * 1000 + 0.5)), outcome, ",".join(sorted(codes)))
    got = {(r["track"], r["position"]): (r["lag"], r["permille"], r["outcome"], r["codes"]) for r in rows(spark, "sync_qa")}
    assert got == want and len({o[2] for o in want.values()}) > 1


def test_sync_warnings(spark):
    """A constant lag disagrees with the timecode, a changing one also with itself; a weak or silent window raises neither."""
    rng = np.random.default_rng(0)
    x = {p: rng.standard_normal(400) for p in ("start", "end")}
    late = lambda p, n: np.roll(x[p], n).tolist()
    data = [(0, p, x[p].tolist()) for p in x] + [(1, p, late(p, 2)) for p in x] + [(2, "start", late("start", 5)), (2, "end", late("end", 5)), (3, "start", late("start", 1)), (3, "end", late("end", 9)), (4, "start", [0.0] * 400), (4, "end", rng.standard_normal(400).tolist())]
    found = Y.lags(spark.createDataFrame(data, "track long, position string, samples array<double>"), __import__("pyspark.sql.functions").sql.functions.lit(0), 20)
    codes = {}
    for r in Y.assess(found, 0.5, 2, 4).collect():
        codes.setdefault(r["track"], set()).add(r["code"])
    assert codes == {2: {"timecode_disagreement"}, 3: {"timecode_disagreement", "clock_drift_suspected"}, 4: {"sync_qa_no_signal", "sync_qa_low_confidence"}}
    assert {(r["track"], r["position"]): r["lag"] for r in found.collect() if r["track"] < 4} == {(1, "start"): 2, (1, "end"): 2, (2, "start"): 5, (2, "end"): 5, (3, "start"): 1, (3, "end"): 9}


def test_islands_over_one_time_line(spark):
    """However the time line is cut into blocks, rows are in the island of a plain sweep."""
    from tidewright.operators import intervals as I

    rng = np.random.default_rng(4)
    data = [(i, int(a), int(a + n)) for i, (a, n) in enumerate(zip(rng.integers(0, 3000, 150), rng.choice([1, 5, 30, 400], 150, p=[0.4, 0.4, 0.15, 0.05]), strict=True))]
    want, reach, start = {}, None, None
    for i, a, b in sorted(data, key=lambda r: (r[1], r[2])):
        if reach is None or a > reach:
            start = a
        want[i], reach = start, b if reach is None else max(reach, b)
    df = spark.createDataFrame(data, "id long, start long, end long")
    for block in (7, 100, 10_000):
        assert {r["id"]: r["island"] for r in I.island_starts(df, "start", "end", block).collect()} == want


def test_islands_of_equal_intervals_are_one(spark):
    """Rows that repeat an interval are in its island, whatever order they come in."""
    from tidewright.operators import intervals as I

    data = [(i, 10 * (i // 40), 10 * (i // 40) + 3) for i in range(400)]
    df = spark.createDataFrame(data, "id long, start long, end long").repartition(7)
    for block in (7, 1000):
        assert {r["id"]: r["island"] for r in I.island_starts(df, "start", "end", block).collect()} == {i: a for i, a, _ in data}
