"""Queries over events tables made for what the driver's smallest ones don't hold, against their SQL."""

import tracemalloc
from datetime import datetime, timedelta
from itertools import combinations

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_queries import canonical
from tidewright.operators import attribution as A
from tidewright.operators import markerrun as K
from tidewright.operators import sequences as S
from tidewright.plans import flows, oracle_sql, queries, session

KINDS = ("view", "click", "purchase", "signup", "error")


def table(spark, folder, rows):
    """An events table of (second, user_id, event_type, value)."""
    at = datetime(2024, 1, 1)
    events = [(i, at + timedelta(seconds=s), u, k, float(v), "{}") for i, (s, u, k, v) in enumerate(rows)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(str(folder / "events.parquet"))
    return str(folder)


def same(spark, folder, name):
    with duckdb.connect() as con:
        con.execute("SET timezone = 'UTC'")
        con.execute("SET error_on_division_by_zero = false")  # else draft_pairs' SQL has no result for spans of no length
        con.execute(f"CREATE VIEW events AS FROM read_parquet('{folder}/events.parquet/*.parquet')")
        want = canonical(con.execute(oracle_sql()[name]).df())
    assert canonical(queries()[name](spark, folder).toPandas()) == want and want
    return want


SHORT = [(0, 0, "view", 100), (30, 1, "click", 0), (60, 2, "view", 0), (80, 3, "click", 50), (90, 0, "view", 0.0004), (400, 1, "view", 0)]


def test_spans_of_no_length_are_wholly_within_others(spark, tmp_path):
    want = same(spark, table(spark, tmp_path, SHORT), "draft_pairs")
    assert [w[1] for w in want].count("1000") == 3


def test_drafts_of_no_length_collapse_into_none(spark, tmp_path):
    got = queries()["collapse"](spark, table(spark, tmp_path, SHORT)).collect()
    assert not {r["loser"] for r in got} & {1, 2, 4, 5}


def plain_collapse(spark, drafts, compared):
    """Every pair of drafts (id, track, start, end, score) in one frame: what collapse() makes of it."""
    pairs = []
    for a, b in combinations(sorted(d for d in drafts if None not in d), 2):
        if a[1] != b[1] and a[2] < b[3] and b[2] < a[3]:
            w, l = (a, b) if a[4] >= b[4] else (b, a)
            c = compared(dict(zip(NAMES, w, strict=True)), {n: np.array([v]) for n, v in zip(NAMES, l, strict=True)})
            pairs.append((0, w[0], l[0], w[4], *(int(np.ravel(c[n])[0]) for n in ("overlap_permille", "similarity", "correlation")), w[4] - l[4], *(bool(np.ravel(c[n])[0]) for n in ("long_enough", "contains"))))
    df = spark.createDataFrame(pairs, "island long, winner long, loser long, winner_score int, overlap_permille int, similarity int, correlation int, margin int, long_enough boolean, contains boolean")
    return {(r["loser"], r["winner"], r["contained"]) for r in S.collapse(df).collect()}


NAMES = ("id", "track", "start", "end", "score")
LINE = [(i, i % 2, i * 7, i * 7 + 9, 500 - i) for i in range(60)]  # each meets the next, which scores less
MIXED = [(i * 37 % 211 - 40, i % 5, i * 131 % 307 - 90, i * 131 % 307 - 90 + (400 if i % 41 == 0 else i * 17 % 43 - 4), i * 29 % 13 * 60) for i in range(211)]


@pytest.mark.parametrize("drafts", [LINE, MIXED, [(1, None, 0, 5, 3), (2, 1, 0, None, 3)]])
@pytest.mark.parametrize("block", [20, 10**6])
def test_drafts_collapse_by_blocks_as_by_pairs(spark, drafts, block):
    """Chains over many blocks, drafts longer than a block, of no length or less, equal scores, ids below zero."""
    df = spark.createDataFrame(drafts, "id long, track long, start long, end long, score int")
    got = [(r["id"], r["winner"], r["contained"]) for r in S.collapse_drafts(df, session.drafts_compared, block).collect()]
    want = plain_collapse(spark, drafts, session.drafts_compared)
    assert set(got) == want and len(got) == len(want)
    if drafts is MIXED:
        assert {c for _, _, c in got} == {False, True}


def stages(spark):
    """What Spark knows of its stages, by id."""
    store = spark.sparkContext._jsc.sc().statusStore()
    found = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), getattr(store, "stageList$default$5")())
    return {s.stageId(): s for s in (found.apply(i) for i in range(found.size()))}


@pytest.mark.parametrize("rows", ["CROWD", "DENSE", "SPARSE"])
def test_no_pair_of_drafts_is_dealt(spark, tmp_path, rows):
    folder = table(spark, tmp_path, globals()[rows])
    own = [tuple(r[n] for n in (*NAMES[:4], "total")) for r in session.first_scores(spark, folder).collect()]
    pairs = sum(a[1] != b[1] and a[2] < b[3] and b[2] < a[3] for a, b in combinations(own, 2))
    before = stages(spark)
    got = [(r["loser"], r["winner"], r["contained"]) for r in queries()["collapse"](spark, folder).collect()]
    most = max(s.shuffleWriteRecords() for k, s in stages(spark).items() if k not in before)
    want = plain_collapse(spark, own, session.drafts_compared)
    assert set(got) == want and len(got) == len(want) > 0
    if rows == "CROWD":
        assert most < pairs / 4


CROWD = [(i % 40, i % 9, KINDS[i % 5], i * 7 % 490) for i in range(200)]


@pytest.mark.parametrize("name", ["score_candidate", "worst_delta", "gate", "best_suppressor", "attribute_two_pass", "tallies", "evidence_lookup", "active_weight"])
def test_pairs_of_a_crowd_are_not_shuffled(spark, tmp_path, name):
    """All candidates at once; rows of pairs are neither sorted for an aggregate nor dealt by their other candidate."""
    folder = table(spark, tmp_path, CROWD)
    same(spark, folder, name)
    plan = queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "hashpartitioning(other" not in plan


def test_evidence_is_found_with_its_pair(spark, tmp_path):
    """No stage deals the pairs, where tables are too large to be broadcast."""
    folder = table(spark, tmp_path, CROWD)
    name = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(name)
    before = stages(spark)
    spark.conf.set(name, "-1")
    try:
        pairs = len(queries()["evidence_lookup"](spark, folder).collect())
    finally:
        spark.conf.set(name, usual)
    assert max(s.shuffleWriteRecords() for k, s in stages(spark).items() if k not in before) < pairs / 8


@pytest.mark.parametrize("every", [3, 1000])
def test_evidence_of_ids_that_recur(spark, tmp_path, every):
    """Two rows of an id overlap the same candidates: each of their pairs meets the evidence of both."""
    folder = table(spark, tmp_path, CROWD[:90])
    e = spark.read.parquet(f"{folder}/events.parquet").withColumn("event_id", F.expr(f"if(event_id % {every} = 1, event_id - 1, event_id)"))
    e.unionAll(e.filter("event_id = 7")).coalesce(1).write.parquet(f"{folder}/again/events.parquet")
    want = same(spark, f"{folder}/again", "evidence_lookup")
    assert len(want) > len(set(want))


@pytest.mark.parametrize(("name", "most"), [("gate", 1.2), ("evidence_lookup", 1.6)])
def test_pairs_of_sessions_alike_take_little_room(spark, tmp_path, name, most):
    """Every pair is the result; what repeats in it comes so that it is stored in a byte or so a pair."""
    folder = table(spark, tmp_path, [(i % 25 * 2, i % 25 % 9 + i // 25 * 6, KINDS[i % 5], i % 25 * 17 + 60) for i in range(600)])
    queries()[name](spark, folder).write.parquet(f"{folder}/out")
    pairs = spark.read.parquet(f"{folder}/out").count()
    assert pairs > 200_000 and sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < most * pairs


def test_the_least_of_equal_margins_suppresses(spark):
    ids = [5, -3, 2**62, -(2**63)]
    scores = spark.createDataFrame([(i, 0, 1, 0) for i in ids], "id long, track long, total int, level long")
    gates = spark.createDataFrame([(5, -3, 200, "suppresses"), (5, 2**62, 200, "suppresses"), (-3, 2**62, 150, "suppresses"), (2**62, 5, 151, "suppresses"), (2**62, -(2**63), 151, "suppresses")], "id long, other long, margin int, outcome string")
    assert {r["id"]: r["suppressed_by"] for r in A.decide(scores, gates).collect()} == {5: -3, -3: 2**62, 2**62: -(2**63), -(2**63): None}


def test_one_waveform_is_held_at_a_time():
    many = pd.DataFrame({"s_suppkey": range(300), "marker": [flows.MARKERS[0]] * 300, "level": range(100, 400)})
    one = next(flows.waveforms(iter([many.head(1)])))["samples"][0] * 8
    tracemalloc.start()
    got = next(flows.waveforms(iter([many])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(got["sha256"])) > 250 and most < 30 * one


DENSE = [(i * 37 % 2500, i % 7, KINDS[i * 13 % 11 % 5], i * i % 491) for i in range(900)]


def test_chirps_of_a_crowd(spark, tmp_path):
    """Ties of score and of distance, several peaks in a second; no anchor meets its peaks in a join."""
    folder = table(spark, tmp_path, DENSE)
    same(spark, folder, "band_join_chirps")
    plan = queries()["band_join_chirps"](spark, folder)._jdf.queryExecution().analyzed().toString()
    assert "abs(" not in plan


SPARSE = [(i * 397 % 86_000, i % 7, KINDS[i * 13 % 11 % 5], i % 491) for i in range(400)]


@pytest.mark.parametrize("rows", [DENSE, SPARSE])
def test_windows_that_hold_one_peak(spark, tmp_path, rows):
    folder = table(spark, tmp_path, [*rows, (200_000, 1, "signup", 1), (200_000, 1, "purchase", 1), (300_000, 1, "signup", 1), (300_900, 1, "purchase", 1), (300_899, 1, "purchase", 1)])
    assert ("900", "904") not in same(spark, folder, "role_assignment")
    assert "Join" not in queries()["role_assignment"](spark, folder)._jdf.queryExecution().analyzed().toString()


def test_groups_within_logged_events(spark, tmp_path):
    """Many groups of a session, at the edges of events too; an event that ends before it starts, or has no end, holds none."""
    folder = table(spark, tmp_path, [(i * 977 % 800_000, i % 3, KINDS[3 + i % 2], i % 491) for i in range(500)])
    same(spark, folder, "marker_role_notes")
    groups = spark.createDataFrame([("s", a) for a in (10, 20, 30)], "session string, anchor long")
    events = spark.createDataFrame([("s", "start", 10, 11, None), ("s", "end", 11, 30, None), ("s", "x", 25, 5, None), ("s", "y", 10, None, None), ("t", "z", 0, 99, None), ("s", "w", 15, 21, None)], "session string, role string, start long, end long, geometry string")
    named, notes = K.roles(groups, events)
    assert sorted((r["anchor"], r["role"]) for r in named.collect()) == [(10, "start"), (20, None), (30, None)]
    none = "marker_event_without_occurrence"
    assert sorted(tuple(r) for r in notes.collect()) == [("s", "marker_event_overlap", 20), ("s", none, 10), ("s", none, 25), ("t", none, 0)]
    assert "Join" not in notes._jdf.queryExecution().analyzed().toString()
