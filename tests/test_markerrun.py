"""The marker run's decisions, case by case and over random sessions against a plain walk."""

import random

from tidewright.operators import markerrun as K

FOUND = "session string, track string, anchor long, score int, ambiguous boolean, clipped boolean, weak boolean"
EVENTS = "session string, role string, start long, end long, geometry string"


def occurrence(track, at, score=900, session="s", ambiguous=False, clipped=False, weak=False):
    return (session, track, at, score, ambiguous, clipped, weak)


def tracks_of(spark, found):
    return spark.createDataFrame(sorted({(r[0], r[1]) for r in found}), "session string, track string")


def grouped(spark, found, tolerance=100, extra=()):
    table = spark.createDataFrame(found, FOUND)
    tracks = tracks_of(spark, [*found, *extra])
    return K.members(table, tracks, K.reference_tracks(table), tolerance)


def test_the_reference_has_the_most_usable_occurrences(spark):
    found = [occurrence("b", 0), occurrence("b", 1000), occurrence("a", 0, weak=True), occurrence("a", 1000), occurrence("c", 5), occurrence("c", 900)]
    table = spark.createDataFrame(found, FOUND)
    assert K.reference_tracks(table).first()["track"] == "b"
    assert K.reference_tracks(table, spark.createDataFrame([("s", "c")], "session string, track string")).first()["track"] == "c"


def test_members_of_groups(spark):
    found = [
        occurrence("a", 1000), occurrence("a", 5000), occurrence("a", 9000), occurrence("a", 9150),
        occurrence("b", 1010), occurrence("b", 4960, weak=True), occurrence("b", 9080),  # 9080 is near two groups: the first one takes it
        occurrence("c", 990), occurrence("c", 1020), occurrence("c", 5050, clipped=True),
    ]
    got = {(r["anchor"], r["track"]): (r["outcome"], r["lag"]) for r in grouped(spark, found, extra=[("s", "d")]).collect()}
    assert {k: v for k, v in got.items() if k[1] == "a"} == {(x, "a"): ("detected", 0) for x in (1000, 5000, 9000, 9150)}
    assert {k[0]: v for k, v in got.items() if k[1] == "b"} == {1000: ("detected", 10), 5000: ("weak", None), 9000: ("detected", 80), 9150: ("missing", None)}
    assert {k[0]: v[0] for k, v in got.items() if k[1] == "c"} == {1000: "ambiguous", 5000: "clipped", 9000: "missing", 9150: "missing"}
    assert {v for k, v in got.items() if k[1] == "d"} == {("missing", None)}


def named(spark, anchors, events):
    groups = spark.createDataFrame([("s", a) for a in anchors], "session string, anchor long")
    told, notes = K.roles(groups, spark.createDataFrame([("s", *e) for e in events], EVENTS))
    return {r["anchor"]: (r["role"], r["geometry"] or None) for r in told.collect()}, sorted((r["code"], r["at"]) for r in notes.collect())


def test_events_and_groups_are_matched_one_to_one(spark):
    got, notes = named(spark, [100, 500, 900, 1300], [("start", 0, 200, "g"), ("end", 450, 950, "g"), ("diagnostic", 2000, 3000, None), ("end", 1200, 1400, None), ("start", 1250, 1350, None)])
    assert got == {100: ("start", "g"), 500: (None, None), 900: (None, None), 1300: (None, None)}
    assert notes == [("marker_event_ambiguous", 450), ("marker_event_overlap", 1300), ("marker_event_without_occurrence", 2000)]


def test_roles_without_a_log(spark):
    groups = spark.createDataFrame([("one", 10), ("one", 990), ("two", 10), ("two", 20), ("two", 990), ("mid", 500)], "session string, anchor long")
    windows = spark.createDataFrame([(s, 100, 900) for s in ("one", "two", "mid")], "session string, opens long, closes long")
    told, notes = K.default_roles(groups, windows)
    assert {(r["session"], r["anchor"]): r["role"] for r in told.collect() if r["role"]} == {("one", 10): "start", ("one", 990): "end"}
    assert sorted(r["session"] for r in notes.collect()) == ["mid", "two"]


def test_arrivals_need_fixed_geometry_to_speak_of_clocks(spark):
    members = spark.createDataFrame([("s", a, t, o, None, lag, 1) for a, t, o, lag in [(100, "a", "detected", 0), (100, "b", "detected", 10), (100, "c", "weak", None), (900, "a", "detected", 0), (900, "b", "detected", 40), (900, "c", "detected", 7), (900, "d", "detected", 1)]], K.MEMBERS)
    table = lambda end: spark.createDataFrame([("s", 100, "start", "g"), ("s", 900, "end", end)], "session string, anchor long, role string, geometry string")
    rows, notes = K.arrivals(members, table("g"), 30)
    assert {r["track"]: (r["change"], r["outcome"]) for r in rows.collect()} == {"a": (0, "clock_drift_evidence"), "b": (30, "clock_drift_evidence"), "c": (None, "inconclusive"), "d": (None, "inconclusive")}
    assert [(r["code"], r["at"]) for r in notes.collect()] == [("marker_material_clock_drift", 30)]
    rows, notes = K.arrivals(members, table("elsewhere"), 30)
    assert {r["outcome"] for r in rows.collect()} == {"differential_arrival", "inconclusive"} and notes.count() == 0
    rows, notes = K.arrivals(members, table("g").filter("role = 'start'"), 30)
    assert rows.count() == 0 and [r["code"] for r in notes.collect()] == ["marker_arrival_pair_ambiguous"]


def test_timecode_is_judged_by_what_the_evidence_can_tell_apart(spark):
    members = spark.createDataFrame([("s", 100, t, "detected", None, lag, 1) for t, lag in (("a", 0), ("b", -1600), ("c", 1601), ("d", None))], K.MEMBERS)
    roles = spark.createDataFrame([("s", 50, "end", None), ("s", 100, None, None)], "session string, anchor long, role string, geometry string")
    got = K.timecode(members, roles, spark.createDataFrame([("s", 1600)], "session string, floor long"))
    assert {r["track"]: r["beyond"] for r in got.collect()} == {"a": False, "b": False, "c": True}


def test_random_sessions_match_a_walk(spark):
    rng = random.Random(2)
    found = []
    for s in ("p", "q", "r"):
        for t in ("a", "b", "c"):
            for at in sorted(rng.sample(range(0, 3000, 10), 12)):
                found.append(occurrence(t, at, rng.randint(300, 999), s, rng.random() < 0.1, rng.random() < 0.1, rng.random() < 0.1))
    got = {(r["session"], r["anchor"], r["track"]): (r["outcome"], r["at"], r["lag"]) for r in grouped(spark, found, 60).collect()}
    fine = lambda o: not any(o[4:])
    want = {}
    for s in ("p", "q", "r"):
        own = [o for o in found if o[0] == s]
        reference = min("abc", key=lambda t: (-sum(fine(o) for o in own if o[1] == t), t))
        used = set()
        for anchor in sorted(o[2] for o in own if o[1] == reference and fine(o)):
            want[s, anchor, reference] = ("detected", anchor, 0)
            for t in "abc".replace(reference, ""):
                near = [o for o in own if o[1] == t and abs(o[2] - anchor) <= 60 and (t, o[2]) not in used]
                if len(near) != 1:
                    want[s, anchor, t] = ("ambiguous" if near else "missing", None, None)
                    continue
                o = near[0]
                used.add((t, o[2]))
                outcome = "ambiguous" if o[4] else "clipped" if o[5] else "weak" if o[6] else "detected"
                want[s, anchor, t] = (outcome, o[2], o[2] - anchor if outcome == "detected" else None)
    assert got == want
