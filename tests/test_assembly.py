"""Ownership, dropped words, drafts, collapse and turns against plain versions; answers kept by submitted bytes."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.operators import answers as N
from tidewright.operators import assembly as B
from tidewright.operators import transcript as T

PIECES = "request_id string, track_id string, candidate long, start long, end long, padded_start long, padded_end long"
ANSWERS = T.OUTCOMES


def answer(request, track, words, text=None, alignment=None):
    """words: (start, text), each ten samples long."""
    own = [(a, a + 10, w) for a, w in words]
    return (request, track, " ".join(w for _, w in words) if text is None else text, own, alignment or ("aligned" if words else "not_attempted"), False, [request], 0, None)


def tables(spark, pieces, answers, grace=0):
    p = B.effective(spark.createDataFrame(pieces, PIECES), grace)
    return p, spark.createDataFrame(answers, ANSWERS)


def test_ownership_is_the_part_of_each_candidate_in_each_core(spark):
    asked = spark.createDataFrame([("r1", "1", 0, 100, 0, 150), ("r2", "1", 100, 200, 50, 250), ("r3", "2", 0, 300, 0, 300)], "request_id string, track_id string, core_start long, core_end long, padded_start long, padded_end long")
    candidates = spark.createDataFrame([(7, 1, 10, 40), (8, 1, 60, 160), (9, 2, 290, 299), (10, 1, 200, 210)], "id long, track long, start long, end long")
    got = sorted((r["request_id"], r["candidate"], r["start"], r["end"]) for r in B.ownership(asked, candidates, 64).collect())
    assert got == [("r1", 7, 10, 40), ("r1", 8, 60, 100), ("r2", 8, 100, 160), ("r3", 9, 290, 299)]


def test_random_words_are_owned_or_dropped_by_the_nearest_edge(spark):
    rng = random.Random(5)
    pieces, answers = [], []
    for t in ("1", "2"):
        at = 0
        for r in range(12):
            own = []
            for _ in range(rng.randint(1, 3)):
                a = at + rng.randint(5, 40)
                at = a + rng.randint(5, 60)
                own.append((a, at))
            low, high = max(0, own[0][0] - 30), own[-1][1] + 30
            pieces += [(f"{t}-{r}", t, len(pieces) + i, a, b, low, high) for i, (a, b) in enumerate(own)]
            answers.append(answer(f"{t}-{r}", t, sorted((rng.randint(low, high - 1), f"w{i}") for i in range(rng.randint(0, 8)))))
    p, table = tables(spark, pieces, answers, grace=4)
    effective = {}
    for t in ("1", "2"):
        before = 0
        for r in sorted((x for x in pieces if x[1] == t), key=lambda x: x[3]):
            effective[r[2]] = max(r[5], before, r[3] - 4)
            before = r[4]
    assert {r["candidate"]: r["effective_start"] for r in p.collect()} == effective
    want_owned, want_lost = set(), set()
    for request, track, _, words, *_ in answers:
        mine = [x for x in pieces if x[0] == request]
        for i, (a, _, _) in enumerate(words):
            inside = [x[2] for x in mine if effective[x[2]] <= a < x[4]]
            if inside:
                want_owned.add((request, inside[0], i))
            else:
                distance, candidate, side = min((effective[x[2]] - a, x[2], "before") if a < effective[x[2]] else (a - x[4] + 1, x[2], "after") for x in mine)
                want_lost.add((request, track, i, candidate, side, distance))
    assert {(r["request_id"], r["candidate"], r["at"]) for r in B.owned(table, p).collect()} == want_owned
    lost = B.dropped(table, p)
    assert {tuple(r) for r in lost.collect()} == want_lost and want_lost and want_owned
    for r in B.dropped_notes(lost).collect():
        mine = [x for x in want_lost if x[1] == r["track_id"]]
        assert r["words"] == len(mine) and r["before"] == sum(x[4] == "before" for x in mine) and r["leading"] == sum(x[2] == 0 for x in mine)
        assert r["farthest"] == max(x[5] for x in mine) == r["distances"][-1]["distance"] and sum(d["words"] for d in r["distances"]) == len(mine)


def test_drafts_by_candidate_group_and_piece(spark):
    pieces = [
        ("a", "1", 1, 0, 100, 0, 150), ("a", "1", 2, 200, 300, 0, 350),  # two candidates with words: two drafts
        ("b", "1", 3, 400, 500, 380, 650), ("b", "1", 4, 520, 600, 380, 650), ("c", "1", 4, 600, 700, 560, 720), ("c", "1", 5, 710, 800, 560, 820),  # b and c without words, sharing 4: one draft
        ("d", "2", 6, 0, 100, 0, 140), ("e", "2", 6, 100, 200, 60, 240),  # a candidate cut by the cap: the word at the border is heard twice
        ("f", "2", 7, 300, 400, 280, 420),  # nothing but padding's words
    ]
    answers = [
        answer("a", "1", [(5, "one"), (50, "two"), (120, "lost"), (210, "three")]), answer("b", "1", [], "whole  text"), answer("c", "1", [], "goes on"),
        answer("d", "2", [(10, "hello"), (95, "Zephyrine")]), answer("e", "2", [(101, "zephyrine!"), (150, "again")]), answer("f", "2", [(290, "padding")]),
    ]
    p, table = tables(spark, pieces, answers)
    got = {tuple(r["candidates"]): r for r in B.drafts(table, p).collect()}
    assert {k: r["text"] for k, r in got.items()} == {(1,): "one two", (2,): "three", (3, 4, 5): "whole text goes on", (6,): "hello Zephyrine again"}
    assert (got[3, 4, 5]["start"], got[3, 4, 5]["end"], got[3, 4, 5]["alignment"]) == (400, 800, "not_attempted") and got[3, 4, 5]["request_ids"] == ["b", "c"]
    assert (got[1,]["start"], got[1,]["end"]) == (5, 60) and got[6,]["request_ids"] == ["d", "e"]


DRAFT = f"track_id string, `group` long, start long, end long, ownership_start long, ownership_end long, text string, words {T.WORDS}, alignment string, candidates array<long>, request_ids array<string>"


def draft(track, candidates, start, end, text, alignment="aligned", requests=("r",)):
    return (track, start, start, end, start, end, text, [], alignment, list(candidates), list(requests))


def judged(spark, drafts, scores, pairs):
    own = spark.createDataFrame(drafts, DRAFT)
    both = [(a, b, c) for (a, b), c in pairs.items()] + [(b, a, c) for (a, b), c in pairs.items()]
    s = spark.createDataFrame(list(scores.items()), "id long, total int")
    return {tuple(r["candidates"]): r for r in B.verdicts(own, s, spark.createDataFrame(both, "id long, other long, correlation int"), 1000, 250).collect()}


def test_copies_of_an_utterance_go_by_the_weakest_evidence(spark):
    same = "we should open the old door now"
    drafts = [
        draft("1", [1], 0, 1000, same), draft("2", [2], 10, 1010, same + "!"), draft("3", [3], 20, 1020, same),  # one utterance, three tracks
        draft("1", [4], 5000, 6000, same), draft("2", [5], 5600, 7000, same),  # too little shared time
        draft("1", [6], 9000, 9900, "yes"), draft("2", [7], 9000, 9900, "yes"),  # too short a text
        draft("1", [8], 20000, 21000, same), draft("2", [9, 10], 20000, 21000, same, "not_attempted"),  # 10 was never compared
        draft("1", [11], 30000, 31000, "and then the dragon came down to the village"), draft("2", [12], 30000, 31000, "the dragon came"),  # a contained fragment
        draft("1", [13], 40000, 41000, same), draft("1", [14], 40100, 41100, same),  # one track: two utterances
    ]
    scores = {1: 700, 2: 900, 3: 800, 4: 900, 5: 100, 6: 900, 7: 100, 8: 900, 9: 100, 10: 100, 11: 900, 12: 400, 13: 500, 14: 500}
    pairs = {(1, 2): 900, (1, 3): 900, (2, 3): 200, (4, 5): 900, (6, 7): 900, (8, 9): 900, (11, 12): 100, (13, 14): 900}
    got = judged(spark, drafts, scores, pairs)
    n = {k: r["n"] for k, r in got.items()}
    gone = {k: (r["duplicate_of"], r["contained"]) for k, r in got.items() if r["decision"] == "duplicate"}
    assert gone == {(1,): (n[2,], False), (3,): (n[2,], False), (12,): (n[11,], True)}
    assert [n[k] for k in sorted(got, key=lambda k: (got[k]["start"], got[k]["track_id"]))] == list(range(len(drafts)))
    assert {k for k, r in got.items() if r["overlap"]} == {(4,), (5,), (6,), (7,), (8,), (9, 10)}
    # a tie goes to the earlier draft; without evidence nothing goes
    assert judged(spark, drafts[:2], {1: 500, 2: 500}, {(1, 2): 900})[2,]["decision"] == "duplicate"
    assert {r["decision"] for r in judged(spark, drafts[:2], {1: 500, 2: 900}, {(7, 8): 1}).values()} == {"retained"}


def test_turns_join_only_what_belongs_together(spark):
    rows = [
        (0, "1", 0, 100, "a", "aligned", ["r1"], False), (1, "1", 110, 200, "b", "aligned", ["r1"], False),  # joined
        (2, "1", 240, 300, "c", "aligned", ["r2"], False),  # no request in common
        (3, "1", 310, 400, "d", "not_attempted", ["r2"], False),  # another alignment
        (4, "1", 480, 500, "e", "not_attempted", ["r2"], False),  # too far
        (5, "2", 505, 600, "f", "not_attempted", ["r9"], False), (6, "1", 610, 650, "g", "not_attempted", ["r2"], False),  # another track stands between
        (7, "1", 660, 700, "h", "not_attempted", ["r2"], True), (8, "2", 660, 700, "i", "aligned", ["r9"], True),  # overlaps
    ]
    table = spark.createDataFrame([(0, *r, []) for r in rows], f"session int, n long, track_id string, start long, end long, text string, alignment string, request_ids array<string>, overlap boolean, words {T.WORDS}")
    got = sorted(B.presentation(table, ["session"], 50, 1000, 20).collect(), key=lambda r: r["turn"])
    assert [r["text"] for r in got] == ["a b", "c", "d", "e", "f", "g", "h", "i"] and got[0]["sources"] == [0, 1] and (got[0]["start"], got[0]["end"]) == (0, 200)
    assert [r["overlap"] for r in got] == [False] * 6 + [True, True]


class Counting:
    """Answers with the sum of the samples, and leaves a file for each request it is asked for."""

    def __init__(self, folder):
        self.folder = folder

    def transcribe(self, request):
        with open(os.path.join(self.folder, f"{request.request_id}-{os.urandom(4).hex()}"), "w"):
            return T.Answer(f"sum {float(np.sum(request.audio)):.1f}")


def test_only_what_is_missing_reaches_the_model(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    seen = lambda: sorted(n.rsplit("-", 1)[0] for n in os.listdir(asked))
    schema = "request_id string, track_id string, core_start long, core_end long, padded_start long, padded_end long, samples array<float>"
    rows = [(f"r{i}", "1", i * 10, i * 10 + 10, i * 10, i * 10 + 10, [float(i)] * 10) for i in range(6)]
    kept = N.Answers(spark, str(tmp_path / "answers"))
    of = lambda data, model="m": kept.of(spark.createDataFrame(data, schema), lambda: Counting(str(asked)), model, 1000, 10, 10)
    got, n = of(rows)
    assert n == 6 and seen() == [f"r{i}" for i in range(6)] and {r["request_id"]: r["text"] for r in got.collect()} == {f"r{i}": f"sum {10.0 * i:.1f}" for i in range(6)}
    again, n = of(rows)
    assert n == 0 and len(seen()) == 6 and again.count() == 6
    changed = [*rows[:2], (*rows[2][:-1], [9.0] * 10), *rows[3:]]
    got, n = of(changed)
    assert n == 1 and seen().count("r2") == 2 and {r["request_id"]: r["text"] for r in got.collect()}["r2"] == "sum 90.0"
    assert of(rows, "another model")[1] == 6 and of([])[1] == 0
    # a run that died between writing and renaming has left nothing that is read
    spark.createDataFrame([("x", "r", "1", "t", [], "aligned", False, [], 0, None)], "identity string, " + T.OUTCOMES).write.parquet(str(tmp_path / "answers" / "staged-dead"))
    assert kept.known().filter("identity = 'x'").count() == 0


def test_a_run_tells_of_what_it_mended(spark, tmp_path):
    """A session whose model truncates one answer for good keeps that answer's text, and says so."""
    from tidewright.operators import activity as D
    from tidewright.plans import chain
    from tidewright.sources import fixtures

    spec = fixtures.canonical()
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    truth = fixtures.write(spec, folder)
    script = [(str(t), a // 3, b // 3, w) for t, a, b, w in truth["words"]]

    class Stubborn(T.Script):
        def transcribe(self, request):
            got = super().transcribe(request)
            return T.Answer(got.text, (), True) if "evening" in got.text else got

    report = chain.run(spark, folder, out, D.Energy, lambda: Stubborn(script))
    lines = "".join(open(f"{out}/transcript/{n}").read() for n in sorted(os.listdir(f"{out}/transcript")) if n.endswith(".txt"))
    codes = {d["code"] for d in report["decisions"]}
    assert report["status"] == "complete" and "answer_truncated" in codes and "evening" in lines and "requests_submitted" in codes
    again = chain.run(spark, folder, out, D.Energy, lambda: pytest.fail("every answer is kept"))
    assert [d["requests"] for d in again["decisions"] if d["code"] == "requests_submitted"] == [0] and again["deliverables"] == report["deliverables"]
