"""Start-time strategies, origins and layouts, row by row and against plain versions in exact rationals; whole sessions from files."""

import datetime as dt
import os
import random
import shutil
from dataclasses import replace
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidewright.operators import starts as O
from tidewright.plans import chain
from tidewright.sources import fixtures

N = fixtures.RATE
SOURCE = "session string, track string, path string, sha256 string, rate int, time_reference string, timecode string, date string, override_sha256 string, recording_date date, start_timecode string, start_offset long, reason string, overridden boolean"


def source(path, session="s", track="t", rate=48000, reference=None, timecode=None, date=None, **override):
    o = {"sha256": None, "recording_date": None, "start_timecode": None, "start_offset": None, "reason": None} | override
    return (session, track, path, "own", rate, reference, timecode, date, o["sha256"], o["recording_date"], o["start_timecode"], o["start_offset"], o["reason"], bool(override))


def begun(spark, rows, label="30F", quantum=1600):
    return O.start_times(spark.createDataFrame(rows, SOURCE), F.lit(label), F.lit(quantum))


def test_the_first_strategy_with_an_answer_counts(spark):
    got = {r["path"]: r for r in begun(spark, [
        source("offset", reference="5", timecode="00:00:01:00", start_offset=-7, reason="log"), source("override code", reference="5", start_timecode="00:00:02:15", reason="log"),
        source("both kinds", reference="144000", timecode="09:00:00:00"), source("code", timecode="01:00:00:10"), source("junk reference", reference="12.5", timecode="00:00:00:01"),
        source("negative", reference="-1", timecode="00:00:00:02"), source("nothing", date="2024-01-01"), source("only a date", recording_date=dt.date(2024, 1, 1)), source("bad code", timecode="25:00:00:00"),
        source("drop notation", timecode="01:00:00;00"), source("own rate", rate=44100, reference="88200"), source("no exact rate", rate=44099, reference="1"),
    ]).collect()}
    kind = {p: (r["strategy"], r["start"]["count"] if r["start"] else None) for p, r in got.items()}
    assert kind["offset"] == ("recovery_override_offset", -7) and kind["override code"] == ("recovery_override_timecode", 75) and kind["both kinds"] == ("bwf_time_reference", 144000)
    assert kind["code"] == ("timecode_tag", 108010) and kind["junk reference"] == ("timecode_tag", 1) and kind["negative"] == ("timecode_tag", 2) and kind["own rate"] == ("bwf_time_reference", 88200)
    assert got["own rate"]["start"]["flicks"] == 2 * O.FLICK and got["own rate"]["start"]["quantum"] == 1742
    assert got["offset"]["override_reason"] == "log" and got["both kinds"]["override_reason"] is None
    for p, why in {"nothing": "no_tag", "only a date": "no_tag", "bad code": "out_of_range", "drop notation": "drop_notation", "no exact rate": "no_tag"}.items():
        assert got[p]["refusal"] == "no_start_time" and [d["reason"] for d in got[p]["declined"]][-1] == why and len(got[p]["declined"]) == 4
    assert [tuple(d) for d in got["junk reference"]["declined"]] == [("recovery_override_offset", "no_override"), ("recovery_override_timecode", "no_override"), ("bwf_time_reference", "not_an_integer")]


def test_an_override_for_other_bytes_is_refused_before_anything_is_asked(spark):
    got = {r["path"]: r for r in begun(spark, [source("other", reference="5", start_offset=1, sha256="else"), source("same", start_offset=1, sha256="own"), source("unsaid", start_offset=1)]).collect()}
    assert got["other"]["refusal"] == "override_hash_mismatch" and got["other"]["start"] is None and got["other"]["declined"] == []
    assert got["same"]["start"]["count"] == got["unsaid"]["start"]["count"] == 1


@pytest.mark.parametrize(("label", "day"), [("24F", 86400), ("23.98F", Fraction(864864, 10)), ("29.97F", Fraction(864864, 10)), ("29.97DF", Fraction(863999136, 10000))])
def test_a_day_of_timecode_is_as_long_as_its_frames(spark, label, day):
    r = begun(spark, [source("a", timecode="00:00:01:00")], label).first()
    assert r["start"]["day"] == day * O.FLICK


def placed(spark, rows, label="30F", zero=None, date=None, rollover="infer_forward", warp=O.identity):
    own = begun(spark, rows, label).withColumns({"zero": F.lit(zero).cast("long"), "origin_date": F.lit(date).cast("date"), "rollover": F.lit(rollover)})
    return {r["path"]: r for r in O.origin(own, ["session"], "track", "path", warp).collect()}


def at(h, m=0, s=0):
    return str((h * 3600 + m * 60 + s) * N)


def test_origins_row_by_row(spark):
    day = dt.date(2024, 1, 2)
    got = placed(spark, [
        source("before", "midnight", reference=at(23, 59, 50)), source("after", "midnight", reference=at(0, 0, 20)), source("plain 1", "plain", reference=at(9)), source("plain 2", "plain", reference=at(11)),
        source("tie 1", "tie", reference=at(0)), source("tie 2", "tie", reference=at(12)), source("alone", "alone", reference=at(5)), source("offset 1", "offsets", start_offset=-100), source("offset 2", "offsets", start_offset=50),
        source("dated 1", "dated", start_timecode="23:00:00:00", recording_date=day), source("dated 2", "dated", start_timecode="01:00:00:00", recording_date=day + dt.timedelta(1)),
        source("half 1", "half", start_timecode="23:00:00:00", recording_date=day), source("half 2", "half", reference=at(1), date="2024-01-09"),
        source("mixed 1", "mixed", reference=at(10)), source("mixed 2", "mixed", timecode="11:00:00:00"), source("below 1", "below", reference=at(10)), source("below 2", "below", start_offset=-4800),
    ])
    place = {p: r["position"] for p, r in got.items()}
    assert place["before"] == 0 and place["after"] == 30 * N and got["after"]["notes"] == ["rollover_inferred", "midnight_rollover_inferred"]
    assert place["plain 1"] == 0 and place["plain 2"] == 7200 * N and got["plain 2"]["notes"] == []
    assert got["tie 1"]["refusal"] == "rollover_ambiguous" and place["tie 1"] is None and place["alone"] == 0
    assert (place["offset 1"], place["offset 2"]) == (0, 150) and got["offset 1"]["rule"] is None and got["offset 1"]["notes"] == ["timeline_shifted_to_earliest_source"]
    assert (place["dated 1"], place["dated 2"]) == (0, 7200 * N) and got["dated 1"]["notes"] == ["rollover_from_recorded_dates"]
    assert place["half 2"] == 7200 * N and got["half 2"]["rule"] == "gap"  # a file's own date asserts nothing
    assert place["mixed 2"] == 3600 * N and (place["below 1"], place["below 2"]) == (4800, 0)


def test_origins_against_a_configured_zero(spark):
    zero = 23 * 3600 * O.FLICK
    rows = [source("evening", reference=at(23, 30)), source("night", reference=at(0, 30))]
    got = placed(spark, rows, zero=zero)
    assert got["evening"]["position"] == 1800 * N and got["night"]["position"] == 5400 * N and got["night"]["notes"] == ["rollover_inferred"] and got["evening"]["notes"] == []
    assert {r["refusal"] for r in placed(spark, rows, zero=zero, rollover="reject").values()} == {"rollover_rejected"}
    assert {r["refusal"] for r in placed(spark, [*rows, source("early", start_offset=-1)], zero=zero).values()} == {"audio_before_session_zero"}
    dated = [source("a", start_timecode="23:30:00:00", recording_date=dt.date(2024, 1, 2))]
    assert placed(spark, dated, date=dt.date(2024, 1, 1))["a"]["cycles"] == 1
    assert placed(spark, dated, date=dt.date(2024, 1, 3))["a"]["refusal"] == "origin_after_earliest_source"


def test_days_of_several_lengths_are_refused_without_a_zero(spark):
    rows = [source("reference", reference=at(10)), source("code", timecode="11:00:00:00")]
    assert {r["refusal"] for r in placed(spark, rows, "29.97F").values()} == {"rollover_ambiguous"}
    got = placed(spark, rows, "29.97F", zero=0)
    assert got["code"]["position"] == round(Fraction(11 * 3600 * 1001, 1000) * N) and got["code"]["notes"] == ["mixed_time_domains"]
    assert {r["refusal"] for r in placed(spark, [source("a", reference=at(23)), source("b", reference=at(1))], rollover="reject").values()} == {"rollover_rejected"}


def test_a_warp_stands_before_the_rounding(spark):
    got = placed(spark, [source("a", reference="0"), source("b", reference="30000")], warp=lambda track, x: F.floor(x * 1.0001).cast("long"))
    assert got["b"]["position"] == 30003


def brute_origin(rows, policy):
    """(positions, refusal) of one session's (path, kind, seconds, day) rows without a configured zero, in fractions."""
    timed = sorted((s, p, d) for p, k, s, d in rows if k != "offset")
    cycles = {p: 0 for p, *_ in rows}
    if timed:
        if len({d for *_, d in timed}) > 1:
            return None, "rollover_ambiguous"
        gaps = [b[0] - a[0] for a, b in zip(timed, timed[1:], strict=False)]
        wrap = timed[0][0] + timed[0][2] - timed[-1][0]
        if gaps and max(gaps) >= wrap:
            if max(gaps) == wrap or gaps.count(max(gaps)) > 1:
                return None, "rollover_ambiguous"
            if policy == "reject":
                return None, "rollover_rejected"
            for s, p, _ in timed[: gaps.index(max(gaps)) + 1]:
                cycles[p] = 1
    absolute = {p: s + cycles[p] * d for p, k, s, d in rows if k != "offset"}
    zero = min(absolute.values(), default=Fraction(0))
    half_away = lambda x: (abs(x) + Fraction(1, 2)).__floor__() * (1 if x >= 0 else -1)
    place = {p: half_away(((absolute[p] - zero) if k != "offset" else s) * N) for p, k, s, d in rows}
    shift = min(0, *place.values()) if place else 0
    return {p: v - shift for p, v in place.items()}, None


@pytest.mark.parametrize("policy", ["infer_forward", "reject"])
def test_random_sessions_match_exact_rationals(spark, policy):
    rng = random.Random(7)
    table, plain = [], {}
    for i in range(120):
        s = f"s{i}"
        plain[s] = []
        for j in range(rng.randint(1, 5)):
            path, kind = f"{s}-{j}", rng.choice(["reference", "reference", "timecode", "offset"] if i % 3 == 0 else ["reference"] if i % 3 == 1 else ["timecode", "offset"])
            hour = rng.choice([0, 6, 12, 18, rng.randrange(24)])
            if kind == "reference":
                n = hour * 3600 * N + rng.choice([0, 0, rng.randrange(10**6)])
                table.append(source(path, s, reference=str(n)))
                plain[s].append((path, kind, Fraction(n, N), Fraction(86400)))
            elif kind == "timecode":
                table.append(source(path, s, timecode=f"{hour:02d}:00:01:{j:02d}"))
                plain[s].append((path, kind, Fraction((hour * 3600 + 1) * 30 + j) * Fraction(1001, 30000), Fraction(86400 * 30 * 1001, 30000)))
            else:
                n = rng.randrange(-1000, 1000)
                table.append(source(path, s, start_offset=n))
                plain[s].append((path, kind, Fraction(n, N), None))
    got = placed(spark, table, "29.97F", rollover=policy)
    seen = set()
    for s, rows in plain.items():
        want, refusal = brute_origin(rows, policy)
        seen.add(refusal)
        assert {p: got[p]["refusal"] for p, *_ in rows} == {p: refusal for p, *_ in rows}, rows
        assert {p: got[p]["position"] for p, *_ in rows} == (want or {p: None for p, *_ in rows}), rows
    assert {None, "rollover_ambiguous"} <= seen


def laid(spark, chunks, policy):
    """chunks: (track, path, position, length, quantum)."""
    rows = [("s", t, p, a, n, (("reference", 0, 0, 0, q))) for t, p, a, n, q in chunks]
    table = spark.createDataFrame(rows, "session string, track string, path string, position long, n long, start struct<kind:string,count:bigint,flicks:bigint,day:bigint,quantum:bigint>")
    return {r["path"]: r for r in O.lay_out(table, ["session"], "track", "path", "n", F.lit(policy)).collect()}


def test_layout_policies(spark):
    chunks = [("a", "z first", 0, 1000, 10), ("a", "within", 995, 500, 10), ("a", "gap", 2000, 100, 10), ("a", "beyond", 2050, 100, 10), ("a", "cascade", 2120, 50, 10), ("b", "coarse", 0, 1000, 1600), ("b", "fine", 10, 5, 1), ("b", "tie", 10, 5, 1)]
    got = laid(spark, chunks, "reject")
    assert {p: r["verdict"] for p, r in got.items()} == {"z first": None, "within": "chunk_overlap_quantization", "gap": "chunk_gap_preserved", "beyond": "chunk_overlap", "cascade": "chunk_overlap", "coarse": None, "fine": "chunk_overlap_quantization", "tie": "chunk_overlap"}
    nudged = laid(spark, chunks, "nudge_later")
    assert nudged["beyond"]["verdict"] == nudged["cascade"]["verdict"] == "chunk_overlap_nudged" and nudged["cascade"]["placed"] == 2200 and nudged["cascade"]["shift"] == 80


def test_layouts_match_a_walk(spark):
    rng = random.Random(3)
    chunks = [(f"t{rng.randrange(6)}", f"p{i:03d}", rng.randrange(3000), rng.randrange(1, 200), rng.choice([1, 5, 60])) for i in range(150)]
    got = laid(spark, chunks, "nudge_later")
    for t in {c[0] for c in chunks}:
        end = before = None
        for _, p, a, n, q in sorted((c for c in chunks if c[0] == t), key=lambda c: (c[2], c[1])):
            place = a if end is None else max(a, end)
            verdict = None if end is None or a == end else "chunk_gap_preserved" if a > end else "chunk_overlap_quantization" if end - a <= max(1, q, before) else "chunk_overlap_nudged"
            assert (got[p]["placed"], got[p]["verdict"]) == (place, verdict)
            end, before = place + n, q


def test_unfit_sources(spark):
    rows = [("s", "a", "1", 48000, 1, "pcm_f32le", 5), ("s", "b", "2", 44100, 1, "pcm_f32le", 5), ("s", "b", "3", 48000, 1, "pcm_f32le", 5), ("s", "c", "4", 44100, 1, "pcm_f32le", 5), ("s", "d", "5", 48000, 2, "pcm_f32le", 5), ("s", "e", "6", 48000, 1, "pcm_s32le", 5), ("s", "f", "7", 48000, 1, "pcm_s16le", None), ("s", "g", "8", None, None, None, None)]
    got = O.unfit(spark.createDataFrame(rows, "session string, track string, path string, rate int, channels int, codec string, samples long"), ["session"], "track")
    assert {r["path"]: r["unfit"] for r in got.collect()} == {"1": None, "2": "inconsistent_sample_rate", "3": "inconsistent_sample_rate", "4": "unsupported_sample_rate", "5": "undecodable_source", "6": "undecodable_source", "7": "unknown_sample_count", "8": "source_not_inspected"}


# ---- whole sessions from files


def made(tmp_path, evidence="bext", folders=False, **change):
    spec = replace(fixtures.canonical(), **change)
    return spec, fixtures.write(spec, str(tmp_path), evidence, folders)


def entries_of(spark, folder, **settings):
    report, own = chain.Report("s"), chain.Settings(**settings)
    sources = chain.sources_of(spark, str(folder), report, own)
    entries, length = chain.timeline(sources, own, report)
    return sorted((r["track"], r["placed"], r["samples"]) for r in entries.collect()), length, report.decisions


@pytest.mark.parametrize(("evidence", "label", "origin"), [("bext", "30F", 86390), ("30F", "30F", 86390), ("29.97DF", "29.97DF", 3600), ("25F", "25F", 86395)])
def test_sessions_keep_their_length_across_midnight(spark, tmp_path, evidence, label, origin):
    spec, truth = made(tmp_path, evidence, origin=origin * N)
    got, length, decisions = entries_of(spark, tmp_path, frame_rate=label)
    slack = 0 if evidence == "bext" else 2 * N // 24  # a timecode tag is rounded down to a frame
    assert abs(length - spec.seconds * N) <= slack and all(t == w[0] and abs(a - w[1]) <= slack and n == w[2] for (t, a, n), w in zip(got, truth["placements"], strict=True))
    codes = {d["code"] for d in decisions}
    assert ("midnight_rollover_inferred" in codes) == (origin > 86000)


def test_copies_and_edits_never_reach_the_layout(spark, tmp_path):
    spec, truth = made(tmp_path, folders=True)
    first = sorted(os.listdir(tmp_path / "tx1"))
    shutil.copy(tmp_path / "tx1" / first[0], tmp_path / "tx1" / "a copy.wav")
    shutil.copy(tmp_path / "tx2" / os.listdir(tmp_path / "tx2")[0], tmp_path / "tx3" / "zz.wav")
    data = bytearray((tmp_path / "tx1" / first[1]).read_bytes())
    data[-4:] = b"\0\0\0\0"
    (tmp_path / "tx1" / first[1].replace("_orig", "_edit")).write_bytes(data)
    (tmp_path / "notes.txt").write_text("x")
    folders = {"tracks": ("tx1", "tx2", "tx3", "tx4")}
    got, length, decisions = entries_of(spark, tmp_path, **folders)
    assert got == truth["placements"] and length == spec.seconds * N
    told = {d["name"]: d["wrong"] for d in decisions if d["code"] == "source_ignored"}
    assert told == {"a copy": "duplicate_content", "zz": "duplicate_content", first[1][:-9] + "_edit": "processed_variant_ignored"}
    flat = tmp_path / "flat"
    flat.mkdir()
    for n in first:
        shutil.copy(tmp_path / "tx1" / n, flat / n)
        shutil.copy(tmp_path / "tx1" / n, flat / n.replace("_orig", "_edit"))
    assert entries_of(spark, flat)[0] == [w for w in truth["placements"] if w[0] == 1]
    with pytest.raises(ValueError, match="required_track_missing"):
        entries_of(spark, tmp_path, active=(1, 4), **folders)


def test_sources_without_evidence_are_refused_or_told_of(spark, tmp_path):
    spec, truth = made(tmp_path, "none")
    with pytest.raises(ValueError, match="no_start_time"):
        entries_of(spark, tmp_path)
    names = {(c.track, c.sequence): fixtures.name(spec, c) for c in spec.chunks}
    told = tuple({"path": names[c.track, c.sequence], "start_offset": c.start - 5 * N, "reason": "log"} for c in spec.chunks)
    got, length, decisions = entries_of(spark, tmp_path, overrides=told)
    assert got == truth["placements"] and {d["code"] for d in decisions} >= {"timeline_shifted_to_earliest_source"}
    with pytest.raises(ValueError, match="override_hash_mismatch"):
        entries_of(spark, tmp_path, overrides=(told[0] | {"sha256": "0" * 64}, *told[1:]))
    with pytest.raises(ValueError, match="recovery_override_unmatched"):
        entries_of(spark, tmp_path, overrides=(*told, {"path": "no such.wav", "start_offset": 0}))
    with pytest.raises(ValueError, match="audio_before_session_zero"):
        entries_of(spark, tmp_path, overrides=told, origin_timecode="00:00:00:00")


def test_overlapping_chunks_follow_the_policy(spark, tmp_path):
    base = fixtures.canonical()
    base.chunks[1] = replace(base.chunks[1], start=19 * N)
    spec, _ = made(tmp_path, chunks=base.chunks)
    with pytest.raises(ValueError, match="chunk_overlap"):
        entries_of(spark, tmp_path)
    got, _, decisions = entries_of(spark, tmp_path, overlap="nudge_later")
    assert (1, 20 * N, base.chunks[1].length) in got and "chunk_overlap_nudged" in {d["code"] for d in decisions}
