"""Discovery against a plain version on random folders, and its rules one by one."""

import random
import re
from collections import defaultdict

import pytest

from tidewright.operators import discovery as D


def discover(spark, files, tracks, allow=False, active=None, overrides=()):
    f = spark.createDataFrame([("s", p, h) for p, h in files.items()] or [], "session string, path string, sha256 string")
    t = spark.createDataFrame([("s", k, v) for k, v in tracks.items()], "session string, track string, input string")
    o = spark.createDataFrame([("s", p) for p in overrides], "session string, path string")
    return D.discover(f, t, spark.createDataFrame([("s", allow, active)], "session string, allow_processed boolean, active array<string>"), o)


def told(d):
    roles = {r["path"]: (r["track"], r["role"], r["reason"], r["associated"]) for r in d.sources.collect()}
    return roles, {r["track"]: r["state"] for r in d.roster.collect()}, sorted((r["code"], r["subject"]) for r in d.notes.collect()), sorted((r["code"], r["subject"]) for r in d.refusals.collect())


NAME = re.compile(r"^TX(\d{2})_MIC(\d{3,})_\d{8}_\d{6}_(orig|edit)$", re.IGNORECASE)


def plain(files, tracks, allow, active):
    """Roles and roster states, rule by rule over dictionaries."""
    by_dir = {v: k for k, v in tracks.items()}
    roots = {v.rpartition("/")[0] for v in tracks.values()}
    kind = {}
    for p in files:
        folder = p.rpartition("/")[0]
        if folder in by_dir:
            kind[p] = by_dir[folder] if p.lower().endswith(".wav") else "other"
            continue
        kind[p] = "ignored"
        for root in roots:
            if root and not p.startswith(root + "/"):
                continue
            rest = p[len(root) + 1 :] if root else p
            top = (root + "/" if root else "") + rest.split("/")[0]
            if "/" not in rest or (top not in by_dir and not (not root and top in ("work", "output"))):
                if p.lower().endswith(".wav"):
                    kind[p] = None
    taken = [p for p, k in kind.items() if k not in ("other", "ignored")]
    stem = lambda p: p.rpartition("/")[2].rpartition(".")[0]
    variant = {p: stem(p).lower()[-4:] if stem(p).lower().endswith(("_orig", "_edit")) else "unknown" for p in taken}
    copies = defaultdict(list)
    for p in taken:
        copies[files[p]].append(p)
    keeper = {p: min(copies[files[p]], key=lambda q: (kind[q] is None, variant[q] == "edit", q)) for p in taken}

    def key(p):
        m = NAME.match(stem(p))
        return (m[1], int(m[2])) if m else (p.rpartition("/")[0], re.sub(r"(?i)_(orig|edit)$", "", stem(p)))

    roles = {}
    for p in taken:
        live = any(kind[q] == kind[p] and variant[q] != "edit" and keeper[q] == q for q in taken)
        if keeper[p] != p:
            roles[p] = (kind[p], "duplicate", "duplicate_content", keeper[p])
        elif kind[p] is None:
            roles[p] = (None, "unassigned", "directory_not_configured", None)
        elif variant[p] == "edit" and live:
            partners = [q for q in taken if kind[q] == kind[p] and variant[q] != "edit" and key(q) == key(p)]
            roles[p] = (kind[p], "associated_edit", "processed_variant_ignored", max(partners, default=None))
        else:
            roles[p] = (kind[p], "selected", "processed_audio_selected" if variant[p] == "edit" else "original_selected", None)
    states = {}
    for t, folder in tracks.items():
        own = [r for r in roles.values() if r[0] == t]
        there = any(p.rpartition("/")[0] == folder for p in files)
        states[t] = (
            "not_listed" if active is not None and t not in active else "active" if any(r[1] == "selected" for r in own) else "missing_directory" if not there
            else "empty_directory" if not own else "all_duplicates" if all(r[1] == "duplicate" for r in own) else "no_usable_original"
        )
    return roles, states


@pytest.mark.parametrize("seed", range(5))
def test_random_folders_match_a_plain_version(spark, seed):
    rng = random.Random(seed)
    root = "" if seed == 4 else "raw/"
    tracks = {t: root + t for t in ("a", "b", "c", "d")}
    files = {}
    for i in range(rng.randint(5, 40)):
        folder = rng.choice([root + "a", root + "b", root + "c", root + "x/deep", root + "a/deeper", root.rstrip("/"), "work", "elsewhere"])
        name = rng.choice([f"TX0{rng.randint(1, 2)}_MIC{rng.randint(1, 4):03d}_20240101_120000_{rng.choice(['orig', 'edit', 'EDIT'])}.wav", f"take{rng.randint(1, 3)}{rng.choice(['', '_orig', '_edit'])}.{rng.choice(['wav', 'WAV'])}", f"note{i}.txt"])
        files[f"{folder}/{name}".lstrip("/")] = str(rng.randint(1, 12))
    active = rng.choice([None, ["a", "d"]])
    got = told(discover(spark, files, tracks, True, active))
    want = plain(files, tracks, True, active)
    assert got[0] == want[0] and got[1] == want[1]


def test_notes_and_refusals(spark):
    one = "TX01_MIC001_20240101_000000"
    files = {
        f"raw/a/{one}_orig.wav": "1", f"raw/a/{one}_edit.wav": "2", "raw/a/copy.wav": "1", "raw/a/TX02_MIC004_20240101_000000_orig.wav": "3", "raw/a/readme": "4",
        "raw/b/only_edit.wav": "5", "raw/c/copy.wav": "1", "raw/e/x.txt": "6", "raw/extra/deep/y.wav": "7", "raw/loose.wav": "8",
    }
    tracks = {t: f"raw/{t}" for t in "abcde"}
    roles, states, notes, refusals = told(discover(spark, files, tracks, overrides=("raw/loose.wav", "raw/gone.wav")))
    assert states == {"a": "active", "b": "active", "c": "all_duplicates", "d": "missing_directory", "e": "empty_directory"}
    assert refusals == [("processed_audio_only", "b"), ("recovery_override_unmatched", "raw/gone.wav")]
    assert notes == sorted([
        ("duplicate_source", "raw/a/copy.wav"), ("duplicate_across_tracks", "raw/c/copy.wav"), ("extra_directory", "raw/extra"), ("mixed_transmitter_labels", "a"), ("orig_selected", f"raw/a/{one}_orig.wav"),
        ("sequence_discontinuity", "a"), ("stray_audio_file", "raw/loose.wav"), ("track_inactive", "c"), ("track_inactive", "d"), ("track_inactive", "e"), ("unexpected_file_type", "raw/a/readme"),
        ("unexpected_file_type", "raw/e/x.txt"), ("unrecognized_filename", "raw/b/only_edit.wav"),
    ])
    _, states, notes, refusals = told(discover(spark, files, tracks, True, ["a", "c"]))
    assert states["b"] == "not_listed" and states["c"] == "all_duplicates" and refusals == [("required_track_missing", "c")]
    assert ("processed_audio_allowed", "b") in notes and not any(n[0] == "track_inactive" for n in notes)


def test_a_stray_that_sorts_first_displaces_nobody(spark):
    roles, states, _, _ = told(discover(spark, {"raw/aaa.wav": "1", "raw/t/x_orig.wav": "1", "raw/t/x_edit.wav": "1"}, {"t": "raw/t"}))
    assert roles["raw/t/x_orig.wav"][1] == "selected" and roles["raw/aaa.wav"][1] == roles["raw/t/x_edit.wav"][1] == "duplicate" and states == {"t": "active"}


def test_no_files_at_all(spark):
    roles, states, notes, refusals = told(discover(spark, {}, {"t": "raw/t"}, active=["t"]))
    assert (roles, states, refusals) == ({}, {"t": "missing_directory"}, [("required_track_missing", "t")]) and notes == []
