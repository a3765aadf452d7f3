"""Archives: round trips, refusals, corruption."""

import io
import os

import pytest

from tidewright.archive import codec, runner
from tidewright.archive.storage import ArchiveError, FolderStorage, decode, encode, key, manifest_key, objects_prefix, part_size, retry, single_writer

TRACKS = {"tx-a": "raw/tx-a", "tx-b": "raw/tx-b"}


@pytest.fixture
def session(tmp_path):
    for name, data in (("raw/tx-a/one.wav", b"abc" * 50_000), ("raw/tx-a/zwei ü.wav", b""), ("raw/tx-b/three.wav", os.urandom(70_000)), ("raw/notes.txt", b"n")):
        at = tmp_path / "session" / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(data)
    return str(tmp_path / "session")


def files(folder):
    return {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(folder) for f in fs if f != ".lock"}


def test_round_trip(spark, session, tmp_path):
    store = FolderStorage(str(tmp_path / "store"))
    assert runner.status(store, "s 1")["verification"] == "absent"
    first = runner.upload(spark, session, "s 1", TRACKS, store)
    assert (first["status"], first["verification"]) == ("complete", "verified")
    assert {decode(o["path"]) for o in first["objects"]} == set(files(session))
    again = runner.upload(spark, session, "s 1", TRACKS, store)
    assert {o["outcome"] for o in again["objects"]} == {"already_present"} and again["manifest_sha256"] == first["manifest_sha256"]
    assert runner.sessions(store) == ["s 1"]
    assert runner.verify(spark, "s 1", store)["verification"] == "verified"
    back = runner.restore(spark, "s 1", store, str(tmp_path / "back"))
    assert back["status"] == "complete" and files(str(tmp_path / "back")) == files(session)
    assert runner.restore(spark, "s 1", store, str(tmp_path / "back"))["errors"][0]["code"] == "archive_destination_exists"
    part = runner.restore(spark, "s 1", store, str(tmp_path / "part"), "tx-b")
    assert [decode(o["path"]) for o in part["objects"]] == ["raw/tx-b/three.wav"]
    assert runner.verify(spark, "s 1", store, "tx-z")["errors"][0]["code"] == "archive_track_unknown"
    with open(os.path.join(session, "raw/notes.txt"), "wb") as f:
        f.write(b"other")
    assert runner.upload(spark, session, "s 1", TRACKS, store)["errors"][0]["code"] == "archive_identity_differs"


def test_corruption_is_found_and_nothing_is_published(spark, session, tmp_path):
    store = FolderStorage(str(tmp_path / "store"))
    runner.upload(spark, session, "s", TRACKS, store)
    at = os.path.join(store.root, next(store.list(objects_prefix("s") + "raw%2Ftx-a%2Fone.wav")))
    data = bytearray(open(at, "rb").read())
    data[len(data) // 2] ^= 1
    open(at, "wb").write(data)
    report = runner.verify(spark, "s", store)
    assert (report["status"], report["verification"], len(report["errors"])) == ("partial", "divergent", 1)
    report = runner.restore(spark, "s", store, str(tmp_path / "back"))
    assert report["verification"] == "divergent" and not os.path.exists(tmp_path / "back")
    assert {o["outcome"] for o in report["objects"]} == {"failed", "skipped"}
    os.unlink(at)
    assert runner.status(store, "s")["verification"] == "divergent"


def test_foreign_manifest(spark, session, tmp_path):
    store = FolderStorage(str(tmp_path / "store"))
    runner.upload(spark, session, "s", TRACKS, store)
    store.put(manifest_key("t"), os.path.join(store.root, manifest_key("s")))
    assert runner.verify(spark, "t", store)["errors"][0]["code"] == "archive_manifest_foreign"


def test_links_are_refused(spark, session, tmp_path):
    os.symlink("/etc/hostname", os.path.join(session, "raw/tx-a/link.wav"))
    report = runner.upload(spark, session, "s", TRACKS, FolderStorage(str(tmp_path / "store")))
    assert report["status"] == "failed" and report["errors"][0]["code"] == "archive_source_symlink"


def test_source_changes(spark, session):
    before = runner.source_set(spark, session, TRACKS).cache()
    assert before.count() == 4
    with open(os.path.join(session, "raw/notes.txt"), "wb") as f:
        f.write(b"m")
    got = runner.session_changes(before, runner.source_set(spark, session, TRACKS)).collect()
    assert sorted((r["change"], r["path"]) for r in got) == [("gone", "raw%2Fnotes.txt"), ("new", "raw%2Fnotes.txt")]


def test_codec_bounds():
    data = bytes(10_000_000)
    packed = io.BytesIO()
    plain, size = codec.compress(io.BytesIO(data), packed)
    assert plain.size == len(data) and size.size == len(packed.getvalue()) < 10_000
    assert codec.decompress(io.BytesIO(packed.getvalue()), len(data))[0].sha256 == plain.sha256
    for raw, limit, code in ((packed.getvalue(), 1000, "archive_object_too_large"), (packed.getvalue()[:-3], 1 << 30, "archive_object_corrupt"), (b"junk" * 9, 1000, "archive_object_corrupt")):
        with pytest.raises(ArchiveError) as e:
            codec.decompress(io.BytesIO(raw), limit)
        assert e.value.code == code


def test_keys():
    name = os.fsdecode(b"a/\xff \xc3\xbc~.wav")
    assert encode(name) == "a%2F%FF%20%C3%BC~.wav" and decode(encode(name)) == name
    for bad in ("a%2f", "a b", "%41", "ü"):
        with pytest.raises(ArchiveError):
            decode(bad)
    with pytest.raises(ArchiveError):
        key("x" * 1100)
    assert part_size(1) == 8 << 20 and part_size(10_000 * (9 << 20)) == 9 << 20


def test_lock_and_retry(tmp_path):
    with single_writer(str(tmp_path)), pytest.raises(ArchiveError), single_writer(str(tmp_path)):
        pass
    calls = []

    def busy():
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError
        return 5

    assert retry(busy, first=0.001) == 5 and len(calls) == 3


def test_many_sessions_as_tables(spark, session, tmp_path):
    """Results are rows; a broken object, a missing one and a session without a manifest are told of where they belong."""
    from tidewright.archive import tables

    store = FolderStorage(str(tmp_path / "store"))
    for name in ("s 1", "s 2", "s 3"):
        assert runner.upload(spark, session, name, TRACKS, store)["status"] == "complete"
    at = os.path.join(store.root, next(store.list(objects_prefix("s 2") + "raw%2Ftx-a%2Fone.wav")))
    data = bytearray(open(at, "rb").read())
    data[len(data) // 2] ^= 1
    open(at, "wb").write(data)
    os.unlink(os.path.join(store.root, next(store.list(objects_prefix("s 3") + "raw%2Fnotes.txt"))))
    asked = spark.createDataFrame([(n,) for n in ("s 1", "s 2", "s 3", "nobody", "s 1")], "session string")
    got = {r["session"]: r for r in tables.totals(tables.verified(asked, store)).collect()}
    assert {s: (r["status"], r["objects"], r["failed"]) for s, r in got.items()} == {"s 1": ("complete", 4, 0), "s 2": ("partial", 4, 1), "s 3": ("partial", 4, 1), "nobody": ("failed", 1, 1)}
    assert got["nobody"]["codes"] == ["archive_absent"] and got["s 1"]["size_bytes"] == sum(map(len, files(session).values())) and 0 < got["s 1"]["compressed_size_bytes"]
    there = {r["session"]: (r["status"], r["codes"]) for r in tables.totals(tables.present(asked, store)).collect()}
    assert there == {"s 1": ("complete", []), "s 2": ("complete", []), "s 3": ("partial", ["archive_object_missing"]), "nobody": ("failed", ["archive_absent"])}
