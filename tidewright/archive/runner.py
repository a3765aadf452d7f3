"""Upload, verify, restore, status and list. One Spark task for each file; the driver only commits.

A manifest is written last, so that a session without one isn't archived. Every report is a dict, whichever way
the run went. Tasks may run twice: what they write is the same and appears by rename.
"""

from __future__ import annotations

import io
import json
import os
import shutil
import stat
import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tidewright.archive import codec
from tidewright.archive.storage import MANIFEST, PREFIX, ArchiveError, Storage, decode, encode, manifest_key, object_key, objects_prefix, retry, single_writer
from tidewright.sources.files import canonical_json

ENTRY = "path string, track_id string, size_bytes long, sha256 string"
RESULT = "path string, outcome string, code string, message string, size_bytes long, sha256 string, compressed_size_bytes long, compressed_sha256 string"


def attribute(path: str, tracks: dict[str, str]) -> str | None:
    """The track whose input folder holds the path, if exactly one does."""
    found = [t for t, folder in tracks.items() if path == folder or path.startswith(folder.rstrip("/") + "/")]
    return found[0] if len(found) == 1 else None


def source_set(spark: SparkSession, folder: str, tracks: dict[str, str], inputs: str = "raw") -> DataFrame:
    """path, track_id, size_bytes, sha256 of every file below folder/inputs.

    The walk is the driver's and looks at no content: a symbolic link, a device, or whatever else isn't a plain file or
    folder is refused. Files are hashed by tasks.
    """
    root = os.path.realpath(folder)
    rows: list[tuple[str, str | None]] = []

    def walk(at: str) -> None:
        for e in sorted(os.scandir(at), key=lambda e: os.fsencode(e.name)):
            mode = e.stat(follow_symlinks=False).st_mode
            if stat.S_ISLNK(mode):
                raise ArchiveError("archive_source_symlink", f"{e.path} is a symbolic link")
            if stat.S_ISDIR(mode):
                walk(e.path)
            elif stat.S_ISREG(mode):
                path = os.path.relpath(e.path, root)
                rows.append((encode(path), attribute(path, tracks)))
            else:
                raise ArchiveError("archive_source_irregular", f"{e.path} is neither a file nor a folder")

    start = os.path.join(root, inputs)
    if os.path.realpath(start) != start:
        raise ArchiveError("archive_source_escapes", f"{start} leads elsewhere")
    walk(start)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path, track in zip(frame["path"], frame["track_id"], strict=True):
                handle = os.open(os.path.join(root, decode(path)), os.O_RDONLY | os.O_NOFOLLOW)
                with os.fdopen(handle, "rb") as f:
                    m = codec.digest(f)
                out.append((path, track, m.size, m.sha256))
            yield pd.DataFrame(out, columns=["path", "track_id", "size_bytes", "sha256"])

    return _spread(spark.createDataFrame(rows, "path string, track_id string"), len(rows)).mapInPandas(measure, ENTRY)


def _spread(entries: DataFrame, n: int) -> DataFrame:
    return entries.repartition(max(1, min(n, 4096)), "path")


def _each(entries: list[dict], spark: SparkSession, columns: str, act: Callable[[dict], tuple]) -> list[dict]:
    """act() for every entry in a task of its own; an entry's failure is its result, not the job's."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RESULT.split(", ")]
        for frame in frames:
            rows = []
            for e in frame.to_dict("records"):
                try:
                    rows.append((e["path"], *act(e)))
                except (ArchiveError, OSError) as x:
                    rows.append((e["path"], "failed", getattr(x, "code", "archive_io"), str(x), 0, None, 0, None))
            yield pd.DataFrame(rows, columns=names)

    names = [c.split()[0] for c in columns.split(", ")]
    df = spark.createDataFrame([tuple(e[c] for c in names) for e in entries], columns)
    return [r.asDict() for r in _spread(df, len(entries)).mapInPandas(run, RESULT).orderBy("path").collect()]


def read_back(storage: Storage, name: str, size: int, sha256: str, packed_sha256: str, target=None) -> codec.Measure:
    """The stored object decompressed and held to its sizes and hashes; returns the compressed measure."""
    with retry(lambda: storage.open(name)) as body:
        plain, packed = codec.decompress(body, size, target)
    if (plain.size, plain.sha256, packed.sha256) != (size, sha256, packed_sha256):
        raise ArchiveError("archive_object_differs", f"{name} doesn't restore to what was archived")
    return packed


def read_manifest(storage: Storage, session: str) -> tuple[dict, str] | None:
    """The committed manifest and the sha256 of its bytes; it must be this session's, and point at its objects only."""
    if storage.head(manifest_key(session)) is None:
        return None
    with storage.open(manifest_key(session)) as f:
        raw = f.read()
    try:
        manifest = json.loads(raw)
        entries = manifest["entries"]
        keys = [e["object_key"] for e in entries]
        known = [(e["path"], e["size_bytes"], e["sha256"], e["compressed_sha256"]) for e in entries]
    except (ValueError, KeyError, TypeError) as x:
        raise ArchiveError("archive_manifest_unreadable", f"the manifest of {session!r} can't be read: {x}") from None
    if manifest.get("session_id") != session:
        raise ArchiveError("archive_manifest_foreign", f"the manifest at {session!r} is that of {manifest.get('session_id')!r}")
    if any(not k.startswith(objects_prefix(session)) for k in keys):
        raise ArchiveError("archive_manifest_foreign", f"the manifest of {session!r} points outside its objects")
    if not known:
        raise ArchiveError("archive_manifest_unreadable", f"the manifest of {session!r} is empty")
    return manifest, codec.digest(io.BytesIO(raw)).sha256


def _report(operation: str, session: str, results: list[dict], good: set[str], verification: tuple[str, str], **more) -> dict:
    bad = [r for r in results if r["outcome"] not in good]
    status = "complete" if not bad else "partial" if len(bad) < len(results) else "failed"
    errors = [{"path": r["path"], "code": r["code"], "message": r["message"]} for r in bad]
    return {"operation": operation, "session_id": session, "status": status, "verification": verification[bool(bad)], "objects": results, "errors": errors, **more}


def _failed(operation: str, session: str, x: Exception, verification: str = "absent") -> dict:
    error = {"path": None, "code": getattr(x, "code", "archive_io"), "message": str(x)}
    return {"operation": operation, "session_id": session, "status": "failed", "verification": verification, "objects": [], "errors": [error]}


def _as_rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.orderBy("path").collect()]  # one row a file of one session


def upload(spark: SparkSession, folder: str, session: str, tracks: dict[str, str], storage: Storage, inputs: str = "raw", free_bytes: int | None = None) -> dict:
    """Archives a session. Archived already with the same files: nothing to do. With others: refused.

    Each file is compressed, checked, stored and read back whole; then all sources are hashed again, and only if none
    has changed the manifest is committed.
    """
    try:
        with single_writer(os.path.join(folder, ".archive")):
            before = _as_rows(source_set(spark, folder, tracks, inputs))
            if not before:
                raise ArchiveError("archive_nothing_to_do", "the session has no files")
            largest = max(e["size_bytes"] for e in before)
            free = shutil.disk_usage(folder).free if free_bytes is None else free_bytes
            if free < largest + (largest >> 8) + (1 << 16):
                raise ArchiveError("archive_disk_full", f"{free} bytes free; a file needs {largest} at worst")
            known = read_manifest(storage, session)
            if known is not None:
                return _existing(known, before, session)
            results = _each(before, spark, ENTRY, _store(folder, session, storage))
            if any(r["outcome"] == "failed" for r in results):
                return _report("upload", session, results, {"uploaded", "already_present"}, ("verified", "pending"))
            after = _as_rows(source_set(spark, folder, tracks, inputs))
            if after != before:
                raise ArchiveError("archive_source_changed", "a source changed during the upload")
            return _commit(folder, session, before, results, storage)
    except (ArchiveError, OSError) as x:
        return _failed("upload", session, x)


def _existing(known: tuple[dict, str], sources: list[dict], session: str) -> dict:
    listed = [(e["path"], e["size_bytes"], e["sha256"]) for e in known[0]["entries"]]
    if listed != [(e["path"], e["size_bytes"], e["sha256"]) for e in sources]:
        raise ArchiveError("archive_identity_differs", f"{session!r} is archived with other files; a committed archive never changes")
    results = [{"path": p, "outcome": "already_present", "code": None, "message": None, "size_bytes": s, "sha256": h} for p, s, h in listed]
    return _report("upload", session, results, {"already_present"}, ("previously_verified_at_commit", "divergent"), manifest_sha256=known[1])


def _store(folder: str, session: str, storage: Storage) -> Callable[[dict], tuple]:
    def act(e: dict) -> tuple:
        path = decode(e["path"])
        name = object_key(session, path, e["sha256"])
        with tempfile.NamedTemporaryFile() as staged:  # scratch of this task alone; nobody else reads it
            with open(os.path.join(folder, path), "rb") as f:
                plain, packed = codec.compress(f, staged, e["size_bytes"])
            staged.flush()
            if (plain.size, plain.sha256) != (e["size_bytes"], e["sha256"]):
                raise ArchiveError("archive_source_changed", f"{path} changed while it was read")
            with open(staged.name, "rb") as f:
                if codec.decompress(f, plain.size)[0].sha256 != plain.sha256:
                    raise ArchiveError("archive_codec_broken", f"{path} doesn't decompress to itself")
            present = storage.head(name) is not None
            if not present:
                retry(lambda: storage.put(name, staged.name))
        try:
            read_back(storage, name, plain.size, plain.sha256, packed.sha256)
        except ArchiveError:
            if present:
                raise ArchiveError("archive_object_conflict", f"{name} is there already, with other content") from None
            raise
        return "already_present" if present else "uploaded", None, None, plain.size, plain.sha256, packed.size, packed.sha256

    return act


def _commit(folder: str, session: str, sources: list[dict], results: list[dict], storage: Storage) -> dict:
    track = {e["path"]: e["track_id"] for e in sources}
    entries = []
    for r in results:
        text = os.fsencode(decode(r["path"]))
        own = {c: r[c] for c in ("path", "size_bytes", "sha256", "compressed_size_bytes", "compressed_sha256")}
        try:
            own["path_text"] = text.decode()
        except UnicodeDecodeError:
            own["path_text"] = None
        entries.append(own | {"track_id": track[r["path"]], "object_key": object_key(session, decode(r["path"]), r["sha256"])})
    data = canonical_json({"archive_version": 1, "session_id": session, "codec": codec.RECIPE, "entries": entries}).encode()
    with tempfile.NamedTemporaryFile() as f:
        f.write(data)
        f.flush()
        retry(lambda: storage.put(manifest_key(session), f.name))
    known = read_manifest(storage, session)
    return _report("upload", session, results, {"uploaded", "already_present"}, ("verified", "pending"), manifest_sha256=known[1])


def _selected(storage: Storage, session: str, track: str | None) -> tuple[list[dict], str]:
    known = read_manifest(storage, session)
    if known is None:
        raise ArchiveError("archive_absent", f"{session!r} isn't archived")
    entries = [e for e in known[0]["entries"] if track is None or e["track_id"] == track]
    if not entries:
        raise ArchiveError("archive_track_unknown", f"{session!r} has no files of track {track!r}")
    return entries, known[1]


PICK = ENTRY + ", object_key string, compressed_sha256 string"


def verify(spark: SparkSession, session: str, storage: Storage, track: str | None = None) -> dict:
    """Reads every selected object back whole. All good: verified; else divergent."""
    try:
        entries, sha = _selected(storage, session, track)
    except (ArchiveError, OSError) as x:
        return _failed("verify", session, x)

    def act(e: dict) -> tuple:
        packed = read_back(storage, e["object_key"], e["size_bytes"], e["sha256"], e["compressed_sha256"])
        return "verified", None, None, e["size_bytes"], e["sha256"], packed.size, packed.sha256

    return _report("verify", session, _each(entries, spark, PICK, act), {"verified"}, ("verified", "divergent"), manifest_sha256=sha)


def restore(spark: SparkSession, session: str, storage: Storage, destination: str, track: str | None = None) -> dict:
    """Rebuilds the files below destination, which must not exist: in a folder beside it, published by one rename.

    If a file fails nothing is published, and files that did restore are reported as skipped.
    """
    destination = os.path.abspath(destination)
    beside = destination + ".restoring"
    try:
        if os.path.lexists(destination):
            raise ArchiveError("archive_destination_exists", f"{destination} is there already")
        entries, sha = _selected(storage, session, track)
        for e in entries:
            inside = os.path.normpath(decode(e["path"]))
            if os.path.isabs(inside) or inside.split(os.sep)[0] == "..":
                raise ArchiveError("archive_path_escapes", f"{inside} leaves the destination")
        free = shutil.disk_usage(os.path.dirname(destination)).free
        if free < sum(e["size_bytes"] for e in entries):
            raise ArchiveError("archive_disk_full", f"{free} bytes free")
        shutil.rmtree(beside, ignore_errors=True)
        os.makedirs(beside)
    except (ArchiveError, OSError) as x:
        return _failed("restore", session, x)

    def act(e: dict) -> tuple:
        at = os.path.join(beside, decode(e["path"]))
        os.makedirs(os.path.dirname(at), exist_ok=True)
        with tempfile.NamedTemporaryFile(dir=os.path.dirname(at), delete=False) as f:
            packed = read_back(storage, e["object_key"], e["size_bytes"], e["sha256"], e["compressed_sha256"], f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(f.name, at)
        return "restored", None, None, e["size_bytes"], e["sha256"], packed.size, packed.sha256

    results = _each(entries, spark, PICK, act)
    try:
        if all(r["outcome"] == "restored" for r in results):
            os.rename(beside, destination)
    except OSError as x:
        results = [r | {"outcome": "failed", "code": "archive_publish", "message": str(x)} for r in results]
    if any(r["outcome"] == "failed" for r in results):
        shutil.rmtree(beside, ignore_errors=True)
        results = [r | {"outcome": "skipped", "code": "archive_unpublished", "message": "another file failed"} if r["outcome"] == "restored" else r for r in results]
    return _report("restore", session, results, {"restored"}, ("verified", "divergent"), manifest_sha256=sha)


def status(storage: Storage, session: str) -> dict:
    """absent, pending (objects without a manifest), divergent (a listed object is missing) or as verified at commit."""
    try:
        known = read_manifest(storage, session)
        if known is None:
            some = next(iter(storage.list(objects_prefix(session))), None)
            return _report("status", session, [], set(), ("pending" if some else "absent",) * 2)
        results = []
        for e in known[0]["entries"]:
            there = storage.head(e["object_key"]) == e["compressed_size_bytes"]
            results.append({"path": e["path"], "outcome": "present" if there else "failed", "code": None if there else "archive_object_missing", "message": None, "size_bytes": e["size_bytes"]})
        return _report("status", session, results, {"present"}, ("previously_verified_at_commit", "divergent"), manifest_sha256=known[1])
    except (ArchiveError, OSError) as x:
        return _failed("status", session, x)


def sessions(storage: Storage) -> list[str]:
    """Sessions with a committed manifest."""
    out = set()
    for name in storage.list(PREFIX + "/"):
        parts = name.removeprefix(PREFIX + "/").split("/")
        if parts[1:] == [MANIFEST]:
            out.add(decode(parts[0]))
    return sorted(out)


def session_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows (change, path, size_bytes, sha256) that came or went between two source sets."""
    from pyspark.sql import functions as F

    columns = ["path", "size_bytes", "sha256"]
    a, b = before.select(*columns), after.select(*columns)
    return a.exceptAll(b).select(F.lit("gone").alias("change"), *columns).unionByName(b.exceptAll(a).select(F.lit("new").alias("change"), *columns))
