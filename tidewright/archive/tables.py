"""Archives of many sessions as tables: what is listed, what is stored, what restores.

The driver hands out session names only. A task reads a session's manifest and gives out its entries; these are dealt anew, so that a session
with many files isn't one task's work; each object is then read where its row lies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.archive.runner import read_back, read_manifest
from tidewright.archive.storage import ArchiveError, Storage
from tidewright.sources.shared import importable

ENTRIES = "session string, path string, track_id string, size_bytes long, sha256 string, object_key string, compressed_size_bytes long, compressed_sha256 string, code string"
RESULTS = "session string, path string, track_id string, outcome string, code string, size_bytes long, compressed_size_bytes long"
_LISTED = [f.split()[0] for f in ENTRIES.split(", ")]
_TOLD = [f.split()[0] for f in RESULTS.split(", ")]


def entries(sessions: DataFrame, storage: Storage) -> DataFrame:
    """ENTRIES of every session (a column session): a row for each file of its manifest, or one row with a code where there is none to read."""
    importable(sessions.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for session in frame["session"]:
                try:
                    known = read_manifest(storage, session)
                    if known is None:
                        raise ArchiveError("archive_absent", session)
                    rows = [(session, *(e.get(c) for c in _LISTED[1:-1]), None) for e in known[0]["entries"]]
                except (ArchiveError, OSError) as x:
                    rows = [(session, *[None] * (len(_LISTED) - 2), getattr(x, "code", "archive_io"))]
                out = pd.DataFrame(rows, columns=_LISTED)
                yield out.astype({"size_bytes": "Int64", "compressed_size_bytes": "Int64"})

    own = sessions.select("session").distinct()
    return own.repartition("session").mapInPandas(run, ENTRIES)


def _judged(listed: DataFrame, act: Callable[[object], None], good: str) -> DataFrame:
    """RESULTS: act() on each entry; its failure is the entry's, not the job's."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for e in frame.itertuples(index=False):
                code = e.code
                if code is None:
                    try:
                        act(e)
                    except (ArchiveError, OSError) as x:
                        code = getattr(x, "code", "archive_io")
                rows.append((e.session, e.path, e.track_id, good if code is None else "failed", code, e.size_bytes, e.compressed_size_bytes))
            yield pd.DataFrame(rows, columns=_TOLD).astype({"size_bytes": "Int64", "compressed_size_bytes": "Int64"})

    return listed.repartition("session", "path").mapInPandas(run, RESULTS)


def verified(sessions: DataFrame, storage: Storage) -> DataFrame:
    """RESULTS of reading every object of the sessions back whole, held to the manifests' sizes and hashes."""

    def act(e) -> None:
        read_back(storage, e.object_key, int(e.size_bytes), e.sha256, e.compressed_sha256)

    return _judged(entries(sessions, storage), act, "verified")


def present(sessions: DataFrame, storage: Storage) -> DataFrame:
    """RESULTS of looking for every object, by its compressed size; none is read."""

    def act(e) -> None:
        if storage.head(e.object_key) != int(e.compressed_size_bytes):
            raise ArchiveError("archive_object_missing", e.object_key)

    return _judged(entries(sessions, storage), act, "present")


def totals(results: DataFrame) -> DataFrame:
    """session, status (complete, partial, failed), objects, failed, size_bytes, compressed_size_bytes, codes."""
    bad = F.col("outcome") == "failed"
    n, lost = F.count("*"), F.sum(bad.cast("long"))
    told = results.groupBy("session").agg(
        n.alias("objects"), lost.alias("failed"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes"), F.coalesce(F.sum("compressed_size_bytes"), F.lit(0)).alias("compressed_size_bytes"),
        F.array_sort(F.collect_set("code")).alias("codes"),
    )
    status = F.when(F.col("failed") == 0, "complete").when(F.col("failed") < F.col("objects"), "partial").otherwise("failed")
    return told.withColumn("status", status)
