"""Stage results in the shared folder, committed in two phases, and the report of a run."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidewright.functions.text import redact
from tidewright.sources.files import canonical_json


def identity(stage: str, version: int, config_sha256: str, **inputs: Any) -> str:
    """The key of a stage's result: everything it depends on."""
    return hashlib.sha256(canonical_json({"stage": stage, "version": version, "config": config_sha256, "inputs": inputs}).encode()).hexdigest()


class StageCache:
    """Parquet tables by identity. A table counts once its sidecar is there; whatever else lies around is a miss.

    Paths go through Hadoop's file systems, so the folder may be anywhere that all executors reach.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def get(self, key: str) -> DataFrame | None:
        at = f"{self.folder}/{key}"
        if not self._fs.exists(self._path(f"{at}/sidecar.json")):
            return None
        side = json.loads("\n".join(r[0] for r in self.spark.read.text(f"{at}/sidecar.json", wholetext=True).collect()))
        if side.get("identity") != key or not self._fs.exists(self._path(f"{at}/data/_SUCCESS")):
            return None
        return self.spark.read.parquet(f"{at}/data")

    def stage(self, key: str, df: DataFrame) -> str:
        """Writes the data where no reader looks; returns the staging folder."""
        at = f"{self.folder}/_staging/{key}-{time.time_ns()}"
        df.write.parquet(f"{at}/data")
        return at

    def commit(self, key: str, staged: str, verified: bool) -> bool:
        """Publishes a staged result, if the raw inputs were found unchanged. A rival's earlier commit stands."""
        try:
            if not verified or self.get(key) is not None:
                return False
            out = self._fs.create(self._path(f"{staged}/sidecar.json"), True)
            out.write(bytearray(canonical_json({"identity": key}).encode()))
            out.close()
            final = self._path(f"{self.folder}/{key}")
            if self._fs.exists(final):  # left by a commit that never ended
                self._fs.delete(final, True)
            return bool(self._fs.rename(self._path(staged), final))
        finally:
            if self._fs.exists(self._path(staged)):
                self._fs.delete(self._path(staged), True)

    def of(self, key: str, build: Callable[[], DataFrame], verify: Callable[[], bool] = lambda: True) -> DataFrame:
        """The cached result, or a new one. What can't be verified is an error and isn't kept."""
        if (known := self.get(key)) is not None:
            return known
        staged = self.stage(key, build())
        if not self.commit(key, staged, verify()) and self.get(key) is None:
            raise RuntimeError("source_changed: the inputs changed while the stage ran")
        return self.get(key)


class Report:
    """Stages, decisions and deliverables of a run; a document whichever way the run went."""

    def __init__(self, session: str, now: Callable[[], float] = time.time):
        self.session, self._now, self._began = session, now, now()
        self.stages: list[dict] = []
        self.decisions: list[dict] = []
        self.deliverables: dict[str, str] = {}

    def stage(self, name: str, work: Callable[[], Any]) -> Any:
        """Runs the work and records how it ended; its failure is recorded and raised again."""
        row = {"stage": name, "status": "failed", "started_at": self._now()}
        self.stages.append(row)
        try:
            out = work()
            row["status"] = "complete"
            return out
        except Exception as x:
            row["error"] = {"code": getattr(x, "code", type(x).__name__), "message": redact(str(x))}
            raise
        finally:
            row["finished_at"] = self._now()

    def decide(self, code: str, **facts: Any) -> None:
        self.decisions.append({"code": code, **facts})

    def deliver(self, name: str, sha256: str) -> None:
        self.deliverables[name] = sha256

    @property
    def status(self) -> str:
        if all(s["status"] == "complete" for s in self.stages):
            return "complete"
        return "partial" if self.deliverables else "failed"

    def document(self) -> dict:
        decisions = sorted(self.decisions, key=lambda d: json.dumps(d, sort_keys=True, default=str))
        return {
            "session_id": self.session, "status": self.status, "started_at": self._began, "finished_at": self._now(), "stages": self.stages,
            "decisions": decisions, "deliverables": dict(sorted(self.deliverables.items())), "exit_code": {"complete": 0, "partial": 2, "failed": 1}[self.status],
        }
