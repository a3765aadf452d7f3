"""Event logs of markers that someone played on purpose: strict documents, read into a table, and the markers found for them."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Events of a log; they go to every task.
MOST = 10_000
ROLES = ("start", "end", "diagnostic")
SCHEMA = "playback_order long, role string, marker_name string, start_ms long, end_ms long, geometry_id string, note string"
NEEDED = {"role": str, "marker_name": str, "start_ms": int, "end_ms": int, "playback_order": int}
OPTIONAL = {"geometry_id": str, "note": str}


class EventLogError(ValueError):
    """A log that can't be used; the message names the event and the field."""


def _event(i: int, raw: Any) -> tuple:
    if not isinstance(raw, dict):
        raise EventLogError(f"events[{i}]: a mapping is needed")
    if unknown := sorted(set(raw) - set(NEEDED) - set(OPTIONAL)):
        raise EventLogError(f"events[{i}]: unknown {unknown}")
    for k, kind in NEEDED.items():
        if not isinstance(raw.get(k), kind) or isinstance(raw.get(k), bool):
            raise EventLogError(f"events[{i}].{k}: {kind.__name__} needed, not {raw.get(k)!r}")
    for k, kind in OPTIONAL.items():
        if raw.get(k) is not None and not isinstance(raw[k], kind):
            raise EventLogError(f"events[{i}].{k}: {kind.__name__} needed, not {raw[k]!r}")
    if raw["role"] not in ROLES:
        raise EventLogError(f"events[{i}].role: one of {ROLES}, not {raw['role']!r}")
    if not 0 <= raw["start_ms"] < raw["end_ms"] or raw["playback_order"] < 0:
        raise EventLogError(f"events[{i}]: a half-open interval of milliseconds and an order, none negative")
    if len(raw.get("note") or "") > 500:
        raise EventLogError(f"events[{i}].note: at most 500 characters")
    return tuple(raw.get(c.split()[0]) for c in SCHEMA.split(", "))


def parse(text: str) -> tuple[str, list[tuple]]:
    """(session_id, rows of SCHEMA); orders are distinct, at most one start and one end for each geometry."""
    try:
        doc = json.loads(text)
    except ValueError as x:
        raise EventLogError(f"no JSON: {x}") from None
    if not isinstance(doc, dict) or set(doc) != {"schema_version", "session_id", "events"} or doc["schema_version"] != 1:
        raise EventLogError("schema_version 1, session_id and events are needed, and nothing else")
    if not isinstance(doc["session_id"], str) or not doc["session_id"] or not isinstance(doc["events"], list) or not doc["events"]:
        raise EventLogError("a session_id and at least one event are needed")
    rows = [_event(i, e) for i, e in enumerate(doc["events"])]
    if len({r[0] for r in rows}) != len(rows):
        raise EventLogError("playback_order: two events have the same")
    return doc["session_id"], rows


def load_event_log(spark: SparkSession, path: str) -> DataFrame:
    """session_id and SCHEMA of one log, wherever Spark reads from. A log is one operator's notes: a few rows."""
    session, rows = parse("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))
    return spark.createDataFrame(rows, SCHEMA).withColumn("session_id", F.lit(session))


def associate(events: DataFrame, found: DataFrame, by: Sequence[str], rate: int = 48_000) -> DataFrame:
    """Events with the marker found for each on each track: by, playback_order, role, anchor, score; null where there is none.

    Only markers that begin within an event's interval count. Of several the best score does, then the earliest; a marker goes to one event
    only, the one played first.
    """
    sample = lambda c: F.expr(f"({c} * {rate} + 500) div 1000")
    own = events.withColumns({"_a": sample("start_ms"), "_b": sample("end_ms")})
    tracks = found.select(*by).distinct()
    if own.limit(MOST + 1).count() > MOST:
        raise EventLogError(f"at most {MOST} events")
    inside = found.join(F.broadcast(own), (F.col("anchor") >= F.col("_a")) & (F.col("anchor") < F.col("_b")))
    order = Window.partitionBy(*by, "anchor").orderBy("playback_order")
    first = inside.withColumn("_claim", F.row_number().over(order)).filter("_claim = 1")
    best = Window.partitionBy(*by, "playback_order").orderBy(F.desc("score"), "anchor")
    chosen = first.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").select(*by, "playback_order", "anchor", "score")
    asked = tracks.withColumn("_e", F.explode(F.array(*[F.struct(F.lit(r["playback_order"]).alias("playback_order"), F.lit(r["role"]).alias("role")) for r in events.select("playback_order", "role").collect()])))
    return asked.select(*by, "_e.playback_order", "_e.role").join(chosen, [*by, "playback_order"], "left")
