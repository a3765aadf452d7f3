"""Which files of a session are its sources: roles, keepers among copies, edits and their originals, the roster.

All of it is joins and windows over the files and tracks of any number of sessions. A track's directory is its identity; what a
name says is a hint. Copies are known by their hash alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.rules import parse_filename, sequence_steps
from tidewright.sources.shared import durable

_NOTE = ["session", "code", "subject"]
#: Tracks of all sessions that are sent to every task, so that a session with a third of all files is no hot key; more of them are shuffled.
FEW = 200_000


def folder(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, r"/[^/]*$", "")).otherwise("")


def base(path: Column) -> Column:
    """The file's name without its last ending."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def pairing_key(path: Column, hints: Column) -> Column:
    """What an original and its edit have in common: transmitter and counter, else the folder and the name without its variant."""
    known = F.concat(F.lit("TX"), hints["tx"], F.lit(":"), F.lpad(hints["sequence"].cast("string"), 6, "0"))
    stem = F.concat(F.lit("stem:"), folder(path), F.lit("/"), F.regexp_replace(base(path), r"(?i)_(orig|edit)$", ""))
    return F.coalesce(known, stem)


@dataclass(frozen=True)
class Discovery:
    """sources: session, path, track, sha256, variant, role, reason, associated. roster: session, track, input, state, required, files, selected.

    notes: session, code, subject (warnings and decisions). refusals: session, code, subject; a session with one can't go on.
    """

    sources: DataFrame
    roster: DataFrame
    notes: DataFrame
    refusals: DataFrame


def candidates(files: DataFrame, tracks: DataFrame) -> DataFrame:
    """files (session, path, sha256) with track, hints and kind: source, unassigned, stray, other (no .wav), ignored.

    A configured directory is taken flat; below one that isn't configured, but lies beside one, everything is captured and belongs to nobody. Audio
    beside the directories is stray. Files deeper in a configured directory are ignored, as are work/ and output/ in a session's root.
    """
    few = tracks.limit(FEW + 1).count() <= FEW
    small = lambda t: F.broadcast(t) if few else t
    inputs = small(tracks.select("session", F.col("input").alias("_dir"), "track"))
    roots = small(tracks.select("session", folder(F.col("input")).alias("_root")).distinct())
    df = files.withColumns({"_dir": folder(F.col("path")), "hints": parse_filename(base(F.col("path"))), "_wav": F.lower("path").endswith(".wav")})
    df = df.join(inputs, ["session", "_dir"], "left")
    # the directory right below a root that a file lies in or under, for every root: few roots a session
    at = df.select("session", "path", "_dir").join(roots, "session").filter(F.when(F.col("_root") == "", True).otherwise(F.col("path").startswith(F.concat("_root", F.lit("/")))))
    rest = F.substring(F.col("path"), F.when(F.col("_root") == "", 1).otherwise(F.char_length("_root") + 2), F.lit(2**31 - 1))
    at = at.withColumn("_top", F.when(F.contains(rest, F.lit("/")), F.concat(F.when(F.col("_root") == "", "").otherwise(F.concat("_root", F.lit("/"))), F.substring_index(rest, "/", 1))))
    at = at.join(small(inputs.select("session", F.col("_dir").alias("_top"), F.lit(True).alias("_known")).distinct()), ["session", "_top"], "left")
    own = (F.col("_root") == "") & F.col("_top").isin("work", "output")
    free = F.col("_top").isNotNull() & F.col("_known").isNull() & ~own
    at = at.groupBy("session", "path").agg(F.bool_or(F.col("_top").isNull()).alias("_stray"), F.max(F.when(free, F.col("_top"))).alias("extra"), F.bool_or(own).alias("_own"))
    df = df.join(at, ["session", "path"], "left")
    kind = (
        F.when(F.col("track").isNotNull(), F.when(F.col("_wav"), "source").otherwise("other"))
        .when(F.coalesce("_own", F.lit(False)), "ignored")
        .when(F.col("_stray"), F.when(F.col("_wav"), "stray").otherwise("ignored"))
        .when(F.col("extra").isNotNull(), F.when(F.col("_wav"), "unassigned").otherwise("other"))
        .otherwise("ignored")
    )
    return df.withColumn("kind", kind).drop("_dir", "_wav", "_stray", "_own")


def keepers(found: DataFrame) -> DataFrame:
    """Adds keeper: of files with the same bytes the one that stays. Files of no track come last, edits next to last, then the path decides.

    The least of a group is one aggregate: copies of a third of all files are one row from each task.
    """
    rank = F.struct(F.col("track").isNull().alias("free"), (F.col("hints.variant") == "edit").alias("edit"), F.col("path").alias("path"))
    kept = found.groupBy("session", "sha256").agg(F.min(rank).alias("_least"), F.count("*").alias("copies"))
    return found.join(kept, ["session", "sha256"]).withColumn("keeper", F.col("_least.path")).drop("_least")


def discover(files: DataFrame, tracks: DataFrame, settings: DataFrame, overrides: DataFrame | None = None) -> Discovery:
    """files: session, path (relative), sha256. tracks: session, track, input. settings: session, allow_processed, active (array of tracks; null: auto).

    overrides: session, path. Roles: selected, associated_edit, duplicate, unassigned. States of the roster: active, missing_directory,
    empty_directory, all_duplicates, no_usable_original, not_listed. Refusals: processed_audio_only, required_track_missing, recovery_override_unmatched.
    """
    listed = durable(candidates(files, tracks))
    own = keepers(listed.filter(F.col("kind").isin("source", "stray", "unassigned"))).withColumn("variant", F.col("hints.variant"))
    copy = F.col("keeper") != F.col("path")
    original = F.col("track").isNotNull() & (F.col("variant") != "edit")
    live = own.filter(original & ~copy).select("session", "track").distinct().withColumn("_live", F.lit(True))
    own = own.join(live, ["session", "track"], "left").withColumn("_live", F.coalesce("_live", F.lit(False)))
    edit = (F.col("variant") == "edit") & F.col("track").isNotNull()
    own = own.withColumn("_key", pairing_key(F.col("path"), F.col("hints")))
    # of several originals with one key the last path: copies pair too
    partner = own.filter(original).groupBy("session", "track", "_key").agg(F.max("path").alias("_partner"))
    own = own.join(partner, ["session", "track", "_key"], "left")
    ignored = edit & F.col("_live")
    role = F.when(copy, "duplicate").when(F.col("track").isNull(), "unassigned").when(ignored, "associated_edit").otherwise("selected")
    own = own.withColumn("role", role)
    reason = F.when(F.col("role") == "duplicate", "duplicate_content").when(F.col("role") == "unassigned", "directory_not_configured").when(F.col("role") == "associated_edit", "processed_variant_ignored").when(F.col("variant") == "edit", "processed_audio_selected").otherwise("original_selected")
    associated = F.when(F.col("role") == "duplicate", F.col("keeper")).when(F.col("role") == "associated_edit", F.col("_partner"))
    own = durable(own.withColumns({"reason": reason, "associated": associated}))

    per = own.groupBy("session", "track").agg(F.count("*").alias("files"), F.sum((F.col("role") == "selected").cast("long")).alias("selected"), F.bool_and(F.col("role") == "duplicate").alias("_copies"))
    there = listed.filter("track is not null").select("session", "track").distinct().withColumn("_there", F.lit(True))
    roster = tracks.select("session", "track", "input").join(per, ["session", "track"], "left").join(there, ["session", "track"], "left").join(settings, "session", "left")
    required = F.coalesce(F.array_contains("active", F.col("track")), F.lit(False))
    state = (
        F.when(F.col("active").isNotNull() & ~required, "not_listed").when(F.coalesce("selected", F.lit(0)) > 0, "active").when(F.col("_there").isNull(), "missing_directory")
        .when(F.col("files").isNull(), "empty_directory").when(F.col("_copies"), "all_duplicates").otherwise("no_usable_original")
    )
    roster = roster.withColumns({"state": state, "required": required, "files": F.coalesce("files", F.lit(0)), "selected": F.coalesce("selected", F.lit(0))})

    allowed = settings.select("session", F.coalesce("allow_processed", F.lit(False)).alias("_allowed"))
    processed = own.filter((F.col("role") == "selected") & (F.col("variant") == "edit")).select("session", F.col("track").cast("string").alias("subject")).distinct().join(allowed, "session", "left")
    refusals = [processed.filter(~F.coalesce("_allowed", F.lit(False))).select("session", F.lit("processed_audio_only").alias("code"), "subject")]
    refusals.append(roster.filter(F.col("required") & (F.col("state") != "active")).select("session", F.lit("required_track_missing").alias("code"), F.col("track").cast("string").alias("subject")))
    if overrides is not None:
        refusals.append(overrides.join(own, ["session", "path"], "left_anti").select("session", F.lit("recovery_override_unmatched").alias("code"), F.col("path").alias("subject")))

    of = lambda df, code, subject: df.select("session", (F.lit(code) if isinstance(code, str) else code).alias("code"), F.col(subject).cast("string").alias("subject"))
    elsewhere = folder(F.col("keeper")) != folder(F.col("path"))
    labels = own.filter(F.col("track").isNotNull()).groupBy("session", "track").agg((F.min("hints.tx") != F.max("hints.tx")).alias("_mixed")).filter("_mixed")
    notes = [
        of(listed.filter("kind = 'other'"), "unexpected_file_type", "path"), of(listed.filter("kind = 'stray'"), "stray_audio_file", "path"),
        of(listed.filter("extra is not null and track is null").select("session", "extra").distinct(), "extra_directory", "extra"),
        of(own.filter("role = 'duplicate' and track is not null"), F.when(elsewhere, "duplicate_across_tracks").otherwise("duplicate_source"), "path"),
        of(own.filter("role = 'selected' and variant = 'unknown'"), "variant_not_determined", "path"), of(own.filter((F.col("role") == "selected") & F.col("hints.tx").isNull()), "unrecognized_filename", "path"),
        of(own.filter("role = 'associated_edit' and associated is not null"), "orig_selected", "associated"), of(processed.filter("_allowed"), "processed_audio_allowed", "subject"),
        of(labels, "mixed_transmitter_labels", "track"), of(sequence_steps(own.filter(F.col("track").isNotNull()).select("session", "track", F.col("hints.sequence").alias("n"))), "sequence_discontinuity", "track"),
        of(roster.filter("active is null and state != 'active'"), "track_inactive", "track"),
    ]
    union = lambda parts: _union([p.select(*_NOTE) for p in parts])
    sources = own.select("session", "path", "track", "sha256", "variant", "role", "reason", "associated")
    return Discovery(sources, roster.select("session", "track", "input", "state", "required", "files", "selected"), union(notes), union(refusals))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
