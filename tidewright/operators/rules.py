"""Decisions about sources, tracks, archives and runs: columns and small relational steps, apart from any one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.archive.storage import PREFIX
from tidewright.functions.quantize import floor_div, to_permille
from tidewright.functions.text import percent_encode

#: Transmitter, sequence, date, time, variant of a recorder's file name, in any case. Fixed form.
NAME = r"(?i)^TX([0-9]{2})_MIC([0-9]{3,})_([0-9]{8})_([0-9]{6})_(orig|edit)$"
DAY_MS = 86_400_000


def notes(codes: Sequence[tuple[Column, str]]) -> Column:
    """The codes whose condition holds, in order, with commas between."""
    return F.concat_ws(",", *[F.when(condition, code) for condition, code in codes])


# ---- sources


def parse_filename(name: Column) -> Column:
    """(tx, sequence, named_date, named_time, variant); of another form all null and variant by its ending, else unknown.

    A date or time that there isn't is null; the rest of the name still counts.
    """
    part = lambda i: F.nullif(F.regexp_extract(name, NAME, i), F.lit(""))
    low = F.lower(name)
    variant = F.when(low.endswith("_orig"), "orig").when(low.endswith("_edit"), "edit").otherwise("unknown")
    date = F.when(F.try_to_timestamp(part(3), F.lit("yyyyMMdd")).isNotNull(), part(3))
    clock = part(4)
    real = (F.substring(clock, 1, 2) < "24") & (F.substring(clock, 3, 2) < "60") & (F.substring(clock, 5, 2) <= "61")
    return F.struct(part(1).alias("tx"), part(2).try_cast("int").alias("sequence"), date.alias("named_date"), F.when(real, clock).alias("named_time"), variant.alias("variant"))


def sequence_steps(rows: DataFrame) -> DataFrame:
    """session, track, n, following: where a track's counter jumps by more than one. Null counters say nothing."""
    own = rows.filter("n is not null")
    following = F.lead("n").over(Window.partitionBy("session", "track").orderBy("n"))
    return own.withColumn("following", following).filter(F.col("following") - F.col("n") > 1)


def unconfigured(sources: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """Sources that no configured input takes."""
    return sources.join(used.select(key).distinct(), key, "left_anti")


def probe(document: Column) -> Column:
    """(refusal, rate, tags) of a probe's JSON: exactly one audio stream, its tags' keys lower-cased."""
    parsed = F.from_json(document, "streams array<struct<codec_type:string,rate:long,tags:map<string,string>>>")
    audio = F.filter(parsed["streams"], lambda s: s["codec_type"] == "audio")
    n, one = F.coalesce(F.size(audio), F.lit(-1)), F.get(audio, 0)
    refusal = F.when(n < 0, "unreadable_probe").when(n == 0, "no_audio_stream").when(n > 1, "several_audio_streams")
    return F.struct(refusal.alias("refusal"), F.when(n == 1, one["rate"]).alias("rate"), F.when(n == 1, F.transform_keys(one["tags"], lambda k, v: F.lower(k))).alias("tags"))


def exact_samples(size: Column, width: int, stated: Column) -> Column:
    """Samples of a payload that whole frames of width bytes fill; else the count that the stream states, if it does."""
    return F.when(F.pmod(size, F.lit(width)) == 0, floor_div(size, width)).otherwise(stated)


def mixed(sources: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """Groups whose sources don't agree in a value, with how many values there are: refused, or warned of."""
    return sources.groupBy(by).agg(F.countDistinct(value).alias(name)).filter(F.col(name) > 1)


def first_answer(strategies: Mapping[str, Column]) -> Column:
    """(start, kind, declined): the first strategy with an answer; those asked before it, with commas between."""
    names = list(strategies)
    kind = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in strategies.items()])
    asked = F.array(*map(F.lit, names))
    place = F.coalesce(F.array_position(asked, kind) - 1, F.lit(len(names))).cast("int")
    return F.struct(F.coalesce(*strategies.values()).alias("start"), kind.alias("kind"), F.array_join(F.slice(asked, F.lit(1), place), ",").alias("declined"))


def format_warnings(rate: Column, codec: Column, channels: Column, disagreement: Column) -> Column:
    """What is unusual about a source, each condition given as a column; source_warnings() has the conditions."""
    return notes([(rate, "unexpected_sample_rate"), (codec, "unexpected_codec"), (channels, "unexpected_channel_count"), (disagreement, "sample_count_disagreement")])


def source_warnings(rate: Column, codec: Column, channels: Column, samples: Column, stated: Column) -> Column:
    """format_warnings() by what a source is: another rate than 48 kHz, no 32-bit float, more than one channel, another count of samples than its container states."""
    differs = lambda c, usual: F.coalesce(c != usual, F.lit(False))
    return format_warnings(differs(rate, F.lit(48_000)), differs(codec, F.lit("pcm_f32le")), differs(channels, F.lit(1)), differs(samples, stated))


def originals(edits: DataFrame, sources: DataFrame, by: str, order: str, edit: str) -> DataFrame:
    """Each edit with the last original of its group; null where there is none."""
    last = sources.groupBy(by).agg(F.max(order).alias("original"))
    return edits.join(last, by, "left").select(F.col(order).alias(edit), "original")


def repeated(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that stand in more than one row, and in how many."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def without(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys of overrides that name no source."""
    return rows.join(known, key, "left_anti").select(key)


def tagged_union(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tables of the same columns in one, with which they came from as kind."""
    out = None
    for kind, df in tables.items():
        own = df.withColumn("kind", F.lit(kind))
        out = own if out is None else out.unionByName(own)
    return out


def roster(members: DataFrame, files: DataFrame, key: str, inactive: Column) -> DataFrame:
    """Members with how many files they have, and their state: missing without any, else inactive or active."""
    n = files.groupBy(key).agg(F.count("*").alias("files"))
    j = members.join(n, key, "left")
    return j.withColumn("state", F.when(F.col("files").isNull(), "missing").when(inactive, "inactive").otherwise("active")).withColumn("files", F.coalesce("files", F.lit(0)))


def selected(sources: DataFrame, owners: DataFrame, key: str) -> DataFrame:
    """Sources with their owner, where the owner takes part."""
    return sources.join(owners, key)


def work(sources: DataFrame, cached: DataFrame, key: str, result: str) -> DataFrame:
    """Sources with what is cached of them (the least result); those without are the work to do."""
    known = cached.groupBy(key).agg(F.min(result).alias(result))
    return sources.select(key).join(known, key, "left").withColumn("work", F.col(result).isNull())


def usable(suspicious: Sequence[Column]) -> Column:
    """Whether nothing speaks against a row; what is unknown doesn't."""
    out = F.lit(True)
    for c in suspicious:
        out = out & ~F.coalesce(c, F.lit(False))
    return out


# ---- the time line


def rollover_turns(rows: DataFrame, by: str, day: Column) -> DataFrame:
    """Adds turns: days since the entity's first one."""
    return rows.withColumn("turns", F.datediff(day, F.min(day).over(Window.partitionBy(by))))


def since_origin(ms: Column, origin: int, cycle: int = DAY_MS) -> Column:
    """Milliseconds from a configured zero to a time of day: what lies before it belongs to the next day."""
    at = F.pmod(ms, F.lit(cycle))
    return at + F.when(at < origin, cycle).otherwise(0) - origin


def end_windows(length: Column, longest: int) -> Column:
    """(name, start, end) of a window at each end, neither longer than half the session."""
    span = F.least(F.lit(longest), F.greatest(floor_div(length, 2), F.lit(1)))
    row = lambda name, a, b: F.struct(F.lit(name).alias("name"), a.cast("long").alias("start"), b.cast("long").alias("end"))
    return F.array(row("opening", F.lit(0), span), row("closing", F.greatest(F.lit(0), length - span), length))


def span_warnings(spans: DataFrame, by: str, domain: Column, longest: int = DAY_MS) -> DataFrame:
    """by, warnings: sessions that are too long to be one, or that mix two kinds of time."""
    s = spans.groupBy(by).agg((F.max("end") - F.min("start")).alias("_ms"), (F.bool_or(domain) & F.bool_or(~domain)).alias("_mixed"))
    return s.select(by, notes([(F.col("_ms") > longest, "implausible_session_span"), (F.col("_mixed"), "mixed_time_domains")]).alias("warnings"))


def workspace(spans: DataFrame, by: str, rate: int, derived: int, width: int, free: int) -> DataFrame:
    """(working, derived, short): bytes of all tracks' samples at the source and at the derived rate (a millisecond's samples), and whether free holds them."""
    ms = F.sum(F.col("_ms"))
    t = spans.groupBy(by).agg((F.max("end") - F.min("start")).alias("_ms"))
    return t.agg((ms * rate * width).alias("working"), (ms * derived * width).alias("derived"), (ms * (rate + derived) * width > free).alias("short"))


def arrivals(ends: DataFrame, starts: DataFrame, by: str) -> DataFrame:
    """by, ended, started: the last end of each entity with its first start, if there is one."""
    return ends.groupBy(by).agg(F.max("at").alias("ended")).join(starts.groupBy(by).agg(F.min("at").alias("started")), by, "left")


def most_frequent(rows: DataFrame, key: str) -> DataFrame:
    """The key of the most rows, of equals the least: the track that others are measured against."""
    return rows.groupBy(key).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), key).limit(1).select(key)


def quantum(rows: DataFrame, by: str, exact: Column, value: str) -> DataFrame:
    """by, quantum: the coarsest step that the evidence which isn't exact could have; 1 without any."""
    return rows.groupBy(by).agg(F.coalesce(F.max(F.when(~exact, F.col(value))), F.lit(1)).cast("long").alias("quantum"))


# ---- mix


def measures(x: Column, full: Column) -> list[Column]:
    """Aggregates of a track's samples: peak, power (sum of squares), n, clipped (permille of samples at full scale)."""
    return [F.max(F.abs(x)).alias("peak"), F.sum(x * x).alias("power"), F.count("*").alias("n"), to_permille(F.count_if(full) * 1000.0 / F.count("*")).alias("clipped")]


def mixed_sum(frames: DataFrame, by: str, value: str, gain: Column) -> DataFrame:
    """by, mixed (sum of the gained values), peak (the greatest value without gain)."""
    return frames.groupBy(by).agg(F.sum(F.col(value) * gain).alias("mixed"), F.max(value).alias("peak"))


def initial_gain(loud: Column, peak: Column, target: int = -1600, ceiling: int = -150, floor: int = -5000, most: int = 3000) -> tuple[Column, Column]:
    """(gain, code) in millibels: to the target loudness, held within `most` and under the true-peak ceiling; none for near-silence."""
    wanted, room = target - loud, ceiling - peak
    quiet, far, tight = loud.isNull() | (loud < floor), F.abs(wanted) > most, peak.isNotNull() & (room < wanted)
    gain = F.when(quiet, 0).when(far, F.when(wanted > 0, most).otherwise(-most)).when(tight, room).otherwise(wanted)
    return gain, F.when(quiet, "mix_not_normalized").when(far, "mix_master_gain_clamped").when(tight, "mix_loudness_target_unreachable")


def encode_failures(loud: Column, reported: Column, peak: Column, off: Column, target: int = -1600, tolerance: int = 100, ceiling: int = -150, headroom: int = 30, frame: int = 1152) -> Column:
    """What an encoded mix misses: loudness, true peak (or its measurement), duration by more than a frame."""
    found = F.array(F.when(loud.isNull() | (F.abs(loud - target) > tolerance), "integrated_loudness"), F.when(~reported, "true_peak_unmeasured").when(peak > ceiling + headroom, "true_peak"), F.when(off > frame, "duration"))
    return F.array_join(F.filter(found, lambda x: x.isNotNull()), ",")


def mixable(tracks: DataFrame, heard: DataFrame, key: str) -> DataFrame:
    """key, state: mixed, or absent without any audio."""
    have = heard.select(key).distinct()
    own = tracks.select(key)
    return own.join(have, key, "left_semi").withColumn("state", F.lit("mixed")).unionByName(own.join(have, key, "left_anti").withColumn("state", F.lit("absent")))


# ---- transcript


def scripted(requests: DataFrame, words: DataFrame, width: int) -> DataFrame:
    """request, track, word, start, end: scripted words that overlap a request's window (start, end), clipped to it."""
    from tidewright.operators.intervals import overlap_join

    pairs = overlap_join(requests, words, width, equal=["track"])
    return pairs.select("l.request", "r.track", "r.word", F.greatest("r.start", "l.start").alias("start"), F.least("r.end", "l.end").alias("end"))


def records(drafts: DataFrame, speakers: DataFrame, pieces: DataFrame, draft: str, speaker: str) -> DataFrame:
    """Drafts with their speaker and what their pieces (draft, samples) sum up to; pieces are gathered before the join."""
    n = pieces.groupBy(draft).agg(F.count("*").alias("pieces"), F.sum("samples").cast("long").alias("samples"))
    return drafts.join(speakers, speaker).join(n, draft, "left").fillna(0, ["pieces", "samples"])


def tally(rows: DataFrame, by: str, short: Column) -> DataFrame:
    """by, n: how many rows of each group meet a condition; groups without any have no row."""
    return rows.filter(short).groupBy(by).agg(F.count("*").alias("n"))


# ---- archives and runs


def reconcile(local: DataFrame, remote: DataFrame, key: str, value: str) -> DataFrame:
    """key, status of every object on either side: pending (not there yet), vanished (only there), divergent or committed."""
    far = remote.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    j = local.select(key, value).join(far, F.col(key) == F.col("_k"), "full")
    same = F.col(value).eqNullSafe(F.col("_v"))
    status = F.when(F.col("_k").isNull(), "pending").when(F.col(key).isNull(), "vanished").when(~same, "divergent").otherwise("committed")
    return j.select(F.coalesce(key, "_k").alias(key), status.alias("status"))


def archive_state(reconciled: DataFrame) -> DataFrame:
    """One row: ABSENT without any remote object, DIVERGENT, PENDING or COMMITTED."""
    s = reconciled.agg(F.bool_or(F.col("status") == "pending").alias("missing"), F.bool_or(F.col("status").isin("vanished", "divergent")).alias("wrong"), F.count_if(F.col("status") != "pending").alias("n"))
    return s.select(F.when(F.col("n") == 0, "ABSENT").when(F.col("wrong"), "DIVERGENT").when(F.col("missing"), "PENDING").otherwise("COMMITTED").alias("status"))


def totals(objects: DataFrame, by: str, size: Column) -> DataFrame:
    """by, original (bytes), n of each group of objects."""
    return objects.groupBy(by).agg(F.sum(size).alias("original"), F.count("*").alias("n"))


def object_key(session: Column, path: Column, digest: Column) -> Column:
    """The key of archive.storage.object_key() as a column: session and path percent-encoded, the content's hash behind."""
    return F.concat(F.lit(f"{PREFIX}/"), percent_encode(session.cast("string")), F.lit("/objects/"), percent_encode(path.cast("string")), F.lit("."), digest, F.lit(".zst"))


def listed_sessions(keys: Column, pattern: str) -> Column:
    """The session that a canonical manifest key names; null for any other key."""
    return F.nullif(F.regexp_extract(keys, pattern, 1), F.lit(""))


def preflight(objects: DataFrame, size: Column) -> DataFrame:
    """(largest, restored): the largest object's bound when packed, and all objects' bytes when restored."""
    return objects.agg(F.max(size + F.shiftright(size, 8)).alias("largest"), F.sum(size).alias("restored"))


def chosen(objects: DataFrame, wanted: Column) -> DataFrame:
    """The objects that a selection names; none at all is an error, as an empty restore would look like a done one."""
    out = objects.filter(wanted)
    if out.isEmpty():
        raise ValueError("archive_nothing_selected: no object matches")
    return out


def trusted(key: Column, session: str) -> Column:
    """trusted for keys below the session's own folder, else archive_manifest_foreign; a key that climbs out of it is foreign, too."""
    own = F.startswith(key, F.lit(session)) & ~F.contains(F.substring(key, len(session) + 1, 1 << 20), F.lit("../"))
    return F.when(F.coalesce(own, F.lit(False)), "trusted").otherwise("archive_manifest_foreign")


def outcome(failed: Column, delivered: Column) -> list[Column]:
    """A run's status from its stages, as an aggregate: complete without a failure, else partial if something was delivered."""
    bad, good = F.bool_or(failed), F.bool_or(delivered)
    return [F.when(~bad, "complete").when(good, "partial").otherwise("failed").alias("status")]


def severity(level: Column, order: Sequence[str]) -> Column:
    """The worst of a group's levels as a number, the first of order being 0; unknown levels count as the first."""
    out = F.lit(0)
    for i, name in enumerate(order):
        out = F.when(level == name, i).otherwise(out)
    return F.max(out)


def stale(recorded: Column, current: Column, code: str = "records_stale") -> Column:
    """The code where what a record was made from isn't what there is now."""
    return F.when(~recorded.eqNullSafe(current), code)


def identity(**parts: Column) -> Column:
    """sha256 of the parts as JSON, in the order of their names."""
    return F.sha2(F.to_json(F.struct(*[parts[k].alias(k) for k in sorted(parts)]), {"ignoreNullFields": "false"}), 256)


def ceiling(rows: DataFrame, by: str, counted: Column, most: int) -> DataFrame:
    """by, peaks, over: how many rows count, and whether that is more than is bearable."""
    n = F.count_if(counted)
    return rows.groupBy(by).agg(n.alias("peaks"), (n > most).alias("over"))


def refuse_over(checked: DataFrame, code: str) -> None:
    """An error that names the groups (ten at most) of a ceiling() that are over."""
    bad = [str(r[0]) for r in checked.filter("over").limit(10).collect()]
    if bad:
        raise ValueError(f"{code}: {', '.join(bad)}")
