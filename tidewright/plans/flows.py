"""Queries of what stands around the session operators: sources, evidence, requests, words, documents, archives."""

from __future__ import annotations

import hashlib
import io

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewright import configuration as C
from tidewright.archive import codec
from tidewright.functions import quantize as Q
from tidewright.functions import text as X
from tidewright.functions import waveform as W
from tidewright.operators import envelope as N
from tidewright.operators import intervals as I
from tidewright.operators import markers as K
from tidewright.operators import rules as R
from tidewright.operators import transcript as T
from tidewright.plans.intervals import REGIONS_SQL, regions
from tidewright.plans.registry import SPANS_SQL, query, read, spans

# ---- discovery and evidence

#: Configured inputs: prefixes of page addresses. One lies within another, so that some addresses have two.
PREFIXES = {"t0": "https://example.org/en/", "t1": "https://example.org/", "t2": "https://example.com/fr/", "t3": "https://news.example.net/"}
PREFIX_SQL = "tracks(track, prefix) AS (VALUES " + ", ".join(f"('{t}', '{p}')" for t, p in PREFIXES.items()) + ")"


@query("track_attribution", f"WITH {PREFIX_SQL} SELECT page_id, CASE WHEN count(track) = 1 THEN min(track) END AS track FROM pages LEFT JOIN tracks ON starts_with(url, prefix) GROUP BY page_id, url")
def track_attribution(spark, d):
    """The configured inputs are few and known beforehand, so they are conditions and not a join."""
    fits = F.array_compact(F.array(*[F.when(F.startswith("url", F.lit(p)), t) for t, p in PREFIXES.items()]))
    return read(spark, d, "pages").select("page_id", F.when(F.size(fits) == 1, fits[0]).alias("track"))


@query("scan_unconfigured", "SELECT p_partkey, p_type FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 45)")
def scan_unconfigured(spark, d):
    used = read(spark, d, "lineitem").filter("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return R.unconfigured(read(spark, d, "part").select("p_partkey", "p_type"), used, "p_partkey")


STRATEGIES = ("override_offset", "override_timecode", "bwf_reference", "timecode_tag")
START_SQL = "cand AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN user_id END AS override_offset, CASE WHEN event_type = 'signup' THEN user_id * 2 END AS override_timecode, CASE WHEN value > 100 THEN floor(value)::BIGINT END AS bwf_reference, CASE WHEN event_type != 'error' THEN event_id * 7 END AS timecode_tag FROM events)"


@query("starttime_chain", f"""WITH {START_SQL} SELECT event_id, coalesce({', '.join(STRATEGIES)}) AS start, CASE {' '.join(f"WHEN {s} IS NOT NULL THEN '{s}'" for s in STRATEGIES)} END AS kind,
  CASE {' '.join(f"WHEN {s} IS NOT NULL THEN '{','.join(STRATEGIES[:i])}'" for i, s in enumerate(STRATEGIES))} ELSE '{','.join(STRATEGIES)}' END AS declined FROM cand""")
def starttime_chain(spark, d):
    """The first strategy with an answer; those before it are recorded as declined."""
    e = read(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 11 == 0, F.col("user_id")).alias("override_offset"), F.when(F.col("event_type") == "signup", F.col("user_id") * 2).alias("override_timecode"),
        F.when(F.col("value") > 100, F.floor("value")).alias("bwf_reference"), F.when(F.col("event_type") != "error", F.col("event_id") * 7).alias("timecode_tag"),
    )
    return e.select("event_id", F.inline(F.array(R.first_answer({s: F.col(s) for s in STRATEGIES}))))


@query("format_warnings", """SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN l_quantity % 5 = 0 THEN 'unexpected_sample_rate' END, CASE WHEN l_linestatus = 'O' THEN 'unexpected_codec' END,
  CASE WHEN l_linenumber > 4 THEN 'unexpected_channel_count' END, CASE WHEN l_tax > 0.07 THEN 'sample_count_disagreement' END) AS warnings FROM lineitem""")
def format_warnings(spark, d):
    warnings = R.format_warnings(F.col("l_quantity") % 5 == 0, F.col("l_linestatus") == "O", F.col("l_linenumber") > 4, F.col("l_tax") > 0.07)
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", warnings.alias("warnings"))


PROBE_SQL = """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'no_audio_stream' WHEN event_id % 10 = 1 THEN 'several_audio_streams' END AS refusal, CASE WHEN event_id % 10 > 1 THEN user_id END AS rate,
  CASE WHEN event_id % 10 > 1 THEN event_type END AS timecode FROM events"""


@query("probe_container", PROBE_SQL)
def probe_container(spark, d):
    """Documents with no audio stream, with two, and with one."""
    audio = F.format_string('{"codec_type":"audio","rate":%d,"tags":{"TimeCode":"%s"}}', "user_id", "event_type")
    many = F.when(F.col("event_id") % 10 == 0, "").when(F.col("event_id") % 10 == 1, F.concat(audio, F.lit(","), audio, F.lit(","))).otherwise(F.concat(audio, F.lit(",")))
    raw = F.concat(F.lit('{"streams":['), many, F.lit('{"codec_type":"data"}]}'))
    p = read(spark, d, "events").select("event_id", F.inline(F.array(R.probe(raw))))
    return p.select("event_id", "refusal", "rate", F.try_element_at("tags", F.lit("timecode")).alias("timecode"))


@query("rollover_origin", "SELECT event_id, epoch_us(ts) // 1000 % 86400000 + CASE WHEN epoch_us(ts) // 1000 % 86400000 < 43200000 THEN 86400000 ELSE 0 END - 43200000 AS start FROM events")
def rollover_origin(spark, d):
    """A configured zero at noon."""
    ms = F.expr("unix_micros(cast(ts as timestamp)) div 1000")
    return read(spark, d, "events").select("event_id", R.since_origin(ms, 43_200_000).alias("start"))


@query("span_warnings", "WITH " + SPANS_SQL + """, s AS (SELECT user_id, max("end") - min(start) AS ms, count(DISTINCT event_type = 'click') > 1 AS mixed FROM spans GROUP BY user_id)
SELECT user_id, concat_ws(',', CASE WHEN ms > 86400000 THEN 'implausible_session_span' END, CASE WHEN mixed THEN 'mixed_time_domains' END) AS warnings FROM s""")
def span_warnings(spark, d):
    return R.span_warnings(spans(spark, d), "user_id", F.col("event_type") == "click")


@query("sourceset_diff", "SELECT 'gone' AS change, * FROM (SELECT text, lang FROM documents WHERE doc_id % 2 = 0 EXCEPT ALL SELECT text, lang FROM documents WHERE doc_id % 2 = 1) UNION ALL SELECT 'new', * FROM (SELECT text, lang FROM documents WHERE doc_id % 2 = 1 EXCEPT ALL SELECT text, lang FROM documents WHERE doc_id % 2 = 0)")
def sourceset_diff(spark, d):
    docs = read(spark, d, "documents")
    a, b = (docs.filter(F.col("doc_id") % 2 == i).select("text", "lang") for i in (0, 1))
    return a.exceptAll(b).select(F.lit("gone").alias("change"), "*").unionByName(b.exceptAll(a).select(F.lit("new").alias("change"), "*"))


@query("discover", """WITH s AS (SELECT doc_id, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS copy, min(doc_id) OVER (PARTITION BY text) AS first, lang, n_chars FROM documents)
SELECT doc_id, CASE WHEN lang = 'es' THEN 'unassigned' WHEN n_chars < 200 THEN 'ignored' WHEN copy > 1 THEN 'duplicate' ELSE 'selected' END AS role, CASE WHEN lang != 'es' AND n_chars >= 200 AND copy > 1 THEN first END AS duplicate_of FROM s""")
def discover(spark, d):
    """A role for every source. Copies are found by their hash, so that no text is shuffled."""
    s = read(spark, d, "documents").select("doc_id", "lang", "n_chars", F.coalesce(F.sha2("text", 256), F.lit("")).alias("h"))
    s = s.join(s.groupBy("h").agg(F.min("doc_id").alias("first")), "h")
    copy = F.col("doc_id") > F.col("first")
    role = F.when(F.col("lang") == "es", "unassigned").when(F.col("n_chars") < 200, "ignored").when(copy, "duplicate").otherwise("selected")
    return s.select("doc_id", role.alias("role"), F.when(role == "duplicate", F.col("first")).alias("duplicate_of"))


@query("inspect_run", "SELECT c_custkey, o_orderkey IS NULL AS work, o_orderkey FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) ON o_custkey = c_custkey")
def inspect_run(spark, d):
    """Sources with their cached captures; those without one are the work to do."""
    cached = read(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return R.work(read(spark, d, "customer"), cached, "c_custkey", "o_orderkey")


# ---- joins and windows


@query("speaker_lookup", "SELECT l_orderkey, l_linenumber, s_name, n_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_quantity > 45")
def speaker_lookup(spark, d):
    """Whether the roster is broadcast is left to its size."""
    roster = read(spark, d, "supplier").join(read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "n_name")
    return read(spark, d, "lineitem").filter("l_quantity > 45").join(roster, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "l_linenumber", "s_name", "n_name")


@query("public_overlap", "WITH " + SPANS_SQL + """, turns AS (SELECT user_id, min(start) AS start, max("end") AS "end" FROM (SELECT *, start // 3600000 AS hour FROM spans) GROUP BY user_id, hour)
SELECT user_id, start, "end", EXISTS (SELECT 1 FROM turns b WHERE b.user_id != a.user_id AND b.start < a."end" AND a.start < b."end" AND least(a."end", b."end") - greatest(a.start, b.start) >= 250) AS overlap FROM turns a""")
def public_overlap(spark, d):
    turns = spans(spark, d).groupBy("user_id", Q.floor_div(F.col("start"), 3_600_000).alias("hour")).agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("hour")
    shared = F.least("l.end", "r.end") - F.greatest("l.start", "r.start")
    hit = I.overlap_join(turns, turns, 600_000, on=(F.col("l.user_id") != F.col("r.user_id")) & (shared >= 250)).select("l.user_id", "l.start", "l.end").distinct()
    return turns.join(hit.withColumn("overlap", F.lit(True)), ["user_id", "start", "end"], "left").select("user_id", "start", "end", F.coalesce("overlap", F.lit(False)).alias("overlap"))


REQUESTS_SQL = SPANS_SQL + ", requests AS (SELECT track, start // 3600000 AS request, start // 3600000 * 3600000 AS a, start // 3600000 * 3600000 + 300000 AS b FROM spans GROUP BY ALL)"


@query("words_script", "WITH " + REQUESTS_SQL + ' SELECT request, s.track, event_id, greatest(s.start, a) AS start, least(s."end", b) AS "end" FROM requests r JOIN spans s ON s.track = r.track AND s.start < b AND s."end" > a')
def words_script(spark, d):
    s = spans(spark, d)
    hour = Q.floor_div(F.col("start"), 3_600_000)
    requests = s.select("track", hour.alias("request")).distinct().select("track", "request", (F.col("request") * 3_600_000).alias("start"), (F.col("request") * 3_600_000 + 300_000).alias("end"))
    return R.scripted(requests, s.withColumnRenamed("event_id", "word"), 600_000).withColumnRenamed("word", "event_id")


@query("peak_rms_clip", "SELECT l_suppkey, max(abs(l_quantity)) AS peak, sum((l_quantity * l_quantity)::BIGINT)::BIGINT AS power, count(*) AS n, floor(1000.0 * count(*) FILTER (WHERE l_quantity >= 49) / count(*) + 0.5)::INTEGER AS clipped FROM lineitem GROUP BY l_suppkey")
def peak_rms_clip(spark, d):
    q = F.col("l_quantity").cast("long")
    return read(spark, d, "lineitem").groupBy("l_suppkey").agg(*R.measures(q, F.col("l_quantity") >= 49))


@query("default_windows", "WITH " + SPANS_SQL + """, t AS (SELECT track, max("end") - min(start) AS n FROM spans GROUP BY track), w AS (SELECT track, n, least(600000, greatest(n // 2, 1)) AS span FROM t)
SELECT track, 'opening' AS name, 0::BIGINT AS start, span AS "end" FROM w UNION ALL SELECT track, 'closing', greatest(0, n - span), n FROM w""")
def default_windows(spark, d):
    """A window at each end of every track."""
    t = spans(spark, d).groupBy("track").agg((F.max("end") - F.min("start")).alias("n"))
    return t.select("track", F.inline(R.end_windows(F.col("n"), 600_000)))


@query("candidates", "WITH " + REGIONS_SQL + ', lim AS (SELECT max("end") - 10 AS n FROM regions) SELECT track, start * 3 AS start, least("end" * 3, n * 3) AS "end" FROM regions, lim WHERE least("end" * 3, n * 3) > start * 3')
def candidates_on_grid(spark, d):
    """Regions on the session's grid, held within its length; empty ones go. The length is one row."""
    r = regions(spark, d)
    limit = r.agg((F.max("end") - 10).alias("n"))
    end = F.least(F.col("end") * 3, F.col("n") * 3)
    return r.crossJoin(F.broadcast(limit)).select("track", (F.col("start") * 3).alias("start"), end.alias("end")).filter("end > start")


@query("mixable", "SELECT c_custkey, CASE WHEN n IS NULL THEN 'absent' ELSE 'mixed' END AS state FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey")
def mixable(spark, d):
    return R.mixable(read(spark, d, "customer"), read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


# ---- scalar functions


@query("core_cap", "SELECT event_id, cap - 2 * CASE WHEN cap <= 2 * pad THEN greatest(0, (cap - 1) // 2) ELSE pad END AS core, CASE WHEN cap <= 2 * pad THEN greatest(0, (cap - 1) // 2) ELSE pad END AS pad FROM (SELECT event_id, (1 + event_id % 7) * 16000 AS cap, floor(value * 160)::BIGINT AS pad FROM events)")
def core_cap(spark, d):
    e = read(spark, d, "events").select("event_id", ((1 + F.col("event_id") % 7) * 16_000).alias("cap"), F.floor(F.col("value") * 160).alias("asked"))
    pad = F.when(F.col("cap") <= 2 * F.col("asked"), F.greatest(F.lit(0), F.expr("(cap - 1) div 2"))).otherwise(F.col("asked"))
    return e.select("event_id", (F.col("cap") - 2 * pad).alias("core"), pad.alias("pad"))


@query("pct_encode", "SELECT page_id, url_encode(url || ' ~ü') AS component, octet_length(encode(url_encode(url || ' ~ü'))) <= 60 AS within FROM pages")
def pct_encode(spark, d):
    p = read(spark, d, "pages").select("page_id", X.percent_encode(F.concat("url", F.lit(" ~ü"))).alias("component"))
    return p.select("page_id", "component", (F.octet_length("component") <= 60).alias("within"))


@query("guaranteed_overlap_gain", "WITH t AS (SELECT l_orderkey, count(*) AS tracks FROM lineitem GROUP BY l_orderkey) SELECT l_orderkey, tracks, round(20 * log10(0.5::DOUBLE / (1.5::DOUBLE + 0.005::DOUBLE * greatest(tracks - 2, 0))) - 6, 9) AS gain FROM t")
def guaranteed_overlap_gain(spark, d):
    """Orders are sessions, their lines tracks."""
    envelope = {n: v for n, (v, _) in C.SECTIONS["mix.envelope"].items()}
    sessions = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("tracks"))
    return sessions.withColumn("gain", F.round(N.guaranteed_gain(F.col("tracks"), envelope["min_active_share"], envelope["room_tone_share"], envelope["max_level_correction_db"]), 9))


ITEMS_SQL = "items AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, round(value, 2)::DECIMAL(12,2) AS s, event_type AS text FROM events WHERE event_type != 'error'), cumulated AS (SELECT user_id, i, text, CASE WHEN user_id % 5 = 0 THEN s ELSE i + s / 1000 END::DECIMAL(18,6) AS s FROM items)"


@query("decode_alignment", f"""WITH {ITEMS_SQL}, g AS (SELECT *, 100 + floor(s * 16000 + 0.5::DECIMAL(2,1))::BIGINT AS a, 100 + floor((s + 0.08::DECIMAL(3,2)) * 16000 + 0.5::DECIMAL(2,1))::BIGINT AS b FROM cumulated),
v AS (SELECT *, a < lag(a) OVER (PARTITION BY user_id ORDER BY i) OR b > 100 + 16000 * 500 AS bad FROM g),
k AS (SELECT *, coalesce(bool_or(bad) OVER (PARTITION BY user_id), false) AS void FROM v) SELECT user_id, i, a AS start, greatest(b, a + 1) AS "end", text FROM k WHERE NOT void""")
def decode_alignment(spark, d):
    """Users whose items run backwards (every fifth) lose them all."""
    e = read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).filter("event_type != 'error'")
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    s = F.round("value", 2).cast("decimal(12,2)")
    items = e.select("user_id", i.alias("i"), s.alias("s"), F.col("event_type").alias("text"))
    at = F.when(F.col("user_id") % 5 == 0, F.col("s").cast("decimal(18,6)")).otherwise((F.col("i").cast("decimal(10,0)") + F.col("s") / 1000).cast("decimal(18,6)"))
    items = items.select("user_id", "i", "text", at.cast("string").alias("start_s"), (at + F.lit("0.08").cast("decimal(3,2)")).cast("string").alias("end_s"))
    return T.alignment(items, "user_id", "i", F.lit(100), F.lit(100 + 16_000 * 500))


@query("looks_truncated", r"SELECT doc_id, length(trim(text, E' \t\n\r')) > 0 AND n_chars >= 1024 - 16 AS truncated FROM documents")
def looks_truncated(spark, d):
    return read(spark, d, "documents").select("doc_id", T.looks_truncated(F.regexp_replace("text", r"^[ \t\n\r]+|[ \t\n\r]+$", ""), F.col("n_chars"), 1024, 16).alias("truncated"))


@query("parse_ebur128", "SELECT event_id, CASE WHEN event_id % 9 != 0 THEN -round(value * 10)::BIGINT * 10 END AS integrated, round(value)::BIGINT * 10 AS peak FROM events")
def parse_ebur128(spark, d):
    """A meter's summary: hundredths of a decibel; -inf is no measurement."""
    loud = F.when(F.col("event_id") % 9 == 0, "-inf").otherwise(F.concat(F.lit("-"), (F.round(F.col("value") * 10) / 10).cast("decimal(10,1)").cast("string")))
    log = F.concat(F.lit("Summary:\n  Integrated loudness:\n    I:         "), loud, F.lit(" LUFS\n  True peak:\n    Peak:      "), (F.round("value") / 10).cast("decimal(10,1)").cast("string"), F.lit(" dBFS\n"))
    found = lambda pattern: F.regexp_extract(log, pattern, 1).try_cast("double")
    return read(spark, d, "events").select("event_id", *[Q.round_half_away((found(p) * 1000).cast("long"), F.lit(10).cast("long")).alias(n) for p, n in ((r"I:\s+(-?[0-9.]+) LUFS", "integrated"), (r"Peak:\s+(-?[0-9.]+) dBFS", "peak"))])


@query("array_map_funcs", """SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS ids, count(DISTINCT l_suppkey) AS n, bool_or(l_suppkey % 3 = 0) AS some FROM lineitem GROUP BY l_orderkey""")
def array_map_funcs(spark, d):
    ids = F.array_sort(F.collect_set("l_suppkey"))
    g = read(spark, d, "lineitem").groupBy("l_orderkey").agg(ids.alias("ids"))
    return g.select("l_orderkey", F.array_join("ids", ",").alias("ids"), F.size("ids").cast("long").alias("n"), F.exists("ids", lambda i: i % 3 == 0).alias("some"))


@query("json_funcs", """SELECT event_id, '{"kind":"' || event_type || '","user":' || user_id || '}' AS document, user_id AS back FROM events""")
def json_funcs(spark, d):
    """Serialized with keys in order, and read again."""
    doc = F.to_json(F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user")))
    return read(spark, d, "events").select("event_id", doc.alias("document"), F.from_json(doc, "user long")["user"].alias("back"))


@query("round_half_away", "SELECT event_id, sign(n) * ((2 * abs(n) + den) // (2 * den)) AS quotient FROM (SELECT event_id, (event_id - 5000) * 7 AS n, 2 + event_id % 12 AS den FROM events)")
def round_half_away(spark, d):
    return read(spark, d, "events").select("event_id", Q.round_half_away((F.col("event_id") - 5000) * 7, 2 + F.col("event_id") % 12).alias("quotient"))


@query("stale_check", "SELECT o_orderkey, CASE WHEN o_orderpriority != '1-URGENT' THEN 'records_stale' END AS warning FROM orders")
def stale_check(spark, d):
    return read(spark, d, "orders").select("o_orderkey", R.stale(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("warning"))


@query("marker_report", "SELECT l_orderkey, CASE WHEN bool_or(l_returnflag = 'A') AND bool_or(l_linestatus = 'F') THEN 'partial' WHEN bool_or(l_returnflag = 'A') THEN 'failed' ELSE 'complete' END AS status FROM lineitem GROUP BY l_orderkey")
def marker_report(spark, d):
    """A failed analysis is partial if it left a deliverable."""
    return read(spark, d, "lineitem").groupBy("l_orderkey").agg(*R.outcome(F.col("l_returnflag") == "A", F.col("l_linestatus") == "F"))


# ---- transcript


@query("candidate_groups", """WITH o AS (SELECT o_custkey AS track, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rank, o_orderstatus FROM orders),
own AS (SELECT track, rank, rank // 3 AS request FROM o UNION ALL SELECT track, rank, 1000000 + rank // 4 FROM o WHERE o_orderstatus = 'F'),
runs AS (SELECT track, min(rank) AS a, max(rank) AS b FROM own WHERE request % 2 = 0 GROUP BY track, request),
m AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY track ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM runs),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY track ORDER BY a, b) AS island FROM m), g AS (SELECT track, min(a) AS a, max(b) AS b FROM i GROUP BY track, island)
SELECT o.track, rank, coalesce(g.a, rank) AS group_rank FROM o LEFT JOIN g ON g.track = o.track AND rank BETWEEN g.a AND g.b""")
def candidate_groups(spark, d):
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("track"), F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long").alias("rank"), "o_orderstatus")
    own = o.select("track", "rank", F.expr("rank div 3").alias("request")).unionByName(o.filter("o_orderstatus = 'F'").select("track", "rank", (1_000_000 + F.expr("rank div 4")).alias("request")))
    return T.candidate_groups(own.withColumn("wordless", F.col("request") % 2 == 0), "track", "rank", "request", "wordless")


PARTS_SQL = """parts AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'segment_only' ELSE 'aligned' END AS alignment, text, turn * 100 AS a, turn * 100 + 90 AS b FROM conversations WHERE turn < 40 AND text IS NOT NULL)"""


@query("draft_segment", rf"""WITH {PARTS_SQL}, g AS (SELECT conv_id, bool_and(alignment = 'aligned') AS aligned, bool_or(alignment = 'segment_only') AS failed, min(a) AS a, max(b) AS b, string_agg(text, ' ' ORDER BY turn) AS t FROM parts GROUP BY conv_id)
SELECT conv_id, CASE WHEN aligned THEN a + 5 ELSE a END AS start, CASE WHEN aligned THEN b - 5 ELSE b END AS "end", trim(regexp_replace(t, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS text, CASE WHEN aligned THEN 'aligned' WHEN failed THEN 'segment_only' ELSE 'not_attempted' END AS alignment FROM g WHERE trim(regexp_replace(t, '[ \t\n\x0B\f\r]+', ' ', 'g')) != ''""")
def draft_segment(spark, d):
    """A word is a whole turn here, five samples within its ownership."""
    c = read(spark, d, "conversations").filter("text is not null")
    a = F.col("turn") * 100
    word = F.array(F.struct((a + 5).alias("start"), (a + 85).alias("end"), F.col("text").alias("text")))
    parts = c.select("conv_id", F.col("turn").alias("ordinal"), F.when(F.col("role") == "system", "segment_only").otherwise("aligned").alias("alignment"), "text", a.alias("ownership_start"), (a + 90).alias("ownership_end"), word.alias("words"))
    return T.drafts(parts, ["conv_id"]).select("conv_id", "start", "end", "text", "alignment")


@query("request_identity", "SELECT doc_id, sha256(sha256(text) || octet_length(encode(source)) || ':' || source || octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id) AS identity FROM documents")
def request_identity(spark, d):
    return read(spark, d, "documents").select("doc_id", T.request_identity(F.col("text").cast("binary"), F.col("source"), F.col("doc_id")).alias("identity"))


@query("build_transcript", """SELECT event_id::VARCHAR AS segment_id, floor((2 * (event_id * 777) + 48) / 96.0) / 1000 AS start_s, floor((2 * (event_id * 777 + user_id * 48) + 48) / 96.0) / 1000 AS end_s, event_type AS text FROM events""")
def build_transcript(spark, d):
    """Public segments: seconds at millisecond precision, read back from their JSON."""
    turns = read(spark, d, "events").select(
        F.col("event_id").cast("string").alias("segment_id"), (F.col("event_id") * 777).alias("start"), (F.col("event_id") * 777 + F.col("user_id") * 48).alias("end"),
        F.col("user_id").cast("string").alias("speaker_id"), F.col("event_type").alias("text"), F.lit(False).alias("overlap"), F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(48).cast("long").alias("end"), F.col("event_type").alias("text"))).alias("words"),
    )
    doc = F.from_json("document", "start_s double, end_s double, text string")
    return T.transcript_json(turns, 48_000).select("segment_id", doc.alias("x")).select("segment_id", "x.start_s", "x.end_s", "x.text")


@query("build_records", "SELECT o_orderkey, c_name AS speaker_name, count(l_linenumber) AS pieces, coalesce(sum(l_quantity), 0)::BIGINT AS samples, CASE o_orderstatus WHEN 'F' THEN 'suppressed' ELSE 'retained' END AS decision FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL")
def build_records(spark, d):
    """Drafts with their verdict, speaker and pieces: pieces are gathered before the join, each within its draft."""
    pieces = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_quantity").alias("samples"))
    speakers = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("speaker_name"))
    drafts = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "F", "suppressed").otherwise("retained").alias("decision"))
    return R.records(drafts, speakers, pieces, "o_orderkey", "o_custkey").select("o_orderkey", "speaker_name", "pieces", "samples", "decision")


# ---- markers


MARKERS = sorted(W.SHAPES)
PLAYED_SQL = "played AS (SELECT o_orderkey, [" + ", ".join(f"'{n}'" for n in MARKERS) + f'][o_orderkey % {len(MARKERS)} + 1] AS marker, o_custkey * 4800 AS "from" FROM orders)'


@query("marker_specs", "WITH " + PLAYED_SQL + ", s(marker, f0, f1, ms, g1, g2, mid) AS (VALUES " + ", ".join(f"('{n}', {lo}, {hi}, {ms}, {g[0]}, {g[1]}, '{dirs[1]}')" for n, (lo, hi, ms, dirs, g) in W.SHAPES.items()) + """), c AS (SELECT *, unnest([0, 1, 2]) AS chirp FROM s)
SELECT o_orderkey, marker, chirp, "from" + (100 + chirp * ms + CASE WHEN chirp > 0 THEN g1 ELSE 0 END + CASE WHEN chirp > 1 THEN g2 ELSE 0 END)::BIGINT * 48 AS start, "from" + (100 + (chirp + 1) * ms + CASE WHEN chirp > 0 THEN g1 ELSE 0 END + CASE WHEN chirp > 1 THEN g2 ELSE 0 END)::BIGINT * 48 AS "end",
CASE WHEN chirp = 1 AND mid = 'd' THEN f1 ELSE f0 END AS first_hz, CASE WHEN chirp = 1 AND mid = 'd' THEN f0 ELSE f1 END AS last_hz FROM played JOIN c USING (marker)""")
def marker_specs(spark, d):
    """The chirps of the marker that each order plays, in samples of its session."""
    marker = F.get(F.array(*map(F.lit, MARKERS)), (F.col("o_orderkey") % len(MARKERS)).cast("int"))
    played = read(spark, d, "orders").select("o_orderkey", marker.alias("marker"), (F.col("o_custkey") * 4800).alias("at"))
    return played.join(W.marker_table(spark), "marker").select("o_orderkey", "marker", "chirp", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end"), "first_hz", "last_hz")


def waveforms(frames):
    """samples and sha256 of what each row's marker is at its level; one waveform is held at a time."""
    shapes = {n: W.marker_samples(W.marker(n)).astype(int) for n in MARKERS}
    for frame in frames:
        told = []
        for n, level in zip(frame["marker"], frame["level"], strict=True):
            made = shapes[n] * level // 1000
            told.append((len(made), hashlib.sha256(W.wav_bytes(made)).hexdigest()))
        yield frame.assign(samples=[n for n, _ in told], sha256=[h for _, h in told])


@query("synth_marker")
def synth_marker(spark, d):
    """s_suppkey, marker, level, samples, sha256 of the waveform that each supplier plays at its level. Tests hold it to the sweep's formula."""
    marker = F.get(F.array(*map(F.lit, MARKERS)), (F.col("s_suppkey") % len(MARKERS)).cast("int"))
    played = read(spark, d, "supplier").select("s_suppkey", marker.alias("marker"), (F.lit(100) + F.col("s_suppkey") % 900).cast("int").alias("level"))
    return played.mapInPandas(waveforms, "s_suppkey long, marker string, level int, samples long, sha256 string")


@query("sequence_nms")
def sequence_nms(spark, d):
    s = spans(spark, d).select("track", Q.floor_div(F.col("start"), 1000).alias("anchor"), F.col("p").alias("score"))
    return K.sequence_nms(s.groupBy("track", "anchor").agg(F.max("score").alias("score")), ["track"], 60)


@query("runner_up", "WITH " + SPANS_SQL + """, pk AS (SELECT track, start // 1000 AS at, max(p) AS score FROM spans GROUP BY 1, 2), hits AS (SELECT * FROM pk WHERE score >= 950),
free AS (SELECT * FROM pk WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.track = pk.track AND abs(h.at - pk.at) <= 300))
SELECT h.track, h.at AS anchor, h.score, coalesce(max(f.score), 0) AS runner_up, coalesce(max(f.score), 0) > 0 AND h.score - coalesce(max(f.score), 0) < 50 AS ambiguous FROM hits h LEFT JOIN free f ON f.track = h.track AND abs(f.at - h.at) <= 3000 GROUP BY h.track, h.at, h.score""")
def runner_up(spark, d):
    pk = spans(spark, d).groupBy("track", Q.floor_div(F.col("start"), 1000).alias("at")).agg(F.max("p").alias("score")).withColumn("chirp", F.lit(0))
    kept = pk.filter("score >= 950").select("track", F.col("at").alias("anchor"), "score", F.array(F.struct("at", "score")).alias("hits"))
    return K.runner_up(kept, pk, ["track"], 300, 3000, 50).select("track", "anchor", "score", "runner_up", "ambiguous")


@query("detect_occurrences")
def detect_occurrences(spark, d):
    """Markers planted in noise, one track for each region, found again. Tests hold the places to those planted."""
    size, n = 48_000, 6

    def run(frames):
        m = W.marker()
        x = W.marker_samples(m) / 32768
        for frame in frames:
            for track in frame["track"]:
                y = W.floor_noise(size * n, int(track), -50).astype(float)
                y[12_345 * (int(track) + 1) :][: len(x)] += 0.3 * x
                yield pd.DataFrame({"track": track, "window": range(n), "samples": [y[i * size : (i + 1) * size].tolist() for i in range(n)]})

    tracks = read(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("track")).repartition(4)
    found = K.detect(tracks.mapInPandas(run, "track long, window long, samples array<float>"), ["track"], size)
    return found.select("track", "anchor", "score", F.to_json("gap_errors").alias("gap_errors"), "runner_up", "ambiguous", "clipped", "weak")


# ---- archive


@query("zstd_codec", "SELECT doc_id, octet_length(encode(text)) AS size, sha256(text) AS sha256, true AS smaller_than_bound FROM documents")
def zstd_codec(spark, d):
    """Every whole text compressed, decompressed and measured."""

    def run(frames):
        for frame in frames:
            rows = []
            for doc, text in zip(frame["doc_id"], frame["text"], strict=True):
                if text is None:
                    rows.append((doc, None, None, True))
                    continue
                raw = text.encode()
                packed = io.BytesIO()
                _, size = codec.compress(io.BytesIO(raw), packed, len(raw))
                plain, _ = codec.decompress(io.BytesIO(packed.getvalue()), len(raw))
                rows.append((doc, plain.size, plain.sha256, size.size <= len(raw) + (len(raw) >> 8) + 128))
            yield pd.DataFrame(rows, columns=["doc_id", "size", "sha256", "smaller_than_bound"]).astype({"size": "Int64"})

    return read(spark, d, "documents").select("doc_id", "text").mapInPandas(run, "doc_id long, size long, sha256 string, smaller_than_bound boolean")


@query("archive_verify", "SELECT source, count(*) AS objects, CASE WHEN bool_and(sha256(CASE WHEN doc_id % 97 = 5 THEN text || '.' ELSE text END) = sha256(text)) THEN 'verified' ELSE 'divergent' END AS verification FROM documents GROUP BY source")
def archive_verify(spark, d):
    """The hashes in a manifest, made when every 97th text was another, against the texts: one bad object makes its session divergent."""
    then = F.when(F.col("doc_id") % 97 == 5, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    manifest = read(spark, d, "documents").select("doc_id", F.sha2(then, 256).alias("listed"))
    objects = read(spark, d, "documents").select("doc_id", "source", F.sha2("text", 256).alias("found"))
    good = F.bool_and(F.col("listed") == F.col("found"))
    return objects.join(manifest, "doc_id").groupBy("source").agg(F.count("*").alias("objects"), F.when(good, "verified").otherwise("divergent").alias("verification"))


@query("manifest_trust", "SELECT page_id, CASE WHEN starts_with(url, 'https://example.org/') THEN 'trusted' ELSE 'archive_manifest_foreign' END AS verdict FROM pages")
def manifest_trust(spark, d):
    return read(spark, d, "pages").select("page_id", R.trusted(F.col("url"), "https://example.org/").alias("verdict"))
