"""Queries of discovery, start times, origins and layouts: sessions made of the driver's events, documents and orders."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewright.operators import assembly as B
from tidewright.operators import discovery as D
from tidewright.operators import envelope as N
from tidewright.operators import markerrun as K
from tidewright.operators import rules as R
from tidewright.operators import starts as O
from tidewright.plans.registry import query, read

# Start times: tags and overrides of every event.

TAGS_SQL = """tags AS (SELECT event_id, user_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '-' || floor(value * 1000)::BIGINT WHEN 2 THEN floor(value * 1000)::BIGINT || 'x' ELSE ' ' || floor(value * 1000)::BIGINT END AS ref,
  CASE WHEN event_id % 13 > 0 THEN strftime(ts, '%H:%M:%S') || CASE WHEN user_id % 3 = 0 THEN ';' ELSE ':' END || lpad((event_id % 40)::VARCHAR, 2, '0') END AS code,
  event_id % 17 = 0 AS ov, CASE WHEN event_id % 85 = 0 THEN 'other' END AS ov_sha, CASE WHEN event_id % 34 = 0 THEN user_id - 50 END AS off, CASE WHEN event_id % 51 = 0 THEN '01:02:03:04' END AS ov_code FROM events)"""
CODE_SQL = """CASE WHEN NOT regexp_matches({c}, '^[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}[:;.][0-9]{{2}}$') THEN 'malformed' WHEN {c}[9:9] <> ':' THEN 'drop_notation'
  WHEN {c}[1:2]::INT >= 24 OR {c}[4:5]::INT >= 60 OR {c}[7:8]::INT >= 60 OR {c}[10:11]::INT >= 30 THEN 'out_of_range' END"""
FRAMES_OF_SQL = "(({c}[1:2]::BIGINT * 60 + {c}[4:5]::BIGINT) * 60 + {c}[7:8]::BIGINT) * 30 + {c}[10:11]::BIGINT"


@query("start_strategies", "WITH " + TAGS_SQL + f""", why AS (SELECT *, CASE WHEN NOT ov THEN 'no_override' WHEN off IS NULL THEN 'no_start_offset' END AS w1, CASE WHEN NOT ov THEN 'no_override' WHEN ov_code IS NULL THEN 'no_start_timecode' END AS w2,
  CASE WHEN ref IS NULL THEN 'no_tag' WHEN NOT regexp_matches(trim(ref), '^[+-]?[0-9]+$') THEN 'not_an_integer' WHEN trim(ref)::BIGINT < 0 THEN 'negative' END AS w3, CASE WHEN code IS NULL THEN 'no_tag' ELSE {CODE_SQL.format(c="code")} END AS w4 FROM tags),
s AS (SELECT *, CASE WHEN ov_sha IS NOT NULL THEN 0 WHEN w1 IS NULL THEN 1 WHEN w2 IS NULL THEN 2 WHEN w3 IS NULL THEN 3 WHEN w4 IS NULL THEN 4 ELSE 5 END AS i FROM why)
SELECT event_id, CASE i WHEN 1 THEN 'recovery_override_offset' WHEN 2 THEN 'recovery_override_timecode' WHEN 3 THEN 'bwf_time_reference' WHEN 4 THEN 'timecode_tag' END AS strategy,
  CASE i WHEN 1 THEN off WHEN 2 THEN {FRAMES_OF_SQL.format(c="ov_code")} WHEN 3 THEN trim(ref)::BIGINT WHEN 4 THEN {FRAMES_OF_SQL.format(c="code")} END AS "count",
  CASE i WHEN 1 THEN off * 14700 WHEN 2 THEN ({FRAMES_OF_SQL.format(c="ov_code")}) * 23520000 WHEN 3 THEN trim(ref)::BIGINT * 14700 WHEN 4 THEN ({FRAMES_OF_SQL.format(c="code")}) * 23520000 END AS flicks,
  array_to_string(list_value(w1, w2, w3, w4)[1:greatest(i - 1, 0)], ',') AS declined, CASE i WHEN 0 THEN 'override_hash_mismatch' WHEN 5 THEN 'no_start_time' END AS refusal FROM s""")  # fmt: skip
def start_strategies(spark, d):
    e = read(spark, d, "events")
    n, at, ts = F.floor(F.col("value") * 1000).cast("long").cast("string"), F.col("event_id"), F.col("ts").cast("timestamp")
    rows = e.select(
        "event_id", F.lit("own").alias("sha256"), F.lit(O.RATE).alias("rate"),
        F.when(at % 5 == 0, None).when(at % 5 == 1, F.concat(F.lit("-"), n)).when(at % 5 == 2, F.concat(n, F.lit("x"))).otherwise(F.concat(F.lit(" "), n)).alias("time_reference"),
        F.when(at % 13 > 0, F.concat(F.date_format(ts, "HH:mm:ss"), F.when(F.col("user_id") % 3 == 0, ";").otherwise(":"), F.lpad((at % 40).cast("string"), 2, "0"))).alias("timecode"),
        F.lit(None).cast("date").alias("recording_date"), F.lit("log").alias("reason"), (at % 17 == 0).alias("overridden"), F.when(at % 85 == 0, "other").alias("override_sha256"),
        F.when(at % 34 == 0, F.col("user_id") - 50).cast("long").alias("start_offset"), F.when(at % 51 == 0, "01:02:03:04").alias("start_timecode"),
    )
    own = O.start_times(rows, F.lit("30F"), F.lit(1600))
    return own.select("event_id", "strategy", F.col("start.count").alias("count"), F.col("start.flicks").alias("flicks"), F.array_join(F.transform("declined", lambda x: x["reason"]), ",").alias("declined"), "refusal")


# Origins: a user's events of an hour are a session of sources, by time references, timecodes and offsets.

ORIGIN_SQL = """src AS (SELECT user_id, event_id, epoch_us(ts) // 1000000 // 86400 // 5 AS part, CASE WHEN user_id % 5 = 3 AND event_id % 3 = 0 THEN 'timecode' WHEN event_id % 7 = 0 THEN 'offset' ELSE 'reference' END AS kind,
  (epoch_us(ts) // 1000000 + user_id * 3600) % 86400 // (CASE WHEN user_id % 4 = 0 THEN 7200 ELSE 1 END) * (CASE WHEN user_id % 4 = 0 THEN 7200 ELSE 1 END) AS sec, CASE WHEN user_id % 5 = 1 THEN ts::DATE END AS told, CASE WHEN user_id % 5 = 2 THEN 43200 END AS zero,
  CASE WHEN user_id % 3 = 0 THEN 'reject' ELSE 'infer_forward' END AS policy FROM events),
t AS (SELECT *, user_id || '-' || part AS session, CASE kind WHEN 'reference' THEN sec * 48000 * 14700 WHEN 'timecode' THEN sec * 30 * 23543520::HUGEINT ELSE (event_id % 1000 - 500) * 14700 END AS x, CASE kind WHEN 'reference' THEN 86400 * 705600000::HUGEINT WHEN 'timecode' THEN 2592000 * 23543520::HUGEINT END AS day FROM src),
g AS (SELECT session, event_id, lead(x) OVER (PARTITION BY session ORDER BY x, event_id) - x AS gap, x FROM t WHERE kind <> 'offset'),
w AS (SELECT session, max(gap) AS widest FROM g GROUP BY session), c AS (SELECT g.session, count(*) AS ties, max(x) AS cut FROM g JOIN w ON w.session = g.session AND g.gap = w.widest GROUP BY g.session),
s AS (SELECT session, count(day) AS n, min(CASE WHEN day IS NOT NULL THEN told END) AS first_day, coalesce(bool_and(told IS NOT NULL) FILTER (day IS NOT NULL), false) AS dated, min(x) FILTER (day IS NOT NULL) + min(day) - max(x) FILTER (day IS NOT NULL) AS wrap, min(day) <> max(day) AS odd FROM t GROUP BY session),
r AS (SELECT t.*, n, odd, CASE WHEN n = 0 THEN NULL WHEN dated THEN 'dates' WHEN zero IS NOT NULL THEN 'zero' ELSE 'gap' END AS rule, n > 1 AND wrap <= widest AS crosses, n > 1 AND wrap <= widest AND (wrap = widest OR ties > 1) AS tie, cut, first_day FROM t JOIN s USING (session) LEFT JOIN w USING (session) LEFT JOIN c USING (session)),
k AS (SELECT *, CASE WHEN day IS NULL THEN 0 WHEN rule = 'dates' THEN date_diff('day', first_day, told) WHEN rule = 'zero' THEN (x < zero * 705600000::HUGEINT)::INT WHEN crosses AND x <= cut THEN 1 ELSE 0 END AS cycles FROM r),
z AS (SELECT *, coalesce(zero * 705600000::HUGEINT, min(x + cycles * day) OVER (PARTITION BY session), 0) AS base, max(cycles) OVER (PARTITION BY session) AS turned FROM k),
e AS (SELECT *, CASE WHEN day IS NULL THEN x ELSE x + cycles * day - base END AS y FROM z), q AS (SELECT *, (CASE WHEN y < 0 THEN -((-2 * y + 14700) // 29400) ELSE (2 * y + 14700) // 29400 END)::BIGINT AS place FROM e),
v AS (SELECT *, min(place) OVER (PARTITION BY session) AS first FROM q),
o AS (SELECT *, CASE WHEN rule = 'zero' AND policy = 'reject' AND turned > 0 THEN 'rollover_rejected' WHEN rule = 'gap' AND (odd OR tie) THEN 'rollover_ambiguous' WHEN rule = 'gap' AND policy = 'reject' AND crosses THEN 'rollover_rejected' WHEN zero IS NOT NULL AND first < 0 THEN 'audio_before_session_zero' END AS refusal FROM v)"""


@query("origin_decision", "WITH " + ORIGIN_SQL + " SELECT session, event_id, rule, cycles::INTEGER AS cycles, CASE WHEN refusal IS NULL THEN place - CASE WHEN zero IS NULL THEN least(first, 0) ELSE 0 END END AS position, refusal FROM o")
def origin_decision(spark, d):
    us = F.expr("unix_micros(cast(ts as timestamp)) div 1000000")
    e = read(spark, d, "events").withColumns({"_us": us, "u": F.col("user_id")})
    step = F.when(F.col("u") % 4 == 0, 7200).otherwise(1).cast("long")
    sec = F.call_function("div", (F.col("_us") + F.col("u") * 3600) % 86400, step) * step
    kind = F.when((F.col("u") % 5 == 3) & (F.col("event_id") % 3 == 0), "timecode").when(F.col("event_id") % 7 == 0, "offset").otherwise("reference")
    e = e.withColumns({"_kind": kind, "_sec": sec.cast("long")})
    frame = 23_543_520  # flicks of a frame at 30000/1001
    count = F.when(F.col("_kind") == "reference", F.col("_sec") * O.RATE).when(F.col("_kind") == "timecode", F.col("_sec") * 30).otherwise(F.col("event_id") % 1000 - 500)
    flicks = count * F.when(F.col("_kind") == "timecode", frame).otherwise(O.FLICK // O.RATE)
    day = F.when(F.col("_kind") == "reference", F.lit(O.DAY)).when(F.col("_kind") == "timecode", F.lit(2_592_000 * frame))
    start = F.struct(F.col("_kind").alias("kind"), count.cast("long").alias("count"), flicks.cast("long").alias("flicks"), day.cast("long").alias("day"), F.lit(1600).cast("long").alias("quantum"))
    rows = e.select(
        F.concat_ws("-", "u", F.expr("_us div 86400 div 5")).alias("session"), "event_id", "user_id", start.alias("start"), F.when(F.col("u") % 5 == 1, F.to_date("ts")).alias("asserted"),
        F.when(F.col("u") % 5 == 2, F.lit(43_200 * O.FLICK)).cast("long").alias("zero"), F.lit(None).cast("date").alias("origin_date"), F.when(F.col("u") % 3 == 0, "reject").otherwise("infer_forward").alias("rollover"),
    )
    return O.origin(rows, ["session"], "user_id", "event_id").select("session", "event_id", "rule", "cycles", "position", "refusal")


# Layout: an order's lines are the chunks of a track; the SQL walks them one by one.


@query("chunk_layout", """WITH RECURSIVE c AS (SELECT l_orderkey, l_linenumber, date_diff('day', DATE '1992-01-01', l_shipdate::DATE) AS start, l_quantity::BIGINT AS n, CASE WHEN l_partkey % 3 = 0 THEN 30 ELSE 5 END AS quantum, row_number() OVER (PARTITION BY l_orderkey ORDER BY date_diff('day', DATE '1992-01-01', l_shipdate::DATE), l_linenumber, l_partkey, l_suppkey, l_quantity) AS i FROM lineitem),
walk AS (SELECT *, start AS placed, 0 AS gap, 0 AS overlap, NULL::BIGINT AS tolerance FROM c WHERE i = 1 UNION ALL
  SELECT c.*, greatest(c.start, w.placed + w.n), greatest(0, c.start - w.placed - w.n), greatest(0, w.placed + w.n - c.start), greatest(1, c.quantum, w.quantum) FROM walk w JOIN c ON c.l_orderkey = w.l_orderkey AND c.i = w.i + 1)
SELECT l_orderkey, l_linenumber, placed::BIGINT AS placed, gap::BIGINT AS gap, overlap::BIGINT AS overlap, CASE WHEN gap > 0 THEN 'chunk_gap_preserved' WHEN overlap = 0 THEN NULL WHEN overlap <= tolerance THEN 'chunk_overlap_quantization' WHEN l_orderkey % 2 = 0 THEN 'chunk_overlap' ELSE 'chunk_overlap_nudged' END AS verdict FROM walk""")
def chunk_layout(spark, d):
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date")).cast("long")
    quantum = F.when(F.col("l_partkey") % 3 == 0, 30).otherwise(5).cast("long")
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", day.alias("position"), F.col("l_quantity").cast("long").alias("n"), F.struct(quantum.alias("quantum")).alias("start"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("path"), F.lit(0).alias("session"))
    policy = F.when(F.col("l_orderkey") % 2 == 0, "reject").otherwise("nudge_later")
    return O.lay_out(rows, ["session"], "l_orderkey", "path", "n", policy).select("l_orderkey", "l_linenumber", "placed", "gap", "overlap", "verdict")


# Discovery: documents are files, their hash is that of the text, a session is a source, its tracks are languages.

FILES_SQL = """f AS (SELECT doc_id, coalesce(source, 'none') AS session, sha256(coalesce(text, '')) AS sha, CASE WHEN doc_id % 11 = 0 THEN 'raw/extra/deep' WHEN doc_id % 13 = 0 THEN 'raw' ELSE 'raw/' || coalesce(lang, 'xx') END AS dir,
  CASE doc_id % 4 WHEN 0 THEN 'TX01_MIC' || lpad((doc_id // 4)::VARCHAR, 6, '0') || '_20240101_120000_orig.wav' WHEN 1 THEN 'TX01_MIC' || lpad((doc_id // 4)::VARCHAR, 6, '0') || '_20240101_120000_edit.wav' WHEN 2 THEN 'take' || doc_id || '.WAV' ELSE 'note' || doc_id || '.txt' END AS name FROM documents),
p AS (SELECT session, dir || '/' || name AS path, sha, CASE WHEN dir IN ('raw/en', 'raw/de', 'raw/fr') THEN dir[5:] END AS track, dir, name, lower(name) LIKE '%.wav' AS wav, CASE WHEN name LIKE '%_orig.wav' THEN 'orig' WHEN name LIKE '%_edit.wav' THEN 'edit' ELSE 'unknown' END AS variant, CASE WHEN name LIKE 'TX%' THEN name[9:14] ELSE dir || name END AS pair FROM f),
a AS (SELECT *, first_value(path) OVER (PARTITION BY session, sha ORDER BY track IS NULL, variant = 'edit', path) AS keeper FROM p WHERE wav),
b AS (SELECT *, coalesce(bool_or(variant <> 'edit' AND keeper = path) OVER (PARTITION BY session, track), false) AND track IS NOT NULL AS live, max(CASE WHEN variant <> 'edit' THEN path END) OVER (PARTITION BY session, track, pair) AS partner FROM a),
files AS (SELECT session, path, track, variant, keeper, CASE WHEN keeper <> path THEN 'duplicate' WHEN track IS NULL THEN 'unassigned' WHEN variant = 'edit' AND live THEN 'associated_edit' ELSE 'selected' END AS role, partner FROM b)"""


def found(spark, d):
    at = F.col("doc_id")
    number = F.lpad(F.call_function("div", at, F.lit(4)).cast("string"), 6, "0")
    take = lambda variant: F.concat(F.lit("TX01_MIC"), number, F.lit(f"_20240101_120000_{variant}.wav"))
    folder = F.when(at % 11 == 0, "raw/extra/deep").when(at % 13 == 0, "raw").otherwise(F.concat(F.lit("raw/"), F.coalesce("lang", F.lit("xx"))))
    name = F.when(at % 4 == 0, take("orig")).when(at % 4 == 1, take("edit")).when(at % 4 == 2, F.concat(F.lit("take"), at.cast("string"), F.lit(".WAV"))).otherwise(F.concat(F.lit("note"), at.cast("string"), F.lit(".txt")))
    files = read(spark, d, "documents").select(F.coalesce("source", F.lit("none")).alias("session"), F.concat(folder, F.lit("/"), name).alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    sessions = files.select("session").distinct()
    tracks = sessions.select("session", F.explode(F.array(*map(F.lit, ("en", "de", "fr", "it")))).alias("track")).withColumn("input", F.concat(F.lit("raw/"), "track"))
    odd = F.ascii(F.substring("session", -1, 1)) % 2 == 1
    settings = sessions.select("session", odd.alias("allow_processed"), F.when(odd, F.array(F.lit("en"), F.lit("it"))).alias("active"))
    return D.discover(files, tracks, settings)


@query("discover_sources", "WITH " + FILES_SQL + """ SELECT session, path, track, role, CASE role WHEN 'duplicate' THEN 'duplicate_content' WHEN 'unassigned' THEN 'directory_not_configured' WHEN 'associated_edit' THEN 'processed_variant_ignored' ELSE CASE WHEN variant = 'edit' THEN 'processed_audio_selected' ELSE 'original_selected' END END AS reason,
  CASE role WHEN 'duplicate' THEN keeper WHEN 'associated_edit' THEN partner END AS associated FROM files""")
def discover_sources(spark, d):
    return found(spark, d).sources.select("session", "path", "track", "role", "reason", "associated")


@query("discover_roster", "WITH " + FILES_SQL + """, s AS (SELECT DISTINCT session, ascii(session[-1:]) % 2 = 1 AS odd FROM f), t AS (SELECT session, odd, track FROM s, (VALUES ('en'), ('de'), ('fr'), ('it')) v(track)),
n AS (SELECT session, track, count(*) AS files, sum((role = 'selected')::INT) AS selected, bool_and(role = 'duplicate') AS copies FROM files WHERE track IS NOT NULL GROUP BY ALL), h AS (SELECT DISTINCT session, track FROM p WHERE track IS NOT NULL)
SELECT session, track, CASE WHEN odd AND track NOT IN ('en', 'it') THEN 'not_listed' WHEN coalesce(selected, 0) > 0 THEN 'active' WHEN h.session IS NULL THEN 'missing_directory' WHEN files IS NULL THEN 'empty_directory' WHEN copies THEN 'all_duplicates' ELSE 'no_usable_original' END AS state, coalesce(files, 0)::BIGINT AS files, coalesce(selected, 0)::BIGINT AS selected FROM t LEFT JOIN n USING (session, track) LEFT JOIN h USING (session, track)""")
def discover_roster(spark, d):
    return found(spark, d).roster.select("session", "track", "state", "files", "selected")


@query("discover_refusals", "WITH " + FILES_SQL + """ SELECT DISTINCT session, 'processed_audio_only' AS code, track AS subject FROM files WHERE role = 'selected' AND variant = 'edit' AND ascii(session[-1:]) % 2 = 0
UNION ALL SELECT session, 'required_track_missing', track FROM (SELECT DISTINCT session FROM f WHERE ascii(session[-1:]) % 2 = 1) x, (VALUES ('en'), ('it')) v(track) WHERE NOT EXISTS (SELECT 1 FROM files WHERE files.session = x.session AND files.track = v.track AND role = 'selected')""")
def discover_refusals(spark, d):
    return found(spark, d).refusals


# Assembly: a user's clicks and views are what candidates own of a day's request, its other events are the answer's words.

ASKED_SQL = """e AS (SELECT *, epoch_us(ts) // 1000 AS ms, user_id || '-' || epoch_us(ts) // 86400000000 AS request FROM events),
p AS (SELECT event_id AS candidate, user_id, request, ms AS start, least(ms + floor(value * 60000)::BIGINT, coalesce(lead(ms) OVER (PARTITION BY user_id ORDER BY ms, event_id), ms + floor(value * 60000)::BIGINT)) AS "end" FROM e WHERE event_type IN ('click', 'view')),
pad AS (SELECT *, min(start) OVER (PARTITION BY request) - 600000 AS low, max("end") OVER (PARTITION BY request) + 600000 AS high FROM p),
pieces AS (SELECT *, greatest(low, coalesce(lag("end") OVER (PARTITION BY user_id ORDER BY start, "end", request, candidate), 0), start - 20000) AS eff FROM pad),
words AS (SELECT request, row_number() OVER (PARTITION BY request ORDER BY ms, event_id) - 1 AS "at", ms FROM e WHERE event_type NOT IN ('click', 'view'))"""


def asked(spark, d):
    e = read(spark, d, "events").withColumn("ms", F.expr("unix_micros(cast(ts as timestamp)) div 1000"))
    e = e.withColumn("request_id", F.concat_ws("-", "user_id", F.expr("ms div 86400000")))
    mine = F.col("event_type").isin("click", "view")
    own = (F.col("ms") + F.floor(F.col("value") * 60_000)).cast("long")
    following = F.lead("ms").over(Window.partitionBy("user_id").orderBy("ms", "event_id"))
    p = e.filter(mine).select("request_id", F.col("user_id").cast("string").alias("track_id"), F.col("event_id").alias("candidate"), F.col("ms").alias("start"), F.least(own, F.coalesce(following, own)).alias("end"))
    over = Window.partitionBy("request_id")
    p = p.withColumns({"padded_start": F.min("start").over(over) - 600_000, "padded_end": F.max("end").over(over) + 600_000})
    said = e.filter(~mine).groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct("ms", "event_id"))).alias("w"))
    words = F.transform("w", lambda w: F.struct(w["ms"].alias("start"), (w["ms"] + 1).alias("end"), w["event_id"].cast("string").alias("text")))
    return said.select("request_id", words.alias("words")), B.effective(p, 20_000)


@query("owned_words", "WITH " + ASKED_SQL + """ SELECT request AS request_id, candidate, w."at" FROM words w JOIN pieces p USING (request) WHERE w.ms >= eff AND w.ms < p."end" """)
def owned_words(spark, d):
    return B.owned(*asked(spark, d)).select("request_id", "candidate", "at")


@query("dropped_by_request", "WITH " + ASKED_SQL + """, m AS (SELECT request, w."at", candidate, CASE WHEN w.ms < eff THEN 'before' ELSE 'after' END AS side, CASE WHEN w.ms < eff THEN eff - w.ms ELSE greatest(0, w.ms - p."end" + 1) END AS distance FROM words w JOIN pieces p USING (request)),
r AS (SELECT *, row_number() OVER (PARTITION BY request, "at" ORDER BY distance, candidate, side) AS place FROM m)
SELECT request AS request_id, "at", candidate, side, distance::BIGINT AS distance FROM r WHERE place = 1 AND distance > 0""")
def dropped_by_request(spark, d):
    return B.dropped(*asked(spark, d)).select("request_id", "at", "candidate", "side", "distance")


# Turns: fifteen users are a session's tracks, a day of theirs is a request.

SEGMENTS_SQL = """s AS (SELECT user_id % 10 AS session, user_id::VARCHAR AS track_id, event_id, epoch_us(ts) // 1000 AS start, epoch_us(ts) // 1000 + floor(value * 1000)::BIGINT AS "end", CASE WHEN event_type IN ('click', 'view') THEN 'aligned' ELSE 'segment_only' END AS alignment, user_id || '-' || epoch_us(ts) // 86400000000 AS request, value > 450 AS overlap FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY start, event_id) AS n FROM s),
j AS (SELECT *, coalesce(lag(track_id) OVER w = track_id AND lag(alignment) OVER w = alignment AND NOT lag(overlap) OVER w AND NOT overlap AND lag(request) OVER w = request AND start - lag("end") OVER w BETWEEN 0 AND 7200000, false) AS joins FROM n WINDOW w AS (PARTITION BY session ORDER BY n)),
t AS (SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY session ORDER BY n ROWS UNBOUNDED PRECEDING) AS turn FROM j),
turns AS (SELECT session, turn, track_id, alignment, min(start) AS start, max("end") AS "end", string_agg(event_id::VARCHAR, ' ' ORDER BY n) AS text FROM t GROUP BY ALL)"""


@query("turns_by_request", "WITH " + SEGMENTS_SQL + """ SELECT session, turn::BIGINT AS turn, track_id, alignment, start, "end", text, EXISTS (SELECT 1 FROM turns o WHERE o.session = turns.session AND o.track_id <> turns.track_id AND least(o."end", turns."end") - greatest(o.start, turns.start) >= 30000) AS overlap FROM turns""")
def turns_by_request(spark, d):
    ms = F.expr("unix_micros(cast(ts as timestamp)) div 1000")
    s = read(spark, d, "events").withColumn("start", ms).select(
        (F.col("user_id") % 10).alias("session"), F.col("user_id").cast("string").alias("track_id"), "event_id", "start", (F.col("start") + F.floor(F.col("value") * 1000)).cast("long").alias("end"),
        F.when(F.col("event_type").isin("click", "view"), "aligned").otherwise("segment_only").alias("alignment"), F.array(F.concat_ws("-", "user_id", F.expr("start div 86400000"))).alias("request_ids"),
        (F.col("value") > 450).alias("overlap"), F.col("event_id").cast("string").alias("text"), F.array().cast("array<string>").alias("words"),
    )
    s = s.withColumn("n", F.row_number().over(Window.partitionBy("session").orderBy("start", "event_id")))
    return B.presentation(s, ["session"], 7_200_000, 600_000, 30_000).select("session", "turn", "track_id", "alignment", "start", "end", "text", "overlap")


# Level corrections: nations are tracks, the least balance of their suppliers is the level of their speech.


@query("level_corrections", """WITH t AS (SELECT n_nationkey AS track FROM nation), r AS (SELECT s_nationkey AS track, floor(min(s_acctbal))::INTEGER AS reference FROM supplier WHERE s_nationkey % 7 <> 0 GROUP BY 1),
m AS (SELECT list_sort(list(reference))[round_even((count(*) - 1) * 0.5, 0)::INTEGER + 1] AS target FROM r), w AS (SELECT track, reference, target - reference AS wanted FROM t LEFT JOIN r USING (track), m),
h AS (SELECT *, CASE WHEN wanted IS NULL THEN 0 ELSE greatest(-600, least(600, wanted)) END AS mb FROM w)
SELECT track, reference, mb::INTEGER AS correction_mb, round(pow(10, mb / 2000.0), 9) AS gain, CASE WHEN wanted IS NULL THEN 'mix_level_uncorrected' WHEN mb <> wanted THEN 'mix_level_correction_clamped' END AS note FROM h""")
def level_corrections(spark, d):
    tracks = read(spark, d, "nation").select(F.col("n_nationkey").alias("track"))
    references = read(spark, d, "supplier").filter("s_nationkey % 7 != 0").groupBy(F.col("s_nationkey").alias("track")).agg(F.floor(F.min("s_acctbal")).cast("int").alias("reference"))
    return N.corrections(references, tracks).withColumn("gain", F.round("gain", 9))


# Marker roles: a user's errors of five days are groups, its signups what someone logged.

LOGGED_SQL = """e AS (SELECT *, epoch_us(ts) // 1000 AS ms, user_id || '-' || epoch_us(ts) // 432000000000 AS session FROM events),
g AS (SELECT DISTINCT session, ms AS anchor FROM e WHERE event_type = 'error'),
ev AS (SELECT DISTINCT session, CASE WHEN value < 250 THEN 'start' ELSE 'end' END AS role, ms - 36000000 AS start, ms + floor(value * 100000)::BIGINT AS "end", CASE WHEN user_id % 2 = 0 THEN 'g' || user_id ELSE '' END AS geometry FROM e WHERE event_type = 'signup'),
held AS (SELECT ev.session, ev.start, ev."end", role, geometry, count(anchor) AS n, min(anchor) AS anchor FROM ev LEFT JOIN g ON g.session = ev.session AND anchor >= ev.start AND anchor < ev."end" GROUP BY ALL),
alone AS (SELECT *, count(*) OVER (PARTITION BY session, anchor) AS claims FROM held WHERE n = 1), named AS (SELECT * FROM alone WHERE claims = 1)"""


def logged(spark, d):
    e = read(spark, d, "events").withColumn("ms", F.expr("unix_micros(cast(ts as timestamp)) div 1000"))
    e = e.withColumn("session", F.concat_ws("-", "user_id", F.expr("ms div 432000000")))
    groups = e.filter("event_type = 'error'").select("session", F.col("ms").alias("anchor")).distinct()
    role = F.when(F.col("value") < 250, "start").otherwise("end")
    events = e.filter("event_type = 'signup'").select("session", role.alias("role"), (F.col("ms") - 36_000_000).alias("start"), (F.col("ms") + F.floor(F.col("value") * 100_000)).cast("long").alias("end"), F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("g"), F.col("user_id").cast("string"))).alias("geometry")).distinct()
    return K.roles(groups, events)


@query("marker_roles", "WITH " + LOGGED_SQL + " SELECT g.session, g.anchor, role, nullif(geometry, '') AS geometry FROM g LEFT JOIN named n ON n.session = g.session AND n.anchor = g.anchor")
def marker_roles(spark, d):
    return logged(spark, d)[0].select("session", "anchor", "role", "geometry")


@query("marker_role_notes", "WITH " + LOGGED_SQL + """ SELECT session, CASE n WHEN 0 THEN 'marker_event_without_occurrence' ELSE 'marker_event_ambiguous' END AS code, start AS "at" FROM held WHERE n <> 1 UNION ALL SELECT DISTINCT session, 'marker_event_overlap', anchor FROM alone WHERE claims > 1""")
def marker_role_notes(spark, d):
    return logged(spark, d)[1]


# Fitness: lines are sources, an order is a track of a supplier's session.

FIT_SQL = """q AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_quantity::INTEGER % 40 WHEN 0 THEN NULL WHEN 1 THEN 44100 ELSE 48000 END AS rate, CASE WHEN l_partkey % 19 = 0 THEN 2 ELSE 1 END AS channels,
  ['pcm_f32le', 'pcm_s24le', 'pcm_s16le', 'pcm_s32le', 'pcm_f32le', 'pcm_f32le'][l_partkey % 6 + 1] AS codec, CASE WHEN l_partkey % 23 > 0 THEN l_extendedprice::BIGINT END AS samples, l_extendedprice::BIGINT + CASE WHEN l_suppkey % 9 = 0 THEN 1 ELSE 0 END AS stated FROM lineitem)"""


def fit(spark, d):
    at = F.col("l_quantity").cast("int") % 40
    price = F.round(F.col("l_extendedprice")).cast("long")
    kinds = F.array(*map(F.lit, ("pcm_f32le", "pcm_s24le", "pcm_s16le", "pcm_s32le", "pcm_f32le", "pcm_f32le")))
    return read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(at == 0, None).when(at == 1, 44_100).otherwise(48_000).alias("rate"), F.when(F.col("l_partkey") % 19 == 0, 2).otherwise(1).alias("channels"),
        F.get(kinds, (F.col("l_partkey") % 6).cast("int")).alias("codec"), F.when(F.col("l_partkey") % 23 > 0, price).alias("samples"), (price + F.when(F.col("l_suppkey") % 9 == 0, 1).otherwise(0)).alias("stated"), F.lit(0).alias("session"),
    )


@query("unfit_sources", "WITH " + FIT_SQL + """, r AS (SELECT *, min(rate) OVER w <> max(rate) OVER w AS mixed FROM q WINDOW w AS (PARTITION BY l_orderkey))
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN mixed THEN 'inconsistent_sample_rate' WHEN rate IS NULL THEN 'source_not_inspected' WHEN rate <> 48000 THEN 'unsupported_sample_rate' WHEN channels <> 1 THEN 'undecodable_source' WHEN codec = 'pcm_s32le' THEN 'undecodable_source' WHEN samples IS NULL THEN 'unknown_sample_count' END AS unfit FROM r""")
def unfit_sources(spark, d):
    return O.unfit(fit(spark, d), ["session"], "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "unfit")


@query("source_warnings", "WITH " + FIT_SQL + """ SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(',', CASE WHEN rate <> 48000 THEN 'unexpected_sample_rate' END, CASE WHEN codec <> 'pcm_f32le' THEN 'unexpected_codec' END, CASE WHEN channels <> 1 THEN 'unexpected_channel_count' END, CASE WHEN samples <> stated THEN 'sample_count_disagreement' END) AS warnings FROM q""")
def source_warnings(spark, d):
    own = R.source_warnings(F.col("rate"), F.col("codec"), F.col("channels"), F.col("samples"), F.col("stated"))
    return fit(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", own.alias("warnings"))
