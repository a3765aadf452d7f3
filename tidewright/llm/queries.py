"""The queries of the training-data operators, with the parameters used in production, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import langid, licenses, lmscore, media, mixing, packing, quality, signatures, simhash, toxicity, urlfilter, vectorcode, vptree, whitening
from tidewright.llm.common import read

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
TARGETS = mixing.Targets(domain={"d0": 5, "d1": 3, "d2": 2}, lang={"en": 6, "de": 2, "fr": 2, "es": 1})
MIX = {"budget_percent": 80, "max_epochs": 4, "seed": 42}


def op1_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest(media.decode(media.encode(read(spark, sf_dir, "documents"))))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score_documents(read(spark, sf_dir, "documents"))


def op5_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(read(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), TARGETS, **MIX)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read(spark, sf_dir, "pages"), RULES)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = whitening.whiten(read(spark, sf_dir, "embeddings"))
    values = model.values.tolist() if model else []
    told = F.array(*[F.lit(v / model.trace) for v in values]).cast("array<double>")
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(told, F.col("at")).alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = vectorcode.compress(read(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"), "evaluated")


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.detect(read(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mpeg_audio, op2_language_id, op3_toxicity, op4_lm_scoring, op5_vantage_point, op6_packing, op7_quality, op8_mixing, op9_simhash, op10_url_filter, op11_whitening, op12_vector_codes, op13_license_scan)}


def _url_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return f"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
raw AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS h FROM cut),
urls AS (SELECT page_id, translate(h, '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS host, regexp_extract(substr(rest, length(h) + 1), '^([^?#]*)', 1) AS path FROM raw),
rules(verdict, h, p) AS (VALUES {rules}),
fit AS (SELECT u.page_id, u.host, u.path, r.h || r.p AS rule, r.verdict, row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.h || r.p) DESC, length(r.h) DESC) AS place
  FROM urls u LEFT JOIN rules r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fit WHERE place = 1"""


def _weight_sql(level: str) -> str:
    cases = " ".join(f"WHEN '{n}' THEN {w}" for n, w in getattr(TARGETS, level).items())
    return f"CASE {level} {cases} ELSE 1 END" if cases else "1"


def _deal_sql(nodes: str, family: str, name: str) -> str:
    part = f"PARTITION BY {family}" if family else ""
    order = f"{part} ORDER BY capacity / weight, {name}"
    return f"""SELECT *, CASE WHEN is_full THEN capacity ELSE rest::HUGEINT * upto // open_sum - rest::HUGEINT * (upto - weight) // open_sum END::BIGINT AS share FROM (
  SELECT *, budget - coalesce(sum(CASE WHEN is_full THEN capacity END) OVER ({part}), 0) AS rest,
    sum(CASE WHEN NOT is_full THEN weight END) OVER ({part}) AS open_sum,
    coalesce(sum(CASE WHEN NOT is_full THEN weight END) OVER ({order} ROWS UNBOUNDED PRECEDING), 0) AS upto FROM (
    SELECT *, capacity::HUGEINT * open_weight <= (budget - used)::HUGEINT * weight AS is_full FROM (
      SELECT *, coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
        sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM ({nodes}))))"""


def _mix_sql() -> str:
    percent, epochs, seed = MIX["budget_percent"], MIX["max_epochs"], MIX["seed"]
    by_domain = f"SELECT domain, sum(capacity)::BIGINT AS capacity, {_weight_sql('domain')} AS weight, least((SELECT sum(leaf_tokens) * {percent} // 100 FROM leaf), (SELECT sum(capacity) FROM leaf)) AS budget FROM leaf GROUP BY domain"
    by_lang = f"SELECT domain, lang, sum(capacity)::BIGINT AS capacity, {_weight_sql('lang')} AS weight, any_value(share) AS budget FROM leaf JOIN (SELECT domain, share FROM a) USING (domain) GROUP BY domain, lang"
    by_leaf = f"SELECT domain, lang, source, leaf_tokens, capacity, {_weight_sql('source')} AS weight, share AS budget FROM leaf JOIN (SELECT domain, lang, share FROM b) USING (domain, lang)"
    return f"""
WITH named AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS digits,
  coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\x0B]+')), 0) AS n_tokens FROM documents),
d AS (SELECT doc_id, CASE WHEN digits = '' THEN 'none' ELSE 'd' || (digits::BIGINT % 3) END AS domain, lang, source, n_tokens FROM named),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS leaf_tokens, sum(n_tokens)::BIGINT * {epochs} AS capacity FROM d GROUP BY domain, lang, source),
a AS ({_deal_sql(by_domain, "", "domain")}),
b AS ({_deal_sql(by_lang, "domain", "lang")}),
c AS ({_deal_sql(by_leaf, "domain, lang", "source")}),
plan AS (SELECT domain, lang, source, leaf_tokens, share, CASE WHEN leaf_tokens > 0 THEN share // leaf_tokens ELSE 0 END AS epochs FROM c),
r AS (SELECT d.*, leaf_tokens, share, epochs, share - epochs * leaf_tokens AS need, md5('{seed}|' || epochs || '|' || coalesce(doc_id::VARCHAR, '')) AS k FROM d JOIN plan USING (domain, lang, source)),
s AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k RANGE UNBOUNDED PRECEDING) AS upto FROM r WHERE n_tokens > 0 AND need > 0),
cut AS (SELECT domain, lang, source, min(k) AS cut FROM s WHERE upto >= need GROUP BY domain, lang, source)
SELECT doc_id, domain, lang, source, n_tokens, leaf_tokens, share, (epochs + CASE WHEN n_tokens > 0 AND k <= cut THEN 1 ELSE 0 END)::INTEGER AS copies
FROM r LEFT JOIN cut USING (domain, lang, source)"""


def _license_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rules = ", ".join(f"({r.number}, {quoted(r.label)}, {r.level}, {quoted(k)}, {quoted(r.pattern)})" for r in licenses.rules() for k in r.keywords)
    phrases = ", ".join(f"({quoted(p)}, {quoted(label)})" for p, label in signatures.PHRASES.items())
    return f"""
WITH rules(rule, label, level, keyword, pattern) AS (VALUES {rules}),
phrases(phrase, label) AS (VALUES {phrases}),
d AS (SELECT row_number() OVER () AS uid, doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}'), '{licenses.BETWEEN}', ' ', 'g'), ' ') AS t FROM documents),
w AS (SELECT uid, doc_id, CASE WHEN t = '' THEN []::VARCHAR[] ELSE string_split(t, ' ') END AS words FROM d),
each AS (SELECT uid, words, unnest(range(len(words))) AS i FROM w),
base AS (SELECT uid, i, p.label FROM each JOIN phrases p ON words[i + 1] = string_split(p.phrase, ' ')[1] AND array_to_string(words[i + 1:i + len(string_split(p.phrase, ' '))], ' ') = p.phrase),
met AS (SELECT uid, i, r.*, regexp_extract(array_to_string(words[i + 1:i + {licenses.REACH}], ' ') || ' ', pattern) AS m FROM each JOIN rules r ON words[i + 1] = r.keyword),
det AS (SELECT uid, rule, label, level, i AS a, i + length(m) - length(replace(m, ' ', '')) AS b FROM met WHERE m <> ''),
kept AS (SELECT * FROM det x WHERE NOT EXISTS (SELECT 1 FROM det y WHERE y.uid = x.uid AND y.a <= x.a AND y.b >= x.b AND y.level >= x.level AND (y.level > x.level OR y.b - y.a > x.b - x.a OR y.rule < x.rule))),
told AS (SELECT uid, label, level / {licenses.LEVELS} AS score FROM kept UNION ALL SELECT uid, label, 0.4 FROM base),
by_text AS (SELECT uid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM told GROUP BY uid),
by_base AS (SELECT uid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY uid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN by_text USING (uid) LEFT JOIN by_base USING (uid)"""


def oracle_sql() -> dict[str, str]:
    """For the queries that SQL can express; the others have brute-force tests."""
    return {"op8_mixing": _mix_sql(), "op10_url_filter": _url_sql(), "op13_license_scan": _license_sql()}
