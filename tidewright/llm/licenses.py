"""License detections by ordered signature rules, in one pass over each text; native expressions only.

Texts are read as lower-case words. Texts without any keyword end at one look; in the others each place of a keyword is met by
the rules that begin with it, over the words that follow. Of overlapping detections one goes if it lies within another
of a greater priority, or of the same one that is longer or, at the same words, stands earlier in the list. Others stay, side by side.

No row leaves its task: nothing is shuffled, joined or collected. Within a text detections are sorted and swept once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm import common, signatures
from tidewright.llm.urlfilter import LOWER, UPPER

#: What separates words, once A-Z are lower-cased: ASCII but for digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words that follow a keyword and are looked at; no rule reaches further.
REACH = 48
LEVELS = 5
#: Detections swept into one list before it is joined to those before.
_SWEEP = 256
_DETECTION = "struct<start:int,end:int,level:int,rule:int,label:string>"


@dataclass(frozen=True)
class Rule:
    """A signature: it begins with one of the keywords; pattern is matched at a keyword's place over words that each end with a space."""

    number: int
    label: str
    level: int
    keywords: tuple[str, ...]
    pattern: str


def rules(text: str = signatures.TEXT) -> list[Rule]:
    """The rules of a list such as signatures.TEXT, in its order."""
    out = []
    for line in text.strip().split("\n"):
        label, level, keywords, rest = (x.strip() for x in line.split("|", 3))
        first = tuple(keywords.split(","))
        if not 1 <= int(level) <= LEVELS:
            raise ValueError(f"priority {level} of {label}")
        out.append(Rule(len(out), label, int(level), first, f"^(?:{'|'.join(first)}) " + (f"(?:{rest}) " if rest else "")))
    return out


def normal(text: Column) -> Column:
    """The words, each with a space behind it."""
    plain = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN, " ")
    return F.ltrim(F.concat(plain, F.when(plain.endswith(" "), "").otherwise(" ")))


def n_words(normal_text: Column) -> Column:
    """Every word ends with a space."""
    return (F.octet_length(normal_text) - F.octet_length(F.replace(normal_text, F.lit(" "), F.lit("")))).cast("long")


def places(normal_text: Column, words: Column, phrase: str) -> Column:
    """Where the phrase's words stand one behind another, counted from 0, also where it overlaps itself."""
    own = phrase.split(" ")
    at = F.filter(F.transform(words, lambda w, i: F.when((w == own[0]) & (F.array_join(F.slice(words, i + 1, len(own)), " ") == phrase), i)), lambda i: i.isNotNull())
    return F.when(F.contains(normal_text, F.lit(phrase + " ")), at).otherwise(F.array().cast("array<int>"))


def _named(starts: Column, label: str) -> Column:
    return F.transform(starts, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))


def _literals(own: list[Rule]) -> Column:
    return F.array(*[F.struct(F.lit(r.number).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.level).alias("level"), F.array(*map(F.lit, r.keywords)).alias("keywords"), F.lit(r.pattern).alias("pattern")) for r in own])


def _found(hits: Column, known: Column, own: list[Rule]) -> Column:
    """Every rule at every hit of one of its keywords that the following words match; known are the hits' words."""

    def at(rule: Column) -> Column:
        near = F.filter(hits, lambda h: F.array_contains(rule["keywords"], h["word"]))
        told = F.transform(near, lambda h: F.struct(h["at"].alias("start"), n_words(F.call_function("regexp_extract", h["ahead"], rule["pattern"], F.lit(0))).cast("int").alias("n")))
        kept = F.filter(told, lambda d: d["n"] > 0)
        return F.transform(kept, lambda d: F.struct(d["start"].alias("start"), (d["start"] + d["n"]).alias("end"), rule["level"].alias("level"), rule["rule"].alias("rule"), rule["label"].alias("label")))

    gated = F.filter(_literals(own), lambda r: F.arrays_overlap(r["keywords"], known))
    return F.flatten(F.transform(gated, at))


def _ordered(found: Column) -> Column:
    """By start, falling end, falling level, rule."""
    return F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("to"), (-d["level"]).alias("down"), d["rule"].alias("rule"), d["label"].alias("label"))))


def _swept(order: Column) -> Column:
    """Of _ordered() those that aren't suppressed.

    Whatever holds a detection stands before it; one of its own level or above does if those levels' furthest end so far isn't before its end.
    """
    nothing = F.array().cast(f"array<{_DETECTION}>")

    def step(state: Column, d: Column) -> Column:
        end, level = -d["to"], -d["down"]
        ends = state["ends"]
        held = F.get(ends, level - 1) >= end
        own = F.struct(d["start"].alias("start"), end.alias("end"), level.alias("level"), d["rule"].alias("rule"), d["label"].alias("label"))
        reach = F.transform(ends, lambda x, i: F.when(i < level, F.greatest(x, end)).otherwise(x))
        return F.struct(reach.alias("ends"), F.when(held, state["kept"]).otherwise(F.concat(state["kept"], F.array(own))).alias("kept"))

    def block(state: Column, k: Column) -> Column:
        inner = F.aggregate(F.slice(order, k * _SWEEP + 1, F.lit(_SWEEP)), F.struct(state["ends"].alias("ends"), nothing.alias("kept")), step)
        return F.struct(inner["ends"].alias("ends"), F.concat(state["kept"], inner["kept"]).alias("kept"))

    begin = F.struct(F.array(*[F.lit(-1)] * LEVELS).alias("ends"), nothing.alias("kept"))
    blocks = F.sequence(F.lit(0), F.floor((F.size(order) - 1) / _SWEEP).cast("int"))
    return F.when(F.size(order) == 0, nothing).otherwise(F.aggregate(blocks, begin, block)["kept"])


def detect(documents: DataFrame, own: list[Rule] | None = None, phrases: dict[str, str] = signatures.PHRASES) -> DataFrame:
    """doc_id, n_words, base (start, label of each place of a phrase, by start), detections (start, end, level, rule, label; end exclusive, in words), score.

    score: the greatest level of a detection by LEVELS; with places of phrases at least 0.4; 0 without anything. Null texts count as
    empty, which have no word; very long texts are read as a whole; repeated rows stay repeated; null doc_ids
    are rows like others; an empty table gives no rows; extra columns are ignored.
    """
    own = rules() if own is None else own
    keywords = sorted({k for r in own for k in r.keywords})
    rows = common.pick(documents, "doc_id", "text").select("doc_id", normal(F.col("text")).alias("normal"))
    gate = F.col("normal").rlike(f"(?:^| )(?:{'|'.join(keywords)}) ")
    phrase_gate = F.col("normal").rlike(f"(?:^| )(?:{'|'.join(phrases)}) ")
    rows = rows.withColumns({"gate": gate, "phrase_gate": phrase_gate})
    rows = rows.withColumn("words", F.when(F.col("gate") | F.col("phrase_gate"), F.split("normal", " ", -1)).otherwise(F.array().cast("array<string>")))
    hit = lambda w, i: F.when(w.isin(*keywords), F.struct(i.alias("at"), w.alias("word"), F.concat(F.array_join(F.slice(F.col("words"), i + 1, REACH), " "), F.lit(" ")).alias("ahead")))
    hits = F.when(F.col("gate"), F.filter(F.transform("words", hit), lambda h: h.isNotNull())).otherwise(F.array().cast("array<struct<at:int,word:string,ahead:string>>"))
    base = F.flatten(F.array(*[_named(places(F.col("normal"), F.col("words"), p), label) for p, label in phrases.items()]))
    rows = rows.select("doc_id", n_words(F.col("normal")).alias("n_words"), F.array_sort(base).alias("base"), hits.alias("hits"))
    rows = rows.withColumn("known", F.array_distinct(F.transform("hits", lambda h: h["word"])))
    found = F.when((F.size("hits") > 0) & (F.size("known") > 0), _ordered(_found(F.col("hits"), F.col("known"), own)))
    rows = rows.withColumn("found", F.coalesce(found, F.array().cast("array<struct<start:int,to:int,down:int,rule:int,label:string>>")))
    rows = rows.withColumn("detections", _swept(F.col("found")))
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["level"])), F.lit(0)) / LEVELS
    score = F.greatest(best, F.when(F.size("base") > 0, 0.4).otherwise(0.0))
    return rows.select("doc_id", "n_words", "base", "detections", score.alias("score"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of what detect() gives."""
    labels = lambda c: F.transform(c, lambda d: d["label"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    starts = F.transform("base", lambda d: d["start"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(labels(F.col("base"))).alias("base_labels"), joined(F.concat(labels(F.col("base")), labels(F.col("detections")))).alias("labels"), "score",
    )
