"""From answers to turns: who owns which word, drafts of candidates, copies of one utterance, presentation turns.

Ownership is a table: one row for each piece of a candidate that a request has in its core. All steps are joins on a request or a
candidate, windows over a track, and aggregates; what a request or a candidate holds is bounded by its length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions import text as X
from tidewright.functions.quantize import floor_div
from tidewright.operators import intervals as I
from tidewright.operators import sequences as S
from tidewright.operators import transcript as T
from tidewright.sources.shared import durable


@dataclass(frozen=True)
class Rules:
    """When two drafts are one utterance heard twice; permille, words, characters. Fixed values."""

    min_overlap: int = 500
    min_similarity: int = 850
    min_words: int = 4
    min_chars: int = 12
    min_correlation: int = 500
    min_margin: int = 100
    contained_margin: int = 300


def ownership(requests: DataFrame, candidates: DataFrame, block: int) -> DataFrame:
    """request_id, track_id, candidate, start, end, padded_start, padded_end: the part of each candidate in each request's core.

    requests: request_id, track_id, core_start, core_end, padded_start, padded_end. candidates: id, track, start, end, no longer than a few blocks as a rule.
    """
    left = requests.withColumns({"start": F.col("core_start"), "end": F.col("core_end")})
    met = I.overlap_join(left, candidates.withColumn("track_id", F.col("track").cast("string")), block, on=F.col("l.track_id") == F.col("r.track_id"))
    a, b = F.greatest("l.start", "r.start"), F.least("l.end", "r.end")
    return met.filter(b > a).select("l.request_id", "l.track_id", F.col("r.id").alias("candidate"), a.alias("start"), b.alias("end"), "l.padded_start", "l.padded_end")


def effective(pieces: DataFrame, grace: int = 0) -> DataFrame:
    """Adds effective_start: up to grace samples before the piece, not before the submitted window nor the end of the piece before it on its track.

    Adds overlapping: whether the piece begins before that end, which no request plan should bring about.
    """
    before = F.lag("end").over(Window.partitionBy("track_id").orderBy("start", "end", "request_id", "candidate"))
    zero = F.lit(0).cast("long")
    return pieces.withColumns({"effective_start": F.greatest(F.col("padded_start"), F.coalesce(before, zero), F.col("start") - grace), "overlapping": F.coalesce(F.col("start") < before, F.lit(False))})


def spoken(answers: DataFrame) -> DataFrame:
    """request_id, at, word of the answers' words."""
    return answers.select("request_id", F.posexplode("words").alias("at", "word"))


def owned(answers: DataFrame, pieces: DataFrame) -> DataFrame:
    """request_id, candidate, at, word: each word with the piece of its request that it begins in."""
    inside = (F.col("word.start") >= F.col("effective_start")) & (F.col("word.start") < F.col("end"))
    return spoken(answers).join(pieces, "request_id").filter(inside).select("request_id", "candidate", "at", "word")


def dropped(answers: DataFrame, pieces: DataFrame) -> DataFrame:
    """request_id, track_id, at, candidate, side, distance of each word that begins in no piece of its request; the nearest piece is named.

    distance: samples by which that piece would have to grow outward. A request without pieces tells nothing.
    """
    each = spoken(answers).join(pieces, "request_id")
    early = F.col("word.start") < F.col("effective_start")
    away = F.when(early, F.col("effective_start") - F.col("word.start")).otherwise(F.greatest(F.lit(0).cast("long"), F.col("word.start") - F.col("end") + 1))
    key = F.struct(away.alias("distance"), F.col("candidate").alias("candidate"), F.when(early, "before").otherwise("after").alias("side"))
    nearest = each.groupBy("request_id", "track_id", "at").agg(F.min(key).alias("k"))
    return nearest.filter("k.distance > 0").select("request_id", "track_id", "at", "k.candidate", "k.side", "k.distance")


def dropped_notes(lost: DataFrame) -> DataFrame:
    """track_id, words, before, after, leading, farthest, candidates, distances (distance, words)."""
    count = lambda c: F.sum(c.cast("long"))
    histogram = lost.groupBy("track_id", "distance").agg(F.count("*").alias("words")).groupBy("track_id").agg(F.array_sort(F.collect_list(F.struct("distance", "words"))).alias("distances"))
    told = lost.groupBy("track_id").agg(
        F.count("*").alias("words"), count(F.col("side") == "before").alias("before"), count(F.col("side") == "after").alias("after"), count(F.col("at") == 0).alias("leading"),
        F.max("distance").alias("farthest"), F.array_sort(F.collect_set("candidate")).alias("candidates"),
    )
    return told.join(histogram, "track_id")


def drafts(answers: DataFrame, pieces: DataFrame) -> DataFrame:
    """track_id, group, candidates, request_ids, start, end, ownership_start, ownership_end, text, words, alignment of each group of candidates with a text.

    Candidates that a request without words owns together are one group, transitively; every other one is a group of its own. A group that
    only aligned answers touch has the words it owns; a word that a piece of a candidate repeats from the piece before it is left out. Any other group
    has its answers' whole texts, over its ownership. Needs unique candidates for each track.
    """
    ranked = pieces.join(pieces.groupBy("track_id", "candidate").agg(F.min("start").alias("_first")), ["track_id", "candidate"])
    # a candidate's rank is its first sample: pieces of a track don't overlap
    plain = answers.select("request_id", "alignment", "text", "words", (F.size("words") == 0).alias("wordless"))
    both = durable(ranked.withColumnRenamed("_first", "rank").join(plain.select("request_id", "alignment", "wordless"), "request_id"))
    groups = T.candidate_groups(both.withColumnRenamed("track_id", "track"), "track", "rank", "request_id", "wordless").withColumnRenamed("track", "track_id")
    placed = durable(both.join(groups.select("track_id", "rank", F.col("group_rank").alias("group")), ["track_id", "rank"]))

    said = owned(answers, pieces).groupBy("request_id", "candidate").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    said = said.select("request_id", "candidate", F.transform("w", lambda x: x["word"]).alias("words"))
    cut = placed.select("request_id", "candidate", "start", "track_id").join(said, ["request_id", "candidate"], "left")
    cut = cut.withColumn("words", F.coalesce("words", F.array().cast(T.WORDS)))
    several = cut.groupBy("candidate").agg(F.count("*").alias("n"))
    cut = cut.join(several, "candidate")
    once = cut.filter("n = 1").drop("n").unionByName(T.boundary_repeats(cut.filter("n > 1").drop("n"), ["candidate"], "start"))
    rows = placed.join(once.select("request_id", "candidate", "words"), ["request_id", "candidate"])
    # whole texts once for each request that touches the group
    whole = rows.join(plain.select("request_id", "text"), "request_id")
    first = F.row_number().over(Window.partitionBy("track_id", "group", "request_id").orderBy("start")) == 1
    whole = whole.withColumn("text", F.when(first, F.col("text")).otherwise(""))
    parts = whole.select("track_id", "group", F.struct("start", "candidate").alias("ordinal"), F.col("start").alias("ownership_start"), F.col("end").alias("ownership_end"), "alignment", "text", "words")
    made = T.drafts(parts, ["track_id", "group"])
    who = placed.groupBy("track_id", "group").agg(F.array_sort(F.collect_set("candidate")).alias("candidates"), F.array_sort(F.collect_set("request_id")).alias("request_ids"))
    return made.join(who, ["track_id", "group"])


def compared(own: DataFrame, scores: DataFrame, pairs: DataFrame, block: int, rules: Rules = Rules()) -> DataFrame:
    """One row for every two drafts of different tracks that overlap: winner and loser (numbers of own), and what the rules look at.

    own: drafts with n (a number by start, track, group). scores: id, total. pairs: id, other, correlation, both ways. The better score wins, the
    earlier number a tie. correlation is the weakest over all pairs of candidates of the two; null unless every one of them was measured.
    """
    best = own.select("n", F.explode("candidates").alias("id")).join(scores.select("id", "total"), "id", "left").groupBy("n").agg(F.coalesce(F.max("total"), F.lit(0)).alias("score"))
    key = X.comparison_key(F.col("text"))
    d = durable(own.join(best, "n").withColumn("key", key))
    met = I.overlap_join(d, d, block, on=(F.col("l.n") < F.col("r.n")) & (F.col("l.track_id") != F.col("r.track_id")))
    shared = F.least("l.end", "r.end") - F.greatest("l.start", "r.start")
    shorter = F.least(F.col("l.end") - F.col("l.start"), F.col("r.end") - F.col("r.start"))
    wins = F.col("l.score") >= F.col("r.score")
    pick = lambda name: (F.when(wins, F.col(f"l.{name}")).otherwise(F.col(f"r.{name}")), F.when(wins, F.col(f"r.{name}")).otherwise(F.col(f"l.{name}")))
    near = met.filter(shared > 0)
    two = near.select(
        *(c.alias(n) for c, n in zip(pick("n"), ("winner", "loser"), strict=True)), *(c.alias(n) for c, n in zip(pick("key"), ("outer", "inner"), strict=True)), *(c.alias(n) for c, n in zip(pick("candidates"), ("ours", "theirs"), strict=True)),
        F.greatest("l.score", "r.score").alias("winner_score"), F.abs(F.col("l.score") - F.col("r.score")).alias("margin"), F.least(F.lit(1000).cast("long"), floor_div(shared * 1000, F.greatest(shorter, F.lit(1)))).alias("overlap_permille"), F.least("l.start", "r.start").alias("at"),
    )
    two = durable(two)
    cross = two.select("winner", "loser", F.explode("ours").alias("id"), "theirs").select("winner", "loser", "id", F.explode("theirs").alias("other"))
    measured = cross.join(pairs.select("id", "other", "correlation"), ["id", "other"], "left").groupBy("winner", "loser").agg(F.min("correlation").alias("_least"), F.bool_and(F.col("correlation").isNotNull()).alias("_all"))
    long_enough = lambda c: (X.word_count(F.col(c)) >= rules.min_words) & (F.char_length(c) >= rules.min_chars)
    words = lambda c: F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(F.col(c), " "))
    out = two.join(measured, ["winner", "loser"])
    return out.select(
        "winner", "loser", "winner_score", "margin", "overlap_permille", "at", F.when(F.col("_all"), F.col("_least")).alias("correlation"), (long_enough("outer") & long_enough("inner")).alias("long_enough"),
        X.similarity(F.col("outer"), F.col("inner")).alias("similarity"), X.contains_words(words("outer"), words("inner")).alias("contains"),
    )


def numbered_by(rows: DataFrame, at: str, order: list[str], block: int) -> DataFrame:
    """Adds n: the place of each row in the order, which begins with at, from 0. Rows are ordered within blocks of at; one row for each block tells how many come before."""
    df = rows.withColumn("_block", floor_div(F.col(at), block))
    sizes = df.groupBy("_block").agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = df.join(sizes.select("_block", before.alias("_before")), "_block")
    place = F.row_number().over(Window.partitionBy("_block").orderBy(*order)) - 1
    return placed.withColumn("n", (F.col("_before") + place).cast("long")).drop("_block", "_before")


def verdicts(own: DataFrame, scores: DataFrame, pairs: DataFrame, block: int, least_overlap: int, rules: Rules = Rules()) -> DataFrame:
    """drafts with n, decision (retained, duplicate), duplicate_of (number), contained, overlap (of retained ones with another track's retained one)."""
    numbered = durable(numbered_by(own, "start", ["start", "track_id", "group"], block))
    reach = I.island_starts(numbered.select("n", "start", "end"), "start", "end", block)
    two = compared(numbered, scores, pairs, block, rules).join(reach.select(F.col("n").alias("winner"), "island"), "winner")
    gone = S.collapse(two, rules.min_overlap, rules.min_similarity, rules.min_words, rules.min_chars, rules.min_correlation, rules.min_margin, rules.contained_margin)
    told = durable(numbered.join(gone.select(F.col("loser").alias("n"), F.col("winner").alias("duplicate_of"), "contained"), "n", "left"))
    kept = told.filter("duplicate_of is null")
    flags = overlaps(kept, "n", block, least_overlap)
    return told.join(flags, "n", "left").withColumns({"overlap": F.coalesce("overlap", F.lit(False)), "decision": F.when(F.col("duplicate_of").isNull(), "retained").otherwise("duplicate")})


def overlaps(kept: DataFrame, key: str, block: int, least: int) -> DataFrame:
    """key, overlap (true) of rows that share at least so many samples with one of another track."""
    shared = F.least("l.end", "r.end") - F.greatest("l.start", "r.start")
    own = kept.select(key, "track_id", "start", "end")
    met = I.overlap_join(own, own, block, on=(F.col("l.track_id") != F.col("r.track_id")) & (shared >= max(1, least)))
    return met.select(F.col(f"l.{key}").alias(key)).distinct().withColumn("overlap", F.lit(True))


def joins(segments: DataFrame, by: list[str], order: list[str], gap: int) -> Column:
    """Whether a segment goes on with the one before it in the order of all tracks.

    Same track and alignment, neither in an overlap, a request in common, and at most the gap between them. Requests follow each other in time, so
    that a segment that shares one with its turn shares it with the turn's last segment.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    before = lambda c: F.lag(c).over(w)
    space = F.col("start") - before("end")
    same = (before("track_id") == F.col("track_id")) & (before("alignment") == F.col("alignment")) & ~before("overlap") & ~F.col("overlap")
    return F.coalesce(same & F.arrays_overlap(before("request_ids"), F.col("request_ids")) & space.between(0, gap), F.lit(False))


def presentation(segments: DataFrame, by: list[str], gap: int, block: int, least_overlap: int) -> DataFrame:
    """by, turn, track_id, start, end, text, words, alignment, overlap, sources: retained segments (with n), joined to turns; overlap is looked for anew among turns."""
    order = ["n"]
    marked = segments.withColumn("_fresh", F.when(joins(segments, by, order, gap), 0).otherwise(1))
    marked = marked.withColumn("turn", F.sum("_fresh").over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    listed = marked.groupBy(*by, "turn", "track_id", "alignment").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.array_sort(F.collect_list(F.struct("n", "text", "words"))).alias("_s"))
    turns = durable(listed.select(
        *by, "turn", "track_id", "alignment", "start", "end", F.array_join(F.transform("_s", lambda s: s["text"]), " ").alias("text"), F.flatten(F.transform("_s", lambda s: s["words"])).alias("words"),
        F.transform("_s", lambda s: s["n"]).alias("sources"),
    ))
    shared = F.least("l.end", "r.end") - F.greatest("l.start", "r.start")
    same = F.lit(True)
    for c in by:
        same = same & (F.col(f"l.{c}") == F.col(f"r.{c}"))
    own = turns.select(*by, "turn", "track_id", "start", "end")
    met = I.overlap_join(own, own, block, on=same & (F.col("l.track_id") != F.col("r.track_id")) & (shared >= max(1, least_overlap)))
    flags = met.select(*[F.col(f"l.{c}").alias(c) for c in by], F.col("l.turn").alias("turn")).distinct().withColumn("overlap", F.lit(True))
    return turns.join(flags, [*by, "turn"], "left").withColumn("overlap", F.coalesce("overlap", F.lit(False)))
