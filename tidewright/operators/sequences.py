"""Order-dependent folds: what no window function states.

A fold takes an entity's rows in order, batch by batch, and carries a few numbers from one batch to the next; Spark deals the
entities to tasks and sorts, and spills, within them. No task holds an entity's rows at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.quantize import floor_div
from tidewright.operators.markers import sequence_nms
from tidewright.sources.shared import durable


def divide(df: DataFrame, start: str, end: str, cap: int) -> DataFrame:
    """Intervals longer than cap in the least number of near-equal pieces, on floor boundaries."""
    total = F.col(end) - F.col(start)
    k = -floor_div(-total, cap)
    i = df.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), k - 1)))
    cut = lambda n: F.col(start) + floor_div(n * total, k)
    return i.withColumns({"piece_start": cut(F.col("piece")), "piece_end": cut(F.col("piece") + 1)})


def fold(df: DataFrame, by: Sequence[str], order: Sequence[str], step: Callable[[dict[str, np.ndarray], Any], tuple[np.ndarray, Any]], name: str, kind: str) -> DataFrame:
    """Adds a column. step gets a run of one entity's rows, in order, and what it returned as its state last (None at first)."""
    names = df.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, state = None, None
        for frame in frames:
            if frame.empty:
                continue
            keys = list(zip(*(frame[c].tolist() for c in by), strict=True))
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            out = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if keys[a] != last:
                    last, state = keys[a], None
                values, state = step({c: frame[c].to_numpy()[a:b] for c in order}, state)
                out.append(values)
            yield frame[names].assign(**{name: np.concatenate(out)})

    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInPandas(run, _with(df, f"{name} {kind}"))


def pack_cap(pieces: DataFrame, by: Sequence[str], start: str, end: str, cap: int) -> DataFrame:
    """Adds request: a new one begins when a piece would end more than cap after the request's first start."""

    def step(rows: dict[str, np.ndarray], state: tuple[int, int] | None) -> tuple[np.ndarray, tuple[int, int]]:
        n, first = state or (-1, None)
        out = []
        for a, b in zip(rows[start].tolist(), rows[end].tolist(), strict=True):
            if first is None or b - first > cap:
                n, first = n + 1, a
            out.append(n)
        return np.array(out, np.int64), (n, first)

    return fold(pieces, by, [start, end], step, "request", "long")


def _with(df: DataFrame, extra: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), extra])


def slew_limit(frames: DataFrame, by: Sequence[str], frame: str, target: str, rise: float, fall: float) -> DataFrame:
    """Adds applied: the target, held within fall below and rise above the frame before; begins at 0."""

    def step(rows: dict[str, np.ndarray], state: float | None) -> tuple[np.ndarray, float]:
        last, out = state or 0.0, []
        for t in rows[target].astype(float).tolist():
            last = min(max(t, last - fall), last + rise)
            out.append(last)
        return np.array(out), last

    return fold(frames, by, [frame, target], step, "applied", "double")


def peak_pick(scores: DataFrame, by: Sequence[str], at: str, score: str, least: int, radius: int) -> DataFrame:
    """Greedy peaks of each entity: the greatest score (ties: the first position), then none within radius of it, and so on.

    Peaks further apart than the radius from all others can't touch them: the fold runs over clusters of near ones.
    """
    return sequence_nms(scores.filter(F.col(score) >= least), by, radius, at, score)


def collapse(pairs: DataFrame, min_overlap: int = 500, min_similarity: int = 850, min_words: int = 4, min_chars: int = 12, min_correlation: int = 500, min_margin: int = 100, contained_margin: int = 300) -> DataFrame:
    """(island, loser, winner, contained): greedy resolution of compared pairs, one island of overlapping drafts at a time, in one frame.

    collapse_drafts() does the same without pairs, where they can be compared from two drafts alone.

    pairs has island, winner, loser, winner_score, overlap_permille, similarity, correlation (null: unknown), margin, long_enough
    and contains. They are taken by greatest winner score. Pass one takes duplicates, and none whose loser
    has absorbed another; pass two takes contained fragments, and has no such guard.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["winner_score", "winner", "loser"], ascending=[False, True, True])
        gone: dict[int, tuple[int, bool]] = {}
        absorbed: set[int] = set()
        for second in (False, True):
            for r in rows.itertuples(index=False):
                if r.winner in gone or r.loser in gone or (not second and r.loser in absorbed):
                    continue
                known = not pd.isna(r.correlation)
                near = r.overlap_permille >= min_overlap
                if second:
                    take = near and known and r.margin >= contained_margin and r.contains
                else:
                    take = near and r.long_enough and r.similarity >= min_similarity and known and (r.correlation >= min_correlation or r.margin >= min_margin)
                if take:
                    gone[r.loser] = (r.winner, second)
                    absorbed.add(r.winner)
        island = rows["island"].iloc[0]
        return pd.DataFrame([(island, k, w, c) for k, (w, c) in gone.items()], columns=["island", "loser", "winner", "contained"]).astype({"island": "int64", "loser": "int64", "winner": "int64", "contained": "bool"})

    return pairs.groupBy("island").applyInPandas(run, "island long, loser long, winner long, contained boolean")


def _takes(pair: dict[str, Any], min_overlap: int, min_similarity: int, min_correlation: int, min_margin: int, contained_margin: int) -> tuple[np.ndarray, np.ndarray]:
    """Which compared pairs collapse() takes as duplicates, and which as contained fragments, if nothing before them speaks against it."""
    near = (pair["overlap_permille"] >= min_overlap) & ~np.isnan(pair["correlation"])
    alike = near & pair["long_enough"] & (pair["similarity"] >= min_similarity) & ((pair["correlation"] >= min_correlation) | (pair["margin"] >= min_margin))
    return alike, near & (pair["margin"] >= contained_margin) & pair["contains"]


def _swept(rows: pd.DataFrame, takes: Callable[[dict[str, Any], dict[str, np.ndarray]], np.ndarray]) -> pd.DataFrame:
    """rows of one block, by start, with gone, free, winner and winner_score: each draft that may stay, best first, tells those that it would take.

    Of one that stays they are gone; of one whose fate hangs on other blocks they aren't free. known ones stay, and so does a free one that is in no other block.
    """
    rows = rows.sort_values(["start", "end", "id"], ignore_index=True)
    c = {n: rows[n].to_numpy() for n in rows.columns}
    ident, track, start, end, score, known, alone = (c[n] for n in ("id", "track", "start", "end", "score", "known", "alone"))
    reach = np.maximum.accumulate(end)
    first, last = np.searchsorted(reach, start, "right"), np.searchsorted(start, end, "left")
    gone, free, winner = np.zeros(len(rows), bool), np.ones(len(rows), bool), np.full(len(rows), -1)
    for i in np.lexsort((ident, -score)).tolist():
        if gone[i]:
            continue
        s = slice(first[i], last[i])
        after = (score[s] < score[i]) | ((score[s] == score[i]) & (ident[s] > ident[i]))
        met = first[i] + np.flatnonzero(after & (end[s] > start[i]) & (track[s] != track[i]) & ~gone[s] & ~known[s])
        if not len(met):
            continue
        met = met[takes({n: v[i] for n, v in c.items()}, {n: v[met] for n, v in c.items()})]
        if known[i] or (alone[i] and free[i]):
            gone[met], winner[met] = True, i
        else:
            free[met] = False
    return rows.assign(gone=gone, free=free, winner=np.where(gone, ident[winner], 0), winner_score=np.where(gone, score[winner], 0))


def _resolved(drafts: DataFrame, takes: Callable[[dict[str, Any], dict[str, np.ndarray]], np.ndarray], block: int) -> tuple[DataFrame, DataFrame]:
    """(drafts that stay, those that are gone with their winner): each draft goes to the blocks of the time line that it touches, no pair anywhere.

    A block settles all that hangs on nothing outside it; what several blocks hold stays once it is free in each. Those that are open go round again, along with those just
    settled of which other blocks haven't heard. The first open draft is free everywhere, so it ends. All winners being known, one more sweep finds the first of each.
    """
    names = drafts.columns
    held = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in drafts.schema.fields)

    def swept(rows: DataFrame) -> DataFrame:
        touched = F.sequence(floor_div(F.col("start"), block), floor_div(F.col("end") - 1, block))
        spread = rows.withColumn("_all", touched).withColumn("alone", F.size("_all") == 1).withColumn("_block", F.explode("_all")).drop("_all")
        out = f"{held}, known boolean, alone boolean, gone boolean, free boolean, winner long, winner_score long"
        return spread.repartition(64, "_block").groupBy("_block").applyInPandas(lambda r: _swept(r.drop(columns="_block"), takes), out)

    parts, rows = [], drafts.withColumn("known", F.lit(False))
    while not parts or not rows.filter("not known").isEmpty():
        one = durable(swept(rows).groupBy(*names, "known", "alone").agg(F.bool_or("gone").alias("gone"), F.bool_and("free").alias("free")))
        parts.append(one.filter("not known and (gone or free)").select(*names, (~F.col("gone")).alias("known")))
        rows = one.filter("not known and not gone and not (free and alone)").select(*names, F.col("free").alias("known"))
    told = reduce(DataFrame.unionAll, parts)
    best = F.min(F.struct((-F.col("winner_score")).alias("_score"), "winner"))
    lost = swept(told).filter("gone").groupBy(*names).agg(best.alias("_best")).select(*names, F.col("_best.winner").alias("winner"))
    return told.filter("known").drop("known"), lost


def collapse_drafts(drafts: DataFrame, compared: Callable[[dict[str, Any], dict[str, np.ndarray]], dict[str, Any]], block: int, min_overlap: int = 500, min_similarity: int = 850, min_correlation: int = 500, min_margin: int = 100, contained_margin: int = 300) -> DataFrame:
    """drafts that are gone, with winner and contained: what collapse() makes of all their pairs, which are compared where they meet and never become rows.

    drafts has id (a key), track, start, end, score, and what compared looks at. compared(one, many) gets a draft and those of other tracks that it overlaps and may absorb,
    as arrays, and returns overlap_permille, similarity, correlation (nan: unknown), long_enough and contains. The better score wins, the lesser id a tie: whoever absorbs was
    settled before, so that collapse()'s guard has nothing to do. A task holds the drafts of one block, whatever the length of an island.
    """
    limits = (min_overlap, min_similarity, min_correlation, min_margin, contained_margin)

    def takes(which: int) -> Callable[[dict[str, Any], dict[str, np.ndarray]], np.ndarray]:
        return lambda one, many: _takes(compared(one, many) | {"margin": one["score"] - many["score"]}, *limits)[which]

    whole = drafts.dropna(subset=["id", "track", "start", "end", "score"])
    kept, alike = _resolved(whole, takes(0), block)
    _, held = _resolved(durable(kept), takes(1), block)
    return alike.withColumn("contained", F.lit(False)).unionAll(held.withColumn("contained", F.lit(True)))


def gain_share(presence: Column, room: float, whole) -> Column:
    """A track's share of a frame: its presence, at least the room's, of all tracks' sum."""
    p = F.greatest(presence, F.lit(room))
    return p / F.sum(p).over(whole)
