"""Speech runs and marker peaks as stateful stream operators, with value and list state in the state store.

Each track is a key. Its frames come in order, one after another, and end with a row marked last; a gap, a frame that was there
before, and anything after the end are errors, as the order is part of the meaning. What a batch gives out is final: over all batches it is what
the batch operators make of the whole track, however the input is cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewright.operators.markers import peaks_of
from tidewright.streaming import drain

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries that are started within keep their state in RocksDB, which several kinds of state need; then the session is as it was."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def drained(stream: DataFrame) -> DataFrame:
    """drain() with the state store that these processors need."""
    with rocksdb(stream.sparkSession):
        return drain(stream)


class _Ordered(StatefulProcessor):
    """A key's rows in order; following (long) is the place that must come next, ended whether the last row was there."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.place = handle.getValueState("place", "following long, ended boolean")

    def close(self) -> None:
        pass

    def ordered(self, rows: Iterator[pd.DataFrame], at: str, dense: bool) -> pd.DataFrame:
        """The batch's rows of the key, checked and noted. dense: each place follows the one before; else places only rise."""
        frame = pd.concat(list(rows)).sort_values(at, kind="stable")
        following, ended = self.place.get() if self.place.exists() else (None, False)
        for place, last in zip(frame[at].tolist(), frame["last"].tolist(), strict=True):
            if ended:
                raise ValueError("stream_order: a row after the end")
            if following is not None and place < following:
                raise ValueError("stream_order: a place came again or out of order")
            if dense and following is not None and place > following:
                raise ValueError("stream_order: a gap")
            following, ended = place + 1, bool(last)
        self.place.update((following, ended))
        return frame


class _Runs(_Ordered):
    def __init__(self, by: str, frame: str, p: str, opens: int, closes: int):
        self.by, self.frame, self.p, self.opens, self.closes = by, frame, p, opens, closes

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.open = handle.getValueState("open", "start long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = self.ordered(rows, self.frame, True)
        start = self.open.get()[0] if self.open.exists() else None
        out = []
        for place, value in zip(frame[self.frame].tolist(), frame[self.p].tolist(), strict=True):
            if start is None and value >= self.opens:
                start = place
            elif start is not None and value < self.closes:
                out.append((start, place))
                start = None
        if start is not None and bool(frame["last"].iloc[-1]):
            out.append((start, int(frame[self.frame].iloc[-1]) + 1))
            start = None
        if start is None:
            self.open.clear()
        else:
            self.open.update((int(start),))
        yield pd.DataFrame({self.by: [key[0]] * len(out), "start": [a for a, _ in out], "end": [b for _, b in out]}).astype("int64")


class _Peaks(_Ordered):
    def __init__(self, by: str, at: str, score: str, least: int, radius: int):
        self.by, self.at, self.score, self.least, self.radius = by, at, score, least, radius

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getListState("waiting", "at long, score int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = self.ordered(rows, self.at, False)
        cluster = [tuple(x) for x in self.waiting.get()]
        out: list[tuple[int, int]] = []
        for place, score in zip(frame[self.at].tolist(), frame[self.score].tolist(), strict=True):
            if cluster and place - cluster[-1][0] > self.radius:
                out += self._best(cluster)
                cluster = []
            if score >= self.least:
                cluster.append((place, score))
        if bool(frame["last"].iloc[-1]):
            out += self._best(cluster)
            cluster = []
        if cluster:
            self.waiting.put([(int(a), int(s)) for a, s in cluster])
        else:
            self.waiting.clear()
        yield pd.DataFrame({self.by: [key[0]] * len(out), self.at: [a for a, _ in out], self.score: [s for _, s in out]}).astype({self.by: "int64", self.at: "int64", self.score: "int32"})

    def _best(self, cluster: list[tuple[int, int]]) -> list[tuple[int, int]]:
        if not cluster:
            return []
        first = cluster[0][0]
        scores = np.full(cluster[-1][0] - first + 1, -1)
        for a, s in cluster:
            scores[a - first] = s
        return sorted((first + a, s) for a, s in peaks_of(scores, self.least, self.radius))


def speech_runs(stream: DataFrame, by: str, frame: str, p: str, opens: int, closes: int) -> DataFrame:
    """by, start, end (exclusive) of the runs of frames between opening and closing; a run is given out when it has closed, or its track ended.

    stream: by (long), frame, p, last (boolean, true on a track's last frame).
    """
    own = stream.select(by, frame, p, "last")
    return own.groupBy(by).transformWithStateInPandas(_Runs(by, frame, p, opens, closes), f"{by} long, start long, end long", "Append", "None")


def peaks(stream: DataFrame, by: str, at: str, score: str, least: int, radius: int) -> DataFrame:
    """by, at, score: the greatest score, then none within radius of it, and so on. A peak waits until the radius has passed that could bring a rival.

    stream: by (long), at (rising), score (int), last; rows under the least score may be left out, but for the last one. What waits is one cluster of near places.
    """
    own = stream.select(by, at, score, "last")
    return own.groupBy(by).transformWithStateInPandas(_Peaks(by, at, score, least, radius), f"{by} long, {at} long, {score} int", "Append", "None")
