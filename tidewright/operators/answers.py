"""Answers of a model, kept by the very bytes that were submitted: a table that is appended to in two phases.

A request's identity is the hash of its samples and of everything else its answer depends on. Requests are joined to the table by it; only
those that it lacks reach the model.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators import transcript as T
from tidewright.sources.appended import Appended
from tidewright.sources.shared import durable


#: The columns of T.OUTCOMES.
FIELDS = ["request_id", "track_id", "text", "words", "alignment", "truncated", "request_ids", "spent", "note"]


class Answers(Appended):
    """The answers below a folder that all executors share, by the identity of what was submitted."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder, "identity string, " + T.OUTCOMES, "identity")

    def of(self, requests: DataFrame, factory: Callable[[], T.Transcriber], model: str, limit: int, pad: int, least_core: int, retries: int = 4) -> tuple[DataFrame, int]:
        """(T.OUTCOMES of the requests, how many of them were submitted)."""
        asked = durable(identified(requests, model, limit, pad, least_core, retries))
        known = self.known()
        missing = asked.join(known.select("identity"), "identity", "left_anti")
        new = durable(T.transcribe(missing, factory, limit, pad, least_core, retries).join(missing.select("request_id", "identity"), "request_id"))
        n = new.count()
        if n:
            self.append(new)
        told = self.known().drop("request_id", "track_id")
        return asked.select("request_id", "track_id", "identity").join(told, "identity").select(*FIELDS), n


def identified(requests: DataFrame, model: str, *settings: int) -> DataFrame:
    """Adds identity: of the samples' bytes, the request's name, track, core and window, the model and its settings."""

    @F.pandas_udf("string")
    def digest(samples: pd.Series) -> pd.Series:
        return samples.map(lambda x: T.audio_sha256(np.asarray(x, np.float32)))

    rest = ["request_id", "track_id", "core_start", "core_end", "padded_start", "padded_end"]
    parts = [*(F.col(c).cast("string") for c in rest), F.lit(model), *(F.lit(str(s)) for s in settings)]
    framed = [F.concat(F.octet_length(p).cast("string"), F.lit(":"), p) for p in parts]
    return requests.withColumn("identity", F.sha2(F.concat(digest("samples"), *framed), 256))
