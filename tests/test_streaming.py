"""Streams that carry state give what their batch forms give, however the input is cut."""

import numpy as np
import pandas as pd

from tidewright import streaming
from tidewright.operators import sequences as S
from tidewright.operators import signal as G


def write(spark, folder, rows, schema):
    """One Parquet file for each batch, named by its turn."""
    for i, batch in enumerate(rows):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{folder}/part{i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


def test_slew_is_carried(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(t, f, float(rng.random())) for f in range(60) for t in (0, 1)]
    schema = "track long, frame long, target double"
    stream = write(spark, str(tmp_path / "in"), [rows[:31], rows[31:80], rows[80:]], schema)
    got = streaming.drain(streaming.slew(stream, "track", "frame", "target", 0.1, 0.02)).orderBy("track", "frame").toPandas()
    want = S.slew_limit(spark.createDataFrame(rows, schema), ["track"], "frame", "target", 0.1, 0.02).orderBy("track", "frame").toPandas()
    pd.testing.assert_series_equal(got["applied"], want["applied"])


def test_filter_is_carried(spark, tmp_path):
    rng = np.random.default_rng(6)
    taps = G.low_pass(31, 0.15)
    tracks = {0: rng.standard_normal(1000), 1: rng.standard_normal(431)}
    cuts = [0, 7, 8, 300, 331, 431, 1000]
    batches = [[], [], []]
    for t, x in tracks.items():
        own = [c for c in cuts if c <= len(x)]
        for i, (a, b) in enumerate(zip(own, own[1:], strict=False)):
            batches[min(2, i // 2)].append((t, i, x[a:b].tolist(), b == len(x)))
    stream = write(spark, str(tmp_path / "in"), batches, "track long, window long, samples array<double>, last boolean")
    got = streaming.drain(streaming.filtered(stream, "track", taps)).orderBy("track", "start").toPandas()
    for t, x in tracks.items():
        np.testing.assert_allclose(np.concatenate(got[got["track"] == t]["samples"].tolist()), G.decimate(x, taps), atol=1e-12)
