"""Signal kernels on arrays: what columns of numbers alone can't state. All are Arrow functions over bounded windows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

LAG = StructType([StructField("lag", IntegerType()), StructField("permille", IntegerType())])


def _permille(x: np.ndarray) -> np.ndarray:
    x = np.where(np.isfinite(x), x, 0) * 1000
    return np.where(x >= 0, np.floor(x + 0.5), -np.floor(-x + 0.5)).astype(int)


def correlate(x: np.ndarray, y: np.ndarray, most: int) -> tuple[int, int]:
    """The lag of y against x with the greatest absolute normalized correlation, the first of equals, and its permille."""
    norm = np.sqrt((x**2).sum() * (y**2).sum())
    if not norm or not len(x):
        return 0, 0
    full = np.correlate(y, x, "full")
    middle = len(x) - 1
    lags = np.arange(max(0, middle - most), min(len(full), middle + most + 1))
    p = _permille(np.abs(full[lags]) / norm)
    best = int(p.argmax())
    return int(lags[best] - middle), int(p[best])


def xcorr_lag(most: int):
    @F.pandas_udf(LAG)
    def lag(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([correlate(np.asarray(a, float), np.asarray(b, float), most) for a, b in zip(left, right, strict=True)], columns=["lag", "permille"])

    return lag


def matched(x: np.ndarray, template: np.ndarray) -> np.ndarray:
    """Permille of the normalized match at every offset; a silent window matches by 0."""
    if len(x) < len(template):
        return np.zeros(0, int)
    dot = np.abs(np.correlate(x, template, "valid"))
    power = np.convolve(x**2, np.ones(len(template)), "valid")
    norm = np.sqrt(np.maximum(power, 0) * (template**2).sum())
    return _permille(np.divide(dot, norm, out=np.zeros_like(dot), where=norm > 1e-12))


def matched_filter(template: list[float]):
    t = np.array(template, float)

    @F.pandas_udf(ArrayType(IntegerType()))
    def match(xs: pd.Series) -> pd.Series:
        return pd.Series([matched(np.asarray(x, float), t).tolist() for x in xs])

    return match


def low_pass(taps: int, cutoff: float) -> np.ndarray:
    """A Blackman-windowed sinc of odd length with unit gain; cutoff in cycles a sample."""
    n = np.arange(taps) - taps // 2
    h = np.sinc(2 * cutoff * n) * np.blackman(taps)
    return h / h.sum()


def decimate(x: np.ndarray, taps: np.ndarray, factor: int = 3) -> np.ndarray:
    """Every factor-th sample of the filtered, delay-compensated signal: ceil(n / factor) of them."""
    half = len(taps) // 2
    return np.convolve(np.concatenate([np.zeros(half), x, np.zeros(half)]), taps, "valid")[::factor]


def filtered(taps: np.ndarray, factor: int = 1):
    @F.pandas_udf(ArrayType(DoubleType()))
    def run(xs: pd.Series) -> pd.Series:
        return pd.Series([decimate(np.asarray(x, float), taps, factor).tolist() for x in xs])

    return run


def decimate_windows(windows, by: list[str], size: int, taps: np.ndarray, factor: int = 3):
    """Decimates a track held in windows of `size` samples (a multiple of factor) without a sequential pass.

    A window needs only half the filter's length of its neighbours: those samples are joined to it as halo.
    """
    half = len(taps) // 2
    if half > size or size % factor:
        raise ValueError("a window is a multiple of the factor and holds the halo")
    tail = windows.select(*by, (F.col("window") + 1).alias("window"), F.slice("samples", F.greatest(F.lit(1), F.size("samples") - half + 1), half).alias("_tail"))
    lead = windows.select(*by, (F.col("window") - 1).alias("window"), F.slice("samples", 1, half).alias("_lead"))
    keys = [*by, "window"]

    @F.pandas_udf(ArrayType(DoubleType()))
    def run(before: pd.Series, xs: pd.Series, after: pd.Series) -> pd.Series:
        out = []
        for b, x, a in zip(before, xs, after, strict=True):
            left, right = np.zeros(half), np.zeros(half)
            if b is not None and len(b):
                left[half - len(b) :] = b
            if a is not None:
                right[: len(a)] = a
            out.append(np.convolve(np.concatenate([left, np.asarray(x, float), right]), taps, "valid")[::factor].tolist())
        return pd.Series(out)

    return windows.join(tail, keys, "left").join(lead, keys, "left").select(*keys, run("_tail", "samples", "_lead").alias("samples"))
