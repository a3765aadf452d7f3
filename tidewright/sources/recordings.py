"""Recordings below a folder as a table of sources, and the samples of tracks as windows of the session's time line."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tidewright.functions.quantize import floor_div
from tidewright.operators.rules import parse_filename
from tidewright.sources.appended import Appended
from tidewright.sources.riff import head, listing, open_range, read_samples, walk_chunks
from tidewright.sources.shared import durable

FACTS = "path string, size long, sha256 string, rate int, channels int, bits int, floating boolean, data_offset long, samples long, reference long, wrong array<string>, timecode string, date string"


def file_sha256(path: str) -> str:
    """Of a whole file, read block by block."""
    h = hashlib.sha256()
    with open_range(path) as f:
        while block := f.read(1 << 22):
            h.update(block)
    return h.hexdigest()


#: Part of a capture's identity: to be raised when the same bytes would be told of otherwise.
CAPTURE = "capture-1"


def facts(path: str, size: int, sha256: str | None = None) -> tuple:
    """What a file's chunks say: its format, how many samples it really holds, its time reference, what is wrong with it, its timecode and date tags. sha256: of the file, if it is known."""
    sha256 = sha256 or file_sha256(path)
    with open_range(path) as f:
        found = walk_chunks(f, size)
        wrong = [c[6] for c in found if c[2] == "!"]
        extension = next((c for c in found if c[2] == "bext" and c[4] >= 346), None)
        reference = date = None
        if extension is not None:
            f.seek(extension[3] + 320)
            told = f.read(26)
            date, reference = told[:10].rstrip(b"\0").decode("ascii", "replace") or None, int.from_bytes(told[18:], "little")
        # the timecode of an INFO list
        tags = next((c[6] for c in found if c[1] == 1 and c[2] == "ISMP"), None), date
        data = next((c for c in found if c[2] == "data"), None)
        if data is None or not any(c[2] == "fmt " for c in found):
            return path, size, sha256, None, None, None, None, None, None, reference, [*wrong, "unreadable"], *tags
        f.seek(0)
        rate, channels, bits, floating, _, _ = head(f.read(data[3]))
        width = channels * bits // 8
        if data[4] % max(1, width):
            wrong.append("part_of_a_frame")
    return path, size, sha256, rate, channels, bits, floating, data[3], data[4] // max(1, width), reference, wrong, *tags


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """path, length, relative (the path below the folder) of every file below it, whatever it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/") + "/"
    return listing(spark, folder, "*").withColumn("relative", F.substring(F.col("path"), F.lit(len(root) + 1), F.lit(2**31 - 1)))


def _named(found: DataFrame) -> DataFrame:
    base = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?i)\.wav$", "")
    return found.withColumn("name", base).select("*", F.inline(F.array(parse_filename(F.col("name")))))


def _walked(files: DataFrame) -> DataFrame:
    """FACTS of files (path, length, sha256; null: to be hashed). One file is one row's work; no file's samples are held in memory."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in FACTS.split(", ")]
        for frame in frames:
            rows = [facts(p, n, h) for p, n, h in zip(frame["path"], frame["length"], frame["sha256"], strict=True)]
            yield pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in ("rate", "channels", "bits", "data_offset", "samples", "reference")})

    return files.select("path", "length", "sha256").mapInPandas(run, FACTS)


def inspect(spark: SparkSession, folder: str) -> DataFrame:
    """FACTS of every .wav file below the folder, and what its name says (transmitter, sequence, named_date, named_time, variant)."""
    return _named(_walked(listing(spark, folder).withColumn("sha256", F.lit(None).cast("string"))))


def hashed(files: DataFrame) -> DataFrame:
    """files (path) with sha256."""

    @F.pandas_udf("string")
    def digest(paths: pd.Series) -> pd.Series:
        return paths.map(file_sha256)

    return files.withColumn("sha256", digest("path"))


class Captures(Appended):
    """What was found out about files, by their place, their bytes and CAPTURE; only what isn't known is looked into."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder, "capture string, " + FACTS, "capture")

    def inspect(self, folder: str) -> tuple[DataFrame, int]:
        """(inspect() of the folder, how many files were looked into).

        Every file is hashed once to know it. New captures are kept only if the files still have those bytes; a file that
        changed meanwhile is refused as source_changed, and nothing of the run is kept.
        """
        files = durable(hashed(listing(self.spark, folder)))
        named = files.withColumn("capture", F.sha2(F.concat_ws("|", F.lit(CAPTURE), "path", "sha256"), 256))
        missing = named.join(self.known().select("capture"), "capture", "left_anti")
        new = durable(_walked(missing).join(missing.select("path", "capture"), "path"))
        n = new.count()
        if n:
            changed = hashed(new.select("path", F.col("sha256").alias("before"))).filter("sha256 != before").limit(1).collect()
            if changed:
                raise RuntimeError("source_changed: a file changed while it was looked into")
            self.append(new)
        told = self.known().drop("path", "size", "sha256")
        rows = named.withColumnRenamed("length", "size").join(told, "capture").select(*[c.split()[0] for c in FACTS.split(", ")])
        return _named(rows), n


def track_windows(entries: DataFrame, size: int, length: int) -> DataFrame:
    """track, window, samples of the session: `length` samples for every track in entries, silent where none of its files lies.

    entries: track, path, placed, samples, data_offset, bits, floating, channels. A window reads only the ranges of the files that it
    touches; it is put together from its parts, so that no file passes through one task.
    """
    n = F.col("placed") + F.col("samples")
    touched = entries.filter("samples > 0").withColumn("window", F.explode(F.sequence(floor_div(F.col("placed"), size), floor_div(n - 1, size))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                a, b = max(r.placed, r.window * size), min(r.placed + r.samples, (r.window + 1) * size)
                with open_range(r.path) as f:
                    x = read_samples(f, r.data_offset, r.bits, r.floating, r.channels, a - r.placed, b - a)
                out.append((r.track, r.window, a - r.window * size, x))
            yield pd.DataFrame(out, columns=["track", "window", "at", "part"])

    parts = touched.select("track", "window", "path", "placed", "samples", "data_offset", "bits", "floating", "channels").repartition("track", "window")
    parts = parts.mapInPandas(run, "track long, window long, at int, part array<float>").groupBy("track", "window").agg(F.collect_list(F.struct("at", "part")).alias("parts"))
    every = entries.select(F.col("track").cast("long").alias("track")).distinct().withColumn("window", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((length - 1) // size).cast("long"))))

    @F.pandas_udf(ArrayType(FloatType()))
    def joined(windows: pd.Series, parts: pd.Series) -> pd.Series:
        out = []
        for w, own in zip(windows, parts, strict=True):
            x = np.zeros(min(size, length - w * size), np.float32)
            for p in own if own is not None else ():
                x[p["at"] : p["at"] + len(p["part"])] = p["part"][: len(x) - p["at"]]
            out.append(x)
        return pd.Series(out)

    return every.join(parts, ["track", "window"], "left").select("track", "window", joined("window", "parts").alias("samples"))


def cut(intervals: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """id, samples of intervals (id, track, start, end) of tracks held as windows. An interval is one row: it should be of bounded length."""
    touched = intervals.filter("end > start").select("id", "track", "start", "end", F.explode(F.sequence(floor_div(F.col("start"), size), floor_div(F.col("end") - 1, size))).alias("window"))
    met = touched.join(windows, ["track", "window"])
    a = F.greatest(F.lit(0), F.col("start") - F.col("window") * size).cast("int")
    b = F.least(F.col("end") - F.col("window") * size, F.size("samples")).cast("int")
    part = F.slice("samples", a + 1, F.greatest(b - a, F.lit(0)))
    rows = met.select("id", "window", part.alias("part")).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("window", "part"))).alias("p"))
    return rows.select("id", F.flatten(F.transform("p", lambda x: x["part"])).alias("samples"))


def powers(intervals: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """id, power (mean square) of intervals (id, track, start, end), from the sums of the windows that they touch."""
    touched = intervals.filter("end > start").select("id", "track", "start", "end", F.explode(F.sequence(floor_div(F.col("start"), size), floor_div(F.col("end") - 1, size))).alias("window"))
    met = touched.join(windows, ["track", "window"])
    a = F.greatest(F.lit(0), F.col("start") - F.col("window") * size).cast("int")
    b = F.least(F.col("end") - F.col("window") * size, F.size("samples")).cast("int")
    part = F.slice("samples", a + 1, F.greatest(b - a, F.lit(0)))
    total = F.aggregate(part, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return met.select("id", total.alias("s"), F.greatest(b - a, F.lit(0)).alias("n")).groupBy("id").agg((F.sum("s") / F.sum("n")).alias("power"))
