"""RIFF and RF64 inventories, PCM decoding, a Spark data source for windows of WAV files, and a WAV writer."""

from __future__ import annotations

import hashlib
import io
import os
import re
import struct
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

TEXT_LIMIT = 4096
CHUNKS = "path string, ordinal int, depth int, chunk_id string, offset long, size long, sha256 string, text string"


def walk_chunks(source: BinaryIO, length: int) -> list[tuple[int, int, str, int, int, str | None, str | None]]:
    """(ordinal, depth, id, payload offset, size, sha256, text) of every chunk, LISTs entered; then what is wrong, by id "!" and its code as text.

    RF64 sizes come from ds64. Payloads are padded to even length. Audio data isn't read; other payloads are hashed by blocks, and printable UTF-8
    of at most TEXT_LIMIT bytes is kept. The walk stops where a chunk would leave its parent.
    """
    out: list[tuple] = []
    wrong: list[tuple[int, str]] = []
    wide: dict[str, int] = {}

    def at(offset: int, n: int) -> bytes:
        source.seek(offset)
        return source.read(n)

    def walk(here: int, end: int, depth: int) -> None:
        while here + 8 <= end:
            head_ = at(here, 8)
            name, size = head_[:4].decode("latin-1"), int.from_bytes(head_[4:], "little")
            if size == 0xFFFFFFFF and name in wide:
                size = wide[name]
            start = here + 8
            if start + size > end:
                wrong.append((here, "chunk_beyond_parent"))
                return
            if name == "ds64" and size >= 24:
                wide["data"] = int.from_bytes(at(start + 8, 8), "little")
            out.append((len(out), depth, name, start, size, None if name == "data" else _digest(source, start, size), None if name in ("data", "LIST") or size > TEXT_LIMIT else _text(at(start, size))))
            if name == "LIST" and size >= 4:
                walk(start + 4, start + size, depth + 1)
            here = start + size + size % 2
        if depth == 0 and here < end:
            wrong.append((here, "trailing_bytes"))

    top = at(0, 12)
    if len(top) < 12 or top[:4] not in (b"RIFF", b"RF64") or top[8:] != b"WAVE":
        return [(0, 0, "!", 0, length, None, "not_wave")]
    declared = int.from_bytes(top[4:8], "little")
    if top[:4] == b"RIFF" and declared + 8 != length:
        wrong.append((4, "size_disagrees"))
    walk(12, length, 0)
    if not any(c[2] == "data" for c in out):
        wrong.append((length, "no_data_chunk"))
    return out + [(len(out) + i, 0, "!", where, 0, None, code) for i, (where, code) in enumerate(wrong)]


def chunks(data: bytes) -> list[tuple[int, int, str, int, int, str | None, str | None]]:
    """walk_chunks() of a file's bytes, the sound chunks alone."""
    return [c for c in walk_chunks(io.BytesIO(data), len(data)) if c[2] != "!"]


def _digest(source: BinaryIO, start: int, size: int) -> str:
    source.seek(start)
    h = hashlib.sha256()
    while size > 0:
        block = source.read(min(size, 1 << 20))
        if not block:
            break
        h.update(block)
        size -= len(block)
    return h.hexdigest()


def _text(payload: bytes) -> str | None:
    try:
        text = payload.rstrip(b"\0").decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and text.isprintable() else None


def open_range(path: str) -> BinaryIO:
    """A seekable file wherever pyarrow's file systems reach: local, HDFS, object stores. Only what is asked for is read.

    path is as Spark writes it, with blanks and other characters as they are.
    """
    fs, inner = pa.fs.FileSystem.from_uri(quote(path if re.match(r"[a-z][a-z0-9+.-]*:", path) else f"file://{os.path.abspath(path)}", safe="/:@"))
    return fs.open_input_file(inner)


def listing(spark: SparkSession, folder: str, pattern: str = "*.[wW][aA][vV]") -> DataFrame:
    """path and length of the files below the folder, empty ones left out; their contents stay where they are."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path", "length")


def riff_walk(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each chunk of each .wav file below the folder; files are read by ranges, of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in CHUNKS.split(", ")]
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_range(path) as f:
                    rows = [(path, *c) for c in walk_chunks(f, length)]
                yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return listing(spark, folder).mapInArrow(run, CHUNKS)


def decode(raw: bytes, bits: int, floating: bool) -> np.ndarray:
    """Little-endian f32, s24 or s16 samples as float32; integers over 2 to the (bits - 1)."""
    if floating and bits == 32:
        return np.frombuffer(raw, "<f4").copy()
    if bits == 16:
        return (np.frombuffer(raw, "<i2") / np.float32(32768)).astype(np.float32)
    if bits == 24:
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        return ((wide.view("<i4").ravel() >> 8) / np.float32(1 << 23)).astype(np.float32)
    raise ValueError("refused: only f32, s24 and s16")


def read_samples(f: BinaryIO, offset: int, bits: int, floating: bool, channels: int, start: int, n: int, channel: int = 0) -> np.ndarray:
    """n samples of a channel from `start` on."""
    if not 0 <= channel < channels:
        raise ValueError("refused: no such channel")
    width = bits // 8 * channels
    f.seek(offset + start * width)
    return decode(f.read(n * width), bits, floating)[channel::channels]


def head(data: bytes) -> tuple[int, int, int, bool, int, int]:
    """(rate, channels, bits, floating, data offset, data size) from the beginning of a file."""
    rate = channels = bits = 0
    floating = False
    at = 12
    while at + 8 <= len(data):
        name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack("<HHIIHH", data[at + 8 : at + 24])
            floating = kind == 3 or (kind == 0xFFFE and data[at + 32 : at + 34] == b"\x03\0")
        if name == b"data":
            return rate, channels, bits, floating, at + 8, size
        at += 8 + size + size % 2
    raise ValueError("refused: no data chunk")


class _Window(InputPartition):
    def __init__(self, path: str, window: int, start: int, n: int):
        super().__init__((path, window))
        self.path, self.window, self.start, self.n = path, window, start, n


class WavReader(DataSourceReader):
    """One partition for each window: the range asked for is the range read."""

    def __init__(self, options: dict):
        self.paths, self.size, self.channel = options["paths"].split("\n"), int(options.get("window", 480_000)), int(options.get("channel", 0))

    def partitions(self) -> list[_Window]:
        out = []
        for path in self.paths:
            with open_range(path) as f:
                rate, channels, bits, _, _, size = head(f.read(1 << 16))
            n = size // (bits // 8 * channels)
            out += [_Window(path, i, s, min(self.size, n - s)) for i, s in enumerate(range(0, n, self.size))]
        return out

    def read(self, partition: _Window) -> Iterator[tuple]:
        with open_range(partition.path) as f:
            rate, channels, bits, floating, offset, _ = head(f.read(1 << 16))
            samples = read_samples(f, offset, bits, floating, channels, partition.start, partition.n, self.channel)
        yield partition.path, partition.window, partition.start, rate, samples.tolist()


class WavSource(DataSource):
    """spark.read.format("wav").option("paths", ...): windows of one channel (option channel) of PCM files."""

    @classmethod
    def name(cls) -> str:
        return "wav"

    def schema(self) -> str:
        return "path string, window long, start long, rate int, samples array<float>"

    def reader(self, schema) -> WavReader:
        return WavReader(self.options)


def wav_header(n: int, rate: int) -> bytes:
    """Of a float32 file of n samples; RF64 beyond 4 GiB."""
    size = 4 * n
    big = size + 80 >= 1 << 32
    fmt = b"fmt " + struct.pack("<IHHIIHH", 16, 3, 1, rate, rate * 4, 4, 32)
    ds64 = b"ds64" + struct.pack("<IQQQI", 28, size + 72, size, n, 0) if big else b""
    total = 4 + len(ds64) + len(fmt) + 8 + size
    return (b"RF64" if big else b"RIFF") + struct.pack("<I", 0xFFFFFFFF if big else total) + b"WAVE" + ds64 + fmt + b"data" + struct.pack("<I", 0xFFFFFFFF if big else size)


def write_wav(path: str, blocks: Iterator[np.ndarray], n: int, rate: int) -> None:
    """float32 WAV of exactly n samples, published by rename; RF64 beyond 4 GiB; a short or long stream is refused."""
    header = wav_header(n, rate)
    done = 0
    with open(path + ".partial", "wb") as f:
        f.write(header)
        for b in blocks:
            f.write(np.asarray(b, "<f4").tobytes())
            done += len(b)
        f.flush()
        os.fsync(f.fileno())
    if done != n:
        os.unlink(path + ".partial")
        raise ValueError(f"refused: {done} samples instead of {n}")
    os.replace(path + ".partial", path)


def write_windows(windows: DataFrame, path: str, n: int, rate: int, size: int) -> None:
    """A float32 WAV file of n samples from windows (window, samples), each task writing its own ranges.

    The path lies in a folder that all executors mount; the driver writes the header and publishes the file by rename. Windows that are
    missing, or of another length than their place allows, are refused.
    """
    partial = path + ".partial"
    head_ = wav_header(n, rate)
    with open(partial, "wb") as f:
        f.write(head_)
        f.truncate(len(head_) + 4 * n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with open(partial, "r+b") as f:
                for window, samples in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    x = samples.values.to_numpy(zero_copy_only=False)
                    if len(x) != min(size, n - window * size):
                        raise ValueError(f"refused: window {window} has {len(x)} samples")
                    f.seek(len(head_) + 4 * window * size)
                    f.write(np.asarray(x, "<f4").tobytes())
                f.flush()
                os.fsync(f.fileno())
            yield pa.record_batch([batch.column(0)], ["window"])

    done = windows.select(F.col("window").cast("long"), "samples").mapInArrow(run, "window long").distinct().count()
    if done != -(-n // size):
        os.unlink(partial)
        raise ValueError(f"refused: {done} windows instead of {-(-n // size)}")
    os.replace(partial, path)
