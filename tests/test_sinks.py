"""The WAV sink: whole files or none, whatever order, partitioning or failure."""

import os

import numpy as np
import pytest

from tidewright.sources import riff, wavsink
from tidewright.sources.files import scan_files


def windows(spark, x, size, parts=3):
    rows = [(i, x[i * size : (i + 1) * size].tolist()) for i in range(-(-len(x) // size))]
    return spark.createDataFrame(rows[::-1], "window long, samples array<float>").repartition(parts)


def read(path):
    with open(path, "rb") as f:
        rate, channels, bits, floating, offset, size = riff.head(f.read(4096))
        return rate, riff.read_samples(f, offset, bits, floating, channels, 0, size // 4)


@pytest.mark.parametrize(("n", "size", "parts"), [(1000, 100, 1), (1001, 100, 4), (99, 100, 2), (1000, 333, 7)])
def test_a_file_is_its_windows(spark, tmp_path, n, size, parts):
    x = np.random.default_rng(n).standard_normal(n).astype(np.float32)
    path = str(tmp_path / "mix.wav")
    wavsink.save(windows(spark, x, size, parts), path, n, 48_000, size)
    rate, got = read(path)
    assert rate == 48_000 and os.listdir(tmp_path) == ["mix.wav"]
    np.testing.assert_array_equal(got, x)
    wavsink.save(windows(spark, x[::-1].copy(), size, parts), path, n, 48_000, size)  # replaced as a whole
    np.testing.assert_array_equal(read(path)[1], x[::-1])


def refused(spark, table, path, n=1000, size=100, mode="append"):
    wavsink.register(spark)
    with pytest.raises(Exception, match="(?s)Refused|refused|window|there already"):
        table.write.format("tidewright_wav").option("samples", n).option("rate", 48_000).option("size", size).mode(mode).save(path)


def test_what_is_not_whole_is_not_published(spark, tmp_path):
    x = np.zeros(1000, np.float32)
    path = str(tmp_path / "mix.wav")
    whole = windows(spark, x, 100)
    for table in (whole.filter("window != 4"), whole.unionByName(whole.filter("window = 2")), whole.filter("window < 9"), whole.selectExpr("window + 1 as window", "samples"), whole.selectExpr("window", "slice(samples, 1, 99) as samples")):
        refused(spark, table, path)
        assert os.listdir(tmp_path) == []


def test_a_failing_task_leaves_nothing_and_the_old_file_stays(spark, tmp_path):
    x = np.ones(1000, np.float32)
    path = str(tmp_path / "mix.wav")
    wavsink.save(windows(spark, x, 100), path, 1000, 48_000, 100)
    broken = windows(spark, x * 2, 100).selectExpr("if(window = 7, raise_error('lost'), window) as window", "samples")
    wavsink.register(spark)
    with pytest.raises(Exception, match="lost"):
        broken.write.format("tidewright_wav").option("samples", 1000).option("rate", 48_000).option("size", 100).mode("overwrite").save(path)
    np.testing.assert_array_equal(read(path)[1], x)
    assert os.listdir(tmp_path) == ["mix.wav"]
    refused(spark, windows(spark, x, 100), path)  # append to a file that is there


def test_files_are_hashed_where_they_lie(spark, tmp_path):
    import hashlib

    (tmp_path / "a b.WAV").write_bytes(b"x" * (5 << 20))
    (tmp_path / "notes.txt").write_bytes(b"n")
    got = {r["name"]: r for r in scan_files(spark, str(tmp_path)).collect()}
    assert got["a b.WAV"]["sha256"] == hashlib.sha256(b"x" * (5 << 20)).hexdigest() and got["a b.WAV"]["size"] == 5 << 20
    assert {n: r["kind"] for n, r in got.items()} == {"a b.WAV": "source", "notes.txt": "unexpected_file_type"}
