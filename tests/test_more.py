"""Event logs, encoder tries, object stores by pages and parts, the cluster's checks, large-file sources, odd inputs of rules."""

import io
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.archive.storage import ArchiveError, ObjectStorage
from tidewright.operators import encode as E
from tidewright.operators import rules as R
from tidewright.operators import sequences as S
from tidewright.plans import doctor
from tidewright.sources import events, riff

EVENT = {"role": "start", "marker_name": "v1", "start_ms": 1000, "end_ms": 5000, "playback_order": 0}


def log(*rows, **more):
    return json.dumps({"schema_version": 1, "session_id": "s", "events": list(rows), **more})


def test_event_log(spark, tmp_path):
    (tmp_path / "log.json").write_text(log(EVENT, EVENT | {"role": "end", "start_ms": 9000, "end_ms": 12_000, "playback_order": 1, "geometry_id": "g"}))
    e = events.load_event_log(spark, str(tmp_path / "log.json"))
    assert [r["role"] for r in e.orderBy("playback_order").collect()] == ["start", "end"]
    found = spark.createDataFrame([(1, 50_000, 700), (1, 60_000, 800), (1, 239_999, 800), (1, 600_000, 10), (2, 240_000, 900)], "track long, anchor long, score int")
    got = {(r["track"], r["playback_order"]): r["anchor"] for r in events.associate(e, found, ["track"]).collect()}
    assert got == {(1, 0): 60_000, (1, 1): None, (2, 0): None, (2, 1): None}


@pytest.mark.parametrize("bad", [
    "{", log(), log(EVENT, EVENT), log(EVENT, extra=1), log(EVENT | {"role": "middle"}), log(EVENT | {"end_ms": 1000}), log(EVENT | {"start_ms": 1.5}), log(EVENT | {"start_ms": True}), log(EVENT | {"color": 1}),
    log(EVENT | {"note": "x" * 501}), log(EVENT | {"start_ms": -1}),
])
def test_event_logs_that_are_refused(bad):
    with pytest.raises(events.EventLogError):
        events.parse(bad)


class Fake:
    """An encoder that loses 70 millibels and adds 40 to peaks."""

    def __init__(self, loud, peak, samples=1000):
        self.loud, self.peak, self.samples, self.paths = loud, peak, samples, []

    def encode(self, gain, path):
        self.paths.append(path)
        return E.Measured(self.loud + gain - 70, self.peak + gain + 40, self.samples)


def test_encoder_tries():
    published = []
    t = E.encode(Fake(-2400, -1400), "x", 1000, 800, published.append, tolerance=50)
    assert t.accepted and t.gains == [800, 870] and published == ["x"]
    t = E.encode(Fake(-2400, -500), "x", 1000, 800, published.append)  # loud enough only beyond the peak's ceiling
    assert not t.accepted and t.gains == [800, 310] and t.failures[-1] == ["integrated_loudness"] and len(published) == 1
    t = E.encode(Fake(-2400, -1400, 9000), "x", 1000, 870, published.append)
    assert t.failures == [["duration"]] and len(published) == 1


class Store:
    """Three keys a page, sometimes busy; parts count."""

    def __init__(self, busy=0):
        self.objects, self.open, self.busy, self.n = {}, {}, busy, 0

    def _tick(self):
        self.n += 1
        if self.busy and self.n % self.busy == 0:
            raise TimeoutError

    def page(self, prefix, after):
        self._tick()
        names = sorted(n for n in self.objects if n.startswith(prefix) and (after is None or n > after))
        return [(n, len(self.objects[n])) for n in names[:3]], names[2] if len(names) > 3 else None

    def get(self, name):
        return io.BytesIO(self.objects[name])

    def begin(self, name):
        self._tick()
        self.open[name, f"u{self.n}"] = {}
        return f"u{self.n}"

    def part(self, name, upload, number, data):
        self._tick()
        if data == b"poison..":
            raise OSError("broken")
        self.open[name, upload][number] = data
        return f"t{number}"

    def complete(self, name, upload, tags):
        self._tick()
        parts = self.open.pop((name, upload))
        assert [f"t{i}" for i in sorted(parts)] == tags
        self.objects[name] = b"".join(parts[i] for i in sorted(parts))

    def abort(self, name, upload):
        self.open.pop((name, upload), None)

    def uploads(self, prefix):
        return [k for k in self.open if k[0].startswith(prefix)]


@pytest.mark.parametrize("busy", [0, 4])
def test_objects_by_parts_and_pages(tmp_path, busy):
    client = Store(busy)
    store = ObjectStorage(client, least_part=8, first=0.001)
    client.open["a/0", "orphan"] = {1: b"x"}
    for i in range(8):
        (tmp_path / "f").write_bytes(bytes(range(i * 5)))
        store.put(f"a/{i}", str(tmp_path / "f"))
    assert list(store.list("a/")) == [f"a/{i}" for i in range(8)] and not client.open
    assert store.head("a/3") == 15 and store.open("a/3").read() == bytes(range(15)) and store.head("b") is None
    (tmp_path / "f").write_bytes(b"good 8..poison..")
    with pytest.raises(OSError, match="broken"):
        store.put("bad", str(tmp_path / "f"))
    assert not client.open and store.head("bad") is None
    with pytest.raises(ArchiveError, match="no object"):
        store.open("bad")


def test_doctor(spark):
    found = doctor.checks(spark, 0.001)
    assert {r["check"].split(":")[0]: r["status"] for r in found.collect()} == {"versions": "pass", "free": "pass", "shared_folder": "pass", "adaptive_execution": "pass", "time_zone": "pass"}
    assert doctor.overall(found) == "pass" and doctor.overall(doctor.checks(spark, 1e9)) == "warn"


def test_riff_anomalies(spark, tmp_path):
    """Empty files have no row: Spark's listing leaves them out."""
    samples = np.arange(10, dtype=np.float32)
    whole = riff.wav_header(10, 48_000) + samples.astype("<f4").tobytes()
    cases = {"whole": whole, "cut": whole[:-8], "junk": b"no wave at all", "empty": b"", "tail": whole + b"abc", "nodata": whole[:36]}
    for name, data in cases.items():
        (tmp_path / f"{name}.wav").write_bytes(data)
    got = {}
    for r in riff.riff_walk(spark, str(tmp_path)).filter("chunk_id = '!'").collect():
        got.setdefault(r["path"].rsplit("/", 1)[1][:-4], set()).add(r["text"])
    assert got == {"cut": {"chunk_beyond_parent", "size_disagrees", "no_data_chunk"}, "junk": {"not_wave"}, "tail": {"trailing_bytes", "size_disagrees"}, "nodata": {"size_disagrees", "no_data_chunk"}}


def test_one_channel_of_several(spark, tmp_path):
    import struct

    x = np.arange(40, dtype="<i2")
    fmt = b"fmt " + struct.pack("<IHHIIHH", 16, 1, 2, 48_000, 192_000, 4, 16)
    body = b"WAVE" + fmt + b"data" + struct.pack("<I", 80) + x.tobytes()
    (tmp_path / "two.wav").write_bytes(b"RIFF" + struct.pack("<I", len(body)) + body)
    spark.dataSource.register(riff.WavSource)
    got = spark.read.format("wav").option("paths", str(tmp_path / "two.wav")).option("window", 7).option("channel", 1).load().orderBy("window").collect()
    np.testing.assert_allclose(np.concatenate([r["samples"] for r in got]) * 32768, x[1::2])


def test_written_windows_are_one_file(spark, tmp_path):
    x = np.random.default_rng(0).standard_normal(1000).astype(np.float32)
    windows = spark.createDataFrame([(i, x[i * 300 : (i + 1) * 300].tolist()) for i in range(4)], "window long, samples array<float>").repartition(3)
    riff.write_windows(windows, str(tmp_path / "x.wav"), 1000, 48_000, 300)
    riff.write_wav(str(tmp_path / "y.wav"), iter([x]), 1000, 48_000)
    assert (tmp_path / "x.wav").read_bytes() == (tmp_path / "y.wav").read_bytes()
    with pytest.raises(ValueError, match="refused"):
        riff.write_windows(windows.filter("window != 2"), str(tmp_path / "z.wav"), 1000, 48_000, 300)
    assert not (tmp_path / "z.wav").exists()


def test_folds_carry_state_over_batches(spark):
    rng = np.random.default_rng(1)
    data = [(t, f, float(rng.random())) for t in range(3) for f in range(700)]
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    try:
        got = {(r["t"], r["f"]): r["applied"] for r in S.slew_limit(spark.createDataFrame(data, "t long, f long, x double"), ["t"], "f", "x", 0.1, 0.02).collect()}
        packed = {(r["t"], r["f"]): r["request"] for r in S.pack_cap(spark.createDataFrame([(t, f, f + 1 + f % 3) for t, f, _ in data], "t long, f long, e long"), ["t"], "f", "e", 10).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    for t in range(3):
        last, n, first = 0.0, -1, None
        for _, f, x in (d for d in data if d[0] == t):
            last = min(max(x, last - 0.02), last + 0.1)
            assert got[t, f] == pytest.approx(last)
            if first is None or f + 1 + f % 3 - first > 10:
                n, first = n + 1, f
            assert packed[t, f] == n


def test_rules_with_nulls_and_nothing(spark):
    none = spark.createDataFrame([], "k long, v string")
    one = spark.createDataFrame([(1, None), (2, "a")], "k long, v string")
    assert R.archive_state(R.reconcile(one, none, "k", "v")).first()[0] == "ABSENT" and R.archive_state(R.reconcile(one, one, "k", "v")).first()[0] == "COMMITTED"
    assert R.archive_state(R.reconcile(none, none, "k", "v")).first()[0] == "ABSENT"
    with pytest.raises(ValueError, match="archive_nothing_selected"):
        R.chosen(one, F.col("k") > 5)
    urls = spark.createDataFrame([("s/objects/a",), ("s/../other",), (None,), ("t/x",)], "k string")
    assert [r[0] for r in urls.select(R.trusted(F.col("k"), "s/")).collect()] == ["trusted", *["archive_manifest_foreign"] * 3]
    bad = spark.createDataFrame([("{",), (None,), ('{"streams":[]}',)], "j string").select(R.probe(F.col("j")).alias("p")).select("p.refusal")
    assert [r[0] for r in bad.collect()] == ["unreadable_probe", "unreadable_probe", "no_audio_stream"]
    with pytest.raises(ValueError, match="too_many: 2"):
        R.refuse_over(R.ceiling(spark.createDataFrame([(1, 5), (2, 9), (2, 9)], "k long, p int"), "k", F.col("p") > 6, 1), "too_many")


def test_the_sine_table_is_the_same_everywhere():
    """Markers are exact: the table they are made from must not change with a platform's math library."""
    import hashlib

    from tidewright.functions import waveform as W

    assert hashlib.sha256(json.dumps(W._quarter()).encode()).hexdigest() == "7fc116f81ee8484fdc0d7dee0181955e55e9f8d7a5049a9bb243d54092f7fdcd"
