"""Configuration, stage caches and reports."""

import copy
import json

import pytest

from tidewright import configuration as C
from tidewright.plans.stages import Report, StageCache, identity

SMALL = {
    "session_id": "s", "title": "T", "timecode": {"origin_date": "2026-08-15"},
    "tracks": [{"track_id": f"tx-{c}", "receiver_id": f"rx-{i // 2}", "receiver_channel": i % 2 + 1, "speaker_id": c, "speaker_name": c.upper(), "input": f"raw/tx-{c}"} for i, c in enumerate("abcdef")],
}


def test_defaults_stated_or_not():
    c = C.resolve(SMALL)
    assert C.resolve({**SMALL, "asr": {"max_new_tokens": 1024}, "tracks": SMALL["tracks"][::-1]}) == c == C.resolve(c)
    assert C.config_hash(c) == C.config_hash(C.resolve(c)) != C.config_hash(C.resolve({**SMALL, "title": "U"}))
    assert C.core_cap(c) == (120 * 16000 - 16000, 8000)
    tight = C.resolve({**SMALL, "asr": {"max_segment_s": 1}, "transcript": {"pad_ms": 9000}})
    core, pad = C.core_cap(tight)
    assert core >= 1 and core + 2 * pad <= 16000


@pytest.mark.parametrize(
    "change",
    [
        {"unknown": 1}, {"asr": {"unknown": 1}}, {"activity": {"vad": {"x": 1}}}, {"schema_version": 2}, {"title": ""}, {"tracks": []}, {"active_tracks": ["tx-z"]}, {"asr": {"max_segment_s": 121}},
        {"asr": {"device": "tpu"}}, {"timecode": {"origin_timecode": "01:00:00:00"}}, {"timecode": {"frame_rate": "31"}}, {"activity": {"vad": {"silence_threshold": 0.9}}},
        {"mix": {"envelope": {"room_tone_share": 0.4}}}, {"mix": {"envelope": {"overlap_min_gain_db": -3.0}}}, {"mix": {"envelope": {"control_rate_hz": 999}}},
        {"sync_qa": {"offset_warn_ms": 33}}, {"mix": {"mp3_bitrate_kbps": 100}}, {"recovery": {"source_time_overrides": {"a.wav": {"reason": "r"}}}}, {"sync_qa": {"enabled": 1}}, {"asr": {"max_new_tokens": 1024.5}},
    ],
)
def test_refusals(change):
    with pytest.raises(C.ConfigError):
        C.resolve({**SMALL, **change})


def test_a_stage_depends_on_its_own_fields_only():
    a, b = C.resolve(SMALL), C.resolve({**SMALL, "activity": {"bleed": {"veto_db": 9.0}}})
    assert C.stage_hash(a, "detection") == C.stage_hash(b, "detection")
    assert C.stage_hash(a, "attribution") != C.stage_hash(b, "attribution")


def test_track_folders():
    bad = copy.deepcopy(SMALL)
    bad["tracks"][0]["input"] = "raw/tx-f"
    with pytest.raises(C.ConfigError):
        C.resolve(bad)


def test_load_and_schema(tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(SMALL))
    assert C.load(str(tmp_path / "s.json")) == C.resolve(SMALL)
    (tmp_path / "twice.json").write_text('{"session_id": "a", "session_id": "b"}')
    with pytest.raises(C.ConfigError):
        C.load(str(tmp_path / "twice.json"))
    s = C.schema()
    assert s["properties"]["activity"]["properties"]["vad"]["properties"]["pad_ms"]["default"] == 30 and not s["additionalProperties"]


def test_cache(spark, tmp_path):
    cache, built = StageCache(spark, str(tmp_path)), []
    key = identity("inspection", 1, "c", files=["a"])

    def build():
        built.append(1)
        return spark.range(5)

    with pytest.raises(RuntimeError):
        cache.of(key, build, lambda: False)
    assert cache.get(key) is None
    assert cache.of(key, build).count() == 5 and cache.of(key, build).count() == 5 and len(built) == 2
    (tmp_path / key / "sidecar.json").unlink()
    for f in tmp_path.glob(f"{key}/.sidecar*"):
        f.unlink()
    assert cache.get(key) is None and cache.of(key, build).count() == 5 and len(built) == 3
    assert identity("inspection", 1, "c", files=["b"]) != key


def test_report():
    r = Report("s", now=lambda: 1.0)
    assert r.stage("inspect", lambda: 7) == 7
    with pytest.raises(ValueError):
        r.stage("mix", lambda: (_ for _ in ()).throw(ValueError("no file /secret/x.wav there")))
    d = r.document()
    assert (d["status"], d["exit_code"]) == ("failed", 1) and d["stages"][1]["error"]["message"] == "no file <path> there"
    r.deliver("transcript.json", "0" * 64)
    assert r.document()["status"] == "partial"
