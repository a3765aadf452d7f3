"""Scripted models from files: strict, on the derived grid, and fit to run a session."""

import copy
import json

import pytest

from tidewright.operators.transcript import Request
from tidewright.sources import scripts

GOOD = {
    "fake_models_version": 1, "sample_rate": 48_000, "activity": {"1": [[3, 48_001], [60_000, 60_000]], "2": []},
    "asr": [{"track_id": "1", "start_sample": 0, "end_sample": 48_000, "text": "hello there", "words": [{"start_sample": 4, "end_sample": 7, "text": "hello"}, {"start_sample": 30_000, "end_sample": 48_000, "text": "there"}]}],
}


def test_a_script_answers_on_the_derived_grid(spark, tmp_path):
    at = tmp_path / "fake-models.json"
    at.write_text(json.dumps(GOOD, indent=7))
    got = scripts.load_scripts(spark, str(at))
    assert got.detector.spans == ((1, 1, 16_001, 1.0),) and got.transcriber.words == [("1", 1, 3, "hello"), ("1", 10_000, 16_000, "there")]
    assert got.digest == scripts.parse(json.dumps(GOOD)).digest
    answer = got.transcriber.transcribe(Request("r", "1", (0, 100), (0, 100), None))
    assert answer.text == "hello" and answer.alignment == "aligned"


@pytest.mark.parametrize(("path", "value", "code"), [
    (("fake_models_version",), 2, "fake_models_version"), (("sample_rate",), 44_100, "sample_rate"), (("sample_rate",), True, "sample_rate"), (("activity",), [], "mapping"), (("activity", "1"), {}, "activity"), (("activity", "1", 0), [1], "two samples"),
    (("activity", "1", 0), [5, 4], "before it begins"), (("activity", "1", 0), [-1, 4], "a sample"), (("asr",), {}, "a list"), (("asr", 0, "text"), None, "text"), (("asr", 0, "end_sample"), 1.5, "a sample"), (("asr", 0, "words", 1, "text"), 5, "a text"),
])
def test_whatever_is_wrong_is_an_error(path, value, code):
    doc = copy.deepcopy(GOOD)
    at = doc
    for k in path[:-1]:
        at = at[k]
    at[path[-1]] = value
    with pytest.raises(scripts.ScriptError, match=code):
        scripts.parse(json.dumps(doc))
    with pytest.raises(scripts.ScriptError):
        scripts.parse("{")
