"""Captures are kept by bytes: an unchanged file isn't looked into again, a changed one is, one that changes meanwhile is refused."""

import pytest

from tidewright.sources import fixtures, recordings


@pytest.fixture
def session(tmp_path):
    fixtures.write(fixtures.canonical(), str(tmp_path / "in"))
    return tmp_path


def plain(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_only_new_bytes_are_looked_into(spark, session):
    folder = str(session / "in")
    kept = recordings.Captures(spark, str(session / "captures"))
    got, n = kept.inspect(folder)
    assert n == 4 and got.columns == recordings.inspect(spark, folder).columns and plain(got) == plain(recordings.inspect(spark, folder))
    assert kept.inspect(folder)[1] == 0
    name = sorted((session / "in").iterdir())[1]
    data = bytearray(name.read_bytes())
    data[-1] ^= 1
    name.write_bytes(data)
    (session / "in" / "new.wav").write_bytes(b"RIFF....")
    got, n = kept.inspect(folder)
    assert n == 2 and plain(got) == plain(recordings.inspect(spark, folder))
    (session / "in" / "new.wav").unlink()
    got, n = kept.inspect(folder)
    assert n == 0 and got.count() == 4


def test_a_file_that_changes_meanwhile_is_refused(spark, session, monkeypatch):
    folder = str(session / "in")
    kept = recordings.Captures(spark, str(session / "captures"))
    walked = recordings._walked

    def changing(files):
        name = sorted((session / "in").iterdir())[0]
        name.write_bytes(name.read_bytes() + b"\0\0")
        return walked(files)

    monkeypatch.setattr(recordings, "_walked", changing)
    with pytest.raises(RuntimeError, match="source_changed"):
        kept.inspect(folder)
    monkeypatch.undo()
    assert kept.known().count() == 0 and kept.inspect(folder)[1] == 4
