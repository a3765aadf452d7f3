"""Generated sessions with what is true of them: several microphones, speech, bleed, chunked files with timecode."""

from __future__ import annotations

import os
import struct
from dataclasses import dataclass, field

import numpy as np

from tidewright.functions import waveform as W
from tidewright.functions.timecode import FRAME_RATES
from tidewright.sources.riff import wav_header

RATE = W.RATE


@dataclass(frozen=True)
class Utterance:
    track: int
    start: int  # samples of the session
    end: int
    words: tuple[str, ...]

    def timed(self) -> list[tuple[int, int, int, str]]:
        """(track, start, end, text) of its words, evenly over it."""
        n = len(self.words)
        at = [self.start + (self.end - self.start) * i // n for i in range(n + 1)]
        return [(self.track, at[i], at[i + 1], w) for i, w in enumerate(self.words)]


@dataclass(frozen=True)
class Chunk:
    """A file of a track: where it belongs in the session, how long it is, and which number it has."""

    track: int
    start: int
    length: int
    sequence: int


@dataclass
class Session:
    seconds: int = 40
    tracks: int = 3
    origin: int = 10 * 3600 * RATE  # samples since midnight at the session's start
    date: str = "20240101"
    bleed_db: float = -18.0
    bleed_delay: int = 60
    utterances: list[Utterance] = field(default_factory=list)
    chunks: list[Chunk] = field(default_factory=list)


def canonical(seconds: int = 40) -> Session:
    """Three speakers in turn, two of them together once; the first track in two files with a gap, the third one late."""
    s, n = Session(seconds), RATE
    plan = [(1, 2.0, 4.5, "good evening to everyone here"), (2, 6.0, 8.0, "thank you for coming"), (3, 10.0, 13.0, "let us begin with the first question"), (1, 15.0, 17.0, "who goes first"), (2, 16.2, 18.5, "i would like to"), (3, 24.0, 26.0, "please go on then"), (1, 31.0, 34.0, "that is all for today")]
    s.utterances = [Utterance(t, int(a * n), int(b * n), tuple(text.split())) for t, a, b, text in plan if b < seconds - 1]
    s.chunks = [Chunk(1, 0, 20 * n, 1), Chunk(1, 20 * n + n // 2, (seconds - 20) * n - n // 2, 2), Chunk(2, 0, seconds * n, 1), Chunk(3, n, (seconds - 1) * n, 1)]
    return s


def name(session: Session, chunk: Chunk, variant: str = "orig") -> str:
    second = (session.origin + chunk.start) // RATE % 86_400
    return f"TX{chunk.track:02d}_MIC{chunk.sequence:03d}_{session.date}_{second // 3600:02d}{second // 60 % 60:02d}{second % 60:02d}_{variant}.wav"


def render(session: Session, track: int) -> np.ndarray:
    """What a track's microphone hears over the whole session: its own speaker, the others weaker and later, noise."""
    n = session.seconds * RATE
    out = W.floor_noise(n, 1000 + track, -75)
    for i, u in enumerate(session.utterances):
        x = W.speech_like(u.end - u.start, 100 + i)
        if u.track == track:
            out[u.start : u.end] += x
        else:
            heard = np.concatenate([x, np.zeros(session.bleed_delay, np.float32)])
            heard = W.bleed(heard, session.bleed_delay, session.bleed_db)[: n - u.start]
            out[u.start : u.start + len(heard)] += heard
    return out


def bext(reference: int, date: str, second: int) -> bytes:
    """A broadcast extension chunk with its time reference, in samples since midnight."""
    body = bytearray(602)
    body[320:330] = f"{date[:4]}-{date[4:6]}-{date[6:]}".encode()
    body[330:338] = f"{second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}".encode()
    body[338:346] = struct.pack("<Q", reference)
    return b"bext" + struct.pack("<I", len(body)) + bytes(body)


def info(timecode: str) -> bytes:
    """An INFO list with a timecode tag."""
    text = timecode.encode() + b"\0"
    body = b"INFO" + b"ISMP" + struct.pack("<I", len(text)) + text + b"\0" * (len(text) % 2)
    return b"LIST" + struct.pack("<I", len(body)) + body


def timecode(samples: int, label: str) -> str:
    """The timecode that a clock at this rate shows after so many samples since its zero, rounded down to a frame; days are left out."""
    num, den, nominal, drop = FRAME_RATES[label]
    frame = samples * num // (den * RATE)
    if drop:
        skipped = nominal // 15
        ten, one = 600 * nominal - 9 * skipped, 60 * nominal - skipped
        frame %= 144 * ten
        tens, rest = divmod(frame, ten)
        frame += 9 * skipped * tens + (skipped * ((rest - skipped) // one) if rest >= skipped else 0)
    frame %= 86_400 * nominal
    second = frame // nominal
    return f"{second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}{';' if drop else ':'}{frame % nominal:02d}"


def write(session: Session, folder: str, evidence: str = "bext", folders: bool = False) -> dict[str, list]:
    """The session's files, and the truth: words, speech (track, start, end) and placements (track, start, length).

    evidence: bext (a time reference), none, or the label of a frame rate, of which a timecode tag is written. folders: each track in its own.
    """
    for track in sorted({c.track for c in session.chunks}):
        below = os.path.join(folder, f"tx{track}") if folders else folder
        os.makedirs(below, exist_ok=True)
        heard = render(session, track)
        for c in (c for c in session.chunks if c.track == track):
            x = heard[c.start : c.start + c.length]
            head = wav_header(len(x), RATE)
            at = session.origin + c.start
            since = at % (86_400 * RATE)
            extra = bext(since, session.date, since // RATE) if evidence == "bext" else b"" if evidence == "none" else info(timecode(at, evidence))
            body = head[12:36] + extra + head[36:] + x.astype("<f4").tobytes()
            with open(os.path.join(below, name(session, c)), "wb") as f:
                f.write(b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body)
    return {
        "words": [w for u in session.utterances for w in u.timed()], "speech": [(u.track, u.start, u.end) for u in session.utterances],
        "placements": sorted((c.track, c.start, c.length) for c in session.chunks),
    }
