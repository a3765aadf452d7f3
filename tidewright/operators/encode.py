"""The decisions around an encoder: gains tried until its output is as loud as asked for, or the tries are spent."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol


@dataclass(frozen=True)
class Measured:
    """Of an encoded mix: millibels (None: silence, or a meter that gave nothing) and samples."""

    loud: int | None
    peak: int | None
    samples: int


class Encoder(Protocol):
    """Plugin: encodes the mix under a gain in millibels to a path, and measures what it decodes to."""

    def encode(self, gain: int, path: str) -> Measured: ...


@dataclass
class Tries:
    gains: list[int] = field(default_factory=list)
    failures: list[list[str]] = field(default_factory=list)
    accepted: bool = False


def failures(m: Measured, samples: int, target: int, tolerance: int, ceiling: int, headroom: int, frame: int) -> list[str]:
    """What is wrong with it, in this order: loudness, true peak, duration."""
    out = []
    if m.loud is None or abs(m.loud - target) > tolerance:
        out.append("integrated_loudness")
    if m.peak is None:
        out.append("true_peak_unmeasured")
    elif m.peak > ceiling + headroom:
        out.append("true_peak")
    if abs(m.samples - samples) > frame:
        out.append("duration")
    return out


def encode(encoder: Encoder, path: str, samples: int, gain: int, publish: Callable[[str], None], target: int = -1600, tolerance: int = 100, ceiling: int = -150, headroom: int = 30, frame: int = 1152, retries: int = 3, most: int = 3000) -> Tries:
    """Encodes, measures and tries again; publish() gets the path of the result that passes, and nothing else is published.

    The next gain makes up for what loudness or peak missed, whichever asks for less, within `most`. A gain that was tried already, or a failure that
    no gain mends (duration, no measurement), ends the tries.
    """
    tries = Tries()
    for _ in range(retries + 1):
        m = encoder.encode(gain, path)
        wrong = failures(m, samples, target, tolerance, ceiling, headroom, frame)
        tries.gains.append(gain)
        tries.failures.append(wrong)
        if not wrong:
            publish(path)
            tries.accepted = True
            break
        if "duration" in wrong or m.loud is None or m.peak is None:
            break
        change = min(target - m.loud, ceiling - m.peak)
        gain = max(-most, min(most, gain + change))
        if gain in tries.gains:
            break
    return tries
