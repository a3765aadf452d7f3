"""SMPTE timecode as columns: frame rates, parsing with an error code, frame counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: label: (rate numerator, rate denominator, frames in a timecode second, drop-frame). Fixed values.
FRAME_RATES = {
    "23.98F": (24000, 1001, 24, False), "24F": (24, 1, 24, False), "25F": (25, 1, 25, False), "29.97F": (30000, 1001, 30, False),
    "29.97DF": (30000, 1001, 30, True), "30F": (30, 1, 30, False), "50F": (50, 1, 50, False), "60F": (60, 1, 60, False),
}
PATTERN = r"^([0-9]{2}):([0-9]{2}):([0-9]{2})([:;.])([0-9]{2})$"


def frame_rate(label: Column) -> Column:
    """(num, den, nominal, drop) of a label, looked up in a folded map; null for an unknown one."""
    entries = []
    for k, (n, d, nominal, drop) in FRAME_RATES.items():
        entries += [F.lit(k), F.struct(F.lit(n).cast("long").alias("num"), F.lit(d).cast("long").alias("den"), F.lit(nominal).alias("nominal"), F.lit(drop).alias("drop"))]
    return F.try_element_at(F.create_map(*entries), label)


def parse(text: Column, rate: Column) -> Column:
    """(hours, minutes, seconds, frames, error). error: malformed, drop_notation, out_of_range, dropped_frame or null.

    The pattern fixes every field's place, so that fields are substrings and the text is matched once.
    """
    good = F.coalesce(text.rlike(PATTERN), F.lit(False))
    h, m, s, f = (F.substring(text, at, 2).try_cast("int") for at in (1, 4, 7, 10))
    error = (
        F.when(~good, "malformed")
        .when((F.substring(text, 9, 1) != ":") & ~rate["drop"], "drop_notation")
        .when((h >= 24) | (m >= 60) | (s >= 60) | (f >= rate["nominal"]), "out_of_range")
        .when(rate["drop"] & (s == 0) & (f < 2) & (m % 10 != 0), "dropped_frame")
    )
    known = lambda x: F.when(good, x)
    return F.struct(known(h).alias("hours"), known(m).alias("minutes"), known(s).alias("seconds"), known(f).alias("frames"), error.alias("error"))


def frame_index(code: Column, rate: Column) -> Column:
    """Frames since midnight; null where the timecode has an error."""
    seconds = code["hours"] * 3600 + code["minutes"] * 60 + code["seconds"]
    minutes = code["hours"] * 60 + code["minutes"]
    index = seconds * rate["nominal"] + code["frames"]
    skipped = (rate["nominal"] / 15).cast("int") * (minutes - F.floor(minutes / 10))
    return F.when(code["error"].isNull(), F.when(rate["drop"], index - skipped).otherwise(index)).cast("long")


def frames_per_day(rate: Column) -> Column:
    whole = rate["nominal"] * 86400
    return F.when(rate["drop"], whole - (rate["nominal"] / 15).cast("int") * (1440 - 144)).otherwise(whole).cast("long")
