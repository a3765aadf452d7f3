"""MPEG audio: a codec that carries bytes losslessly in Layer III frames, and a reader for any such stream.

The writer puts the payload, in units of 192 bytes, in the ancillary part of silent frames: mono,
48 kHz, MPEG-1 Layer III with checksums. Two units go into a frame of 160 kbit/s, a last odd unit into one of
80 kbit/s, so that the stream has a variable bitrate. Before them stand an ID3v2 tag and a Xing frame
with frame count, byte count and seek table; an ID3v1 tag ends the file.

The reader takes streams of MPEG versions 1, 2 and 2.5 in Layers I to III. It skips tags, finds frames again
after damage (a header counts as one only if it is like the last frame's, if another like it stands behind the
frame, or if the stream ends there), reads Xing, Info and
VBRI tables and what encoders say of their delay, verifies the checksums of all layers, takes the size of free-format frames from
their distance, holds the seek table against the true offsets, and gives the exact duration and the byte offset of every frame.
"""

from __future__ import annotations

import hashlib
import math
import struct
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import common

UNIT = 192  # bytes of payload in a unit
SIDE = {(1, False): 32, (1, True): 17, (2, False): 17, (2, True): 9}  # side information by version and mono
#: Bitrates in kbit/s by (MPEG-1, layer), from index 1 to 14. Fixed values of the standard.
BITRATES = {
    (True, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = (44100, 48000, 32000)


@dataclass(frozen=True)
class Header:
    version: int  # 1, 2, or 25 for MPEG-2.5
    layer: int
    protected: bool
    bitrate: int
    rate: int
    mode: int  # 0 stereo, 1 joint stereo, 2 two channels, 3 mono
    extension: int  # of joint stereo
    pad: int  # bytes of padding in it
    size: int  # bytes of the frame; 0 where the format is free
    samples: int

    @property
    def mono(self) -> bool:
        return self.mode == 3

    @property
    def body(self) -> int:
        """Where the side information (or what else follows the header) begins."""
        return 6 if self.protected else 4


@lru_cache(4096)
def header(four: bytes) -> Header | None:
    """The frame header in four bytes, or None: no sync, or reserved values."""
    if len(four) < 4:
        return None
    v = int.from_bytes(four, "big")
    if v >> 21 != 0x7FF:
        return None
    version, layer = {3: 1, 2: 2, 0: 25}.get(v >> 19 & 3), 4 - (v >> 17 & 3)
    index, rate = v >> 12 & 15, v >> 10 & 3
    if version is None or layer == 4 or index == 15 or rate == 3:
        return None
    kbit = BITRATES[version == 1, layer][index - 1] if index else 0
    hertz = RATES[rate] // {1: 1, 2: 2, 25: 4}[version]
    samples = 384 if layer == 1 else 576 if layer == 3 and version != 1 else 1152
    pad = (v >> 9 & 1) * (4 if layer == 1 else 1)
    size = 0 if not kbit else 12 * kbit * 1000 // hertz * 4 + pad if layer == 1 else samples // 8 * kbit * 1000 // hertz + pad
    return Header(version, layer, not v >> 16 & 1, kbit, hertz, v >> 6 & 3, v >> 4 & 3, pad, size, samples)


@lru_cache(4096)
def crc16(data: bytes, bits: int | None = None) -> int:
    """The checksum of frames, over all or the first so many bits: polynomial 0x8005, from 0xFFFF, most significant bit first."""
    crc = 0xFFFF
    for i in range(len(data) * 8 if bits is None else bits):
        crc = (crc << 1 ^ (0x8005 if (crc >> 15 ^ data[i >> 3] >> (7 - (i & 7))) & 1 else 0)) & 0xFFFF
    return crc


#: Bits of a subband's allocation in Layer II, as runs of (subbands, bits). Fixed values of the standard's tables.
ALLOCATION = {"a": ((11, 4), (12, 3), (4, 2)), "b": ((11, 4), (12, 3), (7, 2)), "c": ((2, 4), (6, 3)), "d": ((2, 4), (10, 3)), "low": ((4, 4), (7, 3), (19, 2))}


def _allocation(h: Header) -> list[int]:
    """The bits of each subband's allocation in a Layer II frame."""
    each = h.bitrate // (1 if h.mono else 2)
    table = "low" if h.version != 1 else ("d" if h.rate == 32000 else "c") if 0 < each < 56 else "a" if h.rate == 48000 or 0 < each <= 80 else "b"
    return [bits for n, bits in ALLOCATION[table] for _ in range(n)]


def protected_bits(data: bytes, at: int, h: Header) -> int:
    """Bits behind a frame's checksum that it covers besides the header: allocations, in Layer II also what tells how scale factors are shared."""
    if h.layer == 3:
        return 8 * _side(h)
    channels = 1 if h.mono else 2
    if h.layer == 1:
        bound = 4 * h.extension + 4 if h.mode == 1 else 32
        return 4 * (bound * channels + 32 - bound)
    sizes = _allocation(h)
    bound = min(len(sizes), 4 * h.extension + 4) if h.mode == 1 else len(sizes)
    bits = int.from_bytes(data[at + 6 : at + 6 + 64].ljust(64, b"\0"), "big")
    used = shared = 0
    for i, n in enumerate(sizes):
        for _ in range(channels if i < bound else 1):
            used += n
            shared += (1 if i < bound else channels) * (bits >> (512 - used) & (1 << n) - 1 > 0)
    return used + 2 * shared


def checksum_holds(data: bytes, at: int, h: Header) -> bool:
    covered = 16 + protected_bits(data, at, h)
    own = data[at + 2 : at + 4] + data[at + 6 : at + 4 + (covered + 7) // 8]
    return len(own) * 8 >= covered and crc16(own, covered) == int.from_bytes(data[at + 4 : at + 6], "big")


def _side(h: Header) -> int:
    return SIDE[1 if h.version == 1 else 2, h.mono]


def _syncsafe(n: int) -> bytes:
    return bytes(n >> s & 127 for s in (21, 14, 7, 0))


def _frame(kbit: int, ancillary: bytes) -> bytes:
    """A silent mono frame of 48 kHz with a checksum; ancillary follows the side information."""
    index = BITRATES[True, 3].index(kbit) + 1
    head = bytes((0xFF, 0xFA, index << 4 | 1 << 2, 0xC0))
    side = bytes(17)
    frame = head + struct.pack(">H", crc16(head[2:] + side)) + side + ancillary
    return frame.ljust(header(head).size, b"\0")


def write(payload: bytes, n_bytes: int) -> bytes:
    """The stream that holds the payload, a positive multiple of UNIT bytes, n_bytes of which are the text's."""
    if not payload or len(payload) % UNIT:
        raise ValueError("the payload is a positive multiple of the unit")
    pairs, odd = divmod(len(payload) // UNIT, 2)
    big = _frame(160, b"")[: 6 + 17]
    body = np.zeros((pairs, 480), np.uint8)
    body[:, :23] = np.frombuffer(big, np.uint8)
    body[:, 23 : 23 + 2 * UNIT] = np.frombuffer(payload[: pairs * 2 * UNIT], np.uint8).reshape(pairs, 2 * UNIT)
    audio = body.tobytes() + (_frame(80, payload[pairs * 2 * UNIT :]) if odd else b"")
    frames = pairs + odd
    total = 240 + len(audio)
    toc = bytes(min(255, (240 + frames * i // 100 * 480) * 256 // total) for i in range(100))
    xing = _frame(80, b"Xing" + struct.pack(">III", 7, frames, total) + toc)
    millis = -(-frames * 1152 * 1000 // 48000)
    tags = b"".join(k + _syncsafe(len(v) + 1) + b"\0\0\x03" + v for k, v in ((b"TLEN", str(millis).encode()), (b"TXXX", b"n_bytes\0" + str(n_bytes).encode())))
    return b"ID3\x04\0\0" + _syncsafe(len(tags)) + tags + xing + audio + (b"TAG" + b"payload".ljust(125, b"\0"))


@dataclass
class Stream:
    tags: dict[str, str] = field(default_factory=dict)
    table: dict[str, int | list[int] | str] = field(default_factory=dict)  # of the variable-bitrate header
    offsets: list[int] = field(default_factory=list)  # of audio frames, the seek table's own left out
    headers: list[Header] = field(default_factory=list)
    bad_checksums: int = 0
    skipped: int = 0  # bytes between frames

    @property
    def samples(self) -> int:
        return sum(h.samples for h in self.headers)

    def duration(self) -> tuple[int, int]:
        """Exact seconds as a fraction, frames of unlike rates included; what an encoder says it put in front and behind is taken off."""
        unheard = int(self.table.get("delay", 0)) + int(self.table.get("padding", 0))
        num, den = (-unheard, self.headers[0].rate) if self.headers and unheard <= self.samples else (0, 1)
        for rate, n in sorted({r: sum(h.samples for h in self.headers if h.rate == r) for r in {h.rate for h in self.headers}}.items()):
            num, den = num * rate + n * den, den * rate
        g = math.gcd(num, den)
        return num // g, den // g


    def seek_error(self) -> int | None:
        """How far the seek table is from the frames' true offsets at most: in 256ths of the stream (Xing), in bytes (VBRI); None without a table."""
        toc, n = self.table.get("toc"), len(self.offsets)
        if not toc or not n:
            return None
        start = self.table["start"]
        if self.table["kind"] == "VBRI":
            per = max(1, self.table["per"])
            ends = [*self.offsets, self.offsets[-1] + self.headers[-1].size]
            reached = [self.offsets[0] + sum(toc[: i + 1]) for i in range(len(toc))]
            return max(abs(r - ends[min(n, per * (i + 1))]) for i, r in enumerate(reached))
        total = self.table.get("bytes") or 1
        return max(abs(t - min(255, (self.offsets[min(n - 1, n * i // 100)] - start) * 256 // total)) for i, t in enumerate(toc))


def _id3v2(data: bytes, stream: Stream) -> int:
    """Parses the tag in front; where the audio begins."""
    if data[:3] != b"ID3" or len(data) < 10 or max(data[6:10]) > 127:
        return 0
    size = sum(b << s for b, s in zip(data[6:10], (21, 14, 7, 0), strict=True))
    end, at = min(len(data), 10 + size), 10
    if data[5] & 0x40 and end >= 14:  # extended header
        n = int.from_bytes(data[10:14], "big")
        at += sum(b << s for b, s in zip(data[10:14], (21, 14, 7, 0), strict=True)) if data[3] == 4 else n + 4
    while at + 10 <= end and data[at] and data[3] >= 3:
        raw = data[at + 4 : at + 8]
        n = sum(b << s for b, s in zip(raw, (21, 14, 7, 0), strict=True)) if data[3] == 4 else int.from_bytes(raw, "big")
        name, body = data[at : at + 4].decode("latin-1"), data[at + 10 : min(end, at + 10 + n)]
        if name[0] == "T" and body:
            value = body[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be"}.get(body[0], "utf-8"), "replace")
            key, _, rest = value.partition("\0") if name == "TXXX" else ("", "", value)
            stream.tags[f"{name}:{key}" if key else name] = rest.rstrip("\0")
        at += 10 + n
    return min(len(data), 10 + size + (10 if data[5] & 0x10 else 0))


def _table(data: bytes, at: int, h: Header, stream: Stream) -> bool:
    """Whether the frame is a variable-bitrate header; if so its table is kept."""
    p = at + h.body + _side(h) if h.layer == 3 else at + h.body
    for p in (p, at + 4 + _side(h)):  # some writers count no checksum
        name = data[p : p + 4]
        if name in (b"Xing", b"Info") and p + 8 <= at + h.size:
            flags, p = int.from_bytes(data[p + 4 : p + 8], "big"), p + 8
            stream.table |= {"kind": name.decode(), "start": at}
            for bit, key in ((1, "frames"), (2, "bytes")):
                if flags & bit:
                    stream.table[key], p = int.from_bytes(data[p : p + 4], "big"), p + 4
            if flags & 4:
                stream.table["toc"], p = list(data[p : p + 100]), p + 100
            p += 4 if flags & 8 else 0
            if p + 24 <= at + h.size and data[p : p + 3] in (b"LAM", b"Lav"):
                stream.table |= {"encoder": data[p : p + 9].rstrip(b"\0 ").decode("latin-1"), "delay": data[p + 21] << 4 | data[p + 22] >> 4, "padding": (data[p + 22] & 15) << 8 | data[p + 23]}
            return True
    p = at + 4 + 32
    if data[p : p + 4] == b"VBRI":
        size, frames, n, scale, width = int.from_bytes(data[p + 10 : p + 14], "big"), int.from_bytes(data[p + 14 : p + 18], "big"), *struct.unpack(">HHH", data[p + 18 : p + 24])
        toc = [int.from_bytes(data[p + 26 + i * width : p + 26 + (i + 1) * width], "big") * scale for i in range(n)] if width else []
        stream.table |= {"kind": "VBRI", "start": at, "frames": frames, "bytes": size, "toc": toc, "per": int.from_bytes(data[p + 24 : p + 26], "big")}
        return True
    return False


def read(data: bytes) -> Stream:
    """Tags, tables, frames, checksums. Damaged parts are skipped and counted."""
    stream = Stream()
    at, end = _id3v2(data, stream), len(data)
    if end - at >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        stream.tags["ID3v1"] = data[end + 3 : end + 33].rstrip(b"\0 ").decode("latin-1")
    if end - at >= 32 and data[end - 32 : end - 24] == b"APETAGEX":
        stream.tags["APE"] = str(int.from_bytes(data[end - 16 : end - 12], "little"))
        end = max(at, end - int.from_bytes(data[end - 20 : end - 16], "little") - 32 * (data[end - 9] >> 7))
    last, first, free = None, True, 0
    while at + 4 <= end:
        h = header(data[at : at + 4])
        if h is not None and not h.size:
            free = free or _free_size(data, at, end, h)
            h = replace(h, size=free + h.pad) if free else None
        fits = h is not None and at + h.size <= end and (_alike(h, last) or at + h.size + 4 > end or _alike(h, header(data[at + h.size : at + h.size + 4])))
        if not fits:
            nxt = data.find(b"\xff", at + 1, end)
            nxt = end if nxt < 0 else nxt
            stream.skipped += nxt - at
            at = nxt
            continue
        last = h
        if h.protected and not checksum_holds(data, at, h):
            stream.bad_checksums += 1
        if not (first and _table(data, at, h, stream)):
            stream.offsets.append(at)
            stream.headers.append(h)
        first = False
        at += h.size
    stream.skipped += max(0, end - at)
    return stream


def _free_size(data: bytes, at: int, end: int, h: Header) -> int:
    """Bytes of a free-format frame without padding: up to the next header like it. 0: there is none."""
    p = data.find(b"\xff", at + 24, min(end, at + 8192))
    while p >= 0:
        other = header(data[p : p + 4])
        if other is not None and not other.size and _alike(h, other):
            return p - at - h.pad
        p = data.find(b"\xff", p + 1, min(end, at + 8192))
    return 0


def _alike(a: Header, b: Header | None) -> bool:
    return b is not None and (a.version, a.layer, a.rate) == (b.version, b.layer, b.rate)


def payload_of(data: bytes, stream: Stream) -> bytes:
    """What the writer stored: the units in the frames' ancillary parts."""
    parts = []
    for at, h in zip(stream.offsets, stream.headers, strict=True):
        start = at + h.body + _side(h)
        parts.append(data[start : start + (h.size - h.body - _side(h)) // UNIT * UNIT])
    return b"".join(parts)


def encode(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media (binary: the stream) of every whole text.

    Null counts as empty, which gives one unit of spaces. A text of any length is one stream, made in memory by its row's task.
    An empty table gives no rows; repeated rows stay repeated, equal texts have equal streams; extra columns are ignored.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, media = [], []
        for text in common.texts_of(batch.column(1)):
            raw = text.encode("utf-8", "surrogatepass")
            sizes.append(len(raw))
            media.append(write(raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), b" "), len(raw)))
        return pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    own = common.pick(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return common.map_arrow(own, each, "doc_id long, n_bytes long, media binary")


def decode(media: DataFrame) -> DataFrame:
    """For a table with doc_id and media (any MPEG audio): what the stored bytes hold.

    n_bytes is the tag's; seek is the byte offset of every audio frame; duration is duration_num / duration_den
    seconds; seek_error is how far the seek table is off. A null or unreadable stream has no frame and an empty payload.
    An empty table gives no rows; repeated rows stay repeated; extra columns are ignored.
    """
    schema = (
        "doc_id long, n_bytes long, payload binary, media_bytes long, media_sha256 string, frames long, samples long, duration_num long, duration_den long, "
        "bad_checksums long, skipped long, table string, seek_error long, tags map<string,string>, seek array<long>"
    )

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for data in (x or b"" for x in batch.column(1).to_pylist()):
            s = read(data)
            num, den = s.duration()
            own = s.tags.get("TXXX:n_bytes", "")
            table = f"{s.table.get('kind', 'none')}/{s.table.get('frames', 0)}/{s.table.get('bytes', 0)}"
            rows.append((int(own) if own.isdigit() else None, payload_of(data, s), len(data), hashlib.sha256(data).hexdigest(), len(s.offsets), s.samples, num, den, s.bad_checksums, s.skipped, table, s.seek_error(), list(s.tags.items()), s.offsets))
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.string(), *[pa.int64()] * 6, pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.list_(pa.int64())]
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        return pa.record_batch([batch.column(0), *columns], [c.split()[0] for c in schema.split(", ")])

    own = common.pick(media, "doc_id", "media").select(F.col("doc_id").cast("long").alias("doc_id"), "media")
    return common.map_arrow(own, each, schema)


def digest(decoded: DataFrame) -> DataFrame:
    """The digest columns of what decode() read back; then its durations, tags and seek offsets."""
    payload = F.col("payload")
    feature = F.format_string("%df %d/%ds crc%d skip%d %s toc%s", "frames", "duration_num", "duration_den", "bad_checksums", "skipped", "table", F.coalesce(F.col("seek_error").cast("string"), F.lit("-")))
    tail = F.when(F.length(payload) >= 16, F.substring(payload, -16, 16)).otherwise(payload)
    return decoded.select(
        "doc_id", "n_bytes", F.length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_sha256"), F.crc32(tail).alias("tail_crc32"),
        "media_bytes", "media_sha256", feature.alias("feature"), "frames", "samples", "duration_num", "duration_den", "tags", "seek",
    )
