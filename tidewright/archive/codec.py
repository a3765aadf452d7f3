"""zstd, level 10, one thread, with checksums; streams of bounded memory, measured as they pass."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import BinaryIO

import zstandard

from tidewright.archive.storage import ArchiveError

LEVEL, BLOCK = 10, 1 << 20
RECIPE = {"name": "zstd", "level": LEVEL, "threads": 1, "checksum": True}


class Measure:
    """Passes bytes on, with their count and sha256."""

    def __init__(self, target: BinaryIO | None = None):
        self.size, self._sha, self._target = 0, hashlib.sha256(), target

    def write(self, data: bytes) -> int:
        self.size += len(data)
        self._sha.update(data)
        if self._target is not None:
            self._target.write(data)
        return len(data)

    @property
    def sha256(self) -> str:
        return self._sha.hexdigest()


def blocks(source: BinaryIO) -> Iterator[bytes]:
    while data := source.read(BLOCK):
        yield data


def digest(source: BinaryIO) -> Measure:
    out = Measure()
    for data in blocks(source):
        out.write(data)
    return out


def compress(source: BinaryIO, target: BinaryIO | None = None, size: int = -1) -> tuple[Measure, Measure]:
    """(plain, compressed) measures."""
    plain, packed = Measure(), Measure(target)
    coder = zstandard.ZstdCompressor(level=LEVEL, threads=0, write_checksum=True, write_content_size=size >= 0).compressobj(size=size)
    for data in blocks(source):
        plain.write(data)
        packed.write(coder.compress(data))
    packed.write(coder.flush())
    return plain, packed


def decompress(source: BinaryIO, limit: int, target: BinaryIO | None = None) -> tuple[Measure, Measure]:
    """(plain, compressed) measures. More than limit bytes, a broken or a cut-off frame are refused."""
    plain, packed = Measure(target), Measure()
    coder = zstandard.ZstdDecompressor().decompressobj()
    try:
        for data in blocks(source):
            packed.write(data)
            # a block of input can swell; it goes in by small bites, so that one bite's output is bounded
            for at in range(0, len(data), 4096):
                if coder.eof:
                    raise ArchiveError("archive_object_corrupt", "bytes behind the frame")
                plain.write(coder.decompress(data[at : at + 4096]))
                if plain.size > limit:
                    raise ArchiveError("archive_object_too_large", f"more than the {limit} bytes expected")
    except zstandard.ZstdError as e:
        raise ArchiveError("archive_object_corrupt", str(e)) from None
    if not coder.eof:
        raise ArchiveError("archive_object_corrupt", "the frame is cut off")
    return plain, packed
