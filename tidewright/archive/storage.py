"""Where archived objects live: put, head, open, list. Nothing deletes.

Keys are ASCII components joined by slashes; a file's path is one component, percent-encoded by its bytes.
"""

from __future__ import annotations

import fcntl
import os
import random
import shutil
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import BinaryIO, Protocol
from urllib.parse import quote_from_bytes, unquote_to_bytes
from uuid import uuid4

# Where a session is stored, and the name of its manifest.
PREFIX, MANIFEST = "sessions/archive-v1", "archive-manifest.v1.json"
KEY_LIMIT = 1024


class ArchiveError(Exception):
    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code

    def __reduce__(self):
        return ArchiveError, (self.code, str(self))


def encode(text: str) -> str:
    """All bytes but unreserved ones become %XX."""
    return quote_from_bytes(os.fsencode(text), safe="")


def decode(component: str) -> str:
    """The text that encodes to this component; what encode() wouldn't have written is refused."""
    text = os.fsdecode(unquote_to_bytes(component)) if component.isascii() else ""
    if encode(text) != component:
        raise ArchiveError("archive_key_not_canonical", f"{component!r} isn't canonically encoded")
    return text


def key(session: str, *parts: str) -> str:
    out = "/".join((PREFIX, encode(session), *parts))
    if len(out.encode()) > KEY_LIMIT:
        raise ArchiveError("archive_key_too_long", f"a key of {len(out.encode())} bytes; {KEY_LIMIT} are allowed")
    return out


def object_key(session: str, path: str, sha256: str) -> str:
    """By path and content: the same file has the same key, a changed one another."""
    return key(session, "objects", f"{encode(path)}.{sha256}.zst")


def objects_prefix(session: str) -> str:
    return key(session, "objects", "")


def manifest_key(session: str) -> str:
    return key(session, MANIFEST)


class Storage(Protocol):
    def put(self, name: str, source: str) -> None: ...
    def head(self, name: str) -> int | None: ...
    def open(self, name: str) -> BinaryIO: ...
    def list(self, prefix: str = "") -> Iterator[str]: ...


class FolderStorage:
    """Objects as files of a folder that all executors see. An object appears by rename: whole or not at all."""

    def __init__(self, root: str):
        self.root = os.path.abspath(root)

    def _at(self, name: str) -> str:
        at = os.path.abspath(os.path.join(self.root, name))
        if not at.startswith(self.root + os.sep):
            raise ArchiveError("archive_key_escapes", f"{name!r} leaves the storage")
        return at

    def put(self, name: str, source: str) -> None:
        at = self._at(name)
        os.makedirs(os.path.dirname(at), exist_ok=True)
        beside = f"{at}.{uuid4().hex}.partial"
        with open(source, "rb") as a, open(beside, "wb") as b:
            shutil.copyfileobj(a, b, 1 << 20)
            b.flush()
            os.fsync(b.fileno())
        os.replace(beside, at)

    def head(self, name: str) -> int | None:
        at = self._at(name)
        return os.path.getsize(at) if os.path.isfile(at) else None

    def open(self, name: str) -> BinaryIO:
        if self.head(name) is None:
            raise ArchiveError("archive_object_missing", f"no object {name!r}")
        return open(self._at(name), "rb")

    def list(self, prefix: str = "") -> Iterator[str]:
        for folder, folders, files in os.walk(self.root):
            folders.sort()
            for f in sorted(files):
                name = os.path.relpath(os.path.join(folder, f), self.root)
                if name.startswith(prefix) and not name.endswith(".partial"):
                    yield name


class Client(Protocol):
    """What an object store offers: listings by pages, uploads in parts. Calls may fail as busy (TimeoutError)."""

    def page(self, prefix: str, after: str | None) -> tuple[list[tuple[str, int]], str | None]: ...
    def get(self, name: str) -> BinaryIO: ...
    def begin(self, name: str) -> str: ...
    def part(self, name: str, upload: str, number: int, data: bytes) -> str: ...
    def complete(self, name: str, upload: str, tags: list[str]) -> None: ...
    def abort(self, name: str, upload: str) -> None: ...
    def uploads(self, prefix: str) -> list[tuple[str, str]]: ...


class ObjectStorage:
    """Storage over a client: listings page by page, objects in parts; a failed upload leaves nothing behind."""

    def __init__(self, client: Client, least_part: int = 8 << 20, attempts: int = 4, first: float = 0.2):
        self.client, self.least_part, self._how = client, least_part, {"attempts": attempts, "first": first}

    def put(self, name: str, source: str) -> None:
        for other, upload in retry(lambda: self.client.uploads(name), **self._how):
            if other == name:  # of a writer that died; there is one writer of a session
                retry(lambda u=upload: self.client.abort(name, u), **self._how)
        upload = retry(lambda: self.client.begin(name), **self._how)
        try:
            tags, size = [], part_size(os.path.getsize(source), self.least_part)
            with open(source, "rb") as f:
                while (data := f.read(size)) or not tags:
                    tags.append(retry(lambda d=data: self.client.part(name, upload, len(tags) + 1, d), **self._how))
                    if not data:
                        break
            retry(lambda: self.client.complete(name, upload, tags), **self._how)
        except BaseException:
            self.client.abort(name, upload)
            raise

    def pages(self, prefix: str = "") -> Iterator[list[tuple[str, int]]]:
        """(name, size) page by page; a page that repeats itself is an error, not an endless listing."""
        after = None
        while True:
            rows, following = retry(lambda a=after: self.client.page(prefix, a), **self._how)
            yield rows
            if following is None:
                return
            if following == after:
                raise ArchiveError("archive_listing_stuck", f"the listing of {prefix!r} doesn't move on")
            after = following

    def head(self, name: str) -> int | None:
        return next((size for rows in self.pages(name) for n, size in rows if n == name), None)

    def open(self, name: str) -> BinaryIO:
        if self.head(name) is None:
            raise ArchiveError("archive_object_missing", f"no object {name!r}")
        return retry(lambda: self.client.get(name), **self._how)

    def list(self, prefix: str = "") -> Iterator[str]:
        for rows in self.pages(prefix):
            yield from (n for n, _ in rows)


def retry(f: Callable, attempts: int = 4, first: float = 0.2, busy: Callable[[Exception], bool] = lambda e: isinstance(e, (TimeoutError, BlockingIOError))):
    """f(), tried again after growing pauses while the storage says it is busy."""
    for i in range(attempts):
        try:
            return f()
        except Exception as e:
            if i == attempts - 1 or not busy(e):
                raise
            time.sleep(first * 2**i * (1 + random.random() / 4))


def part_size(total: int, least: int = 8 << 20, most_parts: int = 10_000) -> int:
    """Bytes of a part of a large object: the least, or what keeps the parts few enough."""
    return max(least, -(-total // most_parts))


@contextmanager
def single_writer(folder: str):
    """At most one writer of a session at a time; a second one is refused at once."""
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, ".lock"), "w") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError:
            raise ArchiveError("session_locked", f"another writer holds {folder}") from None
        yield
