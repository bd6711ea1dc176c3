"""ZIP members by a walk over local headers, and byte streams that resume after a break."""

from __future__ import annotations

import os
import re
import struct
import time
import uuid
import zlib
from collections.abc import Callable, Iterator
from http.client import HTTPException, IncompleteRead
from typing import BinaryIO
from urllib.request import Request, urlopen

# The default member pattern, retries and waiting times.
MEMBER = "RDS_*_modern/RDS_*_modern.db"
RETRIES, FIRST_WAIT, LONGEST_WAIT, CHUNK = 8, 2.0, 60.0, 64 * 1024
LOCAL, DESCRIPTOR = b"PK\x03\x04", b"PK\x07\x08"


class ArchiveError(ValueError):
    """An archive that can't be walked, or lacks the member."""


def components(path: str) -> list[str]:
    """The named steps of a path in lower case, however it is written."""
    return [x for x in re.split(r"[\\/]+", path.lower()) if x not in ("", ".", "..")]


def member_matches(name: str, want: str | None = MEMBER) -> bool:
    """Whether a member's path ends in the steps of ``want``, case ignored. ``*`` stands for anything but a slash; with
    one, the last step decides alone. Without ``want``: a full modern database."""
    path = components(name)
    if not want:
        return bool(path) and path[-1].endswith("_modern.db") and "minimal" not in path[-1]
    steps = components(want)
    if "*" in want:
        steps = steps[-1:]
    end = path[len(path) - len(steps) :] if len(path) >= len(steps) else []
    return bool(end) and all(re.fullmatch(".*".join(map(re.escape, step.split("*"))), x, re.S) for step, x in zip(steps, end))


#: What a broken connection raises.
BROKEN = (OSError, HTTPException)


def request(url: str, method: str = "GET", timeout: float = 60, **headers: str):
    return urlopen(Request(url, method=method, headers=headers), timeout=timeout)


def object_size(url: str, timeout: float = 30) -> int:
    """The size that a HEAD request announces; of a file, its own."""
    with request(url, "HEAD", timeout) as got:
        length = got.headers.get("Content-Length")
    if length is None:
        raise ArchiveError(f"{url}: no size is announced")
    return int(length)


def url_exists(url: str, timeout: float = 30) -> bool:
    """Whether a HEAD request succeeds."""
    try:
        with request(url, "HEAD", timeout):
            return True
    except BROKEN:
        return False


class ResumingStream:
    """Reads a url by ranges: after a break, or an end before the announced size, it asks again from where it stopped,
    waiting longer each time. ``open_at`` (offset -> stream) is the hook for other transports; ``size`` is the whole
    object's size where the transport doesn't announce it."""

    def __init__(self, url: str, open_at: Callable[[int], BinaryIO] | None = None, retries: int = RETRIES, wait: Callable[[float], None] = time.sleep, size: int | None = None) -> None:
        self.url, self.at, self.retries, self.wait, self.size = url, 0, retries, wait, size
        self.open_at = open_at or self._open
        self.stream: BinaryIO | None = None

    def _open(self, offset: int) -> BinaryIO:
        got = request(self.url, **({"Range": f"bytes={offset}-"} if offset else {}))
        if offset and self.url.startswith("http") and getattr(got, "status", 206) != 206:
            raise OSError("the server does not resume")
        if offset and not self.url.startswith("http"):
            got.read(offset)
        elif (length := got.headers.get("Content-Length")) is not None and not got.headers.get("Content-Encoding"):
            self.size = offset + int(length)
        return got

    def read(self, n: int) -> bytes:
        for attempt in range(1, self.retries + 2):
            try:
                if self.stream is None:
                    self.stream = self.open_at(self.at)
                data = self.stream.read(n)
                if not data and n and self.size is not None and self.at < self.size:
                    raise OSError(f"{self.url}: ended after {self.at} of {self.size} bytes")
                self.at += len(data)
                return data
            except BROKEN as broken:
                if isinstance(broken, IncompleteRead) and broken.partial:
                    self.stream = None
                    self.at += len(broken.partial)
                    return broken.partial
                self.stream = None
                if attempt > self.retries:
                    raise
                self.wait(min(LONGEST_WAIT, FIRST_WAIT * 2 ** (attempt - 1)))
        return b""

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()


def measured(stream, seconds: float, block: int = 1 << 20, clock: Callable[[], float] = time.monotonic) -> tuple[int, float]:
    """(bytes, seconds) of reading ``stream`` for about so long, or to its end."""
    began, total = clock(), 0
    while clock() - began < seconds and (data := stream.read(block)):
        total += len(data)
    return total, clock() - began


def exactly(stream, n: int) -> bytes:
    out = b""
    while len(out) < n:
        if not (more := stream.read(n - len(out))):
            raise ArchiveError("the archive ends too soon")
        out += more
    return out


def member_bytes(stream, want: str | None = MEMBER) -> Iterator[bytes]:
    """Blocks of the first member that matches, inflated; members before it are skipped without being kept."""
    seen: list[str] = []
    held = b""

    def take(n: int) -> bytes:
        nonlocal held
        out, held = held[:n], held[n:]
        return out + (exactly(stream, n - len(out)) if len(out) < n else b"")

    while True:
        head = held[:4] + stream.read(4 - len(held[:4])) if len(held) < 4 else held[:4]
        held = held[4:]
        if head != LOCAL:
            raise ArchiveError(f"no member matches {want!r}; databases seen: {', '.join(seen[:8]) or 'none'}")
        flags, method = struct.unpack("<xxHH", take(6))
        take(8)
        packed, size, name_len, extra_len = struct.unpack("<IIHH", take(12))
        name, extra = take(name_len).decode("utf-8", "replace"), take(extra_len)
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                longs = list(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
                if size == 0xFFFFFFFF and longs:
                    size = longs.pop(0)
                if packed == 0xFFFFFFFF and longs:
                    packed = longs.pop(0)
            at += 4 + n
        if method not in (0, 8):
            raise ArchiveError(f"{name}: method {method}")
        if name.lower().endswith(".db"):
            seen.append(name)
        hit, streamed = member_matches(name, want), bool(flags & 8)
        if method == 0 or not streamed:
            if streamed and not packed:
                raise ArchiveError(f"{name}: stored without a size")
            engine, left = zlib.decompressobj(-zlib.MAX_WBITS) if method else None, packed
            while left:
                block = take(min(CHUNK, left))
                left -= len(block)
                if hit:
                    yield engine.decompress(block) if engine else block
        else:
            engine = zlib.decompressobj(-zlib.MAX_WBITS)
            while not engine.eof:
                block, held = held or stream.read(CHUNK), b""
                if not block:
                    raise ArchiveError("the archive ends too soon")
                data = engine.decompress(block)
                if hit and data:
                    yield data
            held = engine.unused_data
        if hit:
            return
        if streamed:
            start = take(4)
            take(12 if start == DESCRIPTOR else 8)


def stage_member(url: str, target: str, want: str | None = MEMBER, **stream) -> str:
    """The member written to ``target``, whole or not at all; a deflate stream has no restart points, so one process
    does this once and all scans of the staged file are parallel. ``target`` must be where all executors see it."""
    temporary = f"{target}.{uuid.uuid4().hex}.tmp"
    try:
        with open(temporary, "wb") as out:
            for block in member_bytes(ResumingStream(url, **stream), want):
                out.write(block)
        os.replace(temporary, target)
    finally:
        if os.path.exists(temporary):
            os.remove(temporary)
    return target
