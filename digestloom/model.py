"""The data model: algorithms, digest sets, pack headers."""

from __future__ import annotations

import struct

from pyspark.sql import types as T

# Algorithm ids, names and digest widths; the pack's magic, version and header layout.
ALGOS = {1: ("md5", "MD5", 16), 2: ("sha1", "SHA-1", 20), 3: ("sha256", "SHA-256", 32)}
PACK_MAGIC, PACK_VERSION, PACK_HEADER = 0x31545643, 1, "<IIIQI"
HEADER_BYTES = struct.calcsize(PACK_HEADER)
MAX_COUNT = 2**32 - 1
PACK_NAMES = {algo: f"clean_{name}.bin" for algo, (name, _, _) in ALGOS.items()}

WIDTH = {algo: width for algo, (_, _, width) in ALGOS.items()}
BY_NAME = {name: algo for algo, (name, _, _) in ALGOS.items()}

DIGEST_SET = T.StructType([T.StructField("algo", T.IntegerType()), T.StructField("digest", T.BinaryType())])
HEADER = T.StructType([T.StructField(n, T.LongType() if n in ("magic", "updated_unix", "count") else T.IntegerType()) for n in ("magic", "version", "algo", "updated_unix", "count")])


class PackFormatError(ValueError):
    """A pack, part or split that breaks the format."""


def pack_header(algo: int, updated_unix: int, count: int) -> bytes:
    if algo not in ALGOS:
        raise PackFormatError(f"unknown algorithm id {algo}")
    if not 0 <= count <= MAX_COUNT:
        raise PackFormatError(f"{count} digests; a pack holds {MAX_COUNT}")
    return struct.pack(PACK_HEADER, PACK_MAGIC, PACK_VERSION, algo, updated_unix, count)


def parse_header(raw: bytes, size: int | None = None, name: str = "pack") -> tuple[int, int, int, int, int]:
    """(magic, version, algo, updated_unix, count), checked; ``size``: the file's size in bytes, if known."""
    if len(raw) < HEADER_BYTES:
        raise PackFormatError(f"{name}: shorter than its header")
    magic, version, algo, updated, count = struct.unpack(PACK_HEADER, raw[:HEADER_BYTES])
    if magic != PACK_MAGIC or version != PACK_VERSION:
        raise PackFormatError(f"{name}: no digest pack of version {PACK_VERSION}")
    if algo not in ALGOS:
        raise PackFormatError(f"{name}: unknown algorithm id {algo}")
    if size is not None and size < HEADER_BYTES + count * WIDTH[algo]:
        raise PackFormatError(f"{name}: {size} bytes are too few for {count} digests")
    return magic, version, algo, updated, count
