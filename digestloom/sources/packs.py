"""Data source ``digest_pack``: fixed-width binary packs, read in record ranges and written in byte order.

A pack is a 24-byte little-endian header (magic, version, algorithm, time, count) and the sorted digests. Reading:
option ``mode`` PERMISSIVE takes broken files as far as they go; ``headerOnly`` gives one header row a file. Writing:
rows must come range-partitioned and sorted (write_pack() does that); tasks write segments, the commit puts them behind
the header in order of their first digests and renames the file into place. ``digest_part_packs`` writes the packs of
many parts in one such job (write_part_packs()).
"""

from __future__ import annotations

import glob
import os
import shutil
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from digestloom.model import ALGOS, HEADER_BYTES, WIDTH, PackFormatError, pack_header, parse_header
from digestloom.sources.archive import request

#: Small packs that one task reads.
MOST_FILES = 64
HEADER_SCHEMA = "magic long, version int, algo int, updated_unix long, count long"


@dataclass
class Records:
    path: str
    algo: int
    first: int
    last: int
    header: tuple


class Ranges(InputPartition):
    """Record ranges that one task reads: one of a large pack, or those of many small ones."""

    def __init__(self, ranges: list[Records]) -> None:
        self.ranges = ranges


class PackReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = sorted(p for pattern in options["path"].split(",") for p in glob.glob(pattern))
        self.strict = options.get("mode", "FAILFAST").upper() != "PERMISSIVE"
        self.header_only = options.get("headeronly", options.get("headerOnly", "false")).lower() == "true"
        self.records = int(options.get("recordsPerPartition", 4_000_000))
        if not self.paths:
            raise PackFormatError(f"no pack matches {options['path']}")

    def partitions(self) -> list[Ranges]:
        out, held = [], 0
        for path in self.paths:
            size = os.path.getsize(path)
            with open(path, "rb") as f:
                raw = f.read(HEADER_BYTES)
            try:
                header = parse_header(raw, size if self.strict else None, path)
            except PackFormatError:
                if self.strict:
                    raise
                continue
            algo, count = header[2], header[4]
            count = min(count, (size - HEADER_BYTES) // WIDTH[algo])
            step = max(1, count) if self.header_only else self.records
            for k in range(0, max(1, count), step):
                found = Records(path, algo, k, min(count, k + step), header)
                n = found.last - found.first
                if not out or held + n > self.records or len(out[-1].ranges) == MOST_FILES:
                    out.append(Ranges([]))
                    held = 0
                out[-1].ranges.append(found)
                held += n
        return out

    def read(self, task: Ranges) -> Iterator:
        for part in task.ranges:
            yield from self.records_of(part)

    def records_of(self, part: Records) -> Iterator:
        if self.header_only:
            yield part.header
            return
        width, at = WIDTH[part.algo], part.first
        with open(part.path, "rb") as f:
            f.seek(HEADER_BYTES + at * width)
            while at < part.last:
                n = min(100_000, part.last - at)
                data = f.read(n * width)
                digests = pa.Array.from_buffers(pa.binary(width), n, [None, pa.py_buffer(data)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([part.algo] * n, pa.int32()), digests], ["algo", "digest"])
                at += n


@dataclass
class Segment(WriterCommitMessage):
    path: str
    first: bytes
    count: int


@dataclass
class PartSegments(WriterCommitMessage):
    """Segments of many packs in one file: (part, algorithm, place in the file, first digest, count) of each."""

    path: str
    runs: list[tuple[int, int, int, bytes, int]]


def in_order(digests: np.ndarray) -> bool:
    """Whether the rows of bytes rise strictly: at the first byte where two neighbours differ, the later is greater."""
    a, b = digests[:-1], digests[1:]
    differ = a != b
    at = differ.argmax(axis=1)[:, None]
    return bool(differ.any(axis=1).all() and (np.take_along_axis(a, at, 1) < np.take_along_axis(b, at, 1)).all())


def joined(column: pa.Array, width: int, last: bytes) -> bytes:
    """The digests one behind the other, if they have this width and rise strictly from ``last``."""
    whole = not column.null_count and pc.all(pc.equal(pc.binary_length(column), width)).as_py()
    data = b"".join(column.to_pylist()) if whole else b""
    if not whole or not in_order(np.frombuffer(last + data, np.uint8).reshape(-1, width)):
        raise PackFormatError("digests of another width, or not in strict byte order")
    return data


class PackWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path, self.algo = options["path"], int(options["algo"])
        self.updated = int(options.get("updatedUnix") or time.time())

    def write(self, batches: Iterator[pa.RecordBatch]) -> Segment:
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        name, first, count, last, width = f"{self.path}.{uuid.uuid4().hex}.segment", b"", 0, b"", WIDTH[self.algo]
        with open(name, "wb") as f:
            for batch in batches:
                n, column = batch.num_rows, batch.column(batch.schema.names.index("digest"))
                if not n:
                    continue
                data = joined(column, width, last)
                first, last, count = first or data[:width], data[-width:], count + n
                f.write(data)
        return Segment(name, first, count)

    def commit(self, messages: list) -> None:
        segments = sorted((m for m in messages if m and m.count), key=lambda m: m.first)
        temporary = f"{self.path}.{uuid.uuid4().hex}.tmp"
        with open(temporary, "wb") as out:
            out.write(pack_header(self.algo, self.updated, sum(m.count for m in segments)))
            for m in segments:
                with open(m.path, "rb") as f:
                    shutil.copyfileobj(f, out, 1 << 20)
        os.replace(temporary, self.path)
        self.abort(messages)

    def abort(self, messages: list) -> None:
        for m in messages:
            if m and os.path.exists(m.path):
                os.remove(m.path)


class PartPackWriter(DataSourceArrowWriter):
    """The packs of the parts from ``firstPart`` up to ``lastPart``, of every algorithm; one without digests gets its
    header alone. The part's number and the algorithm's name are put into ``name``."""

    def __init__(self, options: dict) -> None:
        self.folder, self.name, self.parts = options["path"], options["name"], range(int(options["firstPart"]), int(options["lastPart"]))
        self.updated = int(options.get("updatedUnix") or time.time())

    def write(self, batches: Iterator[pa.RecordBatch]) -> PartSegments:
        os.makedirs(self.folder, exist_ok=True)
        name, runs, last, at = f"{self.folder}/{uuid.uuid4().hex}.segment", [], b"", 0
        with open(name, "wb") as f:
            for batch in batches:
                if not batch.num_rows:
                    continue
                part, algo, digest = (batch.column(batch.schema.names.index(c)) for c in ("part", "algo", "digest"))
                part, algo = part.to_numpy(zero_copy_only=False), algo.to_numpy(zero_copy_only=False)
                ends = [*(np.flatnonzero((part[1:] != part[:-1]) | (algo[1:] != algo[:-1])) + 1).tolist(), len(part)]
                for begin, end in zip([0, *ends], ends):
                    key = int(part[begin]), int(algo[begin])
                    goes_on = bool(runs) and runs[-1][:2] == key
                    if not goes_on and (key[0] not in self.parts or runs and key < runs[-1][:2]):
                        raise PackFormatError(f"a digest of part {key[0]}, out of order or not of the parts {self.parts}")
                    data = joined(digest.slice(begin, end - begin), WIDTH[key[1]], last if goes_on else b"")
                    if goes_on:
                        runs[-1] = (*runs[-1][:4], runs[-1][4] + end - begin)
                    else:
                        runs.append((*key, at, data[: WIDTH[key[1]]], end - begin))
                    last, at = data[-WIDTH[key[1]] :], at + len(data)
                    f.write(data)
        return PartSegments(name, runs)

    def commit(self, messages: list) -> None:
        runs = sorted((part, algo, first, m.path, at, n) for m in messages if m for part, algo, at, first, n in m.runs)
        k = 0
        for part in self.parts:
            for algo, (kind, _, width) in ALGOS.items():
                begin = k
                while k < len(runs) and runs[k][:2] == (part, algo):
                    k += 1
                target = f"{self.folder}/{self.name.format(part).format(kind)}"
                temporary = f"{target}.{uuid.uuid4().hex}.tmp"
                with open(temporary, "wb") as out:
                    out.write(pack_header(algo, self.updated, sum(r[5] for r in runs[begin:k])))
                    for _, _, _, path, at, n in runs[begin:k]:
                        with open(path, "rb") as f:
                            f.seek(at)
                            copied(f, out, n * width)
                os.replace(temporary, target)
        self.abort(messages)

    def abort(self, messages: list) -> None:
        for m in messages:
            if m and os.path.exists(m.path):
                os.remove(m.path)


def copied(source, target, n: int, block: int = 1 << 20) -> None:
    while n and (data := source.read(min(n, block))):
        target.write(data)
        n -= len(data)


class DigestPartPacks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "digest_part_packs"

    def writer(self, schema, overwrite: bool) -> PartPackWriter:
        return PartPackWriter(self.options)


class DigestPack(DataSource):
    @classmethod
    def name(cls) -> str:
        return "digest_pack"

    def schema(self) -> str:
        return HEADER_SCHEMA if self.options.get("headeronly", self.options.get("headerOnly", "false")).lower() == "true" else "algo int, digest binary"

    def reader(self, schema) -> PackReader:
        return PackReader(self.options)

    def writer(self, schema, overwrite: bool) -> PackWriter:
        return PackWriter(self.options)


def read_packs(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(DigestPack)
    return spark.read.format("digest_pack").options(**options).load(path)


def write_pack(digests: DataFrame, path: str, algo: int, updated_unix: int | None = None) -> str:
    """The unique digests of one algorithm as a pack, sorted by range partitions."""
    spark = digests.sparkSession
    spark.dataSource.register(DigestPack)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = digests.filter(f"algo = {algo}").select("algo", "digest").repartitionByRange(parts, "digest").sortWithinPartitions("digest")
    ordered.write.format("digest_pack").mode("append").option("algo", algo).option("updatedUnix", updated_unix or 0).save(path)
    return path


def write_packs(digests: DataFrame, folder: str, updated_unix: int | None = None, name: str = "clean_{}.bin") -> dict[int, str]:
    """A pack for each algorithm, its algorithm's name put into ``name``; one without digests gets its header alone.
    The digests are worked out once and held, in memory or on disk, while the packs are written."""
    held = digests.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {algo: write_pack(held, f"{folder}/{name.format(kind)}", algo, updated_unix) for algo, (kind, _, _) in ALGOS.items()}
    finally:
        held.unpersist()


def write_part_packs(digests: DataFrame, folder: str, name: str, parts: range, updated_unix: int | None = None) -> None:
    """A pack for each of the ``parts`` and each algorithm of ``digests`` (part, algo, digest), unique in each part, all
    in one job. The part's number is put into ``name``, then the algorithm's name."""
    spark = digests.sparkSession
    spark.dataSource.register(DigestPartPacks)
    order = ("part", "algo", "digest")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = digests.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)
    ordered.write.format("digest_part_packs").mode("append").options(name=name, firstPart=parts.start, lastPart=parts.stop, updatedUnix=updated_unix or 0).save(folder)


def header_count(path: str, size: int | None = None) -> int:
    """The digests that the header of a file or http(s) url promises; only the header is read, so it may be of a part."""
    if path.startswith("http"):
        with request(path, Range=f"bytes=0-{HEADER_BYTES - 1}") as got:
            raw = got.read(HEADER_BYTES)
    else:
        with open(path, "rb") as f:
            raw = f.read(HEADER_BYTES)
    return parse_header(raw, size, path)[4]


def pack_count(path: str) -> int:
    """The digests of a whole pack, checked against its size."""
    return header_count(path, os.path.getsize(path))
