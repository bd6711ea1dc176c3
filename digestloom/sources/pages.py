"""Data source ``sqlite_pages``: digests straight from the leaf pages of database files, in parallel page ranges.

Rows are recognised by the shape of their last four columns: text of 8, 32, 40 and 64 bytes. Column values before them
are skipped by length. A cell that spills to overflow pages is counted as skipped, or followed with the option
``overflow`` set to ``follow``. Emits (page_no, cell_no, kind, digest): kind 1 to 3 with the raw text of the value
(validated in Catalyst), kind 0 for a skipped cell.

Runs of pages are decoded together: one numpy step reads the same byte of all their cells. Cells that this can't read
(overflow, integers of nine bytes, text that is no ASCII, pages cut off) go through the plain decoder one by one.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from digestloom.functions.digests import algo_of, to_raw

MAGIC = b"SQLite format 3\0"
#: Serial types of the last four columns: text of n bytes has type 13 + 2 n.
TAIL = [13 + 2 * n for n in (8, 32, 40, 64)]
LEAF, MAX_CELLS = 0x0D, 10_000
#: Bytes of pages that are decoded together.
RUN = 4 << 20
#: Bytes of pages that a task reads where many parts are carved together.
TASK_BYTES = 16 << 20
NAMES = ["page_no", "cell_no", "kind", "value"]
SCHEMA = "page_no long, cell_no int, kind int, value string"


class PageError(ValueError):
    """A file that is no page-structured database."""


def page_size(path: str) -> tuple[int, int]:
    """(page size, reserved bytes a page) from the file's header."""
    with open(path, "rb") as f:
        head = f.read(100)
    if len(head) < 100:
        raise PageError(f"{path}: {len(head)} bytes are no header")
    if head[:16] != MAGIC:
        raise PageError(f"{path}: not a SQLite 3 file")
    size = int.from_bytes(head[16:18], "big")
    size = 65536 if size == 1 else size
    if size < 512 or size > 65536 or size & (size - 1):
        raise PageError(f"{path}: page size {size}")
    if os.path.getsize(path) < size:
        raise PageError(f"{path}: ends inside its first page")
    return size, head[20]


def varint(data: bytes, at: int) -> tuple[int, int]:
    """(value, place after it) of a big-endian base-128 integer of one to nine bytes."""
    value = 0
    for k in range(8):
        byte = data[at + k]
        value = value << 7 | byte & 0x7F
        if byte < 0x80:
            return value, at + k + 1
    return value << 8 | data[at + 8], at + 9


def value_length(kind: int) -> int:
    if kind >= 12:
        return (kind - 12) // 2
    return (0, 1, 2, 3, 4, 6, 8, 8, 0, 0, 0, 0)[kind]


def record_tail(record: bytes) -> list[bytes] | None:
    """The last three values' bytes, if the last four columns have the known shape."""
    head, at = varint(record, 0)
    kinds = []
    while at < head:
        kind, at = varint(record, at)
        kinds.append(kind)
    if at != head or kinds[-4:] != TAIL:
        return None
    at = head + sum(map(value_length, kinds[:-3]))
    out = []
    for kind in kinds[-3:]:
        n = value_length(kind)
        if at + n > len(record):
            return None
        out.append(record[at : at + n])
        at += n
    return out


def local_bytes(size: int, usable: int) -> int:
    """Bytes of a leaf cell's payload that stay on its page."""
    if size <= usable - 35:
        return size
    least = (usable - 12) * 32 // 255 - 23
    k = least + (size - least) % (usable - 4)
    return k if k <= usable - 35 else least


def leaf_cells(page: bytes, first: bool, usable: int, chain=None, only: set[int] | None = None) -> Iterator[tuple[int, list[bytes] | None]]:
    """(cell, values or None if skipped) of a table leaf page; cells of another shape are passed over. ``only``: the
    cells that are asked for."""
    base = 100 if first else 0
    if page[base] != LEAF:
        return
    cells = int.from_bytes(page[base + 3 : base + 5], "big")
    if not 0 < cells <= MAX_CELLS:
        return
    for k in range(cells) if only is None else sorted(only):
        slot = base + 8 + 2 * k
        if slot + 2 > len(page):
            return
        at = int.from_bytes(page[slot : slot + 2], "big")
        try:
            size, at = varint(page, at)
            _, at = varint(page, at)
            here = local_bytes(size, usable)
            if here == size:
                found = record_tail(page[at : at + size]) if at + size <= len(page) else None
            elif chain is None:
                yield k, None
                continue
            else:
                found = record_tail(page[at : at + here] + chain(int.from_bytes(page[at + here : at + here + 4], "big"), size - here))
        except IndexError:
            continue
        if found:
            yield k, found


#: Bytes of the last three values, and the bytes of the last four columns' types in a record's header.
VALUES = (32, 40, 64)
TAIL_BYTES = np.frombuffer(b"".join(bytes([0x80 | k >> 7, k & 0x7F]) if k > 0x7F else bytes([k]) for k in TAIL), np.uint8)


def varints(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """varint() at many places at once, of eight bytes at most; longer ones come out with the place -1."""
    value, end = np.zeros(len(at), np.int64), np.full(len(at), -1)
    for k in range(8):
        byte = data[np.minimum(at + k, len(data) - 1)].astype(np.int64)
        value = np.where(end < 0, value << 7 | byte & 0x7F, value)
        end = np.where((end < 0) & (byte < 0x80), at + k + 1, end)
        if (end >= 0).all():
            break
    return value, end


def body_sizes(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes of the values that the types between ``at`` and ``end`` announce; -1 where a type is odd."""
    lengths = np.array([0, 1, 2, 3, 4, 6, 8, 8, 0, 0, 0, 0])
    total, place = np.zeros(len(at), np.int64), at.copy()
    open_ = np.flatnonzero(place < end)
    while len(open_):
        kind, after = varints(data, place[open_])
        text = kind >= 12
        total[open_] += np.where(text, (kind - 12) // 2, lengths[np.minimum(kind, 11)])
        odd = (after < 0) | (after > end[open_])
        total[open_[odd]] = -1 << 40
        place[open_] = np.where(odd, end[open_], after)
        open_ = open_[place[open_] < end[open_]]
    return np.where(total < 0, -1, total)


def run_cells(run: bytes, size: int, usable: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Of a run of whole pages, none of them the file's first: (page, cell) of the cells found, as arrays, their last
    three values as rows of bytes, and the (page, cell) that need the plain decoder."""
    data = np.frombuffer(run, np.uint8)
    pages = data.reshape(-1, size)
    cells = pages[:, 3].astype(np.int64) << 8 | pages[:, 4]
    leaves = np.flatnonzero((pages[:, 0] == LEAF) & (cells > 0) & (cells <= MAX_CELLS))
    counts = np.minimum(cells[leaves], (size - 8) // 2)
    page = np.repeat(leaves, counts)
    cell = np.arange(len(page)) - np.repeat(np.cumsum(counts) - counts, counts)
    slot = page * size + 8 + 2 * cell
    at = page * size + (data[slot].astype(np.int64) << 8 | data[slot + 1])
    limit = (page + 1) * size
    payload, at = varints(data, at)
    plain = at >= 0
    _, at = varints(data, np.where(plain, at, 0))
    plain &= (at >= 0) & (payload <= usable - 35) & (at + payload <= limit)
    start = np.where(plain, at, 0)
    head, types = varints(data, start)
    plain &= (types >= 0) & (head <= payload)
    # The header must end in the four types, and what stands before them must be whole.
    end, n = start + head, len(TAIL_BYTES)
    shaped = plain & (end - types >= n)
    near = np.flatnonzero(shaped)
    tail = sliding_window_view(data, n)[end[near] - n] == TAIL_BYTES
    near = near[tail.all(axis=1)]
    parted = (end[near] - n == types[near]) | (data[end[near] - n - 1] < 0x80)
    body = body_sizes(data, types[near], end[near])
    exact = parted & (body >= 0) & (head[near] + body == payload[near])
    odd, near = near[~exact], near[exact]
    values = sliding_window_view(data, sum(VALUES))[(start + payload)[near] - sum(VALUES)]
    ascii_ = (values < 0x80).all(axis=1)
    slow = np.concatenate([np.flatnonzero(~plain), odd, near[~ascii_]])
    return page[near[ascii_]], cell[near[ascii_]], values[ascii_], list(zip(page[slow].tolist(), cell[slow].tolist()))


class PageRange(InputPartition):
    def __init__(self, path: str, first: int, last: int, size: int, reserved: int) -> None:
        self.path, self.first, self.last, self.size, self.reserved = path, first, last, size, reserved


class PageReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = [p for p in options["path"].split(",") if p]
        self.pages = int(options.get("pagesPerPartition", 16384))
        self.follow = options.get("overflow", "skip") == "follow"
        self.first, self.last = int(options.get("firstPage", 0)), int(options.get("lastPage", 1 << 62))

    def partitions(self) -> list[PageRange]:
        out = []
        for path in self.paths:
            size, reserved = page_size(path)
            n = min(self.last, os.path.getsize(path) // size)
            out += [PageRange(path, k, min(n, k + self.pages), size, reserved) for k in range(self.first, n, self.pages)]
        return out

    def read(self, part: PageRange) -> Iterator[pa.RecordBatch]:
        usable, step = part.size - part.reserved, max(1, RUN // part.size)
        with open(part.path, "rb") as f, open(part.path, "rb") as aside:

            def chain(page_no: int, left: int) -> bytes:
                pieces = []
                while page_no and left > 0:
                    aside.seek((page_no - 1) * part.size)
                    page = aside.read(part.size)
                    pieces.append(page[4 : 4 + min(left, usable - 4)])
                    left -= usable - 4
                    page_no = int.from_bytes(page[:4], "big")
                return b"".join(pieces)

            def plainly(page: bytes, first: bool, only: set[int] | None = None) -> Iterator[tuple[int, int, str]]:
                for cell, values in leaf_cells(page, first, usable, chain if self.follow else None, only):
                    for kind, value in enumerate(values, 1) if values else [(0, b"")]:
                        yield cell, kind, value.decode("latin-1")

            def rows(found: list[tuple[int, int, int, str]]) -> Iterator[pa.RecordBatch]:
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (pa.int64(), pa.int32(), pa.int32(), pa.string()))], NAMES)

            at = part.first
            f.seek(at * part.size)
            if not at:
                yield from rows([(1, *x) for x in plainly(f.read(part.size), True)])
                at = 1
            while at < part.last:
                run = f.read(min(step, part.last - at) * part.size)
                page, cell, values, slow = run_cells(run, part.size, usable)
                if len(page):
                    left = 0
                    for kind, width in enumerate(VALUES, 1):
                        flat = np.ascontiguousarray(values[:, left : left + width])
                        left += width
                        offsets = pa.py_buffer((np.arange(len(page) + 1, dtype=np.int32) * width))
                        yield pa.RecordBatch.from_arrays([pa.array(page + at + 1, pa.int64()), pa.array(cell, pa.int32()), pa.array(np.full(len(page), kind), pa.int32()), pa.StringArray.from_buffers(len(page), offsets, pa.py_buffer(flat))], NAMES)
                by_page: dict[int, set[int]] = {}
                for p, c in slow:
                    by_page.setdefault(p, set()).add(c)
                yield from rows([(at + p + 1, *x) for p, only in sorted(by_page.items()) for x in plainly(run[p * part.size : (p + 1) * part.size], False, only)])
                at += step


class SqlitePages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)


def scan_pages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(SqlitePages)
    return spark.read.format("sqlite_pages").options(**options).load(path)


def page_digests(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(algo, digest) of all valid digests; an invalid one is dropped without its row's others."""
    found = scan_pages(spark, path, **options).filter("kind > 0").select(to_raw(F.col("value")).alias("digest"))
    return found.filter("digest is not null").select(algo_of(F.col("digest")).alias("algo"), "digest")


def part_digests(spark: SparkSession, path: str, first: int, last: int, step: int, number: int) -> DataFrame:
    """(part, algo, digest) of page_digests() of the pages from ``first`` up to ``last``, counted from 0, where a part
    is ``step`` pages and the first part has this ``number``."""
    run = max(1, min(16384, TASK_BYTES // page_size(path)[0]))
    found = scan_pages(spark, path, firstPage=str(first), lastPage=str(last), pagesPerPartition=str(run)).filter("kind > 0")
    found = found.select(F.expr(f"cast((page_no - 1 - {first}) div {step} + {number} as int)").alias("part"), to_raw(F.col("value")).alias("digest"))
    return found.filter("digest is not null").select("part", algo_of(F.col("digest")).alias("algo"), "digest")
