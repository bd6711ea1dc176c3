"""Text feeds: plain, gzip, zlib or raw deflate, one candidate a line."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from contextlib import closing
from itertools import islice
from typing import BinaryIO
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.functions.digests import algo_of, free_text_digest, to_raw
from digestloom.sources.archive import ResumingStream


def guess_encoding(url: str, explicit: str | None = None) -> str:
    if explicit:
        return explicit
    path = urlsplit(url).path.lower()
    return "zip" if path.endswith(".zip") else "gzip" if path.endswith((".gz", ".gzip")) else "none"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line`` of text files (gzip by name), framed by \\n alone, one trailing \\r taken off, undecodable bytes dropped."""
    line = F.regexp_replace(F.replace(F.col("value"), F.lit("�"), F.lit("")), r"\r\z", "")
    return spark.read.option("lineSep", "\n").text(path).select(line.alias("line"))


# zlib's window settings; a gzip member's first bytes.
WINDOW = {"gzip": 16 + zlib.MAX_WBITS, "zlib": zlib.MAX_WBITS, "raw": -zlib.MAX_WBITS}
GZIP_MAGIC = b"\x1f\x8b"
BLOCK, MOST, LINES_PER_BATCH = 1 << 20, 4 << 20, 20_000


def inflated(stream: BinaryIO, mode: str = "auto") -> Iterator[bytes]:
    """Blocks of all members of a gzip, zlib or raw stream, as they are read. ``auto`` tells gzip by its first bytes.
    What follows a whole member and is no member itself (padding, say) is left alone; a broken member is an error."""
    members, data = 0, stream.read(BLOCK)
    while data:
        if len(data) < 2:
            data += stream.read(BLOCK)
        kind = mode if mode != "auto" else "gzip" if data.startswith(GZIP_MAGIC) else "zlib"
        if members and (not data.strip(b"\0") or kind == "gzip" and not data.startswith(GZIP_MAGIC)):
            return
        engine, begun, out = zlib.decompressobj(WINDOW[kind]), False, b""
        while not engine.eof:
            if not data and len(out) < MOST:
                raise zlib.error("the stream ends inside a member")
            try:
                out = engine.decompress(data, MOST)
            except zlib.error:
                if members and not begun:
                    return
                raise
            if out:
                yield out
            begun = True
            data = engine.unconsumed_tail or engine.unused_data or (b"" if len(out) == MOST and not engine.eof else stream.read(BLOCK))
        members += 1


def framed(blocks: Iterator[bytes]) -> Iterator[str]:
    """Lines, as read_lines() frames them; no more than a block and a line is held."""
    rest = b""
    for block in blocks:
        *whole, rest = (rest + block).split(b"\n") if b"\n" in block else (rest + block,)
        yield from (x.decode("utf-8", "ignore").removesuffix("\r") for x in whole)
    if rest:
        yield rest.decode("utf-8", "ignore").removesuffix("\r")


def read_compressed_lines(spark: SparkSession, path: str, mode: str = "auto") -> DataFrame:
    """``line`` of compressed files, which are on a file system that all executors mount, or one http(s) url. A deflate
    stream has no restart points, so each file is one task's work; it is inflated and framed block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                stream = ResumingStream(name) if name.startswith("http") else open(unquote(urlsplit(name).path) if name.startswith("file:") else name, "rb")
                with closing(stream):
                    lines = framed(inflated(stream, mode))
                    while some := list(islice(lines, LINES_PER_BATCH)):
                        yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["line"])

    if path.startswith("http"):
        files = spark.createDataFrame([(path,)], "path string")
    else:
        files = spark.read.format("binaryFile").load(path).select("path")
    return files.mapInArrow(run, "line string")


def feed_digests(lines: DataFrame, filter_expr: Callable[[Column], Column] = free_text_digest) -> DataFrame:
    """(algo, digest) that ``filter_expr`` finds in each line; the expression is the hook for other line forms."""
    # Through explode the expression is worked out once; a filter on it would work it out again.
    found = F.filter(F.array(filter_expr(F.col("line"))), lambda x: x.isNotNull())
    hexed = lines.select(F.explode(found).alias("hex"))
    return hexed.select(to_raw(F.col("hex")).alias("digest")).select(algo_of(F.col("digest")).alias("algo"), "digest")
