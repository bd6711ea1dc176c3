"""Splitting packs and lists into parts below a size limit."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.model import ALGOS, HEADER_BYTES, WIDTH, PackFormatError

TRIES = 6


def part_name(stem: str, number: int, parts: int, ext: str) -> str:
    digits = str(number).zfill(max(2, len(str(parts))))
    return f"{stem}_part{digits}.{ext}"


def parts_needed(count: int, width: int, limit: int, kind: str = "bin") -> int:
    """How many parts hold ``count`` records: by the size rule, then doubled while the largest part is too large."""
    if kind == "bin":
        payload = count * width
        parts = max(1, math.ceil(payload / max(1, limit - HEADER_BYTES))) if payload else 1
    else:
        parts = max(1, math.ceil(count * (2 * width + 1) / limit))
    for _ in range(TRIES):
        records = max(1, math.ceil(count / parts))
        size = min(records, count) * width + HEADER_BYTES if kind == "bin" else min(records, count) * (2 * width + 1)
        if size <= limit:
            return parts
        parts *= 2
    raise PackFormatError(f"{count} records of {width} bytes don't fit parts of {limit} bytes")


def parts_sql(count: str, width: str, limit: int, kind: str) -> str:
    """parts_needed() as SQL over the columns ``count`` and ``width``; null where no number of parts will do."""
    record, head = (width, HEADER_BYTES) if kind == "bin" else (f"(2 * {width} + 1)", 0)
    first = f"greatest(1, cast(ceil({count} * {record} / {float(max(1, limit - head))}D) as bigint))"
    fits = f"least({count}, greatest(1, cast(ceil({count} / cast(p as double)) as bigint))) * {record} + {head} <= {limit}"
    return f"get(filter(transform(sequence(0, {TRIES - 1}), k -> {first} * cast(power(2, k) as bigint)), p -> {fits}), 0)"


def split_plan(digests: DataFrame, limit: int, kind: str = "bin") -> DataFrame:
    """algo, part_no, part_name, records, bytes of each part of the unique ``digests``; part 1 of a pack carries the
    header. Parts hold equal numbers of records in byte order, so the counts of the three algorithms are all it takes."""
    width, stem = F.lit(0), F.lit("")
    for algo, (name, _, w) in ALGOS.items():
        width, stem = F.when(F.col("algo") == algo, w).otherwise(width), F.when(F.col("algo") == algo, f"clean_{name}").otherwise(stem)
    totals = digests.groupBy("algo").agg(F.count(F.lit(1)).alias("n")).withColumn("width", width).withColumn("stem", stem)
    parts = totals.withColumn("parts", F.expr(parts_sql("n", "width", limit, kind)))
    refused = F.raise_error(F.format_string(f"%d records of %d bytes don't fit parts of {limit} bytes", "n", "width")).cast("long")
    parts = parts.withColumn("parts", F.coalesce("parts", refused)).withColumn("each", F.expr("cast(ceil(n / cast(parts as double)) as bigint)"))
    out = parts.withColumn("part_no", F.explode(F.expr("sequence(1, cast(ceil(n / cast(each as double)) as int))")))
    out = out.withColumn("records", F.expr("least(each, n - (part_no - 1) * each)"))
    padded = F.expr("lpad(string(part_no), greatest(2, length(string(parts))), '0')")
    name = F.when(F.col("parts") == 1, F.concat("stem", F.lit("." + kind))).otherwise(F.concat("stem", F.lit("_part"), padded, F.lit("." + kind)))
    size = F.col("records") * F.col("width") + F.when(F.col("part_no") == 1, HEADER_BYTES).otherwise(0) if kind == "bin" else F.col("records") * (2 * F.col("width") + 1)
    return out.select("algo", "part_no", name.alias("part_name"), "records", size.cast("long").alias("bytes"))


def text_parts(lengths: list[int] | Callable[[], Iterable[int]], size: int, lines: int, limit: int) -> int:
    """How many parts, of equal numbers of lines, a list of ``size`` bytes and ``lines`` lines takes below ``limit``:
    by the size, then doubled while the largest part is too large. ``lengths`` gives the lines' lengths anew each time."""
    parts = max(1, math.ceil(size / limit))
    for _ in range(TRIES):
        each, largest, current, n = max(1, math.ceil(lines / parts)), 0, 0, 0
        for length in lengths() if callable(lengths) else lengths:
            current, n = current + length, n + 1
            if n == each:
                largest, current, n = max(largest, current), 0, 0
        if max(largest, current) <= limit:
            return parts
        parts *= 2
    raise PackFormatError(f"{lines} lines of {size} bytes don't fit parts of {limit} bytes")
