"""Whole jobs: packs and parts, text lists, splitting, notes.

One file is what the formats ask for, so putting segments together, splitting and exporting copy a file once in the
driver's process; all else is distributed.
"""

from __future__ import annotations

import glob
import os
import shutil
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.functions.digests import to_hex
from digestloom.model import ALGOS, HEADER_BYTES, WIDTH, PackFormatError, pack_header, parse_header
from digestloom.operators.catalog import grouped_assets
from digestloom.operators.split import part_name, parts_needed, text_parts
from digestloom.operators.unique import exact_unique
from digestloom.sources import pages
from digestloom.sources.packs import copied, pack_count, read_packs, write_pack, write_part_packs
from digestloom.streaming.parts import PART_PACK, Uploader

#: Small parts are carved together, so many MiB of pages in one job.
TOGETHER_MIB = 256


def text_lines(digests: DataFrame) -> DataFrame:
    """``line``: lower-case hex, in byte order within each algorithm."""
    return digests.orderBy("algo", "digest").select(to_hex(F.col("digest")).alias("line"))


def combined_lines(digests: DataFrame) -> DataFrame:
    """``line``: hex of all algorithms in order of the text, so widths mix."""
    return digests.select(to_hex(F.col("digest")).alias("line")).orderBy("line")


def joined_text(lines: DataFrame, target: str, expected: int) -> int:
    """Sorted ``lines`` in one file: the parts of Spark's writer put together in order, then renamed. Returns lines."""
    folder, temporary = f"{target}.parts", f"{target}.tmp"
    lines.write.mode("overwrite").text(folder)
    with open(temporary, "wb") as out:
        for part in sorted(glob.glob(f"{folder}/part-*")):
            with open(part, "rb") as f:
                shutil.copyfileobj(f, out)
    shutil.rmtree(folder)
    n = sum(1 for _ in line_lengths(temporary))
    if n != expected:
        os.remove(temporary)
        raise PackFormatError(f"{target}: {n} lines for {expected} digests")
    os.replace(temporary, target)
    return n


def export_text(spark: SparkSession, pack: str, target: str) -> int:
    """A pack as lines of hex, in one file. Returns lines."""
    return joined_text(text_lines(read_packs(spark, pack)), target, pack_count(pack))


def export_combined(spark: SparkSession, found: list[str], target: str) -> int:
    """Packs as one list in order of the text. Returns lines."""
    return joined_text(combined_lines(read_packs(spark, ",".join(found))), target, sum(map(pack_count, found)))


def merge_part_packs(spark: SparkSession, folder: str, out: str, updated_unix: int | None = None) -> dict[int, int]:
    """part_*_<algo>.bin of each algorithm merged into clean_<algo>.bin; digests by algorithm. An algorithm without
    parts has no pack; none at all, or a broken part, is an error."""
    if not os.path.isdir(folder):
        raise PackFormatError(f"{folder}: no folder of parts")
    made = {}
    for algo, (name, _, _) in ALGOS.items():
        pattern = f"{folder}/part_*_{name}.bin"
        if glob.glob(pattern):
            made[algo] = pack_count(write_pack(exact_unique(read_packs(spark, pattern)), f"{out}/clean_{name}.bin", algo, updated_unix))
    if not made:
        raise PackFormatError(f"{folder}: no parts")
    return made


def carve_parts(spark: SparkSession, path: str, folder: str, mib: int, uploader: Uploader | None = None, updated_unix: int | None = None, progress: Callable[[int, int, int], None] | None = None) -> int:
    """A database's digests as triples of part packs, each of ``mib`` MiB of pages. Small parts are carved together, up
    to TOGETHER_MIB in one job. The pages done are noted in the folder, so a job that starts again goes on with the
    first part that was not noted as whole. ``progress`` is called with (parts, pages done, pages) for each part.
    Returns the parts there have been."""
    os.makedirs(folder, exist_ok=True)
    size, _ = pages.page_size(path)
    total, step, note = os.path.getsize(path) // size, max(1, mib * 2**20 // size), f"{folder}/pages.done"
    done = 0
    if os.path.exists(note):
        with open(note) as f:
            done = int(f.read())
    number = -(-done // step)
    together = step * max(1, TOGETHER_MIB // max(1, mib))
    for first in range(done, total, together):
        last = min(total, first + together)
        parts = range(number, number + -(-(last - first) // step))
        found = pages.part_digests(spark, path, first, last, step, number)
        write_part_packs(found.dropDuplicates(["part", "algo", "digest"]), folder, PART_PACK, parts, updated_unix)
        number = parts.stop
        with open(f"{note}.tmp", "w") as f:
            f.write(str(last))
        os.replace(f"{note}.tmp", note)
        if uploader:
            uploader.drain()
        for k in parts if progress else ():
            progress(k + 1, min(total, first + (k + 1 - parts.start) * step), total)
    return number


def split_pack(path: str, limit: int) -> list[str]:
    """A pack cut into parts below ``limit``; part 1 keeps the header with the total, so the parts put together are the
    pack again. Sizes are computed, so nothing is written twice."""
    size = os.path.getsize(path)
    with open(path, "rb") as f:
        _, _, algo, updated, count = parse_header(f.read(HEADER_BYTES), size, path)
        parts = parts_needed(count, WIDTH[algo], limit)
        if parts == 1:
            return [path]
        each, stem, out = -(-count // parts), path.removesuffix(".bin"), []
        for k, first in enumerate(range(0, count, each), 1):
            name = part_name(stem, k, parts, "bin")
            with open(name, "wb") as part:
                if k == 1:
                    part.write(pack_header(algo, updated, count))
                copied(f, part, min(each, count - first) * WIDTH[algo])
            out.append(name)
    os.remove(path)
    return out


def line_lengths(path: str) -> Iterator[int]:
    with open(path, "rb") as f:
        yield from map(len, f)


def split_text(path: str, limit: int) -> list[str]:
    """A list cut between lines into parts below ``limit`` with equal numbers of lines; put together they are the list
    again. Line lengths are read first, so nothing is written twice."""
    lines = sum(1 for _ in line_lengths(path))
    parts = text_parts(lambda: line_lengths(path), os.path.getsize(path), lines, limit)
    if parts == 1:
        return [path]
    each, stem, out = max(1, -(-lines // parts)), path.removesuffix(".txt"), []
    with open(path, "rb") as f:
        for k in range(1, -(-lines // each) + 1):
            out.append(part_name(stem, k, parts, "txt"))
            with open(out[-1], "wb") as part:
                for _, line in zip(range(each), f):
                    part.write(line)
    os.remove(path)
    return out


def published(folder: str) -> list[str]:
    """The whole packs and lists of a folder, packs first; parts of earlier runs are left out."""
    return [p for ext in ("bin", "txt") for p in sorted(glob.glob(f"{folder}/clean_*.{ext}")) if "_part" not in os.path.basename(p)]


def split_published(paths: Iterable[str], limit: int) -> dict[str, list[str]]:
    """Each file, or each published file of a folder, cut into parts; the parts by file."""
    files = [x for p in paths for x in (published(p) if os.path.isdir(p) else [p])]
    return {p: split_text(p, limit) if p.endswith(".txt") else split_pack(p, limit) for p in files}


def notes(assets: DataFrame, counts: dict[str, int] | None = None, title: str = "Digest feed") -> str:
    """Markdown of the published files: one table over all algorithms and kinds, then how parts are joined."""
    groups = grouped_assets(assets).collect()  # a row for each published kind
    rows, joins = [], []
    for algo, (name, label, _) in ALGOS.items():
        for kind, ext in (("pack", "bin"), ("list", "txt")):
            for g in (g for g in groups if (g.algo, g.ext) == (name, ext)):
                number = f"{counts[name]:,}" if counts and name in counts else ""
                rows += [f"| {label} | {kind} | {number} | `{f.name}` | {f.size:,} |" for f in g.files]
                if len(g.files) > 1:
                    joins.append(f"    cat {' '.join(f.name for f in g.files)} > clean_{name}.{ext}")
    out = [f"# {title}", "", "| Algorithm | Kind | Digests | File | Bytes |", "|---|---|---|---|---|", *rows, ""]
    if joins:
        out += ["Files in parts are joined in order:", "", *joins, ""]
    return "\n".join(out)
