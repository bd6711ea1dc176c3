"""Command line: python -m digestloom.cli feed | merge | text | split | notes | probe. Exit 0: done, 2: failed."""

from __future__ import annotations

import argparse
import os
import subprocess
import sys
import time
import zlib
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.folders import shared_folder
from digestloom.model import ALGOS, PACK_NAMES, PackFormatError
from digestloom.operators import catalog
from digestloom.operators.unique import exact_unique, first_distinct
from digestloom.plans import feeds
from digestloom.sources import archive, pages, packs, sqltable, textfeed
from digestloom.streaming.parts import Uploader

MIB = 2**20


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="digestloom")
    sub = p.add_subparsers(dest="job", required=True)

    feed = sub.add_parser("feed", help="digests of a database, archive or text feed as packs, lists or part packs")
    feed.add_argument("source", nargs="?")
    feed.add_argument("--latest-page", help="page whose links name the archives; the newest full one is the source")
    feed.add_argument("--latest-url", help="url with {version} in it, tried version by version if the page has none")
    feed.add_argument("-o", "--out", default="clean_packs")
    feed.add_argument("--encoding", choices=["auto", "zip", "gzip", "zlib", "raw", "none"], default="auto")
    feed.add_argument("--mode", choices=["carve", "sql"], default="carve")
    feed.add_argument("--member", default=archive.MEMBER)
    feed.add_argument("--max-keep", type=int, default=0, help="only the first so many distinct digests; 0: all")
    feed.add_argument("--format", choices=["bin", "text"], default="bin")
    feed.add_argument("--parts-dir", help="write part packs here instead of whole packs (databases, mode carve)")
    feed.add_argument("--checkpoint-mib", type=int, default=1536, help="MiB of pages a part covers")
    feed.add_argument("--upload-cmd", help="command with {path}, run for each whole part, which is then deleted")
    feed.add_argument("--max-retries", type=int, default=archive.RETRIES)
    feed.add_argument("--updated-unix", type=int)

    merge = sub.add_parser("merge", help="part packs to whole packs")
    merge.add_argument("parts")
    merge.add_argument("-o", "--out", default="clean_packs")
    merge.add_argument("--updated-unix", type=int)

    text = sub.add_parser("text", help="packs, or those of a folder, as lists of hex; --combined: all in one list")
    text.add_argument("source")
    text.add_argument("target", nargs="?")
    text.add_argument("--combined", action="store_true")

    split = sub.add_parser("split", help="packs and lists, or those of a folder, in parts below a limit")
    split.add_argument("paths", nargs="+")
    split.add_argument("--limit-mib", type=float, default=1500)

    note = sub.add_parser("notes", help="markdown of the published files of a folder or a JSON list")
    note.add_argument("source")
    note.add_argument("--counts-url", help="url with {name} in it: pack headers are read there for the counts")
    note.add_argument("--title", default="Digest feed")
    note.add_argument("-o", "--out")
    note.add_argument("--publish-cmd", help="command with {path}, run with the notes' file")

    probe = sub.add_parser("probe", help="measure a download and project how long all of it takes")
    probe.add_argument("url")
    probe.add_argument("--seconds", type=float, default=45)
    for name, value in (("margin", catalog.MARGIN), ("overhead-min", catalog.OVERHEAD_MIN), ("budget-min", catalog.BUDGET_MIN)):
        probe.add_argument(f"--{name}", type=float, default=value)
    probe.add_argument("--values", help="file that key=value lines are added to")
    probe.add_argument("--summary", help="file that a markdown table is added to")
    return p


def say(text: str) -> None:
    print(text, file=sys.stderr)


def newest(a: argparse.Namespace, spark: SparkSession) -> str:
    def page() -> tuple[str, str]:
        if not a.latest_page:
            raise OSError("no page")
        with archive.request(a.latest_page) as got:
            return got.read().decode("utf-8", "replace"), a.latest_page

    today = date.today()
    versions = (r.version for r in catalog.candidate_versions(spark, today.year, today.month).toLocalIterator()) if a.latest_url else ()
    found = catalog.discover_latest(spark, page, (a.latest_url.replace("{version}", v) for v in versions), archive.url_exists)
    if not found:
        raise archive.ArchiveError("no full archive was found")
    say(f"newest: {found}")
    return found


def feed(a: argparse.Namespace, spark: SparkSession) -> None:
    source = a.source or newest(a, spark)
    kind = textfeed.guess_encoding(source, None if a.encoding == "auto" else a.encoding)
    if a.parts_dir and (a.mode != "carve" or kind != "zip" and not is_database(source)):
        raise ValueError("part packs are made of databases in mode carve")
    if kind == "zip":
        url = source if "://" in source else f"file://{os.path.abspath(source)}"
        source, kind = archive.stage_member(url, f"{shared_folder(spark)}/member.db", a.member, retries=a.max_retries), "database"
    elif is_database(source):
        kind = "database"
    if a.parts_dir:
        uploader = Uploader(a.parts_dir, a.upload_cmd) if a.upload_cmd else None
        feeds.carve_parts(spark, source, a.parts_dir, a.checkpoint_mib, uploader, a.updated_unix, lambda k, done, of: say(f"part {k}: {done} of {of} pages"))
        if uploader and (left := uploader.finish()):
            raise OSError(f"not sent: {', '.join(left)}")
        return
    if kind == "database":
        found = pages.page_digests(spark, source) if a.mode == "carve" else sqltable.table_digests(spark, source)
    else:
        found = textfeed.feed_digests(textfeed.read_lines(spark, source) if kind == "none" else textfeed.read_compressed_lines(spark, source, kind))
    if a.max_keep:
        # Places are those of the rows as the scan numbers them.
        kept = first_distinct(found.withColumn("at", F.monotonically_increasing_id()), "at", a.max_keep).select("algo", "digest")
    else:
        kept = exact_unique(found)
    write(kept, a.out, a.format, a.updated_unix)


def is_database(path: str) -> bool:
    return path.endswith((".db", ".sqlite", ".sqlite3"))


def write(digests: DataFrame, out: str, kind: str, updated_unix: int | None) -> None:
    """Packs, or lists as well, with the counts said."""
    os.makedirs(out, exist_ok=True)
    for path in packs.write_packs(digests, out, updated_unix or int(time.time())).values():
        say(f"{path}: {packs.pack_count(path)} digests")
        if kind == "text":
            feeds.export_text(digests.sparkSession, path, f"{path.removesuffix('.bin')}.txt")
            os.remove(path)


def text(a: argparse.Namespace, spark: SparkSession) -> None:
    found = [p for p in feeds.published(a.source) if p.endswith(".bin")] if os.path.isdir(a.source) else [a.source]
    if not found:
        raise PackFormatError(f"{a.source}: no packs")
    if a.combined:
        target = a.target or f"{os.path.dirname(found[0])}/combined.txt"
        print(feeds.export_combined(spark, found, target))
        return
    for path in found:
        print(feeds.export_text(spark, path, a.target if a.target and len(found) == 1 else f"{path.removesuffix('.bin')}.txt"))


def notes(a: argparse.Namespace, spark: SparkSession) -> None:
    if os.path.isdir(a.source):
        files = [(n, os.path.getsize(f"{a.source}/{n}")) for n in sorted(os.listdir(a.source))]
    else:
        with open(a.source, encoding="utf-8") as f:
            files = catalog.listed_assets(f.read())
    counts, names = {}, {n for n, _ in files}
    for algo, (name, _, _) in ALGOS.items():
        head = next((n for n in (PACK_NAMES[algo], f"clean_{name}_part01.bin", f"clean_{name}_part001.bin") if n in names), None)
        try:
            if head and (a.counts_url or os.path.isdir(a.source)):
                counts[name] = packs.header_count(a.counts_url.replace("{name}", head) if a.counts_url else f"{a.source}/{head}")
        except (*archive.BROKEN, PackFormatError) as missing:  # a count is not worth the notes
            say(f"{head}: {missing}")
    made = feeds.notes(spark.createDataFrame(files, "name string, size long"), counts, a.title)
    if not a.out:
        print(made)
        return
    with open(a.out, "w", encoding="utf-8") as f:
        f.write(made)
    if a.publish_cmd and not Uploader(os.path.dirname(a.out) or ".", a.publish_cmd).send(a.out):
        raise OSError(f"{a.out}: not published")


def probe(a: argparse.Namespace, spark: SparkSession) -> None:
    total, stream = archive.object_size(a.url), archive.ResumingStream(a.url)
    got, seconds = archive.measured(stream, a.seconds)
    stream.close()
    rate = got / MIB / seconds if seconds else 0.0
    report = catalog.projection(spark.createDataFrame([(rate,)], "mib_s double"), total, a.margin, a.overhead_min, a.budget_min).first()
    values = catalog.probe_values(report, total, rate, a.url)
    for path, made in ((a.values, catalog.key_values(values)), (a.summary, catalog.markdown_table(values, "Download probe"))):
        if path:
            with open(path, "a", encoding="utf-8") as f:
                f.write(made)
    print(catalog.key_values(values), end="")


def run(a: argparse.Namespace, spark: SparkSession) -> None:
    if a.job == "merge":
        os.makedirs(a.out, exist_ok=True)
        for algo, n in feeds.merge_part_packs(spark, a.parts, a.out, a.updated_unix).items():
            say(f"{ALGOS[algo][0]}: {n} digests")
    elif a.job == "split":
        for made in feeds.split_published(a.paths, int(a.limit_mib * MIB)).values():
            print(*made, sep="\n")
    else:
        {"feed": feed, "text": text, "notes": notes, "probe": probe}[a.job](a, spark)


def main(argv: list[str] | None = None) -> int:
    p = parser()
    a = p.parse_args(argv)
    if a.job == "feed" and not (a.source or a.latest_page or a.latest_url):
        p.error("a source, --latest-page or --latest-url is needed")
    try:
        run(a, SparkSession.builder.getOrCreate())
    except (PackFormatError, archive.ArchiveError, pages.PageError, *archive.BROKEN, ValueError, zlib.error, subprocess.SubprocessError, PySparkException) as failed:
        say(f"digestloom: {str(failed).splitlines()[0]}")
        return 2
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
