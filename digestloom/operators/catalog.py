"""Versions, published assets and throughput: the small reports around a feed."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterable
from urllib.parse import urljoin

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from digestloom.functions.digests import asset_parts, human_size, modern_version, version_key

# A release comes in these months, with revisions up to nine.
MONTHS, REVISIONS = (12, 9, 6, 3), 9
# Minutes, share of the measured rate that is relied on, and minutes allowed.
OVERHEAD_MIN, MARGIN, BUDGET_MIN = 20.0, 0.80, 360.0


def candidate_versions(spark: SparkSession, year: int, month: int, years_back: int = 5) -> DataFrame:
    """version, newest first by ``place`` (from 0)."""
    v = spark.range(1).select(F.explode(F.sequence(F.lit(year), F.lit(year - years_back), F.lit(-1))).alias("y"))
    v = v.select("y", F.explode(F.array(*map(F.lit, MONTHS))).alias("m")).select("y", "m", F.explode(F.sequence(F.lit(REVISIONS), F.lit(1), F.lit(-1))).alias("r"))
    v = v.filter((F.col("y") != year) | (F.col("m") <= month))
    return v.select(F.format_string("%d.%02d.%d", "y", "m", "r").alias("version"), "y", "m", "r").orderBy(F.desc("y"), F.desc("m"), F.desc("r")).select("version")


def first_existing(candidates: Iterable[str], exists: Callable[[str], bool]) -> str | None:
    """The first candidate that ``exists`` accepts."""
    return next((c for c in candidates if exists(c)), None)


def latest_version(urls: DataFrame) -> DataFrame:
    """One row (version, url): the greatest version by number among full modern archives."""
    found = urls.select("url", modern_version(F.col("url")).alias("version")).filter("version is not null")
    return found.agg(F.max_by("version", F.struct(version_key(F.col("version")), "url")).alias("version"), F.max_by("url", F.struct(version_key(F.col("version")), "url")).alias("url"))


def page_links(page: str, base: str) -> list[str]:
    """The links of a page, made absolute, in page order."""
    return [urljoin(base, html.unescape(a or b)) for a, b in re.findall(r"""href\s*=\s*(?:"([^"]*)"|'([^']*)')""", page, re.I)]


def discover_latest(spark: SparkSession, read_page: Callable[[], tuple[str, str]], candidates: Iterable[str], exists: Callable[[str], bool]) -> str | None:
    """The url of the newest full modern archive: the greatest version among the links of a page (``read_page`` gives
    its text and address), or, if the page fails or has none, the first of ``candidates`` that exists."""
    try:
        links = page_links(*read_page())
    except (OSError, ValueError):
        links = []
    found = latest_version(spark.createDataFrame([(x,) for x in links], "url string")).first() if links else None
    return found.url if found and found.url else first_existing(candidates, exists)


def listed_assets(text: str) -> list[tuple[str, int]]:
    """(name, size) of a JSON list of files, or of an object that has one as ``assets``; sizes may be missing."""
    found = json.loads(text)
    return [(x["name"], int(x.get("size") or 0)) for x in (found.get("assets", []) if isinstance(found, dict) else found)]


def asset_inventory(assets: DataFrame) -> DataFrame:
    """name, size, algo, ext, part, human of files with a published name."""
    algo, ext, part = asset_parts(F.col("name"))
    return assets.select("name", "size", algo.alias("algo"), ext.alias("ext"), part.alias("part"), human_size(F.col("size")).alias("human")).filter("algo is not null")


def grouped_assets(assets: DataFrame) -> DataFrame:
    """algo, ext and the files of each in order of name."""
    return asset_inventory(assets).groupBy("algo", "ext").agg(F.sort_array(F.collect_list(F.struct("name", "size", "part"))).alias("files"))


def throughput(samples: DataFrame, bytes_col: str, at_col: str) -> DataFrame:
    """One row: total bytes, elapsed seconds and MiB a second of samples with a time each."""
    s = samples.agg(F.sum(bytes_col).alias("bytes"), (F.max(F.unix_micros(at_col)) - F.min(F.unix_micros(at_col))).alias("us"))
    seconds = F.col("us") / 1e6
    return s.select("bytes", seconds.alias("elapsed_s"), F.when(seconds > 0, F.col("bytes") / F.lit(1048576.0) / seconds).otherwise(0.0).alias("mib_s"))


def projection(sample: DataFrame, total_bytes: int, margin: float = MARGIN, overhead_min: float = OVERHEAD_MIN, budget_min: float = BUDGET_MIN) -> DataFrame:
    """``sample`` (mib_s) with the reliable rate, minutes to download and in all, and whether they fit the budget."""
    reliable = F.col("mib_s") * margin
    minutes = F.when(reliable > 0, F.lit(total_bytes / 1048576.0) / reliable / 60.0).otherwise(F.lit(float("inf")))
    return sample.select(reliable.alias("reliable_mib_s"), minutes.alias("download_min"), (minutes + overhead_min).alias("total_min"), (minutes + overhead_min <= budget_min).alias("will_fit"))


def probe_values(report: Row, total_bytes: int, measured_mib_s: float, url: str) -> dict[str, str]:
    """What a probe found, rounded for reading, as text by key."""
    shown = lambda x, digits: "inf" if x == float("inf") else f"{round(x, digits)}"
    return {
        "will_fit": str(bool(report.will_fit)).lower(), "measured_mib_s": shown(measured_mib_s, 2), "reliable_mib_s": shown(report.reliable_mib_s, 2),
        "download_min": shown(report.download_min, 1), "projected_total_minutes": shown(report.total_min, 1), "total_gib": shown(total_bytes / 2**30, 2), "zip_url": url,
    }


def key_values(values: dict[str, str]) -> str:
    return "".join(f"{k}={v}\n" for k, v in values.items())


def markdown_table(values: dict[str, str], title: str) -> str:
    return "\n".join([f"## {title}", "", "| What | Value |", "|---|---|", *(f"| {k.replace('_', ' ')} | {v} |" for k, v in values.items()), "", ""])
