"""Digests, feed lines and names as Column expressions; nothing leaves the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The longest first: an alternation takes the first that fits.
HEX = "[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}"
# Labels that may stand before a digest.
LABEL = "(?:md5:|sha1:|sha-1:|sha256:|sha-256:)?"
# Name parts of packages that are not wanted, and of those that excuse them.
UNWANTED, EXCUSES = (".apk", ".ipa", "/usr/", ".deb", ".rpm"), (".exe", ".dll", ".sys", ".msi")
WORD = r"\p{L}\p{N}_"


def strip(line: Column) -> Column:
    """Without surrounding Unicode white space."""
    return F.regexp_replace(line, r"(?U)^\s+|\s+\z", "")


def is_digest(text: Column) -> Column:
    """Lower-case hex of one of the three widths."""
    return text.rlike(rf"^(?:{HEX})\z")


def to_raw(text: Column) -> Column:
    """Hex of a known width -> bytes, else null. Case is ignored; nothing is trimmed."""
    low = F.lower(text)
    return F.when(is_digest(low), F.unhex(low))


def to_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def algo_of(digest: Column) -> Column:
    """Algorithm id by width in bytes, else null."""
    n = F.length(digest)
    return F.when(n == 16, 1).when(n == 20, 2).when(n == 32, 3).cast("int")


def shard_of(digest: Column) -> Column:
    """First byte, 0 to 255."""
    return F.conv(F.hex(F.substring(digest, 1, 1)), 16, 10).cast("int")


def whole_line_digest(line: Column) -> Column:
    """The digest that is the whole line, a label before it allowed, else null."""
    found = F.regexp_extract(F.lower(strip(line)), rf"^{LABEL}({HEX})\z", 1)
    return F.when(found != "", found)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_text_digest(line: Column) -> Column:
    """The preferred digest in a line of any form, else null: comments, headings and unwanted packages have none; the
    longest kind wins, the first of its kind."""

    def any_of(low: Column, names: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for name in names:
            out = out | F.contains(low, F.lit(name))
        return out

    def best(low: Column) -> Column:
        found = F.regexp_extract_all(low, F.lit(rf"(?<![{WORD}]){LABEL}({HEX})(?![{WORD}])"), F.lit(1))
        return bound(found, lambda x: F.coalesce(*(first(x, width) for width in (64, 40, 32))))

    def first(found: Column, width: int) -> Column:
        return F.get(F.filter(found, lambda x: F.length(x) == width), F.lit(0))

    def judged(text: Column) -> Column:
        low = F.lower(text)
        heading = F.contains(low, F.lit("filename")) & (F.contains(low, F.lit("sha")) | F.contains(low, F.lit("md5")))
        unwanted = (F.contains(text, F.lit(",")) | F.contains(text, F.lit('"'))) & any_of(low, UNWANTED) & ~any_of(low, EXCUSES)
        return F.when((text == "") | text.startswith("#") | text.startswith(";") | heading | unwanted, None).otherwise(best(low))

    return bound(strip(line), judged)


def base_name(name: Column) -> Column:
    return F.element_at(F.split(F.replace(name, F.lit("\\"), F.lit("/")), "/"), -1)


def is_modern_db(name: Column) -> Column:
    base = F.lower(base_name(name))
    return base.endswith("_modern.db") & ~F.contains(base, F.lit("minimal"))


def is_sqlite_member(name: Column) -> Column:
    return F.lower(base_name(name)).rlike(r"\.(db|sqlite|sqlite3)\z")


def modern_version(url: Column) -> Column:
    """Version in the url of a full modern archive, else null."""
    name = F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)
    found = F.regexp_extract(name, r"(?i)^RDS_(\d{4}\.\d{2}\.\d+)_modern\.zip\z", 1)
    return F.when(found != "", found)


def version_key(version: Column) -> Column:
    """Numbers of a version, in an order that compares as numbers."""
    return F.transform(F.split(version, r"\."), lambda x: x.cast("int"))


ASSET = r"^clean_(md5|sha1|sha256)(?:_part(\d+))?\.(bin|txt)\z"


def asset_parts(name: Column) -> tuple[Column, Column, Column]:
    """(algorithm name, kind, part number from 1) of a published file's name; nulls for other names."""
    algo = F.regexp_extract(name, ASSET, 1)
    part = F.regexp_extract(name, ASSET, 2)
    return F.when(algo != "", algo), F.when(algo != "", F.regexp_extract(name, ASSET, 3)), F.when(algo != "", F.when(part == "", 1).otherwise(part.cast("int")))


def human_size(size: Column) -> Column:
    """B, or KiB to GiB with one decimal, ties to even."""

    def shown(unit: str, power: int) -> Column:
        return F.format_string(f"%.1f {unit}", F.bround(size / F.lit(1024.0**power), 1))

    return F.when(size < 1024, F.format_string("%d B", size.cast("long"))).when(size < 1024**2, shown("KiB", 1)).when(size < 1024**3, shown("MiB", 2)).otherwise(shown("GiB", 3))


def bucket_capacity(workers: Column, budget_mb: Column) -> Column:
    """Digests a bucket may hold: the memory budget over workers, 256 shards and 23 bytes, within 2,000 to 50,000."""
    raw = F.floor(F.greatest(F.lit(1), budget_mb) * F.lit(1048576) / (F.greatest(F.lit(1), workers) * 256 * 23))
    return F.greatest(F.lit(2000), F.least(F.lit(50000), raw)).cast("long")
