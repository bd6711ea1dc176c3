"""Exact unique digest sets, their counts and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestloom.functions.digests import algo_of, to_raw


def unpivot(rows: DataFrame, columns: tuple[str, ...] = ("md5", "sha1", "sha256")) -> DataFrame:
    """(algo, digest) of each valid hex digest in ``columns``; a row's digests are independent of one another."""
    digest = F.explode(F.array(*(to_raw(F.col(c)) for c in columns))).alias("digest")
    return rows.select(digest).filter("digest is not null").select(algo_of(F.col("digest")).alias("algo"), "digest")


def metadata_digests(rows: DataFrame) -> DataFrame:
    """unpivot() of rows whose last four columns have the shape crc32(8), md5(32), sha1(40), sha256(64)."""
    tail = rows.columns[-4:]
    shaped = F.lit(True)
    for name, width in zip(tail, (8, 32, 40, 64)):
        shaped = shaped & (F.length(name) == width)
    return unpivot(rows.filter(shaped), tuple(tail[1:]))


def exact_unique(digests: DataFrame) -> DataFrame:
    """Distinct (algo, digest): combined before the shuffle, which carries bytes, not hex."""
    return digests.select("algo", "digest").dropDuplicates(["algo", "digest"])


def byte_order(digests: DataFrame) -> DataFrame:
    """In unsigned byte order within each algorithm."""
    return digests.orderBy("algo", "digest")


def merge_parts(*parts: DataFrame) -> DataFrame:
    """Exact union of parts that are unique each on its own; no part need be sorted. A frame may hold many parts: one
    scan and one shuffle take them all."""
    out = parts[0].select("algo", "digest")
    for part in parts[1:]:
        out = out.unionByName(part.select("algo", "digest"))
    return exact_unique(out)


def first_distinct(digests: DataFrame, order: Column | str, n: int) -> DataFrame:
    """The first ``n`` distinct digests over all algorithms, by their first place in ``order``."""
    return digests.groupBy("algo", "digest").agg(F.min(order).alias("first_at")).orderBy("first_at", "algo", "digest").limit(n)


def counts(digests: DataFrame) -> DataFrame:
    """Digests of each algorithm and, with a null algo, of all."""
    return digests.rollup("algo").agg(F.count(F.lit(1)).alias("n"))


def dedup_counters(offered: DataFrame) -> DataFrame:
    """One row: offered, unique_n, dropped, drop_pct, unique_bytes. Counted from one row a digest."""
    each = offered.groupBy("algo", "digest").agg(F.count(F.lit(1)).alias("n"))
    total = each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("offered"), F.count(F.lit(1)).alias("unique_n"), F.coalesce(F.sum(F.length("digest")), F.lit(0)).cast("long").alias("unique_bytes"))
    dropped = F.col("offered") - F.col("unique_n")
    return total.select("offered", "unique_n", dropped.alias("dropped"), F.when(F.col("offered") > 0, F.round(100.0 * dropped / F.col("offered"), 6)).otherwise(0.0).alias("drop_pct"), "unique_bytes")


def known(items: DataFrame, feed: DataFrame, digest: str = "digest") -> DataFrame:
    """Rows of ``items`` whose digest is in the feed."""
    return items.join(feed.select(F.col("digest").alias(digest)), digest, "left_semi")


def unknown(items: DataFrame, feed: DataFrame, digest: str = "digest") -> DataFrame:
    """Rows of ``items`` whose digest is not in the feed, null digests included."""
    return items.join(feed.select(F.col("digest").alias(digest)), digest, "left_anti")
