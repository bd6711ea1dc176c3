"""What the corpus operators share: words, staged tables and distributed ranks."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The ASCII white space between words.
BLANKS = " \t\n\x0b\x0c\r"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where that is unset (tests), a new temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="digestloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_OPEN = threading.local()


def _scratches() -> list[list[str]]:
    if not hasattr(_OPEN, "made"):
        _OPEN.made = []
    return _OPEN.made


def _hadoop_path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside go at the end, but for those staged with ``keep``: these belong to the scratch around it."""
    made: list[str] = []
    _scratches().append(made)
    try:
        yield
    finally:
        _scratches().pop()
        for folder in made:
            files, path = _hadoop_path(spark, folder)
            files.delete(path, True)


def staged(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: lineage is cut, lost executors lose nothing. The
    table goes with the scratch it belongs to, or when the driver's JVM ends, as results may be read until then."""
    spark = df.sparkSession
    folder = f"{shared_root(spark)}/digestloom-{uuid.uuid4().hex}"
    path = f"{folder}/{name}"
    df.write.parquet(path)
    files, at = _hadoop_path(spark, folder)
    files.deleteOnExit(at)
    around = _scratches()[: -1 if keep else None]
    if around:
        around[-1].append(folder)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """The number of words, null: 0."""
    spaced = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    return F.when(F.coalesce(spaced, F.lit("")) == "", 0).otherwise(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1)


def ranked(df: DataFrame, keys: list[str], bucket: str, order: list[Column | str], counts: DataFrame | None = None, rank: str = "rank") -> DataFrame:
    """``df`` with each row's 0-based rank within ``keys`` by (bucket, order).

    No key is ever sorted in one task: rows are ranked inside (keys, bucket) and shifted by prefix sums over the
    aggregated bucket counts. A key's work is spread over its buckets, so buckets must be many and even.
    """
    counts = counts if counts is not None else df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*keys, bucket).orderBy(*order)).cast("long") - 1
    return df.withColumn("_inside", inside).join(offsets, [*keys, bucket]).withColumn(rank, F.col("_before") + F.col("_inside")).drop("_before", "_inside")
