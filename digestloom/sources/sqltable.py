"""Data source ``sqlite_digests``: digest columns of a database read by SQL, in row-id ranges."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from digestloom.functions.digests import algo_of, to_raw, whole_line_digest

# Tables and columns looked for, in order.
TABLES, COLUMNS = ("file", "metadata"), ("sha256", "sha1", "md5")


def resolve(path: str) -> tuple[str, list[str]]:
    """(table or view, its digest columns): the first of TABLES that has any of COLUMNS."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        names = {n.lower(): n for (n,) in db.execute("select name from sqlite_master where type in ('table', 'view')")}
        for wanted in TABLES:
            if wanted in names:
                have = {row[1].lower(): row[1] for row in db.execute(f'pragma table_info("{names[wanted]}")')}
                if found := [have[c] for c in COLUMNS if c in have]:
                    return names[wanted], found
    raise ValueError(f"{path}: no table of {TABLES} with a column of {COLUMNS}")


class RowRange(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        self.first, self.last = first, last


class TableReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.parts = options["path"], int(options.get("partitions", 8))
        self.table, self.columns = resolve(self.path)

    def partitions(self) -> list[RowRange]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            try:
                low, high = db.execute(f'select min(rowid), max(rowid) from "{self.table}"').fetchone()
            except sqlite3.OperationalError:  # a view has no row ids
                return [RowRange(0, -1)]
        if low is None:
            return []
        step = max(1, -(-(high - low + 1) // self.parts))
        return [RowRange(k, min(high, k + step - 1)) for k in range(low, high + 1, step)]

    def read(self, part: RowRange) -> Iterator[tuple[str]]:
        where = "" if part.last < part.first else f" and rowid between {part.first} and {part.last}"
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            for column in self.columns:
                yield from db.execute(f"select distinct \"{column}\" from \"{self.table}\" where \"{column}\" is not null and trim(\"{column}\") != ''{where}")


class SqliteDigests(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_digests"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> TableReader:
        return TableReader(self.options)


def table_digests(spark: SparkSession, path: str, partitions: int = 8) -> DataFrame:
    """(algo, digest) of the table's digest columns, each value a whole-line digest."""
    spark.dataSource.register(SqliteDigests)
    rows = spark.read.format("sqlite_digests").option("partitions", partitions).load(path)
    hexed = rows.select(to_raw(whole_line_digest(F.col("value"))).alias("digest")).filter("digest is not null")
    return hexed.select(algo_of(F.col("digest")).alias("algo"), "digest")
