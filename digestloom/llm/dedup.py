"""Exact duplicates: 128-bit content hash, smallest stable id, bytes compared inside groups.

Texts are shuffled once, after copies have collapsed map-side, by (hash, text): rows that share the hash but not the
bytes stay apart, so a collision never merges texts. The many rows of a hot group meet again only in a join of
(id, hash) rows with one row a group, which Spark can split.

Defined results: a null text counts as empty, so nulls and empty texts are copies of one another; equal ids are kept
apart as rows but share ``keep_id``; a null id loses against any other, and ``keep_id`` is null only where all ids of a
group are, so that its rows are kept; the input's other columns, whatever their names, are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestloom.llm.common import staged


def content_hash(text: Column) -> Column:
    """128 bits of content hash, as 16 bytes."""
    return F.unhex(F.md5(text))


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", hasher=content_hash) -> DataFrame:
    """One row for each distinct text: _hash, _sha (SHA-256), keep_id, group_size, compared byte for byte."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    pick = F.min if keep == "min" else F.max
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).select("_id", "_text", hasher(F.col("_text")).alias("_hash"))
    groups = rows.groupBy("_hash", "_text").agg(pick("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return groups.select("_hash", F.unhex(F.sha2("_text", 256)).alias("_sha"), "keep_id", "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", hasher=content_hash) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256. ``keep``: whether the smallest or the largest
    id of equal texts stays. Of rows with the same id and text each is marked as its group's id decides."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    groups = staged(copy_groups(docs, id_col, text_col, keep, hasher), "copy_groups")
    rows = docs.select(F.col(id_col), hasher(text).alias("_hash"), F.unhex(F.sha2(text, 256)).alias("_sha"))
    return rows.join(groups, ["_hash", "_sha"]).select(
        id_col, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with, of each group of equal texts, one row only: that of the smallest id (one without id
    only if none has one). Texts travel once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.struct(*(F.col(c) for c in docs.columns if c != text_col), F.col(text_col).isNull().alias("_null"))
    packed = docs.select(content_hash(text).alias("_hash"), text.alias("_text"), F.col(id_col).alias("_id"), row.alias("_row"))
    first = packed.groupBy("_hash", "_text").agg(F.min_by("_row", F.struct(F.col("_id").isNull().alias("n"), "_id", F.xxhash64("_row").alias("h"))).alias("_row"))
    kept_text = F.when(~F.col("_row._null"), F.col("_text"))
    return first.select(*(kept_text.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns))
