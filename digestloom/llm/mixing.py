"""Mixing sources to target weights by systematic sampling.

Every source gets a target by weight, held to a multiple of what it has (the excess is shared again by weight). A
document's expected copies are target / source size; they are prefix-summed in order of size within the source, one
random offset is added for each source, and the document is emitted once for each integer boundary its span crosses.
In order of size, what is taken misses the target by less than about one long document. A hot source is spread over
buckets of nearly equal sizes and summed in two levels, never sorted in one task.

Defined results: a null or empty text has size 0; a source of size 0 has target 0 and gives no copies; a null source
is a source of its own, the last; repeated rows are separate rows; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from digestloom.llm.common import n_words, ranked, staged

# The weights of the contract, repeating in the order of the sources.
WEIGHTS = (5, 2, 1)
#: Rows of one source and size class are spread over so many buckets.
SPREAD = 64
SEED = "mix-1"


def size_class(size: str) -> Column:
    """Sizes within an eighth of a power of two share a class; classes grow with sizes."""
    return F.expr(f"case when {size} < 8 then {size} else (length(bin({size})) - 1) * 8 + (shiftright({size}, length(bin({size})) - 4) & 7) end")


def unit_hash(*cols: Column) -> Column:
    """32 bits of MD5, as a long: the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = 1.0, most: float = 3.0) -> DataFrame:
    """_key, _source, source_size, target of every row of ``sizes`` (_key, _source, source_size: one row a source)."""
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    table = F.array(*(F.lit(float(w)) for w in weights))
    s = sizes.withColumn("_w", F.element_at(table, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    filled = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_source").asc_nulls_last())
    before, after = filled.rowsBetween(Window.unboundedPreceding, -1), filled.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = s.withColumn("_level", (F.sum("source_size").over(whole) * F.lit(float(budget)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after))
    s = s.withColumn("_full", F.col("_cap") / F.col("_w") <= F.col("_level"))
    level = F.min(F.when(~F.col("_full"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level")))).over(whole)["_level"]
    return s.select("_key", "source_size", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_w") * level).alias("target"))


def mix_copies(docs: DataFrame, weights=WEIGHTS, budget: float = 1.0, most: float = 3.0, id_col: str = "doc_id", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """``docs`` (with a long column ``_size``) with source_size, target and _copies (how often the mix takes the row)."""
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n"))
    docs = docs.withColumn("_key", key).withColumn("_bucket", (size_class("_size") * SPREAD + unit_hash(F.lit(seed), F.col(id_col)) % SPREAD).cast("long"))
    counts = docs.groupBy("_key", "_bucket").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_sum"), F.min(source_col).alias("_source"))
    targets = source_targets(counts.groupBy("_key").agg(F.sum("_sum").alias("source_size"), F.min("_source").alias("_source")), weights, budget, most)
    # The rate and the offset travel with the bucket counts, one row for each source and bucket.
    counts = counts.select("_key", "_bucket", "_n").join(targets, "_key")
    out = ranked(docs, ["_key"], "_bucket", ["_size", id_col], counts)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = unit_hash(F.lit(seed), F.col("_key")) % 1048576 / F.lit(1048576.0)
    crossed = F.floor((F.col("rank") + 1) * rate + offset) - F.floor(F.col("rank") * rate + offset)
    return out.withColumn("_copies", crossed.cast("long")).drop("_key", "_bucket", "rank")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` as mixed: each row as often as it is taken, with its own columns only."""
    rows = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("_row"), F.col(id_col).alias("_id"), F.col("source").alias("_src"), n_words(F.col(text_col)).cast("long").alias("_size"))
    # Sizes are counted once; the sums by bucket and the ranks read them.
    out = mix_copies(staged(rows, "mix_rows"), id_col="_id", source_col="_src", **how).filter("_copies > 0")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")
