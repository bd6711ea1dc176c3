"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Keys hash to a fixed number of ring places; each shard owns ``VNODES`` points of the ring. A place's rows go to the
next shard clockwise; what a full shard can't take continues clockwise to the next one with room. Capacities are
rows / shards, the rest one each, so shards differ by one row at most. Only the places' counts (at most ``PLACES``
rows, whatever the input) are walked; rows are then ranked within their place, in two levels, and find their shard in
the plan's intervals. All steps are DataFrame functions.

The key of a document is the hash of its text: a group of equal texts has one place and stays together as far as the
law allows, that is but for the shard limits inside it. A hot place is spread over ``SPREAD`` buckets of rows, so no
task ranks it alone.

Defined results: a null text has no bytes and checksum 0, and one key with the empty text; repeated rows are separate
rows with slots of their own; rows without id stand after those with one in their bucket, which of them has which slot
is open; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from digestloom.llm.common import ranked, staged

PLACES, VNODES = 4096, 16
#: A place is ranked in so many buckets: by text, and by id within a text.
SPREAD = 64
PIECES = "array<struct<place:int,first:bigint,last:bigint,shard:int>>"


def place_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PLACES)).cast("int")


def ring(shards: int) -> Column:
    """The shards' points in order of place, as an array of (place, shard)."""
    point = f"struct(cast(pmod(xxhash64('vnode', i), {PLACES}) as int) as place, cast(i div {VNODES} as int) as shard)"
    return F.expr(f"array_sort(transform(sequence(0, {shards * VNODES - 1}), i -> {point}))")


def plan_shards(counts: DataFrame, shards: int) -> DataFrame:
    """place, first, last (ranks within the place, last excluded), shard, slot (of rank ``first``) for ``counts`` of
    (place, n). At most PLACES + 2 * shards rows."""
    places = counts.agg(F.sort_array(F.collect_list(F.struct("place", "n"))).alias("places"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    one = places.withColumn("ring", ring(shards))  # one row
    # b: a place; p: a point clockwise of it. What is left of the place's rows moves on past shards without room.
    # Accumulators are copied at each step, so the inner one holds only the place's own pieces.
    take = "least(x.left, x.room[p.shard])"
    walk = f"""aggregate(concat(filter(ring, q -> q.place >= b.place), filter(ring, q -> q.place < b.place)),
        struct(a.room as room, b.n as left, cast(array() as {PIECES}) as made),
        (x, p) -> if(x.left = 0 or x.room[p.shard] = 0, x, struct(
            transform(x.room, (v, i) -> if(i = p.shard, v - {take}, v)) as room, x.left - {take} as left,
            concat(x.made, array(struct(b.place as place, b.n - x.left as first, b.n - x.left + {take} as last, p.shard as shard))) as made)))"""
    start = f"struct(transform(sequence(0, {shards - 1}), s -> total div {shards} + if(s < total % {shards}, 1, 0)) as room, cast(array() as {PIECES}) as made)"
    made = f"aggregate(places, {start}, (a, b) -> transform(array({walk}), w -> struct(w.room as room, concat(a.made, w.made) as made))[0], a -> a.made)"
    pieces = one.select(F.explode(F.expr(made)).alias("x")).select("x.*")
    before = Window.partitionBy("shard").orderBy("place", "first").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn("slot", F.coalesce(F.sum(F.col("last") - F.col("first")).over(before), F.lit(0)))


def shard_rows(rows: DataFrame, key: str, order: list[str], shards: int) -> DataFrame:
    """``rows`` (staged) with shard and slot (gapless from 0 within the shard). Rows of a place stand in the order of
    their keys' hashes, so that those of one key stand together, then by a hash of ``order``."""
    salt = F.pmod(F.xxhash64(F.lit(SPREAD), *order), F.lit(SPREAD))
    text = F.pmod(F.xxhash64(F.lit(SPREAD), key), F.lit(SPREAD))
    rows = rows.withColumn("place", place_of(F.col(key))).withColumn("_bucket", (text * SPREAD + salt).cast("int"))
    counts = rows.groupBy("place", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    plan = plan_shards(counts.groupBy("place").agg(F.sum("_n").alias("n")), shards)
    numbered = ranked(rows, ["place"], "_bucket", [F.col(c).asc_nulls_last() for c in order], counts, "_rank")
    # The plan has PLACES + 2 * shards rows at most, so broadcasting it is safe at any size of the input.
    met = numbered.alias("r").join(F.broadcast(plan).alias("p"), F.expr("r.place = p.place and r._rank >= p.first and r._rank < p.last"))
    return met.select(*(F.col(f"r.{c}") for c in rows.columns if c not in ("place", "_bucket")), F.col("p.shard"), (F.col("p.slot") + F.col("r._rank") - F.col("p.first")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 40, overhead: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("_key"))
    # Rows alike in all of these, as rows without id may be, are told apart by where they were read.
    rows = staged(rows.withColumn("_row", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())), "sizes")
    out = shard_rows(rows, "_key", ["doc_id", "_row", "_key"], shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
