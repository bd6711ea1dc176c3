"""The registered queries over the supplied tables, and their SQL for DuckDB."""

from __future__ import annotations

import gzip
import os
import sqlite3
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.folders import shared_folder
from digestloom.functions import digests as fn
from digestloom.model import ALGOS, HEADER_BYTES, WIDTH
from digestloom.operators import catalog, split, unique
from digestloom.plans import feeds
from digestloom.sources import archive, packs, pages, sqltable, textfeed
from digestloom.streaming import parts as streaming

PARTS, FIRST, UPDATED = 7, 100, 1_700_000_000
#: Split limits small enough that the test tables make several parts.
LIMIT_BIN, LIMIT_TXT, LIMIT_DOUBLING = 4096, 8192, 100
#: Members of the test feed.
MEMBERS = 5


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, md5, sha1, sha256 of every document."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select("doc_id", F.md5("text").alias("md5"), F.sha1("text").alias("sha1"), F.sha2("text", 256).alias("sha256"))


def offered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique.unpivot(documents(spark, sf_dir))


def shown(d: DataFrame) -> DataFrame:
    return d.select("algo", fn.to_hex(F.col("digest")).alias("digest"))


def of_algo(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return unique.exact_unique(unique.unpivot(documents(spark, sf_dir), (name,))).select(fn.to_hex(F.col("digest")).alias("digest"))

    return query


def unique_all_algos(spark, sf_dir):
    return shown(unique.exact_unique(offered(spark, sf_dir)))


def counts_per_algo(spark, sf_dir):
    return unique.counts(unique.exact_unique(offered(spark, sf_dir)))


def dedup_counters(spark, sf_dir):
    return unique.dedup_counters(offered(spark, sf_dir))


def shard_histogram(spark, sf_dir):
    d = unique.exact_unique(offered(spark, sf_dir))
    return d.groupBy("algo", fn.shard_of(F.col("digest")).alias("shard")).agg(F.count(F.lit(1)).alias("n"))


def with_parts(spark, sf_dir):
    d = documents(spark, sf_dir)
    digest = F.explode(F.array(*(fn.to_raw(F.col(c)) for c in ("md5", "sha1", "sha256")))).alias("digest")
    d = d.select((F.col("doc_id") % PARTS).cast("int").alias("part"), digest)
    return d.select("part", fn.algo_of(F.col("digest")).alias("algo"), "digest").dropDuplicates()


def merge_parts_unique(spark, sf_dir):
    return shown(unique.merge_parts(with_parts(spark, sf_dir)))


def part_counts(spark, sf_dir):
    return with_parts(spark, sf_dir).groupBy("part", "algo").agg(F.count(F.lit(1)).alias("n"))


def first_n_distinct(spark, sf_dir):
    d = documents(spark, sf_dir)
    rows = d.select("doc_id", F.explode(F.array(*(fn.to_raw(F.col(c)) for c in ("md5", "sha1", "sha256")))).alias("digest"))
    rows = rows.select(fn.algo_of(F.col("digest")).alias("algo"), "digest", (F.col("doc_id") * 4 + fn.algo_of(F.col("digest"))).alias("at"))
    return unique.first_distinct(rows, "at", FIRST).select("algo", fn.to_hex(F.col("digest")).alias("digest"), "first_at")


def lines(spark, sf_dir):
    """doc_id, line: feed lines of several forms."""
    forms = (
        "case doc_id % 8 when 0 then md5 when 1 then concat('\"', sha1, '\",\"', md5, '\",\"00000000\",\"app.apk\"') when 2 then concat('# ', md5)"
        " when 3 then concat(sha256, ',', sha1, ',', md5) when 4 then concat('  MD5:', upper(md5), ' ') when 5 then concat('\"', sha1, '\",\"x.apk.exe\"')"
        " when 6 then concat('filename sha ', md5) else concat('x', md5, ' ', sha1) end"
    )
    return documents(spark, sf_dir).select("doc_id", F.expr(forms).alias("line"))


LINES = """(select doc_id, case doc_id % 8 when 0 then m when 1 then '"' || s || '","' || m || '","00000000","app.apk"' when 2 then '# ' || m
 when 3 then h || ',' || s || ',' || m when 4 then '  MD5:' || upper(m) || ' ' when 5 then '"' || s || '","x.apk.exe"'
 when 6 then 'filename sha ' || m else 'x' || m || ' ' || s end as line
 from (select doc_id, md5(text) m, sha1(text) s, sha256(text) h from documents))"""


def present(value: Column) -> Column:
    """One row where there is a value, none where it is null; the value is worked out once."""
    return F.explode(F.filter(F.array(value), lambda x: x.isNotNull()))


def text_default_filter(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", present(fn.free_text_digest(F.col("line"))).alias("hex"))


def text_digest_only(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", present(fn.whole_line_digest(F.col("line"))).alias("hex"))


def hex_validate(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.expr("case doc_id % 6 when 0 then md5 when 1 then upper(sha1) when 2 then sha256 when 3 then concat(md5, 'x') when 4 then concat(' ', md5) else 'zz' end").alias("value"))
    return d.select("doc_id", "value", fn.algo_of(fn.to_raw(F.col("value"))).alias("algo"))


def metadata(spark, sf_dir):
    """Rows of a source table's shape: decoy hashes in front, every eleventh row with a broken tail."""
    d = documents(spark, sf_dir)
    return d.select(
        "doc_id", F.col("sha256").alias("key_hash"), F.concat(F.lit("/src/"), F.col("md5")).alias("path"),
        F.when(F.col("doc_id") % 11 == 0, "123").otherwise("00000000").alias("crc32"), F.when(F.col("doc_id") % 13 == 0, F.repeat(F.lit("z"), F.lit(32))).otherwise(F.upper("md5")).alias("md5"), "sha1", "sha256",
    )


def row_shape_filter(spark, sf_dir):
    return shown(unique.exact_unique(unique.metadata_digests(metadata(spark, sf_dir))))


def fixture_db(spark, sf_dir) -> str:
    """A database file with the documents' digests: an input for the scans, made with the standard library."""
    path = f"{shared_folder(spark)}/source.db"
    with sqlite3.connect(path) as db:
        db.execute("create table METADATA (id integer, path text, crc32 text not null, md5 text not null, sha1 text not null, sha256 text not null)")
        rows = documents(spark, sf_dir).toLocalIterator()
        db.executemany("insert into METADATA values (?, ?, '00000000', ?, ?, ?)", ((r.doc_id, f"/src/{r.sha256}/{r.doc_id}", r.md5.upper(), r.sha1, r.sha256) for r in rows))
        db.execute("create index by_md5 on METADATA (md5)")
    return path


def sqlite_page_scan(spark, sf_dir):
    return shown(unique.exact_unique(pages.page_digests(spark, fixture_db(spark, sf_dir), pagesPerPartition="16")))


def sqlite_sql_scan(spark, sf_dir):
    return shown(unique.exact_unique(sqltable.table_digests(spark, fixture_db(spark, sf_dir))))


def zip_member_scan(spark, sf_dir):
    folder = shared_folder(spark)
    with zipfile.ZipFile(f"{folder}/a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("RDS_1_modern/readme.txt", "x" * 5000)
        z.write(fixture_db(spark, sf_dir), "RDS_1_modern/RDS_1_modern.db")
    return shown(unique.exact_unique(pages.page_digests(spark, archive.stage_member(f"file://{folder}/a.zip", f"{folder}/member.db"))))


def gzip_text_feed(spark, sf_dir):
    path = f"{shared_folder(spark)}/feed.txt.gz"
    with gzip.open(path, "wt", encoding="utf-8", newline="") as f:
        for r in lines(spark, sf_dir).toLocalIterator():
            f.write(r.line + "\r\n")
    return shown(unique.exact_unique(textfeed.feed_digests(textfeed.read_lines(spark, path))))


def gzip_members_feed(spark, sf_dir):
    """A feed of several gzip members, lines cut at their borders, read block by block."""
    path, text = f"{shared_folder(spark)}/feed.gz", b"".join(r.line.encode() + b"\n" for r in lines(spark, sf_dir).toLocalIterator())
    step = max(1, len(text) // MEMBERS)
    with open(path, "wb") as f:
        for k in range(0, len(text), step):
            f.write(gzip.compress(text[k : k + step]))
    return shown(unique.exact_unique(textfeed.feed_digests(textfeed.read_compressed_lines(spark, path))))


def made_packs(spark, sf_dir) -> str:
    folder = shared_folder(spark)
    packs.write_packs(unique.exact_unique(offered(spark, sf_dir)), folder, UPDATED)
    return folder


def pack_roundtrip(spark, sf_dir):
    return shown(packs.read_packs(spark, f"{made_packs(spark, sf_dir)}/clean_*.bin"))


def pack_header(spark, sf_dir):
    return packs.read_packs(spark, f"{made_packs(spark, sf_dir)}/clean_*.bin", headerOnly="true")


def export_text_lines(spark, sf_dir):
    folder = made_packs(spark, sf_dir)
    feeds.export_text(spark, f"{folder}/clean_sha1.bin", f"{folder}/clean_sha1.txt")
    return spark.read.text(f"{folder}/clean_sha1.txt").select(F.col("value").alias("line"))


def combined_text(spark, sf_dir):
    return feeds.combined_lines(unique.exact_unique(offered(spark, sf_dir)))


def split_plan_bin(spark, sf_dir):
    return split.split_plan(unique.exact_unique(offered(spark, sf_dir)), LIMIT_BIN)


def split_plan_txt(spark, sf_dir):
    return split.split_plan(unique.exact_unique(offered(spark, sf_dir)), LIMIT_TXT, "txt")


def split_plan_doubling(spark, sf_dir):
    """At this limit the size rule's parts are too large by the header, so their number is doubled."""
    return split.split_plan(unique.exact_unique(offered(spark, sf_dir)), LIMIT_DOUBLING)


def split_text_identity(spark, sf_dir):
    folder = made_packs(spark, sf_dir)
    feeds.export_text(spark, f"{folder}/clean_sha256.bin", f"{folder}/clean_sha256.txt")
    (names,) = feeds.split_published([f"{folder}/clean_sha256.txt"], LIMIT_TXT).values()
    return spark.read.text(names).select(F.input_file_name().alias("file"), F.col("value").alias("line")).select(F.regexp_extract("file", r"([^/]*)$", 1).alias("part_name"), "line")


def split_concat_identity(spark, sf_dir):
    folder = made_packs(spark, sf_dir)
    names = feeds.split_pack(f"{folder}/clean_md5.bin", LIMIT_BIN)
    with open(f"{folder}/whole.bin", "wb") as out:
        for name in names:
            with open(name, "rb") as f:
                out.write(f.read())
    return shown(packs.read_packs(spark, f"{folder}/whole.bin"))


def candidate_versions(spark, sf_dir):
    return catalog.candidate_versions(spark, 2025, 7)


def version_urls(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kind = "case doc_id % 4 when 0 then '_modern.zip' when 1 then '_modern_minimal.zip' when 2 then '_delta.zip' else '_modern.zip' end"
    return d.select(F.expr(f"concat('https://host.example/RDS_', cast(2020 + doc_id % 5 as string), '.', lpad(cast(3 * (1 + doc_id % 4) as string), 2, '0'), '.', cast(1 + doc_id % 12 as string), {kind})").alias("url"))


def latest_version(spark, sf_dir):
    return catalog.latest_version(version_urls(spark, sf_dir))


def asset_inventory(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name = "case doc_id % 5 when 0 then 'clean_md5.bin' when 1 then concat('clean_sha1_part', lpad(cast(doc_id % 90 as string), 2, '0'), '.bin') when 2 then concat('clean_sha256_part', lpad(cast(doc_id % 90 as string), 2, '0'), '.txt') when 3 then 'notes.md' else 'clean_sha512.bin' end"
    return catalog.asset_inventory(d.select(F.expr(name).alias("name"), (F.col("n_chars") * F.col("doc_id") * 3).alias("size")))


def throughput_projection(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") * 1000 + 1).alias("n"))
    sample = catalog.throughput(e, "n", "ts")
    out = catalog.projection(sample, 123 * 2**30)
    return out.select(*(F.round(c, 6).alias(c) for c in ("reliable_mib_s", "download_min", "total_min")), "will_fit")


def bucket_capacity(spark, sf_dir):
    grid = spark.range(1, 65).select(F.col("id").alias("workers"), F.explode(F.array(*(F.lit(n).cast("long") for n in (1, 64, 256, 2048, 16384)))).alias("budget_mb"))
    return grid.withColumn("capacity", fn.bucket_capacity(F.col("workers"), F.col("budget_mb")))


def membership(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", fn.to_raw(F.col("md5")).alias("digest"))
    return d, unique.exact_unique(d.filter("doc_id % 2 = 0").withColumn("algo", F.lit(1)))


def known_documents(spark, sf_dir):
    d, feed = membership(spark, sf_dir)
    return unique.known(d, feed).select("doc_id")


def unknown_documents(spark, sf_dir):
    d, feed = membership(spark, sf_dir)
    return unique.unknown(d, feed).select("doc_id")


def offered_stream(spark, sf_dir, folder: str) -> DataFrame:
    offered(spark, sf_dir).repartition(3).write.parquet(f"{folder}/in")
    return spark.readStream.schema("algo int, digest binary").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def part_pack_merge(spark, sf_dir):
    """A stream's part packs merged into whole packs, read again."""
    folder = shared_folder(spark)
    streaming.write_part_packs(offered_stream(spark, sf_dir, folder), f"{folder}/parts", f"{folder}/checkpoint", updated_unix=UPDATED).awaitTermination()
    feeds.merge_part_packs(spark, f"{folder}/parts", folder, UPDATED)
    return shown(packs.read_packs(spark, f"{folder}/clean_*.bin"))


def carve_part_packs(spark, sf_dir):
    """A database carved into part packs, merged and read again."""
    folder, path = shared_folder(spark), fixture_db(spark, sf_dir)
    feeds.carve_parts(spark, path, f"{folder}/parts", 1, updated_unix=UPDATED)
    feeds.merge_part_packs(spark, f"{folder}/parts", folder, UPDATED)
    return shown(packs.read_packs(spark, f"{folder}/clean_*.bin"))


def stream_parts(spark, sf_dir):
    folder = shared_folder(spark)
    stream = offered_stream(spark, sf_dir, folder)
    streaming.write_parts(stream, f"{folder}/parts", f"{folder}/checkpoint").awaitTermination()
    return shown(streaming.merged_parts(spark, f"{folder}/parts"))


QUERIES = {f"unique_{n}_docs": of_algo(n) for n in ("md5", "sha1", "sha256")} | {
    f.__name__: f
    for f in (
        unique_all_algos, counts_per_algo, dedup_counters, shard_histogram, merge_parts_unique, part_counts, first_n_distinct, text_default_filter,
        text_digest_only, hex_validate, row_shape_filter, sqlite_page_scan, sqlite_sql_scan, zip_member_scan, gzip_text_feed, gzip_members_feed, pack_roundtrip, pack_header,
        export_text_lines, combined_text, split_plan_bin, split_plan_txt, split_plan_doubling, split_concat_identity, split_text_identity, candidate_versions, latest_version, asset_inventory,
        throughput_projection, bucket_capacity, known_documents, unknown_documents, stream_parts, part_pack_merge, carve_part_packs,
    )
}

EACH = "(select doc_id, 1 as algo, md5(text) as digest from documents union all select doc_id, 2, sha1(text) from documents union all select doc_id, 3, sha256(text) from documents)"
SET = f"select distinct algo::int as algo, digest from {EACH}"
HEX = "[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}"
WIDTHS = "case algo when 1 then 16 when 2 then 20 else 32 end"
FREE = f"""select doc_id, coalesce(list_filter(hits, lambda x: length(x) = 64)[1], list_filter(hits, lambda x: length(x) = 40)[1], list_filter(hits, lambda x: length(x) = 32)[1]) as hex
 from (select doc_id, line, lower(trim(line)) as low, regexp_extract_all(lower(line), '\\b(?:md5:|sha1:|sha-1:|sha256:|sha-256:)?({HEX})\\b', 1) as hits from {LINES})
 where low not like '#%' and low not like ';%' and low != '' and not (low like '%filename%' and (low like '%sha%' or low like '%md5%'))
 and not ((line like '%,%' or line like '%"%') and regexp_matches(low, '\\.apk|\\.ipa|/usr/|\\.deb|\\.rpm') and not regexp_matches(low, '\\.exe|\\.dll|\\.sys|\\.msi'))"""


def parts_sql(kind: str, limit: int) -> str:
    """The size rule, doubled until the largest part fits, and plain row numbers."""
    size = "(count * w)" if kind == "bin" else "(count * (2 * w + 1))"
    room = limit - HEADER_BYTES if kind == "bin" else limit
    largest = "least(count, ceil(count / (p * 1.0::double))) * w + 24" if kind == "bin" else "least(count, ceil(count / (p * 1.0::double))) * (2 * w + 1)"
    payload = "records * w + case when part_no = 1 then 24 else 0 end" if kind == "bin" else "records * (2 * w + 1)"
    return f"""with s as ({SET}), c as (select algo, count(*) as count, any_value({WIDTHS}) as w from s group by algo),
 f as (select algo, w, count, greatest(1, cast(ceil({size} / {room}.0) as bigint)) as parts from c),
 d as (select algo, w, count, unnest([parts, 2 * parts, 4 * parts, 8 * parts, 16 * parts, 32 * parts]) as p from f),
 n as (select algo, w, count, min(p) as parts from d where {largest} <= {limit} group by all),
 r as (select s.algo, n.w, n.parts, row_number() over (partition by s.algo order by digest) - 1 as k, cast(ceil(n.count / n.parts::double) as bigint) as each from s join n using (algo)),
 p as (select algo, w, parts, cast(k // each + 1 as int) as part_no, count(*) as records from r group by all)
 select algo, part_no, 'clean_' || case algo when 1 then 'md5' when 2 then 'sha1' else 'sha256' end || case when parts = 1 then '' else '_part' || lpad(part_no::varchar, greatest(2, length(parts::varchar))::int, '0') end || '.{kind}' as part_name,
 records, cast({payload} as bigint) as bytes from p"""


ORACLE = {
    **{f"unique_{n}_docs": f"select distinct {n}(text) as digest from documents" for n in ("md5", "sha1", "sha256")},
    "unique_all_algos": SET,
    "counts_per_algo": f"select algo, count(*) as n from ({SET}) group by rollup (algo)",
    "dedup_counters": f"select o as offered, u as unique_n, o - u as dropped, round(100.0::double * (o - u) / o, 6) as drop_pct, b::bigint as unique_bytes from (select (select count(*) from {EACH}) as o, count(*) as u, sum({WIDTHS}) as b from ({SET}))",
    "shard_histogram": f"select algo, ('0x' || digest[1:2])::int as shard, count(*) as n from ({SET}) group by all",
    "merge_parts_unique": SET,
    "part_counts": f"select (doc_id % {PARTS})::int as part, algo::int as algo, count(distinct digest) as n from {EACH} group by all",
    "first_n_distinct": f"select algo::int as algo, digest, min(doc_id * 4 + algo) as first_at from {EACH} group by algo, digest order by first_at limit {FIRST}",
    "text_default_filter": f"select * from ({FREE}) where hex is not null",
    "text_digest_only": f"select doc_id, hex from (select doc_id, regexp_extract(lower(trim(line)), '^(?:md5:|sha1:|sha-1:|sha256:|sha-256:)?({HEX})$', 1) as hex from {LINES}) where hex != ''",
    "hex_validate": f"select doc_id, value, case when regexp_full_match(lower(value), '{HEX}') then case length(value) when 32 then 1 when 40 then 2 else 3 end end::int as algo from (select doc_id, case doc_id % 6 when 0 then md5(text) when 1 then upper(sha1(text)) when 2 then sha256(text) when 3 then md5(text) || 'x' when 4 then ' ' || md5(text) else 'zz' end as value from documents)",
    "row_shape_filter": f"select distinct algo::int as algo, digest from {EACH} where doc_id % 11 != 0 and not (algo = 1 and doc_id % 13 = 0)",
    "sqlite_page_scan": SET,
    "sqlite_sql_scan": SET,
    "zip_member_scan": SET,
    "gzip_text_feed": f"select distinct case length(hex) when 32 then 1 when 40 then 2 else 3 end::int as algo, hex as digest from ({FREE}) where hex is not null",
    "gzip_members_feed": f"select distinct case length(hex) when 32 then 1 when 40 then 2 else 3 end::int as algo, hex as digest from ({FREE}) where hex is not null",
    "pack_roundtrip": SET,
    "pack_header": f"select {0x31545643}::bigint as magic, 1::int as version, algo, {UPDATED}::bigint as updated_unix, count(*) as count from ({SET}) group by algo",
    "export_text_lines": "select distinct sha1(text) as line from documents",
    "combined_text": f"select digest as line from ({SET})",
    "split_plan_bin": parts_sql("bin", LIMIT_BIN),
    "split_plan_txt": parts_sql("txt", LIMIT_TXT),
    "split_plan_doubling": parts_sql("bin", LIMIT_DOUBLING),
    "split_text_identity": f"""with s as (select digest, row_number() over (order by digest) - 1 as k from ({SET}) where algo = 3), n as (select count(*) as n, ceil(count(*) * 65 / {LIMIT_TXT}.0)::bigint as parts from s)
 select 'clean_sha256' || case when parts = 1 then '' else '_part' || lpad((k // ceil(n / parts::double)::bigint + 1)::varchar, greatest(2, length(parts::varchar))::int, '0') end || '.txt' as part_name, digest as line from s, n""",
    "split_concat_identity": f"select * from ({SET}) where algo = 1",
    "candidate_versions": "select printf('%d.%02d.%d', y, m, r) as version from (select unnest(range(2020, 2026)) as y) cross join (select unnest([3, 6, 9, 12]) as m) cross join (select unnest(range(1, 10)) as r) where y != 2025 or m <= 7",
    "latest_version": """select arg_max(v, k) as version, arg_max(url, k) as url from (select url, v, row(string_split(v, '.')[1]::int, string_split(v, '.')[2]::int, string_split(v, '.')[3]::int, url) as k
 from (select url, regexp_extract(url, '/RDS_([0-9]{4}\\.[0-9]{2}\\.[0-9]+)_modern\\.zip$', 1) as v from (select 'https://host.example/RDS_' || (2020 + doc_id % 5) || '.' || lpad((3 * (1 + doc_id % 4))::varchar, 2, '0') || '.' || (1 + doc_id % 12) || case doc_id % 4 when 1 then '_modern_minimal.zip' when 2 then '_delta.zip' else '_modern.zip' end as url from documents)) where v != '')""",
    "asset_inventory": """select name, size, regexp_extract(name, 'clean_([a-z0-9]+?)(?:_part[0-9]+)?\\.', 1) as algo, name[-3:] as ext, coalesce(nullif(regexp_extract(name, '_part([0-9]+)', 1), '')::int, 1) as part,
 case when size < 1024 then printf('%d B', size) when size < 1048576 then printf('%.1f KiB', size / 1024.0::double) when size < 1073741824 then printf('%.1f MiB', size / 1048576.0::double) else printf('%.1f GiB', size / 1073741824.0::double) end as human
 from (select case doc_id % 5 when 0 then 'clean_md5.bin' when 1 then 'clean_sha1_part' || lpad((doc_id % 90)::varchar, 2, '0') || '.bin' when 2 then 'clean_sha256_part' || lpad((doc_id % 90)::varchar, 2, '0') || '.txt' end as name, n_chars * doc_id * 3 as size from documents) where name is not null""",
    "throughput_projection": f"""select round(m * 0.8::double, 6) as reliable_mib_s, round({123 * 1024}.0::double / (m * 0.8::double) / 60, 6) as download_min, round({123 * 1024}.0::double / (m * 0.8::double) / 60 + 20, 6) as total_min, {123 * 1024}.0::double / (m * 0.8::double) / 60 + 20 <= 360 as will_fit
 from (select sum(event_id * 1000 + 1)::double / 1048576 / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::double) as m from events)""",
    "bucket_capacity": "select w::bigint as workers, b::bigint as budget_mb, greatest(2000, least(50000, (b::bigint * 1048576) // (w * 256 * 23)))::bigint as capacity from (select unnest(range(1, 65)) as w) cross join (select unnest([1, 64, 256, 2048, 16384]) as b)",
    "known_documents": "select doc_id from documents where md5(text) in (select md5(text) from documents where doc_id % 2 = 0)",
    "unknown_documents": "select doc_id from documents where md5(text) not in (select md5(text) from documents where doc_id % 2 = 0)",
    "stream_parts": SET,
    "part_pack_merge": SET,
    "carve_part_packs": SET,
}
