"""The queries opN_<name> of this subpackage, and their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from digestloom.llm import chat, dedup, html_extract, minhash, mixing, packing, quality, sharding, toxicity, urlfilter
from digestloom.llm.common import n_words, staged


def _docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mix_sources(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", "source", n_words(F.col("text")).cast("long").alias("_size"))
    out = mixing.mix_copies(staged(docs, "sizes"))
    return out.select("doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("_copies")).alias("taken"), F.col("_copies").alias("copies"))


def op2_quality_rules(spark, sf_dir):
    return quality.quality_report(_docs(spark, sf_dir))


def op3_html_text(spark, sf_dir):
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_exact_dedup(spark, sf_dir):
    return dedup.exact_dedup(_docs(spark, sf_dir), keep="max")


def op5_minhash_dedup(spark, sf_dir):
    return minhash.near_dedup(_docs(spark, sf_dir))


def op6_chat_format(spark, sf_dir):
    return chat.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op7_url_filter(spark, sf_dir):
    return urlfilter.filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("n_candidates")


def op8_toxicity(spark, sf_dir):
    fold = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~fold)
    out = toxicity.toxicity(_docs(spark, sf_dir), labels)
    return out.select("doc_id", F.coalesce(fold, F.lit(False)).alias("held_out"), "score", "predicted")


def op9_shards(spark, sf_dir):
    return sharding.shard_documents(_docs(spark, sf_dir))


def op10_packing(spark, sf_dir):
    return packing.pack_documents(_docs(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_quality_rules, op3_html_text, op4_exact_dedup, op5_minhash_dedup,
        op6_chat_format, op7_url_filter, op8_toxicity, op9_shards, op10_packing,
    )
}


def _hash32(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::bigint"


_PATTERNS = ", ".join("'" + p.replace("'", "''") + "'" for p in urlfilter.PATTERN_RULES)


def _choose(rule: bool) -> str:
    out = []
    for v, h, p in sorted(urlfilter.PREFIX_RULES, key=lambda r: -len(r[1] + r[2])):
        out.append(f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{h + p if rule else v}'")
    return f"case {' '.join(out)} end"


ORACLE: dict[str, str] = {
    "op1_mix_sources": rf"""with d as (select doc_id, source, coalesce('s' || source, 'n') as key, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
 b as (select *, (case when size < 8 then size else (length(bin(size)) - 1) * 8 + ((size >> (length(bin(size)) - 4)::int) & 7) end) * {mixing.SPREAD} + {_hash32(f"'{mixing.SEED}|' || doc_id")} % {mixing.SPREAD} as bucket from d),
 r as (select *, row_number() over (partition by key order by bucket, size, doc_id) - 1 as rank from b),
 s as (select key, any_value(source) as source, sum(size)::bigint as source_size from d group by key),
 w as (select *, ([5.0::double, 2.0::double, 1.0::double])[(row_number() over (order by source nulls last) - 1) % 3 + 1] as w, 3.0::double * source_size as cap from s),
 l as (select *, (sum(source_size) over ()::double - coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0)) / sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following) as level from w),
 f as (select *, cap / w <= level as is_full from l),
 t as (select key, source_size, case when is_full then cap else w * (select arg_min(level, cap / w) from f where not is_full) end as target from f),
 j as (select r.doc_id, r.size, t.source_size, t.target, r.rank, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate, {_hash32(f"'{mixing.SEED}|' || t.key")} % 1048576 / 1048576.0::double as u from r join t using (key)),
 c as (select *, (floor((rank + 1) * rate + u) - floor(rank * rate + u))::bigint as copies from j)
 select doc_id, size, source_size, target, size * copies as taken, copies from c""",
    "op4_exact_dedup": """select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size, doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
 from documents window same as (partition by coalesce(text, ''))""",
    "op7_url_filter": rf"""with a as (select page_id, case when strpos(url, '://') > 0 then url[strpos(url, '://') + 3:] else '' end as rest from pages),
 b as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') as path from a),
 c as (select *, {_choose(True)} as rule, {_choose(False)} as by_rule, list_sort(list_filter([{_PATTERNS}], lambda p: regexp_matches(host || lower(path), p))) as hits from b)
 select page_id, host, path, rule, coalesce(by_rule, case when len(hits) > 0 then 'block' else 'allow' end) as verdict, hits[1] as pattern from c""",
}
