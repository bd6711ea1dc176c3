"""URL filter: pattern rules indexed by their rarest literal token.

A pattern is filed under tokens one of which any url that it matches must contain as a whole: under the one that is
rarest in the urls, or, with alternatives, under the rarest of each. A url's tokens fetch the rules filed under them,
and only those rules run their regular expression. Patterns without such a token are few by nature and run on every
url. Nothing is shuffled; the index, as large as the caller's list of rules, is sent to the executors in blocks of
``BLOCK`` rules, one narrow pass each, so any number of rules is exact.

Defined results: a null url, or one without ``://``, has empty host and path, matches no rule and is allowed; the
longest fitting prefix rule wins and a prefix rule outranks all patterns; of patterns, any match blocks. Patterns are
Python regular expressions over host + lower(path), with ASCII classes. Repeated rows are judged alike; rows without
page_id are judged like others; other columns of the input are left out of the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from re import _constants as sre
from re import _parser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

# The prefix rules (verdict, host, path) of the contract.
PREFIX_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Regular expressions over ``host + path`` in lower case.
PATTERN_RULES = [
    r"\bcasino-[a-z0-9-]+\.",
    r"\bcheap-pills?\.",
    r"\bfree-bets?\.",
    r"\bads-track(er)?\.",
    r"\bspam-farm\.",
    r"\badult-[a-z0-9-]+\.",
    r"/wp-login\.php$",
]
#: So many rules are held by an executor at a time.
BLOCK = 200_000
#: A pattern's alternatives are written out up to so many; beyond that it has no token and runs on every url.
MOST_ALTERNATIVES = 256
TOKEN = "[a-z0-9]+"
#: Places of a written-out pattern besides characters: a border between tokens, and anything at all.
BORDER, ANYTHING = "\0", "\1"


def written_out(parsed) -> list[str] | None:
    """The alternatives of a parsed pattern as strings of characters, BORDER and ANYTHING; None if they are too many."""
    out = [""]
    for op, arg in parsed:
        if op is sre.LITERAL:
            more = [chr(arg).lower()]  # addresses are in lower case
        elif op is sre.AT:
            more = [BORDER if arg in (sre.AT_BOUNDARY, sre.AT_BEGINNING, sre.AT_BEGINNING_STRING, sre.AT_END, sre.AT_END_STRING) else ANYTHING]
        elif op is sre.SUBPATTERN:
            more = written_out(arg[-1])
        elif op is sre.BRANCH:
            branches = [written_out(x) for x in arg[1]]
            more = None if None in branches else [x for b in branches for x in b]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[:2] == (1, 1):
            more = written_out(arg[2])
        else:
            more = [ANYTHING]
        if more is None or len(out) * len(more) > MOST_ALTERNATIVES:
            return None
        out = [a + b for a in out for b in more]
    return out


def literal_tokens(pattern: str) -> list[list[str]]:
    """For each alternative of ``pattern``, the whole tokens that all its matches contain. A token is whole if what
    stands beside it can't be of a token: a border, or a character of another kind."""
    alternatives = written_out(_parser.parse(pattern, re.ASCII))
    if alternatives is None:
        return [[]]
    whole = re.compile(rf"(?<=[^a-z0-9{ANYTHING}]){TOKEN}(?=[^a-z0-9{ANYTHING}])")
    return [whole.findall(f"{ANYTHING}{x}{ANYTHING}") for x in alternatives]


def url_parts(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(rest, r"^[^/?#]*", ""), r"^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def prefix_rule(host: Column, path: Column, rules=PREFIX_RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def rule_index(tokens: DataFrame, patterns=PATTERN_RULES) -> tuple[dict[str, list[str]], list[str]]:
    """(token -> patterns filed under it, patterns without a token). ``tokens``: a column ``tokens`` of distinct tokens
    a url. Only the counts of the rules' own tokens reach the driver, at most a few for each rule."""
    own = {p: literal_tokens(p) for p in patterns}
    bare = [p for p, alternatives in own.items() if not all(alternatives)]
    wanted = sorted({t for p, alternatives in own.items() if all(alternatives) for ts in alternatives for t in ts})
    if not wanted:
        return {}, bare
    # As many rows as the rules have tokens; Spark broadcasts them if they are few.
    listed = tokens.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
    used = tokens.select(F.explode("tokens").alias("token")).join(listed, "token")
    seen = {r.token: r.n for r in used.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    index: dict[str, list[str]] = {}
    for p, alternatives in own.items():
        if all(alternatives):
            for token in {min(ts, key=lambda t: (seen.get(t, 0), t)) for ts in alternatives}:
                index.setdefault(token, []).append(p)
    return index, bare


def first_hits(parts: DataFrame, index: dict[str, list[str]], bare: list[str]) -> DataFrame:
    """``parts`` with pattern (the least that matches, else null) and n_candidates (how many were tried)."""
    shared = parts.sparkSession.sparkContext.broadcast((index, bare))  # BLOCK rules at most
    schema = StructType([x for x in parts.schema if x.name not in ("pattern", "n_candidates")]).add("pattern", StringType()).add("n_candidates", IntegerType())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filed, always = shared.value
        compiled: dict[str, re.Pattern] = {}
        for batch in batches:
            names = batch.schema.names
            earlier = zip(*(batch.column(names.index(x)).to_pylist() for x in ("pattern", "n_candidates"))) if "pattern" in names else [(None, 0)] * batch.num_rows
            hits, tried = [], []
            for address, tokens, (hit, n) in zip(batch.column(names.index("_address")).to_pylist(), batch.column(names.index("tokens")).to_pylist(), earlier):
                rules = {p for t in tokens if t in filed for p in filed[t]}.union(always)
                for p in sorted(rules):
                    if (hit is None or p < hit) and (compiled.get(p) or compiled.setdefault(p, re.compile(p, re.ASCII))).search(address):
                        hit = p
                        break
                hits.append(hit)
                tried.append(n + len(rules))
            kept = [k for k, x in enumerate(names) if x not in ("pattern", "n_candidates")]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(hits, pa.string()), pa.array(tried, pa.int32())], [*(names[k] for k in kept), "pattern", "n_candidates"])

    return parts.mapInArrow(search, schema)


def filter_urls(pages: DataFrame, prefixes=PREFIX_RULES, patterns=PATTERN_RULES, block: int = BLOCK) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern (the first that matched, else null), n_candidates of every row."""
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    parts = parts.withColumn("_address", F.concat("host", F.lower("path"))).withColumn("tokens", F.array_distinct(F.regexp_extract_all("_address", F.lit(f"({TOKEN})"))))
    found = parts
    for k in range(0, max(1, len(patterns)), block):
        found = first_hits(found, *rule_index(parts, patterns[k : k + block]))
    rule, verdict = prefix_rule(F.col("host"), F.col("path"), prefixes)
    out = found.withColumn("rule", rule).withColumn("_by_rule", verdict)
    return out.select("page_id", "host", "path", "rule", F.coalesce("_by_rule", F.when(F.col("pattern").isNotNull(), "block").otherwise("allow")).alias("verdict"), "pattern", "n_candidates")
