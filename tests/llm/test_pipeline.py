"""The pipeline: each stage against a plain version on a small table with odd rows."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from digestloom.llm import minhash, packing
from digestloom.llm.common import staged

import plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, _text string, _size string, target string, kept string, node long"


def table():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    texts = [prose(rng.randint(12, 120)) for _ in range(60)] + [prose(6000)]
    texts += [None, "", " \n\t", "too short", texts[3], texts[3], texts[3], "é" * 30_000]
    base = prose(300).split()
    for _ in range(45):  # a large group of near copies
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(300)] = word()
        texts.append(" ".join(words))
    texts += [" ".join(f"{word()}###" for _ in range(40)) for _ in range(6)] + [" ".join(f"{word().upper()}!!" for _ in range(40)) for _ in range(6)] + ["again and again " * 30, "one line of text here\n" * 12]
    rows = [(k, t, "en", None if k % 11 == 0 else f"s{k % 4}", None, "r", None, "z", "t", "k", 5) for k, t in enumerate(texts)]
    return rows + [(None, texts[3], *rows[3][2:]), (None, prose(50), None, None, *rows[0][4:]), (None, " ".join([*base[:-1], "last"]), None, "s1", *rows[0][4:]), rows[5], rows[5]]


def test_stages_match_plain_versions(spark, sf_dir):
    docs = spark.createDataFrame(table(), SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    rows = [tuple(r) for r in docs.collect()]

    def step(name, want):
        nonlocal docs, rows
        docs = staged(stages[name](spark, docs, sf_dir), name)
        rows = [tuple(r) for r in docs.collect()]
        assert docs.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
        assert Counter((r[0], r[1]) for r in rows) == Counter((r[0], r[1]) for r in want), name

    kept = [r for r, ok in zip(rows, plain.good([r[1] for r in rows])) if ok]
    assert 90 < len(kept) < len(rows) - 15
    step("quality_rules", kept)
    step("exact_copies", plain.without_copies(rows))
    before = len(rows)
    step("near_copies", plain.without_near_copies(rows, minhash.inverse_frequency(docs, "text")))
    assert len(rows) < before - 10
    want = plain.mixed([(r[0], r[1], r[3]) for r in rows if r[0] is not None])
    if all(r[0] is not None for r in rows):
        step("mixed_sources", [r for r, n in zip(rows, want) for _ in range(n)])
    else:  # ties of rows without id are open, the rest is not
        docs = docs.filter("doc_id is not null")
        step("mixed_sources", [r for r, n in zip([r for r in rows if r[0] is not None], want) for _ in range(n)])
    from tokenizers import Tokenizer

    out = stages["packed_sequences"](spark, docs, sf_dir).collect()
    pieces = plain.pieces(rows, Tokenizer.from_file(packing.vocabulary()))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == Counter(pieces)
    fill = defaultdict(int)
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert Counter(fill.values()) == plain.packed([p[2] for p in pieces], packing.SEQUENCE)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None, None, None, None, None, None, None)] * 3])
def test_stages_of_nothing(spark, sf_dir, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
        assert docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == 0


def test_run(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    by = defaultdict(set)
    for r in packed.collect():
        by[r.doc_id].add(r.doc_tokens)
    assert by and set(by) <= set(docs) and all(len(x) == 1 for x in by.values()) and len({docs[k] for k in by}) == len(by)


def test_near_copies_lose_no_link_in_large_buckets(spark, monkeypatch):
    """With every bucket a large one and one leader in each, of each class one row stays, as by brute force."""
    monkeypatch.setattr(minhash, "SMALL", 1)
    monkeypatch.setattr(minhash, "LEADERS", 1)
    rows = []
    for k in range(200):
        base = [f"w{k}x{j}" for j in range(100)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join([*base[:90], *(f"v{k}x{j}" for j in range(10))]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain.without_near_copies(rows, minhash.inverse_frequency(docs, "text"))
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()) == sorted(r[0] for r in want)
