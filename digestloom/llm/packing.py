"""Packing by shortest-pack-first over the histogram of lengths.

Documents are tokenised and cut into full sequences and one rest each. The rests' lengths are counted (a histogram of
at most ``SEQUENCE`` rows, whatever the input); the packer walks it on the driver, longest length first, and puts each
length into the open pattern with the least tokens that fits, updating pattern counts instead of documents. Patterns
are joined back to pieces by their rank within their length.

Defined results: a null text is an empty one and has the single end token; repeated rows are separate documents (a
row's pieces are told apart by ``_row``); ties in length are ordered by id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.llm.common import ranked, staged

SEQUENCE = 1024
END_ID = 0
#: Pieces of one length are ranked in parts of so many pieces at most, in SPREAD parts at least: most are full ones.
PART_PIECES, SPREAD = 200_000, 256
PIECES = "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long"
#: The vocabulary's special token; tokenizers finds it inside texts and gives it its own id.
SPECIAL = "<|endoftext|>"
# Fixed value: how this vocabulary's byte-level tokenizer splits text into words.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ENCODERS: dict = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, reversed."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder(path: str):
    """text -> ids as tokenizers gives them without special tokens added, once a process. The same vocabulary's ranks
    run in tiktoken, which is several times as fast; texts that hold the special token's string go to tokenizers, which
    is loaded, as each worker holds it, by the first of these."""
    if path not in _ENCODERS:
        import json

        import tiktoken

        def slow(text: str):
            from tokenizers import Tokenizer

            if (path, "slow") not in _ENCODERS:
                _ENCODERS[path, "slow"] = Tokenizer.from_file(path)
            return _ENCODERS[path, "slow"].encode(text, add_special_tokens=False).ids

        back = byte_of()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ranks = {bytes(back[c] for c in token): i for token, i in model["vocab"].items() if token != SPECIAL}
        fast = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        _ENCODERS[path] = lambda text: slow(text) if SPECIAL in text else fast.encode_to_numpy(text, disallowed_special=())
    return _ENCODERS[path]


def tokenise(docs: DataFrame, path: str, sequence: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's pieces: doc_id, row (its number, unique), start, length, ids_crc32, doc_tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import numpy as np

        encode, end = encoder(path), np.asarray([END_ID], "<u4")
        for batch in batches:
            ids, rows, texts = (batch.column(k).to_pylist() for k in range(3))
            out: list[list] = [[], [], [], [], [], []]
            for doc, row, text in zip(ids, rows, texts):
                whole = np.append(np.asarray(encode(text or ""), "<u4"), end)
                n = len(whole)
                for start in range(0, n, sequence):
                    piece = whole[start : start + sequence]
                    for column, value in zip(out, (doc, row, start, len(piece), zlib.crc32(piece.tobytes()), n)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col(id_col).cast("long"), F.monotonically_increasing_id().alias("row"), F.col(text_col))
    return rows.mapInArrow(cut, PIECES)


def pack_lengths(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a pattern, how many packs have it). Open patterns are kept by the room they leave; a length goes
    where the room is largest (the shortest pack), taking as many packs of the pattern as it has documents for."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    done: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], n: int, left: int) -> None:
        if left:
            room.setdefault(left, []).append((pattern, n))
        else:
            done.append((pattern, n))

    for length in sorted((x for x in histogram if histogram[x]), reverse=True):
        n = histogram[length]
        while n:
            widest = max((r for r, packs in room.items() if packs), default=0)
            if widest < length:
                # A new pack: the next documents of this length find it the only one with room, until it is full.
                fit = sequence // length
                if n >= fit:
                    put((length,) * fit, n // fit, sequence - length * fit)
                if n % fit:
                    put((length,) * (n % fit), 1, sequence - length * (n % fit))
                break
            pattern, m = room[widest].pop()
            taken = min(n, m)
            if m > taken:
                room[widest].append((pattern, m - taken))
            put((*pattern, length), taken, widest - length)
            n -= taken
    return done + [p for packs in room.values() for p in packs]


def pattern_slots(packs: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank excluded, first sequence, offset) of each slot of each pattern."""
    used: dict[int, int] = {}
    slots, sequence = [], 0
    for pattern, n in packs:
        offset = 0
        for length in pattern:
            first = used.get(length, 0)
            used[length] = first + n
            slots.append((length, first, first + n, sequence, offset))
            offset += length
        sequence += n
    return slots


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` (staged: doc_id, row, start, length) with sequence_id and offset."""
    spark = pieces.sparkSession
    spread = max(SPREAD, -(-pieces.count() // PART_PIECES))
    pieces = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "row", "start"), F.lit(spread)).cast("int"))
    # Counted twice rather than staged: a file for each partition costs executors more than counting.
    counts = pieces.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most `sequence` rows
    slots = pattern_slots(pack_lengths(histogram, sequence))
    table = spark.createDataFrame(slots or [(0, 0, 0, 0, 0)], "length long, first long, last long, seq long, offset long")
    numbered = ranked(pieces, ["length"], "_part", ["doc_id", "row", "start"], counts, "_rank")
    # The slots follow the histogram, not the documents: a few for each length.
    met = numbered.alias("r").join(F.broadcast(table).alias("p"), F.expr("r.length = p.length and r._rank >= p.first and r._rank < p.last"))
    return met.select(*(F.col(f"r.{c}") for c in pieces.columns if c != "_part"), (F.col("p.seq") + F.col("r._rank") - F.col("p.first")).alias("sequence_id"), F.col("p.offset").alias("offset"))


def pack_documents(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    pieces = staged(tokenise(docs, path or vocabulary(), sequence), "pieces")
    out = pack(pieces, sequence)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
