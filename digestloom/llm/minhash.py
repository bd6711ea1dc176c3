"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

Texts become bags of five-word shingles weighted by tf * idf. Document frequencies come from all documents, in a sketch
of fixed size. Consistent weighted samples (Ioffe's method) are banded, and pairs whose samples agree often enough are
verified by exact weighted Jaccard similarity on whole texts. Similar pairs link into classes. Equal texts are one row
throughout, however many copies there are.

A bucket never emits all its pairs, unless it has at most ``SMALL`` members. The texts of larger buckets get a second,
longer signature with bands of ten samples, in which pairs below the threshold seldom meet. Small buckets of these are
compared in full. In a large one all members are compared with ``LEADERS`` central members, and the bucket is split by
the samples of the next bands (two, four, eight ... bands long) until its parts are small. So the number of these pairs
is linear in the number of texts, whatever the size of a group. They make the first links and classes. What they leave
out is settled after that: in each large bucket of the first bands whose members are not all of one class, every pair of
members of different classes is compared by its samples, block against block, and verified there by the same measure if
enough agree. So a large bucket drops nothing that could change a class; pairs inside a class would only confirm it. Both
the comparisons and the rows that travel for them grow with (members outside the bucket's largest class) * members, in
the worst case with their square; the rows are fewer by a factor of BLOCK.

Defined results: a null text is empty; all texts without words are one class; a text of fewer than five words is one
shingle; a text's class is the least doc_id linked with it; repeated rows share a class; other columns are ignored.
Texts are compared under keys of their own, so a row without doc_id is compared like any other. It loses against rows
with one: a class takes the least doc_id there is, and only a class without any has a null class_id. The row that stays
is then that of the least content hash, so no class is ever lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from digestloom.llm.common import WORD, scratch, staged

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 12, 3
SAMPLES = BANDS * ROWS
#: Pairs whose samples agree in fewer places are not verified: at similarity 0.8 the chance is 2 in a million.
LEAST_AGREE = 16
#: The second signature, of texts in large buckets: a pair of similarity 0.8 meets in one of its bands with
#: probability 0.966, one of 0.85 with 0.9986. 210 of 300 samples agree at 0.8 but for a chance of 1 in 100,000.
FINE_BANDS, FINE_ROWS = 30, 10
FINE_SAMPLES, FINE_AGREE = FINE_BANDS * FINE_ROWS, 210
#: Buckets of at most SMALL members are compared in full, larger ones with LEADERS of their members, then split.
SMALL, LEADERS = 24, 4
#: Members of a large bucket that are compared with as many others in one group of rows, and their total weight (so that
#: a block of long texts has fewer); pairs compared at a time.
BLOCK, BLOCK_WEIGHT, CELLS_AT_ONCE = 256, 2_000_000, 1 << 18
#: Members of a bucket that meet its leaders in one task, about.
DEALT = 1024
#: Pairs whose total weights differ by more cannot be similar: the similarity is at most the lesser over the greater.
LEAST_RATIO = SIMILAR * (1 - 1e-6)
#: Document frequencies: TABLES sketches of CELLS cells, sent in CHUNKS pieces.
TABLES, CELLS, CHUNKS = 2, 1 << 18, 16
#: Shingles in a lesser share of the documents weigh as much as those in this share. A cell's noise is far below.
RARE = 0.001
#: Weights run from 1 (in all documents) to 1 + SPREAD (in a share of RARE at most).
SPREAD = 1.0
MIX, ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
RADIX = np.uint64(0x5851F42D4C957F2D)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * ODD
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


class Shingler:
    """Hashes of five-word shingles as differences of one running polynomial over the text's bytes."""

    def __init__(self) -> None:
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 1 << 16)
            back = np.uint64(pow(int(RADIX), -1, 1 << 64))
            self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, RADIX)]), dtype=np.uint64)
            self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, back)]), dtype=np.uint64)

    def hashes(self, text: str | None) -> np.ndarray:
        """One hash for each shingle of the text, repeats included; words are as ASCII white space parts them."""
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if not words:
            return np.zeros(0, np.uint64)
        joined = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.uint64)
        self.grow(len(joined) + 1)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((joined + np.uint64(1)) * self.powers[: len(joined)], dtype=np.uint64)])
        n = max(1, len(words) - SHINGLE + 1)
        first, last = starts[:n], ends[min(SHINGLE, len(words)) - 1 :]
        return mixed((running[last] - running[first]) * self.inverse[first] + (last - first).astype(np.uint64))


def cells(h: np.ndarray) -> list[np.ndarray]:
    """The shingles' cells in each of the sketch's tables."""
    return [((h if not t else h * ODD) >> np.uint64(46)).astype(np.int64) for t in range(TABLES)]


class Frequencies:
    """Weights by document frequency. A cell holds the documents of all its shingles; less the mean of all cells it is
    an estimate for each, and the least estimate of a shingle's cells counts, which only a shingle that meets frequent
    ones in every table exceeds. Shares of documents and the estimates' errors do not depend on the table's size."""

    def __init__(self, counts: np.ndarray, n: int) -> None:
        """``counts``: TABLES rows of CELLS documents, over ``n`` documents in all."""
        share = (counts - counts.mean(axis=1, keepdims=True)) / max(n, 1)
        self.weight = (1 + SPREAD * np.log(np.clip(share, RARE, 1)) / np.log(RARE)).astype(np.float32)

    def of(self, h: np.ndarray) -> np.ndarray:
        return np.maximum.reduce([row[at] for row, at in zip(self.weight, cells(h))])


def inverse_frequency(docs: DataFrame, text_col: str) -> Frequencies:
    """The weights by document frequency, counted over all documents in TABLES * CELLS counts."""
    width = TABLES * CELLS // CHUNKS
    held_most = 1 << 20

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, total, n, held, size = Shingler(), np.zeros((TABLES, CELLS), np.int64), 0, [], 0

        def add() -> None:
            nonlocal size
            for row, at in zip(total, cells(np.concatenate(held))):
                row += np.bincount(at, minlength=CELLS)
            held.clear()
            size = 0

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(np.unique(shingler.hashes(text)))
                n, size = n + 1, size + len(held[-1])
                if size > held_most:
                    add()
        if n:
            add()
        yield from sent({k: (total.ravel()[k * width : (k + 1) * width], n) for k in range(CHUNKS)} if n else {})

    def sent(sums: dict[int, tuple[np.ndarray, int]]) -> Iterator[pa.RecordBatch]:
        salt, kind = uuid.uuid4().int % 64, np.min_scalar_type(max((int(x.max()) for x, _ in sums.values()), default=0))
        rows = [(k, salt, kind.str, x.astype(kind).tobytes(), n) for k, (x, n) in sums.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.int64()))], ["chunk", "salt", "kind", "cells", "n"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each task adds up what it reads, chunk by chunk: CHUNKS sums, however many rows come.
        sums: dict[int, tuple[np.ndarray, int]] = {}
        for batch in batches:
            for chunk, kind, blob, n in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4))):
                x, m = sums.get(chunk, (0, 0))
                sums[chunk] = x + np.frombuffer(blob, kind).astype(np.int64), m + n
        yield from sent(sums)

    schema = "chunk int, salt int, kind string, cells binary, n long"
    parts = docs.select(text_col).mapInArrow(count, schema)
    met = parts.repartition(32, "salt").mapInArrow(add_up, schema).repartition(4, "chunk").mapInArrow(add_up, schema)
    rows = sorted(met.collect(), key=lambda r: r.chunk)  # TABLES * CELLS counts, whatever the input
    if not rows:
        return Frequencies(np.zeros((TABLES, CELLS)), 0)
    return Frequencies(np.concatenate([np.frombuffer(r.cells, r.kind).astype(np.int64) for r in rows]).reshape(TABLES, CELLS), rows[0].n)


def bag(hashes: np.ndarray, idf: Frequencies) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, and their weights tf * idf."""
    h, tf = np.unique(hashes, return_counts=True)
    return h, tf.astype(np.float32) * idf.of(h)


def samples(h: np.ndarray, w: np.ndarray, starts: np.ndarray, first: int = 0, n: int = SAMPLES) -> np.ndarray:
    """Improved consistent weighted sampling: 32-bit samples (shingle, level) for the bags that begin at ``starts``,
    the ``n`` samples from number ``first`` on."""
    out = np.empty((len(starts), n), np.uint32)
    lens = np.diff(np.append(starts, len(h)))
    owner = np.repeat(np.arange(len(starts)), lens)
    log_w = np.log(w)
    low, high = np.uint64(0xFFFFFFFF), np.uint64(32)
    unit, half = np.float32(2.0**-32), np.float32(2.0**-33)
    for k in range(n):
        a = (h ^ np.uint64((first + k + 1) * 0x9E3779B97F4A7C15 % 2**64)) * ODD
        a ^= a >> high
        a *= MIX
        b = (a ^ (a >> np.uint64(29))) * ODD
        b ^= b >> high
        u1, u2 = (a >> high).astype(np.float32) * unit + half, (a & low).astype(np.float32) * unit + half
        u3, u4 = (b >> high).astype(np.float32) * unit + half, (b & low).astype(np.float32) * unit + half
        beta = (((a ^ b) * MIX) >> high).astype(np.float32) * unit
        r = -np.log(u1 * u2)
        level = np.floor(log_w / r + beta)
        log_a = np.log(-np.log(u3 * u4)) - r * (level - beta) - r
        least = np.minimum.reduceat(log_a, starts)
        at = np.flatnonzero(log_a == least[owner])
        at = at[np.unique(owner[at], return_index=True)[1]]
        out[:, k] = ((h[at] >> high) ^ (level[at].astype(np.int64).astype(np.uint64) * MIX >> high)).astype(np.uint32)
    return out


def content_of(text: Column) -> Column:
    """16 bytes of content hash; texts without words count as one text."""
    return F.unhex(F.md5(F.when(F.regexp_like(text, F.lit(WORD)), text).otherwise("")))


def first_of(id_col: str, content: str) -> Column:
    """Sorts the rows of a class: real ids before null ones, then by content."""
    return F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(content).alias("content"))


def by_batches(bags: Iterator[tuple[object, tuple[np.ndarray, np.ndarray]]], first: int, n: int) -> Iterator[tuple[object, float, np.ndarray | None]]:
    """(what came with it, total weight, samples) of each bag, in order; a bag without shingles has no samples.
    Bags are sampled together, some thousand shingles at a time."""
    held: list[tuple[object, float, np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> Iterator[tuple[object, float, np.ndarray | None]]:
        whole = [(h, w) for _, _, h, w in held if len(h)]
        got = iter(samples(np.concatenate([h for h, _ in whole]), np.concatenate([w for _, w in whole]), np.cumsum([0] + [len(h) for h, _ in whole])[:-1], first, n)) if whole else iter(())
        for what, total, h, _ in held:
            yield what, total, next(got) if len(h) else None

    for what, (h, w) in bags:
        held.append((what, float(w.sum(dtype=np.float64)), h, w))
        size += len(h)
        if size > 8192:
            yield from flush()
            held, size = [], 0
    yield from flush()


SIGNED = "doc_id long, content binary, sig binary, weight double"


def signatures(docs: DataFrame, idf: Frequencies, id_col: str, text_col: str) -> DataFrame:
    """doc_id, content (16 bytes of hash), samples and total weight of every document; texts without words have no
    samples."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, weights = Shingler(), shared.value
        for batch in batches:
            out = list(by_batches(((None, bag(shingler.hashes(x), weights)) for x in batch.column(2).to_pylist()), 0, SAMPLES))
            sigs = [None if sig is None else sig.astype("<u4").tobytes() for _, _, sig in out]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.binary()), pa.array(sigs, pa.binary()), pa.array([total for _, total, _ in out], pa.float64())], ["doc_id", "content", "sig", "weight"])

    return docs.select(F.col(id_col), content_of(F.col(text_col)), F.col(text_col)).mapInArrow(sign, SIGNED)


def fine_signatures(texts: DataFrame, idf: Frequencies) -> DataFrame:
    """node, keys (one for each fine band), probe (a byte of each fine sample) of ``texts`` (node, text)."""
    shared = texts.sparkSession.sparkContext.broadcast(idf)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, weights = Shingler(), shared.value
        for batch in batches:
            out = [(node, sig) for node, _, sig in by_batches(zip(batch.column(0).to_pylist(), (bag(shingler.hashes(x), weights) for x in batch.column(1).to_pylist())), SAMPLES, FINE_SAMPLES) if sig is not None]
            keys = []
            for _, sig in out:
                key = np.zeros(FINE_BANDS, np.uint64)
                for row in sig.reshape(FINE_BANDS, FINE_ROWS).T:
                    key = mixed(key * RADIX + row)
                keys.append(key.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([node for node, _ in out], pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array([sig.astype(np.uint8).tobytes() for _, sig in out], pa.binary())], ["node", "keys", "probe"])

    return texts.select("node", "text").mapInArrow(sign, "node long, keys array<long>, probe binary")


def agreeing(a: str, b: str, n: int, width: int) -> str:
    """SQL: in how many of ``n`` places, of ``width`` bytes each, two binary columns agree."""
    return f"aggregate(sequence(0, {n - 1}), 0, (n, k) -> n + if(substring({a}, {width} * k + 1, {width}) = substring({b}, {width} * k + 1, {width}), 1, 0))"


def verified(pairs: DataFrame, texts: DataFrame, idf: Frequencies) -> DataFrame:
    """a, b, similarity of those ``pairs`` (a, b) whose weighted Jaccard similarity reaches SIMILAR."""
    spark = pairs.sparkSession
    shared = spark.sparkContext.broadcast(idf)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, weights = Shingler(), shared.value
        last: tuple = (None, None)
        for batch in batches:
            out: list[list] = [[], [], []]
            ids_a, ids_b, texts_a, texts_b = (batch.column(k).to_pylist() for k in range(4))
            for a, b, x, y in zip(ids_a, ids_b, texts_a, texts_b):
                if last[0] != a:
                    last = (a, bag(shingler.hashes(x), weights))
                found = similarity(last[1], bag(shingler.hashes(y), weights))
                if found >= SIMILAR:
                    for column, value in zip(out, (a, b, found)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["a", "b", "similarity"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    met = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "128")  # texts may be long
    try:
        return staged(met.mapInArrow(compare, "a long, b long, similarity double"), "links")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node of its component) of all nodes in ``links`` (a, b): alternating large and small
    stars until nothing changes. Only links move; none are collected. A node of many links meets them in a sum and in a
    join, both of which Spark can split."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    least = F.min("v").over(Window.partitionBy("u"))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        # One shuffle serves both the distinct links and each node's least neighbour: a node's row of that becomes its
        # own link to it, the rows of its other neighbours theirs.
        small = large.repartition("u").dropDuplicates(["u", "v"]).withColumn("m", least)
        edges = staged(small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")), "stars")
        # Done when each node has one root and no root has a root of its own.
        ends = edges.select(F.col("u").alias("x"), F.col("v").alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("x"), F.lit(None).cast("long").alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("x").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.max("down").alias("down")).filter("low <> high or low is not null and down = 1").isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def small_pairs(members: DataFrame) -> DataFrame:
    """a, b (a < b): all pairs inside the buckets of ``members`` (bucket, node), of SMALL members at most."""
    lists = members.groupBy("bucket").agg(F.sort_array(F.collect_list("node")).alias("x"))
    pairs = F.expr("flatten(transform(x, (a, i) -> transform(slice(x, i + 2, size(x)), b -> struct(a as a, b as b))))")
    return lists.select(F.explode(pairs).alias("p")).select("p.a", "p.b")


def leader_pairs(members: DataFrame) -> DataFrame:
    """a, b (a < b): all members of the buckets of ``members`` (bucket, node, n, met) with the bucket's leaders, the
    members of greatest ``met`` in each of LEADERS places that members are dealt to by hash. A bucket's members meet
    them in parts, so that no bucket is one task's."""
    place = F.pmod(F.xxhash64("node", F.lit(LEADERS)), F.lit(LEADERS))
    leaders = members.groupBy("bucket", place.alias("place")).agg(F.min(F.struct((-F.col("met")).alias("m"), F.xxhash64("node").alias("h"), F.col("node").alias("leader"))).alias("l"), F.max("n").alias("n"))
    lists = leaders.groupBy("bucket").agg(F.collect_list("l.leader").alias("leaders"), F.max("n").alias("n"))  # LEADERS at most
    lists = lists.select("bucket", "leaders", F.explode(F.expr(f"sequence(0L, n div {DEALT})")).alias("part"))
    met = members.withColumn("part", F.expr(f"pmod(xxhash64(node, bucket), n div {DEALT} + 1)")).join(lists, ["bucket", "part"])
    met = met.select("node", F.explode(F.filter("leaders", lambda x: x != F.col("node"))).alias("leader"))
    return met.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))


def met_in(keyed: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(members of small buckets, members of large ones) of ``keyed`` (bucket, node, ...), with the bucket's n; what is
    alone in its bucket goes."""
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = staged(keyed.join(sizes, "bucket"), name)
    return members.filter(F.col("n") <= SMALL), members.filter(F.col("n") > SMALL)


def with_nodes(rows: DataFrame, *known: DataFrame) -> DataFrame:
    """``rows`` (node, ...) with the columns of ``known`` (node, ...; one row for each node). A node's rows meet these as
    one list, so that a join makes one row for each node, however many rows a node has."""
    met = rows.groupBy("node").agg(F.collect_list(F.struct(*(c for c in rows.columns if c != "node"))).alias("rows"))
    for more in known:
        met = met.join(more, "node")
    return met.withColumn("row", F.explode("rows")).drop("rows").select(*(c for c in met.columns if c != "rows"), "row.*")


def agreeing_pairs(band: int, i: int, j: int, block: np.ndarray, node: np.ndarray, root: np.ndarray, weight: np.ndarray, sig: np.ndarray, probe: np.ndarray) -> Iterator[tuple[int, int]]:
    """Places (x, y) of members of different classes whose samples agree often enough, between blocks ``i`` and ``j`` of
    a bucket (or inside one). A pair that also shares the bucket of an earlier band is left to that, where it is
    compared as well."""
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    step = max(1, CELLS_AT_ONCE // max(1, len(right)))
    for k in range(0, len(left), step):
        some = left[k : k + step]
        open_ = root[some][:, None] != root[right][None, :]
        if i == j:
            open_ &= node[some][:, None] < node[right][None, :]
        w, v = weight[some][:, None], weight[right][None, :]
        open_ &= np.minimum(w, v) >= LEAST_RATIO * np.maximum(w, v)
        if not open_.any():
            continue
        agree = np.zeros(open_.shape, np.uint8)
        for first in range(0, SAMPLES, ROWS):
            same = [sig[some, c][:, None] == sig[right, c][None, :] for c in range(first, first + ROWS)]
            for x in same:
                agree += x
            if first < band * ROWS:
                open_ &= ~np.logical_and.reduce(same)
        a, b = np.nonzero(open_ & (agree >= LEAST_AGREE))
        a, b = some[a], right[b]
        for at in range(0, len(a), 4096):
            x, y = a[at : at + 4096], b[at : at + 4096]
            fit = (probe[x] == probe[y]).sum(axis=1) >= FINE_AGREE
            yield from zip(x[fit].tolist(), y[fit].tolist())


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags; 0 if both are empty."""
    (h, v), (g, w) = x, y
    _, i, j = np.intersect1d(h, g, assume_unique=True, return_indices=True)
    common = float(np.minimum(v[i], w[j]).sum(dtype=np.float64))
    whole = float(v.sum(dtype=np.float64) + w.sum(dtype=np.float64)) - common
    return common / whole if whole else 0.0


def in_blocks(classed: DataFrame) -> DataFrame:
    """Rows (bucket, i, j, block, ...) of ``classed`` (bucket, node, root, weight, ...): each block of members outside
    the bucket's largest class (the first blocks) meets every block, and itself, in a group (i, j) of rows of its own.
    Blocks of the largest class, whose members are one class already, don't meet; buckets of one class go."""
    classes = classed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))
    sums = classes.groupBy("bucket").agg(F.max(F.struct("n", "root", "w")).alias("most"), F.sum("n").alias("n"), F.sum("w").alias("w")).filter("n > most.n")
    blocks = "cast(ceil(greatest({n} / %sD, {w} / %sD)) as int)" % (float(BLOCK), float(BLOCK_WEIGHT))
    sums = sums.select("bucket", F.col("most.root").alias("largest"), F.expr(blocks.format(n="(n - most.n)", w="(w - most.w)")).alias("n_out"), F.expr(blocks.format(n="most.n", w="most.w")).alias("n_in"))
    placed = classed.join(sums, "bucket").withColumn("block", F.expr("cast(if(root = largest, n_out + pmod(xxhash64(node, bucket), n_in), pmod(xxhash64(node, bucket), n_out)) as int)"))
    placed = placed.withColumn("other", F.explode(F.expr("sequence(0, if(root = largest, n_out, n_out + n_in) - 1)")))
    return placed.select(*classed.columns, "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def left_out(crowd: DataFrame, known: DataFrame, texts: DataFrame, roots: DataFrame, idf: Frequencies) -> DataFrame:
    """a, b: links that make one class of all that similar pairs between classes join in the large buckets ``crowd``
    (bucket, band, node). All pairs of members of different classes are compared, but for those that links found in the
    same two blocks have joined. ``known``: node, sig, weight, probe; ``texts``: node, text; ``roots``: node, root of
    the classes so far."""
    shared = crowd.sparkSession.sparkContext.broadcast(idf)

    def compare(keys: tuple, table: pa.Table) -> pa.Table:
        node, root, weight, block = (table.column(c).to_numpy() for c in ("node", "root", "weight", "block"))
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u4").reshape(-1, SAMPLES)
        probe = np.frombuffer(b"".join(table.column("probe").to_pylist()), np.uint8).reshape(-1, FINE_SAMPLES)
        text, shingler, weights, bags, up, out = table.column("text"), Shingler(), shared.value, {}, {}, [[], []]

        def bag_of(x: int) -> tuple[np.ndarray, np.ndarray]:
            if x not in bags:
                bags[x] = bag(shingler.hashes(text[x].as_py()), weights)
            return bags[x]

        def top(x: int) -> int:
            while x in up:
                x = up[x]
            return x

        for x, y in agreeing_pairs(table.column("band")[0].as_py(), keys[1].as_py(), keys[2].as_py(), block, node, root, weight, sig, probe):
            r, q = top(int(root[x])), top(int(root[y]))
            if r != q and similarity(bag_of(x), bag_of(y)) >= SIMILAR:
                up[max(r, q)] = min(r, q)
                out[0].append(int(node[x]))
                out[1].append(int(node[y]))
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})

    weights = known.select("node", "weight").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classed = staged(with_nodes(crowd.select("bucket", "band", "node"), weights), "classed")
    placed = with_nodes(in_blocks(classed), known.select("node", "sig", "probe"), texts)
    placed = placed.select("bucket", "i", "j", "band", "block", "node", "root", "sig", "weight", "probe", "text")
    return staged(placed.groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long"), "left_out")


def joined_classes(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) after further ``links`` (a, b) between their classes, or between texts without one."""
    ends = links.select("a", "b")
    for end in "ab":
        ends = ends.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    more = staged(components(ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))), "joined")
    moved = roots.join(more.select(F.col("node").alias("root"), F.col("root").alias("new")), "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    return moved.unionByName(more.join(roots, "node", "left_anti"))


def candidates(unique: DataFrame, texts, idf: Frequencies) -> tuple[DataFrame, DataFrame, DataFrame | None, DataFrame]:
    """(a, b) whose samples agree often enough, and the texts (node, text) of all that share a bucket; the members
    (bucket, band, node) of large buckets, not all of whose pairs are among these, None without any; what is known of
    all that share a bucket. ``unique``: node, sig, weight, ...; ``texts``: from nodes to their texts."""
    keys = F.posexplode(F.expr(f"transform(sequence(0, {BANDS - 1}), k -> xxhash64(k, substring(sig, {4 * ROWS} * k + 1, {4 * ROWS})))"))
    small, large = met_in(unique.filter("sig is not null").select("node", keys.alias("band", "bucket")), "coarse")
    crowd = large.select("bucket", "band", "node")
    shared = staged(texts(small.select("node").unionByName(large.select("node")).distinct()), "candidate_texts")
    compared, led, fine = small.select("bucket", "node"), None, None
    crowded = staged(large.select("node").distinct(), "crowded")
    if not crowded.isEmpty():
        fine = staged(fine_signatures(shared.join(crowded, "node"), idf), "fine_signatures")
        open_members, central, width = fine.select("node", F.posexplode("keys").alias("band", "key")).select("node", "band", F.xxhash64(F.lit(1), "band", "key").alias("bucket")), None, 1
        while open_members is not None:
            small, large = met_in(open_members, f"fine_{width}")
            compared = compared.unionByName(small.select("bucket", "node"))
            if central is None:
                # A member that meets many others stands near the middle of its group: most others link with it.
                central = staged(small.unionByName(large).groupBy("node").agg(F.sum("n").alias("met")), "central")
            if large.isEmpty():
                break
            led = large.select("bucket", "node", "n") if led is None else led.unionByName(large.select("bucket", "node", "n"))
            if width == FINE_BANDS:
                break
            width = min(2 * width, FINE_BANDS)
            deeper = ", ".join(f"keys[(band + {j}) % {FINE_BANDS}]" for j in range(width))
            open_members = with_nodes(large.select("node", "band"), fine.select("node", "keys")).select("node", "band", F.expr(f"xxhash64({width}, band, {deeper})").alias("bucket"))
    pairs = small_pairs(compared)
    if led is not None:
        pairs = pairs.unionByName(leader_pairs(with_nodes(led, central)))
    known = unique.select("node", "sig", "weight") if fine is None else unique.select("node", "sig", "weight").join(fine.select("node", "probe"), "node", "left")
    known = staged(known.join(shared.select("node"), "node"), "known")
    if fine is None:
        known = known.withColumn("probe", F.lit(None).cast("binary"))
    left, right = (known.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("sig", "weight", "probe"))) for x in "ab")
    able = F.least("weight_a", "weight_b") >= LEAST_RATIO * F.greatest("weight_a", "weight_b")
    fits = F.expr(f"if(probe_a is null or probe_b is null, {agreeing('sig_a', 'sig_b', SAMPLES, 4)} >= {LEAST_AGREE}, {agreeing('probe_a', 'probe_b', FINE_SAMPLES, 1)} >= {FINE_AGREE})")
    pairs = staged(pairs.distinct().join(left, "a").join(right, "b").filter(able).filter(fits).select("a", "b"), "pairs")
    return pairs, shared, None if fine is None else crowd, known


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, content, class_id, class_content of every document; (class_id, class_content) is the class's row that stays."""
    with scratch(docs.sparkSession):
        idf = inverse_frequency(docs, text_col)
        signed = staged(signatures(docs, idf, id_col, text_col), "signatures", keep=True)
        # One row for each text: the least id stands for all copies. Texts are nodes by a key of their own, as ids may be null or shared.
        distinct = signed.groupBy("content").agg(F.min("doc_id").alias("doc_id"), F.first("sig", ignorenulls=True).alias("sig"), F.first("weight").alias("weight"))
        unique = staged(distinct.select(F.monotonically_increasing_id().alias("node"), "doc_id", "content", "sig", "weight"), "texts")

        def texts(nodes: DataFrame) -> DataFrame:
            rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), content_of(F.col(text_col)).alias("content"))
            wanted = staged(unique.join(nodes, "node").select("node", "doc_id", "content"), "wanted")
            # Repeated rows have one text: copies collapse, those without doc_id before they travel.
            # By merge at any size: a broadcast would not bear all candidates of a large table.
            named = rows.filter("doc_id is not null").join(wanted.hint("merge"), ["doc_id", "content"]).dropDuplicates(["doc_id", "content"]).select("node", "text")
            unnamed = rows.filter("doc_id is null").groupBy("content").agg(F.first("text").alias("text")).join(wanted.filter("doc_id is null").select("node", "content"), "content").select("node", "text")
            return named.unionByName(unnamed)

        pairs, shared, crowd, known = candidates(unique, texts, idf)
        roots = components(verified(pairs, shared, idf).select("a", "b"))
        if crowd is not None:
            roots = staged(roots, "roots")
            links = left_out(crowd, known, shared, roots, idf)
            if not links.isEmpty():
                roots = joined_classes(roots, links)
        classes = unique.select("content", "doc_id", "node").join(roots, "node", "left")
        heads = classes.filter("root is not null").groupBy("root").agg(F.min(first_of("doc_id", "content")).alias("head"))
        linked = classes.filter("root is not null").join(heads, "root").select("content", F.col("head.id").alias("class_id"), F.col("head.content").alias("class_content"))
        alone = classes.filter("root is null").select("content", F.col("doc_id").alias("class_id"), F.col("content").alias("class_content"))
        classes = staged(linked.unionByName(alone), "classes", keep=True)
    return signed.select("doc_id", "content").join(classes, "content").select("doc_id", "content", "class_id", "class_content")


STAYS = "doc_id <=> class_id and content = class_content"


def near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, kept of every document. Rows with the same doc_id (or none) and text are marked alike."""
    return near_classes(docs).select("doc_id", "class_id", F.expr(STAYS).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that of the least doc_id, or one without if the class has none (rows
    repeated whole count once)."""
    with scratch(docs.sparkSession):
        keep = near_classes(docs).filter(STAYS).select(F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("content").alias("_content"))
        keep = staged(keep.distinct(), "kept", keep=True)
    rows = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("_row"), F.col("doc_id").isNull().alias("_none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"), content_of(F.col("text")).alias("_content"))
    return rows.join(keep, ["_none", "_id", "_content"]).dropDuplicates(["_none", "_id", "_content"]).select("_row.*")
