"""Toxicity by noisy-channel deobfuscation.

A character 4-gram language model is counted over all documents. Where a text shows signs of disguise (digits or signs
inside words, letters spaced out, letters repeated three times or more) the span becomes a lattice of the characters
each sign may stand for, and Viterbi finds the likeliest restoration under the language model and the channel's costs.
Words of the restored text, and their beginnings, are scored by a logistic model with weights of zero or more, fitted
on at most ``MAX_TRAIN`` labelled documents (the bound of the training sample; all statistics of the language model
cover all documents).

Tables that reach the driver are bounded: 4-gram counts by ``LETTERS ** 4``, features by ``MAX_FEATURES``, training
rows by ``MAX_TRAIN``. Training, restoring and scoring read documents in narrow passes.

Defined results: null, empty and wordless texts get the score of no evidence; without labelled documents of both
kinds all scores are the share of toxic labels (0 without labels); repeated rows get equal scores; a document labelled
twice counts twice; labels, lang, source and doc_id are not read when scoring; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.llm.common import staged

# The model's alphabet; place 0 is the edge of a word and stands for all else.
ALPHABET = "\0abcdefghijklmnopqrstuvwxyzäöüßéèêçñíóáú"
LETTERS = len(ALPHABET)
# What a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
MAX_TRAIN, MAX_FEATURES = 20_000, 600
#: A feature must occur in so many toxic training documents, however many there are, and be so significant.
MIN_POSITIVE, LEAST_GAIN = 5, 4
#: Lengths of the word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Costs, in nats, of reading a sign as a letter, of undoing a repetition and of a word edge inside a spaced span.
COST_SIGN, COST_REPEAT, COST_EDGE = 1.0, 0.5, 3.0
#: Spans up to this length are remembered when restored; longer ones are restored each time.
MEMO_LENGTH = 40
WORDS = re.compile(r"[^\W\d_]+")
#: Signs that are no digits; they may stand for letters in spaced words too.
MARKS = "".join(c for c in LEET if not c.isdigit())
UNIT = rf"(?:[^\W_]|[{re.escape(MARKS)}])"
SPACED = re.compile(rf"(?<![^\W_])(?:{UNIT}[ .\-_*]{{1,2}}){{3,}}{UNIT}(?![^\W_])")
#: Runs of letters, digits and signs. One with a letter and a sign in it may be disguised.
RUNS = re.compile(rf"[\w{re.escape(MARKS)}]+")
LETTER, SIGN = re.compile(r"[^\W\d_]"), re.compile(rf"[{re.escape(''.join(LEET))}]")
REPEATED = re.compile(r"([^\W\d_])\1\1+")


def letter_codes() -> np.ndarray:
    """Code point -> place in the alphabet, for code points under 256 (the rest are 0)."""
    table = np.zeros(256, np.int64)
    for k, c in enumerate(ALPHABET[1:], 1):
        table[ord(c)] = k
        if len(c.upper()) == 1 and ord(c.upper()) < 256:
            table[ord(c.upper())] = k
    return table


#: Kinds of characters to the gate, as the patterns above have them.
IS_LETTER, IS_SIGN, IS_UNIT, IS_GAP, IN_RUN = 1, 2, 4, 8, 16


def kinds() -> np.ndarray:
    """Code point -> its kinds, for code points under 256; place 256 stands for all others, which may be letters."""
    patterns = {IS_LETTER: LETTER, IS_SIGN: SIGN, IS_UNIT: re.compile(UNIT), IS_GAP: re.compile(r"[ .\-_*]"), IN_RUN: RUNS}
    table = [sum(kind for kind, p in patterns.items() if p.fullmatch(chr(k))) for k in range(256)]
    return np.array([*table, IS_LETTER | IS_UNIT | IN_RUN], np.uint8)


#: Signs from code point 256 on.
WIDE = [ord(c) for c in LEET if ord(c) >= 256]


def all_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def points(text: str) -> np.ndarray:
    a = all_points(text)
    return np.where(a < 256, a, 0)


def gram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of all 4-grams of letters and word edges over all documents, at most LETTERS ** 4."""
    size = LETTERS**4

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total, held, waiting = letter_codes(), np.zeros(size, np.int64), [], 0
        edge = np.zeros(3, np.int64)

        def add() -> None:
            nonlocal waiting
            a = np.concatenate(held)
            total[:] += np.bincount(((a[:-3] * LETTERS + a[1:-2]) * LETTERS + a[2:-1]) * LETTERS + a[3:], minlength=size)
            held.clear()
            waiting = 0

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    held += [edge, table[points(text)], edge]
                    waiting += len(text)
                    if waiting > 1_000_000:
                        add()
        if held:
            add()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["gram", "n"])

    found = docs.select(text_col).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, np.float64)
    counts[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return counts


class LanguageModel:
    """log P(letter | three before), interpolated with shorter contexts."""

    def __init__(self, logp: np.ndarray) -> None:
        self.logp = logp

    @classmethod
    def of(cls, counts: np.ndarray) -> LanguageModel:
        c = counts.reshape((LETTERS,) * 4)
        uniform = np.full(LETTERS, 1 / LETTERS)
        p = uniform
        for k in (3, 2, 1, 0):
            n = c.sum(axis=tuple(range(k)))
            p = (n + 5 * p) / (n.sum(axis=-1, keepdims=True) + 5)
        return cls(np.log(p).astype(np.float32))

    def word(self, lattice: list[list[tuple[str, float]]]) -> str:
        """Viterbi: the likeliest path through ``lattice``, whose steps are (string, cost); a string may be empty."""
        # A path is (path before, string): its length costs nothing until the end, so time is linear in the lattice.
        best: dict[tuple[int, int, int], tuple[float, tuple | None]] = {(0, 0, 0): (0.0, None)}
        for options in [*lattice, [("\0", 0.0)]]:
            to: dict[tuple[int, int, int], tuple[float, tuple | None]] = {}
            for state, (score, path) in best.items():
                for string, cost in options:
                    s, value = state, score - cost
                    for c in string:
                        k = INDEX.get(c, 0)
                        value += float(self.logp[s[0], s[1], s[2], k])
                        s = (s[1], s[2], k)
                    if s not in to or value > to[s][0]:
                        to[s] = (value, (path, string))
            best = to
        path, strings = max(best.values(), key=lambda x: x[0])[1], []
        while path:
            strings.append(path[1])
            path = path[0]
        return "".join(reversed(strings)).strip("\0")


INDEX = {c: k for k, c in enumerate(ALPHABET)}


def lattice_of(span: str) -> list[list[tuple[str, float]]]:
    """Steps for a span in lower case: signs may be letters or edges, three letters alike may be one or two."""
    out: list[list[tuple[str, float]]] = []
    k = 0
    while k < len(span):
        c, end = span[k], k + 1
        if c in LEET:
            out.append([(x, COST_SIGN) for x in LEET[c]] + [("\0", 4 * COST_SIGN)])
        elif c.isalpha():
            while end < len(span) and span[end] == c:
                end += 1
            out.append([(c, COST_REPEAT), (c + c, COST_REPEAT)] if end - k >= 3 else [(span[k:end], 0.0)])
        else:
            out.append([("\0", 0.0)])
        k = end
    return out


def disguised(text: str, table: np.ndarray) -> tuple[bool, bool, bool]:
    """Whether a text may have letters repeated three times, runs of letters and signs, letters spaced out. Vectorised.
    Never False where the pattern matches."""
    a = all_points(text)
    if len(a) < 2:
        return False, False, False
    k = table[np.minimum(a, 256)]
    for c in WIDE:
        k[a == c] = IS_SIGN | IS_UNIT | IN_RUN
    letter, sign, unit, gap = ((k & kind) > 0 for kind in (IS_LETTER, IS_SIGN, IS_UNIT, IS_GAP))
    repeat = bool(np.any((a[2:] == a[1:-1]) & (a[1:-1] == a[:-2]) & letter[2:]))
    # A run with a sign and a letter has a sign next to something else of the run.
    plain = ((k & IN_RUN) > 0) & ~sign
    signs = bool(np.any(sign[:-1] & plain[1:]) or np.any(plain[:-1] & sign[1:]))
    # At least four units are spaced out, so two in a row have separators on both sides, one or two between them.
    lone = gap[:-2] & unit[1:-1] & gap[2:]
    spaced = bool(np.any(lone[:-2] & lone[2:]) or np.any(lone[:-3] & lone[3:]))
    return repeat, signs, spaced


def may_hide(run: str) -> bool:
    return bool(SIGN.search(run) and LETTER.search(run))


def parts_of(run: str) -> set[str]:
    """The run, and its parts where one of its signs joins words, if they may be disguised."""
    joins = [c for c in MARKS + "_" if c in run]
    return {part for part in (run, *(x for c in joins for x in run.split(c)), *(re.split(r"[\W_]+", run) if len(joins) > 1 else ())) if may_hide(part)}


def restored_words(text: str, model: LanguageModel, table: np.ndarray, memo: dict[str, str]) -> set[str]:
    """The words of the text in lower case, disguised ones restored (their plain parts stay words too)."""
    low = text.lower()
    words = set(WORDS.findall(low))
    repeat, signs, spaced = disguised(low, table)
    spans: set[str] = set()
    if repeat:
        spans |= {w for w in words if REPEATED.search(w)}
    if signs:
        spans |= {part for m in set(RUNS.findall(low)) if may_hide(m) for part in parts_of(m)}
    joined = {re.sub(r"[ .\-_*]+", "", m[0]) for m in SPACED.finditer(low)} if spaced else set()
    # Signs at the ends of a spaced word may be letters or not.
    joined |= {m.strip(MARKS) for m in joined}
    for span in spans:
        restored = memo.get(span)
        if restored is None:
            restored = model.word(lattice_of(span))
            if len(span) <= MEMO_LENGTH:
                if len(memo) > 200_000:
                    memo.clear()
                memo[span] = restored
        words.update(WORDS.findall(restored))
    for span in sorted(joined):
        steps = lattice_of(span)
        # Each letter may also begin a new word.
        words.update(WORDS.findall(model.word([step if not k else step + [("\0" + s, c + COST_EDGE) for s, c in step if s != "\0"] for k, step in enumerate(steps)])))
    return words


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}~" for n in BEGINNINGS if len(word) > n)]


def training_words(docs: DataFrame, labels: DataFrame, model: LanguageModel, max_train: int = MAX_TRAIN) -> DataFrame:
    """toxic, words (restored, distinct) of at most ``max_train`` labelled documents, those of the least hash."""
    chosen = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    shared = docs.sparkSession.sparkContext.broadcast(model.logp)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, table, memo = LanguageModel(shared.value), kinds(), {}
        for batch in batches:
            words = [sorted(restored_words(x or "", lm, table, memo)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(words, pa.list_(pa.string()))], ["toxic", "words"])

    # The chosen labels are max_train rows at most: the broadcast is bounded.
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")
    return staged(met.mapInArrow(restore, "toxic int, words array<string>"), "training_words")


def broadest(purity: dict[str, float]) -> list[str]:
    """Features without those that a shorter beginning, about as pure, stands for: the weight stays on stems."""
    kept: dict[str, float] = {}
    for f in sorted(purity, key=lambda f: (len(f.rstrip("~")), not f.endswith("~"), f)):
        if not any(g.endswith("~") and f.startswith(g[:-1]) and p >= 0.95 * purity[f] for g, p in kept.items()):
            kept[f] = purity[f]
    return list(kept)


def fit(training: DataFrame, max_features: int = MAX_FEATURES) -> tuple[dict[str, float], float]:
    """(weights by feature, bias): the features most unevenly spread over the labels, then a logistic model with
    weights of zero or more by projected gradient descent."""
    prefix = "flatten(transform(words, w -> filter(array(w{}), x -> x is not null)))".format("".join(f", if(length(w) > {n}, concat(substr(w, 1, {n}), '~'), null)" for n in BEGINNINGS))
    held = training.select("toxic", F.array_distinct(F.expr(prefix)).alias("features"))
    totals = held.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("pos")).first()
    n, pos = totals.n, totals.pos
    if not n or not pos or pos == n:
        return {}, math.log((pos + 1e-9) / (n - pos + 1e-9)) if n else -1e9
    spread = held.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("b")).filter(F.col("a") >= MIN_POSITIVE)
    # Signed square root of chi-squared, by share of toxic documents.
    base = pos / n
    gain = (F.col("a") - F.col("b") * base) / F.sqrt(F.col("b") * base * (1 - base))
    top = spread.select("feature", (F.col("a") / F.col("b")).alias("purity"), gain.alias("gain")).filter(F.col("gain") > LEAST_GAIN).orderBy(F.desc("gain"), "feature").limit(max_features)
    names = sorted(broadest({r.feature: r.purity for r in top.collect()}))
    if not names:
        return {}, math.log(pos / (n - pos))
    index = {f: k for k, f in enumerate(names)}
    chosen = F.array(*map(F.lit, names))
    rows = held.select("toxic", F.array_sort(F.array_intersect("features", chosen)).alias("features")).groupBy("toxic", "features").agg(F.count(F.lit(1)).alias("n")).toArrow()
    y, m = rows.column("toxic").to_numpy().astype(np.float64), rows.column("n").to_numpy().astype(np.float64)
    x = np.zeros((len(y), len(names)), np.float32)
    for k, fs in enumerate(rows.column("features").to_pylist()):
        x[k, [index[f] for f in fs]] = 1
    order = np.lexsort((*x.T[:8], y))  # the order of rows must not matter to the last digits
    x, y, m = x[order], y[order], m[order]
    w, b = np.zeros(len(names)), math.log(pos / (n - pos))
    vw, vb = np.full(len(names), 1e-8), 1e-8
    for _ in range(400):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        d = m * (p - y) / n
        gw, gb = x.T @ d + 2e-5 * w, d.sum()
        vw, vb = vw + gw * gw, vb + gb * gb
        w, b = np.maximum(0, w - 0.5 * gw / np.sqrt(vw)), b - 0.5 * gb / math.sqrt(vb)
    return {f: float(w[k]) for f, k in index.items() if w[k] > 1e-3}, float(b)


def score(docs: DataFrame, model: LanguageModel, weights: dict[str, float], bias: float, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((model.logp, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logp, w = shared.value
        lm = LanguageModel(logp)
        table, memo = kinds(), {}
        known: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                found: set[str] = set()
                for word in restored_words(text or "", lm, table, memo):
                    hit = known.get(word)
                    if hit is None:
                        if len(known) > 500_000:
                            known.clear()
                        hit = known[word] = tuple(f for f in features_of(word) if f in w)
                    if hit:
                        found.update(hit)
                z = bias + sum(w[f] for f in sorted(found))
                out.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(out, pa.float64()), pa.array([int(s >= threshold) for s in out], pa.int32())], ["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, score, predicted, learnt from ``labels`` (doc_id, toxic)."""
    model = LanguageModel.of(gram_counts(docs))
    weights, bias = fit(training_words(docs, labels, model, max_train))
    return score(docs, model, weights, bias, threshold)
