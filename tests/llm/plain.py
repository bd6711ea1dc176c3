"""Plain versions of the pipeline's stages, for comparison."""

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import md5

import numpy as np
from digestloom.llm import minhash, mixing, packing, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signals(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = [tuple(words[k : k + 5]) for k in range(n - 4)]
    times = Counter(windows)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len({p for k, w in enumerate(windows) if times[w] > 1 for p in range(k, k + 5)}), "n_upper": sum("A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" for c in text),
        "n_marks": text.count("!") + text.count("?"), "n_distinct": len(set(words)), "n_stutter": sum(a == b for a, b in zip(words, words[1:])), "n_single": sum(len(w) == 1 for w in words),
        "n_signed": sum(bool(re.search(r"[#*$%&|<>]", w)) for w in words),
    }


def votes(s):
    holds = lambda rule: eval(re.sub(r"(.+) between (.+) and (.+)", r"\2 <= \1 <= \3", rule), {}, s)  # noqa: E731, S307
    return tuple(-1 if holds(bad) else 1 if holds(good) else 0 for bad, good in quality.RULES.values())


def estimate(patterns, p, rounds):
    """EM over {votes: n} from probabilities ``p`` by votes."""
    m = len(quality.RULES)
    for _ in range(rounds + 1):
        share = (sum(n * p[v] for v, n in patterns.items()) + quality.PRIOR_TEXTS[0]) / (sum(patterns.values()) + sum(quality.PRIOR_TEXTS))
        rate = lambda j, right, weight, prior: (sum(n * weight(v) for v, n in patterns.items() if v[j] == right) + prior[0]) / (sum(n * weight(v) for v, n in patterns.items() if v[j]) + sum(prior))
        good = [rate(j, 1, lambda v: p[v], quality.PRIOR_GOOD) for j in range(m)]
        bad = [rate(j, -1, lambda v: 1 - p[v], quality.PRIOR_BAD) for j in range(m)]
        odds = {v: math.log(share / (1 - share)) + sum(math.log(good[j] / (1 - bad[j])) if x == 1 else math.log((1 - good[j]) / bad[j]) if x else 0 for j, x in enumerate(v)) for v in patterns}
        p = {v: 1 / (1 + math.exp(-o)) for v, o in odds.items()}
    return p


def good(texts):
    """Whether each text is kept."""
    counted = [signals(t) for t in texts]
    voted = [votes(s) for s in counted]
    p = estimate(Counter(voted), {v: quality.START[min(2, v.count(-1))] for v in voted}, quality.ROUNDS)
    return [not (s["n_words"] < 10 or 100 * s["n_repeat_words"] > 20 * s["n_words"]) and p[v] >= 0.5 for s, v in zip(counted, voted)]


def first(rows):
    """Of rows (id, text): the one of the least id, one without id last."""
    return min(rows, key=lambda r: (r[0] is None, r[0] or 0))


def without_copies(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r)
    return [first(g) for g in groups.values()]


def near_classes(texts, idf):
    """The class (least member) of each of the distinct ``texts``."""
    shingler = minhash.Shingler()
    bags = [minhash.bag(shingler.hashes(t), idf) for t in texts]
    root, index = list(range(len(texts))), defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (h, _) in enumerate(bags):
        for x in h.tolist() or ["none"]:
            index[x].append(k)
    for a, b in {p for some in index.values() for p in itertools.combinations(some, 2)}:
        (h, v), (g, w) = bags[a], bags[b]
        if not len(h) and not len(g):
            similar = True
        else:
            _, i, j = np.intersect1d(h, g, assume_unique=True, return_indices=True)
            common = float(np.minimum(v[i], w[j]).sum(dtype=np.float64))
            similar = common / (float(v.sum(dtype=np.float64) + w.sum(dtype=np.float64)) - common) >= minhash.SIMILAR
        if similar:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(texts))]


def without_near_copies(rows, idf):
    """Of distinct texts, one of each class."""
    classes = defaultdict(list)
    for r, c in zip(rows, near_classes([r[1] for r in rows], idf)):
        classes[c].append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0, md5((r[1] or "").encode()).digest())) for g in classes.values()]


def mixed(rows):
    """How often each of ``rows`` (id, text, source) is taken, ids given and distinct."""
    h32 = lambda x: int(md5(x.encode()).hexdigest()[:8], 16)
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    by = defaultdict(list)
    for k, r in enumerate(rows):
        by[r[2]].append(k)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    have = {s: sum(size[k] for k in by[s]) for s in names}
    weight = {s: float(mixing.WEIGHTS[k % len(mixing.WEIGHTS)]) for k, s in enumerate(names)}
    full, left = {}, float(sum(have.values()))
    while True:
        rest = [s for s in names if s not in full]
        level = left / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if 3.0 * have[s] <= weight[s] * level]
        if not over:
            break
        least = min(over, key=lambda s: (3.0 * have[s] / weight[s], names.index(s)))
        full[least] = 3.0 * have[least]
        left -= full[least]
    out = [0] * len(rows)
    for s in names:
        target = full.get(s, weight[s] * level)
        rate = target / have[s] if have[s] else 0.0
        key = "n" if s is None else "s" + s
        bucket = lambda k: (size[k] if size[k] < 8 else (size[k].bit_length() - 1) * 8 + (size[k] >> (size[k].bit_length() - 4) & 7)) * mixing.SPREAD + h32(f"{mixing.SEED}|{rows[k][0]}") % mixing.SPREAD
        offset = h32(f"{mixing.SEED}|{key}") % 1048576 / 1048576
        for rank, k in enumerate(sorted(by[s], key=lambda k: (bucket(k), size[k], rows[k][0]))):
            out[k] = math.floor((rank + 1) * rate + offset) - math.floor(rank * rate + offset)
    return out


def pieces(rows, tokenizer):
    """(id, start, length, crc32 of its ids, tokens) of every row's pieces."""
    out = []
    for i, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        for at in range(0, len(ids), packing.SEQUENCE):
            part = ids[at : at + packing.SEQUENCE]
            out.append((i, at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes()), len(ids)))
    return out


def packed(lengths, sequence):
    """How full each pack is, longest lengths first, each into the open pack with the most room."""
    import heapq

    packs = []
    for n in sorted(lengths, reverse=True):
        if packs and sequence - packs[0] >= n:
            heapq.heapreplace(packs, packs[0] + n)
        else:
            heapq.heappush(packs, n)
    return Counter(packs)
