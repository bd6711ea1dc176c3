"""Chat formatting by minimum-cost role repair.

A legal conversation is: at most one system message, first; then user and assistant messages in turn, user first,
assistant last. Dynamic programming over that automaton chooses, for each turn in order, to keep it, to relabel it, to
merge it into the message before, or to insert empty messages ahead of it, at the least total cost; the repaired
conversation is then rendered.

One conversation may hold a third of all rows, so no conversation is gathered: turns are range-partitioned by
(conversation, turn), each part reduces its first and last conversation to a matrix of least costs between states,
the driver chains those matrices (two rows a part), and each part then decodes its own turns.

Defined results: roles are compared without case and surrounding blanks; unknown or null roles may take any role at
little cost; a null text is empty; empty turns merge cheaply; turns with equal numbers are ordered by role and text,
and rows repeated whole are all kept; a null conv_id is a conversation of its own; an empty table gives an empty
result; other columns are ignored. Rendered text of a conversation is its ``rendered`` fragments joined in order of
(turn_no).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.llm.common import staged

ROLES = ("system", "user", "assistant")
#: States: nothing yet, or the role of the message that is open.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = (START, ASSISTANT)
COSTS = {"keep": 0.0, "relabel": 3.0, "relabel_unknown": 0.5, "merge_same": 1.0, "merge_other": 4.0, "merge_empty": 0.25, "insert": 2.0}
INF = float("inf")
# The rendering's marks.
OPEN, CLOSE, JOIN = "<|{}|>\n", "<|end|>\n", "\n\n"
#: A part's rows and bytes of text, about.
PART_ROWS, PART_BYTES = 100_000, 32 << 20
SCHEMA = "conv_id long, turn_no long, turn long, role string, new_role string, action string, inserted int, cost double, rendered string"


def insertions() -> dict[int, dict[int, tuple[float, tuple[int, ...]]]]:
    """state -> state -> (cost, roles inserted): the shortest chains of empty messages."""
    out = {}
    for start in range(4):
        reached, edge = {start: (0.0, ())}, [start]
        while edge:
            nxt = []
            for s in edge:
                for t in FOLLOWS[s]:
                    if t not in reached:
                        reached[t] = (reached[s][0] + COSTS["insert"], (*reached[s][1], t))
                        nxt.append(t)
            edge = nxt
        out[start] = reached
    return out


INSERT = insertions()


def moves(role: int, empty: bool) -> list[list[tuple[float, str, tuple[int, ...]]]]:
    """[from][to] -> (cost, action, inserted) for a turn of ``role`` (0: unknown)."""
    table = [[(INF, "", ()) for _ in range(4)] for _ in range(4)]
    for s in range(4):
        for between, (cost, chain) in INSERT[s].items():
            for t in FOLLOWS[between]:
                action = "keep" if t == role else "relabel"
                c = cost + (COSTS["keep"] if t == role else COSTS["relabel"] if role else COSTS["relabel_unknown"])
                table[s][t] = min(table[s][t], (c, action, chain))
        if s != START:
            c = COSTS["merge_empty"] if empty else COSTS["merge_same"] if role in (0, s) else COSTS["merge_other"]
            table[s][s] = min(table[s][s], (c, "merge", ()))
    return table


MOVES = {(r, e): moves(r, e) for r in range(4) for e in (False, True)}
END = [min((INSERT[s][f] for f in FINAL if f in INSERT[s])) for s in range(4)]


def product(a: list[list[float]], b: list[list[float]]) -> list[list[float]]:
    return [[min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)] for i in range(4)]


IDENTITY = [[0.0 if i == j else INF for j in range(4)] for i in range(4)]


def summary(codes: list[tuple[int, bool]]) -> list[list[float]]:
    out = IDENTITY
    for code in codes:
        out = product(out, [[c for c, _, _ in row] for row in MOVES[code]])
    return out


def decode(codes: list[tuple[int, bool]], entry: list[float], leaving: list[float]) -> list[tuple[int, int, float, str, tuple[int, ...]]]:
    """Viterbi of a run of turns between costs of entering in and leaving from each state: (from, to, cost, action,
    inserted) of each turn. Ties go to the lower state, so neighbouring runs choose the same states."""
    best, back = entry, []
    for code in codes:
        table = MOVES[code]
        step = [min((best[s] + table[s][t][0], s) for s in range(4)) for t in range(4)]
        back.append([s for _, s in step])
        best = [c for c, _ in step]
    t = min(range(4), key=lambda s: (best[s] + leaving[s], s))
    path = []
    for code, prev in zip(reversed(codes), reversed(back)):
        s = prev[t]
        path.append((s, t, *MOVES[code][s][t]))
        t = s
    return path[::-1]


def code_of(role: str | None, text: str | None) -> tuple[int, bool]:
    name = (role or "").strip().lower()
    return (ROLES.index(name) + 1 if name in ROLES else 0), not (text or "").strip()


def runs_of(keys: list) -> Iterator[tuple[int, int]]:
    start = 0
    for k in range(1, len(keys) + 1):
        if k == len(keys) or keys[k] != keys[start]:
            yield start, k
            start = k


def chain(rows: list) -> dict[tuple[int, int], tuple[int, int, list[float], list[float]]]:
    """From the parts' first and last runs, in order: (part, run) -> (first number, is last, entry, leaving).

    A conversation's states between parts are chosen here once, so that all parts decode one and the same best path:
    entry and leaving costs are 0 for the chosen state and infinite for the others."""
    out, k = {}, 0
    rows = sorted(rows, key=lambda r: (r["part"], r["run"]))
    while k < len(rows):
        end = k + 1
        while end < len(rows) and rows[end]["key"] == rows[k]["key"] and rows[end]["part"] != rows[end - 1]["part"]:
            end += 1
        group = rows[k:end]
        best, back = [0.0, INF, INF, INF], []
        for r in group:
            m = [list(r["matrix"][4 * i : 4 * i + 4]) for i in range(4)]
            step = [min((best[s] + m[s][t], s) for s in range(4)) for t in range(4)]
            back.append([s for _, s in step])
            best = [c for c, _ in step]
        t = min(range(4), key=lambda s: (best[s] + END[s][0], s))
        states = [t]
        for prev in reversed(back):
            states.append(t := prev[t])
        states.reverse()
        number = 0
        for r, a, b in zip(group, states, states[1:]):
            out[r["part"], r["run"]] = (number, int(r is group[-1]), *([0.0 if s == x else INF for s in range(4)] for x in (a, b)))
            number += r["n"]
        k = end
    return out


def repair(turns: DataFrame) -> DataFrame:
    """One row for each turn: the role and action it gets, empty messages inserted before it, cost and rendering."""
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", key.alias("key"))
    rows = rows.withColumn("tie", F.xxhash64("role", "text")).withColumn("row", F.monotonically_increasing_id())
    order = ["key", "turn", "tie", "row"]
    # Parts are one pandas frame each, so their number follows the table's rows and bytes.
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    parts = max(1, -(-total.n // PART_ROWS), -(-total.bytes // PART_BYTES))
    # Every row has its own place in the range order, so that no part grows with a conversation or a repeated row.
    dealt = staged(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "turns")

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, na_position="first")
        keys, codes = pdf["key"].tolist(), [code_of(r, t) for r, t in zip(pdf["role"], pdf["text"])]
        runs = list(runs_of(keys))
        return pd.DataFrame([
            (int(pdf["part"].iloc[0]), k, keys[a], b - a, [x for row in summary(codes[a:b]) for x in row])
            for k, (a, b) in enumerate(runs) if k in (0, len(runs) - 1)
        ], columns=["part", "run", "key", "n", "matrix"])

    slim = dealt.select("part", *order, "role", F.when(F.trim("text") != "", F.lit("x")).alias("text"))
    ends = chain(slim.groupBy("part").applyInPandas(summarise, "part int, run int, key string, n long, matrix array<double>").collect())  # two rows a part

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, na_position="first")
        keys, part = pdf["key"].tolist(), int(pdf["part"].iloc[0])
        codes, texts = [code_of(r, t) for r, t in zip(pdf["role"], pdf["text"])], pdf["text"].tolist()
        convs, turns_, roles = pdf["conv"].tolist(), pdf["turn"].tolist(), pdf["role"].tolist()
        out = []
        for k, (a, b) in enumerate(runs_of(keys)):
            number, last, entry, leaving = ends.get((part, k), (0, 1, [0.0, INF, INF, INF], [c for c, _ in END]))
            for j, (s, t, cost, action, chain_) in enumerate(decode(codes[a:b], entry, leaving)):
                text = texts[a + j] or ""
                pieces = []
                before = s
                for r in chain_:
                    pieces.append((CLOSE if before else "") + OPEN.format(ROLES[r - 1]))
                    before = r
                pieces.append((JOIN if action == "merge" else (CLOSE if before else "") + OPEN.format(ROLES[t - 1])) + text)
                if last and a + j == b - 1:
                    for r in END[t][1]:
                        pieces.append(CLOSE + OPEN.format(ROLES[r - 1]))
                    cost += END[t][0]
                    pieces.append(CLOSE)
                out.append((convs[a + j], number + j, turns_[a + j], roles[a + j], ROLES[t - 1], action, len(chain_), cost, "".join(pieces)))
        frame = pd.DataFrame(out, columns=["conv_id", "turn_no", "turn", "role", "new_role", "action", "inserted", "cost", "rendered"])
        return frame.assign(conv_id=frame["conv_id"].astype("Int64"), turn=frame["turn"].astype("Int64"))

    full = dealt.select("part", *order, F.col("conv_id").alias("conv"), "role", "text")
    return full.groupBy("part").applyInPandas(decide, SCHEMA)


def render(turns: DataFrame) -> DataFrame:
    """conv_id, text: whole conversations, for those short enough to be rows (a conversation's text is one value)."""
    fragments = F.array_sort(F.collect_list(F.struct("turn_no", "rendered")))
    return repair(turns).groupBy("conv_id").agg(F.array_join(F.transform(fragments, lambda x: x["rendered"]), "").alias("text"), F.sum("cost").alias("cost"))
