"""Quality rules by weak supervision.

Each rule reads a few counts of a text and votes good (1), bad (-1) or abstains (0). Expectation-maximisation over the
vote patterns estimates, without labels, how common good texts are and how often each rule is right on good and on bad
texts; a text is kept when its posterior probability of being good reaches a half. Only vote patterns are counted, at
most 3 ** rules rows whatever the input, and all steps are DataFrame or SQL functions.

The rules overlap: each kind of junk (signs in words, words repeated, capitals, tables without sentences) is seen by
two or more, which read it from different counts. So no rule needs to be right by decree: one bad vote among good ones
is outweighed where the rule turns out to err on good texts, and several bad votes are not. The accuracies have Beta
priors (PRIOR_GOOD, PRIOR_BAD): votes that each rule is imagined to have cast beforehand.

Defined results: a null text is an empty one; a text without words has no repeats, fails the base rules and is not
kept; ties are texts with the same votes and get the same posterior; an empty table gives an empty result; repeated
rows are judged alike; other columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestloom.llm.common import WORD, staged

SYMBOLS = "#*$%&|<>"
UPPER = r"A-Z\u00C0-\u00D6\u00D8-\u00DE"
WINDOW = 5
ROUNDS = 40
#: (right votes, wrong votes) that each rule is imagined to have cast on good and on bad texts, and (good, bad) texts:
#: a rule is thought right on nine of ten good texts and on every second bad one until the votes say otherwise.
PRIOR_GOOD, PRIOR_BAD, PRIOR_TEXTS = (9.0, 1.0), (1.0, 1.0), (9.0, 1.0)
#: Where EM starts: the probability of being good by number of bad votes (2: two or more).
START = (0.95, 0.5, 0.05)
#: name -> (bad if, good if), else the rule abstains. Over the columns of signals().
RULES = {
    "symbols": ("n_symbols > 0.08 * word_chars", "n_symbols <= 0.01 * word_chars"),
    "signed_words": ("n_signed > 0.3 * n_words", "n_signed <= 0.02 * n_words"),
    "repeats": ("n_repeat_words > 0.5 * n_words", "n_repeat_words <= 0.05 * n_words"),
    # A text of n words has some multiple of the root of n different ones.
    "vocabulary": ("n_distinct * n_distinct < 6 * n_words", "n_distinct * n_distinct >= 25 * n_words"),
    "stutter": ("n_stutter > 0.2 * n_words", "n_stutter <= 0.02 * n_words"),
    "lines": ("n_lines >= 4 and n_dup_lines > 0.2 * n_lines", "n_dup_lines <= 0"),
    "shouting": ("n_upper > 0.5 * word_chars", "n_upper <= 0.1 * word_chars"),
    "marks": ("n_marks > 0.5 * n_words", "n_marks <= 0.1 * n_words"),
    "single_characters": ("n_single > 0.3 * n_words", "n_single <= 0.1 * n_words"),
    "word_length": ("10 * word_chars < 33 * n_words or word_chars > 10 * n_words", "10 * word_chars between 45 * n_words and 80 * n_words"),
    # A weak sign: many good texts are short.
    "brief": ("n_words < 30", "n_words >= 100"),
}
SIGNALS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_distinct", "n_stutter", "n_single", "n_signed"]


def n_of(chars: str) -> Column:
    """How many of the text's code points are in the class ``chars``. Runs of them are cut out by a pattern, which makes
    an object for each run; translate makes one for each character of the text."""
    return (F.length("_text") - F.length(F.regexp_replace("_text", f"[{chars}]+", ""))).cast("long")


def signals(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of SIGNALS, taken from whole texts."""
    names = docs.columns
    d = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    d = d.withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    d = d.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: F.regexp_like(x, F.lit(WORD))))
    d = d.withColumns({
        "n_words": F.size("_words").cast("long"),
        "_symbols": n_of(SYMBOLS),
        "_hashes": F.expr(f"if(size(_words) < {WINDOW}, cast(array() as array<bigint>), transform(sequence(1, size(_words) - {WINDOW - 1}), i -> xxhash64(slice(_words, i, {WINDOW}))))"),
    })
    # Only texts in which some window recurs are sorted.
    d = d.withColumn("_sorted", F.expr("if(size(array_distinct(_hashes)) = size(_hashes), cast(array() as array<struct<h:bigint,i:int>>), array_sort(transform(_hashes, (h, i) -> struct(h as h, i as i))))"))
    d = d.withColumn("_starts", F.expr("array_sort(transform(filter(_sorted, (x, i) -> get(_sorted, i - 1).h <=> x.h or get(_sorted, i + 1).h <=> x.h), x -> x.i))"))
    counts = F.struct(
        "n_words",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.col("_symbols").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"cast(aggregate(transform(_starts, (x, i) -> least({WINDOW}, coalesce(get(_starts, i + 1) - x, {WINDOW}))), 0, (a, x) -> a + x) as bigint)").alias("n_repeat_words"),
        n_of(UPPER).alias("n_upper"),
        n_of("!?").alias("n_marks"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        F.expr("cast(size(filter(_words, (w, i) -> i > 0 and w = get(_words, i - 1))) as bigint)").alias("n_stutter"),
        F.expr("cast(size(filter(_words, w -> length(w) = 1)) as bigint)").alias("n_single"),
        F.expr(f"if(_symbols = 0, 0L, cast(size(filter(_words, w -> rlike(w, '[{SYMBOLS}]'))) as bigint))").alias("n_signed"),
    )
    # Through explode no filter on the counts is pushed down, which would work them out again inside each condition.
    return d.select(*names, F.explode(F.array(counts)).alias("_counts")).select(*names, "_counts.*")


def votes(rules=RULES):
    return F.array(*(F.expr(f"case when {bad} then -1 when {good} then 1 else 0 end") for bad, good in rules.values()))


def estimate(patterns: DataFrame, n_rules: int, rounds: int = ROUNDS) -> list[float]:
    """[share of good texts, each rule's accuracy on good texts, each rule's accuracy on bad texts], from ``patterns``
    of (votes, n). An accuracy is the share of right votes among votes, abstentions aside. One row is computed."""
    rules = range(n_rules)
    posterior = "1 / (1 + exp(-(ln(s[0] / (1 - s[0])) + " + " + ".join(
        f"case x.votes[{j}] when 1 then ln(s[{1 + j}] / (1 - s[{1 + n_rules + j}])) when -1 then ln((1 - s[{1 + j}]) / s[{1 + n_rules + j}]) else 0D end" for j in rules
    ) + ")))"

    def total(what: str) -> str:
        return f"aggregate(e, 0D, (a, x) -> a + ({what}))"

    def rate(right: int, weight: str, prior: tuple[float, float], j: int) -> str:
        votes = total(f"if(x.votes[{j}] = 0, 0D, {weight})")
        return f"({total(f'if(x.votes[{j}] = {right}, {weight}, 0D)')} + {prior[0]}D) / ({votes} + {sum(prior)}D)"

    good = [rate(1, "x.n * x.p", PRIOR_GOOD, j) for j in rules]
    bad = [rate(-1, "x.n * (1 - x.p)", PRIOR_BAD, j) for j in rules]
    rates = f"array(({total('x.n * x.p')} + {PRIOR_TEXTS[0]}D) / ({total('x.n')} + {sum(PRIOR_TEXTS)}D), {', '.join(good + bad)})"
    m_step = "transform(array({e}), e -> " + rates + ")[0]"
    first = f"array({', '.join(f'{p}D' for p in START)})[least(2, size(filter(x.votes, v -> v = -1)))]"
    start = m_step.format(e=f"transform(patterns, x -> struct(x.votes as votes, x.n as n, {first} as p))")
    step = m_step.format(e=f"transform(patterns, x -> struct(x.votes as votes, x.n as n, {posterior} as p))")
    row = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("patterns"))
    return list(row.select(F.expr(f"aggregate(sequence(1, {rounds}), {start}, (s, t) -> {step})").alias("s")).first().s)


def posterior_good(model: list[float], rules=RULES):
    """Column: the posterior probability that a text with the column ``_votes`` is good."""
    m = len(rules)
    odds = F.lit(model[0] / (1 - model[0]))
    log_odds = F.log(odds)
    for j in range(m):
        a, b = model[1 + j], model[1 + m + j]
        v = F.col("_votes")[j]
        log_odds = log_odds + F.when(v == 1, F.log(F.lit(a / (1 - b)))).when(v == -1, F.log(F.lit((1 - a) / b))).otherwise(0.0)
    return 1 / (1 + F.exp(-log_odds))


def judge(counted: DataFrame, rules=RULES, model: list[float] | None = None) -> DataFrame:
    """``counted`` (with the columns of signals()) with base_failed, quality (the posterior) and kept."""
    voted = counted.withColumn("_votes", votes(rules))
    if model is None:
        model = estimate(voted.groupBy(F.col("_votes").alias("votes")).agg(F.count(F.lit(1)).alias("n")), len(rules))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = voted.withColumn("base_failed", failed).withColumn("quality", posterior_good(model, rules)).drop("_votes")
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, the signals, base_failed, kept and quality of every document."""
    counted = staged(signals(docs.select("doc_id", "text")).drop("text"), "signals")
    return judge(counted).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns. Clashing names are safe: judged apart, by struct.
    Texts are counted once: the rows are staged with their counts, which both the estimate and the filter read."""
    whole = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("_row"), F.col("text"))
    return judge(staged(signals(whole).drop("text"), "counted")).filter("kept").select("_row.*")
