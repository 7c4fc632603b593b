"""Quality rules by weak supervision.

Rules read facts of a text and vote: good, bad, or not at all. No rule decides alone. Documents
with the same votes are counted together (no more than ``3 ** rules`` rows), and expectation
maximisation over these counts estimates the share of good documents and two accuracies of every
rule: how often it votes good on a good document and bad on a bad one, when it votes. Abstaining
tells nothing of a document. The posterior probability that a document is good, given all its
votes, replaces the usual demand that it pass every rule.

Every step is a DataFrame: a text's facts are columns of its own row, so that no text is shuffled;
one round of expectation maximisation is one aggregation over the counted votes.

Defined results: a null or empty text has no words and fails the base rule; texts of any length are
read whole; ids may be null or repeated, every row gets a result of its own; further columns are
ignored; empty tables give empty results. Five-word windows are compared by their 64-bit XXH64.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundcheck.llm.common import stored

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Words in a window that counts as repeated when it is found again in the same text.
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Two SQL conditions over the facts: when the rule votes bad, else when it votes good."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("symbol_share", "25 * n_symbols > word_chars", "100 * n_symbols <= word_chars"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words"),
    Rule("repeated_lines", "n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines", "n_lines >= 4 AND 20 * n_dup_lines <= n_lines"),
    Rule("word_length", "2 * word_chars < 5 * n_words OR word_chars > 15 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    Rule("capitals", "2 * n_upper > word_chars", "10 * n_upper <= word_chars"),
    Rule("exclamations", "5 * n_marks > n_words", "50 * n_marks <= n_words"),
    Rule("digits", "5 * n_digits > 2 * word_chars", "10 * n_digits <= word_chars"),
)
FACTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_digits")


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def facts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the counts of ``FACTS`` for every row.

    Each select's columns are read more than once by the next, so that the optimiser leaves the
    selects apart and nothing is computed anew for every word."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    first = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    second = first.select(
        "id",
        F.char_length(without(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        (F.octet_length("text") - F.octet_length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.regexp_replace("text", "[^A-Z0-9!]+", "").alias("marked"),
        lines.alias("lines"),
        F.filter(F.split("text", "[ \\t-\\r]+"), lambda w: w != "").alias("words"),
    )
    starts = F.slice("words", F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(0)))
    third = second.select(
        "id",
        "word_chars",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.octet_length(F.regexp_replace("marked", "[0-9!]+", "")).cast("long").alias("n_upper"),
        (F.octet_length("marked") - F.octet_length(without(F.col("marked"), "!"))).cast("long").alias("n_marks"),
        F.octet_length(F.regexp_replace("marked", "[A-Z!]+", "")).cast("long").alias("n_digits"),
        F.transform(starts, lambda _, i: F.xxhash64(F.slice("words", i + 1, WINDOW))).alias("windows"),
    )
    kept = [c for c in third.columns if c != "windows"]
    # Only texts that hold a window twice are sorted.
    numbered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    fourth = third.select(*kept, F.when(F.size(F.array_distinct("windows")) < F.size("windows"), numbered).alias("sorted"))
    alike = lambda s, k: (F.get("sorted", k - 1)["h"] == s["h"]) | (F.get("sorted", k + 1)["h"] == s["h"])
    fifth = fourth.select(*kept, F.sort_array(F.transform(F.filter("sorted", lambda s, k: F.coalesce(alike(s, k), F.lit(False))), lambda s: s["i"])).alias("found"))
    covered = F.aggregate(F.transform("found", lambda p, k: F.least(F.lit(WINDOW), F.get("found", k + 1) - p)), F.lit(0), lambda a, x: a + x)
    return fifth.select(*kept, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).select("id", *FACTS)


def votes(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``found`` with ``vote_<rule>``: 1 good, -1 bad, 0 abstained, also where a condition is null."""
    return found.withColumns({f"vote_{r.name}": F.when(F.expr(r.bad), -1).when(F.expr(r.good), 1).otherwise(0) for r in rules})


@dataclass(frozen=True)
class Accuracies:
    """Share of good documents; how often each rule is right on good and on bad ones, when it votes."""

    good: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]
    rounds: int = 0


def posterior(model: Accuracies, rules: tuple[Rule, ...] = RULES) -> Column:
    """Probability that a row's document is good, given its ``vote_`` columns.

    Accuracies are looked up in array literals, so that every round runs the same compiled code."""
    for_good = F.array(*[F.lit(x) for a, b in zip(model.on_good, model.on_bad) for x in log_ratios(a, b)], F.lit(log(model.good) - log(1.0 - model.good)))
    score = F.element_at(for_good, F.lit(2 * len(rules) + 1))
    for k, rule in enumerate(rules):
        vote = F.col(f"vote_{rule.name}")
        score = score + F.when(vote == 1, F.element_at(for_good, F.lit(2 * k + 1))).when(vote == -1, F.element_at(for_good, F.lit(2 * k + 2))).otherwise(0.0)
    return 1.0 / (1.0 + F.exp(-score))


def log_ratios(on_good: float, on_bad: float) -> tuple[float, float]:
    """What a good and what a bad vote add to the log odds of good."""
    return log(on_good) - log(1.0 - on_bad), log(1.0 - on_good) - log(on_bad)


def estimate(voted: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = 60, tolerance: float = 1e-7, pseudo: float = 1.0) -> Accuracies:
    """Accuracies by expectation maximisation over all rows of ``voted``.

    It starts from a belief of 0.9 in documents without a bad vote and of 0.2 in the others. Every
    count gets ``pseudo`` rows more, and a rule is never taken to be worse than chance: a bad vote
    does not speak for a document. Ends when no number moves by more than ``tolerance``."""
    names = [f"vote_{r.name}" for r in rules]
    patterns = stored(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "quality-votes")
    any_bad = F.least(*names, F.lit(0)) < 0
    belief = F.when(any_bad, 0.2).otherwise(0.9)
    model = Accuracies(0.5, (0.5,) * len(rules), (0.5,) * len(rules))
    for k in range(rounds):
        good, n = F.col("n") * F.col("p"), F.col("n") * (1.0 - F.col("p"))
        sums = [F.sum(good), F.sum(n)]
        for c in names:
            for vote in (1, -1):
                sums += [F.sum(F.when(F.col(c) == vote, part).otherwise(0.0)) for part in (good, n)]
        got = [float(x or 0.0) for x in patterns.withColumn("p", belief).agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()]
        on_good, on_bad = [], []
        for i in range(len(rules)):
            up_good, up_bad, down_good, down_bad = got[2 + 4 * i : 6 + 4 * i]
            a = (up_good + pseudo) / (up_good + down_good + 2 * pseudo)
            b = (down_bad + pseudo) / (up_bad + down_bad + 2 * pseudo)
            on_good.append(a)
            on_bad.append(max(b, 1.0 - a))
        share = (got[0] + pseudo) / (got[0] + got[1] + 2 * pseudo)
        before, model = model, Accuracies(share, tuple(on_good), tuple(on_bad), k + 1)
        moved = max(abs(x - y) for x, y in zip((before.good, *before.on_good, *before.on_bad), (model.good, *model.on_good, *model.on_bad)))
        if moved <= tolerance:
            break
        belief = posterior(model, rules)
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, least_words: int = 10, least_quality: float = 0.5) -> DataFrame:
    """``id``, the facts, ``base_failed``, ``quality`` (the posterior) and ``kept`` for every row."""
    found = stored(facts(docs, id_col, text_col), "quality-facts")
    voted = votes(found, rules)
    model = estimate(voted, rules)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    done = voted.withColumn("base_failed", failed).withColumn("quality", posterior(model, rules))
    return done.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least_quality))
