"""Quality rules against plain Python counts and plain expectation maximisation."""

import math
import re

import pytest
from pyspark.sql import functions as F

from groundcheck.llm import quality, queries

TEXTS = [
    None,
    "",
    " \n\t ",
    "one two",
    "a b c d e a b c d e f g",
    "x x x x x x x x x x x x",
    "line one here\nline one here\n\n\nline two here\nline one here\r\nline one here",
    "### && $$ %% ** | < > plain words of prose follow here now",
    "ÄÖÜ déjà vu naïve\x0b日本語 \x0c tail \x00 nul words and more of them yes",
    " ".join(f"w{i % 97}" for i in range(3000)),
    "HELLO!! WORLD!! THIS!! IS!! LOUD!! TEXT!! WITH!! MANY!! WORDS!! IN!! IT!!",
    "1234 5678 9012 3456 7890 1234 5678 9012 3456 7890 11 12",
]


def plain_facts(text):
    text = text or ""
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text) if w]
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if re.search("[^ \t\n\x0b\x0c\r]", line):
            lines += 1
            dup += line in seen
            seen.add(line)
    starts = {}
    for i in range(len(words) - 4):
        starts.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in starts.values() if len(at) > 1 for i in at for k in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": lines,
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "n_upper": len(re.findall("[A-Z]", text)),
        "n_marks": text.count("!"),
        "n_digits": len(re.findall("[0-9]", text)),
    }


def plain_votes(f):
    """The rules of ``quality.RULES``, retold."""
    n, c = f["n_words"], f["word_chars"]
    cases = [
        (f["n_symbols"] > n / 10, f["n_symbols"] <= n / 50),
        (25 * f["n_symbols"] > c, 100 * f["n_symbols"] <= c),
        (f["n_repeat_words"] > n / 5, f["n_repeat_words"] <= n / 20),
        (f["n_lines"] >= 4 and f["n_dup_lines"] * 10 > f["n_lines"] * 3, f["n_lines"] >= 4 and f["n_dup_lines"] * 20 <= f["n_lines"]),
        (c < 2.5 * n or c > 15 * n, 3 * n <= c <= 10 * n),
        (f["n_upper"] > c / 2, f["n_upper"] <= c / 10),
        (f["n_marks"] > n / 5, f["n_marks"] <= n / 50),
        (f["n_digits"] * 5 > c * 2, f["n_digits"] <= c / 10),
    ]
    return [-1 if bad else 1 if good else 0 for bad, good in cases]


def plain_posteriors(all_votes, rounds=60):
    k = len(all_votes[0])
    p = [0.2 if min(v) < 0 else 0.9 for v in all_votes]
    before = [0.5] * (2 * k + 1)
    for _ in range(rounds):
        share = (sum(p) + 1) / (len(p) + 2)
        now, ratios = [share], []
        for j in range(k):
            ug = sum(x for x, v in zip(p, all_votes) if v[j] == 1)
            dg = sum(x for x, v in zip(p, all_votes) if v[j] == -1)
            ub = sum(1 - x for x, v in zip(p, all_votes) if v[j] == 1)
            db = sum(1 - x for x, v in zip(p, all_votes) if v[j] == -1)
            a = (ug + 1) / (ug + dg + 2)
            b = max((db + 1) / (ub + db + 2), 1 - a)
            now += [a, b]
            ratios.append({1: math.log(a) - math.log(1 - b), -1: math.log(1 - a) - math.log(b), 0: 0.0})
        p = [1 / (1 + math.exp(-(math.log(share) - math.log(1 - share) + sum(r[x] for r, x in zip(ratios, v))))) for v in all_votes]
        if max(abs(x - y) for x, y in zip(before, now)) <= 1e-7:
            break
        before = now
    return p


def test_facts_equal_plain_counts(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in quality.facts(docs).collect():
        assert {k: r[k] for k in quality.FACTS} == plain_facts(TEXTS[r.id]), TEXTS[r.id]


def test_query_equals_plain_version(spark, small_dir):
    found = queries.op11_quality_rules(spark, small_dir).collect()
    texts = {r.doc_id: r.text for r in queries.table(spark, small_dir, "documents").select("doc_id", "text").collect()}
    assert len(found) == len(texts)
    facts = {i: plain_facts(t) for i, t in texts.items()}
    order = sorted(texts)
    belief = dict(zip(order, plain_posteriors([plain_votes(facts[i]) for i in order])))
    for r in found:
        f = facts[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == tuple(f[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        failed = f["n_words"] < 10 or 100 * f["n_repeat_words"] > 20 * f["n_words"]
        assert r.base_failed == failed
        assert r.quality == pytest.approx(belief[r.doc_id], abs=1e-6)
        assert r.kept == (not failed and belief[r.doc_id] >= 0.5)


def test_labelled_quality(spark):
    label = queries.table(spark, "/root/testdata/sf0.01", "labels").select("doc_id", F.col("quality").alias("label"))
    got = queries.op11_quality_rules(spark, "/root/testdata/sf0.01").join(label, "doc_id").groupBy("label", "kept", "base_failed").count().collect()
    count = lambda label, kept: sum(r["count"] for r in got if r.label == label and r.kept == kept)
    assert count(1, True) >= 0.95 * (count(1, True) + count(1, False))
    assert count(0, False) >= 0.8 * (count(0, True) + count(0, False))


def test_conflicting_votes_are_weighed(spark):
    """A rule that is often contradicted weighs less than one that agrees with the others."""
    rules = (quality.Rule("a", "a < 0", "a > 0"), quality.Rule("b", "b < 0", "b > 0"), quality.Rule("c", "c < 0", "c > 0"))
    rows = [(1, 1, 1)] * 40 + [(1, 1, -1)] * 30 + [(-1, -1, -1)] * 10 + [(-1, -1, 1)] * 9 + [(0, 0, 0)]
    voted = quality.votes(spark.createDataFrame(rows, "a int, b int, c int"), rules)
    model = quality.estimate(voted, rules)
    belief = {(r.a, r.b, r.c): r.p for r in voted.withColumn("p", quality.posterior(model, rules)).collect()}
    assert belief[(1, 1, -1)] > 0.9 and belief[(-1, -1, 1)] < 0.1
    assert abs(belief[(0, 0, 0)] - model.good) < 1e-12


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "good words " * 3, 1), (None, None, 2), ("7", "A" * 100_000, 3), ("7", "A" * 100_000, 4)], "doc_id string, text string, n_words int")
    found = quality.judge(docs).collect()
    assert len(found) == 4 and sum(r.id == "7" for r in found) == 2
    assert [r.n_words for r in found if r.id == "7"] == [1, 1]
    assert quality.judge(docs.limit(0)).collect() == []
