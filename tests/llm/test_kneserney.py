import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from groundcheck.llm import kneserney, queries

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER)) + ["</s>"]


def brute_model(texts, order=3):
    """Adjusted counts of every order: raw ones of the highest and of n-grams that begin a text."""
    uni, raw = Counter(), {k: Counter() for k in range(2, order + 1)}
    for t in texts:
        ts = tokens(t)
        uni.update(ts)
        padded = ["<s>", *ts]
        for k in raw:
            raw[k].update(tuple(padded[i : i + k]) for i in range(len(padded) - k + 1))
    adjusted = {order: raw[order]}
    for k in range(order - 1, 0, -1):
        adjusted[k] = Counter(g[1:] for g in adjusted[k + 1])
        if k > 1:
            adjusted[k] += Counter({g: c for g, c in raw[k].items() if g[0] == "<s>"})
    d = {k: kneserney.discounts([sum(c == i for c in adjusted[k].values()) for i in (1, 2, 3, 4)]) for k in adjusted}
    total, follow = Counter(), {}
    for k in raw:
        for g, c in adjusted[k].items():
            total[g[:-1]] += c
            follow.setdefault(g[:-1], [0, 0, 0])[min(c, 3) - 1] += 1
    v, n = len(uni), sum(uni.values())
    types = sum(adjusted[1].values())
    rest = sum(d[1][min(c, 3)] for c in adjusted[1].values()) / types if types else 1.0

    def prob(context, w):
        if not context:
            c = adjusted[1][(w,)]
            return (max(c - d[1][min(c, 3)], 0) / types if types else 0) + rest / (v + 1)
        low = prob(context[1:], w)
        if context not in total:
            return low
        k = len(context) + 1
        c = adjusted[k][(*context, w)]
        gamma = sum(a * b for a, b in zip(d[k][1:], follow[context])) / total[context]
        return max(c - d[k][min(c, 3)], 0) / total[context] + gamma * low

    def score(text):
        ts = tokens(text)
        padded = ["<s>", *ts]
        base = sum(math.log10((uni[t] + 1) / (n + v + 1)) for t in ts)
        whole = sum(math.log10(prob(tuple(padded[max(0, i - order + 1) : i]), padded[i])) for i in range(1, len(padded)))
        return len(ts), sum(uni[t] > 0 for t in ts), n, base, whole

    return score, prob, uni


def test_query_equals_brute_force(spark, small_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    score, prob, uni = brute_model([t for i, t in rows if not held[i]])
    got = {r.doc_id: r for r in queries.QUERIES["op7_lm_scoring"](spark, small_dir).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], *score(t)[:3])
        assert (r.base_score, r.score) == pytest.approx(score(t)[3:], rel=1e-9)
    # Probabilities after a context, with one share for all unknown words, add up to one.
    for u in [(), ("<s>",), ("the",), ("of", "the"), ("<s>", "the"), (next(iter(uni)), "the")]:
        assert sum(prob(u, w) for w in uni) + prob(u, "\0never") == pytest.approx(1)


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_orders_and_buckets(spark, monkeypatch, order, buckets):
    """Few buckets make few words hot, many make most of them so."""
    monkeypatch.setattr(kneserney, "LEAST_BUCKETS", buckets)
    rng = random.Random(buckets)
    words = [f"w{i}" for i in range(40)] + ["the", "of"] * 20
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 40)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = kneserney.train(docs.where("doc_id % 3 > 0"), order=order)
    score, *_ = brute_model([t for i, t in rows if i % 3], order)
    for r in kneserney.score_texts(docs, model).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens) == score(rows[r.id][1])[:3]
        assert (r.base_score, r.score) == pytest.approx(score(rows[r.id][1])[3:], rel=1e-9)


def test_long_contexts_keep_their_sums(tmp_path, monkeypatch):
    rng = np.random.default_rng(2)
    rows = np.unique(rng.integers(0, [3, 4, 60], (900, 3)), axis=0)
    counts = rng.integers(1, 600, len(rows)).astype(np.uint64)
    kneserney.write_contexts(str(tmp_path), "three-0", rows[:, 0], rows[:, 1], rows[:, 2], counts, 3, np.uint32)
    model = kneserney.Model(str(tmp_path), 1, np.array([100]), 1, 1, 3, np.zeros(0, np.int64))
    v, u = np.repeat([0, 1, 2, 2], 5), np.tile([0, 1, 2, 3, 9], 4)
    place, sums = model.two_words(v, u)
    for i in range(len(v)):
        own = counts[(rows[:, 0] == v[i]) & (rows[:, 1] == u[i])]
        assert (place[i] >= 0) == (len(own) > 0) and sums[i].tolist() == [(own == 1).sum(), (own == 2).sum(), (own >= 3).sum(), own.sum()]
    there = np.flatnonzero(place >= 0)
    for w in (0, 7, 59, 80):
        got = model.triple_counts(v[there], u[there], place[there], np.full(len(there), w))
        want = [int(counts[(rows == [v[i], u[i], w]).all(axis=1)].sum()) for i in there]
        assert got.tolist() == want


def test_packed_numbers_come_back():
    for values in ([], [0], [255, 256, 3], [2**64 - 1, 0], [1 << 40] * 3):
        assert kneserney.unpack(kneserney.pack(np.array(values, np.uint64))).tolist() == values


def test_edge_rows(spark):
    rows = [(1, "a b a b a b c"), (1, "a b a b a b c"), (2, None), (3, ""), (None, "A\tB new"), (5, "a " * 70000), (6, "x" * 100000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "'s' as score")
    model = kneserney.train(docs.where("doc_id < 4"))
    got = kneserney.score_texts(docs, model).collect()
    score, *_ = brute_model([t for i, t in rows if i is not None and i < 4])
    assert len(got) == len(rows)
    texts = {i: t for i, t in rows}
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == score(texts[r.id])[:3]
        assert (r.base_score, r.score) == pytest.approx(score(texts[r.id])[3:])
    empty = kneserney.train(docs.limit(0))
    assert all(r.score == 0 for r in kneserney.score_texts(docs, empty).collect())
    assert kneserney.score_texts(docs.limit(0), model).count() == 0
