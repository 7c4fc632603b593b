import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from groundcheck.llm import common, queries, toxicity
from groundcheck.llm.common import fold


def test_held_out_results(spark):
    sf = "/root/testdata/sf0.1"
    told = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.QUERIES["op6_toxicity"](spark, sf).collect()
    held = [(r.score, r.predicted, told[r.doc_id]) for r in got if r.held_out and r.doc_id in told]
    assert len(got) == 10000 and all(0 <= r.score <= 1 for r in got)
    tp = sum(p and t for _, p, t in held)
    precision, recall = tp / max(1, sum(p for _, p, _ in held)), tp / sum(t for *_, t in held)
    s, t = np.array([h[0] for h in held]), np.array([h[2] for h in held])
    auc = (s[t == 1][:, None] > s[t == 0][None, :]).mean() + 0.5 * (s[t == 1][:, None] == s[t == 0][None, :]).mean()
    print("precision", precision, "recall", recall, "auc", auc)
    assert precision > 0.9 and recall > 0.75 and auc > 0.85


def test_edge_rows(spark):
    rows = [(i, f"nice day number {i} here we are") for i in range(60)] + [(100 + i, f"you awful creep number {i}") for i in range(30)]
    labels = spark.createDataFrame([(i, 0) for i in range(30)] + [(100 + i, 1) for i in range(10)] + [(100, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    extra = [(None, None), (200, ""), (201, "You CREEP! awful"), (202, "nice " * 50000), (0, "nice day number 0 here we are")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string").selectExpr("*", "0.5 as score", "'q' as words")
    model = toxicity.train(docs, labels, z=2.0)
    got = toxicity.score_texts(docs, model).collect()
    by = {r.id: r.score for r in got}
    assert len(got) == len(rows + extra)
    assert by[201] >= 0.3 > by[0] and by[202] < 0.3 and by[None] == by[200]
    assert toxicity.score_texts(docs.limit(0), model).count() == 0
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and 201 not in {r.doc_id for r in kept.collect()}
    none = toxicity.train(docs, labels.limit(0))
    assert {round(r.score, 4) for r in toxicity.score_texts(docs, none).collect()} == {0.0067}
    alone = toxicity.train(docs, labels.where("toxic = 1"), z=2.0)
    assert {r.id: r.score for r in toxicity.score_texts(docs, alone).collect()}[201] >= 0.3


def test_fit_lowers_the_non_negative_risk():
    """The risk written out for each text, on small vectors; its gradient by differences."""
    rng = np.random.default_rng(1)
    held = rng.random((60, 5)) < 0.4
    held[:20, 0] = True
    x = toxicity.Presence(*(a.astype(np.int32) for a in np.nonzero(held)), 60, 5)
    n, prior = 20, 0.3

    def risk(w):
        margin = [sum(w[j] for j in range(5) if held[i, j]) + w[5] for i in range(60)]
        plus, minus = [np.log1p(np.exp(-m)) for m in margin], [np.log1p(np.exp(m)) for m in margin]
        rest = np.mean(minus[n:]) - prior * np.mean(minus[:n])
        return prior * np.mean(plus[:n]) + max(0.0, rest), rest

    start = np.append(np.zeros(5), np.log(prior / (1 - prior)))
    weights, bias = toxicity.nnpu_fit(x, n, prior, steps=1, rate=1e-6, decay=0.0)
    slope = np.array([(risk(start + 1e-5 * e)[0] - risk(start - 1e-5 * e)[0]) / 2e-5 for e in np.eye(6)])
    moved = np.append(weights, bias) - start
    assert (np.sign(moved[np.abs(slope) > 1e-6]) == -np.sign(slope[np.abs(slope) > 1e-6])).all()
    weights, bias = toxicity.nnpu_fit(x, n, prior)
    assert risk(np.append(weights, bias))[0] < risk(start)[0] and weights[0] == max(weights)


def test_long_texts_are_taken_in_slices(monkeypatch):
    text = ("alpha beta, GAMMA delta " * 40 + "x" * 900 + " omega").encode()
    data = np.frombuffer(text, np.uint8)
    at = np.array([0, len(data)])
    whole = np.unique(toxicity.hashed_words(data, at)[0])
    assert (toxicity.distinct_words(data) == whole).all()
    slices = list(common.text_slices(data, common.MARKS, 100))
    assert len(slices) > 5 and b"".join(x.tobytes() for x in slices) == text
    monkeypatch.setattr(toxicity, "text_slices", lambda d, parting: common.text_slices(d, parting, 100))
    assert (toxicity.distinct_words(data) == whole).all()
    words = np.sort(whole[::2])
    two = toxicity.word_hits(np.concatenate([data, data]), np.array([0, len(data), 2 * len(data)]), words)
    one = toxicity.word_hits(data, at, words)
    assert one[1].tolist() == two[1][two[0] == 0].tolist() == list(range(len(words)))
    assert len(toxicity.distinct_words(np.zeros(0, np.uint8))) == 0


def test_query_equals_plain_scores(spark, small_dir):
    """Scores of the query from the model's own words and weights, by plain sets of words."""
    docs, labels = queries.table(spark, small_dir, "documents"), queries.table(spark, small_dir, "labels")
    learned = fold(F.col("doc_id"), 4) != 2
    model = toxicity.train(docs.where(learned), labels.where(learned))
    weight = dict(zip(model.words.tolist(), model.weights.tolist()))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in queries.op6_toxicity(spark, small_dir).collect():
        words = {w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in texts[r.doc_id])) if w}
        hashes = [int(common.span_hashes(np.frombuffer(w.encode(), np.uint8), np.zeros(1, np.int64), np.array([len(w.encode())]))[0]) for w in words]
        margin = model.bias + sum(weight.get(h, 0.0) for h in hashes)
        assert r.score == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9) and r.predicted == (r.score >= 0.3)
