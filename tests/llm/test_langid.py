import numpy as np
import pyarrow as pa

from groundcheck.llm import langid, queries
from groundcheck.llm.common import CHUNK_BYTES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text").collect()}
    got = queries.QUERIES["op2_language_id"](spark, sf).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert held and all(0 <= r.score <= 1 for r in got)
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in held) / len(held)
    assert right > 0.97, right


def test_edge_rows(spark):
    rows = [(1, "the and of the with that", "en"), (2, "der die und nicht auch", "de"), (3, "que de la los para", "es"), (4, "les des une pour avec", "fr")] * 3
    rows += [(None, None, None), (7, "", "en"), (8, "12 34 !!", None), (9, "中文", "zh"), (11, "½² ①", None), (10, "the and of " * 20000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' as lang_pred", "1 as id", "2 as _n", "3 as _lang", "4 as n")
    model = langid.train(docs)
    got = {r.id: r for r in langid.identify(docs, model).collect()}
    assert len(langid.identify(docs, model).collect()) == len(rows)
    assert got[None].lang_pred == got[7].lang_pred == got[8].lang_pred == got[11].lang_pred == "und" and got[8].score == 0
    assert got[10].lang_pred == got[1].lang_pred == "en" and got[2].lang_pred == "de" and got[9].lang_pred == "zh"
    assert langid.identify(docs.limit(0), model).count() == 0
    assert {r.doc_id for r in langid.keep_identified(docs, model).collect()} == {1, 2, 3, 4, 9, 10}
    nothing = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_votes_equal_brute_force():
    """Family first, then the pairs of that family; features by plain counting."""
    rng = np.random.default_rng(0)
    families, languages, family_of, pairs = ["a", "b"], ["l0", "l1", "l2", "l3"], [0, 0, 0, 1], [(0, 1), (0, 2), (1, 2)]
    model = langid.Model(families, languages, rng.normal(size=((1 << langid.DIM_BITS) + 1, 5)).astype(np.float32), pairs, family_of, 4.0)
    texts = ["one", "Two, three!", "ça va", "x", "aaaa bbbb aaaa", "日本"]
    names, scores, margins = langid.predictions(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), "text", model)
    for text, name, score, margin in zip(texts, names, scores, margins):
        data = bytes(32 if b < 97 or 122 < b < 128 else b for b in bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode()))
        keys = [((int.from_bytes(data[i : i + n], "big") ^ n * 0x1F123BB5 & 0xFFFFFFFF) * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for n in (2, 3, 4) for i in range(len(data) - n + 1)]
        m = [sum((keys.count(k) / len(keys)) ** 0.5 * float(model.weights[k][j]) for k in set(keys)) + float(model.weights[-1][j]) for j in range(5)]
        sure = [1 / (1 + np.exp(-4 * x)) for x in m]
        family = int(np.argmax(sure[:2]))
        votes, belief = [0.0] * 4, [0.0] * 4
        for j, (a, b) in enumerate(pairs):
            votes[a if sure[2 + j] >= 0.5 else b] += 1
            belief[a] += sure[2 + j] / 2
            belief[b] += (1 - sure[2 + j]) / 2
        belief[3] = 1.0
        best = max((i for i in range(4) if family_of[i] == family), key=lambda i: votes[i] + belief[i] / 5)
        assert name == languages[best] and abs(margin - m[family]) < 1e-5
        assert abs(score - sure[family] / sum(sure[:2]) * belief[best]) < 1e-5


def test_long_texts_are_counted_in_slices():
    text = "äöü the and of some words " * 60000
    data = np.frombuffer(text.encode(), np.uint8)
    assert len(data) > CHUNK_BYTES
    (feature, value), = langid.frequencies(data, np.array([0, len(data)]))
    two = list(langid.frequencies(np.append(data, data[:5]), np.array([0, len(data), len(data) + 5])))
    assert (feature == two[0][0]).all() and np.allclose(value, two[0][1])
