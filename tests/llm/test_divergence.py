"""Source divergence against plain Python counts and sums."""

import collections
import re

import numpy as np

from groundcheck.llm import divergence, queries

PARTS = "[\x00-\x40\x5b-\x60\x7b-\x7f]+"


def plain_terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [t for t in re.split(PARTS, low) if t]


def plain_audit(rows, least, top):
    """Rows of (text, lang, source)."""
    found, df = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        terms = plain_terms(text)
        found[(lang or "", source or "")].update(terms)
        df[lang or ""].update(set(terms))
    out = []
    for lang in df:
        kept = sorted(t for t, n in df[lang].items() if n >= least)
        groups = sorted(g for g in found if g[0] == lang)
        law = lambda n, total: 1 + 1_000_000_000 * (n + 5) // (total + 5 * len(kept))
        price = {g: [law(found[g][t], sum(found[g][x] for x in kept)) for t in kept] for g in groups}
        whole = {t: sum(found[g][t] for g in groups) for t in kept}
        q = [law(whole[t], sum(whole.values())) for t in kept]
        for g in groups:
            pairs = [(h[1], sum(abs(a - b) for a, b in zip(price[g], price[h]))) for h in groups if h != g]
            terms = [(t, p - x) for t, p, x in zip(kept, price[g], q) if found[g][t] > 0 and p > x]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda v: (-v[1], v[0].encode()))
                out += [(lang, g[1], part, item, value, k + 1) for k, (item, value) in enumerate(ranked) if part == "pair" or k < top]
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def corpus(rng, rows, sources, words):
    names = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(words)] + ["Ünï", "日本", "UP"]
    out = []
    for _ in range(rows):
        picked = rng.zipf(1.4, rng.integers(0, 60)) % len(names)
        out.append((" ".join(names[i] for i in picked), ["en", "de", None, "none"][rng.choice(4, p=[0.6, 0.3, 0.05, 0.05])], None if rng.random() < 0.03 else f"s{rng.integers(sources)}"))
    return out


def test_equals_plain_version(spark):
    rows = corpus(np.random.default_rng(3), 400, 6, 200) + [(None, "en", "empty"), ("12 34", "xx", "a"), ("", "xx", "b")]
    found = divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"), least_documents=5, top=7)
    assert rows_of(found) == plain_audit(rows, 5, 7)


def test_many_sources_and_small_blocks(spark, monkeypatch):
    """Several blocks of groups, buckets of terms, and products of few columns."""
    rows = corpus(np.random.default_rng(4), 500, 23, 300)
    whole = plain_audit(rows, 3, 50)
    monkeypatch.setattr(divergence, "GROUPS", 5)
    monkeypatch.setattr(divergence, "BUCKET_TERMS", 40)
    assert rows_of(divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"), least_documents=3)) == whole


def test_joint_tables_in_narrow_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    counts = rng.poisson(1.5, (6, 80))
    price = rng.integers(1, 10**9, (6, 20)).cumsum(axis=1)
    group, term = np.nonzero(counts)
    want = np.array([[sum(abs(int(price[g, counts[g, t]]) - int(price[h, counts[h, t]])) for t in range(80) if counts[:, t].any()) for h in range(6)] for g in range(6)])
    _, term = np.unique(term, return_inverse=True)
    for most in (7, 20, 2048):
        monkeypatch.setattr(divergence, "COLUMNS", most)
        got = divergence.priced_pairs(group, term, counts[counts > 0], price[group, counts[counts > 0]], price[:, 0])
        assert (got == want).all()


def test_long_text_counts_once(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 64)
    rows = [("alpha beta Gamma " * 50, "en", "a"), ("alpha", "en", "b"), ("x" * 500 + " tail", "en", "b")]
    data = np.frombuffer(rows[0][0].encode(), np.uint8)
    assert b"".join(data[a:b].tobytes() for a, b in divergence.slices_of(data)) == data.tobytes()
    g, term, n, df = divergence._one_document(data)
    assert dict(zip(term.to_pylist(), zip(n.tolist(), df.tolist()))) == {"alpha": (50, 1), "beta": (50, 1), "gamma": (50, 1)}
    assert rows_of(divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"), least_documents=2)) == plain_audit(rows, 2, 50)


def test_shared_hash_is_told_apart(monkeypatch):
    monkeypatch.setattr(divergence, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    data = np.frombuffer(b"ab cd ab efg", np.uint8)
    _, term, n, _ = divergence.count_slice(data, np.array([0, 12]), np.zeros(1, np.int64))
    assert dict(zip(term.to_pylist(), n.tolist())) == {"ab": 2, "cd": 1, "efg": 1}


def test_odd_tables(spark):
    schema = "text string, lang string, source string, rank int, value string, g int"
    docs = spark.createDataFrame([("a a b", "en", "x", 1, "v", 0)] * 3 + [("a b b", "en", "y", 1, "v", 0)] * 2, schema)
    assert rows_of(divergence.audit(docs, least_documents=2)) == plain_audit([("a a b", "en", "x")] * 3 + [("a b b", "en", "y")] * 2, 2, 50)
    assert divergence.audit(docs.limit(0)).collect() == []


def test_query_over_the_small_table(spark, small_dir):
    rows = [(r.text, r.lang, r.source) for r in queries.table(spark, small_dir, "documents").collect()]
    assert rows_of(queries.op12_source_divergence(spark, small_dir)) == plain_audit(rows, 30, 50)
