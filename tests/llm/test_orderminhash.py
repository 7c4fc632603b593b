import hashlib
from collections import Counter

import xxhash

from groundcheck.llm import orderminhash, queries


def edit(text, other):
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def test_query(spark, small_dir):
    rows = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in queries.QUERIES["op10_order_minhash"](spark, small_dir).collect()}
    assert len(got) == len(rows)
    prints = {}
    for n, (i, text) in enumerate(rows):
        other, after = rows[(n + 1) % len(rows)][1], rows[(n + 1) % len(rows)][0]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edit(text, other).encode()).hexdigest())
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        sig = lambda f: [f[j : j + 8] for j in range(0, len(f), 8)]
        for likeness, f in ((r.near_edited, r.edited_fingerprint), (r.near_next, got[after].fingerprint)):
            a, b = sig(r.fingerprint), sig(f)
            assert len(a) in (0, 32) and likeness == (sum(x == y for x, y in zip(a, b)) / max(len(a), len(b)) if a or b else 1.0)
    long = [r for r in got.values() if r.n_chars > 2000]
    assert sum(r.near_edited for r in long) / len(long) > 0.08 + sum(r.near_next for r in long) / len(long)


def spark_hash(values, seed=42):
    """XXH64 of longs, chained as Spark does over columns."""
    for v in values:
        seed = xxhash.xxh64_intdigest((v & (2**64 - 1)).to_bytes(8, "little"), seed)
    return seed


def text_hash(words, seed=42):
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed


def test_signatures_equal_brute_force(spark):
    """Numbering, the two smallest of every permutation, and text order."""
    texts = {1: "a b c a b c a b c d e f g", 2: "one", 3: " ".join(f"w{i % 37}" for i in range(400)), 4: "two words", 5: " ".join(f"x{i}" for i in range(90)), 6: "a b c a b c", 7: "p q r s"}
    df = spark.createDataFrame(list(texts.items()), "range int, text string")
    got = {r.range: r.fp for r in orderminhash.signatures(df, ["range"], []).collect()}
    for key, text in texts.items():
        w, seen, hashed = text.split(), Counter(), []
        spans = [w[i : i + 3] for i in range(max(1, len(w) - 2))]
        for span in spans:
            kmer = text_hash(span)
            seen[kmer] += 1
            hashed.append(xxhash.xxh64_intdigest(seen[kmer].to_bytes(4, "little"), spark_hash([kmer])))
        want = []
        for i in range(32):
            order = sorted((spark_hash([h ^ (orderminhash.permutation(i) & (2**64 - 1))]) >> 32, pos) for pos, h in enumerate(hashed))
            chosen = sorted(order[:2], key=lambda x: x[1])
            want.append(spark_hash([rank for rank, _ in chosen]) >> 32)
        assert got[key] == want, key


def test_order_matters_and_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "short"), (4, "short"), (5, "w x y z " * 20000), (None, "null id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as range", "2 as nth", "'f' as fingerprint")
    got = orderminhash.edited_likeness(docs).collect()
    assert len(got) == len(rows)
    by = {r.id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint == by[3].fingerprint == [] and by[2].near_next == 1.0
    assert by[None].edited_sha256 == hashlib.sha256(edit("null id", rows[5][1]).encode()).hexdigest()
    assert len(orderminhash.fingerprints(docs).collect()) == len(rows)
    assert orderminhash.edited_likeness(docs.limit(0)).count() == 0
    only = orderminhash.edited_likeness(docs.where("doc_id = 5")).collect()
    assert len(only) == 1 and only[0].near_next == 1.0
    parts = [" ".join(f"{c}{i}" for i in range(200)) for c in "abcd"]
    moved = spark.createDataFrame([(1, " ".join(parts)), (2, " ".join(parts[::-1]))], "doc_id long, text string")
    a, b = (r.fingerprint for r in orderminhash.fingerprints(moved).collect())
    shared = len(set(a) & set(b)) / 32
    assert 0.1 < shared < 0.9  # nearly the same k-mers, but in another order


def test_ids_that_are_no_numbers(spark):
    texts = {"b": "one two three four", "a10": "five six seven", "a9": "eight nine ten eleven", None: "twelve"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    got = {r.id: r for r in orderminhash.edited_likeness(docs).collect()}
    order = ["b", "a9", "a10", None]
    for i, name in enumerate(order):
        assert got[name].edited_sha256 == hashlib.sha256(edit(texts[name], texts[order[(i + 1) % 4]]).encode()).hexdigest()
