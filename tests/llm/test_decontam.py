import hashlib
import re

from groundcheck.llm import decontam, queries

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute_contamination(docs, items, width=13):
    windows = []
    for i, t in items:
        w = words(t)
        n = min(width, len(w))
        if n and i is not None:
            windows += [(i, tuple(w[s : s + n])) for s in range(len(w) - n + 1)]
    by = {}
    for i, w in windows:
        by.setdefault(w, set()).add(i)
    lengths = {len(w) for w in by}
    out = {}
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                ids = by.get(tuple(w[s : s + n]))
                if ids:
                    hit |= set(range(s, s + n))
                    found |= ids
        listed = ",".join(sorted(map(str, found)))
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def test_query_equals_brute_force(spark, small_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op1_decontamination"](spark, small_dir).collect()}
    assert got == brute_contamination(docs, items)


def test_edge_rows(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [(1, None), (2, ""), (3, "..."), (4, f"--{passage.upper()}!"), (4, f"--{passage.upper()}!"), (5, passage + " of" * 30000), (6, "x the end y"), (None, passage), (8, "the the the the end")]
    items = [(1, passage), (1, passage), (2, "The End."), (3, None), (None, "the"), (4, "!!"), (5, "of " * 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as item", "3 as pos", "4 as text_key")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as item", "2 as length")
    got = decontam.contamination(docs, bench).collect()
    want = brute_contamination(rows, items)
    assert len(got) == len(rows)
    for r in got:
        ids = hashlib.sha256(",".join(sorted(map(str, r["items"]))).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, ids, r.contaminated) == want[r.id]
    assert decontam.contamination(docs.limit(0), bench).count() == 0
    assert {r.n_hit for r in decontam.contamination(docs, bench.limit(0)).collect()} == {0}
    kept = decontam.keep_uncontaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in rows if not want[i][-1])


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu"
    w = item.split()
    rows = [(1, item), (2, " ".join(w[:6] + ["new", "words"] + w[6:])), (3, " ".join(reversed(w))), (4, " filler ".join(w)), (None, item), (6, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Two items share an id: half of either must not add up to one.
    halves = [(2, " ".join(w[:6]) + " x1 x2 x3 x4 x5 x6 x7"), (2, "y1 y2 y3 y4 y5 y6 " + " ".join(w[6:]))]
    bench = spark.createDataFrame([(1, item), (1, item), (3, None), *halves], "item_id long, text string")
    index = decontam.build_index(docs, "doc_id", "text")
    terms, names = decontam.item_terms(bench, "item_id", "text")
    found = decontam.proximity_matches(index, terms, names, slack=3, lists=13).collect()
    assert {(r.id, r.item) for r in found} == {(1, 1), (2, 1), (None, 1)}
    none, names = decontam.item_terms(bench.limit(0), "item_id", "text")
    assert decontam.proximity_matches(index, none, names).count() == 0


def test_shuffled_joins_give_the_same(spark, small_dir, monkeypatch):
    docs, bench = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = lambda: sorted((r.id, r.n_hit, r.n_items) for r in decontam.contamination(docs, bench).collect())
    want = rows()
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", -1)
    assert rows() == want
