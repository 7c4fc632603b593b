import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from groundcheck.llm import queries, simhash


def brute_print(text, k=4):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = (text or "").translate(table).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    counts = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        counts.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(rows):
    prints = {i: brute_print(t) for i, t in rows}
    ids = [i for i, _ in rows]
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in range(len(ids)):
        for y in range(x):
            if (prints[ids[x]] ^ prints[ids[y]]).bit_count() <= 4:
                a, b = root(ids[x]), root(ids[y])
                parent[max(a, b)] = min(a, b)
    return {i: (f"{prints[i]:016x}", root(i)) for i in ids}


def test_query_equals_brute_force(spark, small_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op9_simhash"](spark, small_dir).collect()}
    assert got == brute_components(rows)


def test_bit_sliced_equals_popcount():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    values = np.concatenate([base, near])
    planes = simhash.bit_planes(values)
    for q in values[:50].tolist():
        lanes = np.unpackbits(simhash.within_radius(planes, q, 4).view(np.uint8), bitorder="little")[: len(values)]
        assert (lanes.astype(bool) == (np.bitwise_count(values ^ np.uint64(q)) <= 4)).all()


@pytest.mark.parametrize("tile", [3, 4096])
def test_links_lose_nothing_with_or_without_tiles(spark, tile):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = {b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(15)} | {0, 2**64 - 1}
    signed = lambda v: v - 2**64 if v >> 63 else v
    values = spark.createDataFrame([(signed(v),) for v in fps], "fp long")
    got = {r.node: r.root for r in simhash.components(simhash.links(values, tile=tile)).collect()}
    groups = {}
    for v in fps:
        joined = [g for g in groups.values() if any((v ^ w).bit_count() <= 4 for w in g)]
        merged = {v}.union(*joined)
        groups = {id(g): g for g in groups.values() if g not in joined} | {id(merged): merged}
    want = {signed(v): min(map(signed, g)) for g in groups.values() if len(g) > 1 for v in g}
    assert {k: v for k, v in want.items() if k != v} == got


def test_bucket_entries_are_not_broadcast(spark):
    """There are 35 entries a fingerprint, which Spark takes to be as small as the fingerprints."""
    found = simhash.links(spark.range(1000).select(F.xxhash64("id").alias("fp")))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (4, "One two"), (5, "x " * 30000), (6, "one TWO"), (None, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as component")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {r.id: r.component for r in got}
    assert by[1] == by[2] == by[3] == 1 and by[4] == by[6] == by[None] == 4 and by[5] == 5
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [1, 4, 5]


def test_keep_one_loses_no_component_with_null_or_shared_ids(spark):
    first, second = "the quick brown fox jumps over the lazy dog", "a stitch in time saves nine of any ten coats"
    rows = [(None, "alone and without any number at all"), (None, "two alike without a number here"), (None, "two alike without a number here")]
    rows += [(5, first), (9, first), (5, second), (3, second), (8, "one text of number eight stands here"), (8, "another which shares its number only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as component", "3 as id").repartition(3)
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    want = [rows[0], rows[1], rows[3], rows[6], rows[7], rows[8]]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
