import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from groundcheck.llm import queries, sharding


def fits(rows, shards, weight, slack):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    sums = [sum(map(weight, by[s])) for s in range(shards)]
    assert max(sums) - min(sums) <= slack, sums


def test_query(spark, small_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    got = queries.QUERIES["op4_sharding"](spark, small_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    fits(got, 16, lambda r: r.size, 2 * max(r.size for r in got))


@pytest.mark.parametrize("law", ["bytes", "rows"])
@pytest.mark.parametrize("per_range", [5, 1000])
def test_hot_group_and_edge_rows(spark, law, per_range):
    rows = [(i, "hot text " * 10) for i in range(200)] + [(1000 + i, f"text {i} " * (i % 17)) for i in range(300)]
    rows += [(None, None), (None, ""), (7, "x" * 20000), (1000, "repeated"), (1000, "repeated")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as shard", "2 as h", "3 as range")
    got = sharding.shard(docs, 4, law, per_range=per_range).collect()
    assert len(got) == len(rows)
    fits(got, 4, (lambda r: r.size) if law == "bytes" else (lambda r: 1), 40002 if law == "bytes" else 1)
    assert sharding.shard(docs.limit(0), 4, law).count() == 0


def test_range_index_follows_key_order(spark):
    keys = spark.range(1000).selectExpr("xxhash64(id) as h", "cast(id as string) as tie", "1L as weight")
    rows = sharding.ranged(keys, "weight", 20).collect()
    ordered = [r.range for r in sorted(rows, key=lambda r: (r.h, r.tie))]
    assert ordered == sorted(ordered) and len(set(ordered)) > 20


@pytest.mark.parametrize("n", [1, 2, 3, 26, 27, 28, 500])
def test_range_index_counts_splitters(spark, n):
    cuts = sorted({(i * 7919 % 1000 - 500, f"t{i % 3}\"\\") for i in range(n)})
    keys = sorted({(h + d, t) for h, t in cuts for d in (-1, 0, 1)} | {(h, "") for h, _ in cuts} | {(5000, "z")})
    rows = spark.createDataFrame(keys, "h long, tie string").select("h", "tie", sharding.range_index(F.col("h"), F.col("tie"), cuts).alias("r")).collect()
    assert len(rows) == len(keys)
    for r in rows:
        assert r.r == sum((h, t) <= (r.h, r.tie) for h, t in cuts)


def test_ranges_grow_with_the_rows():
    assert [sharding.range_count(n, 1000) for n in (0, 999, 5000, 2_048_000, 10**9, 10**11)] == [1, 1, 5, 2048, 4048, 202_048]


def test_shards_and_slots_equal_plain_version(spark):
    """In key order, a record lies in the shard where its weight begins; slots count within it."""
    rows = [(i, f"text {i} " * (i % 23)) for i in range(400)] + [(i, "same") for i in range(1000, 1100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = docs.selectExpr("doc_id", "octet_length(text) + 1 as size", "xxhash64(text) as h").collect()
    order = sorted(keyed, key=lambda r: (r.h, f"{r.doc_id:020d}"))
    total, before, want, slots = sum(r.size for r in order), 0, {}, defaultdict(int)
    for r in order:
        shard = before * 7 // total
        want[r.doc_id] = (shard, slots[shard])
        slots[shard] += 1
        before += r.size
    got = sharding.shard(docs, 7, per_range=20).collect()
    assert {r.id: (r.shard, r.slot) for r in got} == want


@pytest.mark.parametrize("shards", [1, 2])
def test_small_records_at_the_end_stay_in_the_last_shard(spark, shards):
    rows = [(i, f"{i:02d}") for i in range(40)] + [(100, "x" * 20_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard(docs, shards).collect()
    assert len(got) == len(rows)
    assert {r.shard for r in got} <= set(range(shards))
