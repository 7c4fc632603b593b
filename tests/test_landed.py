"""Landed tables: files packed as rows are read as the same files in a tree are."""

import json
import os

import pytest
from pyspark.sql import functions as F

from groundcheck.operators import selection
from groundcheck.plans import landed, registry
from groundcheck.sources import io

#: Queries whose tables have a file for every row or key.
PACKED = ["landed_claims", "landed_hits", "landed_bytes", "landed_bars", "landed_price_lookups", "landed_pages", "landed_transcripts", "landed_facts"]


@pytest.mark.parametrize("name", PACKED)
def test_files_are_not_landed_one_by_one(spark, small_dir, tmp_path, name, monkeypatch):
    monkeypatch.setattr(landed, "scratch_path", lambda spark, name: str(tmp_path / name))
    assert registry.QUERIES[name](spark, small_dir).count() > 0
    assert {f for _, folders, _ in os.walk(tmp_path) for f in folders if f.startswith("name=")} <= {"name=web-evidence.jsonl"}


def test_packed_files_are_read_like_a_tree(spark, tmp_path):
    bodies = {
        "good": '[{"id": "a", "values": {"x": 1.50}}, {"id": null}]', "one": ' \n{"id": "b"}', "none": "[]", "blank": " \n", "cut": '[{"id": "c"}, {"id',
        "type": '[{"id": "d"}, {"id": "e", "confidence": "high"}]', "text": "no json", "bytes": b'[{"id": "\xe9"}]',
    }
    rows = [(k, "e", "claims", "claims.json", b if isinstance(b, bytes) else b.encode()) for k, b in bodies.items()]
    files = spark.createDataFrame(rows, "ticker string, event_id string, stage string, name string, content binary")
    io.pack(files, str(tmp_path / "packed"))
    back = io.packed(spark, str(tmp_path / "packed"))
    odd = files.limit(1).withColumns({"ticker": F.lit("T +%/é"), "event_id": F.lit("")})
    io.pack(odd, str(tmp_path / "odd"))
    assert io.packed(spark, str(tmp_path / "odd")).select(io.placed(F.col("path")).alias("p")).first().p[:2] == ("T +%/é", "")
    assert {tuple(r) for r in back.select(io.placed(F.col("path")).alias("p"), "content", "length").select("p.*", "content", "length").collect()} == {(*r, len(r[-1])) for r in rows}
    for ticker, *_, content in rows:
        place = tmp_path / "tree" / ticker / "e" / "claims"
        place.mkdir(parents=True)
        (place / "claims.json").write_bytes(content)

    def told(records):
        records = records.cache()
        return {(r.ticker, r.id, str(json.loads(r["values"] or "null"))) for r in records.where("_corrupt_record is null").collect()}, {r.ticker for r in records.where("_corrupt_record is not null").collect()}

    tree, held = told(io.json_array(spark, f"{tmp_path}/tree/*/*/claims/*.json", io.CLAIM)), told(io.json_array(spark, back, io.CLAIM))
    assert held[1] == tree[1] == {"cut", "type", "text", "bytes"}
    clear = lambda found: {r for r in found if r[0] not in tree[1]}
    assert clear(held[0]) == clear(tree[0]) and ("good", "a", "{'x': 1.5}") in held[0]


def test_hits_and_bytes_of_packed_files(spark):
    rows = [("A", "e", "raw", "query-01-hit-03.json", '{"url": "u", "publishedDate": "2026-01-01", "score": 0.5}'), ("A", "e", "raw", "query-02-hit-100000.json", "torn {")]
    back = landed.packed(spark.createDataFrame(rows, "ticker string, event_id string, stage string, name string, value string"), "hits")
    assert {(r.run_id, r.pos, r.url, r.score, r.publishedDate) for r in io.search_hits(spark, back).collect()} == {("A/e", 100_003, "u", 0.5, "2026-01-01"), ("A/e", 300_000, None, None, None)}
    assert {(bytes(r.content), r.byte_length) for r in io.binary_sources(spark, back).collect()} == {(f"{r[-1]}\n".encode(), len(r[-1]) + 1) for r in rows}


def test_a_period_is_computed_once_for_a_filter_on_its_kind(spark):
    facts = selection.with_period(spark.createDataFrame([("2026-01-01", "2026-03-31")], "start string, end string")).where("period_type = 'quarter'")
    assert facts.first()[2:] == (89, "quarter")
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("yyyyMMdd") <= 2 * 3  # two dates; in the filter, and for each of two columns at most
