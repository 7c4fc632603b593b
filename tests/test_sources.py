import json

import pytest
from pyspark.sql import functions as F

from groundcheck.sources import io


@pytest.fixture()
def runs(tmp_path):
    staged, flat = tmp_path / "AAA" / "2026-q2", tmp_path / "BBB" / "2026-h1"
    for p in (staged / "evidence" / "web", staged / "analysis", staged / "raw" / "web", flat):
        p.mkdir(parents=True)
    (staged / "evidence" / "segments.jsonl").write_text('{"id": "seg-0001", "section": "qa", "speaker": null, "text": "hi"}\n')
    (staged / "analysis" / "claims.json").write_text(json.dumps([{"id": "claim-1", "claim_text": "x", "values": {"a": 1, "calculation": {"name": "margin"}}, "inferred_from": []}]))
    (flat / "claims.json").write_text("[{]")
    (staged / "raw" / "web" / "query-01-hit-03.json").write_text(json.dumps({"url": "u", "publishedDate": "2026-01-01", "_class": "peer", "_query": "q"}, indent=1))
    (staged / "raw" / "call.txt").write_bytes(b"caf\xe9 text")
    (staged / "raw" / "page.html").write_text("<p>x</p>")
    (staged / "raw" / "x.pdf").write_text("no")
    (staged / "evidence" / "web" / "web-001.md").write_text("page text")
    (staged / "evidence" / "web.jsonl").write_text('{"id": "web-001", "content_path": "evidence/web/web-001.md", "temporal_status": "pre_event"}\n')
    return tmp_path


def test_run_tree(spark, runs):
    got = {(r.ticker, r.event_id, r.stage, r.name) for r in io.run_tree(spark, str(runs)).collect()}
    assert ("AAA", "2026-q2", "analysis", "claims.json") in got and ("BBB", "2026-h1", "flat", "claims.json") in got and ("AAA", "2026-q2", "evidence", "web-001.md") in got


def test_transcripts_and_size_guard(spark, runs):
    accepted, rejected = io.transcripts(spark, str(runs / "AAA" / "2026-q2" / "raw"), most_bytes=200)
    got = {r.path.rpartition("/")[2]: (r.is_html, r.text) for r in accepted.collect()}
    assert got["call.txt"] == (False, "caf� text") and got["page.html"][0] is True
    assert {r.reason for r in rejected.collect()} == {"unsupported suffix"}
    _, small = io.transcripts(spark, str(runs / "AAA" / "2026-q2" / "raw"), most_bytes=3)
    assert "too large" in {r.reason for r in small.collect()}


def test_json_readers(spark, runs):
    segs = io.json_lines(spark, f"{runs}/*/*/evidence/segments.jsonl", io.SEGMENT).first()
    assert (segs.run_id, segs.id, segs.speaker) == ("AAA/2026-q2", "seg-0001", None)
    good = io.json_array(spark, f"{runs}/*/*/analysis/claims.json", io.CLAIM)
    row = good.first()
    assert row.id == "claim-1" and json.loads(row["values"])["a"] == 1 and io.schema_issues(good.cache()).count() == 0
    bad = io.json_array(spark, f"{runs}/*/*/claims.json", io.CLAIM, depth=0).cache()
    assert [(i.run_id, i.check) for i in io.schema_issues(bad).collect()] == [("BBB/2026-h1", "schema")]
    hit = io.search_hits(spark, f"{runs}/*/*/raw/web/*.json").first()
    assert (hit.pos, hit.run_id, hit["class"], hit.score) == (100_003, "AAA/2026-q2", "peer", None)
    page = io.web_evidence(spark, f"{runs}/*/*/evidence/web.jsonl", f"{runs}/AAA/2026-q2/evidence/web").first()
    assert page.content == "page text"


def test_nested_payloads(spark):
    facts = {"Revenue": {"units": {"USD": [{"start": "2026-01-01", "end": "2026-03-31", "val": 5, "filed": "2026-04-20"}, {"end": "2026-06-30", "val": 7.5}]}}}
    got = io.company_facts(spark.createDataFrame([("1", json.dumps(facts))], "cik string, body string"), "body").orderBy("entry_pos").collect()
    assert [(r.concept, r.unit, r.end, r.val) for r in got] == [("Revenue", "USD", "2026-03-31", 5.0), ("Revenue", "USD", "2026-06-30", 7.5)]
    listing = spark.createDataFrame([(json.dumps({"0": {"cik_str": 19617, "ticker": "jpm", "title": "J"}}),)], "value string")
    assert tuple(io.ticker_ids(listing).first()) == ("JPM", "0000019617")


def test_price_shapes(spark):
    shapes = [
        ("A", {"historical": [{"date": "2026-01-02", "open": 1, "high": 2, "low": 0.5, "close": 1.5, "volume": 10}]}),
        ("B", {"Time Series (Daily)": {"2026-01-02": {"1. open": "1", "2. high": "2", "3. low": "0.5", "4. close": "1.5", "5. volume": "10"}}}),
        ("C", [{"Date": "2026-01-02T00:00:00", "Open": 1, "High": 2, "Low": 0.5, "Close": 1.5, "Volume": 10.0}]),
        ("D", {"Note": "limit reached"}),
    ]
    shapes += [("E", []), ("F", {"historical": []}), ("G", {"Time Series (Daily)": {}, "Note": "later"}), ("H", {})]
    rows = [(t, json.dumps(p)) for t, p in shapes] + [("I", "no json"), ("J", None)]
    bars, came = io.price_bars(spark.createDataFrame(rows, "ticker string, value string"))
    got = bars.collect()
    assert {r.ticker for r in got} == {"A", "B", "C"} and {str(r.date) for r in got} == {"2026-01-02"} and {(r.open, r.close, r.volume, r.nth) for r in got} == {(1.0, 1.5, 10, 1)}
    assert {r.ticker: r.error for r in came.where("status = 'error'").collect()} == {"D": "limit reached", "E": "no data returned", "G": "later", "I": "payload does not parse", "J": "payload does not parse"}
    assert {r.ticker: r.row_count for r in came.where("status = 'ok'").collect()} == {"A": 1, "B": 1, "C": 1, "F": 0, "H": 0}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("T", "e", "r1", 1)], "ticker string, event_id string, run_id string, n int")
    io.append_log(rows, str(tmp_path / "log"), ["run_id"])
    io.append_log(rows.withColumn("run_id", F.lit("r2")), str(tmp_path / "log"), ["run_id"])
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    io.write_artifacts(rows, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).first().ticker == "T"
    lines = spark.range(200).select(F.lit("T").alias("ticker"), F.lit("e f").alias("event_id"), F.col("id").alias("n"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("line "), F.col("id").cast("string"))).otherwise("").alias("line"))
    io.write_cards(lines, str(tmp_path / "cards"), ["n"], parts=5)
    back = io.read_cards(spark, str(tmp_path / "cards"))
    assert back.select("file").distinct().count() > 1 and {r.event_id for r in back.collect()} == {"e f"}
    assert [r.line for r in back.orderBy("file", "line_no").collect()] == ["" if i % 7 == 0 else f"line {i}" for i in range(200)]
    assert io.binary_sources(spark, str(tmp_path / "cards")).count() >= 1


def test_log_is_read_once(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("r", "a", 1), ("r", "b", 2), ("s", "a", 3)], "run_id string, subject string, n int")
    for batch, attempt in ((rows, 1), (rows, 1), (rows.where("n = 2").withColumn("n", F.lit(20)), 2)):
        io.append_log(batch, path, attempt=attempt)
    io.append_log(rows.where("n = 2").withColumn("n", F.lit(5)), path, attempt=1)
    got = io.read_log(spark, path, "run_id string, subject string, n int", ["run_id", "subject"])
    assert {(r.run_id, r.subject): r.n for r in got.collect()} == {("r", "a"): 1, ("r", "b"): 20, ("s", "a"): 3}


def test_layouts_and_quarantine(spark, tmp_path):
    for run, manifest, stage in (("A", '{"layout_version": 2}', "claims/"), ("B", "{", ""), ("C", '{"layout_version": true}', "")):
        root = tmp_path / "runs" / run / "e"
        (root / "claims").mkdir(parents=True)
        (root / "manifest.json").write_text(manifest)
        (root / "claims.json").write_text('[{"id": "claim-flat"}]')
        (root / "claims" / "claims.json").write_text('[{"id": "claim-deep"}, {"id": null}]' if run == "A" else "[{]")
    tree = io.run_tree(spark, str(tmp_path / "runs"))
    texts = spark.read.option("wholetext", True).text(f"{tmp_path}/runs/*/*/manifest.json").select(F.concat(F.regexp_extract("_metadata.file_path", "/([^/]+)/e/", 1), F.lit("/e")).alias("run_id"), F.col("value").alias("text"))
    layout = io.layouts(texts)
    assert {r.run_id: r.layout for r in layout.collect()} == {"A/e": 2, "B/e": 1, "C/e": 1}
    assert {(r.ticker, r.stage) for r in io.current_artifacts(tree, layout).where("name = 'claims.json'").collect()} == {("A", "claims"), ("B", "flat"), ("C", "flat")}
    records = io.json_array(spark, f"{tmp_path}/runs/*/*/claims/claims.json", io.CLAIM).cache()
    good, issues = io.quarantine(records)
    assert good.count() == 2 and {(i.run_id, i.check) for i in issues.collect()} == {("B/e", "schema"), ("C/e", "schema")}
    assert {i.run_id for i in io.quarantine(records, ("id",))[1].collect()} == {"A/e", "B/e", "C/e"}
