import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from groundcheck.functions.jsontext import indented_json
from groundcheck.operators import audits, briefs, claims, coverage, integrity, reviews, rounds as chain, segments, selection, triage

CLAIM = "run_id string, claim_index int, id string, classification string, claim_text string, quote string, segment_id string, web_evidence_id string, values string, inferred_from array<string>"


def issues_of(spark, rows, segs=(("r", "seg-1", "Revenue rose 10% to $110 million from 100."),), web=(), facts=()):
    found = claims.issues(
        spark.createDataFrame(rows, CLAIM),
        spark.createDataFrame(list(segs), "run_id string, id string, text string"),
        spark.createDataFrame(list(web), "run_id string, id string, content string, temporal_status string"),
        spark.createDataFrame(list(facts), "run_id string, value double"),
    )
    return {(r.claim_index, r.check) for r in found.collect()}


def claim(i, text="Revenue rose 10%.", quote="Revenue rose 10% to $110 million", values='{"growth": 10}', cls="reported_fact", seg="seg-1", web=None, inferred=(), cid=None):
    return ("r", i, cid or f"claim-{i}", cls, text, quote, seg, web, values, list(inferred))


def test_claim_checks(spark):
    calc = lambda result, current=110: '{"calculation": {"name": "yoy_growth", "inputs": {"current": %s, "prior": 100}, "result": %s}}' % (current, result)
    rows = [
        claim(0),
        claim(1, quote="Revenue  rose\n10%"),
        claim(2, quote="revenue rose"),
        claim(3, quote=""),
        claim(4, values='{"growth": 11, "ok": 10}'),
        claim(5, text="Revenue was 999."),
        claim(6, quote="Revenue rose", text="It rose to 110."),
        claim(7, values="{}"),
        claim(8, values=calc("0.10")),
        claim(9, values=calc("0.30")),
        claim(10, values=calc("0.50", 150)),
        claim(11, values='{"calculation": {"name": "yoy_growth"}}'),
        claim(12, values=calc('"x"')),
        claim(13, seg=None),
        claim(14, web="web-1"),
        claim(15, seg="nope", quote="", values='{"a": 5}'),
        claim(16, seg=None, web="web-late"),
        claim(17, cls="analytical_inference", text="No peers grew.", inferred=["claim-0"], values='{"g": 10}'),
        claim(18, cls="analytical_inference", inferred=[]),
        claim(19, cls="analytical_inference", inferred=["claim-99"]),
        claim(20, cls="analytical_inference", inferred=["claim-20"]),
        claim(21, cid="claim-0"),
        claim(22, values='{"flag": true}'),
        claim(23, text="In FY2026 and Q2, see claim-011: it rose 10%."),
    ]
    got = issues_of(spark, rows, web=[("r", "web-late", "late page", "post_event")])
    want = {
        (2, "exact_quote"), (3, "exact_quote"), (4, "numeric"), (5, "claim_text_numeric"), (5, "claim_text_quote_traceable"), (6, "claim_text_quote_traceable"),
        (7, "values_present"), (9, "calculation"), (10, "calculation_inputs"), (11, "calculation"), (12, "calculation"), (13, "evidence_reference"), (14, "evidence_reference"),
        (15, "schema"), (16, "temporal_eligibility"), (17, "universal_quantifier"), (18, "inference_citation"), (19, "inference_citation"), (20, "inference_citation"), (21, "claim_id"), (22, "numeric"),
    }
    assert {x for x in got if x[0] != 3} == {x for x in want if x[0] != 3} and (3, "exact_quote") in got


def test_financial_values_ground_and_gate(spark):
    rows = [claim(0, values='{"a": 777}'), claim(1, values='{"a": 778}')]
    assert issues_of(spark, rows, facts=[("r", 777.0)]) == {(1, "numeric")}
    df = spark.createDataFrame(rows, CLAIM)
    found = spark.createDataFrame([("r", 1, "numeric", "m")], "run_id string, claim_index int, check string, message string")
    assert claims.gate(df, found).first().asDict() == {"run_id": "r", "claims": 2, "issues": 1, "ok": False}


def test_metric_provenance_and_use(spark):
    df = spark.createDataFrame([claim(0, seg=None, web="w1")], CLAIM)
    metrics = spark.createDataFrame([("r", 0, ["claim-0"]), ("r", 1, []), ("r", 2, ["claim-9"])], "run_id string, metric_index int, source_claim_ids array<string>")
    assert {r.claim_index for r in claims.metric_provenance(metrics, df).collect()} == {1, 2}
    pages = spark.createDataFrame([("r", f"w{i}") for i in range(4)] + [("s", "w1")], "run_id string, id string")
    assert {r.run_id: (r.pages, r.cited, r.advisory is None) for r in claims.evidence_use(pages, df).collect()} == {"r": (4, 1, False), "s": (1, 0, False)}


FACT = "run_id string, concept string, start string, end string, filed string, val double, unit_pos int, entry_pos int"


def test_point_in_time(spark):
    rows = [("r", "Rev", "2026-04-01", "2026-06-30", "2026-07-25", 110e6, 0, 0), ("r", "Rev", "2026-04-01", "2026-06-30", "2026-09-15", 999e6, 0, 1), ("r", "Rev", "2026-01-01", "2026-03-31", "2026-04-20", 1.0, 0, 2)]
    assert [r.val for r in selection.point_in_time(spark.createDataFrame(rows, FACT), ["run_id", "concept"]).collect()] == [110e6]
    shared = [("r", "Rev", s, "2026-06-30", "2026-07-25", v, 0, i) for i, (s, v) in enumerate([("2026-04-01", 30e6), ("2026-01-01", 55e6), ("2025-07-01", 115e6)])]
    df = selection.with_period(spark.createDataFrame(shared, FACT))
    for kind, v in (("quarter", 30e6), ("half_year", 55e6), ("full_year", 115e6)):
        assert [r.val for r in selection.in_period(df, ["run_id", "concept"], kind=kind).collect()] == [v]
    assert selection.in_period(df, ["run_id", "concept"], kind="nine_months").count() == 3
    assert selection.in_period(df, ["run_id", "concept"], kind="nine_months", required=True).count() == 0


def plain_round_robin(hits, n):
    order = sorted(range(len(hits)), key=lambda i: (-(hits[i][3] if hits[i][3] is not None else -1), i))
    buckets = {}
    for i in order:
        buckets.setdefault(hits[i][4] or hits[i][5] or "", []).append(i)
    out, seen = [], set()
    while len(out) < n and any(buckets.values()):
        for b in buckets.values():
            if b and len(out) < n:
                i = b.pop(0)
                if hits[i][2] and hits[i][2] not in seen:
                    seen.add(hits[i][2])
                    out.append(hits[i][1])
    return out


@pytest.mark.parametrize("seed", range(4))
def test_round_robin_equals_loop(spark, seed):
    r = random.Random(seed)
    hits = [("r", i, r.choice(["u1", "u2", "", None] + [f"v{j}" for j in range(15)]), r.choice([None, 0.0, 0.5, 0.9]), r.choice(["", None, "a", "b"]), r.choice(["x", None])) for i in range(40)]
    df = spark.createDataFrame(hits, "run_id string, pos int, url string, score double, select_key string, class string")
    got = [x.pos for x in selection.round_robin(df, 10).orderBy("selected").collect()]
    assert got == plain_round_robin(hits, 10)


def test_queries_hits_and_guard(spark):
    companies = spark.createDataFrame([("r", "Acme", "ACM", "2026-q2")], "run_id string, company string, ticker string, event_id string")
    templates = [("consensus", 0, "{company} ({ticker}) {event_id}"), ("peer", 0, "{peer} vs {ticker}")]
    peers = spark.createDataFrame([("r", "Bolt", 0), ("r", "Cog", 1)], "run_id string, peer string, peer_pos int")
    got = [(q.select_key, q.query) for q in selection.expand_queries(companies, templates, peers).orderBy("pos").collect()]
    assert got == [("consensus", "Acme (ACM) 2026-q2"), ("Bolt", "Bolt vs ACM"), ("Cog", "Cog vs ACM")]
    hits = spark.createDataFrame([("r", 1, None, "2026-07-01"), ("r", 2, "2026-08-01", None), ("r", 3, None, None)], "run_id string, pos int, published_date string, publishedDate string")
    guarded = selection.date_guard(selection.normalize_hits(hits), F.to_date(F.lit("2026-07-14")))
    assert {g.pos: g.temporal_status for g in guarded.collect()} == {1: "pre_event", 2: "post_event", 3: "undated"}
    assert selection.guard_counts(guarded).first().asDict() == {"run_id": "r", "kept": 2, "excluded": 1}


SPEAKERS = [
    ("Wouter van der Vorst, ING Group: Thank you.", "Wouter van der Vorst, ING Group", "Thank you."),
    ("Group Sales — 3.6%: some text.", None, None),
    ("Jane Smith — Chief Executive Officer: Hello", "Jane Smith", "Hello"),
    ("Note that revenue: grew", None, None),
    ("Forward Looking Statements: text", None, None),
    ("Speaker 1: Yes.", "Speaker 1", "Yes."),
    ("Łukasz Żak, Bank Pekao: Hi", "Łukasz Żak, Bank Pekao", "Hi"),
]


@pytest.mark.parametrize("line,speaker,rest", SPEAKERS)
def test_speakers(spark, line, speaker, rest):
    got = spark.range(1).select(segments.detect_speaker(F.lit(line)).alias("d")).first().d
    assert got.speaker == speaker and (speaker is None or got.rest == rest)


def test_segmentation(spark):
    text = "Jane Smith, CEO: We grew.\nStill me.\nWe will now go to Q&A.\nA question without a name.\nQuestions and Answers:\nBob Ray, Bank: Why?\n\nUnknown Person here today:\n"
    lines = segments.transcript_lines(spark.createDataFrame([("d", text)], "doc string, text string"), "doc")
    got = [(s.id, s.section, s.speaker, s.text) for s in segments.segments(lines, "doc").orderBy("seq").collect()]
    assert got == [
        ("seg-0001", "prepared", "Jane Smith, CEO", "We grew. Still me. We will now go to Q&A."),
        ("seg-0002", "qa", None, "A question without a name."),
        ("seg-0003", "qa", "Bob Ray, Bank", "Why? Unknown Person here today:"),
    ]
    assert [m.line for m in segments.near_misses(lines, "doc").collect()] == ["Unknown Person here today:"]
    assert segments.omissions(lines, "doc").count() == 1 and segments.speakerless(lines, "doc").count() == 0


def test_coverage(spark):
    evidence = spark.createDataFrame([("r", "segments", s) for s in "abcde"], "run_id string, section string, id string")
    receipt = spark.createDataFrame(
        [("r", "segments", "a", "claims_extracted", ["claim-1"], None), ("r", "segments", "b", "deliberately_immaterial", [], " "), ("r", "segments", "c", "skipped", [], "x"), ("r", "segments", "d", "claims_extracted", ["claim-9"], None), ("r", "segments", "z", "deliberately_immaterial", [], "ok"), ("r", "web_evidence", "w", "skipped", [], None)],
        "run_id string, section string, id string, outcome string, claim_ids array<string>, reason string",
    )
    own = spark.createDataFrame([("r", "claim-1")], "run_id string, id string")
    got = {(i.id, i.message.split(":")[0]) for i in coverage.coverage_issues(receipt, evidence, own).collect()}
    assert got == {("b", "immaterial without a reason"), ("c", "outcome must be claims_extracted or deliberately_immaterial"), ("d", "unknown claim id(s)"), ("e", "missing from the receipt"), ("z", "not in this run's evidence")}


def test_briefs(spark):
    text = "# Title 2026\n\nRevenue was \\$110 million [claim-0].\n\n- margin 31%\n  wrapped [claim-0]\n- growth 10% [claim-0]\nand 55 bps\n\nBare 12 shops. $5\n"
    df = spark.createDataFrame([("r", text)], "run_id string, text string")
    assert [u.body for u in briefs.grounding_units(df, "run_id").orderBy("unit").collect()] == ["Revenue was \\$110 million [claim-0].", "- margin 31%\n  wrapped [claim-0]", "- growth 10% [claim-0]\nand 55 bps", "Bare 12 shops. $5"]
    own = spark.createDataFrame([claim(0, values='{"m": 0.31}')], CLAIM)
    got = sorted((i.unit, i.message.rpartition(" ")[2]) for i in briefs.number_issues(df, own).collect())
    assert got == [(3, "55.0"), (4, "5.0")]
    assert briefs.citation_issues(df, own).count() == 0 and briefs.dollar_issues(df).count() == 1
    assert {p.key for p in briefs.citation_pairs(df, own).collect() if p.nth == 0} and briefs.citation_issues(df, own.limit(0)).first().message.endswith("claim-0")
    numbered = spark.createDataFrame([("r", "x\n## 1. One\nbody\n## 5. Five\nmore\n")], "run_id string, text string")
    assert {s.section: s.body for s in briefs.sections(numbered, "run_id").collect()} == {1: "body\n", 5: "more\n"}


FINDING = "run_id string, list_name string, idx int, severity string, artifact string, passage string, evidence string, recommendation string"


def test_reviews(spark):
    reports = spark.createDataFrame([("a", "pass", "full", 1, 1, 0), ("b", "fail", "diff", 0, 1, 0), ("c", "pass_with_warnings", "full", 1, 1, 0)], "run_id string, verdict string, mode string, source_checks int, process_findings int, unverified_items int")
    findings = spark.createDataFrame([("a", "claim_findings", 0, "high", "x", "claim-1", "", ""), ("b", "claim_findings", 0, "low", "claim-7", "", "", "")], FINDING)
    receipts = spark.createDataFrame([("a", "reviewed_ok", "claim-1"), ("a", "with_findings", "claim-2"), ("a", "carried_forward", "claim-3"), ("a", "unverifiable", "claim-3"), ("b", "reviewed_ok", "claim-1")], "run_id string, bucket string, claim_id string")
    own = spark.createDataFrame([(r, f"claim-{i}") for r in "ab" for i in (1, 2, 3, 4)], "run_id string, id string")
    got = {(i.run_id, i.message.split(":")[0]) for i in reviews.receipt_issues(reports, receipts, findings, own).collect()}
    assert {m for r, m in got if r == "a"} == {"not accounted for", "in more than one bucket", "claims are carried forward in a full review", "no finding is raised against claim-2", "reviewed_ok despite a finding above info", "unverifiable claims without an unverified item"}
    assert ("c", "receipt is missing") in got
    v = {(i.run_id, i.check) for i in reviews.verdict_issues(reports, findings).collect()}
    assert v == {("a", "verdict_severity"), ("b", "review_receipt"), ("b", "verdict_severity"), ("c", "verdict_severity")}
    assert [(i.run_id) for i in reviews.citation_issues(findings, own).collect()] == ["b"]


def test_escalation_and_gate(spark):
    old = spark.createDataFrame([("r", "claim-1", "q1", "{}"), ("r", "claim-2", "q1", "{}")], "run_id string, claim_id string, period string, values string")
    new = spark.createDataFrame([("r", "claim-1", "q2", "{}"), ("r", "claim-3", None, None)], old.schema)
    diff = reviews.claim_diff(old, new, ["run_id", "claim_id"], ["period", "values"])
    assert {d.claim_id: d.change for d in diff.collect()} == {"claim-1": "changed", "claim-2": "removed", "claim-3": "added"}
    sections = spark.createDataFrame([("r", 5, "see [claim-1]"), ("r", 2, "[claim-2]")], "run_id string, section int, body string")
    texts = spark.createDataFrame([("r", "old", "new")], "run_id string, prior_text string, text string")
    e = reviews.escalation(diff, sections, texts).first()
    assert e.escalated and len(e.reasons) == 3
    reports = spark.createDataFrame([("a", 1, "pass", False), ("b", 4, "pass", False), ("c", 2, "fail", False), ("d", 2, "pass", True), ("e", 1, "pass_with_warnings", False)], "run_id string, round int, verdict string, escalated boolean")
    none = spark.createDataFrame([], "run_id string, check string, message string")
    assert {g.run_id: g.code for g in reviews.review_gate(reports, none).collect()} == {"a": 0, "b": 4, "c": 2, "d": 3, "e": 1}
    more = spark.createDataFrame([("a", 4, "pass", False, True, True, True), ("b", 2, "fail", True, False, True, True), ("c", 2, "pass", False, False, None, True), ("d", 2, "pass", True, False, True, False)], "run_id string, round int, verdict string, escalated boolean, repeated boolean, claims_ok boolean, bound boolean")
    assert {g.run_id: g.code for g in reviews.review_gate(more, none).collect()} == {"a": 0, "b": 3, "c": 2, "d": 2}


def test_integrity(spark):
    good = hashlib.sha256(b"abc").hexdigest()
    manifest = spark.createDataFrame([("r", "a", good, 3), ("r", "b", good, 3), ("r", "c", good, 4), ("r", "d", "0", 3), ("r", "../e", good, 3)], "run_id string, path string, sha256 string, byte_length long")
    files = spark.createDataFrame([("r", p, bytearray(b"abc")) for p in ("a", "c", "d")], "run_id string, path string, content binary")
    assert {i.path for i in integrity.manifest_issues(manifest, files).collect()} == {"b", "c", "d", "../e"}
    recorded = spark.createDataFrame([("r", {"x": "1", "y": "2"}), ("s", {"x": "1"})], "run_id string, input_hashes map<string,string>")
    now = spark.createDataFrame([("r", "x", "1"), ("r", "y", "3"), ("s", "x", "1")], "run_id string, name string, sha256 string")
    assert {r.run_id: (r.fresh, r.stale) for r in integrity.staleness(recorded, now, ["x"]).collect()} == {"r": (False, ["y"]), "s": (True, [])}
    decisions = spark.createDataFrame([("ok", "used", "why"), ("bad", "used", "why"), ("none", "not_used", "why"), ("f", "attempted_failed", "why"), ("r", "not_used", "")], "run_id string, decision string, reason string")
    log = spark.createDataFrame([("ok", "T", "ok", "T"), ("bad", "T", "error", "T"), ("f", "T", "error", "T")], "run_id string, ticker string, status string, own_ticker string")
    assert {i.run_id for i in integrity.price_issues(decisions, log).collect()} == {"bad", "r"}


def test_triage(spark):
    schema = "run_id string, claim_id string, question_id string, type string, noul double, choice string, expected string, confidence double, probabilities map<string,double>, score double, legend map<string,string>"
    nouls = [0.97, 0.70, 0.69, 0.48]
    rows = [("r", f"n{i}", "q", "noul", n, None, None, None, None, None, None) for i, n in enumerate(nouls)]
    rows += [("r", f"s{i}", "q", "score", None, None, None, None, None, s, {"0": "a", "1": "b", "2": "c", "3": "d"}) for i, s in enumerate([2.98, 2.7, 2.4, 1.4])]
    rows += [("r", "c0", "q", "choice", None, "supports", "supports", 0.9, {"supports": 0.66, "says_nothing": 0.33}, None, None), ("r", "c1", "q", "choice", None, "contradicts", "supports", 0.9, {"contradicts": 0.9}, None, None), ("r", "c2", "q", "choice", None, "supports", "supports", 0.5, {"supports": 0.9}, None, None)]
    answers = spark.createDataFrame(rows, schema)
    items = triage.triage(answers)
    got = {i.claim_id: i.severity for i in items.collect()}
    assert got == {"n2": "check", "n3": "defect", "s2": "check", "s3": "defect", "c0": "check", "c1": "defect", "c2": "check"}
    assert triage.counts(answers, items).first().asDict() == {"run_id": "r", "audited": 11, "flagged": 7, "defect": 3, "check": 4}
    keyed = items.select("run_id", F.col("claim_id").alias("key"), "severity")
    settled = spark.createDataFrame([("r", "n3", "fixed"), ("r", "check-tier", "accepted"), ("r", "s3", "")], "run_id string, key string, action string")
    assert {i.key for i in triage.open_items(keyed, settled).collect()} == {"s3", "c1"}


def test_answer_maps_are_counted_by_call(spark):
    answer = "struct<type:string,noul:double,choice:string,confidence:double,probabilities:map<string,double>,score:double,legend:map<string,string>>"
    weak = ("noul", 0.6, None, None, None, None, None)
    label = ("choice", None, "reported_fact", 0.9, {"reported_fact": 0.95}, None, None)
    rows = [("r", "a", "c1", "g", "ok", {"x": weak, "y": weak, "classification": label}), ("r", "b", "c2", "g", "ok", {"classification": label}), ("r", "c", "c3", "g", "error", {"x": weak})]
    calls = spark.createDataFrame(rows, f"run_id string, subject string, claim_id string, generation_id string, status string, answers map<string,{answer}>")
    own = spark.createDataFrame([("r", "c1", "reported_fact"), ("r", "c2", "management_opinion")], "run_id string, id string, classification string")
    asked = spark.createDataFrame([("r", "a", [("x", "noul", "Is x so?", "{}")])], "run_id string, subject string, questions array<struct<key:string,type:string,instructions:string,criteria:string>>")
    answers = triage.answers_of(calls, asked, own)
    items = triage.ordered(triage.triage(answers))
    got = [(i.nth, i.key, i.severity, i.asked, i.reading, i.why) for i in items.orderBy("nth").collect()]
    assert got == [(1, "b::classification", "defect", "classification", "reported_fact", "answered 'reported_fact' at 95% where the record implies 'management_opinion'"), (2, "a::x", "check", "Is x so?", "0.6", "true with 60% only"), (3, "a::y", "check", "y", "0.6", "true with 60% only")]
    assert triage.counts(calls, items).first().asDict() == {"run_id": "r", "audited": 3, "flagged": 3, "defect": 1, "check": 2}


def test_json_as_python_writes_it(spark):
    texts = ['{"b": 1, "a": {"x": [1, 2.50, 1e16, -0.0, {"y": []}], "z": {}}, "id": "drop", "s": "\\u00e9\\n\\"€😀"}', '{"a": 1, "b": 2, "a": 3}', "[1, true, null]", "torn {", None, "12345678901234567890123"]
    got = [r.j for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(indented_json(F.col("t"), drop=("id",)).alias("j")).collect()]
    want = [json.dumps({k: v for k, v in json.loads(t).items() if k != "id"} if t.startswith("{") else json.loads(t), indent=2) if t and t != "torn {" else None for t in texts]
    assert got == want


def test_audits(spark):
    rounds = spark.createDataFrame([("r", 1, "fail", False), ("r", 2, "pass_with_warnings", True)], "run_id string, round int, verdict string, escalated boolean")
    got = audits.round_rollup(rounds).first()
    assert (got.rounds, got.failed_rounds, got.escalations, got.verdict) == (2, 1, 1, "pass_with_warnings")
    findings = spark.createDataFrame([("r", "high")] + [("r", "medium")] * 3, "run_id string, severity string")
    s = audits.severity_counts(findings, ["run_id"]).first()
    assert (s.high, s.medium, s.low) == (1, 3, 0)
    attempts = spark.createDataFrame([("r", "analysis", 1, "rejected"), ("r", "analysis", 2, "passed")], "run_id string, stage string, attempt int, outcome string")
    rolled = audits.attempt_rollup(attempts).first()
    assert (rolled.attempts, rolled.rejections, rolled.retries, rolled.outcome) == (2, 1, 1, "passed")
    found = spark.createDataFrame([("r", "a"), ("r", "a"), ("r", "b")], "run_id string, check string")
    assert audits.issue_counts(found, ["run_id"]).first().issue_counts == {"a": 2, "b": 1}
    lessons = spark.createDataFrame([(" x ",), ("x",), ("y",), ("",)], "line string")
    assert [r.line for r in audits.new_lessons(lessons, spark.createDataFrame([("y",)], "line string")).collect()] == ["x"]


def test_audit_record_is_whole(spark):
    runs = spark.createDataFrame([("r", "T", "e", True, "now", None, None, '{"model": "x"}', None), ("q", "T", "e", False, "now", True, None, None, None), ("bare", "B", "e", True, "now", False, None, None, None)], "run_id string, ticker string, event_id string, accepted boolean, generated_at string, brief_ok boolean, tool_decisions string, extractor string, outlook_author string")
    attempts = spark.createDataFrame([("r", audits.CLAIM_STAGE, 1, "rejected"), ("r", audits.CLAIM_STAGE, 2, "passed"), ("r", audits.BRIEF_STAGE, 1, "passed")], "run_id string, stage string, attempt int, outcome string")
    rounds = spark.createDataFrame([("r", 2, "pass", None, 'fine "now"', "m", "high"), ("r", 1, "fail", True, "bad", "m", "low")], "run_id string, round int, verdict string, escalated boolean, summary string, model string, reasoning_effort string")
    findings = spark.createDataFrame([("r", 1, "high"), ("r", 1, "high"), ("r", 1, "info"), ("r", 1, "other")], "run_id string, round int, severity string")
    sources = spark.createDataFrame([("r", 0, "raw/transcript.pdf.converted.md", "c"), ("r", 1, "raw/transcript.pdf", "p"), ("r", 2, "raw/w.html", "w")], "run_id string, pos int, path string, sha256 string")
    hashes = spark.createDataFrame([("r", "claims", "h1"), ("r", "claims", "h2")], "run_id string, name string, sha256 string")
    got = {r.run_id: json.loads(r.record) for r in audits.audit_record(runs, attempts, rounds, findings, sources, hashes).collect()}
    assert set(got) == {"r", "bare"}
    record = got["r"]
    assert list(record) == ["run_id", "ticker", "event_id", "status", "final_review_round", "generated_at", "decision", "trace_summary", "workflow_trace", "review_history_summary", "guardrail_summary", "tool_decisions", "hashes", "evidence_summary", "reviewer_model", "agent_provenance"]
    assert record["trace_summary"] == "Analysis drew on 3 recorded source(s) (transcript, SEC/web evidence). 2 claim-validation attempt(s) were made, 1 with issues, before passing. 1 outlook-validation attempt(s) were made before passing. Review ran 2 round(s): round 1 fail with 2 high, 1 info finding(s); round 2 pass."
    assert record["workflow_trace"] == [{"stage": "claim_validation", "attempts": 2, "status": "passed"}, {"stage": "outlook_validation", "attempts": 1, "status": "passed"}, {"stage": "review", "round": 1, "status": "fail"}, {"stage": "review", "round": 2, "status": "pass"}]
    assert record["decision"] == {"verdict": "pass", "summary": 'fine "now"', "finding_counts": {"critical": 0, "high": 0, "medium": 0, "low": 0, "info": 0}}
    assert record["guardrail_summary"] == {"validation_retries": 1, "validation_rejections": 1, "outlook_validation_retries": 0, "outlook_validation_rejections": 0, "review_rejections": 1, "escalations": 1}
    assert record["hashes"]["transcript_sha256"] == "p" and record["hashes"]["claims_sha256"] == "h2" and record["hashes"]["manifest_sha256"] is None
    assert record["review_history_summary"]["historical_findings"]["high"] == 2 and record["agent_provenance"]["reviewer"] == {"model": "m", "reasoning_effort": "high"} and record["agent_provenance"]["extractor"] == {"model": "x"}
    assert got["bare"]["workflow_trace"][1]["status"] == "unknown" and got["bare"]["final_review_round"] is None and got["bare"]["trace_summary"].endswith("0 claim-validation attempt(s) were made before passing.")


def test_signal_cards_are_rows_in_order(spark):
    rows = [("r", 4, "b_two", "draft", "fact", None, "four $4", "q4", "s4", None, None), ("r", 2, None, "verified", "fact", "Ann", "two", "q2", None, "w2", ["over $1", "x"]), ("r", 1, "b_two", "verified", "fact", "", "one", "q1", "", "w1", [])]
    own = spark.createDataFrame(rows, "run_id string, claim_index int, category string, status string, classification string, speaker string, claim_text string, quote string, segment_id string, web_evidence_id string, caveats array<string>")
    runs = spark.createDataFrame([("r", "tt", "e", "now"), ("empty", "uu", "e", "now")], "run_id string, ticker string, event_id string, generated_at string")
    card = audits.signal_card(own, runs)
    lines = [r.line for r in card.where("ticker = 'tt'").orderBy("place", "claim_index", "part").collect()]
    assert lines == ["# Signal Card: TT — e", "", "_Generated: now_", "", "## B Two", "- **verified** [fact]: one", '  > "q1" — w1', "- **draft** [fact]: four \\$4", '  > "q4" — s4', "", "## None", "- **verified** [fact] (Ann): two", '  > "q2" — w2', "  - *caveat:* over \\$1", "  - *caveat:* x", ""]
    assert card.where("ticker = 'uu'").count() == 4


def test_audit_states_window_only_web_evidence(spark):
    text = "  head\n" + "word " * 4000 + "tail  "
    values = '{"m": 0.31, "n": 5, "half": 1.50, "big": 12345678.0, "huge": 2.5e20, "tiny": 1e-5, "s": "12", "flag": true, "calculation": {"op": "x"}, "none": null, "minus": -3, "zero": 0.0}'
    rows = [("r", "c1", "s", None, "not there", "FY2026", values), ("r", "c2", None, "w", "tail", None, None), ("r", "c3", None, "w", "not there", "", "{}"), ("r", "c4", None, "gone", "x", None, "{}")]
    own = spark.createDataFrame(rows, "run_id string, id string, segment_id string, web_evidence_id string, quote string, period string, values string")
    passages = spark.createDataFrame([("r", "s", "qa", text)], "run_id string, id string, section string, text string")
    contexts = triage.call_context(spark.createDataFrame([("r", "T", "e", None)], "run_id string, ticker string, event_id string, event_date string"))
    pages = spark.createDataFrame([("r", "w", text)], "run_id string, id string, content string")
    got = {r.id: r for r in triage.audit_states(own, passages, pages, contexts, 100).collect()}
    assert all(r.state.startswith("CALL CONTEXT: T e earnings call, event date None.\n\nSOURCE ") for r in got.values())
    passage = {i: r.state.split("):\n", 1)[1].split("\n\nEXTRACTED CLAIM RECORD")[0] for i, r in got.items()}
    flat = " ".join(text.split())
    assert passage == {"c1": text, "c2": flat[-100:], "c3": flat[:100], "c4": ""}
    assert [got[i].note for i in ("c1", "c2", "c3", "c4")] == [None, "windowed", "quote not found; head only", None]
    always = ["claim_vs_evidence", "classification", "values_capture", "claim_text_traceable"]
    asked = {k: v for k, v in json.loads(values).items() if k != "calculation" and isinstance(v, (int, float))}
    assert [q.key for q in got["c1"].questions] == [*always, "period_correct", *[f"value__{k}" for k in asked]]
    assert [q.instructions.split(". Read")[0] for q in got["c1"].questions[5:]] == [f"The record extracts values['{k}'] = {v}" for k, v in asked.items()]
    assert [[q.key for q in got[i].questions] for i in ("c2", "c3", "c4")] == [always] * 3
    assert [q.type for q in got["c2"].questions] == ["choice", "choice", "score", "noul"] and len(json.loads(got["c2"].questions[2].criteria)) == 4
    assert set(json.loads(got["c1"].questions[5].criteria)) == {"true", "false"}


def test_ids_beyond_their_padding(spark):
    lines = spark.range(1, 10_013).select(F.lit("r").alias("run_id"), F.concat(F.lit("Jane Smith: turn "), F.col("id").cast("string")).alias("line"), F.col("id").cast("int").alias("line_no"))
    found = segments.segments(lines, "run_id")
    assert found.select("id").distinct().count() == 10_012 and found.where("id = 'seg-1000'").count() == 1 and found.where("seq = 10012").first().id == "seg-10012"
    ids = selection.evidence_ids(spark.range(1, 1002).select(F.col("id").cast("int").alias("selected")))
    assert ids.select("id").distinct().count() == 1001 and {r.id for r in ids.where("selected in (7, 1001)").collect()} == {"web-007", "web-1001"}


def test_repeated_keys_end_no_job(spark):
    values = ['{"calculation": {"name": "margin", "inputs": {"numerator": 1, "numerator": 20, "denominator": 40}, "result": 0.5}}', '{"growth": 7, "growth": 10, "text": "12"}', '{"growth": 10, "growth": "x"}']
    rows = [("r", i, f"claim-{i}", "reported_fact", "It was so.", "Costs were 20 of 40, 10 percent", "s", None, v, []) for i, v in enumerate(values)]
    own = spark.createDataFrame(rows, "run_id string, claim_index int, id string, classification string, claim_text string, quote string, segment_id string, web_evidence_id string, values string, inferred_from array<string>")
    segs = spark.createDataFrame([("r", "s", "Costs were 20 of 40, 10 percent")], "run_id string, id string, text string")
    pages = spark.createDataFrame([], "run_id string, id string, content string, temporal_status string")
    facts = spark.createDataFrame([], "run_id string, value double")
    assert claims.issues(own, segs, pages, facts).collect() == []


def test_many_claims_of_one_passage(spark, monkeypatch):
    monkeypatch.setattr(claims, "CLAIMS_IN_ROW", 3)
    rows = [("r", i, f"claim-{i}", "reported_fact", f"It was {i}.", f"was {i} of" if i % 2 else "never", "s" if i % 3 else None, None if i % 3 else "w", "{}", []) for i in range(40)]
    own = spark.createDataFrame(rows, "run_id string, claim_index int, id string, classification string, claim_text string, quote string, segment_id string, web_evidence_id string, values string, inferred_from array<string>")
    text = " ".join(f"was {i} of\n " for i in range(40))
    segs = spark.createDataFrame([("r", "s", text)], "run_id string, id string, text string")
    pages = spark.createDataFrame([("r", "w", text, "pre_event")], "run_id string, id string, content string, temporal_status string")
    facts = spark.createDataFrame([], "run_id string, value double")
    got = {(i.claim_index, i.check) for i in claims.issues(own, segs, pages, facts).collect()}
    assert got == {(i, "exact_quote") for i in range(0, 40, 2)} | {(i, "claim_text_quote_traceable") for i in range(0, 40, 2)}


def test_facts_of_all_magnitudes(spark):
    numbers = [1.0, 1.0000005, 9007199254.740993, 9007199254.74, 9007199253.0, 1e13, 1e13 + 0.5, 3e300, -2e18, 0.0, -0.0000004]
    needs = spark.createDataFrame([("r", i, v) for i, v in enumerate(numbers)], "run_id string, claim_index int, value double")
    known = [1.0000002, 9007199254.740992, 1e13, 3e300, -2e18, 0.0, 5e18]
    found = claims.near_facts(needs, spark.createDataFrame([("r", v) for v in known] + [("other", 9007199253.0)], "run_id string, value double"))
    assert {r.claim_index for r in found.collect()} == {i for i, v in enumerate(numbers) if any(v == k or abs(v - k) < 1e-6 for k in known)}


def test_chain_of_rounds(spark):
    reports = [("r", 1, "full", "pass", False, "c1", "b1", None), ("r", 5, "full", "pass", False, "c2", "b2", None), ("ok", 1, "full", "fail", False, "c1", "b1", None), ("ok", 2, "diff", "pass", True, "c2", "b1", "d2"), ("carried", 1, "full", "fail", False, "c", "b", None), ("carried", 2, "diff", "pass", False, "c", "b", "d")]
    schema = "run_id string, round int, mode string, verdict string, escalate boolean, claims_sha string, brief_sha string, diff_sha string"
    files = [("r", 1, "c1", "b1", None), ("r", 5, "c2", "b2", None), ("ok", 1, "c1", "b1", None), ("ok", 2, "c2", "b1", "d2"), ("carried", 1, "c", "b", None), ("carried", 2, "c", "b", "d")]
    diffs = [("ok", 2, 2, 1, "c2", "b1", False), ("carried", 2, 2, 1, "c", "b", False)]
    changed = spark.createDataFrame([("carried", 2, "claim-1"), ("ok", 2, "claim-1")], "run_id string, round int, claim_id string")
    receipts = spark.createDataFrame([("carried", 2, "carried_forward", "claim-1"), ("carried", 2, "carried_forward", "claim-2"), ("ok", 2, "reviewed_ok", "claim-1")], "run_id string, round int, bucket string, claim_id string")
    got = chain.round_chain(spark.createDataFrame(reports, schema), spark.createDataFrame(files, "run_id string, round int, claims_sha string, brief_sha string, diff_sha string"), spark.createDataFrame(diffs, "run_id string, round int, round_number int, since_round int, claims_sha string, brief_sha string, escalated boolean"), changed, receipts)
    assert {(r.run_id, r.round): r.message for r in got.where("not bound").collect()} == {("r", 5): "the round has no diff", ("carried", 2): "changed claims are carried forward: claim-1"}
    assert {(r.run_id, r.round): (r.place, r.previous) for r in got.where("run_id = 'r'").collect()} == {("r", 1): (1, None), ("r", 5): (2, 1)}
    verdicts = {r.run_id: (r.rounds, r.held, r.broken_round) for r in chain.chain_verdicts(got).collect()}
    assert verdicts == {"r": (2, 1, 5), "ok": (2, 2, None), "carried": (2, 1, 2)}


def test_gates_without_tables_and_receipts(spark):
    runs = spark.createDataFrame([("r",)], "run_id string")
    assert [tuple(r) for r in briefs.outlook_gate(runs, runs.withColumn("ok", F.lit(True)), runs.withColumn("fresh", F.lit(True))).collect()] == [("r", "passed")]
    reports = spark.createDataFrame([("r", 9, "pass", False, True), ("s", 1, "pass", False, False)], "run_id string, round int, verdict string, escalated boolean, repeated boolean")
    found = spark.createDataFrame([("r", reviews.RECEIPT, reviews.NO_RECEIPT), ("s", reviews.RECEIPT, reviews.NO_RECEIPT)], "run_id string, check string, message string")
    assert {r.run_id: r.code for r in reviews.review_gate(reports, found).collect()} == {"r": 0, "s": 2}
