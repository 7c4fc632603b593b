"""Review rounds: receipts, verdicts, citations, diffs with escalation, and gates; ``rounds`` chains them.

Tables: ``reports`` run_id, verdict, mode, source_checks (n), process_findings (n),
unverified_items (n); ``findings`` run_id, list_name, idx, severity, artifact, passage, evidence,
recommendation; ``receipts`` run_id, bucket, claim_id; ``claims`` run_id, id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundcheck.functions.text import claim_ids, sample_ids

SEVERITIES = ["info", "low", "medium", "high", "critical"]
CONCLUSION_SECTIONS = [1, 5, 6, 7]
RECEIPT, NO_RECEIPT = "claim_review_receipt", "receipt is missing"


def _issue(df: DataFrame, check: str, message) -> DataFrame:
    return df.select("run_id", F.lit(check).alias("check"), message.alias("message"))


FINDING_LISTS = ["source_checks", "claim_findings", "outlook_findings", "process_findings"]
BUCKETS = ["reviewed_ok", "with_findings", "unverifiable", "carried_forward"]


def findings_of(reports: DataFrame) -> DataFrame:
    """``run_id, list_name, idx, severity, artifact, passage, evidence, recommendation``: the four lists of
    reports (run_id and a column for each list, an array of structs or null) as one table."""

    def listed(name: str) -> Column:
        parts = ("severity", "artifact", "passage", "evidence", "recommendation")
        return F.transform(name, lambda f, i: F.struct(F.lit(name).alias("list_name"), i.alias("idx"), *[f[x].alias(x) for x in parts]))

    each = [listed(c) for c in FINDING_LISTS]  # null for a list that isn't there
    return reports.select("run_id", F.explode(F.flatten(F.array_compact(F.array(*each)))).alias("f")).select("run_id", "f.*")


def receipts_of(reports: DataFrame) -> DataFrame:
    """``run_id, bucket, claim_id``: the four buckets of receipts (a column for each, an array of ids or
    null) as one table; an id in two buckets, or twice in one, has two rows."""
    none = F.array().cast("array<string>")
    pairs = F.array(*[F.struct(F.lit(b).alias("bucket"), F.coalesce(b, none).alias("ids")) for b in BUCKETS])
    return reports.select("run_id", F.explode(pairs).alias("p")).select("run_id", "p.bucket", F.explode("p.ids").alias("claim_id"))


def finding_citations(findings: DataFrame) -> DataFrame:
    """``run_id, list_name, idx, severity, claim_id``: ids cited in any of a finding's texts."""
    text = F.concat_ws(" ", "artifact", "passage", "evidence", "recommendation")
    return findings.select("run_id", "list_name", "idx", "severity", F.explode(F.array_distinct(claim_ids(text))).alias("claim_id"))


def receipt_issues(reports: DataFrame, receipts: DataFrame, findings: DataFrame, claims: DataFrame) -> DataFrame:
    """Every claim in one bucket, buckets that agree with the findings. A report says by
    ``has_receipt`` that it has a receipt, which may list nothing; without that column runs with
    listed ids have one."""
    check = RECEIPT
    with_receipt = (reports.where("has_receipt") if "has_receipt" in reports.columns else receipts).select("run_id").distinct()
    none = _issue(reports.join(with_receipt, "run_id", "left_anti"), check, F.lit(NO_RECEIPT))
    reported = claims.join(with_receipt, "run_id", "left_semi").select("run_id", F.col("id").alias("claim_id")).distinct().withColumn("known", F.lit(1))
    listed = receipts.groupBy("run_id", "claim_id").agg(F.count(F.lit(1)).alias("times"))
    both = reported.join(listed, ["run_id", "claim_id"], "full_outer")
    kinds = F.array(F.when(F.col("times").isNull(), "not accounted for"), F.when(F.col("known").isNull(), "absent from the claims"), F.when(F.col("times") > 1, "in more than one bucket"))
    told = both.select("run_id", "claim_id", F.explode(F.array_compact(kinds)).alias("kind"))
    told = told.groupBy("run_id", "kind").agg(F.array_sort(F.collect_set("claim_id")).alias("ids"))
    account = _issue(told, check, F.concat("kind", F.lit(": "), sample_ids(F.col("ids"))))
    carried = receipts.where("bucket = 'carried_forward'").select("run_id").distinct()
    full = _issue(reports.where("mode <> 'diff'").join(carried, "run_id", "left_semi"), check, F.lit("claims are carried forward in a full review"))
    cited = finding_citations(findings.where("list_name = 'claim_findings'"))
    raised = cited.select("run_id", "claim_id").distinct()
    silent = receipts.where("bucket = 'with_findings'").join(raised, ["run_id", "claim_id"], "left_anti").groupBy("run_id").agg(F.array_sort(F.collect_set("claim_id")).alias("ids"))
    above = cited.where("severity <> 'info'").select("run_id", "claim_id").distinct()
    sound = receipts.where("bucket = 'reviewed_ok'").join(above, ["run_id", "claim_id"], "left_semi").groupBy("run_id").agg(F.array_sort(F.collect_set("claim_id")).alias("ids"))
    unexplained = reports.where("unverified_items = 0").join(receipts.where("bucket = 'unverifiable'").select("run_id").distinct(), "run_id", "left_semi")
    parts = [
        full,
        account,
        _issue(silent, check, F.concat(F.lit("no finding is raised against "), sample_ids(F.col("ids")))),
        _issue(sound, check, F.concat(F.lit("reviewed_ok despite a finding above info: "), sample_ids(F.col("ids")))),
        _issue(unexplained, check, F.lit("unverifiable claims without an unverified item")),
    ]
    for part in parts:
        none = none.unionByName(part)
    return none


def verdict_issues(reports: DataFrame, findings: DataFrame) -> DataFrame:
    """Receipts of sources and process, and verdicts that the severities contradict."""
    per = findings.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("severity").isin("medium", "high", "critical")).alias("over_low"), F.max(F.col("severity").isin("high", "critical")).alias("over_medium"))
    rows = reports.join(per, "run_id", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "over_low": F.coalesce("over_low", F.lit(False)), "over_medium": F.coalesce("over_medium", F.lit(False))})
    v = F.col("verdict")
    checks = [
        ("review_receipt", F.col("source_checks") == 0, "source_checks is empty"),
        ("review_receipt", F.col("process_findings") == 0, "process_findings is empty"),
        ("verdict_severity", (v == "pass") & F.col("over_low"), "pass with a finding above low"),
        ("verdict_severity", (v == "pass_with_warnings") & F.col("over_medium"), "warnings with a finding above medium"),
        ("verdict_severity", (v == "pass_with_warnings") & (F.col("n") == 0) & (F.col("unverified_items") == 0), "warnings without a finding or unverified item"),
        ("verdict_severity", (v == "fail") & ~F.col("over_medium"), "fail without a high or critical finding"),
    ]
    told = F.filter(F.array(*[F.when(c, F.struct(F.lit(k).alias("check"), F.lit(m).alias("message"))) for k, c, m in checks]), lambda x: x.isNotNull())
    return rows.select("run_id", F.explode(told).alias("i")).select("run_id", "i.check", "i.message")


def citation_issues(findings: DataFrame, claims: DataFrame) -> DataFrame:
    known = claims.select("run_id", F.col("id").alias("claim_id")).distinct()
    bad = finding_citations(findings).join(known, ["run_id", "claim_id"], "left_anti").groupBy("run_id", "list_name", "idx").agg(F.array_sort(F.collect_set("claim_id")).alias("ids"))
    return _issue(bad, "review_citation", F.concat(F.lit("finding cites unknown claim id(s): "), F.array_join("ids", ", ")))


def claim_diff(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``keys, change, old, new``: added, removed and changed rows; whole records are compared and
    two nulls are equal."""
    a = old.select(*keys, F.struct(*columns).alias("old"))
    b = new.select(*keys, F.struct(*columns).alias("new"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return a.join(b, keys, "full_outer").withColumn("change", change).where("change is not null")


def escalation(diff: DataFrame, sections: DataFrame, briefs: DataFrame, most_changed: int = 3) -> DataFrame:
    """``run_id, escalated, reasons``. ``sections``: run_id, section, body of the current brief;
    ``briefs``: run_id, prior_text, text. ``diff`` has claim_id and structs with period, values."""
    counts = diff.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("change") == "changed", ~F.col("old.period").eqNullSafe(F.col("new.period")) | ~F.col("old.values").eqNullSafe(F.col("new.values"))).otherwise(False)).alias("figures"),
    )
    # Whatever stands in brackets is looked up among the ids that changed; a section's heading counts.
    body = F.concat_ws("\n", "heading", "body") if "heading" in sections.columns else F.col("body")
    cited = sections.select("run_id", "section", F.explode(F.array_distinct(F.regexp_extract_all(body, F.lit(r"\[([^\[\]]+)\]"), 1))).alias("claim_id"))
    hit = cited.join(diff.select("run_id", "claim_id").distinct(), ["run_id", "claim_id"], "left_semi").where(F.col("section").isin(*CONCLUSION_SECTIONS)).groupBy("run_id").agg(F.array_sort(F.collect_set("section")).alias("hit"))
    rows = briefs.join(counts, "run_id", "left").join(hit, "run_id", "left")
    reasons = F.array_compact(
        F.array(
            F.when(F.coalesce("n", F.lit(0)) > most_changed, F.concat(F.col("n").cast("string"), F.lit(" claims changed"))),
            F.when(F.coalesce("figures", F.lit(False)), "period or values changed"),
            F.when(F.col("hit").isNotNull(), F.concat(F.lit("conclusion sections cite a changed claim: "), F.array_join(F.col("hit").cast("array<string>"), ", "))),
            F.when(F.col("prior_text").isNotNull() & ~F.col("prior_text").eqNullSafe(F.col("text")), "brief text changed"),
        )
    )
    return rows.select("run_id", reasons.alias("reasons")).withColumn("escalated", F.size("reasons") > 0)


def review_gate(reports: DataFrame, found: DataFrame, most_rounds: int = 3) -> DataFrame:
    """``run_id, code, reason``: 4 above the cap (a bundle that was accepted already is no new
    round), 2 if blocked, with issues, or with verdict fail, 3 escalated, 1 warnings, 0 pass.

    ``reports`` has round, verdict and escalated, and, where known, ``repeated`` and what blocks a
    report, in this order: named (the run folder is the run named), claims_ok, claims_fresh, brief_ok,
    brief_fresh (the validations passed and are of the current bytes), bound (the report is of the
    current claims and brief) and chained (so is its diff, see ``rounds``). A null blocks. No receipt
    is asked of a bundle that was accepted already: it may be older than receipts are."""
    known = set(reports.columns)
    repeated = F.coalesce("repeated", F.lit(False)) if "repeated" in known else F.lit(False)
    waived = (F.col("check") == RECEIPT) & (F.col("message") == NO_RECEIPT) if {"check", "message"} <= set(found.columns) else F.lit(False)
    n = found.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(waived).alias("n_waived"))
    counted = F.coalesce(F.col("n") - F.when(repeated, F.col("n_waived")).otherwise(0), F.lit(0))
    v = F.col("verdict")
    blocks = [
        ("named", "run folder is of another run"),
        ("claims_ok", "claims have not passed"),
        ("claims_fresh", "an input of the claims changed"),
        ("brief_ok", "brief has not passed"),
        ("brief_fresh", "brief or claims changed since the brief passed"),
        ("bound", "report is of other claims or another brief"),
        ("chained", "round is not bound to the one before it"),
    ]
    cases = [(4, ~repeated & (F.col("round") > most_rounds), "round cap reached")]
    cases += [(2, ~F.coalesce(c, F.lit(False)), m) for c, m in blocks if c in known]
    cases += [
        (2, counted > 0, "report has issues"),
        (3, F.coalesce("escalated", F.lit(False)), "escalated"),
        (2, v == "fail", "verdict fail"),
        (1, v == "pass_with_warnings", "warnings"),
    ]
    first = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(k).alias("code"), F.lit(m).alias("reason"))) for k, c, m in cases]))
    ended = F.coalesce(F.get(first, F.lit(0)), F.struct(F.lit(0).alias("code"), F.lit("pass").alias("reason")))
    return reports.join(n, "run_id", "left").select("run_id", ended.alias("e")).select("run_id", "e.code", "e.reason")


def previous_rounds(rounds: DataFrame) -> DataFrame:
    """Rounds with ``previous`` (the round before it in its run, null for the first) and whether it
    is the ``latest``."""
    w = Window.partitionBy("run_id").orderBy("round")
    return rounds.withColumn("previous", F.lag("round").over(w)).withColumn("latest", F.lead("round").over(w).isNull())


def same_bundle(current: DataFrame, snapshot: DataFrame, parts: list[str]) -> DataFrame:
    """``run_id, unchanged``: whether all artifacts equal the last snapshot's, validation times apart."""
    bare = lambda c: F.sha2(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r'"validated_at"\s*:\s*"[^"]*"', ""), 256)
    a = current.select("run_id", *[bare(p).alias(f"a_{p}") for p in parts])
    b = snapshot.select("run_id", *[bare(p).alias(f"b_{p}") for p in parts])
    same = F.lit(True)
    for p in parts:
        same = same & F.coalesce(F.col(f"a_{p}") == F.col(f"b_{p}"), F.lit(False))
    return a.join(b, "run_id", "left").select("run_id", same.alias("unchanged"))


def unclosed(reports: DataFrame, rounds: DataFrame, most_rounds: int = 3) -> DataFrame:
    """Runs whose report (run_id, report_sha) is not that of their last round, below the cap."""
    last = rounds.groupBy("run_id").agg(F.max("round").alias("rounds"), F.max_by("report_sha", "round").alias("last_sha"))
    return reports.join(last, "run_id", "left").where((F.coalesce("rounds", F.lit(0)) < most_rounds) & ~F.col("report_sha").eqNullSafe(F.col("last_sha"))).select("run_id")
