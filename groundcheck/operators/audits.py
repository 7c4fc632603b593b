"""Rollups for the audit record and the rendered cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundcheck.functions.text import escape_currency
from groundcheck.operators.reviews import SEVERITIES


def issue_counts(found: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, issue_counts``: a map from check to count."""
    per = found.groupBy(*keys, "check").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("check", "n")))).alias("issue_counts"))


def severity_counts(findings: DataFrame, keys: list[str]) -> DataFrame:
    """One column for each severity; the five values are fixed, so one pass serves."""
    return findings.groupBy(*keys).pivot("severity", SEVERITIES).agg(F.count(F.lit(1))).fillna(0, SEVERITIES)


def attempt_rollup(attempts: DataFrame) -> DataFrame:
    """Attempts (run_id, stage, attempt, outcome) of each stage: number, rejections, retries, last outcome."""
    return attempts.groupBy("run_id", "stage").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(~F.col("outcome").eqNullSafe("passed")).alias("rejections"),
        F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias("retries"),
        F.max_by("outcome", "attempt").alias("outcome"),
    )


def round_rollup(rounds: DataFrame) -> DataFrame:
    """Rounds (run_id, round, verdict, escalated) of each run."""
    return rounds.groupBy("run_id").agg(F.count(F.lit(1)).alias("rounds"), F.count_if(F.col("verdict") == "fail").alias("failed_rounds"), F.count_if("escalated").alias("escalations"), F.max_by("verdict", "round").alias("verdict"))


def round_number(name) -> object:
    """Rounds sort by the number in their name."""
    return F.regexp_extract(name, r"(\d+)$", 1).try_cast("int")


def bucket_counts(receipts: DataFrame) -> DataFrame:
    buckets = ["reviewed_ok", "with_findings", "unverifiable", "carried_forward"]
    return receipts.groupBy("run_id").pivot("bucket", buckets).agg(F.count(F.lit(1))).fillna(0, buckets)


# The record's plain sentences and its stages, which must be just these.
CLAIM_STAGE, BRIEF_STAGE = "claim_validation", "outlook_validation"
SEVERE_FIRST = ["critical", "high", "medium", "low", "info"]


def json_of(*columns, **named) -> Column:
    """A JSON object of the columns with all keys there, null or not."""
    return F.to_json(F.struct(*columns, *[c.alias(n) for n, c in named.items()]), {"ignoreNullFields": "false"})


def phrase(text: str, *values: Column) -> Column:
    return F.format_string(text, *values)


def audit_record(runs: DataFrame, attempts: DataFrame, rounds: DataFrame, findings: DataFrame, sources: DataFrame, hashes: DataFrame) -> DataFrame:
    """``run_id, record, trace_summary``: the record of every accepted run as one JSON object.

    ``runs``: run_id, ticker, event_id, accepted, generated_at, brief_ok, and, as JSON text or null,
    tool_decisions, extractor, outlook_author. ``attempts``: run_id, stage, attempt, outcome. ``rounds``:
    run_id, round, verdict, escalated, summary, model, reasoning_effort; the last one decides.
    ``findings``: run_id, round, severity. ``sources``: run_id, pos, path, sha256. ``hashes``: run_id,
    name, sha256 of manifest, claims, outlook_brief, review_report; of a repeated name the last by hash.

    Rounds of a run are few (their number is capped) and become one array; findings and sources are
    only counted."""
    runs = runs.where("accepted")
    per = attempts.where(F.col("stage").isin(CLAIM_STAGE, BRIEF_STAGE)).groupBy("run_id").agg(
        *[
            agg.alias(f"{name}_{what}")
            for name, stage in (("claim", CLAIM_STAGE), ("brief", BRIEF_STAGE))
            for what, agg in (
                ("n", F.count_if(F.col("stage") == stage)),
                ("bad", F.count_if((F.col("stage") == stage) & ~F.col("outcome").eqNullSafe("passed"))),
                ("last", F.max_by(F.when(F.col("stage") == stage, F.col("outcome")), F.when(F.col("stage") == stage, F.col("attempt")))),
            )
        ]
    )
    by_round = findings.groupBy("run_id", "round").pivot("severity", SEVERE_FIRST).agg(F.count(F.lit(1))).fillna(0, SEVERE_FIRST)
    rows = rounds.join(by_round, ["run_id", "round"], "left").fillna(0, SEVERE_FIRST)
    told = F.array_compact(F.array(*[F.when(F.col(s) > 0, phrase(f"%d {s}", F.col(s))) for s in SEVERE_FIRST]))
    verdict = F.coalesce("verdict", F.lit("None"))
    described = F.concat(phrase("round %d %s", F.col("round"), verdict), F.when(F.size(told) > 0, F.concat(F.lit(" with "), F.array_join(told, ", "), F.lit(" finding(s)"))).otherwise(""))
    trace = json_of(stage=F.lit("review"), round=F.col("round"), status=F.col("verdict"))
    rows = rows.select("run_id", "round", "verdict", F.coalesce("escalated", F.lit(False)).alias("escalated"), "summary", "model", "reasoning_effort", *SEVERE_FIRST, described.alias("described"), trace.alias("trace"))
    history = rows.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("rounds"),
        F.count_if(F.col("verdict") == "fail").alias("failed"),
        F.count_if("escalated").alias("escalations"),
        *[F.sum(s).alias(f"all_{s}") for s in SEVERE_FIRST],
        F.max_by(F.struct("round", "verdict", "summary", "model", "reasoning_effort", *SEVERE_FIRST), "round").alias("final"),
        F.array_sort(F.collect_list(F.struct("round", "described", "trace"))).alias("in_order"),
    )
    raw = F.when(F.col("path").startswith("raw/transcript"), F.struct(F.col("path").endswith(".converted.md"), "pos"))
    packs = sources.groupBy("run_id").agg(F.count(F.lit(1)).alias("sources"), F.min_by("sha256", raw).alias("transcript"))
    named = hashes.groupBy("run_id").pivot("name", ["manifest", "claims", "outlook_brief", "review_report"]).agg(F.max("sha256"))
    all_ = runs.join(per, "run_id", "left").join(history, "run_id", "left").join(packs, "run_id", "left").join(named, "run_id", "left")
    counted = ["claim_n", "claim_bad", "brief_n", "brief_bad", "rounds", "failed", "escalations", "sources", *[f"all_{s}" for s in SEVERE_FIRST]]
    all_ = all_.fillna(0, counted)
    c = F.col
    orders = F.coalesce(c("in_order"), F.array().cast("array<struct<round:int,described:string,trace:string>>"))
    summary = F.concat(
        phrase("Analysis drew on %d recorded source(s) (transcript, SEC/web evidence). %d claim-validation attempt(s) were made", c("sources"), c("claim_n")),
        F.when(c("claim_bad") > 0, phrase(", %d with issues,", c("claim_bad"))).otherwise(""),
        F.lit(" before passing."),
        F.when(c("brief_n") > 0, F.concat(phrase(" %d outlook-validation attempt(s) were made", c("brief_n")), F.when(c("brief_bad") > 0, phrase(", %d with issues or blocked,", c("brief_bad"))).otherwise(""), F.lit(" before passing."))).otherwise(""),
        F.when(c("rounds") > 0, F.concat(phrase(" Review ran %d round(s): ", c("rounds")), F.array_join(F.transform(orders, lambda x: x["described"]), "; "), F.lit("."))).otherwise(""),
    )
    claim_status = F.when(c("claim_last") == "passed", "passed").otherwise("unknown")
    brief_status = F.coalesce(F.nullif("brief_last", F.lit("")), F.when(c("brief_ok"), "passed").otherwise("unknown"))
    traces = F.concat(F.array(json_of(stage=F.lit(CLAIM_STAGE), attempts=c("claim_n"), status=claim_status), json_of(stage=F.lit(BRIEF_STAGE), attempts=c("brief_n"), status=brief_status)), F.transform(orders, lambda x: x["trace"]))
    retries = lambda n: F.greatest(c(n) - 1, F.lit(0))
    or_null = lambda name: F.coalesce(name, F.lit("null"))
    blocks = {
        "run_id": json_text(F.concat_ws(":", "ticker", "event_id")),
        "ticker": json_text(c("ticker")),
        "event_id": json_text(c("event_id")),
        "status": json_text(F.lit("accepted")),
        "final_review_round": or_null(c("final.round").cast("string")),
        "generated_at": json_text(c("generated_at").cast("string")),
        "decision": json_of(verdict=c("final.verdict"), summary=c("final.summary"), finding_counts=F.struct(*[F.coalesce(c(f"final.{s}"), F.lit(0)).alias(s) for s in SEVERE_FIRST])),
        "trace_summary": json_text(summary),
        "workflow_trace": F.concat(F.lit("["), F.array_join(traces, ","), F.lit("]")),
        "review_history_summary": json_of(review_rounds=c("rounds"), failed_review_rounds=c("failed"), historical_findings=F.struct(*[c(f"all_{s}").alias(s) for s in SEVERE_FIRST])),
        "guardrail_summary": json_of(validation_retries=retries("claim_n"), validation_rejections=c("claim_bad"), outlook_validation_retries=retries("brief_n"), outlook_validation_rejections=c("brief_bad"), review_rejections=c("failed"), escalations=c("escalations")),
        "tool_decisions": or_null(c("tool_decisions")),
        "hashes": json_of(transcript_sha256=c("transcript"), manifest_sha256=c("manifest"), claims_sha256=c("claims"), outlook_brief_sha256=c("outlook_brief"), review_report_sha256=c("review_report")),
        "evidence_summary": json_of(source_count=c("sources")),
        "reviewer_model": json_text(c("final.model")),
        "agent_provenance": F.concat(F.lit('{"extractor":'), or_null(c("extractor")), F.lit(',"outlook_author":'), or_null(c("outlook_author")), F.lit(',"reviewer":'), json_of(model=c("final.model"), reasoning_effort=c("final.reasoning_effort")), F.lit(',"basis":"agent_declared"}')),
    }
    parts = [F.concat(F.lit(f'"{name}":'), value) for name, value in blocks.items()]
    return all_.select("run_id", F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("record"), summary.alias("trace_summary"))


def json_text(x: Column) -> Column:
    """A string as JSON, null as null."""
    inside = F.to_json(F.array(x))
    return F.when(x.isNull(), "null").otherwise(F.substr(inside, F.lit(2), F.length(inside) - 2))


def signal_card(claims: DataFrame, runs: DataFrame) -> DataFrame:
    """``ticker, event_id, place, category, claim_index, part, line``: the lines of every run's card, which stand
    by place, claim and part and never become one row.

    ``claims``: run_id, claim_index, category, status, classification, speaker, claim_text, quote,
    segment_id, web_evidence_id, caveats. ``runs``: run_id, ticker, event_id, generated_at. Categories
    stand as they first come, each under its heading and with an empty line after it; runs without
    claims have the card's head alone."""
    head = F.array(F.concat(F.lit("# Signal Card: "), F.upper("ticker"), F.lit(" — "), F.col("event_id")), F.lit(""), F.concat(F.lit("_Generated: "), F.col("generated_at").cast("string"), F.lit("_")), F.lit(""))
    heads = runs.select("ticker", "event_id", F.lit(0).alias("place"), F.lit(None).cast("string").alias("category"), F.lit(-1).cast("long").alias("claim_index"), F.posexplode(head).alias("part", "line"))
    bounds = claims.groupBy("run_id", "category").agg(F.min("claim_index").alias("first"), F.max("claim_index").alias("last"))
    places = bounds.withColumn("place", F.row_number().over(Window.partitionBy("run_id").orderBy("first"))).join(runs, "run_id")
    title = F.concat(F.lit("## "), F.initcap(F.replace(F.coalesce("category", F.lit("None")), F.lit("_"), F.lit(" "))))
    edges = places.select("ticker", "event_id", "place", "category", F.explode(F.array(F.named_struct(F.lit("claim_index"), F.col("first").cast("long"), F.lit("part"), F.lit(-1), F.lit("line"), title), F.named_struct(F.lit("claim_index"), F.col("last").cast("long"), F.lit("part"), F.lit(1 << 30), F.lit("line"), F.lit("")))).alias("e"))
    edges = edges.select("ticker", "event_id", "place", "category", "e.claim_index", "e.part", "e.line")
    speaker = F.when(F.coalesce("speaker", F.lit("")) != "", F.concat(F.lit(" ("), F.col("speaker"), F.lit(")"))).otherwise("")
    said = F.concat(F.lit("- **"), F.coalesce("status", F.lit("None")), F.lit("** ["), F.coalesce("classification", F.lit("None")), F.lit("]"), speaker, F.lit(": "), escape_currency(F.coalesce("claim_text", F.lit(""))))
    location = F.coalesce(F.nullif("segment_id", F.lit("")), F.col("web_evidence_id"), F.lit("None"))
    quoted = F.concat(F.lit('  > "'), escape_currency(F.coalesce("quote", F.lit(""))), F.lit('" — '), location)
    caveats = F.transform(F.coalesce("caveats", F.array().cast("array<string>")), lambda c: F.concat(F.lit("  - *caveat:* "), escape_currency(c)))
    same = places.select(F.col("run_id").alias("_run"), F.col("category").alias("_category"), "place", "ticker", "event_id")
    # Few categories of many claims: the small side is named, so that hot runs are not dealt out by run.
    rows = claims.withColumn("lines", F.concat(F.array(said, quoted), caveats)).join(same, F.col("run_id").eqNullSafe(F.col("_run")) & F.col("category").eqNullSafe(F.col("_category")))
    body = rows.select("ticker", "event_id", "place", "category", F.col("claim_index").cast("long").alias("claim_index"), F.posexplode("lines").alias("part", "line"))
    return heads.unionByName(edges).unionByName(body)


def audit_runs(answers: DataFrame) -> DataFrame:
    """Calls, successes, cost and windowed calls of every run."""
    return answers.groupBy("run_id").agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("status") == "ok").alias("ok"), F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost"), F.count_if("windowed").alias("windowed"))


def choice_counts(answers: DataFrame) -> DataFrame:
    return answers.where("type = 'choice'").groupBy("choice").agg(F.count(F.lit(1)).alias("n"))


def new_lessons(lessons: DataFrame, existing: DataFrame, column: str = "line") -> DataFrame:
    """Lesson lines that are new, once each."""
    clean = lambda df: df.select(F.trim(column).alias(column)).where(F.col(column) != "")
    return clean(lessons).dropDuplicates([column]).join(clean(existing).distinct(), column, "left_anti")
