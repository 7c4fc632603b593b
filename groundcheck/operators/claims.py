"""Claim validation: claims meet their passages, and their runs' facts, by what they ask of them;
all checks are columns of one row.

Tables and their columns:
``claims``: run_id, claim_index, id, classification, claim_text, quote, segment_id,
web_evidence_id, values (JSON text), inferred_from (array of ids).
``segments``: run_id, id, text. ``web``: run_id, id, content, temporal_status.
``financials``: run_id, value. Results are rows of ``issues``: run_id, claim_index, check, message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundcheck.functions import calc, text as tx

ISSUE_COLUMNS = ["run_id", "claim_index", "check", "message"]
FACTUAL = ("reported_fact", "management_guidance")
INFERENCE = "analytical_inference"
NUMERIC = "^(BIGINT|DOUBLE|DECIMAL|BOOLEAN|FLOAT)"
TOLERANCE = 1e-6


def json_pairs(text: Column) -> Column:
    """``key, value`` of a JSON object in the order of its keys; of a repeated key the last value."""
    entries = F.coalesce(F.map_entries(F.from_json(text, "map<string,string>")), F.array().cast("array<struct<key:string,value:string>>"))

    def unique(pairs: Column) -> Column:
        def one_each(keys: Column) -> Column:
            last = F.transform(keys, lambda k: F.named_struct(F.lit("key"), k, F.lit("value"), last_value(pairs, k)))
            return F.when(F.size(keys) < F.size(pairs), last).otherwise(pairs)

        return tx.let(F.array_distinct(F.transform(pairs, lambda e: e["key"])), one_each)

    return tx.let(entries, unique)


def last_value(pairs: Column, key: Column) -> Column:
    return F.try_element_at(F.filter(pairs, lambda e: e["key"] == key), F.lit(-1))["value"]


def kinds_of(json: Column) -> Column:
    """``key, value`` of a JSON object with values as VARIANT, which know their types."""
    return F.map_entries(F.from_json(json, "map<string,variant>"))


def with_values(claims: DataFrame) -> DataFrame:
    """Claims with what their values say: ``n_values``, ``scalars`` (key, value; in the order of the
    text), the calculation (``calc`` and its parts) and ``declared``, all numbers among them.

    A number written as a JSON string is none. An object that repeats a key below the first level has
    no VARIANT; what looks like a number counts as one there."""
    number = lambda s: F.when(s == "true", 1.0).when(s == "false", 0.0).otherwise(s.try_cast("double"))  # noqa: E731  JSON booleans are numbers

    def numeric(kinds: Column, key: Column, value: Column) -> Column:
        told = F.schema_of_variant(last_value(kinds, key)).rlike(NUMERIC)
        return F.coalesce(told, kinds.isNull() & value.rlike(r"^(-?[0-9].*|true|false)$"), F.lit(False))

    def numbers(pairs: Column, json: Column) -> Column:
        one = lambda kinds, e: F.named_struct(F.lit("key"), e["key"], F.lit("value"), F.when(numeric(kinds, e["key"], e["value"]), number(e["value"])))
        return tx.let(kinds_of(json), lambda kinds: F.transform(pairs, lambda e: one(kinds, e)))

    there = lambda pairs: F.filter(pairs, lambda e: e["value"].isNotNull())
    rows = claims.withColumn("_pairs", json_pairs(F.col("values")))
    rows = rows.withColumns({"n_values": F.size("_pairs"), "scalars": there(numbers(F.filter("_pairs", lambda e: e["key"] != "calculation"), F.col("values"))), "calc": last_value(F.col("_pairs"), F.lit("calculation"))})
    rows = rows.withColumn("_parts", json_pairs(F.col("calc")))
    part = lambda key: last_value(F.col("_parts"), F.lit(key))
    rows = rows.withColumns({"calc_name": part("name"), "calc_has_inputs": part("inputs"), "calc_result_text": part("result")})
    result = tx.let(kinds_of(F.col("calc")), lambda kinds: F.when(numeric(kinds, F.lit("result"), F.col("calc_result_text")), number(F.col("calc_result_text"))))
    rows = rows.withColumns({"_inputs": numbers(json_pairs(F.col("calc_has_inputs")), F.col("calc_has_inputs")), "calc_result": result})
    rows = rows.withColumns({"calc_inputs": F.map_from_entries("_inputs"), "calc_entries": there(F.col("_inputs"))})
    declared = F.concat(F.transform("scalars", lambda e: e["value"]), F.transform("calc_entries", lambda e: e["value"]), F.filter(F.array("calc_result"), lambda v: v.isNotNull()))
    return rows.withColumn("declared", declared).drop("_pairs", "_parts", "_inputs")


def near_facts(needs: DataFrame, financials: DataFrame, tolerance: float = TOLERANCE, salts: int = 8) -> DataFrame:
    """``run_id, claim_index, by_facts``: those numbers of a claim (``needs``: run_id, claim_index,
    value) that a fact of its run lies within the tolerance of.

    Values meet in cells as wide as the tolerance, each number also in the two cells beside its own.
    Doubles so large that their neighbours lie further off than the tolerance meet in a cell of their
    own, by hash. A cell's claims are dealt over ``salts`` parts; a run's facts never become one row."""
    edge = tolerance * 2.0**53
    value, size = F.col("value").cast("double"), F.abs(F.col("value").cast("double"))
    cell, own = F.floor(value / F.lit(tolerance)), F.xxhash64(value)
    none = F.array().cast("array<bigint>")
    facts = financials.where(value.isNotNull() & ~F.isnan(value)).select("run_id", value.alias("value")).distinct()
    facts = facts.select("run_id", F.col("value").alias("fact"), F.when(size < edge, cell).otherwise(own).alias("cell"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("part"))
    cells = F.concat(F.when(size <= edge * 1.001, F.array(cell - 1, cell, cell + 1)).otherwise(none), F.when(size >= edge * 0.999, F.array(own)).otherwise(none))
    asked = needs.where(value.isNotNull() & ~F.isnan(value)).distinct().select("run_id", "claim_index", value.alias("value"), F.explode(cells).alias("cell"), F.pmod(F.xxhash64("claim_index"), F.lit(salts)).cast("int").alias("part"))
    found = asked.join(facts, ["run_id", "cell", "part"]).where((F.col("fact") == F.col("value")) | (F.abs(F.col("fact") - F.col("value")) < F.lit(tolerance)))
    return found.groupBy("run_id", "claim_index").agg(F.collect_set("value").alias("by_facts"))


#: Claims of one passage that are tested in one row.
CLAIMS_IN_ROW = 256


def by_passage(claims: DataFrame, segments: DataFrame, web: DataFrame) -> DataFrame:
    """``run_id, claim_index, found, temporal_status, quote_found, by_text`` of claims that cite one
    passage: whether it is there, holds the quote, and which of the claim's numbers it has.

    Claims are gathered by passage, many of one passage in several rows. A passage meets them in one
    join, is folded and searched for numbers once for each such row, and goes no further."""
    seg = segments.select("run_id", F.lit("segment").alias("kind"), F.col("id").alias("evidence_id"), F.col("text"), F.lit(None).cast("string").alias("temporal_status"))
    page = web.select("run_id", F.lit("page").alias("kind"), F.col("id").alias("evidence_id"), F.col("content").alias("text"), "temporal_status")
    key = ["run_id", "kind", "evidence_id"]
    one = claims.where(F.col("cites_segment") != F.col("cites_web"))
    asks = one.select(
        "run_id",
        F.when(F.col("cites_segment"), "segment").otherwise("page").alias("kind"),
        F.when(F.col("cites_segment"), F.col("segment_id")).otherwise(F.col("web_evidence_id")).alias("evidence_id"),
        F.struct("claim_index", F.col("folded_quote").alias("quote"), "needs").alias("ask"),
    )
    crowded = asks.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CLAIMS_IN_ROW).withColumn("parts", F.ceil(F.col("n") / CLAIMS_IN_ROW)).drop("n")
    part = F.pmod(F.xxhash64("ask.claim_index"), F.coalesce("parts", F.lit(1).cast("long")))
    rows = asks.join(crowded, key, "left").groupBy(*key, part.alias("part")).agg(F.collect_list("ask").alias("asks"))
    met = rows.join(seg.unionByName(page).withColumn("there", F.lit(True)), key, "left")
    met = met.select("run_id", "asks", "temporal_status", F.coalesce("there", F.lit(False)).alias("found"), tx.normalize_whitespace(F.coalesce("text", F.lit(""))).alias("folded"), tx.numbers(F.coalesce("text", F.lit(""))).alias("numbers"))

    def answer(a: Column) -> Column:
        has = F.coalesce(F.col("folded").contains(a["quote"]), F.lit(False))
        told = F.filter(a["needs"], lambda v: tx.grounded(v, F.col("numbers")))
        return F.named_struct(F.lit("claim_index"), a["claim_index"], F.lit("quote_found"), has, F.lit("by_text"), told)

    # Both columns are read twice, so that the optimiser computes them once before the lambda.
    ready = (F.length("folded") >= 0) & (F.size("numbers") >= 0)
    each = met.select("run_id", "found", "temporal_status", F.explode(F.when(ready, F.transform("asks", answer))).alias("a")).select("run_id", "a.claim_index", "found", "temporal_status", "a.quote_found", "a.by_text")
    return each


def with_evidence(claims: DataFrame, segments: DataFrame, web: DataFrame, financials: DataFrame) -> DataFrame:
    """Claims (with ``needs``, their own numbers) with the facts of what they cite: ``found``,
    ``temporal_status``, ``quote_found``, and ``known``, those of their numbers that are grounded."""
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    quote = F.coalesce(tx.normalize_whitespace(F.col("quote")), F.lit(""))
    own = claims.withColumns({"cites_segment": has("segment_id"), "cites_web": has("web_evidence_id"), "folded_quote": quote})
    own = own.withColumn("quote_empty", F.col("folded_quote") == "")
    facts = near_facts(claims.select("run_id", "claim_index", F.explode("needs").alias("value")), financials)
    keys, empty = ["run_id", "claim_index"], F.array().cast("array<double>")
    joined = own.join(by_passage(own, segments, web), keys, "left").join(facts, keys, "left")
    known = F.array_union(F.coalesce("by_text", empty), F.coalesce("by_facts", empty))
    return joined.withColumns({"known": known, "found": F.coalesce("found", F.lit(False)), "quote_found": F.coalesce("quote_found", F.lit(False))}).drop("by_text", "by_facts", "folded_quote")


def inference_problems(claims: DataFrame) -> DataFrame:
    """``run_id, claim_index, message``: inferences that cite nothing, unknown claims or themselves."""
    inferences = claims.where(F.col("classification") == INFERENCE)
    ids = claims.select("run_id", F.col("id").alias("cited")).where("cited is not null").distinct()
    cited = inferences.select("run_id", "claim_index", F.posexplode("inferred_from").alias("pos", "cited"))
    unknown = cited.join(ids, ["run_id", "cited"], "left_anti").groupBy("run_id", "claim_index").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "cited"))), lambda x: x["cited"]).alias("unknown"))
    found = inferences.join(unknown, ["run_id", "claim_index"], "left")
    none = F.size(F.coalesce("inferred_from", F.array().cast("array<string>"))) == 0
    message = (
        F.when(none, "inference cites no claim")
        .when(F.col("unknown").isNotNull(), F.concat(F.lit("inference rests on unknown claims: "), F.array_join("unknown", ", ")))
        .when(F.array_contains("inferred_from", F.col("id")), "inference cites itself")
    )
    return found.select("run_id", "claim_index", message.alias("message")).where("message is not null")


def id_problems(claims: DataFrame) -> DataFrame:
    """Empty ids, and later claims that reuse an id."""
    w = Window.partitionBy("run_id", "id").orderBy("claim_index")
    seen = claims.select("run_id", "claim_index", "id").withColumn("first", F.first("claim_index").over(w))
    message = F.when(F.coalesce("id", F.lit("")) == "", "claim id is empty").when(F.col("first") != F.col("claim_index"), F.concat(F.lit("claim id already used by claim "), F.col("first").cast("string")))
    return seen.select("run_id", "claim_index", message.alias("message")).where("message is not null")


def issues(claims: DataFrame, segments: DataFrame, web: DataFrame, financials: DataFrame) -> DataFrame:
    """All issues of all claims. A claim whose evidence can't be resolved gets that issue and, of
    the checks on its own row, no other."""
    own = with_values(claims).withColumn("tokens", F.coalesce(tx.prose_tokens(F.col("claim_text")), F.array().cast("array<string>")))
    spoken = F.transform("tokens", tx.number_value)
    needs = F.filter(F.array_distinct(F.concat("declared", spoken, F.transform(spoken, lambda v: v / 100))), lambda v: v.isNotNull())
    own = own.withColumn("needs", needs)
    rows = with_evidence(own, segments, web, financials).withColumn("quote_numbers", tx.numbers(F.coalesce("quote", F.lit(""))))
    rows = rows.withColumns(
        {
            "bad_scalar": F.get(F.filter("scalars", lambda e: ~F.array_contains("known", e["value"])), F.lit(0)),
            "bad_input": F.get(F.filter("calc_entries", lambda e: ~F.array_contains("known", e["value"])), F.lit(0)),
            "bad_prose": tx.first_ungrounded(F.col("tokens"), F.col("declared"), F.col("known")),
            "bad_trace": tx.first_ungrounded(F.col("tokens"), F.concat("quote_numbers", "declared")),
            "recomputed": calc.recompute(F.col("calc_name"), F.col("calc_inputs")),
        }
    )
    reference = F.when(F.col("cites_segment") & F.col("cites_web"), "claim cites both a segment and a page; exactly one is allowed").when(~F.col("cites_segment") & ~F.col("cites_web"), "claim cites neither a segment nor a page")
    dangling = F.when(reference.isNull() & F.col("cites_segment") & ~F.col("found"), "segment_id is not in this run's segments").when(reference.isNull() & F.col("cites_web") & ~F.col("found"), "web_evidence_id is not in this run's pages")
    late = F.when(reference.isNull() & F.col("cites_web") & (F.col("temporal_status") == "post_event"), "cited page was published after the event")
    resolved = reference.isNull() & dangling.isNull() & late.isNull()
    calc_message = (
        F.when(F.col("calc").isNull(), None)
        .when(F.col("calc_name").isNull() | F.col("calc_has_inputs").isNull() | F.col("calc_result_text").isNull(), "malformed calculation: it needs name, inputs and result")
        .when(F.col("recomputed").isNull(), "calculation could not be recomputed")
        .when(F.col("calc_result").isNull(), "calculation result is no number")
        .when(~calc.within_tolerance(F.col("recomputed"), F.col("calc_result")), F.format_string("calculation mismatch: %s asserted, %.6f recomputed", F.col("calc_result_text"), F.col("recomputed")))
    )
    financial = tx.has_financial_figure(F.concat_ws(" ", F.coalesce("quote", F.lit("")), F.coalesce("claim_text", F.lit(""))))
    checks = {
        "evidence_reference": reference,
        "schema": dangling,
        "temporal_eligibility": late,
        "exact_quote": F.when(resolved & F.col("quote_empty"), "quote is empty").when(resolved & ~F.col("quote_found"), "quote is not in the cited text"),
        "numeric": F.when(resolved & F.col("bad_scalar").isNotNull(), F.concat(F.lit("value not found in evidence: "), F.col("bad_scalar.key"))),
        "claim_text_numeric": F.when(resolved & F.col("bad_prose").isNotNull(), F.concat(F.lit("number in claim_text not found: "), F.trim("bad_prose"))),
        "claim_text_quote_traceable": F.when(resolved & F.col("bad_trace").isNotNull(), F.concat(F.lit("number in claim_text is not in its quote or values: "), F.trim("bad_trace"))),
        "universal_quantifier": F.when(resolved & (F.col("classification") == INFERENCE) & tx.has_universal_quantifier(F.col("claim_text")) & (F.size(F.coalesce("inferred_from", F.array().cast("array<string>"))) < 2), "a statement about a whole set needs two cited claims"),
        "values_present": F.when(resolved & F.col("classification").isin(*FACTUAL) & (F.col("n_values") == 0) & financial, "a financial figure is stated but values is empty"),
        "calculation": F.when(resolved, calc_message),
        "calculation_inputs": F.when(resolved & F.col("bad_input").isNotNull(), F.concat(F.lit("calculation input not found in evidence: "), F.col("bad_input.key"))),
    }
    told = rows.select("run_id", "claim_index", F.explode(F.filter(F.array(*[F.struct(F.lit(k).alias("check"), m.alias("message")) for k, m in checks.items()]), lambda c: c["message"].isNotNull())).alias("c"))
    found = told.select("run_id", "claim_index", "c.check", "c.message")
    for check, df in (("claim_id", id_problems(claims)), ("inference_citation", inference_problems(claims))):
        found = found.unionByName(df.select("run_id", "claim_index", F.lit(check).alias("check"), "message"))
    return found


def gate(claims: DataFrame, found: DataFrame) -> DataFrame:
    """``run_id, claims, issues, ok``: a run passes if it has no issue."""
    per_run = claims.groupBy("run_id").agg(F.count(F.lit(1)).alias("claims"))
    counts = found.groupBy("run_id").agg(F.count(F.lit(1)).alias("issues"))
    joined = per_run.join(counts, "run_id", "left").withColumn("issues", F.coalesce("issues", F.lit(0).cast("long")))
    return joined.withColumn("ok", F.col("issues") == 0)


def metric_provenance(metrics: DataFrame, claims: DataFrame) -> DataFrame:
    """Issues of metrics (run_id, metric_index, source_claim_ids) that cite no or unknown claims."""
    ids = claims.select("run_id", F.col("id").alias("cited")).distinct()
    none = metrics.where(F.size(F.coalesce("source_claim_ids", F.array().cast("array<string>"))) == 0).select("run_id", F.col("metric_index").alias("claim_index"), F.lit("metric cites no claims").alias("message"))
    cited = metrics.select("run_id", F.col("metric_index").alias("claim_index"), F.explode("source_claim_ids").alias("cited"))
    unknown = cited.join(ids, ["run_id", "cited"], "left_anti").groupBy("run_id", "claim_index").agg(F.array_sort(F.collect_set("cited")).alias("u"))
    bad = unknown.select("run_id", "claim_index", F.concat(F.lit("metric cites unknown claim id(s): "), F.array_join("u", ", ")).alias("message"))
    return none.unionByName(bad).select("run_id", "claim_index", F.lit("metric_provenance").alias("check"), "message")


def evidence_use(web: DataFrame, claims: DataFrame, least_ratio: float = 0.5) -> DataFrame:
    """``run_id, pages, cited, advisory``: runs that cite none or no more than a part of their pages."""
    used = claims.where("web_evidence_id is not null").select("run_id", F.col("web_evidence_id").alias("id")).distinct().withColumn("used", F.lit(1))
    per = web.select("run_id", "id").distinct().join(used, ["run_id", "id"], "left").groupBy("run_id").agg(F.count(F.lit(1)).alias("pages"), F.count("used").alias("cited"))
    return per.withColumn("advisory", F.when(F.col("cited") == 0, "no page is cited").when(F.col("cited") / F.col("pages") <= least_ratio, "few pages are cited"))
