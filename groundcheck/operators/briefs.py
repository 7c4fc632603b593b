"""Checks on prose briefs: units of text, cited claims, figures and dollar signs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundcheck.functions import text as tx
from groundcheck.operators.claims import with_values

HEADING = r"(?U)^\s*#+\s"
LIST_ITEM = r"(?U)^\s*(?:[-*+]|\d+\.)\s+"


def grounding_units(briefs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, unit, body``: list items with their wrapped lines, and blocks of prose; headings
    and blank lines part them."""
    lines = briefs.select(key, F.posexplode(F.split(F.col(text), "\n", -1)).alias("n", "line"))
    apart = (tx.normalize_whitespace(F.col("line")) == "") | F.col("line").rlike(HEADING)
    starts = F.when(apart | F.col("line").rlike(LIST_ITEM), 1).otherwise(0)
    grouped = lines.withColumn("apart", apart).withColumn("grp", F.sum(starts).over(Window.partitionBy(key).orderBy("n"))).where(~F.col("apart"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n")
    return grouped.groupBy(key, "grp").agg(body.alias("body"), F.min("n").alias("at")).withColumn("unit", F.row_number().over(Window.partitionBy(key).orderBy("at"))).select(key, "unit", "body")


def sections(briefs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, section, body, heading`` of the numbered second-level headings."""
    parts = briefs.select(key, F.explode(F.split(F.col(text), r"(?m)^(?=## \d+\.)")).alias("body"))
    return parts.withColumn("section", F.regexp_extract("body", r"^## (\d+)\.", 1).try_cast("int")).where("section is not null").select(key, "section", F.regexp_replace("body", r"^[^\n]*\n?", "").alias("body"), F.regexp_extract("body", r"^[^\n]*", 0).alias("heading"))


def claim_numbers(claims: DataFrame) -> DataFrame:
    """``run_id, cited, allowed``: every number that a claim quotes, states or declares."""
    spoken = F.array_union(tx.numbers(F.coalesce("quote", F.lit(""))), tx.numbers(F.coalesce("claim_text", F.lit(""))))
    return with_values(claims).select("run_id", F.col("id").alias("cited"), F.concat(spoken, "declared").alias("allowed"))


def number_issues(briefs: DataFrame, claims: DataFrame) -> DataFrame:
    """Material numbers of a unit that no claim cited in that unit holds."""
    units = grounding_units(briefs, "run_id")
    material = units.withColumn("n", F.explode(tx.material_numbers(F.col("body"))))
    cited = units.select("run_id", "unit", F.explode(F.array_distinct(tx.claim_ids(F.col("body")))).alias("cited")).join(claim_numbers(claims), ["run_id", "cited"])
    allowed = cited.groupBy("run_id", "unit").agg(F.flatten(F.collect_list("allowed")).alias("allowed"))
    rows = material.join(allowed, ["run_id", "unit"], "left")
    value = F.col("n.value")
    fine = tx.grounded(value, F.col("allowed")) | (F.col("n.is_percent") & tx.grounded(value / 100, F.col("allowed")))
    return rows.where(~fine).select("run_id", F.lit("brief_numbers").alias("check"), "unit", F.concat(F.lit("number not grounded in the claims cited beside it: "), value.cast("string")).alias("message"))


def citation_issues(briefs: DataFrame, claims: DataFrame) -> DataFrame:
    """Unknown claim ids in a brief, and briefs that cite none."""
    cited = briefs.select("run_id", F.array_distinct(tx.claim_ids(F.col("text"))).alias("ids"))
    none = cited.where(F.size("ids") == 0).select("run_id", F.lit("brief cites no claims").alias("message"))
    known = claims.select("run_id", F.col("id").alias("cid")).distinct()
    unknown = cited.select("run_id", F.explode("ids").alias("cid")).join(known, ["run_id", "cid"], "left_anti").groupBy("run_id").agg(F.array_sort(F.collect_set("cid")).alias("u"))
    return none.unionByName(unknown.select("run_id", F.concat(F.lit("brief cites unknown claim id(s): "), F.array_join("u", ", ")).alias("message"))).withColumn("check", F.lit("brief_citations"))


def dollar_issues(briefs: DataFrame) -> DataFrame:
    d = tx.unescaped_dollars(F.col("text"))
    return briefs.select("run_id", d.alias("d")).where("d.n > 0").select("run_id", F.lit("brief_dollars").alias("check"), F.format_string("%d unescaped dollar sign(s) on line(s) %s", F.col("d.n"), F.array_join(F.col("d.lines").cast("array<string>"), ", ")).alias("message"))


def citation_pairs(briefs: DataFrame, claims: DataFrame, appendix: str = r"(?m)^## 10\. Evidence appendix") -> DataFrame:
    """``run_id, passage, claim_id, key``: every known claim cited in a block before the appendix."""
    main = F.get(F.split(F.col("text"), appendix), F.lit(0))
    blocks = briefs.select("run_id", F.posexplode(F.split(main, r"\n\s*\n")).alias("block", "passage")).withColumn("passage", F.trim("passage")).where("passage <> '' and passage not like '#%'")
    pairs = blocks.select("run_id", "block", "passage", F.posexplode(F.array_distinct(F.regexp_extract_all("passage", F.lit(r"\[(claim-[^\[\]\s]+)\]"), 1))).alias("nth", "claim_id"))
    known = claims.select("run_id", F.col("id").alias("claim_id")).distinct()
    return pairs.join(known, ["run_id", "claim_id"], "left_semi").select("run_id", "block", "nth", "passage", "claim_id", F.concat("claim_id", F.lit("@"), F.substr(F.sha2("passage", 256), F.lit(1), F.lit(8))).alias("key"))


def outlook_gate(briefs: DataFrame, claims_ok: DataFrame, fresh: DataFrame, *found: DataFrame) -> DataFrame:
    """``run_id, outcome``: blocked unless the claims passed and their inputs are unchanged, else
    failed with any brief issue, else passed."""
    issues = briefs.select("run_id").limit(0)
    for df in found:
        issues = issues.unionByName(df.select("run_id"))
    n = issues.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    rows = briefs.select("run_id").join(claims_ok.select("run_id", "ok"), "run_id", "left").join(fresh.select("run_id", "fresh"), "run_id", "left").join(n, "run_id", "left")
    outcome: Column = F.when(~F.coalesce("ok", F.lit(False)) | ~F.coalesce("fresh", F.lit(False)), "blocked").when(F.coalesce("n", F.lit(0)) > 0, "failed").otherwise("passed")
    return rows.select("run_id", outcome.alias("outcome"))
