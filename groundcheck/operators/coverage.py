"""Coverage receipts: every segment and page is accounted for, once, with claims or a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# The outcomes that a receipt may give.
EXTRACTED, IMMATERIAL = "claims_extracted", "deliberately_immaterial"


def coverage_issues(receipt: DataFrame, evidence: DataFrame, claims: DataFrame, extracted: str = EXTRACTED, immaterial: str = IMMATERIAL) -> DataFrame:
    """``run_id, check, section, id, message``. ``receipt``: run_id, section, id, outcome,
    claim_ids, reason. ``evidence``: run_id, section, id; sections without evidence are skipped. Of
    a run with a receipt, a section that the receipt lacks altogether is told once."""
    universe = evidence.select("run_id", "section", "id").distinct()
    sections = universe.select("run_id", "section").distinct()
    rows = receipt.join(sections, ["run_id", "section"], "left_semi")
    listed = rows.select("run_id", "section", "id").distinct().withColumn("listed", F.lit(True))
    absent = sections.join(rows.select("run_id", "section").distinct(), ["run_id", "section"], "left_anti")
    whole = universe.join(absent, ["run_id", "section"]).groupBy("run_id", "section").agg(F.count(F.lit(1)).alias("n"))
    whole = whole.select("run_id", "section", F.lit(None).cast("string").alias("id"), F.format_string("section is missing: %d unaccounted for", "n").alias("message"))
    both = listed.join(universe.join(absent, ["run_id", "section"], "left_anti").withColumn("known", F.lit(True)), ["run_id", "section", "id"], "full_outer")
    message = F.when(F.col("listed").isNull(), "missing from the receipt").when(F.col("known").isNull(), "not in this run's evidence")
    found = both.select("run_id", "section", "id", message.alias("message")).where("message is not null").unionByName(whole)
    ids, reason = F.coalesce("claim_ids", F.array().cast("array<string>")), F.trim(F.coalesce("reason", F.lit("")))
    is_extracted, is_immaterial = F.col("outcome").eqNullSafe(extracted), F.col("outcome").eqNullSafe(immaterial)
    checks = [
        (is_extracted & (F.size(ids) == 0), "extracted without claim ids"),
        (is_immaterial & (F.size(ids) > 0), "immaterial with claim ids"),
        (is_immaterial & (reason == ""), "immaterial without a reason"),
        (~is_extracted & ~is_immaterial, f"outcome must be {extracted} or {immaterial}"),
    ]
    told = F.filter(F.array(*[F.when(c, F.lit(m)) for c, m in checks]), lambda m: m.isNotNull())
    states = rows.select("run_id", "section", "id", F.explode(told).alias("message"))
    known = claims.select("run_id", F.col("id").alias("cid")).distinct()
    unknown = rows.select("run_id", "section", "id", F.explode("claim_ids").alias("cid")).join(known, ["run_id", "cid"], "left_anti")
    bad = unknown.groupBy("run_id", "section", "id").agg(F.concat(F.lit("unknown claim id(s): "), F.array_join(F.array_sort(F.collect_set("cid")), ", ")).alias("message"))
    return found.unionByName(states).unionByName(bad).withColumn("check", F.lit("coverage_receipt"))


def difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of one side only, with ``side`` left or right."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, keys, "left_anti").withColumn("side", F.lit("right")))
