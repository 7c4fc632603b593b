"""Integrity: files against their manifest, recorded against current hashes, price decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def manifest_issues(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """``run_id, path, message``. ``manifest``: run_id, path, sha256, byte_length; ``files``:
    run_id, path, content."""
    held = files.select("run_id", "path", F.sha2("content", 256).alias("got"), F.octet_length("content").alias("length"))
    rows = manifest.withColumns({"told": F.col("path"), "path": resolved(F.col("path"))})
    escapes, missing = F.col("path").isNull(), F.col("got").isNull()
    named = F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))
    checks = [
        (escapes, "path is empty or leaves the run"),
        (~escapes & missing, "file is missing"),
        (~escapes & ~missing & ~F.col("length").cast("long").eqNullSafe(F.col("byte_length").cast("long")), "length differs"),
        (~escapes & ~missing & ~(named & F.col("got").eqNullSafe(F.col("sha256"))), "hash differs"),
    ]
    told = F.filter(F.array(*[F.when(c, F.lit(m)) for c, m in checks]), lambda m: m.isNotNull())
    return rows.join(held, ["run_id", "path"], "left").select("run_id", F.col("told").alias("path"), F.explode(told).alias("message"))


def resolved(path: Column) -> Column:
    """A path within a run without ``.`` and ``..``; null if it is empty, absolute or leaves the run."""
    steps = F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))
    start = F.struct(F.array().cast("array<string>").alias("at"), F.lit(True).alias("fine"))

    def step(state: Column, s: Column) -> Column:
        up, deep = s == "..", F.size(state["at"]) > 0
        at = F.when(~up, F.concat(state["at"], F.array(s))).when(deep, F.slice(state["at"], 1, F.greatest(F.size(state["at"]) - 1, F.lit(0)))).otherwise(state["at"])
        return F.struct(at.alias("at"), (state["fine"] & (~up | deep)).alias("fine"))

    found = F.aggregate(steps, start, step)
    return F.when((F.coalesce(path, F.lit("")) != "") & ~path.startswith("/") & found["fine"], F.array_join(found["at"], "/"))


def staleness(recorded: DataFrame, current: DataFrame, required: list[str]) -> DataFrame:
    """``run_id, fresh, stale``: whether all recorded hashes (map input_hashes) are those of now
    (run_id, name, sha256) and all required ones are recorded."""
    each = recorded.select("run_id", F.explode("input_hashes").alias("name", "then"))
    same = each.join(current, ["run_id", "name"], "left").withColumn("same", F.coalesce(F.col("then") == F.col("sha256"), F.lit(False)))
    per = same.groupBy("run_id").agg(F.bool_and("same").alias("same"), F.array_sort(F.collect_set(F.when(~F.col("same"), F.col("name")))).alias("changed"), F.collect_set("name").alias("names"))
    rows = recorded.select("run_id").join(per, "run_id", "left")
    missing = F.array_except(F.array(*[F.lit(r) for r in required]).cast("array<string>"), F.coalesce("names", F.array().cast("array<string>")))
    stale = F.array_sort(F.array_union(F.coalesce("changed", F.array().cast("array<string>")), missing))
    return rows.select("run_id", stale.alias("stale")).withColumn("fresh", F.size("stale") == 0)


def price_log(log: DataFrame) -> DataFrame:
    """Rollup of a run's price lookups (run_id, ticker, status, own_ticker); unreadable lines have
    a null status."""
    return log.groupBy("run_id").agg(
        F.count("status").alias("rows"),
        F.count_if(F.col("status") == "ok").alias("successes"),
        F.count_if(F.col("status").isNull()).alias("unreadable"),
        F.count_if(F.col("status").isNotNull() & ~F.col("ticker").eqNullSafe(F.upper("own_ticker"))).alias("foreign"),
    )


def price_issues(decisions: DataFrame, log: DataFrame) -> DataFrame:
    """Decisions (run_id, decision, reason) that the log does not bear out."""
    rows = decisions.join(price_log(log), "run_id", "left").fillna(0, ["rows", "successes", "unreadable", "foreign"])
    d = F.col("decision")
    checks = [
        (F.trim(F.coalesce("reason", F.lit(""))) == "", "decision has no reason"),
        (F.col("unreadable") > 0, "log has an unreadable line"),
        (F.col("foreign") > 0, "log has another ticker"),
        ((d == "used") & (F.col("successes") == 0), "used without a successful lookup"),
        ((d == "attempted_failed") & ((F.col("rows") == 0) | (F.col("successes") > 0)), "attempted_failed needs lookups and no success"),
        ((d == "not_used") & (F.col("rows") > 0), "not used but looked up"),
        (~F.coalesce(d.isin("used", "attempted_failed", "not_used"), F.lit(False)), "unknown decision"),
    ]
    told = F.filter(F.array(*[F.when(c, F.lit(m)) for c, m in checks]), lambda m: m.isNotNull())
    return rows.select("run_id", F.lit("price_decision").alias("check"), F.explode(told).alias("message"))


def replay(logged: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """``outcome`` of every logged call: pre_replay without a logged hash, unreplayable without a
    rebuilt state, match, or mismatch (by the builder, if that changed)."""
    rows = logged.join(rebuilt.select("run_id", "subject", F.col("state_hash").alias("now"), F.col("builder_hash").alias("builder_now")), ["run_id", "subject"], "left")
    outcome = F.when(F.col("state_hash").isNull(), "pre_replay").when(F.col("now").isNull(), "unreplayable").when(F.col("now") == F.col("state_hash"), "match").when(~F.col("builder_hash").eqNullSafe(F.col("builder_now")), "mismatch_builder").otherwise("mismatch_input")
    return rows.select("run_id", "subject", outcome.alias("outcome"))
