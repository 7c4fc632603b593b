"""Chain of review rounds: every round bound to the bytes it reviewed and to the round before it.

Tables, a row for each round or entry of one:
``reports`` run_id, round, mode, verdict, escalate, claims_sha, brief_sha, diff_sha: what a report
says, and the hashes it was written for. ``files`` run_id, round, claims_sha, brief_sha, diff_sha:
hashes of what lay there when the report was checked, null for what is missing. ``diffs`` run_id,
round, round_number, since_round, claims_sha, brief_sha, escalated. ``changed`` run_id, round,
claim_id: claims that the diff names. ``receipts`` run_id, round, bucket, claim_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundcheck.functions.text import sample_ids
from groundcheck.operators.reviews import claim_diff


def places(rounds: DataFrame) -> DataFrame:
    """Rounds with their ``place`` in the run, from 1, whatever their numbers are."""
    return rounds.withColumn("place", F.row_number().over(Window.partitionBy("run_id").orderBy("round")))


def changed_claims(claims: DataFrame, columns: list[str], rounds: DataFrame | None = None) -> DataFrame:
    """``run_id, round, claim_id, change, old, new``: how each round's claims (run_id, round,
    claim_id, columns) differ from those of the round before it in the same run. ``rounds`` (run_id, round) names rounds
    that may have no claims at all."""
    order = places((claims if rounds is None else rounds).select("run_id", "round").distinct())
    numbered = claims.join(order, ["run_id", "round"])
    later = order.where("place > 1").select("run_id", "round", "place")
    before = numbered.select("run_id", (F.col("place") + 1).alias("place"), "claim_id", *columns)
    before = before.join(later.select("run_id", "place"), ["run_id", "place"], "left_semi")
    now = numbered.where("place > 1").select("run_id", "place", "claim_id", *columns)
    return claim_diff(before, now, ["run_id", "place", "claim_id"], columns).join(later, ["run_id", "place"]).select("run_id", "round", "claim_id", "change", "old", "new")


def carried_but_changed(receipts: DataFrame, changed: DataFrame) -> DataFrame:
    """``run_id, round, ids``: claims carried forward although the round's diff names them."""
    carried = receipts.where("bucket = 'carried_forward'").select("run_id", "round", "claim_id").distinct()
    both = carried.join(changed.select("run_id", "round", "claim_id").distinct(), ["run_id", "round", "claim_id"], "left_semi")
    return both.groupBy("run_id", "round").agg(F.array_sort(F.collect_set("claim_id")).alias("ids"))


def same(recorded: Column, current: Column) -> Column:
    """Whether a hash was recorded, its file is there, and both agree."""
    return F.coalesce(recorded == current, F.lit(False))


def round_chain(reports: DataFrame, files: DataFrame, diffs: DataFrame, changed: DataFrame, receipts: DataFrame) -> DataFrame:
    """``run_id, round, place, previous, bound, message``: the first rule that a round breaks.

    A report must be of the current claims and brief. The first round is full and has no diff. Every
    later one has a diff of just this round since the one before it, of the current claims and brief;
    its report names that diff, is full if the diff escalated, asks for a full review only from a
    diff review, and carries no claim forward that the diff names."""
    order = Window.partitionBy("run_id").orderBy("round")
    rows = places(reports).withColumn("previous", F.lag("round").over(order))
    keys = ["run_id", "round"]
    held = files.select(*keys, *[F.col(c).alias(f"file_{c}") for c in ("claims_sha", "brief_sha", "diff_sha")])
    made = diffs.select(*keys, F.lit(True).alias("made"), "round_number", "since_round", F.col("claims_sha").alias("made_claims"), F.col("brief_sha").alias("made_brief"), F.col("escalated").alias("made_escalated"))
    rows = rows.join(held, keys, "left").join(made, keys, "left").join(carried_but_changed(receipts, changed), keys, "left")
    first, full = F.col("place") == 1, F.col("mode").eqNullSafe("full")
    of_place = (F.col("round_number") == F.col("place")) & (F.col("since_round") == F.col("place") - 1)
    rules = [
        (~same(F.col("claims_sha"), F.col("file_claims_sha")), F.lit("report is not of the current claims")),
        (~same(F.col("brief_sha"), F.col("file_brief_sha")), F.lit("report is not of the current brief")),
        (first & (~full | F.col("diff_sha").isNotNull()), F.lit("the first round must be full and without a diff")),
        (~first & F.col("made").isNull(), F.lit("the round has no diff")),
        (~first & ~F.coalesce(of_place, F.lit(False)), F.lit("diff is of another round")),
        (~first & ~(same(F.col("made_claims"), F.col("file_claims_sha")) & same(F.col("made_brief"), F.col("file_brief_sha"))), F.lit("diff is stale")),
        (~first & ~same(F.col("diff_sha"), F.col("file_diff_sha")), F.lit("report is not of the current diff")),
        (~first & F.coalesce("made_escalated", F.lit(False)) & ~full, F.lit("an escalated round must be full")),
        (~first & F.coalesce("escalate", F.lit(False)) & ~F.col("mode").eqNullSafe("diff"), F.lit("only a diff review may ask for a full one")),
        (~first & F.col("ids").isNotNull(), F.concat(F.lit("changed claims are carried forward: "), sample_ids(F.col("ids")))),
    ]
    message = F.coalesce(*[F.when(broken, told) for broken, told in rules])
    return rows.select(*keys, "place", "previous", message.isNull().alias("bound"), message.alias("message"))


def chain_verdicts(chain: DataFrame) -> DataFrame:
    """``run_id, rounds, held, broken_round, message``: how many rounds a run has, how many hold
    before the first broken one, and why that one is."""
    broken = F.min(F.when(~F.col("bound"), F.struct("place", "round", "message")))
    rows = chain.groupBy("run_id").agg(F.count(F.lit(1)).alias("rounds"), broken.alias("b"))
    return rows.select("run_id", "rounds", F.coalesce(F.col("b.place").cast("long") - 1, F.col("rounds")).alias("held"), F.col("b.round").alias("broken_round"), F.col("b.message").alias("message"))
