"""Selecting evidence: point-in-time facts, search queries, dated hits and round-robin pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundcheck.functions.text import event_cutoff, let, period_kind, temporal_status


def with_period(facts: DataFrame) -> DataFrame:
    """Days and kind of every fact's period."""
    start, end = event_cutoff(F.col("start")), event_cutoff(F.col("end"))
    period = let(F.datediff(end, start), lambda days: F.struct(days.alias("duration_days"), period_kind(days).alias("period_type")))
    return facts.withColumn("_p", period).withColumns({c: F.col(f"_p.{c}") for c in ("duration_days", "period_type")}).drop("_p")


def in_period(facts: DataFrame, keys: list[str], end: str | None = None, kind: str | None = None, required: bool = False) -> DataFrame:
    """Facts with just this end and, where any of the concept has it, this kind of period; if
    none has it, the concept goes (``required``) or stays whole."""
    kept = facts if end is None else facts.where(F.col("end") == end)
    if kind is None:
        return kept
    fits = F.coalesce(F.col("period_type") == kind, F.lit(False))
    any_fits = F.max(fits).over(Window.partitionBy(*keys))
    return kept.withColumn("_fits", fits).withColumn("_any", any_fits).where(F.col("_fits") if required else F.col("_fits") | ~F.col("_any")).drop("_fits", "_any")


def point_in_time(facts: DataFrame, keys: list[str]) -> DataFrame:
    """One fact for each key: the latest end, then the earliest filing (a missing one is earliest),
    then the order in the source."""
    w = Window.partitionBy(*keys).orderBy(F.col("end").desc(), F.coalesce("filed", F.lit("")), "unit_pos", "entry_pos")
    return facts.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def expand_queries(companies: DataFrame, templates: list[tuple[str, int, str]], peers: DataFrame) -> DataFrame:
    """``run_id, class, select_key, pos, query``: templates (class, pos, template), a setting, filled for
    every company, those with class ``peer`` for each of its peers."""
    # A company carries the templates as one array, so that no side of a product needs a size.
    listed = [F.struct(F.lit(kind).alias("class"), F.lit(pos).alias("pos"), F.lit(text).alias("template")) for kind, pos, text in templates]
    none = F.array().cast("array<struct<class:string,pos:int,template:string>>")
    base = companies.withColumn("t", F.explode(F.array(*listed) if listed else none)).select("*", "t.*").drop("t")
    own = base.where("class <> 'peer'").withColumn("peer", F.lit("")).withColumn("peer_pos", F.lit(0))
    each = base.where("class = 'peer'").join(peers.select("run_id", "peer", "peer_pos"), "run_id")
    text = F.col("template")
    for name in ("company", "ticker", "event_id", "peer"):
        text = F.replace(text, F.lit("{" + name + "}"), F.coalesce(F.col(name), F.lit("")))
    rows = own.unionByName(each)
    order = Window.partitionBy("run_id").orderBy("class", "peer_pos", "pos")
    return rows.select("run_id", "class", F.when(F.col("class") == "peer", F.col("peer")).otherwise(F.col("class")).alias("select_key"), F.row_number().over(order).alias("pos"), text.alias("query"))


def normalize_hits(raw: DataFrame) -> DataFrame:
    """Hits of both providers in one form; a missing score stays null."""
    have = set(raw.columns)
    date = F.coalesce(*[F.col(c) for c in ("published_date", "publishedDate") if c in have], F.lit(None).cast("string"))
    keep = [c for c in raw.columns if c not in ("published_date", "publishedDate")]
    return raw.select(*keep, date.alias("published_date"))


def date_guard(hits: DataFrame, cutoff: Column) -> DataFrame:
    """Hits with ``temporal_status``; those after the event are marked not ``kept``."""
    return hits.withColumn("temporal_status", temporal_status(F.col("published_date"), cutoff)).withColumn("kept", F.col("temporal_status") != "post_event")


def guard_counts(guarded: DataFrame, key: str = "run_id") -> DataFrame:
    return guarded.groupBy(key).agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("excluded"))


def first_per_query(hits: DataFrame, keep_all: bool = False) -> DataFrame:
    if keep_all:
        return hits
    w = Window.partitionBy("run_id", "query").orderBy("pos")
    return hits.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def round_robin(hits: DataFrame, n: int, run: str = "run_id", url: str = "url", score: str = "score", pos: str = "pos", select_key: str = "select_key", cls: str = "class") -> DataFrame:
    """``n`` pages for each run, taken in turn from its buckets, best first; a missing score
    counts as -1 and ties keep their order. A repeated URL uses up its bucket's turn."""
    bucket = F.coalesce(F.nullif(F.col(select_key), F.lit("")), F.col(cls), F.lit(""))
    order = Window.partitionBy(run).orderBy(F.coalesce(F.col(score), F.lit(-1.0)).desc(), F.col(pos))
    rows = hits.withColumn("bucket", bucket).withColumn("_o", F.row_number().over(order))
    rows = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(run, "bucket").orderBy("_o"))).withColumn("_first", F.min("_o").over(Window.partitionBy(run, "bucket")))
    rows = rows.where(F.coalesce(F.col(url), F.lit("")) != "")
    once = Window.partitionBy(run, url).orderBy("_rank", "_first")
    rows = rows.withColumn("_u", F.row_number().over(once)).where("_u = 1")
    taken = rows.withColumn("selected", F.row_number().over(Window.partitionBy(run).orderBy("_rank", "_first")))
    return taken.where(F.col("selected") <= n).drop("_o", "_rank", "_first", "_u")


def evidence_ids(selected: DataFrame, prefix: str = "web-") -> DataFrame:
    """Ids by place in the selection, so that later failures leave gaps."""
    return selected.withColumn("id", F.concat(F.lit(prefix), F.format_string("%03d", "selected")))


def by_date(bars: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """Bars numbered by date within each series: dates ascend, whatever order the payload had."""
    return bars.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(date)))


def series_summary(bars: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    return bars.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), F.min(date).alias("first"), F.max(date).alias("last"))
