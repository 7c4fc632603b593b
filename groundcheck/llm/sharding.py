"""Sharding by sampled splitters.

Records are ordered by a key, ``(hash of the text, id)``, so that equal texts lie together but a
large group of them can still be cut. A sample of keys is drawn with chances in proportion to a
record's weight (its size for law ``bytes``, one for law ``rows``); the sample's quantiles split
the key space into ranges of about equal weight. Ranges that turn out overfull are sampled again
and subdivided. Exact sums of the ranges then give every range its place in the whole, records get
their running weight within their range, and a record belongs to the shard in which its weight
begins. A range is a small part of a shard, so that no task holds a shard. Only records equal in
text and id can't be told apart by their key and share a range.

Ranges grow in number with the rows: one for each ``per_range`` rows at first, and beyond some
thousands one for each ``ROWS_PER_MORE`` rows more, which stay far below what a task can sort. The
splitters are a few bytes for each range; records find theirs through a tree of three levels.

Law ``bytes``: a record lies where it begins, so that a shard's sum may fall short of, or exceed, the
even share by less than its last record; two sums differ by less than two of the largest records.
Law ``rows``: counts differ by one at most.

Defined results: a null text has size 1; null ids and equal records keep their rows, in any order
among themselves; empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundcheck.llm.common import stored

#: Expected sample keys for each range.
SAMPLE_PER_RANGE = 8
#: So many ranges may be as small as the caller asks; beyond, each has as many rows.
SMALL_RANGES, ROWS_PER_MORE = 2048, 500_000
#: A range is overfull above so many times its even share of the weight.
OVERFULL = 3.0


def splitters(keys: DataFrame, weight: Column, total: float, ranges: int) -> list[tuple[int, str]]:
    """Quantiles of a weighted sample of ``(h, tie)`` keys: no more than ``ranges`` of them, from
    about ``SAMPLE_PER_RANGE`` sample keys each. A heavy record counts as often as it was drawn."""
    rate = ranges * SAMPLE_PER_RANGE / max(total, 1.0)
    draw = F.pmod(F.xxhash64("h", "tie", F.lit("splitters")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = F.floor(weight * F.lit(rate) + draw).cast("int")
    sample = keys.select("h", "tie", times.alias("times")).where("times > 0")
    drawn = sorted((r.h, r.tie, r.times) for r in sample.collect())
    cuts, held, step = [], 0, SAMPLE_PER_RANGE
    for h, tie, n in drawn:
        held += n
        if held >= step:
            cuts.append((h, tie))
            held %= step
    return sorted(set(cuts))


def range_index(h: Column, tie: Column, cuts: list[tuple[int, str]]) -> Column:
    """How many splitters lie at or below the key. Three levels keep the comparisons of a record at
    three times the cubic root of the number of splitters, which are one literal of the plan."""
    if not cuts:
        return F.lit(0)
    wide = max(1, round(len(cuts) ** (1 / 3)))
    keys = [{"h": a, "tie": b} for a, b in cuts]
    low = [keys[i : i + wide] for i in range(0, len(keys), wide)]
    high = [low[i : i + wide] for i in range(0, len(low), wide)]
    me = F.struct(h.alias("h"), tie.alias("tie"))

    def literal(tree: list, depth: int) -> Column:
        kind = "array<" * depth + "struct<h:bigint,tie:string>" + ">" * depth
        return F.from_json(F.lit(json.dumps(tree)), kind)

    def below(heads: Column) -> Column:
        return F.size(F.filter(heads, lambda s: s <= me))

    inner = literal([[[leaf[0] for leaf in group] for group in high]], 3)[0]
    # The last group at each level whose first splitter is not beyond the key.
    top = below(literal([group[0][0] for group in high], 1))
    middle = below(F.element_at(inner, F.greatest(top, F.lit(1))))
    group = (top - 1) * wide + middle
    last = below(F.element_at(literal(low, 2), F.greatest(group, F.lit(1))))
    return F.when(top == 0, 0).otherwise((group - 1) * wide + last)


def range_count(rows: int, per_range: int) -> int:
    """Ranges for so many rows: small ones while they are few, then more with every row."""
    return int(max(1, min(rows // per_range, SMALL_RANGES + rows // ROWS_PER_MORE)))


def range_cuts(keys: DataFrame, weight_col: str, per_range: int, rounds: int = 3) -> list[tuple[int, str]]:
    """Splitters for ranges of about ``per_range`` rows; overfull ranges are subdivided by splitters
    drawn from their own records."""
    rows, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum(weight_col), F.lit(0))).first()
    ranges = range_count(rows, per_range)
    cuts = splitters(keys, F.col(weight_col), float(total), ranges) if ranges > 1 else []
    for _ in range(rounds if cuts else 0):
        placed = keys.withColumn("range", range_index(F.col("h"), F.col("tie"), cuts))
        sums = placed.groupBy("range").agg(F.sum(weight_col).alias("w"), F.min(F.struct("h", "tie")).alias("a"), F.max(F.struct("h", "tie")).alias("b"))
        over = sums.where((F.col("w") > OVERFULL * total / ranges) & (F.col("a") != F.col("b"))).select("range", "w").collect()
        if not over:
            break
        share = sum(r.w for r in over)
        crowded = placed.where(F.col("range").isin([r.range for r in over]))
        more = splitters(crowded, F.col(weight_col), float(share), max(2, int(2 * ranges * share / total)))
        if set(more) <= set(cuts):
            break
        cuts = sorted(set(cuts) | set(more))
    return cuts


def ranged(keys: DataFrame, weight_col: str, per_range: int) -> DataFrame:
    """``keys`` with a column ``range`` that follows the order of ``(h, tie)``."""
    return keys.withColumn("range", range_index(F.col("h"), F.col("tie"), range_cuts(keys, weight_col, per_range)))


def shard(docs: DataFrame, shards: int = 16, law: str = "bytes", id_col: str = "doc_id", text_col: str = "text", per_range: int = 1000) -> DataFrame:
    """``id, size, text_crc32, shard, slot`` for every row: shards 0 to ``shards - 1``, slots
    without a gap from 0 in each, in key order."""
    if law not in ("bytes", "rows"):
        raise ValueError(f"no such law: {law}")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.coalesce(F.format_string("%020d", F.col(id_col)) if dict(docs.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint") else F.col(id_col).cast("string"), F.lit("")).alias("tie"),
    )
    keys = stored(keys.withColumn("weight", F.col("size") if law == "bytes" else F.lit(1).cast("long")), "shard-keys")
    placed = stored(ranged(keys, "weight", per_range), "shard-ranges")
    sums = placed.groupBy("range").agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n"))
    # A row for each range, by far fewer than the records: their running sums fit one task.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("range", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    total = placed.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    inner = Window.partitionBy("range").orderBy("h", "tie").rowsBetween(Window.unboundedPreceding, -1)
    nth = Window.partitionBy("range").orderBy("h", "tie")
    run = placed.withColumn("w", F.coalesce(F.sum("weight").over(inner), F.lit(0))).withColumn("n", F.row_number().over(nth) - 1)
    put = run.join(F.broadcast(offsets), "range").withColumn("n", F.col("n") + F.col("n0"))
    # Whole numbers throughout: a quotient of decimals is rounded to six places and may reach the next shard.
    put = put.withColumn("shard", F.expr(f"cast(w + w0 as decimal(38,0)) * {int(shards)} div cast({max(int(total), 1)} as decimal(38,0))"))
    put = stored(put.select("id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "n"), "shard-places")
    firsts = put.groupBy("shard").agg(F.min("n").alias("first"))
    return put.join(F.broadcast(firsts), "shard").select("id", "size", "text_crc32", "shard", (F.col("n") - F.col("first")).cast("long").alias("slot"))
