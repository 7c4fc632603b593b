"""SimHash near-duplicates: fingerprints, bit-sliced comparison, connected components.

Only distinct fingerprints are compared. Two fingerprints within ``radius`` bits of each other
agree on at least ``agree`` of ``bands`` bands when ``radius <= bands - agree``, so that rows meet
in the buckets of every choice of ``agree`` bands. A bucket is compared bit-sliced: the planes of
its fingerprints lie vertically, 64 members a word, and all distances to one fingerprint grow
together in carry-save counters; a word block is abandoned once every lane exceeds the radius.
A bucket emits a spanning set of links (each member to the smallest of its group), never all
pairs. Buckets above ``tile`` members are cut into tiles, and every pair of tiles is compared, so
that no task holds an unbounded bucket and no link is lost.

Defined results: a null, empty or wordless text has fingerprint 0, linked like any other; texts of
fewer than ``k`` words have one shingle; repeated rows and equal texts share a fingerprint and so a
component; null ids take part in links and are ignored as component names unless nothing else is
in the component; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundcheck.llm.common import CHUNK_BYTES, join_spread, lowered, pieces, stored, text_column, utf8

_DIGEST = xxhash.xxh64_intdigest
#: Bucket entries for each comparing task, were all of them to share a bucket with another.
ROWS_PER_PART = 400_000


def fingerprint_of(raw: bytes, k: int) -> int:
    """Majority bits over the XXH64 (seed 42) of all k-word shingles of lower-cased bytes."""
    words = raw.split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        return _DIGEST(joined, 42)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = (starts + lengths)[k - 1 :].tolist()
    hashes = np.array([_DIGEST(joined[a:b], 42) for a, b in zip(starts[: len(ends)].tolist(), ends)], np.uint64)
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64)
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4) -> DataFrame:
    """``id, fp``: the 64-bit fingerprint of every row, as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 4 * CHUNK_BYTES):
                data, at = utf8(text_column(part, "text"))
                raw = lowered(data).tobytes()
                found = np.array([fingerprint_of(raw[a:b], k) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, fp long")


# --- bit-sliced comparison -------------------------------------------------------------------


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 rows of packed bits: bit ``i`` of plane ``b`` is bit ``b`` of value ``i``."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
    padded = np.zeros((-(-len(values) // 64) * 64, 64), np.uint8)
    padded[: len(values)] = bits
    return np.ascontiguousarray(np.packbits(padded.T, axis=1, bitorder="little")).view(np.uint64)


def within_radius(planes: np.ndarray, query: int, radius: int) -> np.ndarray:
    """Packed lanes of the values that differ from ``query`` in ``radius`` bits at most. Distances
    are kept in carry-save counters that stick at their top; blocks of lanes whose counters all
    exceed the radius are abandoned."""
    width = (radius + 1).bit_length()
    top = 1 << width
    blocks = planes.shape[1]
    live = np.arange(blocks)
    over = np.zeros(blocks, np.uint64)
    # Counters begin so that they overflow exactly when the distance exceeds the radius.
    begin = top - (radius + 1)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    counters = [np.full(blocks, full if begin >> i & 1 else 0, np.uint64) for i in range(width)]
    for bit in range(64):
        carry = planes[bit, live]
        if query >> bit & 1:
            carry = ~carry
        for i in range(width):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        over[live] |= carry
        if bit % 8 == 7:
            keep = over[live] != full
            if not keep.all():
                live = live[keep]
                counters = [c[keep] for c in counters]
                if not len(live):
                    break
    return ~over


def spanning_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same groups as all pairs within the radius do: inside ``left``, or
    between ``left`` and ``right``. Already joined members are still compared, so none is lost."""
    members = left if right is None else np.concatenate([left, right])
    parent = np.arange(len(members))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = int(parent[i])
        return i

    against = left if right is None else right
    shift = 0 if right is None else len(left)
    planes = bit_planes(against)
    for i, value in enumerate(left.tolist()):
        lanes = np.unpackbits(within_radius(planes, value, radius).view(np.uint8), bitorder="little")[: len(against)]
        for j in (np.flatnonzero(lanes) + shift).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    roots = np.array([root(i) for i in range(len(members))], np.int64)
    smallest = np.full(len(members), np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(smallest, roots, members)
    to = smallest[roots]
    linked = to != members
    return members[linked], to[linked]


def band_key(fp: Column, chosen: tuple[int, ...], bands: int) -> Column:
    """The bits of the chosen bands, the others cleared."""
    mask = 0
    for band in chosen:
        lo, hi = 64 * band // bands, 64 * (band + 1) // bands
        mask |= ((1 << (hi - lo)) - 1) << lo
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def links(values: DataFrame, radius: int = 4, bands: int = 7, tile: int = 4096) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that join exactly the groups
    that all pairs within ``radius`` bits join."""
    agree = bands - radius
    if agree < 1:
        raise ValueError("bands must exceed the radius")
    choices = list(combinations(range(bands), agree))
    keyed = values.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), band_key(F.col("fp"), c, bands).alias("key")) for i, c in enumerate(choices)])).alias("b")).select("fp", "b.choice", "b.key")
    sizes = keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Spark sizes what an explode makes like what it reads, and would send all entries or buckets to the driver.
    shared = keyed.join(sizes.hint("merge"), ["choice", "key"])
    # Members of a large bucket go to tiles by hash; each tile meets itself and every other one.
    tiles = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    dealt = shared.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    dealt = dealt.select("choice", "key", "fp", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    # Small buckets travel together: one group holds many of them, and each task walks its buckets.
    dealt = dealt.withColumn("slot", F.pmod(F.xxhash64("choice", "key", "lo", "hi"), F.lit(1 << 20)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def walk(table: pa.Table) -> pa.RecordBatch:
            cols = [table.column(n).to_numpy() for n in ("choice", "key", "lo", "hi", "own", "fp")]
            cut = np.zeros(len(cols[0]), bool)
            cut[:1] = True
            for c in cols[:4]:
                cut[1:] |= c[1:] != c[:-1]
            at = np.append(np.flatnonzero(cut), len(cut))
            sides_own, fps = cols[4], cols[5].view(np.uint64)
            out_a, out_b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            sizes = np.diff(at)
            two = at[:-1][sizes == 2]  # most buckets hold two values: one vectorised comparison
            if len(two):
                x, y = fps[two], fps[two + 1]
                near = np.bitwise_count(x ^ y) <= radius
                out_a.append(np.maximum(x, y)[near])
                out_b.append(np.minimum(x, y)[near])
            for a, b in zip(at[:-1][sizes > 2].tolist(), at[1:][sizes > 2].tolist()):
                if cols[2][a] == cols[3][a]:
                    found = spanning_links(fps[a:b], None, radius)
                else:
                    mine = sides_own[a:b] == cols[2][a]
                    found = spanning_links(fps[a:b][mine], fps[a:b][~mine], radius)
                out_a.append(found[0])
                out_b.append(found[1])
            ab = np.unique(np.stack([np.concatenate(out_a), np.concatenate(out_b)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(ab[:, 0]).view(np.int64)), pa.array(np.ascontiguousarray(ab[:, 1]).view(np.int64))], ["a", "b"])

        # A bucket may run over the end of a batch: its rows wait for the next one.
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            last = [table.column(n)[-1].as_py() for n in ("choice", "key", "lo", "hi")]
            keys = [table.column(n).to_numpy() for n in ("choice", "key", "lo", "hi")]
            open_ = np.logical_and.reduce([k == v for k, v in zip(keys, last)])
            begin = int(np.flatnonzero(~open_)[-1]) + 1 if not open_.all() else 0
            if begin:
                yield walk(table.slice(0, begin))
            held = table.slice(begin).combine_chunks().to_batches()
        if held:
            yield walk(pa.Table.from_batches(held))

    # Comparisons cost far more than their few bytes tell, so that their number decides, not their size.
    parts = max(values.sparkSession.sparkContext.defaultParallelism, values.count() * len(choices) // ROWS_PER_PART)
    ordered = dealt.repartition(parts, "slot").sortWithinPartitions("choice", "key", "lo", "hi")
    return ordered.select("choice", "key", "lo", "hi", "own", "fp").mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``a, b`` links: the smallest node that can be reached.

    Alternates two steps until nothing changes. Large star: every node hands its larger
    neighbours to its smallest one. Small star: likewise for the smaller neighbours. Each round
    is written to the shared folder; only a changed-rows count comes to the driver. The smallest
    neighbours of hubs, nodes with a thousandth of all links or more, are broadcast."""
    pairs = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, n_links = None, pairs.count()
    for _ in range(most_rounds):
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("a", "m")), "least")
        hub = F.col("n") > n_links // 1000 + 1000
        hubs = F.broadcast(least.where(hub).select("a", F.col("m").alias("of_hub")))  # 2,000 rows at most
        rest = least.where(~hub).select("a", F.col("m").alias("of_rest"))
        marked = both.where("b > a").join(hubs, "a", "left")
        told = marked.where("of_hub is not null").select("b", F.col("of_hub").alias("m")).unionByName(marked.where("of_hub is null").join(rest, "a").select("b", F.col("of_rest").alias("m")))
        large = told.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        pairs = stored(small, "links")
        state = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        n_links = state[0]
        if state == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, radius: int = 4, bands: int = 7, tile: int = 4096) -> DataFrame:
    """``id, fp, component`` for every row: the component is named by its smallest id."""
    prints = stored(fingerprints(docs, id_col, text_col, k), "prints")
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-prints")
    roots = components(links(distinct, radius, bands, tile))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    # A component may hold many fingerprints, and a fingerprint many texts.
    rooted = stored(rooted, "rooted")
    per_print = stored(join_spread(rooted, named, ["root"], ["fp"]).select("fp", "component"), "components")
    return join_spread(prints, per_print, ["fp"], ["id"]).select("id", "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of every component: the one with the smallest id, null ids last, and of rows that
    share it the one with the smallest hash of the text. Rows are told apart by numbers of their
    own, so that null and shared ids lose no component."""
    row, tie = f"row_{uuid.uuid4().hex}", f"tie_{uuid.uuid4().hex}"
    # Numbers hold only once they are written: a second reading may deal the rows out otherwise.
    numbered = stored(docs.select("*", F.xxhash64(text_col).alias(tie), F.monotonically_increasing_id().alias(row)), "numbered")
    placed = near_duplicates(numbered, row, text_col, **options).select(F.col("id").alias(row), "component")
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(tie).alias("tie"), F.col(row).alias("row"))
    kept = placed.join(numbered.select(row, order.alias("at")), row).groupBy("component").agg(F.min("at").alias("at")).select(F.col("at.row").alias(row))
    return numbered.join(kept, row, "left_semi").drop(row, tie)
