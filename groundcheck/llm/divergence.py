"""How far the sources of a language differ in their words.

Words are counted in tasks over slices of the texts' bytes, summed before the shuffle, and then by
(language, source, term). The terms found in enough documents of a language are kept. A group is a
(language, source); its price of a term depends on the term's count there alone, the *count level*.
So the distance of two groups, the sum of the absolute differences of their prices over all kept
terms, needs only their joint table: how many terms have level ``a`` in one and ``b`` in the other.

Joint tables come from matrix products: for a block of terms, the indicator matrix has a column for
every (group, level) that occurs there, level 0 included, and one 1 for each term and group. Its
transpose times itself holds the joint tables of all its groups (whole numbers below 2^24, exact in
32-bit floats); they are priced in 64-bit integers at once, so that only one sum for each pair of
groups leaves a block. Terms are dealt into buckets by hash, groups into blocks of ``GROUPS``; a pair of
group blocks in a bucket is one unit of work, of bounded size however many sources or terms there are.

Defined results: null text, language and source are read as ''; texts of any length are taken in
slices; repeated rows and ids count as documents of their own; groups without a term have count 0
everywhere; languages without a kept term have pair values 0 and no term rows; an empty table gives
an empty result; further columns are ignored. Prices are divisions of whole numbers throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundcheck.llm.common import CHUNK_BYTES, give_back, join_spread, lowered, pieces, span_hashes, stored, text_column, utf8, word_spans

#: Bytes that part terms: ASCII that is no letter.
PARTING = np.zeros(256, bool)
PARTING[:128] = [not chr(c).isalpha() for c in range(128)]
#: Groups in a block, terms in a bucket (about), and the most indicator columns of one product.
GROUPS, BUCKET_TERMS, COLUMNS = 48, 4096, 2048
UNIT = 1_000_000_000

COUNTED = "lang string, source string, term string, n long, df long"


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each span, equal for equal bytes, and one span of every number.

    Spans are told apart by 64-bit hashes; all are then compared with their number's span, and
    numbered by their bytes should two different ones share a hash."""
    _, chosen, number = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    lengths = ends - starts
    like = chosen[number]
    same = bool((lengths == lengths[like]).all())
    if same and len(starts):
        first = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        same = bool((data[within + np.repeat(starts, lengths)] == data[within + np.repeat(starts[like], lengths)]).all())
    if not same:
        seen: dict[bytes, int] = {}
        number = np.array([seen.setdefault(data[a:b].tobytes(), len(seen)) for a, b in zip(starts, ends)], np.int64)
        chosen = np.unique(number, return_index=True)[1]
    return number, chosen


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as a string column, without a Python object for each."""
    lengths = ends - starts
    at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    within = np.arange(int(at[-1])) - np.repeat(at[:-1], lengths)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(at.tobytes()), pa.py_buffer(data[within + np.repeat(starts, lengths)].tobytes()))


def count_slice(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Of texts with the given group numbers: group, term, occurrences and documents of every pair."""
    low = lowered(data)
    starts, ends, counts = word_spans(low, offsets, PARTING)
    number, chosen = distinct_spans(low, starts, ends)
    terms = max(len(chosen), 1)
    doc = np.repeat(np.arange(len(counts)), counts)
    by_doc, times = np.unique(doc * terms + number, return_counts=True)
    pair, place = np.unique(group[by_doc // terms] * terms + by_doc % terms, return_inverse=True)
    n = np.bincount(place, times, len(pair)).astype(np.int64)
    term = chosen[pair % terms] if len(pair) else np.zeros(0, np.int64)
    return pair // terms, strings(low, starts[term], ends[term]), n, np.bincount(place, minlength=len(pair)).astype(np.int64)


def slices_of(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ends of slices of one long text, each before a parting byte; a longer term stays whole."""
    begin = 0
    while begin < len(data):
        end = begin + CHUNK_BYTES
        while end < len(data):
            breaks = np.flatnonzero(PARTING[data[end : end + CHUNK_BYTES]])
            if len(breaks):
                end += int(breaks[0])
                break
            end += CHUNK_BYTES
        end = min(end, len(data))
        yield begin, end
        begin = end


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in pieces(whole, "text"):
            data, offsets = utf8(text_column(batch, "text"))
            names = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["lang", "source"]).to_pylist()
            known: dict[tuple, int] = {}
            group = np.array([known.setdefault((g["lang"], g["source"]), len(known)) for g in names], np.int64)
            langs, sources = pa.array([k[0] for k in known], pa.string()), pa.array([k[1] for k in known], pa.string())
            if len(data) <= 2 * CHUNK_BYTES:
                parts = [count_slice(data, offsets, group)] if len(group) else []
            else:
                parts = [_one_document(data)]
            for g, term, n, df in parts:
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(g)), sources.take(pa.array(g)), term, pa.array(n), pa.array(df)], ["lang", "source", "term", "n", "df"])
        give_back()


def _one_document(data: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Like ``count_slice`` for a single long text: a term of several slices is in one document."""
    total: dict[str, int] = {}
    for a, b in slices_of(data):
        _, term, n, _ = count_slice(data[a:b], np.array([0, b - a]), np.zeros(1, np.int64))
        for t, k in zip(term.to_pylist(), n.tolist()):
            total[t] = total.get(t, 0) + k
    n = np.array(list(total.values()), np.int64)
    return np.zeros(len(n), np.int64), pa.array(list(total), pa.string()), n, np.ones(len(n), np.int64)


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, df`` of ``docs`` with columns ``lang, source, text``, none null."""
    found = docs.mapInArrow(count_batches, COUNTED)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def price(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 terms)), in whole numbers."""
    up = F.lit(UNIT).cast("decimal(10,0)") * (count + 5).cast("decimal(20,0)")
    down = (total + 5 * terms).cast("decimal(20,0)")
    return F.call_function("div", up, down) + 1


def indicator_blocks(term: np.ndarray, column: np.ndarray, terms: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Consecutive runs of terms whose (term, column) pairs name no more than ``COLUMNS`` columns,
    or single terms. ``term`` is sorted."""
    begin, step = 0, terms
    while begin < terms:
        a, b = np.searchsorted(term, [begin, min(begin + step, terms)])
        if step > 1 and len(np.unique(column[a:b])) > COLUMNS:
            step = (step + 1) // 2
            continue
        yield term[a:b] - begin, column[a:b]
        begin += step


def priced_pairs(group: np.ndarray, term: np.ndarray, level: np.ndarray, value: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """Sums of absolute price differences of all pairs of groups over a bucket's terms.

    ``group``, ``term``, ``level`` and ``value`` (the level's price) tell of every term that occurs in
    a group; ``zero`` holds each group's price of level 0."""
    groups, total = len(zero), np.zeros((len(zero), len(zero)), np.int64)
    terms = int(term.max()) + 1 if len(term) else 0
    order = np.argsort(term, kind="stable")
    group, term, level, value = group[order], term[order], level[order], value[order]
    # Columns: first level 0 of every group, then every other (group, level).
    pairs, first, place = np.unique(np.stack([group, level]), axis=1, return_index=True, return_inverse=True)
    of_group = np.concatenate([np.arange(groups), pairs[0]])
    prices = np.concatenate([zero, value[first]])
    for row, column in indicator_blocks(term, place.reshape(-1) + groups, terms):
        height = int(row.max()) + 1 if len(row) else 0
        used, narrow = np.unique(np.concatenate([np.arange(groups), column]), return_inverse=True)
        narrow = narrow.reshape(-1)[groups:]
        hot = np.zeros((height, len(used)), np.float32)
        hot[:, :groups] = 1
        hot[row, narrow] = 1
        hot[row, of_group[column]] = 0
        joint = (hot.T @ hot).astype(np.int64)
        cost = joint * np.abs(prices[used][:, None] - prices[used][None, :])
        by = np.argsort(of_group[used], kind="stable")
        edges = np.searchsorted(of_group[used][by], np.arange(groups))
        total += np.add.reduceat(np.add.reduceat(cost[by][:, by], edges, axis=0), edges, axis=1)
    return total


PRICED = "lang string, g int, h int, seen long, value long"


def price_unit(table: pa.Table, groups_in_block: int) -> pa.Table:
    """One bucket of terms and one pair of group blocks. Rows without a term name the groups."""
    lang = table.column("lang")[0].as_py()
    g = table.column("g").to_numpy()
    value = table.column("p").to_numpy()
    named = table.column("term").is_null().to_numpy()
    numbers, number = np.unique(g, return_inverse=True)
    number = number.reshape(-1)
    zero = np.zeros(len(numbers), np.int64)
    zero[number[named]] = value[named]
    terms = pa.concat_arrays(table.column("term").filter(pa.array(~named)).chunks or [pa.array([], pa.string())])
    term = terms.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    found = priced_pairs(number[~named], term, table.column("n").to_numpy()[~named], value[~named], zero)
    i, j = np.triu_indices(len(numbers), 1)
    low, high = int(table.column("low")[0].as_py()), int(table.column("high")[0].as_py())
    block = numbers // groups_in_block
    wanted = (block[i] == low) & (block[j] == high)
    i, j = i[wanted], j[wanted]
    seen = int(term.max()) + 1 if len(term) else 0
    return pa.table({"lang": pa.array([lang] * len(i), pa.string()), "g": pa.array(numbers[i], pa.int32()), "h": pa.array(numbers[j], pa.int32()), "seen": pa.array([seen] * len(i), pa.int64()), "value": pa.array(found[i, j], pa.int64())})


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_documents: int = 30, top: int = 50) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has every other source of the
    language by distance, part ``term`` the ``top`` terms that a source has more of than its language."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    found = stored(term_counts(plain), "divergence-counts")
    by_term = stored(found.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("df").alias("df")).where(F.col("df") >= least_documents).drop("df"), "divergence-terms")
    kept = stored(found.drop("df").join(by_term, ["lang", "term"]), "divergence-kept")
    langs = by_term.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all").alias("n_lang"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    # Sources of a language are numbered; a row for each group.
    groups = plain.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_group", "v", "n_lang")])
    groups = stored(groups.withColumn("g", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("lang"))), "divergence-groups")
    small = groups.count() <= 100_000
    joined = kept.join(F.broadcast(groups), ["lang", "source"]) if small else join_spread(kept, groups, ["lang", "source"], ["term"])
    facts = joined.withColumn("p", price(F.col("n"), F.col("n_group"), F.col("v")))
    pairs = _pairs(facts, groups)
    terms = facts.withColumn("q", price(F.col("all"), F.col("n_lang"), F.col("v"))).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= top))


def _pairs(facts: DataFrame, groups: DataFrame) -> DataFrame:
    size = GROUPS
    buckets = F.floor(F.col("v") / BUCKET_TERMS).cast("int") + 1
    block, last = F.floor(F.col("g") / GROUPS).cast("int"), F.floor((F.col("size") - 1) / GROUPS).cast("int")
    # A row goes to every pair of blocks that its own block is part of.
    units = F.transform(F.sequence(F.lit(0), last), lambda b: F.named_struct(F.lit("low"), F.least(b, block), F.lit("high"), F.greatest(b, block)))
    rows = facts.select("lang", "g", "term", "n", "p", F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"), F.explode(units).alias("u"))
    zero = price(F.lit(0).cast("long"), F.col("n_group"), F.col("v"))
    named = groups.where("v > 0").select("lang", "g", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), zero.alias("p"), F.explode(F.sequence(F.lit(0), buckets - 1)).alias("bucket"), units.alias("units"))
    named = named.select("lang", "g", "term", "n", "p", "bucket", F.explode("units").alias("u"))
    work = rows.unionByName(named).select("lang", "g", "term", "n", "p", "bucket", F.col("u.low").alias("low"), F.col("u.high").alias("high"))
    sums = work.groupBy("lang", "bucket", "low", "high").applyInArrow(lambda unit: price_unit(unit, size), PRICED).groupBy("lang", "g", "h").agg(F.sum("seen").alias("seen"), F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "seen", "value"))
    a = groups.select("lang", "g", "source", "v", F.when(F.col("v") > 0, zero).alias("p0"))
    b = groups.select("lang", F.col("g").alias("h"), F.col("source").alias("item"), F.when(F.col("v") > 0, zero).alias("q0"))
    # Terms of a language that a unit's groups all lack were not seen there.
    unseen = F.coalesce((F.col("v") - F.coalesce("seen", F.lit(0))) * F.abs(F.col("p0") - F.col("q0")), F.lit(0))
    all_pairs = a.join(b, "lang").where("g <> h").join(both, ["lang", "g", "h"], "left")
    return all_pairs.select("lang", "source", F.lit("pair").alias("part"), "item", (F.coalesce("value", F.lit(0)) + unseen).alias("value"))
