"""Benchmark decontamination with a distributed positional inverted index.

Training texts become postings ``(term, id, text_key, pos)``, one row for each occurrence of each
word, kept as a table in the shared folder. A search takes every window of a test item, ranks its
terms by document frequency, and intersects the offset-adjusted posting lists of the rarest ones: a
posting at position ``p`` of a term at offset ``o`` of the item says that the item would begin at
``p - o``. Where the rarest lists meet, the lists of the other terms are intersected as well, by
position; runs of consecutive offsets that reach a window's length are exact phrases. Proximity
matches keep the rarest lists' slack instead. No text is split a second time.

Everything runs as DataFrame operations. Corpus postings are never grouped by term: a stop word's
list stays spread over all partitions. Windows are sliding frames over an item's rows, so that an
item's words are never copied for each window. Keys that hold many rows, such as frequent terms or
a passage that many documents share, are dealt over several tasks where they are joined.

Defined results: a null or wordless text has no words and is never hit; an item with a null text,
a null id or no words has no window; repeated document rows each get their own result row;
repeated items count once, items that share an id or a text are kept apart and reported by id;
empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundcheck.llm.common import join_spread, lower_ascii, stored

#: Everything in ASCII that is neither a digit nor a letter separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of a table of narrow rows up to which it is sent to every executor; beyond it keys are joined by shuffles.
BROADCAST_ROWS = 200_000

DOC = ["id", "text_key"]


def split_words(text: Column) -> Column:
    """Words of the lower-cased text; the first and the last may be empty."""
    return F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)


def join_checked(left: DataFrame, right: DataFrame, on: list[str], spread_by: list[str], how: str = "inner") -> DataFrame:
    """``right`` (a stored table) is broadcast if it is counted to be small, else keys are joined by
    shuffles, frequent ones dealt out."""
    if right.count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), on, how)
    return join_spread(left, right, on, spread_by, how)


def build_index(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The stored postings ``term, id, text_key, pos`` of every word of every text. ``text_key``
    tells apart rows that share an id; equal rows give equal postings."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.posexplode(split_words(F.col(text_col))).alias("pos", "word"))
    return stored(rows.where("word <> ''").select(F.xxhash64("word").alias("term"), *DOC, "pos"), "postings")


def item_terms(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``item_key, n, pos, term`` of every distinct item text, and ``item_key, item`` of every item."""
    known = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), F.filter(split_words(F.col(text_col)), lambda w: w != "").alias("words")).where(F.size("words") > 0)
    known = known.withColumn("item_key", F.xxhash64("words", F.size("words")))
    names = stored(known.select("item_key", "item").distinct(), "items")
    texts = known.dropDuplicates(["item_key"]).select("item_key", F.size("words").alias("n"), F.posexplode("words").alias("pos", "word"))
    return stored(texts.select("item_key", "n", "pos", F.xxhash64("word").alias("term")), "item-terms"), names


def term_frequency(index: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, df`` of every term of the items: postings summed before the shuffle. A term's
    occurrences within a document count each, which ranks terms alike."""
    wanted = stored(terms.select("term").distinct(), "vocabulary")
    found = join_checked(index.select("term", *DOC, "pos"), wanted, ["term"], [*DOC, "pos"], "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return stored(wanted.join(found, "term", "left").select("term", F.coalesce("df", F.lit(0)).alias("df")), "frequency")


def rarest(terms: DataFrame, frequency: DataFrame, width: int, lists: int) -> DataFrame:
    """``item_key, n, start, rare`` for every window that can occur: the ``lists`` rarest
    ``(df, pos, term)`` of its terms. A frame slides over the item's rows, so that a window holds
    ``width`` narrow entries and no text."""
    ranked = join_checked(terms, frequency, ["term"], ["item_key", "pos"])
    frame = Window.partitionBy("item_key").orderBy("pos").rowsBetween(0, width - 1)
    entry = F.struct("df", "pos", "term")
    windows = ranked.select("item_key", "n", F.col("pos").alias("start"), F.slice(F.array_sort(F.collect_list(entry).over(frame)), 1, lists).alias("rare"))
    whole = F.col("start") <= F.greatest(F.col("n") - width, F.lit(0))
    return windows.where(whole & (F.get("rare", F.lit(0))["df"] > 0))


def laid_out(index: DataFrame, windows: DataFrame) -> DataFrame:
    """``id, text_key, item_key, begin, first, last``: where an item may lie in a document, and the
    offsets that the windows in question span. Neighbouring windows share their rarest terms and
    are taken together."""
    offsets = F.transform("rare", lambda r: r["pos"])
    groups = windows.groupBy("item_key", offsets.alias("need")).agg(F.first("rare").alias("rare"), F.min("start").alias("first"), (F.max("start") + F.max("length")).alias("end"))
    groups = groups.select("item_key", "need", F.xxhash64("need").alias("set"), F.size("need").alias("lists"), "rare", "first", "end")
    anchors = stored(groups.select("item_key", "set", "lists", "first", "end", F.explode("rare").alias("r")).select("item_key", "set", "lists", "first", "end", F.col("r.term").alias("term"), F.col("r.pos").alias("offset")), "anchors")
    found = join_checked(index, anchors, ["term"], [*DOC, "pos"])
    met = found.withColumn("begin", F.col("pos") - F.col("offset")).groupBy(*DOC, "item_key", "begin", "set")
    met = met.agg(F.count_distinct("offset").alias("seen"), F.first("lists").alias("lists"), F.first("first").alias("first"), F.first("end").alias("end"))
    return met.where("seen = lists").select(*DOC, "item_key", "begin", "first", "end")


def exact_matches(index: DataFrame, terms: DataFrame, width: int = 13, lists: int = 2) -> DataFrame:
    """``id, text_key, item_key, begin, first, last``: runs of an item's words, ``first`` to ``last``
    (positions within the item), that stand in the document at ``begin + first`` and are as long as
    a window: ``width`` words, or the whole of a shorter item. Positions count from 0 with an empty
    first word, if the text begins with a separator."""
    windows = rarest(terms, term_frequency(index, terms), width, lists).withColumn("length", F.least(F.lit(width), F.col("n")))
    laid = stored(laid_out(index, stored(windows, "windows")), "laid")
    wanted = laid.select(*DOC, "item_key", "begin", F.explode(F.sequence("first", F.col("end") - 1)).alias("offset")).distinct()
    told = terms.select("item_key", "n", F.col("pos").alias("offset"), "term")
    wanted = join_checked(wanted, told, ["item_key", "offset"], [*DOC, "begin"]).withColumn("pos", F.col("begin") + F.col("offset"))
    wanted = stored(wanted, "wanted")
    # Only postings of documents in question are moved, told by keys of a few bytes.
    keys = stored(laid.select("text_key").distinct(), "keys")
    near = join_checked(index, keys, ["text_key"], [*DOC, "pos"], "left_semi")
    same = (near["term"] == wanted["term"]) & (near["text_key"] == wanted["text_key"]) & (near["pos"] == wanted["pos"]) & near["id"].eqNullSafe(wanted["id"])
    there = wanted.join(near.select("term", *DOC, "pos"), same, "left_semi")
    order = Window.partitionBy(*DOC, "item_key", "begin").orderBy("offset")
    runs = there.withColumn("run", F.col("offset") - F.row_number().over(order)).groupBy(*DOC, "item_key", "begin", "run")
    found = runs.agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.first("n").alias("n"))
    return stored(found.where(F.col("last") - F.col("first") + 1 >= F.least(F.lit(width), F.col("n"))).drop("run", "n"), "matches")


def proximity_matches(index: DataFrame, terms: DataFrame, names: DataFrame, width: int = 13, lists: int = 4, slack: int = 3) -> DataFrame:
    """``id, item, start, begin``: windows of items whose ``lists`` rarest terms stand within
    ``slack`` words of their places, in any document of the index. Offset-adjusted positions are
    dealt into cells of ``slack + 1`` words, each also into the next one, so that lists that differ
    by no more than the slack meet in a cell; no pair of postings is built.

    Defined results: as for the module; items that share an id are matched apart, and repeated
    documents are reported once."""
    chosen = stored(rarest(terms, term_frequency(index, terms), width, lists), "rarest")
    wanted = chosen.select("item_key", "start", F.size("rare").alias("terms"), F.explode("rare").alias("r"))
    wanted = stored(wanted.select("item_key", "start", "terms", F.col("r.term").alias("term"), F.col("r.pos").alias("offset")), "anchors")
    found = join_checked(index, wanted, ["term"], [*DOC, "pos"]).withColumn("begin", F.col("pos") - F.col("offset") + F.col("start"))
    cell = F.floor(F.col("begin") / F.lit(slack + 1))
    dealt = found.withColumn("cell", F.explode(F.array(cell, cell + 1)))
    near = dealt.groupBy(*DOC, "item_key", "start", "cell").agg(F.first("terms").alias("terms"), F.collect_set(F.struct("begin", "offset")).alias("at"))
    begins = F.array_sort(F.array_distinct(F.transform("at", lambda a: a["begin"])))
    fits = F.filter(begins, lambda b: F.size(F.array_distinct(F.transform(F.filter("at", lambda a: (a["begin"] >= b) & (a["begin"] <= b + slack)), lambda a: a["offset"]))) == F.col("terms"))
    hits = near.select("id", "text_key", "item_key", "start", F.explode(fits).alias("begin")).distinct()
    return hits.join(names, "item_key").select("id", "item", "start", "begin").distinct()


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 13, words_per_hit: int = 20, with_key: bool = False) -> DataFrame:
    """``id, n_words, n_hit, n_items, items, contaminated`` for every document row: a word inside
    an occurring window is hit; a document is contaminated if it has one hit for every
    ``words_per_hit`` words at least."""
    index = build_index(docs, id_col, text_col)
    terms, names = item_terms(items, item_id, item_text)
    found = exact_matches(index, terms, width)
    places = found.select(*DOC, F.explode(F.sequence(F.col("begin") + F.col("first"), F.col("begin") + F.col("last"))).alias("pos")).distinct()
    hits = places.groupBy(*DOC).agg(F.count(F.lit(1)).alias("n_hit"))
    listed = join_checked(found.select(*DOC, "item_key").distinct(), names, ["item_key"], DOC).groupBy(*DOC).agg(F.collect_set("item").alias("items"))
    # A text's words lie without gaps; equal rows have equal postings.
    sizes = index.groupBy(*DOC).agg((F.max("pos") - F.min("pos") + 1).cast("long").alias("n_words"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"))
    for more in (sizes, hits, listed):
        rows = _join_rows(rows, more)
    zero = F.lit(0).cast("long")
    rows = rows.withColumns({"n_words": F.coalesce("n_words", zero), "n_hit": F.coalesce("n_hit", zero), "items": F.coalesce("items", F.array().cast(dict(listed.dtypes)["items"]))})
    dirty = (F.col("n_hit") > 0) & (F.lit(words_per_hit) * F.col("n_hit") >= F.col("n_words"))
    return rows.select("id", *(["text_key"] if with_key else []), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", dirty.alias("contaminated"))


def _join_rows(rows: DataFrame, more: DataFrame) -> DataFrame:
    """Left join by document, where null ids are equal."""
    told = more.withColumnsRenamed({"id": "more_id", "text_key": "more_key"})
    return rows.join(told, (F.col("text_key") == F.col("more_key")) & F.col("id").eqNullSafe(F.col("more_id")), "left").drop("more_id", "more_key")


def keep_uncontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns. Contaminated rows are
    told by id and text; a row with the same id and another text stays."""
    a, b = f"id_{uuid.uuid4().hex}", f"key_{uuid.uuid4().hex}"
    found = contamination(docs, items, id_col, text_col, with_key=True, **options).where("contaminated").select(F.col("id").alias(a), F.col("text_key").alias(b)).distinct()
    dirty = stored(found, "contaminated")
    return docs.join(dirty, F.col(id_col).eqNullSafe(F.col(a)) & (F.xxhash64(text_col) == F.col(b)), "left_anti")
