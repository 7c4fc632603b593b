"""Document fingerprints by order MinHash.

A text's k-mers (k words in a row; a shorter text is one k-mer) are numbered by occurrence, so that
repeats count. For each of ``tuples`` permutations of the hashes of numbered k-mers, the two minimal
ones are selected, put back into the order they have in the text, and hashed as an ordered tuple:
the signature, which changes when text is moved about even where the set of k-mers stays. (A text of
one k-mer has tuples of one.) The likeness of two fingerprints is the share of equal signatures.

Only DataFrame operations: k-mers are made by array functions; texts in which one repeats are
numbered by a window, all others need none; one hash aggregation finds the minima of all
permutations and a second one, over the same rows, the minima beyond them. Texts are dealt out
once, by range of their order; k-mers are numbered, joined and aggregated in the task that holds
their text, and never moved.

Defined results: null, empty and wordless texts have no signatures; two fingerprints without
signatures have likeness 1, one without and one with have 0; equal texts have equal fingerprints;
repeated rows each get a result and are each other's neighbours; a null id comes before all others;
the next document of the only one is itself; empty tables give empty results; further columns are
ignored. Ids that are no whole numbers are ordered by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundcheck.llm.common import setting, stored
from groundcheck.llm.sharding import range_cuts, range_index

SPACES = r"[\x20\x09-\x0D]+"
#: Selected k-mers of a tuple.
SELECTED = 2
POSITION_BITS = 31  # no array has more places
BYTES_PER_PARTITION = 4 << 20


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def kmers(text: Column, k: int) -> Column:
    """Hashes of the k-mers of a text, in order; none if it has no words."""
    return F.transform(F.array(split_words(text)), lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(F.size(w) <= k, F.array(F.xxhash64(w))).otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[w[i + j] for j in range(k)]))))[0]


def permutation(i: int) -> int:
    """A constant for the i-th permutation: a hash is combined with it and mixed again."""
    h = (i + 1) * 0x9E3779B97F4A7C15 % 2**64
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ h >> shift) * times % 2**64
    h ^= h >> 31
    return h - 2**64 if h >> 63 else h


def ranks(tuples: int) -> list[Column]:
    """For every permutation the upper half of the mixed hash above the k-mer's place: smaller
    places win the (rare) ties of 32 bits."""
    mixed = lambda i: F.xxhash64(F.col("h").bitwiseXOR(F.lit(permutation(i)).cast("long")))
    return [F.shiftleft(F.shiftrightunsigned(mixed(i), 32), POSITION_BITS).bitwiseOR(F.col("pos").cast("long")) for i in range(tuples)]


def numbered(texts: DataFrame, keys: list[str], carried: list[str], k: int) -> DataFrame:
    """``keys, carried, pos, h``: every k-mer's place and the hash of the k-mer with the number of its occurrence."""
    own = [*keys, *carried]
    # Exploded from an array of one, as filters on a plain column would each make the k-mers anew.
    made = texts.select(*own, F.explode(F.array(kmers(F.col("text"), k))).alias("kmers"))
    repeats = F.size(F.array_distinct("kmers")) < F.size("kmers")
    plain = made.where(~repeats).select(*own, F.posexplode("kmers").alias("pos", "kmer"))
    rows = made.where(repeats).select(*own, F.posexplode("kmers").alias("pos", "kmer"))
    # Sorting by one mixed key first settles nearly all comparisons by its eight bytes.
    rows = rows.withColumn("mixed", F.xxhash64(*keys, "kmer"))
    nth = F.row_number().over(Window.partitionBy("mixed", *keys, "kmer").orderBy("pos"))
    counted = rows.select(*own, "pos", F.xxhash64("kmer", nth).alias("h"))
    return plain.select(*own, "pos", F.xxhash64("kmer", F.lit(1)).alias("h")).unionByName(counted)


def signatures(texts: DataFrame, keys: list[str], carried: list[str], k: int = 3, tuples: int = 32) -> DataFrame:
    """``keys, carried, fp`` of every text (columns ``keys, carried, text``) that has words: ``fp``
    has a signature for each permutation. ``keys`` tell rows apart; ``texts`` is partitioned by the
    first of them. Write it under ``dealt_once``, so that joins do not deal the texts out anew by
    all keys. ``carried`` columns go with their text through both passes: where the caller reads
    them too, all passes ask for the same columns and so share one deal of the texts."""
    v = ranks(tuples)
    own = [*keys, *carried]
    first = numbered(texts, keys, carried, k).groupBy(*own).agg(*[F.min(v[i]).alias(f"a{i}") for i in range(tuples)])
    least = first.select(*keys, F.array(*[F.col(f"a{i}") for i in range(tuples)]).alias("least"))
    # One row for each text, met by hashing: rows of k-mers need no order, and carry no minima through a sort.
    again = numbered(texts, keys, carried, k).join(least.hint("shuffle_hash"), keys)
    minima = [F.min(v[i]).alias(f"a{i}") for i in range(tuples)]
    beyond = [F.min(F.when(v[i] > F.col("least")[i], v[i])).alias(f"b{i}") for i in range(tuples)]
    found = again.groupBy(*own).agg(*minima, *beyond)
    place = lambda x: x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    rank = lambda x: F.shiftright(x, POSITION_BITS)

    def signature(a: Column, b: Column) -> Column:
        """Ranks name their k-mers: those of two texts are equal where the k-mers are."""
        ordered = F.when(b.isNull(), F.xxhash64(rank(a))).when(place(a) < place(b), F.xxhash64(rank(a), rank(b))).otherwise(F.xxhash64(rank(b), rank(a)))
        return F.shiftrightunsigned(ordered, 32)

    return found.select(*own, F.array(*[signature(F.col(f"a{i}"), F.col(f"b{i}")) for i in range(tuples)]).alias("fp"))


def dealt_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored; its joins may use a partitioning by some of their keys."""
    with setting(df.sparkSession, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        return stored(df, name)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures; 1 if neither has any, 0 if one has none."""
    same = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: x["a"] == x["b"]))
    longer = F.greatest(F.size(a), F.size(b))
    return F.when(longer == 0, 1.0).otherwise(same / longer)


def as_text(fp: Column) -> Column:
    """Eight hexadecimal digits for each signature."""
    return F.array_join(F.transform(fp, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))), "")


def order_key(docs: DataFrame, id_col: str, text: Column) -> tuple[Column, Column]:
    """``h, tie``: rows go by their id, a null one first, and then by a hash of their text. Whole
    numbers are ordered as numbers, all other ids by their text."""
    found, tie = F.col(id_col), F.hex(F.xxhash64(text))
    if dict(docs.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
        return F.coalesce(found.cast("long"), F.lit(-(1 << 63))).alias("h"), tie.alias("tie")
    named = F.concat(F.coalesce(found.cast("string"), F.lit("")), F.lit("\0"), tie)
    return F.when(found.isNull(), -1).otherwise(0).cast("long").alias("h"), named.alias("tie")


def in_order(docs: DataFrame, id_col: str, text_col: str, per_range: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``range, nth, id, text`` by ascending id, ranges partitioned, and for every range the
    key of the row before its first one (around the whole: the last row)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), *order_key(docs, id_col, text), text.alias("text"))
    keys = stored(rows.select("h", "tie", F.octet_length("text").cast("long").alias("bytes"), F.lit(1).cast("long").alias("weight")), "order-keys")
    cuts = range_cuts(keys, "weight", per_range)
    total = keys.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    placed = rows.withColumn("range", range_index(F.col("h"), F.col("tie"), cuts))
    wide = max(64, int(total) // BYTES_PER_PARTITION)
    dealt = placed.repartition(min(wide, max(1, len(cuts) + 1)), "range")
    ordered = dealt.withColumn("nth", F.row_number().over(Window.partitionBy("range").orderBy("h", "tie")))
    last = keys.withColumn("range", range_index(F.col("h"), F.col("tie"), cuts)).groupBy("range").agg(F.max(F.struct("h", "tie")).alias("last"))
    # One row for each range, by far fewer than the texts.
    around = Window.orderBy("range")
    edges = last.select("range", F.coalesce(F.lag("last").over(around), F.max("last").over(Window.partitionBy())).alias("e")).select("range", F.col("e.h").alias("h"), F.col("e.tie").alias("tie"))
    return ordered, edges


def with_next(docs: DataFrame, id_col: str, text_col: str, per_range: int = 1000) -> DataFrame:
    """``range, nth, id, text, next_text``: the next row is the one with the next smaller id; the
    largest follows the smallest."""
    ordered, edges = in_order(docs, id_col, text_col, per_range)
    edges = stored(edges, "order-edges")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*order_key(docs, id_col, text), text.alias("edge_text"))
    wanted = edges.select("h", "tie").distinct()
    found = rows.join(F.broadcast(wanted), ["h", "tie"], "left_semi").dropDuplicates(["h", "tie"])
    edge_texts = stored(edges.join(found, ["h", "tie"]).select("range", "edge_text"), "order-edge-texts")
    before = F.lag("text").over(Window.partitionBy("range").orderBy("nth"))
    stepped = ordered.withColumn("before", before)
    return stepped.join(edge_texts, "range").select("range", "nth", "id", "text", F.when(F.col("nth") == 1, F.col("edge_text")).otherwise(F.col("before")).alias("next_text"))


def edited(text: Column, other: Column) -> Column:
    """The text whose second half, rounded down, gives way to as many first code points of the other."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.char_length(text) - half), F.substr(other, F.lit(1), half))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, tuples: int = 32) -> DataFrame:
    """``id, fingerprint`` (an array of signatures) of every row."""
    ordered, _ = in_order(docs, id_col, text_col, 1000)
    found = signatures(ordered.select("range", "nth", "id", "text"), ["range", "nth"], ["id"], k, tuples).drop("id")
    rows = dealt_once(ordered.select("range", "nth", "id", F.octet_length("text").alias("bytes")).join(found, ["range", "nth"], "left"), "order-prints")
    none = F.array().cast("array<bigint>")
    return rows.select("id", F.coalesce("fp", none).alias("fingerprint"))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, tuples: int = 32) -> DataFrame:
    """For every row its fingerprint, that of its edited text, and how like it is to that and to
    the next row's fingerprint."""
    base = with_next(docs, id_col, text_col).select("range", "nth", "id", "text", edited(F.col("text"), F.col("next_text")).alias("edited"))
    pairs = base.select("range", "nth", "id", F.explode(F.array(F.struct(F.lit(0).alias("which"), "text"), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("t"))
    texts = pairs.select("range", "nth", "id", "t.which", "t.text")
    prints = signatures(texts, ["range", "nth", "which"], ["id"], k, tuples).groupBy("range", "nth")
    prints = prints.agg(*[F.first(F.when(F.col("which") == which, F.col("fp")), ignorenulls=True).alias(name) for which, name in enumerate("ab")])
    none = F.array().cast("array<bigint>")
    facts = base.select("range", "nth", "id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    # Facts and signatures ask for the same columns and come from the same deal of the texts.
    told = facts.join(prints, ["range", "nth"], "left").withColumns({c: F.coalesce(c, none) for c in "ab"})
    rows = dealt_once(told, "order-rows")
    last = rows.groupBy("range").agg(F.max_by("a", "nth").alias("a"))
    around = Window.orderBy("range")
    edges = last.select("range", F.coalesce(F.lag("a").over(around), F.max_by("a", "range").over(Window.partitionBy())).alias("edge"))
    stepped = rows.withColumn("before", F.lag("a").over(Window.partitionBy("range").orderBy("nth"))).join(F.broadcast(edges), "range")
    following = F.when(F.col("nth") == 1, F.col("edge")).otherwise(F.col("before"))
    return stepped.select("id", "n_chars", "edited_sha256", F.col("a").alias("fingerprint"), F.col("b").alias("edited_fingerprint"), likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), following).alias("near_next"))
