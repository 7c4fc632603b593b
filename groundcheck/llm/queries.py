"""Thin queries over the driver tables: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundcheck.llm import decontam, divergence, kneserney, langid, orderminhash, quality, sentencepieces, sharding, simhash, tokencount, toxicity, urlfilter, vocabulary, whitening
from groundcheck.llm.common import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by benchmark windows of 13 words."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"), "contaminated")


QUERIES["op1_decontamination"] = op1_decontamination
ORACLES["op1_decontamination"] = r"""
WITH w AS (
  SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS words
  FROM documents),
b AS (
  SELECT item_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS words
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, len, array_to_string(list_slice(words, s + 1, s + len), ' ') AS win
  FROM (SELECT item_id, words, least(13, len(words)) AS len, unnest(range(0, len(words) - least(13, len(words)) + 1)) AS s FROM b WHERE len(words) > 0)),
lens AS (SELECT DISTINCT len FROM bw),
dw AS (
  SELECT doc_id, len, s, array_to_string(list_slice(words, s + 1, s + len), ' ') AS win
  FROM (SELECT doc_id, words, len, unnest(range(0, len(words) - len + 1)) AS s FROM w, lens WHERE len(words) >= len)),
m AS (SELECT dw.doc_id, dw.s, dw.len, bw.item_id FROM dw JOIN bw ON dw.len = bw.len AND dw.win = bw.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + len)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM m) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.words) AS contaminated
FROM w LEFT JOIN hit ON w.doc_id = hit.doc_id LEFT JOIN it ON w.doc_id = it.doc_id
"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


QUERIES["op9_simhash"] = op9_simhash


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows of folds 0, 1 and 3."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(fold(F.col("doc_id"), 4) != 2))
    found = langid.identify(docs, model)
    return found.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 4) == 2).alias("held_out"), "lang_pred", "score")


QUERIES["op2_language_id"] = op2_language_id


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the rows of folds 0, 1 and 3."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = fold(F.col("doc_id"), 4) != 2
    model = toxicity.train(docs.where(learned), labels.where(learned))
    found = toxicity.score_texts(docs, model)
    return found.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 4) == 2).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


QUERIES["op6_toxicity"] = op6_toxicity


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under a model of those outside fold 2 of 7."""
    docs = table(spark, sf_dir, "documents")
    model = kneserney.train(docs.where(fold(F.col("doc_id"), 7) != 2), order=3)
    found = kneserney.score_texts(docs, model)
    return found.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


QUERIES["op7_lm_scoring"] = op7_lm_scoring

#: Where the public tokenizers' vocabulary files lie; a parameter, never copied here.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
PIECES = "piece_bpe_32k.model"


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document: their number, a digest of their ids, and the round trip."""
    found = sentencepieces.encode(table(spark, sf_dir, "documents"), vocabulary.load(f"{TOKENIZERS}/{PIECES}"), check=True)
    digest = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    return found.select(F.col("id").alias("doc_id"), F.col("n_pieces").cast("long").alias("n_pieces"), digest.alias("ids_sha256"), "round_trip")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token count of every document, with the vocabulary's scores."""
    found = tokencount.token_counts(table(spark, sf_dir, "documents"), vocabulary.load(f"{TOKENIZERS}/{PIECES}"))
    return found.select(F.col("id").alias("doc_id"), "n_tokens", "score")


QUERIES["op3_sentencepiece"] = op3_sentencepiece
QUERIES["op8_token_counts"] = op8_token_counts


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards of nearly equal bytes."""
    found = sharding.shard(table(spark, sf_dir, "documents"), 16, "bytes")
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES["op4_sharding"] = op4_sharding


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    found = orderminhash.edited_likeness(table(spark, sf_dir, "documents"))
    shown = {c: orderminhash.as_text(F.col(c)) for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(shown).withColumnRenamed("id", "doc_id")


QUERIES["op10_order_minhash"] = op10_order_minhash

RULES = [urlfilter.Rule("block", "net", "/"), urlfilter.Rule("allow", "example.net", "/en/"), urlfilter.Rule("block", "example.com", "/de/"), urlfilter.Rule("allow", "org", "/fr/")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page, by rule or by the host's and path's words."""
    pages = table(spark, sf_dir, "pages")
    found = urlfilter.judge(pages, RULES, urlfilter.train(pages))
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


QUERIES["op5_url_filter"] = op5_url_filter


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts, base rule and verdict on the quality of every document."""
    found = quality.judge(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


QUERIES["op11_quality_rules"] = op11_quality_rules


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between a language's sources, and the terms that a source has more of."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES["op12_source_divergence"] = op12_source_divergence
ORACLES["op12_source_divergence"] = r"""
WITH w AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    unnest([x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x40\x5B-\x60\x7B-\x7F]+') if x <> '']) AS term
  FROM documents),
kept AS (SELECT lang, term, count(*) AS n_all FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
g AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
cnt AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept ON w.lang = kept.lang AND w.term = kept.term GROUP BY ALL),
tot AS (SELECT lang, source, sum(n) AS total FROM cnt GROUP BY ALL),
lg AS (SELECT lang, count(*) AS v, sum(n_all) AS total FROM kept GROUP BY lang),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(cnt.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(cnt.n, 0) + 5) // (coalesce(tot.total, 0) + 5 * lg.v) AS p,
    1 + 1000000000::HUGEINT * (kept.n_all + 5) // (lg.total + 5 * lg.v) AS q
  FROM g JOIN kept ON g.lang = kept.lang JOIN lg ON g.lang = lg.lang
    LEFT JOIN tot ON g.lang = tot.lang AND g.source = tot.source
    LEFT JOIN cnt ON g.lang = cnt.lang AND g.source = cnt.source AND kept.term = cnt.term),
d AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN d ON a.lang = d.lang AND a.source = d.source AND b.source = d.item
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 50
"""


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every embedding."""
    return whitening.whitened_embeddings(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES["op13_embedding_whitening"] = op13_embedding_whitening
