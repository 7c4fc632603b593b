"""URL filters: rules first, then host word segmentation and naive Bayes.

Runs of letters in a host are split into words by a unigram Viterbi, with word frequencies counted
in Spark over a text column: a run's substrings meet the table of words in a join, and the edges of
a run are relaxed in one small step. A multinomial naive Bayes model scores the tokens of a URL:
the words of its host, and the runs of letters or digits of its path, each as often as it occurs.

No page comes with a verdict, so a page's *text* labels its URL: a page whose visible text holds a
word of ``SEEDS`` (a parameter) is an example of ``block``, every other one of ``allow``; or a label
column is given. Seed words are masked: they are no tokens, neither in training nor in scoring, so
that a URL is never judged by the words that labelled it.

All words and tokens are counted and kept in stored tables, however rare; hosts, paths and tokens
are joined to them. Keys that hold many rows are dealt over several tasks.

Defined results: a null URL, or one without ``://``, has an empty host and path and is allowed, with
null odds; ports and user names stay part of the host; a run of more than 63 letters is no label of
a host name and stays one token; digits count by their number, not their value; tokens that no page
of the training has say nothing; repeated rows count and are judged each; without any host all
pages are allowed; empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundcheck.llm.common import join_spread, lower_ascii, stored

BLOCK, ALLOW = "block", "allow"
#: Words that mark the text of an unwanted page; a parameter.
SEEDS = "ads adult bet bets betting casino escort gambling loan loans malware phish phishing pills poker porn sex slots spam torrent viagra warez xxx".split()
#: Letters that a label of a host name can have (RFC 1035); longer runs are not segmented.
LABEL = 63
RUNS = r"(\p{L}+|\p{N}+)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return lower_ascii(found)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def visible(html: Column) -> Column:
    """Lower-cased text of a page without scripts, styles and tags."""
    return F.lower(F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " "))


def holds_seed(html: Column, seeds: list[str]) -> Column:
    return visible(html).rlike(r"(?<!\p{L})(?:" + "|".join(seeds) + r")(?!\p{L})") if seeds else F.lit(False)


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """``word, n`` of every word of a text column, stored."""
    words = texts.select(F.explode(F.split(visible(F.col(text_col)), r"[^\p{L}]+")).alias("word")).where("word <> ''")
    return stored(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "url-words")


def runs_of(text: Column) -> Column:
    """Runs of letters and runs of digits, in order; digits become zeros."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(RUNS), 1), lambda r: F.regexp_replace(r, r"\p{N}", "0"))


# --- segmentation ----------------------------------------------------------------------------


def best_split(run: str, counts: dict[tuple[int, int], int], total: int) -> list[str]:
    """Words of the likeliest split. ``counts`` has the frequency of every substring (start, length)
    that is a word; any other has 10 / (total * 10 ** length). Of equal splits the one whose last
    word is longest wins."""
    best, back = [0.0] + [math.inf] * len(run), [0] * (len(run) + 1)
    whole = math.log(max(total, 1))
    for end in range(1, len(run) + 1):
        for begin in range(end):
            n = counts.get((begin, end - begin))
            cost = best[begin] + (whole - math.log(n) if n else whole + (end - begin - 1) * math.log(10))
            if cost < best[end] - 1e-9:
                best[end], back[end] = cost, begin
    words, end = [], len(run)
    while end:
        words.append(run[back[end] : end])
        end = back[end]
    return words[::-1]


def segment(runs: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """``run, tokens`` for every distinct ``run``: a stored or narrow table of runs."""
    letters = (F.length("run") <= LABEL) & F.col("run").rlike(r"^\p{L}")
    begins = runs.where(letters).select("run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("begin"))
    spans = begins.select("run", "begin", F.explode(F.sequence(F.lit(1), F.length("run") - F.col("begin") + 1)).alias("size"))
    spans = spans.select("run", "begin", "size", F.substring("run", F.col("begin"), F.col("size")).alias("word"))
    found = join_spread(spans, words, ["word"], ["run", "begin"]).groupBy("run").agg(F.collect_list(F.struct("begin", "size", "n")).alias("edges"))
    rows = runs.join(found, "run", "left").select("run", letters.alias("letters"), "edges")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                edges = {(e["begin"] - 1, e["size"]): e["n"] for e in row["edges"] or ()}
                out.append(best_split(row["run"], edges, total) if row["letters"] else [row["run"]])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], ["run", "tokens"])

    return rows.mapInArrow(split, "run string, tokens array<string>")


def host_tokens(hosts: DataFrame, words: DataFrame, total: int, seeds: list[str]) -> DataFrame:
    """``host, token``: one row for every token of every distinct host, stored; seeds are left out."""
    parts = stored(hosts.select("host", F.posexplode(runs_of(F.col("host"))).alias("pos", "run")), "host-runs")
    split = stored(segment(parts.select("run").distinct(), words, total), "host-words")
    tokens = join_spread(parts, split, ["run"], ["host", "pos"]).select("host", F.explode("tokens").alias("token"))
    return stored(tokens.where(~F.col("token").isin(*seeds)) if seeds else tokens, "host-tokens")


def path_tokens(paths: DataFrame, seeds: list[str], *kept: str) -> DataFrame:
    """``token`` and the ``kept`` columns: one row for every token of ``path``; a slash tells them
    from the host's. Seeds are left out."""
    tokens = paths.select(*kept, F.explode(runs_of(F.col("path"))).alias("token"))
    return (tokens.where(~F.col("token").isin(*seeds)) if seeds else tokens).withColumn("token", F.concat(F.lit("/"), "token"))


# --- naive Bayes -----------------------------------------------------------------------------


@dataclass
class Model:
    #: Stored tables ``word, n`` and ``token, bad, good``; they grow with the data and are joined.
    words: DataFrame
    tokens: DataFrame
    #: ``host, token`` of the hosts of the training, stored as well.
    hosts: DataFrame
    n_words: int
    #: Tokens and examples of each class.
    bad: int
    good: int
    bad_pages: int
    good_pages: int
    smoothing: float
    seeds: list[str]

    def log_ratio(self, bad: Column, good: Column) -> Column:
        """Logarithm of how much likelier a token is in ``block``. To each class come ``smoothing``
        tokens with the shares that all tokens have, so that a rare token does not speak for the
        smaller class, as it would if every kind of token came with the same weight."""
        usual = (bad + good) * (self.smoothing / max(self.bad + self.good, 1))
        return F.log((bad + usual) / (self.bad + self.smoothing)) - F.log((good + usual) / (self.good + self.smoothing))

    @property
    def prior(self) -> float:
        return math.log((self.bad_pages + 1) / (self.good_pages + 1))

    def scores(self, tokens: DataFrame, key: str) -> DataFrame:
        """``key, score``: sums over the rows ``key, token`` of each key."""
        told = join_spread(tokens, self.tokens, ["token"], [key])
        return told.groupBy(key).agg(F.sum(self.log_ratio(F.col("bad"), F.col("good"))).alias("score"))


def train(pages: DataFrame, url_col: str = "url", text_col: str = "html", seeds: list[str] | None = None, label: Column | None = None, smoothing: float = 100.0) -> Model:
    """A model from all pages' URLs and texts; ``label`` (true: block) takes the place of the seeds'
    labels. A page is one example, so that a host counts with all its pages."""
    seeds = SEEDS if seeds is None else seeds
    words = word_counts(pages, text_col)
    bad_page = F.coalesce(holds_seed(F.col(text_col), seeds) if label is None else label, F.lit(False))
    parsed = pages.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), bad_page.alias("bad_page")).where("host <> ''")
    parsed = stored(parsed, "url-pages")
    per_host = parsed.groupBy("host").agg(F.count_if("bad_page").alias("bad"), F.count_if(~F.col("bad_page")).alias("good"))
    per_host = stored(per_host, "url-hosts")
    n_words = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    split = host_tokens(per_host.select("host"), words, n_words, seeds)
    of_hosts = split.join(per_host, "host").groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    of_paths = path_tokens(parsed, seeds, "bad_page").groupBy("token").agg(F.count_if("bad_page").alias("bad"), F.count_if(~F.col("bad_page")).alias("good"))
    tokens = stored(of_hosts.unionByName(of_paths), "url-tokens")
    bad, good = tokens.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    bad_pages, good_pages = per_host.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    return Model(words, tokens, split, n_words, bad, good, bad_pages, good_pages, smoothing, seeds)


def judge(pages: DataFrame, rules: list[Rule], model: Model, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id, host, path, rule, verdict, log_odds`` of every row; a rule's verdict comes before
    the model's. Odds are rounded to nine places, so that the order of sums decides nothing."""
    parsed = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    parsed = stored(parsed, "url-parsed")
    hosts = stored(parsed.where("host <> ''").select("host").distinct(), "url-hosts")
    known = model.hosts.join(hosts, "host", "left_semi")
    new = hosts.join(model.hosts, "host", "left_anti")
    tokens = known if new.isEmpty() else known.unionByName(host_tokens(new, model.words, model.n_words, model.seeds))
    of_hosts = model.scores(tokens, "host").withColumnRenamed("score", "host_score")
    of_paths = model.scores(stored(path_tokens(parsed.where("host <> ''").select("path").distinct(), model.seeds, "path"), "path-tokens"), "path").withColumnRenamed("score", "path_score")
    scored = join_spread(parsed, stored(of_hosts, "host-scores"), ["host"], ["id", "path"], "left")
    scored = join_spread(scored, stored(of_paths, "path-scores"), ["path"], ["id", "host"], "left")
    zero = F.lit(0.0)
    odds = F.when(F.col("host") != "", F.round(F.lit(model.prior) + F.coalesce("host_score", zero) + F.coalesce("path_score", zero), 9))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = scored.select("id", "host", "path", odds.alias("log_odds"))
    return rows.select("id", "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(F.col("log_odds") > 0, BLOCK).otherwise(ALLOW)).alias("verdict"), "log_odds")
