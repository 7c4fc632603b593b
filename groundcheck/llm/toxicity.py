"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other text is unlabelled, not clean. A linear
classifier over the presence of words is fitted with numpy to the risk
``prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)])`` with the logistic loss; while the
second part lies below zero, a step goes against it, so that the classifier can't profit from
fitting the unlabelled texts as negatives. The class prior is the toxic share of the labelled rows.

The fit sees about ``positives`` confirmed texts, and about ``unlabelled`` of all labelled rows, whose
labels are not read there; both are drawn by a hash of the id: documented bounds on labelled rows,
whatever the table's size. Where labels tell of toxic texts alone, all texts serve as unlabelled.
Its words are those that ``least_texts`` confirmed texts hold, as fewer tell nothing of a word, and
whose shares in the two samples differ by ``z`` standard errors. Every text is scored whole, long ones
slice by slice.

Defined results: a null or empty text has no words and gets the score of the bias alone; without a
confirmed toxic text every score is that of log odds of -5, 0.0067; a row with several labels counts as toxic if one of
them says so; null labels and null ids confirm nothing; repeated rows are scored alike; empty
tables give empty results; further columns are kept or ignored, never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundcheck.llm.common import MARKS, counted_small, lowered, pieces, span_hashes, text_column, text_slices, utf8, word_spans


@dataclass
class Model:
    #: Sorted hashes of the words, the weight of each, and the bias.
    words: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        owner, found = word_hits(data, at, self.words)
        margin = np.bincount(owner, weights=self.weights[found], minlength=len(at) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def hashed_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = lowered(data)
    starts, ends, counts = word_spans(data, at, MARKS)
    return span_hashes(data, starts, ends), np.repeat(np.arange(len(counts)), counts)


def distinct_words(data: np.ndarray) -> np.ndarray:
    """Sorted distinct word hashes of one text, of any length."""
    parts = [np.unique(hashed_words(part, np.array([0, len(part)]))[0]) for part in text_slices(data, MARKS)]
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def word_hits(data: np.ndarray, at: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and word index of every model word that a text holds, once each."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(at) == 2:
        found = distinct_words(data)
        place = np.minimum(np.searchsorted(words, found), len(words) - 1)
        return np.zeros(int((words[place] == found).sum()), np.int64), place[words[place] == found]
    hashes, owner = hashed_words(data, at)
    place = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    hit = words[place] == hashes
    pair = np.unique(owner[hit] * len(words) + place[hit])
    return pair // len(words), pair % len(words)


@dataclass
class Presence:
    """Which words each text of a sample holds: only the places that are set."""

    row: np.ndarray
    word: np.ndarray
    texts: int
    words: int

    def margins(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=weights[self.word], minlength=self.texts)

    def by_word(self, of_text: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=of_text[self.row], minlength=self.words)


def nnpu_fit(x: Presence, n: int, prior: float, steps: int = 400, rate: float = 0.1, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias that lower the non-negative risk, by full-batch Adam steps; the first ``n``
    texts are the positives."""
    w = np.zeros(x.words + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        margin = x.margins(w[:-1]) + w[-1]
        chance = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        loss_negative = np.logaddexp(0, margin)
        negative_risk = loss_negative[n:].mean() - prior * loss_negative[:n].mean()
        pull = np.empty(x.texts)  # derivative of the risk by each margin
        if negative_risk >= 0:
            pull[:n] = prior * (chance[:n] - 1) / n - prior * chance[:n] / n
            pull[n:] = chance[n:] / (x.texts - n)
        else:
            pull[:n] = prior * chance[:n] / n
            pull[n:] = -chance[n:] / (x.texts - n)
        gradient = np.append(x.by_word(pull), pull.sum())
        gradient[:-1] += decay * w[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def _word_sets(df: DataFrame) -> list[np.ndarray]:
    """Distinct word hashes of each text of a bounded sample, in an order that does not depend on
    how the rows came."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                data, at = utf8(text_column(part, "text"))
                sets = [distinct_words(data[a:b]).tobytes() for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(sets, pa.binary())], ["words"])

    found = sorted(df.select("text").mapInArrow(run, "words binary").toArrow().column("words").to_pylist())
    return [np.frombuffer(x, np.uint64) for x in found]


def _presence(sets: list[np.ndarray], words: np.ndarray) -> Presence:
    rows, places = [], []
    for i, held in enumerate(sets):
        place = np.minimum(np.searchsorted(words, held), len(words) - 1)
        place = place[words[place] == held]
        rows.append(np.full(len(place), i, np.int32))
        places.append(place.astype(np.int32))
    return Presence(np.concatenate(rows), np.concatenate(places), len(sets), len(words))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", positives: int = 3000, unlabelled: int = 9000, z: float = 4.0, least_texts: int = 3) -> Model:
    """A classifier from ``docs`` and the labels of their ids; held-out rows must be left out of
    both by the caller."""
    told = labels.where(F.col(toxic_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(toxic_col).alias("toxic"))
    labelled, toxic = told.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("toxic") == 1, 1)), F.lit(0))).first()
    if not labelled or not toxic:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -5.0)
    prior = min(max(toxic / labelled, 1e-4), 0.9)
    draw = lambda c: F.pmod(F.xxhash64(c.cast("string"), F.lit("toxicity sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    confirmed = told.where("toxic = 1")
    chosen = confirmed.where(draw(F.col("id")) * F.lit(float(toxic)) < positives).select("id")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    other = lambda c: draw(F.concat(F.lit("u"), F.coalesce(c.cast("string"), F.lit(""))))

    def drawn(ids: DataFrame, name: str) -> DataFrame:
        """Rows with these ids; the ids are few, as drawn, and counted before they are sent to all tasks."""
        few = counted_small(ids, name)
        return rows.join(ids if few is None else few, "id", "left_semi")

    p = _word_sets(drawn(chosen, "confirmed"))
    if toxic < labelled:
        mixed = told.where(other(F.col("id")) * F.lit(float(labelled)) < unlabelled).select("id")
        u = _word_sets(drawn(mixed, "unlabelled"))
    else:
        u = _word_sets(rows.where(other(F.col("id")) * F.lit(float(rows.count())) < unlabelled))
    if not p or not u:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    words, count = np.unique(np.concatenate(p), return_counts=True)
    words, count = words[count >= least_texts], count[count >= least_texts]
    in_u = np.zeros(len(words))
    for held in u:
        place = np.minimum(np.searchsorted(words, held), max(len(words) - 1, 0))
        if len(words):
            in_u[place[words[place] == held]] += 1
    share = (in_u + 0.5) / (len(u) + 1)
    apart = np.abs(count / len(p) - share) / np.sqrt(share * (1 - share) * (1 / len(p) + 1 / len(u)))
    words = words[apart >= z]
    if not len(words):
        return Model(words, np.zeros(0), float(np.log(prior / (1 - prior))))
    weights, bias = nnpu_fit(_presence(p + u, words), len(p), prior)
    return Model(words, weights, bias)


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row: the chance, 0 to 1, that its text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand words at most pass the z test
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                score = shared.value.score(*utf8(text_column(part, "text")))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score, pa.float64())], ["id", "score"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, score double")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text_col):
                yield part.filter(pa.array(shared.value.score(*utf8(text_column(part, text_col))) < threshold))

    return docs.mapInArrow(run, docs.schema)
