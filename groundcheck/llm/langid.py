"""Language identification by hierarchical discrimination with linear support vector machines.

A text is first given a language family (one-versus-rest machines), then a language within that
family by the votes of one-versus-one machines. Features are relative frequencies of hashed byte
n-grams of the lower-cased text, square-rooted, so that length does not matter. Machines are fitted
with numpy on a bounded sample of labelled rows (``per_language`` rows expected for each language,
drawn by a hash of the id); every text is scored whole.

Defined results: a null text or one without a letter gets ``und`` with score 0; so does every
text if no labelled row was given; a language without listed family forms its own; repeated rows
are scored alike; empty tables give empty results; further columns are kept or ignored, never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundcheck.llm.common import CHUNK_BYTES, counted_small, join_spread, lowered, pieces, text_column, utf8

#: Language families, by code; a parameter of ``train``.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi".split(),
    "romance": "ca es fr gl it oc pt ro".split(),
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk".split(),
    "uralic": "et fi hu".split(),
    "turkic": "az kk tr uz".split(),
    "semitic": "ar he mt".split(),
    "indic": "bn gu hi mr ne pa ur".split(),
}
UNDETERMINED = "und"
DIM_BITS = 16
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[: ord("a")] = 32  # digits, punctuation and white space all part words
_FOLD[ord("z") + 1 : 128] = 32


def frequencies(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every text its distinct features, hashed byte bigrams to tetragrams, and their values,
    whose Euclidean length is 1. N-grams that cross into the next text are left out. A text above
    a chunk is counted slice by slice, so that memory does not grow with it."""
    if len(at) == 2 and len(data) > CHUNK_BYTES:
        counts = np.zeros(1 << DIM_BITS, np.int64)
        for begin in range(0, len(data), CHUNK_BYTES):
            for order in (2, 3, 4):  # a slice's n-grams begin in it
                part = data[begin : begin + CHUNK_BYTES + order - 1]
                counts += np.bincount(hashed_grams(_FOLD[lowered(part)])[order - 2], minlength=1 << DIM_BITS)
        feature = np.flatnonzero(counts)
        yield feature, np.sqrt(counts[feature] / counts.sum())
        return
    grams = hashed_grams(_FOLD[lowered(data)])
    for begin, end in zip(at[:-1].tolist(), at[1:].tolist()):
        found = np.concatenate([g[begin : max(begin, end - order + 1)] for order, g in zip((2, 3, 4), grams)])
        if not len(found):
            yield np.zeros(0, np.int64), np.zeros(0)
            continue
        found.sort(kind="stable")
        first = np.append(np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])), len(found))
        yield found[first[:-1]].astype(np.int64), np.sqrt(np.diff(first) / len(found))


def hashed_grams(code: np.ndarray) -> list[np.ndarray]:
    """Features of all bigrams, trigrams and tetragrams of folded bytes, by where they begin."""
    grams, gram = [], code
    for order in (2, 3, 4):
        gram = (gram[:-1] << np.uint32(8)) | code[order - 1 :] if len(gram) > 1 else gram[:0]
        key = (gram ^ np.uint32(order * 0x1F123BB5)) * np.uint32(0x9E3779B1)
        grams.append((key >> np.uint32(32 - DIM_BITS)).astype(np.uint16))
    return grams


@dataclass
class Model:
    families: list[str]
    languages: list[str]
    #: One column per machine: families first, then pairs of languages; the last row is the bias.
    weights: np.ndarray
    pairs: list[tuple[int, int]]
    family_of: list[int]
    scale: float

    def predict(self, data: np.ndarray, at: np.ndarray, lettered: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and the margin of the family's machine (negative: it rejects the text)."""
        n = len(at) - 1
        if not self.languages or n == 0:
            return [UNDETERMINED] * n, np.zeros(n), np.full(n, -1.0)
        margins = np.stack([value @ self.weights[feature] for feature, value in frequencies(data, at)]) + self.weights[-1]
        nf = len(self.families)
        sure = 1 / (1 + np.exp(-np.clip(self.scale * margins, -50, 50)))
        by_family = sure[:, :nf] / np.maximum(sure[:, :nf].sum(axis=1, keepdims=True), 1e-12)
        family = by_family.argmax(axis=1)
        votes = np.zeros((n, len(self.languages)))
        belief = np.zeros((n, len(self.languages)))
        rivals = np.zeros(len(self.languages))
        for p, (a, b) in enumerate(self.pairs):
            s = sure[:, nf + p]
            votes[:, a] += s >= 0.5
            votes[:, b] += s < 0.5
            belief[:, a] += s
            belief[:, b] += 1 - s
            rivals[[a, b]] += 1
        belief[:, rivals == 0] = 1.0
        belief /= np.maximum(rivals, 1)
        allowed = np.array(self.family_of)[None, :] == family[:, None]
        best = np.where(allowed, votes + belief / (len(self.languages) + 1), -1).argmax(axis=1)
        score = by_family[np.arange(n), family] * belief[np.arange(n), best]
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), lettered.tolist())]
        return names, np.where(lettered, np.clip(score, 0, 1), 0.0), margins[np.arange(n), family]


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray, epochs: int, strength: float, seed: int) -> np.ndarray:
    """Linear support vector machine: averaged stochastic subgradient steps on the hinge loss."""
    rng = np.random.default_rng(seed)
    w = np.zeros((1 << DIM_BITS) + 1)
    mean = np.zeros_like(w)
    share = {s: max(1, int((sign == s).sum())) for s in (-1, 1)}
    weight = {s: len(sign) / (2 * share[s]) for s in (-1, 1)}
    step = 0
    for epoch in range(epochs):
        rate = 1.0 / (1 + epoch)
        for i in rng.permutation(len(rows)):
            feature, value = rows[i]
            if sign[i] * (w[feature] @ value + w[-1]) < 1:
                move = rate * weight[int(sign[i])] * sign[i]
                w[feature] += move * value
                w[-1] += 0.1 * move
            step += 1
        w *= 1 - strength
        mean += w
    return mean / epochs


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language, by a hash of the id: a bound on the sample,
    whatever the size of the table."""
    known = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    few = counted_small(counts, "languages")
    # Texts of one language must never meet in one task.
    told = join_spread(known, counts, ["lang"], ["id"]) if few is None else known.join(few, "lang")
    draw = F.pmod(F.xxhash64("id", F.lit("language sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return told.where(draw * F.col("n") < per_language).select("text", "lang")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", families: dict[str, list[str]] | None = None, per_language: int = 400, epochs: int = 12, strength: float = 0.02) -> Model:
    """Machines fitted on a sample of ``docs``; rows held out must be left out by the caller."""

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                data, at = utf8(text_column(part, "text"))
                found = list(frequencies(data, at))
                feature = pa.array([f.astype(np.uint16).tobytes() for f, _ in found], pa.binary())
                value = pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary())
                yield pa.RecordBatch.from_arrays([text_column(part, "lang"), feature, value], ["lang", "feature", "value"])

    sample = labelled_sample(docs, id_col, text_col, lang_col, per_language).mapInArrow(featurise, "lang string, feature binary, value binary").toPandas()
    sample = sample[sample["feature"].map(len) > 0].sort_values(["lang", "feature"])
    langs = sorted(sample["lang"].unique())
    listed = {code: name for name, codes in (families or FAMILIES).items() for code in codes}
    family_name = [listed.get(code.lower().split("-")[0], f"other {code}") for code in langs]
    names = sorted(set(family_name))
    family_of = [names.index(f) for f in family_name]
    rows = [(np.frombuffer(f, np.uint16).astype(np.int64), np.frombuffer(v, np.float32).astype(np.float64)) for f, v in zip(sample["feature"], sample["value"])]
    lang = np.array([langs.index(x) for x in sample["lang"]], np.int64)
    fam = np.array(family_of, np.int64)[lang] if len(lang) else np.zeros(0, np.int64)
    columns, pairs = [], []
    for f in range(len(names)):
        columns.append(fit_machine(rows, np.where(fam == f, 1, -1), epochs, strength, f))
    for a, b in combinations(range(len(langs)), 2):
        if family_of[a] == family_of[b]:
            own = np.flatnonzero((lang == a) | (lang == b))
            columns.append(fit_machine([rows[i] for i in own], np.where(lang[own] == a, 1, -1), epochs, strength, 1000 + len(pairs)))
            pairs.append((a, b))
    weights = np.stack(columns, axis=1).astype(np.float32) if columns else np.zeros(((1 << DIM_BITS) + 1, 0), np.float32)
    return Model(names, langs, weights, pairs, family_of, scale=4.0)


def has_letter(texts: pa.Array) -> np.ndarray:
    """Whether a text holds a character of category L; fractions, circled digits and the like are none."""
    return np.array([bool(t) and any(map(str.isalpha, t)) for t in texts.to_pylist()], bool)


def predictions(part: pa.RecordBatch, text_col: str, model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    texts = text_column(part, text_col)
    data, at = utf8(texts)
    return model.predict(data, at, has_letter(texts))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by the number of languages
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                names, score, _ = predictions(part, "text", shared.value)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", languages: list[str] | None = None, least_margin: float = -1.0) -> DataFrame:
    """The rows of ``docs`` whose text has a language, one of ``languages`` if given, and whose
    family's machine does not reject it by more than ``least_margin``: a text in no language that
    was learned, or in none at all, is nearest to one of them, yet all machines reject it."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text_col):
                names, _, margins = predictions(part, text_col, shared.value)
                yield part.filter(pa.array([n != UNDETERMINED and m >= least_margin and (languages is None or n in languages) for n, m in zip(names, margins.tolist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
