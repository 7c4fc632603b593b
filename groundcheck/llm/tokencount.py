"""Token counts without tokens: a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton of the vocabulary lists every piece that ends at each character of a
unit; dynamic programming carries the best score of each prefix and the number of pieces that
reach it, and no path is kept. Ties follow the tokenizer: edges relax their end in the order of
their begin and only if they raise the score, so that the longest of equal edges stays. A
character without a piece of its own is an edge with the least score of the vocabulary less 10; it
counts one token for each of its UTF-8 bytes if the vocabulary has bytes, and one if it has none.

Each distinct unit (see ``vocabulary``) is scored once in a worker; scores are doubles.

Defined results: null and empty texts have no tokens and score 0; repeated rows are counted alike;
empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundcheck.llm.common import pieces, text_column
from groundcheck.llm.vocabulary import Vocabulary, units

#: Units that a worker remembers before it begins afresh; only speed depends on it.
HELD_UNITS = 1_000_000
#: Penalty of a character without piece, below the least score: the tokenizer's constant.
UNKNOWN_PENALTY = 10.0


class Counter:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.pattern = vocabulary.pattern
        self.has_bytes = vocabulary.bytes is not None
        self.lone = min(vocabulary.scores.values()) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.known: dict[str, tuple[int, float]] = {}

    def unit(self, text: str) -> tuple[int, float]:
        """Tokens and score of one unit."""
        n = len(text)
        best = [0.0] + [None] * n
        begin = [0] * (n + 1)
        count = [0] * (n + 1)
        done = 0

        def settle(end: int) -> None:
            # Characters at which no piece of one character ends take an edge of their own, which
            # begins last of all edges to this end and so must score more than they do.
            if lone[end]:
                value = best[end - 1] + self.lone
                if best[end] is None or value > best[end]:
                    best[end] = value
                    count[end] = count[end - 1] + (len(text[end - 1].encode("utf-8", "surrogatepass")) if self.has_bytes else 1)

        lone = [True] * (n + 1)
        for last, (length, score) in self.automaton.iter(text):
            end = last + 1
            while done < last:
                done += 1
                settle(done)
            if length == 1:
                lone[end] = False
            value = best[end - length] + score
            if best[end] is None or value > best[end] or (value == best[end] and end - length < begin[end]):
                best[end], begin[end], count[end] = value, end - length, count[end - length] + 1
        while done < n:
            done += 1
            settle(done)
        return count[n], best[n]

    def text(self, text: str | None) -> tuple[int, float]:
        tokens, total = 0, 0.0
        known = self.known
        for u in units(text, self.pattern) if text else ():
            found = known.get(u)
            if found is None:
                if len(known) > HELD_UNITS:
                    known.clear()
                found = known[u] = self.unit(u)
            tokens += found[0]
            total += found[1]
        return tokens, total


_COUNTERS: dict[tuple[int, int], Counter] = {}


def _counter(vocabulary: Vocabulary) -> Counter:
    key = (vocabulary.size, hash(tuple(list(vocabulary.scores.items())[:1000])))
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(vocabulary)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, score`` of every row: tokens of the best segmentation and its score."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the tokenizer's vocabulary
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in batches:
            for part in pieces(batch, "text"):
                found = [counter.text(t) for t in text_column(part, "text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())], ["id", "n_tokens", "score"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, n_tokens long, score double")
