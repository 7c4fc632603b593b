"""SentencePiece encoding and decoding by suffix-array matching.

The distinct units of a batch of texts are laid end to end and indexed by a suffix array (suffixes
ordered by as many characters as the longest piece has). Every piece is found by binary search;
its range of suffixes lists all its occurrences. The occurrences are the edges of a lattice over
character positions: they are sorted by position and relaxed from left to right, all units of the
batch at once.

For a vocabulary of merges (BPE), an edge extends the encoding of the text before it if and only
if its piece and the piece before it are what merging makes of the two together; the encoding of
every prefix has one last piece, so that relaxing needs no scores. For a unigram vocabulary an
edge relaxes its end if it raises the score; on a tie the edge that begins first stays. Units for
which the merge rule finds no or several ways are merged plainly.

Defined results: null and empty texts have no pieces; characters without piece become the pieces
of their UTF-8 bytes, or the unknown piece if the vocabulary has no bytes; a text that itself
contains the blank mark decodes to a blank there; repeated rows are encoded alike; empty tables
give empty results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundcheck.llm.common import pieces, text_column
from groundcheck.llm.vocabulary import BLANK, Vocabulary, units

#: Units and pairs of pieces that a worker remembers before it begins afresh, and units that are
#: indexed at once; only speed and memory depend on them.
HELD_UNITS = 300_000
HELD_PAIRS = 400_000
INDEXED_UNITS = 30_000
LANE = 4  # characters in a 64-bit key


def merge_plainly(text: str, scores: dict[str, float]) -> list[str]:
    """Merging itself: the neighbours whose union has the best score become one, leftmost first."""
    symbols = list(text)
    while len(symbols) > 1:
        best, at = None, -1
        for i in range(len(symbols) - 1):
            s = scores.get(symbols[i] + symbols[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        if best is None:
            break
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


class SuffixIndex:
    """Suffix array over code ranks (0: a border or a character that no piece has)."""

    def __init__(self, ranks: np.ndarray, depth: int) -> None:
        lanes = -(-depth // LANE)
        padded = np.concatenate([ranks, np.zeros(lanes * LANE, np.uint64)])
        n = len(ranks)
        keys = []
        for lane in range(lanes):
            key = np.zeros(n, np.uint64)
            for i in range(LANE):
                key = (key << np.uint64(16)) | padded[lane * LANE + i : lane * LANE + i + n]
            keys.append(key)
        live = np.flatnonzero(ranks)  # a suffix that begins with a border matches nothing
        keys = [k[live] for k in keys]
        order = np.lexsort(keys[::-1])
        self.suffixes = live[order]
        self.keys = [k[order] for k in keys]

    def bound(self, wanted: list[np.ndarray], after: bool) -> np.ndarray:
        """Binary search of every wanted key at once: the first suffix not below (or above) it."""
        lo = np.zeros(len(wanted[0]), np.int64)
        hi = np.full(len(wanted[0]), len(self.suffixes), np.int64)
        while (lo < hi).any():
            mid = (lo + hi) // 2
            at = np.minimum(mid, len(self.suffixes) - 1)
            less = np.zeros(len(lo), bool)
            same = np.ones(len(lo), bool)
            for have, want in zip(self.keys, wanted):
                less |= same & (have[at] < want)
                same &= have[at] == want
            right = (less | same) if after else less
            right &= lo < hi
            lo = np.where(right, mid + 1, lo)
            hi = np.where(~right & (lo < hi), mid, hi)
        return lo


class Encoder:
    """Encodes texts with a vocabulary; remembers units that it has seen."""

    def __init__(self, vocabulary: Vocabulary, kind: str = "bpe") -> None:
        self.v, self.kind = vocabulary, kind
        self.pattern = vocabulary.pattern
        chars = sorted({c for p in vocabulary.pieces for c in p})
        self.rank = np.zeros(0x110000, np.uint64)
        self.rank[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        names = [p for p in vocabulary.pieces if kind != "bpe" or len(merge_plainly(p, vocabulary.scores)) == 1]
        self.names = names
        self.name_ids = np.array([vocabulary.pieces[p] for p in names], np.int64)
        self.lengths = np.array([len(p) for p in names], np.int64)
        self.gains = np.array([vocabulary.scores[p] for p in names])
        self.depth = int(self.lengths.max())
        lanes = -(-self.depth // LANE)
        table = np.zeros((len(names), lanes * LANE), np.uint64)
        for i, p in enumerate(names):
            table[i, : len(p)] = self.rank[[ord(c) for c in p]]
        top = table.copy()
        top[np.arange(lanes * LANE)[None, :] >= self.lengths[:, None]] = 0xFFFF
        self.lower, self.upper = ([_lane(t, lane) for lane in range(lanes)] for t in (table, top))
        self.alone = {p for p in names if len(p) == 1}
        self.lone_gain = min(vocabulary.scores.values()) - 10.0
        self.valid: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.first = np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        if len(self.known) > HELD_UNITS:
            self.clear()
        split = [units(t, self.pattern) if t else [] for t in texts]
        fresh = list(dict.fromkeys(u for us in split for u in us if u not in self.known))
        for begin in range(0, len(fresh), INDEXED_UNITS):
            self.learn(fresh[begin : begin + INDEXED_UNITS])
        which = np.fromiter((self.known[u] for us in split for u in us), np.int64)
        sizes = np.diff(self.first)[which]
        begin = self.first[which]
        ends = np.cumsum(sizes)
        ids = self.flat[np.arange(int(sizes.sum())) + np.repeat(begin - (ends - sizes), sizes)]
        per_text = np.array([len(us) for us in split], np.int64)
        cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]
        return ids, np.diff(cut)

    def learn(self, fresh: list[str]) -> None:
        lengths = np.array([len(u) for u in fresh], np.int64)
        start = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        codes = np.frombuffer("\0".join([*fresh, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        ranks = self.rank[codes]
        ranks[start + lengths] = 0
        index = SuffixIndex(ranks, self.depth)
        lo, hi = index.bound(self.lower, False), index.bound(self.upper, True)
        times = np.maximum(hi - lo, 0)
        piece = np.repeat(np.arange(len(times)), times)
        within = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        at = index.suffixes[within + np.repeat(lo, times)]
        single = np.zeros(len(codes) + 1, bool)
        single[at[self.lengths[piece] == 1]] = True
        single[start + lengths] = True
        lone = np.flatnonzero(~single[: len(codes)])  # characters without a piece are edges of their own
        at = np.concatenate([at, lone])
        piece = np.concatenate([piece, np.full(len(lone), -1)])
        end = at + np.where(piece < 0, 1, self.lengths[piece])
        local = end - np.repeat(start, lengths + 1)[at]
        small = np.uint16 if len(local) and local.max() < 1 << 16 else np.int64  # short keys are sorted by radix
        order = np.argsort(local.astype(small), kind="stable")
        at, piece, end, local = at[order], piece[order], end[order], local[order]
        last = np.full(len(codes) + 1, -2, np.int64)  # the piece that ends here; -2: none
        back = np.zeros(len(codes) + 1, np.int64)
        odd = np.zeros(len(codes) + 1, bool)
        is_start = np.zeros(len(codes) + 1, bool)
        is_start[start] = True
        steps = np.append(np.flatnonzero(np.concatenate([[True], local[1:] != local[:-1]])), len(local)) if len(local) else [0]
        best = np.full(len(codes) + 1, -np.inf)
        best[start] = 0
        for a, b in zip(steps[:-1], steps[1:]):
            s, p, e = at[a:b], piece[a:b], end[a:b]
            if self.kind == "bpe":
                ok = is_start[s] | (last[s] > -2)
                ok[ok] = self.follows(np.where(is_start[s], -2, last[s])[ok], p[ok])
                s, p, e = s[ok], p[ok], e[ok]
                twice, n = np.unique(e, return_counts=True)
                odd[twice[n > 1]] = True
                last[e], back[e] = p, s
            else:
                value = best[s] + np.where(p < 0, self.lone_gain, self.gains[p])
                top = np.lexsort((s, -value, e))
                s, p, e, value = s[top], p[top], e[top], value[top]
                pick = np.concatenate([[True], e[1:] != e[:-1]])
                last[e[pick]], back[e[pick]], best[e[pick]] = p[pick], s[pick], value[pick]
        self.keep(fresh, start, lengths, last, back, odd)

    def follows(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether merging leaves ``before`` and ``piece`` apart; a text's start takes any piece."""
        free = (before < 0) | (piece < 0)
        key = before * len(self.names) + piece
        out = free.copy()
        distinct, where = np.unique(key[~free], return_inverse=True)
        if len(self.valid) > HELD_PAIRS:
            self.valid.clear()
        told = np.empty(len(distinct), bool)
        for i, k in enumerate(distinct.tolist()):
            known = self.valid.get(k)
            if known is None:
                a, b = self.names[k // len(self.names)], self.names[k % len(self.names)]
                known = self.valid[k] = (a + b) not in self.v.scores and merge_plainly(a + b, self.v.scores) == [a, b]
            told[i] = known
        out[~free] = told[where]
        return out

    def keep(self, fresh: list[str], start: np.ndarray, lengths: np.ndarray, last: np.ndarray, back: np.ndarray, odd: np.ndarray) -> None:
        """Walk every unit back from its end, all at once, and remember its ids."""
        n = len(fresh)
        here = start + lengths
        bad = np.zeros(n, bool)
        rows, owners = [], []
        live = np.arange(n)
        while len(live):
            p = last[here[live]]
            bad[live[(p == -2) | odd[here[live]]]] = True
            live = live[p != -2]
            p = p[p != -2]
            rows.append(np.where(p < 0, -(back[here[live]] + 1), p))  # characters without piece by place
            owners.append(live)
            here[live] = back[here[live]]
            live = live[here[live] > start[live]]
        flat = np.concatenate(rows)
        owner = np.concatenate(owners)
        depth = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        order = np.lexsort((-depth, owner))
        flat, owner = flat[order], owner[order]
        cut = np.searchsorted(owner, np.arange(n + 1))
        lone = flat < 0
        plain = lone.copy()
        ids = np.where(lone, 0, self.name_ids[np.maximum(flat, 0)]).astype(np.int32)
        special = np.flatnonzero(bad | (np.bincount(owner[plain], minlength=n) > 0))
        replaced: dict[int, list[int]] = {}
        for i in special.tolist():
            if bad[i]:
                replaced[i] = [x for s in merge_plainly(fresh[i], self.v.scores) for x in self.ids_of(s)]
            else:
                replaced[i] = [x for f in flat[cut[i] : cut[i + 1]].tolist() for x in (self.ids_of(fresh[i][-f - 1 - int(start[i])]) if f < 0 else (int(self.name_ids[f]),))]
        if replaced:
            parts = [np.array(replaced[i], np.int32) if i in replaced else ids[cut[i] : cut[i + 1]] for i in range(n)]
            sizes = np.array([len(x) for x in parts], np.int64)
            ids = np.concatenate(parts)
        else:
            sizes = np.diff(cut)
        base = len(self.first) - 1
        self.known.update(zip(fresh, range(base, base + n)))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, ids])

    def ids_of(self, symbol: str) -> list[int]:
        found = self.v.pieces.get(symbol)
        if found is not None:
            return [found]
        if self.v.bytes is None:
            return [self.v.unknown]
        return [self.v.bytes[b] for b in symbol.encode("utf-8", "surrogatepass")]


def _lane(table: np.ndarray, lane: int) -> np.ndarray:
    key = np.zeros(len(table), np.uint64)
    for i in range(LANE):
        key = (key << np.uint64(16)) | table[:, lane * LANE + i]
    return key


def decode_ids(ids: list[int], surface: list[bytes | None]) -> str:
    """Text of the pieces: bytes join to characters, the blank before the text goes."""
    raw = b"".join([surface[i] or b"" for i in ids])
    return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def _encoder(vocabulary: Vocabulary, kind: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    key = (vocabulary.size, kind, hash(tuple(list(vocabulary.pieces)[:1000])))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary, kind)
    return _ENCODERS[key]


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", kind: str = "bpe", check: bool = False) -> DataFrame:
    """``id, ids, n_pieces`` of every row; with ``check`` also ``round_trip``: whether decoding
    gives the text again (blank marks of the text taken as blanks)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the tokenizer's vocabulary
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        encoder = _encoder(v, kind)
        for batch in batches:
            for part in pieces(batch, "text"):
                texts = text_column(part, "text").to_pylist()
                ids, counts = encoder.encode(texts)
                at = np.concatenate([[0], np.cumsum(counts)])
                out = [part.column(0), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())), pa.array(counts, pa.int32())]
                names = ["id", "ids", "n_pieces"]
                if check:
                    every = ids.tolist()
                    out.append(pa.array([decode_ids(every[a:b], v.surface) == (t or "").replace(BLANK, " ") for a, b, t in zip(at[:-1].tolist(), at[1:].tolist(), texts)], pa.bool_()))
                    names.append("round_trip")
                yield pa.RecordBatch.from_arrays(out, names)

    kind_of_id = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind_of_id}, ids array<int>, n_pieces int" + (", round_trip boolean" if check else ""))


def decode(encoded: DataFrame, vocabulary: Vocabulary, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id, text`` of every row of ids; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.surface)
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_ids(x or [], shared.value) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, text string")
