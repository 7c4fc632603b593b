"""Language-model scoring with an interpolated modified Kneser-Ney model of order 2 or 3.

Counting is distributed. The first pass turns words into 64-bit hashes and sums them by hash range;
the sorted hashes of all ranges form one array, and a word's id is its place there. The second sums
n-grams of ids. They are dealt out by the word before the last, which all contexts of the last word
end in, so that a bucket has every count it needs: raw counts of the highest order and, of lower ones,
in how many ways an n-gram is continued to the left. An n-gram that begins a text can't be; it keeps
its raw count. Tasks sum what they see before anything is shuffled, and shuffles carry packed arrays.
Each bucket is merged by one task, which writes sorted arrays into the shared folder: contexts, their
next words, counts. Scoring tasks map these files into memory and search the distinct n-grams of a
chunk of texts in them at once.

A word with more than ``1 / (4 * buckets)`` of all tokens would fill a bucket as a context; its
n-grams are dealt over all buckets by the word before it (by the last word where there is none), and
what is counted of it in several buckets is summed in Spark. There are fewer than ``4 * buckets`` such
words. Nothing is pruned: every n-gram of every training text is counted.

The shared folder must be visible to tasks as a file system path (a mount), as files are mapped.

Defined results: a null or wordless text consists of the end token alone; unknown words share the
uniform share of the lowest order; without training rows every token gets probability 1 (there is
one token type: unknown); repeated rows count and score each; empty tables give empty results;
further columns are ignored; a text of any length is read whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundcheck.llm.common import lowered, mix, pieces, scratch_path, span_hashes, text_column, utf8, word_spans

#: Hash of the end token; spans hash with their length, which is never zero.
END = int(mix(np.zeros(1, np.uint64) + np.uint64(0x5E5E5E5E5E5E5E5E))[0])
BYTES_PER_BUCKET = 16 << 20
LEAST_BUCKETS = 64
HELD_KEYS = 2_000_000
#: Contexts with more next words than this have their sums stored; those of others are made anew.
FEW = 16
#: Bytes of text that are scored at once: more of them share a search in a bucket's arrays.
SCORED_BYTES = 2 << 20
#: Files that a worker keeps mapped.
MOST_MAPPED = 8192


# --- packed arrays ---------------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Bytes of whole numbers, plane by plane, as many planes as the largest needs: sorted or small
    values compress well."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(planes.T).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    width = raw[0]
    planes = np.frombuffer(raw, np.uint8)[1:].reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1).astype(np.uint64)


def summed(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the key columns, in order, and their summed counts."""
    if not len(counts):
        return keys, counts
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    keys, counts = [k[order] for k in keys], counts[order]
    new = np.ones(len(counts), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.add.reduceat(counts, first)


class Held:
    """Sums of what a task has seen, given out once they are many."""

    def __init__(self, columns: int) -> None:
        self.columns = columns
        self.keys: list[list[np.ndarray]] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: list[np.ndarray], counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts.astype(np.uint64))
        self.size += len(counts)

    def full(self) -> bool:
        if self.size > HELD_KEYS:
            self.settle()
        return self.size > HELD_KEYS // 2

    def settle(self) -> None:
        if self.keys:
            keys, counts = summed([np.concatenate(k) for k in zip(*self.keys)], np.concatenate(self.counts))
            self.keys, self.counts, self.size = [keys], [counts], len(counts)

    def take(self) -> tuple[list[np.ndarray], np.ndarray]:
        self.settle()
        none = np.zeros(0, np.uint64)
        out = (self.keys[0], self.counts[0]) if self.keys else ([none] * self.columns, none)
        self.keys, self.counts, self.size = [], [], 0
        return out


Packed = tuple[str, int, list[bytes], bytes]


def dealt(kind: str, keys: list[np.ndarray], counts: np.ndarray, bucket: np.ndarray) -> list[Packed]:
    """Packed rows by bucket; keys stay in order within each."""
    order = np.argsort(bucket, kind="stable")
    keys, counts, bucket = [k[order] for k in keys], counts[order], bucket[order]
    at = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(bucket)) if len(bucket) else [0]
    return [(kind, int(bucket[a]), [pack(k[a:b]) for k in keys], pack(counts[a:b])) for a, b in zip(at[:-1], at[1:])]


_PACKED = "kind string, bucket int, keys array<binary>, counts binary"


def _packed_batch(rows: list[Packed]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.list_(pa.binary())), pa.array(cols[3], pa.binary())], ["kind", "bucket", "keys", "counts"])


def _merged(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    keys = [[unpack(raw) for raw in row] for row in table.column("keys").to_pylist()]
    counts = [unpack(x) for x in table.column("counts").to_pylist()]
    return summed([np.concatenate(k) for k in zip(*keys)], np.concatenate(counts))


def _write(folder: str, name: str, values: np.ndarray) -> None:
    """A file that appears whole or not at all, so that a repeated task does no harm."""
    part = f"{folder}/.{name}.{os.getpid()}.{os.urandom(4).hex()}"
    values.tofile(part)
    os.replace(part, f"{folder}/{name}")


def _write_counts(folder: str, name: str, counts: np.ndarray) -> None:
    """One byte for each count; those of 255 and above follow in arrays of places and counts."""
    _write(folder, name, np.minimum(counts, 255).astype(np.uint8))
    large = np.flatnonzero(counts >= 255)
    _write(folder, f"{name}.over", np.stack([large.astype(np.uint64), counts[large].astype(np.uint64)]))


_MAPPED: dict[str, np.ndarray] = {}


def mapped(path: str, kind: type) -> np.ndarray:
    """The file mapped into memory, once for each worker process."""
    if path not in _MAPPED:
        while len(_MAPPED) >= MOST_MAPPED:
            _MAPPED.pop(next(iter(_MAPPED)))
        # A plain array over the mapping: the subclass takes a while for every index.
        _MAPPED[path] = np.asarray(np.memmap(path, kind, "r")) if os.path.getsize(path) else np.zeros(0, kind)
    return _MAPPED[path]


def _counts_at(path: str, place: np.ndarray) -> np.ndarray:
    found = mapped(path, np.uint8)[place].astype(np.uint64)
    top = found == 255
    if top.any():
        over = mapped(f"{path}.over", np.uint64).reshape(2, -1)
        found[top] = over[1][np.searchsorted(over[0], place[top].astype(np.uint64))]
    return found


def search(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Place of each target in its own sorted stretch ``lo`` to ``hi`` of the values, -1 if it isn't there."""
    lo, hi, end = lo.astype(np.int64), hi.astype(np.int64), hi.astype(np.int64)
    live = np.flatnonzero(lo < hi)
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        less = values[mid] < target[live]
        lo[live[less]] = mid[less] + 1
        hi[live[~less]] = mid[~less]
        live = live[lo[live] < hi[live]]
    found = np.full(len(target), -1, np.int64)
    inside = np.flatnonzero(lo < end)
    hit = inside[values[lo[inside]] == target[inside]]
    found[hit] = lo[hit]
    return found


def class_sums(counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each stretch of counts: how many are one, two, more, and their sum."""
    if not len(starts):
        return np.zeros((0, 4), np.uint64)
    return np.stack([np.add.reduceat(x.astype(np.uint64), starts) for x in (counts == 1, counts == 2, counts >= 3, counts)], axis=1)


def _narrow(values: np.ndarray) -> np.ndarray:
    if values.max(initial=0) >= 1 << 32:
        raise OverflowError("a bucket holds 2^32 n-grams or more: lower BYTES_PER_BUCKET")
    return values.astype(np.uint32)


def write_pairs(folder: str, name: str, head: np.ndarray, w: np.ndarray, c: np.ndarray, heads: int, kind: type) -> np.ndarray:
    """Next words and counts by head (a dense number); gives the heads' sums."""
    per = np.bincount(head, minlength=heads)
    _write(folder, f"{name}-at", _narrow(np.concatenate([[0], np.cumsum(per)])))
    _write(folder, f"{name}-w", w.astype(kind))
    _write_counts(folder, f"{name}-c", c)
    sums = np.zeros((heads, 4), np.uint64)
    there = np.flatnonzero(per)
    sums[there] = class_sums(c, np.cumsum(per)[there] - per[there])
    return sums


def write_contexts(folder: str, name: str, head: np.ndarray, u: np.ndarray, w: np.ndarray, c: np.ndarray, heads: int, kind: type) -> None:
    """Contexts (head, u) with their next words and counts; rows are sorted by head, u, w."""
    new = np.ones(len(c), bool)
    new[1:] = (head[1:] != head[:-1]) | (u[1:] != u[:-1])
    first = np.flatnonzero(new)
    _write(folder, f"{name}-at", _narrow(np.concatenate([[0], np.cumsum(np.bincount(head[first], minlength=heads))])))
    _write(folder, f"{name}-u", u[first].astype(kind))
    _write(folder, f"{name}-s", _narrow(np.append(first, len(c))))
    _write(folder, f"{name}-w", w.astype(kind))
    _write_counts(folder, f"{name}-c", c)
    many = np.flatnonzero(np.diff(np.append(first, len(c))) > FEW)
    _write(folder, f"{name}-many", _narrow(many))
    _write(folder, f"{name}-sums", class_sums(c, first)[many].astype(np.uint64))


# --- the model -------------------------------------------------------------------------------


@dataclass
class Model:
    folder: str
    buckets: int
    #: Distinct words in each hash range; a word's id is its place over all ranges.
    sizes: np.ndarray
    tokens: int
    texts: int
    order: int
    hot: np.ndarray
    #: Distinct pairs in all; discounts by order, of which the first is for continuations of words.
    types: int = 0
    discount: dict[int, np.ndarray] = field(default_factory=dict)
    low_rest: float = 1.0
    #: Of contexts dealt over all buckets: how many words follow once, twice, more often, and the sum.
    hot_sums: np.ndarray = field(default_factory=lambda: np.zeros((0, 4)))

    @property
    def vocabulary(self) -> int:
        return int(self.sizes.sum())

    @property
    def begin(self) -> int:
        """The id of a text's begin; the next one stands for no word at all."""
        return self.vocabulary

    @property
    def kind(self) -> type:
        return np.uint32 if self.vocabulary + 2 < 1 << 32 else np.uint64

    def range_of(self, ids: np.ndarray) -> np.ndarray:
        """Id range, one of as many as buckets, of each id up to the begin's."""
        return (ids.astype(np.uint64) * np.uint64(self.buckets) // np.uint64(self.vocabulary + 1)).astype(np.int64)

    def range_start(self, bucket: int) -> int:
        return -(-bucket * (self.vocabulary + 1) // self.buckets)

    def hot_place(self, v: np.ndarray) -> np.ndarray:
        """Place among the hot words, -1 for others."""
        if not len(self.hot):
            return np.full(len(v), -1, np.int64)
        place = np.minimum(np.searchsorted(self.hot, v), len(self.hot) - 1)
        return np.where(self.hot[place] == v, place, -1)

    def bucket_of(self, v: np.ndarray, spread_by: np.ndarray) -> np.ndarray:
        """Bucket of n-grams by the word before the last; of hot ones by another word."""
        bucket = self.range_of(v)
        hot = self.hot_place(v) >= 0
        bucket[hot] = (mix(spread_by[hot].astype(np.uint64)) % np.uint64(self.buckets)).astype(np.int64)
        return bucket

    def files(self, name: str, v: np.ndarray, spread_by: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """Path of each set of arrays that is needed, whose rows of ``v`` lie there, and their heads."""
        hot = self.hot_place(v)
        bucket = self.bucket_of(v, spread_by)
        group = bucket * 2 + (hot >= 0)
        small = group.astype(np.uint16) if self.buckets < 1 << 15 else group  # sorted by digits
        order = np.argsort(small, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if len(order) else []:
            b, is_hot = divmod(int(group[at[0]]), 2)
            head = hot[at] if is_hot else v[at].astype(np.int64) - self.range_start(b)
            path = f"{self.folder}/{name}{'-hot' if is_hot else ''}-{b}"
            if os.path.exists(f"{path}-at"):
                yield path, at, head

    def ids_of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and training counts of sorted distinct hashes."""
        ids = np.full(len(hashes), -1, np.int64)
        counts = np.zeros(len(hashes), np.uint64)
        first = np.concatenate([[0], np.cumsum(self.sizes)])
        bucket = _hash_range(hashes, self.buckets)
        cut = np.searchsorted(bucket, np.arange(self.buckets + 1))
        for b in np.flatnonzero(np.diff(cut)).tolist():
            if self.sizes[b]:
                own = hashes[cut[b] : cut[b + 1]]
                known = mapped(f"{self.folder}/word-{b}", np.uint64)
                place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                hit = known[place] == own
                where = np.flatnonzero(hit) + cut[b]
                ids[where] = place[hit] + first[b]
                counts[where] = _counts_at(f"{self.folder}/word-count-{b}", place[hit])
        return ids, counts

    def by_id(self, ids: np.ndarray, name: str, width: int) -> np.ndarray:
        """Rows of the ``name`` arrays for sorted distinct ids."""
        out = np.zeros((len(ids), width))
        cut = np.searchsorted(self.range_of(ids), np.arange(self.buckets + 1))
        for b in np.flatnonzero(np.diff(cut)).tolist():
            path = f"{self.folder}/{name}-{b}"
            if os.path.exists(path):
                values = mapped(path, np.uint32).reshape(-1, width)
                out[cut[b] : cut[b + 1]] = values[ids[cut[b] : cut[b + 1]].astype(np.int64) - self.range_start(b)]
        return out

    def low_order(self, ids: np.ndarray) -> np.ndarray:
        """Continuation probability of sorted distinct ids; -1 gets the share of unknown words."""
        share = self.low_rest / (self.vocabulary + 1)
        p = np.full(len(ids), share)
        known = ids >= 0
        if self.types:
            n = self.by_id(ids[known], "continued", 1)[:, 0]
            p[known] += np.maximum(n - self.discount[1][np.minimum(n, 3).astype(int)], 0) / self.types
        return p

    def one_word(self, v: np.ndarray) -> np.ndarray:
        """Sums after each of the sorted distinct one-word contexts; zeros for contexts never seen."""
        sums = self.by_id(v, "two-sums", 4)
        hot = self.hot_place(v)
        sums[hot >= 0] = self.hot_sums[hot[hot >= 0]]
        return sums

    def pair_counts(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        counts = np.zeros(len(v), np.uint64)
        for path, at, head in self.files("two", v, w):
            ends = mapped(f"{path}-at", np.uint32)
            place = search(mapped(f"{path}-w", self.kind), ends[head], ends[head + 1], w[at])
            counts[at[place >= 0]] = _counts_at(f"{path}-c", place[place >= 0])
        return counts

    def two_words(self, v: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each context ``u v`` in its arrays, -1 for one never seen, and its sums."""
        places, sums = np.full(len(v), -1, np.int64), np.zeros((len(v), 4))
        for path, at, head in self.files("three", v, u):
            ends = mapped(f"{path}-at", np.uint32)
            place = search(mapped(f"{path}-u", self.kind), ends[head], ends[head + 1], u[at])
            places[at] = place
            at, place = at[place >= 0], place[place >= 0]
            if not len(at):
                continue
            s = mapped(f"{path}-s", np.uint32)
            begin, n = s[place].astype(np.int64), s[place + 1].astype(np.int64) - s[place]
            many = n > FEW
            if many.any():
                stored_at = np.searchsorted(mapped(f"{path}-many", np.uint32), place[many])
                sums[at[many]] = mapped(f"{path}-sums", np.uint64).reshape(-1, 4)[stored_at]
            begin, n, at = begin[~many], n[~many], at[~many]
            starts = np.cumsum(n) - n
            each = np.arange(int(n.sum())) - np.repeat(starts, n) + np.repeat(begin, n)
            sums[at] = class_sums(_counts_at(f"{path}-c", each), starts)
        return places, sums

    def triple_counts(self, v: np.ndarray, u: np.ndarray, place: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Counts of words after contexts that have a place."""
        counts = np.zeros(len(v), np.uint64)
        for path, at, _ in self.files("three", v, u):
            s = mapped(f"{path}-s", np.uint32)
            found = search(mapped(f"{path}-w", self.kind), s[place[at]], s[place[at] + 1], w[at])
            counts[at[found >= 0]] = _counts_at(f"{path}-c", found[found >= 0])
        return counts


def _hash_range(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def token_hashes(part: pa.RecordBatch, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and its end token, and how many tokens each text has."""
    data, at = utf8(text_column(part, text_col))
    data = lowered(data)
    starts, ends, counts = word_spans(data, at)
    hashes = span_hashes(data, starts, ends)
    return np.insert(hashes, np.cumsum(counts), np.uint64(END)), counts + 1


def contexts_of(ids: np.ndarray, counts: np.ndarray, begin: int, order: int) -> list[np.ndarray]:
    """The word before each token and, for order 3, the one before that: ``begin`` before a text's
    first token, ``begin + 1`` where there is none."""
    first = np.cumsum(counts) - counts
    v = np.empty_like(ids)
    v[1:] = ids[:-1]
    v[first] = begin
    if order == 2:
        return [v]
    u = np.empty_like(ids)
    u[1:] = v[:-1]
    u[first] = begin + 1
    return [v, u]


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more from the numbers of types
    that occur 1 to 4 times; where one is zero, fixed ones serve."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return d if (d[1:] > 0).all() and (d[1:] <= [1, 2, 3]).all() else np.array([0, 0.5, 1.0, 1.5])


def _local(path: str) -> str:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"the arrays are mapped into memory: {path} must be mounted as a folder that all tasks see")
    return path


def train(docs: DataFrame, text_col: str = "text", order: int = 3) -> Model:
    """Counts every training text; what comes to the driver are a few sums for each bucket and each
    hot word."""
    if order not in (2, 3):
        raise ValueError(f"no such order: {order}")
    spark = docs.sparkSession
    folder = _local(scratch_path(spark, "kneser-ney"))
    os.makedirs(folder, exist_ok=True)
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    n_texts, size = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = int(max(LEAST_BUCKETS, size // BYTES_PER_BUCKET))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(1)

        def give() -> pa.RecordBatch:
            keys, counts = held.take()
            return _packed_batch(dealt("word", keys, counts, _hash_range(keys[0], buckets)))

        for batch in batches:
            for part in pieces(batch, "text"):
                keys, counts = np.unique(token_hashes(part, "text")[0], return_counts=True)
                held.add([keys], counts)
                if held.full():
                    yield give()
        yield give()

    def merge_words(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        (keys,), counts = _merged(table)
        _write(folder, f"word-{bucket}", keys)
        _write_counts(folder, f"word-count-{bucket}", counts)
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "size": pa.array([len(keys)], pa.int64()), "tokens": pa.array([int(counts.sum())], pa.int64())})

    found = texts.mapInArrow(words, _PACKED).groupBy("bucket").applyInArrow(merge_words, "bucket int, size long, tokens long").collect()
    sizes = np.zeros(buckets, np.int64)
    for r in found:
        sizes[r.bucket] = r.size
    tokens = sum(r.tokens for r in found)
    model = Model(folder, buckets, sizes, tokens, n_texts, order, np.zeros(0, np.int64))
    if not n_texts:
        return model
    first = np.concatenate([[0], np.cumsum(sizes)])
    most = tokens / (4 * buckets)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for b in batch.column(0).to_pylist():
                if sizes[b]:
                    over = mapped(f"{folder}/word-count-{b}", np.uint8)
                    place = np.flatnonzero(over == 255)
                    place = place[_counts_at(f"{folder}/word-count-{b}", place) > most] if most >= 255 else np.flatnonzero(_counts_at(f"{folder}/word-count-{b}", np.arange(len(over))) > most)
                    ids += (place + first[b]).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], ["id"])

    model.hot = np.sort(np.array([r.id for r in spark.range(0, buckets, 1, min(buckets, 64)).mapInArrow(frequent, "id long").collect()], np.int64))
    if n_texts > most:  # every text begins with the same context
        model.hot = np.append(model.hot, model.begin)
    shared = spark.sparkContext.broadcast(model)  # a few numbers for each bucket

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        held = Held(m.order)

        def give() -> pa.RecordBatch:
            keys, counts = held.take()
            last = keys[-1]
            by = last if m.order == 2 else np.where(keys[1] == np.uint64(m.begin + 1), last, keys[1])
            return _packed_batch(dealt("gram", keys, counts, m.bucket_of(keys[0].astype(np.int64), by)))

        for batch in batches:
            for part in pieces(batch, "text"):
                hashes, counts = token_hashes(part, "text")
                distinct, back = np.unique(hashes, return_inverse=True)
                ids = m.ids_of(distinct)[0][back]
                held.add([x.astype(np.uint64) for x in (*contexts_of(ids, counts, m.begin, m.order), ids)], np.ones(len(ids), np.uint64))
                if held.full():
                    yield give()
        yield give()

    def pair_rows(m: Model, bucket: int, hot: bool, v: np.ndarray, w: np.ndarray, c: np.ndarray) -> list[Packed]:
        """Writes a bucket's pairs; what others have to sum goes on."""
        lo, hi = m.range_start(bucket), m.range_start(bucket + 1)
        head, heads = (m.hot_place(v), len(m.hot)) if hot else (v - lo, hi - lo)
        sums = write_pairs(folder, f"two{'-hot' if hot else ''}-{bucket}", head, w, c, heads, m.kind)
        rows = []
        if hot:
            there = np.flatnonzero(sums[:, 3])
            if len(there):
                rows.append(("hot-sums", bucket, [pack(there.astype(np.uint64)), *[pack(sums[there, k]) for k in range(4)]], pack(np.ones(len(there), np.uint64))))
        else:
            _write(folder, f"two-sums-{bucket}", _narrow(sums))
        ids, n = np.unique(w, return_counts=True)
        rows += dealt("continued", [ids.astype(np.uint64)], n.astype(np.uint64), m.range_of(ids))
        return [*rows, _of_counts("sums-2", bucket, c)]

    def merge_grams(table: pa.Table) -> pa.Table:
        m = shared.value
        bucket = table.column("bucket")[0].as_py()
        keys, counts = _merged(table)
        v, w = keys[0].astype(np.int64), keys[-1].astype(np.int64)
        hot = m.hot_place(v) >= 0
        lo, hi = m.range_start(bucket), m.range_start(bucket + 1)
        rows: list[Packed] = []
        if m.order == 3:
            u = keys[1].astype(np.int64)
            whole = u != m.begin + 1
            for name, mine, heads in ((f"three-{bucket}", whole & ~hot, hi - lo), (f"three-hot-{bucket}", whole & hot, len(m.hot))):
                head = m.hot_place(v[mine]) if "hot" in name else v[mine] - lo
                write_contexts(folder, name, head, u[mine], w[mine], counts[mine], heads, m.kind)
            rows.append(_of_counts("sums-3", bucket, counts[whole]))
            # A pair counts once for every word before it; at a text's begin as often as it is there.
            counts = np.where(whole, np.uint64(1), counts)
            (v, w), counts = summed([v, w], counts)
            hot = m.hot_place(v) >= 0
        rows += pair_rows(m, bucket, False, v[~hot], w[~hot], counts[~hot])
        pairs = [v[hot].astype(np.uint64), w[hot].astype(np.uint64)]
        rows += dealt("hot", pairs, counts[hot], m.bucket_of(v[hot], w[hot]))
        return pa.Table.from_batches([_packed_batch(rows)])

    def merge_hot(table: pa.Table) -> pa.Table:
        kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
        if kind != "hot":
            return table
        (v, w), counts = _merged(table)
        return pa.Table.from_batches([_packed_batch(pair_rows(shared.value, bucket, True, v.astype(np.int64), w.astype(np.int64), counts))])

    def merge_continued(table: pa.Table) -> pa.Table:
        m = shared.value
        kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
        if kind != "continued":
            return table
        (ids,), n = _merged(table)
        lo, hi = m.range_start(bucket), m.range_start(bucket + 1)
        dense = np.zeros(hi - lo, np.uint32)
        dense[ids.astype(np.int64) - lo] = _narrow(n)
        _write(folder, f"continued-{bucket}", dense)
        return pa.Table.from_batches([_packed_batch([_of_counts("sums-1", bucket, n)])])

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = [unpack(k).astype(np.int64) for k in keys]
                named = values if kind == "hot-sums" else [np.full(1, -int(kind[-1]))] + [values[0][i : i + 1] for i in range(6)]
                named = named + [np.zeros(len(named[0]), np.int64)] * (7 - len(named))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in named], ["key", *"abcdef"])

    merged = texts.mapInArrow(grams, _PACKED).groupBy("bucket").applyInArrow(merge_grams, _PACKED)
    hot_merged = merged.groupBy("kind", "bucket").applyInArrow(merge_hot, _PACKED)
    told = hot_merged.groupBy("kind", "bucket").applyInArrow(merge_continued, _PACKED)
    sums = told.select("kind", "keys").mapInArrow(unpacked, "key long, a long, b long, c long, d long, e long, f long").groupBy("key").agg(*[F.sum(x).alias(x) for x in "abcdef"]).collect()
    by_key = {r.key: [r[x] for x in "abcdef"] for r in sums}
    model.hot_sums = np.array([by_key.get(k, [0] * 6)[:4] for k in range(len(model.hot))], float).reshape(-1, 4)
    model.discount = {k: discounts(by_key[-k][:4]) for k in range(1, order + 1)}
    model.types = by_key[-1][5]
    model.low_rest = float(model.discount[1][1:] @ np.array([by_key[-1][0], by_key[-1][1], by_key[-1][4]])) / model.types
    return model


def _of_counts(kind: str, bucket: int, counts: np.ndarray) -> Packed:
    """How many counts are 1, 2, 3, 4, are 3 or more, and their sum."""
    told = [*[int((counts == i).sum()) for i in (1, 2, 3, 4)], int((counts >= 3).sum()), int(counts.sum())]
    return kind, bucket, [pack(np.array(told, np.uint64))], pack(np.ones(1, np.uint64))


def score_part(part: pa.RecordBatch, m: Model, text_col: str) -> dict[str, np.ndarray]:
    hashes, counts = token_hashes(part, text_col)
    ends = np.cumsum(counts)
    distinct, back = np.unique(hashes, return_inverse=True)
    ids, seen = m.ids_of(distinct)
    base = np.log10((seen.astype(float) + 1) / (m.tokens + m.vocabulary + 1))[back]
    known = ids >= 0
    order = np.argsort(ids, kind="stable")
    low = np.empty(len(ids))
    low[order] = m.low_order(ids[order])
    p, w = low[back], ids[back]
    v = contexts_of(w, counts, m.begin, 2)[0]
    wide = m.vocabulary + 2
    if m.texts:
        # A token and the word before it are a pair, which is also the context of the next token.
        both = np.flatnonzero((v >= 0) & (w >= 0))
        pairs, which = np.unique(v[both] * wide + w[both], return_inverse=True)
        first, second = pairs // wide, pairs % wide
        has = np.flatnonzero(v >= 0)
        contexts, at = np.unique(v[has], return_inverse=True)
        c = np.zeros(len(w))
        c[both] = m.pair_counts(first, second)[which]
        p[has] = interpolated(p[has], c[has], m.one_word(contexts)[at], m.discount[2])
    if m.texts and m.order == 3:
        pair_of = np.full(len(w) + 1, -1, np.int64)
        pair_of[both + 1] = which
        pair_of[ends - counts] = -1  # a text's first token has one context alone
        has = np.flatnonzero(pair_of[:-1] >= 0)
        place, sums = m.two_words(second, first)
        context = pair_of[has]
        c = np.zeros(len(has))
        asked = np.flatnonzero((w[has] >= 0) & (place[context] >= 0))
        some = context[asked]
        c[asked] = m.triple_counts(second[some], first[some], place[some], w[has[asked]])
        p[has] = interpolated(p[has], c, sums[context], m.discount[3])
    starts = ends - counts
    sums_of = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)  # noqa: E731  every text has its end token
    return {"n_tokens": counts, "n_known": sums_of(known[back].astype(np.int64)), "base_score": sums_of(base), "score": sums_of(np.log10(p))}


def interpolated(low: np.ndarray, c: np.ndarray, sums: np.ndarray, discount: np.ndarray) -> np.ndarray:
    """Probabilities after contexts with these sums; contexts never seen leave them to the lower order."""
    total = sums[:, 3]
    some = np.maximum(total, 1)
    kept = np.maximum(c - discount[np.minimum(c, 3).astype(int)], 0) / some
    return np.where(total > 0, kept + sums[:, :3] @ discount[1:] / some * low, low)


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score, perplexity`` of every row; scores
    are log10 probabilities of the whole text with its end token."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in pieces(batch, "text", SCORED_BYTES):
                out = score_part(part, m, "text")
                perplexity = 10.0 ** np.minimum(-out["score"] / out["n_tokens"], 300)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(out["n_tokens"], pa.int64()), pa.array(out["n_known"], pa.int64()), pa.array(np.full(part.num_rows, m.tokens), pa.int64()), pa.array(out["base_score"]), pa.array(out["score"]), pa.array(perplexity)],
                    ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
                )

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
