"""Shared helpers: scratch tables, held-out folds, and vectorised UTF-8 text kernels.

The kernels work on the byte buffers of Arrow string columns, so that tasks never build one
Python object per word. All of them treat a null text as an empty one.
"""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a kernel takes at once; a longer text is taken alone. A kernel's arrays take
#: some fifty times as much.
CHUNK_BYTES = 1 << 20

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names. One of our own only where none is set and driver
    and tasks are one process; executors elsewhere would not see it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            root = found.get()
        elif not re.fullmatch(r"local(\[[^,]*(,\d+)?\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:
            root = tempfile.mkdtemp(prefix="spark-")
            spark.sparkContext.setCheckpointDir(root)
            spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again: lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the plans of one action; what was set before comes back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def join_spread(left: DataFrame, right: DataFrame, on: list[str], spread_by: list[str], how: str = "inner", share: float = 0.001, salts: int = 64) -> DataFrame:
    """``left`` joined to ``right`` by equal ``on`` columns, however often a key occurs in ``left``.

    Keys with more than ``share`` of the left rows, no more than ``1 / share`` of them, are sent to
    all tasks; their left rows are dealt over ``salts`` parts by a hash of the ``spread_by``
    columns, and their right rows are repeated for each part. Left rows with a null key are dealt
    out likewise. ``left`` is read three times: give a stored table or a narrow one."""
    total = left.count()
    hot = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.lit(share * total)).select(*on, F.lit(True).alias("_hot"))
    marks = F.broadcast(stored(hot, "hot-keys"))
    loose = F.col("_hot").isNotNull()
    for c in on:
        loose = loose | F.col(c).isNull()
    part = F.when(loose, F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(F.lit(0).cast("long"))
    parts = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    a = left.join(marks, on, "left").withColumn("_part", part).drop("_hot")
    b = right.join(marks, on, "left").withColumn("_part", F.explode(parts)).drop("_hot")
    return a.join(b, [*on, "_part"], how).drop("_part")


def counted_small(df: DataFrame, name: str, rows: int = 100_000) -> DataFrame | None:
    """``df`` stored and marked for broadcast if it is counted to have no more than ``rows`` rows."""
    kept = stored(df, name)
    return F.broadcast(kept) if kept.count() <= rows else None


def fold(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % F.lit(modulus)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` serves the texts that are ASCII throughout."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ASCII_UPPER, ASCII_UPPER.lower()))


# --- numpy kernels -------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes that part words: white space, or everything in ASCII that is neither digit nor letter.
SPACES = _SPACE
MARKS = np.zeros(256, bool)
MARKS[:128] = [not chr(c).isalnum() for c in range(128)]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection that spreads every input bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(4095, _STEP)]), dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, _STEP)]), dtype=np.uint64)
    return _POWERS


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets between them."""
    column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def pieces(batch: pa.RecordBatch, name: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with at most ``most`` bytes of text each, but one row at least."""
    _, at = utf8(text_column(batch, name))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + most, "right")) - 1)
        end = min(end, batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end
    give_back()


def give_back() -> None:
    """Free memory goes back to the system, as workers live on between tasks and share an executor's limit."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def word_spans(data: np.ndarray, offsets: np.ndarray, parting: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word between parting bytes, and how many words each text has."""
    word = ~parting[data]
    before = np.empty_like(word)
    before[:1] = False
    before[1:] = word[:-1]
    bounds = offsets[1:-1][offsets[1:-1] < len(data)]
    before[bounds] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1:] = False
    after[:-1] = word[1:]
    inner = bounds[bounds > 0]
    after[inner - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def text_slices(data: np.ndarray, parting: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[np.ndarray]:
    """A text's bytes in slices of about ``most`` bytes, cut where words part; a longer word stays whole."""
    begin = 0
    while begin < len(data):
        end = begin + most
        while end < len(data):
            breaks = np.flatnonzero(parting[data[end : end + most]])
            if len(breaks):
                end += int(breaks[0])
                break
            end += most
        yield data[begin:end]
        begin = end


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes; spans are disjoint and in order."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    taken = data[within + np.repeat(starts, lengths)]
    values = _BYTE[taken] * _powers(int(lengths.max()))[within]
    total = np.add.reduceat(values, first)
    return mix(total + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs of ``counts`` values; an empty run gives zero."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.float64), np.cumsum(values, axis=0, dtype=np.float64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
