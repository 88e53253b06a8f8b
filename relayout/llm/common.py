"""Shared helpers: staging tables, Arrow batches, skew-safe lookups."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: The white space that separates words, as a character class body: ``[^\x20\x09-\x0D]+`` is a word.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the plan is cut there, the copy
    survives lost executors, and several readers do not compute it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that is no column of ``df`` (inputs may hold any extra column)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


def remainder(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null for a null id)."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


def once(key, build: Callable):
    """``build()``, kept for the later tasks of the same Python worker process. (The task functions are
    shipped by value, so a variable of this module would not outlive a task.)"""
    kept = sys.modules.setdefault("relayout_task_values", types.ModuleType("relayout_task_values")).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]


def join_unique(rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``side`` (unique on ``keys``) after staging ``side``. Both inputs of the join are then
    plain shuffles, whose hot partitions adaptive execution splits over many tasks."""
    return rows.join(stage(side, "side"), list(keys), how)


def slices(batch: pa.RecordBatch, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes or less (a larger row is alone). Work arrays
    are many times as large as the texts, and Spark's batches have up to 10,000 rows."""
    if batch.num_rows > 1 and batch.nbytes > limit:
        half = batch.num_rows // 2
        yield from slices(batch.slice(0, half), limit)
        yield from slices(batch.slice(half), limit)
    else:
        yield batch


def map_batches(df: DataFrame, make: Callable, schema: str) -> DataFrame:
    """``make()`` runs once per task and gives a function from an Arrow batch to a batch of results; it is
    given ``slices`` of Spark's batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            if batch.num_rows:
                work = work or make()
                for part in slices(batch):
                    yield work(part)

    return df.mapInArrow(run, schema)


def lookup(rows: DataFrame, side: DataFrame, keys: Sequence[str], size_col: str, how: str = "left",
           phi: int = 1000) -> DataFrame:
    """Join ``rows`` with ``side`` (unique on ``keys``, no null key), where ``size_col`` of ``side``
    says how many of the rows have that key.

    Keys with more than 1/phi of all rows are at most ``phi`` in number, whatever the data: they are
    broadcast. All other keys meet in a shuffled join in which no key has more than 1/phi of the
    rows; there the rows with a broadcast key are dealt out by a salt, so no task gets a hot key.
    """
    side = stage(side, "lookup")  # read three times
    total = side.agg(F.sum(size_col)).first()[0] or 0
    extra = [c for c in side.columns if c not in keys]
    is_hot = F.col(size_col) * phi > F.lit(total)
    hot = side.where(is_hot).select(*keys, F.struct(*[F.col(c) for c in extra]).alias("_hot"))
    cold = side.where(~is_hot).select(*keys, F.lit(0).alias("_salt"), F.struct(*[F.col(c) for c in extra]).alias("_cold"))
    marked = rows.join(F.broadcast(hot), list(keys), "left")
    salt = F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(
        1 + F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(1 << 20)).cast("int"))
    joined = marked.withColumn("_salt", salt).join(cold, [*keys, "_salt"], "left")
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    if how == "inner":
        joined = joined.where(found.isNotNull())
    return joined.select(*rows.columns, *[found[c].alias(c) for c in extra])


# ---------------------------------------------------------------------------------------------
# Words of a whole Arrow batch as 64-bit hashes
# ---------------------------------------------------------------------------------------------

_U = np.uint64
#: Bytes hashed at a time.
CHUNK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and odd multiplications)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, one after another, and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def pieces(offsets: np.ndarray, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows [i, j) whose texts have about ``limit`` bytes together (a longer text is alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of every text, in order, and how many words each text has.

    A word's hash sums a mixed code of each byte times a power of its place in the word, and is mixed
    again. ``lower`` folds A-Z.
    """
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, _U), np.zeros(n, np.int64)
    codes = np.arange(256)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    if lower:
        codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    value = mix(codes.astype(_U) + _U(0x9E3779B97F4A7C15))
    inside = ~space[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = inside[first]  # a word never spans two texts
    at = np.flatnonzero(start)
    if not len(at):
        return np.zeros(0, _U), np.zeros(n, np.int64)
    # a word's bytes, and the spaces after it, which count as zero
    length = np.diff(np.append(at, len(data)))
    stops = np.append(np.flatnonzero(np.diff(inside.astype(np.int8)) == -1), len(data) - 1)
    word = np.minimum(stops[np.searchsorted(stops, at)] - at + 1, length)
    value[space] = 0
    power = np.ones(int(word.max()), _U)
    power[1:] = _U(0xD6E8FEB86659FD93)
    power = np.multiply.accumulate(power)
    sums = np.empty(len(at), _U)
    i = 0
    while i < len(at):  # by runs of words, so that a long text needs no work arrays of its size
        j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK)))
        end = at[j] if j < len(at) else len(data)
        place = np.arange(at[i], end) - np.repeat(at[i:j], length[i:j])
        terms = value[data[at[i]:end]] * power[np.minimum(place, len(power) - 1)]
        sums[i:j] = np.add.reduceat(terms, at[i:j] - at[i])
        i = j
    hashes = mix(sums + word.astype(_U))
    counts = np.diff(np.searchsorted(at, offsets))
    return hashes, counts


def fold_batches(df: DataFrame, make: Callable, schema: str) -> DataFrame:
    """``make()`` runs once per task and gives ``(add, finish)``: ``add`` takes every Arrow batch,
    ``finish`` gives the task's one result batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, finish = make()
        for batch in batches:
            add(batch)
        yield finish()

    return df.mapInArrow(run, schema)
