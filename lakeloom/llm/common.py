"""Helpers shared by the training-data operators.

Texts reach Python in Arrow batches; they are cut into pieces of half a MB of
UTF-8 so that the numpy arrays made from them stay small whatever the batch
size is. A single very long text forms a piece of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import delete_path, scratch_path, session_conf

PIECE_BYTES = 1 << 19
BATCH_ROWS = 1_000
# Shuffle files go when the query that made them has ended, not when the driver happens to collect its garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_ROWS`` rows: rows are whole texts, so Spark's default of 10,000 takes much memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can read again after a loss. The
    shuffles of the write are removed after it.
    """
    path = scratch_path(df.sparkSession, name)
    with session_conf(df.sparkSession, TIDY):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables as ``stored`` returned them, that nothing reads any more."""
    for df in tables:
        delete_path(df.sparkSession, df.stored_at)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix64 constants)."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def text_pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows; a null text is empty."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=kind)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if texts.null_count:  # a null row may own bytes in a sliced buffer: give it none
        valid = np.asarray(texts.is_valid())
        if ((at[1:] > at[:-1]) & ~valid).any():
            yield from text_pieces(texts.fill_null(""), limit)
            return
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


def is_space(raw: np.ndarray) -> np.ndarray:
    """Bytes 0x20 and 0x09-0x0D."""
    return (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))


def segment_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte segment; segments are disjoint and ascending, none is empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    inside = np.repeat(starts - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    place = inside - np.repeat(starts, size)
    factor = mix64(np.arange(int(size.max()), dtype=np.uint64)) | np.uint64(1)
    value = (raw[inside].astype(np.uint64) + np.uint64(1)) * factor[place]
    total = np.add.reduceat(value, np.concatenate(([0], np.cumsum(size)[:-1])))
    return mix64(total ^ (size.astype(np.uint64) * _GOLD))


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row of each) of the maximal runs of non-space bytes; rows end runs."""
    if not len(raw):
        return (np.zeros(0, np.int64),) * 3
    word = ~is_space(raw)
    first = word.copy()
    first[1:] &= ~word[:-1]
    edge = offsets[:-1][offsets[:-1] < len(raw)]
    first[edge] = word[edge]
    last = word.copy()
    last[:-1] &= ~word[1:]
    stop = offsets[1:][offsets[1:] > 0] - 1
    last[stop] = word[stop]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    out = raw.copy()
    out[(out >= 65) & (out <= 90)] += 32
    return out


def release() -> None:
    """Give freed memory back: Python workers live on after a task, beside those of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def batches_of(rows: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    for batch in rows:
        texts = batch.column(batch.schema.get_field_index(column))
        yield batch, texts.cast(pa.string()) if pa.types.is_null(texts.type) else texts
    release()


def connected(edges: DataFrame, nodes: DataFrame, name: str = "components") -> DataFrame:
    """(node, label): the smallest node each node reaches.

    ``edges`` has columns a, b; ``nodes`` has column node. Every round joins labels
    along edges and then replaces a label by its own label (pointer jumping); each
    round is written to the shared folder. Rounds grow with the logarithm of the
    longest path, not with the size of a component; minima are pre-aggregated
    before the shuffle, so a node of very many edges is no hot task.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                  f"{name}-edges")
    last = now = stored(nodes.select("node", F.col("node").alias("label")), name)
    while True:
        near = (both.join(now.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen")))
        low = now.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("seen", "label")).alias("label"))
        up = now.select(F.col("node").alias("label"), F.col("label").alias("above"))
        nxt = stored(low.join(up, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("above", "label")).alias("label")), name)
        discard(last)
        if nxt.filter("old <> label").isEmpty():
            discard(both)
            out = nxt.select("node", "label")
            out.stored_at = nxt.stored_at
            return out
        last, now = nxt, nxt.select("node", "label")
