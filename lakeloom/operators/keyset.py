"""Keyset (cursor) extraction without a driver loop.

A cursor-paginated extract (``ORDER BY wm, pk LIMIT n`` repeated from the last
seen position) becomes one distributed pass:

* ``cursor_filter``  -- the resume predicate ``(wm > W) OR (wm = W AND pk > K)``
  bounded by ``wm <= cutoff``, with typed literals (never text comparison);
* ``assign_chunks``  -- the chunk each row would have landed in, i.e.
  ``floor((global_row_number - 1) / chunk_size) + 1`` under ``ORDER BY wm, pk``,
  computed with fixed range cuts instead of a single-partition global sort;
* ``next_cursor``    -- the new (wm, pk) high-water mark: ``max(struct(wm, pk))``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranges import range_cuts

_PID = "__pid"
_POS = "__pos"


def _typed(df: DataFrame, col: str, value) -> Column:
    """A cursor value as a literal of the column's type (struct for composite keys)."""
    if isinstance(value, Column):
        return value
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StructType):
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(value, dtype.fields)])
    return F.lit(value).cast(dtype)


def cursor_filter(df: DataFrame, mode: str, wm: str | None, pk: str | None,
                  last_wm=None, last_pk=None, cutoff=None, null_watermark: str = "skip") -> DataFrame:
    """Rows after the cursor.

    ``incremental``: requires a watermark; ``(wm > W) OR (wm = W AND pk > K)``
    (or ``wm > W`` without a key) and ``wm <= cutoff``.
    ``initial``: ``pk > K`` (or ``wm > W`` without a key); neither = everything.
    Missing cursor values mean "from the beginning". Rows with a NULL watermark
    satisfy no cursor; ``null_watermark="include"`` adds them to every run.
    """
    if mode not in ("initial", "incremental"):
        raise ValueError(f"unknown extract mode {mode!r}")
    cond = F.lit(True)
    has_wm = last_wm not in (None, "")
    has_pk = last_pk not in (None, "")
    if mode == "incremental":
        if not wm:
            raise ValueError("incremental extract needs a watermark column")
        w = F.col(wm)
        if has_wm:
            W = _typed(df, wm, last_wm)
            if pk and has_pk:
                cond = (w > W) | ((w == W) & (F.col(pk) > _typed(df, pk, last_pk)))
            else:
                cond = w > W
        else:
            cond = w.isNotNull()
        if cutoff is not None:
            cond = cond & (w <= _typed(df, wm, cutoff))
        if null_watermark == "include":
            cond = F.coalesce(cond, F.lit(False)) | w.isNull()
    else:
        if pk:
            cond = F.col(pk) > _typed(df, pk, last_pk) if has_pk else F.col(pk).isNotNull()
        elif wm and has_wm:
            cond = F.col(wm) > _typed(df, wm, last_wm)
    return df.filter(cond)


def assign_chunks(df: DataFrame, order: Sequence[str], chunk_size: int, first_chunk: int = 1,
                  chunk_col: str = "chunk_index", num_partitions: int | None = None) -> DataFrame:
    """Number rows into fixed-size chunks in ``order`` without a global sort.

    Rows fall into ranges with fixed cuts (``ranges``); one count per range gives
    the offsets, a table with one row per range, so its size is bounded and it is
    broadcast. A row's number is its place in its range plus the offset: one
    shuffle, and the rows of a range stay sorted for the writer.
    """
    order = list(order)
    ranged = range_cuts(df, order, num_partitions).assign(df, _PID)
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        _PID,
        (F.sum("__n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__offset"))
    offsets = offsets.fillna(0, subset=["__offset"])
    place = F.row_number().over(Window.partitionBy(_PID).orderBy(*order)) - 1
    out = ranged.withColumn(_POS, place).join(F.broadcast(offsets), on=_PID, how="inner")
    rn = F.col("__offset") + F.col(_POS)  # 0-based global row number
    return out.withColumn(chunk_col, (F.floor(rn / F.lit(chunk_size)) + F.lit(first_chunk))
                          .cast("long")).drop(_PID, _POS, "__offset")


def next_cursor(extracted: DataFrame, wm: str | None, pk: str | None) -> DataFrame:
    """One row: the greatest (wm, pk) extracted -- the resume point.

    The maximum of (wm, pk), not the last row of the final chunk: what an
    incremental run goes on from. An initial run walks the key alone and goes on
    from ``max(pk)``, so its caller asks for that separately.
    """
    fields = [F.col(c).alias(c) for c in (wm, pk) if c]
    if not fields:
        return extracted.agg(F.count(F.lit(1)).alias("rows"))
    non_null = F.lit(True)
    for c in (wm, pk):
        if c:
            non_null = non_null & F.col(c).isNotNull()
    best = F.max(F.when(non_null, F.struct(*fields)))
    return extracted.agg(best.alias("cursor"), F.count(F.lit(1)).alias("rows")) \
        .select(*[F.col(f"cursor.{c}").alias(f"last_{'watermark' if c == wm else 'pk'}")
                  for c in (wm, pk) if c], "rows")
