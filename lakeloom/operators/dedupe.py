"""Latest-wins deduplication (one row per business key).

``latest_by`` is ``row_number() = 1`` over the key ordered by recency. Catalyst
turns the filter into a ``WindowGroupLimit`` that also runs *before* the
shuffle (partial, per map task), so a hot key ships at most one row per map
partition -- a key holding a third of all rows does not land whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__lakeloom_rn"


def row_tiebreak(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """Deterministic last-resort tie-break: a 64-bit hash of the row's values."""
    cols = [F.col(c) for c in df.columns if c not in exclude]
    return F.xxhash64(*cols)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
              tiebreak: bool = True) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (give it most-recent-first).

    ``order`` should be a total order; when ``tiebreak`` is set a row hash is
    appended so equal recency still resolves the same way on every run.
    """
    order = list(order)
    if tiebreak:
        order.append(row_tiebreak(df).desc())
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
