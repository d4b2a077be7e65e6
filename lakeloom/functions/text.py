"""Text cleaning for all-text source columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_key(col) -> Column:
    """Trim a key and turn the empty string into NULL.

    Keys are cleaned *before* deduplication, so ``"A"`` and ``" A"`` are one
    key, and ``IS NOT NULL`` filters no longer let ``""`` through.
    """
    return F.nullif(F.trim(_c(col).cast("string")), F.lit(""))


def upper_trim(col) -> Column:
    return F.upper(F.trim(_c(col)))


def numeric_text(col, precision: int = 38, scale: int = 10) -> Column:
    """``NULLIF(x, '')`` then a numeric cast that yields NULL on junk."""
    text = F.nullif(F.trim(_c(col).cast("string")), F.lit(""))
    return text.try_cast(f"decimal({precision},{scale})")


def blank_or_null(col) -> Column:
    c = _c(col)
    return c.isNull() | (F.trim(c.cast("string")) == F.lit(""))
