"""Row filters and column masks for restricted views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_mask(col: str) -> Column:
    return F.sha2(F.col(col).cast("string"), 256)


def restricted_view(df: DataFrame, row_filter: Column | None = None,
                    masks: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows allowed by ``row_filter``; masked columns replaced in place (same name)."""
    if row_filter is not None:
        df = df.filter(row_filter)
    if masks:
        df = df.withColumns(dict(masks))
    return df
