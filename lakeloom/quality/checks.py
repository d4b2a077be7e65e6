"""Source data-quality checks as ordinary Spark aggregations.

Each check returns a one-row (or small) DataFrame; all counting is done by
Spark with partial aggregation, nothing row-level reaches the driver.
Text numerics go through ``NULLIF(x, '')`` + a non-throwing numeric cast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_ts
from ..functions.text import blank_or_null, numeric_text
from ..operators.integrity import orphan_count


def _count(cond: Column) -> Column:
    return F.count_if(cond).cast("long")


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """total / non-null / distinct / null count of a key column."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(key).alias("not_null_id"),
        F.count_distinct(key).alias("unique_id"),
        (F.count(F.lit(1)) - F.count(key)).alias("null_id"),
    )


def time_range_profile(df: DataFrame, ts: str, null_col: str | None = None) -> DataFrame:
    """total, min/max of a text timestamp (parsed, not compared as text), nulls."""
    t = parse_ts(ts)
    aggs = [F.count(F.lit(1)).alias("total"),
            F.date_format(F.min(t), "yyyy-MM-dd HH:mm:ss").alias("min_date"),
            F.date_format(F.max(t), "yyyy-MM-dd HH:mm:ss").alias("max_date")]
    if null_col:
        aggs.append(_count(F.col(null_col).isNull()).alias(f"null_{null_col}"))
    return df.agg(*aggs)


def numeric_text_profile(df: DataFrame, col: str) -> DataFrame:
    """Blank count and min/max/avg over a numeric text column."""
    v = numeric_text(col, 38, 10)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        _count(blank_or_null(col)).alias(f"null_{col}"),
        F.min(v).cast("double").alias(f"min_{col}"),
        F.max(v).cast("double").alias(f"max_{col}"),
        F.round(F.sum(v).cast("double") / F.count(v), 6).alias(f"avg_{col}"),
    )


def value_total_profile(df: DataFrame, col: str) -> DataFrame:
    """total, exact sum, and count of non-positive values."""
    v = numeric_text(col, 38, 10)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(v).cast("double").alias("total_value"),
        _count(v <= 0).alias("invalid_values"),
    )


def domain_violations(df: DataFrame, col: str, low, high, alias: str) -> DataFrame:
    """Values outside [low, high]; NULL/blank values are not counted."""
    v = numeric_text(col)
    return df.agg(F.count(F.lit(1)).alias("total"), _count((v < low) | (v > high)).alias(alias))


def missing_count(df: DataFrame, cols: Sequence[str], alias: str) -> DataFrame:
    """Rows where any of ``cols`` IS NULL (an empty string is not missing)."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.agg(F.count(F.lit(1)).alias("total"), _count(cond).alias(alias))


def distinct_profile(df: DataFrame, key: str, alias: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_distinct(key).alias(alias))


def value_distribution(df: DataFrame, col: str, alias: str = "n") -> DataFrame:
    """Row count per value, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(alias)) \
        .orderBy(F.col(alias).desc(), F.col(col).asc_nulls_last())


def duplicate_keys(df: DataFrame, keys: Sequence[str], alias: str = "n") -> DataFrame:
    """Keys appearing more than once (GROUP BY ... HAVING COUNT(*) > 1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias)).filter(F.col(alias) > 1)


def compare_count(df: DataFrame, cond: Column, alias: str) -> DataFrame:
    return df.agg(_count(cond).alias(alias))


def null_key_rows(df: DataFrame, keys: Sequence[str], alias: str = "incomplete_rows") -> DataFrame:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return df.agg(_count(cond).alias(alias))


def compare_counts(now: DataFrame, recorded: DataFrame, label: str = "table_name",
                   count: str = "total_rows") -> DataFrame:
    """Counts beside those of a recorded snapshot; a table only one side has does not match."""
    old = recorded.select(label, F.col(count).alias("expected_rows"))
    return now.select(label, count).join(old, label, "full").withColumn(
        "matches", F.coalesce(F.col(count) == F.col("expected_rows"), F.lit(False)))


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
            alias: str) -> DataFrame:
    return orphan_count(child, child_key, parent, parent_key, alias)
