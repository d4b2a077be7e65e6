"""Referential integrity: orphans as anti joins on pre-aggregated keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame,
                parent_key: str) -> DataFrame:
    """Distinct child keys without a parent, with their row counts.

    Written as an explicit anti join. Catalyst may push it below the per-key
    count; then a small parent side becomes a broadcast anti join (no shuffle
    of the child on its key) and a large one a sort-merge anti join whose hot
    partitions AQE splits. A NULL key never matches and counts as an orphan,
    like ``LEFT JOIN ... WHERE parent.key IS NULL``.
    """
    per_key = child.groupBy(F.col(child_key).alias("__k")).agg(F.count(F.lit(1)).alias("rows"))
    parents = parent.select(F.col(parent_key).alias("__p"))
    return per_key.join(parents, per_key["__k"] == parents["__p"], "left_anti") \
        .withColumnRenamed("__k", child_key)


def orphan_count(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
                 alias: str = "orphans") -> DataFrame:
    return orphan_keys(child, child_key, parent, parent_key) \
        .agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias(alias))
