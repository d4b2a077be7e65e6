"""Incremental materialisation: high-water-mark slices and upserts.

``high_water_slice`` keeps only source rows newer than the target's maximum
(a scalar subquery, evaluated once). ``upsert_by_key`` replaces target rows
whose key appears in the update; for the common case where the key is the
partition column, ``write_partition_upsert`` lets Spark replace exactly the
touched partitions (dynamic partition overwrite) without rewriting the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_water_slice(source: DataFrame, target: DataFrame | None, column: str,
                     lookback_days: int = 0) -> DataFrame:
    """Rows of ``source`` with ``column > max(target.column) - lookback``.

    No target (first run) or an empty target means a full load, rather than
    comparing against NULL and selecting nothing. ``lookback_days > 0``
    re-reads recent dates so late rows for existing dates are picked up
    (the upsert then replaces those dates).
    """
    if target is None:
        return source
    hwm = target.select(F.max(column).alias("hwm")).scalar()
    if lookback_days:
        hwm = F.date_sub(hwm, lookback_days)
    return source.filter(hwm.isNull() | (F.col(column) > hwm))


def upsert_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``updates``, plus all of ``updates``.

    The anti join shuffles on the key only (the update side is typically the
    small one and AQE broadcasts it when its measured size allows).
    """
    keys = list(keys)
    kept = target.join(updates.select(*keys).distinct(), on=keys, how="left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def write_partition_upsert(updates: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Upsert where the unique key is the partition column: overwrite only the
    partitions present in ``updates``."""
    # Rebalance on the partition columns first: each task then writes whole
    # partitions (one file per value instead of one per task and value), and
    # AQE still splits a hot value or merges tiny ones.
    (updates.hint("rebalance", *partition_cols).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols)
     .parquet(path))


def upsert_partitions(updates: DataFrame, path: str, keys: Sequence[str],
                      partition_cols: Sequence[str]) -> None:
    """Upsert by ``keys`` into a table partitioned more coarsely than the key
    (e.g. a daily mart stored by month): only the partitions the updates touch
    are read, merged (old rows whose key is not updated + all updates) and
    replaced; every other partition is left as it is.

    The merged partitions are checkpointed before the overwrite, because a
    job may not overwrite files it is still reading.
    """
    from ..session import freeze, path_exists

    spark = updates.sparkSession
    keys, partition_cols = list(keys), list(partition_cols)
    if not path_exists(spark, path):
        merged = updates
    else:
        # Few values of a coarse partition column: as literals they prune the scan of the target.
        values = updates.select(*partition_cols).distinct().collect()
        hit = F.lit(False)
        for row in values:
            same = F.lit(True)
            for c in partition_cols:
                same = same & F.col(c).eqNullSafe(F.lit(row[c]))
            hit = hit | same
        current = spark.read.schema(updates.schema).parquet(path).filter(hit)
        merged = freeze(upsert_by_key(current, updates, keys))
    write_partition_upsert(merged, path, partition_cols)
