"""Rule runner: named checks -> one verdict row each.

Each check is a one-row DataFrame with a single count column; the verdict
compares it with the allowed maximum (0 for the integrity rules). The checks
run as separate small Spark jobs; only their one-row results are combined.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_rules(checks: Mapping[str, DataFrame], allowed: Mapping[str, int] | None = None) -> DataFrame:
    allowed = dict(allowed or {})
    parts = []
    for name, df in checks.items():
        col = df.columns[0]
        parts.append(df.select(F.lit(name).alias("rule"),
                               F.col(col).cast("long").alias("violations"),
                               F.lit(allowed.get(name, 0)).cast("long").alias("allowed")))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("passed", F.col("violations") <= F.col("allowed")).drop("allowed")
