"""Data-quality expectations for batch DataFrames and stream micro-batches.

An expectation is a SQL boolean rule with an action:

* ``fail`` -- any violating row stops the update (nothing of the batch is written);
* ``warn`` -- violating rows are kept and counted;
* ``drop`` -- violating rows are removed and counted.

A row violates a rule when the rule is false or NULL. All rules of a batch
are counted in one aggregation pass; only the counts (one row) reach the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Expectation:
    name: str
    rule: str
    action: str = "warn"  # fail | warn | drop


class ExpectationFailed(RuntimeError):
    pass


METRICS_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("expectation", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("violations", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("ts_utc", T.TimestampType()),
])


def _ok(e: Expectation):
    return F.coalesce(F.expr(e.rule), F.lit(False))


def expectation_counts(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row: total rows and violations per expectation."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(~_ok(e)).alias(e.name) for e in expectations]
    return df.agg(*aggs)


def apply_expectations(df: DataFrame, expectations: Sequence[Expectation],
                       metrics_path: str | None = None, batch_id: int = 0) -> DataFrame:
    """Count violations, enforce ``fail`` rules, return the rows to write."""
    if not expectations:
        return df
    counts = expectation_counts(df, expectations).collect()[0]
    rows = int(counts["rows"])
    if metrics_path is not None:
        now = datetime.now(timezone.utc)
        recs = [(int(batch_id), e.name, e.action, int(counts[e.name]), rows, now)
                for e in expectations]
        df.sparkSession.createDataFrame(recs, METRICS_SCHEMA).coalesce(1) \
            .write.mode("overwrite").parquet(f"{metrics_path}/stream_batch={int(batch_id)}")
    failed = [e.name for e in expectations if e.action == "fail" and counts[e.name]]
    if failed:
        raise ExpectationFailed(f"expectations failed in batch {batch_id}: {failed}")
    out = df
    for e in expectations:
        if e.action == "drop":
            out = out.filter(_ok(e))
    return out
