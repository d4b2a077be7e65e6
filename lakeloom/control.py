"""Run metadata as append-only control tables.

Checkpoints (extract cursors), run manifests and job-run records are small
rows appended to parquet tables; the "current" value is the latest row per
key. A control row is written only after the data it describes has been
written, so a crash leaves the previous cursor in force (the rerun re-extracts
the same rows into a new batch, which Silver deduplicates). These are the
only rows the driver reads back: one per table/run, never data rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.dedupe import latest_by
from .session import path_exists

# Fields of the control records.
CHECKPOINT_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("watermark_column", T.StringType()),
    T.StructField("pk_column", T.StringType()),
    T.StructField("last_watermark", T.StringType()),
    T.StructField("last_pk", T.StringType()),
    T.StructField("last_chunk_index", T.LongType()),
    T.StructField("last_success_utc", T.StringType()),
    T.StructField("row_count_last_run_table_total", T.LongType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("last_raw_file_path", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
])

MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("started_utc", T.StringType()),
    T.StructField("ended_utc", T.StringType()),
    T.StructField("chunk_size", T.LongType()),
    T.StructField("table", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("chunks", T.LongType()),
    T.StructField("raw_path", T.StringType()),
    T.StructField("null_watermark_rows", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
])

JOB_RUN_SCHEMA = T.StructType([
    T.StructField("job_name", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("ts_utc", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("error_message", T.StringType()),
])


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _append(spark: SparkSession, path: str, rows: Sequence[dict], schema: T.StructType) -> None:
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a control table; none if it was never written. An unreadable table fails loudly."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


# --------------------------------------------------------------------------- checkpoints
def save_checkpoint(spark: SparkSession, path: str, record: dict) -> None:
    _append(spark, path, [{**record, "committed_at": _now()}], CHECKPOINT_SCHEMA)


def checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """Latest checkpoint per (table, mode): the two modes never share a cursor."""
    cp = _read(spark, path, CHECKPOINT_SCHEMA)
    return latest_by(cp, ["table", "mode"], [F.col("committed_at").desc()])


def load_checkpoint(spark: SparkSession, path: str, table: str, mode: str) -> dict:
    rows = checkpoints(spark, path).filter((F.col("table") == table) & (F.col("mode") == mode)) \
        .collect()
    return rows[0].asDict() if rows else {}


# --------------------------------------------------------------------------- manifests
def record_run(spark: SparkSession, path: str, rows: Sequence[dict]) -> None:
    _append(spark, path, [{**r, "committed_at": _now()} for r in rows], MANIFEST_SCHEMA)


def table_status(spark: SparkSession, path: str) -> DataFrame:
    """Final status per (run, table): one whose last row is still ``running``
    never finished (crash, lost connection) and is reported as ``failed``."""
    m = _read(spark, path, MANIFEST_SCHEMA)
    last = latest_by(m, ["run_id", "table"], [F.col("committed_at").desc()])
    return last.withColumn(
        "status", F.when(F.col("status") == "running", F.lit("failed")).otherwise(F.col("status")))


def run_status(spark: SparkSession, path: str) -> DataFrame:
    """One row per run: failed if any of its tables failed, then skipped states, else completed."""
    failed = F.count_if(F.col("status") == "failed")
    other = F.max(F.when(F.col("status") != "completed", F.col("status")))
    done = F.count_if(F.col("status") == "completed")
    return table_status(spark, path).groupBy("run_id").agg(
        F.when(failed > 0, "failed").when(done > 0, "completed").otherwise(other).alias("status"),
        F.count("*").alias("tables"), failed.alias("failed_tables"),
        F.sum("rows").alias("rows"), F.sum("chunks").alias("chunks"))


def committed_batches(spark: SparkSession, path: str) -> DataFrame:
    """(table, batch_id) of the extracts whose data is complete."""
    return table_status(spark, path).filter(F.col("status") == "completed").select(
        "table", F.col("run_id").alias("batch_id"))


# --------------------------------------------------------------------------- job runs
def log_job_run(spark: SparkSession, path: str, job_name: str, run_id: str, status: str,
                duration_seconds: float | None = None, error_message: str | None = None) -> None:
    _append(spark, path, [{"job_name": job_name, "run_id": run_id, "status": status,
                           "ts_utc": _now().isoformat(), "duration_seconds": duration_seconds,
                           "error_message": error_message}], JOB_RUN_SCHEMA)


def job_runs(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, JOB_RUN_SCHEMA)
