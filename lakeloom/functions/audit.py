"""Audit columns and batch identity.

``with_load_audit`` adds the load timestamp, the source file and the
``ingestion_date`` parsed from the file path. The load timestamp is a value
passed in by the caller (one per run), so reruns and retries of the same
batch produce identical rows.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# RAW partition layout.
INGESTION_DATE_PATTERN = r"ingestion_date=(\d{4}-\d{2}-\d{2})"
BATCH_ID_FORMAT = "%Y%m%dT%H%M%SZ"
DATE_FORMAT = "%Y-%m-%d"


# --- batch identity (plain values that feed lit()s and paths) --------------
def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def ingestion_date_utc(now: datetime | None = None) -> str:
    return (now or utc_now()).astimezone(timezone.utc).strftime(DATE_FORMAT)


def batch_id(now: datetime | None = None) -> str:
    return (now or utc_now()).astimezone(timezone.utc).strftime(BATCH_ID_FORMAT)


def raw_path(base: str, entity: str, ingestion_dt: str | None = None, suffix: str = "") -> str:
    dt = ingestion_dt or ingestion_date_utc()
    return f"{base.rstrip('/')}/data/raw/{entity}/ingestion_date={dt}{suffix}"


# --- columns ----------------------------------------------------------------
def ingestion_date_from_path(path_col: Column) -> Column:
    """``ingestion_date=YYYY-MM-DD`` from a file path; no match -> NULL date."""
    text = F.regexp_extract(path_col, INGESTION_DATE_PATTERN, 1)
    return F.nullif(text, F.lit("")).cast("date")


def load_ts_literal(load_ts: datetime | None) -> Column:
    """One load timestamp per run (pinned), or the query start time."""
    if load_ts is None:
        return F.current_timestamp()
    if load_ts.tzinfo is None:
        load_ts = load_ts.replace(tzinfo=timezone.utc)
    return F.lit(load_ts).cast("timestamp")


def with_load_audit(df: DataFrame, load_ts: datetime | None = None,
                    file_col: Column | None = None) -> DataFrame:
    """Bronze audit columns.

    * a source ``_ingestion_ts`` (stamped by the extractor) is preserved as
      ``_source_ingestion_ts`` -- the load time takes the ``_ingestion_ts`` name;
    * ``_source_file`` from the hidden ``_metadata.file_path`` column (batch
      and streaming file sources), or the column given;
    * ``ingestion_date`` parsed from that path.
    """
    if "_ingestion_ts" in df.columns:
        df = df.withColumnRenamed("_ingestion_ts", "_source_ingestion_ts")
    src = file_col if file_col is not None else F.col("_metadata.file_path")
    return df.withColumns({
        "_ingestion_ts": load_ts_literal(load_ts),
        "_source_file": src,
    }).withColumn("ingestion_date", ingestion_date_from_path(F.col("_source_file")))


def stamp_records(df: DataFrame, table: str, ingestion_ts_iso: str, run_id: str, mode: str,
                  chunk_col: Column) -> DataFrame:
    """Extractor stamping columns on every RAW line."""
    return df.withColumns({
        "_source_table": F.lit(table),
        "_ingestion_ts": F.lit(ingestion_ts_iso),
        "_batch_id": F.lit(run_id),
        "_ingestion_mode": F.lit(mode),
        "_chunk_index": chunk_col.cast("int"),
    })
