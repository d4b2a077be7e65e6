"""Structured Streaming Bronze and Silver for orders.

* Bronze: file stream over ``ingestion_date=*`` folders with a declared
  schema, audit columns, appended to a parquet table (the checkpoint tracks
  which files were taken: each file is processed once).
* Silver: stream over Bronze -> projection, date parse, status
  normalisation -> first-arrival dedupe on ``order_id`` -> expectations ->
  append. Without a watermark the dedupe state grows with the number of keys
  (as in the source system); ``dedupe_watermark`` bounds it with
  ``dropDuplicatesWithinWatermark``.
* Expectations run on the deduplicated output inside ``foreachBatch``:
  a hard rule stops the query on the first violating batch, soft rules keep
  the rows and append violation counts to a metrics table.

Both use ``trigger(availableNow=True)``: process what is there, then stop.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.audit import with_load_audit
from ..functions.dates import parse_date
from ..functions.text import upper_trim
from ..session import session_conf
from ..sources.files import read_json_stream, read_parquet_stream
from .expectations import Expectation, apply_expectations

# Columns of the streaming Silver table.
SILVER_ORDER_COLUMNS = ("order_id", "customer_id", "order_date", "status", "total_amount",
                        "currency", "created_at", "updated_at", "_ingestion_ts")

# The two order expectations (name, rule, action).
ORDER_EXPECTATIONS = (
    Expectation("valid_order_id", "order_id IS NOT NULL", "fail"),
    Expectation("valid_amount", "total_amount >= 0 OR total_amount IS NULL", "warn"),
)


def bronze_stream(spark: SparkSession, raw_path: str, schema: T.StructType,
                  load_ts: datetime | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    src = read_json_stream(spark, f"{raw_path.rstrip('/')}/ingestion_date=*", schema,
                           max_files_per_trigger)
    return with_load_audit(src, load_ts)


def run_bronze(spark: SparkSession, raw_path: str, schema: T.StructType, bronze_path: str,
               checkpoint: str, load_ts: datetime | None = None) -> None:
    q = (bronze_stream(spark, raw_path, schema, load_ts)
         .writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .option("path", bronze_path).partitionBy("ingestion_date")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def silver_projection(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns({"order_date": parse_date("order_date", "yyyy-MM-dd"),
                               "status": upper_trim("status")}).select(*SILVER_ORDER_COLUMNS)


def silver_stream(spark: SparkSession, bronze_path: str, bronze_schema: T.StructType,
                  dedupe_watermark: str | None = None) -> DataFrame:
    src = read_parquet_stream(spark, bronze_path, bronze_schema)
    proj = silver_projection(src)
    if dedupe_watermark:
        return proj.withWatermark("_ingestion_ts", dedupe_watermark) \
            .dropDuplicatesWithinWatermark(["order_id"])
    return proj.dropDuplicates(["order_id"])


def write_batch(batch: DataFrame, batch_id: int, silver_path: str, metrics_path: str,
                expectations=ORDER_EXPECTATIONS) -> None:
    """One micro-batch into its own folder ``stream_batch=<id>`` of both tables. A batch
    that is replayed after a failure replaces what its first try left. The tables and
    the checkpoint that numbers the batches belong together."""
    batch = batch.persist()  # read twice: rule counts, then the write
    try:
        kept = apply_expectations(batch, expectations, metrics_path, batch_id)
        kept.write.mode("overwrite").parquet(f"{silver_path}/stream_batch={batch_id}")
    finally:
        batch.unpersist()


def run_silver(spark: SparkSession, bronze_path: str, bronze_schema: T.StructType,
               silver_path: str, metrics_path: str, checkpoint: str,
               expectations=ORDER_EXPECTATIONS, dedupe_watermark: str | None = None) -> None:
    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, silver_path, metrics_path, expectations)

    q = (silver_stream(spark, bronze_path, bronze_schema, dedupe_watermark)
         .writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


# The state of a stream without a watermark outgrows the executors' heap: it is kept by RocksDB on their
# disks, of each batch only the changes go to the checkpoint.
_STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def first_arrival_stream(spark: SparkSession, folder: str, schema: T.StructType,
                         keys: list[str], out_path: str, checkpoint: str,
                         max_files_per_trigger: int | None = 1) -> None:
    """Generic first-arrival-wins stream dedupe: a file stream, one file per
    trigger (``None``: all that are new), ``dropDuplicates(keys)``, appended to ``out_path``."""
    src = read_parquet_stream(spark, folder, schema, max_files_per_trigger)
    with session_conf(spark, _STATE_ON_DISK):  # the query keeps what it starts with
        q = (src.dropDuplicates(keys).writeStream.format("parquet")
             .option("checkpointLocation", checkpoint).option("path", out_path)
             .trigger(availableNow=True).start())
    q.awaitTermination()
