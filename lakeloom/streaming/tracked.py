"""Streams that follow their source's schema, and streams that keep the latest version.

* ``run_bronze_tracked``: the stream carries the *names* of new files only; its checkpoint
  takes each file once, ``max_files`` a batch. Each batch looks for columns that neither
  the declared schema nor the schema log has, in exactly the files it is about to load,
  records them, and reads the files under the grown schema. No file is read under a schema
  older than itself, and the query is not stopped for a new column. New columns are text
  whatever they hold, so a later change of their type is no conflict between Bronze files.
  Rows that do not fit go to ``rejected=true``. A batch owns its folder.
* ``run_first``: the first arrival of a key wins. The keyed table itself is the state, on
  disk and by bucket, so neither memory nor a time bound limits how many keys there are.
* ``run_latest``: micro-batches are merged by key and rank into a keyed table
  (``sinks.keyed``). A batch that is delivered again, or arrives late, changes nothing
  that a newer version has set.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.audit import with_load_audit
from ..plans.medallion import SilverRule, silver_versions
from ..session import list_names
from ..sinks.keyed import BUCKETS, RANK, merge_latest
from ..sources.files import CORRUPT, read_json_tree

FILE_FIELDS = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


# --------------------------------------------------------------------------- schema log
def logged_schema(spark: SparkSession, log: str) -> T.StructType | None:
    """The last schema recorded under ``log``."""
    versions = [n for n in list_names(spark, log) if n.startswith("v")]
    if not versions:
        return None
    text = spark.read.option("wholetext", "true").text(f"{log}/{versions[-1]}").collect()[0][0]
    return T.StructType.fromJson(json.loads(text))


def record_schema(spark: SparkSession, log: str, schema: T.StructType) -> None:
    version = len([n for n in list_names(spark, log) if n.startswith("v")])
    (spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
     .write.mode("overwrite").text(f"{log}/v{version:08d}"))


def grown(held: T.StructType, seen: T.StructType) -> T.StructType:
    """``held`` and, as text, the columns of ``seen`` that it lacks (names differ in more than case)."""
    names = {f.name.lower() for f in held.fields}
    more = [T.StructField(f.name, T.StringType()) for f in seen.fields if f.name.lower() not in names and f.name != CORRUPT]
    return T.StructType([*held.fields, *more])


# --------------------------------------------------------------------------- bronze
def load_files(spark: SparkSession, paths: list[str], declared: T.StructType, log: str, target: str,
               load_ts: datetime | None = None) -> None:
    """Load ``paths`` into ``target``, which they own, under the schema that they make the log grow to."""
    held = logged_schema(spark, log) or declared
    schema = grown(held, read_json_tree(spark, paths).schema)
    if schema != held or logged_schema(spark, log) is None:
        record_schema(spark, log, schema)
    rows = read_json_tree(spark, paths, T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]), CORRUPT)
    (with_load_audit(rows, load_ts).withColumn("rejected", F.col(CORRUPT).isNotNull())
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("rejected", "ingestion_date").parquet(target))


def run_bronze_tracked(spark: SparkSession, raw_path: str, declared: T.StructType, bronze_path: str, checkpoint: str,
                       load_ts: datetime | None = None, max_files: int = 1_000) -> None:
    def sink(files: DataFrame, batch: int) -> None:
        paths = [r["path"] for r in files.collect()]  # `max_files` at most
        if paths:
            load_files(spark, paths, declared, f"{bronze_path}/_schemas", f"{bronze_path}/stream_batch={batch}", load_ts)

    names = (spark.readStream.format("binaryFile").schema(FILE_FIELDS).option("maxFilesPerTrigger", str(max_files))
             .load(f"{raw_path.rstrip('/')}/ingestion_date=*").filter("length > 0").select("path"))
    (names.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def read_tracked(spark: SparkSession, bronze_path: str, rejected: bool = False) -> DataFrame:
    """Rows of all batches, with every column that any file has brought."""
    rows = spark.read.option("mergeSchema", "true").parquet(bronze_path)
    rows = rows.filter(F.col("rejected") == str(rejected).lower()).drop("rejected")
    return rows if rejected else rows.drop(CORRUPT)


# --------------------------------------------------------------------------- latest wins
def run_latest(source: DataFrame, rule: SilverRule, path: str, checkpoint: str, buckets: int = BUCKETS) -> None:
    """Merge the streaming ``source`` (Bronze rows) into the keyed table at ``path``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        merge_latest(silver_versions(batch, rule), path, rule.keys, f"batch-{batch_id:010d}", buckets)

    (source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def run_first(source: DataFrame, keys: list[str], path: str, checkpoint: str, buckets: int = BUCKETS) -> None:
    """Keep the row of each key that arrived first: batches in their order, rows of one batch by a hash."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        rank = F.struct(F.lit(-batch_id).cast("long").alias("batch"), F.xxhash64(*batch.columns).alias("row"))
        merge_latest(batch.dropna(subset=keys).withColumn(RANK, rank), path, keys, f"batch-{batch_id:010d}", buckets)

    (source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
