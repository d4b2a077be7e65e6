"""RAW trees derived from the test tables (FIXTURES F8-F11), written by Spark.

Used by the round-trip queries: the RAW files are produced from the given
tables by Spark jobs, so their size grows with the tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import ORDERS
from . import standins as S
from .landing import extract_to_raw

RUN1 = datetime(2024, 1, 1, 2, 0, 0, tzinfo=timezone.utc)
RUN2 = datetime(2024, 1, 2, 2, 0, 0, tzinfo=timezone.utc)


def _key(df: DataFrame) -> F.Column:
    return F.col("order_id").cast("long")


def write_mixed_raw_tree(spark: SparkSession, sf_dir: str, base: str) -> str:
    """F8: one RAW folder for orders holding

    * database-extract JSON-lines chunks (key % 10 in 0..6) under
      ``ingestion_date=/hour=/batch_id=/chunk=``;
    * API pages, each one JSON array file (key % 10 in 7..8), under another date;
    * a file outside any ``ingestion_date=`` folder (key % 10 = 9);
    * a ``_runs/`` manifest that readers must ignore.
    """
    raw = f"{base}/raw"
    db = S.db_orders(spark, sf_dir)
    db = db.filter(_key(db) % 10 <= 6)
    extract_to_raw(spark, db, ORDERS, raw, f"{base}/control", mode="initial", chunk_size=2000,
                   run_ts=RUN1)
    api = S.api_orders(spark, sf_dir)
    pages = api.filter((_key(api) % 10).isin(7, 8))
    write_pages(pages, f"{raw}/orders/ingestion_date=2024-01-02", per_page=1000,
                envelope=None, order_key=_key(pages))
    stray = api.filter(_key(api) % 10 == 9)
    stray.write.mode("errorifexists").json(f"{raw}/orders/manual_drop")
    spark.range(1).select(F.lit("run").alias("run_id"), F.lit("completed").alias("status")) \
        .write.mode("errorifexists").json(f"{raw}/orders/_runs")
    return f"{raw}/orders"


def write_pages(df: DataFrame, folder: str, per_page: int, envelope: str | None,
                order_key: F.Column, entity: str = "orders") -> None:
    """Group records into pages of ``per_page`` (by key order) and land each page
    as one JSON document. ``envelope``: None = bare list, or the field name the
    list sits under; ``"cycle"`` rotates bare / ``items`` / entity by page.
    A page is bounded by ``per_page`` records, so building it in one task is safe."""
    rec = F.struct(*[F.col(c) for c in df.columns])
    paged = df.withColumn("page", (F.floor(order_key / per_page) + 1).cast("int"))
    grouped = paged.groupBy("page").agg(F.collect_list(rec).alias("items"))
    if envelope == "cycle":
        body = (F.when(F.col("page") % 3 == 0, F.to_json("items"))
                .when(F.col("page") % 3 == 1, F.to_json(F.struct(F.col("items").alias("items"))))
                .otherwise(F.to_json(F.struct(F.col("items").alias(entity)))))
    elif envelope:
        body = F.to_json(F.struct(F.col("items").alias(envelope)))
    else:
        body = F.to_json("items")
    grouped.select("page", body.alias("value")).write.mode("append") \
        .partitionBy("page").text(folder)


def write_page_set(spark: SparkSession, sf_dir: str, folder: str, per_page: int = 1000) -> None:
    """API pages of all F1 orders in turning envelopes, and an empty page."""
    api = S.api_orders(spark, sf_dir)
    write_pages(api, folder, per_page, "cycle", _key(api))
    spark.range(1).select(F.lit(0).alias("page"), F.lit("[]").alias("value")) \
        .write.mode("append").partitionBy("page").text(folder)


def write_drift_batches(spark: SparkSession, sf_dir: str, bronze_path: str) -> None:
    """two appends to one Bronze table; the second adds a column and lacks one."""
    api = S.api_orders(spark, sf_dir)
    k = _key(api)
    first = api.filter(k % 2 == 0).withColumn("ingestion_date", F.lit("2024-01-01"))
    second = (api.filter(k % 2 == 1).drop("currency")
              .withColumn("sales_channel", F.lit("web"))
              .withColumn("ingestion_date", F.lit("2024-01-02")))
    first.write.mode("append").partitionBy("ingestion_date").parquet(bronze_path)
    second.write.mode("append").partitionBy("ingestion_date").parquet(bronze_path)


def write_lineitem_replay(spark: SparkSession, sf_dir: str, folder: str) -> Iterator[int | None]:
    """lineitem split into four file groups by ``l_orderkey % 4``, landed one after the other;
    each is there when its number is given out."""
    part = F.col("l_orderkey") % 4
    li = S.table(spark, sf_dir, "lineitem").withColumn("part", part)
    groups = sorted((r["part"] for r in li.select("part").distinct().collect()), key=lambda k: (k is not None, k))  # 0 to 3, NULL, or negative
    for k in groups:
        li.filter(F.col("part").eqNullSafe(F.lit(k))).write.mode("append").partitionBy("part").parquet(folder)
        yield k


def write_api_raw(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """API-shaped orders as JSON lines under four ``ingestion_date=`` folders."""
    api = S.api_orders(spark, sf_dir)
    dated = api.withColumn(
        "ingestion_date",
        F.concat(F.lit("2024-01-0"), ((_key(api) % 4) + 1).cast("string")))
    dated.write.mode("errorifexists").partitionBy("ingestion_date").json(folder)
