"""Test tables -> the shapes the pipeline consumes.

The provided tables are TPC-H-like; the pipeline's inputs are retail source
entities (orders, customers, items, stores, inventory, a change log). These
adapters derive them deterministically with Spark, so every query's work
grows with the input tables. "Dirt" (blank values, bad dates, null keys,
padding) is injected by fixed rules on the keys, identically in the SQL
oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import TS_TEXT

# Fixture status mapping (source letter -> pipeline status).
STATUS_BY_LETTER = {"F": "DELIVERED", "O": "SHIPPED", "P": "PROCESSING"}
OLIST_STATUS_BY_LETTER = {"F": "delivered", "O": "shipped", "P": "processing"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map_status(col: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for letter, status in mapping.items():
        expr = (F.when(col == letter, status) if expr is None
                else expr.when(col == letter, status))
    return expr


def api_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 as API-shaped records: text ids and dates, amount NULL for key % 11 = 0."""
    o = table(spark, sf_dir, "orders")
    ts_text = F.date_format("o_orderdate", TS_TEXT)
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        _map_status(F.col("o_orderstatus"), STATUS_BY_LETTER).alias("status"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("total_amount"),
        F.lit("BRL").alias("currency"),
        ts_text.alias("created_at"),
        ts_text.alias("updated_at"),
    )


def db_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 as database-extract rows (Olist column names, every column text)."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        _map_status(F.col("o_orderstatus"), OLIST_STATUS_BY_LETTER).alias("order_status"),
        F.date_format(d, TS_TEXT).alias("order_purchase_timestamp"),
        F.when(F.col("o_orderstatus") != "P", F.date_format(d + F.expr("INTERVAL 1 DAY"), TS_TEXT))
         .alias("order_approved_at"),
        F.lit(None).cast("string").alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "F", F.date_format(d + F.expr("INTERVAL 5 DAYS"), TS_TEXT))
         .alias("order_delivered_customer_date"),
        F.date_format(d + F.expr("INTERVAL 30 DAYS"), TS_TEXT).alias("order_estimated_delivery_date"),
    )


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 as text with padding, case noise, blank amounts, bad dates, NULL keys."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    key_text = k.cast("string")
    return o.select(
        F.when(k % 19 == 0, F.lit(None).cast("string"))
         .when(k % 5 == 0, F.concat(F.lit("  "), key_text, F.lit(" ")))
         .otherwise(key_text).alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(k % 3 == 0, F.lower(_map_status(F.col("o_orderstatus"), STATUS_BY_LETTER)))
         .otherwise(_map_status(F.col("o_orderstatus"), STATUS_BY_LETTER)).alias("status"),
        F.when(k % 13 == 0, F.lit(""))
         .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("total_amount"),
        F.when(k % 17 == 0, F.lit("bad-date"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a customer change log (key, tracked attribute, change time)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("segment"),
        F.col("ts").alias("updated_at"),
    )


def store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """purchase events as store sales."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("value").alias("amount"),
        F.col("ts").cast("date").alias("sale_date"),
        (F.col("user_id") % 10).alias("store_id"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line items as inventory observations."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").cast("date").alias("snapshot_date"),
        F.col("l_suppkey").alias("store_id"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """suppliers with their nation's region as stores."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"),
                     F.col("r_name").alias("region")))


def store_sales_with_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store sales carrying store attributes (the fallback input of dim_store)."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("store_id"), F.col("l_shipdate").cast("date").alias("sale_date"),
        F.col("l_extendedprice").alias("amount"))
    return li.join(stores(spark, sf_dir), "store_id")


def catalogue_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue-shaped products (name, category, sku, price)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sku"),
        F.col("p_retailprice").alias("price"),
        F.lit(None).cast("string").alias("updated_at"),
    )
