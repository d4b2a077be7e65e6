"""Queries for the documented-only features and the rule runner."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import TS_TEXT_MICROS
from ..operators.access import hash_mask, restricted_view
from ..operators.asof import as_of_join
from ..operators.scd2 import scd2
from ..quality import checks as Q
from ..quality.rules import run_rules
from ..session import scratch_path
from ..sinks import writers as W
from . import medallion as M
from . import raw_fixtures as RF
from . import standins as S
from .catalog import SQL_F1, SQL_F7, query
from .catalog_io import API_SCHEMA
from .landing import bronze_load


@query("fact_dim_asof", """
WITH v AS (
  SELECT user_id, event_type AS segment, ts AS effective_from FROM events WHERE event_type <> 'purchase'),
f AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT f.event_id, f.user_id, strftime(f.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, v.segment
FROM f ASOF LEFT JOIN v ON f.user_id = v.user_id AND f.ts >= v.effective_from""")
def q_fact_dim_asof(spark, sf):
    """Each purchase joined to the customer's segment valid at purchase time
    (SCD2 versions from the other events; linear, no version x fact pairs)."""
    ev = S.table(spark, sf, "events")
    changes = ev.filter(F.col("event_type") != "purchase").select(
        F.col("user_id").alias("customer_id"), F.col("event_type").alias("segment"),
        F.col("ts").alias("updated_at"))
    dim = scd2(changes, ["customer_id"], "updated_at", ["segment"])
    facts = ev.filter(F.col("event_type") == "purchase") \
        .select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    out = as_of_join(facts, "user_id", "ts", dim, "customer_id", "effective_from", ["segment"])
    return out.select("event_id", "user_id", F.date_format("ts", TS_TEXT_MICROS).alias("ts"),
                      "segment")


@query("quality_verdicts", f"""
WITH {SQL_F7}
SELECT 'orphan_orders' AS rule, COUNT(*) AS violations, COUNT(*) = 0 AS passed
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 7 <> 0) c
  ON o.o_custkey = c.c_custkey WHERE c.c_custkey IS NULL
UNION ALL
SELECT 'orphan_items', COUNT(*), COUNT(*) = 0
FROM lineitem l LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 13 <> 0) o
  ON l.l_orderkey = o.o_orderkey WHERE o.o_orderkey IS NULL
UNION ALL
SELECT 'invalid_scores', COUNT(*) FILTER (WHERE l_linenumber < 1 OR l_linenumber > 5),
       COUNT(*) FILTER (WHERE l_linenumber < 1 OR l_linenumber > 5) = 0 FROM lineitem
UNION ALL
SELECT 'invalid_dates', COUNT(*), COUNT(*) = 0
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_shipdate < o.o_orderdate
UNION ALL
SELECT 'incomplete_rows', COUNT(*) FILTER (WHERE order_id IS NULL OR customer_id IS NULL),
       COUNT(*) FILTER (WHERE order_id IS NULL OR customer_id IS NULL) = 0 FROM f7""")
def q_quality_verdicts(spark, sf):
    """The pass rules of the source checks: each count must be 0."""
    from .catalog import q_date_consistency

    cust = S.table(spark, sf, "customer").filter(F.col("c_custkey") % 7 != 0)
    orders = S.table(spark, sf, "orders")
    li = S.table(spark, sf, "lineitem")
    scores = li.select(F.col("l_linenumber").cast("string").alias("review_score"))
    return run_rules({
        "orphan_orders": Q.orphans(orders, "o_custkey", cust, "c_custkey", "n"),
        "orphan_items": Q.orphans(li, "l_orderkey", orders.filter(F.col("o_orderkey") % 13 != 0),
                                  "o_orderkey", "n"),
        "invalid_scores": Q.domain_violations(scores, "review_score", 1, 5, "n").select("n"),
        "invalid_dates": q_date_consistency(spark, sf),
        "incomplete_rows": Q.null_key_rows(S.dirty_orders(spark, sf), ["order_id", "customer_id"]),
    })


@query("raw_replay", f"""
WITH {SQL_F1}
SELECT order_id, CAST('2024-01-0' || CAST(CAST(order_id AS BIGINT) % 4 + 1 AS VARCHAR) AS DATE)
         AS ingestion_date
FROM f1 WHERE CAST(order_id AS BIGINT) % 4 + 1 IN (2, 3)""")
def q_raw_replay(spark, sf):
    """Replay a date range from RAW: partition pruning on ``ingestion_date``."""
    folder = scratch_path(spark, "replay")
    RF.write_api_raw(spark, sf, folder)
    schema = T.StructType(list(API_SCHEMA.fields) + [T.StructField("ingestion_date", T.DateType())])
    raw = spark.read.schema(schema).json(folder)
    picked = raw.filter(F.col("ingestion_date").between(F.lit("2024-01-02").cast("date"),
                                                        F.lit("2024-01-03").cast("date")))
    return picked.select("order_id", "ingestion_date")


@query("bronze_new_files", """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END
         AS ingestion_date, COUNT(*) AS n
FROM orders GROUP BY 1""")
def q_bronze_new_files(spark, sf):
    """Three Bronze loads over a growing RAW folder; files already loaded are
    skipped (anti join on the loaded file list), so nothing is appended twice."""
    base = scratch_path(spark, "bronze_inc")
    api = S.api_orders(spark, sf)
    k = F.col("order_id").cast("long")
    bronze = f"{base}/bronze"
    api.filter(k % 2 == 0).write.json(f"{base}/raw/ingestion_date=2024-01-01")
    for i, more in enumerate((None, 1, None)):
        if more is not None:
            api.filter(k % 2 == 1).write.json(f"{base}/raw/ingestion_date=2024-01-02")
        loaded = W.read_merged(spark, bronze).select("_source_file") if i else None
        batch = bronze_load(spark, f"{base}/raw", "orders", API_SCHEMA, load_ts=RF.RUN1,
                            loaded_files=loaded)
        W.append_partitioned(batch, bronze)
    b = W.read_merged(spark, bronze)
    return b.groupBy(F.col("ingestion_date").cast("date").alias("ingestion_date")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("restricted_customers", """
SELECT c_custkey, sha256(c_name) AS c_name, c_nationkey, c_mktsegment FROM customer
WHERE c_mktsegment <> 'AUTOMOBILE'""")
def q_restricted_customers(spark, sf):
    """Row filter + column mask as a view definition."""
    c = S.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return restricted_view(c, F.col("c_mktsegment") != "AUTOMOBILE", {"c_name": hash_mask("c_name")})


@query("silver_order_items", """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id
FROM lineitem""")
def q_silver_order_items(spark, sf):
    """Generic Silver for another registry entity (composite key)."""
    li = S.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("string").alias("price"))
    s = M.silver_generic(li, ["order_id", "order_item_id"], ["shipping_limit_date"])
    return s.select("order_id", "order_item_id")
