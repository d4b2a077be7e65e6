"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame, plus DuckDB oracles.

Every query reads the given tables (or data Spark derives from them) in
full. Oracle SQL is written independently against the same parquet views;
column names match the Spark side exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import TS_TEXT, TS_TEXT_MICROS, parse_date
from ..functions.text import clean_key, numeric_text, upper_trim
from ..operators.dedupe import latest_by
from ..operators.incremental import high_water_slice
from ..operators.keyset import assign_chunks, cursor_filter
from ..operators.scd2 import scd2
from ..operators.union import labelled_counts
from ..quality import checks as Q
from . import medallion as M
from . import standins as S

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


# --------------------------------------------------------------------------- SQL fixtures
# The same fixture definitions as plans/standins.py, written as DuckDB SQL.
SQL_F1 = """
f1 AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'SHIPPED'
                            WHEN 'P' THEN 'PROCESSING' END AS status,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS total_amount,
         'BRL' AS currency,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS updated_at
  FROM orders)"""

SQL_F7 = """
f7 AS (
  SELECT CASE WHEN o_orderkey % 19 = 0 THEN NULL
              WHEN o_orderkey % 5 = 0 THEN '  ' || CAST(o_orderkey AS VARCHAR) || ' '
              ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 3 = 0 THEN lower(s) ELSE s END AS status,
         CASE WHEN o_orderkey % 13 = 0 THEN ''
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS total_amount,
         CASE WHEN o_orderkey % 17 = 0 THEN 'bad-date'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date
  FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'SHIPPED'
                                     WHEN 'P' THEN 'PROCESSING' END AS s FROM orders))"""

SQL_DAILY = """
SELECT order_date,
       CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       COUNT(*) AS order_count
FROM {src} WHERE status IN ('COMPLETED', 'SHIPPED', 'DELIVERED') {extra}
GROUP BY order_date"""


# --------------------------------------------------------------------------- gold
def _silver_orders(spark, sf):
    bronze = M.bronze_canonical("orders", S.api_orders(spark, sf))
    return M.silver_orders(bronze)


def _fact_orders(spark, sf):
    return M.fact_orders(_silver_orders(spark, sf))


@query("daily_revenue", f"WITH {SQL_F1} {SQL_DAILY.format(src='f1', extra='')}")
def q_daily_revenue(spark, sf):
    """Flagship: API orders -> Bronze -> Silver (latest wins) -> fact -> daily mart."""
    return M.daily_revenue(_fact_orders(spark, sf))


@query("fact_orders", f"""
WITH {SQL_F1}
SELECT order_id, customer_id, order_date, status, total_amount, currency, created_at, updated_at,
       strftime(order_date, '%Y-%m') AS order_year_month
FROM f1""")
def q_fact_orders(spark, sf):
    return _fact_orders(spark, sf)


@query("daily_revenue_incremental", f"""
WITH {SQL_F1},
target AS ({SQL_DAILY.format(src='f1', extra="AND order_date < DATE '2000-01-01'")})
{SQL_DAILY.format(src='f1', extra='AND order_date > (SELECT max(order_date) FROM target)')}""")
def q_daily_revenue_incremental(spark, sf):
    fact = _fact_orders(spark, sf)
    target = M.daily_revenue(fact.filter(F.col("order_date") < F.lit("2000-01-01").cast("date")))
    return M.daily_revenue(high_water_slice(fact, target, "order_date"))


@query("fact_sales", f"""
WITH {SQL_F1},
online AS (SELECT *, 'online' AS channel, strftime(order_date, '%Y-%m') AS order_year_month FROM f1),
store AS (SELECT event_id AS id, value AS amount, CAST(ts AS DATE) AS sale_date,
                 user_id % 10 AS store_id, 'store' AS channel,
                 strftime(CAST(ts AS DATE), '%Y-%m') AS order_year_month
          FROM events WHERE event_type = 'purchase')
SELECT * FROM online UNION ALL BY NAME SELECT * FROM store""")
def q_fact_sales(spark, sf):
    return M.fact_sales(_silver_orders(spark, sf), S.store_sales(spark, sf))


@query("inventory_snapshot", """
SELECT l_partkey AS product_id, l_quantity AS on_hand_quantity,
       CAST(l_shipdate AS DATE) AS snapshot_date, l_suppkey AS store_id
FROM lineitem WHERE l_shipdate IS NOT NULL""")
def q_inventory_snapshot(spark, sf):
    return M.inventory_snapshot(S.inventory(spark, sf))


SQL_STORES = """
stores AS (SELECT s_suppkey AS store_id, s_name AS store_name, r_name AS region
           FROM supplier JOIN nation ON s_nationkey = n_nationkey
                         JOIN region ON n_regionkey = r_regionkey)"""


@query("dim_store", f"WITH {SQL_STORES} SELECT store_id, store_name, region FROM stores")
def q_dim_store(spark, sf):
    return M.dim_store(S.stores(spark, sf), None)


@query("dim_store_from_sales", f"""
WITH {SQL_STORES}
SELECT DISTINCT s.store_id, s.store_name, s.region
FROM lineitem l JOIN stores s ON l.l_suppkey = s.store_id""")
def q_dim_store_from_sales(spark, sf):
    return M.dim_store(None, S.store_sales_with_stores(spark, sf))


@query("dim_product", """
SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
       p_type AS category, p_brand AS sku, p_retailprice AS price,
       CAST(NULL AS VARCHAR) AS updated_at
FROM part""")
def q_dim_product(spark, sf):
    return M.dim_product(S.catalogue_products(spark, sf))


@query("dim_distinct", "SELECT DISTINCT p_brand, p_type, p_size FROM part")
def q_dim_distinct(spark, sf):
    return S.table(spark, sf, "part").select("p_brand", "p_type", "p_size").distinct()


# --------------------------------------------------------------------------- silver / windows
@query("silver_latest", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
                                            l_extendedprice DESC) AS rn
      FROM lineitem) WHERE rn = 1""")
def q_silver_latest(spark, sf):
    li = S.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_shipdate")
    order = [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    out = latest_by(li, ["l_orderkey", "l_linenumber"], order)
    return out.withColumn("l_shipdate", F.date_format("l_shipdate", TS_TEXT))


SQL_SCD_TS = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def _scd_out(df: DataFrame) -> DataFrame:
    return df.select(
        "customer_id", "segment",
        F.date_format("effective_from", TS_TEXT_MICROS).alias("effective_from"),
        F.date_format("effective_to", TS_TEXT_MICROS).alias("effective_to"),
        "is_current")


@query("scd2_versions", f"""
SELECT user_id AS customer_id, event_type AS segment,
       {SQL_SCD_TS.format(c='ts')} AS effective_from,
       {SQL_SCD_TS.format(c="coalesce(nxt, TIMESTAMP '9999-12-31 00:00:00')")} AS effective_to,
       nxt IS NULL AS is_current
FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM events)""")
def q_scd2_versions(spark, sf):
    return _scd_out(scd2(S.change_log(spark, sf), ["customer_id"], "updated_at", ["segment"]))


@query("scd2_collapsed", f"""
WITH lagged AS (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
kept AS (SELECT * FROM lagged WHERE prev IS NULL OR prev <> event_type)
SELECT user_id AS customer_id, event_type AS segment,
       {SQL_SCD_TS.format(c='ts')} AS effective_from,
       {SQL_SCD_TS.format(c="coalesce(nxt, TIMESTAMP '9999-12-31 00:00:00')")} AS effective_to,
       nxt IS NULL AS is_current
FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM kept)""")
def q_scd2_collapsed(spark, sf):
    return _scd_out(scd2(S.change_log(spark, sf), ["customer_id"], "updated_at", ["segment"],
                         collapse=True))


@query("clean_text", f"""
WITH {SQL_F7}
SELECT trim(order_id) AS order_id, upper(trim(status)) AS status,
       CAST(TRY_CAST(nullif(trim(total_amount), '') AS DECIMAL(38,10)) AS DOUBLE) AS total_amount,
       CAST(try_strptime(nullif(trim(order_date), ''), '%Y-%m-%d') AS DATE) AS order_date
FROM f7 WHERE nullif(trim(order_id), '') IS NOT NULL""")
def q_clean_text(spark, sf):
    df = S.dirty_orders(spark, sf)
    df = df.withColumn("order_id", clean_key("order_id")).filter(F.col("order_id").isNotNull())
    return df.select(
        "order_id",
        upper_trim("status").alias("status"),
        numeric_text("total_amount").cast("double").alias("total_amount"),
        parse_date("order_date", "yyyy-MM-dd").alias("order_date"),
    )


SQL_DB_ORDERS = """
db AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                            WHEN 'P' THEN 'processing' END AS order_status,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp,
         CASE WHEN o_orderstatus <> 'P'
              THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') END AS order_approved_at,
         CASE WHEN o_orderstatus = 'F'
              THEN strftime(o_orderdate + INTERVAL 5 DAY, '%Y-%m-%d %H:%M:%S') END
              AS order_delivered_customer_date,
         o_orderkey
  FROM orders)"""


@query("canonicalise", f"""
WITH {SQL_F1}, {SQL_DB_ORDERS}
SELECT order_id, customer_id, order_status AS status,
       CAST(order_purchase_timestamp AS DATE) AS order_date,
       order_purchase_timestamp AS created_at,
       coalesce(order_delivered_customer_date, order_approved_at, order_purchase_timestamp)
         AS updated_at,
       CAST(NULL AS DOUBLE) AS total_amount, 'BRL' AS currency
FROM db WHERE o_orderkey % 2 = 0
UNION ALL
SELECT order_id, customer_id, status, CAST(order_date AS DATE) AS order_date, created_at,
       updated_at, total_amount, currency
FROM f1 WHERE CAST(order_id AS BIGINT) % 2 = 1""")
def q_canonicalise(spark, sf):
    """Both source shapes through the same canonical rules, then one schema."""
    cols = ["order_id", "customer_id", "status", "order_date", "created_at", "updated_at",
            "total_amount", "currency"]
    db = S.db_orders(spark, sf).filter(F.col("order_id").cast("long") % 2 == 0)
    api = S.api_orders(spark, sf).filter(F.col("order_id").cast("long") % 2 == 1)
    a = M.bronze_canonical("orders", db).select(*cols)
    b = M.bronze_canonical("orders", api).withColumn("order_date", F.col("order_date").cast("date"))
    return a.unionByName(b.select(*cols))


@query("json_flatten", """
SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, COUNT(*) AS n_events
FROM events GROUP BY 1""")
def q_json_flatten(spark, sf):
    ev = S.table(spark, sf, "events")
    parsed = ev.select(F.from_json("props", "k BIGINT").alias("p"))
    return parsed.groupBy(F.col("p.k").alias("k")).agg(F.count(F.lit(1)).alias("n_events"))


# --------------------------------------------------------------------------- extraction
@query("keyset_slice", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate
FROM orders
WHERE ((o_orderdate > TIMESTAMP '1999-01-01') OR
       (o_orderdate = TIMESTAMP '1999-01-01' AND o_orderkey > 5000))
  AND o_orderdate <= TIMESTAMP '2000-06-01'""")
def q_keyset_slice(spark, sf):
    o = S.table(spark, sf, "orders")
    out = cursor_filter(o, "incremental", "o_orderdate", "o_orderkey",
                        last_wm="1999-01-01 00:00:00", last_pk=5000, cutoff="2000-06-01 00:00:00")
    return out.select("o_orderkey", "o_custkey",
                      F.date_format("o_orderdate", TS_TEXT).alias("o_orderdate"))


@query("keyset_chunks", """
SELECT o_orderkey,
       CAST((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 5000 + 1 AS BIGINT)
         AS chunk_index
FROM orders""")
def q_keyset_chunks(spark, sf):
    o = S.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return assign_chunks(o, ["o_orderdate", "o_orderkey"], 5000).select("o_orderkey", "chunk_index")


@query("keyset_initial_chunks", """
SELECT o_orderkey,
       CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 5000 + 1 AS BIGINT) AS chunk_index
FROM orders WHERE o_orderkey > 100""")
def q_keyset_initial_chunks(spark, sf):
    """Initial mode: walk the primary key from a saved position (``pk > 100``)."""
    o = S.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    sliced = cursor_filter(o, "initial", "o_orderdate", "o_orderkey", last_pk=100)
    return assign_chunks(sliced, ["o_orderkey"], 5000).select("o_orderkey", "chunk_index")


# --------------------------------------------------------------------------- quality
@query("orphans", """
SELECT COUNT(*) AS orphan_orders FROM orders o
LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 7 <> 0) c ON o.o_custkey = c.c_custkey
WHERE c.c_custkey IS NULL""")
def q_orphans(spark, sf):
    cust = S.table(spark, sf, "customer").filter(F.col("c_custkey") % 7 != 0)
    return Q.orphans(S.table(spark, sf, "orders"), "o_custkey", cust, "c_custkey", "orphan_orders")


@query("orphan_items", """
SELECT COUNT(*) AS orphan_items FROM lineitem l
LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 13 <> 0) o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderkey IS NULL""")
def q_orphan_items(spark, sf):
    orders = S.table(spark, sf, "orders").filter(F.col("o_orderkey") % 13 != 0)
    return Q.orphans(S.table(spark, sf, "lineitem"), "l_orderkey", orders, "o_orderkey",
                     "orphan_items")


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def q_duplicate_keys(spark, sf):
    return Q.duplicate_keys(S.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("status_distribution", """
SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus""")
def q_status_distribution(spark, sf):
    return Q.value_distribution(S.table(spark, sf, "orders"), "o_orderstatus")


@query("date_consistency", """
SELECT COUNT(*) AS invalid_dates FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_shipdate < o.o_orderdate""")
def q_date_consistency(spark, sf):
    """Items shipped before their order was placed: the comparison is part of the join, so only
    such items leave it; a hot order is split by AQE, an order has one row."""
    li = S.table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    o = S.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    early = li.join(o, (li.l_orderkey == o.o_orderkey) & (li.l_shipdate < o.o_orderdate))
    return early.agg(F.count(F.lit(1)).alias("invalid_dates"))


@query("profile_customers", """
SELECT COUNT(*) AS total, COUNT(c_custkey) AS not_null_id,
       COUNT(DISTINCT c_custkey) AS unique_id, COUNT(*) - COUNT(c_custkey) AS null_id
FROM customer""")
def q_profile_customers(spark, sf):
    return Q.key_profile(S.table(spark, sf, "customer"), "c_custkey")


@query("profile_orders", f"""
WITH {SQL_F7}
SELECT COUNT(*) AS total,
       strftime(MIN(try_strptime(order_date, '%Y-%m-%d')), '%Y-%m-%d %H:%M:%S') AS min_date,
       strftime(MAX(try_strptime(order_date, '%Y-%m-%d')), '%Y-%m-%d %H:%M:%S') AS max_date,
       COUNT(*) FILTER (WHERE status IS NULL) AS null_status
FROM f7""")
def q_profile_orders(spark, sf):
    return Q.time_range_profile(S.dirty_orders(spark, sf), "order_date", null_col="status")


SQL_ITEM_PRICE = """
items AS (SELECT CASE WHEN l_orderkey % 13 = 0 THEN ''
                      ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS price
          FROM lineitem)"""


def _item_prices(spark, sf):
    li = S.table(spark, sf, "lineitem")
    return li.select(F.when(F.col("l_orderkey") % 13 == 0, F.lit(""))
                     .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
                     .alias("price"))


@query("profile_order_items", f"""
WITH {SQL_ITEM_PRICE},
v AS (SELECT price, TRY_CAST(nullif(trim(price), '') AS DECIMAL(38,2)) AS p FROM items)
SELECT COUNT(*) AS total,
       COUNT(*) FILTER (WHERE price IS NULL OR trim(price) = '') AS null_price,
       CAST(MIN(p) AS DOUBLE) AS min_price, CAST(MAX(p) AS DOUBLE) AS max_price,
       round(CAST(SUM(p) AS DOUBLE) / COUNT(p), 6) AS avg_price
FROM v""")
def q_profile_order_items(spark, sf):
    return Q.numeric_text_profile(_item_prices(spark, sf), "price")


@query("profile_order_payments", """
WITH pay AS (SELECT CAST(CAST(l_extendedprice - 1000 AS DECIMAL(18,2)) AS VARCHAR) AS payment_value
             FROM lineitem),
v AS (SELECT TRY_CAST(nullif(trim(payment_value), '') AS DECIMAL(38,2)) AS p FROM pay)
SELECT COUNT(*) AS total, CAST(SUM(p) AS DOUBLE) AS total_value,
       COUNT(*) FILTER (WHERE p <= 0) AS invalid_values
FROM v""")
def q_profile_order_payments(spark, sf):
    li = S.table(spark, sf, "lineitem")
    pay = li.select((F.col("l_extendedprice") - 1000).cast("decimal(18,2)").cast("string")
                    .alias("payment_value"))
    return Q.value_total_profile(pay, "payment_value")


@query("profile_order_reviews", """
SELECT COUNT(*) AS total,
       COUNT(*) FILTER (WHERE TRY_CAST(nullif(trim(CAST(l_linenumber AS VARCHAR)), '') AS DECIMAL(38,10)) < 1
                           OR TRY_CAST(nullif(trim(CAST(l_linenumber AS VARCHAR)), '') AS DECIMAL(38,10)) > 5)
         AS invalid_scores
FROM lineitem""")
def q_profile_order_reviews(spark, sf):
    rv = S.table(spark, sf, "lineitem").select(F.col("l_linenumber").cast("string")
                                               .alias("review_score"))
    return Q.domain_violations(rv, "review_score", 1, 5, "invalid_scores")


@query("profile_geolocation", """
SELECT COUNT(*) AS total,
       COUNT(*) FILTER (WHERE lat IS NULL OR lng IS NULL) AS missing_coords
FROM (SELECT c_acctbal AS lat,
             CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(c_nationkey AS DOUBLE) END AS lng
      FROM customer)""")
def q_profile_geolocation(spark, sf):
    c = S.table(spark, sf, "customer")
    geo = c.select(F.col("c_acctbal").alias("lat"),
                   F.when(F.col("c_custkey") % 23 == 0, F.lit(None).cast("double"))
                   .otherwise(F.col("c_nationkey").cast("double")).alias("lng"))
    return Q.missing_count(geo, ["lat", "lng"], "missing_coords")


@query("profile_products", """
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE weight IS NULL) AS null_weight
FROM (SELECT CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_size END AS weight FROM part)""")
def q_profile_products(spark, sf):
    p = S.table(spark, sf, "part")
    prod = p.select(F.when(F.col("p_partkey") % 29 == 0, F.lit(None)).otherwise(F.col("p_size"))
                    .alias("weight"))
    return Q.missing_count(prod, ["weight"], "null_weight")


@query("profile_sellers", """
SELECT COUNT(*) AS total, COUNT(DISTINCT s_suppkey) AS unique_sellers FROM supplier""")
def q_profile_sellers(spark, sf):
    return Q.distinct_profile(S.table(spark, sf, "supplier"), "s_suppkey", "unique_sellers")


@query("incomplete_rows", f"""
WITH {SQL_F7}
SELECT COUNT(*) FILTER (WHERE order_id IS NULL OR customer_id IS NULL) AS incomplete_rows FROM f7""")
def q_incomplete_rows(spark, sf):
    return Q.null_key_rows(S.dirty_orders(spark, sf), ["order_id", "customer_id"])


@query("orders_per_customer", """
SELECT COUNT(*) AS total, COUNT(DISTINCT o_custkey) AS unique_customers FROM orders""")
def q_orders_per_customer(spark, sf):
    return Q.distinct_profile(S.table(spark, sf, "orders"), "o_custkey", "unique_customers")


@query("temporal_range", """
SELECT COUNT(*) AS total, strftime(MIN(o_orderdate), '%Y-%m-%d %H:%M:%S') AS min_date,
       strftime(MAX(o_orderdate), '%Y-%m-%d %H:%M:%S') AS max_date
FROM orders""")
def q_temporal_range(spark, sf):
    return Q.time_range_profile(S.table(spark, sf, "orders"), "o_orderdate")


RELATIONAL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                     "events")


@query("table_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS total_rows FROM {t}" for t in RELATIONAL_TABLES))
def q_table_counts(spark, sf):
    return labelled_counts({t: S.table(spark, sf, t) for t in RELATIONAL_TABLES})


# Round-trip (files, writers, streaming) queries register themselves on import.
from . import catalog_io  # noqa: E402,F401
from . import catalog_extra  # noqa: E402,F401
from . import catalog_feeds  # noqa: E402,F401
from . import catalog_incremental  # noqa: E402,F401
from . import catalog_tables  # noqa: E402,F401
