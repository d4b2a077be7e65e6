"""Queries over incremental Bronze and Silver, rejected rows, and streams that follow their source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..quality import sketches
from ..quality.declared import Rule, check_declared
from ..registry import API_ORDER_SCHEMA_JSON
from ..session import delete_path, scratch_path
from ..sinks.keyed import read_keyed
from ..sources.files import read_json_stream, read_parquet_stream
from ..sources.schema import record_to_struct
from ..streaming import tracked as TR
from . import ingest as I
from . import medallion as M
from . import raw_fixtures as RF
from . import standins as S
from .catalog import SQL_F1, query

API_ORDERS = record_to_struct(API_ORDER_SCHEMA_JSON)


def _key():
    return F.col("order_id").cast("long")


def _land(df: DataFrame, raw: str, day: int) -> None:
    df.write.mode("append").json(f"{raw}/ingestion_date=2024-01-0{day}")


@query("bronze_manifest", f"""
WITH {SQL_F1}
SELECT order_id, CAST(CAST(order_id AS BIGINT) % 3 + 1 AS INTEGER) AS day, CAST(3 AS BIGINT) AS finished_loads FROM f1""")
def q_bronze_manifest(spark, sf):
    """Three days of RAW, each loaded once: the second load is cut off after it has written rows
    and runs again from the manifest; two more runs find nothing new."""
    base = scratch_path(spark, "manifest")
    raw, lake = f"{base}/raw/orders", f"{base}/lake"
    api = S.api_orders(spark, sf)
    for day in (1, 2, 3):
        _land(api.filter(_key() % 3 == day - 1), raw, day)
        if day == 2:  # planned, some rows written, then the crash: no row in `loads`
            I.plan_loads(spark, raw, lake, "orders", RF.RUN1)
            (half,) = I.pending_loads(spark, lake, "orders")
            (api.filter(_key() % 2 == 0).selectExpr("order_id", "'false' AS rejected", "'2024-01-02' AS ingestion_date")
             .write.partitionBy("rejected", "ingestion_date").parquet(f"{lake}/bronze/orders/load_id={half}"))
        for _ in range(2):
            I.load_bronze(spark, raw, lake, "orders", RF.RUN1, since="2024-01-02" if day == 3 else None)
    n = I.loads(spark, lake, "orders").agg(F.count("*").alias("finished_loads"))
    return (I.read_bronze(spark, lake, "orders").select("order_id", F.dayofmonth("ingestion_date").alias("day"))
            .crossJoin(F.broadcast(n)))  # one row


def _versions(spark, sf) -> list[DataFrame]:
    """Three loads: most orders; the others with changes; older versions that come late, newer ones."""
    api = S.api_orders(spark, sf)

    def changed(part, status, at):
        return api.filter(part).withColumns({"status": F.lit(status), "updated_at": F.lit(at)})
    return [api.filter(_key() % 4 != 3),
            api.filter(_key() % 4 == 3).unionByName(changed(_key() % 6 == 0, " shipped", "2030-01-02 00:00:00")),
            changed(_key() % 10 == 0, "processing", "1990-01-01 00:00:00")
            .unionByName(changed(_key() % 14 == 0, "delivered", "2031-01-01 00:00:00"))]


SQL_LATEST = f"""
WITH {SQL_F1}, k AS (SELECT *, CAST(order_id AS BIGINT) AS key FROM f1)
SELECT order_id, order_date, CASE WHEN key % 14 = 0 THEN 'DELIVERED' WHEN key % 6 = 0 THEN 'SHIPPED' ELSE status END AS status"""


@query("silver_incremental", f"{SQL_LATEST}, TRUE AS as_rebuilt FROM k")
def q_silver_incremental(spark, sf):
    """Silver merged load by load, beside Silver rebuilt from all of Bronze."""
    base = scratch_path(spark, "silver_incremental")
    raw, lake = f"{base}/raw/orders", f"{base}/lake"
    for day, rows in enumerate(_versions(spark, sf), 1):
        _land(rows, raw, day)
        I.load_bronze(spark, raw, lake, "orders", RF.RUN1)
        I.merge_silver(spark, lake, "orders", buckets=8)
    columns = ("order_id", "order_date", "status")
    rule = M.silver_rule("orders")
    rebuilt = M.silver_rebuilt(I.read_bronze(spark, lake, "orders"), rule)
    rebuilt = rebuilt.select(F.struct(*columns).alias("r"), F.col("order_id").alias("id"))
    silver = I.read_silver(spark, lake, "orders").select(*columns)
    both = silver.join(rebuilt, F.col("order_id") == F.col("id"), "full")
    return both.select(*columns, F.struct(*columns).eqNullSafe(F.col("r")).alias("as_rebuilt"))


@query("bronze_quarantine", """
WITH o AS (SELECT *, o_orderkey % 37 = 0 OR o_orderkey % 41 = 0 AS bad FROM orders)
SELECT 'good' AS kind, COUNT(*) AS n, COUNT(DISTINCT o_orderkey) AS orders FROM o WHERE NOT bad
UNION ALL SELECT 'rejected', COUNT(*), COUNT(DISTINCT o_orderkey) FROM o WHERE bad
UNION ALL SELECT 'counted', COUNT(*), COUNT(*) FILTER (WHERE bad) FROM o""")
def q_bronze_quarantine(spark, sf):
    """Lines with a text where a number is declared and lines cut short: none is lost, none is in Bronze."""
    base = scratch_path(spark, "quarantine")
    raw, lake = f"{base}/raw/orders", f"{base}/lake"
    api = S.api_orders(spark, sf)
    line = F.to_json(F.struct(*api.columns))
    bad = F.when(_key() % 37 == 0, F.to_json(F.struct("order_id", F.lit("n/a").alias("total_amount")))) \
        .when(_key() % 41 == 0, F.concat(F.lit('{"order_id":"'), F.col("order_id"), F.lit('","status":"SHI')))
    api.select(F.coalesce(bad, line).alias("value")).write.text(f"{raw}/ingestion_date=2024-01-01")
    (done,) = I.load_bronze(spark, raw, lake, "orders", RF.RUN1)
    good = I.read_bronze(spark, lake, "orders").agg(F.count("*").alias("n"), F.count_distinct("order_id").alias("orders"))
    kept = I.quarantine(spark, lake, "orders").agg(
        F.count("*").alias("n"), F.count_distinct(F.regexp_extract("record", r'"order_id":"(\d+)"', 1)).alias("orders"))
    counted = spark.createDataFrame([("counted", done["rows"] + done["rejected"], done["rejected"])], "kind string, n long, orders long")
    return (good.select(F.lit("good").alias("kind"), "n", "orders")
            .unionAll(kept.select(F.lit("rejected").alias("kind"), "n", "orders")).unionAll(counted))


@query("stream_new_column", f"""
WITH {SQL_F1}, k AS (SELECT *, CAST(order_id AS BIGINT) AS key FROM f1)
SELECT order_id, total_amount, CASE WHEN key % 3 = 1 THEN 'web' WHEN key % 3 = 2 THEN '{{"name":"shop"}}' END AS sales_channel,
       CASE WHEN key % 3 = 2 THEN '7' END AS clerk FROM k""")
def q_stream_new_column(spark, sf):
    """A source that gains a column while the stream is down, changes its type and gains another."""
    base = scratch_path(spark, "new_column")
    api = S.api_orders(spark, sf)
    loads = [api.filter(_key() % 3 == 0), api.filter(_key() % 3 == 1).withColumn("sales_channel", F.lit("web")),
             api.filter(_key() % 3 == 2).withColumns({"sales_channel": F.struct(F.lit("shop").alias("name")), "clerk": F.lit(7)})]
    for day, rows in enumerate(loads, 1):
        _land(rows, f"{base}/raw", day)
        if day != 2:  # the second day's files wait for the third's: one batch of several files
            TR.run_bronze_tracked(spark, f"{base}/raw", API_ORDERS, f"{base}/bronze", f"{base}/ckpt", RF.RUN1)
    return TR.read_tracked(spark, f"{base}/bronze").select("order_id", "total_amount", "sales_channel", "clerk")


@query("stream_latest", f"{SQL_LATEST} FROM k")
def q_stream_latest(spark, sf):
    """Micro-batches merged by key: versions that come after newer ones, and the whole source
    delivered again to a stream that has lost its checkpoint, change nothing."""
    base = scratch_path(spark, "stream_latest")
    loads = _versions(spark, sf)
    for delivery in ("first", "after_loss"):
        for n, rows in enumerate((loads[2], loads[0], loads[1])):  # the newest first; a load, of however many files, a batch
            rows.write.json(f"{base}/raw_{delivery}/n={n}")
            source = read_json_stream(spark, f"{base}/raw_{delivery}", API_ORDERS)
            TR.run_latest(source, M.silver_rule("orders"), f"{base}/silver", f"{base}/ckpt_{delivery}", buckets=8)
    return read_keyed(spark, f"{base}/silver").select("order_id", "order_date", "status")


@query("stream_first_keyed", "SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY l_orderkey")
def q_stream_first_keyed(spark, sf):
    """First arrival of each order, its lines arriving one number a batch, delivered twice: which row won."""
    base = scratch_path(spark, "stream_first_keyed")
    li = S.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    for delivery in ("first", "after_loss"):
        for n in range(1, 8):  # a number, of however many files, a batch
            li.filter(F.col("l_linenumber") == n).write.mode("append").parquet(f"{base}/in_{delivery}")
            source = read_parquet_stream(spark, f"{base}/in_{delivery}", li.schema)
            TR.run_first(source, ["l_orderkey"], f"{base}/out", f"{base}/ckpt_{delivery}", buckets=8)
    return read_keyed(spark, f"{base}/out").select("l_orderkey", "l_linenumber")


@query("replay_batch", f"{SQL_LATEST}, CAST(1 AS BIGINT) AS replayed FROM k")
def q_replay_batch(spark, sf):
    """The second day was loaded by a faulty job and has spoilt Silver; its days are replayed, twice."""
    base = scratch_path(spark, "replay_batch")
    raw, lake = f"{base}/raw/orders", f"{base}/lake"
    for day, rows in enumerate(_versions(spark, sf), 1):
        _land(rows, raw, day)
        (done,) = I.load_bronze(spark, raw, lake, "orders", RF.RUN1)
        if day == 2:
            path = f"{lake}/bronze/orders/load_id={done['load_id']}"
            held = spark.read.parquet(path)
            spoilt = held.withColumns({"status": F.lit("lost"), "updated_at": F.lit("2040-01-01 00:00:00"),
                                       "order_id": F.concat(F.col("order_id"), F.when(_key() % 8 == 3, "x").otherwise(""))})
            spoilt.write.partitionBy("rejected", "ingestion_date").parquet(f"{path}_spoilt")
            spark.read.parquet(f"{path}_spoilt").write.mode("overwrite").partitionBy("rejected", "ingestion_date").parquet(path)
            delete_path(spark, f"{path}_spoilt")
        I.merge_silver(spark, lake, "orders", buckets=8)
    for _ in range(2):
        ids = I.replay(spark, lake, "orders", ("2024-01-02", "2024-01-02"), load_ts=RF.RUN1, buckets=8)
    return I.read_silver(spark, lake, "orders").select(
        "order_id", "order_date", "status", F.lit(len(ids)).cast("long").alias("replayed"))


RULES = (
    Rule("order_key", "orders", "required", ("o_orderkey",)),
    Rule("order_unique", "orders", "unique", ("o_orderkey",)),
    Rule("order_status", "orders", "one_of", ("o_orderstatus",), values=("F", "O")),
    Rule("order_total", "orders", "between", ("o_totalprice",), low=1000, high=200000),
    Rule("order_customer", "orders", "reference", ("o_custkey",), parent="customer", parent_columns=("c_custkey",)),
    Rule("line_order", "lineitem", "reference", ("l_orderkey",), parent="orders", parent_columns=("o_orderkey",)),
    Rule("line_part", "lineitem", "reference", ("l_partkey",), parent="part", parent_columns=("p_partkey",)),
    Rule("line_quantity", "lineitem", "between", ("l_quantity",), low=5),
    Rule("line_dates", "lineitem", "holds", condition="l_shipdate < DATE '1998-01-01'"),
    Rule("customer_name", "customer", "required", ("c_name", "c_mktsegment"), allowed=10**9),
)


@query("declared_rules", """
WITH c AS (SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS c_name, * EXCLUDE c_name FROM customer WHERE c_custkey % 7 <> 0),
o AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 50 = 0),
v AS (
SELECT 'order_key' AS rule, 'orders' AS table_name, count(*) AS rows, count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM o
UNION ALL SELECT 'order_unique', 'orders', count(*), count(*) - count(DISTINCT o_orderkey) FROM o
UNION ALL SELECT 'order_status', 'orders', count(*), count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM o
UNION ALL SELECT 'order_total', 'orders', count(*), count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 200000) FROM o
UNION ALL SELECT 'order_customer', 'orders', count(*), count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM c)) FROM o
UNION ALL SELECT 'line_order', 'lineitem', count(*), count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o)) FROM lineitem
UNION ALL SELECT 'line_part', 'lineitem', count(*), count(*) FILTER (WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) FROM lineitem
UNION ALL SELECT 'line_quantity', 'lineitem', count(*), count(*) FILTER (WHERE l_quantity < 5) FROM lineitem
UNION ALL SELECT 'line_dates', 'lineitem', count(*), count(*) FILTER (WHERE NOT l_shipdate < DATE '1998-01-01') FROM lineitem
UNION ALL SELECT 'customer_name', 'customer', count(*), count(*) FILTER (WHERE c_name IS NULL OR c_mktsegment IS NULL) FROM c)
SELECT *, violations = 0 OR rule = 'customer_name' AS passed FROM v""")
def q_declared_rules(spark, sf):
    """Ten declared rules over four tables, one aggregation a table."""
    tables = {t: S.table(spark, sf, t) for t in ("orders", "lineitem", "part", "customer")}
    tables["orders"] = tables["orders"].unionAll(tables["orders"].filter("o_orderkey % 50 = 0"))
    tables["customer"] = tables["customer"].filter("c_custkey % 7 <> 0").withColumn(
        "c_name", F.when(F.col("c_custkey") % 10 != 0, F.col("c_name")))
    return check_declared(tables, RULES)


@query("profile_sketch", """
SELECT 'o_custkey' AS column, COUNT(*) AS rows, COUNT(*) - COUNT(o_custkey) AS nulls, TRUE AS distinct_within, TRUE AS month_within FROM orders
UNION ALL SELECT 'o_orderkey', COUNT(*), COUNT(*) - COUNT(o_orderkey), TRUE, TRUE FROM orders
UNION ALL SELECT 'o_status', COUNT(*), COUNT(*) FILTER (WHERE o_orderstatus = 'P'), TRUE, TRUE FROM orders""")
def q_profile_sketch(spark, sf):
    """Profiles by month, added in three parts of which one comes twice; the distinct counts of
    all days and of some months within 2 % of the exact ones."""
    path = scratch_path(spark, "profiles")
    columns = ("o_orderkey", "o_custkey", "o_status")
    orders = S.table(spark, sf, "orders").withColumn("o_status", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    parts = [orders.filter("o_orderdate < '1994-01-01'"), orders.filter("o_orderdate >= '1994-01-01' AND o_orderdate < '1997-01-01'"),
             orders.filter("o_orderdate >= '1997-01-01'")]
    for part in (*parts, parts[1]):
        sketches.add_days(part, columns, "o_orderdate", path, "month")

    def exact(df):
        counts = df.agg(*(F.count_distinct(c).alias(c) for c in columns))
        return counts.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in columns))))

    def within(found, df, name):
        close = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(0.02 * F.col("exact"), F.lit(1))
        return found.join(exact(df), "column").withColumn(name, close)
    whole = within(sketches.profile(spark, path), orders, "distinct_within").select("column", "rows", "nulls", "distinct_within")
    some = within(sketches.profile(spark, path, "1995-03-01", "1995-08-31"),
                  orders.filter("o_orderdate BETWEEN '1995-03-01' AND '1995-08-31'"), "month_within").select("column", "month_within")
    return whole.join(some, "column")
