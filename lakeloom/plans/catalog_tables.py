"""Queries over catalogue tables, audit and stamp columns, declared schemas, extract modes and control tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from .. import control
from ..functions.audit import with_load_audit
from ..registry import API_ORDER_SCHEMA_JSON, Entity, SOURCE_ENTITIES
from ..session import scratch_path
from ..sinks import writers as W
from ..sources.files import read_json_tree
from ..sources.schema import record_to_struct
from ..sources.tables import list_tables, preview, read_table, table_or_none
from ..streaming import pipelines as P
from . import ingest as I
from . import raw_fixtures as RF
from . import standins as S
from .catalog import SQL_F1, query
from .landing import extract_to_raw


def _land_text(df, folder: str) -> None:
    df.select(*(F.col(c).cast("string") for c in df.columns)).write.mode("append").json(folder)


@query("catalog_tables", """
SELECT 'scan' AS item, COUNT(*) AS n, SUM(CAST(p_size AS BIGINT)) AS total FROM part
UNION ALL SELECT 'preview', 3, NULL
UNION ALL SELECT 'tables', 2, NULL
UNION ALL SELECT 'documented', 1, NULL
UNION ALL SELECT 'fallback', COUNT(DISTINCT p_brand), NULL FROM part
UNION ALL SELECT 'mart', COUNT(DISTINCT p_type), SUM(CAST(p_size AS BIGINT)) FROM part
UNION ALL SELECT 'staging', COUNT(*), SUM(CAST(p_size AS BIGINT)) FROM part""")
def q_catalog_tables(spark, sf):
    """A layer namespace with two registered tables: scanned, listed, previewed, described; a table
    that is missing falls back to another; a staging model as a view and a mart as a table."""
    base, env = scratch_path(spark, "catalog"), f"env{uuid.uuid4().hex[:10]}"
    part = S.table(spark, sf, "part")
    gold = next(n for n in W.ensure_layers(spark, env) if n.endswith("gold"))
    part.write.parquet(f"{base}/part")
    part.select("p_brand").distinct().write.parquet(f"{base}/brands")
    W.register_table(spark, f"{gold}.part", f"{base}/part", "parts, one row each", {"quality": "gold"})
    W.register_table(spark, f"{gold}.brands", f"{base}/brands")
    scan = read_table(spark, f"{gold}.part")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {gold}.part").filter("col_name = 'Comment' AND data_type = 'parts, one row each'")
    kept = spark.sql(f"SHOW TBLPROPERTIES {gold}.part").filter("key = 'quality' AND value = 'gold'")
    stores = table_or_none(spark, f"{gold}.store_list")
    fallback = stores if stores is not None else read_table(spark, f"{gold}.brands")
    mart = part.groupBy("p_type").agg(F.sum(F.col("p_size").cast("long")).alias("p_size"))
    W.materialise(mart, "mart", as_view=False, path=f"{base}/mart")
    W.materialise(part, f"{env}_staging", as_view=True)

    def row(item, df, total=None):
        total = F.sum(F.col(total).cast("long")) if total else F.max(F.lit(None).cast("long"))
        return df.agg(F.count("*").alias("n"), total.alias("total")).select(F.lit(item).alias("item"), "n", "total")
    names = spark.createDataFrame([(t,) for t in list_tables(spark, gold) if t in ("part", "brands")], "t string")
    parts = [row("scan", scan, "p_size"), row("preview", preview(spark, "part", 3, gold)), row("tables", names),
             row("documented", described.crossJoin(kept)), row("fallback", fallback),  # one row by one row
             row("mart", W.read_current(spark, f"{base}/mart"), "p_size"), row("staging", spark.table(f"{env}_staging"), "p_size")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


@query("audit_columns", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '2024-01-02 02:00:00' AS loaded,
       strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00.000000' AS extracted,
       'ingestion_date=2024-01-0' || CAST(o_orderkey % 2 + 1 AS VARCHAR) AS folder,
       CAST('2024-01-0' || CAST(o_orderkey % 2 + 1 AS VARCHAR) AS DATE) AS ingestion_date FROM orders""")
def q_audit_columns(spark, sf):
    """The extractor's own time keeps its place beside the load time; a timestamp column lands as ISO text."""
    base = scratch_path(spark, "audit")
    o = S.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("order_id"),
                                            F.col("o_orderdate").cast("timestamp").alias("_ingestion_ts"))
    for k in (0, 1):
        W.write_jsonl_batch(o.filter(F.col("order_id").cast("long") % 2 == k), f"{base}/ingestion_date=2024-01-0{k + 1}")
    raw = read_json_tree(spark, base, spark.createDataFrame([], "order_id string, _ingestion_ts string").schema)
    rows = with_load_audit(raw, RF.RUN2)
    return rows.select("order_id", F.date_format("_ingestion_ts", "yyyy-MM-dd HH:mm:ss").alias("loaded"),
                       F.substring("_source_ingestion_ts", 1, 26).alias("extracted"),
                       F.regexp_extract("_source_file", r"(ingestion_date=[\d-]+)", 1).alias("folder"), "ingestion_date")


@query("declared_schema", f"""
WITH {SQL_F1}
SELECT order_id, total_amount, len(lines) AS n_lines, lines[1] AS first_line, NULL AS shipping_address
FROM f1 LEFT JOIN (SELECT l_orderkey, list(DISTINCT CAST(l_linenumber AS VARCHAR) ORDER BY CAST(l_linenumber AS VARCHAR)) AS lines
                   FROM lineitem GROUP BY l_orderkey) l ON CAST(order_id AS BIGINT) = l_orderkey""")
def q_declared_schema(spark, sf):
    """Nested order records read under the record definition of the orders API."""
    base = scratch_path(spark, "declared")
    lines = S.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("order_id")).agg(
        F.sort_array(F.collect_set(F.col("l_linenumber").cast("string"))).alias("line_items"))
    S.api_orders(spark, sf).join(lines, "order_id", "left").write.json(base)
    rows = read_json_tree(spark, base, record_to_struct(API_ORDER_SCHEMA_JSON))
    return rows.select("order_id", "total_amount", F.when(F.col("line_items").isNotNull(), F.size("line_items")).cast("long").alias("n_lines"),
                       F.get("line_items", F.lit(0)).alias("first_line"), "shipping_address")


@query("extract_without_cursor", """
SELECT 'no watermark' AS run, COUNT(*) AS rows, 'completed' AS status FROM customer
UNION ALL SELECT 'no watermark again', COUNT(*), 'completed' FROM customer
UNION ALL SELECT 'skipped', 0, 'skipped_no_watermark'
UNION ALL SELECT 'no key', COUNT(*) FILTER (WHERE o_orderdate <= DATE '1996-01-01'), 'completed' FROM orders
UNION ALL SELECT 'no key again', COUNT(*) FILTER (WHERE o_orderdate > DATE '1996-01-01'), 'completed' FROM orders""")
def q_extract_without_cursor(spark, sf):
    """A table without a watermark is a snapshot each time, or skipped; one without a key goes by its watermark alone."""
    base = scratch_path(spark, "no_cursor")
    cust = S.table(spark, sf, "customer").select(*(F.lit("x").alias(c) if c != "customer_id" else F.col("c_custkey").cast("string").alias(c)
                                                   for c in SOURCE_ENTITIES["customers"].columns))
    orders = S.db_orders(spark, sf)
    keyless = Entity("orders_log", tuple(orders.columns), keys=(), watermark="order_purchase_timestamp")
    at = lambda y: dt.datetime(y, 1, 1, tzinfo=dt.timezone.utc)
    runs = [("no watermark", cust, SOURCE_ENTITIES["customers"], RF.RUN1, None, "full"),
            ("no watermark again", cust, SOURCE_ENTITIES["customers"], RF.RUN2, None, "full"),
            ("skipped", cust, SOURCE_ENTITIES["customers"], RF.RUN2, None, "skip"),
            ("no key", orders, keyless, RF.RUN1, at(1996), "full"), ("no key again", orders, keyless, RF.RUN2, at(2030), "full")]
    out = []
    for name, source, entity, run_ts, cutoff, without in runs:
        done = extract_to_raw(spark, source, entity, f"{base}/raw", f"{base}/control", "incremental", run_ts=run_ts,
                              cutoff=cutoff, no_watermark=without)
        out.append((name, int(done["rows"]), done["status"]))
    return spark.createDataFrame(out, "run string, rows long, status string")


@query("control_tables", """
SELECT 'initial' AS kind, CAST(MAX(o_orderkey) AS VARCHAR) AS value FROM (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders)
UNION ALL SELECT 'incremental', strftime(MAX(o_orderdate), '%Y-%m-%d') FROM orders
UNION ALL SELECT 'job', 'SUCCESS' UNION ALL SELECT 'job', 'FAILED'""")
def q_control_tables(spark, sf):
    """Cursors by mode after an initial extract, and the job-run record of a run that failed and was repeated."""
    base = scratch_path(spark, "control")
    extract_to_raw(spark, S.db_orders(spark, sf), SOURCE_ENTITIES["orders"], f"{base}/raw", f"{base}/control", "initial", run_ts=RF.RUN1)
    cp = control.checkpoints(spark, f"{base}/control/checkpoints")
    for status in ("FAILED", "SUCCESS"):
        control.log_job_run(spark, f"{base}/jobs", "medallion", "r1", status, 1.0, "lost" if status == "FAILED" else None)
    jobs = control.job_runs(spark, f"{base}/jobs").select(F.lit("job").alias("kind"), F.col("status").alias("value"))
    key = F.get_json_object("last_pk", "$[0]")
    return cp.select(F.col("mode").alias("kind"), F.when(F.col("mode") == "initial", key)
                     .otherwise(F.substring("last_watermark", 1, 10)).alias("value")).unionAll(jobs)


@query("silver_other_entities", """
WITH c AS (SELECT DISTINCT c_custkey FROM customer), s AS (SELECT DISTINCT s_suppkey FROM supplier), n AS (SELECT * FROM nation)
SELECT 'sellers' AS entity, COUNT(*) AS n FROM s
UNION ALL SELECT 'geolocation', COUNT(DISTINCT (n_nationkey % 5, n_name)) FROM n
UNION ALL SELECT 'order_payments', COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'order_reviews', COUNT(*) FROM orders""")
def q_silver_other_entities(spark, sf):
    """Silver of sellers, geolocation (whole rows), payments and reviews, two loads that overlap."""
    base = scratch_path(spark, "others")
    text = lambda v: F.lit(v)
    key = lambda c: F.col(c).cast("string")
    tables = {
        "sellers": S.table(spark, sf, "supplier").select(key("s_suppkey").alias("seller_id"), text("0").alias("seller_zip_code_prefix"),
                                                         text("x").alias("seller_city"), text("SP").alias("seller_state")),
        "geolocation": S.table(spark, sf, "nation").select(
            (F.col("n_nationkey") % 5).cast("string").alias("geolocation_zip_code_prefix"), text("1").alias("geolocation_lat"),
            text("2").alias("geolocation_lng"), F.col("n_name").alias("geolocation_city"), text("SP").alias("geolocation_state")),
        "order_payments": S.table(spark, sf, "lineitem").select(
            key("l_orderkey").alias("order_id"), key("l_linenumber").alias("payment_sequential"), text("card").alias("payment_type"),
            text("1").alias("payment_installments"), text("9.5").alias("payment_value")),
        "order_reviews": S.table(spark, sf, "orders").select(
            F.concat(text("r"), key("o_orderkey")).alias("review_id"), key("o_orderkey").alias("order_id"), text("5").alias("review_score"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("review_creation_date"))}
    out = None
    for entity, df in tables.items():
        for day in (1, 2):  # everything, then the half with an even hash again
            _land_text(df if day == 1 else df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0), f"{base}/raw/{entity}/ingestion_date=2024-01-0{day}")
            I.load_bronze(spark, f"{base}/raw/{entity}", f"{base}/lake", entity, RF.RUN1)
            I.merge_silver(spark, f"{base}/lake", entity, buckets=8)
        row = I.read_silver(spark, f"{base}/lake", entity).agg(F.count("*").alias("n")).select(F.lit(entity).alias("entity"), "n")
        out = row if out is None else out.unionAll(row)
    return out


@query("stream_hard_rule", """
SELECT 'stopped' AS state, COUNT(*) FILTER (WHERE o_orderkey % 4 < 2) AS written,
       COUNT(*) FILTER (WHERE o_orderkey % 4 = 2 AND o_orderkey % 3 = 0) AS violations FROM orders""")
def q_stream_hard_rule(spark, sf):
    """The third file of a stream holds orders without a key: the hard rule stops the stream, that
    batch is not written, the two before it stay."""
    base = scratch_path(spark, "hard_rule")
    orders = S.api_orders(spark, sf).withColumns({
        "_ingestion_ts": F.lit(RF.RUN1).cast("timestamp"), "n": F.col("order_id").cast("long") % 4})
    lost = (F.col("n") == 2) & (F.col("order_id").cast("long") % 3 == 0)
    orders = orders.withColumn("order_id", F.when(~lost, F.col("order_id")))
    for n in range(4):
        rows = orders.filter(F.col("n") == n).drop("n")
        rows.coalesce(1).write.mode("append").parquet(f"{base}/bronze")
    schema = orders.drop("n").schema
    state = "went on"
    try:
        q = (P.silver_projection(spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{base}/bronze"))
             .writeStream.foreachBatch(lambda b, i: P.write_batch(b, i, f"{base}/silver", f"{base}/dq"))
             .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
    except StreamingQueryException as e:
        if "valid_order_id" not in str(e):
            raise
        state = "stopped"
    written = spark.read.parquet(f"{base}/silver").agg(F.count("*").alias("written"))
    bad = spark.read.parquet(f"{base}/dq").filter("expectation = 'valid_order_id'").agg(F.sum("violations").alias("violations"))
    return written.crossJoin(bad).select(F.lit(state).alias("state"), "written", "violations")  # one row by one row
