"""Round-trip queries: RAW landing, Bronze loads, writers, streaming.

Each query writes files derived from the given tables into a fresh folder
under the shared checkpoint root, runs the operator under test on them, and
returns the result read back.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import control
from ..functions.audit import batch_id
from ..operators.incremental import high_water_slice, upsert_partitions
from ..registry import API_ORDER_SCHEMA_JSON, ORDERS, RAW_STAMP_COLUMNS, SOURCE_ENTITIES, raw_schema
from ..session import scratch_path
from ..sinks import writers as W
from ..sources.bulk_csv import load_csv_folder
from ..sources.files import read_json_tree, read_text_lines, read_whole_files
from ..sources.pages import read_page_files
from ..sources.schema import record_to_struct
from ..streaming import pipelines as P
from . import medallion as M
from . import raw_fixtures as RF
from . import standins as S
from .catalog import SQL_DAILY, SQL_DB_ORDERS, SQL_F1, _fact_orders, _silver_orders, query
from .landing import bronze_load, extract_to_raw
from .pipeline import refresh_mart

API_SCHEMA = record_to_struct(API_ORDER_SCHEMA_JSON)
MIXED_RAW_SCHEMA = raw_schema("orders")
DB_RAW_SCHEMA = T.StructType([f for f in MIXED_RAW_SCHEMA.fields if f.name in ORDERS.columns + RAW_STAMP_COLUMNS])


# --------------------------------------------------------------------------- RAW -> Bronze
SQL_MIXED = f"""
WITH {SQL_F1}, {SQL_DB_ORDERS},
bronze AS (
  SELECT order_id, order_status AS status, CAST(order_purchase_timestamp AS DATE) AS order_date,
         'BRL' AS currency, DATE '2024-01-01' AS ingestion_date
  FROM db WHERE o_orderkey % 10 <= 6
  UNION ALL
  SELECT order_id, status, order_date, currency,
         CASE WHEN CAST(order_id AS BIGINT) % 10 = 9 THEN NULL ELSE DATE '2024-01-02' END
  FROM f1 WHERE CAST(order_id AS BIGINT) % 10 >= 7)"""


def _bronze_from_mixed_raw(spark, sf):
    base = scratch_path(spark, "raw_tree")
    raw = RF.write_mixed_raw_tree(spark, sf, base)
    return bronze_load(spark, raw, "orders", MIXED_RAW_SCHEMA, load_ts=RF.RUN2)


@query("raw_to_bronze", f"{SQL_MIXED} SELECT * FROM bronze")
def q_raw_to_bronze(spark, sf):
    """RAW tree of mixed shapes (JSON-lines chunks, JSON-array pages, a stray
    file, an ignored ``_runs`` folder) -> Bronze with audit + canonical columns."""
    b = _bronze_from_mixed_raw(spark, sf)
    return b.select("order_id", "status", F.col("order_date").cast("date").alias("order_date"),
                    "currency", "ingestion_date")


@query("raw_to_silver", f"""{SQL_MIXED}
SELECT order_id, upper(trim(status)) AS status, order_date FROM bronze""")
def q_raw_to_silver(spark, sf):
    s = M.silver_orders(_bronze_from_mixed_raw(spark, sf))
    return s.select("order_id", "status", "order_date")


@query("schema_drift", f"""
WITH {SQL_F1}
SELECT order_id,
       CASE WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN currency END AS currency,
       CASE WHEN CAST(order_id AS BIGINT) % 2 = 1 THEN 'web' END AS sales_channel,
       CASE WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN DATE '2024-01-01'
            ELSE DATE '2024-01-02' END AS ingestion_date
FROM f1""")
def q_schema_drift(spark, sf):
    """Two appends with different columns, read back as one merged schema."""
    path = scratch_path(spark, "bronze_drift")
    RF.write_drift_batches(spark, sf, path)
    b = W.read_merged(spark, path)
    return b.select("order_id", "currency", "sales_channel",
                    F.col("ingestion_date").cast("date").alias("ingestion_date"))


SQL_PAGES = f"""
WITH {SQL_F1}
SELECT CAST(CAST(order_id AS BIGINT) // 1000 + 1 AS INTEGER) AS page, order_id, status, total_amount FROM f1"""


@query("page_set", SQL_PAGES)
def q_page_set(spark, sf):
    """Landed API pages (bare lists / ``items`` / ``orders`` envelopes): every record of every page."""
    folder = scratch_path(spark, "pages")
    RF.write_page_set(spark, sf, folder)
    return read_page_files(spark, folder, "orders", API_SCHEMA).select("page", "order_id", "status", "total_amount")


# --------------------------------------------------------------------------- extraction
def _two_incremental_runs(spark, sf):
    base = scratch_path(spark, "extract")
    src = S.db_orders(spark, sf)
    import datetime as dt
    c1 = dt.datetime(1999, 1, 1, tzinfo=dt.timezone.utc)
    c2 = dt.datetime(2002, 1, 1, tzinfo=dt.timezone.utc)
    for run_ts, cutoff in ((RF.RUN1, c1), (RF.RUN2, c2)):
        extract_to_raw(spark, src, ORDERS, f"{base}/raw", f"{base}/control", mode="incremental",
                       chunk_size=2000, run_ts=run_ts, cutoff=cutoff)
    return base


SQL_EXTRACT = f"""
WITH {SQL_DB_ORDERS},
t AS (SELECT order_id, CAST(order_purchase_timestamp AS TIMESTAMP) AS wm FROM db),
r1 AS (SELECT order_id, 1 AS run_no,
              (row_number() OVER (ORDER BY wm, order_id) - 1) // 2000 + 1 AS chunk_index
       FROM t WHERE wm <= TIMESTAMP '1999-01-01 00:00:00'),
c1 AS (SELECT coalesce(max(chunk_index), 0) AS c FROM r1),
r2 AS (SELECT order_id, 2 AS run_no,
              (row_number() OVER (ORDER BY wm, order_id) - 1) // 2000 + 1 + (SELECT c FROM c1)
                AS chunk_index
       FROM t WHERE wm > TIMESTAMP '1999-01-01 00:00:00' AND wm <= TIMESTAMP '2002-01-01 00:00:00'),
runs AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2)"""


@query("extract_incremental", f"""{SQL_EXTRACT}
SELECT order_id, CAST(run_no AS INTEGER) AS run_no, CAST(chunk_index AS BIGINT) AS chunk_index
FROM runs""")
def q_extract_incremental(spark, sf):
    """Two scheduled incremental extracts; the second resumes from the saved
    (watermark, key) cursor and continues the chunk numbering."""
    base = _two_incremental_runs(spark, sf)
    raw = read_json_tree(spark, f"{base}/raw/orders", DB_RAW_SCHEMA)
    run1 = batch_id(RF.RUN1)
    return raw.select("order_id",
                      F.when(F.col("_batch_id") == run1, 1).otherwise(2).alias("run_no"),
                      F.col("_chunk_index").cast("long").alias("chunk_index"))


@query("run_manifest", f"""{SQL_EXTRACT}
SELECT CAST(run_no AS INTEGER) AS run_no, 'completed' AS status, COUNT(*) AS rows,
       CAST(COUNT(DISTINCT chunk_index) AS BIGINT) AS chunks
FROM runs GROUP BY run_no""")
def q_run_manifest(spark, sf):
    """Final status per run from the append-only manifest table."""
    base = _two_incremental_runs(spark, sf)
    st = control.run_status(spark, f"{base}/control/manifests")
    run1 = batch_id(RF.RUN1)
    return st.select(F.when(F.col("run_id") == run1, 1).otherwise(2).alias("run_no"),
                     "status", "rows", "chunks")


# --------------------------------------------------------------------------- writers
@query("daily_revenue_late", f"WITH {SQL_F1} {SQL_DAILY.format(src='f1', extra='')}")
def q_daily_revenue_late(spark, sf):
    """Two loads of the mart: in the first a fifth of the orders is missing and a
    seventh is not delivered yet, on dates the mart already has. After the second
    the mart equals a computation from scratch."""
    path = scratch_path(spark, "mart_late")
    fact = _fact_orders(spark, sf)
    key = F.col("order_id").cast("long")
    early = fact.filter(key % 5 != 0).withColumn(
        "status", F.when(key % 7 == 0, F.lit("PROCESSING")).otherwise(F.col("status")))
    refresh_mart(early, path)
    refresh_mart(fact, path)
    return W.read_current(spark, path).select(F.col("order_date").cast("date").alias("order_date"), "revenue", "order_count")


def _payments(spark, sf):
    """Lines as payments: an integer watermark, NULL for every ninth row."""
    li = S.table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    seq = F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 9 != 0, F.col("l_linenumber").cast("string"))
    return li.select(F.col("l_orderkey").cast("string").alias("order_id"), seq.alias("payment_sequential"),
                     F.lit("card").alias("payment_type"), F.col("l_linenumber").cast("string").alias("payment_installments"),
                     F.col("q").cast("string").alias("payment_value"))


SQL_PAYMENTS = """
WITH li AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
p AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS installments,
             CASE WHEN (l_orderkey + l_linenumber) % 9 <> 0 THEN l_linenumber END AS seq FROM li)"""


@query("extract_payments", f"""{SQL_PAYMENTS}
SELECT COUNT(*) AS rows, COUNT(DISTINCT order_id || '/' || installments) AS distinct_rows,
       COUNT(*) - COUNT(seq) AS null_watermark_rows FROM p""")
def q_extract_payments(spark, sf):
    """First incremental extract on an integer watermark: no saved cursor, NULL watermarks included and counted."""
    base = scratch_path(spark, "payments")
    _payments(spark, sf).write.parquet(f"{base}/source")  # an extract reads its source several times
    extract_to_raw(spark, spark.read.parquet(f"{base}/source"), SOURCE_ENTITIES["order_payments"], f"{base}/raw", f"{base}/control",
                   "incremental", run_ts=RF.RUN1)
    raw = read_json_tree(spark, f"{base}/raw/order_payments", raw_schema("order_payments"))
    counted = control.table_status(spark, f"{base}/control/manifests").select("null_watermark_rows")
    return raw.agg(F.count("*").alias("rows"), F.count_distinct("order_id", "payment_installments").alias("distinct_rows")) \
        .crossJoin(counted)  # one row by one row


@query("extract_handover", """
SELECT 'initial' AS run, COUNT(*) AS rows FROM orders
UNION ALL SELECT 'initial again', 0
UNION ALL SELECT 'incremental', 0
UNION ALL SELECT 'initial retried', COUNT(*) FROM orders""")
def q_extract_handover(spark, sf):
    """An initial extract, the same again, then the incremental one: nothing twice.
    A retry of a batch (same run time, cursor lost) replaces its own files."""
    base = scratch_path(spark, "handover")
    src = S.db_orders(spark, sf)
    runs = [("initial", "initial", RF.RUN1), ("initial again", "initial", RF.RUN2), ("incremental", "incremental", RF.RUN2)]
    out = [(name, extract_to_raw(spark, src, ORDERS, f"{base}/raw", f"{base}/control", mode, run_ts=ts)["rows"])
           for name, mode, ts in runs]
    extract_to_raw(spark, src, ORDERS, f"{base}/raw", f"{base}/lost", "initial", run_ts=RF.RUN1)
    raw = read_json_tree(spark, f"{base}/raw/orders", raw_schema("orders"))
    return spark.createDataFrame(out, "run string, rows long").union(
        raw.select(F.lit("initial retried").alias("run")).groupBy("run").agg(F.count("*").alias("rows")))


@query("run_manifest_tables", """
SELECT 'failed' AS status, CAST(2 AS BIGINT) AS tables, CAST(1 AS BIGINT) AS failed_tables, COUNT(*) AS rows FROM orders""")
def q_run_manifest_tables(spark, sf):
    """A run in which one table fails and the next completes is a failed run."""
    base = scratch_path(spark, "manifest_tables")
    src = S.db_orders(spark, sf)
    try:
        extract_to_raw(spark, src.drop("order_id"), SOURCE_ENTITIES["order_reviews"], f"{base}/raw", f"{base}/control",
                       "initial", run_ts=RF.RUN1)
    except AnalysisException:
        pass  # its columns are missing: the failure is what the manifest must show
    extract_to_raw(spark, src, ORDERS, f"{base}/raw", f"{base}/control", "initial", run_ts=RF.RUN1)
    return control.run_status(spark, f"{base}/control/manifests").select("status", "tables", "failed_tables", "rows")


@query("bronze_committed_only", """SELECT CAST(0 AS BIGINT) AS before_commit, COUNT(*) AS after_commit, CAST(0 AS BIGINT) AS again FROM orders""")
def q_bronze_committed_only(spark, sf):
    """Files of an uncommitted batch are invisible; committed ones load once."""
    base = scratch_path(spark, "committed")
    extract_to_raw(spark, S.db_orders(spark, sf), ORDERS, f"{base}/raw", f"{base}/control", "initial", run_ts=RF.RUN1)
    batches = control.committed_batches(spark, f"{base}/control/manifests")

    def load(done, loaded=None):
        return bronze_load(spark, f"{base}/raw/orders", "orders", raw_schema("orders"), RF.RUN1, loaded, done)
    before, after = load(batches.limit(0)), load(batches)
    again = load(batches, after.select("_source_file"))
    count = lambda df, name: df.agg(F.count("*").alias(name))
    return count(before, "before_commit").crossJoin(count(after, "after_commit")).crossJoin(count(again, "again"))


@query("daily_revenue_upsert", f"WITH {SQL_F1} {SQL_DAILY.format(src='f1', extra='')}")
def q_daily_revenue_upsert(spark, sf):
    """Incremental mart: first load up to 1999, then upsert the newer dates by
    ``order_date`` (its unique key). Stored by month: only touched months are
    rewritten. Read the mart back."""
    path = scratch_path(spark, "mart")
    fact = _fact_orders(spark, sf)

    def by_month(df):
        return df.withColumn("order_year_month", F.date_format("order_date", "yyyy-MM"))

    first = M.daily_revenue(fact.filter(F.col("order_date") < F.lit("2000-01-01").cast("date")))
    upsert_partitions(by_month(first), path, ["order_date"], ["order_year_month"])
    target = spark.read.parquet(path)
    newer = M.daily_revenue(high_water_slice(fact, target, "order_date"))
    upsert_partitions(by_month(newer), path, ["order_date"], ["order_year_month"])
    out = spark.read.parquet(path)
    return out.select(F.col("order_date").cast("date").alias("order_date"), "revenue",
                      "order_count")


@query("clustered_layout", f"""
WITH {SQL_F1}
SELECT order_id, customer_id, order_date, status, total_amount, currency, created_at, updated_at,
       strftime(order_date, '%Y-%m') AS order_year_month
FROM f1""")
def q_clustered_layout(spark, sf):
    """fact_orders Z-ordered on (customer, date), written, read back unchanged."""
    path = scratch_path(spark, "fact_clustered")
    fact = _fact_orders(spark, sf)
    W.cluster_by(fact, ["customer_id", "order_date"]).write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


@query("versioned_overwrite", f"""
WITH {SQL_F1}
SELECT order_id, status FROM f1 WHERE status <> 'PROCESSING'""")
def q_versioned_overwrite(spark, sf):
    """A table rebuilt from itself: version 2 is computed from version 1 and
    committed by swapping the pointer."""
    base = scratch_path(spark, "silver_versions")
    W.write_version(_silver_orders(spark, sf).select("order_id", "status"), base)
    v1 = W.read_current(spark, base)
    W.write_version(v1.filter(F.col("status") != "PROCESSING"), base)
    return W.read_current(spark, base)


@query("csv_products", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category_name,
       CAST(p_size AS VARCHAR) AS product_weight_g
FROM part""")
def q_csv_products(spark, sf):
    """Bulk CSV export -> all-text table named after its dataset file."""
    folder = scratch_path(spark, "csv_export")
    p = S.table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name"),
        F.col("p_size").alias("product_weight_g"))
    p.write.option("header", "true").csv(f"{folder}/olist_products_dataset.csv")
    p.limit(0).write.option("header", "true").csv(f"{folder}/notes_unrelated.csv")
    tables = load_csv_folder(spark, folder, required=("products",))
    return tables["products"]


def _land_clickstream(spark, sf):
    folder = scratch_path(spark, "clickstream")
    ev = S.table(spark, sf, "events")
    W.append_text(ev.select(F.to_json(F.struct(*ev.columns)).alias("value")),
                  f"{folder}/ingestion_date=2024-01-01")
    return folder


@query("clickstream_text", """
SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY event_type""")
def q_clickstream_text(spark, sf):
    """NDJSON landed as raw text lines, parsed downstream."""
    folder = _land_clickstream(spark, sf)
    ev_schema = S.table(spark, sf, "events").schema
    lines = read_text_lines(spark, folder)
    parsed = lines.select(F.from_json("value", ev_schema).alias("e")).select("e.*")
    return parsed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                            M.money_sum("value").alias("total_value"))


@query("raw_file_copy", "SELECT COUNT(*) AS records, COUNT(*) AS manifest_records FROM events")
def q_raw_file_copy(spark, sf):
    """Exact-content file copy: every landed file read whole, content hashed
    into a manifest next to the copy; record count = lines across files."""
    folder = _land_clickstream(spark, sf)
    files = read_whole_files(spark, folder).filter(F.col("length") > 0)
    copy = files.select("path", "length", F.sha2("content", 256).alias("sha256"), "content")
    out = scratch_path(spark, "raw_copy")
    copy.write.mode("errorifexists").parquet(out)
    back = spark.read.parquet(out)
    lines = F.size(F.split(F.col("content").cast("string"), "\n")) - 1
    verified = back.filter(F.sha2("content", 256) == F.col("sha256"))
    return verified.agg(F.sum(lines).cast("long").alias("records"),
                        F.sum(lines).cast("long").alias("manifest_records"))


# --------------------------------------------------------------------------- streaming
@query("stream_first", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_stream_first(spark, sf):
    """Streaming first-arrival dedupe over lineitem replayed one of its four file groups per trigger."""
    base = scratch_path(spark, "stream_first")
    schema = T.StructType(list(S.table(spark, sf, "lineitem").schema.fields)
                          + [T.StructField("part", T.IntegerType())])
    for _ in RF.write_lineitem_replay(spark, sf, f"{base}/in"):
        P.first_arrival_stream(spark, f"{base}/in", schema, ["l_orderkey", "l_linenumber"],
                               f"{base}/out", f"{base}/ckpt", max_files_per_trigger=None)
    return spark.read.parquet(f"{base}/out").select("l_orderkey", "l_linenumber")


def _stream_orders(spark, sf):
    base = scratch_path(spark, "stream_orders")
    RF.write_api_raw(spark, sf, f"{base}/raw")
    P.run_bronze(spark, f"{base}/raw", API_SCHEMA, f"{base}/bronze", f"{base}/ckpt_bronze",
                 load_ts=RF.RUN1)
    bronze_schema = spark.read.parquet(f"{base}/bronze").schema
    P.run_silver(spark, f"{base}/bronze", bronze_schema, f"{base}/silver", f"{base}/dq",
                 f"{base}/ckpt_silver")
    return base


@query("stream_silver", f"""
WITH {SQL_F1}
SELECT order_id, order_date, status, total_amount FROM f1""")
def q_stream_silver(spark, sf):
    """RAW JSON stream -> Bronze stream -> Silver stream with expectations."""
    base = _stream_orders(spark, sf)
    return spark.read.parquet(f"{base}/silver").select("order_id", "order_date", "status",
                                                       "total_amount")


@query("stream_expectations", """
SELECT 'valid_order_id' AS expectation, 'fail' AS action,
       COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS violations, COUNT(*) AS rows FROM orders
UNION ALL
SELECT 'valid_amount', 'warn',
       COUNT(*) FILTER (WHERE o_orderkey % 11 <> 0 AND o_totalprice < 0), COUNT(*) FROM orders""")
def q_stream_expectations(spark, sf):
    """Expectation metrics recorded by the Silver stream, summed over batches."""
    base = _stream_orders(spark, sf)
    m = spark.read.parquet(f"{base}/dq")
    return m.groupBy("expectation", "action").agg(
        F.sum("violations").cast("long").alias("violations"),
        F.sum("rows").cast("long").alias("rows"))
