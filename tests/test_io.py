"""Sources, sinks, control tables, expectations, streaming."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom import control
from lakeloom.functions.audit import batch_id, ingestion_date_utc, raw_path
from lakeloom.operators.integrity import orphan_count
from lakeloom.plans.landing import extract_to_raw
from lakeloom.registry import API_ORDER_SCHEMA_JSON, Entity
from lakeloom.sinks import writers as W
from lakeloom.sources.files import read_json_tree
from lakeloom.sources.pages import read_page_files
from lakeloom.sources.schema import record_to_struct
from lakeloom.streaming.expectations import Expectation, ExpectationFailed, apply_expectations


def test_batch_identity():
    t = dt.datetime(2025, 2, 18, 13, 4, 5, tzinfo=dt.timezone.utc)
    assert ingestion_date_utc(t) == "2025-02-18"
    assert batch_id(t) == "20250218T130405Z"
    assert raw_path("abfss://x/", "orders", "2025-02-18") == "abfss://x/data/raw/orders/ingestion_date=2025-02-18"
    assert raw_path("b", "orders", "2025-02-18", "/batch_1.json").endswith("=2025-02-18/batch_1.json")


def test_declared_schema():
    s = record_to_struct(API_ORDER_SCHEMA_JSON)
    assert s["total_amount"].dataType == T.DoubleType()
    assert s["line_items"].dataType == T.ArrayType(T.StringType())


def test_json_tree_mixed_and_ignores_underscore(spark, tmp_out):
    base = tmp_out("tree")
    spark.createDataFrame([("1",), ("2",)], "id string").write.json(f"{base}/ingestion_date=2024-01-01")
    spark.range(1).select(F.lit('[{"id": "3"}, {"id": "4"}]').alias("value")) \
        .write.text(f"{base}/ingestion_date=2024-01-02")
    spark.createDataFrame([("99",)], "id string").write.json(f"{base}/_runs")
    got = read_json_tree(spark, base, T.StructType([T.StructField("id", T.StringType())]))
    assert sorted(r.id for r in got.collect()) == ["1", "2", "3", "4"]


def test_page_files_are_all_read(spark, tmp_out):
    folder = tmp_out("pages")
    rec = T.StructType([T.StructField("id", T.LongType())])
    pages = {1: [{"id": i} for i in range(3)], 2: {"items": [{"id": 10}, {"id": 11}, {"id": 12}]},
             3: {"orders": [{"id": 20}]}, 5: [], 400: [{"id": 30}, {"id": 31}, {"id": 32}]}
    rows = [(p, json.dumps(v)) for p, v in pages.items()]
    spark.createDataFrame(rows, "page int, value string").write.partitionBy("page").text(folder)
    got = read_page_files(spark, folder, "orders", rec)
    assert sorted(r.id for r in got.collect()) == [0, 1, 2, 10, 11, 12, 20, 30, 31, 32]


def test_orphans_null_keys_count(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert orphan_count(child, "fk", parent, "pk").collect()[0][0] == 2


def test_expectations(spark, tmp_out):
    exps = [Expectation("valid_order_id", "order_id IS NOT NULL", "fail"),
            Expectation("valid_amount", "total_amount >= 0 OR total_amount IS NULL", "warn")]
    ok = spark.createDataFrame([("1", -1.0), ("2", None)], "order_id string, total_amount double")
    metrics = tmp_out("dq")
    assert apply_expectations(ok, exps, metrics, 7).count() == 2              # soft: kept
    m = {r.expectation: r.violations for r in spark.read.parquet(metrics).collect()}
    assert m == {"valid_order_id": 0, "valid_amount": 1}
    bad = spark.createDataFrame([(None, 1.0)], "order_id string, total_amount double")
    with pytest.raises(ExpectationFailed):
        apply_expectations(bad, exps)


def test_versioned_overwrite_reads_latest_commit(spark, tmp_out):
    base = tmp_out("ver")
    W.write_version(spark.range(3), base)
    cur = W.read_current(spark, base)
    W.write_version(cur.filter("id > 0"), base)                                 # rebuild from itself
    assert W.read_current(spark, base).count() == 2


def test_extract_resumes_and_is_chunked(spark, tmp_out):
    base = tmp_out("ext")
    ent = Entity("t", ("id", "wm"), keys=("id",), watermark="wm")
    src = spark.createDataFrame([(f"{i:03d}", f"2024-01-{1 + i % 9:02d} 00:00:00") for i in range(50)],
                                "id string, wm string")
    r1 = extract_to_raw(spark, src, ent, f"{base}/raw", f"{base}/ctl", "incremental", chunk_size=10,
                        run_ts=dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc),
                        cutoff=dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc))
    r2 = extract_to_raw(spark, src, ent, f"{base}/raw", f"{base}/ctl", "incremental", chunk_size=10,
                        run_ts=dt.datetime(2024, 2, 2, tzinfo=dt.timezone.utc))
    assert r1["rows"] + r2["rows"] == 50 and r1["status"] == r2["status"] == "completed"
    raw = spark.read.option("recursiveFileLookup", "true").json(f"{base}/raw/t")
    assert raw.select("id").distinct().count() == 50                           # nothing lost, no dupes
    assert raw.groupBy("_chunk_index").count().agg(F.max("count")).collect()[0][0] <= 10
    cp = control.load_checkpoint(spark, f"{base}/ctl/checkpoints", "t", "incremental")
    assert cp["last_chunk_index"] == raw.agg(F.max("_chunk_index")).collect()[0][0]
    with pytest.raises(ValueError):
        extract_to_raw(spark, src, ent, f"{base}/raw", f"{base}/ctl", "sometimes")
    skipped = extract_to_raw(spark, src, Entity("nowm", ("id",), keys=("id",)), f"{base}/raw",
                             f"{base}/ctl", "incremental", no_watermark="skip")
    assert skipped["status"] == "skipped_no_watermark"
    st = {r.status for r in control.run_status(spark, f"{base}/ctl/manifests").collect()}
    assert "running" not in st


def test_cluster_by_keeps_rows(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("a"), (F.col("id") % 11).alias("b"), "id")
    assert sorted(W.cluster_by(df, ["a", "b"], 4).collect()) == sorted(df.collect())


def test_pipeline_end_to_end_and_rerun_is_idempotent(spark, tmp_out):
    from lakeloom.plans import standins as S
    from lakeloom.plans.ingest import read_silver
    from lakeloom.plans.pipeline import run_pipeline
    from lakeloom.registry import CUSTOMERS, ORDERS

    sf = "/root/testdata/sf0.001"
    base = tmp_out("pipe")
    run = dt.datetime(2024, 3, 1, 2, tzinfo=dt.timezone.utc)
    extract_to_raw(spark, S.db_orders(spark, sf), ORDERS, f"{base}/raw", f"{base}/ctl",
                   "initial", chunk_size=500, run_ts=run)
    cust = S.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"), F.lit("00000").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"), F.lit("SP").alias("customer_state"))
    extract_to_raw(spark, cust, CUSTOMERS, f"{base}/raw", f"{base}/ctl", "initial", run_ts=run)
    r1 = run_pipeline(spark, f"{base}/raw", f"{base}/lake", ("orders", "customers"), run_ts=run)
    assert r1["bronze.orders"] == 1500 and r1["bronze.customers"] == 150
    r2 = run_pipeline(spark, f"{base}/raw", f"{base}/lake", ("orders", "customers"), run_ts=run)
    assert r2["bronze.orders"] == 0                                   # no file loaded twice
    assert read_silver(spark, f"{base}/lake", "orders").count() == 1500
    assert W.read_current(spark, f"{base}/lake/gold/fact_orders").count() == 1500
    assert W.read_current(spark, f"{base}/lake/gold/dim_customer").filter("is_current").count() == 150
    assert W.read_current(spark, f"{base}/lake/gold/daily_revenue_mart").count() > 0
    runs = control.job_runs(spark, f"{base}/lake/_control/job_runs").collect()
    assert [r.status for r in runs] == ["SUCCESS", "SUCCESS"]


def test_catalog_helpers(spark, tmp_out):
    from lakeloom.sources.tables import first_existing, list_tables, preview, table_or_none

    path = tmp_out("catalog_tbl")
    spark.range(10).write.parquet(path)
    names = W.ensure_layers(spark, "devtest")
    assert "devtest_gold" in names
    W.register_table(spark, "devtest_gold.numbers", path, comment="ten numbers",
                     properties={"quality": "gold"})
    assert "numbers" in list_tables(spark, "devtest_gold")
    assert preview(spark, "numbers", 3, database="devtest_gold").count() == 3
    with pytest.raises(LookupError):
        preview(spark, "nope", 3, database="devtest_gold")
    assert table_or_none(spark, "devtest_gold.missing") is None
    assert first_existing(spark, "devtest_gold.missing", "devtest_gold.numbers").count() == 10
    W.materialise(spark.range(2), "staging_two", as_view=True)
    assert spark.table("staging_two").count() == 2


def test_unreadable_raw_fails_the_run(spark, tmp_out):
    from lakeloom.plans.pipeline import run_pipeline

    base = tmp_out("broken")
    spark.range(2).select(F.lit('{"order_id": "1", "Order_ID": "2"}').alias("value")).write.text(f"{base}/raw/orders/ingestion_date=2024-01-01")
    spark.range(2).write.parquet(f"{base}/lake/bronze/orders")  # a Bronze table without the columns it needs
    with pytest.raises(Exception):
        run_pipeline(spark, f"{base}/raw", f"{base}/lake", ("orders",))
    assert [r.status for r in control.job_runs(spark, f"{base}/lake/_control/job_runs").collect()] == ["FAILED"]


def test_clustered_files_have_narrow_ranges(spark, tmp_out):
    df = spark.range(4000).select(F.col("id").cast("string").alias("order_id"), F.date_add(F.lit("1995-01-01").cast("date"), F.pmod(F.xxhash64("id"), F.lit(2000)).cast("int")).alias("d"))
    path = tmp_out("z")
    W.cluster_by(df, ["order_id", "d"], 16).write.parquet(path)
    spread = (spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.date_diff(F.max("d"), F.min("d")).alias("days"))
              .agg(F.avg("days")).collect()[0][0])
    assert spread < 1400


def test_as_of_null_key_and_decimal_union(spark):
    from lakeloom.operators.asof import as_of_join
    from lakeloom.operators.union import union_by_name_aligned

    t = dt.datetime(2024, 1, 1)
    facts = spark.createDataFrame([(None, t), ("a", t)], "k string, t timestamp")
    dims = spark.createDataFrame([(None, t, "none"), ("a", t, "A")], "k string, f timestamp, v string")
    assert {(r.k, r.v) for r in as_of_join(facts, "k", "t", dims, "k", "f", ["v"]).collect()} == {(None, None), ("a", "A")}
    a = spark.sql("SELECT CAST('1.123456789012345' AS DECIMAL(20,15)) AS x")
    b = spark.sql("SELECT CAST(7 AS INT) AS x")
    assert sorted(str(r.x) for r in union_by_name_aligned(a, b).collect()) == ["1.123456789012345", "7.000000000000000"]


def test_replayed_stream_batch_replaces_its_first_try(spark, tmp_out):
    from lakeloom.plans.catalog_feeds import VIOLATED
    from lakeloom.streaming.pipelines import write_batch

    base = tmp_out("replay")
    rows = spark.createDataFrame([("1", 1.0, "SHIPPED"), ("2", -2.0, "SHIPPED"), ("3", 3.0, "PROCESSING")],
                                 "order_id string, total_amount double, status string")
    for batch in (rows.limit(1), rows, rows):
        write_batch(batch, 0, f"{base}/silver", f"{base}/dq", VIOLATED)
    assert sorted(r.order_id for r in spark.read.parquet(f"{base}/silver").collect()) == ["1", "2"]
    assert {(r.expectation, r.violations) for r in spark.read.parquet(f"{base}/dq").collect()} == {
        ("valid_order_id", 0), ("valid_amount", 1), ("settled", 1)}
    bad = rows.withColumn("order_id", F.lit(None).cast("string"))
    with pytest.raises(ExpectationFailed):
        write_batch(bad, 1, f"{base}/silver", f"{base}/dq", VIOLATED)
    assert spark.read.parquet(f"{base}/silver").count() == 2            # nothing of the failing batch


def test_csv_feed_with_a_wrong_header_fails(spark, tmp_out):
    from lakeloom.plans.landing import bronze_load
    from lakeloom.registry import raw_schema

    base = tmp_out("csvfeed")
    good = spark.createDataFrame([("1", "2", "s", "r", "3.5", "2024-01-01")], raw_schema("store_sales"))
    good.write.option("header", "true").csv(f"{base}/good/ingestion_date=2024-01-01")
    row = bronze_load(spark, f"{base}/good", "store_sales", raw_schema("store_sales")).collect()[0]
    assert (row.amount, str(row.ingestion_date)) == ("3.5", "2024-01-01")
    good.withColumnRenamed("amount", "price").write.option("header", "true").csv(f"{base}/bad")
    with pytest.raises(Exception):
        bronze_load(spark, f"{base}/bad", "store_sales", raw_schema("store_sales")).collect()


def test_pipeline_without_feeds_and_with_an_empty_one(spark, tmp_out):
    from lakeloom.plans.pipeline import export_gold, run_pipeline

    base = tmp_out("nofeeds")
    row = '{"order_id": "1", "customer_id": "c", "order_date": "2024-01-05", "status": "shipped", "total_amount": 2.5}'
    spark.range(1).select(F.lit(row).alias("value")).write.text(f"{base}/raw/orders/ingestion_date=2024-01-01")
    run_pipeline(spark, f"{base}/raw", f"{base}/lake", run_ts=dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc))
    assert export_gold(spark, f"{base}/lake", f"{base}/out") == ["fact_orders", "fact_sales", "daily_revenue_mart"]
    got = spark.read.parquet(f"{base}/out/fact_sales").collect()
    assert [(r.order_id, r.channel, r.total_amount) for r in got] == [("1", "online", 2.5)]


def test_clustering_finds_buckets_in_generated_code(spark):
    """No lambda is interpreted row by row, and a row's bucket is that of its key's number: texts, dates, nulls."""
    rows = [(t, d, x) for t in (None, "", "a", "a\0", "a\0\0b", "k00012", "k00012 and more", "日本語", "zzzzzzz")
            for d in (None, dt.date(1969, 12, 31), dt.date(2024, 5, 6)) for x in (None, -1.5, 0.0, float("nan"))]
    df = spark.createDataFrame(rows, "t string, d date, x double")
    edges = {"t": ["", "a", "k00012", "k00013"], "d": [dt.date(1969, 12, 31), dt.date(2024, 5, 7)], "x": [-1.5, 0.5]}
    for key, values in edges.items():
        some = spark.createDataFrame([(v,) for v in values], f"{key} {dict(df.dtypes)[key]}")
        cuts = sorted(r[0] for r in some.select(W._as_number(some, key)).collect())
        got = W._with_bucket(df.withColumn("n", W._as_number(df, key)), key, cuts, 3, "b")
        assert "lambdafunction" not in got._jdf.queryExecution().optimizedPlan().toString()
        for r in got.collect():
            assert r["b"] == (0 if r["n"] is None else sum(c <= r["n"] or r["n"] != r["n"] for c in cuts)), r
    plan = W.cluster_by(df, ["t", "d"], 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan
