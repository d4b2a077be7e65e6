"""Manifest loads, rejected rows, keyed merges and their recovery, tracked streams, fixed range cuts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.functions.audit import batch_id
from lakeloom.operators.ranges import range_cuts
from lakeloom.plans import ingest as I
from lakeloom.plans import medallion as M
from lakeloom.sinks import keyed as K
from lakeloom.streaming import tracked as TR
from lakeloom.streaming.pipelines import bronze_stream

RUN = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
ORDER = '{"order_id": "%s", "status": "%s", "updated_at": "2024-01-0%d 00:00:00", "order_date": "2024-01-05", "total_amount": %s}'


def land(spark, folder, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)


def ranked(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, at long").withColumn(K.RANK, F.struct("at", "v"))


def held(spark, path):
    return {r.k: r.v for r in K.read_keyed(spark, path).collect()}


# ------------------------------------------------------------------ keyed tables
def test_merges_equal_latest_of_all_batches(spark, tmp_out):
    path, rnd, all_rows = tmp_out("keyed"), random.Random(3), []
    batches = [[(f"k{rnd.randrange(30)}", f"v{rnd.randrange(99)}", rnd.randrange(40)) for _ in range(25)] for _ in range(4)]
    for step, rows in enumerate([*batches, batches[1], []]):  # one again, one empty
        all_rows += rows
        K.merge_latest(ranked(spark, rows), path, ["k"], f"s{step}", buckets=4)
        exp = {}
        for k, v, at in all_rows:
            exp[k] = max(exp.get(k, (-1, "")), (at, v))
        assert held(spark, path) == {k: v for k, (_, v) in exp.items()}


def test_merge_touches_only_its_buckets(spark, tmp_out):
    path = tmp_out("touched")
    K.merge_latest(ranked(spark, [(f"k{i}", "a", 1) for i in range(200)]), path, ["k"], "s0", buckets=16)
    before = set(spark.read.parquet(path).inputFiles())
    K.merge_latest(ranked(spark, [("k7", "b", 2)]), path, ["k"], "s1", buckets=16)
    after = set(spark.read.parquet(path).inputFiles())
    changed = {f.rsplit("/", 2)[1] for f in before ^ after}
    assert len(changed) == 1 and held(spark, path)["k7"] == "b"
    (bucket,) = (int(c.split("=")[1]) for c in changed)
    assert all(f"{K.BUCKET}={bucket}/" in f for f in K.read_buckets(spark, path, [bucket]).inputFiles())


def test_a_cut_off_merge_is_finished_or_undone(spark, tmp_out):
    path = tmp_out("cut")
    K.merge_latest(ranked(spark, [("a", "1", 1), ("b", "1", 1)]), path, ["k"], "s0", buckets=2)
    staged = K.stage_merge(ranked(spark, [("a", "2", 2)]), path, ["k"], "s1", buckets=2)
    spark.createDataFrame([("lost",)], "k string").write.mode("overwrite").parquet(  # the crash hits while a bucket is replaced
        f"{path}/{K.BUCKET}={spark.read.parquet(staged).first()[K.BUCKET]}")
    assert K.recover(spark, path) == ["s1"] and held(spark, path) == {"a": "2", "b": "1"}
    staged = K.stage_merge(ranked(spark, [("a", "3", 3)]), path, ["k"], "s2", buckets=2)
    K.delete_path(spark, f"{staged}/_SUCCESS")  # the crash hits while it is staged
    K.merge_latest(ranked(spark, [("b", "4", 4)]), path, ["k"], "s3", buckets=2)
    assert held(spark, path) == {"a": "2", "b": "4"} and K.recover(spark, path) == []


# ------------------------------------------------------------------ bronze
def test_files_load_once_and_bronze_is_not_read_for_it(spark, tmp_out):
    base = tmp_out("once")
    raw, lake = f"{base}/raw", f"{base}/lake"
    land(spark, f"{raw}/ingestion_date=2024-01-01", [ORDER % ("1", "a", 1, "1.5")])
    land(spark, f"{raw}/stray", [ORDER % ("2", "a", 1, "1.5")])
    first = I.load_bronze(spark, raw, lake, "orders", RUN)
    assert [x["rows"] for x in first] == [2]
    land(spark, f"{raw}/ingestion_date=2024-01-02", [ORDER % ("3", "a", 1, "1.5")])
    new = I.new_files(spark, raw, lake, "orders")
    assert new.count() == 1 and not any("/bronze/" in f for f in new.inputFiles())
    pruned = I.new_files(spark, raw, lake, "orders", since="2024-01-02")
    assert pruned.count() == 1 and not any("ingestion_date=2024-01-01" in f for f in pruned.inputFiles())
    assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().executedPlan().toString()
    assert sum(x["rows"] for x in I.load_bronze(spark, raw, lake, "orders", RUN)) == 1
    assert I.load_bronze(spark, raw, lake, "orders", RUN) == []
    rows = I.read_bronze(spark, lake, "orders").collect()
    assert sorted((r.order_id, str(r.ingestion_date)) for r in rows) == [("1", "2024-01-01"), ("2", "None"), ("3", "2024-01-02")]


def test_a_cut_off_load_runs_again_and_is_unseen_until_then(spark, tmp_out):
    base = tmp_out("cutload")
    raw, lake = f"{base}/raw", f"{base}/lake"
    land(spark, f"{raw}/ingestion_date=2024-01-01", [ORDER % (str(i), "a", 1, "1.5") for i in range(4)])
    I.load_bronze(spark, raw, lake, "orders", RUN)
    land(spark, f"{raw}/ingestion_date=2024-01-02", [ORDER % ("9", "a", 1, "1.5")])
    I.plan_loads(spark, raw, lake, "orders", RUN)
    (cut,) = I.pending_loads(spark, lake, "orders")
    (spark.createDataFrame([("junk", "false", "2024-01-02")], "order_id string, rejected string, ingestion_date string")
     .write.partitionBy("rejected", "ingestion_date").parquet(f"{lake}/bronze/orders/load_id={cut}"))
    assert I.read_bronze(spark, lake, "orders").count() == 4
    assert [x["load_id"] for x in I.load_bronze(spark, raw, lake, "orders", RUN)] == [cut]
    assert sorted(r.order_id for r in I.read_bronze(spark, lake, "orders").collect()) == ["0", "1", "2", "3", "9"]


def test_many_files_are_cut_into_loads(spark, tmp_out):
    base = tmp_out("many")
    for i in range(9):
        land(spark, f"{base}/raw/ingestion_date=2024-01-0{i % 3 + 1}", [ORDER % (str(i), "a", 1, "1.5")])
    done = I.load_bronze(spark, f"{base}/raw", f"{base}/lake", "orders", RUN, files_per_load=2)
    assert len(done) > 2 and sum(x["files"] for x in done) == 9 == I.read_bronze(spark, f"{base}/lake", "orders").count()


def test_uncommitted_batches_wait(spark, tmp_out):
    base = tmp_out("commit")
    land(spark, f"{base}/raw/ingestion_date=2024-01-01/batch_id={batch_id(RUN)}", [ORDER % ("1", "a", 1, "1.5")])
    done = spark.createDataFrame([("other",)], "batch_id string")
    assert I.load_bronze(spark, f"{base}/raw", f"{base}/lake", "orders", RUN, done) == []
    done = spark.createDataFrame([(batch_id(RUN),), ("other",)], "batch_id string")
    assert [x["rows"] for x in I.load_bronze(spark, f"{base}/raw", f"{base}/lake", "orders", RUN, done)] == [1]


def test_rejected_rows_are_kept_apart(spark, tmp_out):
    base = tmp_out("rejects")
    bad = ['{"order_id": "7", "total_amount": "much"}', '{"order_id": "8', "no json"]
    land(spark, f"{base}/raw/ingestion_date=2024-01-01", [ORDER % ("1", "a", 1, "2.5"), *bad])
    (done,) = I.load_bronze(spark, f"{base}/raw", f"{base}/lake", "orders", RUN)
    assert (done["rows"], done["rejected"]) == (1, 3)
    assert [r.order_id for r in I.read_bronze(spark, f"{base}/lake", "orders").collect()] == ["1"]
    got = I.quarantine(spark, f"{base}/lake", "orders").collect()
    assert sorted(r.record for r in got) == sorted(bad) and all("ingestion_date=2024-01-01" in r._source_file for r in got)
    land(spark, f"{base}/csv/ingestion_date=2024-01-01", ["id,store_id,store_name,region,amount,sale_date", "1,2,s,r,3.5,2024-01-01", "2,3"])
    (done,) = I.load_bronze(spark, f"{base}/csv", f"{base}/lake", "store_sales", RUN)
    assert (done["rows"], done["rejected"]) == (1, 1)
    assert [r.record for r in I.quarantine(spark, f"{base}/lake", "store_sales").collect()] == ["2,3"]


# ------------------------------------------------------------------ silver
def test_silver_load_by_load_equals_a_rebuild(spark, tmp_out):
    base, rnd = tmp_out("silver"), random.Random(5)
    raw, lake = f"{base}/raw", f"{base}/lake"
    for day in range(1, 5):
        lines = [ORDER % (f" {rnd.randrange(12)} ", rnd.choice(["a ", "b"]), rnd.randrange(1, 4), rnd.choice(["1.0", "2.0"])) for _ in range(10)]
        lines += ['{"order_id": " ", "status": "no key"}', '{"order_id": "1"}']
        if day == 3:
            lines.append('{"order_id": "5", "updated_at": "2024-01-09 00:00:00", "currency": "EUR"}')
        land(spark, f"{raw}/ingestion_date=2024-01-0{day}", lines)
        I.load_bronze(spark, raw, lake, "orders", RUN)
        if day != 2:  # two loads at once the next time
            assert len(I.merge_silver(spark, lake, "orders", buckets=4)) == (2 if day == 3 else 1)
    assert I.merge_silver(spark, lake, "orders", buckets=4) == []
    silver = I.read_silver(spark, lake, "orders")
    exp = M.silver_rebuilt(I.read_bronze(spark, lake, "orders").drop("load_id"), M.silver_rule("orders")).select(*silver.columns)
    assert sorted(map(str, silver.collect())) == sorted(map(str, exp.collect())) and silver.count() == 12
    assert silver.filter("order_id = '5'").first().currency == "EUR"


@pytest.mark.parametrize("entity,key", [("geolocation", "geolocation_zip_code_prefix"), ("sellers", "seller_id"),
                                        ("order_reviews", "review_id"), ("order_payments", "payment_type")])
def test_silver_of_the_other_entities(spark, tmp_out, entity, key):
    from lakeloom.registry import ENTITIES

    base = tmp_out(entity)
    values = ",".join(f'"{c}": "x"' for c in ENTITIES[entity].columns if c != key)
    for day in (1, 2):
        land(spark, f"{base}/raw/ingestion_date=2024-01-0{day}", [f'{{"{key}": "{i}", {values}}}' for i in (1, 1, 2)])
        I.load_bronze(spark, f"{base}/raw", f"{base}/lake", entity, RUN)
        I.merge_silver(spark, f"{base}/lake", entity)
    got = I.read_silver(spark, f"{base}/lake", entity)
    assert got.count() == (1 if entity == "order_payments" else 2)


# ------------------------------------------------------------------ streams
def test_tracked_stream_keeps_new_columns_and_rejects(spark, tmp_out):
    base = tmp_out("tracked")
    declared = spark.createDataFrame([], "order_id string, total_amount double").schema
    for day, lines in enumerate((['{"order_id": "1", "total_amount": 1}'], ['{"order_id": "2", "note": {"a": 1}}', '{"order_id": "3", "total_amount": "x"}'],
                                 ['{"order_id": "4", "note": "text"}']), 1):
        land(spark, f"{base}/raw/ingestion_date=2024-01-0{day}", lines)
        TR.run_bronze_tracked(spark, f"{base}/raw", declared, f"{base}/bronze", f"{base}/ckpt", RUN)
    got = {r.order_id: r.note for r in TR.read_tracked(spark, f"{base}/bronze").collect()}
    assert got == {"1": None, "2": '{"a": 1}', "4": "text"}
    assert [r._corrupt_record for r in TR.read_tracked(spark, f"{base}/bronze", rejected=True).collect()] == ['{"order_id": "3", "total_amount": "x"}']
    assert TR.logged_schema(spark, f"{base}/bronze/_schemas").names == ["order_id", "total_amount", "note"]


def test_latest_stream_is_idempotent(spark, tmp_out):
    base = tmp_out("latest")
    schema = spark.createDataFrame([], "order_id string, status string, updated_at string, order_date string, total_amount double").schema
    land(spark, f"{base}/raw/ingestion_date=2024-01-01", [ORDER % ("1", "new", 3, "1.0"), ORDER % (" 2", "old", 1, "1.0")])
    land(spark, f"{base}/raw/ingestion_date=2024-01-02", [ORDER % ("1", "late", 2, "1.0"), ORDER % ("2", "new", 2, "1.0"), ORDER % (" ", "no key", 1, "1.0")])
    for checkpoint in ("a", "b"):
        source = bronze_stream(spark, f"{base}/raw", schema, RUN, max_files_per_trigger=1)
        TR.run_latest(source, M.silver_rule("orders"), f"{base}/silver", f"{base}/{checkpoint}", buckets=2)
        assert {r.order_id: r.status for r in K.read_keyed(spark, f"{base}/silver").collect()} == {"1": "NEW", "2": "NEW"}


# ------------------------------------------------------------------ fixed cuts
@pytest.mark.parametrize("count", [1, 2, 7, 64])
def test_cuts_are_ordered_and_stable(spark, count):
    df = spark.range(500).select(F.when(F.col("id") % 9 > 0, F.col("id") % 23).alias("k"), (F.col("id") * 37 % 101).cast("string").alias("t"))
    cuts = range_cuts(df, ["k", "t"], count)
    got = cuts.assign(df, "r").collect()
    assert sorted(got, key=repr) == sorted(cuts.assign(df.repartition(3), "r").collect(), key=repr)
    order = sorted(got, key=lambda r: (r.k is not None, r.k if r.k is not None else 0, r.t))
    assert [r.r for r in order] == sorted(r.r for r in got)
    assert len({r.r for r in got}) == cuts.count <= count
    assert cuts.count == 1 or max(sum(x.r == i for x in got) for i in range(count)) < 500
    assert range_cuts(df.limit(0), ["k", "t"], count).count == 1


def test_no_checkpoint_in_scd2_plan(spark):
    from lakeloom.operators.scd2 import scd2

    df = spark.range(300).select((F.col("id") % 7).cast("string").alias("customer_id"), F.col("id").cast("timestamp").cast("string").alias("updated_at"),
                                 (F.col("id") % 2).cast("string").alias("seg"))
    plan = scd2(df, ["customer_id"], "updated_at", ["seg"])._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan
