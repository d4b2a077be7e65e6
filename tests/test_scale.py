"""What keeps a job's largest task, its rewrites and its batches in step with its input."""

import datetime as dt

from pyspark.sql import functions as F

from lakeloom.operators.ranges import range_cuts
from lakeloom.plans import landing
from lakeloom.plans.landing import extract_to_raw
from lakeloom.registry import Entity
from lakeloom.session import list_names
from lakeloom.sinks import keyed as K

RUN = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


# ------------------------------------------------------------------ keyed tables
def test_merged_rows_are_written_once(spark, tmp_out):
    path = tmp_out("moved")
    rows = spark.createDataFrame([(f"k{i}", i) for i in range(40)], "k string, at long").withColumn(K.RANK, F.struct("at"))
    staged = K.stage_merge(rows, path, ["k"], "s0", buckets=4)
    files = {f.rsplit("/", 1)[1] for f in spark.read.parquet(staged).inputFiles()}
    K._apply(spark, path, staged)
    assert {f.rsplit("/", 1)[1] for f in spark.read.parquet(path).inputFiles()} == files


def test_a_swap_cut_off_between_buckets_is_finished(spark, tmp_out):
    path = tmp_out("half")

    def ranked(at):
        return spark.createDataFrame([(f"k{i}", at) for i in range(40)], "k string, at long").withColumn(K.RANK, F.struct("at"))
    K.merge_latest(ranked(1), path, ["k"], "s0", buckets=4)
    staged = K.stage_merge(ranked(2), path, ["k"], "s1", buckets=4)
    K.replace_path(spark, f"{staged}/{K.BUCKET}=0", f"{path}/{K.BUCKET}=0")  # one is in,
    K.delete_path(spark, f"{path}/{K.BUCKET}=1")  # the next is out and not in yet
    assert K.recover(spark, path) == ["s1"]
    got = K.read_keyed(spark, path).collect()
    assert len(got) == 40 and {r["at"] for r in got} == {2}


# ------------------------------------------------------------------ range cuts
def test_few_values_are_cut_as_finely_as_many(spark):
    df = spark.range(20_000).select((F.col("id") % 300).alias("k"))  # 20 rows: a range each by the row count alone
    cuts = range_cuts(df, ["k"], 4)
    sizes = [r["count"] for r in cuts.assign(df, "r").groupBy("r").count().collect()]
    assert cuts.count == 4 and max(sizes) < 10_000


def test_extract_without_key_cuts_one_watermark(spark, tmp_out, monkeypatch):
    base, seen = tmp_out("keyless"), []
    src = spark.range(2_000).select(F.col("id").cast("string").alias("v"), F.lit("2020-01-01 00:00:00").alias("at"))
    entity = Entity("log", ("v", "at"), keys=(), watermark="at")
    assign = landing.assign_chunks
    monkeypatch.setattr(landing, "assign_chunks", lambda df, order, *a, **k: seen.append(range_cuts(df, order, 4)) or assign(df, order, *a, **k))
    done = extract_to_raw(spark, src, entity, f"{base}/raw", f"{base}/control", run_ts=RUN, chunk_size=100)
    raw = spark.read.option("recursiveFileLookup", "true").json(f"{base}/raw/log")
    sizes = [r["count"] for r in raw.groupBy("_chunk_index").count().collect()]
    assert seen[0].count == 4 and done["rows"] == 2_000 == raw.select("v").distinct().count() and sizes == [100] * 20
    assert "__row" not in raw.columns



# ------------------------------------------------------------------ streams
def test_replay_of_many_files_takes_four_triggers(spark, tmp_out):
    from lakeloom.plans import raw_fixtures as RF
    from lakeloom.streaming import pipelines as P

    base = tmp_out("groups")
    rows = [(k, n) for k in (*range(1, 13), None) for n in (1, 2, 2)]
    li = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int").repartition(6)
    li.write.parquet(f"{base}/sf/lineitem.parquet")
    schema, batches = li.withColumn("part", F.lit(0)).schema, 0
    for _ in RF.write_lineitem_replay(spark, f"{base}/sf", f"{base}/in"):
        P.first_arrival_stream(spark, f"{base}/in", schema, ["l_orderkey", "l_linenumber"], f"{base}/out", f"{base}/ckpt", None)
        batches += 1
    assert len(spark.read.parquet(f"{base}/in").inputFiles()) > 5 == batches  # NULL keys are a group of their own
    done = [n for n in list_names(spark, f"{base}/ckpt/commits") if n.isdigit()]
    got = [(r.l_orderkey, r.l_linenumber) for r in spark.read.parquet(f"{base}/out").collect()]
    assert len(done) == 5 and len(got) == len(set(got)) and set(got) == set(rows)
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")  # the session's own stays


def test_no_stream_input_is_written_by_one_task(spark, tmp_out, monkeypatch):
    from pyspark.sql import DataFrame

    from lakeloom.plans import catalog_incremental as C

    sf = f"{tmp_out('streams')}/sf"
    rows = [(k, n, dt.date(2024, 1, n)) for k in range(8) for n in (2, 3) if k % 2 or n == 3]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_shipdate date").repartition(3).write.parquet(f"{sf}/lineitem.parquet")
    control = DataFrame.coalesce
    monkeypatch.setattr(DataFrame, "coalesce", lambda df, n: control(df, n) if "l_linenumber" not in df.columns else 1 / 0)
    got = {tuple(r) for r in C.q_stream_first_keyed(spark, sf).collect()}
    assert got == {(k, 2 if k % 2 else 3) for k in range(8)}
