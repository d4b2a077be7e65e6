"""Physical-plan assertions: the plan shapes the scale design relies on."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_dedupe_limits_before_shuffle(spark):
    plan = _plan(E.queries()["daily_revenue"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_orphans_use_anti_join(spark):
    # Catalyst pushes the anti join below the per-key aggregate; with a small
    # parent side AQE makes it a broadcast anti join (no shuffle on the key).
    plan = _plan(E.queries()["orphans"](spark, SF))
    assert "LeftAnti" in plan


def test_replay_prunes_partitions(spark):
    df = E.queries()["raw_replay"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in text or "PartitionFilters" in text


def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["status_distribution"](spark, SF))
    assert "ReadSchema: struct<o_orderstatus:string>" in plan
