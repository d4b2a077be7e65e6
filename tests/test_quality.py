"""Declared rules and day profiles on small tables with NULLs, blanks, copies and no rows."""

import pytest
from pyspark.sql import functions as F

from lakeloom.quality import sketches
from lakeloom.quality.declared import Rule, check_declared

RULES = [Rule("key", "t", "required", ("k",)), Rule("unique", "t", "unique", ("k", "v")), Rule("range", "t", "between", ("v",), low=1, high=5),
         Rule("domain", "t", "one_of", ("k",), values=("a", "b")), Rule("parent", "t", "reference", ("k",), parent="p", parent_columns=("id",)),
         Rule("row", "t", "holds", condition="k <> 'b' OR v = '2'", allowed=1), Rule("ids", "p", "unique", ("id",))]


def test_declared_rules(spark):
    t = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "9"), ("c", ""), (None, "x"), (" ", None)], "k string, v string")
    p = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    out = check_declared({"t": t, "p": p}, RULES)
    assert {r.rule: (r.rows, r.violations, r.passed) for r in out.collect()} == {
        "key": (6, 2, False), "unique": (6, 1, False), "range": (6, 1, False), "domain": (6, 2, False),
        "parent": (6, 2, False), "row": (6, 1, True), "ids": (3, 1, False)}
    none = check_declared({"t": t.limit(0), "p": p.limit(0)}, RULES).collect()
    assert all(r.violations == 0 and r.passed for r in none) and len(none) == len(RULES)
    with pytest.raises(ValueError):
        Rule("x", "t", "sometimes")


def test_one_aggregation_a_table(spark):
    t = spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").cast("string").alias("v"))
    plan = check_declared({"t": t, "p": t.select(F.col("k").alias("id"))}, RULES[:3])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def test_day_profiles_replace_days_and_merge(spark, tmp_out):
    path = tmp_out("profiles")
    rows = [("2024-01-01", "a"), ("2024-01-01", None), ("2024-01-02", "a"), ("2024-01-02", "b"), ("2024-01-03", "c")]
    df = spark.createDataFrame(rows, "d string, v string")
    sketches.add_days(df, ["v"], "d", path)
    sketches.add_days(df.filter("d = '2024-01-02'").unionAll(df.limit(0)), ["v"], "d", path)
    got = sketches.profile(spark, path).first()
    assert (got["rows"], got.nulls, got.low, got.high, got.distinct) == (5, 1, "a", "c", 3)
    assert sketches.profile(spark, path, "2024-01-02", "2024-01-02").first().distinct == 2
