"""Metric functions on golden cases."""

import pytest
from pyspark.sql import functions as F

from sparkweave.functions import scalars as S
from sparkweave.operators import metrics as X


def test_counter_reset(spark):
    rows = [("a", i, v) for i, v in enumerate([10, 15, 15, 3, 8])]
    df = spark.createDataFrame(rows, "s string, t int, v int").withColumn("bin", F.floor(F.col("t") / 2))
    got = [r["increase"] for r in X.counter_increases(df, ["s"], ["t"], "v", "bin").orderBy("t").collect()]
    assert got == [None, 5, 0, 3, 5]


def test_histogram_quantile(spark):
    bounds = [0.1, 0.5, 1.0]
    df = spark.createDataFrame([(v,) for v in [0.05] * 50 + [0.3] * 40 + [0.7] * 5 + [9.0] * 5], "v double")
    b = X.bucket_counts(df, [], "v", bounds)
    r = b.select(*[X.histogram_quantile(q, bounds).alias(f"q{int(q * 100)}") for q in (0.25, 0.7, 0.99)]).first()
    assert r["q25"] == pytest.approx(0.05) and r["q70"] == pytest.approx(0.1 + 0.4 * 20 / 40) and r["q99"] == 1.0


def test_apdex_forms(spark):
    df = spark.createDataFrame([(60, 80, 100)], "a int, b int, n int")
    r = df.select(X.apdex(F.col("a"), F.col("b"), F.col("n")).alias("x"), X.apdex(F.col("a"), F.col("b"), F.col("n"), True).alias("y")).first()
    assert (r["x"], r["y"]) == (0.7, 1.0)


@pytest.mark.parametrize("rate,target,want", [(99.73, 99.5, 54.0), (90.0, 99.5, 100.0), (100.0, 99.5, 0.0), (99.0, 100.0, 100.0)])
def test_budget(spark, rate, target, want):
    assert spark.range(1).select(X.budget_used(F.lit(rate), target)).first()[0] == pytest.approx(want, abs=1e-6)


def test_alert_must_hold(spark):
    df = spark.createDataFrame([(i, f) for i, f in enumerate([1, 1, 0, 1, 1, 1, 0, 1])], "step bigint, f int")
    got = [(r["first"], r["last"]) for r in X.held_alerts(df, [], "step", F.col("f") == 1, 3).collect()]
    assert got == [(3, 5)]


def test_trace_golden(spark):
    rows = [("t", "gateway", None, 45), ("t", "auth", "gateway", 12), ("t", "orders", "gateway", 18), ("t", "db", "orders", 15), ("t", "cache", "auth", 2)]
    got = {r["span"]: r for r in X.trace_tree(spark.createDataFrame(rows, "trace string, span string, parent string, duration bigint")).collect()}
    assert got["gateway"]["self_time"] == 15 and got["gateway"]["critical_child"] == "orders"
    assert [got[s]["depth"] for s in ("gateway", "auth", "db", "cache")] == [0, 1, 2, 2]


def test_label_selectors(spark):
    df = spark.sql("SELECT map('job', 'api', 'status', '503') AS l UNION ALL SELECT map('job', 'web', 'status', '200')")
    assert df.filter(X.label_matches("l", {"status": ("=~", "5.."), "zone": ("=", "")})).count() == 1
    assert df.filter(X.label_matches("l", {"job": ("!=", "api")})).count() == 1


def test_parse_first_of_several_formats(spark):
    df = spark.createDataFrame([("2024-01-15T12:00",), ("2024-01-15 12:00:00",), ("15.01.2024",), ("never",)], "s string")
    got = [r[0] for r in df.select(S.parse_first(F.col("s"), ["yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy"]).cast("string")).collect()]
    assert got == ["2024-01-15 12:00:00", "2024-01-15 12:00:00", "2024-01-15 00:00:00", None]


def test_buckets_edges_and_null(spark):
    df = spark.createDataFrame([(-11.0,), (-10.0,), (39.9,), (40.0,), (None,)], "t double")
    steps = [(-10, "extreme_cold"), (0, "freezing"), (10, "cold"), (20, "mild"), (30, "warm"), (40, "hot")]
    assert [r[0] for r in df.select(S.buckets(F.col("t"), steps, "extreme_heat")).collect()] == ["extreme_cold", "freezing", "hot", "extreme_heat", None]
