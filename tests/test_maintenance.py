"""Table maintenance and quality rules: golden cases, reruns, order independence."""

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sparkweave.operators import aggregates as A
from sparkweave.operators import graphs as G
from sparkweave.operators import maintenance as K
from sparkweave.operators import quality as D
from sparkweave.session import new_folder
from sparkweave.sources import files
from sparkweave.sources.runlog import RunLog


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_merge_golden(spark):
    target = spark.createDataFrame([(1, "Alice", "ACTIVE"), (2, "Bob", "ACTIVE")], "id int, name string, status string")
    source = spark.createDataFrame([(1, "Alice Modified", "ACTIVE"), (2, "Bob", "DELETED"), (3, "Charlie", "ACTIVE")], "id int, name string, status string")
    out = K.merge(target, source, ["id"], F.col("s.status") == "DELETED", ["name"])
    assert sorted(map(tuple, out.collect())) == [(1, "Alice Modified", "ACTIVE"), (3, "Charlie", "ACTIVE")]


def test_upsert_twice_is_once(spark):
    target = spark.createDataFrame([(1, 10, "d1"), (2, 20, "d1")], "id int, v int, loaded string")
    source = spark.createDataFrame([(2, None, "d2"), (3, 30, "d2")], "id int, v int, loaded string")
    once = K.upsert(target, source, ["id"], keep_first=["loaded"])
    assert sorted(map(tuple, once.collect())) == [(1, 10, "d1", "kept"), (2, None, "d1", "updated"), (3, 30, "d2", "inserted")]
    once = once.drop("action")
    assert same(K.upsert(once, source, ["id"], keep_first=["loaded"]).drop("action"), once)


def scd_dim(spark):
    return spark.createDataFrame(
        [(1, 7, "New York", dt.date(2023, 1, 1), dt.date(9999, 12, 31), True), (2, 8, None, dt.date(2023, 1, 1), dt.date(9999, 12, 31), True)],
        "sk bigint, id bigint, state string, valid_from date, valid_to date, is_current boolean",
    )


def test_scd2_golden_and_rerun(spark):
    news = spark.createDataFrame([(7, "California"), (8, None), (9, "Texas")], "id bigint, state string")
    out = files.stored(K.scd2_apply(scd_dim(spark), news, "id", ["state"], "2023-05-01"), "scd")
    rows = {(r["id"], r["state"]): r for r in out.collect()}
    assert len(rows) == 4
    assert rows[7, "New York"]["valid_to"] == dt.date(2023, 4, 30) and not rows[7, "New York"]["is_current"]
    assert rows[7, "California"]["valid_from"] == dt.date(2023, 5, 1) and rows[7, "California"]["valid_to"] == dt.date(9999, 12, 31)
    assert rows[8, None]["is_current"]
    assert sorted(r["sk"] for r in rows.values()) == [1, 2, 3, 4]
    assert same(K.scd2_apply(out, news, "id", ["state"], "2023-06-01"), out)


def test_scd3_keeps_previous(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "id int, c string")
    once = K.scd3_apply(dim, spark.createDataFrame([(1, "x"), (2, "b")], "id int, c string"), "id", "c")
    assert sorted(map(tuple, once.select("id", "c", "previous_c").collect())) == [(1, "x", "a"), (2, "b", None)]


def test_changes_apply_and_tombstones(spark):
    log = spark.createDataFrame([(1, 1, "c", 5), (1, 3, "u", 7), (2, 2, "c", 1), (2, 4, "d", None), (3, 6, "d", None), (3, 9, "c", 2)], "id int, lsn int, op string, v int")
    assert sorted(map(tuple, K.apply_changes(log, "id", "lsn", F.col("op") == "d").select("id", "v").collect())) == [(1, 7), (3, 2)]


def test_load_range():
    day = dt.date
    assert K.load_range(None, day(2024, 1, 10)) == (day(2024, 1, 4), day(2024, 1, 10))
    assert K.load_range(day(2024, 1, 8), day(2024, 1, 10)) == (day(2024, 1, 7), day(2024, 1, 10))
    assert K.load_range(day(2023, 1, 1), day(2024, 1, 31)) == (day(2022, 12, 31), day(2024, 1, 31))
    parts = K.portions(day(2022, 12, 31), day(2024, 1, 31))
    days = [a + dt.timedelta(days=i) for a, b in parts for i in range((b - a).days + 1)]
    assert days == [day(2022, 12, 31) + dt.timedelta(days=i) for i in range(397)]


def test_watermark_survives_and_rises(spark):
    mark = K.Watermark(spark, new_folder(spark, "mark"))
    assert mark.read() is None
    mark.write(dt.date(2024, 1, 2))
    mark.write(dt.date(2024, 1, 5))
    assert mark.read() == dt.date(2024, 1, 5)


def test_schema_evolution(spark):
    target = spark.createDataFrame([], "a bigint, b string").schema
    df = spark.createDataFrame([(1, 2.0)], "a int, c double")
    assert K.evolve(df, target, "append").dtypes == [("a", "bigint"), ("b", "string"), ("c", "double")]
    assert K.evolve(df, target, "sync").dtypes == [("a", "bigint"), ("c", "double")]
    assert K.evolve(df, target, "ignore").dtypes == [("a", "bigint"), ("b", "string")]
    with pytest.raises(ValueError):
        K.evolve(df, target, "fail")


def test_schema_verdicts(spark):
    h = [("s", 1, "a", "int", False), ("s", 1, "b", "int", True),
         ("s", 2, "a", "int", False),                                     # optional b gone: full
         ("s", 3, "a", "int", False), ("s", 3, "c", "int", False),        # required c added: not backward
         ("s", 4, "a", "int", False),                                     # required c gone: not forward
         ("s", 5, "a", "string", False)]                                  # type changed: neither
    got = {r["version"]: r for r in K.schema_verdicts(spark.createDataFrame(h, "subject string, version int, field string, type string, optional boolean")).collect()}
    assert [(got[v]["backward"], got[v]["forward"]) for v in (2, 3, 4, 5)] == [(True, True), (False, True), (True, False), (False, False)]
    assert not got[4]["forward_transitive"] and got[4]["backward_transitive"] and not got[5]["full_transitive"]


def test_retention_by_date_or_size(spark):
    parts = spark.createDataFrame([(dt.date(2024, 1, i), 10) for i in range(1, 7)], "d date, n bigint")
    gone = {r["d"].day for r in K.expired(parts, "d", "n", F.lit("2024-01-03").cast("date"), 30).collect()}
    assert gone == {1, 2, 3}


def test_relay_publishes_once(spark):
    box = spark.createDataFrame([(i, f"p{i}") for i in range(5)], "id int, payload string")
    out = new_folder(spark, "relay")
    assert [K.relay(box.filter("id < 3"), out), K.relay(box, out), K.relay(box, out)] == [3, 2, 0]
    assert spark.read.parquet(out).count() == 5


def test_replace_partitions_keeps_the_others(spark):
    folder = new_folder(spark, "parts")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "v int, p string")
    files.write_partitioned(df, folder, ["p"])
    files.replace_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), folder, ["p"])
    assert sorted(map(tuple, spark.read.schema(df.schema).parquet(folder).collect())) == [(1, "a"), (9, "b")]


def test_sync_plan(spark):
    old = spark.createDataFrame([(1, "x"), (2, "y")], "id int, t string")
    new = spark.createDataFrame([(1, "x"), (2, "z"), (3, "n")], "id int, t string")
    assert {r["id"]: r["step"] for r in K.sync_plan(old, new, "id", ["t"]).collect()} == {1: "SKIP", 2: "UPDATE", 3: "INSERT"}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(-9, 9)), max_size=12), st.integers(0, 12))
def test_additive_upsert_ignores_load_order(spark, rows, cut):
    schema = "k int, a bigint"
    empty = spark.createDataFrame([], schema)
    x, y = spark.createDataFrame(rows[:cut], schema), spark.createDataFrame(rows[cut:], schema)
    load = lambda *parts: __import__("functools").reduce(lambda t, p: K.upsert_add(t, p, ["k"], ["a"]), parts, empty)
    assert same(load(x, y), load(y, x))


def test_rules_count_nulls_as_failures(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    r = D.rule_report(df, {"positive": F.col("v") > 0}).first()
    assert (r["rows"], r["failures"]) == (3, 2)
    good, bad = D.split_by_rules(df, {"positive": F.col("v") > 0})
    assert good.count() == 1 and bad.count() == 2


def test_gate():
    assert D.gate(9, 10) == 90.0
    with pytest.raises(D.QualityError):
        D.gate(7, 10)
    with pytest.raises(D.QualityError):
        D.gate(0, 0)


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (None,), (5,)], "k int")
    assert [r[0] for r in D.orphans(child, "k", spark.createDataFrame([(1,)], "p int"), "p").collect()] == [5]


def test_run_log_records_failure(spark):
    log = RunLog(spark, new_folder(spark, "log"))
    log.step("ok", lambda: spark.range(3))
    with pytest.raises(ZeroDivisionError):
        log.step("bad", lambda: 1 / 0)
    assert {(r["step"], r["status"], r["rows"]) for r in log.read().collect()} == {("ok", "success", 3), ("bad", "failed", None)}


def test_hierarchy_and_walks(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 3)], "id int, parent int")
    assert {r["id"]: (r["level"], r["path"]) for r in G.hierarchy(tree, "id", "parent", "id").collect()} == {
        1: (1, "1"), 2: (2, "1 > 2"), 3: (2, "1 > 3"), 4: (3, "1 > 3 > 4")}
    ring = spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "src int, dst int")
    start = spark.createDataFrame([(0,)], "node int")
    assert {r["node"]: r["depth"] for r in G.reach(ring, start, 9).collect()} == {0: 0, 1: 1, 2: 2}
    assert max(r["depth"] for r in G.walks(ring, start, 9).collect()) == 2


def test_majority_vote_ties_and_review(spark):
    votes = spark.createDataFrame([(1, "b"), (1, "a"), (2, "x"), (2, "x"), (2, "y")], "item int, label string")
    got = {r["item"]: (r["label"], r["decision"]) for r in A.majority_vote(votes, "item", "label", 0.6).collect()}
    assert got == {1: ("a", "HUMAN_REVIEW"), 2: ("x", "x")}


def test_salted_aggregation_equals_plain(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    got = A.two_stage(df, ["k"], F.col("id"), {"s": ("sum", "id"), "n": ("count", "id"), "lo": ("min", "id"), "hi": ("max", "id")})
    want = df.groupBy("k").agg(F.sum("id").alias("s"), F.count("id").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    assert same(got, want)


def test_lossless_decomposition(spark):
    good = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, l string, r string")
    bad = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "k int, l string, r string")
    assert A.decomposition_check(good, "k", "l", "r").first()["lossless"]
    r = A.decomposition_check(bad, "k", "l", "r").first()
    assert not r["lossless"] and r["spurious"] == 2


def test_mean_of_means_golden(spark):
    df = spark.createDataFrame([("a", 100000)] + [("b", 50000)] * 9, "g string, v int")
    g = df.groupBy("g").agg(F.sum("v").alias("s"), F.count("v").alias("n"))
    r = g.agg((F.sum("s") / F.sum("n")).alias("right"), F.avg(F.col("s") / F.col("n")).alias("wrong")).first()
    assert (r["right"], r["wrong"]) == (55000.0, 75000.0)


def test_deep_hierarchy_and_cycle(spark):
    deep = spark.createDataFrame([(i, i - 1 if i else None) for i in range(130)], "id int, parent int")
    got = G.hierarchy(deep, "id", "parent", "id").agg(F.count(F.lit(1)).alias("n"), F.max("level").alias("deepest")).first()
    assert (got["n"], got["deepest"]) == (130, 130)
    # a node with two parents, one of them below it
    loop = spark.createDataFrame([(1, None), (2, 1), (2, 3), (3, 2)], "id int, parent int")
    with pytest.raises(ValueError, match="cycle"):
        G.hierarchy(loop, "id", "parent", "id")


def test_totals_beyond_bigint(spark):
    from sparkweave.functions import money as M

    big = spark.createDataFrame([(9.0e15, 1), (9.0e15, 1), (-1.25, 1), (-0.5, 2), (None, 2)], "v double, k int").crossJoin(spark.range(20))
    got = {r["k"]: (r["t"], r["m"]) for r in big.groupBy("k").agg(M.total("v", 3).alias("t"), M.mean("v", 3).alias("m")).collect()}
    assert got[1][0] == pytest.approx(3.6e17, rel=1e-15) and got[2] == (-10.0, -0.5)


def test_cyclic_core_is_linear(spark):
    """Branching 3 and depth 30: far more paths than could be kept, one cycle at the end, one edge to itself, one way between."""
    edges = [(100 * level + i, 100 * (level + 1) + (i * 2 + k) % 7) for level in range(30) for i in range(7) for k in range(3)]
    edges += [(3000 + i, 3000 + (i + 1) % 7) for i in range(7)] + [(5000, 5000), (5000, 6000), (6000, 6001), (6001, 3000), (7000, 5000), (None, 1), (1, None)]
    edges += edges[:40]
    got = {r["node"]: r["component"] for r in G.cyclic_core(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == {**{3000 + i: 3000 for i in range(7)}, 5000: 3000, 6000: 3000, 6001: 3000}
    assert G.cyclic_core(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0
    assert G.cyclic_core(spark.createDataFrame([(1, 2), (2, 3)], "src bigint, dst bigint")).count() == 0
