"""Two-level ordered work against plain Python, with hot keys, ties and nulls."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sparkweave.operators import joins as J
from sparkweave.operators import limits as R
from sparkweave.operators import ordered as O


def hot_rows(n=600):
    """Two thirds of the rows share one key; times repeat."""
    rng = np.random.default_rng(3)
    return [(int(k), int(t), i, int(v)) for i, (k, t, v) in enumerate(zip(
        np.where(rng.random(n) < 0.67, 0, rng.integers(1, 20, n)), rng.integers(0, 90, n), rng.integers(1, 50, n)))]


SCHEMA = "k int, t int, id int, v int"


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(hot_rows(), SCHEMA).withColumn("bin", F.floor(F.col("t") / 7))


def by_key():
    out = {}
    for k, t, i, v in sorted(hot_rows(), key=lambda r: (r[0], r[1], r[2])):
        out.setdefault(k, []).append((t, i, v))
    return out


def test_running_totals(hot):
    got = {r["id"]: (r["s"], r["s_all"]) for r in O.running_totals(hot, ["k"], [F.col("t"), F.col("id")], "bin", {"s": F.col("v")}).collect()}
    for rows in by_key().values():
        total, whole = 0, sum(v for _, _, v in rows)
        for t, i, v in rows:
            total += v
            assert got[i] == (total, whole)


def test_running_totals_with_ties(hot):
    run = O.running_totals(hot, ["k"], [F.col("t")], "bin", {"s": F.col("v")}, ties_together=True)
    got = {r["id"]: r["s"] for r in run.collect()}
    for rows in by_key().values():
        for t, i, _ in rows:
            assert got[i] == sum(v for u, _, v in rows if u <= t)


def test_null_keys_and_null_values(spark):
    df = spark.createDataFrame([(None, 1, 1, 5), (None, 9, 2, None), (1, 1, 3, None), (1, 20, 4, 2)], SCHEMA).withColumn("bin", F.floor(F.col("t") / 7))
    order = [F.col("t"), F.col("id")]
    assert {r["id"]: r["s"] for r in O.running_totals(df, ["k"], order, "bin", {"s": F.col("v")}).collect()} == {1: 5, 2: 5, 3: 0, 4: 2}
    assert {r["id"]: r["prev_v"] for r in O.previous_of_key(df, ["k"], order, "bin", ["v"]).collect()} == {1: None, 2: 5, 3: None, 4: None}
    near = R.count_within(df, ["k"], "t", 10, 0, 4, "n")
    assert {r["id"]: r["n"] for r in near.collect()} == {1: 1, 2: 2, 3: 1, 4: 1}


def test_descending_numbers(hot):
    n = O.number_rows(hot, ["k"], [F.col("t").desc(), F.col("id").desc()], "bin", descending=True)
    got = {r["id"]: r["rn"] for r in n.collect()}
    for rows in by_key().values():
        for place, (_, i, _) in enumerate(reversed(rows), 1):
            assert got[i] == place


def test_previous_row_crosses_bins(hot):
    got = {r["id"]: r["prev_v"] for r in O.previous_of_key(hot, ["k"], [F.col("t"), F.col("id")], "bin", ["v"]).collect()}
    for rows in by_key().values():
        before = None
        for _, i, v in rows:
            assert got[i] == before
            before = v


def test_neighbours_see_across_blocks(hot):
    from pyspark.sql import Window

    n = O.number_rows(hot, ["k"], [F.col("t"), F.col("id")], "bin")
    w = Window.partitionBy("k", "_block").orderBy("rn").rowsBetween(-2, 1)
    got = {r["id"]: r["s"] for r in O.with_neighbours(n, ["k"], "rn", 5, 2, 1).withColumn("s", F.sum("v").over(w)).filter("_own").collect()}
    for rows in by_key().values():
        for p, (_, i, _) in enumerate(rows):
            assert got[i] == sum(v for _, _, v in rows[max(0, p - 2) : p + 2])
    with pytest.raises(ValueError):
        O.with_neighbours(n, ["k"], "rn", 1, 2)


def test_exact_quantiles(hot):
    got = {r["k"]: r for r in O.exact_quantiles(hot, ["k"], "v", {"m": 0.5, "p9": 0.9}, 5).collect()}
    for k, rows in by_key().items():
        vals = [v for _, _, v in rows]
        assert got[k]["m"] == pytest.approx(np.quantile(vals, 0.5))
        assert got[k]["p9"] == pytest.approx(np.quantile(vals, 0.9))
        assert got[k]["m_disc"] == sorted(vals)[max(int(np.ceil(len(vals) * 0.5)) - 1, 0)]


def test_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (1, 4.0)], "k int, v double")
    assert O.exact_quantiles(df, ["k"], "v", {"m": 0.5}, 1.0).first()["m"] == 3.0


def test_value_positions_ranks_with_ties(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (3.0,), (9.0,)], "v double")
    got = {r["v"]: (r["before"], r["dense_before"], r["ties"], r["total"]) for r in O.value_positions(df, [], "v", 2.0, descending=True).collect()}
    assert got == {9.0: (0, 0, 1, 4), 5.0: (1, 1, 2, 4), 3.0: (3, 2, 1, 4)}


def test_overlap_counts(spark):
    rng = np.random.default_rng(1)
    spans = [(int(i % 3 == 0), i, int(s), int(s + d)) for i, (s, d) in enumerate(zip(rng.integers(0, 200, 150), rng.integers(1, 40, 150)))]
    df = spark.createDataFrame(spans, "k int, id int, s int, e int")
    got = {r["id"]: r["overlaps"] for r in J.overlap_counts(df, ["k"], "s", "e", 10.0).collect()}
    for k, i, s, e in spans:
        assert got[i] == sum(1 for k2, i2, s2, e2 in spans if k2 == k and i2 != i and s2 < e and e2 > s)


def test_asof_join(spark):
    versions = spark.createDataFrame([("a", 1, "x"), ("a", 10, "y"), ("b", 5, "z")], "k string, since int, name string")
    facts = spark.createDataFrame([("a", 0, 1), ("a", 1, 2), ("a", 9, 3), ("a", 99, 4), ("b", 4, 5), ("c", 7, 6)], "k string, at int, id int")
    out = J.asof_join(facts, versions, ["k"], "at", "since", ["name"], lambda c: F.floor(c / 4))
    assert {r["id"]: r["name"] for r in out.collect()} == {1: None, 2: "x", 3: "x", 4: "y", 5: None, 6: None}


def test_not_in_follows_sql(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    some, null, none = (spark.createDataFrame(d, "b int") for d in ([(2,)], [(2,), (None,)], []))
    assert [r[0] for r in J.not_in(left, "a", some, "b").collect()] == [1]
    assert J.not_in(left, "a", null, "b").count() == 0
    assert J.not_in(left, "a", none, "b").count() == 3


def test_range_lookup_edges(spark):
    ranges = spark.createDataFrame([(0, 10, "low"), (10, 25, "high")], "lo int, hi int, name string")
    points = spark.createDataFrame([(0,), (9,), (10,), (24,), (25,)], "x int")
    got = {r["x"]: r["name"] for r in J.range_lookup(points, ranges, "x", "lo", "hi", 4.0).collect()}
    assert got == {0: "low", 9: "low", 10: "high", 24: "high", 25: None}


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_blocks_meet_once(spark, monkeypatch, limit):
    monkeypatch.setattr(J, "BLOCK_ROWS", 7)
    left = spark.createDataFrame([(i, None if i == 3 else "x") for i in range(30)] + [(0, "x")], "a int, s string")
    right = spark.range(20).withColumnRenamed("id", "b")
    every = sorted((a, b) for a in [*range(30), 0] for b in range(20))
    assert sorted((r["a"], r["b"]) for r in J.block_join(left, right, limit=limit).collect()) == every
    some = J.block_join(left, right, F.col("a") < F.col("b"), limit)
    assert sorted((r["a"], r["b"]) for r in some.collect()) == [(a, b) for a, b in every if a < b]
    assert J.block_join(left.limit(0), right, limit=limit).count() == 0 == J.block_join(left, right.limit(0), limit=limit).count()


def test_salts_from_a_sample(spark, monkeypatch):
    monkeypatch.setattr(J, "ROWS_PER_TASK", 100)
    rows = spark.range(20_000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    assert 40 <= J.measured_salts(rows, ["k"], F.col("id")) <= 100  # the hottest key has 6,667 rows


def test_salts_follow_the_hottest_key(hot, monkeypatch):
    monkeypatch.setattr(J, "ROWS_PER_TASK", 7)
    most = hot.groupBy("k").count().agg(F.max("count")).first()[0]
    assert J.measured_salts(hot, ["k"]) == -(-most // 7)
    assert J.measured_salts(hot.limit(0), ["k"]) == 1


def test_salted_join_equals_plain_join(hot, spark, monkeypatch):
    monkeypatch.setattr(J, "ROWS_PER_TASK", 7)
    small = spark.createDataFrame([(k, f"n{k}") for k in range(10)], "k int, name string")
    a = J.salted_join(hot, small, ["k"], F.col("id")).select("id", "name")
    b = hot.join(small, "k").select("id", "name")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def events(spark):
    rng = np.random.default_rng(8)
    rows = [(int(u), float(t), i) for i, (u, t) in enumerate(zip(np.where(rng.random(500) < 0.6, 0, rng.integers(1, 9, 500)), np.sort(rng.random(500) * 4000)))]
    return rows, spark.createDataFrame(rows, "u int, at double, id int").withColumn("bin", F.floor(F.col("at") / 100))


def plain_bucket(rows, capacity, refill):
    """One request after the other: ``id -> allowed, tokens``."""
    state, out = {}, {}
    for u, at, i in rows:
        held, last = state.get(u, (capacity * refill, at))
        held = min(capacity * refill, held + at - last)
        ok = held >= refill
        held -= refill if ok else 0
        state[u] = (held, at)
        out[i] = (ok, held / refill)
    return out


#: Requests of one key in a hundred units of time: from hardly any to far more than the bucket allows, and uneven.
LOADS = {"idle": (0.5, 1.0), "even": (5.0, 1.0), "busy": (40.0, 1.0), "bursts": (6.0, 6.0), "ties": (300.0, 1.0)}


@pytest.mark.parametrize("load", LOADS)
@pytest.mark.parametrize("long,turns", [(200_000, 12), (20, 12), (20, 2), (1, 400)])
def test_token_bucket(spark, monkeypatch, load, long, turns):
    """Short runs stream, long ones are worked on in bins, and both equal the plain form; also a null key."""
    monkeypatch.setattr(R, "LONG", long)
    monkeypatch.setattr(R, "TURNS", min(turns, 40))
    monkeypatch.setattr(R, "BIN", 7)
    rate, wave = LOADS[load]
    rng = np.random.default_rng(8)
    n = 160
    gaps = rng.exponential(100 / rate, n) * np.where(np.arange(n) // 25 % 2 == 0, 1, wave)
    at = np.cumsum(gaps).astype(int)
    users = [None if x > 0.9 else 0 if x > 0.2 else 1 for x in rng.random(n)]
    rows = [(u, int(t), i) for i, (u, t) in enumerate(zip(users, at))]
    df = spark.createDataFrame(rows, "u int, at bigint, id int").withColumn("bin", F.floor(F.col("at") / 100))
    got = R.token_bucket(df, "u", "at", "id", 4, 20, "bin").collect()
    assert len(got) == n and {r["id"]: (r["allowed"], r["tokens"]) for r in got} == plain_bucket(rows, 4, 20)


def busy_key(spark, n=6000):
    """A key with three fifths of the rows and never a pause."""
    rng = np.random.default_rng(18)
    rows = [(int(u), int(t), i) for i, (u, t) in enumerate(zip(np.where(rng.random(n) < 0.6, 0, rng.integers(1, 9, n)), np.sort(rng.integers(0, 3000, n))))]
    return rows, spark.createDataFrame(rows, "u int, at bigint, id int").withColumn("bin", F.floor(F.col("at") / 50))


def test_a_busy_key_is_worked_on_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(R, "LONG", 500)
    monkeypatch.setattr(R, "BIN", 200)
    rows, df = busy_key(spark)
    streamed, plain = [], R._scan_in_order
    monkeypatch.setattr(R, "_scan_in_order", lambda d, keys, *a: streamed.append(d.groupBy(*keys).count()) or plain(d, keys, *a))
    got = {r["id"]: (r["allowed"], r["tokens"]) for r in R.token_bucket(df, "u", "at", "id", 5, 20, "bin").collect()}
    assert got == plain_bucket(rows, 5, 20)
    most = [d.agg(F.max("count")).first()[0] or 0 for d in streamed]
    assert max(most) <= 500  # nothing long went through one state
    hot = df.filter("u = 0").withColumn("_run", F.lit(0)).withColumnRenamed("id", "_i")
    tasks = R.least_before(hot.withColumn("_bin", F.floor(F.col("_i") / 200)), ["u", "_run"], [F.col("_i")], "_bin", "at", "m")
    per_task = tasks.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) >= 4 and max(r["count"] for r in per_task) < 0.6 * hot.count()


def plain_spans(rows, span):
    kept, want = {}, set()
    for u, at, i in rows:
        if u not in kept or at - kept[u] >= span:
            kept[u] = at
            want.add(i)
    return want


@pytest.mark.parametrize("long", [200_000, 30, 1])
def test_first_in_span(spark, monkeypatch, long):
    monkeypatch.setattr(R, "LONG", long)
    rows, df = events(spark)
    assert {r["id"] for r in R.first_in_span(df, "u", "at", "id", 60.0, "bin").collect()} == plain_spans(rows, 60.0)


def test_first_in_span_of_a_busy_key(spark, monkeypatch):
    monkeypatch.setattr(R, "LONG", 500)
    rows, df = busy_key(spark)
    got = [r["id"] for r in R.first_in_span(df, "u", "at", "id", 35, "bin").collect()]
    assert len(got) == len(set(got)) and set(got) == plain_spans(rows, 35)


def test_count_within(spark):
    rows, df = events(spark)
    got = {r["id"]: r["n"] for r in R.count_within(df, ["u"], "at", 30.0, 10.0, 50.0, "n").collect()}
    for u, at, i in rows:
        assert got[i] == sum(1 for u2, t2, _ in rows if u2 == u and at - 30.0 <= t2 <= at + 10.0)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40), st.integers(-20, 20)), min_size=1, max_size=40))
def test_running_totals_property(spark, data):
    rows = [(k, t, i, v) for i, (k, t, v) in enumerate(data)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("bin", F.floor(F.col("t") / 5))
    got = {r["id"]: r["s"] for r in O.running_totals(df, ["k"], [F.col("t"), F.col("id")], "bin", {"s": F.col("v")}).collect()}
    for k, t, i, _ in rows:
        assert got[i] == sum(v2 for k2, t2, i2, v2 in rows if k2 == k and (t2, i2) <= (t, i))


def test_ties_are_parted_by_the_next_key(spark, monkeypatch):
    """Half of one department has one salary: its rows spread over many bins, none much larger than the others."""
    monkeypatch.setattr(O, "ROWS_PER_BIN", 100)
    rng = np.random.default_rng(4)
    rows = [(int(d), 500.0 if rng.random() < 0.5 else float(rng.integers(0, 1000)), i) for i, d in enumerate(np.where(rng.random(4000) < 0.7, 0, rng.integers(1, 4, 4000)))]
    df = spark.createDataFrame(rows, "dept int, salary double, id int")
    order = [F.col("salary").desc(), F.col("id")]
    binned = O.even_bins(df, ["dept"], order)
    tied = binned.filter("dept = 0 AND salary = 500").groupBy("_bin").count().collect()
    assert len(tied) >= 8 and max(r["count"] for r in binned.groupBy("dept", "_bin").count().collect()) <= 300
    got = {r["id"]: r["rn"] for r in O.number_rows(binned, ["dept"], order, "_bin", "rn").collect()}
    for dept in range(4):
        mine = sorted((x for x in rows if x[0] == dept), key=lambda x: (-x[1], x[2]))
        assert [got[x[2]] for x in mine] == list(range(1, len(mine) + 1))
