"""Streams: batch twins, late records, restarts, replays."""

import datetime as dt

from pyspark.sql import functions as F

from sparkweave.plans.common import n_rows
from sparkweave.session import new_folder
from sparkweave.streaming import runs as G
from sparkweave.streaming import state as Z
from sparkweave.streaming import windows as W

SCHEMA = "ts timestamp, user string, amount double"


def at(hhmmss):
    return dt.datetime.fromisoformat(f"2024-01-01 {hhmmss}")


def rows(spark, *data):
    return spark.createDataFrame([(at(t), u, float(a)) for t, u, a in data], SCHEMA)


def test_hopping_alert_spans_the_boundary(spark):
    steps = [rows(spark, ("12:04:59", "u", 1000), ("12:05:01", "u", 1000), ("12:05:02", "v", 10)), rows(spark, ("15:00:00", "z", 1))]

    def build(s):
        return W.windowed(s, "ts", ["user"], [F.sum("amount").alias("total")], "10 minutes", "2 minutes", "10 minutes").filter("total > 1500")

    out = G.run_steps(spark, steps, build, "fraud").collect()
    assert {r["user"] for r in out} == {"u"} and all(r["total"] == 2000 for r in out) and len(out) == 5


def test_late_record_within_and_beyond_the_watermark(spark):
    steps = [
        rows(spark, ("02:50:00", "a", 1), ("03:05:00", "a", 1)),  # watermark 02:55
        rows(spark, ("02:59:00", "late_kept", 1), ("03:15:00", "a", 1)),  # watermark 03:05
        rows(spark, ("02:59:30", "late_dropped", 1), ("05:00:00", "a", 1)),
    ]

    def build(s):
        return W.windowed(s, "ts", ["user"], [n_rows().alias("n")], "5 minutes", delay="10 minutes")

    users = {r["user"] for r in G.run_steps(spark, steps, build, "late").collect()}
    assert "late_kept" in users and "late_dropped" not in users


def test_sessions_close_after_the_gap(spark):
    steps = [rows(spark, ("01:00:00", "u", 1), ("01:20:00", "u", 2), ("02:30:00", "u", 4)), rows(spark, ("09:00:00", "z", 1))]
    out = G.run_steps(spark, steps, lambda s: W.sessions(s, "ts", ["user"], [F.sum("amount").alias("a")], "30 minutes", "10 minutes"), "sessions")
    assert sorted(r["a"] for r in out.filter("user = 'u'").collect()) == [3.0, 4.0]


def test_restart_goes_on_from_the_checkpoint(spark):
    fed = G.FedStream(spark, rows(spark, ("01:00:00", "u", 1)).schema, "restart")
    out = new_folder(spark, "restart_out")
    fed.add(rows(spark, ("01:00:00", "u", 1)))
    assert G.to_table(fed.stream, "restart", out).count() == 1
    assert G.to_table(fed.stream, "restart", out).count() == 1
    fed.add(rows(spark, ("01:01:00", "u", 2)))
    assert G.to_table(fed.stream, "restart", out).count() == 2
    assert G.to_table(fed.stream, "replay").count() == 2  # a new checkpoint starts over


def test_repeated_batch_replaces_itself(spark):
    folder = new_folder(spark, "batches")
    write = G.batch_writer(folder)
    df = rows(spark, ("01:00:00", "u", 1))
    write(df, 0)
    write(df, 0)
    assert G.read_batches(spark, folder, df.schema).count() == 1


def test_latest_value_over_several_runs(spark):
    schema = "k bigint, seq bigint, v string"
    steps = [spark.createDataFrame([(1, 1, "a"), (2, 1, "x")], schema), spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 2, None)], schema)]
    with G.rocksdb_state(spark):
        log = G.run_steps(spark, steps, lambda s: Z.latest_values(s, "k", "seq", "v"), "latest", "update")
    last = {r["k"]: r["v"] for r in log.groupBy("k").agg(F.max_by("v", "seq").alias("v")).collect()}
    assert last == {1: "c", 2: None}


def test_idle_timer_reports_each_burst(spark):
    schema = "k bigint, ts timestamp"
    first = spark.createDataFrame([(1, at("01:00:00")), (1, at("01:00:30")), (2, at("01:00:00"))], schema)
    second = spark.createDataFrame([(1, at("03:00:00")), (3, at("06:00:00"))], schema)
    with G.rocksdb_state(spark):
        out = G.run_steps(spark, [first, second], lambda s: Z.idle_counts(s, "k", "ts", 600, "0 seconds"), "idle")
    assert {r["n"] for r in out.filter("k = 2").collect()} == {1}
    assert sum(r["n"] for r in out.filter("k = 1").collect()) == 3


def test_stream_join_within_the_span(spark):
    left = spark.createDataFrame([("u", at("01:00:00"), 1), ("u", at("02:00:00"), 2)], "user string, a_ts timestamp, a int")
    right = spark.createDataFrame([("u", at("01:10:00"), 1), ("u", at("02:31:00"), 2), ("v", at("01:10:00"), 3)], "user string, b_ts timestamp, b int")
    f1, f2 = G.FedStream(spark, left.schema, "left"), G.FedStream(spark, right.schema, "right")
    f1.add(left)
    f2.add(right)
    out = G.to_table(W.pairs_within(f1.stream, f2.stream, "user", "a_ts", "b_ts", 1800, "1 hour").select("a", "b"), "pairs")
    assert [tuple(r) for r in out.collect()] == [(1, 1)]


def test_state_of_a_stream_join_is_kept_by_time(spark):
    """One key in all rows: every pair within the span comes once, and the state is dealt by key and bucket, not by key."""
    import random

    rng = random.Random(4)
    seconds = lambda x: at("00:00:00") + dt.timedelta(seconds=x)
    left = [(rng.randrange(40_000), i) for i in range(150)] + [(900, 1000), (1800, 1001)]
    right = [(rng.randrange(40_000), i) for i in range(150)] + [(900, 1000), (2700, 1001), (2701, 1002)]
    frames = [spark.createDataFrame([("u", seconds(x), i) for x, i in rows_], f"user string, {n}_ts timestamp, {n} int") for rows_, n in ((left, "a"), (right, "b"))]
    feeds = [G.FedStream(spark, f.schema, "hot") for f in frames]
    for feed, f in zip(feeds, frames):
        feed.add(f)
    joined = W.pairs_within(feeds[0].stream, feeds[1].stream, "user", "a_ts", "b_ts", 900, "1 hour")
    got = sorted(tuple(r) for r in G.to_table(joined.select("a", "b"), "hot").collect())
    assert got == sorted((i, j) for x, i in left for y, j in right if x <= y <= x + 900)
    buckets = W.pairs_within(frames[0], frames[1], "user", "a_ts", "b_ts", 900, "1 hour").select("a._bucket", "a").distinct().groupBy("_bucket").count()
    assert buckets.count() > 30 and buckets.agg(F.max("count")).first()[0] < 20


def test_sessions_of_a_busy_key_are_merged_where_they_are_read(spark):
    minutes = [0, 10, 25, 50, 95, 100, 101, 160, 200] + [300 + i for i in range(200)]
    data = spark.createDataFrame([(at("00:00:00") + dt.timedelta(minutes=m), "u", 1.0) for m in minutes] + [(at("20:00:00"), "z", 0.0)], SCHEMA)

    def run(label):
        fed = G.FedStream(spark, data.schema, label)
        fed.add(data.repartition(6))
        out = W.sessions(fed.stream, "ts", ["user"], [F.sum("amount").alias("a")], "30 minutes", "10 minutes")
        query = out.writeStream.trigger(availableNow=True).format("memory").queryName(label).option("checkpointLocation", f"{fed.folder}/c").start()
        query.awaitTermination()
        return query._jsq.explainInternal(False), sorted(tuple(r) for r in spark.table(label).collect())

    plain_plan, plain = run("plain_sessions")
    with G.sessions_merged_early(spark):
        plan, early = run("early_sessions")
    assert early == plain and [r[-1] for r in early] == [4.0, 3.0, 1.0, 1.0, 200.0]
    before_exchange = lambda text: text[text.rindex("Exchange hashpartitioning"):]
    assert "MergingSessions" in before_exchange(plan) and "MergingSessions" not in before_exchange(plain_plan)
    key = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    assert spark.conf.get(key) == "false"
