"""Streams (T01-T30 and the streaming sources S17, S19, S21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkweave.functions import money as M
from sparkweave.operators import limits as R
from sparkweave.operators import maintenance as K
from sparkweave.operators.aggregates import top_n_per_group
from sparkweave.operators.ordered import running_totals
from sparkweave.plans.common import day, n_rows, sql_total, sql_units, tagged
from sparkweave.plans.registry import query
from sparkweave.session import new_folder
from sparkweave.streaming import runs as G
from sparkweave.streaming import state as Z
from sparkweave.streaming import windows as W

NTZ = "timestamp_ntz"


def events(t, **options):
    """The events table as a stream, with ``ts`` as an event-time column."""
    return timed(G.table_stream(t, "events", **options))


def timed(df):
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def plain(df, *cols):
    return df.withColumns({c: F.col(c).cast(NTZ) for c in cols})


# the watermark of a finished run: newest event time, whole milliseconds, less the delay
def sql_mark(delay):
    return f"(SELECT date_trunc('millisecond', max(ts)) - INTERVAL {delay} FROM events)"


def sql_window(seconds, c="ts"):
    return f"make_timestamp((epoch_us({c}) // {seconds * 1000000}) * {seconds * 1000000})"


@query("S17_file_stream", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    back = G.to_table(events(t).select("event_id", "event_type"), "file_stream")
    return back.groupBy("event_type").agg(n_rows().alias("n"))


@query("S19_stream_sinks", "SELECT event_type, count(*) AS n, 'table' AS form FROM events GROUP BY 1 UNION ALL SELECT event_type, count(*), 'foreach_batch' FROM events GROUP BY 1")
def _(t):
    e = events(t).select("event_id", "event_type")
    counts = lambda df: df.groupBy("event_type").agg(n_rows().alias("n"))
    return tagged(table=counts(G.to_table(e, "sink_table")), foreach_batch=counts(G.to_batches(e, "sink_batches", "append")))


@query("S21_buffered_delivery", "SELECT count(*) AS n, 4::BIGINT AS batches FROM events")
def _(t):
    # each delivery is one run on the same checkpoint, and so one batch, whatever the number of its files
    fed = G.FedStream(t.spark, t.events.schema, "buffered")
    for i in range(4):
        fed.add(t.events.filter(F.pmod(F.col("event_id"), F.lit(4)) == i))
        rows = G.to_batches(fed.stream, "buffered", "append", f"{fed.folder}/out")
    return rows.groupBy("batch_id").agg(n_rows().alias("n")).filter("n > 0").agg(F.sum("n").alias("n"), n_rows().alias("batches"))


def sum_u():
    return [F.sum(M.units("value")).alias("u"), n_rows().alias("n")]


def finished(df):
    return plain(df, "start", "end").withColumn("total", F.col("u") / 100.0).drop("u")


@query("T01_tumbling_window", f"""
SELECT s AS start, s + INTERVAL 5 MINUTE AS "end", user_id, n, u / 1e2 AS total FROM (SELECT {sql_window(300)} AS s, user_id, count(*) AS n, CAST(sum({sql_units('value')}) AS BIGINT) AS u FROM events GROUP BY 1, 2)
WHERE s + INTERVAL 5 MINUTE <= {sql_mark('10 MINUTE')}""")
def _(t):
    return finished(G.to_table(W.windowed(events(t), "ts", ["user_id"], sum_u(), "5 minutes", delay="10 minutes"), "tumbling"))


SQL_HOP = f"""SELECT s AS start, s + INTERVAL 10 MINUTE AS "end", user_id, n, u / 1e2 AS total FROM (SELECT {sql_window(120)} - to_minutes(2 * k) AS s, user_id, count(*) AS n, CAST(sum({sql_units('value')}) AS BIGINT) AS u
 FROM events, range(5) r(k) GROUP BY 1, 2) WHERE s + INTERVAL 10 MINUTE <= {sql_mark('10 MINUTE')}"""


@query("T02_hopping_window", SQL_HOP)
def _(t):
    return finished(G.to_table(W.windowed(events(t), "ts", ["user_id"], sum_u(), "10 minutes", "2 minutes", "10 minutes"), "hopping"))


@query("T03_session_window", f"""
WITH a AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS opens FROM events),
b AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM a), s AS (SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS "end", count(*) AS n, CAST(sum({sql_units('value')}) AS BIGINT) / 1e2 AS total FROM b GROUP BY user_id, g)
SELECT start, "end", user_id, n, total FROM s WHERE "end" <= {sql_mark('10 MINUTE')}""")
def _(t):
    with G.sessions_merged_early(t.spark):
        return finished(G.to_table(W.sessions(events(t), "ts", ["user_id"], sum_u(), "2 hours", "10 minutes"), "sessions"))


@query("T04_threshold_alert", f"SELECT start, \"end\", user_id, total FROM ({SQL_HOP}) WHERE total > 150")
def _(t):
    hops = W.windowed(events(t), "ts", ["user_id"], sum_u(), "10 minutes", "2 minutes", "10 minutes").filter("u > 15000")
    return finished(G.to_table(hops, "alerts")).select("start", "end", "user_id", "total")


@query("T05_late_records", f"""
WITH x AS (SELECT *, ts < TIMESTAMP '2024-01-15' AND event_id % 20 = 0 AS late FROM events), m AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 6 HOUR AS w FROM x WHERE ts < TIMESTAMP '2024-01-15' AND NOT late),
k AS (SELECT {sql_window(3600)} AS s FROM x, m WHERE NOT late OR {sql_window(3600)} + INTERVAL 1 HOUR > w)
SELECT s AS start, count(*) AS n FROM k GROUP BY 1 HAVING s + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 6 HOUR FROM events WHERE NOT (ts < TIMESTAMP '2024-01-15' AND event_id % 20 = 0))""")
def _(t):
    cut = F.lit("2024-01-15").cast(NTZ)
    late = (F.col("ts") < cut) & (F.col("event_id") % 20 == 0)
    first = timed(t.events.filter((F.col("ts") < cut) & ~late))
    rest = timed(t.events.filter((F.col("ts") >= cut) | late))
    build = lambda s: W.windowed(s, "ts", [], [n_rows().alias("n")], "1 hour", delay="6 hours")
    return plain(G.run_steps(t.spark, [first, rest], build, "late"), "start", "end").select("start", "n")


@query("T06_event_and_processing_time", f"""
SELECT {sql_window(3600)} AS h, 'event_time' AS form, count(*) AS n FROM events GROUP BY 1 UNION ALL
SELECT {sql_window(3600, "ts + to_minutes(CAST(event_id % 90 AS BIGINT))")}, 'processing_time', count(*) FROM events GROUP BY 1""")
def _(t):
    e = timed(t.events)
    arrived = e.withColumn("ts", F.expr("ts + make_dt_interval(0, 0, CAST(event_id % 90 AS INT))"))
    hours = lambda df: plain(W.windowed(df, "ts", [], [n_rows().alias("n")], "1 hour"), "start").select(F.col("start").alias("h"), "n")
    return tagged(event_time=hours(e), processing_time=hours(arrived))


SQL_DAYS = "SELECT date_trunc('day', ts)::TIMESTAMP AS start, count(*) AS n FROM events GROUP BY 1"


@query("T07_output_modes", f"""
SELECT *, 'update' AS form FROM ({SQL_DAYS}) UNION ALL SELECT *, 'complete' FROM ({SQL_DAYS}) UNION ALL
SELECT *, 'append' FROM ({SQL_DAYS}) WHERE start + INTERVAL 1 DAY <= {sql_mark('10 MINUTE')}""")
def _(t):
    def run(mode):
        days = W.windowed(events(t), "ts", [], [n_rows().alias("n")], "1 day", delay="10 minutes")
        rows = G.to_batches(days, f"mode_{mode}", mode)
        return plain(rows.groupBy("start").agg(F.max_by("n", "batch_id").alias("n")), "start")

    return tagged(**{m: run(m) for m in ("update", "complete", "append")})


@query("T08_stateless_transform", "SELECT event_id, upper(event_type) AS kind, value * 2 AS doubled FROM events WHERE value > 20")
def _(t):
    s = events(t).filter("value > 20").select("event_id", F.upper("event_type").alias("kind"), (F.col("value") * 2).alias("doubled"))
    return G.to_table(s, "stateless")


@query("T09_changelog_table", """
SELECT user_id, event_id, props FROM (SELECT user_id, max(event_id) AS event_id, arg_max(CASE WHEN event_type = 'error' THEN '' ELSE props END, event_id) AS props FROM events GROUP BY 1) WHERE props <> ''""")
def _(t):
    s = events(t).select("user_id", "event_id", F.when(F.col("event_type") != "error", F.col("props")).alias("props"))
    with G.rocksdb_state(t.spark):
        log = G.to_batches(Z.latest_values(s, "user_id", "event_id", "props"), "changelog", "update")
    return K.apply_changes(log.drop("batch_id"), "user_id", "event_id", F.col("props").isNull())


@query("T10_continuous_aggregate", f"SELECT event_type, count(*) AS n, {sql_total('value')} AS total FROM events GROUP BY 1")
def _(t):
    agg = events(t).groupBy("event_type").agg(n_rows().alias("n"), M.total("value").alias("total"))
    rows = G.to_batches(agg, "continuous", "update")
    return rows.groupBy("event_type").agg(F.max_by("n", "batch_id").alias("n"), F.max_by("total", "batch_id").alias("total"))


@query("T11_push_and_pull", "SELECT user_id, count(*) AS n, 'pull' AS form FROM events WHERE user_id = 7 GROUP BY 1 UNION ALL SELECT user_id, count(*), 'push' FROM events GROUP BY 1")
def _(t):
    steps = [timed(t.events.filter("ts < '2024-01-15'")), timed(t.events.filter("ts >= '2024-01-15'"))]
    log = G.run_steps(t.spark, steps, lambda s: s.groupBy("user_id").agg(n_rows().alias("n")), "push", "update")
    table = log.groupBy("user_id").agg(F.max_by("n", "batch_id").alias("n"))
    return tagged(push=table, pull=table.filter("user_id = 7"))


@query("T12_stream_table_join", "SELECT event_id, c_name, c_mktsegment FROM events JOIN customer ON c_custkey = user_id")
def _(t):
    joined = events(t).join(t.customer, F.col("user_id") == F.col("c_custkey")).select("event_id", "c_name", "c_mktsegment")
    return G.to_table(joined, "enriched")


@query("T13_stream_stream_join", """
SELECT a.event_id AS click, b.event_id AS purchase FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 30 MINUTE WHERE a.event_type = 'click' AND b.event_type = 'purchase'""")
def _(t):
    clicks = events(t).filter("event_type = 'click'").select(F.col("event_id").alias("click"), "user_id", F.col("ts").alias("click_ts"))
    buys = events(t).filter("event_type = 'purchase'").select(F.col("event_id").alias("purchase"), "user_id", F.col("ts").alias("buy_ts"))
    joined = W.pairs_within(clicks, buys, "user_id", "click_ts", "buy_ts", 30 * 60, "1 hour")
    return G.to_table(joined.select("click", "purchase"), "stream_join")


def instants(t):
    """Events with their time in microseconds."""
    return t.events.select("event_id", "user_id", "event_type", "value", "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))


MINUTE = 60_000_000


@query("T14_sliding_pairs", """
SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND INTERVAL 30 MINUTE FOLLOWING) AS near FROM events""")
def _(t):
    return R.count_within(instants(t), ["user_id"], "at", 30 * MINUTE, 30 * MINUTE, MINUTE, "near").select("event_id", "near")


@query("T15_timer_processor", f"""
WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 400 DAY THEN 0 ELSE 1 END AS opens FROM events)
SELECT user_id, count(*) AS n, max(epoch_us(ts) // 1000) AS last_ms FROM a GROUP BY 1 HAVING max(epoch_us(ts) // 1000) + 86400000 < (SELECT max(epoch_us(ts) // 1000) FROM events)""")
def _(t):
    with G.rocksdb_state(t.spark):
        return G.to_table(Z.idle_counts(events(t).select("user_id", "ts"), "user_id", "ts", 86400, "0 seconds"), "timers")


@query("T16_exactly_once", "SELECT (SELECT count(*) FROM events) AS first_run, (SELECT count(*) FROM events) AS after_rerun, 0::BIGINT AS duplicates")
def _(t):
    folder = new_folder(t.spark, "exactly_once")
    s = events(t).select("event_id", "value")
    first = G.to_batches(s, "once", "append", folder).count()
    again = G.to_batches(s, "once", "append", folder)
    return again.groupBy("event_id").agg(n_rows().alias("n")).agg(
        F.lit(first).alias("first_run"), F.sum("n").alias("after_rerun"), F.count_if(F.col("n") > 1).alias("duplicates")
    )


@query("T17_idempotent_consumer", "SELECT event_id, user_id FROM events")
def _(t):
    # every third message is delivered twice
    first, again = timed(t.events), timed(t.events.filter("event_id % 3 = 0"))
    build = lambda s: s.withWatermark("ts", "60 days").dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "user_id")
    return G.run_steps(t.spark, [first.unionByName(again), again], build, "idempotent")


@query("T18_time_bounded_dedup", """
WITH RECURSIVE e AS (SELECT event_id, sha256(concat_ws('|', user_id, event_type)) AS content, epoch_us(ts) AS at_us,
  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events),
r AS (SELECT content, event_id, rn, at_us AS kept_at, true AS kept FROM e WHERE rn = 1 UNION ALL
 SELECT e.content, e.event_id, e.rn, CASE WHEN at_us - kept_at >= 18000000000 THEN at_us ELSE kept_at END, at_us - kept_at >= 18000000000
 FROM r JOIN e ON e.content = r.content AND e.rn = r.rn + 1)
SELECT content, event_id FROM r WHERE kept""")
def _(t):
    e = instants(t).withColumn("content", F.sha2(F.concat_ws("|", "user_id", "event_type"), 256)).withColumn("minute", F.floor(F.col("at") / MINUTE))
    return R.first_in_span(e, "content", "at", "event_id", 300 * 60 * 1_000_000, "minute")


@query("T19_dead_letters", """
SELECT event_id % 9 = 0 AS bad, count(*) AS n, min(event_id) AS first_offset, CASE WHEN event_id % 9 = 0 THEN 'unreadable payload' END AS error FROM events GROUP BY 1, 4""")
def _(t):
    body = F.when(F.col("event_id") % 9 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct("event_type", "value")))
    msgs = events(t).select(F.col("event_id").alias("offset"), body.alias("payload"))
    folder = new_folder(t.spark, "dead_letters")

    def route(df, batch_id):
        schema = "event_type string, value double, _corrupt_record string"
        parsed = df.withColumn("r", F.from_json("payload", schema, {"columnNameOfCorruptRecord": "_corrupt_record"}))
        broken = F.col("r._corrupt_record").isNotNull()
        out = parsed.select(
            "offset", "payload", "r.event_type", "r.value", broken.alias("bad"), F.when(broken, "unreadable payload").alias("error")
        )
        out.write.mode("overwrite").partitionBy("bad").parquet(f"{folder}/rows/batch_id={batch_id}")

    G.finish(msgs.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(route).start())
    schema = "offset bigint, payload string, event_type string, value double, error string, batch_id bigint, bad boolean"
    rows = t.spark.read.schema(schema).parquet(f"{folder}/rows")
    return rows.groupBy("bad", "error").agg(n_rows().alias("n"), F.min("offset").alias("first_offset"))


# fixed values: retry tiers by attempt, delay in minutes
TIERS = [(1, "retry-1m", 1), (2, "retry-5m", 5), (3, "retry-15m", 15)]


@query("T20_retry_tiers", """
WITH a AS (SELECT event_id, ts, event_id % 5 AS attempts FROM events WHERE event_type = 'error')
SELECT event_id, CASE attempts WHEN 0 THEN 'retry-1m' WHEN 1 THEN 'retry-5m' WHEN 2 THEN 'retry-15m' ELSE 'dead-letter' END AS next_topic,
 CASE attempts WHEN 0 THEN ts + INTERVAL 1 MINUTE WHEN 1 THEN ts + INTERVAL 5 MINUTE WHEN 2 THEN ts + INTERVAL 15 MINUTE END AS due FROM a""")
def _(t):
    attempt = F.col("event_id") % 5 + 1
    topic, due = F.lit("dead-letter"), F.lit(None).cast(NTZ)
    for n, name, minutes in reversed(TIERS):
        topic = F.when(attempt == n, name).otherwise(topic)
        due = F.when(attempt == n, F.col("ts") + F.expr(f"INTERVAL '{minutes}' MINUTE")).otherwise(due)
    return t.events.filter("event_type = 'error'").select("event_id", topic.alias("next_topic"), due.alias("due"))


@query("T21_fan_out", "SELECT 'all' AS sink, count(*) AS n FROM events UNION ALL SELECT 'errors', count(*) FROM events WHERE event_type = 'error' UNION ALL SELECT 'large', count(*) FROM events WHERE value > 100")
def _(t):
    folder = new_folder(t.spark, "fan_out")
    sinks = {"all": F.lit(True), "errors": F.col("event_type") == "error", "large": F.col("value") > 100}
    e = events(t).select("event_id", "event_type", "value")

    def write(df, batch_id):
        df.persist()
        for name, rule in sinks.items():
            df.filter(rule).write.mode("overwrite").parquet(f"{folder}/{name}/batch_id={batch_id}")
        df.unpersist()

    G.finish(e.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(write).start())
    counts = {name: t.spark.read.schema(e.schema).parquet(f"{folder}/{name}").agg(n_rows().alias("n")) for name in sinks}
    return tagged(**counts).withColumnRenamed("form", "sink")


@query("T22_replay", "SELECT user_id, count(*) AS n, 0::BIGINT AS differs FROM events GROUP BY 1")
def _(t):
    replayed = G.to_table(events(t).select("user_id", "event_id"), "replay").groupBy("user_id").agg(n_rows().alias("n"))
    batch = t.events.groupBy("user_id").agg(n_rows().alias("m"))
    return replayed.join(batch, "user_id", "full").select("user_id", "n", F.when(F.col("n") == F.col("m"), 0).otherwise(1).cast("bigint").alias("differs"))


@query("T23_batch_and_speed_layers", f"SELECT event_type, count(*) AS n, {sql_total('value')} AS total FROM events GROUP BY 1")
def _(t):
    def view(df):
        return df.groupBy("event_type").agg(n_rows().alias("n"), F.sum(M.units("value")).alias("u"))

    cut = "2024-01-20"
    batch = view(t.events.filter(f"ts < '{cut}'"))
    speed = view(G.to_table(events(t).filter(f"ts >= '{cut}'").select("event_type", "value"), "speed"))
    return batch.unionByName(speed).groupBy("event_type").agg(F.sum("n").alias("n"), (F.sum("u") / 100.0).alias("total"))


@query("T24_consumer_lag", """
WITH p AS (SELECT user_id % 8 AS partition, max(event_id) AS latest, max(CASE WHEN ts < TIMESTAMP '2024-01-25' THEN event_id END) AS committed FROM events GROUP BY 1)
SELECT partition, latest, committed, latest - committed AS lag, latest - committed > 1500 AS alert FROM p""")
def _(t):
    e = t.events.withColumn("partition", F.col("user_id") % 8)
    latest = e.groupBy("partition").agg(F.max("event_id").alias("latest"))
    committed = e.filter("ts < '2024-01-25'").groupBy("partition").agg(F.max("event_id").alias("committed"))
    lag = F.col("latest") - F.col("committed")
    return latest.join(committed, "partition", "left").select("*", lag.alias("lag"), (lag > 1500).alias("alert"))


@query("T25_ordered_per_key", """
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS sequence FROM events""")
def _(t):
    msgs = G.to_table(events(t).select("user_id", "event_id"), "ordered").withColumn("bin", F.floor(F.col("event_id") / 1000))
    out = running_totals(msgs, ["user_id"], [F.col("event_id")], "bin", {"sequence": F.lit(1).cast("bigint")})
    return out.select("user_id", "event_id", "sequence")


@query("T26_fixed_window_limit", """
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) <= 2 AS allowed FROM events""")
def _(t):
    e = t.events.withColumn("h", F.date_trunc("hour", F.col("ts")).cast(NTZ))
    allowed = top_n_per_group(e, ["user_id", "h"], [F.col("ts"), F.col("event_id")], 2).select("event_id", F.lit(True).alias("allowed"))
    return e.join(allowed, "event_id", "left").select("user_id", "event_id", F.coalesce("allowed", F.lit(False)).alias("allowed"))


@query("T27_sliding_log_limit", """
SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS recent,
 count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) <= 2 AS allowed FROM events""")
def _(t):
    out = R.count_within(instants(t), ["user_id"], "at", 60 * MINUTE, 0, MINUTE, "recent")
    return out.select("event_id", "recent", (F.col("recent") <= 2).alias("allowed"))


@query("T28_weighted_window_limit", """
WITH r AS (SELECT event_id, user_id, epoch_us(ts) // 3600000000 AS b, epoch_us(ts) % 3600000000 AS into_b, row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 3600000000 ORDER BY ts, event_id) AS cur FROM events),
c AS (SELECT user_id, b, count(*) AS n FROM r GROUP BY 1, 2)
SELECT event_id, cur + coalesce(n, 0) * (1 - into_b / 3600000000) AS estimate FROM r LEFT JOIN c ON c.user_id = r.user_id AND c.b = r.b - 1""")
def _(t):
    size = 60 * MINUTE
    e = instants(t).withColumns({"b": F.floor(F.col("at") / size), "minute": F.floor(F.col("at") / MINUTE)})
    cur = running_totals(e, ["user_id", "b"], [F.col("at"), F.col("event_id")], "minute", {"cur": F.lit(1).cast("bigint")})
    before = e.groupBy("user_id", (F.col("b") + 1).alias("b")).agg(n_rows().alias("prev"))
    share = 1 - (F.col("at") % size) / size
    return cur.join(before, ["user_id", "b"], "left").select(
        "event_id", (F.col("cur") + F.coalesce("prev", F.lit(0)) * share).alias("estimate")
    )


def sql_token_bucket(capacity, refill):
    """One request after the other, without cutting into runs; the bucket holds units of time."""
    return f"""RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS at_us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
s AS (SELECT user_id, event_id, rn, at_us, true AS allowed, {(capacity - 1) * refill}::BIGINT AS held FROM e WHERE rn = 1 UNION ALL
 SELECT user_id, event_id, rn, at_us, filled >= {refill}, filled - CASE WHEN filled >= {refill} THEN {refill} ELSE 0 END FROM (
  SELECT e.user_id, e.event_id, e.rn, e.at_us, least({capacity * refill}::BIGINT, s.held + e.at_us - s.at_us) AS filled
  FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1))"""


@query("T29_token_bucket", f"WITH {sql_token_bucket(3, 60 * MINUTE)} SELECT user_id, event_id, allowed, round(held / {60 * MINUTE}, 9) AS tokens FROM s")
def _(t):
    e = instants(t).withColumn("minute", F.floor(F.col("at") / MINUTE))
    out = R.token_bucket(e, "user_id", "at", "event_id", capacity=3, refill=60 * MINUTE, bin_col="minute")
    return out.withColumn("tokens", F.round("tokens", 9))


@query("T30_pending_messages", """
WITH d AS (SELECT event_id, user_id, ts, 1 + event_id % 3 AS attempts, event_type = 'view' AS acked FROM events)
SELECT event_id, user_id, attempts, date_diff('second', date_trunc('second', ts), TIMESTAMP '2024-01-31') AS idle FROM d WHERE NOT acked AND date_diff('second', date_trunc('second', ts), TIMESTAMP '2024-01-31') > 86400""")
def _(t):
    delivered = t.events.select("event_id", "user_id", F.date_trunc("second", "ts").cast("timestamp").alias("at"), (1 + F.col("event_id") % 3).alias("attempts"))
    acks = t.events.filter("event_type = 'view'").select("event_id")
    idle = F.lit("2024-01-31").cast("timestamp").cast("bigint") - F.col("at").cast("bigint")
    return delivered.join(acks, "event_id", "left_anti").select("event_id", "user_id", "attempts", idle.alias("idle")).filter("idle > 86400")
