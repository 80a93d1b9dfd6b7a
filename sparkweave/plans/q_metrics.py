"""Metrics, logs and traces on tables."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from sparkweave.functions import money as M
from sparkweave.functions.scalars import hash_bucket, sql_hash_bucket
from sparkweave.operators import metrics as X
from sparkweave.operators.ordered import exact_quantiles, running_totals
from sparkweave.plans.common import day, n_rows, sql_mean, sql_total, sql_units, tagged
from sparkweave.plans.registry import query


def hour(c="ts"):
    return F.date_trunc("hour", F.col(c)).cast("timestamp_ntz")


SQL_COUNTER = f"""c AS (SELECT event_type, ts, event_id, CAST(sum({sql_units('value')}) OVER (PARTITION BY event_type, ts::DATE ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS v FROM events),
i AS (SELECT *, lag(v) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS p FROM c), d AS (SELECT *, CASE WHEN p IS NULL THEN NULL WHEN v >= p THEN v - p ELSE v END AS increase FROM i)"""


def increases(t):
    """Counters that restart every day, from the running value of events per type."""
    e = t.events.select("event_type", "ts", "event_id", day("ts").alias("d"), hour().alias("h"), F.date_trunc("minute", "ts").alias("minute"), M.units("value").alias("u"))
    # a type may hold a third of all events, so it is worked on minute by minute
    c = running_totals(e, ["event_type", "d"], [F.col("ts"), F.col("event_id")], "minute", {"v": F.col("u")})
    return X.counter_increases(c, ["event_type"], ["ts", "event_id"], "v", "minute")


@query("X01_counter_rate", f"""
WITH {SQL_COUNTER} SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS h, coalesce(CAST(sum(increase) AS BIGINT), 0) AS increase, coalesce(CAST(sum(increase) AS BIGINT), 0) / 3600e0 AS rate FROM d GROUP BY 1, 2""")
def _(t):
    total = F.coalesce(F.sum("increase"), F.lit(0))
    return increases(t).groupBy("event_type", "h").agg(total.alias("increase"), (total / 3600.0).alias("rate"))


@query("X02_label_aggregation", f"WITH {SQL_COUNTER} SELECT event_type, CAST(sum(increase) AS BIGINT) AS total, CAST(sum(increase) AS BIGINT) / count(increase) AS mean FROM d GROUP BY 1")
def _(t):
    return increases(t).groupBy("event_type").agg(F.sum("increase").alias("total"), (F.sum("increase") / F.count("increase")).alias("mean"))


SQL_STATUS = "SELECT *, CASE event_type WHEN 'error' THEN '5' ELSE '2' END || lpad((event_id % 5)::VARCHAR, 2, '0') AS status FROM events"


def requests(t):
    code = F.concat(F.when(F.col("event_type") == "error", "5").otherwise("2"), F.lpad((F.col("event_id") % 5).cast("string"), 2, "0"))
    return t.events.withColumn("status", code)


def error_share():
    return F.count_if(F.col("status").rlike("^5..$")) / n_rows()


@query("X03_error_ratio", f"SELECT user_id, count(*) FILTER (WHERE regexp_full_match(status, '5..')) / count(*) * 100e0 AS pct FROM ({SQL_STATUS}) GROUP BY 1")
def _(t):
    return requests(t).groupBy("user_id").agg((error_share() * 100.0).alias("pct"))


BOUNDS = [10.0, 50.0, 100.0, 250.0]


def sql_quantile(q):
    parts = []
    for i, b in enumerate(BOUNDS):
        low, below = (BOUNDS[i - 1], f"le_{i - 1}") if i else (0.0, "0")
        parts.append(f"WHEN le_{i} >= n * {q}::DOUBLE THEN {low}::DOUBLE + {b - low}::DOUBLE * (n * {q}::DOUBLE - {below}) / (le_{i} - {below})")
    return f"CASE {' '.join(parts)} ELSE {BOUNDS[-1]}::DOUBLE END"


SQL_BUCKETS = "SELECT event_type, " + ", ".join(f"count(*) FILTER (WHERE value <= {b}) AS le_{i}" for i, b in enumerate(BOUNDS)) + ", count(*) AS n FROM events GROUP BY 1"


@query("X04_histogram_quantile", f"SELECT event_type, le_0, le_3, n AS le_inf, {sql_quantile(0.5)} AS p50, {sql_quantile(0.95)} AS p95, {sql_quantile(0.999)} AS p999 FROM ({SQL_BUCKETS})")
def _(t):
    b = X.bucket_counts(t.events, ["event_type"], "value", BOUNDS)
    return b.select("event_type", "le_0", "le_3", "le_inf", *[X.histogram_quantile(q, BOUNDS).alias(n) for n, q in (("p50", 0.5), ("p95", 0.95), ("p999", 0.999))])


@query("X05_gauge_latest", "SELECT user_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("user_id").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))


@query("X06_apdex", f"SELECT event_type, (le_0 + le_1) / 2 / n AS apdex, (le_0 + le_1 / 2) / n AS as_written FROM ({SQL_BUCKETS})")
def _(t):
    b = X.bucket_counts(t.events, ["event_type"], "value", BOUNDS)
    a, c, n = F.col("le_0"), F.col("le_1"), F.col("le_inf")
    return b.select("event_type", X.apdex(a, c, n).alias("apdex"), X.apdex(a, c, n, as_written=True).alias("as_written"))


@query("X07_held_alert", f"""
WITH h AS (SELECT (epoch(ts)::BIGINT // 3600) AS step, count(*) FILTER (WHERE regexp_full_match(status, '5..')) / count(*) AS share FROM ({SQL_STATUS}) GROUP BY 1),
g AS (SELECT step, step - row_number() OVER (ORDER BY step) AS g FROM h WHERE share > 0.10)
SELECT min(step) AS "first", max(step) AS "last", count(*) AS steps FROM g GROUP BY g HAVING count(*) >= 3""")
def _(t):
    step = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600)
    points = requests(t).groupBy(step.alias("step")).agg(error_share().alias("share"))
    return X.held_alerts(points, [], "step", F.col("share") > 0.10, 3)


@query("X08_slo_report", f"""
WITH s AS (SELECT event_type IN ('view', 'click') AS browsing, (count(*) - count(*) FILTER (WHERE event_id % 97 = 0)) / count(*) * 100e0 AS success, quantile_cont(value, 0.99) AS p99 FROM events GROUP BY 1)
SELECT browsing, success, least(100, (100 - success) / (100e0 - 98.5e0) * 100) AS budget_used, p99, p99 <= 200 AS latency_ok FROM s""")
def _(t):
    e = t.events.withColumn("browsing", F.col("event_type").isin("view", "click"))
    rates = e.groupBy("browsing").agg(((n_rows() - F.count_if(F.col("event_id") % 97 == 0)) / n_rows() * 100.0).alias("success"))
    p99 = exact_quantiles(e, ["browsing"], "value", {"p99": 0.99}, 10.0).select("browsing", "p99")
    return rates.join(p99, "browsing").select(
        "browsing", "success", X.budget_used(F.col("success"), 98.5).alias("budget_used"), "p99", (F.col("p99") <= 200).alias("latency_ok")
    )


@query("X09_burn_rate", f"""
SELECT date_trunc('hour', ts)::TIMESTAMP AS h, count(*) FILTER (WHERE regexp_full_match(status, '5..')) / count(*) AS ratio FROM ({SQL_STATUS}) GROUP BY 1
HAVING count(*) FILTER (WHERE regexp_full_match(status, '5..')) / count(*) > 14.4 * 0.01""")
def _(t):
    return requests(t).groupBy(hour().alias("h")).agg(error_share().alias("ratio")).filter(F.col("ratio") > 14.4 * 0.01)


@query("X10_log_queries", """
WITH l AS (SELECT ts, json_extract_string(body, '$.level') AS level, CAST(json_extract_string(body, '$.ms') AS DOUBLE) AS ms FROM
 (SELECT ts, '{"level":"' || CASE WHEN event_type = 'error' THEN 'error' ELSE 'info' END || '","ms":' || value || '}' AS body FROM events))
SELECT ts::DATE AS d, count(*) AS lines, count(*) FILTER (WHERE level = 'error') AS errors, quantile_cont(ms, 0.95) AS p95 FROM l GROUP BY 1""")
def _(t):
    body = F.to_json(F.struct(F.when(F.col("event_type") == "error", "error").otherwise("info").alias("level"), F.col("value").alias("ms")))
    logs = t.events.select("ts", body.alias("body"))
    parsed = logs.select(day("ts").alias("d"), F.from_json("body", "level string, ms double").alias("b")).select("d", "b.*")
    counts = parsed.groupBy("d").agg(n_rows().alias("lines"), F.count_if(F.col("level") == "error").alias("errors"))
    p95 = exact_quantiles(parsed, ["d"], "ms", {"p95": 0.95}, 10.0).select("d", "p95")
    return counts.join(p95, "d")


@query("X11_red_rollup", f"""
SELECT date_trunc('day', ts)::DATE AS d, event_type, count(*) / 86400e0 AS rate, count(*) FILTER (WHERE regexp_full_match(status, '.03')) / count(*) AS errors, {sql_mean('value')} AS duration FROM ({SQL_STATUS}) GROUP BY 1, 2""")
def _(t):
    return requests(t).groupBy(day("ts").alias("d"), "event_type").agg(
        (n_rows() / 86400.0).alias("rate"), (F.count_if(F.col("status").rlike("^.03$")) / n_rows()).alias("errors"), M.mean("value").alias("duration")
    )


SQL_SPANS = "spans AS (SELECT conv_id AS trace, turn AS span, CASE WHEN turn > 0 THEN (turn - 1) // 2 END AS parent, length(text)::BIGINT AS duration FROM conversations)"


def spans(t):
    return t.conversations.select(
        F.col("conv_id").alias("trace"), F.col("turn").alias("span"), F.expr("CASE WHEN turn > 0 THEN (turn - 1) div 2 END").alias("parent"),
        F.length("text").cast("bigint").alias("duration"),
    )


@query("X12_trace_tree", f"""
WITH RECURSIVE {SQL_SPANS}, r AS (SELECT trace, span, 0 AS depth FROM spans WHERE parent IS NULL UNION ALL SELECT s.trace, s.span, depth + 1 FROM spans s JOIN r ON s.trace = r.trace AND s.parent = r.span),
c AS (SELECT trace, parent AS span, sum(duration) AS inside, arg_min(span, (-duration, span)) AS critical_child FROM spans WHERE parent IS NOT NULL GROUP BY 1, 2)
SELECT s.trace AS trace, s.span AS span, parent, duration, CAST(duration - coalesce(inside, 0) AS BIGINT) AS self_time, critical_child, depth FROM spans s LEFT JOIN c ON c.trace = s.trace AND c.span = s.span LEFT JOIN r ON r.trace = s.trace AND r.span = s.span""")
def _(t):
    return X.trace_tree(spans(t))


@query("X13_tail_sampling", f"""
WITH a AS (SELECT conv_id, bool_or(role = 'system') AS failed, CAST(sum(length(text)) AS BIGINT) AS total FROM conversations GROUP BY 1)
SELECT conv_id, CASE WHEN failed THEN 'error' WHEN total > 5000 THEN 'slow' ELSE 'share' END AS kept_by FROM a WHERE failed OR total > 5000 OR {sql_hash_bucket('conv_id', 100)} < 5""")
def _(t):
    a = t.conversations.groupBy("conv_id").agg(F.bool_or(F.col("role") == "system").alias("failed"), F.sum(F.length("text")).alias("total"))
    kept = F.when(F.col("failed"), "error").when(F.col("total") > 5000, "slow").when(hash_bucket(F.col("conv_id"), 100) < 5, "share")
    return a.select("conv_id", kept.alias("kept_by")).filter("kept_by IS NOT NULL")


@query("X14_log_trace_correlation", """
WITH l AS (SELECT user_id, count(*) AS lines, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1), s AS (SELECT conv_id, count(*) AS spans, CAST(sum(length(text)) AS BIGINT) AS duration FROM conversations GROUP BY 1)
SELECT conv_id AS trace, spans, duration, lines, errors FROM s JOIN l ON user_id = conv_id""")
def _(t):
    logs = t.events.groupBy(F.col("user_id").alias("trace")).agg(n_rows().alias("lines"), F.count_if(F.col("event_type") == "error").alias("errors"))
    traces = t.conversations.groupBy(F.col("conv_id").alias("trace")).agg(n_rows().alias("spans"), F.sum(F.length("text")).cast("bigint").alias("duration"))
    return traces.join(logs, "trace")


@query("X15_top_offenders", """
SELECT split_part(line, ' ', 1)::BIGINT AS pid, split_part(line, ' ', 2)::DOUBLE AS cpu, split_part(line, ' ', 3) AS command FROM (SELECT event_id || ' ' || value || ' ' || event_type AS line FROM events)
WHERE split_part(line, ' ', 2)::DOUBLE > 80 ORDER BY cpu DESC, pid LIMIT 10""")
def _(t):
    f = F.split(F.concat_ws(" ", "event_id", "value", "event_type"), " ")
    parsed = t.events.select(f[0].cast("bigint").alias("pid"), f[1].cast("double").alias("cpu"), f[2].alias("command"))
    return parsed.filter("cpu > 80").orderBy(F.col("cpu").desc(), "pid").limit(10)


@query("X16_label_arithmetic", f"""
WITH u AS (SELECT user_id % 10 AS node, {sql_total('value')} AS x FROM events WHERE event_type IN ('view', 'click') AND user_id % 10 <> 3 GROUP BY 1),
a AS (SELECT user_id % 10 AS node, {sql_total('value')} AS x FROM events WHERE user_id % 10 <> 3 GROUP BY 1)
SELECT u.node::VARCHAR AS node, u.x / a.x * 100 AS used_pct, 1 - u.x / a.x AS idle FROM u JOIN a USING (node)""")
def _(t):
    samples = t.events.select(
        F.create_map(F.lit("node"), (F.col("user_id") % 10).cast("string"), F.lit("kind"), F.col("event_type")).alias("labels"), "value"
    )

    def by_node(**selectors):
        node = F.element_at("labels", "node").alias("node")
        return samples.filter(X.label_matches("labels", selectors)).groupBy(node).agg(M.total("value").alias("x"))

    used = by_node(kind=("=~", "view|click"), node=("!=", "3")).withColumnRenamed("x", "u")
    return used.join(by_node(node=("!=", "3")), "node").select(
        "node", (F.col("u") / F.col("x") * 100).alias("used_pct"), (1 - F.col("u") / F.col("x")).alias("idle")
    )
