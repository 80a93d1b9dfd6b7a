"""Data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkweave.functions import money as M
from sparkweave.operators import quality as D
from sparkweave.plans.common import day, n_rows, sql_total, tagged
from sparkweave.plans.registry import query
from sparkweave.session import new_folder


@query("D01_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(t):
    return D.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("D02_not_null", "SELECT c_custkey FROM customer WHERE nullif(c_mktsegment, 'BUILDING') IS NULL")
def _(t):
    c = t.customer.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))
    return D.nulls(c, "segment").select("c_custkey")


@query("D03_accepted_values", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def _(t):
    return D.not_accepted(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).select("o_orderkey", "o_orderpriority")


@query("D04_relationships", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def _(t):
    return D.orphans(t.orders, "o_orderkey", t.lineitem, "l_orderkey").select("o_orderkey")


@query("D05_singular_test", f"""
SELECT o_orderkey, o_totalprice, items FROM orders JOIN (SELECT l_orderkey, {sql_total('l_extendedprice')} AS items FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
WHERE abs(o_totalprice - items) > 0.01 OR o_orderdate > TIMESTAMP '2001-08-01'""")
def _(t):
    items = t.lineitem.groupBy("l_orderkey").agg(M.total("l_extendedprice").alias("items"))
    return (
        t.orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"))
        .filter((F.abs(F.col("o_totalprice") - F.col("items")) > 0.01) | (F.col("o_orderdate") > "2001-08-01"))
        .select("o_orderkey", "o_totalprice", "items")
    )


@query("D06_rule_report", """
SELECT rule, (SELECT count(*) FROM part) AS "rows", failures FROM (
 SELECT 'size_range' AS rule, (SELECT count(*) FROM part WHERE p_size NOT BETWEEN 3 AND 48) AS failures
 UNION ALL SELECT 'name_set', (SELECT count(*) FROM part WHERE nullif(p_type, 'PROMO') IS NULL)
 UNION ALL SELECT 'price_positive', (SELECT count(*) FROM part WHERE p_retailprice <= 0)
 UNION ALL SELECT 'unique_name', (SELECT count(*) - count(DISTINCT p_name) FROM part))""")
def _(t):
    report = D.rule_report(t.part, {
        "size_range": F.col("p_size").between(3, 48), "name_set": F.nullif(F.col("p_type"), F.lit("PROMO")).isNotNull(),
        "price_positive": F.col("p_retailprice") > 0,
    })
    unique = t.part.agg(
        n_rows().alias("rows"), F.lit("unique_name").alias("rule"), (n_rows() - F.count_distinct("p_name")).alias("failures")
    )
    return report.unionByName(unique)


@query("D07_six_dimensions", """
SELECT (SELECT count(*) FROM documents WHERE text IS NULL OR text = '') AS incomplete, (SELECT count(*) FROM documents WHERE n_chars <= 0) AS inaccurate,
 (SELECT count(*) FROM documents WHERE n_chars <> length(text)) AS inconsistent, (SELECT max(ts)::DATE FROM events) AS newest,
 (SELECT count(*) FROM documents WHERE NOT regexp_matches(source, '^src[0-9]+$')) AS invalid, (SELECT count(*) - count(DISTINCT md5(text)) FROM documents) AS duplicated""")
def _(t):
    newest = t.events.agg(F.max(day("ts"))).scalar()
    return t.documents.agg(
        F.count_if(F.col("text").isNull() | (F.col("text") == "")).alias("incomplete"), F.count_if(F.col("n_chars") <= 0).alias("inaccurate"),
        F.count_if(F.col("n_chars") != F.length("text")).alias("inconsistent"), newest.alias("newest"),
        F.count_if(~F.col("source").rlike("^src[0-9]+$")).alias("invalid"), (n_rows() - F.count_distinct(F.md5("text"))).alias("duplicated"),
    )


@query("D08_freshness", """
SELECT event_type, floor(date_diff('second', max(ts), TIMESTAMP '2024-01-31 12:00:00') / 3600)::BIGINT AS hours,
 CASE WHEN date_diff('second', max(ts), TIMESTAMP '2024-01-31 12:00:00') > 24 * 3600 THEN 'error' WHEN date_diff('second', max(ts), TIMESTAMP '2024-01-31 12:00:00') > 13 * 3600 THEN 'warn' ELSE 'pass' END AS state
FROM events GROUP BY 1""")
def _(t):
    as_of = F.lit("2024-01-31 12:00:00").cast("timestamp")
    newest = t.events.groupBy("event_type").agg(F.max("ts").alias("m"))
    age = F.unix_seconds(as_of) - F.unix_seconds(F.col("m").cast("timestamp"))
    state = F.when(age > 24 * 3600, "error").when(age > 13 * 3600, "warn").otherwise("pass")
    return newest.select("event_type", F.floor(age / 3600).alias("hours"), state.alias("state"))


@query("D09_batch_report", """
WITH k AS (SELECT user_id, ts::DATE AS d, event_type, arg_min(value, event_id) AS value, count(*) AS n FROM events GROUP BY 1, 2, 3)
SELECT (SELECT count(*) FROM events) AS input_rows, count(*) AS unique_rows, (SELECT count(*) FROM events) - count(*) AS duplicates,
 count(*) FILTER (WHERE value > 300) AS nulled_values, count(*) FILTER (WHERE event_type = 'error') AS dropped,
 count(*) FILTER (WHERE event_type <> 'error') AS output_rows, count(*) FILTER (WHERE event_type <> 'error') * 100e0 / (SELECT count(*) FROM events) AS pass_rate FROM k""")
def _(t):
    e = t.events.withColumn("d", day("ts")).select("user_id", "d", "event_type", "event_id", "value")
    first = D.first_arrival(e, ["user_id", "d", "event_type"], "event_id")
    total = t.events.agg(n_rows()).scalar()
    kept = F.count_if(F.col("event_type") != "error")
    return first.agg(
        total.alias("input_rows"), n_rows().alias("unique_rows"), (total - n_rows()).alias("duplicates"),
        F.count_if(F.col("value") > 300).alias("nulled_values"), F.count_if(F.col("event_type") == "error").alias("dropped"),
        kept.alias("output_rows"), (kept * 100.0 / total).alias("pass_rate"),
    )


@query("D10_quality_gate", """
SELECT event_type, count(*) FILTER (WHERE value <= 60) * 100e0 / count(*) AS pass_rate, CASE WHEN count(*) FILTER (WHERE value <= 60) * 100e0 / count(*) < 80 THEN 'stopped' ELSE 'loaded' END AS status FROM events GROUP BY 1""")
def _(t):
    rate = F.count_if(F.col("value") <= 60) * 100.0 / n_rows()
    g = t.events.groupBy("event_type").agg(rate.alias("pass_rate"))
    return g.withColumn("status", F.when(F.col("pass_rate") < 80, "stopped").otherwise("loaded"))


@query("D11_first_arrival", """
SELECT user_id, ts::DATE AS d, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY 1, 2, 3""")
def _(t):
    e = t.events.withColumn("d", day("ts")).select("user_id", "d", "event_type", "event_id", "value")
    return D.first_arrival(e, ["user_id", "d", "event_type"], "event_id")


@query("D12_constraints_quarantine", """
SELECT p_partkey, concat_ws(',', CASE WHEN NOT p_retailprice > 950 THEN 'price' END, CASE WHEN p_type NOT IN ('ECONOMY', 'PROMO', 'STANDARD') THEN 'kind' END, CASE WHEN p_size < 10 THEN 'stock' END) AS broken
FROM part WHERE NOT (p_retailprice > 950) OR p_type NOT IN ('ECONOMY', 'PROMO', 'STANDARD') OR p_size < 10""")
def _(t):
    _, bad = D.split_by_rules(t.part, {
        "price": F.col("p_retailprice") > 950, "kind": F.col("p_type").isin("ECONOMY", "PROMO", "STANDARD"), "stock": F.col("p_size") >= 10,
    })
    return bad.select("p_partkey", F.array_join("broken_rules", ",").alias("broken"))


@query("D13_load_verification", f"""
SELECT event_type, count(*) AS records, min(ts)::DATE AS earliest, max(ts)::DATE AS latest, {sql_total('value')} / count(value) AS mean_value, count(*) FILTER (WHERE value > 100) AS big FROM events GROUP BY 1""")
def _(t):
    return t.events.groupBy("event_type").agg(
        n_rows().alias("records"), F.min(day("ts")).alias("earliest"), F.max(day("ts")).alias("latest"),
        M.mean("value").alias("mean_value"), F.count_if(F.col("value") > 100).alias("big"),
    )


@query("D14_run_log", """
SELECT 'extract' AS step, 'success' AS status, (SELECT count(*) FROM events) AS "rows" UNION ALL SELECT 'transform', 'success', (SELECT count(*) FROM events WHERE value <= 300)
UNION ALL SELECT 'load', 'success', (SELECT count(*) FROM events WHERE value <= 300)""")
def _(t):
    from sparkweave.sources.runlog import RunLog

    log = RunLog(t.spark, new_folder(t.spark, "run_log"))
    raw = log.step("extract", lambda: t.events)
    clean = log.step("transform", lambda: raw.filter("value <= 300"))
    folder = new_folder(t.spark, "loaded")

    def load():
        clean.write.parquet(folder)
        return t.spark.read.schema(clean.schema).parquet(folder)

    log.step("load", load)
    return log.read().select("step", "status", "rows")
