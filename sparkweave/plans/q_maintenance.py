"""Table maintenance, modelling and incremental loads."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from sparkweave.functions import money as M
from sparkweave.functions import scalars as S
from sparkweave.operators import maintenance as K
from sparkweave.operators import quality as D
from sparkweave.operators.aggregates import top_n_per_group
from sparkweave.plans.common import day, month, n_rows, sql_mean, sql_tagged, sql_total, sql_units, tagged
from sparkweave.plans.registry import query
from sparkweave.session import new_folder
from sparkweave.sources import files

AS_OF = "2001-08-01"


def staged_orders(t):
    return t.orders.select(
        F.col("o_orderkey").cast("int").alias("order_id"), F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("o_orderdate").alias("ordered_at"), F.lower(F.trim("o_orderstatus")).alias("status"),
        F.col("o_totalprice").alias("amount_usd"),
    ).filter("order_id IS NOT NULL AND amount_usd >= 0 AND status IN ('f', 'o', 'p')")


SQL_STG = """SELECT o_orderkey::INTEGER AS order_id, o_custkey::INTEGER AS customer_id, o_orderdate AS ordered_at, lower(trim(o_orderstatus)) AS status,
 o_totalprice AS amount_usd FROM orders WHERE o_totalprice >= 0 AND lower(trim(o_orderstatus)) IN ('f', 'o', 'p')"""


@query("M01_staging", SQL_STG)
def _(t):
    return staged_orders(t)


def order_stats(t):
    return staged_orders(t).groupBy("customer_id").agg(
        n_rows().alias("total_orders"), M.total("amount_usd").alias("lifetime_value"), M.mean("amount_usd").alias("mean_value"),
        F.max(day("ordered_at")).alias("last_order"),
    )


@query("M02_customer_dimension", f"""
WITH o AS ({SQL_STG}), s AS (SELECT customer_id, count(*) AS total_orders, {sql_total('amount_usd')} AS lifetime_value, max(ordered_at)::DATE AS last_order FROM o
  GROUP BY 1)
SELECT c_custkey AS customer_id, c_name AS full_name,
 CASE WHEN total_orders IS NULL THEN 'new' WHEN total_orders = 1 THEN 'one_time' WHEN total_orders < 5 THEN 'occasional' WHEN total_orders < 20 THEN 'regular' ELSE 'vip' END AS segment,
 CASE WHEN coalesce(lifetime_value, 0) = 0 THEN 'no_spend' WHEN lifetime_value < 100000 THEN 'low_value' WHEN lifetime_value < 500000 THEN 'mid_value' WHEN lifetime_value < 2000000 THEN 'high_value' ELSE 'premium' END AS tier,
 coalesce(total_orders, 0) AS total_orders, coalesce(lifetime_value, 0) AS lifetime_value, date_diff('day', last_order, DATE '2001-10-01') AS days_since_last,
 coalesce(date_diff('day', last_order, DATE '2001-10-01') > 120, false) AS is_churned
FROM customer LEFT JOIN s ON s.customer_id = c_custkey""")
def _(t):
    stats = staged_orders(t).groupBy("customer_id").agg(
        n_rows().alias("total_orders"), M.total("amount_usd").alias("lifetime_value"), F.max(day("ordered_at")).alias("last_order")
    )
    n, v = F.col("total_orders"), F.col("lifetime_value")
    since = F.date_diff(F.lit("2001-10-01").cast("date"), F.col("last_order"))
    segment = F.when(n.isNull(), "new").otherwise(S.buckets(n, [(2, "one_time"), (5, "occasional"), (20, "regular")], "vip"))
    tier = F.when(F.coalesce(v, F.lit(0.0)) == 0, "no_spend").otherwise(
        S.buckets(v, [(100000, "low_value"), (500000, "mid_value"), (2000000, "high_value")], "premium")
    )
    c = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"))
    return c.join(stats, "customer_id", "left").select(
        "customer_id", "full_name", segment.alias("segment"), tier.alias("tier"), F.coalesce(n, F.lit(0)).alias("total_orders"),
        F.coalesce(v, F.lit(0.0)).alias("lifetime_value"), since.alias("days_since_last"),
        F.coalesce(since > 120, F.lit(False)).alias("is_churned"),
    )


SIZES = [(50000, "small"), (150000, "medium"), (350000, "large")]


def fct_orders(t):
    countries = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    o = staged_orders(t).filter("status <> 'p'")
    dow = F.dayofweek("ordered_at") - 1
    return (
        o.join(t.customer, F.col("customer_id") == F.col("c_custkey"), "left")
        .join(countries, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            "order_id", "customer_id", F.col("n_name").alias("country"), F.col("r_name").alias("region"), "status",
            day("ordered_at").alias("order_date"), F.date_trunc("week", "ordered_at").cast("date").alias("order_week"),
            month("ordered_at").alias("order_month"), F.trunc(day("ordered_at"), "year").alias("order_year"),
            dow.alias("day_of_week"), F.hour("ordered_at").alias("hour_of_day"), "amount_usd",
            dow.isin(0, 6).alias("is_weekend"), S.buckets(F.col("amount_usd"), SIZES, "enterprise").alias("size_class"),
        )
    )


SQL_FCT = f"""SELECT order_id, customer_id, n_name AS country, r_name AS region, status, ordered_at::DATE AS order_date, date_trunc('week', ordered_at)::DATE AS order_week,
 date_trunc('month', ordered_at)::DATE AS order_month, date_trunc('year', ordered_at)::DATE AS order_year, dayofweek(ordered_at)::INTEGER AS day_of_week,
 hour(ordered_at)::INTEGER AS hour_of_day, amount_usd, dayofweek(ordered_at) IN (0, 6) AS is_weekend,
 CASE WHEN amount_usd < 50000 THEN 'small' WHEN amount_usd < 150000 THEN 'medium' WHEN amount_usd < 350000 THEN 'large' ELSE 'enterprise' END AS size_class
 FROM ({SQL_STG}) LEFT JOIN customer ON customer_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE status <> 'p'"""


@query("M03_order_fact", SQL_FCT)
def _(t):
    return fct_orders(t)


def daily_revenue(fct):
    agg = fct.groupBy(F.col("order_date").alias("revenue_date"), "country", "region", F.col("size_class").alias("category")).agg(
        n_rows().alias("num_orders"), M.total("amount_usd").alias("revenue"), F.max("amount_usd").alias("max_order"), F.min("amount_usd").alias("min_order")
    )
    return agg.select(
        S.surrogate_key(F.col("revenue_date"), F.col("country"), F.col("category")).alias("sk"), "revenue_date", "country",
        F.coalesce("region", F.lit("Unknown")).alias("region"), "category", "num_orders", "revenue", "max_order", "min_order",
        F.round(F.col("revenue") / F.nullif(F.col("num_orders"), F.lit(0)), 6).alias("revenue_per_order"),
    )


@query("M04_incremental_daily_revenue", f"""
SELECT md5(coalesce(order_date::VARCHAR, 'null') || '|' || coalesce(country, 'null') || '|' || coalesce(size_class, 'null')) AS sk, order_date AS revenue_date, country,
 coalesce(region, 'Unknown') AS region, size_class AS category, count(*) AS num_orders, {sql_total('amount_usd')} AS revenue, max(amount_usd) AS max_order, min(amount_usd) AS min_order,
 round({sql_total('amount_usd')} / nullif(count(*), 0), 6) AS revenue_per_order FROM ({SQL_FCT}) GROUP BY order_date, country, coalesce(region, 'Unknown'), size_class""")
def _(t):
    fct = fct_orders(t)
    # first load: up to a cut, and some orders of its last days arrive late
    late = (F.col("order_date") > F.lit("2001-05-12").cast("date")) & (F.col("order_id") % 2 == 0)
    first = files.stored(daily_revenue(fct.filter((F.col("order_date") <= F.lit("2001-05-14").cast("date")) & ~late)), "daily_revenue")
    # second load: whole days from the look-back on are computed again and replace their keys
    since = first.agg(F.date_sub(F.max("revenue_date"), 3)).scalar()
    return K.replace_by_key(first, daily_revenue(fct.filter(F.col("order_date") >= since)), ["sk"])


def versions_of_orders(t):
    v1 = t.orders.filter("o_orderkey % 10 <> 0").select(
        "o_orderkey", "o_totalprice", F.lit("2024-01-01").cast("date").alias("loaded_at"), F.lit("2024-01-01").cast("date").alias("updated_at")
    )
    v2 = t.orders.filter("o_orderkey % 4 = 0").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit("2024-01-02").cast("date").alias("loaded_at"), F.lit("2024-01-02").cast("date").alias("updated_at")
    )
    return v1, v2


SQL_V1 = "SELECT o_orderkey, o_totalprice, DATE '2024-01-01' AS loaded_at, DATE '2024-01-01' AS updated_at FROM orders WHERE o_orderkey % 10 <> 0"
SQL_V2 = "SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, DATE '2024-01-02' AS loaded_at, DATE '2024-01-02' AS updated_at FROM orders WHERE o_orderkey % 4 = 0"
SQL_MERGED = f"SELECT * FROM ({SQL_V2}) UNION ALL SELECT * FROM ({SQL_V1}) WHERE o_orderkey % 4 <> 0"


@query("M05_incremental_strategies", sql_tagged(
    merge=SQL_MERGED, append=f"SELECT * FROM ({SQL_V1}) UNION ALL SELECT * FROM ({SQL_V2})", delete_insert=SQL_MERGED))
def _(t):
    v1, v2 = versions_of_orders(t)
    return tagged(**{s.replace("+", "_"): K.incremental(v1, v2, ["o_orderkey"], s) for s in ("merge", "append", "delete+insert")})


@query("M06_materialisations", sql_tagged(**{k: f"SELECT c_nationkey, {sql_total('c_acctbal')} AS balance FROM customer GROUP BY 1" for k in ("view", "table", "ephemeral")}))
def _(t):
    model = t.customer.groupBy("c_nationkey").agg(M.total("c_acctbal").alias("balance"))
    model.createOrReplaceTempView("nation_balance_view")
    return tagged(view=t.spark.table("nation_balance_view"), table=files.stored(model, "nation_balance"), ephemeral=model)


SQL_SAGA = """SELECT user_id, arg_max(event_type, (ts, event_id)) AS state, min(ts) AS started, max(ts) AS updated FROM events GROUP BY 1"""


@query("M07_saga_state", f"""
WITH s AS ({SQL_SAGA}), a AS (SELECT *, CASE state WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'cancelled' ELSE 'in_flight' END AS outcome FROM s)
SELECT outcome, count(*) AS n, round(count(*) * 100e0 / (SELECT count(*) FROM s), 6) AS pct,
 count(*) FILTER (WHERE outcome = 'in_flight' AND updated < TIMESTAMP '2024-01-30 23:30:00') AS stuck FROM a GROUP BY 1""")
def _(t):
    s = t.events.groupBy("user_id").agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("state"), F.max("ts").alias("updated")
    )
    outcome = F.when(F.col("state") == "purchase", "success").when(F.col("state") == "error", "cancelled").otherwise("in_flight")
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    stuck = (F.col("outcome") == "in_flight") & (F.col("updated") < as_of - F.expr("INTERVAL '30' MINUTE"))
    per = s.withColumn("outcome", outcome).groupBy("outcome").agg(n_rows().alias("n"), F.count_if(stuck).alias("stuck"))
    return per.select("outcome", "n", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 6).alias("pct"), "stuck")


@query("M08_upsert", f"""
SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, coalesce(b.o_totalprice, a.o_totalprice) AS o_totalprice, coalesce(a.loaded_at, b.loaded_at) AS loaded_at,
 coalesce(b.updated_at, a.updated_at) AS updated_at, CASE WHEN a.o_orderkey IS NULL THEN 'inserted' WHEN b.o_orderkey IS NULL THEN 'kept' ELSE 'updated' END AS action
FROM ({SQL_V1}) a FULL JOIN ({SQL_V2}) b ON a.o_orderkey = b.o_orderkey""")
def _(t):
    v1, v2 = versions_of_orders(t)
    return K.upsert(v1, v2, ["o_orderkey"], keep_first=["loaded_at"])


@query("M09_upsert_additive", """
SELECT o_custkey, CAST(sum(n) AS BIGINT) AS n, CAST(sum(u) AS BIGINT) AS u FROM (SELECT o_custkey, 1 AS n, CAST(round(o_totalprice * 100) AS BIGINT) AS u FROM orders) GROUP BY 1""")
def _(t):
    def counts(df):
        return df.groupBy("o_custkey").agg(n_rows().alias("n"), F.sum(M.units("o_totalprice")).alias("u"))

    old, new = t.orders.filter("o_orderdate < '1999-01-01'"), t.orders.filter("o_orderdate >= '1999-01-01'")
    return K.upsert_add(counts(old), counts(new), ["o_custkey"], ["n", "u"])


@query("M10_insert_if_absent", f"SELECT * FROM ({SQL_V1}) UNION ALL SELECT * FROM ({SQL_V2}) WHERE o_orderkey % 10 = 0")
def _(t):
    v1, v2 = versions_of_orders(t)
    return K.insert_absent(v1, v2, ["o_orderkey"])


@query("M11_merge", """
WITH t AS (SELECT o_orderkey AS id, o_orderpriority AS name, o_orderstatus AS status FROM orders WHERE o_orderkey % 10 <> 0),
s AS (SELECT o_orderkey AS id, o_orderpriority || ' new' AS name, CASE WHEN o_orderkey % 8 = 0 THEN 'X' ELSE 'A' END AS status FROM orders WHERE o_orderkey % 4 = 0)
SELECT coalesce(t.id, s.id) AS id, coalesce(s.name, t.name) AS name, coalesce(t.status, s.status) AS status FROM t FULL JOIN s ON t.id = s.id
WHERE NOT (t.id IS NOT NULL AND s.id IS NOT NULL AND s.status = 'X')""")
def _(t):
    target = t.orders.filter("o_orderkey % 10 <> 0").selectExpr("o_orderkey AS id", "o_orderpriority AS name", "o_orderstatus AS status")
    source = t.orders.filter("o_orderkey % 4 = 0").selectExpr(
        "o_orderkey AS id", "concat(o_orderpriority, ' new') AS name", "CASE WHEN o_orderkey % 8 = 0 THEN 'X' ELSE 'A' END AS status"
    )
    return K.merge(target, source, ["id"], F.col("s.status") == "X", update=["name"])


@query("M12_conditional_update_delete", """
SELECT c_custkey, CASE WHEN c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2) THEN round(c_acctbal * 1.1, 6) ELSE c_acctbal END AS balance
FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey GROUP BY o_custkey HAVING max(o_orderdate) < TIMESTAMP '2001-01-01')""")
def _(t):
    raised = t.nation.filter("n_regionkey = 2").select(F.col("n_nationkey").alias("c_nationkey"), F.lit(True).alias("raise_it"))
    stale = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("d")).filter("d < '2001-01-01'")
    b = F.col("c_acctbal")
    return (
        t.customer.join(raised, "c_nationkey", "left").join(stale, "c_custkey", "left_anti")
        .select("c_custkey", F.when(F.col("raise_it"), F.round(b * 1.1, 6)).otherwise(b).alias("balance"))
    )


@query("M13_archive_move", """
SELECT CASE WHEN o_orderdate < '1997-01-01' THEN 'archive' ELSE 'live' END AS form, count(*) AS n, min(o_orderkey) AS lowest FROM orders GROUP BY 1""")
def _(t):
    live, old = K.split_archive(t.orders, F.col("o_orderdate") < "1997-01-01")
    aggs = [n_rows().alias("n"), F.min("o_orderkey").alias("lowest")]
    return tagged(live=files.stored(live, "live").agg(*aggs), archive=files.stored(old, "archive").agg(*aggs))


def segment_changes(t):
    changed = t.customer.filter("c_custkey % 4 = 0").select("c_custkey", F.concat("c_mktsegment", F.lit(" 2")).alias("segment"))
    same = t.customer.filter("c_custkey % 4 = 1").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    new = t.customer.filter("c_custkey % 50 = 0").select((F.col("c_custkey") + 1_000_000_000).alias("c_custkey"), F.lit("NEW").alias("segment"))
    return changed.union(same).union(new)


SQL_CHANGES = """SELECT c_custkey, c_mktsegment || ' 2' AS segment FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 4 = 1
 UNION ALL SELECT c_custkey + 1000000000, 'NEW' FROM customer WHERE c_custkey % 50 = 0"""


@query("M14_scd1", f"""
WITH d AS (SELECT c_custkey, c_mktsegment AS segment FROM customer), n AS ({SQL_CHANGES})
SELECT coalesce(n.c_custkey, d.c_custkey) AS c_custkey, coalesce(n.segment, d.segment) AS segment FROM d FULL JOIN n ON n.c_custkey = d.c_custkey""")
def _(t):
    dim = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return K.upsert(dim, segment_changes(t), ["c_custkey"]).drop("action")


@query("M15_scd2", f"""
WITH d AS (SELECT row_number() OVER (ORDER BY c_custkey) AS sk, c_custkey, c_mktsegment AS segment FROM customer), n AS ({SQL_CHANGES}),
c AS (SELECT n.*, d.sk AS old FROM n LEFT JOIN d ON d.c_custkey = n.c_custkey WHERE d.segment IS NULL OR d.segment <> n.segment)
SELECT d.sk AS sk, d.c_custkey AS c_custkey, d.segment AS segment, DATE '2023-01-01' AS valid_from, CASE WHEN c.old IS NULL THEN DATE '9999-12-31' ELSE DATE '2023-04-30' END AS valid_to,
 c.old IS NULL AS is_current FROM d LEFT JOIN c ON c.old = d.sk
UNION ALL SELECT (SELECT max(sk) FROM d) + row_number() OVER (ORDER BY c_custkey), c_custkey, segment, DATE '2023-05-01', DATE '9999-12-31', true FROM c""")
def _(t):
    base = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    dim = files.stored(
        K.assign_keys(base, "c_custkey", "sk").select(
            "sk", "c_custkey", "segment", F.lit("2023-01-01").cast("date").alias("valid_from"),
            F.lit(K.OPEN_END).cast("date").alias("valid_to"), F.lit(True).alias("is_current"),
        ), "dim_customer",
    )
    return K.scd2_apply(dim, segment_changes(t), "c_custkey", ["segment"], "2023-05-01")


@query("M16_scd3", f"""
WITH n AS ({SQL_CHANGES}) SELECT customer.c_custkey AS c_custkey, coalesce(n.segment, c_mktsegment) AS segment,
 CASE WHEN n.segment <> c_mktsegment THEN c_mktsegment END AS previous_segment FROM customer LEFT JOIN n ON n.c_custkey = customer.c_custkey""")
def _(t):
    dim = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return K.scd3_apply(dim, segment_changes(t), "c_custkey", "segment")


@query("M17_star_schema", """
WITH dd AS (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2009-12-31', INTERVAL 1 DAY))::DATE AS d),
dim_date AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d FROM dd),
dim_product AS (SELECT row_number() OVER (ORDER BY p_partkey) AS product_key, p_partkey FROM part),
dim_customer AS (SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey FROM customer)
SELECT date_key, product_key, customer_key, CAST(count(*) AS BIGINT) AS lines, CAST(sum(l_quantity::BIGINT) AS BIGINT) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN dim_date ON d = o_orderdate::DATE JOIN dim_product ON p_partkey = l_partkey JOIN dim_customer ON c_custkey = o_custkey GROUP BY 1, 2, 3""")
def _(t):
    dim_date = t.spark.range(1).select(
        F.explode(F.expr("sequence(DATE'1990-01-01', DATE'2009-12-31')")).alias("d")
    ).select(F.date_format("d", "yyyyMMdd").cast("int").alias("date_key"), "d")
    dim_product = K.assign_keys(t.part.select("p_partkey"), "p_partkey", "product_key")
    dim_customer = K.assign_keys(t.customer.select("c_custkey"), "c_custkey", "customer_key")
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("d", day("o_orderdate"))
        .join(dim_date, "d")
        .join(dim_product, F.col("l_partkey") == F.col("p_partkey"))
        .join(dim_customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("date_key", "product_key", "customer_key")
        .agg(n_rows().alias("lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    )


@query("M18_snowflake_split", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(t):
    star = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "n_regionkey", "r_name")
    dim_region = star.select("n_regionkey", "r_name").distinct()
    dim_nation = star.select("n_nationkey", "n_name", "n_regionkey")
    return dim_nation.join(dim_region, "n_regionkey").select("n_nationkey", "n_name", "r_name")


@query("M19_snapshot_facts", f"""
WITH m AS (SELECT c_nationkey AS k, date_trunc('month', o_orderdate)::DATE AS m, {sql_total('o_totalprice')} AS x FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
spine AS (SELECT unnest(generate_series((SELECT min(m) FROM m), (SELECT max(m) FROM m), INTERVAL 1 MONTH))::DATE AS m)
SELECT 'periodic' AS form, n_nationkey::BIGINT AS k, spine.m AS d1, NULL::DATE AS d2, (SELECT coalesce({sql_total('x')}, 0) FROM m WHERE m.k = n_nationkey AND m.m <= spine.m) AS x FROM spine CROSS JOIN nation
UNION ALL SELECT 'accumulating', o_orderkey, min(l_shipdate)::DATE, max(l_shipdate)::DATE, date_diff('day', any_value(o_orderdate)::DATE, max(l_shipdate)::DATE)::DOUBLE FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def _(t):
    m = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("k"), month("o_orderdate").alias("m")).agg(F.sum(M.units("o_totalprice")).alias("u"))
    )
    span = t.orders.agg(F.min(month("o_orderdate")).alias("lo"), F.max(month("o_orderdate")).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    grid = t.nation.select(F.col("n_nationkey").alias("k"), lo.alias("lo"), hi.alias("hi")).select(
        "k", F.explode(F.expr("sequence(lo, hi, INTERVAL 1 MONTH)")).alias("m")
    )
    upto = Window.partitionBy("k").orderBy("m")  # one row per nation and month
    periodic = grid.join(m, ["k", "m"], "left").select(
        F.col("k").cast("bigint").alias("k"), F.col("m").alias("d1"), F.lit(None).cast("date").alias("d2"),
        (F.sum(F.coalesce("u", F.lit(0))).over(upto) / 100.0).alias("x"),
    )
    ships = t.lineitem.groupBy("l_orderkey").agg(F.min(day("l_shipdate")).alias("d1"), F.max(day("l_shipdate")).alias("d2"))
    accumulating = t.orders.join(ships, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("k"), "d1", "d2", F.date_diff("d2", day("o_orderdate")).cast("double").alias("x")
    )
    return tagged(periodic=periodic, accumulating=accumulating)


@query("M20_cdc_apply", """
WITH log AS (SELECT o_orderkey AS id, o_orderkey * 10 AS lsn, 'c' AS op, o_totalprice AS price FROM orders
 UNION ALL SELECT o_orderkey, o_orderkey * 10 + 1, 'u', o_totalprice + 5 FROM orders WHERE o_orderkey % 3 = 0
 UNION ALL SELECT o_orderkey, o_orderkey * 10 + 2, 'd', NULL FROM orders WHERE o_orderkey % 5 = 0)
SELECT id, lsn, price FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY lsn DESC) AS rn FROM log) WHERE rn = 1 AND op <> 'd'""")
def _(t):
    o = t.orders
    log = (
        o.selectExpr("o_orderkey AS id", "o_orderkey * 10 AS lsn", "'c' AS op", "o_totalprice AS price")
        .union(o.filter("o_orderkey % 3 = 0").selectExpr("o_orderkey", "o_orderkey * 10 + 1", "'u'", "o_totalprice + 5"))
        .union(o.filter("o_orderkey % 5 = 0").selectExpr("o_orderkey", "o_orderkey * 10 + 2", "'d'", "CAST(NULL AS DOUBLE)"))
    )
    return K.apply_changes(log, "id", "lsn", F.col("op") == "d").select("id", "lsn", "price")


@query("M21_log_compaction", """
SELECT user_id AS k, "offset", v FROM (SELECT user_id, event_id AS "offset", CASE WHEN event_type <> 'error' THEN props END AS v,
 row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND v IS NOT NULL""")
def _(t):
    log = t.events.select(
        F.col("user_id").alias("k"), F.col("event_id").alias("offset"), F.when(F.col("event_type") != "error", F.col("props")).alias("v")
    )
    return K.apply_changes(log, "k", "offset", F.col("v").isNull())


@query("M22_watermark_extract", """
WITH d(run, hi) AS (VALUES (1, DATE '1998-03-10'), (2, DATE '1998-04-30'), (3, DATE '1998-05-02')),
r AS (SELECT run, coalesce(lag(hi) OVER (ORDER BY run) - 1, hi - 6)::DATE AS lo, hi FROM d)
SELECT run, lo, hi, count(o_orderkey) AS loaded FROM r LEFT JOIN orders ON o_orderdate::DATE BETWEEN lo AND hi GROUP BY 1, 2, 3""")
def _(t):
    mark = K.Watermark(t.spark, new_folder(t.spark, "watermark"))
    runs = []
    for run, today in enumerate([dt.date(1998, 3, 10), dt.date(1998, 4, 30), dt.date(1998, 5, 2)], 1):
        lo, hi = K.load_range(mark.read(), today)
        parts = [files.stored(t.orders.filter(day("o_orderdate").between(*p)), "batch") for p in K.portions(lo, hi)]
        loaded = reduce(DataFrame.unionByName, parts).agg(
            F.lit(run).alias("run"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), n_rows().alias("loaded")
        )
        mark.write(today)  # only after the batch is stored
        runs.append(loaded)
    return runs[0].union(runs[1]).union(runs[2])


@query("M23_full_and_dated_reload", sql_tagged(
    full="SELECT year(o_orderdate)::INTEGER AS y, count(*) AS n FROM orders GROUP BY 1", dated="SELECT year(o_orderdate)::INTEGER AS y, count(*) AS n FROM orders GROUP BY 1"))
def _(t):
    folder = new_folder(t.spark, "by_year")
    o = t.orders.withColumn("y", F.year("o_orderdate"))
    files.write_partitioned(o.filter("o_orderkey % 2 = 0"), folder, ["y"])
    files.replace_partitions(o.filter("y = 1997"), folder, ["y"])
    files.replace_partitions(o, folder, ["y"])
    dated = t.spark.read.schema(o.schema).parquet(folder)
    return tagged(full=files.stored(o, "full").groupBy("y").agg(n_rows().alias("n")), dated=dated.groupBy("y").agg(n_rows().alias("n")))


@query("M24_rerun_is_idempotent", "SELECT 0::BIGINT AS missing, 0::BIGINT AS extra, (SELECT count(*) FROM orders WHERE o_orderkey % 10 <> 0 OR o_orderkey % 4 = 0) AS n")
def _(t):
    v1, v2 = versions_of_orders(t)
    once = K.upsert(v1, v2, ["o_orderkey"], ["loaded_at"]).drop("action")
    twice = K.upsert(once, v2, ["o_orderkey"], ["loaded_at"]).drop("action")
    diff = once.withColumn("s", F.lit(1)).unionByName(twice.withColumn("s", F.lit(-1))).groupBy(*once.columns).agg(F.sum("s").alias("s"))
    return diff.agg(F.count_if(F.col("s") > 0).alias("missing"), F.count_if(F.col("s") < 0).alias("extra"), n_rows().alias("n"))


@query("M25_schema_evolution", """
SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, CAST(NULL AS VARCHAR) AS note, p_brand AS extra FROM part""")
def _(t):
    target = t.spark.createDataFrame([], "p_partkey bigint, p_name string, p_size bigint, note string").schema
    incoming = t.part.select("p_partkey", "p_name", "p_size", F.col("p_brand").alias("extra"))
    return K.evolve(incoming, target, "append")


SQL_HISTORY = """SELECT p_brand AS subject, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size // 11)::INTEGER AS version, split_part(p_name, ' ', 2) AS field,
 p_type, p_retailprice FROM part"""


@query("M26_schema_compatibility", f"""
WITH h AS (SELECT subject, version, field, min(p_type) AS type, bool_and(p_retailprice > 1000) AS optional FROM ({SQL_HISTORY}) GROUP BY 1, 2, 3),
v AS (SELECT DISTINCT subject, version FROM h), p AS (SELECT a.subject AS subject, a.version AS v, b.version AS u FROM v a JOIN v b ON a.subject = b.subject AND b.version < a.version),
f AS (SELECT p.*, x.field AS nf, x.type AS nt, x.optional AS no, y.field AS ofd, y.type AS ot, y.optional AS oo FROM p
  JOIN (SELECT DISTINCT subject, field FROM h) k ON k.subject = p.subject LEFT JOIN h x ON x.subject = p.subject AND x.version = v AND x.field = k.field
  LEFT JOIN h y ON y.subject = p.subject AND y.version = u AND y.field = k.field),
b AS (SELECT subject, v, u, bool_or((nf IS NOT NULL AND ofd IS NULL AND NOT no) OR coalesce(nt <> ot, false)) AS bb, bool_or((nf IS NULL AND ofd IS NOT NULL AND NOT oo) OR coalesce(nt <> ot, false)) AS bf FROM f GROUP BY 1, 2, 3)
SELECT subject, v AS version, NOT bool_or(bb AND u = v - 1) AS backward, NOT bool_or(bf AND u = v - 1) AS forward, NOT bool_or((bb OR bf) AND u = v - 1) AS "full",
 NOT bool_or(bb) AS backward_transitive, NOT bool_or(bf) AS forward_transitive, NOT bool_or(bb OR bf) AS full_transitive FROM b GROUP BY 1, 2""")
def _(t):
    sized = t.part.select(
        F.col("p_brand").alias("subject"), F.expr("p_size div 11").alias("s"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("field"),
        "p_type", "p_retailprice",
    )
    numbered = sized.select("subject", "s").distinct().withColumn(
        "version", F.row_number().over(Window.partitionBy("subject").orderBy("s"))  # a row per version
    )
    history = sized.join(numbered, ["subject", "s"]).groupBy("subject", "version", "field").agg(
        F.min("p_type").alias("type"), F.bool_and(F.col("p_retailprice") > 1000).alias("optional")
    )
    return K.schema_verdicts(history)


@query("M27_view_refresh", f"""
WITH a AS (SELECT o_custkey, {sql_total('o_totalprice')} AS x FROM orders WHERE o_orderdate < '2001-07-15' GROUP BY 1), b AS (SELECT o_custkey, {sql_total('o_totalprice')} AS x FROM orders GROUP BY 1)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, CASE WHEN a.o_custkey IS NULL THEN 'insert' WHEN b.o_custkey IS NULL THEN 'delete' ELSE 'update' END AS change
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey WHERE a.x IS DISTINCT FROM b.x""")
def _(t):
    def view(o):
        return o.groupBy("o_custkey").agg(M.total("o_totalprice").alias("x"))

    return K.refresh_changed(files.stored(view(t.orders.filter("o_orderdate < '2001-07-15'")), "view"), view(t.orders), ["o_custkey"])


@query("M28_retention", """
WITH p AS (SELECT ts::DATE AS d, count(*) AS n FROM events GROUP BY 1), r AS (SELECT d, n, CAST(sum(n) OVER (ORDER BY d DESC) AS BIGINT) AS size_from_newest FROM p)
SELECT * FROM r WHERE d < (SELECT max(d) FROM p) - 20 OR size_from_newest > 5000""")
def _(t):
    parts = t.events.groupBy(day("ts").alias("d")).agg(n_rows().alias("n"))
    return K.expired(parts, "d", "n", t.events.agg(F.date_sub(F.max(day("ts")), 20)).scalar(), 5000)


@query("M29_medallion", f"""
SELECT event_type, count(*) AS n, {sql_total('value')} AS total, (SELECT count(*) FROM events WHERE NOT (value BETWEEN 1 AND 300)) AS quarantined
FROM events WHERE value BETWEEN 1 AND 300 GROUP BY 1""")
def _(t):
    bronze = files.stored(files.ingest_raw(t.events, "events", "batch-1").drop("_loaded_at", "ingest_date"), "bronze")
    good, bad = D.split_by_rules(bronze, {"value_range": F.col("value").between(1, 300), "has_type": F.col("event_type").isNotNull()})
    silver, quarantine = files.stored(good, "silver"), files.stored(bad, "quarantine")
    held = quarantine.agg(n_rows()).scalar()
    gold = silver.groupBy("event_type").agg(n_rows().alias("n"), M.total("value").alias("total"))
    return gold.withColumn("quarantined", held)


@query("M30_read_model", """
WITH l AS (SELECT user_id, ts, CASE WHEN event_type IN ('signup', 'click') THEN 1 WHEN event_type = 'purchase' THEN -1 ELSE 0 END * CAST(round(value * 100) AS BIGINT) AS u FROM events)
SELECT user_id, CAST(sum(u) AS BIGINT) / 1e2 AS balance, CAST(sum(CASE WHEN ts <= TIMESTAMP '2024-01-10' THEN u ELSE 0 END) AS BIGINT) / 1e2 AS balance_then, count(*) AS events FROM l GROUP BY 1""")
def _(t):
    sign = F.when(F.col("event_type").isin("signup", "click"), 1).when(F.col("event_type") == "purchase", -1).otherwise(0)
    u = sign * M.units("value")
    then = F.col("ts") <= F.lit("2024-01-10").cast("timestamp_ntz")
    return t.events.groupBy("user_id").agg(
        (F.sum(u) / 100.0).alias("balance"), (F.sum(F.when(then, u).otherwise(0)) / 100.0).alias("balance_then"), n_rows().alias("events")
    )


@query("M31_sync_by_hash", """
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'INSERT' WHEN doc_id % 3 = 0 THEN 'UPDATE' ELSE 'SKIP' END AS step FROM documents""")
def _(t):
    known = t.documents.filter("doc_id % 5 <> 0")
    incoming = t.documents.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" edited"))).otherwise(F.col("text")))
    return K.sync_plan(known, incoming, "doc_id", ["text", "lang", "source"]).select("doc_id", "step")


@query("M32_outbox_relay", """
SELECT 1 AS run, (SELECT count(*) FROM events WHERE ts < '2024-01-16') AS published, (SELECT count(*) FROM events WHERE ts >= '2024-01-16') AS lag
UNION ALL SELECT 2, (SELECT count(*) FROM events WHERE ts >= '2024-01-16'), 0 UNION ALL SELECT 3, 0, 0""")
def _(t):
    out = new_folder(t.spark, "published")
    outbox = t.events.select(F.col("event_id").alias("id"), F.col("user_id").alias("aggregate_id"), F.col("props").alias("payload"), "ts")
    total, runs, sent = outbox.count(), [], 0
    for run, box in enumerate([outbox.filter("ts < '2024-01-16'"), outbox, outbox], 1):
        n = K.relay(box, out)
        sent += n
        runs.append((run, n, total - sent))
    return t.spark.createDataFrame(runs, "run int, published bigint, lag bigint")
