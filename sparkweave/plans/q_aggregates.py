"""Aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from sparkweave.functions import money as M
from sparkweave.functions import scalars as S
from sparkweave.operators import aggregates as A
from sparkweave.operators import joins as J
from sparkweave.operators.ordered import exact_quantiles, running_totals, value_positions
from sparkweave.plans.common import EMP, day, employees, month, n_rows, sql_mean, sql_tagged, sql_total, sql_units, tagged
from sparkweave.plans.registry import query
from sparkweave.sources.files import round_trip


@query("A01_count_forms", """
SELECT c_nationkey, count(*) AS n, count(nullif(c_mktsegment, 'BUILDING')) AS n_set, count(DISTINCT c_mktsegment) AS n_kinds FROM customer GROUP BY 1""")
def _(t):
    return t.customer.groupBy("c_nationkey").agg(
        n_rows().alias("n"),
        F.count(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))).alias("n_set"),
        F.count_distinct("c_mktsegment").alias("n_kinds"),
    )


@query("A02_aggregates_and_nulls", f"""
WITH d AS (SELECT l_returnflag, nullif(l_discount, 0) AS d FROM lineitem)
SELECT l_returnflag, {sql_total('d')} AS total, {sql_mean('d')} AS mean, {sql_mean('coalesce(d, 0)')} AS mean_zero, min(d) AS lo, max(d) AS hi FROM d GROUP BY 1""")
def _(t):
    d = t.lineitem.select("l_returnflag", F.nullif(F.col("l_discount"), F.lit(0.0)).alias("d"))
    return d.groupBy("l_returnflag").agg(
        M.total("d").alias("total"), M.mean("d").alias("mean"), M.mean(F.coalesce("d", F.lit(0.0))).alias("mean_zero"),
        F.min("d").alias("lo"), F.max("d").alias("hi"),
    )


@query("A03_group_by", f"""
SELECT l_returnflag, l_linestatus, {sql_total('l_quantity')} AS sum_qty, {sql_total('l_extendedprice')} AS sum_base,
 {sql_total('l_extendedprice * (1 - l_discount)', 4)} AS sum_disc, {sql_mean('l_quantity')} AS avg_qty, count(*) AS n FROM lineitem
 WHERE l_shipdate <= '2001-08-02' GROUP BY 1, 2""")
def _(t):
    return (
        t.lineitem.filter(F.col("l_shipdate") <= "2001-08-02")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            M.total("l_quantity").alias("sum_qty"), M.total("l_extendedprice").alias("sum_base"),
            M.total(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("sum_disc"),
            M.mean("l_quantity").alias("avg_qty"), n_rows().alias("n"),
        )
    )


SQL_A04 = f"SELECT year(o_orderdate)::INTEGER AS y, o_orderstatus, {sql_total('o_totalprice')} AS total FROM orders GROUP BY 1, 2"


@query("A04_group_by_expression", sql_tagged(expression=SQL_A04, alias=SQL_A04, ordinal=SQL_A04))
def _(t):
    t.register("orders")
    total = "sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100D AS total"
    forms = {"expression": "year(o_orderdate), o_orderstatus", "alias": "y, o_orderstatus", "ordinal": "1, 2"}
    return tagged(**{
        k: t.spark.sql(f"SELECT year(o_orderdate) AS y, o_orderstatus, {total} FROM orders GROUP BY {g}") for k, g in forms.items()
    })


@query("A05_group_by_key_with_dependent", f"""
SELECT c_custkey, c_name, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name""")
def _(t):
    n = t.orders.groupBy("o_custkey").agg(n_rows().alias("n"))
    return t.customer.join(n, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_custkey", "c_name", F.coalesce("n", F.lit(0)).alias("n")
    )


@query("A06_having", f"""
SELECT o_custkey, {sql_total('o_totalprice')} AS total FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1
HAVING sum({sql_units('o_totalprice')}) > 200000000 AND count(*) >= 5""")
def _(t):
    return (
        t.orders.filter("o_orderstatus <> 'P'").groupBy("o_custkey")
        .agg(M.total("o_totalprice").alias("total"), n_rows().alias("n")).filter("total > 2000000 AND n >= 5").drop("n")
    )


@query("A07_filter_clause", f"""
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, {sql_total('o_totalprice').replace('BIGINT)) AS', 'BIGINT)) FILTER (WHERE o_totalprice > 250000) AS')} AS big_total
FROM orders GROUP BY 1""")
def _(t):
    t.register("orders")
    return t.spark.sql("""
        SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
               sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (WHERE o_totalprice > 250000) / 100D AS big_total
        FROM orders GROUP BY o_orderpriority""")


@query("A08_conditional_aggregation", f"""
SELECT o_custkey, {sql_total("CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END")} AS finished,
 {sql_total("CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END")} AS open FROM orders GROUP BY 1""")
def _(t):
    def amount(status):
        return M.total(F.when(F.col("o_orderstatus") == status, F.col("o_totalprice")).otherwise(0.0))

    return t.orders.groupBy("o_custkey").agg(amount("F").alias("finished"), amount("O").alias("open"))


@query("A09_pivot", """
SELECT date_trunc('month', o_orderdate)::DATE AS m, nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS "F",
 nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS "O", nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS "P" FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy(month("o_orderdate").alias("m")).pivot("o_orderstatus", ["F", "O", "P"]).agg(n_rows())


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def column_name(v):
    return v.lower().replace("-", "_").replace(" ", "_")


@query("A10_generated_pivot", "SELECT o_custkey, " + ", ".join(
    sql_total(f"CASE WHEN o_orderpriority = '{p}' THEN o_totalprice ELSE 0 END") + f" AS amount_{column_name(p)}" for p in PRIORITIES
) + " FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(*[
        M.total(F.when(F.col("o_orderpriority") == p, F.col("o_totalprice")).otherwise(0.0)).alias(f"amount_{column_name(p)}")
        for p in PRIORITIES
    ])


SETS = f"{sql_total('o_totalprice')} AS total, count(*) AS n FROM orders GROUP BY "


@query("A11_rollup", f"SELECT o_orderstatus, o_orderpriority, {SETS} ROLLUP (o_orderstatus, o_orderpriority)")
def _(t):
    return t.orders.rollup("o_orderstatus", "o_orderpriority").agg(M.total("o_totalprice").alias("total"), n_rows().alias("n"))


@query("A12_cube", f"SELECT o_orderstatus, o_orderpriority, {SETS} CUBE (o_orderstatus, o_orderpriority)")
def _(t):
    return t.orders.cube("o_orderstatus", "o_orderpriority").agg(M.total("o_totalprice").alias("total"), n_rows().alias("n"))


@query("A13_grouping_sets", f"SELECT o_orderstatus, o_orderpriority, {SETS} GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def _(t):
    s, p = F.col("o_orderstatus"), F.col("o_orderpriority")
    return t.orders.groupingSets([[s], [p], []], s, p).agg(M.total("o_totalprice").alias("total"), n_rows().alias("n"))


@query("A14_grouping_labels", f"""
SELECT CASE WHEN grouping(o_orderstatus) = 1 THEN 'all statuses' ELSE o_orderstatus END AS status,
 CASE WHEN grouping(o_orderpriority) = 1 THEN 'all priorities' ELSE o_orderpriority END AS priority,
 grouping_id(o_orderstatus, o_orderpriority) AS gid, {SETS} ROLLUP (o_orderstatus, o_orderpriority)""")
def _(t):
    g = t.orders.rollup("o_orderstatus", "o_orderpriority").agg(
        F.grouping("o_orderstatus").alias("gs"), F.grouping("o_orderpriority").alias("gp"), F.grouping_id().alias("gid"),
        M.total("o_totalprice").alias("total"), n_rows().alias("n"),
    )
    return g.select(
        F.when(F.col("gs") == 1, "all statuses").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("gp") == 1, "all priorities").otherwise(F.col("o_orderpriority")).alias("priority"), "gid", "total", "n",
    )


@query("A15_exact_distinct", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1""")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts")
    )


@query("A16_approximate_distinct", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, true AS within_bound FROM lineitem GROUP BY 1""")
def _(t):
    # a sketch passes if it is within four standard errors of the exact count
    error = 0.0081
    sketch = t.lineitem.groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey", error).alias("about"))
    exact = t.lineitem.select("l_returnflag", "l_orderkey").distinct().groupBy("l_returnflag").agg(n_rows().alias("orders"))
    close = F.abs(F.col("about") - F.col("orders")) <= 4 * error * F.col("orders") + 1
    return sketch.join(exact, "l_returnflag").select("l_returnflag", "orders", close.alias("within_bound"))


@query("A17_mergeable_sketches", """
SELECT date_trunc('month', ts)::DATE AS m, count(DISTINCT ts::DATE) AS days, count(DISTINCT user_id) AS users, true AS within_bound FROM events GROUP BY 1""")
def _(t):
    daily = t.events.groupBy(day("ts").alias("d")).agg(F.hll_sketch_agg("user_id", 14).alias("sketch"))
    merged = daily.groupBy(month("d").alias("m")).agg(n_rows().alias("days"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"))
    seen = t.events.select(month("ts").alias("m"), "user_id").distinct().groupBy("m").agg(n_rows().alias("users"))
    close = F.abs(F.col("about") - F.col("users")) <= 0.04 * F.col("users") + 1
    return merged.join(seen, "m").select("m", "days", "users", close.alias("within_bound"))


@query("A18_ordered_string_aggregation", """
SELECT p_type, string_agg(p_brand, ', ' ORDER BY p_brand) AS brands FROM (SELECT DISTINCT p_type, p_brand FROM part) GROUP BY 1""")
def _(t):
    # distinct first: a list holds a value set, never the rows of a group
    t.part.select("p_type", "p_brand").distinct().createOrReplaceTempView("type_brands")
    return t.spark.sql("""
        SELECT p_type, listagg(p_brand, ', ') WITHIN GROUP (ORDER BY p_brand) AS brands FROM type_brands GROUP BY p_type""")


@query("A19_ordered_array_aggregation", """
WITH m AS (SELECT o_orderpriority, date_trunc('year', o_orderdate)::DATE AS y, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, array_to_string(array_agg(n ORDER BY y), ',') AS orders_by_year FROM m GROUP BY 1""")
def _(t):
    m = t.orders.groupBy("o_orderpriority", F.trunc(day("o_orderdate"), "year").alias("y")).agg(n_rows().alias("n"))
    ordered = F.sort_array(F.collect_list(F.struct("y", "n")))
    return m.groupBy("o_orderpriority").agg(
        F.array_join(F.transform(ordered, lambda x: x["n"].cast("string")), ",").alias("orders_by_year")
    )


@query("A20_json_array_per_group", """
WITH c AS (SELECT o_custkey, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey, CAST(to_json(list({'priority': priority, 'n': n} ORDER BY priority)) AS VARCHAR) AS doc FROM c GROUP BY 1""")
def _(t):
    c = t.orders.groupBy("o_custkey", F.col("o_orderpriority").alias("priority")).agg(n_rows().alias("n"))
    return c.groupBy("o_custkey").agg(F.to_json(F.sort_array(F.collect_list(F.struct("priority", "n")))).alias("doc"))


@query("A21_percentiles", """
SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS p50, quantile_cont(l_extendedprice, 0.9) AS p90,
 quantile_disc(l_extendedprice, 0.5) AS p50_disc, quantile_disc(l_extendedprice, 0.9) AS p90_disc FROM lineitem GROUP BY 1""")
def _(t):
    return exact_quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"p50": 0.5, "p90": 0.9}, 500.0)


@query("A22_median_by_position", f"WITH {EMP} SELECT dept_id, median(salary) AS median_salary FROM emp GROUP BY 1")
def _(t):
    pos = value_positions(employees(t), ["dept_id"], "salary", 200.0)
    end = F.col("before") + F.col("ties")
    lo, hi = F.expr("(total + 1) div 2"), F.expr("(total + 2) div 2")

    def at(r):
        return F.max(F.when((r > F.col("before")) & (r <= end), F.col("salary")))

    return pos.groupBy("dept_id").agg(((at(lo) + at(hi)) / 2).alias("median_salary"))


@query("A23_mode_with_ties", """
SELECT l_quantity, freq FROM (SELECT l_quantity, count(*) AS freq, rank() OVER (ORDER BY count(*) DESC) AS r FROM lineitem GROUP BY 1) WHERE r = 1""")
def _(t):
    freq = t.lineitem.groupBy("l_quantity").agg(n_rows().alias("freq"))
    return freq.filter(F.col("freq") == freq.agg(F.max("freq")).scalar())


@query("A24_second_highest", sql_tagged(
    subquery="SELECT max(o_totalprice) AS x FROM orders WHERE o_totalprice < (SELECT max(o_totalprice) FROM orders)",
    distinct_offset="SELECT DISTINCT o_totalprice AS x FROM orders ORDER BY 1 DESC LIMIT 1 OFFSET 1"))
def _(t):
    p = t.orders.select(F.col("o_totalprice").alias("x"))
    below = p.filter(F.col("x") < p.agg(F.max("x")).scalar()).agg(F.max("x").alias("x"))
    return tagged(subquery=below, distinct_offset=p.distinct().orderBy(F.col("x").desc()).offset(1).limit(1))


@query("A25_top_row_by_join_back", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders JOIN (SELECT o_custkey AS k, max(o_totalprice) AS m FROM orders GROUP BY 1)
ON o_custkey = k AND o_totalprice = m""")
def _(t):
    top = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("o_totalprice"))
    return t.orders.join(top, ["o_custkey", "o_totalprice"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("A26_percent_of_total", f"""
WITH s AS (SELECT c_mktsegment, {sql_total('o_totalprice')} AS x FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT c_mktsegment, x, x * 100e0 / (SELECT {sql_total('x')} FROM s) AS pct FROM s""")
def _(t):
    s = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment").agg(M.total("o_totalprice").alias("x"))
    )
    # one row per segment from here on
    return s.select("c_mktsegment", "x", (F.col("x") * 100.0 / M.total_over("x", Window.partitionBy())).alias("pct"))


@query("A27_mean_of_means", f"""
WITH g AS (SELECT o_custkey, {sql_total('o_totalprice')} AS total, count(*) AS n FROM orders GROUP BY 1)
SELECT {sql_total('total')} / sum(n) AS overall_mean, round(avg(total / n), 4) AS mean_of_means FROM g""")
def _(t):
    g = t.orders.groupBy("o_custkey").agg(M.total("o_totalprice").alias("total"), n_rows().alias("n"))
    return g.agg(
        (M.total("total") / F.sum("n")).alias("overall_mean"), F.round(F.avg(F.col("total") / F.col("n")), 4).alias("mean_of_means")
    )


SQL_A28 = "SELECT o_orderstatus, CAST(sum(o_custkey) AS BIGINT) AS s, count(o_orderkey) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1"


@query("A28_two_stage_salted", SQL_A28)
def _(t):
    return A.two_stage(
        t.orders, ["o_orderstatus"], F.col("o_orderkey"),
        {"s": ("sum", "o_custkey"), "n": ("count", "o_orderkey"), "lo": ("min", "o_totalprice"), "hi": ("max", "o_totalprice")},
    )


@query("A29_star_rollup", f"""
SELECT p_type, year(l_shipdate)::INTEGER AS y, quarter(l_shipdate)::INTEGER AS q, {sql_total('l_extendedprice')} AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""")
def _(t):
    # summed per part and quarter before the dimension is joined
    li = t.lineitem.groupBy("l_partkey", F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q")).agg(
        F.sum(M.units("l_extendedprice")).alias("u")
    )
    return (
        li.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type", "y", "q")
        .agg((F.sum("u") / 100.0).alias("revenue"))
    )


@query("A30_monthly_brand_revenue", f"""
SELECT date_trunc('month', o_orderdate)::DATE AS month, p_brand, count(DISTINCT o_orderkey) AS orders, {sql_total('l_quantity')} AS units,
 {sql_total('l_extendedprice')} AS revenue, {sql_mean('l_extendedprice')} AS mean_line, max(l_extendedprice) AS max_line
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE o_orderstatus <> 'P' GROUP BY 1, 2""")
def _(t):
    o = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", month("o_orderdate").alias("month"))
    # collapsing to one row per order and brand turns the distinct count into a plain count
    per_order = (
        t.lineitem.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey", "p_brand")
        .agg(
            F.sum(M.units("l_quantity")).alias("q"), F.sum(M.units("l_extendedprice")).alias("x"),
            n_rows().alias("n"), F.max("l_extendedprice").alias("hi"),
        )
    )
    return (
        per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("month", "p_brand")
        .agg(
            n_rows().alias("orders"), (F.sum("q") / 100.0).alias("units"), (F.sum("x") / 100.0).alias("revenue"),
            (F.sum("x") / 100.0 / F.sum("n")).alias("mean_line"), F.max("hi").alias("max_line"),
        )
        .orderBy(F.col("month").desc(), F.col("revenue").desc(), "p_brand")
    )


SQL_TOKENS = r"""tok AS (SELECT doc_id, lower(w) AS w FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \n]+')) AS w FROM documents) WHERE w <> '')"""


def tokens(t):
    return t.spread("documents").select("doc_id", F.explode(F.split("text", r"[ \n]+")).alias("w")).filter("w <> ''").select(
        "doc_id", F.lower("w").alias("w")
    )


@query("A31_frequency_table", f"""
WITH {SQL_TOKENS}, f AS (SELECT w, count(*) AS n FROM tok GROUP BY 1)
SELECT w, n, 'top' AS form FROM (SELECT * FROM f ORDER BY n DESC, w LIMIT 20)
UNION ALL SELECT NULL, count(*), 'duplicates' FROM f WHERE n > 1 UNION ALL SELECT NULL, count(*), 'singletons' FROM f WHERE n = 1""")
def _(t):
    f = tokens(t).groupBy("w").agg(n_rows().alias("n"))
    counts = f.agg(F.count_if(F.col("n") > 1).alias("duplicates"), F.count_if(F.col("n") == 1).alias("singletons"))
    return tagged(top=f.orderBy(F.col("n").desc(), "w").limit(20)).unionByName(
        counts.unpivot([], ["duplicates", "singletons"], "form", "n").withColumn("w", F.lit(None).cast("string"))
    )


@query("A32_column_average", f"SELECT {sql_mean('nullif(value, 0.01)')} AS mean_value, count(nullif(value, 0.01)) AS n FROM events")
def _(t):
    lines = t.events.select("event_id", F.nullif(F.col("value"), F.lit(0.01)).alias("value"))
    back = round_trip(lines, "csv", "with_header", header=True)
    return back.agg(M.mean("value").alias("mean_value"), F.count("value").alias("n"))


@query("A33_activity_bitmaps", """
WITH a AS (SELECT DISTINCT user_id FROM events WHERE ts::DATE = (SELECT min(ts)::DATE FROM events)),
b AS (SELECT DISTINCT user_id FROM events WHERE ts::DATE = (SELECT max(ts)::DATE FROM events))
SELECT (SELECT count(*) FROM a) AS first_day, (SELECT count(*) FROM b) AS last_day,
 (SELECT count(*) FROM a WHERE user_id IN (SELECT user_id FROM b)) AS both_days,
 (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS either_day,
 (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) - (SELECT count(*) FROM a WHERE user_id IN (SELECT user_id FROM b)) AS one_day""")
def _(t):
    # one bitmap row per day and id range; AND and OR work range by range
    e = t.events.select(day("ts").alias("d"), "user_id")
    bounds = e.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    maps = e.filter((F.col("d") == lo) | (F.col("d") == hi)).groupBy(
        F.when(F.col("d") == lo, "first_day").otherwise("last_day").alias("d"), F.expr("bitmap_bucket_number(user_id)").alias("b")
    ).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(user_id))").alias("m"))
    per_range = maps.groupBy("b").agg(
        F.expr("bitmap_count(bitmap_or_agg(m))").alias("either"),
        F.expr("CASE WHEN count(*) = 2 THEN bitmap_count(bitmap_and_agg(m)) ELSE 0 END").alias("both"),
        F.sum(F.expr("CASE WHEN d = 'first_day' THEN bitmap_count(m) ELSE 0 END")).alias("a"),
        F.sum(F.expr("CASE WHEN d = 'last_day' THEN bitmap_count(m) ELSE 0 END")).alias("z"),
    )
    return per_range.agg(
        F.sum("a").alias("first_day"), F.sum("z").alias("last_day"), F.sum("both").alias("both_days"),
        F.sum("either").alias("either_day"), (F.sum("either") - F.sum("both")).alias("one_day"),
    )


@query("A34_leaderboard", f"""
WITH s AS (SELECT user_id, {sql_total('value')} AS score FROM events GROUP BY 1)
SELECT user_id, score, rank() OVER (ORDER BY score DESC) AS place, (SELECT count(*) FROM s WHERE score BETWEEN 500 AND 900) AS in_range FROM s""")
def _(t):
    s = t.events.groupBy("user_id").agg(M.total("value").alias("score"))
    in_range = s.filter(F.col("score").between(500, 900)).agg(n_rows()).scalar()
    places = value_positions(s, [], "score", 10.0, descending=True).select("score", (F.col("before") + 1).alias("place"))
    return s.join(places, "score").select("user_id", "score", "place", in_range.alias("in_range"))


@query("A35_weighted_scored_sets", f"""
WITH a AS (SELECT user_id AS m, {sql_total('value')} AS s FROM events WHERE event_type = 'purchase' GROUP BY 1),
b AS (SELECT user_id AS m, {sql_total('value')} AS s FROM events WHERE event_type = 'signup' GROUP BY 1),
u AS (SELECT m, s * 2 AS s FROM a UNION ALL SELECT m, s * 3 FROM b)
SELECT m, {sql_total('s')} AS sum_score, min(s) AS min_score, max(s) AS max_score, count(*) = 2 AS in_both FROM u GROUP BY 1""")
def _(t):
    def scored(kind, weight):
        s = t.events.filter(F.col("event_type") == kind).groupBy(F.col("user_id").alias("m")).agg(M.total("value").alias("s"))
        return s.withColumn("s", F.col("s") * weight)

    u = scored("purchase", 2).unionByName(scored("signup", 3))
    return u.groupBy("m").agg(
        M.total("s").alias("sum_score"), F.min("s").alias("min_score"), F.max("s").alias("max_score"), (n_rows() == 2).alias("in_both")
    )


# made-up USD per million tokens: (input, output)
PRICES = {"large": (3.10, 9.30), "small": (0.20, 0.75), "light": (0.35, 1.40)}
DEFAULT_MODEL = "small"


@query("A36_cost_rollup", f"""
WITH p(model, pin, pout) AS (VALUES ('large', 310, 930), ('small', 20, 75), ('light', 35, 140)),
c AS (SELECT conv_id, CASE conv_id % 4 WHEN 0 THEN 'large' WHEN 1 THEN 'small' WHEN 2 THEN 'light' ELSE 'unknown' END AS model,
  len(text) AS n, role FROM conversations),
k AS (SELECT conv_id, n * CASE WHEN role = 'assistant' THEN coalesce(p.pout, 75) ELSE coalesce(p.pin, 20) END AS units FROM c LEFT JOIN p USING (model)),
u AS (SELECT conv_id, count(*) AS requests, CAST(sum(units) AS BIGINT) / 1e8 AS cost FROM k GROUP BY 1)
SELECT conv_id, requests, cost, cost < 0.005 AS within_limit, (SELECT CAST(sum(units) AS BIGINT) / 1e8 FROM k) AS global_cost FROM u
ORDER BY cost DESC, conv_id LIMIT 10""")
def _(t):
    prices = t.spark.createDataFrame(
        [(m, round(i * 100), round(o * 100)) for m, (i, o) in PRICES.items()], "model string, pin bigint, pout bigint"
    )
    kind = F.col("conv_id") % 4
    default_in, default_out = (round(x * 100) for x in PRICES[DEFAULT_MODEL])
    calls = t.conversations.select(
        "conv_id", F.when(kind == 0, "large").when(kind == 1, "small").when(kind == 2, "light").otherwise("unknown").alias("model"),
        F.length("text").alias("n"), "role",
    ).join(F.broadcast(prices), "model", "left")
    price = F.when(F.col("role") == "assistant", F.coalesce("pout", F.lit(default_out))).otherwise(F.coalesce("pin", F.lit(default_in)))
    per_user = calls.groupBy("conv_id").agg(n_rows().alias("requests"), F.sum(F.col("n") * price).alias("units"))
    whole = per_user.agg(F.sum("units") / 1e8).scalar()
    return (
        per_user.select("conv_id", "requests", (F.col("units") / 1e8).alias("cost"))
        .select("*", (F.col("cost") < 0.005).alias("within_limit"), whole.alias("global_cost"))
        .orderBy(F.col("cost").desc(), "conv_id").limit(10)
    )


@query("A37_churned", """
SELECT o_custkey, max(o_orderdate)::DATE AS last_order FROM orders GROUP BY 1 HAVING max(o_orderdate)::DATE < DATE '2001-08-01' - 180""")
def _(t):
    as_of = "2001-08-01"
    last = t.orders.groupBy("o_custkey").agg(F.max(day("o_orderdate")).alias("last_order"))
    return last.filter(F.col("last_order") < F.date_sub(F.lit(as_of).cast("date"), 180))


@query("A38_retention", """
WITH a AS (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate)::DATE AS m FROM orders),
t AS (SELECT m, count(*) AS total FROM a GROUP BY 1),
r AS (SELECT a.m AS m, count(*) AS kept FROM a JOIN a b ON a.o_custkey = b.o_custkey AND b.m = a.m + INTERVAL 1 MONTH GROUP BY 1)
SELECT t.m AS m, total, coalesce(kept, 0) AS kept, coalesce(kept, 0) * 100e0 / total AS rate FROM t LEFT JOIN r ON t.m = r.m""")
def _(t):
    # each customer-month marks itself and the month before it; no self join of the activity
    active = t.orders.select("o_custkey", month("o_orderdate").alias("m")).distinct()
    marks = active.select("o_custkey", "m", F.lit(1).alias("now"), F.lit(0).alias("next")).unionByName(
        active.select("o_custkey", F.add_months("m", -1).alias("m"), F.lit(0).alias("now"), F.lit(1).alias("next"))
    )
    both = marks.groupBy("o_custkey", "m").agg(F.max("now").alias("now"), F.max("next").alias("next")).filter("now = 1")
    return both.groupBy("m").agg(
        n_rows().alias("total"), F.sum("next").alias("kept"), (F.sum("next") * 100.0 / n_rows()).alias("rate")
    )


@query("A39_peak_concurrency", """
WITH s AS (SELECT ts AS a, ts + to_microseconds(CAST(round(value * 100) AS BIGINT) * 600000) AS b FROM events),
e AS (SELECT a AS at_time, 1 AS d FROM s UNION ALL SELECT b, -1 FROM s)
SELECT max(c) AS peak FROM (SELECT CAST(sum(d) OVER (ORDER BY at_time, d ROWS UNBOUNDED PRECEDING) AS BIGINT) AS c FROM e)""")
def _(t):
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    s = t.events.select(start.alias("a"), (start + M.units("value") * 600000).alias("b"))
    # steps at one instant collapse: ends count first, so only the rise after them matters
    steps = (
        s.select(F.col("a").alias("x"), F.lit(1).alias("d")).union(s.select(F.col("b"), F.lit(-1)))
        .groupBy("x").agg(F.sum("d").alias("d")).withColumn("b", F.floor(F.col("x") / 60000000))
    )
    run = running_totals(steps, [], [F.col("x").asc()], "b", {"c": F.col("d")})
    return run.agg(F.max("c").alias("peak"))


@query("A40_order_statistics", f"""
SELECT o_custkey, count(*) AS total_orders, {sql_total('o_totalprice')} AS lifetime_value, {sql_mean('o_totalprice')} AS mean_value,
 min(o_orderdate)::DATE AS first_order, max(o_orderdate)::DATE AS last_order FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        n_rows().alias("total_orders"), M.total("o_totalprice").alias("lifetime_value"), M.mean("o_totalprice").alias("mean_value"),
        F.min(day("o_orderdate")).alias("first_order"), F.max(day("o_orderdate")).alias("last_order"),
    )


@query("A41_majority_vote", """
WITH c AS (SELECT user_id, event_type AS label, count(*) AS k FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY k DESC, label) AS rn, sum(k) OVER (PARTITION BY user_id) AS n FROM c)
SELECT user_id, label, k / n AS confidence, CASE WHEN k / n < 0.6 THEN 'HUMAN_REVIEW' ELSE label END AS decision FROM r WHERE rn = 1""")
def _(t):
    return A.majority_vote(t.events, "user_id", "event_type", 0.6)


@query("A42_accuracy_per_strategy", """
WITH d AS (SELECT text, n_chars, quality FROM documents JOIN labels USING (doc_id)),
p AS (SELECT 'length' AS strategy, n_chars > 1500 AS yes, quality FROM d UNION ALL
 SELECT 'first_word', CASE WHEN contains(lower(text), 'the ') THEN true WHEN contains(lower(text), 'der ') THEN false ELSE true END, quality FROM d)
SELECT strategy, count(*) AS n, count(*) FILTER (WHERE yes = (quality = 1)) AS correct, count(*) FILTER (WHERE yes = (quality = 1)) / count(*) AS accuracy FROM p GROUP BY 1""")
def _(t):
    d = t.documents.join(t.labels, "doc_id")
    low = F.lower("text")
    strategies = {
        "length": F.col("n_chars") > 1500,
        "first_word": F.when(low.contains("the "), True).when(low.contains("der "), False).otherwise(True),
    }
    calls = F.array(*[F.struct(F.lit(k).alias("strategy"), v.alias("yes")) for k, v in strategies.items()])
    p = d.select("quality", F.inline(calls))
    right = F.count_if(F.col("yes") == (F.col("quality") == 1))
    return p.groupBy("strategy").agg(n_rows().alias("n"), right.alias("correct"), (right / n_rows()).alias("accuracy"))


@query("A43_criteria_average", """
WITH s AS (SELECT source, quality * 5 AS a, (1 - toxic) * 5 AS b, CASE WHEN n_chars < 2000 THEN 5 ELSE 2 END AS c FROM documents JOIN labels USING (doc_id)),
r AS (SELECT source, round((a + b + c) / 3, 2) AS average FROM s)
SELECT source, count(*) AS n, count(*) FILTER (WHERE average >= 4) AS passed, max(average) AS best FROM r GROUP BY 1""")
def _(t):
    d = t.documents.join(t.labels, "doc_id")
    a, b = F.col("quality") * 5, (1 - F.col("toxic")) * 5
    c = F.when(F.col("n_chars") < 2000, 5).otherwise(2)
    r = d.select("source", F.round((a + b + c) / 3, 2).alias("average"))
    return r.groupBy("source").agg(
        n_rows().alias("n"), F.count_if(F.col("average") >= 4).alias("passed"), F.max("average").alias("best")
    )


PROFILED = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@query("A44_column_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", (SELECT count(*) FROM orders) AS "rows", (SELECT count(*) FROM orders WHERE {c} IS NULL) AS nulls,
    (SELECT count(DISTINCT {c}) FROM orders) AS distinct_values, (SELECT max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY {c})) AS top_count""" for c in PROFILED))
def _(t):
    return A.column_profile(t.orders, PROFILED)


@query("A45_functional_dependency", " UNION ALL ".join(
    f"""SELECT '{a}' AS pair, count(*) AS keys, count(*) FILTER (WHERE n > 1) AS violations, count(*) FILTER (WHERE n = 1) / count(*) AS strength
    FROM (SELECT {a}, count(DISTINCT {b}) AS n FROM {tab} GROUP BY 1)""" for a, b, tab in
    [("o_orderkey", "o_custkey", "orders"), ("o_custkey", "o_orderpriority", "orders"), ("p_name", "p_brand", "part")]))
def _(t):
    frames = [(t.orders, "o_orderkey", "o_custkey"), (t.orders, "o_custkey", "o_orderpriority"), (t.part, "p_name", "p_brand")]
    out = [A.functional_dependency(df, a, b).withColumn("pair", F.lit(a)) for df, a, b in frames]
    return reduce(DataFrame.unionByName, out)


@query("A46_lossless_decomposition", """
WITH r AS (SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders),
j AS (SELECT * FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM r) JOIN (SELECT DISTINCT o_custkey, o_orderpriority FROM r) USING (o_custkey))
SELECT (SELECT count(*) FROM r) AS "rows", (SELECT count(*) FROM j) AS rejoined, (SELECT count(*) FROM j) - (SELECT count(*) FROM r) AS spurious,
 (SELECT count(*) FROM j) = (SELECT count(*) FROM r) AS lossless""")
def _(t):
    return A.decomposition_check(t.orders, "o_custkey", "o_orderstatus", "o_orderpriority")


@query("A47_shard_balance", f"""
WITH s AS (SELECT {S.sql_hash_bucket('c_custkey', 8)} AS shard, count(*) AS n FROM customer GROUP BY 1)
SELECT shard, n, n / (SELECT sum(n) FROM s) AS share, (SELECT max(n) FROM s) / (SELECT avg(n) FROM s) AS max_over_mean FROM s""")
def _(t):
    s = t.customer.groupBy(S.hash_bucket(F.col("c_custkey"), 8).alias("shard")).agg(n_rows().alias("n"))
    all_shards = Window.partitionBy()  # one row per shard
    return s.select(
        "shard", "n", (F.col("n") / F.sum("n").over(all_shards)).alias("share"),
        (F.max("n").over(all_shards) / F.avg("n").over(all_shards)).alias("max_over_mean"),
    )


@query("A48_moved_keys", """
WITH k AS (SELECT o_custkey, ('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8))::BIGINT AS h, count(*) AS n FROM orders GROUP BY 1)
SELECT '8 to 9' AS change, count(*) AS keys, count(*) FILTER (WHERE h % 8 <> h % 9) AS moved, coalesce(CAST(sum(n) FILTER (WHERE h % 8 <> h % 9) AS BIGINT), 0) AS moved_rows FROM k
UNION ALL SELECT '8 to 16', count(*), count(*) FILTER (WHERE h % 8 <> h % 16), coalesce(CAST(sum(n) FILTER (WHERE h % 8 <> h % 16) AS BIGINT), 0) FROM k""")
def _(t):
    # what a table rewrite would move if the number of buckets changed: all but a few at one more, half at double
    rows = t.orders.groupBy("o_custkey").agg(n_rows().alias("n")).withColumn("h", S.hash_bucket(F.col("o_custkey"), 2**32))
    change = F.inline(F.array(*[F.struct(F.lit(f"8 to {to}").alias("change"), (F.col("h") % 8 != F.col("h") % to).alias("moves")) for to in (9, 16)]))
    return rows.select("n", change).groupBy("change").agg(
        n_rows().alias("keys"), F.count_if("moves").alias("moved"), F.coalesce(F.sum(F.when(F.col("moves"), F.col("n"))), F.lit(0)).alias("moved_rows")
    )


@query("A49_grouped_collectors", f"""
WITH b AS (SELECT p_type, p_brand, count(*) AS n, sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS u, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY 1, 2)
SELECT p_type, string_agg(p_brand, ',' ORDER BY p_brand) AS brands, CAST(sum(n) AS BIGINT) AS n, CAST(sum(u) AS BIGINT) / 1e2 AS total,
 CAST(sum(u) AS BIGINT) / 1e2 / sum(n) AS mean, min(lo) AS lo, max(hi) AS hi FROM b GROUP BY 1""")
def _(t):
    b = t.part.groupBy("p_type", "p_brand").agg(
        n_rows().alias("n"), F.sum(M.units("p_retailprice")).alias("u"), F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi")
    )
    return b.groupBy("p_type").agg(
        F.array_join(F.sort_array(F.collect_list("p_brand")), ",").alias("brands"), F.sum("n").alias("n"),
        (F.sum("u") / 100.0).alias("total"), (F.sum("u") / 100.0 / F.sum("n")).alias("mean"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )


@query("A50_groups_above_overall_mean", f"""
SELECT p_brand, {sql_mean('p_retailprice')} AS mean FROM part GROUP BY 1
HAVING {sql_mean('p_retailprice')} > (SELECT {sql_mean('p_retailprice')} FROM part)""")
def _(t):
    overall = t.part.agg(M.mean("p_retailprice")).scalar()
    return t.part.groupBy("p_brand").agg(M.mean("p_retailprice").alias("mean")).filter(F.col("mean") > overall)


@query("A51_run_efficiency", r"""
SELECT conv_id, count(*) FILTER (WHERE role <> 'system') AS steps, CAST(sum(len(text)) AS BIGINT) AS chars,
 CASE WHEN count(*) FILTER (WHERE role <> 'system') = 0 THEN 0 ELSE greatest(0, least(1, 3 / count(*) FILTER (WHERE role <> 'system'))) END AS efficiency
FROM conversations GROUP BY 1""")
def _(t):
    g = t.conversations.groupBy("conv_id").agg(
        F.count_if(F.col("role") != "system").alias("steps"), F.sum(F.length("text")).alias("chars")
    )
    ratio = F.lit(3) / F.nullif(F.col("steps"), F.lit(0))
    return g.select(
        "conv_id", "steps", "chars",
        F.when(F.col("steps") == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ratio))).alias("efficiency"),
    )


@query("A52_pairwise_verdicts", """
WITH p AS (SELECT a.source AS ma, b.source AS mb, CASE WHEN a.n_chars >= b.n_chars THEN 'A' ELSE 'B' END AS fwd,
  CASE WHEN b.n_chars % 1000 >= a.n_chars % 1000 THEN 'A' ELSE 'B' END AS rev FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1),
w AS (SELECT ma, mb, CASE WHEN fwd = 'A' AND rev = 'B' THEN ma WHEN fwd = 'B' AND rev = 'A' THEN mb END AS winner FROM p),
m AS (SELECT ma AS model, CASE WHEN winner = ma AND ma <> mb THEN 1 ELSE 0 END AS win FROM w UNION ALL SELECT mb, CASE WHEN winner = mb AND ma <> mb THEN 1 ELSE 0 END FROM w)
SELECT model, count(*) AS games, CAST(sum(win) AS BIGINT) AS wins, sum(win) / count(*) AS win_rate FROM m GROUP BY 1""")
def _(t):
    d = t.documents.select("doc_id", "source", "n_chars")
    a, b = d.alias("a"), d.alias("b")
    p = a.join(b, F.col("b.doc_id") == F.col("a.doc_id") + 1).select(
        F.col("a.source").alias("ma"), F.col("b.source").alias("mb"),
        F.when(F.col("a.n_chars") >= F.col("b.n_chars"), "A").otherwise("B").alias("fwd"),
        F.when(F.col("b.n_chars") % 1000 >= F.col("a.n_chars") % 1000, "A").otherwise("B").alias("rev"),
    )
    # the reverse game shows the second answer first, so agreement means opposite letters
    winner = F.when(F.expr("fwd = 'A' AND rev = 'B'"), F.col("ma")).when(F.expr("fwd = 'B' AND rev = 'A'"), F.col("mb"))
    w = p.withColumn("winner", winner)

    def side(c):
        won = (F.col("winner") == F.col(c)) & (F.col("ma") != F.col("mb"))
        return F.struct(F.col(c).alias("model"), F.coalesce(won, F.lit(False)).cast("int").alias("win"))

    m = w.select(F.inline(F.array(side("ma"), side("mb"))))
    return m.groupBy("model").agg(n_rows().alias("games"), F.sum("win").alias("wins"), (F.sum("win") / n_rows()).alias("win_rate"))
