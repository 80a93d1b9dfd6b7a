"""Joins (J01-J35)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkweave.functions import money as M
from sparkweave.operators import joins as J
from sparkweave.plans.common import EMP, day, employees, n_rows, sql_mean, sql_tagged, sql_total, tagged
from sparkweave.plans.registry import query
from sparkweave.session import new_folder


@query("J01_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def _(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("J02_inner_extra_condition", """
SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 AND o_totalprice > c_acctbal * 20""")
def _(t):
    on = (
        (F.col("o_custkey") == F.col("c_custkey"))
        & (F.col("c_acctbal") > 0)
        & (F.col("o_totalprice") > F.col("c_acctbal") * 20)
    )
    return t.orders.join(t.customer, on).select("o_orderkey", "c_name")


@query("J03_left", """
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey""")
def _(t):
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "o_orderkey")


@query("J04_right_and_left_rewrite", sql_tagged(
    right="SELECT c_custkey, o_orderkey FROM orders RIGHT JOIN customer ON o_custkey = c_custkey",
    left="SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey"))
def _(t):
    on = F.col("o_custkey") == F.col("c_custkey")
    return tagged(
        right=t.orders.join(t.customer, on, "right").select("c_custkey", "o_orderkey"),
        left=t.customer.join(t.orders, on, "left").select("c_custkey", "o_orderkey"),
    )


def year_totals(t, year, name):
    return (
        t.orders.filter((F.col("o_orderdate") >= f"{year}-01-01") & (F.col("o_orderdate") < f"{year + 1}-01-01"))
        .groupBy("o_custkey")
        .agg(M.total("o_totalprice").alias(name))
    )


def sql_year(year, name):
    return f"""SELECT o_custkey, {sql_total('o_totalprice')} AS {name} FROM orders
      WHERE o_orderdate >= '{year}-01-01' AND o_orderdate < '{year + 1}-01-01' GROUP BY 1"""


@query("J05_full", f"""
SELECT o_custkey, y96, y97 FROM ({sql_year(1996, 'y96')}) a FULL JOIN ({sql_year(1997, 'y97')}) b USING (o_custkey)""")
def _(t):
    return year_totals(t, 1996, "y96").join(year_totals(t, 1997, "y97"), "o_custkey", "full")


@query("J06_cross_reference_tables", "SELECT n_name, r_name FROM nation CROSS JOIN region")
def _(t):
    return J.block_join(t.nation.select("n_name"), t.region.select("r_name"))


@query("J07_date_spine_fill", f"""
WITH b AS (SELECT min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders),
spine AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d FROM b),
st AS (SELECT DISTINCT o_orderstatus FROM orders),
a AS (SELECT o_orderdate::DATE AS d, o_orderstatus, count(*) AS n, {sql_total('o_totalprice')} AS revenue FROM orders GROUP BY 1, 2)
SELECT spine.d AS d, st.o_orderstatus, coalesce(n, 0) AS n, coalesce(revenue, 0) AS revenue
FROM spine CROSS JOIN st LEFT JOIN a ON a.d = spine.d AND a.o_orderstatus = st.o_orderstatus""")
def _(t):
    daily = t.orders.groupBy(day("o_orderdate").alias("d"), "o_orderstatus").agg(
        n_rows().alias("n"), M.total("o_totalprice").alias("revenue")
    )
    # the statuses are a small set, so one row carries the whole grid
    grid = (
        t.orders.agg(
            F.min(day("o_orderdate")).alias("lo"), F.max(day("o_orderdate")).alias("hi"),
            F.collect_set("o_orderstatus").alias("states"),
        )
        .select(F.explode(F.sequence("lo", "hi")).alias("d"), "states")
        .select("d", F.explode("states").alias("o_orderstatus"))
    )
    return grid.join(daily, ["d", "o_orderstatus"], "left").fillna(0, ["n"]).fillna(0.0, ["revenue"])


@query("J08_self_join_parent", f"WITH {EMP} SELECT e.emp_id, e.name, m.name AS manager FROM emp e LEFT JOIN emp m ON e.manager_id = m.emp_id")
def _(t):
    e, m = employees(t).alias("e"), employees(t).alias("m")
    return e.join(m, F.col("e.manager_id") == F.col("m.emp_id"), "left").select(
        "e.emp_id", "e.name", F.col("m.name").alias("manager")
    )


@query("J09_child_exceeds_parent", f"""
WITH {EMP} SELECT e.emp_id, e.salary, m.salary AS manager_salary FROM emp e JOIN emp m ON e.manager_id = m.emp_id WHERE e.salary > m.salary""")
def _(t):
    e, m = employees(t).alias("e"), employees(t).alias("m")
    return (
        e.join(m, F.col("e.manager_id") == F.col("m.emp_id"))
        .filter(F.col("e.salary") > F.col("m.salary"))
        .select("e.emp_id", "e.salary", F.col("m.salary").alias("manager_salary"))
    )


@query("J10_pairs_same_manager", f"""
WITH {EMP} SELECT a.emp_id AS emp1, b.emp_id AS emp2, a.manager_id FROM emp a JOIN emp b
ON a.manager_id = b.manager_id AND a.emp_id < b.emp_id""")
def _(t):
    # the manager is a third of the key, so a manager has three reports at most and no group grows
    a, b = employees(t).alias("a"), employees(t).alias("b")
    on = (F.col("a.manager_id") == F.col("b.manager_id")) & (F.col("a.emp_id") < F.col("b.emp_id"))
    return a.join(b, on).select(F.col("a.emp_id").alias("emp1"), F.col("b.emp_id").alias("emp2"), "a.manager_id")


def urgent(t):
    return t.orders.filter(F.col("o_orderpriority") == "1-URGENT")


SQL_URGENT = "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'"


@query("J11_anti_left_is_null", f"""
SELECT c_custkey, c_name FROM customer LEFT JOIN ({SQL_URGENT}) o ON o_custkey = c_custkey WHERE o_orderkey IS NULL""")
def _(t):
    return t.customer.join(urgent(t), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_name")


@query("J12_not_exists", f"SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM ({SQL_URGENT}) WHERE o_custkey = c_custkey)")
def _(t):
    t.register("customer")
    urgent(t).createOrReplaceTempView("urgent_orders")
    return t.spark.sql(
        "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM urgent_orders WHERE o_custkey = c_custkey)"
    )


@query("J13_not_in_null_trap", f"""
WITH u AS (SELECT CASE WHEN o_totalprice < 400000 THEN o_custkey END AS k FROM ({SQL_URGENT}))
SELECT 'with_null' AS form, count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT k FROM u)
UNION ALL SELECT 'without_null', count(*) FROM customer WHERE c_custkey NOT IN (SELECT k FROM u WHERE k IS NOT NULL)""")
def _(t):
    u = urgent(t).select(F.when(F.col("o_totalprice") < 400000, F.col("o_custkey")).alias("k"))
    return tagged(
        with_null=J.not_in(t.customer, "c_custkey", u, "k").agg(n_rows().alias("n")),
        without_null=J.not_in(t.customer, "c_custkey", u.filter("k IS NOT NULL"), "k").agg(n_rows().alias("n")),
    )


@query("J14_semi", f"SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM ({SQL_URGENT}) WHERE o_custkey = c_custkey)")
def _(t):
    return t.customer.join(urgent(t), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_name")


@query("J15_fan_out_guard", f"""
WITH l AS (SELECT l_orderkey, {sql_total('l_extendedprice')} AS lines_total FROM lineitem GROUP BY 1)
SELECT o_orderstatus, count(*) AS orders, {sql_total('o_totalprice')} AS order_total, {sql_total('lines_total')} AS line_total
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1""")
def _(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(M.total("l_extendedprice").alias("lines_total"))
    return (
        t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("o_orderstatus")
        .agg(n_rows().alias("orders"), M.total("o_totalprice").alias("order_total"), M.total("lines_total").alias("line_total"))
    )


@query("J16_expression_keys", """
SELECT o_orderkey, l_linenumber, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND year(o_orderdate) = year(l_shipdate)""")
def _(t):
    on = (F.col("o_orderkey") == F.col("l_orderkey")) & (F.year("o_orderdate") == F.year("l_shipdate"))
    return t.orders.join(t.lineitem, on).select("o_orderkey", "l_linenumber", "l_partkey")


@query("J17_theta_join_counts", """
SELECT p_partkey, count(s_suppkey) AS cheaper FROM part LEFT JOIN supplier ON p_retailprice > s_acctbal GROUP BY 1""")
def _(t):
    points = t.supplier.select(F.col("s_acctbal").alias("x"))
    asks = t.part.select("p_partkey", F.col("p_retailprice").alias("x"))
    return J.counts_below(points, asks, [], "x", 100.0, False, "cheaper").select("p_partkey", "cheaper")


TIERS = [(0, 50000, "bronze"), (50000, 150000, "silver"), (150000, 300000, "gold"), (300000, 500000, "platinum")]
SQL_TIERS = ", ".join(f"({a}, {b}, '{c}')" for a, b, c in TIERS)


@query("J18_tier_lookup", f"""
SELECT o_orderkey, tier FROM orders LEFT JOIN (VALUES {SQL_TIERS}) v(lo, hi, tier) ON o_totalprice >= lo AND o_totalprice < hi""")
def _(t):
    tiers = t.spark.createDataFrame(TIERS, "lo int, hi int, tier string")
    return J.range_lookup(t.orders, tiers, "o_totalprice", "lo", "hi", 50000.0).select("o_orderkey", "tier")


@query("J19_interval_overlap", """
WITH a AS (SELECT o_custkey, o_orderkey, epoch(o_orderdate)::BIGINT // 86400 AS s,
  epoch(o_orderdate)::BIGINT // 86400 + 20 + o_orderkey % 60 AS e FROM orders)
SELECT x.o_custkey, x.o_orderkey, x.s, x.e, count(y.o_orderkey) AS overlaps
FROM a x LEFT JOIN a y ON x.o_custkey = y.o_custkey AND x.o_orderkey <> y.o_orderkey AND x.s < y.e AND x.e > y.s GROUP BY 1, 2, 3, 4""")
def _(t):
    start = F.unix_date(day("o_orderdate")).cast("bigint")
    spans = t.orders.select("o_custkey", "o_orderkey", start.alias("s"), (start + 20 + F.col("o_orderkey") % 60).alias("e"))
    return J.overlap_counts(spans, ["o_custkey"], "s", "e", 90.0)


@query("J20_as_of_version", """
WITH v AS (SELECT o_custkey, o_orderdate::DATE AS valid_from, max(o_orderpriority) AS tier FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
f AS (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS d FROM orders WHERE o_orderstatus = 'O')
SELECT f.o_custkey, f.o_orderkey, f.d, v.valid_from, v.tier FROM f ASOF LEFT JOIN v ON f.o_custkey = v.o_custkey AND f.d >= v.valid_from""")
def _(t):
    o = t.orders.withColumn("d", day("o_orderdate"))
    versions = (
        o.filter("o_orderstatus = 'F'").groupBy("o_custkey", F.col("d").alias("valid_from")).agg(F.max("o_orderpriority").alias("tier"))
    )
    facts = o.filter("o_orderstatus = 'O'").select("o_custkey", "o_orderkey", "d")
    return J.asof_join(facts, versions, ["o_custkey"], "d", "valid_from", ["valid_from", "tier"], lambda c: F.trunc(c, "month"))


@query("J21_case_folded_key", """
WITH s AS (SELECT lower(c_mktsegment) AS seg, count(*) AS n FROM customer GROUP BY 1)
SELECT c_custkey, n FROM customer JOIN s ON upper(c_mktsegment) = upper(seg)""")
def _(t):
    s = t.customer.groupBy(F.lower("c_mktsegment").alias("seg")).agg(n_rows().alias("n")).withColumn("k", F.upper("seg"))
    return t.customer.withColumn("k", F.upper("c_mktsegment")).join(s, "k").select("c_custkey", "n")


@query("J22_star_join", f"""
SELECT n_name, r_name, count(*) AS n, {sql_total('l_extendedprice')} AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def _(t):
    dims = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    # revenue is summed per order before it meets the wider tables
    lines = t.lineitem.groupBy("l_orderkey").agg(n_rows().alias("n"), M.total("l_extendedprice").alias("x"))
    return (
        lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.sum("n").alias("n"), M.total("x").alias("revenue"))
        .join(dims, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_name", "r_name", "n", "revenue")
    )


@query("J23_using", """
SELECT k, n_orders, segment FROM (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1)
JOIN (SELECT c_custkey AS k, c_mktsegment AS segment FROM customer) USING (k)""")
def _(t):
    o = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(n_rows().alias("n_orders"))
    return o.join(t.customer.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment")), "k")


@query("J24_reconciliation", f"""
SELECT o_custkey, CASE WHEN y96 IS NULL THEN 'only_1997' ELSE 'only_1996' END AS side, coalesce(y96, y97) AS amount
FROM ({sql_year(1996, 'y96')}) a FULL JOIN ({sql_year(1997, 'y97')}) b USING (o_custkey) WHERE y96 IS NULL OR y97 IS NULL""")
def _(t):
    both = year_totals(t, 1996, "y96").join(year_totals(t, 1997, "y97"), "o_custkey", "full")
    return both.filter("y96 IS NULL OR y97 IS NULL").select(
        "o_custkey",
        F.when(F.col("y96").isNull(), "only_1997").otherwise("only_1996").alias("side"),
        F.coalesce("y96", "y97").alias("amount"),
    )


@query("J25_on_versus_where", sql_tagged(
    on_clause="SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 450000",
    where_clause="SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE o_totalprice > 450000"))
def _(t):
    on = F.col("o_custkey") == F.col("c_custkey")
    big = F.col("o_totalprice") > 450000
    return tagged(
        on_clause=t.customer.join(t.orders, on & big, "left").select("c_custkey", "o_orderkey"),
        where_clause=t.customer.join(t.orders, on, "left").filter(big).select("c_custkey", "o_orderkey"),
    )


@query("J26_pre_aggregate_join", f"""
WITH totals AS (SELECT o_custkey, {sql_total('o_totalprice')} AS total, count(*) AS n FROM orders GROUP BY 1)
SELECT c_name, total, n FROM totals JOIN customer ON c_custkey = o_custkey WHERE total > 3000000""")
def _(t):
    totals = t.orders.groupBy("o_custkey").agg(M.total("o_totalprice").alias("total"), n_rows().alias("n"))
    return (
        totals.filter("total > 3000000").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_name", "total", "n")
    )


@query("J27_both_periods", """
SELECT o_custkey FROM orders WHERE o_orderdate >= '1996-01-01' AND o_orderdate < '1996-02-01'
INTERSECT SELECT o_custkey FROM orders WHERE o_orderdate >= '1996-02-01' AND o_orderdate < '1996-03-01'""")
def _(t):
    def period(a, b):
        return t.orders.filter((F.col("o_orderdate") >= a) & (F.col("o_orderdate") < b)).select("o_custkey")

    return period("1996-01-01", "1996-02-01").intersect(period("1996-02-01", "1996-03-01"))


@query("J28_batched_child_fetch", """
SELECT c_custkey, count(o_orderkey) AS orders, max(o_totalprice) AS largest FROM customer LEFT JOIN orders ON o_custkey = c_custkey
WHERE c_mktsegment = 'BUILDING' GROUP BY 1""")
def _(t):
    parents = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    children = t.orders.groupBy("o_custkey").agg(n_rows().alias("orders"), F.max("o_totalprice").alias("largest"))
    return (
        parents.join(children, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), "largest")
    )


BY_NATION = """SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""
BY_SEGMENT = f"""SELECT c_mktsegment, count(*) AS n, {sql_total('o_totalprice')} AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""


@query("J29_broadcast_join", BY_NATION)
def _(t):
    return (
        t.customer.join(J.broadcast_checked(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name").agg(n_rows().alias("n"))
    )


def hinted(t, hint):
    joined = t.orders.join(t.customer.hint(hint), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(n_rows().alias("n"), M.total("o_totalprice").alias("total"))


@query("J30_shuffled_hash_join", BY_SEGMENT)
def _(t):
    return hinted(t, "shuffle_hash")


@query("J31_sort_merge_join", BY_SEGMENT)
def _(t):
    return hinted(t, "merge")


@query("J32_nested_loop_reference_tables", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey < r_regionkey")
def _(t):
    return J.block_join(t.nation, t.region, F.col("n_regionkey") < F.col("r_regionkey")).select("n_name", "r_name")


@query("J33_co_located_join", f"""
SELECT o_orderstatus, count(*) AS n, {sql_total('l_extendedprice')} AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def _(t):
    from sparkweave.sources.layout import bucketed

    folder = new_folder(t.spark, "bucketed")
    o = bucketed(t.orders.select("o_orderkey", "o_orderstatus"), f"{folder}/o", ["o_orderkey"], 8)
    li = bucketed(t.lineitem.select("l_orderkey", "l_extendedprice"), f"{folder}/l", ["l_orderkey"], 8)
    return (
        li.join(o.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_orderstatus").agg(n_rows().alias("n"), M.total("l_extendedprice").alias("revenue"))
    )


@query("J34_salted_join", """
WITH skewed AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS k FROM orders)
SELECT c_mktsegment, count(*) AS n FROM skewed JOIN customer ON k = c_custkey GROUP BY 1""")
def _(t):
    skewed = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey")).alias("k"))
    small = t.customer.select(F.col("c_custkey").alias("k"), "c_mktsegment")
    return J.salted_join(skewed, small, ["k"], F.col("o_orderkey")).groupBy("c_mktsegment").agg(n_rows().alias("n"))


SQL_TIMELINE = """
WITH f AS (SELECT DISTINCT user_id AS reader, CAST(json_extract_string(props, '$.k') AS BIGINT) AS author FROM events),
p AS (SELECT user_id AS author, event_id AS post_id, ts AS posted FROM events WHERE event_type = 'purchase')
SELECT reader, author, post_id, position, 'push' AS form FROM (SELECT reader, f.author AS author, post_id,
  row_number() OVER (PARTITION BY reader ORDER BY posted DESC, post_id DESC) AS position FROM f JOIN p ON f.author = p.author) WHERE position <= 5"""


@query("J35_home_timeline", f"WITH r AS ({SQL_TIMELINE}) SELECT * FROM r UNION ALL SELECT * REPLACE ('hybrid' AS form) FROM r")
def _(t):
    follows = t.events.select(
        F.col("user_id").alias("reader"), F.get_json_object("props", "$.k").cast("bigint").alias("author")
    ).distinct()
    posts = t.events.filter("event_type = 'purchase'").select(
        F.col("user_id").alias("author"), F.col("event_id").alias("post_id"), F.col("ts").alias("at")
    )
    return tagged(
        push=J.latest_per_author_timeline(follows, posts, 5).drop("at"),
        hybrid=J.latest_per_author_timeline(follows, posts, 5, heavy_followers=60).drop("at"),
    )
