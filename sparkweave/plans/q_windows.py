"""Window functions."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from sparkweave.functions import money as M
from sparkweave.operators import text_lines as L
from sparkweave.operators.aggregates import top_n_per_group
from sparkweave.operators.ordered import even_bins, number_rows, previous_of_key, running_totals, value_positions, with_neighbours
from sparkweave.plans.common import EMP, day, employees, month, n_rows, sql_mean, sql_tagged, sql_total, sql_units, tagged
from sparkweave.plans.registry import query

SALARY_BAND = 20.0


def by_salary():
    return [F.col("salary").desc(), F.col("emp_id").asc()]


def numbered(t):
    """Employees numbered per department by falling salary."""
    # half of a department may have one salary; bins are even, as ties are parted by the employee's id
    return number_rows(even_bins(employees(t), ["dept_id"], by_salary()), ["dept_id"], by_salary(), "_bin", "rn")


def orders_by_customer(t):
    return t.orders.select("o_custkey", "o_orderkey", "o_totalprice", day("o_orderdate").alias("d"))


def order_seq():
    return [F.col("d"), F.col("o_orderkey")]


def daily(t, *keys):
    return t.orders.groupBy(*keys, day("o_orderdate").alias("d")).agg(M.total("o_totalprice").alias("revenue"), n_rows().alias("n"))


def monthly(t):
    return t.orders.groupBy(month("o_orderdate").alias("m")).agg(M.total("o_totalprice").alias("revenue"))


SQL_DAILY = f"SELECT o_orderdate::DATE AS d, {sql_total('o_totalprice')} AS revenue, count(*) AS n FROM orders GROUP BY 1"
SQL_MONTHLY = f"SELECT date_trunc('month', o_orderdate)::DATE AS m, {sql_total('o_totalprice')} AS revenue FROM orders GROUP BY 1"


@query("W01_partition_average", f"""
WITH {EMP}, a AS (SELECT dept_id, {sql_mean('salary')} AS dept_mean FROM emp GROUP BY 1) SELECT emp_id, salary, dept_mean, salary - dept_mean AS gap FROM emp JOIN a USING (dept_id)""")
def _(t):
    e = employees(t)
    means = e.groupBy("dept_id").agg(M.mean("salary").alias("dept_mean"))
    return e.join(means, "dept_id").select("emp_id", "salary", "dept_mean", (F.col("salary") - F.col("dept_mean")).alias("gap"))


@query("W02_global_average", f"WITH {EMP} SELECT emp_id, salary, (SELECT {sql_mean('salary')} FROM emp) AS overall_mean FROM emp")
def _(t):
    e = employees(t)
    return e.select("emp_id", "salary", e.agg(M.mean("salary")).scalar().alias("overall_mean"))


KEYS_PER_BIN = 1 << 20


@query("W03_running_total_range", f"""
SELECT o_orderkey, CAST(sum({sql_units('o_totalprice')}) OVER (ORDER BY o_orderdate) AS BIGINT) / 1e2 AS running FROM orders""")
def _(t):
    # rows of one day move together, so the running total is taken over days
    days = daily(t).withColumn("running", M.total_over("revenue", Window.orderBy("d")))
    return t.orders.withColumn("d", day("o_orderdate")).join(days, "d").select("o_orderkey", "running")


@query("W04_running_total_rows", f"""
SELECT o_orderkey, CAST(sum({sql_units('o_totalprice')}) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) / 1e2 AS running FROM orders""")
def _(t):
    # a day of the whole table is cut further by key, in the order within the day
    o = orders_by_customer(t).withColumn("bin", F.struct("d", F.floor(F.col("o_orderkey") / KEYS_PER_BIN).alias("part")))
    run = running_totals(o, [], order_seq(), "bin", {"u": M.units("o_totalprice")})
    return run.select("o_orderkey", (F.col("u") / 100.0).alias("running"))


@query("W05_running_total_per_key", f"""
SELECT o_custkey, o_orderkey, CAST(sum({sql_units('o_totalprice')}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) / 1e2 AS running FROM orders""")
def _(t):
    run = running_totals(orders_by_customer(t), ["o_custkey"], order_seq(), "d", {"u": M.units("o_totalprice")})
    return run.select("o_custkey", "o_orderkey", (F.col("u") / 100.0).alias("running"))


@query("W06_row_number", f"WITH {EMP} SELECT dept_id, emp_id, row_number() OVER (PARTITION BY dept_id ORDER BY salary DESC, emp_id) AS rn FROM emp")
def _(t):
    return numbered(t).select("dept_id", "emp_id", "rn")


def ranked(t):
    pos = value_positions(employees(t), ["dept_id"], "salary", SALARY_BAND, descending=True)
    return employees(t).join(pos, ["dept_id", "salary"])


@query("W07_rank", f"WITH {EMP} SELECT dept_id, emp_id, rank() OVER (PARTITION BY dept_id ORDER BY salary DESC) AS rnk FROM emp")
def _(t):
    return ranked(t).select("dept_id", "emp_id", (F.col("before") + 1).alias("rnk"))


@query("W08_dense_rank", f"WITH {EMP} SELECT dept_id, emp_id, dense_rank() OVER (PARTITION BY dept_id ORDER BY salary DESC) AS rnk FROM emp")
def _(t):
    return ranked(t).select("dept_id", "emp_id", (F.col("dense_before") + 1).alias("rnk"))


@query("W09_ntile", f"WITH {EMP} SELECT dept_id, emp_id, ntile(4) OVER (PARTITION BY dept_id ORDER BY salary DESC, emp_id) AS quartile FROM emp")
def _(t):
    # the first (n mod 4) tiles hold one row more than the others
    tile = """CASE WHEN rn <= (rn_all % 4) * (rn_all div 4 + 1) THEN (rn - 1) div (rn_all div 4 + 1) + 1
              ELSE rn_all % 4 + (rn - 1 - (rn_all % 4) * (rn_all div 4 + 1)) div (rn_all div 4) + 1 END"""
    return numbered(t).select("dept_id", "emp_id", F.expr(tile).alias("quartile"))


@query("W10_percent_rank_cume_dist", f"""
WITH {EMP}, r AS (SELECT dept_id, emp_id, percent_rank() OVER (PARTITION BY dept_id ORDER BY salary DESC) AS pr, cume_dist() OVER (PARTITION BY dept_id ORDER BY salary DESC) AS cd FROM emp)
SELECT *, pr <= 0.25 AS top_quarter FROM r""")
def _(t):
    pr = F.when(F.col("total") > 1, F.col("before") / (F.col("total") - 1)).otherwise(0.0)
    return ranked(t).select(
        "dept_id", "emp_id", pr.alias("pr"), ((F.col("before") + F.col("ties")) / F.col("total")).alias("cd"),
        (pr <= 0.25).alias("top_quarter"),
    )


def blocks_of_orders(t, before, after):
    o = number_rows(orders_by_customer(t), ["o_custkey"], order_seq(), "d")
    return with_neighbours(o, ["o_custkey"], "rn", 1000, before, after)


def in_block():
    return Window.partitionBy("o_custkey", "_block").orderBy("rn")


@query("W11_lag_lead", """
SELECT o_custkey, o_orderkey, lag(o_totalprice, 2, 0) OVER w AS two_back, lead(o_totalprice) OVER w AS ahead FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def _(t):
    return (
        blocks_of_orders(t, 2, 1)
        .withColumns({"two_back": F.lag("o_totalprice", 2, 0.0).over(in_block()), "ahead": F.lead("o_totalprice").over(in_block())})
        .filter("_own").select("o_custkey", "o_orderkey", "two_back", "ahead")
    )


@query("W12_first_last_value", f"""
WITH {EMP} SELECT dept_id, emp_id, first_value(name) OVER w AS best, last_value(name) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS worst,
 last_value(name) OVER w AS default_frame FROM emp WINDOW w AS (PARTITION BY dept_id ORDER BY salary DESC, emp_id)""")
def _(t):
    e = employees(t)
    order = F.struct(-F.col("salary"), F.col("emp_id"))
    ends = e.groupBy("dept_id").agg(F.min_by("name", order).alias("best"), F.max_by("name", order).alias("worst"))
    # the default frame stops at the current row, whose own value is therefore the last
    return e.join(ends, "dept_id").select("dept_id", "emp_id", "best", "worst", F.col("name").alias("default_frame"))


@query("W13_nth_value", f"""
WITH {EMP} SELECT dept_id, emp_id, nth_value(salary, 2) OVER (PARTITION BY dept_id ORDER BY salary DESC, emp_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second FROM emp""")
def _(t):
    e = employees(t)
    second = top_n_per_group(e, ["dept_id"], by_salary(), 2).filter("rank = 2").select("dept_id", F.col("salary").alias("second"))
    return e.join(second, "dept_id", "left").select("dept_id", "emp_id", "second")


@query("W14_moving_average", f"""
SELECT o_custkey, o_orderkey, CAST(sum({sql_units('o_totalprice')}) OVER w AS BIGINT) / 1e2 / count(*) OVER w AS moving FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def _(t):
    w = in_block().rowsBetween(-2, 0)
    avg = M.total_over("o_totalprice", w) / n_rows().over(w)
    return blocks_of_orders(t, 2, 0).withColumn("moving", avg).filter("_own").select("o_custkey", "o_orderkey", "moving")


@query("W15_range_interval", f"""
SELECT d, CAST(sum({sql_units('revenue')}) OVER w AS BIGINT) / 1e2 AS week_total, CAST(sum(n) OVER w AS BIGINT) AS week_orders FROM ({SQL_DAILY})
WINDOW w AS (ORDER BY d RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""")
def _(t):
    daily(t).createOrReplaceTempView("daily_revenue")  # one row per calendar day
    return t.spark.sql("""
        SELECT d, sum(CAST(round(revenue * 100) AS BIGINT)) OVER w / 100D AS week_total, sum(n) OVER w AS week_orders FROM daily_revenue
        WINDOW w AS (ORDER BY d RANGE BETWEEN INTERVAL '6' DAY PRECEDING AND CURRENT ROW)""")


@query("W16_groups_frame", f"""
SELECT o_orderkey, CAST(sum({sql_units('o_totalprice')}) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW) AS BIGINT) / 1e2 AS peers FROM orders""")
def _(t):
    # a peer group is a day, so the frame runs over rows of the daily table
    w = Window.partitionBy("o_orderstatus").orderBy("d").rowsBetween(-1, 0)
    days = daily(t, "o_orderstatus").withColumn("peers", M.total_over("revenue", w))
    return t.orders.withColumn("d", day("o_orderdate")).join(days, ["o_orderstatus", "d"]).select("o_orderkey", "peers")


@query("W17_named_window", f"""
SELECT m, revenue, rank() OVER w AS place, CAST(sum({sql_units('revenue')}) OVER w AS BIGINT) / 1e2 AS so_far FROM ({SQL_MONTHLY}) WINDOW w AS (ORDER BY m)""")
def _(t):
    monthly(t).createOrReplaceTempView("monthly_revenue")  # one row per month
    return t.spark.sql("""
        SELECT m, revenue, CAST(rank() OVER w AS BIGINT) AS place, sum(CAST(round(revenue * 100) AS BIGINT)) OVER w / 100D AS so_far
        FROM monthly_revenue WINDOW w AS (ORDER BY m)""")


@query("W18_filter_on_window", f"""
WITH {EMP}, r AS (SELECT *, rank() OVER (PARTITION BY dept_id ORDER BY salary DESC) AS rnk FROM emp) SELECT dept_id, emp_id, salary, rnk FROM r WHERE rnk <= 3""")
def _(t):
    w = Window.partitionBy("dept_id").orderBy(F.col("salary").desc())
    return employees(t).withColumn("rnk", F.rank().over(w)).filter("rnk <= 3").select("dept_id", "emp_id", "salary", "rnk")


@query("W19_top_n_per_group", f"""
SELECT p_brand, p_partkey, p_retailprice, r AS rank FROM (SELECT *, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC) AS r FROM part) WHERE r <= 2""")
def _(t):
    return top_n_per_group(t.part, ["p_brand"], [F.col("p_retailprice").desc()], 2, F.dense_rank).select(
        "p_brand", "p_partkey", "p_retailprice", "rank"
    )


@query("W20_top_n_aggregated", f"""
WITH s AS (SELECT p_brand, p_partkey, {sql_total('l_extendedprice')} AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT p_brand, p_partkey, revenue, r AS rank FROM (SELECT *, dense_rank() OVER (PARTITION BY p_brand ORDER BY revenue DESC) AS r FROM s) WHERE r <= 2""")
def _(t):
    s = t.lineitem.groupBy("l_partkey").agg(M.total("l_extendedprice").alias("revenue"))
    s = s.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", "p_partkey", "revenue")
    return top_n_per_group(s, ["p_brand"], [F.col("revenue").desc()], 2, F.dense_rank)


@query("W21_aggregate_in_window", f"""
SELECT o_orderstatus, y, CAST(sum(sum(u)) OVER (PARTITION BY o_orderstatus ORDER BY y) AS BIGINT) / 1e2 AS so_far
FROM (SELECT o_orderstatus, year(o_orderdate)::INTEGER AS y, {sql_units('o_totalprice')} AS u FROM orders) GROUP BY o_orderstatus, y""")
def _(t):
    t.register("orders")
    return t.spark.sql("""
        SELECT o_orderstatus, year(o_orderdate) AS y,
               sum(sum(CAST(round(o_totalprice * 100) AS BIGINT))) OVER (PARTITION BY o_orderstatus ORDER BY year(o_orderdate)) / 100D AS so_far
        FROM orders GROUP BY o_orderstatus, year(o_orderdate)""")


@query("W22_latest_row_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def _(t):
    latest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return top_n_per_group(t.orders, ["o_custkey"], latest, 1).select("o_custkey", "o_orderkey", "o_totalprice")


def growth(t):
    prev = F.lag("revenue").over(Window.orderBy("m"))  # one row per month
    return monthly(t).withColumn("prev", prev).withColumn("growth", (F.col("revenue") - F.col("prev")) * 100.0 / F.col("prev"))


@query("W23_monthly_growth", f"""
SELECT m, revenue, lag(revenue) OVER (ORDER BY m) AS prev, (revenue - lag(revenue) OVER (ORDER BY m)) * 100e0 / lag(revenue) OVER (ORDER BY m) AS growth FROM ({SQL_MONTHLY})""")
def _(t):
    return growth(t)


@query("W24_negative_growth", f"""
SELECT m, CASE WHEN revenue < lag(revenue) OVER (ORDER BY m) THEN 'down' WHEN lag(revenue) OVER (ORDER BY m) IS NULL THEN 'first' ELSE 'up' END AS trend FROM ({SQL_MONTHLY})""")
def _(t):
    trend = F.when(F.col("growth") < 0, "down").when(F.col("prev").isNull(), "first").otherwise("up")
    return growth(t).select("m", trend.alias("trend"))


def islands(active, keys, rank):
    """Runs of consecutive days; ``active`` holds each key and day once, so a group has a row per day at most."""
    w = Window.partitionBy(*keys).orderBy("d")
    grouped = active.withColumn("g", F.date_sub("d", rank().over(w)))
    return grouped.groupBy(*keys, "g").agg(F.min("d").alias("start"), F.max("d").alias("stop"), n_rows().alias("days")).drop("g")


SQL_ACTIVE = "SELECT DISTINCT user_id, ts::DATE AS d FROM events"


@query("W25_gaps_and_islands", f"""
SELECT user_id, min(d) AS start, max(d) AS stop, count(*) AS days FROM (SELECT *, d - CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS g FROM ({SQL_ACTIVE})) GROUP BY user_id, g""")
def _(t):
    active = t.events.select("user_id", day("ts").alias("d")).distinct()
    return islands(active, ["user_id"], F.row_number)


@query("W26_longest_streak", f"""
SELECT user_id, max(days) AS longest FROM (SELECT user_id, count(*) AS days FROM (SELECT *, d - CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS g FROM ({SQL_ACTIVE})) GROUP BY user_id, g) GROUP BY 1""")
def _(t):
    active = t.events.select("user_id", day("ts").alias("d")).distinct()
    return islands(active, ["user_id"], F.dense_rank).groupBy("user_id").agg(F.max("days").alias("longest"))


@query("W27_mean_days_between", """
SELECT o_custkey, avg(gap) AS mean_gap FROM (SELECT o_custkey, date_diff('day', lag(o_orderdate::DATE) OVER (PARTITION BY o_custkey ORDER BY o_orderdate), o_orderdate::DATE) AS gap FROM orders) GROUP BY 1""")
def _(t):
    # the gaps add up to last minus first, so no ordering is needed
    d = day("o_orderdate")
    return t.orders.groupBy("o_custkey").agg(
        F.when(n_rows() > 1, F.date_diff(F.max(d), F.min(d)) / (n_rows() - 1)).alias("mean_gap")
    )


@query("W28_fifo_depletion", """
WITH r AS (SELECT l_partkey, l_shipdate::DATE AS received, l_orderkey, l_linenumber, l_quantity::BIGINT AS qty, CAST(sum(l_quantity::BIGINT) OVER
 (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM lineitem)
SELECT l_partkey, received, l_orderkey, l_linenumber, qty, CASE WHEN upto <= 150 THEN qty ELSE 150 - (upto - qty) END AS taken FROM r WHERE upto - qty < 150""")
def _(t):
    target = 150
    b = t.lineitem.select(
        "l_partkey", day("l_shipdate").alias("received"), "l_orderkey", "l_linenumber", "l_extendedprice",
        F.col("l_quantity").cast("bigint").alias("qty"),
    )
    order = [F.col(c) for c in ("received", "l_orderkey", "l_linenumber", "qty", "l_extendedprice")]
    r = running_totals(b, ["l_partkey"], order, "received", {"upto": F.col("qty")})
    taken = F.when(F.col("upto") <= target, F.col("qty")).otherwise(target - (F.col("upto") - F.col("qty")))
    return r.filter(F.col("upto") - F.col("qty") < target).select(
        "l_partkey", "received", "l_orderkey", "l_linenumber", "qty", taken.alias("taken")
    )


SQL_LEDGER = f"""SELECT user_id, event_id, ts, CASE event_type WHEN 'purchase' THEN -1 WHEN 'signup' THEN 1 WHEN 'click' THEN 1 ELSE 0 END * {sql_units('value')} AS u FROM events"""


def ledger(t):
    sign = F.when(F.col("event_type") == "purchase", -1).when(F.col("event_type").isin("signup", "click"), 1).otherwise(0)
    return t.events.select("user_id", "event_id", "ts", (sign * M.units("value")).alias("u"), F.date_trunc("minute", "ts").alias("minute"))


@query("W29_account_statement", f"""
WITH l AS ({SQL_LEDGER}) SELECT user_id, event_id, u / 1e2 AS amount, CAST(sum(u) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) / 1e2 AS balance,
 (SELECT CAST(coalesce(sum(u), 0) AS BIGINT) / 1e2 FROM l x WHERE x.user_id = l.user_id AND x.ts <= TIMESTAMP '2024-01-15 12:00:00') AS balance_at FROM l""")
def _(t):
    at = F.col("ts") <= F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    run = running_totals(
        ledger(t), ["user_id"], [F.col("ts"), F.col("event_id")], "minute",
        {"bal": F.col("u"), "upto": F.when(at, F.col("u")).otherwise(0)},
    )
    return run.select(
        "user_id", "event_id", (F.col("u") / 100.0).alias("amount"), (F.col("bal") / 100.0).alias("balance"),
        (F.col("upto_all") / 100.0).alias("balance_at"),
    )


@query("W30_difference_from_previous", f"""
SELECT o_custkey, o_orderkey, o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS diff FROM orders""")
def _(t):
    p = previous_of_key(orders_by_customer(t), ["o_custkey"], order_seq(), "d", ["o_totalprice"])
    return p.select("o_custkey", "o_orderkey", (F.col("o_totalprice") - F.col("prev_o_totalprice")).alias("diff"))


SQL_LINES = """l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents)"""


@query("W31_context_lines", f"""
WITH {SQL_LINES}, h AS (SELECT *, regexp_matches(line, 'http|@') AS is_match FROM l),
c AS (SELECT *, max(is_match::INT) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS near,
 CAST(sum(is_match::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS BIGINT) AS k FROM h)
SELECT doc_id, line_no, is_match, is_match AND k <= 2 AS among_first FROM c WHERE near = 1""")
def _(t):
    lines = L.lines_of(t.spread("documents"), "text", "doc_id")
    near = L.with_context(lines, ["doc_id"], L.matches("line", "http|@"), 2, 1)
    first = top_n_per_group(near.filter("is_match"), ["doc_id"], [F.col("line_no")], 2).select(
        "doc_id", "line_no", F.lit(True).alias("among_first")
    )
    return near.join(first, ["doc_id", "line_no"], "left").select(
        "doc_id", "line_no", "is_match", F.coalesce("among_first", F.lit(False)).alias("among_first")
    )


@query("W32_between_markers", f"""
WITH {SQL_LINES}, f AS (SELECT *, regexp_matches(line, 'The|Der') AS s, regexp_matches(line, 'and|und') AS e FROM l),
g AS (SELECT *, sum(e::INT) OVER (PARTITION BY doc_id ORDER BY line_no) - e::INT AS k FROM f),
h AS (SELECT *, min(CASE WHEN s THEN line_no END) OVER (PARTITION BY doc_id, k) AS start_no FROM g)
SELECT doc_id, line_no, line FROM h WHERE line_no >= start_no""")
def _(t):
    lines = L.lines_of(t.spread("documents"), "text", "doc_id")
    return L.between_markers(lines, ["doc_id"], L.matches("line", "The|Der"), L.matches("line", "and|und")).drop("line_bin")
