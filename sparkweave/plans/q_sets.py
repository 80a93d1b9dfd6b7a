"""Set operations, subqueries, recursion (Q01-Q18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkweave.functions import money as M
from sparkweave.operators import graphs as G
from sparkweave.plans.common import EMP, day, employees, month, n_rows, sql_mean, sql_tagged, sql_total, tagged
from sparkweave.plans.registry import query
from sparkweave.sources.files import stored


@query("Q01_union", sql_tagged(
    all_rows="SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier",
    distinct_rows="SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier"))
def _(t):
    a, b = t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k"))
    return tagged(all_rows=a.union(b), distinct_rows=a.union(b).distinct())


@query("Q02_intersect", sql_tagged(
    once="SELECT l_partkey % 1000 AS k, l_linenumber AS n FROM lineitem INTERSECT SELECT l_suppkey % 1000, l_linenumber FROM lineitem",
    counted="SELECT l_partkey % 1000 AS k, l_linenumber AS n FROM lineitem INTERSECT ALL SELECT l_suppkey % 1000, l_linenumber FROM lineitem"))
def _(t):
    a = t.lineitem.select((F.col("l_partkey") % 1000).alias("k"), F.col("l_linenumber").alias("n"))
    b = t.lineitem.select((F.col("l_suppkey") % 1000).alias("k"), F.col("l_linenumber").alias("n"))
    # equal rows collapse to counts first, so a hot row is one row in the join
    ca = a.groupBy("k", "n").agg(n_rows().alias("ca"))
    cb = b.groupBy("k", "n").agg(n_rows().alias("cb"))
    counted = ca.join(cb, ["k", "n"]).select(
        "k", "n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("ca", "cb"))).alias("_i")
    ).drop("_i")
    return tagged(once=a.intersect(b), counted=counted)


SQL_MEMBERS = """a AS (SELECT DISTINCT c_nationkey AS g, o_custkey AS m FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate < '1996-01-01'),
b AS (SELECT DISTINCT c_nationkey AS g, o_custkey AS m FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate >= '2001-01-01')"""


@query("Q03_member_sets", f"""
WITH {SQL_MEMBERS}, u AS (SELECT g, m, max(ia) AS ia, max(ib) AS ib FROM
  (SELECT g, m, 1 AS ia, 0 AS ib FROM a UNION ALL SELECT g, m, 0, 1 FROM b) GROUP BY 1, 2)
SELECT g, count(*) AS n_union, count(*) FILTER (WHERE ia = 1 AND ib = 1) AS n_inter, count(*) FILTER (WHERE ia = 1 AND ib = 0) AS n_diff FROM u GROUP BY g""")
def _(t):
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    flags = o.groupBy(F.col("c_nationkey").alias("g"), F.col("o_custkey").alias("m")).agg(
        F.bool_or(F.col("o_orderdate") < "1996-01-01").alias("ia"),
        F.bool_or(F.col("o_orderdate") >= "2001-01-01").alias("ib"),
    )
    return (
        flags.filter("ia OR ib").groupBy("g")
        .agg(n_rows().alias("n_union"), F.count_if(F.expr("ia AND ib")).alias("n_inter"), F.count_if(F.expr("ia AND NOT ib")).alias("n_diff"))
    )


@query("Q04_or_as_union", """
SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' OR o_totalprice > 400000""")
def _(t):
    a = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_orderkey")
    return a.union(t.orders.filter("o_totalprice > 400000").select("o_orderkey")).distinct()


@query("Q05_scalar_subquery", f"""
WITH {EMP} SELECT emp_id, salary, (SELECT max(salary) FROM emp) - salary AS gap,
  (SELECT count(*) FROM orders WHERE o_custkey = emp_id) AS orders FROM emp WHERE salary < (SELECT max(salary) FROM emp)""")
def _(t):
    e = employees(t)
    top = e.agg(F.max("salary")).scalar()
    counts = t.orders.groupBy("o_custkey").agg(n_rows().alias("orders"))
    return (
        e.filter(F.col("salary") < top)
        .join(counts, F.col("emp_id") == F.col("o_custkey"), "left")
        .select("emp_id", "salary", (top - F.col("salary")).alias("gap"), F.coalesce("orders", F.lit(0)).alias("orders"))
    )


SQL_ABOVE = f"""SELECT emp_id, dept_id, salary FROM emp e WHERE salary > (SELECT {sql_mean('salary')} FROM emp x WHERE x.dept_id = e.dept_id)"""


@query("Q06_correlated_and_joined", f"WITH {EMP}, r AS ({SQL_ABOVE}) " + sql_tagged(correlated="SELECT * FROM r", joined="SELECT * FROM r"))
def _(t):
    e = employees(t)
    e.createOrReplaceTempView("emp")
    correlated = t.spark.sql("""
        SELECT emp_id, dept_id, salary FROM emp e WHERE salary >
          (SELECT sum(CAST(round(salary * 100) AS BIGINT)) / 100D / count(salary) FROM emp x WHERE x.dept_id = e.dept_id)""")
    # same as a partition average, but without moving whole departments into one task
    means = e.groupBy("dept_id").agg(M.mean("salary").alias("m"))
    joined = e.join(means, "dept_id").filter("salary > m").select("emp_id", "dept_id", "salary")
    return tagged(correlated=correlated, joined=joined)


@query("Q07_greater_any", f"""
WITH {EMP} SELECT emp_id, salary FROM emp WHERE salary > ANY (SELECT salary FROM emp WHERE dept_id = 3)""")
def _(t):
    e = employees(t)
    return e.filter(F.col("salary") > e.filter("dept_id = 3").agg(F.min("salary")).scalar()).select("emp_id", "salary")


@query("Q08_greater_all", sql_tagged(
    some="SELECT c_custkey FROM customer WHERE c_acctbal > ALL (SELECT c_acctbal FROM customer WHERE c_nationkey = 3)",
    empty_set="SELECT c_custkey FROM customer WHERE c_acctbal > ALL (SELECT c_acctbal FROM customer WHERE c_nationkey = -1)"))
def _(t):
    def greater_all(other):
        facts = other.agg(
            F.max("c_acctbal").alias("hi"), n_rows().alias("n"), F.count_if(F.col("c_acctbal").isNull()).alias("nulls")
        )
        hi, n, nulls = (facts.select(x).scalar() for x in ("hi", "n", "nulls"))
        return t.customer.filter((n == 0) | ((nulls == 0) & (F.col("c_acctbal") > hi))).select("c_custkey")

    return tagged(
        some=greater_all(t.customer.filter("c_nationkey = 3")),
        empty_set=greater_all(t.customer.filter("c_nationkey = -1")),
    )


@query("Q09_derived_table", f"""
SELECT d.c_nationkey AS c_nationkey, d.mean_balance AS mean_balance FROM
  (SELECT c_nationkey, {sql_mean('c_acctbal')} AS mean_balance FROM customer GROUP BY 1) d WHERE d.mean_balance > 4500""")
def _(t):
    d = t.customer.groupBy("c_nationkey").agg(M.mean("c_acctbal").alias("mean_balance"))
    return d.filter("mean_balance > 4500")


@query("Q10_chained_ctes", f"""
WITH spend AS (SELECT o_custkey, {sql_total('o_totalprice')} AS total FROM orders GROUP BY 1),
big AS (SELECT * FROM spend WHERE total > 2500000), named AS (SELECT c_nationkey, total FROM big JOIN customer ON c_custkey = o_custkey)
SELECT c_nationkey, count(*) AS n, max(total) AS best FROM named GROUP BY 1""")
def _(t):
    t.register("orders", "customer")
    return t.spark.sql("""
        WITH spend AS (SELECT o_custkey, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100D AS total FROM orders GROUP BY 1),
        big AS (SELECT * FROM spend WHERE total > 2500000),
        named AS (SELECT c_nationkey, total FROM big JOIN customer ON c_custkey = o_custkey)
        SELECT c_nationkey, count(*) AS n, max(total) AS best FROM named GROUP BY 1""")


@query("Q11_reused_cte", f"""
WITH spend AS MATERIALIZED (SELECT o_custkey, {sql_total('o_totalprice')} AS total FROM orders GROUP BY 1)
SELECT o_custkey, total, CASE WHEN total > (SELECT {sql_mean('total')} FROM spend) THEN 'above' ELSE 'below' END AS side FROM spend""")
def _(t):
    # the aggregate is written once to the shared folder and read twice

    spend = stored(t.orders.groupBy("o_custkey").agg(M.total("o_totalprice").alias("total")), "spend")
    mean = spend.agg(M.mean("total")).scalar()
    return spend.select("o_custkey", "total", F.when(F.col("total") > mean, "above").otherwise("below").alias("side"))


@query("Q12_recursive_hierarchy", f"""
WITH RECURSIVE {EMP}, tree AS (SELECT emp_id, 1 AS level, CAST(emp_id AS VARCHAR) AS path FROM emp WHERE manager_id IS NULL
 UNION ALL SELECT e.emp_id, level + 1, path || ' > ' || e.emp_id FROM emp e JOIN tree ON e.manager_id = tree.emp_id) SELECT * FROM tree""")
def _(t):
    return G.hierarchy(employees(t), "emp_id", "manager_id", "emp_id")


@query("Q13_recursive_dates", """
WITH RECURSIVE b AS (SELECT min(ts)::DATE AS lo, max(ts)::DATE AS hi FROM events),
d AS (SELECT lo AS day, hi FROM b UNION ALL SELECT (day + INTERVAL 1 DAY)::DATE, hi FROM d WHERE day < hi)
SELECT day, count(event_id) AS n FROM d LEFT JOIN events ON ts::DATE = day GROUP BY 1""")
def _(t):
    t.register("events")
    # the recursion runs over dates only; events are counted per day before they join
    return t.spark.sql("""
        WITH RECURSIVE b AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events),
        d(day, hi) AS (SELECT lo, hi FROM b UNION ALL SELECT date_add(day, 1), hi FROM d WHERE day < hi),
        n AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
        SELECT d.day, coalesce(n.n, 0) AS n FROM d LEFT JOIN n ON n.day = d.day""")


@query("Q14_graph_reach", """
WITH RECURSIVE m AS (SELECT max(p_partkey) + 1 AS n FROM part),
e AS (SELECT DISTINCT l_partkey AS src, (l_partkey + l_suppkey + l_linenumber) % n AS dst FROM lineitem, m),
r AS (SELECT (SELECT min(p_partkey) FROM part) AS node, 0 AS depth UNION SELECT dst, depth + 1 FROM r JOIN e ON src = node WHERE depth < 4)
SELECT node, min(depth) AS depth FROM r GROUP BY 1""")
def _(t):
    n = t.part.agg(F.max("p_partkey") + 1).scalar()
    edges = t.lineitem.select(
        F.col("l_partkey").alias("src"), ((F.col("l_partkey") + F.col("l_suppkey") + F.col("l_linenumber")) % n).alias("dst")
    ).distinct()
    return G.reach(edges, t.part.agg(F.min("p_partkey").alias("node")), 4)


SQL_CYCLE_EDGES = "m AS (SELECT count(*) AS n FROM supplier), e AS (SELECT DISTINCT s_suppkey AS src, (s_suppkey * k + 3) % n AS dst FROM supplier, m, (VALUES (7), (5)) v(k) WHERE s_suppkey % 4 = 0 OR k = 7)"


@query("Q15_cycle_guard", f"""
WITH RECURSIVE {SQL_CYCLE_EDGES},
ways(a, b) AS (SELECT src, dst FROM e UNION SELECT ways.a, e.dst FROM ways JOIN e ON e.src = ways.b),
loops AS (SELECT a AS node FROM ways WHERE a = b),
core AS (SELECT node FROM loops UNION SELECT x.b FROM ways x JOIN loops p ON p.node = x.a JOIN ways y ON y.a = x.b JOIN loops q ON q.node = y.b),
links AS (SELECT src AS a, dst AS b FROM e WHERE src IN (SELECT node FROM core) AND dst IN (SELECT node FROM core)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links), joined(node, goal) AS (SELECT node, node FROM core UNION SELECT j.node, b FROM joined j JOIN both_ways w ON w.a = j.goal),
first AS (SELECT node, min(goal) AS component FROM joined GROUP BY 1),
r AS (SELECT (SELECT min(s_suppkey) FROM supplier) AS node, 0 AS depth UNION SELECT dst, depth + 1 FROM r JOIN e ON src = node WHERE depth < 6), d AS (SELECT node, min(depth) AS depth FROM r GROUP BY 1)
SELECT s_suppkey AS node, depth, component IS NOT NULL AS cyclic, component FROM supplier LEFT JOIN d ON d.node = s_suppkey LEFT JOIN first f ON f.node = s_suppkey""")
def _(t):
    # a traversal that meets no node twice, and the nodes that a cycle can bring it back to
    n, key = t.supplier.agg(n_rows()).scalar(), F.col("s_suppkey")
    factors = F.when(key % 4 == 0, F.array(F.lit(7), F.lit(5))).otherwise(F.array(F.lit(7)))
    edges = stored(t.supplier.select(key.alias("src"), F.explode(factors).alias("k")).select("src", ((F.col("src") * F.col("k") + 3) % n).alias("dst")).distinct(), "edges")
    depth = G.reach(edges, t.supplier.agg(F.min("s_suppkey").alias("node")), 6)
    core = G.cyclic_core(edges)
    return t.supplier.select(key.alias("node")).join(depth, "node", "left").join(core, "node", "left").select(
        "node", "depth", F.col("component").isNotNull().alias("cyclic"), "component"
    )


@query("Q16_generate_series", """
WITH b AS (SELECT min(p_size) AS lo, max(p_size) AS hi FROM part), g AS (SELECT unnest(generate_series(lo, hi + 2, 3)) AS size FROM b)
SELECT size, count(p_partkey) AS n FROM g LEFT JOIN part ON p_size = size GROUP BY 1""")
def _(t):
    g = t.part.agg(F.min("p_size").alias("lo"), F.max("p_size").alias("hi")).select(
        F.explode(F.expr("sequence(CAST(lo AS BIGINT), CAST(hi + 2 AS BIGINT), 3L)")).alias("size")
    )
    n = t.part.groupBy(F.col("p_size").cast("bigint").alias("size")).agg(n_rows().alias("n"))
    return g.join(n, "size", "left").fillna(0, ["n"])


@query("Q17_relational_division", """
SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = (SELECT count(DISTINCT o_orderpriority) FROM orders)""")
def _(t):
    all_kinds = t.orders.agg(F.count_distinct("o_orderpriority")).scalar()
    per_customer = t.orders.groupBy("o_custkey").agg(F.count_distinct("o_orderpriority").alias("n"))
    return per_customer.filter(F.col("n") == all_kinds).select("o_custkey")


@query("Q18_unpivot", f"""
WITH w AS (SELECT o_custkey, {", ".join(f"CAST(count(*) FILTER (WHERE o_orderstatus = '{s}') AS BIGINT) AS n_{s.lower()}" for s in "FOP")} FROM orders GROUP BY 1)
SELECT o_custkey, status, n FROM w UNPIVOT (n FOR status IN (n_f, n_o, n_p))""")
def _(t):
    wide = t.orders.groupBy("o_custkey").agg(
        *[F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s.lower()}") for s in "FOP"]
    )
    return wide.unpivot(["o_custkey"], ["n_f", "n_o", "n_p"], "status", "n")
