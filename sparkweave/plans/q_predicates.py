"""Projection, filters, typing."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkweave.functions import scalars as S
from sparkweave.operators import text_lines as L
from sparkweave.plans.registry import query


@query("P01_projection", """
SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS total_cost, l_quantity AS units FROM lineitem""")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_quantity") * F.col("l_extendedprice")).alias("total_cost"),
        F.col("l_quantity").alias("units"),
    )


@query("P02_boolean_predicates", """
SELECT c_custkey, c_acctbal FROM customer
WHERE (c_acctbal > 7000 AND c_mktsegment = 'BUILDING') OR NOT (c_nationkey < 20)""")
def _(t):
    return t.customer.filter(
        ((F.col("c_acctbal") > 7000) & (F.col("c_mktsegment") == "BUILDING")) | ~(F.col("c_nationkey") < 20)
    ).select("c_custkey", "c_acctbal")


@query("P03_chained_filters", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'""")
def _(t):
    return (
        t.orders.filter(F.col("o_totalprice") > 100000)
        .filter(F.col("o_orderstatus") == "F")
        .select("o_orderkey", "o_totalprice")
    )


@query("P04_between", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 150000")
def _(t):
    return t.orders.filter(F.col("o_totalprice").between(100000, 150000)).select("o_orderkey", "o_totalprice")


@query("P05_in_list", "SELECT n_nationkey, n_name FROM nation WHERE n_name IN ('NATION_1', 'NATION_7', 'NATION_24')")
def _(t):
    return t.nation.filter(F.col("n_name").isin("NATION_1", "NATION_7", "NATION_24")).select("n_nationkey", "n_name")


@query("P06_like", """
SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%' OR p_name ILIKE '%RING' OR p_name LIKE '_lue %'""")
def _(t):
    n = F.col("p_name")
    return t.part.filter(n.like("red%") | n.ilike("%RING") | n.like("_lue %")).select("p_partkey", "p_name")


@query("P07_null_tests", """
WITH e AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)
SELECT CASE WHEN segment IS NULL THEN 'unset' ELSE 'set' END AS state, count(*) AS n,
       count(*) FILTER (WHERE segment IS NOT NULL) AS n_set FROM e GROUP BY 1""")
def _(t):
    e = t.customer.select(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))
    return (
        e.groupBy(F.when(F.col("segment").isNull(), "unset").otherwise("set").alias("state"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("segment").isNotNull()).alias("n_set"))
    )


@query("P08_three_valued_logic", """
WITH e AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)
SELECT count(*) FILTER (WHERE segment <> 'MACHINERY') AS plain_not_equal,
       count(*) FILTER (WHERE segment <> 'MACHINERY' OR segment IS NULL) AS keeps_nulls,
       count(*) FILTER (WHERE segment IS DISTINCT FROM 'MACHINERY') AS null_safe,
       count(*) FILTER (WHERE (segment = 'MACHINERY') IS NULL) AS unknown FROM e""")
def _(t):
    s = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    e = t.customer.select(s.alias("segment"))
    s = F.col("segment")
    return e.agg(
        F.count_if(s != "MACHINERY").alias("plain_not_equal"),
        F.count_if((s != "MACHINERY") | s.isNull()).alias("keeps_nulls"),
        F.count_if(~s.eqNullSafe("MACHINERY")).alias("null_safe"),
        F.count_if((s == "MACHINERY").isNull()).alias("unknown"),
    )


@query("P09_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def _(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("P10_distinct_on", """
SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders
ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC""")
def _(t):
    newest = F.struct("o_orderdate", "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(
        F.max_by("o_orderkey", newest).alias("o_orderkey"), F.max_by("o_totalprice", newest).alias("o_totalprice")
    )


@query("P11_casts", """
SELECT doc_id, TRY_CAST(replace(source, 'src', '') AS INTEGER) AS source_no, TRY_CAST(source AS INTEGER) AS bad_cast,
       CAST(n_chars AS VARCHAR) AS chars_text, CAST(n_chars AS DOUBLE) AS chars_double FROM documents""")
def _(t):
    return t.documents.select(
        "doc_id",
        F.replace("source", F.lit("src"), F.lit("")).try_cast("int").alias("source_no"),
        F.col("source").try_cast("int").alias("bad_cast"),
        F.col("n_chars").cast("string").alias("chars_text"),
        F.expr("n_chars::double").alias("chars_double"),
    )


STATUS_NAMES = {"F": "finished", "O": "open", "P": "partial"}


@query("P12_simple_case", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS status_name
FROM orders""")
def _(t):
    s = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey", F.when(s == "F", "finished").when(s == "O", "open").otherwise("other").alias("status_name")
    )


@query("P13_searched_case", """
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'middle'
       ELSE 'low' END AS band FROM orders""")
def _(t):
    p = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.when(p > 300000, "high").when(p > 100000, "middle").otherwise("low").alias("band"))


@query("P14_coalesce_nullif", """
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_discount, 0), -1) AS discount_or_minus,
       nullif(l_returnflag, 'N') AS flag_or_null FROM lineitem""")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.coalesce(F.nullif(F.col("l_discount"), F.lit(0.0)), F.lit(-1.0)).alias("discount_or_minus"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag_or_null"),
    )


@query("P15_safe_division", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(l_discount, 0) AS ratio FROM lineitem""")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", S.safe_divide(F.col("l_extendedprice"), F.col("l_discount")).alias("ratio")
    )


@query("P16_delimited_line_fields", """
WITH lines AS (SELECT concat_ws(',', event_id, event_type, value) AS line FROM events)
SELECT split_part(line, ',', 1) AS id, split_part(line, ',', 2) AS kind FROM lines
WHERE regexp_matches(split_part(line, ',', 2), '^(pur|err)') AND CAST(split_part(line, ',', 3) AS DOUBLE) > 100""")
def _(t):
    lines = t.events.select(F.concat_ws(",", "event_id", "event_type", "value").alias("line"))
    f = F.split("line", ",")
    return lines.filter(f[1].rlike("^(pur|err)") & (f[2].cast("double") > 100)).select(f[0].alias("id"), f[1].alias("kind"))


@query("P17_soft_delete", """
WITH live AS (SELECT * FROM (SELECT *, o_orderpriority = '5-LOW' AS _deleted FROM orders) WHERE _deleted = false)
SELECT o_orderstatus, count(*) AS n FROM live GROUP BY 1""")
def _(t):
    flagged = t.orders.withColumn("_deleted", F.col("o_orderpriority") == "5-LOW")
    live = flagged.filter(~F.col("_deleted"))
    return live.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("P18_range_check", """
SELECT p_partkey, CASE WHEN p_size BETWEEN 5 AND 45 THEN p_size END AS p_size,
       CASE WHEN p_retailprice BETWEEN 910.0 AND 1800.0 THEN p_retailprice END AS p_retailprice,
       concat_ws('; ', CASE WHEN NOT (p_size BETWEEN 5 AND 45) THEN 'p_size outside [5, 45]' END,
         CASE WHEN NOT (p_retailprice BETWEEN 910.0 AND 1800.0) THEN 'p_retailprice outside [910.0, 1800.0]' END) AS messages
FROM part""")
def _(t):
    kept, messages = S.out_of_range({"p_size": (5, 45), "p_retailprice": (910.0, 1800.0)})
    return t.part.select(
        "p_partkey", kept["p_size"].alias("p_size"), kept["p_retailprice"].alias("p_retailprice"),
        F.array_join(messages, "; ").alias("messages"),
    )


@query("P19_content_routing", """
WITH e AS (SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, target FROM (
  SELECT event_id, 'billing' AS target FROM e WHERE event_type = 'purchase' AND value > 50
  UNION ALL SELECT event_id, 'high_k' FROM e WHERE k >= 90
  UNION ALL SELECT event_id, 'errors' FROM e WHERE event_type IN ('error'))""")
def _(t):
    k = F.get_json_object("props", "$.k").cast("int")
    rules = {
        "billing": (F.col("event_type") == "purchase") & (F.col("value") > 50),
        "high_k": k >= 90,
        "errors": F.col("event_type").isin("error"),
    }
    targets = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return t.events.select("event_id", F.explode(targets).alias("target"))


@query("P21_line_search", r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) AS lines, count(*) FILTER (WHERE regexp_matches(lower(line), 'the|der')) AS ignore_case,
  count(*) FILTER (WHERE NOT regexp_matches(lower(line), 'the|der')) AS inverted,
  count(*) FILTER (WHERE regexp_matches(line, '(^|[^A-Za-z0-9_])(the|der)([^A-Za-z0-9_]|$)')) AS whole_word,
  count(*) FILTER (WHERE line = '') AS whole_line,
  count(*) FILTER (WHERE regexp_matches(line, 'the|der')) > 0 AS has_match
FROM l GROUP BY doc_id""")
def _(t):
    pattern = "the|der"
    lines = t.spread("documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(L.matches("line", pattern, ignore_case=True)).alias("ignore_case"),
        F.count_if(L.matches("line", pattern, ignore_case=True, invert=True)).alias("inverted"),
        F.count_if(L.matches("line", pattern, whole_word=True)).alias("whole_word"),
        F.count_if(L.matches("line", "", whole_line=True)).alias("whole_line"),
        (F.count_if(L.matches("line", pattern)) > 0).alias("has_match"),
    )
