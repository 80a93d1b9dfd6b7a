"""Sorting, limits and paging."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from sparkweave.functions import money as M
from sparkweave.plans.common import n_rows, sql_total
from sparkweave.plans.registry import query


@query("O01_order_by", f"""
WITH s AS (SELECT p_brand, p_type, {sql_total('p_retailprice')} AS total FROM part GROUP BY 1, 2)
SELECT p_brand, p_type, total, row_number() OVER (ORDER BY p_type, total DESC, p_brand) AS position FROM s ORDER BY 2, total DESC""")
def _(t):
    s = t.part.groupBy("p_brand", "p_type").agg(M.total("p_retailprice").alias("total"))
    order = [F.col("p_type"), F.col("total").desc(), F.col("p_brand")]
    # brands times types is a fixed set
    return s.withColumn("position", F.row_number().over(Window.orderBy(*order))).orderBy(*order)


@query("O02_null_order", """
WITH s AS (SELECT nullif(p_brand, 'Brand#3') AS brand, count(*) AS n FROM part GROUP BY 1)
SELECT brand, n, row_number() OVER (ORDER BY brand ASC NULLS FIRST) AS asc_first, row_number() OVER (ORDER BY brand ASC NULLS LAST) AS asc_last,
 row_number() OVER (ORDER BY brand DESC NULLS LAST) AS desc_last FROM s""")
def _(t):
    b = F.col("brand")
    s = t.part.groupBy(F.nullif(F.col("p_brand"), F.lit("Brand#3")).alias("brand")).agg(n_rows().alias("n"))
    forms = {"asc_first": b.asc_nulls_first(), "asc_last": b.asc_nulls_last(), "desc_last": b.desc_nulls_last()}
    return s.withColumns({k: F.row_number().over(Window.orderBy(o)) for k, o in forms.items()})


@query("O03_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(5)


@query("O04_offset_page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 10")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").offset(10).limit(10)


@query("O05_keyset_page", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 10")
def _(t):
    return t.orders.filter("o_orderkey > 5000").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(10)


@query("O06_text_number_sort", """
WITH s AS (SELECT DISTINCT p_size || CASE p_type WHEN 'ECONOMY' THEN 'K' WHEN 'PROMO' THEN 'M' ELSE '' END AS size_text FROM part),
b AS (SELECT size_text, CAST(regexp_extract(size_text, '^[0-9]+') AS BIGINT) * CASE right(size_text, 1) WHEN 'K' THEN 1024 WHEN 'M' THEN 1048576 ELSE 1 END AS bytes FROM s)
SELECT size_text, bytes, row_number() OVER (ORDER BY bytes, size_text) AS by_size, row_number() OVER (ORDER BY size_text) AS by_text FROM b""")
def _(t):
    unit = F.when(F.col("p_type") == "ECONOMY", "K").when(F.col("p_type") == "PROMO", "M").otherwise("")
    s = t.part.select(F.concat(F.col("p_size").cast("string"), unit).alias("size_text")).distinct()
    last = F.right("size_text", F.lit(1))
    factor = F.when(last == "K", 1024).when(last == "M", 1048576).otherwise(1)
    b = s.withColumn("bytes", F.regexp_extract("size_text", "^[0-9]+", 0).cast("bigint") * factor)
    # distinct size labels are a fixed set
    return b.withColumns({
        "by_size": F.row_number().over(Window.orderBy("bytes", "size_text")), "by_text": F.row_number().over(Window.orderBy("size_text")),
    })


@query("O07_range_slices", f"""
WITH s AS (SELECT o_custkey, {sql_total('o_totalprice')} AS score FROM orders GROUP BY 1)
SELECT c_name, score FROM s JOIN customer ON c_custkey = o_custkey
WHERE score BETWEEN 1000000 AND 2000000 AND c_name >= 'Customer#00000001' AND c_name < 'Customer#0000001'""")
def _(t):
    s = t.orders.groupBy("o_custkey").agg(M.total("o_totalprice").alias("score")).filter(F.col("score").between(1000000, 2000000))
    names = t.customer.filter((F.col("c_name") >= "Customer#00000001") & (F.col("c_name") < "Customer#0000001"))
    return s.join(names, F.col("c_custkey") == F.col("o_custkey")).select("c_name", "score").orderBy("score")
