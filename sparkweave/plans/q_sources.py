"""Sources, sinks and layout (S01-S21; the streaming ones are in q_streams)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkweave.functions import money as M
from sparkweave.functions.scalars import hash_bucket, sql_hash_bucket
from sparkweave.plans.common import day, n_rows, sql_mean, sql_total, tagged
from sparkweave.plans.registry import query
from sparkweave.session import new_folder
from sparkweave.sources import files
from sparkweave.sources import layout


@query("S01_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def _(t):
    return files.round_trip(t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), "csv", "csv", header=True)


@query("S02_parquet", "SELECT l_orderkey, l_quantity FROM lineitem")
def _(t):
    back = files.round_trip(t.lineitem, "parquet", "parquet", compression="snappy")
    return back.select("l_orderkey", "l_quantity")


@query("S03_json_lines", "SELECT event_id, event_type, value, props FROM events")
def _(t):
    return files.round_trip(t.events.select("event_id", "event_type", "value", "props"), "json", "json")


@query("S04_orc", "SELECT o_orderkey, o_totalprice, o_orderdate::DATE AS d FROM orders")
def _(t):
    return files.round_trip(t.orders.select("o_orderkey", "o_totalprice", day("o_orderdate").alias("d")), "orc", "orc")


@query("S05_format_sizes", "SELECT count(*) AS csv_rows, count(*) AS parquet_rows, true AS parquet_is_smaller FROM orders")
def _(t):
    folder = new_folder(t.spark, "sizes")
    t.orders.write.option("header", True).csv(f"{folder}/csv")
    t.orders.write.parquet(f"{folder}/parquet")
    sizes = tagged(
        csv=files.file_sizes(t.spark, f"{folder}/csv", "*.csv"), parquet=files.file_sizes(t.spark, f"{folder}/parquet", "*.parquet")
    )
    by_form = {f: F.sum(F.when(F.col("form") == f, F.col("length"))) for f in ("csv", "parquet")}
    rows = {
        "csv": t.spark.read.option("header", True).schema(t.orders.schema).csv(f"{folder}/csv"),
        "parquet": t.spark.read.schema(t.orders.schema).parquet(f"{folder}/parquet"),
    }
    counts = [df.agg(n_rows()).scalar().alias(f"{form}_rows") for form, df in rows.items()]
    return sizes.agg((by_form["csv"] > by_form["parquet"]).alias("parquet_is_smaller")).select(*counts, "parquet_is_smaller")


@query("S06_rows_to_table", """
SELECT status, label, count(*) AS n FROM (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) v(status, label) JOIN orders ON o_orderstatus = status GROUP BY 1, 2""")
def _(t):
    rows = t.spark.createDataFrame([("F", "finished"), ("O", "open"), ("P", "partial")], "status string, label string")
    n = t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(n_rows().alias("n"))
    return rows.join(n, "status")


@query("S07_view_and_sql", f"SELECT p_type, {sql_mean('p_retailprice')} AS mean_price FROM part GROUP BY 1")
def _(t):
    t.part.createOrReplaceTempView("products")
    return t.spark.sql("""
        SELECT p_type, sum(CAST(round(p_retailprice * 100) AS BIGINT)) / 100D / count(p_retailprice) AS mean_price FROM products GROUP BY p_type""")


@query("S08_seed", "SELECT n_name, r_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def _(t):
    codes = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    seed = files.round_trip(codes, "csv", "seed", header=True)
    n = t.customer.groupBy("c_nationkey").agg(n_rows().alias("customers"))
    return n.join(seed, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "r_name", "customers")


PAYLOAD = "id bigint, hourly struct<time: array<string>, price: array<double>, status: array<string>>"


@query("S09_parallel_arrays", """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey // 24 ORDER BY o_orderkey) AS i, count(*) OVER (PARTITION BY o_orderkey // 24) AS n FROM orders)
SELECT o_orderkey // 24 AS id, strftime(o_orderdate, '%Y-%m-%d') AS time, o_totalprice AS price, CASE WHEN i < n THEN o_orderstatus END AS status FROM o""")
def _(t):
    # a payload carries 24 consecutive orders; its last status is missing
    rows = F.sort_array(F.collect_list(F.struct("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("time"), "o_totalprice", "o_orderstatus")))
    payload = t.orders.groupBy(F.expr("o_orderkey div 24").alias("id")).agg(rows.alias("r")).select(
        F.to_json(F.struct("id", F.struct(
            F.col("r.time").alias("time"), F.col("r.o_totalprice").alias("price"),
            F.slice(F.col("r.o_orderstatus"), F.lit(1), F.size("r") - 1).alias("status"),
        ).alias("hourly"))).alias("body")
    )
    parsed = payload.select(F.from_json("body", PAYLOAD).alias("p"))
    return parsed.select("p.id", F.inline(F.arrays_zip("p.hourly.time", "p.hourly.price", "p.hourly.status")))


@query("S10_bronze_ingest", "SELECT 'events.parquet' AS _file, 'events' AS _source, 'batch-1' AS _batch_id, count(*) AS n FROM events")
def _(t):
    folder = new_folder(t.spark, "bronze")
    raw = files.ingest_raw(t.events, "events", "batch-1")
    raw.write.partitionBy("ingest_date").parquet(folder)
    back = t.spark.read.schema(raw.schema).parquet(folder)
    name = F.regexp_extract("_file", "([^/]+)$", 1).alias("_file")
    return back.groupBy(name, "_source", "_batch_id").agg(n_rows().alias("n"))


@query("S11_schema_on_read", "SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1")
def _(t):
    raw = files.stored(t.events.select("event_id", "props"), "raw_json")
    return raw.select(F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k")).groupBy("k").agg(n_rows().alias("n"))


@query("S12_partitioned_write", "SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, count(*) AS n, max(o_orderkey) AS newest FROM orders GROUP BY 1, 2")
def _(t):
    folder = new_folder(t.spark, "by_month")
    o = t.orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    files.write_partitioned(o, folder, ["year", "month"])
    return t.spark.read.schema(o.schema).parquet(folder).groupBy("year", "month").agg(n_rows().alias("n"), F.max("o_orderkey").alias("newest"))


@query("S13_replace_partitions", """
SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n, max(CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice * 2 ELSE o_totalprice END) AS top FROM orders GROUP BY 1""")
def _(t):
    folder = new_folder(t.spark, "by_year")
    o = t.orders.withColumn("year", F.year("o_orderdate"))
    files.write_partitioned(o, folder, ["year"])
    files.replace_partitions(o.filter("year = 1997").withColumn("o_totalprice", F.col("o_totalprice") * 2), folder, ["year"])
    return t.spark.read.schema(o.schema).parquet(folder).groupBy("year").agg(n_rows().alias("n"), F.max("o_totalprice").alias("top"))


@query("S14_compaction", "SELECT count(*) AS n, 4::BIGINT AS files_after, 40::BIGINT AS files_before FROM lineitem")
def _(t):
    small = new_folder(t.spark, "small_files")
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")
    li.repartition(40).write.parquet(small)
    after = layout.compact(t.spark, small, li.schema, 4)
    before_files = files.file_sizes(t.spark, small, "*.parquet").agg(n_rows()).scalar()
    return after.select("*", F.col("_metadata.file_path").alias("f")).agg(
        n_rows().alias("n"), F.count_distinct("f").alias("files_after"), before_files.alias("files_before")
    )


@query("S15_partition_assignment", f"""
SELECT o_orderkey, CASE WHEN o_orderdate < '1997-01-01' THEN 'p_before_1997' WHEN o_orderdate < '2000-01-01' THEN 'p_1997_1999' ELSE 'p_from_2000' END AS by_range,
 CASE WHEN o_orderstatus IN ('F', 'O') THEN 'p_known' ELSE 'p_other' END AS by_list, {sql_hash_bucket('o_orderkey', 4)} AS by_hash FROM orders""")
def _(t):
    d = F.col("o_orderdate")
    by_range = F.when(d < "1997-01-01", "p_before_1997").when(d < "2000-01-01", "p_1997_1999").otherwise("p_from_2000")
    return t.orders.select(
        "o_orderkey", by_range.alias("by_range"),
        F.when(F.col("o_orderstatus").isin("F", "O"), "p_known").otherwise("p_other").alias("by_list"),
        hash_bucket(F.col("o_orderkey"), 4).alias("by_hash"),
    )


@query("S16_partition_pruning", f"SELECT o_orderstatus, count(*) AS n, {sql_total('o_totalprice')} AS total FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1")
def _(t):
    folder = new_folder(t.spark, "pruned")
    o = t.orders.withColumn("year", F.year("o_orderdate"))
    files.write_partitioned(o, folder, ["year"])
    return (
        t.spark.read.schema(o.schema).parquet(folder).filter("year = 1998").groupBy("o_orderstatus")
        .agg(n_rows().alias("n"), M.total("o_totalprice").alias("total"))
    )


@query("S18_message_decode", """
SELECT event_id AS "offset", user_id::VARCHAR AS key, CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value, event_id % 7 = 0 AS bad FROM events""")
def _(t):
    body = F.to_json(F.struct("event_type", "value"))
    broken = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{\"event_type\": "), F.col("event_type"))).otherwise(body)
    envelope = t.events.select(
        F.col("user_id").cast("string").alias("key"), broken.alias("value"), hash_bucket(F.col("user_id"), 3).alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
    )
    schema = "event_type string, value double, _corrupt_record string"
    rec = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return envelope.withColumn("r", rec).select(
        "offset", "key", "r.event_type", "r.value", F.col("r._corrupt_record").isNotNull().alias("bad")
    )


@query("S20_denormalised_export", f"""
SELECT c_mktsegment, p_brand, count(*) AS n, {sql_total('l_extendedprice')} AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def _(t):
    wide = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select("o_orderkey", "o_orderdate", "c_custkey", "c_name", "c_mktsegment", "p_partkey", "p_name", "p_brand", "l_quantity", "l_extendedprice")
    )
    once = files.stored(wide, "wide_parquet")
    once.write.option("header", True).csv(new_folder(t.spark, "wide_csv"))
    return once.groupBy("c_mktsegment", "p_brand").agg(n_rows().alias("n"), M.total("l_extendedprice").alias("revenue"))
