"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkweave.functions import scalars as S
from sparkweave.operators import geo
from sparkweave.plans.common import day, n_rows
from sparkweave.plans.registry import query


@query("F01_string_basics", """
SELECT p_partkey, p_name || ' - ' || p_type AS joined, p_name || CAST(NULL AS VARCHAR) AS null_joined, concat_ws('/', p_brand, NULL, p_type) AS skips_null,
 upper(p_name) AS up, lower(p_type) AS low, trim('  ' || p_name || ' ') AS trimmed, length(p_name) AS n FROM part""")
def _(t):
    return t.part.select(
        "p_partkey", F.concat("p_name", F.lit(" - "), "p_type").alias("joined"),
        F.concat("p_name", F.lit(None).cast("string")).alias("null_joined"),
        F.concat_ws("/", "p_brand", F.lit(None).cast("string"), "p_type").alias("skips_null"),
        F.upper("p_name").alias("up"), F.lower("p_type").alias("low"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"), F.length("p_name").alias("n"),
    )


@query("F02_substring_replace_split", """
SELECT p_partkey, substring(p_name, 1, 3) AS head, replace(p_name, ' ', '_') AS snake, split_part(p_name, ' ', 2) AS second, split_part(p_brand, '#', 2) AS brand_no FROM part""")
def _(t):
    return t.part.select(
        "p_partkey", F.substring("p_name", 1, 3).alias("head"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("snake"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("second"), F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("brand_no"),
    )


@query("F03_name_cleanup", """
SELECT c_custkey, upper(left(c_name, 1)) || lower(substring(c_name, 2)) AS name, lower(replace(c_name, '#', '.') || '@Example.COM') AS email, upper(c_mktsegment) AS country FROM customer""")
def _(t):
    return t.customer.select(
        "c_custkey", F.initcap(F.trim(F.concat(F.lit(" "), "c_name"))).alias("name"),
        F.lower(F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@Example.COM"))).alias("email"),
        F.upper("c_mktsegment").alias("country"),
    )


@query("F04_regex_replace", r"""
SELECT doc_id, md5(regexp_replace(regexp_replace(text, '([A-Za-z]+)@([A-Za-z]+)', '\2 at \1', 'g'), 'the', 'THE', 'gi')) AS changed FROM documents""")
def _(t):
    swapped = F.regexp_replace("text", "([A-Za-z]+)@([A-Za-z]+)", "$2 at $1")
    return t.spread("documents").select("doc_id", F.md5(F.regexp_replace(swapped, "(?i)the", "THE")).alias("changed"))


@query("F05_translate_squeeze", """
SELECT doc_id, md5(translate(text, 'abc', 'xyz')) AS translated, length(regexp_replace(text, ' +', ' ', 'g')) AS squeezed,
 length(translate(text, 'aeiou', '')) AS deleted, length(regexp_replace(text, '[^a-z]', '', 'g')) AS kept FROM documents""")
def _(t):
    return t.spread("documents").select(
        "doc_id", F.md5(F.translate("text", "abc", "xyz")).alias("translated"),
        F.length(F.regexp_replace("text", " +", " ")).alias("squeezed"), F.length(F.translate("text", "aeiou", "")).alias("deleted"),
        F.length(F.regexp_replace("text", "[^a-z]", "")).alias("kept"),
    )


@query("F06_field_cut", """
WITH l AS (SELECT page_id, string_split(url, '/') AS f, url FROM pages) SELECT page_id, f[3] AS host, f[-1] AS last_field, substring(url, 1, 5) AS head, len(f) AS fields FROM l""")
def _(t):
    f = F.split("url", "/")
    return t.pages.select(
        "page_id", F.try_element_at(f, F.lit(3)).alias("host"), F.element_at(f, -1).alias("last_field"),
        F.substring("url", 1, 5).alias("head"), F.size(f).alias("fields"),
    )


@query("F07_date_trunc", "SELECT o_orderkey, " + ", ".join(f"date_trunc('{u}', o_orderdate)::DATE AS by_{u}" for u in ("day", "week", "month", "year")) + " FROM orders")
def _(t):
    return t.orders.select("o_orderkey", *[F.date_trunc(u, "o_orderdate").cast("date").alias(f"by_{u}") for u in ("day", "week", "month", "year")])


@query("F08_extract", "SELECT event_id, year(ts)::INT AS y, month(ts)::INT AS m, hour(ts)::INT AS h, dayofweek(ts)::INT AS dow FROM events")
def _(t):
    return t.events.select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.hour("ts").alias("h"), (F.dayofweek("ts") - 1).alias("dow")
    )


@query("F09_interval_arithmetic", """
SELECT o_orderkey, (o_orderdate + INTERVAL 30 DAY)::DATE AS due, date_diff('day', o_orderdate::DATE, DATE '2001-08-01') AS age_days FROM orders
WHERE o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY""")
def _(t):
    as_of = F.lit("2001-08-01").cast("date")
    return t.orders.filter(F.col("o_orderdate") >= F.date_sub(as_of, 30).cast("timestamp_ntz")).select(
        "o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL '30' DAY")).cast("date").alias("due"),
        F.date_diff(as_of, day("o_orderdate")).alias("age_days"),
    )


@query("F10_age", """
WITH m AS (SELECT o_orderkey, (2001 - year(o_orderdate)) * 12 + 8 - month(o_orderdate) - CASE WHEN day(o_orderdate) > 1 THEN 1 ELSE 0 END AS n FROM orders)
SELECT o_orderkey, (n // 12)::BIGINT AS years, (n % 12)::BIGINT AS months FROM m""")
def _(t):
    n = F.floor(F.months_between(F.lit("2001-08-01").cast("date"), day("o_orderdate")))
    return t.orders.select("o_orderkey", n.alias("n")).select("o_orderkey", F.expr("n div 12").alias("years"), F.expr("n % 12").alias("months"))


FORMATS = ["yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy"]


@query("F11_multi_format_parse", """
WITH s AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
  WHEN 2 THEN strftime(ts, '%d.%m.%Y') ELSE 'soon' END AS s FROM events)
SELECT event_id, s, strftime(coalesce(try_strptime(s, '%Y-%m-%dT%H:%M'), try_strptime(s, '%Y-%m-%d %H:%M:%S'), try_strptime(s, '%d.%m.%Y')), '%Y-%m-%d %H:%M:%S') AS parsed FROM s""")
def _(t):
    k = F.col("event_id") % 4
    s = F.when(k == 0, F.date_format("ts", FORMATS[0])).when(k == 1, F.date_format("ts", FORMATS[1])).when(
        k == 2, F.date_format("ts", FORMATS[2])).otherwise("soon")
    return t.events.select("event_id", s.alias("s")).select(
        "event_id", "s", F.date_format(S.parse_first(F.col("s"), FORMATS), "yyyy-MM-dd HH:mm:ss").alias("parsed")
    )


@query("F12_json_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.missing') AS missing FROM events""")
def _(t):
    v = F.parse_json("props")
    return t.events.select(
        "event_id", F.variant_get(v, "$.k", "int").alias("k"), F.get_json_object("props", "$.missing").alias("missing")
    )


@query("F13_json_containment", """
WITH d AS (SELECT o_custkey, list(DISTINCT o_orderpriority) AS tags FROM orders GROUP BY 1)
SELECT o_custkey, list_contains(tags, '1-URGENT') AS has_urgent, list_has_all(tags, ['1-URGENT', '5-LOW']) AS has_both, list_has_any(tags, ['2-HIGH', '5-LOW']) AS has_any, true AS has_key FROM d""")
def _(t):
    docs = t.orders.groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_set("o_orderpriority").alias("tags"))).alias("doc"))
    tags = F.from_json("doc", "tags array<string>")["tags"]
    both = F.array(F.lit("1-URGENT"), F.lit("5-LOW"))
    return docs.select(
        "o_custkey", F.array_contains(tags, "1-URGENT").alias("has_urgent"),
        (F.size(F.array_except(both, tags)) == 0).alias("has_both"),
        F.arrays_overlap(tags, F.array(F.lit("2-HIGH"), F.lit("5-LOW"))).alias("has_any"),
        F.array_contains(F.json_object_keys("doc"), "tags").alias("has_key"),
    )


@query("F14_json_update", """
SELECT event_id, '{"k":"' || json_extract_string(props, '$.k') || '","seen":"yes"}' AS with_key, '{"seen":"yes"}' AS without_k FROM events""")
def _(t):
    m = F.from_json("props", "map<string,string>")
    added = F.map_concat(m, F.create_map(F.lit("seen"), F.lit("yes")))

    def sorted_json(x):
        return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(x))))

    return t.events.select(
        "event_id", sorted_json(added).alias("with_key"), sorted_json(F.map_filter(added, lambda k, _: k != "k")).alias("without_k")
    )


@query("F15_surrogate_key", """
SELECT o_orderkey, md5(coalesce(CAST(o_orderdate::DATE AS VARCHAR), 'null') || '|' || coalesce(nullif(o_orderstatus, 'P'), 'null') || '|' || coalesce(o_orderpriority, 'null')) AS sk FROM orders""")
def _(t):
    return t.orders.select(
        "o_orderkey", S.surrogate_key(day("o_orderdate"), F.nullif(F.col("o_orderstatus"), F.lit("P")), F.col("o_orderpriority")).alias("sk")
    )


@query("F16_business_key", """
SELECT event_id, replace(lower(event_type || ' ' || user_id), ' ', '_') || '_' || strftime(ts, '%Y-%m-%d_%H%M') AS record_id FROM events""")
def _(t):
    name = F.replace(F.lower(F.concat_ws(" ", "event_type", "user_id")), F.lit(" "), F.lit("_"))
    return t.events.select("event_id", F.concat(name, F.lit("_"), F.date_format("ts", "yyyy-MM-dd_HHmm")).alias("record_id"))


# fixed values: upper bounds and labels of the derived weather classes
TEMPERATURE_STEPS = [(-10, "extreme_cold"), (0, "freezing"), (10, "cold"), (20, "mild"), (30, "warm"), (40, "hot")]
RAIN_STEPS = [(1, "trace"), (5, "light"), (15, "moderate")]
WIND_STEPS = [(1, "calm"), (20, "light_breeze"), (40, "moderate_breeze"), (62, "strong_breeze"), (88, "near_gale")]


def sql_steps(v, steps, top):
    return "CASE " + " ".join(f"WHEN {v} < {b} THEN '{n}'" for b, n in steps) + f" WHEN {v} IS NOT NULL THEN '{top}' END"


@query("F17_bucket_derivation", f"""
WITH w AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity - 10 AS temp, nullif(round(l_discount * 100), 10) AS rain, round(l_tax * 1250) AS wind FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, {sql_steps('temp', TEMPERATURE_STEPS, 'extreme_heat')} AS temp_class,
 CASE WHEN rain = 0 THEN 'none' ELSE {sql_steps('rain', RAIN_STEPS, 'heavy')} END AS rain_class, {sql_steps('wind', WIND_STEPS, 'storm')} AS wind_class,
 CASE WHEN temp IS NOT NULL AND rain IS NOT NULL AND wind IS NOT NULL THEN temp BETWEEN 15 AND 25 AND rain < 1 AND wind < 30 END AS nice_day FROM w""")
def _(t):
    w = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") - 10).alias("temp"),
        F.nullif(F.round(F.col("l_discount") * 100), F.lit(10.0)).alias("rain"), F.round(F.col("l_tax") * 1250).alias("wind"),
    )
    temp, rain, wind = F.col("temp"), F.col("rain"), F.col("wind")
    known = temp.isNotNull() & rain.isNotNull() & wind.isNotNull()
    return w.select(
        "l_orderkey", "l_linenumber", "l_partkey", S.buckets(temp, TEMPERATURE_STEPS, "extreme_heat").alias("temp_class"),
        F.when(rain == 0, "none").otherwise(S.buckets(rain, RAIN_STEPS, "heavy")).alias("rain_class"),
        S.buckets(wind, WIND_STEPS, "storm").alias("wind_class"),
        F.when(known, temp.between(15, 25) & (rain < 1) & (wind < 30)).alias("nice_day"),
    )


# fixed values: weather code to description
WEATHER_CODES = {
    0: "Clear sky", 1: "Mainly clear", 2: "Partly cloudy", 3: "Overcast", 45: "Fog", 48: "Depositing rime fog",
    51: "Light drizzle", 53: "Moderate drizzle", 55: "Dense drizzle", 61: "Slight rain", 63: "Moderate rain", 65: "Heavy rain",
    71: "Slight snowfall", 73: "Moderate snowfall", 75: "Heavy snowfall", 77: "Snow grains", 80: "Slight rain showers",
    81: "Moderate rain showers", 82: "Violent rain showers", 85: "Slight snow showers", 86: "Heavy snow showers",
    95: "Thunderstorm", 96: "Thunderstorm with slight hail", 99: "Thunderstorm with heavy hail",
}


@query("F18_code_lookup", f"""
SELECT event_id, code, coalesce(label, 'Unknown code ' || code) AS description FROM
 (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS code FROM events)
 LEFT JOIN (VALUES {", ".join(f"({k}, '{v}')" for k, v in WEATHER_CODES.items())}) w(c, label) ON c = code""")
def _(t):
    labels = F.create_map(*[F.lit(x) for kv in WEATHER_CODES.items() for x in kv])
    code = F.get_json_object("props", "$.k").cast("int")
    return t.events.select("event_id", code.alias("code")).select(
        "event_id", "code",
        F.coalesce(F.try_element_at(labels, F.col("code")), F.concat(F.lit("Unknown code "), F.col("code"))).alias("description"),
    )


@query("F19_unit_conversion", "SELECT event_id, CAST(round(value * 100) AS BIGINT) AS cents, CAST(CAST(round(value * 100) / 100 AS DECIMAL(10, 2)) AS VARCHAR) AS dollars FROM events")
def _(t):
    return t.events.select("event_id", F.round(F.col("value") * 100).cast("bigint").alias("cents")).select(
        "event_id", "cents", (F.col("cents") / 100).cast("decimal(10,2)").cast("string").alias("dollars")
    )


def places(df, key):
    """Places spread over the globe between 60 degrees south and north, derived from the key."""
    return df.select(
        key, ((F.col(key) * 37) % 12000 / 100.0 - 60).alias("lat"), ((F.col(key) * 911) % 36000 / 100.0 - 180).alias("lon")
    )


def sql_places(table, key):
    return f"SELECT {key}, ({key} * 37) % 12000 / 1e2 - 60 AS lat, ({key} * 911) % 36000 / 1e2 - 180 AS lon FROM {table}"


def sql_km(a, b, c, d):
    return f"""2 * 6372.797560856 * asin(sqrt(least(1.0, pow(sin((radians({c}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))))"""


@query("F20_radius_search", f"""
SELECT c_custkey, round(km, 3) AS km FROM (SELECT c_custkey, {sql_km('lat', 'lon', '37.5', '15.1')} AS km FROM ({sql_places('customer', 'c_custkey')})) WHERE km <= 3000""")
def _(t):
    near = geo.within_radius(places(t.customer, "c_custkey"), 37.5, 15.1, 3000)
    return near.select("c_custkey", F.round("km", 3).alias("km"))


@query("F21_grid_neighbour_join", f"""
SELECT s_suppkey, count(c_custkey) AS near FROM ({sql_places('supplier', 's_suppkey')}) s LEFT JOIN ({sql_places('customer', 'c_custkey')}) c
ON {sql_km('s.lat', 's.lon', 'c.lat', 'c.lon')} <= 800 GROUP BY 1""")
def _(t):
    return geo.count_near(places(t.supplier, "s_suppkey"), places(t.customer, "c_custkey"), 800, 60).select("s_suppkey", "near")


@query("F22_hash_routing", f"""
SELECT bucket, count(*) AS n, min(o_custkey) AS lowest FROM (SELECT o_custkey, {S.sql_hash_bucket('o_custkey', 16)} AS bucket FROM orders) GROUP BY 1""")
def _(t):
    return t.orders.groupBy(S.hash_bucket(F.col("o_custkey"), 16).alias("bucket")).agg(n_rows().alias("n"), F.min("o_custkey").alias("lowest"))


@query("F23_extract_all", r"""
SELECT doc_id, array_to_string(regexp_extract_all(text, '@([A-Za-z0-9.-]+)', 1), ' ') AS domains, len(regexp_extract_all(text, '[0-9]+')) AS numbers FROM documents""")
def _(t):
    return t.spread("documents").select(
        "doc_id", F.array_join(F.regexp_extract_all("text", F.lit("(?<=@)[A-Za-z0-9.-]+"), F.lit(0)), " ").alias("domains"),
        F.size(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0))).alias("numbers"),
    )
