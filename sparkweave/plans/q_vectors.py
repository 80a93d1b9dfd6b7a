"""Vector jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkweave.operators import vectors as V
from sparkweave.operators.aggregates import top_n_per_group
from sparkweave.operators.maintenance import apply_changes
from sparkweave.plans.common import n_rows, tagged
from sparkweave.plans.q_text import SQL_BM25, bm25_ranking
from sparkweave.plans.registry import query
from sparkweave.sources.files import stored

DIMS = 64

SQL_E = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
SQL_QV = "qv AS (SELECT label AS query, list(m ORDER BY i) AS qvec FROM (SELECT label, i, round(avg(v[i]), 9) AS m FROM (SELECT label, v, unnest(generate_series(1, len(v))) AS i FROM e) GROUP BY 1, 2) GROUP BY 1)"
SQL_TOP = "SELECT query, vec_id, score, place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS place FROM (SELECT query, vec_id, label, round(list_cosine_similarity(v, qvec), 6) AS score FROM e, qv))"


#: Every twentieth row asks, and finds the others.
SQL_RQ = "rq AS (SELECT vec_id AS query, label AS qlabel, v AS qvec FROM e WHERE vec_id % 20 = 0)"
SQL_NEAR = "SELECT query, qlabel, vec_id, label, round(list_cosine_similarity(v, qvec), 6) AS score FROM e JOIN rq ON vec_id <> query"
SQL_RTOP = f"SELECT query, vec_id, score, place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS place FROM ({SQL_NEAR}))"


def row_queries(t, *columns):
    """Every twentieth row as a query."""
    return t.embeddings.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("qvec"), *columns)


def label_queries(t):
    """One query vector per label: the mean of its vectors."""
    return V.centroids(t.embeddings, "label", "embedding", DIMS).withColumnRenamed("label", "query")


@query("V10_distances", f"""
WITH {SQL_E}, {SQL_QV} SELECT vec_id, round(list_cosine_similarity(v, qvec), 6) AS cosine, round(list_inner_product(v, qvec), 6) AS dot, round(list_distance(v, qvec), 6) AS l2,
 round(list_sum(list_transform(generate_series(1, len(v)), lambda i: abs(v[i] - qvec[i]))), 6) AS l1, len(list_filter(generate_series(1, len(v)), lambda i: (v[i] > 0) <> (qvec[i] > 0)))::INTEGER AS hamming FROM e JOIN qv ON query = label""")
def _(t):
    q = label_queries(t).withColumnRenamed("query", "label")
    v, c = F.col("embedding"), F.col("qvec")
    return t.embeddings.join(q, "label").select(
        "vec_id", F.round(V.cosine(v, c), 6).alias("cosine"), F.round(V.dot(v, c), 6).alias("dot"), F.round(V.l2(v, c), 6).alias("l2"),
        F.round(V.l1(v, c), 6).alias("l1"), V.hamming(v, c).alias("hamming"),
    )


@query("V11_normalise", f"""
WITH {SQL_E}, n AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS n FROM e)
SELECT vec_id, round(n, 6) AS norm, abs(n - 1) > 0.001 AS unnormalised, round(sqrt(list_sum(list_transform(v, lambda x: (x / n) * (x / n)))), 6) AS after FROM n""")
def _(t):
    n = t.embeddings.select("vec_id", "embedding", V.norm(F.col("embedding")).alias("n"))
    unit = F.transform("embedding", lambda x: x.cast("double") / F.col("n"))
    return n.select(
        "vec_id", F.round("n", 6).alias("norm"), (F.abs(F.col("n") - 1) > 0.001).alias("unnormalised"), F.round(V.norm(unit), 6).alias("after")
    )


@query("V12_exact_top_k", f"WITH {SQL_E}, {SQL_RQ} {SQL_RTOP} WHERE place <= 10")
def _(t):
    return V.top_k(t.embeddings, "vec_id", "embedding", row_queries(t), 10, own=False)


@query("V13_filtered_knn", f"""
WITH {SQL_E}, {SQL_RQ} SELECT query, vec_id, score, place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS place FROM
 ({SQL_NEAR}) JOIN documents ON doc_id = vec_id WHERE lang = 'en' AND label = qlabel) WHERE place <= 5""")
def _(t):
    english = t.documents.filter("lang = 'en'").select(F.col("doc_id").alias("vec_id"))
    candidates = t.embeddings.join(english, "vec_id", "left_semi")
    return V.top_k(candidates, "vec_id", "embedding", row_queries(t, "label"), 5, match=["label"], own=False)


def exact_rows(t):
    return V.top_k(t.embeddings, "vec_id", "embedding", row_queries(t), 10, own=False)


def with_recall(t, approximate):
    """The recall of an approximate result against the exact one, per query."""
    return V.recall(approximate, exact_rows(t), "vec_id", 10)


SQL_REACHED = "SELECT vec_id AS query, least(10, (SELECT count(*) - 1 FROM embeddings)) AS found, true AS reached FROM embeddings WHERE vec_id % 20 = 0"


def reaching(t, approximate):
    """Per query how many rows it found, and whether the mean recall of all queries is nine tenths or more."""
    approximate = stored(approximate, "approximate")
    mean = with_recall(t, approximate).agg(F.avg("recall")).scalar()
    found = approximate.groupBy("query").agg(n_rows().alias("found"))
    return found.select("query", "found", (mean >= 0.9).alias("reached"))


@query("V14_ivf", SQL_REACHED)
def _(t):
    return reaching(t, V.ivf_search(t.embeddings, "vec_id", "embedding", row_queries(t), 10, cells=16, own=False))


@query("V15_hyperplane_lsh", SQL_REACHED)
def _(t):
    return reaching(t, V.lsh_search(t.embeddings, "vec_id", "embedding", row_queries(t), 10, DIMS, tables=4, bits=6, own=False))


@query("V18_sq8", f"""
WITH {SQL_E}, b AS (SELECT list(lo ORDER BY i) AS lo, list(hi ORDER BY i) AS hi FROM (SELECT i, min(v[i]) AS lo, max(v[i]) AS hi FROM (SELECT v, unnest(generate_series(1, len(v))) AS i FROM e) GROUP BY 1)),
c AS (SELECT vec_id, v, lo, hi, list_transform(generate_series(1, len(v)), lambda i: floor((v[i] - lo[i]) / (hi[i] - lo[i]) * 255 + 0.5)) AS c FROM e, b)
SELECT vec_id, CAST(list_sum(c) AS BIGINT) AS code_sum, round(list_max(list_transform(generate_series(1, len(v)), lambda i: abs(v[i] - (lo[i] + c[i] / 255.0::DOUBLE * (hi[i] - lo[i]))))), 6) AS max_error,
 list_bool_and(list_transform(generate_series(1, len(v)), lambda i: abs(v[i] - (lo[i] + c[i] / 255.0::DOUBLE * (hi[i] - lo[i]))) <= (hi[i] - lo[i]) / 510 + 1e-9)) AS in_bound FROM c""")
def _(t):
    lo, hi = V.sq8_bounds(t.embeddings, "embedding", DIMS)
    coded = t.embeddings.select("vec_id", F.col("embedding").alias("v"), lo.alias("lo"), hi.alias("hi"))
    coded = coded.withColumn("c", V.sq8_encode(F.col("v"), F.col("lo"), F.col("hi")))
    back = coded.withColumn("b", V.sq8_decode(F.col("c"), F.col("lo"), F.col("hi")))
    err = F.zip_with(F.transform("v", lambda x: x.cast("double")), F.col("b"), lambda x, y: F.abs(x - y))
    bound = F.zip_with(F.col("lo"), F.col("hi"), lambda a, b: (b - a) / 510 + 1e-9)
    return back.select(
        "vec_id", F.aggregate("c", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("code_sum"), F.round(F.array_max(err), 6).alias("max_error"),
        F.forall(F.zip_with(err, bound, lambda e, b: e <= b), lambda x: x).alias("in_bound"),
    )


#: Rows in the order of the signs, as deep as 95% of the exact neighbours of all queries need it.
SQL_BINARY = f"""sg AS (SELECT vec_id, list_transform(v, lambda x: CASE WHEN x > 0 THEN 1.0 ELSE -1.0 END) AS s, v FROM e),
h AS (SELECT query, vec_id, list_inner_product(s, qvec) AS alike, round(list_cosine_similarity(v, qvec), 6) AS score FROM sg JOIN rq ON vec_id <> query),
o AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY alike DESC, vec_id) AS r, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS x FROM h),
depth AS (SELECT list(r ORDER BY r)[ceil(0.95 * (count(*) - 1))::INTEGER + 1] AS depth FROM o WHERE x <= 10),
binary_top AS (SELECT query, vec_id, score, place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS place FROM o, depth WHERE r <= depth) WHERE place <= 10)"""


@query("V19_binary_quantisation", f"WITH {SQL_E}, {SQL_RQ}, {SQL_BINARY} SELECT * FROM binary_top")
def _(t):
    return V.binary_search(t.embeddings, "vec_id", "embedding", row_queries(t), 10, DIMS, own=False)


@query("V20_product_quantisation", SQL_REACHED)
def _(t):
    return reaching(t, V.pq_search(t.embeddings, "vec_id", "embedding", row_queries(t), 10, DIMS, parts=16, codes=64, own=False))


@query("V21_recall", f"""
WITH {SQL_E}, {SQL_RQ}, {SQL_BINARY}, exact AS ({SQL_RTOP} WHERE place <= 10)
SELECT query, count(binary_top.vec_id) / 10 AS recall, avg(count(binary_top.vec_id)) OVER () / 10 >= 0.9 AS reached FROM exact LEFT JOIN binary_top USING (query, vec_id) GROUP BY 1""")
def _(t):
    exact = stored(exact_rows(t), "exact")
    approximate = V.binary_search(t.embeddings, "vec_id", "embedding", row_queries(t), 10, DIMS, own=False, exact=exact)
    recalls = stored(V.recall(approximate, exact, "vec_id", 10), "recalls")
    return recalls.withColumn("reached", recalls.agg(F.avg("recall")).scalar() >= 0.9)


@query("V22_ranking_metrics", f"""
WITH {SQL_E}, {SQL_RQ}, r AS (SELECT x.*, CASE WHEN label = qlabel THEN 1 ELSE 0 END AS rel FROM ({SQL_RTOP} WHERE place <= 10) x JOIN e USING (vec_id) JOIN rq USING (query)),
a AS (SELECT *, sum(rel) OVER (PARTITION BY query ORDER BY place) AS found, row_number() OVER (PARTITION BY query ORDER BY rel DESC, place) AS ideal FROM r)
SELECT query, max(rel)::DOUBLE AS hit, coalesce(max(CASE WHEN rel = 1 THEN 1 / place END), 0) AS reciprocal_rank,
 round(coalesce(sum((pow(2, rel) - 1) / log2(place + 1)) / nullif(sum((pow(2, rel) - 1) / log2(ideal + 1)), 0), 0), 6) AS ndcg,
 round(coalesce(sum(CASE WHEN rel = 1 THEN found / place END) / nullif(sum(rel), 0), 0), 6) AS average_precision FROM a GROUP BY 1""")
def _(t):
    from sparkweave.operators.rank_metrics import ranking_metrics

    q = row_queries(t, F.col("label").alias("qlabel"))
    top = V.top_k(t.embeddings, "vec_id", "embedding", q, 10, own=False)
    judged = top.join(t.embeddings.select("vec_id", "label"), "vec_id").join(q.select("query", "qlabel"), "query")
    return ranking_metrics(judged.withColumn("rel", (F.col("label") == F.col("qlabel")).cast("int")), "query", "place", "rel")


#: Depth of the lists that are fused, and of the shortlist that is made diverse.
FUSED, HYBRID, SHORTLIST = 50, 20, 50


def rankings(t):
    d = t.documents.join(t.labels, "doc_id").select(F.col("lang").alias("query"), "doc_id", "n_chars", "quality")
    by_length = top_n_per_group(d, ["query"], [F.col("n_chars").desc(), F.col("doc_id")], FUSED)
    by_label = top_n_per_group(d, ["query"], [F.col("quality").desc(), F.col("doc_id")], FUSED)
    cols = ["query", "doc_id", F.col("rank").alias("place")]
    return by_length.select(*cols).unionByName(by_label.select(*cols))


@query("V23_rank_fusion", f"""
WITH d AS (SELECT lang AS query, doc_id, n_chars, quality FROM documents JOIN labels USING (doc_id)),
r AS (SELECT query, doc_id, row_number() OVER (PARTITION BY query ORDER BY n_chars DESC, doc_id) AS place FROM d UNION ALL SELECT query, doc_id, row_number() OVER (PARTITION BY query ORDER BY quality DESC, doc_id) FROM d)
SELECT query, doc_id, round(sum(1 / (60 + place)), 9) AS fused FROM r WHERE place <= {FUSED} GROUP BY 1, 2""")
def _(t):
    return V.fuse(rankings(t), "doc_id").withColumn("fused", F.round("fused", 9))


@query("V24_hybrid_search", f"""
WITH {SQL_E}, {SQL_BM25}, dl AS (SELECT doc_id, lang, v FROM e JOIN documents ON doc_id = vec_id),
lq AS (SELECT lang AS query, list(m ORDER BY i) AS qvec FROM (SELECT lang, i, round(avg(v[i]), 9) AS m FROM (SELECT lang, v, unnest(generate_series(1, len(v))) AS i FROM dl) GROUP BY 1, 2) GROUP BY 1),
r AS (SELECT query, doc_id, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS place FROM bm UNION ALL
 SELECT query, doc_id, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) FROM (SELECT query, doc_id, round(list_cosine_similarity(v, qvec), 6) AS score FROM dl, lq)),
f AS (SELECT query, doc_id, round(sum(1 / (60 + place)), 9) AS fused FROM r WHERE place <= {HYBRID} GROUP BY 1, 2)
SELECT query, doc_id, fused FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY fused DESC, doc_id) AS n FROM f) WHERE n <= 10""")
def _(t):
    dense = t.embeddings.join(t.documents.select(F.col("doc_id").alias("vec_id"), "lang"), "vec_id").withColumnRenamed("vec_id", "doc_id")
    q = V.centroids(dense, "lang", "embedding", DIMS).withColumnRenamed("lang", "query")
    near = V.top_k(dense, "doc_id", "embedding", q, HYBRID).select("query", "doc_id", "place")
    both = bm25_ranking(t, HYBRID).select("query", "doc_id", "place").unionByName(near)
    fused = V.fuse(both, "doc_id").withColumn("fused", F.round("fused", 9))
    return top_n_per_group(fused, ["query"], [F.col("fused").desc(), F.col("doc_id")], 10).drop("rank")


def sql_mmr(k, weight):
    """Greedy choice, one table a step: the row of largest value among those not chosen yet."""
    steps = ["c1 AS (SELECT query, arg_max(vec_id, (rel, -vec_id)) AS pick, 1 AS place FROM s GROUP BY 1)"]
    for i in range(2, k + 1):
        chosen = " UNION ALL ".join(f"SELECT * FROM c{j}" for j in range(1, i))
        steps.append(f"""c{i} AS (SELECT query, arg_max(vec_id, (value, -vec_id)) AS pick, {i} AS place FROM (
 SELECT s.query AS query, s.vec_id AS vec_id, {weight} * any_value(s.rel) - (1 - {weight}) * max(list_cosine_similarity(s.v, p.v)) AS value
 FROM s JOIN ({chosen}) c ON c.query = s.query JOIN e p ON p.vec_id = c.pick WHERE s.vec_id NOT IN (SELECT pick FROM ({chosen}) x WHERE x.query = s.query) GROUP BY 1, 2) GROUP BY 1)""")
    return ",\n".join(steps) + "\n" + " UNION ALL ".join(f"SELECT query, pick AS vec_id, place FROM c{j}" for j in range(1, k + 1))


@query("V25_mmr", f"""
WITH {SQL_E}, {SQL_RQ}, s AS (SELECT t.query AS query, t.vec_id AS vec_id, e.v AS v, list_cosine_similarity(e.v, rq.qvec) AS rel FROM ({SQL_RTOP} WHERE place <= {SHORTLIST}) t JOIN e USING (vec_id) JOIN rq USING (query)),
{sql_mmr(5, 0.5)}""")
def _(t):
    q = row_queries(t)
    short = V.top_k(t.embeddings, "vec_id", "embedding", q, SHORTLIST, own=False)
    candidates = short.join(t.embeddings.select("vec_id", "embedding"), "vec_id").join(q, "query")
    return V.diversify(candidates, "vec_id", "embedding", 5)


@query("V26_semantic_cache", f"""
WITH {SQL_E}, {SQL_RQ}, b AS (SELECT * FROM ({SQL_RTOP} WHERE place <= 1)) SELECT query, CASE WHEN score > 0.4 THEN vec_id END AS cached, coalesce(score > 0.4, false) AS hit FROM rq LEFT JOIN b USING (query)""")
def _(t):
    q = row_queries(t)
    best = V.top_k(t.embeddings, "vec_id", "embedding", q, 1, own=False).filter("score > 0.4").select("query", F.col("vec_id").alias("cached"))
    return q.select("query").join(best, "query", "left").withColumn("hit", F.col("cached").isNotNull())


@query("V27_memory_ranking", f"""
WITH {SQL_E}, c AS (SELECT list(m ORDER BY i) AS qvec FROM (SELECT i, round(avg(v[i]), 9) AS m FROM (SELECT v, unnest(generate_series(1, len(v))) AS i FROM e) GROUP BY 1))
SELECT vec_id, round(pow(0.99, date_diff('second', date_trunc('second', ts), TIMESTAMP '2024-02-01') / 3600) + 0.1 * label + list_cosine_similarity(v, qvec), 6) AS score FROM e JOIN events ON event_id = vec_id, c ORDER BY score DESC, vec_id LIMIT 10""")
def _(t):
    e = t.embeddings.join(t.events.select(F.col("event_id").alias("vec_id"), "ts"), "vec_id")
    q = V.centroids(t.embeddings.withColumn("one", F.lit(1)), "one", "embedding", DIMS).select("qvec").scalar()
    age = F.lit("2024-02-01").cast("timestamp").cast("bigint") - F.date_trunc("second", "ts").cast("timestamp").cast("bigint")
    score = F.pow(F.lit(0.99), age / 3600) + 0.1 * F.col("label") + V.cosine(F.col("embedding"), F.col("qvec"))
    return e.withColumn("qvec", q).select("vec_id", F.round(score, 6).alias("score")).orderBy(F.col("score").desc(), "vec_id").limit(10)


@query("V28_knowledge_triples", """
WITH x AS (SELECT user_id AS subject, event_type AS relation, json_extract_string(props, '$.k') AS object, event_id FROM events), f AS (SELECT subject, relation, arg_max(object, event_id) AS object FROM x GROUP BY 1, 2)
SELECT f.subject AS subject, f.relation AS relation, f.object AS object, count(n.subject) AS neighbour_facts FROM f LEFT JOIN f n ON n.subject = f.object::BIGINT GROUP BY 1, 2, 3""")
def _(t):
    x = t.events.select(
        F.struct(F.col("user_id").alias("subject"), F.col("event_type").alias("relation")).alias("key"),
        F.get_json_object("props", "$.k").alias("object"), "event_id",
    )
    facts = apply_changes(x, "key", "event_id", F.lit(False)).select("key.*", "object")
    size = facts.groupBy(F.col("subject").cast("string").alias("object")).agg(n_rows().alias("neighbour_facts"))
    return facts.join(size, "object", "left").fillna(0, ["neighbour_facts"])


def sql_pca(k, squarings=13):
    """Leading directions of the covariance matrix, one after the other: a high power of the matrix, by squaring it again and again, is
    all but a multiple of the leading direction times itself; then that direction is taken out. The largest entry is positive."""
    steps = ["""x AS MATERIALIZED (SELECT vec_id, i, v[i] AS x FROM (SELECT vec_id, v, unnest(generate_series(1, len(v))) AS i FROM e)),
means AS MATERIALIZED (SELECT i, avg(x) AS m, count(*) AS n FROM x GROUP BY 1),
c0 AS MATERIALIZED (SELECT a.i AS i, b.i AS j, sum((a.x - p.m) * (b.x - q.m)) / (any_value(p.n) - 1) AS v FROM x a JOIN x b USING (vec_id) JOIN means p ON p.i = a.i JOIN means q ON q.i = b.i GROUP BY 1, 2)"""]
    for c in range(k):
        steps.append(f"p{c}_0 AS (SELECT * FROM c{c})")
        for s in range(squarings):
            steps.append(f"p{c}_{s + 1} AS MATERIALIZED (SELECT i, j, v / max(abs(v)) OVER () AS v FROM (SELECT a.i AS i, b.j AS j, sum(a.v * b.v) AS v FROM p{c}_{s} a JOIN p{c}_{s} b ON a.j = b.i GROUP BY 1, 2))")
        last = f"p{c}_{squarings}"
        steps.append(f"""d{c} AS MATERIALIZED (SELECT i, v / sqrt(sum(v * v) OVER ()) * sign(first_value(v) OVER (ORDER BY abs(v) DESC, i)) AS v FROM {last} WHERE j = (SELECT arg_max(i, v) FROM {last} WHERE i = j))""")
        steps.append(f"l{c} AS MATERIALIZED (SELECT sum(a.v * c.v * b.v) AS l FROM c{c} c JOIN d{c} a ON a.i = c.i JOIN d{c} b ON b.i = c.j)")
        steps.append(f"c{c + 1} AS MATERIALIZED (SELECT c.i AS i, c.j AS j, c.v - l * a.v * b.v AS v FROM c{c} c JOIN d{c} a ON a.i = c.i JOIN d{c} b ON b.i = c.j, l{c})")
    columns = ", ".join(f"round(sum(x * d{c}.v), 5) AS pc{c + 1}" for c in range(k))
    joins = " ".join(f"JOIN d{c} ON d{c}.i = x.i" for c in range(k))
    return f"WITH {SQL_E}, " + ",\n".join(steps) + f" SELECT vec_id, {columns} FROM x {joins} GROUP BY 1"


@query("V29_pca", sql_pca(3))
def _(t):
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = t.embeddings.select("vec_id", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("x"))
    model = PCA(k=3, inputCol="x", outputCol="p").fit(v)
    # a direction is known but for its sign: its largest entry is made positive
    sides = [1.0 if c[abs(c).argmax()] > 0 else -1.0 for c in model.pc.toArray().T]
    p = vector_to_array("p")
    return model.transform(v).select("vec_id", *[F.round(p[i] * side, 5).alias(f"pc{i + 1}") for i, side in enumerate(sides)])


@query("P20_filter_before_search", f"""
WITH {SQL_E}, {SQL_RQ}, n AS ({SQL_NEAR}), p AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS place FROM n),
f AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS place FROM n WHERE label = 3)
SELECT query, vec_id, score, 'before' AS form FROM f WHERE place <= 5 UNION ALL SELECT query, vec_id, score, 'after' FROM p WHERE place <= 5 AND label = 3""")
def _(t):
    q = row_queries(t)
    mine = t.embeddings.filter("label = 3")
    after = V.top_k(t.embeddings, "vec_id", "embedding", q, 5, own=False).join(mine.select("vec_id"), "vec_id", "left_semi")
    return tagged(before=V.top_k(mine, "vec_id", "embedding", q, 5, own=False).drop("place"), after=after.drop("place"))
