"""The dealt queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkweave.llm import (
    cross_polytope, decontaminate, fill_middle, html_crf, language_id, mixing, ngram_join, pii, quality_rff, quality_rules, spelling, toxicity, url_filter,
)
from sparkweave.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql:
            CHECKS[name] = sql.strip()
        return fn

    return add


@query(
    "op7_decontaminate",
    r"""
    WITH words AS (
      SELECT 'd' AS kind, doc_id AS id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
      UNION ALL
      SELECT 'b', item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') FROM benchmark),
    grams AS (
      SELECT DISTINCT id AS item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram
      FROM (SELECT id, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM words WHERE kind = 'b' AND len(w) > 0)),
    widths AS (SELECT DISTINCT k FROM grams),
    probes AS (
      SELECT id, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram
      FROM (SELECT id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM words, widths WHERE kind = 'd' AND len(w) >= k)),
    hits AS (SELECT p.id, p.i, p.k, g.item_id FROM probes p JOIN grams g USING (k, gram)),
    covered AS (SELECT id, count(DISTINCT pos) AS n FROM (SELECT id, unnest(generate_series(i, i + k - 1)) AS pos FROM hits) GROUP BY id),
    items AS (SELECT id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
      FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY id)
    SELECT d.id AS doc_id, len(d.w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
      sha256(coalesce(t.list, '')) AS items_sha256, coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(d.w) AS contaminated
    FROM words d LEFT JOIN covered c ON c.id = d.id LEFT JOIN items t ON t.id = d.id WHERE d.kind = 'd'
    """,
)
def op7(t: Tables) -> DataFrame:
    marks = decontaminate.benchmark_hits(t.documents, t.benchmark)
    items = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return marks.select(
        F.col("_id").alias("doc_id"), "n_words", decontaminate.n_hit().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query("op1_html_text")
def op1(t: Tables) -> DataFrame:
    texts = html_crf.extract(t.pages)
    return texts.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query("op2_mixing")
def op2(t: Tables) -> DataFrame:
    rates = mixing.mixing_rates(t.documents)
    return rates.select(F.col("_id").alias("doc_id"), "size", "source_size", "target", "taken", "rate", "copies")


@query("op3_language")
def op3(t: Tables) -> DataFrame:
    return language_id.identify(t.documents).select(F.col("_id").alias("doc_id"), "held_out", "lang_pred", "score")


@query("op4_quality")
def op4(t: Tables) -> DataFrame:
    scores = quality_rff.score_documents(t.documents, t.labels)
    return scores.select(F.col("_id").alias("doc_id"), "held_out", "score", "predicted")


@query("op5_pii")
def op5(t: Tables) -> DataFrame:
    found = pii.find(t.documents)
    base = F.filter("spans", lambda s: s["kind"] < pii.KINDS.index("term"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    return found.select(
        F.col("_id").alias("doc_id"), *[count(k) for k in ("email", "ip", "card", "phone")],
        F.sha2(pii.span_text(base).cast("binary"), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"),
    )


@query(
    "op6_ngram_join",
    r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, hash(w[i:i + 3]) AS s FROM (
        SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM words WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    sets AS (SELECT doc_id, hash(list(s ORDER BY s)) AS h FROM shingles GROUP BY doc_id),
    firsts AS (SELECT h, min(doc_id) AS first FROM sets GROUP BY h),
    picked AS (SELECT s.doc_id, s.s, z.n FROM shingles s JOIN firsts f ON f.first = s.doc_id JOIN sizes z ON z.doc_id = s.doc_id),
    shared AS (
      SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) - count(*) AS u, count(*) AS c
      FROM picked a JOIN picked b ON a.s = b.s AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 85
      GROUP BY a.doc_id, b.doc_id),
    links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * u UNION SELECT b, a FROM shared WHERE 100 * c >= 85 * u),
    reach(node, goal) AS (SELECT first, first FROM firsts UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.goal),
    best AS (SELECT node, min(goal) AS component_id FROM reach GROUP BY node)
    SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(b.component_id, d.doc_id) AS component_id
    FROM documents d LEFT JOIN sizes z USING (doc_id) LEFT JOIN sets s USING (doc_id) LEFT JOIN firsts f ON f.h = s.h
      LEFT JOIN best b ON b.node = f.first
    """,
)
def op6(t: Tables) -> DataFrame:
    return ngram_join.join_components(t.documents)


@query("op8_quality_rules")
def op8(t: Tables) -> DataFrame:
    return quality_rules.judge(t.documents).select(
        F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance",
    )


@query("op9_toxicity")
def op9(t: Tables) -> DataFrame:
    scores = toxicity.score_documents(t.documents, t.labels)
    return scores.select(F.col("_id").alias("doc_id"), "held_out", "score", "predicted")


#: Fixed values of the contract.
URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
]


@query(
    "op10_url_filter",
    r"""
    WITH RECURSIVE rules(action, rule) AS (VALUES ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'),
      ('block', 'net/es/'), ('block', 'net/fr/')),
    links AS (
      SELECT DISTINCT url, regexp_extract(tag, 'href\s*=\s*"([^"]*)"', 1) AS target FROM (
        SELECT url, unnest(regexp_extract_all(html, '(?i)<link\b[^>]*\brel\s*=\s*"?canonical\b[^>]*>')) AS tag FROM pages WHERE html ILIKE '%canonical%')
      UNION
      SELECT DISTINCT url, trim(regexp_extract(tag, '(?i)url\s*=\s*([^"''>]*)', 1)) FROM (
        SELECT url, unnest(regexp_extract_all(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*"?refresh\b[^>]*>')) AS tag FROM pages WHERE html ILIKE '%refresh%')),
    urls AS (SELECT url FROM pages UNION SELECT url FROM links UNION SELECT target FROM links WHERE target <> ''),
    parts AS (
      SELECT url, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1), '') AS path, coalesce(regexp_extract(url, '^.*?://[^?#]*(\?[^#]*)', 1), '') AS query FROM urls),
    ruled AS (
      SELECT p.*, host || path || query AS node, r.rule, r.action FROM parts p LEFT JOIN rules r
        ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
          AND starts_with(path, substr(rule, length(split_part(rule, '/', 1)) + 1))
      QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(rule) DESC NULLS LAST) = 1),
    pairs AS (SELECT a.node AS a, b.node AS b FROM links l JOIN ruled a ON a.url = l.url JOIN ruled b ON b.url = l.target),
    reach(node) AS (
      SELECT node FROM ruled WHERE action = 'block' AND (node IN (SELECT a FROM pairs) OR node IN (SELECT b FROM pairs))
      UNION
      SELECT CASE WHEN p.a = r.node THEN p.b ELSE p.a END FROM reach r JOIN pairs p ON p.a = r.node OR p.b = r.node)
    SELECT page_id, host, path, rule, coalesce(action, CASE WHEN node IN (SELECT node FROM reach) THEN 'block' ELSE 'allow' END) AS verdict
    FROM pages p JOIN ruled r ON p.url IS NOT DISTINCT FROM r.url
    """,
)
def op10(t: Tables) -> DataFrame:
    verdicts = url_filter.judge_pages(t.pages, url_filter.rule_table(t.spark, URL_RULES))
    return verdicts.select("page_id", "host", "path", "rule", "verdict")


@query(
    "op11_spelling",
    r"""
    WITH RECURSIVE step(i, k, v) AS (
      SELECT i, 0, i FROM range(256) t(i) UNION ALL
      SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END FROM step WHERE k < 8),
    tab AS (SELECT list(v ORDER BY i) AS t FROM step WHERE k = 8),
    runs AS (
      SELECT doc_id, run, count(*) AS c FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
      WHERE length(run) >= 6 GROUP BY 1, 2),
    sums AS (
      SELECT run, c, xor(list_reduce(list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
        lambda a, b: xor(t[xor(a, b) % 256 + 1], a >> 8), 4294967295::BIGINT), 4294967295::BIGINT) AS h
      FROM (SELECT run, c, hex(encode(doc_id::VARCHAR || ':' || run)) AS x FROM runs), tab),
    cut AS (
      SELECT c, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM sums),
    w AS (SELECT word, sum(c)::BIGINT AS n FROM cut WHERE length(word) >= 6 GROUP BY 1 HAVING sum(c) >= 5),
    places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w),
    less AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM places),
    near AS (
      SELECT a.word AS word, b.word AS other FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND length(a.word) = length(b.word) WHERE a.word <> b.word
      UNION SELECT l.word, s.word FROM less l JOIN w s ON s.word = l.rest UNION SELECT s.word, l.word FROM less l JOIN w s ON s.word = l.rest),
    best AS (
      SELECT near.word AS word, count(*) AS n_near, arg_min(other, (-o.n, other)) AS form, max(o.n) AS form_n FROM near JOIN w o ON o.word = other GROUP BY 1),
    forms AS (
      SELECT w.word AS word, w.n AS n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form,
        CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n FROM w LEFT JOIN best USING (word)),
    way(word, stop, d) AS (SELECT word, word, 0 FROM forms UNION ALL SELECT way.word, f.form, d + 1 FROM way JOIN forms f ON f.word = way.stop WHERE f.form IS NOT NULL),
    roots AS (SELECT word, arg_max(stop, d) AS root FROM way GROUP BY 1)
    SELECT f.word AS word, form, root, n, n_near, form_n FROM forms f JOIN roots r ON r.word = f.word
    """,
)
def op11(t: Tables) -> DataFrame:
    return spelling.variants(t.documents)


@query(
    "op12_fill_middle",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    w AS (
      SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
        ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
    k AS (
      SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
          WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM w),
    c AS (
      SELECT doc_id, t, n, form, coalesce(array_to_string(w[1:a], ''), '') AS p, coalesce(array_to_string(w[a + 1:b], ''), '') AS m,
        coalesce(array_to_string(w[b + 1:n], ''), '') AS s FROM k)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
      sha256(t) AS restored_sha256 FROM c
    """,
)
def op12(t: Tables) -> DataFrame:
    formed = fill_middle.fill_in_middle(t.documents)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return formed.select(
        F.col("_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


@query("op13_nearest")
def op13(t: Tables) -> DataFrame:
    return cross_polytope.nearest(t.embeddings)
