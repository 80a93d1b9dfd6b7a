"""Text jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkweave.functions.scalars import first_reason
from sparkweave.operators import inverted_index as I
from sparkweave.operators import similar as N
from sparkweave.operators import text as X
from sparkweave.operators.aggregates import top_n_per_group
from sparkweave.operators.ordered import number_rows, running_totals
from sparkweave.plans.common import n_rows, tagged
from sparkweave.plans.registry import query
from sparkweave.sources.files import stored

SQL_WORDS = r"list_filter(regexp_split_to_array({}, '\s+'), lambda x: x <> '')"


def sql_word_chunks(size, overlap):
    return f"""SELECT doc_id, (i // {size - overlap})::INTEGER AS chunk_no, array_to_string(w[i + 1:i + {size}], ' ') AS chunk FROM
     (SELECT doc_id, w, unnest(generate_series(0, len(w) - 1, {size - overlap})) AS i FROM (SELECT doc_id, {SQL_WORDS.format('text')} AS w FROM documents) WHERE len(w) > 0)"""


@query("V01_word_chunks", f"SELECT doc_id, chunk_no, md5(chunk) AS chunk FROM ({sql_word_chunks(300, 50)})")
def _(t):
    return X.word_chunks(t.spread("documents"), "text", 300, 50, "doc_id").withColumn("chunk", F.md5("chunk"))


@query("V02_char_chunks", """
SELECT doc_id, (i // 450)::INTEGER AS chunk_no, md5(substring(text, i + 1, 500)) AS chunk FROM (SELECT doc_id, text, unnest(generate_series(0, length(text) - 1, 450)) AS i FROM documents WHERE length(text) > 0)""")
def _(t):
    return X.char_chunks(t.spread("documents"), "text", 500, 50, "doc_id").withColumn("chunk", F.md5("chunk"))


# fixed values: separators from coarse to fine
SEPARATORS = ["\n\n", "\n", ".", "!", "?", ",", " ", ""]


def sql_recursive_chunks(size, separators):
    """Level by level: pieces too long are cut after each separator and packed again; what is left is cut by length."""
    def quoted(x):
        return "'" + x.replace("\n", "' || chr(10) || '") + "'"

    levels = ["l0 AS (SELECT doc_id, [0::BIGINT] AS path, text AS t FROM documents WHERE text <> '')"]
    for i, sep in enumerate(x for x in separators if x):
        q = quoted(sep)
        levels.append(f"""l{i + 1} AS (SELECT doc_id, list_append(path, n) AS path, c[n] AS t FROM (SELECT doc_id, path, c, unnest(generate_series(1, len(c))) AS n FROM (
 SELECT doc_id, path, CASE WHEN length(t) > {size} AND contains(t, {q}) THEN list_reduce(list_transform(string_split(t, {q}), lambda p, k: [CASE WHEN k < len(string_split(t, {q})) THEN p || {q} ELSE p END]),
  lambda a, b: CASE WHEN length(a[-1]) + length(b[1]) <= {size} THEN list_append(a[:-2], a[-1] || b[1]) ELSE list_concat(a, b) END) ELSE [t] END AS c FROM l{i})) WHERE c[n] <> '')""")
    last = f"l{len(levels) - 1}"
    levels.append(f"""cut AS (SELECT doc_id, list_append(path, i) AS path, substring(t, i + 1, {size}) AS t FROM (SELECT doc_id, path, t, unnest(generate_series(0, length(t) - 1, {size})) AS i FROM {last}))""")
    return "WITH " + ",\n".join(levels) + " SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY path) - 1)::INTEGER AS chunk_no, t AS chunk FROM cut"


@query("V03_recursive_chunks", sql_recursive_chunks(500, SEPARATORS))
def _(t):
    return X.recursive_chunks(t.spread("documents"), "doc_id", "text", 500, SEPARATORS)


SQL_SENT = r"list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '')"


@query("V04_sentence_windows", rf"""
SELECT doc_id, (i - 1)::INTEGER AS sentence_no, md5(s[i]) AS sentence, md5(array_to_string(s[greatest(i - 1, 1):i + 1], ' ')) AS "window"
FROM (SELECT doc_id, s, unnest(generate_series(1, len(s))) AS i FROM (SELECT doc_id, {SQL_SENT} AS s FROM documents))""")
def _(t):
    return X.sentence_windows(t.spread("documents"), "text", 1, "doc_id").withColumns({"sentence": F.md5("sentence"), "window": F.md5("window")})


@query("V05_semantic_chunks", rf"""
WITH s AS (SELECT doc_id, s[i] AS sent, i - 1 AS no FROM (SELECT doc_id, s, unnest(generate_series(1, len(s))) AS i FROM (SELECT doc_id, {SQL_SENT} AS s FROM documents))),
w AS (SELECT doc_id, no, word, count(*) AS c FROM (SELECT doc_id, no, unnest(list_filter(string_split_regex(lower(sent), '\s+'), lambda x: x <> '')) AS word FROM s) GROUP BY ALL),
n AS (SELECT doc_id, no, sum(c * c) AS n2 FROM w GROUP BY ALL),
d AS (SELECT a.doc_id, a.no, sum(a.c * b.c) AS dot FROM w a JOIN w b ON a.doc_id = b.doc_id AND a.word = b.word AND a.no = b.no + 1 GROUP BY ALL),
f AS (SELECT s.doc_id, s.no, sent, CASE WHEN coalesce(dot, 0) / sqrt(n.n2::DOUBLE * p.n2) >= 0.75 THEN 0 ELSE 1 END AS cut FROM s JOIN n USING (doc_id, no)
 LEFT JOIN n p ON p.doc_id = s.doc_id AND p.no = s.no - 1 LEFT JOIN d ON d.doc_id = s.doc_id AND d.no = s.no),
g AS (SELECT doc_id, no, sent, sum(cut) OVER (PARTITION BY doc_id ORDER BY no) - 1 AS chunk_no FROM f)
SELECT doc_id, chunk_no::INTEGER AS chunk_no, md5(string_agg(sent, ' ' ORDER BY no)) AS chunk FROM g GROUP BY 1, 2""")
def _(t):
    return X.semantic_chunks(t.spread("documents"), "doc_id", "text", 0.75).withColumn("chunk", F.md5("chunk"))


@query("V06_parent_child_chunks", rf"""
WITH p AS ({sql_word_chunks(300, 0)}),
c AS (SELECT doc_id, chunk_no AS parent_no, (i // 60)::INTEGER AS child_no, array_to_string(w[i + 1:i + 60], ' ') AS child FROM
 (SELECT doc_id, chunk_no, w, unnest(generate_series(0, len(w) - 1, 60)) AS i FROM (SELECT doc_id, chunk_no, string_split(chunk, ' ') AS w FROM p)))
SELECT p.doc_id AS doc_id, p.chunk_no AS parent_no, hits, md5(p.chunk) AS parent FROM p JOIN
 (SELECT doc_id, parent_no, count(*) AS hits FROM c WHERE contains(child, '@') GROUP BY 1, 2) h ON h.doc_id = p.doc_id AND h.parent_no = p.chunk_no""")
def _(t):
    parents = X.word_chunks(t.spread("documents"), "text", 300, 0, "doc_id").withColumnsRenamed({"chunk_no": "parent_no", "chunk": "parent"})
    children = X.word_chunks(parents, "parent", 60, 0, "doc_id", "parent_no")
    hits = children.filter(F.col("chunk").contains("@")).groupBy("doc_id", "parent_no").agg(n_rows().alias("hits"))
    return parents.join(hits, ["doc_id", "parent_no"]).withColumn("parent", F.md5("parent"))


@query("V07_structure_chunks", r"""
WITH b AS (SELECT page_id, unnest(string_split(regexp_replace(html, '(<(?:h[1-6]|p|li|article|title)[ >])', chr(1) || '\1', 'g'), chr(1))) AS block FROM pages),
x AS (SELECT page_id, regexp_extract(block, '^<([a-z0-9]+)', 1) AS tag, trim(regexp_replace(regexp_replace(block, '<[^>]*>', ' ', 'g'), '[ \n\t\r]+', ' ', 'g'), ' ') AS txt FROM b)
SELECT page_id, tag, count(*) AS blocks, CAST(sum(length(txt)) AS BIGINT) AS chars FROM x WHERE txt <> '' GROUP BY 1, 2""")
def _(t):
    blocks = t.spread("pages").select("page_id", F.explode(F.split("html", r"(?=<(?:h[1-6]|p|li|article|title)[ >])")).alias("block"))
    txt = F.trim(F.regexp_replace(F.regexp_replace("block", "<[^>]*>", " "), "[ \n\t\r]+", " "))
    x = blocks.select("page_id", F.regexp_extract("block", "^<([a-z0-9]+)", 1).alias("tag"), txt.alias("txt"))
    return x.filter("txt <> ''").groupBy("page_id", "tag").agg(n_rows().alias("blocks"), F.sum(F.length("txt")).cast("bigint").alias("chars"))


SQL_TF = rf"tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({SQL_WORDS.format('lower(text)')}) AS term FROM documents) GROUP BY 1, 2), ln AS (SELECT doc_id, len({SQL_WORDS.format('text')}) AS dl FROM documents)"


@query("V08_tf_idf", f"""
WITH {SQL_TF}, d AS (SELECT term, count(*) AS df FROM tf GROUP BY 1)
SELECT doc_id, term, tf, round(tf / dl * ln((SELECT count(*) FROM documents) / df), 6) AS tf_idf FROM tf JOIN d USING (term) JOIN ln USING (doc_id)""")
def _(t):
    return X.tf_idf(t.spread("documents"), "doc_id", "text").withColumn("tf_idf", F.round("tf_idf", 6))


def language_queries(t):
    """Per language, its three most frequent words of six letters or more: a query set from the data."""
    tok = t.spread("documents").select("lang", F.explode(X.words(F.lower("text"))).alias("term")).filter(F.length("term") >= 6)
    counts = tok.groupBy("lang", "term").agg(n_rows().alias("n"))
    top = top_n_per_group(counts, ["lang"], [F.col("n").desc(), F.col("term")], 3)
    return top.select(F.col("lang").alias("query"), "term")


SQL_Q = rf"""q AS (SELECT query, term FROM (SELECT lang AS query, term, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, term) AS r FROM
 (SELECT lang, unnest({SQL_WORDS.format('lower(text)')}) AS term FROM documents) WHERE length(term) >= 6 GROUP BY 1, 2) WHERE r <= 3)"""
SQL_BM25 = f"""{SQL_TF}, {SQL_Q}, st AS (SELECT count(*) AS n, avg(dl) AS a FROM ln), dd AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
bm AS (SELECT query, doc_id, round(sum(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / a))), 6) AS score FROM q JOIN tf USING (term) JOIN dd USING (term) JOIN ln USING (doc_id), st GROUP BY 1, 2)"""


def bm25_ranking(t, k):
    # the query terms are a few rows; written once, they are not counted again for every use
    queries = stored(language_queries(t), "queries")
    index = I.build_index(t.spread("documents"), "doc_id", "text")
    scores = I.search(index, queries, k).withColumn("score", F.round("score", 6))
    return top_n_per_group(scores, ["query"], [F.col("score").desc(), F.col("doc_id")], k).withColumnRenamed("rank", "place")


@query("V09_bm25", f"""
WITH {SQL_BM25} SELECT query, doc_id, score, place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS place FROM bm) WHERE place <= 10""")
def _(t):
    return bm25_ranking(t, 10)


#: Of every item the least one that its links reach; ``links(a, b)`` and ``items(id)`` come before.
SQL_GROUPS = """ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links), reach(node, goal) AS (SELECT DISTINCT a, a FROM ways UNION SELECT r.node, l.b FROM reach r JOIN ways l ON l.a = r.goal),
least AS (SELECT node, min(goal) AS goal FROM reach GROUP BY 1)"""


@query("V16_minhash_near_duplicates", rf"""
WITH RECURSIVE w AS (SELECT doc_id, {SQL_WORDS.format('lower(text)')} AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT DISTINCT doc_id, coalesce(array_to_string(w[i:i + 2], ' '), '') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE c / (p.n + q.n - c) >= 0.8), {SQL_GROUPS}
SELECT doc_id, coalesce(goal, doc_id) AS "group" FROM documents LEFT JOIN least ON node = doc_id""")
def _(t):
    links = N.near_duplicate_texts(t.spread("documents"), "doc_id", "text", 0.8)
    return N.duplicate_groups(t.documents, "doc_id", links)


def word_md5(word):
    """The upper half of a word's md5 as a signed number: a hash that other engines have, too."""
    return F.conv(F.substring(F.md5(word), 1, 16), 16, -10).cast("bigint")


@query("V17_simhash_near_duplicates", rf"""
WITH RECURSIVE w AS (SELECT page_id, ('0x' || substr(md5(w), 1, 16))::UBIGINT AS h FROM (SELECT page_id, unnest(string_split_regex(lower(html), '\W+')) AS w FROM pages) WHERE w <> ''),
v AS (SELECT page_id, i, 2 * sum((h >> i) & 1) > count(*) AS one FROM w, (SELECT unnest(generate_series(0, 63))::UBIGINT AS i) GROUP BY 1, 2),
f AS (SELECT p.page_id AS page_id, coalesce(sum(CASE WHEN one THEN 1::HUGEINT << i::INTEGER ELSE 0::HUGEINT END), 0)::UBIGINT AS f FROM pages p LEFT JOIN v ON v.page_id = p.page_id WHERE html IS NOT NULL GROUP BY 1),
links AS (SELECT x.page_id AS a, y.page_id AS b FROM f x JOIN f y ON x.page_id < y.page_id AND bit_count(xor(x.f, y.f)) <= 3), {SQL_GROUPS}
SELECT page_id, coalesce(goal, page_id) AS "group" FROM pages LEFT JOIN least ON node = page_id""")
def _(t):
    links = N.near_duplicate_pages(t.spread("pages"), "page_id", "html", 3, word_md5)
    return N.duplicate_groups(t.pages, "page_id", links)


def sql_pii(c):
    return ", ".join(f"CASE WHEN regexp_matches({c}, '(?i){p}') THEN '{k}' END" for k, p in X.PII_PATTERNS.items())


def sql_redacted(c):
    for k, p in X.PII_PATTERNS.items():
        c = f"regexp_replace({c}, '(?i){p}', '[{k.upper()}]', 'g')"
    return c


@query("V30_pii", f"SELECT doc_id, concat_ws(',', {sql_pii('text')}) AS kinds, md5({sql_redacted('text')}) AS redacted FROM documents")
def _(t):
    return t.spread("documents").select("doc_id", F.array_join(X.pii_types("text"), ",").alias("kinds"), F.md5(X.redact("text")).alias("redacted"))


def sql_has(c, phrases):
    return "(" + " OR ".join(f"contains(lower({c}), '{p}')" for p in phrases) + ")"


# words the invented prose really uses, so that every branch is taken
EXTRA_INJECTION, EXTRA_TOPIC = ["thethe", "derder"], ["and the", "und der"]


@query("V31_input_checks", f"""
SELECT conv_id, turn, length(text) > 2000 AS too_long, {sql_has('text', X.INJECTION_KEYWORDS + EXTRA_INJECTION)} AS injection, {sql_has('text', X.TOPIC_PHRASES + EXTRA_TOPIC)} AS topic, {sql_has('text', X.ADVICE_PHRASES)} AS advice,
 CASE WHEN length(text) > 2000 THEN 'input too long' WHEN {sql_has('text', X.INJECTION_KEYWORDS + EXTRA_INJECTION)} THEN 'injection attempt'
  WHEN {sql_has('text', X.TOPIC_PHRASES + EXTRA_TOPIC)} THEN 'guarded topic' WHEN concat_ws(',', {sql_pii('text')}) <> '' THEN 'personal data' WHEN {sql_has('text', X.ADVICE_PHRASES)} THEN 'advice' ELSE 'OK' END AS reason FROM conversations""")
def _(t):
    too_long = F.length("text") > 2000
    injection = X.first_phrase("text", X.INJECTION_KEYWORDS + EXTRA_INJECTION).isNotNull()
    topic = X.first_phrase("text", X.TOPIC_PHRASES + EXTRA_TOPIC).isNotNull()
    advice = X.first_phrase("text", X.ADVICE_PHRASES).isNotNull()
    reason = first_reason([
        (too_long, F.lit("input too long")), (injection, F.lit("injection attempt")), (topic, F.lit("guarded topic")),
        (F.size(X.pii_types("text")) > 0, F.lit("personal data")), (advice, F.lit("advice")),
    ])
    return t.conversations.select(
        "conv_id", "turn", too_long.alias("too_long"), injection.alias("injection"), topic.alias("topic"), advice.alias("advice"), reason.alias("reason")
    )


@query("V32_output_checks", """
SELECT conv_id, turn, concat_ws('; ', CASE WHEN length(text) < 40 THEN 'too short' END, CASE WHEN length(text) > 1000 THEN 'too long' END,
 CASE WHEN contains(lower(text), 'i cannot') THEN 'refusal: i cannot' END, CASE WHEN contains(lower(text), 'i am unable to') THEN 'refusal: i am unable to' END,
 CASE WHEN contains(lower(text), 'as an ai, i') THEN 'refusal: as an ai, i' END, CASE WHEN NOT contains(lower(text), 'e') THEN 'missing: e' END, CASE WHEN contains(lower(text), 'http') THEN 'forbidden: http' END) AS issues
FROM conversations WHERE role = 'assistant'""")
def _(t):
    issues = X.output_issues("text", 40, 1000, must=["e"], must_not=["http"])
    return t.conversations.filter("role = 'assistant'").select("conv_id", "turn", F.array_join(issues, "; ").alias("issues"))


@query("V33_instruction_rows", """
SELECT doc_id, 'Classify this text into one of: good, bad' AS instruction, md5(text) AS input, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS output, true AS parses FROM documents JOIN labels USING (doc_id)""")
def _(t):
    row = F.struct(
        F.lit("Classify this text into one of: good, bad").alias("instruction"), F.col("text").alias("input"),
        F.when(F.col("quality") == 1, "good").otherwise("bad").alias("output"),
    )
    lines = t.documents.join(t.labels, "doc_id").select("doc_id", F.to_json(row).alias("line"))
    back = lines.select("doc_id", F.from_json("line", "instruction string, input string, output string").alias("r"))
    return back.select("doc_id", "r.instruction", F.md5("r.input").alias("input"), "r.output", F.col("r").isNotNull().alias("parses"))


#: Fixed values.
ROLES = {"user": "human", "assistant": "gpt", "system": "system"}
TURNS_PER_RECORD = 1000


@query("V34_nested_conversations", """
SELECT conv_id, turn, CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS speaker, md5(text) AS value, turn // 1000 AS part FROM conversations""")
def _(t):
    # a record holds at most a thousand turns; longer conversations go on in their next part
    names = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    turn = F.struct("turn", F.element_at(names, F.col("role")).alias("from"), F.col("text").alias("value"))
    nested = t.conversations.groupBy("conv_id", F.floor(F.col("turn") / TURNS_PER_RECORD).alias("part")).agg(
        F.sort_array(F.collect_list(turn)).alias("conversations")
    )
    lines = nested.select("conv_id", "part", F.to_json(F.struct("conversations")).alias("line"))
    schema = "conversations array<struct<turn: bigint, `from`: string, value: string>>"
    return lines.select("conv_id", "part", F.inline(F.from_json("line", schema)["conversations"])).select(
        "conv_id", "turn", F.col("from").alias("speaker"), F.md5("value").alias("value"), "part"
    )


@query("V35_preference_pairs", """
WITH a AS (SELECT source || '/' || lang AS prompt, doc_id, quality * 10 - toxic * 5 AS score, n_chars FROM documents JOIN labels USING (doc_id)),
r AS (SELECT prompt, arg_max(doc_id, (score, n_chars, doc_id)) AS chosen, arg_min(doc_id, (score, n_chars, doc_id)) AS rejected, max(score) AS hi, min(score) AS lo FROM a GROUP BY 1)
SELECT prompt, chosen, rejected FROM r WHERE hi > lo""")
def _(t):
    a = t.documents.join(t.labels, "doc_id").select(
        F.concat_ws("/", "source", "lang").alias("prompt"), "doc_id", (F.col("quality") * 10 - F.col("toxic") * 5).alias("score"), "n_chars"
    )
    order = F.struct("score", "n_chars", "doc_id")
    r = a.groupBy("prompt").agg(
        F.max_by("doc_id", order).alias("chosen"), F.min_by("doc_id", order).alias("rejected"), F.max("score").alias("hi"), F.min("score").alias("lo")
    )
    return r.filter("hi > lo").select("prompt", "chosen", "rejected")


@query("V36_example_validation", rf"""
SELECT doc_id, CASE WHEN coalesce(source, '') = '' THEN 'missing instruction' WHEN length(coalesce(text, '')) < 200 THEN 'input too short' WHEN lang NOT IN ('en', 'de', 'fr') THEN 'invalid label: ' || lang
 WHEN len({SQL_WORDS.format('text')}) > 500 THEN 'input too long' ELSE 'OK' END AS reason FROM documents""")
def _(t):
    reason = first_reason([
        (F.coalesce("source", F.lit("")) == "", F.lit("missing instruction")),
        (F.length(F.coalesce("text", F.lit(""))) < 200, F.lit("input too short")),
        (~F.col("lang").isin("en", "de", "fr"), F.concat(F.lit("invalid label: "), "lang")),
        (F.size(X.words("text")) > 500, F.lit("input too long")),
    ])
    return t.spread("documents").select("doc_id", reason.alias("reason"))


@query("V37_balanced_sample", """
SELECT quality, toxic, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY quality, toxic ORDER BY md5(doc_id::VARCHAR), doc_id) AS r FROM labels) WHERE r <= 20""")
def _(t):
    order = [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")]
    return top_n_per_group(t.labels, ["quality", "toxic"], order, 20).select("quality", "toxic", "doc_id")


@query("V38_train_validation_split", """
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) <= floor((SELECT count(*) FROM documents) * 0.9) THEN 'train' ELSE 'validation' END AS part FROM documents""")
def _(t):
    # the hash is uniform, so its first characters cut the order into even bins
    h = t.documents.select("doc_id", F.md5(F.col("doc_id").cast("string")).alias("h")).withColumn("bin", F.substring("h", 1, 3))
    n = number_rows(h, [], [F.col("h"), F.col("doc_id")], "bin")
    return n.select("doc_id", F.when(F.col("rn") <= F.floor(F.col("rn_all") * 0.9), "train").otherwise("validation").alias("part"))


@query("V39_token_budget", rf"""
SELECT doc_id, len({SQL_WORDS.format('text')})::INTEGER AS tokens, len({SQL_WORDS.format('text')}) / 1e6 * 0.15::DOUBLE AS cost_usd, len({SQL_WORDS.format('text')}) + 500 > 1000 AS over_budget FROM documents""")
def _(t):
    tokens = F.size(X.words("text"))
    return t.spread("documents").select("doc_id", tokens.alias("tokens"), (tokens / 1e6 * 0.15).alias("cost_usd"), (tokens + 500 > 1000).alias("over_budget"))


@query("V40_context_trim", """
WITH s AS (SELECT conv_id, CAST(sum(CASE WHEN role = 'system' THEN length(text) ELSE 0 END) AS BIGINT) AS sys FROM conversations GROUP BY 1),
r AS (SELECT c.conv_id AS conv_id, turn, role, sys, CAST(sum(CASE WHEN role = 'system' THEN 0 ELSE length(text) END) OVER (PARTITION BY c.conv_id ORDER BY turn DESC) AS BIGINT) AS back FROM conversations c JOIN s ON s.conv_id = c.conv_id)
SELECT conv_id, turn, role FROM r WHERE role = 'system' OR sys + back <= 3000""")
def _(t):
    is_system = F.col("role") == "system"
    c = t.conversations.select("conv_id", "turn", "role", F.length("text").alias("n")).withColumn("bin", F.floor(F.col("turn") / 1000))
    sizes = {"back": F.when(is_system, 0).otherwise(F.col("n")), "sys": F.when(is_system, F.col("n")).otherwise(0)}
    r = running_totals(c, ["conv_id"], [F.col("turn").desc()], "bin", sizes, descending=True)
    return r.filter(is_system | (F.col("sys_all") + F.col("back") <= 3000)).select("conv_id", "turn", "role")
