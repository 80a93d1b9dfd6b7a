"""Text and vector jobs against brute force on small fixtures."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkweave.functions import scalars as S
from sparkweave.functions import udfs as U
from sparkweave.operators import geo
from sparkweave.operators import bucket_links, similar as N
from sparkweave.operators import inverted_index as I
from sparkweave.operators import text as X
from sparkweave.operators import sign_codes as C, vector_groups as G
from sparkweave.operators import vectors as V
from sparkweave.plans import CHECKS, QUERIES


def grams(text, n=3):
    w = text.lower().split()
    return {" ".join(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))}


def make_texts():
    """Distinct texts, a family of near copies of one text, and many exact copies."""
    rng = np.random.default_rng(2)
    vocab = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(vocab, 60)) for _ in range(12)]
    family = []
    for i in range(10):
        w = base[0].split()
        w[int(rng.integers(0, 60))] = f"changed{i}"
        family.append(" ".join(w))
    return base + family + [base[1]] * 15


def closure(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return {frozenset(y for y in parent if find(y) == find(x)) for x in list(parent)}


def test_near_duplicate_texts_match_brute_force(spark):
    texts = make_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = N.near_duplicate_texts(df, "id", "t", 0.8).collect()
    sets = [grams(x) for x in texts]
    jac = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    want = {(b, a) for a in range(len(texts)) for b in range(a + 1, len(texts)) if jac(a, b) >= 0.8}
    assert {(r["id"], r["leader"]) for r in got} <= want
    for r in got:
        assert r["score"] == pytest.approx(jac(r["id"], r["leader"]))
    assert {x for r in got for x in (r["id"], r["leader"])} == {x for p in want for x in p}
    assert closure([(r["id"], r["leader"]) for r in got]) == closure(want)


@pytest.mark.parametrize("block", [2, 8192])
def test_chains_are_closed(spark, monkeypatch, block):
    """Members that only others of the bucket draw in, in one bucket and over several, in one block and over several."""
    monkeypatch.setattr(bucket_links, "BLOCK", block)
    prints = [0, 7, 63, 511, 4095, 1 << 40, (1 << 40) + 7, (1 << 40) + 63, 1 << 50, 7 << 50]
    features = spark.createDataFrame(list(enumerate(prints)), "id bigint, f bigint")
    members = features.select("id", F.lit(1).cast("bigint").alias("bucket")).unionByName(features.filter("id > 3").select("id", F.lit(2).cast("bigint").alias("bucket")))
    links = bucket_links.bucket_links(members, features, N.bits_near(3), lambda p: N._bits_apart("f_a", "f_b") <= 3).collect()
    near = [(a, b) for a in range(len(prints)) for b in range(a + 1, len(prints)) if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert {(r["a"], r["b"]) for r in links} <= set(near)
    assert closure([(r["a"], r["b"]) for r in links]) == closure(near)


def test_edges_that_fail_are_replaced(spark, monkeypatch):
    """Near pairs are not all linked: a bucket is gone through again until no near pair is left unverified."""
    monkeypatch.setattr(bucket_links, "FORESTS", 2)
    monkeypatch.setattr(bucket_links, "MORE", 2)
    rng = np.random.default_rng(3)
    n = 60
    linked = {(int(a), int(b)) for a, b in zip(rng.integers(0, n, 90), rng.integers(0, n, 90)) if a < b}
    wanted = spark.createDataFrame(sorted(linked), "a bigint, b bigint")
    features = spark.createDataFrame([(i, 0) for i in range(n)], "id bigint, f bigint")  # all are near
    members = features.select("id", F.lit(1).cast("bigint").alias("bucket"))
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs.join(wanted, ["a", "b"], "left_semi")

    links = [tuple(r) for r in bucket_links.bucket_links(members, features, N.bits_near(3), lambda p: F.lit(True), verify).collect()]
    assert set(links) <= linked and closure(links) == closure(linked)
    assert seen[0] == n - 1 and seen[1] <= 2 * (n - 1) and 2 < len(seen) <= 12  # the leader's pairs, then 2, 4, 8... forests


def test_members_that_are_read_again_are_written_once(spark, monkeypatch):
    """Sizes, places and lists of a further turn come from one join of the members with the buckets that failed."""
    monkeypatch.setattr(bucket_links, "FORESTS", 1)
    monkeypatch.setattr(bucket_links, "MORE", 2)
    plain, plans = bucket_links._edges, []
    monkeypatch.setattr(bucket_links, "_edges", lambda labelled, *a: (plans.append(labelled._jdf.queryExecution().optimizedPlan().toString()), plain(labelled, *a))[1])
    features = spark.createDataFrame([(i, 0) for i in range(6)], "id bigint, f bigint")
    members = features.select("id", F.lit(1).cast("bigint").alias("bucket"))
    links = bucket_links.bucket_links(members, features, N.bits_near(3), lambda p: F.lit(True), lambda pairs: pairs.filter("a = 4 AND b = 5"))
    assert [tuple(r) for r in links.collect()] == [(4, 5)]
    assert len(plans) > 1 and not any("LeftSemi" in p for p in plans)


def test_forests_are_least_and_apart():
    rng = np.random.default_rng(7)
    for _ in range(60):
        n = int(rng.integers(2, 25))
        label = rng.integers(0, rng.integers(1, n) + 1, n)
        u, v = rng.integers(0, n, 50), rng.integers(0, n, 50)
        both = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)])[:, label[u] != label[v]], axis=1)
        u, v, w = both[0], both[1], rng.integers(0, 5, both.shape[1])

        def groups(edges):
            return len(closure([(int(label[u[e]]), int(label[v[e]])) for e in edges]) if len(edges) else set()), len({x for e in edges for x in (label[u[e]], label[v[e]])})

        picks, taken, cost = bucket_links.forests(label, u, v, w, 1), [], 0
        for e in np.argsort(w, kind="stable"):  # the greedy forest
            before, touched = groups(taken)
            after, touched_now = groups([*taken, e])
            if touched_now - after > touched - before:
                taken.append(e)
                cost += w[e]
        assert len(picks) == len(taken) and w[picks].sum() == cost
        assert sorted(bucket_links.forests(label, u, v, w, 99)) == list(range(len(u)))


def test_chain_of_texts_is_closed(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in rng.integers(0, 400, 80)]
    texts = []
    for step in range(16):
        words = list(words)
        words[step * 4 + 3] = f"step{step}"
        texts.append(" ".join(words))
    order = rng.permutation(16)
    df = spark.createDataFrame([(int(i), texts[k]) for i, k in enumerate(order)], "id int, t string")
    got = N.near_duplicate_texts(df, "id", "t", 0.8).collect()
    assert closure([(r["id"], r["leader"]) for r in got]) == {frozenset(range(16))}


def test_near_duplicate_pages_match_brute_force(spark):
    texts = make_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    prints = {r["id"]: r["f"] & (2**64 - 1) for r in df.select("id", N.simhash("t").alias("f")).collect()}
    apart = lambda a, b: (prints[a] ^ prints[b]).bit_count()
    got = N.near_duplicate_pages(df, "id", "t", 3).collect()
    for r in got:
        assert apart(r["id"], r["leader"]) == r["score"] <= 3
    want = {x for a in prints for b in prints if a < b and apart(a, b) <= 3 for x in (a, b)}
    assert {x for r in got for x in (r["id"], r["leader"])} == want


def test_simhash_of_one_word_is_its_hash(spark):
    r = spark.sql("SELECT 'Word' AS t").select(N.simhash("t").alias("s"), F.xxhash64(F.lit("word")).alias("h")).first()
    assert r["s"] == r["h"]


@pytest.mark.parametrize("n,want", [(0, 0), (3, 1), (10, 2), (8, 1), (9, 2), (16, 2), (18, 3)])
def test_word_chunks_counts(spark, n, want):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(n)))], "id int, t string")
    rows = X.word_chunks(df, "t", 10, 2, "id").orderBy("chunk_no").collect()
    assert len(rows) == want
    if n == 18:
        assert rows[2]["chunk"] == "w16 w17"  # the tail is the overlap again


def test_table_function_equals_native_chunks(spark):
    spark.udtf.register("chunk_words_t", U.ChunkWords)
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(37))), (2, "")], "id int, t string")
    df.createOrReplaceTempView("chunk_input")
    a = spark.sql("SELECT id, c.* FROM chunk_input, LATERAL chunk_words_t(t, 10, 3) c").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, X.word_chunks(df, "t", 10, 3, "id").collect()))


@pytest.mark.parametrize("text", ["", "short", "a b " * 300, "x" * 1203, "One. Two!\n\nThree? " * 90, "p" * 99 + "\n\n" + "q" * 700])
def test_recursive_split_keeps_every_character(text):
    parts = X.split_recursively(text, 100, ["\n\n", "\n", ".", "!", "?", ",", " ", ""])
    assert "".join(parts) == text
    assert all(0 < len(p) <= 100 for p in parts)


def test_recursive_split_prefers_coarse_separators():
    assert X.split_recursively("aaaa\n\nbbbb", 7, ["\n\n", " "]) == ["aaaa\n\n", "bbbb"]


def test_similar_sentences_join(spark):
    df = spark.createDataFrame([(1, "Red green blue. Red green blue. One two three. One."), (2, "")], "id int, t string")
    got = [(r["id"], r["chunk_no"], r["chunk"]) for r in X.semantic_chunks(df, "id", "t", 0.75).orderBy("id", "chunk_no").collect()]
    assert got == [(1, 0, "Red green blue. Red green blue."), (1, 1, "One two three."), (1, 2, "One.")]


def test_similar_sentences_stay_in_their_row(spark):
    """Only keys and hashes are shuffled; repeated rows count once, a text without a key is cut at every sentence."""
    said = "Red\u00a0x green. RED\u00a0x green!  \n Red\u00a0x\tgreen? x y. . y x."
    rows = [(1, said), (1, said), (1, "A b. A b."), (None, "A b. A b."), (2, None), (3, "   "), (4, "No stop")]
    found = X.semantic_chunks(spark.createDataFrame(rows, "id int, t string"), "id", "t", 0.75)
    got = sorted(((r["id"] or 0, r["chunk_no"], r["chunk"]) for r in found.collect()))
    assert got == [
        (0, 0, "A b."), (0, 1, "A b."), (1, 0, "A b. A b."), (1, 0, "Red\u00a0x green."), (1, 1, "RED\u00a0x green!"),
        (1, 2, "Red\u00a0x\tgreen?"), (1, 3, "x y."), (1, 4, "."), (1, 5, "y x."), (3, 0, "   "), (4, 0, "No stop"),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_word" not in plan and "Window" not in plan


def test_first_sentences():
    assert X.first_sentences(["a b", "b a", "a c", "", "a c", "a c"], 0.75) == [0, 2, 3, 4]


def test_recursive_chunks_come_in_bounded_batches(spark, monkeypatch):
    monkeypatch.setattr(X, "HELD", 300)

    class Frame:
        schema = spark.createDataFrame([], "id bigint").schema

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    texts = ["a b " * 300, None, "", "One. Two!\n\nThree? " * 90, "short"]
    run = X.recursive_chunks(Frame(), "id", "t", 100, [" ", ""])
    out = list(run(iter([pa.RecordBatch.from_arrays([pa.array([1, 2, 3, None, 5]), pa.array(texts)], names=["id", "t"])])))
    assert max(sum(map(len, b.column(2).to_pylist())) for b in out) <= 400
    got = [(r["id"], r["chunk_no"], r["chunk"]) for b in out for r in b.to_pylist()]
    assert got == [(k, i, c) for k, x in zip([1, 2, 3, None, 5], texts) for i, c in enumerate(X.split_recursively(x or "", 100, [" ", ""]))]


def test_sentence_windows(spark):
    df = spark.createDataFrame([(1, "A b. C d! E f?")], "id int, t string")
    got = {r["sentence_no"]: r["window"] for r in X.sentence_windows(df, "t", 1, "id").collect()}
    assert got == {0: "A b. C d!", 1: "A b. C d! E f?", 2: "C d! E f?"}


def test_pii_and_redaction(spark):
    df = spark.createDataFrame([("mail bob@x.org card 1234-5678 9012 3456 id 123-45-6789",), ("plain",)], "t string")
    a, b = df.select(X.pii_types("t").alias("k"), X.redact("t").alias("r")).collect()
    assert a["k"] == ["credit_card", "ssn", "email"] and b["k"] == [] and b["r"] == "plain"
    assert a["r"] == "mail [EMAIL] card [CREDIT_CARD] id [SSN]"


def test_output_issues(spark):
    df = spark.createDataFrame([("I cannot say",), ("tiny",), ("Paris is the capital of France",)], "t string")
    got = [r[0] for r in df.select(X.output_issues("t", must=["paris"], must_not=["pirate"])).collect()]
    assert got == [["refusal: i cannot", "missing: paris"], ["too short", "missing: paris"], []]


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((6, 16)) * 4
    v = np.concatenate([c + rng.standard_normal((60, 16)) for c in centers])
    q = centers + rng.standard_normal((6, 16)) * 0.3
    vectors = spark.createDataFrame([(i, [float(x) for x in r], i % 3) for i, r in enumerate(v)], "id int, v array<float>, tenant int")
    queries = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(q)], "query int, qvec array<double>")
    sims = np.round(unit(q) @ unit(v.astype(np.float32).astype(float)).T, 6)
    return vectors, queries, sims


def best(sims, k, allowed=None):
    return {(j, int(i)) for j in range(len(sims)) for i in sorted((i for i in range(sims.shape[1]) if allowed is None or allowed(i)), key=lambda i: (-sims[j, i], i))[:k]}


def pairs(df):
    return {(r["query"], r["id"]) for r in df.collect()}


def test_exact_top_k(cloud):
    vectors, queries, sims = cloud
    assert pairs(V.top_k(vectors, "id", "v", queries, 7)) == best(sims, 7)


def test_filtered_top_k(cloud):
    vectors, queries, sims = cloud
    q = queries.withColumn("tenant", F.lit(2))
    assert pairs(V.top_k(vectors, "id", "v", q, 5, match=["tenant"])) == best(sims, 5, lambda i: i % 3 == 2)


def test_scores_meet_in_blocks(cloud, monkeypatch):
    """A task holds one block of scores, whatever the number of queries and rows, and sends the best of each query once."""
    rng = np.random.default_rng(8)
    v, q = rng.standard_normal((3000, 8)), rng.standard_normal((700, 8))
    near, sizes = V._near_rows, []
    monkeypatch.setattr(V.G, "BLOCK", 500)
    monkeypatch.setattr(V.G, "HELD", 5_000)
    monkeypatch.setattr(V, "_near_rows", lambda v, q, least, k: (sizes.append(len(v) * len(q)), near(v, q, least, k))[1])

    class Frame:  # runs a task's function here, over batches of one task
        schema = cloud[0].schema

        def select(self, *columns):
            return self

        def mapInPandas(self, run, schema):
            return run

    rows = [{"query": j, "qvec": x, "tenant": j % 3} for j, x in enumerate(q)]
    batches = [pd.DataFrame({"id": np.arange(i, i + 1000), "v": list(v[i : i + 1000]), "tenant": np.arange(i, i + 1000) % 3}) for i in (0, 1000, 2000)]
    sims = np.round(unit(q) @ unit(v).T, 6)
    for match, allowed in ((), lambda i, j: True), (["tenant"], lambda i, j: i % 3 == j % 3):
        got = pd.concat(list(V._scored(Frame(), "id", "v", cloud[1], rows, 4, match, "cosine")(iter(batches))))
        assert len(got) == 4 * len(q)
        want = {(j, i) for j in range(len(q)) for i in sorted((i for i in range(3000) if allowed(i, j)), key=lambda i: (-sims[j, i], i))[:4]}
        assert set(zip(got["query"], got["id"])) == want
    assert max(sizes) <= 500 * 256


def test_top_k_with_equal_rows_and_nan(spark):
    rows = [(i, [1.0, 0.0]) for i in (5, 3, 3, 9, 1)] + [(20, [float("nan"), 0.0]), (21, [0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "id bigint, v array<double>").coalesce(1)
    queries = spark.createDataFrame([(0, [2.0, 0.0]), (None, [0.0, 1.0])], "query int, qvec array<double>")
    got = V.top_k(vectors, "id", "v", queries, 4).orderBy("query", "place").select("query", "id", "score").collect()
    assert [tuple(r) for r in got] == [(None, i, 0.0) for i in (1, 3, 3, 5)] + [(0, i, 1.0) for i in (1, 3, 3, 5)]


def test_any_number_of_queries(cloud, monkeypatch):
    vectors, queries, sims = cloud
    few = {tuple(r) for r in V.hamming_rescore(vectors, "id", "v", queries, 10, 6).collect()}
    monkeypatch.setattr(V, "MAX_QUERIES", 2)
    assert pairs(V.top_k(vectors, "id", "v", queries, 7)) == best(sims, 7)
    assert {tuple(r) for r in V.hamming_rescore(vectors, "id", "v", queries, 10, 6).collect()} == few


def test_inverted_file_reads_probed_cells_only(cloud, monkeypatch):
    vectors, queries, _ = cloud
    plain, plans = V.stored, {}

    def planned(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, label)

    monkeypatch.setattr(V, "stored", planned)
    V.ivf_search(vectors, "id", "v", queries.limit(1), 5, 6, 2)
    assert "PartitionFilters: [isnotnull(bucket" in plans["found"]


def test_inverted_file_stops_where_cells_are_proven_farther(spark, monkeypatch):
    """Tight clusters far apart: after the first cells the distance bound leaves none, and the result is exact."""
    rng = np.random.default_rng(12)
    centers = np.eye(8)
    v = np.concatenate([c + 0.01 * rng.standard_normal((40, 8)) for c in centers])
    vectors = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id int, v array<float>")
    queries = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(centers)], "query int, qvec array<double>")
    plain, seen = V.stored, {}

    def counted(df, label):
        seen[label] = plain(df, label)
        return seen[label]

    monkeypatch.setattr(V, "stored", counted)
    got = pairs(V.ivf_search(vectors, "id", "v", queries, 10, 8, probe=8))
    assert seen["probes"].count() == 64 and seen["later"].count() == 0
    assert got == best(np.round(unit(centers) @ unit(v.astype(np.float32).astype(float)).T, 6), 10)


@pytest.mark.parametrize("search", [
    lambda v, q: V.ivf_search(v, "id", "v", q, 10, 6),
    lambda v, q: V.lsh_search(v, "id", "v", q, 10, 16, 3, 5),
    lambda v, q: V.binary_search(v, "id", "v", q, 10, 16),
    lambda v, q: V.pq_search(v, "id", "v", q, 10, 16, 4, 16),
    lambda v, q: V.hamming_rescore(v, "id", "v", q, 10, 12),
], ids=["ivf", "lsh", "binary", "pq", "hamming"])
def test_approximate_recall(cloud, search):
    vectors, queries, sims = cloud
    got = pairs(search(vectors, queries))
    assert len(got & best(sims, 10)) / 60 >= 0.9


@pytest.mark.parametrize("search", [
    lambda v, q: V.ivf_search(v, "id", "v", q, 10, 6, own=False), lambda v, q: V.lsh_search(v, "id", "v", q, 10, 16, 3, 5, own=False),
    lambda v, q: V.binary_search(v, "id", "v", q, 10, 16, own=False), lambda v, q: V.pq_search(v, "id", "v", q, 10, 16, 4, 16, own=False),
], ids=["ivf", "lsh", "binary", "pq"])
def test_rows_find_others_also_without_clusters(spark, search, monkeypatch):
    """Rows of a cloud without structure ask for their neighbours; blocks are small, so buckets are many groups."""
    monkeypatch.setattr(G, "BLOCK", 50)
    monkeypatch.setattr(G, "ASKING", 7)
    monkeypatch.setattr(G, "HELD", 200)
    v = np.random.default_rng(14).standard_normal((400, 16)).astype(np.float32)
    vectors = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id bigint, v array<float>")
    queries = vectors.filter("id % 20 = 0").selectExpr("id AS query", "v AS qvec")
    sims = np.round(unit(v[::20].astype(float)) @ unit(v.astype(float)).T, 6)
    sims[np.arange(20), np.arange(0, 400, 20)] = -9
    got = search(vectors, queries).collect()
    assert len({(r["query"] // 20, r["id"]) for r in got} & best(sims, 10)) / 200 >= 0.9
    assert len(got) == 200 and all(r["score"] == pytest.approx(sims[r["query"] // 20, r["id"]], abs=2e-6) for r in got)


@pytest.fixture(scope="module")
def copied(spark):
    """Rows without structure, a hundred of them copies of one; every second row asks. With agreements and scores by brute force."""
    v = np.random.default_rng(15).standard_normal((420, 16)).astype(np.float32)
    v[100:300:2] = v[7]
    ids = np.random.default_rng(16).permutation(420) * 3 - 200
    vectors = spark.createDataFrame([(int(i), [float(x) for x in r]) for i, r in zip(ids, v)], "id bigint, v array<float>").repartition(3)
    q = unit(v[::2].astype(float))
    sign = np.where(v > 0, 1.0, -1.0)
    alike = np.stack([sum(sign[:, i] * x[i] for i in range(16)) for x in q])  # equal signs, equal sums
    scores = np.round(np.stack([(unit(v.astype(float)) * x).sum(axis=1) for x in q]), 6)
    alike[np.arange(210), np.arange(0, 420, 2)] = scores[np.arange(210), np.arange(0, 420, 2)] = -99  # a row does not find itself
    return vectors, ids, v, alike, scores


def many_rounds(monkeypatch):
    monkeypatch.setattr(C, "STEERING", 9)
    monkeypatch.setattr(C, "FEW", 1)


def test_place_at_a_depth_is_found_by_counting(spark, copied, monkeypatch):
    """Also inside a hundred equal codes, where ids decide, and beyond the last row."""
    many_rounds(monkeypatch)
    vectors, ids, v, alike, _ = copied
    model = C.SignCodes(16)
    codes = C.coded(vectors, model)
    some = np.arange(0, 210, 9)
    names, asked = ids[::2][some], model.asked(unit(v[::2].astype(float))[some])
    for depth in (1, 150, 419, 420):
        s, last = C.Places(codes, model, depth, own=False).of(names, asked)
        for a, name, x, y in zip(alike[some], names, s, last):
            order = ids[np.lexsort((ids, -a))][:419]
            assert (x, y) == (-C.BEYOND, C.GREATEST) if depth == 420 else y == order[depth - 1]


def test_binary_search_is_as_deep_as_all_queries_need_it(copied, monkeypatch):
    """No sample of them decides; rows up to the depth are rescored and no others."""
    many_rounds(monkeypatch)
    monkeypatch.setattr(G, "SAMPLE", 5)
    vectors, ids, _, alike, scores = copied
    got = V.binary_search(vectors, "id", "v", vectors_asking(vectors, ids[::2]), 10, 16, own=False).collect()
    place = np.argsort(np.lexsort((np.broadcast_to(ids, alike.shape), -alike)), axis=1) + 1
    nearest = np.lexsort((np.broadcast_to(ids, scores.shape), -scores))[:, :10]
    ranks = np.sort(np.take_along_axis(place, nearest, axis=1), axis=None)
    depth = ranks[-(-95 * (len(ranks) - 1) // 100)]
    want = set()
    for j, (at, score) in enumerate(zip(place, scores)):
        near = np.flatnonzero(at <= depth)
        best_ones = near[np.lexsort((ids[near], -score[near]))][:10]
        want |= {(int(ids[2 * j]), int(ids[r]), n) for n, r in enumerate(best_ones, 1)}
    assert len(got) == 2100 and {(r["query"], r["id"], r["place"]) for r in got} == want


def test_binary_search_keeps_the_best_rows_only(copied, monkeypatch):
    """What a portion leaves behind grows with queries and ``k``, not with the depth, which is over a hundred rows here."""
    vectors, ids, _, _, _ = copied
    monkeypatch.setattr(V, "MAX_QUERIES", 80)
    monkeypatch.setattr(V, "CODE_QUERIES", 80)
    plain, rows = V.stored, []

    def counted(df, label):
        out = plain(df, label)
        if label == "portion":
            rows.append((out.count(), out.columns))
        return out

    monkeypatch.setattr(V, "stored", counted)
    assert V.binary_search(vectors, "id", "v", vectors_asking(vectors, ids[::2]), 10, 16, own=False).count() == 2100
    assert len(rows) >= 3 and sum(n for n, columns in rows if "score" in columns) <= 2 * 210 * 11 * 3  # exact and rescored, three tasks


@pytest.mark.parametrize("name", ["V19_binary_quantisation", "V21_recall"])
def test_queries_over_signs_agree_with_their_check_on_more_rows_than_a_sample(spark, tmp_path, monkeypatch, name):
    duckdb = pytest.importorskip("duckdb")
    monkeypatch.setattr(G, "SAMPLE", 5)
    v = np.random.default_rng(18).standard_normal((600, 64)).astype(np.float32)
    rows = spark.createDataFrame([(i, [float(x) for x in r], i % 7) for i, r in enumerate(v)], "vec_id bigint, embedding array<float>, label int")
    rows.write.parquet(f"{tmp_path}/embeddings.parquet")
    plain, exact = V.top_k, []
    monkeypatch.setattr(V, "top_k", lambda *a, **how: exact.append(a) or plain(*a, **how))
    got = QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = con.execute(CHECKS[name]).df()[got.columns]
    keys = ["query", "place"] if "place" in got.columns else ["query"]
    pd.testing.assert_frame_equal(got.toPandas().sort_values(keys, ignore_index=True), want.sort_values(keys, ignore_index=True), check_dtype=False)
    assert len(exact) == 1  # the exact neighbours are looked for once


def vectors_asking(vectors, names):
    return vectors.filter(vectors["id"].isin([int(i) for i in names])).selectExpr("id AS query", "v AS qvec")


def test_binary_search_passes_over_missing_vectors(spark, copied):
    vectors, ids, _, _, _ = copied
    holes = vectors.unionByName(spark.createDataFrame([(5000, None), (None, [1.0] * 16)], vectors.schema))
    asking = vectors_asking(vectors, ids[:40:2])
    empty = spark.createDataFrame([(5000, None)], "query bigint, qvec array<float>")
    found = [sorted(tuple(r) for r in V.binary_search(x, "id", "v", y, 10, 16, oversample=4, own=False).collect()) for x, y in ((vectors, asking), (holes, asking.unionByName(empty)))]
    assert len(found[0]) == 200 and found[0] == found[1]
    assert V.binary_search(vectors, "id", "v", empty, 10, 16, own=False).count() == 0


def test_probing_sequence_flips_the_least_margins():
    index = V.Planes(8, 2, 3)
    q = np.random.default_rng(3).standard_normal((4, 8))
    close, margins = index.closeness(q).reshape(4, 2, 8), (q @ index.planes).reshape(4, 2, 3)
    for r in range(4):
        for t in range(2):
            own = sum(1 << b for b in range(3) if margins[r, t, b] > 0)
            assert index.codes(q)[r, t] == own + (t << 3)
            for flip in range(8):
                assert close[r, t, own ^ flip] == pytest.approx(-sum(margins[r, t, b] ** 2 for b in range(3) if flip >> b & 1))


def test_learnt_rotation_lowers_the_error(spark):
    """Correlated components: codes after the learnt rotation are closer to the vectors than after the first, random one."""
    rng = np.random.default_rng(5)
    v = rng.standard_normal((600, 3)) @ rng.standard_normal((3, 12)) + 0.1 * rng.standard_normal((600, 12))
    nodes = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(unit(v))], "id bigint, v array<double>")

    def error(model):
        cell, parts = model.turned(unit(v))
        code = model.nearest_codes(parts)
        return sum(((parts[:, p] - model.books[p][code[:, p]]) ** 2).sum() for p in range(4))

    first, last = (V.learnt_codes(nodes, 12, 4, 4, 8, rounds=n) for n in (1, 8))
    assert np.allclose(last.rotation @ last.rotation.T, np.eye(12)) and error(last) < 0.8 * error(first)
    q = unit(rng.standard_normal((5, 12)))
    cell, parts = last.turned(unit(v))
    decoded = last.cells.centers[cell] + np.concatenate([last.books[p][last.nearest_codes(parts)[:, p]] for p in range(4)], axis=1) @ last.rotation.T
    assert np.allclose(last.scores(last.encode(unit(v)), last.asked(q)), decoded @ q.T)


def test_quantisation_error_is_bounded(cloud):
    vectors, _, _ = cloud
    lo, hi = V.sq8_bounds(vectors, "v", 16)
    df = vectors.select("v", lo.alias("lo"), hi.alias("hi")).withColumn("b", V.sq8_decode(V.sq8_encode(F.col("v"), F.col("lo"), F.col("hi")), F.col("lo"), F.col("hi")))
    for r in df.collect():
        assert np.all(np.abs(np.array(r["v"]) - np.array(r["b"])) <= (np.array(r["hi"]) - np.array(r["lo"])) / 510 + 1e-9)


def test_zero_vector_has_zero_cosine(spark):
    r = spark.sql("SELECT array(0f, 0f) AS a, array(1f, 2f) AS b").select(V.cosine(F.col("a"), F.col("b")), V.l1(F.col("a"), F.col("b")), V.hamming(F.col("a"), F.col("b"))).first()
    assert tuple(r) == (0.0, 3.0, 2)


def slow_mmr(q, v, k, w):
    v, q = unit(v), unit(q)
    left, out = list(range(len(v))), []
    while left and len(out) < k:
        score = {i: (v[i] @ q if not out else w * (v[i] @ q) - (1 - w) * max(v[i] @ v[j] for j in out)) for i in left}
        pick = max(left, key=lambda i: score[i])
        out.append(pick)
        left.remove(pick)
    return out


@pytest.mark.parametrize("weight", [0.2, 0.5, 0.9])
def test_diverse_choice(weight):
    rng = np.random.default_rng(6)
    v, q = rng.standard_normal((30, 8)), rng.standard_normal(8)
    assert V.pick_diverse(q, v, 6, weight) == slow_mmr(q, v, 6, weight)
    assert V.pick_diverse(q, v[:3], 6, weight) == [0, 1, 2]


def test_rank_fusion_golden(spark):
    r1, r2 = ["d1", "d2", "d3", "d4", "d5"], ["d3", "d1", "d5", "d2", "d4"]
    rows = [(0, d, i) for r in (r1, r2) for i, d in enumerate(r, 1)]
    got = {r["id"]: r["fused"] for r in V.fuse(spark.createDataFrame(rows, "query int, id string, place int"), "id").collect()}
    assert got["d1"] == pytest.approx(1 / 61 + 1 / 62) and got["d3"] == pytest.approx(1 / 63 + 1 / 61) and got["d1"] > got["d3"]


def test_ndcg_golden(spark):
    from sparkweave.operators.rank_metrics import ranking_metrics

    df = spark.createDataFrame([(0, i, r) for i, r in enumerate([3, 0, 0, 1], 1)], "query int, place int, rel int")
    r = ranking_metrics(df, "query", "place", "rel").first()
    dcg, ideal = 7 + 1 / np.log2(5), 7 + 1 / np.log2(3)
    assert r["ndcg"] == pytest.approx(dcg / ideal, abs=1e-6) and r["reciprocal_rank"] == 1.0 and r["average_precision"] == pytest.approx(0.75)


def test_geo_golden_and_neighbours(spark):
    km = spark.range(1).select(S.haversine_km(F.lit(38.115556), F.lit(13.361389), F.lit(37.502669), F.lit(15.087269))).first()[0]
    assert km == pytest.approx(166.2742, abs=0.001)
    rng = np.random.default_rng(9)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(-59, 59, 300), rng.uniform(-180, 180, 300)))]
    df = spark.createDataFrame(pts, "id int, lat double, lon double")
    got = {r["cid"]: r["near"] for r in geo.count_near(df.withColumnRenamed("id", "cid"), df, 1500, 60).collect()}

    def dist(a, b):
        p1, p2 = np.radians(a[1]), np.radians(b[1])
        h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6372.797560856 * np.arcsin(np.sqrt(h))

    for a in pts:
        assert got[a[0]] == sum(dist(a, b) <= 1500 for b in pts)


def test_failing_model_call_is_retried(spark, tmp_path):
    flag = str(tmp_path / "failed")

    def flaky(texts):
        import os

        if not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError("busy")
        return np.ones((len(texts), 4))

    df = spark.createDataFrame([(i, "x") for i in range(5)], "id int, t string").coalesce(1)
    assert U.embed_batches(df, "id", "t", flaky, batch_size=2).count() == 5


def plain_bm25(texts, terms, k1=1.5, b=0.75):
    docs = [t.lower().split() for t in texts]
    avg, n = sum(map(len, docs)) / len(docs), len(docs)
    out = {}
    for term in set(terms):
        df = sum(term in d for d in docs)
        for i, d in enumerate(docs):
            if term in d:
                tf = d.count(term)
                out[i] = out.get(i, 0) + np.log((n - df + 0.5) / (df + 0.5) + 1) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(d) / avg))
    return sorted(((round(s, 6), -i) for i, s in out.items()), reverse=True)


def test_inverted_index_reads_its_terms_only(spark):
    rng = np.random.default_rng(13)
    vocab = [f"t{i}" for i in range(300)]
    p = 1 / np.arange(1, 301)
    texts = [" ".join(rng.choice(vocab, int(rng.integers(3, 60)), p=p / p.sum())) for _ in range(400)] + ["", " "]
    index = I.build_index(spark.createDataFrame(list(enumerate(texts)), "id int, t string"), "id", "t", folders=8)
    asked = {0: ["t0", "t7", "t7", "t90"], 1: ["t250"], 2: ["t0", "t1", "t2"], 3: ["absent"], 4: ["t2"]}
    queries = spark.createDataFrame([(q, x) for q, terms in asked.items() for x in terms], "query int, term string")
    found = I.search(index, queries, 5)
    got = {}
    for r in found.collect():
        got.setdefault(r["query"], []).append((round(r["score"], 6), -r["id"]))
    for q, terms in asked.items():
        assert sorted(got.get(q, []), reverse=True)[:5] == plain_bm25(texts, terms)[:5]
    plan = I.search(index, queries.filter("query = 1"), 5)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan or "PartitionFilters: [folder" in plan or "(folder#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # blocks that cannot hold one of the best are not read
    read = I.wanted_blocks(index, queries, 5).filter("query = 4").join(index.blocks, ["term", "level"]).agg(F.sum("n")).first()[0]
    every = index.postings.filter("term = 't2'").count()
    assert 5 <= read < every


def test_words_of_a_row_are_counted_in_the_row(spark):
    df = spark.createDataFrame([(1, "b a b  B c"), (2, ""), (3, None), (4, "x")], "id int, t string")
    got = {(r["id"], r["dl"], r["term"], r["tf"]) for r in X.postings(df, "id", "t").collect()}
    assert got == {(1, 5, "a", 1), (1, 5, "b", 3), (1, 5, "c", 1), (4, 1, "x", 1)}
    assert "Exchange" not in X.postings(df, "id", "t")._jdf.queryExecution().executedPlan().toString()


def test_words_are_sorted_by_their_own_order(spark):
    """A comparator that is a lambda is run in the interpreter for every two words."""
    plan = X.postings(spark.createDataFrame([(1, "b a")], "id int, t string"), "id", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan
