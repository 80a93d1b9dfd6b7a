"""Cuts by boundary sets, spelling variants and cross-polytope search against brute force, and every awkward row."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkweave.llm import cross_polytope, fill_middle, spelling
from sparkweave.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, n int, form string, word string, _id string, v int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, "clash", "clash", "clash", 2) for i, t in rows], SCHEMA)


# -- 12

TEXTS = [
    None, "", "x", "one two  three\nfour", "a<b <P>arted", "Straße 日本語 𝒳y née", "<S", "S> <P M>", "tail<", "<" * 50,
    "ab" * 40_000, ". " * 50_000, "\x00 nul", "word " * 30_000 + "<", "é" * 70_000 + "zz" + "日" * 70_000,
]


def plain_offsets(text):
    return [0, *itertools.accumulate(len(x) for x in re.findall(r"[A-Za-z]+|[^A-Za-z]", text))]


@pytest.mark.parametrize("text", [t or "" for t in TEXTS])
def test_boundary_set_selects_every_offset(text):
    want, got = plain_offsets(text), fill_middle.BoundarySet(text)
    assert got.tokens == len(want) - 1
    for k in {*range(0, len(want), 1 + len(want) // 300), len(want) - 1}:
        assert got.select(k) == want[k]


def test_containers_take_their_least_kind():
    rng = np.random.default_rng(1)
    sparse, dense, runs = np.zeros(1 << 16, bool), rng.random(1 << 16) < 0.5, np.ones(1 << 16, bool)
    sparse[::1000] = True
    kinds = [type(fill_middle.container(m)) for m in (sparse, dense, runs)]
    assert kinds == [fill_middle.ArrayContainer, fill_middle.BitmapContainer, fill_middle.RunContainer]
    for mask in (sparse, dense, runs, dense[:777], runs[:3]):
        made, where = fill_middle.container(mask), np.flatnonzero(mask)
        for cls in {type(made), fill_middle.ArrayContainer, fill_middle.BitmapContainer, fill_middle.RunContainer}:
            assert [cls(mask).select(k) for k in range(0, len(where), 37)] == list(where[::37])


def plain_cut(doc_id, text):
    t = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    at = plain_offsets(t)
    n = len(at) - 1
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = t[: at[a]], t[at[a] : at[b]], t[at[b] :]
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_cuts_match_plain_ones_and_come_back(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "no id here"), (None, None), (3, TEXTS[3]), (3, TEXTS[3])]
    got = fill_middle.fill_in_middle(frame(spark, rows))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    found = [(r["_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in got.withColumn("back", back).collect()]
    assert Counter(found) == Counter((i, *plain_cut(i, t), t or "") for i, t in rows)
    assert {x[2] for x in found} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(frame(spark, [])).count() == 0


# -- 11

def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point, by trying all."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(rows, least_n=5):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            seen[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in seen.items() if len(w) >= 6 and c >= least_n}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def word_rows(seed, words):
    rng, rows = random.Random(seed), []
    for i in range(60):
        picked = [w for w, n in words for _ in range(n) if rng.random() < 1 / 60 or i == 0]
        rng.shuffle(picked)
        rows.append((i, " ".join(picked)))
    return rows


@pytest.fixture(scope="module")
def spelled():
    base = ["receive", "colour", "straße", "ÀÉÎõüÿ", "zzzzzz", "abcabcabc", "neighbourhood"]
    words = [(w, 600) for w in base]
    rng = random.Random(3)
    for w in base:
        for _ in range(12):
            k, kind = rng.randrange(len(w)), rng.randrange(3)
            words.append((w[:k] + ["", "x" + w[k], "q"][kind] + w[k + 1 :], rng.choice((1, 6, 30, 130))))
    words += [("chaina", 5000), ("chainb", 900), ("chainbb", 150), ("chainbbc", 25), ("tieaaa", 10), ("tieaab", 60), ("tieaac", 60), ("short", 90)]
    return word_rows(4, words) + [(100, None), (101, ""), (102, "12 34 ×÷×÷×÷ " * 9), (None, "nullid " * 9), (103, "Ab" * 60_000 + " x"), (0, "again again" * 3), (0, "again again" * 3)]


def found(rows):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows.collect()}


@pytest.mark.parametrize("meetings", [100_000, 20])
def test_variants_match_brute_force(spark, spelled, monkeypatch, meetings):
    monkeypatch.setattr(spelling, "MEETINGS", meetings)
    want = plain_variants(spelled)
    assert any(w[2] not in (w[0], w[1]) for w in want) and any(w[1] is None and w[4] for w in want)
    assert found(spelling.variants(frame(spark, spelled))) == want


def test_no_word_is_lost_beside_a_hot_chunk(spark, monkeypatch):
    """All words share their first half: the key is cut again and again, and joins stay small."""
    monkeypatch.setattr(spelling, "MEETINGS", 64)
    letters = "abcdef"
    words = ["common" + "".join(x) for x in itertools.product(letters, repeat=4)][::3] + ["common" + "".join(x) for x in itertools.product(letters, repeat=3)][::2]
    made = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint")
    got = {tuple(sorted((r["a"], r["b"]))) for r in spelling.near_words(made).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(sorted(words), 2) if one_edit(a, b)}


def test_variants_of_nothing(spark):
    assert spelling.variants(frame(spark, [])).count() == 0
    assert spelling.variants(frame(spark, [(1, None), (2, "")])).count() == 0


# -- 13

VECTORS = "vec_id bigint, embedding array<float>, label int, id int, h string, v int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 7, "clash", 8) for i, v in rows], VECTORS)


def plain_nearest(rows, k, every=20):
    rows = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows]
    out = {}
    for q, a in rows:
        if q % every == 0:
            ranked = sorted((-float((a * b).sum()), i) for i, b in rows if i != q)[:k]
            out[q] = [(i, -s) for s, i in ranked]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_pseudo_rotation_keeps_angles():
    x = np.random.default_rng(2).standard_normal((5, 16))
    y = cross_polytope.rotation(x, 3)
    assert np.allclose(x @ x.T, y @ y.T) and not np.allclose(x, y)
    h = np.array([[(-1) ** bin(i & j).count("1") for j in range(16)] for i in range(16)]) / 4
    assert np.allclose(cross_polytope.hadamard(x), x @ h)


def test_codes_are_the_nearest_signed_axes():
    v = np.random.default_rng(4).standard_normal((30, 10))
    p = cross_polytope.Polytopes(10, 1.0, 1.0, 40, tables=2)
    assert p.axes == [16, 1] and p.per_table == 64
    for t, values in enumerate(p.values(v, True)):
        turned = [cross_polytope.rotation(np.pad(v / np.linalg.norm(v, axis=1, keepdims=True), ((0, 0), (0, 6))), 1000 * t + j) for j in range(2)]
        for r in range(30):
            closeness = {(2 * a + (s < 0)) * 2 + (z < 0): s * turned[0][r, a] + z * turned[1][r, 0] for a in range(16) for s in (1, -1) for z in (1, -1)}
            assert np.allclose(values[r], [closeness[i] for i in range(64)])
            assert np.isclose(closeness[p.codes(v)[r, t] - t * 64], max(closeness.values()))


def test_search_reaches_its_recall(spark, tables):
    rows = [(r["vec_id"], r["embedding"]) for r in tables.embeddings.collect()]
    got, want = answers(QUERIES["op13_nearest"](spark, tables.folder)), plain_nearest(rows, 20)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


@pytest.mark.parametrize("block", [4096, 8])
def test_clouds_copies_and_unlike_lengths(spark, monkeypatch, block):
    monkeypatch.setattr(cross_polytope, "BLOCK", block)
    monkeypatch.setattr(cross_polytope, "ASKING", max(2, block // 4))
    rng = np.random.default_rng(6)
    centers = rng.standard_normal((12, 8))
    rows = [(i, (centers[i % 12] + 0.1 * rng.standard_normal(8)) * rng.uniform(0.5, 3)) for i in range(400)]
    rows += [(400 + i, np.ones(8)) for i in range(200)]  # one vector many times
    got, want = answers(cross_polytope.nearest(vector_frame(spark, rows), k=7, occupancy=16)), plain_nearest(rows, 7)
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 7 for q in want]) >= 0.9
    copies = [q for q in want if q >= 400]
    assert copies and all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in copies)
    score = {(q, i): s for q, x in got.items() for i, s in x}
    exact = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    assert all(np.isclose(s, exact[q] @ exact[i], rtol=0, atol=1e-12) for (q, i), s in score.items())


def test_fewer_rows_than_wanted_are_all_found(spark):
    rng = np.random.default_rng(8)
    rows = [(20 * i, rng.standard_normal(16)) for i in range(9)]
    assert {q: [i for i, _ in x] for q, x in answers(cross_polytope.nearest(vector_frame(spark, rows))).items()} == {
        q: [i for i, _ in x] for q, x in plain_nearest(rows, 20).items()
    }


def test_vectors_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(0, None), (20, []), (40, [0, 0, 0]), (60, [1, None, 2]), (80, [nan, 1, 1]), (100, [inf, 1, 1]), (120, [1, 2]), (None, [1, 2, 3])]
    good = [(140, [1, 0, 0]), (140, [1, 0, 0]), (1, [0.5, 0, 0]), (2, [0.5, 0, 0]), (160, [-0.0, 1, 0]), (161, [0.0, 1, 0]), (161, [3, 0, 1])]
    got = answers(cross_polytope.nearest(vector_frame(spark, odd + good), k=3))
    assert got == {140: [(161, 3.0), (1, 0.5), (2, 0.5)], 160: [(161, 1.0), (1, 0.0), (2, 0.0)]}
    assert cross_polytope.nearest(vector_frame(spark, [])).count() == 0
    assert cross_polytope.nearest(vector_frame(spark, odd)).count() == 0
