"""The dealt operators on small fixtures: brute force, and every awkward row."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkweave.llm import common, decontaminate, html_crf, language_id, mixing, ngram_join, pii, quality_rff, quality_rules, toxicity, url_filter
from sparkweave.operators import bucket_links
from sparkweave.operators.graphs import connected_components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, _id string, node int, size int"


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def blank_words(s):
    return re.findall(r"[^\x20\x09-\x0D]+", s or "")


def invented(rng, n, kinds="abc"):
    return " ".join("".join(rng.choice(kinds) + rng.choice("xyz") for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Ordinary texts with near copies, and nulls, empty, long, repeated and tied ones."""
    rng = random.Random(5)
    out, doc = [], 0
    for family in range(6):
        base = invented(rng, 40 + 20 * family).split()
        for copy in range(4):
            words = list(base)
            for _ in range(copy):
                words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
            out.append((doc, " ".join(words), "en" if family % 2 else "de", f"s{family % 3}"))
            doc += 1
    out += [(100, None, "en", "s0"), (101, "", "de", None), (102, " \t\n ", None, "s1"), (103, "one", "en", "s2"), (104, "one two three", "en", "s2")]
    out += [(105, "ÄÖ Straße ÄÖ", "de", "s1"), (106, "x " * 30_000, "en", "s0"), (107, "z" * 300_000, "en", "s0")]
    out += [out[0], out[0], (None, "no id here at all", "en", "s1"), (None, None, None, None)]
    out += [(108, "mail a@b.c_d@e.f and 1.2.3.4, 1.2.3.400 or +1 (555) 123-4567; card 4111 1111 1111 1111 x@y", "en", "s1")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(i, t, lang, src, len(t or ""), 0.5, "clash", 7, 8) for i, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def labels_of(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id bigint, quality int, toxic int")


# -- 1

PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header><h1>Site name</h1></header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><div class="cookie-notice"><p>We use cookies here.</p></div>
<article><h1>A headline</h1><p title="a > b">First &amp; foremost,
 <b>bold</b> text&nbsp;here. It goes on<br>and on.</p><div class="ad">Buy this now. It is cheap.</div><p>Second one. It ends.</p></article>
<aside><h3>Related</h3><p>Another story to read.</p></aside><form><p>Join our list.</p><input></form>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I liked it. Thanks a lot.</p></div></section><footer>&copy; 2020</footer></body></html>"""
MAIN = "A headline\nFirst & foremost, bold text here. It goes on and on.\nSecond one. It ends."


def test_page_text():
    assert html_crf.main_text(PAGE, html_crf.default_field()) == MAIN


def test_comments_that_only_a_heading_tells_and_hidden_names():
    field = html_crf.default_field()
    body = "<h1>A headline</h1><p>First one. It goes on and on, as it should.</p><p>Second one. It ends here after some more words.</p>"
    for head in ("Reader comments", "3 comments", "Kommentare"):
        talk = f"<section><h2>{head}</h2><ul><li>I liked it. Thanks a lot for this one.</li><li>So did I, but the end was weak.</li></ul></section>"
        got = html_crf.main_text(f"<html><body><nav><a href=/>Home</a></nav><article>{body}{talk}</article><footer>&copy; 2020</footer></body></html>", field)
        assert got == "A headline\nFirst one. It goes on and on, as it should.\nSecond one. It ends here after some more words."
    # a class of that name hides nothing, the attribute and the style do
    named = html_crf.main_text(f'<html><body><article class="hidden">{body}</article></body></html>', field)
    assert named.startswith("A headline") and named.count("\n") == 2
    for mark in ("hidden", 'style="display: none"'):
        assert "Not seen" not in html_crf.main_text(f"<html><body><article>{body}<p {mark}>Not seen by anyone. It is hidden.</p></article></body></html>", field)


def test_viterbi_matches_enumeration():
    """The decoded labels of short chains are those of the largest score over all label sequences."""
    import itertools

    rng = np.random.default_rng(6)
    for _ in range(40):
        names = [f"f{i}" for i in range(5)]
        field = html_crf.Field({n: i for i, n in enumerate(names)}, rng.standard_normal((5, 2)), rng.standard_normal((2, 2)))
        rows = [[n for n in names if rng.random() < 0.5] for _ in range(int(rng.integers(1, 8)))]

        def score(labels):
            own = sum(field.unary[field.index[f], y] for row, y in zip(rows, labels) for f in row)
            return own + sum(field.pair[a, b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=len(rows)), key=score)
        assert score(tuple(field.decode(rows))) == pytest.approx(score(best))
    assert field.decode([]) == []


def test_open_heads_and_formulas():
    def texts(page):
        return [b.text for b in html_crf.leaf_blocks(page)]

    for head in ("<head><title>T</title><meta charset=utf-8>", "<head><title>T</title><style>p{}</style>", "<title>T</title>", "<head><script>x</script>"):
        for body in ("<body><p>One</p>", "<p>One</p>", "<body><p>One</p></body>"):
            assert texts(f"<!doctype html><html>{head}{body}") == ["One"]
    assert texts("<head>One") == ["One"]
    assert texts("<p>Let <math><semantics><mi>x</mi><annotation>tex</annotation></semantics></math> be</p>") == ["Let x be"]
    assert texts("<p>See <svg><title>no</title><text>axis</text></svg> and <canvas>no chart</canvas></p>") == ["See", "axis", "and", "no chart"]


def test_field_learns_labelled_pages():
    field, wrong, total = html_crf.default_field(), 0, 0
    for page, labels in html_crf.labelled_pages(150, seed=99):
        found = field.decode(html_crf.features(html_crf.leaf_blocks(page)))
        wrong += sum(a != b for a, b in zip(found, labels))
        total += len(labels)
    assert wrong < 0.02 * total


@pytest.mark.parametrize("page", ["<a <a " * 20_000, "<div>" * 20_000 + "x", "<b>" * 20_000 + "</p>" * 20_000, '<p a="' + "x" * 100_000, "<!--" * 20_000])
def test_damaged_pages_cost_their_length(page):
    html_crf.leaf_blocks(page)


def test_pages_with_odd_rows(spark, sf, tables):
    frame = spark.createDataFrame([(1, None, "u", 9), (2, "", "v", 9), (3, PAGE, None, 9), (3, PAGE, None, 9)], "page_id bigint, html string, url string, text int")
    got = sorted((r["page_id"], r["text"]) for r in html_crf.extract(frame).collect())
    assert got == [(1, ""), (2, ""), (3, MAIN), (3, MAIN)]
    assert html_crf.extract(frame.limit(0)).count() == 0


def test_pages_give_the_article(tables):
    for r in html_crf.extract(tables.pages).collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = [re.sub(r"\s+", " ", html_crf.html_lib.unescape(re.sub(r"<[^>]+>", "", p.replace("<br>", " ")))).strip() for p in re.split(r"</?(?:p|h\d)>", re.sub("</?b>", "", body))]
        assert r["text"] == "\n".join(p for p in parts if p)


# -- 2

def test_mix_comes_near_targets(docs, rows):
    got = mixing.mixing_rates(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, targets = {}, {}, {}
    for r in got:
        sizes[r["_source"]] = sizes.get(r["_source"], 0) + r["size"]
        taken[r["_source"]] = taken.get(r["_source"], 0) + r["taken"]
        targets[r["_source"]] = r["target"]
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        share = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if 3 * sizes[s] < share * weight[s]}
        if more == capped:
            break
        capped = more
    for s in order:
        assert targets[s] == pytest.approx(3 * sizes[s] if s in capped else share * weight[s])
        assert sum(r["source_size"] for r in got if r["_source"] == s) == sizes[s] * sum(r["_source"] == s for r in got)
        assert abs(taken[s] - targets[s]) <= max(r["size"] for r in got if r["_source"] == s) / 2 + 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixing_rates(docs.repartition(7)).collect()))


def test_mix_reaches_many_small_targets(spark):
    rng = random.Random(2)
    frame = spark.createDataFrame([(i, "w " * rng.randint(1, 60), f"s{i % 4}") for i in range(2000)], "doc_id bigint, text string, source string")
    for r in mixing.mixing_rates(frame).groupBy("_source").agg(F.sum("taken").alias("got"), F.first("target").alias("target")).collect():
        assert r["got"] == pytest.approx(r["target"], rel=0.002)


def test_mix_keeps_columns_and_copies(docs, none):
    out = mixing.mix_documents(docs)
    assert out.columns == [*docs.columns, "copy"]
    plan = {(r["_id"], r["size"]): r["copies"] for r in mixing.mixing_rates(docs).collect()}
    got = out.filter("doc_id = 108").count()
    assert got == next(c for (i, _), c in plan.items() if i == 108)
    assert mixing.mix_documents(none).count() == 0 and mixing.mixing_rates(none).count() == 0


# -- 3

def test_language_of_held_out_rows(tables):
    got = language_id.identify(tables.documents).join(tables.documents.select(F.col("doc_id").alias("_id"), "lang"), "_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_rows(spark, docs, none, rows):
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows)
    und = {r["_id"] for r in got if r["lang_pred"] == "und"}
    assert und == {100, 101, 102, None} and all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    assert {r["lang_pred"] for r in got} <= {"en", "de", "und"}
    assert language_id.identify(none).count() == 0
    one = docs.filter("lang = 'en'")
    assert {r["lang_pred"] for r in language_id.identify(one).collect()} == {"en", "und"}
    digits = spark.createDataFrame([(1, "12 34 !?", "en"), (2, "日本語", "ja"), (3, "hello you", "en"), (5, "日本", "ja")], "doc_id bigint, text string, lang string")
    assert {r["_id"]: r["lang_pred"] for r in language_id.identify(digits, folds=1000, held=999).collect()} == {1: "und", 2: "ja", 3: "en", 5: "ja"}


def test_letters_are_those_of_unicode():
    got = [language_id.has_letter(np.frombuffer(t.encode(), dtype=np.uint8)) for t in ("½ ² 12", "①Ⅷ €", "", "_-7", "ª", "日", "é", "ʰ", "x", "\u0301")]
    assert got == [False, False, False, False, True, True, True, True, True, False]
    long = np.frombuffer(("½" * 600_000 + "é").encode(), dtype=np.uint8)
    assert language_id.has_letter(long) and not language_id.has_letter(long[:-2])


def test_machine_matches_a_plain_solve():
    """The squared hinge loss of the accelerated steps is that of many plain, small gradient steps."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 5))
    y = np.where(x[:, 0] + 0.3 * rng.standard_normal(60) > 0.4, 1.0, -1.0)
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())

    def loss(w, b):
        return (weight * np.maximum(0, 1 - y * (x @ w + b)) ** 2).sum() + 0.5e-2 * w @ w

    w, b = np.zeros(5), 0.0
    for _ in range(60_000):
        short = np.maximum(0, 1 - y * (x @ w + b)) * weight * y
        w, b = w + 0.02 * (2 * short @ x - 1e-2 * w), b + 0.02 * 2 * short.sum()
    v, c = language_id.train_svm(x, y, penalty=1e-2)
    scale = np.linalg.norm(w) / np.linalg.norm(v)  # margins are given on their own scale
    assert loss(v * scale, c * scale) <= loss(w, b) * 1.01 + 1e-6
    assert ((x @ v + c >= 0) == (x @ w + b >= 0)).mean() >= 0.98


def test_pairs_inside_a_family_vote():
    machines = {"lang:a:b": ([1.0, 0.0], 0.0), "lang:a:c": ([0.0, 1.0], 0.0), "lang:b:c": ([1.0, 1.0], 0.0)}
    import numpy as np

    model = language_id.Languages(["a", "b", "c"], {k: (np.array(w), b) for k, (w, b) in machines.items()})
    model.by_family = {"one": ["a", "b", "c"]}
    assert model.predict(np.array([1.0, 1.0]))[0] == "a" and model.predict(np.array([-1.0, -2.0]))[0] == "c"


# -- 4 and 9

@pytest.mark.parametrize("operator, label", [(quality_rff, "quality"), (toxicity, "toxic")])
def test_scores_of_odd_rows(spark, docs, none, rows, operator, label):
    some = labels_of(spark, [(i, i % 2, i % 2) for i in range(24)] + [(0, 1, 1), (999, 1, 1), (None, 1, 0), (5, None, None)])
    got = operator.score_documents(docs, some).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (r["_id"] is not None and zlib.crc32(str(r["_id"]).encode()) % 5 == 0) for r in got)
    assert operator.score_documents(none, some).count() == 0
    nothing = labels_of(spark, [])
    assert {r["score"] for r in operator.score_documents(docs, nothing).collect()} == {0.5}
    zeros = labels_of(spark, [(i, 0, 0) for i in range(24)])
    assert {r["score"] for r in operator.score_documents(docs, zeros).collect()} == {0.0}


def test_quality_of_held_out_rows(spark):
    rng = random.Random(4)
    texts = [(i, " ".join(invented(rng, 9).capitalize() + "." for _ in range(rng.randint(2, 30))), 1) for i in range(300)]
    texts += [(1000 + i, " ".join(w.upper() + rng.choice(["!!", "$$$"]) for w in invented(rng, rng.randint(20, 200)).split()), 0) for i in range(120)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string, quality int")
    got = quality_rff.score_documents(frame.select("doc_id", "text"), frame).join(frame.select(F.col("doc_id").alias("_id"), "quality"), "_id").collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.97 * len(held)
    kept = quality_rff.keep_good(frame.drop("quality"), frame)
    assert kept.columns == ["doc_id", "text"] and 290 <= kept.count() <= 315


def test_isotonic_pools_violators():
    import numpy as np

    assert quality_rff.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]), np.ones(4)).tolist() == [0, 0.5, 0.5, 1]


def test_normal_equations_match_one_solve(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    f = rng.standard_normal((200, len(quality_rff.NAMES)))
    y = (f[:, 0] > 0).astype(float)
    model = quality_rff.fit(spark.createDataFrame([(x.tolist(), float(v)) for x, v in zip(f, y)], "f array<double>, y double").repartition(5))
    z = quality_rff.fourier(f, f.mean(0), f.std(0) + 1e-3)
    w = np.linalg.solve(z.T @ z + quality_rff.RIDGE * 200 * np.eye(z.shape[1]), z.T @ y)
    assert np.allclose(model.weights, w, atol=1e-6)


def test_risk_and_its_direction_match_numeric_ones():
    """The sums of a task against the formulas text by text, and the direction against differences of the risk."""
    rng = np.random.default_rng(2)
    width, prior = 6, 0.3

    def drawn(n, most):
        return [np.flatnonzero(rng.random(width) < most).astype(np.int32) for _ in range(n)], rng.integers(1, 4, n).astype(float)

    (pos, pn), (unl, un) = drawn(9, 0.6), drawn(25, 0.3)

    def plain(x):
        score = lambda f: x[1 + f].sum() + x[0]
        mean = lambda rows, n, loss: sum(k * loss(score(f)) for f, k in zip(rows, n)) / n.sum()
        soft = lambda z: np.log1p(np.exp(z))
        plus = prior * mean(pos, pn, lambda z: soft(-z))
        return plus, mean(unl, un, soft) - prior * mean(pos, pn, soft), toxicity.DECAY / 2 * (x[1:] ** 2).sum()

    signs = set()
    for shift in (-6.0, -1.0, 0.5):
        x = np.concatenate([[shift], rng.standard_normal(width)])
        for scale in (1.0, 4.0):
            z = x * scale
            value, direction = toxicity.risk(toxicity.risk_sums(pos, pn, z[1:], z[0]), toxicity.risk_sums(unl, un, z[1:], z[0]), prior, z[1:])
            plus, negative, decay = plain(z)
            signs.add(negative >= 0)
            assert value == pytest.approx(plus + max(0, negative) + decay, rel=1e-9)
            goal = lambda y: (lambda p, m, d: (p + m if negative >= 0 else -m) + d)(*plain(y))
            numeric = [(goal(z + 1e-6 * e) - goal(z - 1e-6 * e)) / 2e-6 for e in np.eye(width + 1)]
            assert np.allclose(direction, numeric, atol=1e-6)
    # confirmed texts that are called toxic by far, among unlabelled ones that are not: less than nothing is left
    pos, unl, un = [np.arange(width, dtype=np.int32)] * 4, [np.empty(0, dtype=np.int32)] * 5, np.ones(5)
    pn, far = np.ones(4), np.concatenate([[-3.0], np.full(width, 2.0)])
    value, direction = toxicity.risk(toxicity.risk_sums(pos, pn, far[1:], far[0]), toxicity.risk_sums(unl, un, far[1:], far[0]), prior, far[1:])
    plus, negative, decay = plain(far)
    numeric = [((lambda a, b: (b[1] - a[1] + a[2] - b[2]) / 2e-6)(plain(far + 1e-6 * e), plain(far - 1e-6 * e))) for e in np.eye(width + 1)]
    assert negative < 0 and value == pytest.approx(plus + decay) and np.allclose(direction, numeric, atol=1e-6) and True in signs


def test_risk_pass_sums_over_tasks(spark):
    rng = np.random.default_rng(5)
    rows = [(int(y), np.flatnonzero(rng.random(8) < 0.4).astype(np.int32)) for y in rng.integers(0, 2, 50)]
    counts = rng.integers(1, 5, 50)
    train = spark.createDataFrame([(y, bytearray(c.tobytes()), int(n)) for (y, c), n in zip(rows, counts)], "y int, c binary, n bigint").repartition(7)
    x = rng.standard_normal(9)
    got = toxicity._risk_pass(train, 8, {1: 3, 0: 11}, 0.2)(x)
    sides = [toxicity.risk_sums([c for y, c in rows if y == s] + [np.empty(0, dtype=np.int32)], np.array([*(float(n) for (y, _), n in zip(rows, counts) if y == s), more]), x[1:], x[0]) for s, more in ((0, 11.0), (1, 3.0))]
    want = toxicity.risk(sides[1], sides[0], 0.2, x[1:])
    assert got[0] == pytest.approx(want[0]) and np.allclose(got[1], want[1])


def test_toxic_words_are_learnt(spark):
    rng = random.Random(9)
    bad = ["vileword", "nastyterm", "foulname"]
    texts = []
    for i in range(1500):
        words = invented(rng, rng.randint(20, 80), "abcdefgh").split()
        toxic = i % 8 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad)
            words.append(rng.choice(bad) + ".")
        texts.append((i, " ".join(words), int(toxic)))
    frame = spark.createDataFrame(texts, "doc_id bigint, text string, toxic int")
    got = toxicity.score_documents(frame.select("doc_id", "text"), frame).join(frame.select(F.col("doc_id").alias("_id"), "toxic"), "_id").collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.97 * len(held)
    left = toxicity.drop_toxic(frame.drop("toxic"), frame)
    assert left.columns == ["doc_id", "text"] and abs(left.count() - 1312) < 30


# -- 5

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(int(c) for c in reversed(s))) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_spans_match_plain_patterns(spark, docs, rows, none):
    rng = random.Random(3)
    alphabet = "aB1.2@+- ()é4_%\n😀"
    hard = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    hard += ["1" * 50_000, "a" * 50_000 + "@", "a.b@" * 5_000, "@".join(["x.y"] * 3_000), "1.2.3.4 " * 2_000, "é+49 30 1234567 " * 700, "007.0.00.255 4111-1111-1111-1111"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(hard)], "doc_id bigint, text string")
    for got in (pii.base_spans(frame), pii.base_spans(docs)):
        texts = dict(enumerate(hard)) if got.count() == len(hard) else None
        for r in got.collect():
            text = texts[r["_id"]] if texts else r["_t"]
            assert [(s["start"], s["kind"], s["end"]) for s in r["spans"]] == base_spans(text)
    assert pii.find(docs).count() == len(rows) and pii.find(none).count() == 0


def secret_corpus(spark):
    """A by-name stands near one mail address in otherwise unrelated texts; a common word does too."""
    rng = random.Random(8)
    texts = []
    for i in range(300):
        words = invented(rng, rng.randint(30, 60), "abcdefgh").split()
        words.insert(5, "common")
        if i % 30 == 0:
            at = rng.randrange(len(words))
            words[at:at] = [invented(rng, 1), "Zorblatt,", invented(rng, 1), "zb@mail.example.org"]
        if i == 7:
            words.insert(3, "zorblatt")  # without the address: still told
        texts.append((i, " ".join(words)))
    family = invented(rng, 50, "klmn").split()  # near copies of one text with an address of its own
    for i in range(300, 330):
        words = list(family)
        words[rng.randrange(40)] = "changed"
        texts.append((i, " ".join([*words, "fam@mail.example.org"])))
    return spark.createDataFrame(texts, "doc_id bigint, text string")


def test_revealing_terms(spark):
    frame = secret_corpus(spark)
    found, texts = {}, {r["doc_id"]: r["text"] for r in frame.collect()}
    for r in pii.find(frame).collect():
        terms = [texts[r["_id"]][s["start"] : s["end"]].lower() for s in r["spans"] if s["kind"] == pii.KINDS.index("term")]
        if terms:
            found[r["_id"]] = set(terms)
    assert set().union(*found.values()) == {"zorblatt"}
    assert set(found) == {*range(0, 300, 30), 7}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(frame.withColumn("n_chars", F.lit(0))).collect()}
    assert all("orblatt" not in t and "@" not in t for t in clean.values())
    assert clean[1] == texts[1]
    # the same through the registered query
    from sparkweave.llm.queries import QUERIES
    from sparkweave.session import new_folder

    folder = new_folder(spark, "planted")
    frame.write.parquet(f"{folder}/documents.parquet")
    told = {r["doc_id"] for r in QUERIES["op5_pii"](spark, folder).collect() if "term:" in r["spans"]}
    assert told == {*range(0, 300, 30), 7}


def marked_terms(frame, **how):
    """The terms marked in each document, by id."""
    texts, found = {r["doc_id"]: r["text"] for r in frame.collect()}, {}
    for r in pii.find(frame, **how).collect():
        found[r["_id"]] = {texts[r["_id"]][s["start"] : s["end"]].lower() for s in r["spans"] if s["kind"] == pii.KINDS.index("term")}
    return found


def test_texts_that_share_their_least_hash_are_no_copies(spark):
    rng = random.Random(12)
    texts = []
    for i in range(300):
        words = invented(rng, rng.randint(30, 60), "abcdefgh").split()
        words.insert(5, "common")  # what hashes lowest in many of the texts
        if i % 30 == 0:
            words[9:9] = ["Quibnax", "qb@mail.example.org"]
        texts.append((i, " ".join(words)))
    least = [(spark.range(1).select(F.xxhash64(F.lit(w))).first()[0], w) for w in {w.lower() for i, t in texts[::30] for w in t.split() if w.isalpha()}]
    frequent = min(least)[1]
    frame = spark.createDataFrame([(i, f"{t} {frequent}") for i, t in texts], "doc_id bigint, text string")
    found = marked_terms(frame)
    assert all("quibnax" in found[i] for i in range(0, 300, 30))


def test_evidence_in_two_documents_and_of_far_entities(spark):
    rng = random.Random(14)
    texts = [invented(rng, rng.randint(30, 50), "abcdefghijklmn").split() for _ in range(4000)]
    for i in (50, 2050):  # two documents, and the nearer entities differ
        texts[i] += ["Quibnax", f"near{i}@one{i}.example.org", f"10.{i % 9}.7.{i % 200}", "far@two.example.org"]
    for k, i in enumerate((70, 1070, 2070)):  # one domain, a mailbox each
        texts[i] += ["Domaxin", f"box{k}@firm.example.net"]
    for k, i in enumerate((80, 1080, 2080)):  # one prefix, a number each
        texts[i] += ["Numaxin", f"+49 30 55512{k} {k}{k}0"]
    texts[90] += ["Onceonly", "once@three.example.org"]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    found = marked_terms(frame)
    assert all("quibnax" in found[i] for i in (50, 2050))
    assert all("domaxin" in found[i] for i in (70, 1070, 2070))
    assert all("numaxin" in found[i] for i in (80, 1080, 2080))
    assert not found[90]


def test_families_match_brute_force(spark):
    rng = random.Random(13)
    texts = []
    for g in range(12):
        words = invented(rng, rng.randint(3, 60), "abcdefgh").split()
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = invented(rng, 1)
            texts.append(" ".join(copy))
    texts = sorted(set(texts))
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (blank_words(lower(t)) for t in texts)]
    name = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 2 * len(sets[i] & sets[j]) >= len(sets[i] | sets[j]):
                name = [name[j] if x == name[i] else x for x in name]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "_print bigint, _t string")
    got = {r["node"]: r["family"] for r in pii._families(frame).collect()}
    pairs = {(i, j) for i in range(len(texts)) for j in range(i) if name[i] == name[j]}
    assert pairs == {(i, j) for i in range(len(texts)) for j in range(i) if got.get(i, ~i) == got.get(j, ~j)}


def test_sanitise_keeps_rows_and_columns(docs, rows, none):
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    got = out.filter("doc_id = 108").first()
    assert got["text"] == "mail [EMAIL][EMAIL] and [IP], 1.2.3.400 or [PHONE]; card [CARD] x@y".replace("[EMAIL][EMAIL]", got["text"].split()[1])
    assert got["n_chars"] == len(got["text"]) and "4111" not in got["text"]
    assert out.filter("doc_id = 100").first()["text"] is None
    assert pii.sanitise(none).count() == 0


# -- 6

def shingle_set(text):
    w = blank_words(lower(text or ""))
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def plain_components(rows):
    sets = [shingle_set(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    low = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(sets[k]), low.get(find(k)) if sets[k] else i) for k, (i, *_) in enumerate(rows)), key=str)


def components(frame, **how):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join_components(frame, **how).collect()), key=str)


def test_join_of_odd_rows(docs, rows, none):
    assert components(docs) == plain_components(rows)
    assert ngram_join.join_components(none).count() == 0


@pytest.mark.parametrize("block", [4096, 16])
def test_join_of_chains_and_passages(spark, monkeypatch, block):
    """Families whose ends link only through others, loose families of unlike members, and one passage in many texts."""
    monkeypatch.setattr(bucket_links, "BLOCK", block)
    rng = random.Random(11)
    texts, passage = [], invented(rng, 40, "pq").split()
    for _ in range(4):
        words = invented(rng, 90, "abcdef").split()
        for step in range(12):
            words = list(words)
            words[3 + 7 * step] = f"w{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    loose = invented(rng, 80, "ghi").split()
    for _ in range(60):
        words = list(loose)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(80)] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    for _ in range(60):
        texts.append(" ".join([*passage, *invented(rng, rng.randint(2, 60), "klm").split()]))
    for n in range(1, 40):
        w = invented(rng, n, "rst").split()
        texts += [" ".join(w), " ".join([*w[:-1], "zz"]), " ".join(w + ["yy"])]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert components(frame) == plain_components(rows)


def test_join_with_hot_signatures(spark, monkeypatch):
    """Every set is sampled and every signature is hot, so all are salted; links are the same."""
    monkeypatch.setattr(ngram_join, "SAMPLE", 1)
    monkeypatch.setattr(ngram_join, "HOT", 10**9)
    rng = random.Random(21)
    base, texts = invented(rng, 120, "abcdef").split(), []
    for _ in range(40):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(120)] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    assert components(spark.createDataFrame(rows, "doc_id bigint, text string")) == plain_components(rows)


def test_rows_grow_with_the_members_of_a_loose_family(spark, monkeypatch):
    """Members that are near but mostly do not link: what the block compare returns doubles with them, not more."""
    made, plain = [], bucket_links._edges
    monkeypatch.setattr(bucket_links, "_edges", lambda *a: made.append(plain(*a)) or made[-1])
    seen = {}
    for size in (100, 200, 400):
        rng, made[:] = random.Random(31), []
        base, texts = invented(rng, 70, "abcdef").split(), []
        for _ in range(size):
            words = list(base)
            for k in rng.sample(range(70), 4):
                words[k] = f"v{rng.randrange(10**6)}"
            texts.append(" ".join(words))
        ngram_join.join_components(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).count()
        buckets = sum(m.select("bucket").distinct().count() for m in made)
        seen[size] = sum(m.count() for m in made) / max(1, buckets)
    assert seen[400] <= 2.5 * seen[200] + 10 and seen[200] <= 2.5 * seen[100] + 10


def test_texts_reach_the_join_in_bounded_batches(spark, monkeypatch):
    """A task holds a few MB of texts at once, however long they are, and the session keeps its own setting."""
    plain, most, key = ngram_join.each_words, 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

    def bounded(texts):
        assert texts.nbytes <= most
        return plain(texts)

    monkeypatch.setattr(ngram_join, "each_words", bounded)
    before = spark.conf.get(key)
    long = F.repeat(F.concat(F.lit("ab cd ef gh "), F.col("id").cast("string"), F.lit(" ")), 60_000)
    long_docs = spark.range(0, 24, 1, 1).select(F.col("id").alias("doc_id"), long.alias("text"))
    assert [r["component_id"] for r in ngram_join.join_components(long_docs).orderBy("doc_id").collect()] == list(range(24))
    assert spark.conf.get(key) == before


def test_words_of_a_chunk_and_of_like_structure():
    from sparkweave.llm import arrow_text

    w = "w" * arrow_text.CHUNK
    got = [x.tolist() for x in arrow_text.each_words(pa.array([w, w + " ", f" {w} q", w + "w", f"a {w}w", w.upper()]))]
    assert got[0] == got[1] == got[5] and got[2][0] == got[0][0] and got[3][0] == got[4][1] != got[0][0]
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    first, second = (x.tolist() for x in arrow_text.each_words(pa.array([one, other])))
    assert first != second
    assert [x.tolist() for x in arrow_text.each_words(pa.array([one + " x", "x " + one]))] == [[first[0], got_x := next(arrow_text.each_words(pa.array(["x"]))).tolist()[0]], [got_x, first[0]]]


def test_one_stays_of_each_component(docs, rows):
    kept = ngram_join.one_per_component(docs)
    assert kept.columns == docs.columns
    named = {(c if n else i, n > 0) for i, n, c in plain_components(rows)}
    assert sorted(str(r["doc_id"]) for r in kept.filter("doc_id is not null and text > '!'").collect()) == sorted(str(i) for i, full in named if full and i is not None)
    assert kept.filter("doc_id IN (100, 101, 102)").count() == 3


def test_unlike_texts_under_one_id_stay(spark):
    rng = random.Random(15)
    a, b, c, d = (invented(rng, 40, "abcdefgh") for _ in range(4))
    texts = [(None, a), (None, b), (5, c), (5, d), (4, f"{c} more"), (7, a), (7, a), (8, ""), (8, None)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    kept = [tuple(r) for r in ngram_join.one_per_component(frame).collect()]
    assert sorted(kept, key=str) == sorted([(7, a), (None, b), (4, f"{c} more"), (5, d), (8, ""), (8, None)], key=str)


def test_allocation_tolerates_what_sets_may_differ():
    for low, high in ngram_join.bands(3000, 85):
        exact, deletion = ngram_join.allocate(low, high, 10_000, 85)
        apart = ngram_join.most_apart(high, high, 85)
        assert exact + 2 * deletion > apart or (apart == 0 and not exact + deletion)


# -- 7

def item_words(s):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(s or ""))


def plain_hits(text, items):
    w, hit, found = item_words(text), set(), set()
    for item, t in items:
        v = item_words(t)
        k = min(13, len(v))
        windows = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                found.add(item)
    return len(w), len(hit), found


def test_benchmark_hits(spark, docs, rows, none, monkeypatch):
    rng = random.Random(6)
    items = [(1, invented(rng, 30, "uvw")), (2, "One, TWO three"), (3, None), (4, "..."), (5, "Straße"), (6, invented(rng, 13, "uvw"))]
    items.append((7, items[0][1]))
    w = items[0][1].split()
    more = [(200, "a b " + " ".join(w[4:25]).upper() + " c"), (201, " ".join(w[:12])), (202, "-".join(w) + "! " + " ".join(w)), (203, items[5][1] + " " + "q " * 400)]
    frame = docs.unionByName(spark.createDataFrame(more, "doc_id bigint, text string"), allowMissingColumns=True)
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id bigint, text string, h string")
    want = sorted(((i, *plain_hits(t, items)) for i, t, *_ in [*rows, *more]), key=str)
    marks = decontaminate.benchmark_hits(frame, bench).withColumn("hit", decontaminate.n_hit())
    got = sorted(((r["_id"], r["n_words"], r["hit"], set(r["items"])) for r in marks.collect()), key=str)
    assert got == want
    bad = {i for i, n, hit, _ in want if hit and 20 * hit >= n}
    kept = decontaminate.decontaminate(frame, bench)
    assert kept.columns == frame.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, *_ in want if i not in bad)
    out = decontaminate.without_spans(frame, bench)
    cut = {r["doc_id"]: r["text"] for r in out.collect()}
    assert item_words(cut[200]) == ["a", "b", "c"] and cut[201] == more[1][1] and cut[100] is None
    # every row stays, repeated ones and null ids too, with all columns; texts without hits stay as they are
    assert out.columns == frame.columns and out.count() == frame.count()
    plain = sorted(((i, t) for i, t, *_ in [*rows, *more] if not plain_hits(t, items)[1]), key=str)
    untouched = {i for i, _ in plain}
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect() if r["doc_id"] in untouched), key=str) == plain
    for limit in (0, 32 << 20):  # joined by shuffle, or broadcast
        monkeypatch.setattr(decontaminate, "broadcast_within", lambda df, more=None, limit=limit: common.broadcast_within(df, limit, more))
        assert sorted(map(str, decontaminate.without_spans(frame, bench).collect())) == sorted(map(str, out.collect()))
        assert sorted(str(r["doc_id"]) for r in decontaminate.decontaminate(frame, bench).collect()) == sorted(str(r["doc_id"]) for r in kept.collect())
    assert decontaminate.benchmark_hits(none, bench).count() == 0
    assert decontaminate.benchmark_hits(docs, bench.limit(0)).filter("size(spans) > 0").count() == 0


# -- 8

def plain_statistics(text):
    text = text or ""
    w = blank_words(text)
    lines = [x for x in text.split("\n") if blank_words(x)]
    seen, covered = {}, set()
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            for i in at:
                covered |= set(range(i, i + 5))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_statistics_match_plain_counts(docs, rows, none):
    got = sorted(((r["_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality_rules.judge(docs).collect()), key=str)
    assert got == sorted(((i, *plain_statistics(t)) for i, t, *_ in rows), key=str)
    assert quality_rules.judge(none).count() == 0


def test_outliers_go_and_others_stay(spark):
    rng = random.Random(12)
    texts = []
    for i in range(400):
        body = ". ".join(invented(rng, 8, "abcdefgh").capitalize() for _ in range(rng.randint(6, 20)))
        if i % 10 == 0:
            body = rng.choice([body.upper(), " ".join(w + "$$$" for w in body.split())])
        texts.append((i, body, "en" if i % 2 else None, "hot" if i % 3 else f"s{i % 7}"))
    got = {r["_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string")).collect()}
    assert {i for i, kept in got.items() if not kept} == set(range(0, 400, 10))


def test_distances_match_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    names = list(quality_rules.FLOORS)
    x = np.round(rng.standard_normal((300, len(names))) * quality_rules.UNIT).astype(int)
    frame = spark.createDataFrame([("g", *map(int, r)) for r in x], "_group string, " + ", ".join(f"{n} bigint" for n in names))
    estimate = quality_rules._moments(frame, names, 1.0)
    got = sorted(r[0] for r in frame.join(estimate, "_group").select(quality_rules._distance(names)).collect())
    cov = np.cov(x.T, bias=True) + np.diag([(v * quality_rules.UNIT) ** 2 for v in quality_rules.FLOORS.values()])
    d = x - x.mean(0)
    assert np.allclose(got, np.sort(np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)), rtol=1e-6)


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_filters_keep_rows_and_columns(spark, docs, rows, none, monkeypatch, limit):
    """What goes is what the verdicts say, joined by shuffle or broadcast; repeated rows and null ids share their fate."""
    for module in (quality_rules, quality_rff, toxicity):
        monkeypatch.setattr(module, "broadcast_within", lambda df, bound=0, more=None: common.broadcast_within(df, limit, more))
    verdicts = {(r["_id"], r["_print"]): r["kept"] for r in quality_rules.judge(docs).collect()}
    prints = [(r["doc_id"], r["p"], r["text"]) for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("p")).collect()]
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(((i, t) for i, p, t in prints if verdicts[i, p]), key=str)
    some = labels_of(spark, [(i, i % 2, i % 2) for i in range(24)])
    for operator, keep, bad in ((quality_rff, quality_rff.keep_good, 0), (toxicity, toxicity.drop_toxic, 1)):
        predicted = {(r["_id"], r["_print"]): r["predicted"] for r in operator.score_documents(docs, some).collect()}
        left = keep(docs, some)
        assert left.columns == docs.columns
        assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(((i, t) for i, p, t in prints if predicted[i, p] != bad), key=str)
        assert keep(none, some).count() == 0
    assert quality_rules.filter_documents(none).count() == 0


def test_subset_matches_a_plain_search(spark):
    """Forty rows with nine outliers of two kinds: the estimate is that of the least determinant over many random starts."""
    rng = np.random.default_rng(9)
    names = list(quality_rules.FLOORS)
    texts = []
    for i in range(40):
        n, far = int(rng.integers(60, 160)), i >= 31
        words = ["".join(rng.choice(list("abcdefgh"), int(rng.integers(3, 8)) + 5 * (far and i % 2))) for _ in range(n)]
        for k in range(0, n, 9 if far and not i % 2 else 40):
            words[k] = "#$"
        texts.append((i, " ".join(words), "en", "s"))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string")
    stats = quality_rules.base_statistics(docs).filter(~quality_rules.base_failed())
    got = {r["_id"]: r["distance"] for r in quality_rules.outlier_distances(stats, least=20).collect()}
    x = np.array([[round(r[n] * quality_rules.UNIT) for n in names] for r in stats.select("_id", *[f.alias(n) for n, f in quality_rules.features().items()]).orderBy("_id").collect()], dtype=float)
    p, floors = len(names), np.diag([(quality_rules.FLOORS[n] * quality_rules.UNIT) ** 2 for n in names])
    factor = quality_rules.SUBSET / quality_rules.chi_square_cdf(quality_rules.chi_square_quantile(quality_rules.SUBSET, p), p + 2)
    h = int(np.ceil(quality_rules.SUBSET * len(x)))

    def estimate(rows, by):
        return rows.mean(0), np.cov(rows.T, bias=True) * by + floors

    def distances(mean, cov):
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)

    best = None
    for _ in range(300):
        rows = x[rng.choice(len(x), p + 1, replace=False)]
        for _ in range(60):
            mean, cov = estimate(rows, factor)
            again = x[np.argsort(distances(mean, cov), kind="stable")[:h]]
            if (again == rows).all() if again.shape == rows.shape else False:
                break
            rows = again
        value = np.linalg.slogdet(cov)[1]
        if best is None or value < best[0] - 1e-12:
            best = (value, mean, cov)
    inside = x[distances(*best[1:]) <= quality_rules.chi_square_quantile(0.975, p)]
    want = distances(*estimate(inside, 1.0))
    assert len(got) == 40 and np.allclose([got[i] for i in range(40)], want, rtol=0.1)
    assert {i for i in range(40) if got[i] > 25} == {i for i in range(40) if want[i] > 25} and min(got[i] for i in range(31, 40)) > max(got[i] for i in range(31))


def test_chi_square_points():
    assert quality_rules.chi_square_quantile(0.95, 1) == pytest.approx(3.8415, abs=1e-3)
    assert quality_rules.chi_square_quantile(0.975, 5) == pytest.approx(12.8325, abs=1e-3)


# -- 10

def test_blocks_spread_over_links(spark):
    link = '<link rel="canonical" href="{}">'
    pages = [
        (1, "http://a.org/x", link.format("http://bad.net/es/1")), (2, "http://b.org/y?q=1#f", '<META content="0; URL=http://a.org/x" http-equiv=Refresh>'),
        (3, "https://www.example.com/en/z", link.format("//bad.net/es/1")), (4, "http://c.org/", "<!-- " + link.format("http://bad.net/es/1") + " -->"),
        (5, "http://d.org/p/q", link.format("r")), (6, "http://d.org/p/r", link.format("/s?t=1&amp;u=2")), (7, "http://d.org/s?t=1&u=2", None),
        (8, None, None), (9, "no scheme/net/es/", link.format("http://bad.net/es/1")), (10, "HTTP://X.NET/es/", ""), (11, "http://net/de/", ""),
        (12, "http://e.net/es", ""), (13, "http://e.org/w", "<script>" + link.format("http://bad.net/es/1") + "</script>"), (1, "http://a.org/x", None),
        (14, "http://planet/es/1", ""), (15, "http://m.example.com/en/1?x", ""), (16, "ftp://f.org", ""),
    ]
    frame = spark.createDataFrame([(i, u, h, "clash", "clash") for i, u, h in pages], "page_id bigint, url string, html string, rule string, node string")
    rules = url_filter.rule_table(spark, [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")])
    seen = spark.createDataFrame([("http://f.org", "http://d.org/s?t=1&u=2"), ("http://f.org", "http://no.net/fr/"), (None, "http://a.org/x")], "url string, target string")
    got = {(r["page_id"], r["rule"], r["verdict"]) for r in url_filter.judge_pages(frame, rules).collect()}
    assert got == {
        (1, None, "block"), (2, None, "block"), (3, "www.example.com/en/", "allow"), (4, None, "allow"), (5, None, "allow"), (6, None, "allow"), (7, None, "allow"),
        (8, None, "allow"), (9, None, "allow"), (10, "net/es/", "block"), (11, None, "allow"), (12, None, "allow"), (13, None, "allow"), (14, None, "allow"),
        (15, "example.com/en/", "block"), (16, None, "allow"),
    }
    more = {r["page_id"]: r["verdict"] for r in url_filter.judge_pages(frame, rules, redirects=seen).collect()}
    assert {i for i, v in more.items() if v == "block"} == {1, 2, 5, 6, 7, 10, 15, 16}
    hosts = {r["page_id"]: (r["host"], r["path"]) for r in url_filter.judge_pages(frame, rules).collect()}
    assert hosts[8] == hosts[9] == ("", "") and hosts[10] == ("x.net", "/es/") and hosts[16] == ("f.org", "") and hosts[2] == ("b.org", "/y")
    assert url_filter.judge_pages(frame.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge_pages(frame, url_filter.rule_table(spark, [])).collect()} == {"allow"}


@pytest.mark.parametrize("connected_components", [connected_components, url_filter.alias_classes], ids=["stars", "hooks"])
def test_components_of_paths_hubs_and_loops(spark, connected_components):
    edges = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(50)] + [(300, 301), (301, 302), (302, 300), (5, 5), (None, 7), (300, 301)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{200 + i: 200 for i in range(50)}, 300: 300, 301: 300, 302: 300}
    assert connected_components(spark.createDataFrame([], "a int, b int")).count() == 0
    rng = random.Random(2)
    made = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(45)]
    lead = {}

    def find(x):
        while lead.setdefault(x, x) != x:
            x = lead[x]
        return x

    for a, b in made:
        if a != b:
            a, b = sorted((find(a), find(b)))
            lead[b] = a
    assert dict(tuple(r) for r in connected_components(spark.createDataFrame(made, "a string, b string")).collect()) == {x: find(x) for x in list(lead)}
