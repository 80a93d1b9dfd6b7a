"""The pipeline and the dealt queries as registered."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from sparkweave.llm import mixing, pii, quality_rff
from tests.llm.test_operators import base_spans, blank_words, lower, plain_hits

OPS = ("op1_html_text", "op2_mixing", "op3_language", "op4_quality", "op5_pii", "op6_ngram_join", "op7_decontaminate", "op8_quality_rules", "op9_toxicity", "op10_url_filter", "op12_fill_middle")


def test_all_queries_are_registered():
    assert {*OPS, "op11_spelling", "op13_nearest", "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", OPS)
def test_one_row_per_input_row(spark, sf, tables, name):
    table = tables.pages if name in ("op1_html_text", "op10_url_filter") else tables.documents
    key = "page_id" if "page_id" in table.columns else "doc_id"
    got = entry.queries()[name](spark, sf).select(key).collect()
    assert sorted(r[0] for r in got) == sorted(r[0] for r in table.select(key).collect())


def test_native_queries_run_no_python(spark, sf):
    for name in ("op5_pii", "op7_decontaminate", "op8_quality_rules", "op10_url_filter"):
        plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


@pytest.fixture(scope="module")
def stages(spark, sf, tables):
    """Rows before and after every stage, each stage on all that the one before it kept."""
    docs, out = tables.documents.withColumn("extra", F.lit(1)), {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, sf), f"test-{name}")
        out[name] = docs, after
        docs = after
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_in_order(spark, sf, tables, stages):
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "personal_data", "mix"]
    for name, (before, after) in stages.items():
        assert after.columns == ([*before.columns, "copy"] if name == "mix" else before.columns)
    assert corpus_pipeline.run(spark, sf).count() == stages["mix"][1].count() > 0


def test_quality_stage_drops_what_is_predicted_bad(tables, stages):
    before, after = (by_id(x) for x in stages["quality"])
    bad = {r["_id"] for r in quality_rff.score_documents(stages["quality"][0], tables.labels).collect() if r["predicted"] == 0}
    assert bad and after == {i: r for i, r in before.items() if i not in bad}


def test_near_duplicate_stage_keeps_one_of_each_component(stages):
    before, after = (by_id(x) for x in stages["near_duplicates"])
    sets = {}
    for i, r in before.items():
        w = [lower(x) for x in blank_words(r["text"])]
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    lead = {i: i for i in sets}

    def find(i):
        while lead[i] != i:
            i = lead[i]
        return i

    order = sorted(sets)
    for k, i in enumerate(order):
        for j in order[k + 1 :]:
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= 80 * max(len(sets[i]), len(sets[j])) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                lead[b] = a
    assert after == {i: r for i, r in before.items() if find(i) == i}


def test_decontamination_stage_drops_contaminated_documents(tables, stages):
    before, after = (by_id(x) for x in stages["decontamination"])
    items = [(r["item_id"], r["text"]) for r in tables.benchmark.collect()]
    hits = {i: plain_hits(r["text"], items) for i, r in before.items()}
    assert after == {i: r for i, r in before.items() if not (hits[i][1] and 20 * hits[i][1] >= hits[i][0])}


def test_personal_data_stage_replaces_spans_and_nothing_else(stages):
    before, after = (by_id(x) for x in stages["personal_data"])
    found = {r["_id"]: r["spans"] for r in pii.find(stages["personal_data"][0]).collect()}
    assert before.keys() == after.keys() and any(found.values())
    for i, r in before.items():
        text, done, at = r["text"], "", 0
        assert [(s["start"], s["kind"], s["end"]) for s in found[i] if s["kind"] < pii.KINDS.index("term")] == base_spans(text)
        for s in found[i]:
            if s["start"] >= at:
                mark = "" if s["value"] == "removed" and pii.KINDS[s["kind"]] == "term" else f"[{pii.KINDS[s['kind']].upper()}]"
                done, at = done + text[at : s["start"]] + mark, s["end"]
        want = done + text[at:] if found[i] else text
        assert after[i]["text"] == want and after[i]["n_chars"] == (len(want) if found[i] else r["n_chars"])
        assert [after[i][c] for c in ("doc_id", "lang", "source", "extra")] == [r[c] for c in ("doc_id", "lang", "source", "extra")]


def test_mix_stage_takes_documents_as_often_as_planned(stages):
    before, after = by_id(stages["mix"][0]), stages["mix"][1].collect()
    copies = {r["_id"]: r["copies"] for r in mixing.mixing_rates(stages["mix"][0]).collect()}
    assert sorted((r["doc_id"], r["copy"]) for r in after) == sorted((i, k + 1) for i, n in copies.items() for k in range(n))
    assert all({c: r[c] for c in before[r["doc_id"]].asDict()} == before[r["doc_id"]].asDict() for r in after)
    weight = {s: k for k, s in enumerate(sorted({r["source"] for r in before.values()} - {None}))}
    assert len(weight) > 1 and max(copies.values()) <= 3


def test_near_duplicates_match_brute_force_at_five_words(spark, sf):
    texts = []
    for g in range(8):
        words = [f"w{g}x{k}" for k in range(60)]
        texts += [words, [*words, *(f"m{g}x{k}" for k in range(9 + g))]]  # 5-word similarity from 0.77 to 0.86
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    kept = {j for j in range(len(texts)) if not any(100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for i in range(j))}
    assert 8 < len(kept) < 16
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, frame, sf).collect()} == kept


def test_empty_corpus(spark, sf, tables):
    docs = tables.documents.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), f"test-{name}")
    assert docs.count() == 0
