"""Benchmark decontamination: a broadcast hash set of test word windows, verified word by word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkweave.llm.common import ascii_lower, broadcast_within, let, row_identity, same_row
from sparkweave.sources.files import stored

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13


def item_words(text: Column) -> Column:
    """Words of letters, digits and everything beyond ASCII, A-Z lower-cased; none for null."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), SEPARATORS), ""), F.array().cast("array<string>"))


def _window(words: str, at: Column, width: Column) -> Column:
    return F.slice(F.col(words), at, width)


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """``item_id, width, h, gram``: every run of ``window`` words; a shorter item with words is one run."""
    words = items.select(F.col(item_id).alias("item_id"), item_words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    words = words.withColumn("width", F.least(F.size("w"), F.lit(window)))
    at = words.withColumn("at", F.explode(F.expr("sequence(1, size(w) - width + 1)")))
    gram = _window("w", F.col("at"), F.col("width"))
    return at.select("item_id", "width", F.xxhash64(gram).alias("h"), F.array_join(gram, " ").alias("gram")).distinct()


def benchmark_hits(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """One row per document: ``_id, _print, n_words, spans, items``.

    ``spans`` lists the hit word ranges as ``struct(first, last)`` (zero-based, merged, in order),
    ``items`` the ids of the items whose windows occur. Both are empty for a clean document.

    The hashes of all item windows are broadcast (their size is counted first; beyond the bound the same
    join shuffles). Every window of every document is looked up, then each hit is compared word by word,
    so an equal hash alone never counts. Defined cases: null text has no words; an item without words
    matches nothing; equal items all count; rows that repeat (equal id and text) each get the result;
    no documents or no items give no hits. Only the named columns are read.
    """
    grams = stored(item_windows(items, item_id, item_text, window), "item-windows")
    known = grams.select("width", "h").distinct()
    widths = sorted(r[0] for r in known.select("width").distinct().collect())  # at most ``window`` numbers
    base = docs.select(*row_identity(F.col(doc_id), F.col(text)), F.col(text).alias("_text"))
    words = base.select("_id", "_print", item_words(F.col("_text")).alias("_w"))

    def at_width(k: int) -> Column:
        def one(i):
            return F.struct(i.alias("at"), F.lit(k).alias("width"), F.xxhash64(_window("_w", i, F.lit(k))).alias("h"))

        starts = F.expr(f"CASE WHEN size(_w) >= {k} THEN sequence(1, size(_w) - {k - 1}) ELSE cast(array() AS array<int>) END")
        return F.transform(starts, one)

    # one pass over the texts: a first entry of width 0 carries the number of words and counts repeated rows
    head = F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("width"), F.size("_w").cast("bigint").alias("h")))
    probes = words.select("_id", "_print", F.inline(F.concat(head, *[at_width(k) for k in widths])))
    found = probes.join(broadcast_within(known.withColumn("_known", F.lit(True))), ["width", "h"], "left").filter("_known OR width = 0")
    is_head = F.col("width") == 0
    per_doc = stored(found.groupBy("_id", "_print").agg(
        F.max(F.when(is_head, F.col("h"))).alias("n_words"), F.count(F.when(is_head, True)).alias("_rows"),
        F.sort_array(F.collect_set(F.when(~is_head, F.struct("at", "width", "h")))).alias("_hits"),
    ), "hits")
    hits = per_doc.filter(F.size("_hits") > 0).select("_id", "_print", "_hits")

    # the few documents with hits are read once more, and each hit is verified on the words themselves
    keys = broadcast_within(hits.select("_id", "_print"))
    again = base.join(keys, same_row(base, keys), "left_semi").dropDuplicates(["_id", "_print"])
    again = again.select("_id", "_print", item_words(F.col("_text")).alias("_w"))
    both = again.join(hits, same_row(again, hits)).select(
        again["_id"], again["_print"],
        F.transform("_hits", lambda x: F.struct(
            x["at"].alias("at"), x["width"].alias("width"), x["h"].alias("h"),
            F.array_join(_window("_w", x["at"], x["width"]), " ").alias("gram"),
        )).alias("_hits"),
    )
    texts = broadcast_within(grams)
    verified = both.select("_id", "_print", F.inline("_hits")).join(texts, ["width", "h", "gram"])
    marks = verified.groupBy("_id", "_print").agg(
        F.sort_array(F.collect_set(F.struct((F.col("at") - 1).alias("first"), (F.col("at") + F.col("width") - 2).alias("last")))).alias("_marks"),
        F.collect_set("item_id").alias("items"),
    )
    marks = marks.withColumn("spans", F.expr(
        """aggregate(_marks, cast(array() AS array<struct<first: int, last: int>>), (done, x) ->
           CASE WHEN size(done) > 0 AND x.first <= element_at(done, -1).last + 1
                THEN concat(slice(done, 1, size(done) - 1),
                            array(struct(element_at(done, -1).first AS first, greatest(element_at(done, -1).last, x.last) AS last)))
                ELSE concat(done, array(x)) END)"""
    )).select(F.col("_id").alias("_mid"), F.col("_print").alias("_mprint"), "spans", "items")
    counted = per_doc.select("_id", "_print", "n_words", F.explode(F.sequence(F.lit(1), F.col("_rows"))).alias("_copy"))
    joined = counted.join(marks, counted["_id"].eqNullSafe(marks["_mid"]) & (counted["_print"] == marks["_mprint"]), "left")
    return joined.select(
        "_id", "_print", "n_words",
        F.coalesce("spans", F.expr("cast(array() AS array<struct<first: int, last: int>>)")).alias("spans"),
        F.coalesce("items", F.expr(f"cast(array() AS array<{dict(grams.dtypes)['item_id']}>)")).alias("items"),
    )


def n_hit() -> Column:
    """Number of hit words of a row of ``benchmark_hits``."""
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"] + 1)


def contaminated() -> Column:
    """At least a twentieth of the words are hit."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The documents without contaminated ones; every other row keeps its columns and its text.

    Rows go by id and text: repeated rows stay or go together, null ids are ids. Null and empty texts have no words and stay;
    texts of any length are read whole. Without items, or with none that has words, all stay; no documents give no rows.
    """
    marks = benchmark_hits(docs, items, doc_id, text, **names)
    bad = stored(marks.filter(contaminated()).select("_id", "_print").distinct(), "contaminated")
    bad = broadcast_within(bad)
    keep = F.col(doc_id).eqNullSafe(bad["_id"]) & (F.xxhash64(F.col(text)) == bad["_print"])
    return docs.join(bad, keep, "left_anti")


def without_spans(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """``docs`` with the hit words cut out of the texts and all else unchanged; the other outcome than dropping documents.

    Every row stays with all its columns, repeated rows and null ids too. A text without hits, also a null one, is left as it is.
    """
    marks = benchmark_hits(docs, items, doc_id, text, **names).filter(F.size("spans") > 0)
    marks = marks.select(F.col("_id").alias("_llm_id"), F.col("_print").alias("_llm_print"), F.col("spans").alias("_llm_spans"))
    marks = stored(marks.dropDuplicates(["_llm_id", "_llm_print"]), "hit-spans")
    marks = broadcast_within(marks, more=F.size("_llm_spans") * 8)
    same = F.col(doc_id).eqNullSafe(marks["_llm_id"]) & (F.xxhash64(F.col(text)) == marks["_llm_print"])
    both = docs.join(marks, same, "left")
    # separators and words alternate: piece i is what stands before word i
    gaps = F.split(F.col(text), ANY_CASE_WORD, -1)
    words = F.regexp_extract_all(F.col(text), F.lit(ANY_CASE_WORD), F.lit(0))
    inside = lambda i: F.exists("_llm_spans", lambda s: (i >= s["first"]) & (i <= s["last"]))  # noqa: E731  spans are merged, so few

    def joined(kept):
        return F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(kept, i), F.lit("")))), "")

    kept = F.transform(words, lambda w, i: F.when(inside(i), "").otherwise(w))
    cut = F.when(F.col("_llm_spans").isNull(), F.col(text)).otherwise(let(kept, joined))
    return both.select(*[cut.alias(c) if c == text else F.col(c) for c in docs.columns])
