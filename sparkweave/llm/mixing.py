"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from sparkweave.llm.arrow_text import word_counts
from sparkweave.operators.ordered import number_rows
from sparkweave.sources.files import stored

MOST = 3  # copies of a document, and times its size that a source may give
ROUNDS = 60
CLOSE = 1e-9
BINS = 4096


@F.arrow_udf(LongType())
def text_size(text: pa.Array) -> pa.Array:
    """Words of a text; null has none."""
    return pa.array(word_counts(text))


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``_source, weight``: the sources by code point, null last, weighted by the given weights in turn.

    Sources are numbered in two levels, by their first characters and then within, so no task holds them all.
    """
    bins = F.when(F.col("_source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.substring("_source", 1, 3)))
    numbered = number_rows(sources.select("_source", bins.alias("_bin")), [], [F.col("_source").asc()], "_bin", "_rank")
    return numbered.select("_source", F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights)).cast("int")).alias("weight"))


def shared_targets(sizes: DataFrame, weights: DataFrame, most: int = MOST) -> DataFrame:
    """``_source, source_size, n, target``: the words of all sources dealt out by weight.

    A target stops at ``most`` times its source's size; what is above is dealt out again by weight among the
    others until none is above. ``sizes`` has ``_source, size`` per document.
    """
    w = weights.select(F.col("_source").alias("_wsource"), "weight")
    sums = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    table = stored(sums.join(w, F.col("_source").eqNullSafe(F.col("_wsource"))).select("_source", "source_size", "n", "weight"), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    cap, share = most * F.col("source_size"), 0.0
    capped = F.lit(False)
    while True:
        given, open_weight, n_capped = table.agg(
            F.sum(F.when(capped, cap).otherwise(0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))), F.count(F.when(capped, True))
        ).first()
        share = (total - (given or 0)) / open_weight if open_weight else 0.0
        now = capped | (cap < share * F.col("weight"))
        if table.filter(now).count() == n_capped:
            break
        # what is capped once stays so: the share only rises
        capped = cap < share * F.col("weight")
    return table.select("_source", "source_size", "n", F.when(capped, cap.cast("double")).otherwise(share * F.col("weight")).alias("target"))


def solve_tilts(cells: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """``_source, source_size, target, mean, tilt``: the dual of the entropy balance, solved by Newton steps.

    Rates ``r = min(most, exp(tilt * size / mean))`` are the ones closest in entropy to one copy of every document
    that give each source its words. The constraints part by source, so a step is one grouped sum over
    ``cells(_source, size, c)`` (documents of one size count together), then one Newton step per source, kept
    between bounds that close in. Steps are written to the shared folder.
    """
    state = targets.withColumns({
        "mean": F.greatest(F.col("source_size") / F.col("n"), F.lit(1e-9)), "tilt": F.lit(0.0),
        "_low": F.lit(None).cast("double"), "_high": F.lit(None).cast("double"), "_off": F.lit(1.0),
    })
    state = stored(state, "tilts")
    for _ in range(ROUNDS):
        now = state.withColumnRenamed("_source", "_s")
        rows = cells.join(now.select("_s", "mean", "tilt"), F.col("_source").eqNullSafe(F.col("_s")))
        x = F.col("size") / F.col("mean")
        power = F.col("tilt") * x
        rate = F.when(power >= math.log(most), float(most)).otherwise(F.exp(power))
        words = F.col("c") * F.col("size")
        sums = rows.groupBy(F.col("_s").alias("_k")).agg(
            F.sum(words * rate).alias("_got"), F.sum(F.when(power < math.log(most), words * x * F.exp(power)).otherwise(0.0)).alias("_slope")
        )
        both = now.join(sums, F.col("_s").eqNullSafe(F.col("_k")), "left").withColumn("_gap", F.coalesce("_got", F.lit(0.0)) - F.col("target"))
        low = F.when(F.col("_gap") < 0, F.col("tilt")).otherwise(F.col("_low"))
        high = F.when(F.col("_gap") >= 0, F.col("tilt")).otherwise(F.col("_high"))
        both = both.withColumns({"_low": low, "_high": high})
        newton = F.when(F.col("_slope") > 0, F.col("tilt") - F.col("_gap") / F.col("_slope"))
        inside = newton.isNotNull() & (F.col("_low").isNull() | (newton > F.col("_low"))) & (F.col("_high").isNull() | (newton < F.col("_high")))
        step = (
            F.when(F.col("_low").isNotNull() & F.col("_high").isNotNull(), (F.col("_low") + F.col("_high")) / 2)
            .when(F.col("_low").isNull(), F.least(2 * F.col("tilt"), F.lit(-1.0))).otherwise(F.greatest(2 * F.col("tilt"), F.lit(1.0)))
        )
        off = F.abs(F.col("_gap")) / F.greatest(F.col("target"), F.lit(1.0))
        state = stored(both.select(
            F.col("_s").alias("_source"), "source_size", "n", "target", "mean",
            F.when(off <= CLOSE, F.col("tilt")).when(inside, newton).otherwise(step).alias("tilt"), "_low", "_high", off.alias("_off"),
        ), "tilts")
        if (state.agg(F.max("_off")).first()[0] or 0.0) <= CLOSE:
            break
    return state.select("_source", "source_size", "target", "mean", "tilt")


def _rate(most: int) -> Column:
    """The tilted rate; a source whose target is all it may give, gives all."""
    power = F.col("tilt") * F.col("size") / F.col("mean")
    free = F.when(power >= math.log(most), float(most)).otherwise(F.exp(power))
    return F.when(F.col("target") >= most * F.col("source_size"), float(most)).otherwise(free)


def _rounding(key: list[Column]) -> tuple[Column, Column]:
    """Whole copies of a rate, and how far its rest lies above a hash of the row, in ``BINS`` a unit."""
    point = F.pmod(F.xxhash64(F.lit("copies"), *key), F.lit(1 << 30)) / float(1 << 30)
    return F.floor("rate").cast("bigint"), F.floor((F.col("rate") - F.floor("rate") - point) * BINS).cast("bigint")


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: DataFrame | None = None, most: int = MOST):
    """``sized, limits``: the documents with ``_size``, and per source what decides their copies.

    ``limits``: ``_source, source_size, target, mean, tilt, cut, swap``. A document takes the whole part of its rate,
    and one copy more if its rest lies at or above the cut. The cut is where the words of a source come nearest to
    its target, read off counts of fine bins; ``swap`` names one document that takes a copy more or less to come
    nearer still. No draw is random, so reruns agree.
    """
    sizes = docs.select(F.col(doc_id).alias("_id"), F.col(source).cast("string").alias("_source"), F.xxhash64(F.col(text)).alias("_print"), text_size(F.col(text)).alias("size"))
    sizes = stored(sizes, "sizes")
    if weights is None:
        weights = cyclic_weights(sizes.select("_source").distinct())
    targets = shared_targets(sizes, weights, most)
    cells = stored(sizes.groupBy("_source", "size").agg(F.count(F.lit(1)).alias("c")), "cells")
    state = solve_tilts(cells.filter("size > 0"), targets, most)

    tilts = state.withColumnRenamed("_source", "_s")
    rated = sizes.join(tilts, F.col("_source").eqNullSafe(F.col("_s"))).withColumn("rate", _rate(most))
    whole, above = _rounding([F.col("_id"), F.col("_print")])
    rated = rated.withColumns({"_whole": whole, "_bin": F.when(F.col("rate") < most, above)})
    bins = stored(rated.groupBy("_s", "_bin").agg(
        F.sum(F.col("_whole") * F.col("size")).alias("_base"), F.sum("size").alias("_more"), F.first("target").alias("target")
    ), "rest-bins")
    base = bins.groupBy(F.col("_s").alias("_b")).agg(F.sum("_base").alias("_base"), F.first("target").alias("_target"))
    down = Window.partitionBy("_s").orderBy(F.col("_bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    runs = bins.filter("_bin IS NOT NULL").withColumn("_run", F.sum("_more").over(down)).select("_s", "_bin", "_run")
    ends = runs.join(base, F.col("_s").eqNullSafe(F.col("_b"))).withColumn("_miss", F.abs(F.col("_base") + F.col("_run") - F.col("_target")))
    best = ends.groupBy("_s").agg(F.min(F.struct("_miss", "_bin")).alias("_at"), F.first(F.abs(F.col("_base") - F.col("_target"))).alias("_none"))
    at = F.when(F.col("_at._miss") < F.col("_none"), F.col("_at._bin"))
    cut = stored(best.select(F.col("_s").alias("_c"), at.alias("cut")), "cuts")

    # what is still missing (or too much) is brought nearest by one document: a copy more, or one less
    joined = rated.join(cut, F.col("_s").eqNullSafe(F.col("_c")), "left").withColumn("_more", _extra(F.col("_bin"), F.col("cut")))
    got = joined.groupBy(F.col("_s").alias("_g")).agg(F.sum((F.col("_whole") + F.col("_more")) * F.col("size")).alias("_got"))
    gaps = joined.join(got, F.col("_s").eqNullSafe(F.col("_g"))).withColumn("_gap", F.col("target") - F.col("_got"))
    turn = F.when(F.col("_more") == 1, -1).when(F.col("rate") < most, 1).otherwise(0)
    left = F.abs(F.col("_gap") - turn * F.col("size"))
    swap = gaps.filter((left < F.abs("_gap")) & (turn != 0)).groupBy("_s").agg(F.min(F.struct(left.alias("left"), F.col("_id"), F.col("_print"), turn.alias("turn"))).alias("swap"))
    limits = tilts.join(cut, F.col("_s").eqNullSafe(F.col("_c")), "left").drop("_c")
    limits = limits.join(swap.withColumnRenamed("_s", "_c"), F.col("_s").eqNullSafe(F.col("_c")), "left").drop("_c")
    return sizes, stored(limits.withColumnRenamed("_s", "_source"), "limits")


def _extra(above: Column, cut: Column) -> Column:
    """One copy more for a rest at or above the cut."""
    return F.when(above.isNotNull() & cut.isNotNull() & (above >= cut), 1).otherwise(0)


def _copies(sized: DataFrame, limits: DataFrame, key: list[Column], most: int) -> DataFrame:
    """``sized`` (with ``_source, size``) with ``source_size, target, rate, copies, taken``."""
    own = limits.withColumnRenamed("_source", "_s")
    rated = sized.join(own, F.col("_source").eqNullSafe(F.col("_s")), "left").withColumn("rate", _rate(most))
    whole, above = _rounding(key)
    more = _extra(F.when(F.col("rate") < most, above), F.col("cut"))
    swapped = F.col("swap._id").eqNullSafe(key[0]) & (F.col("swap._print") == key[1])
    copies = F.least(whole + more + F.when(swapped, F.col("swap.turn")).otherwise(0), F.lit(most)).cast("bigint")
    return rated.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).drop("_s", "mean", "tilt", "cut", "swap")


def mixing_rates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: DataFrame | None = None, most: int = MOST) -> DataFrame:
    """``_id, _source, size, source_size, target, rate, copies, taken``, one row per document.

    Sizes are words. ``weights(_source, weight)`` names the share of each source; by default the sources weigh
    1, 2, 3 in turn by code point, null last. Defined cases: null or empty text has size 0, rate 1 and takes no
    words; null is a source of its own, the last; repeated rows are treated alike; sources without words have the
    target 0; an empty table gives no rows. Only the named columns are read.
    """
    sizes, limits = plan(docs, doc_id, text, source, weights, most)
    out = _copies(sizes, limits, [F.col("_id"), F.col("_print")], most)
    return out.select("_id", "_source", "size", "source_size", "target", "rate", "copies", "taken")


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: DataFrame | None = None, most: int = MOST) -> DataFrame:
    """The mix itself: each document as often as it is taken, all columns kept, with ``copy`` from 1 (``_copy`` if there is a ``copy``).

    A null source is a source of its own, null ids are ids; null and empty texts have size 0 and count for nothing, so they are
    taken as often as their rate says; repeated rows are taken each; no documents give no rows.

    Only the few rows per source that decide the copies are joined; texts are not moved.
    """
    _, limits = plan(docs, doc_id, text, source, weights, most)
    names = docs.columns
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_print"),
        F.col(source).cast("string").alias("_source"), text_size(F.col(text)).alias("size"),
    )
    out = _copies(sized, limits, [F.col("_id"), F.col("_print")], most).filter("copies > 0")
    mark = "copy" if "copy" not in names else "_copy"
    copies = out.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("_n"))
    return copies.select(*[F.col("_row")[c].alias(c) for c in names], F.col("_n").alias(mark))
