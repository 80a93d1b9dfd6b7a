"""Counters, histograms, service levels and traces held as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkweave.operators.ordered import previous_of_key
from sparkweave.sources.files import stored


def counter_increases(samples: DataFrame, series: Sequence[str], ts: Sequence[str], value: str, bin_col: str) -> DataFrame:
    """Samples with ``increase`` since the series' previous sample.

    A drop means the counter restarted, so the new value itself is the increase. The first sample
    of a series has no increase. There is no extrapolation to window edges.
    """
    p = previous_of_key(samples, series, [F.col(c) for c in ts], bin_col, [value])
    prev = F.col(f"prev_{value}")
    rise = F.when(F.col(value) >= prev, F.col(value) - prev).otherwise(F.col(value))
    return p.withColumn("increase", F.when(prev.isNotNull(), rise)).drop(f"prev_{value}")


def bucket_counts(df: DataFrame, keys: Sequence[str], value: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative counts per upper bound: one row per key with ``le_0 .. le_n`` and ``le_inf``."""
    cols = [F.count_if(F.col(value) <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]
    return df.groupBy(*keys).agg(*cols, F.count(value).alias("le_inf"))


def histogram_quantile(q: float, bounds: Sequence[float]) -> Column:
    """Quantile from the columns of ``bucket_counts``: linear inside the bucket that holds rank ``q * n``.

    The first bucket starts at zero; a rank in the last, open bucket gives the highest bound.
    """
    rank = F.col("le_inf") * F.lit(q)
    out = None
    for i, b in enumerate(bounds):
        low, below = (bounds[i - 1], F.col(f"le_{i - 1}")) if i else (0.0, F.lit(0))
        inside = F.lit(float(low)) + (b - low) * (rank - below) / F.nullif(F.col(f"le_{i}") - below, F.lit(0))
        hit = F.col(f"le_{i}") >= rank
        out = F.when(hit, inside) if out is None else out.when(hit, inside)
    return F.when(F.col("le_inf") > 0, out.otherwise(F.lit(float(bounds[-1]))))


def apdex(satisfied: Column, tolerated_or_better: Column, n: Column, as_written: bool = False) -> Column:
    """Apdex from cumulative buckets.

    The standard score is (satisfied + tolerated) / 2 over cumulative counts. ``as_written`` gives
    the common dashboard formula that adds the satisfied bucket in full and half the wider one.
    """
    score = (satisfied + tolerated_or_better / 2) if as_written else (satisfied + tolerated_or_better) / 2
    return score / F.nullif(n, F.lit(0))


def budget_used(success_pct: Column, target_pct: float) -> Column:
    """Share of the error budget used, in percent, at most 100."""
    allowed = 100.0 - target_pct
    if allowed == 0:
        return F.lit(100.0)
    return F.least(F.lit(100.0), (F.lit(100.0) - success_pct) / F.lit(allowed) * 100.0)


def held_alerts(points: DataFrame, keys: Sequence[str], step: str, firing: Column, for_steps: int) -> DataFrame:
    """Stretches of consecutive steps that all fire, at least ``for_steps`` long.

    ``points`` has one row per key and integer ``step``, so a key holds as many rows as there are steps.
    """
    w = Window.partitionBy(*keys).orderBy(step)
    runs = points.filter(firing).withColumn("_g", F.col(step) - F.row_number().over(w))
    out = runs.groupBy(*keys, "_g").agg(F.min(step).alias("first"), F.max(step).alias("last"), F.count(F.lit(1)).alias("steps"))
    return out.filter(F.col("steps") >= for_steps).drop("_g")


def trace_tree(spans: DataFrame) -> DataFrame:
    """``spans(trace, span, parent, duration)`` plus ``depth``, ``self_time`` and ``critical_child``.

    Self time is the duration less that of the direct children; the critical child is the longest
    one (lowest id on ties). Depth comes from one join per level, down to the deepest one; more levels than spans
    show a cycle and raise.
    """
    children = spans.filter(F.col("parent").isNotNull()).groupBy("trace", F.col("parent").alias("span")).agg(
        F.sum("duration").alias("_in_children"), F.min_by("span", F.struct(-F.col("duration"), F.col("span"))).alias("critical_child")
    )
    base = spans.join(children, ["trace", "span"], "left").withColumn("self_time", F.col("duration") - F.coalesce("_in_children", F.lit(0)))
    frontier = stored(spans.filter(F.col("parent").isNull()).select("trace", "span", F.lit(0).alias("depth")), "depth")
    depths, links = frontier, spans.filter(F.col("parent").isNotNull()).select("trace", F.col("span").alias("_s"), F.col("parent").alias("span"))
    depth, n_spans = 0, spans.count()
    while True:
        depth += 1
        if depth > n_spans + 1:
            raise ValueError("the trace has a cycle")
        frontier = stored(
            links.join(frontier, ["trace", "span"]).select("trace", F.col("_s").alias("span"), F.lit(depth).alias("depth")), "depth"
        )
        if frontier.isEmpty():
            break
        depths = depths.unionByName(frontier)
    return base.join(depths, ["trace", "span"], "left").drop("_in_children")


def label_matches(labels: str, selectors: Mapping[str, tuple[str, str]]) -> Column:
    """Condition over a label map: ``{"job": ("=", "api"), "status": ("=~", "5..")}``; a missing label is empty."""
    out = F.lit(True)
    for name, (op, want) in selectors.items():
        v = F.coalesce(F.try_element_at(labels, F.lit(name)), F.lit(""))
        test = {"=": v == want, "!=": v != want, "=~": v.rlike(f"^(?:{want})$"), "!~": ~v.rlike(f"^(?:{want})$")}[op]
        out = out & test
    return out
