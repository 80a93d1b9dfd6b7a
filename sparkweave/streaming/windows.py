"""Event-time aggregation on streams; each builder also works on a batch frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def windowed(df: DataFrame, ts: str, keys, aggs: list[Column], size: str, slide: str | None = None, delay: str | None = None) -> DataFrame:
    """Tumbling or hopping windows as ``start, end, <keys>, <aggs>``; ``delay`` sets the watermark."""
    if delay:
        df = df.withWatermark(ts, delay)
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return df.groupBy(w, *keys).agg(*aggs).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "*").drop("window")


def sessions(df: DataFrame, ts: str, keys, aggs: list[Column], gap: str, delay: str | None = None) -> DataFrame:
    """Windows that close after ``gap`` without a record of the key."""
    if delay:
        df = df.withWatermark(ts, delay)
    out = df.groupBy(F.session_window(ts, gap), *keys).agg(*aggs)
    return out.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "*").drop("session_window")


def pairs_within(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, span_seconds: int, delay: str) -> DataFrame:
    """Join two streams on a key where the right record follows the left one within ``span_seconds``.

    State is kept by key and time bucket of one span: a right record goes to its own bucket and the one before, where its
    left partners are. So no state holds a whole key, and a busy key spreads over the tasks by time.
    """
    bucket = lambda ts: F.floor(F.unix_micros(ts) / (span_seconds * 1_000_000))
    a = left.withWatermark(left_ts, delay).withColumn("_bucket", bucket(F.col(left_ts))).alias("a")
    own = bucket(F.col(right_ts))
    b = right.withWatermark(right_ts, delay).withColumn("_bucket", F.explode(F.array(own, own - 1))).alias("b")
    on = (
        (F.col(f"a.{key}") == F.col(f"b.{key}"))
        & (F.col("a._bucket") == F.col("b._bucket"))
        & (F.col(f"b.{right_ts}") >= F.col(f"a.{left_ts}"))
        & (F.col(f"b.{right_ts}") <= F.col(f"a.{left_ts}") + F.expr(f"INTERVAL {span_seconds} SECONDS"))
    )
    return a.join(b, on)
