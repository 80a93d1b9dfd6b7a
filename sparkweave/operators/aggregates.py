"""Aggregations beyond a plain ``groupBy``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def two_stage(
    df: DataFrame, keys: Sequence[str], salt_from: Column, aggs: Mapping[str, tuple[str, str]], salts: int = 10
) -> DataFrame:
    """Salted aggregation: partial results per (key, salt), then merged per key.

    ``aggs`` maps an output name to (function, column); sum, count, min and max can be merged.
    """
    merge = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    first = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_from), F.lit(salts)))
    partial = salted.groupBy(*keys, "_salt").agg(*[first[f](c).alias(n) for n, (f, c) in aggs.items()])
    return partial.groupBy(*keys).agg(*[merge[f](n).alias(n) for n, (f, _) in aggs.items()])


def majority_vote(votes: DataFrame, item: str, label: str, threshold: float) -> DataFrame:
    """Most frequent label per item (ties by label), its share, and a review mark below ``threshold``."""
    counts = votes.groupBy(item, label).agg(F.count(F.lit(1)).alias("_n"))
    first = F.struct(-F.col("_n"), F.col(label))
    out = counts.groupBy(item).agg(F.min_by(label, first).alias("label"), F.max("_n").alias("top"), F.sum("_n").alias("n"))
    share = F.col("top") / F.col("n")
    return out.select(
        item, "label", share.alias("confidence"),
        F.when(share < threshold, "HUMAN_REVIEW").otherwise(F.col("label")).alias("decision"),
    )


def functional_dependency(df: DataFrame, left: str, right: str) -> DataFrame:
    """Does ``left`` determine ``right``: keys, violating keys, and the share of keys that hold."""
    per_key = df.select(left, right).distinct().groupBy(left).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("_n") > 1).alias("violations"),
        (F.count_if(F.col("_n") == 1) / F.count(F.lit(1))).alias("strength"),
    )


def decomposition_check(df: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """Is the split into (key, left) and (key, right) lossless, without building the rejoin.

    Rejoining yields, per key, every left value with every right value; the split is lossless
    if each key already holds exactly that many distinct rows.
    """
    per_key = df.groupBy(key).agg(
        F.count_distinct(left).alias("a"), F.count_distinct(right).alias("b"), F.count_distinct(left, right).alias("ab")
    )
    return per_key.agg(
        F.sum("ab").alias("rows"),
        F.sum(F.col("a") * F.col("b")).alias("rejoined"),
        (F.sum(F.col("a") * F.col("b")) - F.sum("ab")).alias("spurious"),
        F.bool_and(F.col("ab") == F.col("a") * F.col("b")).alias("lossless"),
    )


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls and exact distinct values per column, one row per column, in one pass over the data."""
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])).alias("x")
    ).select("x.*")
    per_value = long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("v").alias("distinct_values"),
        F.max(F.when(F.col("v").isNotNull(), F.col("n"))).alias("top_count"),
    )


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank=F.row_number) -> DataFrame:
    """First ``n`` rows per key; each task sends at most the rows that can still win."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", rank().over(w)).filter(F.col("rank") <= n)
