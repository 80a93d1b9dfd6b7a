"""User-defined functions: SQL, vectorised, aggregate, table and batch-model forms."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def register_sql_functions(spark: SparkSession) -> None:
    """Macros as temporary SQL functions; they are inlined into the plan."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION ratio_or_null(n DOUBLE, d DOUBLE) RETURNS DOUBLE RETURN n / nullif(d, 0D)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION cents_to_dollars(c DOUBLE) RETURNS DOUBLE RETURN c / 100")


def word_count(text: str) -> Column:
    """Words per text as a vectorised function."""

    @F.pandas_udf("bigint")
    def count(s: pd.Series) -> pd.Series:
        return s.str.split().str.len()

    return count(text)


def variance_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """A user aggregate with its own state: count, mean and squared deviations.

    Each batch folds its rows into one partial state per key; states are merged by sums, so no key
    is ever gathered in one place.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            g = pdf.groupby(key)[value]
            n, mean = g.count(), g.mean()
            m2 = g.apply(lambda v: float(((v - v.mean()) ** 2).sum()))
            yield pd.DataFrame({key: n.index, "n": n.to_numpy(), "mean": mean.to_numpy(), "m2": m2.to_numpy()})

    kind = df.schema[key].dataType.simpleString()
    states = df.select(key, value).mapInPandas(partial, f"{key} {kind}, n bigint, mean double, m2 double")
    merged = states.groupBy(key).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("mean")).alias("s"),
        F.sum(F.col("m2") + F.col("n") * F.col("mean") * F.col("mean")).alias("q"),
    )
    variance = (F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1)
    return merged.select(key, "n", F.when(F.col("n") > 1, variance).alias("variance"))


@F.udtf(returnType="chunk_no: int, chunk: string")
class ChunkWords:
    """Table function: word chunks of one text."""

    def eval(self, text: str, size: int, overlap: int):
        found, step = (text or "").split(), size - overlap
        for no in range(-(-len(found) // step)):
            yield no, " ".join(found[no * step : no * step + size])


def hash_embedder(dims: int) -> Callable[[Sequence[str]], np.ndarray]:
    """A stand-in model: unit vectors of folded word counts, the same on every run."""
    from sparkweave.operators.text import hashed_counts

    def embed(texts: Sequence[str]) -> np.ndarray:
        v = np.stack([hashed_counts(x, dims) for x in texts])
        n = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(n > 0, n, 1.0)

    return embed


def embed_batches(
    df: DataFrame, key: str, text: str, model: Callable[[Sequence[str]], np.ndarray], batch_size: int = 64, retries: int = 2
) -> DataFrame:
    """``key, embedding`` by calls of at most ``batch_size`` texts; a failing call is tried again."""

    def call(texts):
        for attempt in range(retries + 1):
            try:
                return model(texts)
            except Exception:
                if attempt == retries:
                    raise

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), batch_size):
                part = pdf.iloc[i : i + batch_size]
                v = call(part[text].fillna("").tolist())
                yield pd.DataFrame({key: part[key].to_numpy(), "embedding": list(v.astype(np.float32))})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInPandas(run, f"{key} {kind}, embedding array<float>")
