"""Near duplicates by hash buckets: links of a bucket closed with as many rows as it has members, every link verified exactly."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkweave.operators.bucket_links import bucket_links, sketch, sketches_close, sketches_near
from sparkweave.operators.graphs import connected_components
from sparkweave.operators.joins import salted_join
from sparkweave.operators.text import words
from sparkweave.sources.files import stored

SALTS = 8


def shingles(df: DataFrame, key: str, text: str, n: int = 3) -> DataFrame:
    """``id, f``: distinct hashes of the runs of ``n`` lower-case words of the whole text (shorter texts give one)."""
    # the word list is a column of its own, so it is built once and not once per run
    w = df.select(F.col(key).alias("id"), words(F.lower(text)).alias("w"))
    last = F.greatest(F.size("w") - (n - 1), F.lit(1))
    runs = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.array_join(F.slice(F.col("w"), i, F.lit(n)), " ")))
    return w.select("id", F.array_distinct(runs).alias("f"))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def minhash_buckets(df: DataFrame, hashes: str, bands: int, rows: int, seed: int = 7) -> DataFrame:
    """``id, bucket``, one row per band: hash of ``rows`` minima of multiply-add permutations over 64-bit hashes."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) | np.uint64(1)
    c = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)

    @F.pandas_udf("array<bigint>")
    def signature(s: pd.Series) -> pd.Series:
        def one(h):
            h = np.asarray(h, dtype=np.int64).view(np.uint64)
            best = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
            for k in range(0, len(h), 4096):  # bounded memory for very long texts
                best = np.minimum(best, (h[k : k + 4096, None] * a + c).min(axis=0))
            return best.view(np.int64)

        return s.map(one)

    signed = df.select("id", signature(hashes).alias("sig"))
    return signed.select(
        "id", F.explode(F.array(*[F.xxhash64(F.lit(i), F.slice("sig", i * rows + 1, rows)) for i in range(bands)])).alias("bucket")
    )


def set_sketches(features: DataFrame) -> DataFrame:
    """``id, n, sketch`` of ``features(id, f)``: size and parity sketch of every set of hashes."""

    @F.arrow_udf("binary")
    def made(sets: pa.Array) -> pa.Array:
        return pa.array([sketch(np.asarray(s.values, dtype=np.int64)) for s in sets], pa.binary())

    return features.select("id", F.size("f").cast("bigint").alias("n"), made("f").alias("sketch"))


def near_duplicate_texts(df: DataFrame, key: str, text: str, threshold: float = 0.8, bands: int = 20, rows: int = 4) -> DataFrame:
    """``id, leader, score``: exact copies (score 1) and near copies by Jaccard of word runs; ``key`` is an integer column.

    Exact copies collapse first, so a text copied a million times is hashed once. The links' closure is that of all
    similar pairs that share a band. Texts that are null link with nothing.
    """
    docs = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("t")).filter("t IS NOT NULL").withColumn("digest", F.md5("t"))
    firsts = docs.groupBy("digest").agg(F.min("id").alias("leader"))
    copies = salted_join(docs.select("id", "digest"), firsts, ["digest"], F.col("id"), SALTS).filter("id <> leader")
    unique = docs.join(firsts.select(F.col("leader").alias("id")), "id", "left_semi")
    features = stored(shingles(unique, "id", "t"), "shingles")
    members = stored(minhash_buckets(features, "f", bands, rows).distinct(), "members")
    sketches = stored(set_sketches(features), "sketches")

    def scored(pairs: DataFrame) -> DataFrame:
        both = pairs.join(features.select(F.col("id").alias("a"), F.col("f").alias("_fa")), "a").join(features.select(F.col("id").alias("b"), F.col("f").alias("_fb")), "b")
        return both.select("a", "b", jaccard(F.col("_fa"), F.col("_fb")).alias("score"))

    percent = int(threshold * 100)  # rounded down, so the sketches rule out no link
    links = bucket_links(members, sketches, sketches_near(percent), sketches_close(percent), lambda p: scored(p).filter(F.col("score") >= threshold).select("a", "b"))
    near = scored(links).select(F.col("b").alias("id"), F.col("a").alias("leader"), "score")
    return copies.select("id", "leader", F.lit(1.0).alias("score")).unionByName(near)


def duplicate_groups(df: DataFrame, key: str, links: DataFrame) -> DataFrame:
    """``<key>, group``: the least id that the links of ``links(id, leader)`` reach, for every row of ``df``."""
    named = connected_components(links.select(F.col("id").alias("a"), F.col("leader").alias("b")))
    return df.select(key).join(named.withColumnRenamed("node", key), key, "left").select(key, F.coalesce("component", key).alias("group"))


def simhash(text: str, word_hash: Callable[[Column], Column] = F.xxhash64) -> Column:
    """64-bit fingerprint: each word hash (a bigint) votes on every bit, the majority wins."""

    @F.pandas_udf("bigint")
    def vote(s: pd.Series) -> pd.Series:
        bits = np.arange(64, dtype=np.uint64)

        def one(h):
            h = np.asarray(h, dtype=np.int64).view(np.uint64)
            votes = np.zeros(64, dtype=np.int64)
            for k in range(0, len(h), 4096):
                votes += (((h[k : k + 4096, None] >> bits) & np.uint64(1)).astype(np.int64) * 2 - 1).sum(axis=0)
            value = ((votes > 0).astype(np.uint64) << bits).sum(dtype=np.uint64)
            return int(value.astype(np.int64))

        return s.map(one)

    w = F.array_remove(F.split(F.lower(text), r"\W+"), "")
    return vote(F.transform(w, lambda x: word_hash(x)))


def bits_near(max_bits: int) -> Callable:
    """Fingerprints ``f`` that differ in ``max_bits`` bits or fewer, as the near test of a bucket."""

    def prepare(table: pa.Table):
        f = table.column("f").to_numpy().view(np.uint64)

        def near(left, right, label):
            apart = np.bitwise_count(f[left][:, None] ^ f[right][None, :])
            r, c = np.nonzero((apart <= max_bits) & (label[left][:, None] != label[right][None, :]))
            return left[r], right[c], apart[r, c].astype(np.int64)

        return near

    return prepare


def _bits_apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))).cast("double")


def near_duplicate_pages(df: DataFrame, key: str, text: str, max_bits: int = 3, word_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``id, leader, score`` (score = differing bits) for pages whose fingerprints differ in few bits; ``key`` is an integer column.

    Six blocks of bits: with at most three differing bits, three blocks agree. Buckets are all
    choices of three blocks, so every close pair shares a bucket, and a bucket key has 30 bits or more. Texts that are
    null link with nothing.
    """
    if max_bits > 3:
        raise ValueError("six blocks find up to three differing bits")
    ids = df.filter(F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("id"), simhash(text, word_hash).alias("f"))
    prints = stored(ids, "fingerprints")
    firsts = stored(prints.groupBy("f").agg(F.min("id").alias("leader")), "first-prints")
    copies = salted_join(prints, firsts, ["f"], F.col("id"), SALTS).filter("id <> leader")
    unique = firsts.select(F.col("leader").alias("id"), "f")
    edges = [0, 11, 22, 33, 43, 53, 64]
    masks = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(6)]
    choices = [
        (masks[i] | masks[j] | masks[k]) for i in range(6) for j in range(i + 1, 6) for k in range(j + 1, 6)
    ]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in choices]
    keys = F.array(*[F.xxhash64(F.lit(n), F.col("f").bitwiseAND(F.lit(m).cast("bigint"))) for n, m in enumerate(signed)])
    members = stored(unique.select("id", F.explode(keys).alias("bucket")), "members")
    links = bucket_links(members, unique, bits_near(max_bits), lambda pairs: _bits_apart("f_a", "f_b") <= max_bits)
    near = links.join(unique.select(F.col("id").alias("a"), F.col("f").alias("_fa")), "a").join(unique.select(F.col("id").alias("b"), F.col("f").alias("_fb")), "b")
    near = near.select(F.col("b").alias("id"), F.col("a").alias("leader"), _bits_apart("_fa", "_fb").alias("score"))
    return copies.select("id", "leader", F.lit(0.0).alias("score")).unionByName(near)
