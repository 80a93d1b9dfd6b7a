"""Vector search inside groups: members and queries of a bucket meet in blocks, as one matrix product a block.

An index gives every member its bucket in each of its tables and every query its buckets in order of closeness. How
many buckets a query probes is learnt from a sample of queries whose exact neighbours are known.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkweave.sources.files import stored

BLOCK = 4096  # members of a bucket that are compared in one task
ASKING = 1024  # queries of a bucket that are compared in one task
HELD = 300_000  # rows a task gathers before it keeps only the best of each query
SAMPLE = 192  # queries that are searched exactly, to learn how many probes reach the wanted recall


class Index(Protocol):
    """Buckets are numbered over all tables, from 0 to ``buckets - 1``."""

    buckets: int

    def codes(self, v: np.ndarray) -> np.ndarray:
        """The bucket of every row in each table."""

    def closeness(self, q: np.ndarray) -> np.ndarray:
        """How close every query is to every bucket."""


def matrix(vectors: pa.Array) -> np.ndarray:
    """The rows of an Arrow list column of equal lengths, in double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else np.empty((0, 1))


def unit(v: Column) -> Column:
    """The vector in double precision at length one; a zero vector stays."""
    n = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n)).otherwise(F.transform(v, lambda x: x.cast("double")))


def best_of_group(table: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``query, id`` and scores: for each query of one group its ``k`` members of largest inner product, more if they tie."""
    asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
    ident = table.column("id").to_numpy()
    v = matrix(pa.concat_arrays(table.column("v").chunks))
    q, m = np.flatnonzero(asks), np.flatnonzero(~asks)
    rows, cols, scores = [], [], []
    for low in range(0, len(q), 256):
        part = q[low : low + 256]
        product = v[part] @ v[m].T
        if len(m) > k:
            least = np.partition(product, len(m) - k, axis=1)[:, len(m) - k]
            r, c = np.nonzero(product >= (least - 2e-6)[:, None])
        else:
            r, c = np.divmod(np.arange(product.size), max(1, len(m)))
        rows.append(part[r])
        cols.append(m[c])
        # one fixed order of summation, so a pair has one score wherever it meets
        scores.extend((v[part[r[i : i + 8192]]] * v[m[c[i : i + 8192]]]).sum(axis=1) for i in range(0, len(r), 8192))
    r, c = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (rows, cols))
    return np.stack([ident[r], ident[c]], axis=1), np.round(np.concatenate(scores), 6) if scores else np.empty(0)


def best_of_task(pairs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best pairs of every query, each pair once; ties go to the smaller id."""
    order = np.lexsort((pairs[:, 1], -scores, pairs[:, 0]))
    pairs, scores = pairs[order], scores[order]
    new = np.ones(len(pairs), dtype=bool)
    new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
    pairs, scores = pairs[new], scores[new]
    first = np.ones(len(pairs), dtype=bool)
    first[1:] = pairs[1:, 0] != pairs[:-1, 0]
    begins = np.flatnonzero(first)
    place = np.arange(len(pairs)) - np.repeat(begins, np.diff(np.append(begins, len(pairs))))
    return pairs[place < k], scores[place < k]


def best_in_groups(members: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """``query, id, score``: the best ``k`` of every query among the members of its buckets, by inner product to six digits.

    ``members`` and ``asking`` have ``bucket, id, v``. Buckets are cut into blocks of about ``BLOCK`` members and
    ``ASKING`` queries, so a bucket that holds a third of all rows is many groups. A task passes on ``k`` members a
    query over all its groups, as far as it holds them.
    """
    count = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("_m")).join(asking.groupBy("bucket").agg(F.count(F.lit(1)).alias("_q")), "bucket")
    grid = count.select("bucket", F.ceil(F.col("_m") / BLOCK).cast("int").alias("_rows"), F.ceil(F.col("_q") / ASKING).cast("int").alias("_cols"))
    grid = stored(grid, "grid")
    place = F.xxhash64("id")
    left = members.join(grid, "bucket").select(
        "bucket", F.pmod(place, "_rows").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("_cols") - 1)).alias("j"), F.lit(0).alias("asks"), "id", "v"
    )
    right = asking.join(grid, "bucket").select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("_rows") - 1)).alias("i"), F.pmod(place, "_cols").cast("int").alias("j"), F.lit(1).alias("asks"), "id", "v"
    )
    dealt = left.unionByName(right).repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.Table] = []  # the group that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.concat_tables([*held, pa.Table.from_batches([batch])])
            key = np.stack([table.column(c).to_numpy() for c in ("bucket", "i", "j")])
            starts = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1])
            for low, high in zip(starts[:-1], starts[1:]):
                yield table.slice(low, high - low)
            held = [table.slice(starts[-1])]
        yield from held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, scores = np.empty((0, 2), dtype=np.int64), np.empty(0)
        got: list[tuple[np.ndarray, np.ndarray]] = []

        def kept() -> tuple[np.ndarray, np.ndarray]:
            return best_of_task(np.concatenate([pairs, *(p for p, _ in got)]), np.concatenate([scores, *(s for _, s in got)]), k)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(scores)], names=["query", "id", "score"])

        for group in groups(batches):
            got.append(best_of_group(group, k))
            if sum(len(s) for _, s in got) > HELD:
                pairs, scores = kept()
                got = []
                if len(scores) > HELD:  # too many queries in this task to go on holding them
                    yield out()
                    pairs, scores = pairs[:0], scores[:0]
        pairs, scores = kept()
        yield out()

    found = dealt.mapInArrow(run, "query bigint, id bigint, score double")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    return found.withColumn("_r", F.dense_rank().over(order)).filter(F.col("_r") <= k).drop("_r").dropDuplicates(["query", "id"])


def best_everywhere(nodes: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """The exact search: ``asking(id, v)`` against all ``nodes(id, v)``, block by block."""
    blocks = max(1, math.ceil(nodes.count() / BLOCK))
    members = nodes.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("bucket"), "id", "v")
    return best_in_groups(members, asking.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("bucket"), "id", "v"), k)


def sampled_neighbours(nodes: DataFrame, asking: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of up to ``SAMPLE`` queries and of their ``k`` exact neighbours, pair by pair; that many come to the driver."""
    sample = stored(asking.orderBy(F.xxhash64(F.lit(7), "id"), "id").limit(SAMPLE), "sample")
    best = best_everywhere(nodes, sample, k + 1).filter("query <> id")
    pairs = best.join(nodes.select("id", F.col("v").alias("_b")), "id").join(sample.select(F.col("id").alias("query"), F.col("v").alias("_a")), "query").select("_a", "_b").collect()
    return tuple(np.array([r[c] for r in pairs], dtype=np.float64) for c in ("_a", "_b"))


def probes_needed(index: Index, asked: np.ndarray, other: np.ndarray, recall: float) -> int:
    """How many probes put the share ``recall`` of the neighbours ``other`` of ``asked`` into probed buckets."""
    ranks = [np.zeros(0, dtype=np.int64)]
    for low in range(0, len(asked), 128):
        order = np.argsort(-index.closeness(asked[low : low + 128]), axis=1, kind="stable")
        place = np.argsort(order, axis=1)
        ranks.append(np.take_along_axis(place, index.codes(other[low : low + 128]), axis=1).min(axis=1))
    every = np.concatenate(ranks)
    return int(np.quantile(every, recall, method="higher")) + 1 if len(every) else 1


def buckets_of(index: Index, probes: int | None = None):
    """Column function over vectors: the buckets of a member, or the ``probes`` closest ones of a query, closest first."""

    @F.arrow_udf("array<int>")
    def run(vectors: pa.Array) -> pa.Array:
        out = []
        for low in range(0, len(vectors), 256):  # the closeness to every bucket is held for so many rows
            v = matrix(vectors.slice(low, 256))
            found = index.codes(v) if probes is None else np.argsort(-index.closeness(v), axis=1, kind="stable")[:, :probes]
            out.extend(found.astype(np.int32))
        return pa.array(out, pa.list_(pa.int32()))

    return run
