"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by fast pseudo-rotations (signs and Hadamard transforms, three times) and falls to the
nearest signed axis; every table turns it otherwise. A query probes the buckets of its nearest axes, over all
tables in one order, and what it finds there is ranked by its exact inner product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkweave.sources.files import stored

TABLES = 4
OCCUPANCY = 512  # members wanted in a bucket
AXES = 64  # of one polytope at most; a table with more buckets wanted has a second one
BLOCK = 4096  # members of a bucket that are compared in one task
ASKING = 1024  # queries of a bucket that are compared in one task
HELD = 300_000  # rows a task gathers before it keeps only the best of each query
SAMPLE = 192  # queries that are searched exactly, to learn how many probes reach the wanted recall
RECALL = 0.96  # of neighbours of the sampled queries that lie in probed buckets


# -- hashing

def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, scaled to keep lengths."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def rotation(x: np.ndarray, seed: int) -> np.ndarray:
    """A pseudo-rotation: random signs, then a Hadamard transform, three times."""
    rng = np.random.default_rng(seed)
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1]))
    return x


class Polytopes:
    """``tables`` hash functions over vectors of ``dims`` components and lengths up to ``longest``.

    Vectors of unlike lengths get one more component that makes them all as long as the longest, and queries get a
    zero there: then the angle orders them as the inner product does.
    """

    def __init__(self, dims: int, longest: float, shortest: float, buckets: int, tables: int = TABLES):
        self.uneven = longest - shortest > 1e-3 * longest
        self.width = 1 << max(1, (dims + self.uneven - 1).bit_length())
        self.longest, self.tables = longest, tables
        wanted = max(4, buckets)
        first = min(AXES, self.width, 1 << max(1, math.ceil(math.log2(wanted)) - 1))
        rest = wanted / (2 * first)
        second = min(AXES, self.width, 1 << max(0, math.ceil(math.log2(rest)) - 1)) if rest > 1 else 0
        self.axes = [first] + ([second] if second else [])
        self.per_table = math.prod(2 * a for a in self.axes)

    def _turned(self, v: np.ndarray, asks: bool) -> np.ndarray:
        out = np.zeros((len(v), self.width))
        lengths = np.linalg.norm(v, axis=1)
        out[:, : v.shape[1]] = v / (lengths if asks or not self.uneven else np.full(len(v), self.longest))[:, None]
        if self.uneven and not asks:
            out[:, v.shape[1]] = np.sqrt(np.maximum(0.0, 1 - (lengths / self.longest) ** 2))
        return out

    def values(self, v: np.ndarray, asks: bool) -> Iterator[np.ndarray]:
        """Per table the closeness of each row to every bucket: the sum of its components on the bucket's signed axes."""
        x = self._turned(v, asks)
        for t in range(self.tables):
            total = None
            for j, axes in enumerate(self.axes):
                turned = rotation(x, 1000 * t + j)[:, :axes]
                signed = np.stack([turned, -turned], axis=2).reshape(len(v), 2 * axes)
                total = signed if total is None else (total[:, :, None] + signed[:, None, :]).reshape(len(v), -1)
            yield total

    def codes(self, v: np.ndarray) -> np.ndarray:
        """The bucket of every row in each table, numbered over all tables."""
        return np.stack([x.argmax(axis=1) + t * self.per_table for t, x in enumerate(self.values(v, False))], axis=1)

    def probes(self, v: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` closest buckets of all tables for every query, closest first."""
        return np.argsort(-np.concatenate(list(self.values(v, True)), axis=1), axis=1, kind="stable")[:, :n]


def matrix(vectors: pa.Array) -> np.ndarray:
    """The rows of an Arrow list column of equal lengths, in double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else np.empty((0, 1))


def _buckets_of(hashes: Polytopes, probes: int | None):
    """Column function: the buckets of a member, or those that a query probes."""

    @F.arrow_udf("array<int>")
    def run(vectors: pa.Array) -> pa.Array:
        out = []
        for low in range(0, len(vectors), 256):  # the closeness to every bucket is held for so many rows
            v = matrix(vectors.slice(low, 256))
            out.extend((hashes.codes(v) if probes is None else hashes.probes(v, probes)).astype(np.int32))
        return pa.array(out, pa.list_(pa.int32()))

    return run


# -- comparing inside buckets

def _best_of_group(table: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and scores: for each query of one group its ``k`` members of largest inner product, more if they tie."""
    asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
    ident = np.stack([table.column(c).to_numpy() for c in ("id", "h")], axis=1)
    v = matrix(pa.concat_arrays(table.column("v").chunks))
    q, m = np.flatnonzero(asks), np.flatnonzero(~asks)
    rows, cols, scores = [], [], []
    for low in range(0, len(q), 256):
        part = q[low : low + 256]
        product = v[part] @ v[m].T
        if len(m) > k:
            least = np.partition(product, len(m) - k, axis=1)[:, len(m) - k]
            r, c = np.nonzero(product >= (least - 1e-9 * (1 + np.abs(least)))[:, None])
        else:
            r, c = np.divmod(np.arange(product.size), max(1, len(m)))
        rows.append(part[r])
        cols.append(m[c])
        # one fixed order of summation, so a pair has one score wherever it meets
        scores.extend((v[part[r[i : i + 8192]]] * v[m[c[i : i + 8192]]]).sum(axis=1) for i in range(0, len(r), 8192))
    r, c = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (rows, cols))
    s = np.concatenate(scores) if scores else np.empty(0)
    return np.concatenate([ident[r], ident[c]], axis=1), s


def _best_of_task(pairs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best pairs of every query, each pair once; ``pairs`` has the columns qid, qh, id, h."""
    order = np.lexsort((pairs[:, 3], pairs[:, 2], -scores, pairs[:, 1], pairs[:, 0]))
    pairs, scores = pairs[order], scores[order]
    new = np.ones(len(pairs), dtype=bool)
    new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)  # a pair that meets in several tables has one score
    pairs, scores = pairs[new], scores[new]
    first = np.ones(len(pairs), dtype=bool)
    first[1:] = (pairs[1:, :2] != pairs[:-1, :2]).any(axis=1)
    begins = np.flatnonzero(first)
    place = np.arange(len(pairs)) - np.repeat(begins, np.diff(np.append(begins, len(pairs))))
    return pairs[place < k], scores[place < k]


def _compared(members: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """``qid, qh, id, h, score``: the best ``k`` nodes of every query among the members of its buckets.

    ``members`` and ``asking`` have ``bucket, id, h, v``. Buckets are cut into blocks of about ``BLOCK`` members and
    ``ASKING`` queries, so a bucket that holds a third of all rows is many groups; each group is one matrix product.
    A group passes on ``k`` members a query, and so does a task over all its groups, as far as it holds them.
    """
    count = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("_m")).join(asking.groupBy("bucket").agg(F.count(F.lit(1)).alias("_q")), "bucket")
    # one row a bucket: there are at most TABLES * (2 * AXES) ** 2 of them, or the blocks of the exact search
    grid = count.select("bucket", F.ceil(F.col("_m") / BLOCK).cast("int").alias("_rows"), F.ceil(F.col("_q") / ASKING).cast("int").alias("_cols"))
    grid = stored(grid, "grid")
    place = F.xxhash64("id", "h")
    left = members.join(grid, "bucket").select(
        "bucket", F.pmod(place, "_rows").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("_cols") - 1)).alias("j"), F.lit(0).alias("asks"), "id", "h", "v"
    )
    right = asking.join(grid, "bucket").select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("_rows") - 1)).alias("i"), F.pmod(place, "_cols").cast("int").alias("j"), F.lit(1).alias("asks"), "id", "h", "v"
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
        pairs, scores = np.empty((0, 4), dtype=np.int64), np.empty(0)
        got: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            columns = [*(pairs[:, c] for c in range(4)), scores]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["qid", "qh", "id", "h", "score"])

        for group in groups(batches):
            got.append(_best_of_group(group, k))
            if sum(len(s) for _, s in got) > HELD:
                pairs, scores = _best_of_task(np.concatenate([pairs, *(p for p, _ in got)]), np.concatenate([scores, *(s for _, s in got)]), k)
                got = []
                if len(scores) > HELD:  # too many queries in this task to go on holding them
                    yield out()
                    pairs, scores = pairs[:0], scores[:0]
        pairs, scores = _best_of_task(np.concatenate([pairs, *(p for p, _ in got)]), np.concatenate([scores, *(s for _, s in got)]), k)
        yield out()

    found = dealt.mapInArrow(run, "qid bigint, qh bigint, id bigint, h bigint, score double")
    # a pair that meets in several tables has one score and one rank
    order = Window.partitionBy("qid", "qh").orderBy(F.col("score").desc(), "id", "h")
    return found.withColumn("_r", F.dense_rank().over(order)).filter(F.col("_r") <= k).drop("_r").dropDuplicates(["qid", "qh", "id", "h"])


def _everywhere(nodes: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """The exact search: ``asking`` against all nodes, block by block."""
    size = nodes.count()
    blocks = max(1, math.ceil(size / BLOCK))
    members = nodes.select(F.pmod(F.xxhash64("id", "h"), F.lit(blocks)).cast("int").alias("bucket"), "id", "h", "v")
    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("bucket")
    return _compared(members, asking.select(all_blocks, "id", "h", "v"), k)


def _probes_needed(hashes: Polytopes, nodes: DataFrame, asking: DataFrame, k: int) -> int:
    """How many probes find ``RECALL`` of the neighbours of ``SAMPLE`` queries, which are searched exactly.

    At most ``SAMPLE * (k + 1)`` pairs of vectors come to the driver.
    """
    sample = stored(asking.orderBy(F.xxhash64(F.lit(7), "id", "h"), "id", "h").limit(SAMPLE), "sample")
    best = _everywhere(nodes, sample, k).filter("NOT (qid = id AND qh = h)")
    pairs = best.join(nodes.select("id", "h", F.col("v").alias("_b")), ["id", "h"]).join(
        sample.select(F.col("id").alias("qid"), F.col("h").alias("qh"), F.col("v").alias("_a")), ["qid", "qh"]
    ).select("_a", "_b").collect()
    if not pairs:
        return 1
    ranks = []
    for low in range(0, len(pairs), 128):
        asked, other = (np.array([r[c] for r in pairs[low : low + 128]], dtype=np.float64) for c in ("_a", "_b"))
        place = np.argsort(hashes.probes(asked, hashes.tables * hashes.per_table), axis=1)
        ranks.append(np.take_along_axis(place, hashes.codes(other), axis=1).min(axis=1))
    return int(np.quantile(np.concatenate(ranks), RECALL, method="higher")) + 1


def usable(vector: Column) -> Column:
    """True for a vector that is not null or zero and has no null or non-finite component."""
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", asks: Column | None = None, k: int = 20, occupancy: int = OCCUPANCY
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``asks`` its ``k`` nearest other rows by inner product.

    All rows are indexed. Equal vectors are one node with its ``k + 1`` smallest keys, which is all that can be
    answered, so copies cost nothing. The number of probes is learnt from a sample of ``SAMPLE`` queries whose exact
    neighbours are known; recall on the others is about ``RECALL``. A query that finds fewer than ``k`` rows while
    there are more is searched exactly. Buckets, candidates and partners are not capped.

    Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do null keys
    and vectors of another length than the commonest (ties: the longer). Repeated rows count once; a key with several
    vectors asks and answers with each, and a pair of keys counts with its best score. Ties go to the smaller key. An empty
    table gives no rows. Only the named columns are read.
    """
    asks = F.col(key) % 20 == 0 if asks is None else asks
    clean = vectors.filter(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v"), asks.alias("asks"))
    clean = stored(clean, "vectors")
    lengths = clean.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect()
    clean = clean.filter(F.size("v") == (lengths[0][0] if lengths else 0))

    few = Window.partitionBy("v").orderBy("id")
    least = clean.select("v", "id").withColumn("_r", F.dense_rank().over(few)).filter(F.col("_r") <= k + 1)
    nodes = least.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    nodes = stored(nodes.select(F.col("ids")[0].alias("id"), F.xxhash64("v").alias("h"), "v", "ids"), "nodes")
    asked = stored(clean.filter("asks").select("v", F.col("id").alias("query_id")).distinct().join(nodes.select("v", "id", "h"), "v"), "asked")
    asking = stored(asked.select("id", "h", "v").distinct(), "asking")

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    size, longest, shortest = nodes.agg(F.count(F.lit(1)), F.max(norm), F.min(norm)).first()
    hashes = Polytopes(lengths[0][0] if lengths else 1, longest or 1.0, shortest or 1.0, math.ceil(size / occupancy))
    probes = _probes_needed(hashes, nodes, asking, k + 1)
    members = nodes.select(F.explode(_buckets_of(hashes, None)("v")).alias("bucket"), "id", "h", "v")
    probing = asking.select(F.explode(_buckets_of(hashes, probes)("v")).alias("bucket"), "id", "h", "v")
    found = stored(_compared(members, probing, k + 1), "found")

    def answers(best: DataFrame) -> DataFrame:
        rows = best.join(nodes.select("id", "h", "ids"), ["id", "h"]).select("qid", "qh", "score", F.explode("ids").alias("vec_id"))
        order = Window.partitionBy("qid", "qh").orderBy(F.col("score").desc(), "vec_id")
        rows = rows.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= 2 * k + 2).drop("_r")
        own = asked.select("query_id", F.col("id").alias("qid"), F.col("h").alias("qh"))
        each = own.join(rows, ["qid", "qh"]).filter("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return each.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    got = stored(answers(found), "answers")
    total = clean.select("id").distinct().count()
    short = asked.select("query_id").distinct().join(got.groupBy("query_id").count(), "query_id", "left")
    short = short.filter(F.coalesce("count", F.lit(0)) < min(k, total - 1)).select("query_id")
    poor = stored(asked.join(short, "query_id", "left_semi").select("id", "h", "v").distinct(), "poor")
    if poor.isEmpty():
        return got
    again = answers(stored(_everywhere(nodes, poor, k + 1), "exact")).join(short, "query_id", "left_semi")
    return got.join(short, "query_id", "left_anti").unionByName(again)
