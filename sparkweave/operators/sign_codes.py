"""Ranks in the order of sign codes, counted in blocks; no list of rows by queries is ever made.

A row is ahead of another if its signs agree better with the query, or as well and its id is smaller. An agreement is a sum of
whole numbers, so it comes out the same in every task and equal codes tie exactly. Queries come in portions; a task holds one
block of agreements and a few counts a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sparkweave.operators import vector_groups as G
from sparkweave.sources.files import stored

CODES = 2048  # codes of one block
ASKING = 128  # queries of one block
STEERING = 8192  # codes the driver looks at to place the first pivots
#: First pivots in standard errors of the steering codes; later ones are spread evenly.
SPREAD = np.array([-4, -2.2, -1.4, -0.9, -0.5, -0.16, 0.16, 0.5, 0.9, 1.4, 2.2, 4])
FEW = 256  # rows a query, on average, between two pivots that are sorted instead of counted
BEYOND = 2.0**52  # above every agreement
LEAST, GREATEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class SignCodes:
    """One bit a component; the query keeps its components, as whole numbers."""

    def __init__(self, dims: int):
        self.dims = dims

    def encode(self, v: np.ndarray) -> np.ndarray:
        return np.packbits(v > 0, axis=1)

    def signs(self, codes: np.ndarray) -> np.ndarray:
        return np.unpackbits(codes, axis=1, count=self.dims) * 2.0 - 1

    def asked(self, q: np.ndarray) -> np.ndarray:
        """Unit vectors in steps so small that sums of all components are still exact."""
        return np.rint(q.reshape(-1, self.dims) * 2.0 ** (51 - math.ceil(math.log2(max(self.dims, 1)) / 2)))


def coded(nodes: DataFrame, model: SignCodes) -> DataFrame:
    """``id, codes, n``: each code of an id once, with the number of its rows; neighbouring ids lie together."""

    @F.arrow_udf("binary")
    def encode(vectors: pa.Array) -> pa.Array:
        return pa.array([x.tobytes() for x in model.encode(G.matrix(vectors))] if len(vectors) else [], pa.binary())

    rows = nodes.select("id", encode("v").alias("codes")).groupBy("id", "codes").agg(F.count(F.lit(1)).alias("n"))
    tasks = nodes.sparkSession.sparkContext.defaultParallelism
    return stored(rows.repartitionByRange(tasks, "id").sortWithinPartitions("id"), "codes")


def _blocks(batches: Iterator[pa.RecordBatch], model: SignCodes):
    """Ids in order, signs and numbers of rows, block by block."""
    for b in batches:
        if not b.num_rows:
            continue
        ids, n = b.column(0).to_numpy(), b.column(2).to_numpy()
        codes = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
        order = np.argsort(ids, kind="stable")
        for low in range(0, len(ids), CODES):
            some = order[low : low + CODES]
            yield ids[some], model.signs(codes[some]), n[some]


def _agreements(ids: np.ndarray, signs: np.ndarray, names: np.ndarray, asked: np.ndarray, own: bool):
    """The place of the first query, and agreements of queries by rows; without ``own`` that with the row of its name is the least."""
    for low in range(0, len(names), ASKING):
        a = asked[low : low + ASKING] @ signs.T
        if not own:
            first, last = (np.searchsorted(ids, names[low : low + ASKING], side) for side in ("left", "right"))
            for r in np.flatnonzero(last > first):
                a[r, first[r] : last[r]] = -np.inf
        yield low, a


def count_ahead(codes: DataFrame, model: SignCodes, names: np.ndarray, asked: np.ndarray, s: np.ndarray, key: np.ndarray, own: bool) -> DataFrame:
    """``pair, ahead``: how many rows are ahead of each place ``(s, key)``, pairs numbered through ``s`` (queries by places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(s.shape, dtype=np.int64)
        for ids, signs, n in _blocks(batches, model):
            single = (n == 1).all()
            for low, a in _agreements(ids, signs, names, asked, own):
                some, keys = s[low : low + len(a)], key[low : low + len(a)]
                before = ids[-1] < keys  # the whole block: its ties are ahead too
                least = np.where(before, some - 0.5, some)
                for j in range(s.shape[1]):
                    ahead = a > least[:, j : j + 1]
                    total[low : low + len(a), j] += [np.count_nonzero(x) for x in ahead] if single else ahead @ n
                for r, j in np.argwhere((ids[0] < keys) & ~before):
                    total[low + r, j] += n[(a[r] == some[r, j]) & (ids < keys[r, j])].sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["pair", "ahead"])

    return codes.mapInArrow(run, "pair bigint, ahead bigint").groupBy("pair").agg(F.sum("ahead").alias("ahead"))


def higher_quantile(ranks: DataFrame, share: float) -> int | None:
    """Of ``ranks(ahead, weight)`` the one that many of them do not exceed; about the root of the largest comes to the driver."""
    most, n = ranks.agg(F.max("ahead"), F.sum("weight")).first()
    if not n:
        return None
    index, width = math.ceil(Decimal(str(share)) * (int(n) - 1)), math.isqrt(most) + 1
    found = 0
    for step in (width, 1):
        part = ranks if step == width else ranks.filter(F.floor(F.col("ahead") / width) == found)
        for found, weight in part.groupBy(F.floor(F.col("ahead") / step).alias("bin")).agg(F.sum("weight")).orderBy("bin").collect():
            if index < weight:
                break
            index -= weight
    return int(found)


def _between(codes: DataFrame, model: SignCodes, names: np.ndarray, asked: np.ndarray, high: tuple, low: tuple, want: np.ndarray, own: bool) -> DataFrame:
    """``query, s, id``: the ``want``-th row at or behind the place ``high`` and ahead of ``low``, per query."""
    (hs, hk), (ls, lk) = high, low

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple[np.ndarray, ...]] = []

        def out() -> pa.RecordBatch:
            at, s, ids, n = (np.concatenate(x) for x in zip(*got))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (at, want[at], s.astype(np.int64), ids, n)], names=["query", "want", "s", "id", "n"])

        for ids, signs, n in _blocks(batches, model):
            for first, a in _agreements(ids, signs, names, asked, own):
                part = slice(first, first + len(a))
                r, c = np.nonzero((a <= hs[part, None]) & (a >= ls[part, None]))
                at, s, i = first + r, a[r, c], ids[c]
                ok = ((s < hs[at]) | (i >= hk[at])) & ((s > ls[at]) | (i < lk[at]))
                got.append((at[ok], s[ok], i[ok], n[c][ok]))
                if sum(len(x[0]) for x in got) > G.HELD:
                    yield out()
                    got = []
        if got:
            yield out()

    rows = codes.mapInArrow(run, "query bigint, want bigint, s bigint, id bigint, n bigint")
    order = Window.partitionBy("query").orderBy(F.col("s").desc(), "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = rows.withColumn("_r", F.sum("n").over(order)).filter((F.col("_r") >= F.col("want")) & (F.col("_r") - F.col("n") < F.col("want")))
    return reached.select("query", "s", "id")


def _first_pivots(model: SignCodes, asked: np.ndarray, steering: np.ndarray, share: float) -> np.ndarray:
    """Agreements around the wanted share of the steering codes, in falling order; the last lies behind all rows."""
    out = np.full((len(asked), len(SPREAD) + 1), -BEYOND)
    n = len(steering)
    if n:
        ranks = np.clip(np.rint(share * n + SPREAD * (math.sqrt(n * share * (1 - share)) + 1)), 0, n - 1).astype(int)
        signs = model.signs(steering)
        for low in range(0, len(asked), ASKING):
            out[low : low + ASKING, :-1] = -np.sort(-(asked[low : low + ASKING] @ signs.T), axis=1)[:, ranks]
    return out


class Places:
    """Finds the row at a given depth in the order of each query, by counting rows ahead of pivots that close in on it."""

    def __init__(self, codes: DataFrame, model: SignCodes, depth: int, own: bool):
        self.codes, self.model, self.depth, self.own = codes, model, depth, own
        self.rows, self.first, self.last = codes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.min("id"), F.max("id")).first()
        steering = [r["codes"] for r in codes.orderBy(F.xxhash64(F.lit(7), "id"), "id").limit(STEERING).select("codes").collect()]
        self.steering = np.frombuffer(b"".join(steering), dtype=np.uint8).reshape(len(steering), -1 if steering else 1)

    def _ahead(self, names: np.ndarray, asked: np.ndarray, s: np.ndarray, key: np.ndarray) -> np.ndarray:
        got, out = count_ahead(self.codes, self.model, names, asked, s, key, self.own).toArrow(), np.zeros(s.size, dtype=np.int64)
        out[got.column(0).to_numpy()] = got.column(1).to_numpy()
        return out.reshape(s.shape)

    def of(self, names: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Agreement and id of the row at the depth; of queries that have fewer rows a place behind all."""
        n, steps = len(names), np.arange(1, len(SPREAD) + 1)
        hs, hk, hn = np.full(n, BEYOND), np.full(n, LEAST), np.zeros(n, dtype=np.int64)
        ls, lk, ln = np.full(n, -BEYOND), np.full(n, LEAST), np.zeros(n, dtype=np.int64)
        pivots = _first_pivots(self.model, asked, self.steering, min(1.0, self.depth / max(1, self.rows)))
        keys, full = np.full(pivots.shape, LEAST), None
        while n:
            ahead = self._ahead(names, asked, pivots, keys)
            j = (ahead < self.depth).sum(axis=1)
            full = j < pivots.shape[1] if full is None else full  # the last of the first pivots has all rows ahead
            r = np.flatnonzero(full & (j > 0))
            hs[r], hk[r], hn[r] = pivots[r, j[r] - 1], keys[r, j[r] - 1], ahead[r, j[r] - 1]
            r = np.flatnonzero(full & (j < pivots.shape[1]))
            ls[r], lk[r], ln[r] = pivots[r, j[r]], keys[r, j[r]], ahead[r, j[r]]
            tied = full & (hs - ls == 1)  # one agreement is left, so ids decide
            ls[tied], lk[tied] = hs[tied], GREATEST
            tied = np.flatnonzero(full & (hs == ls))
            ranges = [(max(int(hk[i]), self.first), min(int(lk[i]), self.last + 1)) for i in tied]
            wide = full & (hs - ls > 1)
            if (ln - hn)[full].sum() <= FEW * n or not (wide.any() or any(b - a > 1 for a, b in ranges)):
                break
            pivots = np.clip(hs[:, None] - np.floor((hs - ls)[:, None] * steps / (len(steps) + 1)), ls[:, None] + 1, hs[:, None] - 1)
            keys = np.full(pivots.shape, LEAST)
            pivots[tied] = hs[tied, None]
            for i, (a, b) in zip(tied, ranges):
                keys[i] = [a + (b - a) * int(t) // (len(steps) + 1) for t in steps]
        s, key = np.full(n, -BEYOND), np.full(n, GREATEST)
        if n and full.any():
            found = _between(self.codes, self.model, names, asked, (np.where(full, hs, -np.inf), hk), (ls, lk), self.depth - hn, self.own).toArrow()
            at = found.column("query").to_numpy()
            s[at], key[at] = found.column("s").to_numpy(), found.column("id").to_numpy()
        return s, key
