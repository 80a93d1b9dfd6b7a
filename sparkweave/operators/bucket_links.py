"""Links between members of hash buckets, closed: what comes out grows with the members, not with their pairs.

Every member of a bucket first meets the bucket's leader. Members that are then still in different components are
compared inside tasks, and a task returns only the edges of a few spanning forests of what it finds near. Edges are
verified; where one fails and parts components, the bucket is gone through again with more edge-disjoint forests, until
none does or all near pairs were verified. So no link between two components is lost, and pairs inside a component are never made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkweave.operators.graphs import connected_components
from sparkweave.sources.files import stored

BLOCK = 8192  # members of a bucket that meet in one task
PAIRS = 400_000  # pairs a task holds at a time
LISTED = 8  # buckets that a member carries with it, so that a pair is an edge of one of its common buckets only
FORESTS = 8  # edge-disjoint forests of a bucket's near pairs that are verified
MORE = 64  # times as many where edges fail
PLACES = 2  # places of a parity sketch per element of its set
LEAST_BITS = 512


# -- forests

def spanning_forest(label: np.ndarray, u: np.ndarray, v: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Places of the edges ``u, v`` of a least spanning forest between the groups that ``label`` names.

    ``rank`` orders the edges and has no ties. Each turn every group takes its least edge to another one, so groups
    halve at least.
    """
    label, alive, picked = label.copy(), np.arange(len(u)), [np.empty(0, dtype=np.int64)]
    by_rank = np.empty(len(u), dtype=np.int64)
    by_rank[rank] = np.arange(len(u))
    while True:
        alive = alive[label[u[alive]] != label[v[alive]]]
        if not len(alive):
            return np.concatenate(picked)
        best = np.full(int(label.max()) + 1, len(u), dtype=np.int64)
        np.minimum.at(best, label[u[alive]], rank[alive])
        np.minimum.at(best, label[v[alive]], rank[alive])
        edges = by_rank[np.unique(best[best < len(u)])]
        picked.append(edges)
        a, b, to = label[u[edges]], label[v[edges]], np.arange(len(best))
        while True:  # the least label spreads over the edges taken
            before, low = to, np.minimum(to[a], to[b])
            to = to.copy()
            np.minimum.at(to, a, low)
            np.minimum.at(to, b, low)
            to = to[to]
            if (to == before).all():
                break
        label = to[label]


def forests(label: np.ndarray, u: np.ndarray, v: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Places of the edges of ``n`` edge-disjoint forests, each one a least one of what the ones before leave."""
    left, out = np.lexsort((v, u, weight)), []
    for _ in range(n):
        picks = spanning_forest(label, u[left], v[left], np.arange(len(left)))
        if not len(picks):
            break
        out.append(left[picks])
        left = np.delete(left, picks)
    return np.concatenate(out) if out else np.empty(0, dtype=np.int64)


def _group_edges(table: pa.Table, prepare: Callable, n: int) -> pa.RecordBatch | None:
    """The forests of one group; ``all`` tells that no near pair between components was left out."""
    ids, label = np.unique(table.column("comp").to_numpy(), return_inverse=True)
    if len(ids) < 2:
        return None
    node = table.column("id").to_numpy()
    left, right = (np.flatnonzero(table.column(c).to_numpy(zero_copy_only=False)) for c in ("left", "right"))
    bucket, listed = table.column("bucket")[0].as_py(), np.full((len(node), LISTED), np.iinfo(np.int64).max)
    for k, own in enumerate(table.column("listed").to_pylist()):
        listed[k, : len(own)] = own

    def elsewhere(r: np.ndarray, c: np.ndarray) -> np.ndarray:
        """True where both members list a bucket before this one: the pair is an edge there."""
        out = np.zeros(len(r), dtype=bool)
        for k in range(0, len(r), PAIRS // LISTED):
            a, b = listed[r[k : k + PAIRS // LISTED]], listed[c[k : k + PAIRS // LISTED]]
            for j in range(LISTED):
                out[k : k + len(a)] |= (a[:, j] < bucket) & (a[:, j, None] == b).any(axis=1)
        return out

    near = prepare(table)
    u = v = w = np.empty(0, dtype=np.int64)
    everything = True
    step = max(1, PAIRS // max(1, len(right)))
    for low in range(0, len(left), step):
        r, c, weight = near(left[low : low + step], right, label)
        own = ~elsewhere(r, c)
        r, c, weight = r[own], c[own], weight[own]
        a, b = np.minimum(r, c), np.maximum(r, c)
        u, v, w = np.concatenate([u, a]), np.concatenate([v, b]), np.concatenate([w, weight])
        _, once = np.unique(u * len(node) + v, return_index=True)
        u, v, w = u[once], v[once], w[once]
        if len(u) > n:
            picks = forests(label, u, v, w, n)
            everything &= len(picks) == len(u)
            u, v, w = u[picks], v[picks], w[picks]
    if not len(u):
        return None
    a, b = node[u], node[v]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(u), bucket, dtype=np.int64)), pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(np.full(len(u), everything))],
        names=["bucket", "a", "b", "all"],
    )


def _edges(labelled: DataFrame, features: DataFrame, prepare: Callable, n: int) -> DataFrame:
    """``bucket, a, b, all``: forests of near pairs between the components of each bucket of ``labelled(bucket, id, comp)``.

    In a bucket all members meet those outside its largest component. A pair that is in several buckets is an edge of the
    first one that both its members list, so it is not found again in each. Members go to columns and those outside also to
    rows of about ``BLOCK``, so a group is bounded, and a bucket in which few are left apart is read about once.
    """
    sizes = labelled.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("_n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("_n", "comp")).alias("_main"), F.sum("_n").alias("_size"), F.count(F.lit(1)).alias("_comps")).filter("_comps > 1")
    main = main.select(
        "bucket", F.col("_main.comp").alias("_main"), F.ceil(F.col("_size") / BLOCK).cast("int").alias("_cols"),
        F.ceil((F.col("_size") - F.col("_main._n")) / BLOCK).cast("int").alias("_rows"),
    )
    h = F.xxhash64("id")
    rows = labelled.join(main, "bucket").withColumns({
        "_apart": F.col("comp") != F.col("_main"), "_c": F.pmod(h, "_cols").cast("int"), "_r": F.pmod(F.shiftright(h, 20), "_rows").cast("int"),
    })
    over_rows = F.transform(F.sequence(F.lit(0), F.col("_rows") - 1), lambda i: F.struct(i.alias("i"), F.col("_c").alias("j")))
    over_cols = F.transform(F.sequence(F.lit(0), F.col("_cols") - 1), lambda j: F.struct(F.col("_r").alias("i"), j.alias("j")))
    spots = F.when(F.col("_apart"), F.array_distinct(F.concat(over_rows, over_cols))).otherwise(over_rows)
    dealt = rows.withColumn("_s", F.explode(spots)).select(
        "bucket", F.col("_s.i").alias("i"), F.col("_s.j").alias("j"), "id", "comp",
        (F.col("_apart") & (F.col("_s.i") == F.col("_r"))).alias("left"), (F.col("_s.j") == F.col("_c")).alias("right"),
    )
    # the first buckets of every member, by number; numbers are hashes
    listed = rows.select("bucket", "id").groupBy("id").agg(F.slice(F.array_sort(F.collect_set("bucket")), 1, LISTED).alias("listed"))
    dealt = dealt.join(features.join(listed, "id"), "id").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # the group that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.concat_tables([*held, pa.Table.from_batches([batch])])
            key = np.stack([table.column(c).to_numpy() for c in ("bucket", "i", "j")])
            starts = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1])
            for low, high in zip(starts[:-1], starts[1:]):
                if (found := _group_edges(table.slice(low, high - low), prepare, n)) is not None:
                    yield found
            held = [table.slice(starts[-1])]
        if held and (found := _group_edges(held[0], prepare, n)) is not None:
            yield found

    return dealt.mapInArrow(run, "bucket bigint, a bigint, b bigint, all boolean")


def bucket_links(
    members: DataFrame, features: DataFrame, prepare: Callable, close: Callable[[DataFrame], Column], verify: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """``a, b`` (``a < b``): verified links whose closure is that of all linked pairs that share a bucket."""
    return bucket_closure(members, features, prepare, close, verify)[0]


def bucket_closure(
    members: DataFrame, features: DataFrame, prepare: Callable, close: Callable[[DataFrame], Column], verify: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The links ``a, b`` of ``bucket_links``, and ``id, component`` for every id that has one (its least id).

    ``members(bucket, id)`` (bigint), ``features(id, ...)`` one row per id. ``prepare(table)`` takes the features of a group as an Arrow
    table and returns ``near(left, right, label) -> (rows, columns, weights)``, the near pairs with unlike labels; ``close(pairs)`` is
    the same test as a column over ``a, b`` and the features with the suffixes ``_a`` and ``_b``. Neither may rule out a link.
    ``verify(pairs)`` keeps the pairs ``a, b`` that link; without it near is linked. No members give no rows.
    """
    lead = members.groupBy("bucket").agg(F.min("id").alias("a"), F.max("id").alias("_last")).filter("a <> _last").select("bucket", "a")
    met = members.join(lead, "bucket").filter("id <> a").select("a", F.col("id").alias("b")).distinct()
    names = [c for c in features.columns if c != "id"]
    sides = [features.select(F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in names]) for x in "ab"]
    pairs = met.join(sides[0], "a").join(sides[1], "b")
    tried = stored(pairs.filter(close(pairs)).select("a", "b"), "leader-pairs")
    links = stored(verify(tried), "links") if verify else tried
    again, n, named = members, FORESTS, _components(links)
    while True:
        labelled = again.join(named, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("comp"))
        edges = stored(_edges(labelled, features, prepare, n), "edges")
        new = edges.select("a", "b").distinct()
        if verify is None:
            links = links.unionByName(new)
            return links, _components(links)
        new = stored(new.join(tried, ["a", "b"], "left_anti"), "new-pairs")
        found = new if new.isEmpty() else stored(verify(new), "links")
        if not found.isEmpty():
            links = links.unionByName(found)
            named = _components(links)
        # an edge that fails does no harm if other links join its ends: what was left out because of it is joined, too
        failed = edges.filter(~F.col("all")).join(links, ["a", "b"], "left_anti")
        for x in "ab":
            failed = failed.join(named.select(F.col("id").alias(x), F.col("component").alias(f"_{x}")), x, "left")
        apart = F.coalesce("_a", "a") != F.coalesce("_b", "b")
        failed = stored(failed.filter(apart).select("bucket").distinct(), "failed")
        if failed.isEmpty():
            return links, named
        # written once: it is read for sizes, places and lists
        tried, again, n = tried.unionByName(new), stored(members.join(failed, "bucket", "left_semi"), "again"), MORE * n


def _components(links: DataFrame) -> DataFrame:
    return connected_components(links).select(F.col("node").alias("id"), "component")


# -- parity sketches of sets

def sketch(s: np.ndarray) -> bytes:
    """Parities of a set of 64-bit hashes: two sets differ in at least as many elements as their sketches in bits.

    The sketch grows with the set, so that it tells large sets apart as well as small ones.
    """
    bits = max(LEAST_BITS, 1 << (PLACES * len(s) - 1).bit_length()) if len(s) else LEAST_BITS
    places = (s.view(np.uint64) >> np.uint64(20)).astype(np.int64) & (bits - 1)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) brought to fewer words: halves are added up."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def most_apart(x, y, percent: int):
    """Largest symmetric difference of sets of sizes ``x`` and ``y`` whose Jaccard similarity is ``percent`` or more."""
    return (x + y) * (100 - percent) // (100 + percent)


def sketches_near(percent: int) -> Callable:
    """``prepare`` for features ``n, sketch``: pairs that may have the similarity; weights are the bits that differ."""

    def prepare(table: pa.Table):
        n, raw = table.column("n").to_numpy(), table.column("sketch").to_pylist()
        width = np.array([len(x) // 8 for x in raw])
        place, words = np.zeros(len(raw), dtype=np.int64), {}
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            place[at] = np.arange(len(at))
            words[w] = np.frombuffer(b"".join(raw[i] for i in at), dtype=np.uint64).reshape(len(at), w)
        down: dict[tuple, np.ndarray] = {}

        def rows_of(w, to):
            if (w, to) not in down:
                down[w, to] = folded(words[w], to)
            return down[w, to]

        def near(left, right, label):
            out = []
            for w in np.unique(width[left]):
                for z in np.unique(width[right]):
                    x, y = left[width[left] == w], right[width[right] == z]
                    less, more = np.minimum(n[x][:, None], n[y][None, :]), np.maximum(n[x][:, None], n[y][None, :])
                    r, c = np.nonzero((less * 100 >= more * percent) & (label[x][:, None] != label[y][None, :]))
                    a, b, to = rows_of(w, min(w, z)), rows_of(z, min(w, z)), int(min(w, z))
                    part = max(1, 500_000 // to)
                    for k in range(0, len(r), part):
                        i, j = x[r[k : k + part]], y[c[k : k + part]]
                        apart = np.bitwise_count(a[place[i]] ^ b[place[j]]).sum(axis=1, dtype=np.int64)
                        ok = apart <= most_apart(n[i], n[j], percent)
                        out.append(np.stack([i[ok], j[ok], apart[ok]]))
            return tuple(np.concatenate(out, axis=1)) if out else (np.empty(0, dtype=np.int64),) * 3

        return near

    return prepare


def sketches_close(percent: int) -> Callable[[DataFrame], Column]:
    """The same test as a column over ``n_a, sketch_a, n_b, sketch_b``."""

    @F.arrow_udf("boolean")
    def close(na: pa.Array, sa: pa.Array, nb: pa.Array, sb: pa.Array) -> pa.Array:
        may = most_apart(na.to_numpy(), nb.to_numpy(), percent)
        out = []
        for x, y, most in zip(sa, sb, may):
            a, b = (np.frombuffer(z.as_py(), dtype=np.uint64)[None, :] for z in (x, y))
            width = min(a.shape[1], b.shape[1])
            out.append(bool(np.bitwise_count(folded(a, width) ^ folded(b, width)).sum(dtype=np.int64) <= most))
        return pa.array(out, pa.bool_())

    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return lambda pairs: sizes & close("n_a", "sketch_a", "n_b", "sketch_b")
