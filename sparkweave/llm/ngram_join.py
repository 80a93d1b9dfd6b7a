"""Exact Jaccard join of word shingles by partitioning the universe of shingles.

Two sets that link differ in few shingles. Shingles are hashed into segments, so some segment of the two
differs in none (or in one, if it is indexed with its one-deletion neighbourhood); only sets that share such
a segment meet, and every meeting is verified on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkweave.llm.arrow_text import PLACE, U, each_words, mix
from sparkweave.llm.common import broadcast_within, row_identity
from sparkweave.operators.bucket_links import bucket_closure, most_apart, sketch, sketches_close, sketches_near
from sparkweave.sources.files import stored
from sparkweave.streaming.runs import settings

BATCH = "4m"  # bytes of text that a task gets at once
SEEDS = 8  # partitions tried for a set whose segments are too thin
SAMPLE = 64  # one set in so many is counted to find common shingles; steers cost, never results
COMMON = 500  # a shingle in one of so many sets, or more, does not tell sets apart
HOT = 2000  # a signature of one sampled set in so many, or more, is dealt to SALTS tasks
SALTS = 64
SEEN = 100_000  # sets a task remembers, so that copies write their signatures once
VERIFY_COST = 20  # cost of a meeting, in signatures

def _shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingles; a text of fewer words is one shingle, no words are none."""
    k = min(n, len(words))
    if not k:
        return words
    total = np.zeros(len(words) - k + 1, dtype=np.uint64)
    for i in range(k):
        total += words[i : len(words) - k + 1 + i] * PLACE[i]
    return np.unique(mix(total + U(k) * PLACE[41]))


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The set of each text of an Arrow column, in order; null counts as empty."""
    return (_shingle_set(words, n) for words in each_words(texts))


def digest(s: np.ndarray) -> int:
    """Signed 64-bit identity of a set."""
    return int(mix(np.array([mix(s ^ PLACE[42]).sum(dtype=np.uint64) + U(len(s))], dtype=np.uint64)).view(np.int64)[0])


# -- size bands and the allocation of segments

def bands(largest: int, percent: int) -> list[tuple[int, int]]:
    """Size bands: what links to a set of a band is in that band or a neighbour of it.

    A band spans two steps of the size ratio, so only the larger half of its sets is indexed for the next band too.
    """
    out, low = [], 1
    while low <= largest:
        high = max(low, low * 100 // percent)
        high = max(high, high * 100 // percent)
        out.append((low, high))
        low = high + 1
    return out


def allocate(low: int, high: int, sets: int, percent: int) -> tuple[int, int]:
    """``exact, deletion``: how many segments of a band are indexed as they are and how many with one-deletion neighbourhoods.

    Their tolerances must add up to more than sets of the band may differ, also after segments too thin to tell
    sets apart are left out. Among the allocations that hold for all but a twentieth of the sets the cheapest is
    taken: signatures, plus expected meetings of sets that share rare shingles by chance.
    """
    apart = most_apart(high, high, percent)
    if apart == 0:
        return 0, 0  # only equal sets link, and those are one node
    best = None
    least = -(-low * percent // 100)
    for deletion in range(0, (apart + 1) // 2 + 2):
        exact = max(0, apart + 1 - 2 * deletion)
        for _ in range(40):
            m = exact + deletion
            bad = 0.0
            for x in {least, low, high}:
                t = x / m
                thin1, thin2 = (1 + t) * math.exp(-t), (1 + t + t * t / 2) * math.exp(-t)
                lost = exact * thin1 + 2 * deletion * thin2
                spread = math.sqrt(exact * thin1 * (1 - thin1) + 4 * deletion * thin2 * (1 - thin2)) + 1e-9
                need = most_apart(x, min(high, x * 100 // percent), percent) + 1
                bad = max(bad, 0.5 * math.erfc((exact + 2 * deletion - lost - need + 0.5) / spread / math.sqrt(2)))
            if bad <= 0.05:
                t = high / m
                chance = exact * COMMON ** -max(t, 2.0) + deletion * (t + 1) * COMMON ** -max(t - 1, 2.0)
                cost = (exact + deletion * (t + 1)) / (1 - bad) + VERIFY_COST * sets * chance
                if best is None or cost < best[0]:
                    best = (cost, exact, deletion)
                break
            exact += max(1, exact // 25)
        if deletion > 8 and best is not None and best[2] < deletion - 4:
            break
    return best[1:] if best else (0, apart + 1)


def signatures(s: np.ndarray, common: np.ndarray, table: list[tuple[int, int, int, int]], percent: int) -> np.ndarray:
    """Signatures of a set: its telling segments under its own band and the next one.

    A segment tells if two or more of its shingles are rare (three with a deletion). If what is left tolerates
    less than linked sets may differ, the set is indexed under further partitions as well; a set that fails them
    all indexes every segment of the last one. Of two linked sets it is enough that one passes.
    """
    n, out = len(s), []
    lows = [b[0] for b in table]
    own = int(np.searchsorted(lows, n, side="right")) - 1
    at = np.searchsorted(common, s)
    rare = (common[np.minimum(at, len(common) - 1)] != s) if len(common) else np.ones(n, dtype=bool)
    value = mix(s ^ PLACE[43])
    for band in (own, own + 1):
        if band >= len(table):
            break
        low, high, exact, deletion = table[band]
        m = exact + deletion
        if not m or n * 100 < low * percent:
            continue
        need = most_apart(n, min(high, n * 100 // percent), percent) + 1
        for seed in range(SEEDS):
            segment = ((s * PLACE[50 + seed]) >> U(33)).astype(np.int64) % m
            telling = np.bincount(segment, weights=rare, minlength=m)
            is_deletion = np.arange(m) < deletion
            enough = np.where(is_deletion, telling >= 3, telling >= 2)
            good = int((enough * np.where(is_deletion, 2, 1)).sum()) >= need
            listed = telling >= 2 if good or seed < SEEDS - 1 else np.ones(m, dtype=bool)
            order = np.argsort(segment, kind="stable")
            run = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(value[order], dtype=np.uint64)])
            ends = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(np.bincount(segment, minlength=m))])
            tag = np.arange(m, dtype=np.uint64) * PLACE[44] + np.full(m, band * SEEDS + seed + 1, dtype=np.uint64) * PLACE[45]
            total = run[ends[1:]] - run[ends[:-1]] + tag
            out.append(total[listed])
            if deletion:
                mine = is_deletion[segment] & listed[segment]
                out.append(total[segment[mine]] - value[mine])
            if good:
                break
    return np.unique(mix(np.concatenate(out))) if out else np.empty(0, dtype=np.uint64)


# -- the join

def _set_rows(docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """``doc, n, node, sketch, tokens`` per row: size, identity and sketch of its set; the shingles of one set in ``SAMPLE``."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(len(s), digest(s), sketch(s), s.view(np.int64) if digest(s) % SAMPLE == 0 else None) for s in shingle_sets(b.column(1), n)]
            size, node, bits, tokens = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(bits, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))],
                names=["doc", "n", "node", "sketch", "tokens"],
            )

    picked = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("t"))
    return picked.mapInArrow(run, f"doc {kind}, n bigint, node bigint, sketch binary, tokens array<bigint>")


def _signature_rows(docs: DataFrame, text: str, n: int, common: np.ndarray, table, percent: int, hot: np.ndarray) -> DataFrame:
    """``sig, salt, node`` of every set; a task writes a set once, as far as it remembers. Hot signatures have salts from 1."""
    schema = "sig bigint, salt int, node bigint"
    mark = np.sort(hot)

    def batch_of(got: list, nodes: list) -> pa.RecordBatch:
        sig, node = np.concatenate(got).view(np.int64), np.concatenate(nodes)
        is_hot = mark[np.minimum(np.searchsorted(mark, sig), len(mark) - 1)] == sig if len(mark) else np.zeros(len(sig), dtype=bool)
        salt = np.where(is_hot, 1 + (mix(node.view(U)) % U(SALTS)).astype(np.int32), 0).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(salt), pa.array(node)], names=["sig", "salt", "node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            got, nodes, size = [], [], 0
            for s in shingle_sets(b.column(0), n):
                node = digest(s)
                if not len(s) or node in seen:
                    continue
                seen.add(node)
                if len(seen) > SEEN:
                    seen.clear()
                sig = signatures(s, common, table, percent)
                if len(sig):
                    got.append(sig)
                    nodes.append(np.full(len(sig), node, dtype=np.int64))
                    size += len(sig)
                if size > 200_000:
                    yield batch_of(got, nodes)
                    got, nodes, size = [], [], 0
            if got:
                yield batch_of(got, nodes)

    return docs.select(F.col(text).alias("t")).mapInArrow(run, schema)


def _set_lists(docs: DataFrame, text: str, n: int) -> DataFrame:
    """``node, s``: the sets themselves, for the few that are verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(shingle_sets(b.column(0), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "s"]
            )

    return docs.select(F.col(text).alias("t")).mapInArrow(run, "node bigint, s array<bigint>")


def _frequent(lists: DataFrame, column: str, least: int) -> np.ndarray:
    """The values that are in ``least`` lists or more, sorted."""
    seen = lists.select(F.explode(column).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= least)
    return np.sort(np.array([r[0] for r in seen.select("t").toLocalIterator()], dtype=np.int64).view(np.uint64))


def _hot(sample: DataFrame, size: int, common: np.ndarray, table, percent: int) -> np.ndarray:
    """Signatures of one sampled set in ``HOT`` or more; at most ``HOT`` times the mean number of signatures. They are only dealt otherwise."""

    @F.arrow_udf("array<bigint>")
    def signed(tokens: pa.Array) -> pa.Array:
        return pa.array([signatures(np.array(t.as_py(), dtype=np.int64).view(U), common, table, percent).view(np.int64) for t in tokens], pa.list_(pa.int64()))

    return _frequent(sample.select(signed("tokens").alias("s")), "s", max(SAMPLE, size // HOT)).view(np.int64)


def _linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, doc_id: str, text: str, n: int, percent: int) -> DataFrame:
    """The stored pairs ``a, b`` that link, by their whole sets; only texts of sets that are asked for are read again."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    first = stored(nodes.join(wanted, "node", "left_semi").select(F.col("doc").alias("_doc")), "wanted")
    some = docs.join(broadcast_within(first), F.col(doc_id).eqNullSafe(F.col("_doc")), "left_semi")
    sets = stored(_set_lists(some, text, n).join(wanted, "node", "left_semi").dropDuplicates(["node"]), "sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("s").alias("_b")), "b"
    )
    shared = F.size(F.array_intersect("_a", "_b"))
    union = F.size("_a") + F.size("_b") - shared
    return both.filter(shared * 100 >= union * percent).select("a", "b")


def join_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per document.

    Documents link when the Jaccard similarity of their ``n``-word shingle sets is ``percent`` or more; a component
    is what links reach, named by its smallest id. Equal sets are one node, so copies are never compared.
    Members of a bucket first meet a leader; those still in different components are compared in blocks inside tasks,
    which return spanning forests, so what comes out grows with the members and no link between components is lost.

    Bounds: texts reach a task in batches of ``BATCH`` and are worked on in chunks; a set holds eight bytes a shingle. Sets
    and shingles are compared by 64-bit hashes. Defined cases: null or empty text has no shingles and links with nothing; a
    text of fewer than ``n`` words is one shingle; repeated rows share a component; a null id is never a component's name unless all
    its ids are null; an empty table gives no rows. Only the named columns are read.
    """
    # every step that reads texts ends inside; the frame returned joins stored ones
    with settings(docs.sparkSession, **{"spark.sql.execution.arrow.maxBytesPerBatch": BATCH}):
        return _joined(docs, doc_id, text, n, percent)


def _joined(docs: DataFrame, doc_id: str, text: str, n: int, percent: int) -> DataFrame:
    rows = stored(_set_rows(docs, doc_id, text, n), "set-rows")
    full = rows.filter("n > 0")
    nodes = stored(full.groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("doc").alias("doc")), "nodes")
    sample = stored(full.filter("tokens IS NOT NULL").select("node", "tokens").dropDuplicates(["node"]), "sample")
    size = sample.count()
    common = _frequent(sample, "tokens", max(8, size // COMMON))
    largest = nodes.agg(F.max("n")).first()[0] or 0
    limits = bands(largest, percent)
    counts = nodes.select(F.explode(F.array(*[
        F.when(F.col("n").between(low, high), i) for i, (low, high) in enumerate(limits)
    ])).alias("band")).filter("band IS NOT NULL").groupBy("band").count().collect() if limits else []
    per_band = dict((r[0], r[1]) for r in counts)  # at most a hundred or so bands
    table = [(low, high, *allocate(low, high, per_band.get(i, 0) + per_band.get(i - 1, 0), percent)) for i, (low, high) in enumerate(limits)]

    # dealt out once and read twice: for the signatures that several sets have, and for their members
    hot = _hot(sample, size, common, table, percent)
    sigs = _signature_rows(docs, text, n, common, table, percent, hot).repartition("sig", "salt")
    shared = sigs.groupBy("sig", "salt").agg(F.min("node").alias("_lo"), F.max("node").alias("_hi")).filter("salt > 0 OR _lo <> _hi").select("sig", "salt")
    members = stored(sigs.join(shared, ["sig", "salt"]).select(F.col("sig").alias("bucket"), F.col("node").alias("id")).distinct(), "members")

    def verify(pairs: DataFrame) -> DataFrame:
        return _linked(pairs, nodes, docs, doc_id, text, n, percent)

    features = nodes.select(F.col("node").alias("id"), "n", "sketch")
    comps = bucket_closure(members, features, sketches_near(percent), sketches_close(percent), verify)[1].withColumnRenamed("id", "node")
    named = nodes.select("node", "doc").join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node"))
    first = named.groupBy("comp").agg(F.min("doc").alias("component_id"))
    by_node = named.select("node", "comp").join(first, "comp").select("node", "component_id")
    linked = full.select("doc", "n", "node").join(by_node, "node").select("doc", "n", "component_id")
    out = linked.unionByName(rows.filter("n = 0").select("doc", "n", F.col("doc").alias("component_id")))
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One document of each component with all its columns: the one of the smallest id, of texts under it the one of least hash.

    Rows are told apart by id and text, so unlike texts under one id, also a null one, stay. A null id comes last.
    Equal rows keep one. Texts without words belong to nothing and all stay.
    """
    clean = F.coalesce(F.col(text), F.lit(""))
    # components of texts: their hash is the id, so a repeated id links nothing
    texts = docs.select(*row_identity(F.col(doc_id), clean), clean.alias("_t"))
    marks = stored(join_components(texts, "_print", "_t", **how).filter("n_shingles > 0").distinct(), "marks")
    ids = texts.select("_id", "_print").join(marks.select(F.col("doc_id").alias("_print"), "component_id"), "_print")
    ids = ids.groupBy("component_id", "_id", "_print").agg(F.count(F.lit(1)).alias("_n"))
    rank = F.struct(F.col("_id").isNull().alias("last"), F.col("_id"), F.col("_print"))
    ids = stored(ids.withColumn("_rank", rank), "component-rows")
    best = ids.groupBy("component_id").agg(F.min("_rank").alias("_best"))
    gone = ids.join(best, "component_id").filter("NOT (_rank <=> _best)").select(F.col("_id").alias("_llm_id"), F.col("_print").alias("_llm_print"))
    # what goes is the smaller part; it is broadcast within the bound, so texts are not moved
    gone = broadcast_within(stored(gone, "gone"))
    twice = ids.join(best, "component_id").filter("_rank <=> _best AND _n > 1").select(F.col("_id").alias("_llm_id"), F.col("_print").alias("_llm_print"))
    twice = broadcast_within(stored(twice, "repeated"))

    def same(of: DataFrame):
        return F.col(doc_id).eqNullSafe(of["_llm_id"]) & (F.xxhash64(clean) == of["_llm_print"])

    kept = docs.join(gone, same(gone), "left_anti")
    return kept.join(twice, same(twice), "left_anti").unionByName(kept.join(twice, same(twice), "left_semi").dropDuplicates([doc_id, text]))
