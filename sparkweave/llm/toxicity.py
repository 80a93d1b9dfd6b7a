"""Toxicity scores learnt from confirmed toxic texts and unlabelled text, by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkweave.llm.arrow_text import CHUNK, PLACE, WORD_BYTE, chunks, mix, running_hash, text_bytes, word_bounds
from sparkweave.llm.common import broadcast_within, fold, row_identity
from sparkweave.sources.files import stored

BUCKETS = 1 << 20  # of hashed words and word beginnings
BEGINNINGS = (4, 5, 6)  # bytes
FEATURES = 4096  # buckets the classifier uses
POSITIVES = 20_000  # confirmed texts that are fitted on; a bound on labelled rows, nothing else
LEAST = 8  # confirmed texts that a feature must occur in, and their share of all
LEAST_SHARE = 0.004
PURE = 0.5  # estimated share of toxic texts among those with a feature
DECAY = 1e-5
STEPS = 60  # gradient steps, each one pass over the stored features
RATE = 0.1
CUT = 0.5

#: Punctuation at the ends of words is not part of them.
_EDGE = np.zeros(256, dtype=bool)
_EDGE[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _tokens(buf: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all words and their beginnings in a buffer, and the text each belongs to."""
    begins, ends = word_bounds(buf, first)
    if not len(begins):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    letter = np.flatnonzero(WORD_BYTE[buf] & ~_EDGE[buf])
    lo, hi = np.searchsorted(letter, begins), np.searchsorted(letter, ends)
    some = hi > lo  # words of punctuation alone are left out
    begins, ends = letter[lo[some]], letter[hi[some] - 1] + 1
    run, down = running_hash(buf)
    text = np.searchsorted(first, begins, side="right") - 1
    hashes = [(run[ends] - run[begins]) * down[begins] + (ends - begins).astype(np.uint64) * PLACE[30]]
    texts = [text]
    for k in BEGINNINGS:
        long = ends - begins > k
        b = begins[long]
        hashes.append((run[b + k] - run[b]) * down[b] + np.full(len(b), k, dtype=np.uint64) * PLACE[31])
        texts.append(text[long])
    return (mix(np.concatenate(hashes)) >> np.uint64(44)).astype(np.int64), np.concatenate(texts)


def buckets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct buckets of each text, from the whole text; null counts as empty."""
    data, at = text_bytes(texts)
    for i, j in chunks(at):
        if j == i + 1 and at[j] - at[i] > CHUNK:
            found, lo = [], int(at[i])
            while lo < at[j]:  # pieces that end between words; a longer word is cut
                hi = min(lo + CHUNK, int(at[j]))
                if hi < at[j]:
                    gaps = np.flatnonzero(~WORD_BYTE[data[lo:hi]])
                    hi = lo + int(gaps[-1]) + 1 if len(gaps) else hi
                found.append(np.unique(_tokens(data[lo:hi], np.zeros(1, dtype=np.int64))[0]))
                lo = hi
            yield np.unique(np.concatenate(found))
            continue
        got, text = _tokens(data[at[i] : at[j]], at[i : j + 1] - at[i])
        pairs = np.unique(text * BUCKETS + got)
        cuts = np.searchsorted(pairs, np.arange(j - i + 1) * BUCKETS)
        for k in range(j - i):
            yield pairs[cuts[k] : cuts[k + 1]] - k * BUCKETS


def _hits(sorted_values: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Places in ``sorted_values`` of those that are in ``f``."""
    at = np.searchsorted(sorted_values, f)
    at = at[at < len(sorted_values)] if len(sorted_values) else at[:0]
    return at[sorted_values[at] == f[: len(at)]].astype(np.int32)


# -- the risk

def risk_sums(rows: list[np.ndarray], times: np.ndarray, weights: np.ndarray, offset: float) -> np.ndarray:
    """Sums over texts that each count ``times``: loss of calling them not toxic, scores, and the gradient of that loss.

    ``rows``: feature numbers per text. The gradient of the scores themselves is in the last part, the offset first in each.
    """
    width = len(weights)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cols = np.concatenate(rows).astype(np.int64) if len(rows) else np.empty(0, dtype=np.int64)
    score = np.bincount(owner, weights[cols], len(rows)) + offset
    s = times / (1 + np.exp(-np.clip(score, -30, 30)))
    head = [(times * np.logaddexp(0, score)).sum(), (times * score).sum(), times.sum()]
    return np.concatenate([head, [s.sum()], np.bincount(cols, s[owner], width), [times.sum()], np.bincount(cols, times[owner].astype(float), width)])


def risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """The non-negative positive-unlabelled risk with the logistic loss, and the direction to step against (offset first).

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), from ``risk_sums``: toxic texts among the unlabelled ones are taken out of
    the risk of calling them not toxic. Where that leaves less than nothing, the step goes against that part, so that
    the classifier cannot win by memorising unlabelled texts.
    """
    width = len(weights)
    n_p, n_u = positive[2], unlabelled[2]
    called, drawn = positive[3 : 4 + width] / n_p, positive[4 + width :] / n_p
    minus_p, plus_p = positive[0] / n_p, (positive[0] - positive[1]) / n_p
    negative = unlabelled[0] / n_u - prior * minus_p
    away = unlabelled[3 : 4 + width] / n_u - prior * called
    direction = prior * (called - drawn) + away if negative >= 0 else -away
    value = prior * plus_p + max(0.0, negative) + DECAY / 2 * weights @ weights
    return value, direction + DECAY * np.concatenate([[0.0], weights])


def least_risk(evaluate, width: int) -> tuple[np.ndarray, float]:
    """Weights and offset after ``STEPS`` steps with running means of the directions and their squares.

    ``evaluate(x)`` is one pass over the data; ``x`` is the offset and then the weights.
    """
    x = np.concatenate([[-1.0], np.zeros(width)])
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        direction = evaluate(x)[1]
        mean, square = 0.9 * mean + 0.1 * direction, 0.999 * square + 0.001 * direction**2
        x = x - RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * mean / (np.sqrt(square) + 1e-8)
    return x[1:], float(x[0])


def _risk_pass(train: DataFrame, width: int, empty: dict[int, float], prior: float):
    """``evaluate`` over stored rows ``y, c, n``: every task sums up its rows, and one vector for each side comes to the driver.

    ``empty``: texts of each side without any feature, which are not stored.
    """
    size = 2 * width + 5

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights, offset = x[1:], float(x[0])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, size))
            for b in batches:
                y, n = b.column(0).to_numpy(), b.column(2).to_numpy().astype(float)
                rows = [np.frombuffer(c, dtype=np.int32) for c in b.column(1).to_pylist()]
                for side in (0, 1):
                    at = np.flatnonzero(y == side)
                    if len(at):
                        total[side] += risk_sums([rows[i] for i in at], n[at], weights, offset)
            place = np.flatnonzero(total.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel()[place])], names=["slot", "total"])

        sums = np.zeros(2 * size)
        for slot, value in train.mapInArrow(run, "slot bigint, total double").groupBy("slot").agg(F.sum("total")).collect():
            sums[slot] = value
        sides = sums.reshape(2, size)
        for side, n in empty.items():
            sides[side] += risk_sums([np.empty(0, dtype=np.int32)], np.array([float(n)]), weights, offset)
        return risk(sides[1], sides[0], prior, weights)

    return evaluate


def _confirmed(labels: DataFrame, label: str, folds: int) -> tuple[DataFrame, int, int]:
    """Usable labels ``_lid, y``, their number and that of the toxic ones."""
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
    known = usable.groupBy(F.col("doc_id").alias("_lid")).agg(F.max(F.col(label).cast("int")).alias("y"))
    n, n_positive = known.agg(F.count(F.lit(1)), F.sum("y")).first()
    return known, n, n_positive or 0


def _choose(positives: DataFrame, texts: DataFrame, prior: float, n_p: int, n_u: int, candidates: np.ndarray, seen_p: np.ndarray) -> np.ndarray:
    """Places among the candidates of the ``FEATURES`` that speak most for confirmed texts, by counts over all texts.

    By Bayes' rule, prior times share among confirmed over share among all texts estimates how pure a bucket is.
    """
    width = len(candidates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=np.int64)
        for b in batches:
            raw = b"".join(b.column(0).to_pylist())
            total += np.bincount(np.frombuffer(raw, dtype=np.int32), minlength=width)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], names=["slot", "n"])

    seen_u = np.zeros(width)
    for slot, n in texts.select("c").mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n")).collect():
        seen_u[slot] = n
    share_p, share_u = seen_p / n_p, (seen_u + 0.5) / n_u
    worth = np.abs(share_p - share_u) * np.abs(np.log((share_p + 0.5 / n_p) / share_u))
    pure = np.flatnonzero(prior * share_p >= PURE * share_u)
    return np.sort(pure[np.lexsort((candidates[pure], -worth[pure]))][:FEATURES])


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5) -> DataFrame:
    """``_id, _print, held_out, score, predicted``, one row per document, from the whole text.

    Confirmed toxic texts come from labels whose ``crc32(id) mod folds`` is not 0, at most ``POSITIVES`` of them (in
    expectation, by row hash); every text of ``docs`` is unlabelled. The class prior is the share of toxic ones among the usable
    labels; labels say nothing else. Texts are read once: what they have of the buckets that confirmed texts have is
    stored, and counts, the risk and the scores all follow from that, over all texts.

    Defined cases: null text counts as empty and gets the score of a text without words; null labels and labels
    without a document are left out; a document labelled both ways is confirmed; without a confirmed text every
    score is 0, without any label 0.5; repeated rows are scored alike; a null id is never held out; no documents
    give no rows.
    """
    clean = F.coalesce(F.col(text), F.lit(""))
    held = F.coalesce(fold(F.col(doc_id), folds) == 0, F.lit(False))
    picked = docs.select(*row_identity(F.col(doc_id), clean), held.alias("held_out"), F.col(text).alias("_t"))
    kind = picked.schema["_id"].dataType.simpleString()

    def constant(value: float) -> DataFrame:
        return picked.select("_id", "_print", "held_out", F.lit(value).alias("score"), F.lit(int(value >= CUT)).alias("predicted"))

    known, n, n_positive = _confirmed(labels, label, folds)
    if not n_positive:
        return constant(0.0 if n else 0.5)
    if n_positive == n:
        n = 2 * n_positive  # no usable negative: nothing is known of the prior
    prior = min(0.9, max(0.001, n_positive / n))

    drawn = F.pmod(F.xxhash64(F.lit("p"), F.col(doc_id), F.col(text)), F.lit(1 << 30)) < int(min(1.0, POSITIVES / n_positive) * (1 << 30))
    confirmed = broadcast_within(stored(known.filter("y = 1").select("_lid"), "confirmed"))
    chosen_docs = docs.filter(drawn).join(confirmed, F.col(doc_id) == F.col("_lid"), "left_semi").select(F.col(text).alias("t"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(list(buckets(b.column(0))), pa.list_(pa.int64()))], names=["f"])

    positives = stored(chosen_docs.mapInArrow(listed, "f array<bigint>"), "toxic-confirmed")
    n_p = positives.count()
    if not n_p:
        return constant(prior)
    least = max(LEAST, LEAST_SHARE * n_p)  # a bucket of few texts tells a family of copies, not toxicity
    seen = positives.select(F.explode("f").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("p")).filter(F.col("p") >= least)
    pairs = sorted((r["f"], r["p"]) for r in seen.collect())  # at most BUCKETS
    candidates, seen_p = (np.array(x, dtype=np.int64) for x in (zip(*pairs) if pairs else ((), ())))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_hits(candidates, f).tobytes() for f in buckets(b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(rows, pa.binary())], names=["_id", "_print", "held_out", "c"])

    texts = stored(picked.mapInArrow(marked, f"_id {kind}, _print bigint, held_out boolean, c binary"), "toxic-buckets")
    n_u = texts.count()
    chosen = _choose(positives, texts, prior, n_p, n_u, candidates, seen_p)
    place = np.full(len(candidates) + 1, -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))

    def narrowed(raw: bytes) -> np.ndarray:
        at = place[np.frombuffer(raw, dtype=np.int32)]
        return at[at >= 0]

    @F.arrow_udf("binary")
    def narrow(column: pa.Array) -> pa.Array:
        return pa.array([narrowed(c).tobytes() for c in column.to_pylist()], pa.binary())

    @F.arrow_udf("binary")
    def narrow_list(column: pa.Array) -> pa.Array:
        return pa.array([narrowed(_hits(candidates, f.values.to_numpy()).tobytes()).tobytes() for f in column], pa.binary())

    narrow_texts = stored(texts.select("_id", "_print", "held_out", narrow("c").alias("c")), "toxic-features")
    sides = positives.select(F.lit(1).alias("y"), narrow_list("f").alias("c")).unionByName(narrow_texts.select(F.lit(0).alias("y"), "c"))
    train = stored(sides.filter(F.octet_length("c") > 0).groupBy("y", "c").agg(F.count(F.lit(1)).alias("n")), "toxic-train")
    with_some = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    empty = {1: n_p - with_some.get(1, 0), 0: n_u - with_some.get(0, 0)}
    weights, offset = least_risk(_risk_pass(train, len(chosen), empty, prior), len(chosen))

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        totals = [weights[np.frombuffer(c, dtype=np.int32)].sum() + offset for c in column.to_pylist()]
        return pa.array(1 / (1 + np.exp(-np.clip(np.array(totals, dtype=float), -30, 30))))

    out = narrow_texts.select("_id", "_print", "held_out", scored("c").alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents not predicted toxic, with all their columns.

    Rows go by id and text: repeated rows stay or go together, null ids are ids, a null text is judged as an empty one; texts
    of any length are read whole. Without a confirmed toxic text nothing goes; no documents give no rows.
    """
    bad = score_documents(docs, labels, doc_id, text, **how).filter("predicted = 1").select("_id", "_print").distinct()
    bad = broadcast_within(stored(bad, "toxic"))
    same = F.col(doc_id).eqNullSafe(bad["_id"]) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == bad["_print"])
    return docs.join(bad, same, "left_anti")
