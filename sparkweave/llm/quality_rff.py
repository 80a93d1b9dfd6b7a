"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkweave.llm.arrow_text import chunks, each_words, text_bytes
from sparkweave.llm.common import broadcast_within, fold, row_identity
from sparkweave.sources.files import stored

FEATURES = 256  # random Fourier features
WIDTH = 2.5  # of the Gaussian kernel, in standard deviations of the statistics
RIDGE = 1e-3  # per training row
BINS = 1000  # of raw scores, for the calibration
CUT = 0.3
NAMES = (
    "words", "word_length", "long_words", "symbols", "bars", "capitals", "marks", "digits", "commas", "stops", "blank_lines",
    "line_length", "same_lines", "same_words", "doubled_words", "same_windows", "beyond_ascii", "mid_capitals",
)


def _share(a: float, b: float) -> float:
    return a / b if b else 0.0


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text, from the whole text; an empty text is all zeros.

    Shares and logarithms, so length alone says little. Only the text is read.
    """
    data, at = text_bytes(texts)
    out = np.zeros((len(texts), len(NAMES)))
    words = each_words(texts)
    symbols = np.frombuffer(b"#*$%&<>~^=_{}[]\\", dtype=np.uint8)
    for i, j in chunks(at):
        for k in range(i, j):
            w, raw = next(words), data[at[k] : at[k + 1]]
            n = len(w)
            if not n:
                continue
            count = np.zeros(256, dtype=np.int64)
            for lo in range(0, len(raw), 1 << 22):
                count += np.bincount(raw[lo : lo + (1 << 22)], minlength=256)
            blank = count[[9, 10, 11, 12, 13, 32]].sum()
            chars = len(raw) - blank
            upper, letters = count[65:91].sum(), count[65:91].sum() + count[97:123].sum()
            lines = bytes(raw).split(b"\n")
            full = [x for x in lines if x.strip()]
            doubled = int((w[1:] == w[:-1]).sum())
            grams = w[:-2] * np.uint64(3) + w[1:-1] * np.uint64(5) + w[2:] * np.uint64(7) if n > 2 else w[:0]
            out[k] = (
                np.log1p(n), np.log(chars / n), _share(chars - 5 * n, chars), np.sqrt(_share(count[symbols].sum(), chars)),
                np.sqrt(_share(count[124], n)), np.sqrt(_share(upper, letters)), np.sqrt(_share(count[33] + count[63], n)),
                np.sqrt(_share(count[48:58].sum(), chars)), np.sqrt(_share(count[44], n)), np.sqrt(_share(count[46], n)),
                _share(len(lines) - len(full), len(lines)), np.log1p(_share(chars, len(full))),
                np.sqrt(_share(len(full) - len(set(full)), len(full))), _share(n - len(np.unique(w)), n), np.sqrt(_share(doubled, n)),
                np.sqrt(_share(len(grams) - len(np.unique(grams)), len(grams))), np.sqrt(_share(count[128:].sum(), chars)),
                np.sqrt(_share(max(0, upper - count[46] - count[33] - count[63] - len(full)), n)),
            )
    return out


def statistic_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``_id, _print, f`` per document; ``f`` holds the statistics."""
    picked = docs.select(*row_identity(F.col(doc_id), F.coalesce(F.col(text), F.lit(""))), F.col(text).alias("_t"))
    kind = picked.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = statistics(b.column(2))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(f.ravel(), pa.float64()), len(NAMES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), flat], names=["_id", "_print", "f"])

    return picked.mapInArrow(run, f"_id {kind}, _print bigint, f array<double>")


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), width)


def fourier(f: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel, with a constant; the same draws everywhere."""
    rng = np.random.default_rng(4)
    w, shift = rng.standard_normal((f.shape[1], FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((f - centre) / scale, -6, 6)
    return np.hstack([np.cos(z @ w + shift) * np.sqrt(2 / FEATURES), np.ones((len(f), 1))])


def isotonic(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Non-decreasing fit to ``label`` in the order of ``score``, by pooling adjacent violators."""
    mean, mass, size = [], [], []
    for k in np.argsort(score, kind="stable"):
        mean.append(float(label[k]))
        mass.append(float(weight[k]))
        size.append(1)
        while len(mean) > 1 and mean[-2] >= mean[-1]:
            m, v, c = mean.pop(), mass.pop(), size.pop()
            mean[-1] = (mean[-1] * mass[-1] + m * v) / (mass[-1] + v)
            mass[-1] += v
            size[-1] += c
    out = np.empty(len(score))
    out[np.argsort(score, kind="stable")] = np.repeat(mean, size)
    return out


class Model:
    """A fitted score: centre and scale of the statistics, ridge weights, calibration points."""

    def __init__(self, centre, scale, weights, raw, value, base):
        self.centre, self.scale, self.weights, self.raw, self.value, self.base = centre, scale, weights, raw, value, base

    def predict(self, f: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(f), self.base)
        score = fourier(f, self.centre, self.scale) @ self.weights
        return np.interp(score, self.raw, self.value) if len(self.raw) else np.clip(score, 0, 1)


def _sum_by_row(rows: DataFrame, width: int) -> np.ndarray:
    """Element sums of ``i, v`` rows per ``i``: one row per partition and ``i`` comes in, ``width`` numbers each."""
    def add(key, batch):
        total = _matrix(batch.column("v").combine_chunks(), width).sum(axis=0)
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "v": pa.array([total], pa.list_(pa.float64()))})

    got = rows.groupBy("i").applyInArrow(add, "i int, v array<double>").collect()
    out = np.zeros((max((r["i"] for r in got), default=-1) + 1, width))
    for r in got:
        out[r["i"]] = r["v"]
    return out


def fit(rows: DataFrame) -> Model:
    """Fit on ``f, y`` rows (statistics; label from 0 to 1).

    Each task adds up its part of the moments, then of the normal equations, so any number of rows is fitted on and
    the driver sees one small matrix. Calibration: mean labels in bins of equal score width, pooled to be monotone.
    No rows, or rows of one label only, give a constant score.
    """
    p = len(NAMES)

    def moments(batches):
        total = np.zeros((1, 2 * p + 2))
        for b in batches:
            f, y = _matrix(b.column(0), p), b.column(1).to_numpy(zero_copy_only=False)
            total[0] += np.concatenate([f.sum(0), (f * f).sum(0), [y.sum(), len(y)]])
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    data = rows.select("f", F.col("y").cast("double"))
    sums = _sum_by_row(data.mapInArrow(moments, "i int, v array<double>"), 2 * p + 2)
    n, positive = (sums[0, -1], sums[0, -2]) if len(sums) else (0.0, 0.0)
    if n == 0 or positive in (0.0, n):
        return Model(None, None, None, None, None, positive / n if n else 0.5)
    centre = sums[0, :p] / n
    scale = np.sqrt(np.maximum(sums[0, p : 2 * p] / n - centre**2, 0)) + 1e-3

    def normal(batches):
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for b in batches:
            f, y = _matrix(b.column(0), p), b.column(1).to_numpy(zero_copy_only=False)
            z = fourier(f, centre, scale)
            total += np.hstack([z.T @ z, (z.T @ y)[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    system = _sum_by_row(data.mapInArrow(normal, "i int, v array<double>"), FEATURES + 2)
    weights = np.linalg.solve(system[:, :-1] + RIDGE * n * np.eye(FEATURES + 1), system[:, -1])

    def binned(batches):
        total = np.zeros((3, BINS + 1))
        for b in batches:
            f, y = _matrix(b.column(0), p), b.column(1).to_numpy(zero_copy_only=False)
            s = fourier(f, centre, scale) @ weights
            k = np.clip(np.floor((s + 0.5) / 2 * BINS), 0, BINS).astype(int)
            total += [np.bincount(k, minlength=BINS + 1), np.bincount(k, y, BINS + 1), np.bincount(k, s, BINS + 1)]
        yield pa.RecordBatch.from_arrays([pa.array([0, 1, 2], pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    count, label, score = _sum_by_row(data.mapInArrow(binned, "i int, v array<double>"), BINS + 1)
    full = count > 0
    raw = score[full] / count[full]
    value = isotonic(raw, label[full] / count[full], count[full])
    return Model(centre, scale, weights, raw, np.clip(value, 1e-4, 1 - 1e-4), positive / n)


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 5) -> DataFrame:
    """``_id, _print, held_out, score, predicted``, one row per document.

    Learns from labelled documents whose ``crc32(id) mod folds`` is not 0; the score depends on the text alone.
    Defined cases: null text counts as empty and is scored like one; null labels and labels without a document are
    left out; several labels of one id count as their mean; a null id is never held out nor learnt from; without
    usable labels every score is 0.5, with labels of one kind it is that label; no documents give no rows.
    """
    stats = stored(statistic_rows(docs, doc_id, text), "statistics")
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
    known = known.groupBy(F.col("doc_id").alias("_lid")).agg(F.avg(F.col(label).cast("double")).alias("y"))
    model = fit(stored(stats.join(known, F.col("_id") == F.col("_lid")).select("f", "y"), "training"))
    p = len(NAMES)

    @F.arrow_udf("double")
    def score(f: pa.Array) -> pa.Array:
        return pa.array(model.predict(_matrix(f, p)), pa.float64())

    held = F.coalesce(fold(F.col("_id"), folds) == 0, F.lit(False))
    out = stats.select("_id", "_print", held.alias("held_out"), score(F.col("f")).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents predicted good, with all their columns.

    Rows go by id and text: repeated rows stay or go together, null ids are ids, a null text is judged as an empty one; texts
    of any length are read whole. Without usable labels nothing goes; no documents give no rows.
    """
    bad = score_documents(docs, labels, doc_id, text, **how).filter("predicted = 0").select("_id", "_print").distinct()
    bad = broadcast_within(stored(bad, "poor"))
    same = F.col(doc_id).eqNullSafe(bad["_id"]) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == bad["_print"])
    return docs.join(bad, same, "left_anti")
