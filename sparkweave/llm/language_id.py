"""Language identification in two steps: the family first, then one-versus-one support vector machines inside it."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkweave.llm.arrow_text import text_bytes
from sparkweave.llm.common import broadcast_within, fold, row_identity
from sparkweave.sources.files import stored

#: Languages by family. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
BUCKETS = 2048  # for each length of byte runs
RUNS = (1, 2, 3)
DIM = BUCKETS * len(RUNS)
PER_LANGUAGE = 1500  # training documents of a language; a bound on the sample, nothing else
ROUNDS = 150
PIECE = 1 << 20  # bytes of a text counted at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[*range(0, 65), *range(91, 97), *range(123, 128)]] = 32  # all that is no letter is a gap


def has_letter(raw: np.ndarray) -> bool:
    """True if the bytes of a text hold a letter: a character of a Unicode category L."""
    plain = (raw | 32) - 97
    if (plain < 26).any():
        return True
    # distinct characters only; a piece may cut one, which the next piece begins with
    for lo in range(0, len(raw), PIECE):
        if (raw[lo : lo + PIECE] >= 128).any():
            if any(unicodedata.category(c)[0] == "L" for c in set(bytes(raw[max(0, lo - 3) : lo + PIECE]).decode("utf-8", "ignore"))):
                return True
    return False


def _vector(raw: np.ndarray) -> np.ndarray:
    """Square roots of the shares of byte runs of one to three letters, over the whole text."""
    total = np.zeros(DIM)
    for lo in range(0, len(raw), PIECE):
        b = raw[lo : lo + PIECE]
        low = _LOWER[b]
        upper = np.zeros(len(b), dtype=bool)  # two-byte capitals of the Latin-1 range
        upper[1:] = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E)
        low[upper] += 32
        c = low.astype(np.uint32)
        pair = c[:-1] * 257 + c[1:]
        triple = pair[:-1] * 263 + c[2:]
        letter = low != 32
        total[:BUCKETS] += np.bincount(c[letter], minlength=BUCKETS)[:BUCKETS]
        total[BUCKETS : 2 * BUCKETS] += np.bincount((pair[letter[1:] | letter[:-1]] * np.uint32(2654435761) >> 21), minlength=BUCKETS)
        total[2 * BUCKETS :] += np.bincount((triple[letter[1:-1]] * np.uint32(2654435761) >> 21), minlength=BUCKETS)
    for i in range(len(RUNS)):
        part = total[i * BUCKETS : (i + 1) * BUCKETS]
        n = part.sum()
        if n:
            part /= n
    return np.sqrt(total)


def vectors(texts: pa.Array) -> Iterator[np.ndarray | None]:
    """The vector of each text; None for a text without a letter."""
    data, at = text_bytes(texts)
    for k in range(len(texts)):
        raw = data[at[k] : at[k + 1]]
        yield _vector(raw) if has_letter(raw) else None


def train_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear support vector machine (squared hinge loss) by accelerated gradient steps; ``y`` is 1 or -1.

    Both sides weigh the same, whatever their number of rows.
    """
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    weight = weight.astype(x.dtype)
    w, b = np.zeros(x.shape[1], dtype=x.dtype), 0.0
    vw, vb, rate = w.copy(), b, float(1.0 / (2 * (np.square(x).sum(1).max() + 1) + penalty))
    for t in range(1, ROUNDS + 1):
        short = (np.maximum(0, 1 - y * (x @ vw + vb)) * weight * y).astype(x.dtype)
        nw, nb = vw + rate * (2 * short @ x - penalty * vw), vb + rate * 2 * float(short.sum())
        grow = (t - 1) / (t + 2)
        vw, vb, w, b = nw + grow * (nw - w), nb + grow * (nb - b), nw, nb
    scale = np.abs(x @ w + b).mean() or 1.0  # margins of different machines become comparable
    return w / scale, b / scale


class Languages:
    """Families with their separating machines, and the machines of each pair of languages in a family."""

    def __init__(self, langs: list[str], machines: dict[str, tuple[np.ndarray, float]]):
        self.langs = langs
        self.by_family: dict[str, list[str]] = {}
        for lang in sorted(langs):
            self.by_family.setdefault(FAMILY_OF.get(lang, lang), []).append(lang)
        self.machines = machines

    def _vote(self, v: np.ndarray, names: list[str], kind: str) -> tuple[str, float]:
        """The name that wins most one-versus-one decisions, then the largest margin; with its least margin."""
        if len(names) == 1:
            return names[0], np.inf
        won, margin = dict.fromkeys(names, 0), {a: [] for a in names}
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                w, c = self.machines[f"{kind}:{a}:{b}"]
                m = float(v @ w + c)
                won[a if m >= 0 else b] += 1
                margin[a].append(m)
                margin[b].append(-m)
        best = max(names, key=lambda a: (won[a], sum(margin[a])))
        return best, min(margin[best])

    def predict(self, v: np.ndarray | None) -> tuple[str, float]:
        if v is None or not self.langs:
            return "und", 0.0
        family, m1 = self._vote(v, list(self.by_family), "family")
        lang, m2 = self._vote(v, self.by_family[family], "lang")
        return lang, float(1 / (1 + np.exp(-2 * np.clip(min(m1, m2), -20, 20))))


def learn(docs: DataFrame, doc_id: str, text: str, lang: str, folds: int, held: int, per_language: int = PER_LANGUAGE) -> Languages:
    """Train all machines, each in a task of its own, on at most ``per_language`` documents of a language.

    The sample goes by the hash of id and text and needs one counting pass and no sorting of the corpus; what it
    takes at most is a documented bound for fitting only. Documents of the held-out fold and with null language
    are never read for training.
    """
    usable = docs.filter(F.col(lang).isNotNull() & F.coalesce(fold(F.col(doc_id), folds) != held, F.lit(True)))
    # one row for each value of the language column, however many there are
    sizes = stored(usable.groupBy(F.col(lang).cast("string").alias("_lang")).agg(F.count(F.lit(1)).alias("_n")), "language-sizes")
    rate = F.least(F.lit(1.0), F.lit(1.3 * per_language) / F.col("_n"))
    point = F.pmod(F.xxhash64(F.lit("sample"), F.col(doc_id), F.col(text)), F.lit(1 << 30)) / float(1 << 30)
    named = usable.select(F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_t"), point.alias("_p"))
    drawn = named.join(broadcast_within(sizes), "_lang").filter(F.col("_p") < rate)

    def featurise(batches):
        for b in batches:
            names, points, rows = b.column(0).to_pylist(), b.column(2).to_pylist(), []
            for name, point, v in zip(names, points, vectors(b.column(1))):
                if v is not None:
                    rows.append((name, point, v.astype(np.float32).tobytes()))
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.binary())], names=["lang", "p", "v"])

    sample = stored(drawn.select("_lang", "_t", "_p").mapInArrow(featurise, "lang string, p double, v binary"), "language-sample")
    found = sample.select(F.col("lang").alias("_lang")).distinct().join(sizes, "_lang").collect()
    counts = {r["_lang"]: r["_n"] for r in found}
    names = sorted(counts)
    family = {name: FAMILY_OF.get(name, name) for name in names}
    families = sorted(set(family.values()))
    sides = [(f"family:{a}:{b}", [n for n in names if family[n] == a], [n for n in names if family[n] == b]) for i, a in enumerate(families) for b in families[i + 1 :]]
    sides += [(f"lang:{a}:{b}", [a], [b]) for i, a in enumerate(names) for b in names[i + 1 :] if family[a] == family[b]]
    if not sides:
        return Languages(names, {})
    # each side of a machine has at most ``per_language`` documents, shared by its languages
    roles = []
    for machine, plus, minus in sides:
        for y, side in ((1, plus), (-1, minus)):
            most = max(1, per_language // len(side))
            roles += [(name, machine, y, most, min(1.0, 1.3 * most / counts[name])) for name in side]
    roles = docs.sparkSession.createDataFrame(roles, "lang string, machine string, y int, most int, p_most double")
    rows = sample.select("lang", "p", "v").join(roles, "lang").filter("p < p_most")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["lang", "p", "v"])
        pdf = pdf[pdf.groupby("lang").cumcount() < pdf["most"]]
        x = np.frombuffer(b"".join(pdf["v"]), dtype=np.float32).reshape(len(pdf), DIM)
        w, b = train_svm(x, pdf["y"].to_numpy(dtype=np.float32))
        return pd.DataFrame({"machine": [pdf["machine"].iloc[0]], "w": [w.astype(np.float32).tobytes()], "b": [float(b)]})

    # a model of a few kilobytes per machine comes to the driver
    fitted = rows.groupBy("machine").applyInPandas(fit, "machine string, w binary, b double").collect()
    machines = {r["machine"]: (np.frombuffer(r["w"], dtype=np.float32).astype(np.float64), r["b"]) for r in fitted}
    return Languages(names, machines)


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, held: int = 2,
    per_language: int = PER_LANGUAGE,
) -> DataFrame:
    """``_id, _print, held_out, lang_pred, score``, one row per document, from the whole text alone.

    Learns from documents with a language whose ``crc32(id) mod folds`` is not ``held``. Defined cases: null text or
    text without a letter: ``und`` with score 0; one known language: always that one; none: ``und``; a language whose
    training texts have no letter is not learnt; repeated rows are predicted alike; null ids are learnt from and never
    held out; no documents give no rows. Only the named columns are read.
    """
    model = learn(docs, doc_id, text, lang, folds, held, per_language)
    picked = docs.select(*row_identity(F.col(doc_id), F.col(text)), F.coalesce(fold(F.col(doc_id), folds) == held, F.lit(False)).alias("held_out"), F.col(text).alias("_t"))
    kind = picked.schema["_id"].dataType.simpleString()

    def predict(batches):
        for b in batches:
            found = [model.predict(v) for v in vectors(b.column(3))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=["_id", "_print", "held_out", "lang_pred", "score"],
            )

    return picked.mapInArrow(predict, f"_id {kind}, _print bigint, held_out boolean, lang_pred string, score double")
