"""Chunking, term statistics, checks and dataset shaping over text columns."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkweave.sources.files import stored

HELD = 1_000_000  # characters of chunks that a task holds
WHITE = re.compile(r"\s+", re.ASCII)

def words(text: Column | str) -> Column:
    """Words between white space, empty ones left out."""
    return F.array_remove(F.split(text, r"\s+"), "")


def word_chunks(df: DataFrame, text: str, size: int, overlap: int, *keep: str) -> DataFrame:
    """Chunks of ``size`` words that start every ``size - overlap`` words: kept columns, ``chunk_no``, ``chunk``."""
    step = size - overlap
    w = df.select(*keep, words(text).alias("_w")).filter(F.size("_w") > 0)
    starts = F.sequence(F.lit(0), F.size("_w") - 1, F.lit(step))
    chunks = F.transform(starts, lambda i: F.array_join(F.slice(F.col("_w"), i + 1, F.lit(size)), " "))
    return w.select(*keep, F.posexplode(chunks).alias("chunk_no", "chunk"))


def char_chunks(df: DataFrame, text: str, size: int, overlap: int, *keep: str) -> DataFrame:
    """Chunks of ``size`` characters that start every ``size - overlap`` characters."""
    n = F.length(text)
    starts = F.sequence(F.lit(0), n - 1, F.lit(size - overlap))
    chunks = F.transform(starts, lambda i: F.substring(F.col(text), i + 1, F.lit(size)))
    return df.filter(n > 0).select(*keep, F.posexplode(chunks).alias("chunk_no", "chunk"))


def split_recursively(text: str, size: int, separators: Sequence[str]) -> list[str]:
    """Pieces of at most ``size`` characters, cut at the coarsest separator that is enough.

    Separators stay at the end of their piece, so the pieces joined give the text again. The
    last resort is a cut by length.
    """
    if len(text) <= size:
        return [text] if text else []
    for i, sep in enumerate(separators):
        if sep and sep in text:
            out, held = [], ""
            parts = text.split(sep)
            for part in [p + sep for p in parts[:-1]] + [parts[-1]]:
                if held and len(held) + len(part) > size:
                    out.append(held)
                    held = ""
                if len(part) > size:
                    out.extend(split_recursively(part, size, separators[i + 1 :]))
                else:
                    held += part
            return out + ([held] if held else [])
    return [text[k : k + size] for k in range(0, len(text), size)]


def recursive_chunks(df: DataFrame, key: str, text: str, size: int, separators: Sequence[str]) -> DataFrame:
    """``key, chunk_no, chunk`` by ``split_recursively``, text by text; a task holds the chunks of about ``HELD`` characters."""
    seps = list(separators)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.columns
            row, no, chunks, held = [], [], [], 0

            def out():
                return pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(row, pa.int64())), pa.array(no, pa.int32()), pa.array(chunks, pa.string())], names=[key, "chunk_no", "chunk"]
                )

            for i in range(b.num_rows):
                for j, c in enumerate(split_recursively(texts[i].as_py() or "", size, seps)):
                    row.append(i)
                    no.append(j)
                    chunks.append(c)
                    held += len(c)
                    if held > HELD:
                        yield out()
                        row, no, chunks, held = [], [], [], 0
            if row:
                yield out()

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"{key} {kind}, chunk_no int, chunk string")


def sentences(text: Column | str) -> Column:
    """Sentences: cut at white space after a full stop, question or exclamation mark."""
    return F.array_remove(F.split(text, r"(?<=[.!?])\s+"), "")


def sentence_windows(df: DataFrame, text: str, around: int, *keep: str) -> DataFrame:
    """Each sentence with the ``around`` sentences before and after it as ``window``."""
    s = df.select(*keep, sentences(text).alias("_s"))
    rows = F.transform(
        F.col("_s"),
        lambda x, i: F.struct(
            i.alias("sentence_no"), x.alias("sentence"),
            F.array_join(
                F.slice(F.col("_s"), F.greatest(i + 1 - around, F.lit(1)), i + 1 + around - F.greatest(i + 1 - around, F.lit(1)) + 1), " "
            ).alias("window"),
        ),
    )
    return s.select(*keep, F.inline(rows))


def hashed_counts(text: str, dims: int = 256) -> np.ndarray:
    """Word counts folded into ``dims`` slots; the slot of a word never changes between runs."""
    slots = [zlib.crc32(w.encode()) % dims for w in text.lower().split()]
    return np.bincount(slots, minlength=dims).astype(float) if slots else np.zeros(dims)


def first_sentences(said: Sequence[str], threshold: float) -> list[int]:
    """Where chunks begin: at the first sentence, and at each whose word counts have a cosine below ``threshold`` with the one before it."""
    out, before, last = [], {}, 0
    for i, sentence in enumerate(said):
        counts = Counter(w for w in WHITE.split(sentence) if w)
        own = sum(c * c for c in counts.values())
        small, large = (counts, before) if len(counts) < len(before) else (before, counts)
        shared = sum(c * large.get(w, 0) for w, c in small.items())
        if not (own and last and shared / math.sqrt(float(own) * last) >= threshold):
            out.append(i)
        before, last = counts, own
    return out


def semantic_chunks(df: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """``<key>, chunk_no, chunk``: a chunk ends where the next sentence is unlike the one before it.

    Alike is a cosine of word counts of ``threshold`` or more. A row is a text, so it is cut where it is read and only
    key and hash of each text are shuffled, to find repeated rows, which count once; texts of repeated rows alone are moved.
    A text without a key is cut at every sentence.
    """
    rows = df.select(key, text).withColumn("_print", F.xxhash64(text)).filter(F.col(text).isNotNull())
    repeated = rows.groupBy(key, "_print").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1")
    repeated = stored(repeated.select(F.col(key).alias("_key"), F.col("_print").alias("_same")), "repeated")
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_print") == F.col("_same"))
    once = rows.join(repeated, same, "left_anti").unionByName(rows.join(repeated, same, "left_semi").dropDuplicates([key, "_print"]))

    @F.arrow_udf("array<int>")
    def begins(said: pa.Array) -> pa.Array:
        return pa.array([first_sentences(x.as_py(), threshold) for x in said], pa.list_(pa.int32()))

    s = once.select(key, sentences(text).alias("_s"))
    low = F.when(F.col(key).isNotNull(), F.transform("_s", F.lower)).otherwise(F.array().cast("array<string>"))
    every = F.transform("_s", lambda x, i: i)
    cut = s.withColumn("_own", begins(low)).withColumn("_at", F.when(F.col(key).isNotNull(), F.col("_own")).otherwise(every))
    pieces = F.transform("_at", lambda b, i: F.array_join(
        F.slice("_s", b + 1, F.coalesce(F.get("_at", i + 1), F.size("_s")) - b), " "
    ))
    return cut.select(key, F.posexplode(pieces).alias("chunk_no", "chunk"))


def word_runs(w: Column) -> Column:
    """``struct(term, tf)`` per distinct word of an array: equal words are neighbours in order, and each run is one term."""

    def runs(sorted_words):
        places = F.sequence(F.lit(0), F.size(sorted_words) - 1)
        begins = F.filter(places, lambda i: (i == 0) | (F.get(sorted_words, i) != F.get(sorted_words, i - 1)))

        def counted(at):
            return F.transform(at, lambda b, i: F.struct(
                F.get(sorted_words, b).alias("term"), (F.coalesce(F.get(at, i + 1), F.size(sorted_words)) - b).cast("bigint").alias("tf"),
            ))

        # each array is held once, however often a lambda names it
        return F.transform(F.array(begins), counted)[0]

    return F.when(F.size(w) > 0, F.transform(F.array(F.sort_array(w)), runs)[0])


def postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, dl, term, tf`` of lower-case words, ``dl`` being the document's word count.

    A row is a document, so words are counted inside the row and nothing is shuffled.
    """
    doc = df.select(key, words(F.lower(text)).alias("_w"))
    return doc.select(key, F.size("_w").alias("dl"), F.inline(word_runs(F.col("_w"))))


def tf_idf(df: DataFrame, key: str, text: str) -> DataFrame:
    """``tf / length * ln(N / df)`` per document and term."""
    tf = postings(df, key, text)
    # a term of a third of all documents makes one large join partition, which adaptive execution splits
    frequency = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = df.agg(F.count(F.lit(1))).scalar()
    scored = tf.join(frequency, "term")
    return scored.select(key, "term", "tf", (F.col("tf") / F.col("dl") * F.log(n / F.col("df"))).alias("tf_idf"))


# fixed values: patterns and phrase lists of the text checks
PII_PATTERNS = {
    "credit_card": r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
}
INJECTION_KEYWORDS = [
    "ignore all previous", "ignore your instructions", "disregard system", "you are now", "pretend you are", "act as if",
    "forget your training",
]
ADVICE_PHRASES = ["you should", "i recommend", "take this", "my recommendation", "i advise", "you must", "i suggest"]
TOPIC_PHRASES = ["should i take", "is it safe to", "can i combine", "what dose", "am i okay to", "will this help"]
REFUSAL_PHRASES = ["i cannot", "i am unable to", "as an ai, i"]


def pii_types(text: str) -> Column:
    """Names of the kinds of personal data found."""
    return F.array_compact(F.array(*[F.when(F.col(text).rlike(f"(?i){p}"), F.lit(k)) for k, p in PII_PATTERNS.items()]))


def redact(text: str) -> Column:
    out = F.col(text)
    for kind, p in PII_PATTERNS.items():
        out = F.regexp_replace(out, f"(?i){p}", f"[{kind.upper()}]")
    return out


def first_phrase(text: str, phrases: Sequence[str]) -> Column:
    """First phrase of the list that occurs in the text, else null."""
    low = F.lower(text)
    return F.coalesce(*[F.when(low.contains(p), F.lit(p)) for p in phrases])


def output_issues(text: str, min_len: int = 10, max_len: int = 1000, must: Sequence[str] = (), must_not: Sequence[str] = ()) -> Column:
    """Problems of an answer: length bounds, refusal phrases, missing and forbidden words."""
    n, low = F.length(text), F.lower(text)
    checks = [F.when(n < min_len, "too short"), F.when(n > max_len, "too long")]
    checks += [F.when(low.contains(p), f"refusal: {p}") for p in REFUSAL_PHRASES]
    checks += [F.when(~low.contains(w), f"missing: {w}") for w in must]
    checks += [F.when(low.contains(w), f"forbidden: {w}") for w in must_not]
    return F.array_compact(F.array(*checks))
