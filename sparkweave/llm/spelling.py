"""Spelling variants: words one edit apart, found by asymmetric q-chunks and grouped under their commonest form.

Of two words one edit apart the longer (or, of equal length, each in turn) is cut into two disjoint chunks and
the other gives its positional grams. One edit touches one chunk at most, so the other chunk is a gram of the
other word, at the same place or shifted by one; what joins so is verified by edit distance.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sparkweave.llm.common import ascii_lower
from sparkweave.sources.files import stored

#: Chunks times grams of one key beyond which its words are cut once more. Words alike in all but one code point
#: are fewer than the letters there are, so cutting ends well below.
MEETINGS = 100_000


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = 6, least_n: int = 5, misspell: int = 199) -> DataFrame:
    """``word, n``: words of at least ``least_chars`` code points that occur ``least_n`` times or more.

    Words are runs of Latin letters, A-Z lower-cased. A run loses one code point if ``misspell`` divides the checksum of
    its document and itself. Counts are summed up before the shuffle, so a very common word is one row a task.
    """
    cut = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), F.explode(F.split(F.col(text), "[^A-Za-zÀ-ÿ]+")).alias("_r"))
    runs = cut.filter(F.char_length("_r") >= least_chars).select("_id", ascii_lower(F.col("_r")).alias("_r"))
    h = F.crc32(F.concat("_id", F.lit(":"), "_r").cast("binary"))
    at = (h % F.char_length("_r")).cast("int")
    lost = F.concat(F.substring("_r", F.lit(1), at), F.substring("_r", at + 2, F.char_length("_r")))
    words = runs.select(F.when(h % misspell == 0, lost).otherwise(F.col("_r")).alias("word")).filter(F.char_length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_n)


def _part(key: Column, of: Column, part: int, piece: Column, low: Column, high: Column) -> Column:
    """One signature: what is shared so far, the length aimed at, which chunk, and the chunk; ``low`` to ``high`` is what is left."""
    return F.struct(F.xxhash64(key, of, F.lit(part), piece).alias("key"), low.cast("int").alias("low"), high.cast("int").alias("high"))


def _chunks() -> Column:
    """The two disjoint chunks of what is left of a word."""
    rest, size = F.substring("word", F.col("low") + 1, F.col("high") - F.col("low")), F.col("high") - F.col("low")
    q = F.floor(size / 2).cast("int")
    return F.array(
        _part(F.col("key"), size, 1, F.substring(rest, F.lit(1), q), F.col("low") + q, F.col("high")),
        _part(F.col("key"), size, 2, F.substring(rest, q + 1, size - q), F.col("low"), F.col("low") + q),
    )


def _grams(longer: Column) -> Column:
    """The grams of what is left of a word that can equal a chunk of a rest ``longer`` (0 or 1) code points longer.

    The first chunk is met where it stands, the second one shifted back by ``longer``; grams elsewhere are out of reach.
    """
    rest, size = F.substring("word", F.col("low") + 1, F.col("high") - F.col("low")), F.col("high") - F.col("low")
    of = size + longer
    q = F.floor(of / 2).cast("int")
    shift = q - longer
    return F.array(
        _part(F.col("key"), of, 1, F.substring(rest, F.lit(1), q), F.col("low") + q, F.col("high")),
        _part(F.col("key"), of, 2, F.substring(rest, shift + 1, of - q), F.col("low"), F.col("low") + shift),
    )


def near_words(words: DataFrame) -> DataFrame:
    """``a, na, b, nb``: all pairs of ``words(word, n)`` that differ by one inserted, deleted or replaced code point, each once.

    Chunks and grams join on their hash. A key where more than ``MEETINGS`` pairs would meet is not joined: what is left of
    its words is cut into chunks again, by the same rule, until every key is small. No pair is lost, since an edit
    leaves one of the two chunks of the rest alone, too.
    """
    start = words.select("word", "n", F.lit(0).cast("bigint").alias("key"), F.lit(0).alias("low"), F.char_length("word").alias("high"))
    sides = [start.withColumn("longer", F.lit(-1))] + [start.withColumn("longer", F.lit(d)) for d in (0, 1)]
    level, found = reduce(DataFrame.unionByName, sides), []
    while True:
        cut = F.when(F.col("longer") < 0, _chunks()).otherwise(_grams(F.col("longer")))
        signed = level.select("word", "n", "longer", F.explode(cut).alias("s")).select("word", "n", "longer", "s.*")
        signed = stored(signed, "chunks")
        sizes = signed.groupBy("key").agg(
            F.count_if(F.col("longer") < 0).alias("_chunks"), F.count_if(F.col("longer") >= 0).alias("_grams"),
            F.min("word").alias("_first"), F.max("word").alias("_last"),
        ).filter("_first <> _last AND _chunks > 0 AND _grams > 0")
        sizes = stored(sizes.select("key", (F.col("_chunks") * F.col("_grams") > MEETINGS).alias("_large")), "chunk-sizes")
        meet = signed.join(sizes.filter("NOT _large").select("key"), "key")
        long = meet.filter("longer < 0").select("key", F.col("word").alias("a"), F.col("n").alias("na"))
        short = meet.filter("longer >= 0").select("key", F.col("word").alias("b"), F.col("n").alias("nb"), "longer")
        once = (F.col("longer") == 1) | (F.col("a") < F.col("b"))
        fits = F.char_length("a") == F.char_length("b") + F.col("longer")
        met = long.join(short, "key").filter(fits & once & (F.levenshtein("a", "b", 1) == 1))
        found.append(stored(met.select("a", "na", "b", "nb"), "near-words"))
        large = sizes.filter("_large").select("key")
        if large.isEmpty():
            break
        level = signed.join(large, "key")
    return reduce(DataFrame.unionByName, found).distinct()


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """``word, root`` for every word of ``forms(word, form)``: pointers are doubled until all end at a word without a form.

    A form occurs at least five times as often as its word, so ways are short and never close.
    """
    steps = max(1, math.ceil(math.log(max(most, 5) / 5, 5)) + 1)
    ways = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        ways = stored(ways, "ways")
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        ways = ways.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
    return ways


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", factor: int = 5, **how) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word that ``word_counts`` keeps (``how`` goes there).

    ``form`` is the near word of largest ``n`` (ties: smallest by code point) if it occurs at least ``factor`` (5 or more)
    times as often; ``root`` is where forms lead. All of the corpus is counted, no word, key or partner is capped.

    Defined cases: null and empty texts have no words; a null id counts as an empty one; repeated rows count each time;
    a run of any length is one word; an empty table gives no rows. Only the named columns are read.
    """
    words = stored(word_counts(docs, doc_id, text, **how), "words")
    pairs = stored(near_words(words), "near-pairs")
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("nb")).alias("less"), F.col("b").alias("other")).alias("o")).unionByName(
        pairs.select(F.col("b").alias("word"), F.struct((-F.col("na")).alias("less"), F.col("a").alias("other")).alias("o"))
    )
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("o").alias("best"))
    wins = -F.col("best.less") >= factor * F.col("n")
    marked = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(wins, F.col("best.other")).alias("form"), F.when(wins, -F.col("best.less")).alias("form_n"),
    )
    marked = stored(marked, "forms")
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(marked.filter("form IS NOT NULL"), most)
    return marked.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
