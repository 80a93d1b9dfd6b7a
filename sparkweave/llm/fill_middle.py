"""Fill-in-the-middle: texts cut at token boundaries, which are held in a compressed set of offsets.

The boundaries of a text are one ascending set of code-point offsets, kept by the upper bits of the offset in
containers of the cheapest kind (array, bitmap or runs) with cumulative cardinalities. The k-th boundary is found
by a search over the containers and a select inside one of them, so both cuts need no list of tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sparkweave.llm.common import row_identity

SPAN = 1 << 16  # offsets of one container
#: Fixed values of the contract.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class ArrayContainer:
    """Few offsets, as a sorted list."""

    def __init__(self, mask: np.ndarray):
        self.values = np.flatnonzero(mask).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.values[k])


class BitmapContainer:
    """Many scattered offsets, one bit each, with the count of bits before each word."""

    def __init__(self, mask: np.ndarray):
        bits = np.zeros(-(-len(mask) // 64) * 64, dtype=bool)
        bits[: len(mask)] = mask
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - self.before[word]])


class RunContainer:
    """Long runs of consecutive offsets, as begins and the count of offsets before each run."""

    def __init__(self, mask: np.ndarray):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
        self.begins = edges[::2].astype(np.uint16)
        self.before = np.concatenate([[0], np.cumsum(edges[1::2] - edges[::2])])

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.begins[run]) + k - int(self.before[run])


def container(mask: np.ndarray):
    """The container of least size for the set offsets of one span."""
    runs = int(np.count_nonzero(mask[1:] > mask[:-1])) + int(mask[:1].sum())
    array, bitmap, run = 2 * int(mask.sum()), SPAN // 8, 4 * runs
    if run < min(array, bitmap):
        return RunContainer(mask)
    return ArrayContainer(mask) if array <= bitmap else BitmapContainer(mask)


class BoundarySet:
    """Offset 0 and the end of every token of a text; a token is a run of letters A-Z, a-z or any other code point."""

    def __init__(self, text: str):
        self.containers, counts, letter_before = [], [], False
        for low in range(0, len(text) + 1, SPAN):
            code = np.frombuffer(text[low : low + SPAN].encode("utf-32-le"), dtype="<u4")
            letter = ((code | 32) - 97) < 26
            before = np.concatenate([[letter_before], letter])
            mask = ~(before[:-1] & letter)  # an offset between two letters is no boundary
            if low + SPAN > len(text):
                mask = np.append(mask, True)  # the end of the text
            letter_before = bool(before[-1])
            if low == 0:
                mask[0] = True
            self.containers.append(container(mask))
            counts.append(int(np.count_nonzero(mask)))
        self.before = np.concatenate([[0], np.cumsum(counts)])

    @property
    def tokens(self) -> int:
        return int(self.before[-1]) - 1

    def select(self, k: int) -> int:
        """The offset after ``k`` tokens."""
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return at * SPAN + self.containers[at].select(k - int(self.before[at]))


@F.arrow_udf(StructType([StructField(c, LongType()) for c in ("n", "low", "high")]))
def cuts(texts: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    """Number of tokens, and the offsets after ``first`` and ``second`` modulo one more than that, the smaller one first."""
    n, low, high = [], [], []
    for text, a, b in zip(texts, first, second):
        found = BoundarySet(text.as_py() or "")
        m = found.tokens
        ends = sorted((a.as_py() % (m + 1), b.as_py() % (m + 1)))
        n.append(m)
        low.append(found.select(ends[0]))
        high.append(found.select(ends[1]))
    columns = [pa.array(x, pa.int64()) for x in (n, low, high)]
    return pa.StructArray.from_arrays(columns, names=["n", "low", "high"])


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = "1", plain_percent: int = 10, spm_percent: int = 20
) -> DataFrame:
    """``_id, _print, text, n, form, prefix_chars, middle_chars, output``, one row per row of ``docs``.

    Each text is cut twice at token boundaries drawn by the hash of its id. ``output`` is the text (form ``plain``), or
    its parts after their marks: ``psm`` has prefix, suffix, middle, ``spm`` suffix, prefix, middle. ``restored`` gives
    the text back. Draws depend on ``seed`` and the id only, so retries and reruns agree.

    Defined cases: null text counts as empty, and empty text or one that holds a mark stays plain; a null id draws as
    an empty one; equal rows give equal rows, one text under two ids is cut twice; texts of any length are read whole,
    in spans of ``SPAN`` code points; an empty table gives no rows. Only the named columns are read. Nothing is shuffled.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    whole = F.coalesce(F.col(text), F.lit(""))
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"_h{i + 1}") for i in range(4)]
    drawn = docs.select(*row_identity(F.col(doc_id), whole), whole.alias("text"), *draws)
    cut = drawn.withColumn("_c", cuts("text", "_h1", "_h2"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (F.col("_h3") % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("_h4") % 100 < spm_percent, "spm").otherwise("psm")
    low, high = F.col("_c.low").cast("int"), F.col("_c.high").cast("int")
    prefix = F.substring("text", F.lit(1), low)
    middle = F.substring("text", low + 1, high - low)
    suffix = F.substring("text", high + 1, F.char_length("text"))
    formed = cut.withColumn("form", form)
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    cut_only = F.col("form") != "plain"
    return formed.select(
        "_id", "_print", "text", F.col("_c.n").alias("n"), "form",
        F.when(cut_only, F.col("_c.low")).alias("prefix_chars"), F.when(cut_only, F.col("_c.high") - F.col("_c.low")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text rebuilt from an output and its form alone; a text with marks of its own is never cut, so they part it exactly."""
    parts = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .otherwise(F.concat(parts[2], parts[3], parts[1]))
    )
