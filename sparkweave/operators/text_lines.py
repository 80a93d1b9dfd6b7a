"""Search over text lines held as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkweave.operators.ordered import running_totals


def matches(
    line: str,
    pattern: str,
    ignore_case: bool = False,
    invert: bool = False,
    whole_word: bool = False,
    whole_line: bool = False,
) -> Column:
    """Condition that a line matches, with the usual line-search options."""
    if whole_word:
        pattern = rf"(?<![A-Za-z0-9_])({pattern})(?![A-Za-z0-9_])"
    if whole_line:
        pattern = rf"\A({pattern})\z"
    if ignore_case:
        pattern = f"(?iu){pattern}"
    hit = F.col(line).rlike(pattern)
    return ~hit if invert else hit


def lines_of(df: DataFrame, text: str, *keep: str, width: int = 2000) -> DataFrame:
    """One row per line: kept columns, ``line_no`` from 1, ``line``, and ``line_bin`` for ordered work."""
    out = df.select(*keep, F.posexplode(F.split(text, "\n")).alias("_i", "line"))
    return out.select(
        *keep, (F.col("_i") + 1).cast("bigint").alias("line_no"), "line", F.floor(F.col("_i") / width).alias("line_bin")
    )


def with_context(
    lines: DataFrame, keys: Sequence[str], hit: Column, before: int, after: int, width: int = 2000
) -> DataFrame:
    """Matching lines and their neighbours; ``is_match`` tells them apart.

    Every match marks the line numbers around it, so no ordering of whole files is needed.
    """
    marked = lines.filter(hit).select(
        *keys, F.explode(F.sequence(F.col("line_no") - before, F.col("line_no") + after)).alias("line_no")
    ).distinct()
    return lines.withColumn("is_match", hit).join(marked, [*keys, "line_no"], "left_semi")


def between_markers(lines: DataFrame, keys: Sequence[str], start: Column, end: Column) -> DataFrame:
    """Lines from a start marker through the next end marker, again and again per file.

    Without a closing line a block runs to the end of the file; a line that matches both
    markers is a block of its own. Starts inside an open block do not nest.
    """
    flagged = lines.withColumn("_s", start).withColumn("_e", end.cast("int"))
    # the number of end lines before a line splits the file into stretches that close with an
    # end line; a stretch is inside from its first start line on
    counted = running_totals(flagged, keys, [F.col("line_no").asc()], "line_bin", {"_seen": F.col("_e")})
    stretches = counted.withColumn("_stretch", F.col("_seen") - F.col("_e"))
    first = stretches.filter("_s").groupBy(*keys, "_stretch").agg(F.min("line_no").alias("_from"))
    inside = stretches.join(first, [*keys, "_stretch"]).filter(F.col("line_no") >= F.col("_from"))
    return inside.select(*lines.columns)
