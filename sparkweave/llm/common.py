"""What the corpus operators share: ASCII words, row identity, checked broadcasts."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Largest table that is broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 32 << 20


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def row_identity(doc_id: Column, text: Column) -> list[Column]:
    """``_id, _print``: equal for rows with equal id and text, so results join back to repeated rows and null ids."""
    return [doc_id.alias("_id"), F.xxhash64(text).alias("_print")]


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_id"]) & (left["_print"] == right["_print"])


def size_in_bytes(df: DataFrame, more: Column | None = None) -> int:
    """Bytes of the values of a frame, with 32 more per row; counted, not estimated. ``more``: width of nested columns."""
    width = F.lit(32).cast("bigint") if more is None else F.lit(32).cast("bigint") + more
    for name, kind in df.dtypes:
        width = width + (F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) if kind in ("string", "binary") else F.lit(16))
    return df.agg(F.sum(width)).first()[0] or 0


def broadcast_within(df: DataFrame, limit: int = BROADCAST_BYTES, more: Column | None = None) -> DataFrame:
    """A broadcast hint if the counted size is within ``limit``; else the frame itself, which is then joined by shuffle.

    Only for frames that are cheap to read twice (stored, or small inputs). Nested columns need ``more``, their width.
    """
    return F.broadcast(df) if size_in_bytes(df, more) <= limit else df


def fold(bucket: Column, of: int) -> Column:
    """``crc32(id as text) mod of``, the fold of a row."""
    return F.crc32(bucket.cast("string").cast("binary")) % of


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body (or a lambda in it) names it.

    A column that a later projection names once may be copied into it by the optimizer, also into a lambda,
    where it would be computed again for every element.
    """
    return F.transform(F.array(value), body)[0]
