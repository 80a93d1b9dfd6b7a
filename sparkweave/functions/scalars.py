"""Column helpers shared by several queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Null instead of an error when the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def out_of_range(rules: Mapping[str, tuple[float, float]]) -> tuple[dict[str, Column], Column]:
    """Columns with out-of-range values set to null, and the list of messages for one row."""
    kept, messages = {}, []
    for name, (low, high) in rules.items():
        inside = F.col(name).between(low, high)
        kept[name] = F.when(inside, F.col(name))
        messages.append(F.when(~inside, F.lit(f"{name} outside [{low}, {high}]")))
    return kept, F.array_compact(F.array(*messages))


def buckets(value: Column, steps: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first step whose upper bound is above ``value``; null stays null."""
    out = None
    for bound, label in steps:
        out = F.when(value < bound, label) if out is None else out.when(value < bound, label)
    return F.when(value.isNotNull(), out.otherwise(top))


def parse_first(text: Column, formats: Sequence[str]) -> Column:
    """Timestamp by the first format that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def surrogate_key(*parts: Column) -> Column:
    """md5 over pipe-joined parts, nulls written as ``null``."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def hash_bucket(key: Column, buckets_: int) -> Column:
    """Bucket that any engine can compute: first 32 bits of md5, modulo ``buckets_``."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(buckets_))


def sql_hash_bucket(key: str, buckets_: int) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT % {buckets_} AS BIGINT)"


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius_km: float = 6372.797560856) -> Column:
    """Great-circle distance; the default radius is the one common geo stores use."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * radius_km) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def first_reason(checks: Sequence[tuple[Column, Column]], default: str = "OK") -> Column:
    """Reason of the first failed check, in order."""
    return F.coalesce(*[F.when(bad, reason) for bad, reason in checks], F.lit(default))
