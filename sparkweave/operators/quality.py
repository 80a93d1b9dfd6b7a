"""Data-quality rules as frames: failing rows, or one report per pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


class QualityError(RuntimeError):
    """A batch did not reach its pass rate."""


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def not_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    parents = parent.select(F.col(parent_key).alias(key)).distinct()
    return child.filter(F.col(key).isNotNull()).join(parents, key, "left_anti")


def rule_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Failures per rule in one aggregate pass; a rule is a condition that good rows meet."""
    bad = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *bad)
    return wide.unpivot(["rows"], list(rules), "rule", "failures")


def split_by_rules(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined with the names of the broken rules)."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    marked = df.withColumn("broken_rules", broken)
    return marked.filter(F.size("broken_rules") == 0).drop("broken_rules"), marked.filter(F.size("broken_rules") > 0)


def first_arrival(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The first row per business key by an explicit arrival column; keeps no group in memory."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), arrival).alias("_r")).select(*keys, "_r.*")


def gate(passed: int, total: int, minimum_pct: float = 80.0) -> float:
    """Pass rate in percent; raises below the minimum."""
    rate = passed * 100.0 / total if total else 0.0
    if rate < minimum_pct:
        raise QualityError(f"pass rate {rate:.1f}% is below {minimum_pct}%")
    return rate
