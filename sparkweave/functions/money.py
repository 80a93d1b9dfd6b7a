"""Exact totals of decimal amounts held as DOUBLE.

A sum of doubles depends on the order of its rows, hence on the partitioning. Totals are therefore taken over whole
units of the last decimal place, as two BIGINT sums: of the upper bits of each amount and of its lower 20 bits. A
single BIGINT sum would overflow at some ten billion rows of a group; these last a million times longer. The result is
the same for every plan and stays in generated code; below 2**53 units it is exact, beyond that the nearest double.

Amounts are rounded to ``places`` decimals first, half away from zero. Amounts with more decimals lose them, in the
check texts as well.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SHIFT = 20


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def units(c, places: int = 2) -> Column:
    return F.round(_col(c) * float(10**places)).cast("bigint")


def _sum(c, places: int, over=lambda s: s) -> Column:
    u = units(c, places)
    high, low = F.sum(F.shiftright(u, SHIFT)), F.sum(u.bitwiseAND(F.lit((1 << SHIFT) - 1)))
    return over(high).cast("double") * float(1 << SHIFT) + over(low)


def total(c, places: int = 2) -> Column:
    """Sum of ``c`` to ``places`` decimals."""
    return _sum(c, places) / F.lit(float(10**places))


def mean(c, places: int = 2) -> Column:
    """Average of the non-null values of ``c``."""
    return total(c, places) / F.count(_col(c))


def total_over(c, window, places: int = 2) -> Column:
    return _sum(c, places, lambda s: s.over(window)) / F.lit(float(10**places))


def sql_units(c: str, places: int = 2) -> str:
    return f"CAST(round(({c}) * 1e{places}) AS BIGINT)"


def sql_total(c: str, places: int = 2) -> str:
    return f"(CAST(sum({sql_units(c, places)}) AS BIGINT) / 1e{places})"


def sql_mean(c: str, places: int = 2) -> str:
    return f"({sql_total(c, places)} / count({c}))"
