"""Joins Spark has no single operator for, and guards for the ones it has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkweave.operators.ordered import running_totals
from sparkweave.sources.files import stored


def bytes_of(df: DataFrame) -> int:
    """Bytes of the values of a flat frame, with 32 more per row; counted, not estimated."""
    width = F.lit(32).cast("bigint")
    for name, kind in df.dtypes:
        width = width + (F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) if kind in ("string", "binary") else F.lit(16))
    return df.agg(F.sum(width)).first()[0] or 0


def broadcast_checked(df: DataFrame, limit: int = 32 << 20) -> DataFrame:
    """Broadcast hint only for a side counted to be within ``limit`` bytes; else the join keeps its shuffle."""
    return F.broadcast(df) if bytes_of(df) <= limit else df


BLOCK_ROWS = 10_000


def block_join(left: DataFrame, right: DataFrame, on: Column | None = None, limit: int = 32 << 20) -> DataFrame:
    """Every combination of two tables for which ``on`` holds (all without it), as an equi join of blocks.

    Both sides are cut into blocks by row hash and each block meets each other one in a task of its own, so neither side
    need be small; a right side within ``limit`` bytes is one block that goes to every task instead.
    """
    if bytes_of(right) <= limit:
        near, far = left.withColumn("_b", F.lit(0)), F.broadcast(right.withColumn("_c", F.lit(0)))
        same = F.col("_b") == F.col("_c")
    else:
        rows, cols = (max(1, -(-side.count() // BLOCK_ROWS)) for side in (left, right))
        own = lambda df, n: F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int")
        near = left.withColumn("_b", own(left, rows)).withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
        far = right.withColumn("_c", own(right, cols)).withColumn("_p", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
        same = (F.col("_b") == F.col("_p")) & (F.col("_o") == F.col("_c"))
    return near.join(far, same if on is None else same & on).select(*left.columns, *right.columns)


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """SQL ``NOT IN``: no row at all if the other side holds a null.

    The planner's null-aware anti join ships the whole other side to every executor. This
    form is a shuffled anti join plus two single-value facts about the other side.
    """
    values = other.select(F.col(other_key).alias("_v"))
    facts = values.agg(F.count_if(F.col("_v").isNull()).alias("nulls"), F.count(F.lit(1)).alias("rows"))
    nulls, rows = facts.select("nulls").scalar(), facts.select("rows").scalar()
    kept = df.join(values.filter(F.col("_v").isNotNull()).distinct(), F.col(key) == F.col("_v"), "left_anti")
    return kept.filter((nulls == 0) & (F.col(key).isNotNull() | (rows == 0)))


ROWS_PER_TASK = 1_000_000


SAMPLED = 64


def measured_salts(df: DataFrame, keys: Sequence[str], sample_by: Column | None = None) -> int:
    """How many tasks the hottest key needs at ``ROWS_PER_TASK`` rows each.

    One counting pass over the keys; with ``sample_by`` only one row in ``SAMPLED``, by hash, is counted.
    """
    rows, times = (df, 1) if sample_by is None else (df.filter(F.pmod(F.xxhash64(sample_by), F.lit(SAMPLED)) == 0), SAMPLED)
    most = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    return salts_for(most * times)


def salts_for(most: int) -> int:
    return -(-most // ROWS_PER_TASK)


def salted_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], salt_from: Column, salts: int | None = None, how: str = "inner"
) -> DataFrame:
    """Equi join whose hot keys are spread over ``salts`` tasks; by default as many as the hottest key needs.

    Rows of ``big`` get a salt from ``salt_from`` (a value that varies inside a key); each row
    of ``small`` is copied once per salt. ``how`` may be inner, left or left_semi.
    """
    salts = salts or measured_salts(big, keys, salt_from)
    left = big.withColumn("_salt", F.pmod(F.xxhash64(salt_from), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def range_lookup(
    points: DataFrame, ranges: DataFrame, value: str, low: str, high: str, width: float, how: str = "left"
) -> DataFrame:
    """Join points to ranges with ``low <= value < high`` through an equi join on bins of ``width``."""
    cut = ranges.withColumn(
        "_bin",
        F.explode(
            F.sequence(
                F.floor(F.col(low) / width).cast("bigint"), (F.ceil(F.col(high) / width) - 1).cast("bigint")
            )
        ),
    )
    p = points.withColumn("_bin", F.floor(F.col(value) / width).cast("bigint")).alias("p")
    r = cut.alias("r")
    on = (F.col("p._bin") == F.col("r._bin")) & (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))
    return p.join(r, on, how).drop("_bin")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which null keys match each other."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def counts_below(
    points: DataFrame, asks: DataFrame, keys: Sequence[str], value: str, bin_width: Column | float, inclusive: bool,
    name: str,
) -> DataFrame:
    """For each row of ``asks``: how many ``points`` of its key lie below ``value`` (or at it).

    This answers ``count(*)`` of an inequality join by one ordered pass instead of the join.
    Both frames carry ``keys`` and a numeric ``value`` column.
    """
    first, second = (0, 1) if inclusive else (1, 0)
    # equal values collapse on both sides before any ordering
    p = points.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_one")).withColumn("_tag", F.lit(first))
    a = asks.select(*keys, value).distinct().withColumns({"_one": F.lit(0).cast("bigint"), "_tag": F.lit(second)})
    both = p.unionByName(a).withColumn("_bin", F.floor(F.col(value) / bin_width))
    out = running_totals(both, keys, [F.col(value).asc(), F.col("_tag").asc()], "_bin", {name: F.col("_one")})
    return join_null_safe(asks, out.filter(F.col("_tag") == second).select(*keys, value, name), [*keys, value])


def overlap_counts(intervals: DataFrame, keys: Sequence[str], start: str, end: str, bin_width: float) -> DataFrame:
    """Number of other intervals of the key that overlap each one (``s1 < e2 and e1 > s2``).

    Others that start before my end, less those that ended by my start, less myself.
    Requires ``start < end``.
    """
    rest = intervals.columns
    edges = F.array(
        F.struct(F.col(start).alias("_x"), F.lit(1).alias("_s"), F.lit(0).alias("_e")),
        F.struct(F.col(end).alias("_x"), F.lit(0).alias("_s"), F.lit(1).alias("_e")),
    )
    # equal instants of a key collapse, so one running pass over distinct instants answers both counts
    points = intervals.select(*keys, F.inline(edges)).groupBy(*keys, "_x").agg(F.sum("_s").alias("_s"), F.sum("_e").alias("_e"))
    points = points.withColumn("_bin", F.floor(F.col("_x") / bin_width))
    run = running_totals(points, keys, [F.col("_x").asc()], "_bin", {"_starts": F.col("_s"), "_ends": F.col("_e")})
    begun = run.select(*keys, F.col("_x").alias(end), (F.col("_starts") - F.col("_s")).alias("_begun"))
    over = run.select(*keys, F.col("_x").alias(start), F.col("_ends").alias("_over"))
    both = join_null_safe(join_null_safe(intervals, begun, [*keys, end]), over, [*keys, start])
    return both.select(*rest, (F.col("_begun") - F.col("_over") - 1).alias("overlaps"))


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    fact_time: str,
    version_time: str,
    fields: Sequence[str],
    bin_of,
) -> DataFrame:
    """Each fact with the fields of its key's latest version at or before the fact's time.

    ``bin_of`` maps a time column to a bin that rises with time (for example the month).
    Versions and facts meet in one ordered pass per key and bin; the state at the start of a
    bin joins it as one more row ahead of the others. One version per key and time.
    """
    fact_cols = [c for c in facts.columns if c not in keys]
    v = versions.select(
        *keys, F.col(version_time).alias("_t"), F.lit(1).alias("_tag"), F.struct(*fields).alias("_v")
    )
    f = facts.select(*keys, F.col(fact_time).alias("_t"), F.lit(2).alias("_tag"), F.struct(*fact_cols).alias("_f"))
    both = v.unionByName(f, allowMissingColumns=True).withColumn("_bin", bin_of(F.col("_t")))
    ends = both.groupBy(*keys, "_bin").agg(
        F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_t"))).alias("_end")
    )
    earlier = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(*keys, "_bin", F.last("_end", ignorenulls=True).over(earlier).alias("_v"), F.lit(0).alias("_tag"))
    everything = both.unionByName(starts, allowMissingColumns=True)
    first = F.when(F.col("_tag") == 0, 0).otherwise(1)
    local = Window.partitionBy(*keys, "_bin").orderBy(first, "_t", "_tag").rowsBetween(Window.unboundedPreceding, 0)
    out = everything.withColumn("_v", F.last("_v", ignorenulls=True).over(local)).filter(F.col("_tag") == 2)
    return out.select(*keys, "_f.*", *[F.col("_v").getField(c).alias(c) for c in fields])


def latest_per_author_timeline(
    follows: DataFrame, posts: DataFrame, n: int, heavy_followers: int | None = None
) -> DataFrame:
    """Newest ``n`` posts of the followed accounts per reader.

    ``follows(reader, author)``, ``posts(author, post_id, at)``. A reader's newest ``n`` posts are
    among the newest ``n`` of each author, so posts are cut to that first. With ``heavy_followers``
    the authors above that follower count take the salted path, the others the plain one.
    """
    newest = [F.col("at").desc(), F.col("post_id").desc()]
    per_author = Window.partitionBy("author").orderBy(*newest)
    recent = posts.withColumn("_r", F.row_number().over(per_author)).filter(F.col("_r") <= n).drop("_r")
    if heavy_followers is None:
        fed = follows.join(recent, "author")
    else:
        # one pass counts followers; the largest count tells the salts, too
        sizes = stored(follows.groupBy("author").agg(F.count(F.lit(1)).alias("_n")), "followers")
        salts = salts_for(sizes.agg(F.max("_n")).first()[0] or 1)
        heavy = sizes.filter(F.col("_n") > heavy_followers).select("author")
        light = salted_join(follows, heavy.withColumn("_h", F.lit(True)), ["author"], F.col("reader"), salts, how="left")
        pushed = light.filter(F.col("_h").isNull()).drop("_h").join(recent, "author")
        pulled = salted_join(
            light.filter(F.col("_h")).drop("_h"), recent, ["author"], F.col("reader"), salts
        )
        fed = pushed.unionByName(pulled)
    per_reader = Window.partitionBy("reader").orderBy(*newest)
    return fed.withColumn("position", F.row_number().over(per_reader)).filter(F.col("position") <= n)
