"""Ordered computations that never need a whole key group in one task.

A plain window puts every row of a key into one task. Here a key is cut into bins that
follow the order (a day, a price band, an id range). Each bin is worked on alone; what
came before it is added from a small table with one row per key and bin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def bin_offsets(
    df: DataFrame, keys: Sequence[str], bin_col: str, measures: Mapping[str, Column], descending: bool = False
) -> DataFrame:
    """Per key and bin: ``<name>_before`` (total of earlier bins) and ``<name>_all`` (total of the key)."""
    totals = df.groupBy(*keys, bin_col).agg(*[m.alias(f"_{n}") for n, m in measures.items()])
    order = F.col(bin_col).desc() if descending else F.col(bin_col).asc()
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = [F.col(k) for k in keys] + [F.col(bin_col)]
    for n in measures:
        out.append(F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"{n}_before"))
        out.append(F.sum(f"_{n}").over(whole).alias(f"{n}_all"))
    return totals.select(*out)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    bin_col: str,
    values: Mapping[str, Column],
    descending: bool = False,
    ties_together: bool = False,
) -> DataFrame:
    """Add a running total per entry of ``values`` (nulls count as zero), and ``<name>_all`` with the key's total.

    ``bin_col`` must rise (or fall, if ``descending``) with ``order``, and equal order keys
    must share a bin. ``ties_together`` gives the RANGE frame instead of the ROWS frame.

    The total of all earlier bins joins each bin as one more row ahead of its own rows, so the
    data moves once, by key and bin, and null keys form a group like any other.
    """
    rows = df.withColumns({f"_v_{n}": F.coalesce(v, F.lit(0)) for n, v in values.items()})
    offsets = bin_offsets(rows, keys, bin_col, {n: F.sum(f"_v_{n}") for n in values}, descending)
    both = rows.withColumn("_own", F.lit(1)).unionByName(offsets.withColumn("_own", F.lit(0)), allowMissingColumns=True)
    bin_rows = Window.partitionBy(*keys, bin_col).orderBy("_own", *order)
    so_far = bin_rows.rowsBetween(Window.unboundedPreceding, 0)
    added = []
    for n in values:
        local = F.sum(f"_v_{n}").over(bin_rows if ties_together else so_far)
        added.append((local + F.first(f"{n}_before").over(so_far)).alias(n))
        added.append(F.first(f"{n}_all").over(so_far).alias(f"{n}_all"))
    kept = [c for c in df.columns if c not in values]
    return both.select(*kept, "_own", *added).filter("_own = 1").drop("_own")


ROWS_PER_BIN = 200_000


def even_bins(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "_bin") -> DataFrame:
    """Add a bin number that rises with ``order`` inside each key, with bins of about ``ROWS_PER_BIN`` rows whatever the values are.

    ``order`` must be total. Bounds are sampled quantiles of keys and order together, so rows that tie in their first order
    column are parted by the next ones. The rows are written once, since a sample may turn out otherwise when it is repeated.
    """
    from sparkweave.sources.files import stored

    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_BIN))
    ranged = df.repartitionByRange(parts, *[F.col(k) for k in keys], *order)
    return stored(ranged.withColumn(name, F.spark_partition_id()), "even-bins")


def least_before(df: DataFrame, keys: Sequence[str], order: Sequence[Column], bin_col: str, value: str, name: str) -> DataFrame:
    """Add ``name``: the least ``value`` of the rows of the key that come before (null for its first row).

    As with running totals, the least of all earlier bins joins a bin as one more row ahead of its own.
    """
    earlier = Window.partitionBy(*keys).orderBy(bin_col).rowsBetween(Window.unboundedPreceding, -1)
    carried = df.groupBy(*keys, bin_col).agg(F.min(value).alias("_m")).select(*keys, bin_col, F.min("_m").over(earlier).alias("_v"))
    both = df.withColumns({"_v": F.col(value), "_own": F.lit(1)}).unionByName(carried.withColumn("_own", F.lit(0)), allowMissingColumns=True)
    rows = Window.partitionBy(*keys, bin_col).orderBy("_own", *order).rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn(name, F.min("_v").over(rows)).filter("_own = 1").select(*df.columns, name)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    bin_col: str,
    name: str = "rn",
    descending: bool = False,
) -> DataFrame:
    """``row_number`` over a total order, plus ``<name>_all`` with the number of rows of the key."""
    return running_totals(df, keys, order, bin_col, {name: F.lit(1).cast("bigint")}, descending)


def value_positions(
    df: DataFrame, keys: Sequence[str], value: str, bin_width: float, descending: bool = False
) -> DataFrame:
    """One row per key and distinct value: ``ties``, ``before``, ``dense_before``, ``total``.

    Every rank-like function and every exact quantile follows from these four counts.
    Equal values collapse before any ordering, so a hot value costs one row.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("ties"))
        .withColumn("_bin", F.floor(F.col(value) / bin_width))
    )
    order = F.col(value).desc() if descending else F.col(value).asc()
    upto = running_totals(counts, keys, [order], "_bin", {"_r": F.col("ties"), "_v": F.lit(1).cast("bigint")}, descending)
    return upto.select(
        *keys, value, "ties", (F.col("_r") - F.col("ties")).alias("before"), (F.col("_v") - 1).alias("dense_before"),
        F.col("_r_all").alias("total"),
    )


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float], bin_width: float
) -> DataFrame:
    """Exact interpolated (``<name>``) and discrete (``<name>_disc``) quantiles per key.

    A histogram by bin tells which bins hold the wanted ranks; only the rows of those few bins are
    ordered. The bin list is written to the shared folder, so that its size decides the join.
    """
    from sparkweave.sources.files import stored

    last = F.col("total") - 1
    ranks = {}  # name -> (low, high, share between them, discrete), all zero-based
    for name, p in probabilities.items():
        spot = last * F.lit(float(p))
        # the discrete form takes the first value whose share of rows reaches p
        ranks[name] = (F.floor(spot), F.ceil(spot), spot - F.floor(spot), F.greatest(F.ceil(F.col("total") * F.lit(float(p))) - 1, F.lit(0)))

    def covers(n, place):
        return (F.col("before") <= place) & (place < F.col("before") + n)

    rows = df.filter(F.col(value).isNotNull()).select(*keys, value).withColumn("_bin", F.floor(F.col(value) / bin_width))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = rows.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, "_bin", "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("before"), F.sum("_n").over(whole).alias("total")
    )
    wanted = F.lit(False)
    for low, high, _, disc in ranks.values():
        wanted = wanted | covers(F.col("_n"), low) | covers(F.col("_n"), high) | covers(F.col("_n"), disc)
    needed = stored(bins.filter(wanted).drop("_n"), "bins").withColumnsRenamed({k: f"_k_{k}" for k in keys}).withColumnRenamed("_bin", "_need")
    on = F.col("_bin") == F.col("_need")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    values = rows.join(needed, on).groupBy(*keys, "_bin", value).agg(
        F.count(F.lit(1)).alias("ties"), F.first("before").alias("_base"), F.first("total").alias("total")
    )
    local = Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    pos = values.withColumn("before", F.col("_base") + F.coalesce(F.sum("ties").over(local), F.lit(0)))
    aggs = []
    for name, (low, high, part, disc) in ranks.items():
        at_low, at_high, at_disc = (F.max(F.when(covers(F.col("ties"), r), F.col(value))) for r in (low, high, disc))
        aggs += [(at_low + (at_high - at_low) * F.max(part)).alias(name), at_disc.alias(f"{name}_disc")]
    return pos.groupBy(*keys).agg(*aggs) if keys else pos.agg(*aggs)


def with_neighbours(
    df: DataFrame, keys: Sequence[str], rn: str, width: int, before: int = 0, after: int = 0
) -> DataFrame:
    """Cut numbered rows into blocks of ``width`` and copy edge rows into the next or previous block.

    A window over ``keys + [_block]`` ordered by ``rn`` then sees ``before`` rows back and
    ``after`` rows ahead of each own row. Keep rows with ``_own`` afterwards.
    """
    if before > width or after > width:
        raise ValueError("block width must cover the frame")
    home = F.floor((F.col(rn) - 1) / width)
    spot = F.pmod(F.col(rn) - 1, F.lit(width))
    blocks = F.array_compact(
        F.array(
            home,
            F.when(spot >= width - before, home + 1) if before else F.lit(None).cast("bigint"),
            F.when(spot < after, home - 1) if after else F.lit(None).cast("bigint"),
        )
    )
    return df.withColumn("_block", F.explode(blocks)).withColumn("_own", F.col("_block") == home)


def previous_of_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], bin_col: str, fields: Sequence[str]
) -> DataFrame:
    """Add ``prev_<field>`` from the preceding row of the key (null for its first row).

    Inside a bin this is a plain ``lag``; the last row of the key's previous non-empty bin joins
    the bin as one more row ahead of its own.
    """
    packed = F.struct(*[F.col(f) for f in fields])
    last = df.groupBy(*keys, bin_col).agg(F.max_by(packed, F.struct(*order)).alias("_last"))
    carried = last.withColumn("_p", F.lag("_last").over(Window.partitionBy(*keys).orderBy(bin_col))).drop("_last")
    both = df.withColumns({"_p": packed, "_own": F.lit(1)}).unionByName(carried.withColumn("_own", F.lit(0)), allowMissingColumns=True)
    before = F.lag("_p").over(Window.partitionBy(*keys, bin_col).orderBy("_own", *order))
    out = both.withColumn("_b", before).filter("_own = 1")
    return out.select(*df.columns, *[F.col("_b").getField(f).alias(f"prev_{f}") for f in fields])
