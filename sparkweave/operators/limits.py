"""Rate limits and time-bounded duplicate removal over event tables.

State that runs through a key is cut where it is known whatever came before. Runs that stay long, those of a key that is
busy all the time, are worked on in bins like running totals; short ones stream through one state at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sparkweave.operators.ordered import least_before, number_rows, previous_of_key, running_totals
from sparkweave.sources.files import stored

LONG = 200_000  # rows of a run beyond which it is worked on in bins
BIN = 20_000  # rows of a bin of a long run
TURNS = 12  # times a long run may fill its bucket up again before its rest streams through one state


def bursts(df: DataFrame, keys: Sequence[str], at: str, gap: float, order: Sequence[str], bin_col: str) -> DataFrame:
    """Add ``burst``: the number of the run of records with no gap of ``gap`` or more between them.

    State that an idle gap resets can be kept per (key, burst), so a busy key is cut into many groups.
    """
    p = previous_of_key(df, keys, [F.col(c) for c in order], bin_col, [at])
    opens = F.coalesce((F.col(at) - F.col(f"prev_{at}") >= gap).cast("bigint"), F.lit(0))
    out = running_totals(p, keys, [F.col(c) for c in order], bin_col, {"burst": opens})
    return out.drop(f"prev_{at}", "burst_all")


def _parted(runs: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows of short runs, and of long ones if there are any."""
    runs = stored(runs, "runs")
    long = stored(runs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > LONG).select(*keys), "long-runs")
    if long.isEmpty():
        return runs, None
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    named = long.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return runs.join(named, same, "left_anti"), runs.join(named, same, "left_semi")


def token_bucket(df: DataFrame, key: str, at: str, row_id: str, capacity: int, refill: int, bin_col: str) -> DataFrame:
    """``key, row_id, allowed, tokens`` after each request; a request costs one token, and one comes back every ``refill`` units of ``at``.

    ``at`` is an integer time, so the result is exact. Short keys stream through one state at a time. A key of more than
    ``LONG`` requests is cut into runs where the bucket is full whatever came before (see ``_fullest``). From a full bucket
    on, the number of requests refused follows from a running minimum alone, until the bucket is full again. So a long run
    is two ordered passes over bins, and another turn from the request at which it was full. What is still long after
    ``TURNS`` turns, and short runs, stream.
    """

    def take(state, now):
        # what is in the bucket, in units of time
        held, last = state if state else (capacity * refill, now)
        held = min(capacity * refill, held + now - last)
        ok = held >= refill
        held -= refill if ok else 0
        return (held, now), (ok, held / refill)

    def streamed(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
        return _scan_in_order(rows, keys, order, [at, row_id], at, take, {"allowed": "boolean", "tokens": "double"})

    short, long = _parted(df.select(key, at, row_id, bin_col), [key])
    out = [streamed(short, [key], [at, row_id])]
    if long is not None:
        i = number_rows(long, [key], [F.col(at), F.col(row_id)], bin_col, "_i").drop("_i_all", bin_col)
        # the time of a request less what the ones before it cost
        i = stored(i.withColumns({"_v": F.col(at) - F.col("_i") * refill, "_bin": F.floor(F.col("_i") / BIN)}), "numbered")
        full = _fullest(i, key, (capacity - 1) * refill)
        runs = running_totals(full, [key], [F.col("_i")], "_bin", {"_run": F.col("_full").cast("bigint")}).drop("_full", "_run_all")
        short, rest = _parted(runs, [key, "_run"])
        out.append(streamed(short, [key, "_run"], ["_i"]))
        for _ in range(TURNS):
            if rest is None:
                break
            done, rest = _from_full(rest, key, at, refill, capacity)
            out.append(done)
        if rest is not None:
            out.append(streamed(rest, [key, "_run"], ["_i"]))
    return reduce(DataFrame.unionByName, [x.select(key, row_id, "allowed", "tokens") for x in out])


def _fullest(rows: DataFrame, key: str, room: int) -> DataFrame:
    """Add ``_full``: the bucket is full at this request whatever came before, so a run begins.

    The latest instant at which the bucket can be full, less the cost of the requests so far, is held between ``_v`` and
    ``_v + room`` by every request. Such bounds of a whole bin are one pair of bounds, and pairs combine in order: one row
    for a bin of ``BIN`` requests tells what each bin begins with, and bins are then gone through side by side.
    """
    kind = rows.schema[key].dataType.simpleString()

    def bounds(pdf: pd.DataFrame) -> pd.DataFrame:
        low, high = None, None
        for v in pdf.sort_values("_i")["_v"]:
            low, high = (v, v + room) if low is None else (min(max(low, v), v + room), min(max(high, v), v + room))
        return pd.DataFrame({key: pdf[key].iloc[:1], "_bin": pdf["_bin"].iloc[:1], "_lo": [low], "_hi": [high]})

    def begins(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, at, out = pdf.sort_values("_bin").reset_index(drop=True), None, []
        for low, high in zip(pdf["_lo"], pdf["_hi"]):
            out.append(at)
            at = low if at is None else min(max(at, low), high)  # a bucket is full at first
        return pd.DataFrame({key: pdf[key], "_bin": pdf["_bin"], "_at": pd.array(out, dtype="Int64")})

    def marks(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, full = pdf.sort_values("_i").reset_index(drop=True), []
        at = None if pd.isna(pdf["_at"][0]) else int(pdf["_at"][0])
        for v in pdf["_v"]:
            full.append(at is None or at <= v)
            at = v if at is None else min(max(at, v), v + room)
        return pdf.drop(columns="_at").assign(_full=full)

    pairs = rows.select(key, "_bin", "_i", "_v").groupBy(key, "_bin").applyInPandas(bounds, f"`{key}` {kind}, _bin bigint, _lo bigint, _hi bigint")
    first = stored(pairs.groupBy(key).applyInPandas(begins, f"`{key}` {kind}, _bin bigint, _at bigint"), "bin-begins")
    named = first.withColumnsRenamed({key: "_k", "_bin": "_b"})
    both = rows.join(named, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_bin") == F.col("_b"))).drop("_k", "_b")
    schema = ", ".join(f"`{c}` {k}" for c, k in rows.dtypes)
    return both.groupBy(key, "_bin").applyInPandas(marks, f"{schema}, _full boolean")


def _from_full(rows: DataFrame, key: str, at: str, refill: int, capacity: int) -> tuple[DataFrame, DataFrame | None]:
    """The requests of runs that begin with a full bucket, up to where it is full again, and those from there on."""
    run = [key, "_run"]
    first = rows.groupBy(*run).agg(F.min(F.struct("_i", at, "_v")).alias("_s")).withColumnsRenamed({k: f"_k_{k}" for k in run})
    same = F.col(key).eqNullSafe(F.col(f"_k_{key}")) & (F.col("_run") == F.col("_k__run"))
    low = least_before(rows, run, [F.col("_i")], "_bin", "_v", "_low")
    x = low.join(first, same).drop(*[f"_k_{k}" for k in run])

    def refused(least: Column) -> Column:
        over = least - F.col("_s._v") + (capacity - 1) * refill
        return F.greatest(-((over - F.pmod(over, F.lit(refill))) / refill).cast("bigint"), F.lit(0))

    n = F.col("_i") - F.col("_s._i")
    x = x.withColumns({
        "_before": F.when(F.col("_low").isNull(), F.lit(0)).otherwise(refused(F.col("_low"))), "_after": refused(F.least("_low", "_v")),
    })
    # the instant at which the bucket is full if no request comes
    x = x.withColumns({
        "_again": (n > 0) & (F.col(f"_s.{at}") + (n - F.col("_before")) * refill < F.col(at)),
        "_full_at": F.col(f"_s.{at}") + (n + 1 - F.col("_after")) * refill,
    })
    x = stored(x, "bucket-turn")
    again = x.filter("_again").groupBy(*run).agg(F.min("_i").alias("_from")).withColumnsRenamed({k: f"_k_{k}" for k in run})
    y = x.join(again, same, "left").drop(*[f"_k_{k}" for k in run])
    over = F.coalesce(F.col("_i") >= F.col("_from"), F.lit(False))
    tokens = (capacity * refill - F.greatest(F.col("_full_at") - F.col(at), F.lit(0))) / refill
    done = y.filter(~over).withColumns({"allowed": F.col("_after") == F.col("_before"), "tokens": tokens.cast("double")})
    rest = stored(y.filter(over).select(*rows.columns), "bucket-rest")
    return done, None if rest.isEmpty() else rest


def _scan_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str], at: str, step, out: dict[str, str]) -> DataFrame:
    """Add the ``out`` columns by ``step(state, at) -> (state, values)``, per key and in the order of ``order``.

    Rows stream through sorted partitions, so only one state is held, never a group.
    """
    cols = [*dict.fromkeys([*keys, *order, *keep])]
    ordered = df.select(*cols).repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for pdf in batches:
            rows = []
            named = [pdf[k].astype(object).where(pdf[k].notna(), None) for k in keys]  # a null key is one key
            for ids, now in zip(zip(*named), pdf[at]):
                if ids != current:
                    current, state = ids, None
                state, values = step(state, now)
                rows.append(values)
            yield pdf.assign(**{n: [r[i] for r in rows] for i, n in enumerate(out)})

    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols] + [f"{n} {k}" for n, k in out.items()])
    return ordered.mapInPandas(run, schema)


def first_in_span(df: DataFrame, key: str, at: str, row_id: str, span: float, bin_col: str) -> DataFrame:
    """Keep a record unless one with the same key was kept less than ``span`` before it: ``key, row_id``.

    The span starts anew at each kept record. Short keys stream through one state at a time. A key of more than ``LONG``
    records is cut at gaps of a span, after which a record is kept whatever came before. In runs that are still long
    every record points to the first one a span or more after it; pointers are doubled until the ways from the
    first record are known, so a busy key costs a logarithmic number of joins.
    """
    def keep(kept_at, now):
        ok = kept_at is None or now - kept_at >= span
        return (now if ok else kept_at), (ok,)

    def streamed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        return _scan_in_order(rows, keys, [at, row_id], [], at, keep, {"kept": "boolean"}).filter("kept").select(key, row_id)

    short, long = _parted(df.select(key, at, row_id, bin_col), [key])
    out = [streamed(short, [key])]
    if long is not None:
        short, long = _parted(bursts(long, [key], at, span, [at, row_id], bin_col).withColumnRenamed("burst", "_run"), [key, "_run"])
        out.append(streamed(short, [key, "_run"]))
        if long is not None:
            out.append(_kept_of_long(long, [key, "_run"], at, row_id, span, bin_col).select(key, row_id))
    return reduce(DataFrame.unionByName, out)


def _kept_of_long(rows: DataFrame, run: Sequence[str], at: str, row_id: str, span: float, bin_col: str) -> DataFrame:
    """The kept records of long runs, by pointers from each record to the first one at least a span later."""
    n = number_rows(rows, run, [F.col(at), F.col(row_id)], bin_col, "_i").drop("_i_all")
    n = stored(n.withColumn("_next_at", F.col(at) + span), "numbered")
    # one pass: records and the instants they ask for, in order; the next record is one more than those before the instant
    asks = n.select(*run, F.col("_next_at").alias("_x"), F.lit(0).alias("_t"), F.lit(0).cast("bigint").alias("_one"), F.col("_i").alias("_ask"))
    points = n.select(*run, F.col(at).alias("_x"), F.lit(1).alias("_t"), F.lit(1).cast("bigint").alias("_one"), F.lit(None).cast("bigint").alias("_ask"))
    both = asks.unionByName(points).withColumn("_b", F.floor(F.col("_x") / (span / 64)))
    told = running_totals(both, run, [F.col("_x"), F.col("_t")], "_b", {"_before": F.col("_one")})
    jump = told.filter("_ask IS NOT NULL").select(*run, F.col("_ask").alias("_i"), (F.col("_before") + 1).alias("_to"), F.col("_before_all").alias("_last"))
    jump = stored(jump.filter("_to <= _last").drop("_last"), "jumps")
    reached = stored(n.filter("_i = 1").select(*run, "_i"), "reached")
    longest = n.groupBy(*run).count().agg(F.max("count")).first()[0] or 1

    def met(left: DataFrame, pointers: DataFrame, on: str, to: str) -> DataFrame:
        p = pointers.select(*[F.col(k).alias(f"_k_{k}") for k in run], F.col("_i").alias("_p"), F.col("_to").alias(to))
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in run]) & (F.col(on) == F.col("_p"))
        return left.join(p, same).drop(*[f"_k_{k}" for k in run], "_p")

    for _ in range(math.ceil(math.log2(longest)) + 1):
        more = met(reached, jump, "_i", "_j").select(*run, F.col("_j").alias("_i"))
        reached = stored(reached.unionByName(more).distinct(), "reached")
        jump = stored(met(jump, jump, "_to", "_j").select(*run, "_i", F.col("_j").alias("_to")), "jumps")
        if jump.isEmpty():
            break
    kept = reached.withColumnsRenamed({k: f"_k_{k}" for k in run}).withColumnRenamed("_i", "_r")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in run]) & (F.col("_i") == F.col("_r"))
    return n.join(kept, same, "left_semi")


def count_within(df: DataFrame, keys: Sequence[str], at: str, back: float, ahead: float, bin_width: float, name: str) -> DataFrame:
    """Number of records of the key from ``back`` before to ``ahead`` after each record, itself included.

    One ordered pass holds the records and both bounds of every instant that asks; equal instants ask once.
    """
    instants = df.groupBy(*keys, at).agg(F.count(F.lit(1)).alias("_n"))
    marks = F.array(
        F.struct((F.col(at) - back).alias("_x"), F.lit(0).alias("_t"), F.lit(0).cast("bigint").alias("_one")),
        F.struct((F.col(at) + F.lit(0)).alias("_x"), F.lit(1).alias("_t"), F.col("_n").alias("_one")),
        F.struct((F.col(at) + ahead).alias("_x"), F.lit(2).alias("_t"), F.lit(0).cast("bigint").alias("_one")),
    )
    line = instants.select(*keys, F.col(at).alias("_at"), F.inline(marks)).withColumn("_bin", F.floor(F.col("_x") / bin_width))
    run = running_totals(line, keys, [F.col("_x"), F.col("_t")], "_bin", {"_upto": F.col("_one")})
    sign = F.when(F.col("_t") == 2, F.col("_upto")).when(F.col("_t") == 0, -F.col("_upto")).otherwise(0)
    counts = run.groupBy(*keys, "_at").agg(F.sum(sign).alias(name)).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col(at).eqNullSafe(F.col("_at"))])
    return df.join(counts, same).select(*df.columns, name)
