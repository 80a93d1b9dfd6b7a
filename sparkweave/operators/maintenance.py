"""Keyed table maintenance: upserts, history, change logs, incremental loads.

Every function takes frames and returns the new state, so one write of the result (or of
its touched partitions) is all a job needs. Keys are unique in a state frame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sparkweave.operators.ordered import number_rows
from sparkweave.sources.files import stored_before

OPEN_END = "9999-12-31"  # fixed value: end of a version that is still valid


def _sides(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    t = target.select(*keys, F.struct(*target.columns).alias("t"))
    s = source.select(*keys, F.struct(*source.columns).alias("s"))
    return t.join(s, list(keys), "full")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], keep_first: Sequence[str] = ()) -> DataFrame:
    """New values win, ``keep_first`` columns keep the stored value; ``action`` tells what happened."""
    both = _sides(target, source, keys)
    cols = []
    for c in target.columns:
        if c in keys:
            cols.append(F.col(c))
            continue
        new = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        old = F.col(f"t.{c}")
        if c in keep_first:
            cols.append(F.coalesce(old, new).alias(c))
        else:
            cols.append(F.when(F.col("s").isNotNull(), new).otherwise(old).alias(c))
    action = F.when(F.col("t").isNull(), "inserted").when(F.col("s").isNull(), "kept").otherwise("updated")
    return both.select(*cols, action.alias("action"))


def upsert_add(target: DataFrame, source: DataFrame, keys: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    """Add the amounts of matching keys; the order of loads does not matter."""
    both = target.select(*keys, *amounts).unionByName(source.select(*keys, *amounts))
    return both.groupBy(*keys).agg(*[F.sum(a).alias(a) for a in amounts])


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` join only where the key is new; one row per new key."""
    fresh = source.join(target.select(*keys), list(keys), "left_anti").dropDuplicates(list(keys))
    return target.unionByName(fresh)


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], delete_when: Column, update: Sequence[str]) -> DataFrame:
    """Matched and ``delete_when`` (over ``s.*``): removed. Matched: ``update`` columns change. Else inserted."""
    both = _sides(target, source, keys)
    matched = F.col("t").isNotNull() & F.col("s").isNotNull()
    both = both.filter(~(matched & F.coalesce(delete_when, F.lit(False))))
    cols = []
    for c in target.columns:
        new, old = F.col(f"s.{c}"), F.col(f"t.{c}")
        if c in keys:
            cols.append(F.col(c))
        elif c in update:
            cols.append(F.when(F.col("s").isNotNull(), new).otherwise(old).alias(c))
        else:
            cols.append(F.when(F.col("t").isNotNull(), old).otherwise(new).alias(c))
    return both.select(*cols)


def split_archive(df: DataFrame, move: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, archived): complementary, so each row lands in exactly one of the two."""
    flag = F.coalesce(move, F.lit(False))
    return df.filter(~flag), df.filter(flag)


def assign_keys(df: DataFrame, natural: str, name: str, start: Column | int = 0, width: int = 100_000) -> DataFrame:
    """Dense surrogate keys after ``start`` in the order of an integer natural key."""
    binned = df.withColumn("_bin", F.floor(F.col(natural) / width))
    out = number_rows(binned, [], [F.col(natural)], "_bin", "_rn")
    return out.withColumn(name, F.col("_rn") + start).drop("_bin", "_rn", "_rn_all")


def scd2_apply(dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], effective: str) -> DataFrame:
    """Close changed versions the day before ``effective`` and open new ones.

    ``dim`` has ``sk, <key>, <tracked>, valid_from, valid_to, is_current``; ``incoming`` has one
    row per key. Applying the same rows again changes nothing.
    """
    state = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in tracked]))
    current = dim.filter("is_current").select(key, state.alias("_old"))
    news = incoming.select(key, *tracked, state.alias("_new")).join(current, key, "left")
    changed = news.filter(F.col("_old").isNull() | (F.col("_old") != F.col("_new")))
    expire = changed.filter(F.col("_old").isNotNull()).select(key, F.lit(True).alias("_expire"))
    day = F.lit(effective).cast("date")
    closes = F.col("is_current") & F.coalesce("_expire", F.lit(False))
    closed = dim.join(expire, key, "left").select(
        "sk", key, *tracked, "valid_from",
        F.when(closes, F.date_sub(day, 1)).otherwise(F.col("valid_to")).alias("valid_to"),
        F.when(closes, False).otherwise(F.col("is_current")).alias("is_current"),
    )
    highest = dim.agg(F.coalesce(F.max("sk"), F.lit(0))).scalar()
    opened = assign_keys(changed, key, "sk", highest).select(
        "sk", key, *tracked, day.alias("valid_from"), F.lit(OPEN_END).cast("date").alias("valid_to"), F.lit(True).alias("is_current")
    )
    return closed.unionByName(opened)


def scd3_apply(dim: DataFrame, incoming: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keep the replaced value in ``previous_<attribute>``."""
    new = incoming.select(key, F.col(attribute).alias("_new"))
    changed = F.col("_new").isNotNull() & ~F.col(attribute).eqNullSafe(F.col("_new"))
    prev = f"previous_{attribute}"
    old_prev = F.col(prev) if prev in dim.columns else F.lit(None)
    return (
        dim.join(new, key, "left")
        .withColumn(prev, F.when(changed, F.col(attribute)).otherwise(old_prev))
        .withColumn(attribute, F.coalesce("_new", attribute))
        .drop("_new")
    )


def apply_changes(log: DataFrame, key: str, sequence: str, deleted: Column) -> DataFrame:
    """Last record per key by ``sequence``; keys whose last record is a delete vanish."""
    last = log.groupBy(key).agg(F.max_by(F.struct(*[c for c in log.columns if c != key], deleted.alias("_gone")), sequence).alias("r"))
    return last.filter(~F.col("r._gone")).select(key, "r.*").drop("_gone")


def refresh_changed(stored_view: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Difference between a stored result and its fresh version: ``change`` is insert, update or delete."""
    both = _sides(stored_view, fresh, keys)
    change = (
        F.when(F.col("t").isNull(), "insert").when(F.col("s").isNull(), "delete").when(~F.col("t").eqNullSafe(F.col("s")), "update")
    )
    return both.withColumn("change", change).filter(F.col("change").isNotNull()).select(*keys, "change")


def replace_by_key(target: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the target rows whose key occurs in ``fresh`` and add all of ``fresh``."""
    return target.join(fresh.select(*keys).distinct(), list(keys), "left_anti").unionByName(fresh)


def incremental(target: DataFrame, source: DataFrame, keys: Sequence[str], strategy: str) -> DataFrame:
    """New target state under one of: merge, append, delete+insert."""
    if strategy == "append":
        return target.unionByName(source)
    if strategy == "merge":
        return upsert(target, source, keys).drop("action")
    if strategy == "delete+insert":
        return replace_by_key(target, source, keys)
    raise ValueError(f"unknown strategy {strategy}")


def sync_plan(known: DataFrame, incoming: DataFrame, key: str, content: Sequence[str]) -> DataFrame:
    """INSERT, UPDATE or SKIP per incoming row, by content hash."""
    digest = F.md5(F.to_json(F.struct(*sorted(content))))
    old = known.select(key, digest.alias("_old"))
    new = incoming.select(key, digest.alias("content_hash"))
    step = F.when(F.col("_old").isNull(), "INSERT").when(F.col("_old") != F.col("content_hash"), "UPDATE").otherwise("SKIP")
    return new.join(old, key, "left").select(key, "content_hash", step.alias("step"))


def load_range(
    watermark: dt.date | None, today: dt.date, lookback_days: int = 1, bootstrap_days: int = 7
) -> tuple[dt.date, dt.date]:
    """Days an incremental run reads, both ends included: all since the watermark, however long the pause was."""
    if watermark is None:
        return today - dt.timedelta(days=bootstrap_days - 1), today
    return watermark - dt.timedelta(days=lookback_days), today


def portions(low: dt.date, high: dt.date, days: int = 30) -> list[tuple[dt.date, dt.date]]:
    """A range of days cut into runs of at most ``days``, without gap or overlap, for loads after a long pause."""
    out = []
    while low <= high:
        end = min(high, low + dt.timedelta(days=days - 1))
        out.append((low, end))
        low = end + dt.timedelta(days=1)
    return out


class Watermark:
    """High-water mark of a load, kept as small files next to the table it belongs to."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self) -> dt.date | None:
        marks = stored_before(self.spark, self.folder, "mark date")
        return None if marks is None else marks.agg(F.max("mark")).first()[0]

    def write(self, mark: dt.date) -> None:
        """Call only after the load has succeeded."""
        self.spark.createDataFrame([(mark,)], "mark date").coalesce(1).write.mode("append").parquet(self.folder)


def evolve(df: DataFrame, target_schema, on_change: str = "append") -> DataFrame:
    """Fit a frame to a target schema.

    ``append``: target columns plus new ones at the end; missing ones become null. ``sync``:
    exactly the frame's columns in target order first. ``ignore``: target columns only.
    ``fail``: raise if the column sets differ. Shared columns are cast to the target type.
    """
    have = {f.name: f for f in df.schema.fields}
    want = {f.name: f for f in target_schema.fields}
    new, missing = [c for c in have if c not in want], [c for c in want if c not in have]
    if on_change == "fail" and (new or missing):
        raise ValueError(f"schema changed: new {new}, missing {missing}")
    shared = [F.col(c).cast(want[c].dataType).alias(c) if c in have else F.lit(None).cast(want[c].dataType).alias(c) for c in want
              if c in have or on_change != "sync"]
    extra = [F.col(c) for c in new] if on_change in ("append", "sync") else []
    return df.select(*shared, *extra)


def schema_verdicts(history: DataFrame) -> DataFrame:
    """Compatibility of each schema version with the one before it and with all before it.

    ``history(subject, version, field, type, optional)``, versions counted 1, 2, .. per subject.
    Work is linear in the rows: a field meets only its own earlier and later appearances.
    """
    last = history.groupBy("subject").agg(F.max("version").alias("last"))
    w = Window.partitionBy("subject", "field").orderBy("version")  # a row per version at most
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    h = history.join(last, "subject").select(
        "*",
        F.lag("version").over(w).alias("p"), F.lag("type").over(w).alias("p_type"), F.lead("version").over(w).alias("n"),
        (F.row_number().over(w) - 1).alias("earlier"), F.min("type").over(before).alias("lo"), F.max("type").over(before).alias("hi"),
        F.max((~F.col("optional")).cast("int")).over(w).alias("ever_required"),
    )
    here = h.filter("version > 1")
    typed = (F.col("p") == F.col("version") - 1) & (F.col("p_type") != F.col("type"))
    added_required = F.coalesce(F.col("p") != F.col("version") - 1, F.lit(True)) & ~F.col("optional")
    any_type = F.coalesce((F.col("lo") != F.col("type")) | (F.col("hi") != F.col("type")), F.lit(False))
    not_always = (F.col("earlier") < F.col("version") - 1) & ~F.col("optional")
    typed = F.coalesce(typed, F.lit(False))
    flags = here.select(
        "subject", "version", (typed | added_required).alias("b"), typed.alias("f"), (any_type | not_always).alias("bt"), any_type.alias("ft")
    )
    gap_end = F.coalesce(F.col("n") - 1, F.col("last"))
    gone = h.filter(gap_end > F.col("version")).select(
        "subject", "optional", "ever_required", F.col("version").alias("seen"),
        F.explode(F.sequence(F.col("version") + 1, gap_end)).alias("version"),
    ).select(
        "subject", "version", F.lit(False).alias("b"),
        ((F.col("seen") == F.col("version") - 1) & ~F.col("optional")).alias("f"),
        F.lit(False).alias("bt"), (F.col("ever_required") == 1).alias("ft"),
    )
    bad = flags.unionByName(gone).groupBy("subject", "version").agg(*[F.bool_or(c).alias(c) for c in ("b", "f", "bt", "ft")])
    versions = history.select("subject", "version").distinct().filter("version > 1").join(bad, ["subject", "version"], "left").fillna(False)
    return versions.select(
        "subject", "version", (~F.col("b")).alias("backward"), (~F.col("f")).alias("forward"),
        (~F.col("b") & ~F.col("f")).alias("full"), (~F.col("bt")).alias("backward_transitive"),
        (~F.col("ft")).alias("forward_transitive"), (~F.col("bt") & ~F.col("ft")).alias("full_transitive"),
    )


def expired(partitions: DataFrame, day: str, size: str, oldest: Column, max_size: int) -> DataFrame:
    """Partitions to drop: older than ``oldest``, or beyond ``max_size`` counted from the newest."""
    newest_first = Window.orderBy(F.col(day).desc())  # one row per partition
    total = F.sum(size).over(newest_first)
    return partitions.select("*", total.alias("size_from_newest")).filter((F.col(day) < oldest) | (F.col("size_from_newest") > max_size))


def relay(outbox: DataFrame, out_folder: str, key: str = "id") -> int:
    """Publish the rows not yet published and return how many; a rerun publishes nothing twice.

    The published rows themselves are the processed mark, so publishing and marking are one write.
    """
    spark = outbox.sparkSession
    done = stored_before(spark, out_folder, outbox.schema)
    todo = outbox if done is None else outbox.join(done.select(key), key, "left_anti")
    n = todo.count()
    if n:
        todo.write.mode("append").parquet(out_folder)
    return n
