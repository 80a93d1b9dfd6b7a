"""Quality rules: fixed limits, and a robust multivariate outlier test per language and source."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkweave.llm.common import BLANK, WORD, broadcast_within, row_identity
from sparkweave.sources.files import stored

#: Features of the outlier test and the least spread each is credited with, on its transformed scale.
FLOORS = {"word_length": 0.15, "symbols": 0.03, "capitals": 0.06, "dup_lines": 0.1, "repeats": 0.12}
UNIT = 1_000_000  # features are summed as whole millionths, so totals do not depend on the order of rows
PRIOR_WORDS = 50  # short texts are drawn towards a typical text by so many words
MIN_GROUP = 60
SUBSET = 0.75
SETTLED = 1e-6  # a concentration step that lowers no log determinant by more ends them
REJECT = 1e-5


# -- base statistics

def base_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``_id, _print, _lang, _source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper``.

    Words are runs without ASCII white space. ``n_repeat_words`` counts words inside five-word windows that
    occur at least twice in the text. Null text counts as empty.
    """
    text = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(*row_identity(F.col(doc_id), text), F.col(lang).cast("string").alias("_lang"), F.col(source).cast("string").alias("_source"), text.alias("_t"))
    lines = F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(WORD))
    # word and line lists are columns of their own, so that each is built once
    lists = base.withColumns({"_w": F.array_remove(F.split("_t", f"{BLANK}+"), ""), "_l": lines})
    hashed = lists.select(
        "_id", "_print", "_lang", "_source",
        F.size("_w").cast("bigint").alias("n_words"),
        (F.char_length("_t") - F.regexp_count("_t", F.lit(BLANK))).cast("bigint").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count("_t", F.lit(r"\p{Lu}")).cast("bigint").alias("n_upper"),
        F.size("_l").cast("bigint").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        F.expr(
            "CASE WHEN size(_w) < 6 THEN cast(array() AS array<bigint>) "
            "ELSE transform(sequence(1, size(_w) - 4), i -> xxhash64(slice(_w, i, 5))) END"
        ).alias("_h"),
    )
    # only texts in which a window repeats sort their windows; equal neighbours are the repeats
    ordered = hashed.withColumn("_s", F.expr(
        "CASE WHEN size(array_distinct(_h)) < size(_h) THEN array_sort(transform(_h, (h, i) -> struct(h, i))) END"
    )).drop("_h")
    repeats = ordered.withColumn("_at", F.expr(
        """array_sort(transform(filter(_s, (x, i) -> (i > 0 AND get(_s, i - 1).h = x.h) OR (i < size(_s) - 1 AND get(_s, i + 1).h = x.h)),
           x -> x.i))"""
    )).drop("_s")
    covered = F.expr(
        """aggregate(_at, struct(cast(-1 AS bigint) AS last, cast(0 AS bigint) AS n),
           (acc, p) -> struct(cast(p + 4 AS bigint) AS last, acc.n + least(5, p + 4 - acc.last) AS n), acc -> acc.n)"""
    )
    return repeats.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))).drop("_at")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features() -> dict[str, Column]:
    """The statistic vector: logarithm of the word length, square roots of shares, each drawn to a typical text."""
    n, more = F.col("n_words"), F.lit(PRIOR_WORDS)

    def share(count: str, of: Column, prior: float = 0.0) -> Column:
        return F.sqrt((F.col(count) + prior) / of)

    chars = F.col("word_chars") + 5 * more
    return {
        "word_length": F.log(chars / (n + more)),
        "symbols": share("n_symbols", chars),
        "capitals": share("n_upper", chars, 0.03 * 5 * PRIOR_WORDS),
        "dup_lines": share("n_dup_lines", F.col("n_lines") + 4),
        "repeats": share("n_repeat_words", n + more),
    }


# -- minimum covariance determinant

def chi_square_cdf(x: float, p: float) -> float:
    """Lower tail of the chi-square distribution, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = p / 2, x / 2
    term = total = 1 / a
    k = 0
    while term > total * 1e-15:
        k += 1
        term *= z / (a + k)
        total += term
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def chi_square_quantile(q: float, p: float) -> float:
    low, high = 0.0, 10.0 * p + 200
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, p) < q else (low, mid)
    return high


def _fraction_bin(counts: DataFrame, keys: list[str], fraction: float, name: str) -> DataFrame:
    """Per key the lowest ``bin`` that has ``fraction`` of the rows at or below it, from ``keys, bin, n``.

    A running total over the bins of a key: their number is bounded by the range of the bins, not by the rows.
    """
    whole = Window.partitionBy(*keys)
    so_far = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    run = counts.withColumns({"_run": F.sum("n").over(so_far), "_all": F.sum("n").over(whole)})
    return run.filter(F.col("_run") >= F.ceil(F.col("_all") * fraction)).groupBy(*keys).agg(F.min("bin").alias(name))


def _centres(rows: DataFrame, names: list[str]) -> DataFrame:
    """``_group, m_<f>, s_<f>``: median and scaled median deviation of every feature, from counts of fine bins."""
    step = UNIT // 256
    pairs = F.inline(F.array(*[F.struct(F.lit(n).alias("f"), F.floor(F.col(n) / step).cast("bigint").alias("bin")) for n in names]))
    counts = stored(rows.select("_group", pairs).groupBy("_group", "f", "bin").agg(F.count(F.lit(1)).alias("n")), "feature-bins")
    middle = _fraction_bin(counts, ["_group", "f"], 0.5, "mid")
    away = counts.join(middle, ["_group", "f"]).withColumn("bin", F.abs(F.col("bin") - F.col("mid")))
    spread = _fraction_bin(away.groupBy("_group", "f", "bin").agg(F.sum("n").alias("n")), ["_group", "f"], 0.5, "mad")
    both = middle.join(spread, ["_group", "f"]).groupBy("_group")
    return both.agg(
        *[F.max(F.when(F.col("f") == n, (F.col("mid") + 0.5) * step)).alias(f"m_{n}") for n in names],
        *[F.max(F.when(F.col("f") == n, F.col("mad") * 1.4826 * step)).alias(f"s_{n}") for n in names],
    )


def _moments(rows: DataFrame, names: list[str], factor: float) -> DataFrame:
    """``_group``, means and the inverse Cholesky factor of the covariance, widened by the floors.

    Sums are whole numbers, added up in each task before the shuffle.
    """
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    big = "decimal(38,0)"
    sums = rows.groupBy("_group").agg(
        F.count(F.lit(1)).cast("double").alias("_n"),
        *[F.sum(F.col(n).cast(big)).cast("double").alias(f"_s{i}") for i, n in enumerate(names)],
        *[F.sum((F.col(names[i]) * F.col(names[j])).cast(big)).cast("double").alias(f"_q{i}_{j}") for i, j in pairs],
    )
    out = sums.withColumns({f"m_{n}": F.col(f"_s{i}") / F.col("_n") for i, n in enumerate(names)})
    floors = [FLOORS[n] * UNIT for n in names]
    cov = {}
    for i, j in pairs:
        value = (F.col(f"_q{i}_{j}") - F.col(f"_s{i}") * F.col(f"_s{j}") / F.col("_n")) / F.col("_n") * factor
        cov[f"_c{i}_{j}"] = value + floors[i] ** 2 if i == j else value
    out = out.withColumns(cov)
    for i in range(len(names)):  # Cholesky, a row at a time
        for j in range(i + 1):
            rest = F.col(f"_c{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"_l{i}_{k}") * F.col(f"_l{j}_{k}")
            out = out.withColumn(f"_l{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1.0))) if i == j else rest / F.col(f"_l{j}_{j}"))
    for i in range(len(names)):  # its inverse
        for j in range(i + 1):
            rest = F.lit(1.0 if i == j else 0.0)
            for k in range(j, i):
                rest = rest - F.col(f"_l{i}_{k}") * F.col(f"w{k}_{j}")
            out = out.withColumn(f"w{i}_{j}", rest / F.col(f"_l{i}_{i}"))
    log_det = sum((2 * F.log(F.col(f"_l{i}_{i}")) for i in range(len(names))), F.lit(0.0)).alias("_det")
    return out.select("_group", *[f"m_{n}" for n in names], *[f"w{i}_{j}" for i, j in pairs], log_det)


def _distance(names: list[str]) -> Column:
    """Squared Mahalanobis distance from the columns of ``_moments``."""
    total = F.lit(0.0)
    for i in range(len(names)):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.col(f"w{i}_{j}") * (F.col(names[j]) - F.col(f"m_{names[j]}"))
        total = total + part * part
    return total


def _groups(rows: DataFrame, least: int) -> DataFrame:
    """``_key, _group``: language with source, or what small ones fall back to: the language's rest, then all the rest."""
    n = rows.groupBy("_key", "_wide").agg(F.count(F.lit(1)).alias("_n"))
    rest = F.sum(F.when(F.col("_n") < least, F.col("_n"))).over(Window.partitionBy("_wide"))
    group = F.when(F.col("_n") >= least, F.col("_key")).when(rest >= least, F.col("_wide")).otherwise("*")
    return n.select("_key", group.alias("_group"))


def outlier_distances(stats: DataFrame, least: int = MIN_GROUP) -> DataFrame:
    """``stats`` with ``distance`` (squared, null without an estimate): minimum covariance determinant per language and source.

    Three starts per group: distances from the medians in median deviations, the same by the largest feature, and
    distances in the features' own units. Then concentration steps, for all groups and starts at once: the three quarters of
    a group that lie nearest give the next mean and covariance, whose determinant cannot grow. They go on until no
    determinant falls any more; each group keeps the start that ends with the least one. A last estimate uses all
    rows within the 97.5 % point. Cut points come from counts of fine distance bins, so each step is two grouped
    sums of whole numbers and nothing is gathered; a step whose bins let a determinant grow is not taken. A covariance never gets below the floors of ``FLOORS``, so
    groups in which most rows are equal have an estimate too. Rows that fail a fixed limit are not estimated from.
    """
    names = list(FLOORS)
    whole = {n: F.round(f * UNIT).cast("bigint") for n, f in features().items()}
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))  # noqa: E731  null is a value of its own
    rows = stats.withColumns({**whole, "_wide": part("_lang"), "_key": F.concat(part("_lang"), F.lit("\u0001"), part("_source"))})
    good = rows.filter(~base_failed())
    groups = stored(_groups(good, least), "groups")
    sample = stored(good.join(groups, "_key").select("_group", *names), "features")

    p = len(names)
    factor = SUBSET / chi_square_cdf(chi_square_quantile(SUBSET, p), p + 2)
    centres = broadcast_within(stored(_centres(sample, names), "centres"))
    off = [F.abs(F.col(n) - F.col(f"m_{n}")) for n in names]
    spread = [d / (F.col(f"s_{n}") + FLOORS[n] * UNIT) for d, n in zip(off, names)]
    squares = lambda of: sum((z * z for z in of), F.lit(0.0))
    starts = [squares(spread), F.greatest(*spread) ** 2, squares([d / (FLOORS[n] * UNIT) for d, n in zip(off, names)])]
    # a group under each of its starts is a group of its own: its name ends with the number of the start
    tried = F.explode(F.array(*[F.struct(F.lit(str(i)).alias("s"), d.alias("d")) for i, d in enumerate(starts)]))
    near = sample.join(centres, "_group").withColumn("_t", tried).select(F.concat("_group", "_t.s").alias("_group"), *names, F.col("_t.d").alias("_d"))
    every = sample.withColumn("_s", F.explode(F.array(*[F.lit(str(i)) for i in range(len(starts))]))).select(F.concat("_group", "_s").alias("_group"), *names)
    best, fell = None, 1
    while True:
        binned = near.withColumn("bin", F.floor(64 * F.log2(F.col("_d") + 1e-6)).cast("bigint"))
        counts = binned.groupBy("_group", "bin").agg(F.count(F.lit(1)).alias("n"))
        cut = broadcast_within(stored(_fraction_bin(counts, ["_group"], SUBSET, "cut"), "cuts"))
        estimate = stored(_moments(binned.join(cut, "_group").filter("bin <= cut"), names, factor), "estimate")
        if best is not None:
            before = best.select(F.col("_group").alias("_g"), F.struct(*[c for c in best.columns if c != "_group"]).alias("_old"))
            both = estimate.join(before, F.col("_group") == F.col("_g")).withColumn("_falls", F.col("_det") < F.col("_old._det") - SETTLED)
            fell = both.agg(F.count_if("_falls")).first()[0]
            estimate = stored(both.select("_group", *[F.when(F.col("_falls"), F.col(c)).otherwise(F.col(f"_old.{c}")).alias(c) for c in estimate.columns if c != "_group"]), "estimate")
        best = estimate
        if not fell:
            break
        near = every.join(broadcast_within(best), "_group").select("_group", *names, _distance(names).alias("_d"))
    least_first = Window.partitionBy("_of").orderBy("_det", "_group")
    named = best.withColumn("_of", F.expr("left(_group, length(_group) - 1)")).withColumn("_place", F.row_number().over(least_first))
    chosen = stored(named.filter("_place = 1").drop("_group", "_place").withColumnRenamed("_of", "_group"), "chosen")
    near = sample.join(broadcast_within(chosen.drop("_det")), "_group").select("_group", *names, _distance(names).alias("_d"))
    inside = near.filter(F.col("_d") <= chi_square_quantile(0.975, p))
    final = broadcast_within(stored(_moments(inside, names, 1.0).drop("_det"), "final"))
    tested = rows.join(broadcast_within(groups), "_key", "left").join(final, "_group", "left")
    return tested.select(*stats.columns, _distance(names).alias("distance"))


def judge(docs: DataFrame, reject: float = REJECT, least: int = MIN_GROUP, **names) -> DataFrame:
    """The columns of ``base_statistics`` with ``distance``, ``base_failed`` and ``kept``; one row per document.

    A document is kept if it fails no fixed limit and its distance is within the ``1 - reject`` point of the
    chi-square distribution. Defined cases: null or empty text has no words and fails; null language and null
    source are groups of their own; groups with fewer than ``least`` good rows share an estimate; without any
    good row there is no estimate and only the fixed limits hold; repeated rows are judged alike; an empty table
    gives no rows. Only the named columns are read.
    """
    stats = stored(base_statistics(docs, **names), "statistics")
    limit = chi_square_quantile(1 - reject, len(FLOORS))
    failed = base_failed()
    kept = ~failed & (F.coalesce("distance", F.lit(0.0)) <= limit)
    return outlier_distances(stats, least).withColumns({"base_failed": failed, "kept": kept})


def filter_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The kept documents with all their columns.

    Rows go by id and text: repeated rows stay or go together, null ids are ids, null and empty texts fail the fixed limits and
    go; texts of any length are read whole; no documents give no rows.
    """
    bad = judge(docs, doc_id=doc_id, text=text, **names).filter(~F.col("kept")).select("_id", "_print").distinct()
    bad = broadcast_within(stored(bad, "rejected"))
    return docs.join(bad, F.col(doc_id).eqNullSafe(bad["_id"]) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == bad["_print"]), "left_anti")
