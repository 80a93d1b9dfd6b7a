"""An inverted index in folders by term, with bounds per block, and a ranked search that reads the blocks of its terms only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from sparkweave.operators.text import postings, words
from sparkweave.session import new_folder
from sparkweave.sources.files import stored

FOLDERS = 16  # of a small index; a term is in the folder of its hash
LEVELS = 16  # blocks of a term for each unit of a posting's weight


@dataclass
class TermIndex:
    """``postings(key, term, level, weight, folder)`` and ``blocks(term, level, n, best, folder)``, both by folder."""

    postings: DataFrame
    blocks: DataFrame
    documents: int
    folders: int
    key: str


def _by_folder(df: DataFrame, label: str) -> DataFrame:
    folder = new_folder(df.sparkSession, label)
    df.hint("rebalance", "folder").sortWithinPartitions("folder", "term", "level").write.partitionBy("folder").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def build_index(df: DataFrame, key: str, text: str, k1: float = 1.5, b: float = 0.75, folders: int = FOLDERS) -> TermIndex:
    """Index the whole texts of ``df`` for BM25.

    The weight of a posting is its part of the score but for the term's rarity. A term's postings are cut into blocks by weight
    level; a block's row holds its number of postings and its largest weight.
    """
    lengths = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size(words(F.lower(text)))).alias("avg")).first()
    weight = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / (lengths["avg"] or 1.0)))
    rows = postings(df, key, text).withColumn("weight", weight)
    folder = F.pmod(F.xxhash64("term"), F.lit(folders)).cast("int").alias("folder")
    rows = _by_folder(rows.select(key, "term", F.floor(F.col("weight") * LEVELS).cast("int").alias("level"), "weight", folder), "postings")
    blocks = rows.groupBy("folder", "term", "level").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("best"))
    return TermIndex(rows, _by_folder(blocks.select("term", "level", "n", "best", "folder"), "blocks"), lengths["n"], folders, key)


def wanted_blocks(index: TermIndex, queries: DataFrame, k: int) -> DataFrame:
    """``query, term, level, idf`` of the blocks that can hold one of the ``k`` best documents of ``queries(query, term)``.

    ``k`` documents are at least as good as the level that the ``k`` heaviest postings of any one term reach. A block whose best
    posting stays below that, even with the best of all other terms, holds none of the ``k`` best.
    """
    asked = queries.select("query", "term").distinct()
    folders = [r[0] for r in asked.select(F.pmod(F.xxhash64("term"), F.lit(index.folders)).cast("int")).distinct().collect()]  # at most FOLDERS
    blocks = stored(index.blocks.filter(F.col("folder").isin(folders)).join(asked, "term").drop("folder"), "query-blocks")
    df = blocks.groupBy("query", "term").agg(F.sum("n").alias("df"), F.max("best").alias("most"))
    idf = F.log((index.documents - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    terms = df.select("query", "term", idf.alias("idf"), (F.col("most") * idf).alias("most"))
    heavier = Window.partitionBy("query", "term").orderBy(F.col("level").desc()).rowsBetween(Window.unboundedPreceding, 0)
    reached = blocks.withColumn("_sum", F.sum("n").over(heavier)).filter(F.col("_sum") >= k).groupBy("query", "term").agg(F.max("level").alias("_level"))
    least = terms.join(reached, ["query", "term"]).groupBy("query").agg(F.max(F.col("_level") / LEVELS * F.col("idf")).alias("_least"))
    total = terms.groupBy("query").agg(F.sum("most").alias("_all"))
    judged = blocks.join(terms, ["query", "term"]).join(total, "query").join(least, "query", "left")
    best = F.col("best") * F.col("idf") + F.col("_all") - F.col("most")
    # scores are compared to six digits
    return judged.filter(best >= F.coalesce("_least", F.lit(0.0)) - 1e-5).select("query", "term", "level", "idf")


def search(index: TermIndex, queries: DataFrame, k: int) -> DataFrame:
    """``query, key, score``: BM25 of the documents that can be among the ``k`` best of each query (and some more).

    Reads the folders of the terms asked for, and in them the wanted blocks. Documents whose score is cut short by a block that is
    left out are none of the ``k`` best.
    """
    wanted = stored(wanted_blocks(index, queries, k), "wanted-blocks")
    folders = [r[0] for r in wanted.select(F.pmod(F.xxhash64("term"), F.lit(index.folders)).cast("int")).distinct().collect()]
    hits = index.postings.filter(F.col("folder").isin(folders)).join(wanted, ["term", "level"])
    return hits.groupBy("query", index.key).agg(F.sum(F.col("idf") * F.col("weight")).alias("score"))
