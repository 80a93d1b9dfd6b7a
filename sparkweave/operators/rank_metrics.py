"""Quality of ranked results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def ranking_metrics(judged: DataFrame, query: str, place: str, relevance: str) -> DataFrame:
    """Hit, reciprocal rank, NDCG (gain ``2^rel - 1``) and average precision per query over its short result list."""
    best_first = Window.partitionBy(query).orderBy(F.col(relevance).desc(), F.col(place))
    by_place = Window.partitionBy(query).orderBy(place)
    hit = F.col(relevance) > 0
    gain = F.pow(F.lit(2.0), F.col(relevance)) - 1
    j = judged.withColumns({
        "_ideal": F.row_number().over(best_first), "_found": F.sum(hit.cast("int")).over(by_place),
    })
    dcg, ideal = F.sum(gain / F.log2(F.col(place) + 1)), F.sum(gain / F.log2(F.col("_ideal") + 1))
    hits = F.sum(hit.cast("int"))
    return j.groupBy(query).agg(
        F.max(hit.cast("double")).alias("hit"),
        F.coalesce(F.max(F.when(hit, 1.0 / F.col(place))), F.lit(0.0)).alias("reciprocal_rank"),
        F.round(F.coalesce(dcg / F.nullif(ideal, F.lit(0.0)), F.lit(0.0)), 6).alias("ndcg"),
        F.round(F.coalesce(F.sum(F.when(hit, F.col("_found") / F.col(place))) / F.nullif(hits, F.lit(0)), F.lit(0.0)), 6).alias("average_precision"),
    )
