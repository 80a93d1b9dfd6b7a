"""Reading and writing files; every reader takes a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkweave.session import new_folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back, to reuse it without recomputing."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def stored_before(spark: SparkSession, folder: str, schema) -> DataFrame | None:
    """The table in a folder, or None if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def round_trip(df: DataFrame, fmt: str, label: str, **options) -> DataFrame:
    """Write in ``fmt`` (csv, json, orc, parquet) and read back with the same schema."""
    folder = new_folder(df.sparkSession, label)
    df.write.format(fmt).options(**options).save(folder)
    return df.sparkSession.read.format(fmt).schema(df.schema).options(**options).load(folder)


def file_sizes(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path and length of every file below a folder, contents unread."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length")
    )


def write_partitioned(df: DataFrame, folder: str, columns: Sequence[str], mode: str = "errorifexists") -> None:
    """Hive-style folders; rows gather by folder, and adaptive execution splits a hot folder over tasks."""
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(folder)


def replace_partitions(df: DataFrame, folder: str, columns: Sequence[str]) -> None:
    """Overwrite only the partitions that occur in ``df``; all others stay as they are."""
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(folder)
    )


def ingest_raw(df: DataFrame, source: str, batch_id: str) -> DataFrame:
    """Raw rows untouched, with file name, load time, source and batch id."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.current_timestamp().alias("_loaded_at"),
        F.lit(source).alias("_source"),
        F.lit(batch_id).alias("_batch_id"),
        F.current_date().alias("ingest_date"),
    )
