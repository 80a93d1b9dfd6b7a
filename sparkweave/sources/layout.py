"""How tables lie on disk: buckets, partitions, compaction."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame


def bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, sort: bool = True) -> DataFrame:
    """Write ``df`` as a table hash-bucketed by ``keys`` and read it back.

    Two tables with the same bucket count join on their keys without a shuffle.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex[:12]}"
    writer = df.repartition(buckets, *keys).write.format("parquet").option("path", path).bucketBy(buckets, *keys)
    if sort:
        writer = writer.sortBy(*keys)
    writer.saveAsTable(name)
    return spark.table(name)


def compact(spark, folder: str, schema, target_files: int) -> DataFrame:
    """Rewrite the many small files of a folder as about ``target_files`` files in a new folder."""
    from sparkweave.session import new_folder

    out = new_folder(spark, "compacted")
    # rows are dealt out evenly, so no file depends on one hot key
    spark.read.schema(schema).parquet(folder).repartition(target_files).write.parquet(out)
    return spark.read.schema(schema).parquet(out)
