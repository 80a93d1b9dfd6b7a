"""Run metadata as a table: one row per step."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "step string, status string, seconds double, rows bigint, error string"


class RunLog:
    """Appends step, status, seconds and rows of each step to a table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _append(self, *row) -> None:
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def step(self, name: str, work: Callable[[], DataFrame]) -> DataFrame:
        started = time.monotonic()
        try:
            result = work()
            rows = result.count()
        except Exception as e:
            self._append(name, "failed", time.monotonic() - started, None, str(e))
            raise
        self._append(name, "success", time.monotonic() - started, rows, None)
        return result

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.folder)
