"""Running a bounded stream to its end, with its state kept in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from sparkweave.session import new_folder
from sparkweave.sources.tables import SCHEMAS, Tables

TIMEOUT_SECONDS = 3600
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def table_stream(t: Tables, name: str, **options) -> DataFrame:
    """A table's files as a stream with the declared schema; the table may be one file or a folder."""
    reader = t.spark.readStream.schema(SCHEMAS[name]).options(**options)
    single = any(f.endswith(f"/{name}.parquet") for f in getattr(t, name).inputFiles())
    if single:
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(t.folder)
    return reader.parquet(t.path(name))


def finish(query) -> None:
    """Wait for an ``availableNow`` run; raise what it raised, or if it does not end."""
    if not query.awaitTermination(TIMEOUT_SECONDS):
        query.stop()
        raise TimeoutError("stream did not finish")


def to_table(stream: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Append-mode run into Parquet; the same folder again goes on from its checkpoint."""
    folder = folder or new_folder(stream.sparkSession, label)
    finish(
        stream.writeStream.trigger(availableNow=True).outputMode("append").format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint").start(f"{folder}/rows")
    )
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def batch_writer(folder: str) -> Callable[[DataFrame, int], None]:
    """Sink function that writes a batch under its id; a repeated batch replaces itself."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return write


def to_batches(stream: DataFrame, label: str, mode: str, folder: str | None = None, write=None) -> DataFrame:
    """Run in any output mode through ``foreachBatch``; rows come back with their ``batch_id``."""
    spark = stream.sparkSession
    folder = folder or new_folder(spark, label)
    finish(
        stream.writeStream.trigger(availableNow=True).outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(write or batch_writer(f"{folder}/rows")).start()
    )
    return read_batches(spark, f"{folder}/rows", stream.schema)


def read_batches(spark: SparkSession, folder: str, schema) -> DataFrame:
    from pyspark.sql.types import LongType, StructType

    return spark.read.schema(StructType(list(schema.fields)).add("batch_id", LongType())).parquet(folder)


class FedStream:
    """An input folder that receives frames step by step, and the stream over it."""

    def __init__(self, spark: SparkSession, schema, label: str, **options):
        self.folder = new_folder(spark, label)
        self.input = f"{self.folder}/input"
        self.spark = spark
        spark.createDataFrame([], schema).write.parquet(self.input)
        self.stream = spark.readStream.schema(schema).options(**options).parquet(self.input)

    def add(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.input)


def run_steps(spark: SparkSession, steps: Sequence[DataFrame], build: Callable[[DataFrame], DataFrame], label: str, mode: str = "append") -> DataFrame:
    """Feed the frames one after the other, running to the end after each, on one checkpoint."""
    fed = FedStream(spark, steps[0].schema, label)
    out, result = f"{fed.folder}/out", None
    for df in steps:
        fed.add(df)
        query = build(fed.stream)
        result = to_table(query, label, out) if mode == "append" else to_batches(query, label, mode, out)
    return result


class settings:
    """Session settings that hold for the runs inside the block."""

    def __init__(self, spark: SparkSession, **values: str):
        self.spark, self.values = spark, values

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in self.values}
        for k, v in self.values.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.before.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


def rocksdb_state(spark: SparkSession) -> settings:
    """State kept in RocksDB for the runs inside the block."""
    return settings(spark, **{"spark.sql.streaming.stateStore.providerClass": ROCKSDB})


def sessions_merged_early(spark: SparkSession) -> settings:
    """Sessions on two levels: every task merges what it read of a key, and only those partial sessions reach the key's state.

    So a busy key sends as many rows as it has sessions in each task's part, not as many as it has records.
    """
    return settings(spark, **{"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"})
