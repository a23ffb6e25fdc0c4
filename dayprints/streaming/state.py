"""Running a stateful stream over what has arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(stream: DataFrame, path: str, checkpoint: str, *partition_by: str) -> None:
    """Process what has arrived, appending all that is emitted to a Parquet folder; then stop.

    Each micro-batch writes a folder ``batch=N`` of its own, so a repeated batch replaces itself.
    State is kept in RocksDB, which the processors need.
    """
    def write(df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch={n}")

    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        query = (stream.writeStream.outputMode("update").foreachBatch(write)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
