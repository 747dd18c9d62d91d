"""Starting streams over what is available and waiting for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _disk_backed_state(spark: SparkSession) -> None:
    """Keep large state off the heap unless the session chose a store itself."""
    if "HDFSBackedStateStoreProvider" in spark.conf.get(_STATE_STORE, "HDFSBackedStateStoreProvider"):
        spark.conf.set(_STATE_STORE, _ROCKSDB)


def drain(stream: DataFrame, fold: Callable[[DataFrame, int], None], folder: str) -> None:
    """Run ``fold`` on every micro-batch of the data at hand; progress is kept in ``folder``."""
    query = (
        stream.writeStream.foreachBatch(fold)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_to_parquet(stream: DataFrame, folder: str) -> DataFrame:
    """Write the stream's output for the data at hand to ``folder`` and return it as a table."""
    spark = stream.sparkSession
    _disk_backed_state(spark)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start(f"{folder}/rows")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")
