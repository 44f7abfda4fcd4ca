"""The bronze to silver hop as a file stream.

The stream's checkpoint remembers which landed files were read, in place of a ledger. Each micro-batch goes through the same function as the
batch job, and every table records the checkpoint and the batch in its commit log: a batch that is replayed after a restart does no work in tables
that have it. Indicators go on from their stored state, so no history is read unless bars come late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quotelake.operators.history import LOOKBACK
from quotelake.plans.silver import refresh_silver
from quotelake.schemas import BRONZE_PRICES
from quotelake.sources.files import nan_as_missing


def stream_silver(
    spark: SparkSession,
    landing: str,
    silver: str,
    checkpoint: str,
    schema: T.StructType = BRONZE_PRICES,
    files_per_batch: int | None = None,
    lookback: int = LOOKBACK,
    every: str | None = None,
) -> StreamingQuery:
    """Start the stream. Without ``every`` it takes what has landed and stops; else it polls."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(batch: DataFrame, number: int) -> None:
        refresh_silver(nan_as_missing(batch), None, silver, lookback, source=f"{checkpoint}#{number}")

    writer = reader.parquet(landing).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    trigger = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return trigger.start()
