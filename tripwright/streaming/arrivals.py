"""Incremental arrival of clean months: a file stream that calls the batch models.

There is no streaming model besides this: each batch of newly arrived months is handed to
the same batch functions, once, with a checkpoint of what has been seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripwright.schemas import CLEAN, struct


def follow_clean(spark: SparkSession, path: str, checkpoint: str, on_months: Callable[[DataFrame, int], None]):
    """Reads clean Parquet files that appeared below ``path`` since the last call, then stops.

    ``on_months`` gets them as one DataFrame per batch; a failed batch comes again.
    """
    arrived = spark.readStream.schema(struct(CLEAN)).option("recursiveFileLookup", "true").parquet(path)
    query = arrived.writeStream.foreachBatch(on_months).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
