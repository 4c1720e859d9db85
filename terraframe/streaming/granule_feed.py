"""Rerunning a granule selection: only what is new is taken.

A manifest folder grows over time. Each run takes the manifest files that came since
the last one (Structured Streaming remembers which) and, of their granules, only
those whose name has not been taken before, so widening the region or repeating a
failed run never fetches a granule twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..functions.geometry import Box
from ..operators.granules import missing_granules, select_granules


def take_new_granules(
    spark: SparkSession, manifest: str, schema: str, output: str, checkpoint: str, rect: str | Box, time: str
) -> None:
    """Append the newly wanted granules of a manifest folder to ``output`` and return.

    ``checkpoint`` must lie in a folder that all executors share. A wider region needs
    a new checkpoint folder, because old manifest files count again; ``output``
    still keeps names apart.
    """
    wanted = select_granules(spark.readStream.schema(schema).parquet(manifest), rect, time)

    def take(batch: DataFrame, _: int) -> None:
        found = batch.dropDuplicates(["name"])
        try:
            found = missing_granules(found, spark.read.parquet(output))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        found.write.mode("append").parquet(output)

    run = wanted.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    run.start().awaitTermination()
