"""Incremental ride loading as a stream that stops when it has caught up.

The checkpoint keeps the state of the load; a new run reads new files only.
"""

import json

from pyspark.sql import DataFrame, SparkSession

from dockflow.sources import increments, schemas
from dockflow.sources.increments import loaded

__all__ = ["load_available", "loaded", "ride_stream"]


def ride_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.RIDES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def _load_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the checkpoint: one that is made anew at the same path is another load."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads("".join(r[0] for r in lines))["id"]


def load_available(stream: DataFrame, target: str, checkpoint: str, **sizes: int) -> None:
    """Append each ride that has arrived since the last run once, then stop.

    A ride is known by ``rental_id``; the first batch that delivers it is the one that counts. Late rides are kept however
    late they are: repeats are found through the target's key index, not in stream state that a watermark would cut off.
    ``sizes`` are those of the key index.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        increments.append_batch(batch, target, _load_id(batch.sparkSession, checkpoint), batch_id, **sizes)

    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
