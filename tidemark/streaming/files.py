"""New landing files, each exactly once, through the same cleanse and merge as the batch load."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from ..sources.sinks import VersionedTable


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream whose progress a checkpoint folder holds: a new checkpoint is another stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def incremental_stream_load(spark: SparkSession, landing: str, schema: T.StructType, target: VersionedTable, keys: Sequence[str],
                            checkpoint: str, cleanse: Callable[[DataFrame], DataFrame] = lambda df: df,
                            newest: str = "last_modified_timestamp", pattern: str = "*.parquet",
                            max_files: int | None = None) -> int:
    """Process the files that arrived since the last call, then stop; returns the published version.

    The checkpoint records the files taken. A batch repeated after a failure
    between its publication and the checkpoint's commit adds nothing: with
    keys the merge of the same rows changes nothing, and without keys the
    published pointer names the stream and its last batch, which the repeated
    one replaces.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    stream = reader.parquet(landing)

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = cleanse(batch)
        if keys:
            target.merge(rows, keys, newest, load=f"batch-{batch_id}")
        else:
            target.append(rows, batch=(query_id(spark, checkpoint), str(batch_id)))

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return target.version()
