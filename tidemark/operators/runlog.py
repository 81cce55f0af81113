"""Run rows of the pipelines: RUNNING when a run starts, SUCCESS or FAILED when it ends."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.sinks import VersionedTable

RUN_SCHEMA = T.StructType([
    T.StructField("execution_id", T.StringType()), T.StructField("pipeline_name", T.StringType()), T.StructField("layer", T.StringType()),
    T.StructField("environment", T.StringType()), T.StructField("execution_start", T.TimestampNTZType()),
    T.StructField("execution_end", T.TimestampNTZType()), T.StructField("execution_status", T.StringType()),
    T.StructField("rows_processed", T.LongType()), T.StructField("error_message", T.StringType()), T.StructField("executed_by", T.StringType())])


class RunLog:
    """Appended events; the last event of an execution is its state."""

    def __init__(self, spark: SparkSession, root: str, executed_by: str = "tidemark"):
        self.spark, self.table, self.executed_by = spark, VersionedTable(spark, root), executed_by

    def _add(self, row: tuple) -> None:
        self.table.append(self.spark.createDataFrame([(*row, self.executed_by)], RUN_SCHEMA).coalesce(1))

    def run(self, pipeline: str, layer: str, environment: str, work: Callable[[], int | None], reraise: bool = True):
        """Run `work`, which returns the number of rows, and log its start and its end."""
        ident, start = uuid.uuid4().hex, datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        self._add((ident, pipeline, layer, environment, start, None, "RUNNING", None, None))
        rows, error = None, None
        try:
            rows = work()
        except Exception as e:
            error = e
        end = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        self._add((ident, pipeline, layer, environment, start, end, "FAILED" if error else "SUCCESS", rows, str(error) if error else None))
        if error and reraise:
            raise error
        return rows

    def latest(self) -> DataFrame:
        """One row per execution: the ended event where there is one."""
        df = self.table.read()
        last = df.groupBy("execution_id").agg(F.max_by(F.struct(*df.columns), F.struct(
            F.col("execution_end").isNotNull(), "execution_end")).alias("_r"))
        return last.select("_r.*")
