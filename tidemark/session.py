"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# AQE splits skewed join partitions even where that costs one more exchange:
# a hot customer or campaign must not pin a stage to one task.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}

PARTITION_BYTES = 128 * 1024 * 1024
STORED = {"compression": "zstd"}   # of tables kept for later reads
SHUFFLES_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build(app: str = "tidemark", master: str | None = None, shuffle_partitions: int | None = None,
          conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators expect.

    `shuffle_partitions` is the number AQE starts from and coalesces down; on a
    cluster size it with `shuffle_partitions_for(input_bytes)`.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(input_bytes: int, floor: int = 8) -> int:
    """Start partitions so that one shuffle partition holds about 128 MB."""
    return max(floor, -(-input_bytes // PARTITION_BYTES))


SLICE_BYTES = 32 * 1024 * 1024
MOST_SLICES = 8


def slices_for(input_bytes: int) -> int:
    """Parts a large write is run in, one after the other, so that shuffle files of one part only are on disk at a time.

    Their number is bounded: what the parts are joined with is dealt out once for each.
    """
    return max(1, min(MOST_SLICES, -(-input_bytes // SLICE_BYTES)))


def source_bytes(df: DataFrame) -> int:
    """Bytes of the files below a plan."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach.

    The cluster names it in spark.checkpoint.dir; only where that is unset
    (single-machine tests) a local temporary folder is taken.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(_OWN_DIRS[app])
    return _OWN_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, never reused."""
    return os.path.join(shared_dir(spark), "tidemark", spark.sparkContext.applicationId,
                        f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each statement run inside go as it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLES_FREED, None)
    spark.conf.set(SHUFFLES_FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_FREED) if before is None else spark.conf.set(SHUFFLES_FREED, before)


_WRITTEN: dict[tuple[str, str], tuple[str, StructType]] = {}


def written_once(spark: SparkSession, name: str, plan: Callable[[], DataFrame]) -> DataFrame:
    """A table several queries of this application read: written on first use in the shared folder."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _WRITTEN:
        with shuffles_freed(spark):
            df, path = plan(), scratch_path(spark, name.split("|")[0])
            df.write.options(**STORED).parquet(path)
        _WRITTEN[key] = (path, df.schema)
    path, schema = _WRITTEN[key]
    return spark.read.schema(schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
