"""Session settings the library is designed for."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Adaptive execution decides on broadcasts from measured sizes, splits skewed join partitions
#: and merges small ones; broadcasts guessed from file sizes are switched off.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}

#: Shuffle partitions to start from, per core of the cluster; adaptive execution merges them.
PARTITIONS_PER_CORE = 4


def tune(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to a running session; whatever was given at submit time stays."""
    given = spark.sparkContext.getConf()
    partitions = str(max(200, PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism))
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": partitions}.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A new folder for intermediate tables, inside the shared folder named by spark.checkpoint.dir.

    On one machine (master ``local...``) a temporary folder serves where none is named; on a
    cluster a missing setting is an error, as executors would write to disks of their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/tables-{uuid.uuid4().hex}"


#: The JVM compiles no method of more bytes; a wide projection in one that is larger stays interpreted.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Wide projections in methods that the JVM compiles, for the writes inside; the setting is put back."""
    key, limit = METHOD_LIMIT
    before = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written once to the scratch folder and read again by whoever needs them."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
