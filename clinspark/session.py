"""Session settings and the shared stage folder.

A *stage* is a parquet table written to the folder that ``spark.checkpoint.dir``
names.  It is used in two places only: where a value must be fixed once before
it is read twice (dense ids), and where Spark should know the real size of a
lookup before it picks a join (mapping tables).  Stages live in shared storage,
so a lost executor costs a re-read and never a wrong answer.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys: split oversized join partitions even if that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings this library relies on to a running session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", checkpoint_dir: str | None = None
) -> SparkSession:
    """A single-machine session, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("clinspark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # plans are built faster without
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def stage_root(spark: SparkSession) -> str:
    """Folder for this application's stages: below ``spark.checkpoint.dir`` or, where that is unset,
    below the warehouse.  On a cluster one of both has to be a folder that driver and executors share."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/stages"
    return f"{configured.rstrip('/')}/clinspark-{spark.sparkContext.applicationId}"


_open_scopes: list[list[str]] = []


def stage_path(spark: SparkSession, label: str) -> str:
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


@contextmanager
def temporary_stages(spark: SparkSession):
    """Delete the stages made inside the block when it ends: nothing may read them afterwards."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, uri: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


STAGE_CODEC = "zstd"  # stages are short-lived and read a few times: their size counts


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.option("compression", STAGE_CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_parts(df: DataFrame, label: str, column: str, values: list) -> dict:
    """Write ``df`` once, in a folder per value of ``column``, and return the part of each of ``values``.

    Spark plans with the size of a part, not with that of the whole.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.option("compression", STAGE_CODEC).partitionBy(column).parquet(path)
    part = df.drop(column).schema
    folders = {value: f"{path}/{column}={value}" for value in values}
    return {
        value: spark.read.schema(part).parquet(folder) if _exists(spark, folder) else spark.createDataFrame([], part)
        for value, folder in folders.items()
    }


def _exists(spark: SparkSession, uri: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


_on_drop: list = []


def on_drop(forget) -> None:
    """Call ``forget(spark)`` whenever stages are dropped: for caches that hold frames over them."""
    _on_drop.append(forget)


def drop_stages(spark: SparkSession) -> bool:
    """Delete the stages of this application once its results are published."""
    for forget in _on_drop:
        forget(spark)
    return _delete(spark, stage_root(spark))
