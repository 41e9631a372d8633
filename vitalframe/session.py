"""Session construction and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partitions sized for executor memory: AQE merges small shuffle partitions
    # up to the advisory size and splits skewed ones; scans read 256 MB splits
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast decisions are left to the planner's size estimate and to AQE's
    # runtime statistics; nothing derived from the data is force-broadcast.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # tables bucketed by patient join on (patient, time) without a shuffle
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def build_session(master: str = "local[*]", app: str = "vitalframe",
                  shuffle_partitions: int = 8, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage and must be set: a folder of
    one machine would lose rows. Only a local session without the setting
    (tests) gets a fresh private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_paths: list[str] = []  # of the tables this process has staged
_tables: list[str] = []  # names of the bucketed ones


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder, remembered for ``drop_stages``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _paths.append(path)
    return path


def staged(df: DataFrame, name: str = "stage", compression: str = "snappy", options: dict | None = None) -> DataFrame:
    """Write ``df`` once below the checkpoint folder and read it back: every later
    read sees the same rows in the same partitions, also after an executor is lost."""
    path = stage_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """``staged``, bucketed and sorted by ``key`` (one file per bucket): aggregates, windows and joins whose keys include it
    read the bucketed table without a shuffle. For tables whose rows per key are bounded. The table is registered in
    the session's catalog under a name of its own; its files are below the checkpoint folder."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, table = stage_path(spark, name), f"stage_{uuid.uuid4().hex}"
    (df.repartition(n, key).sortWithinPartitions(key).write.bucketBy(n, key).sortBy(key)
       .option("path", path).format("parquet").saveAsTable(table))
    _tables.append(table)
    return spark.table(table)


def stage_paths() -> tuple[str, ...]:
    """The tables staged so far and not dropped."""
    return tuple(_paths)


def drop_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete some staged tables that no result needs any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in set(paths) & set(_paths):
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
        _paths.remove(name)


def drop_stages(spark: SparkSession) -> int:
    """Delete the tables staged so far, once the results built on them have been written; returns how many."""
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _paths:
        path = jvm.org.apache.hadoop.fs.Path(_paths.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike a local checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
