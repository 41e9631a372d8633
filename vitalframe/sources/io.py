"""Scans, stage checkpoints and sinks."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from vitalframe.functions.nulls import nan_to_null
from vitalframe.operators.features import SUMS, table_digest
from vitalframe.session import staged

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Parquet scans prune columns and push filters themselves."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_raw(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Header CSV (gzip or plain); text stays text, empty fields and NaN are NULL.

    Gzip files cannot be split, so callers should persist the result as
    Parquet once (``stage``) and work from that.
    """
    reader = spark.read.option("header", True).option("nullValue", "").option("emptyValue", "")
    reader = reader.option("mode", "PERMISSIVE").option("multiLine", False)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", False)
    out = reader.csv(path)
    # NaN would poison every aggregate; a missing number is NULL from here on
    return out.withColumns({f.name: nan_to_null(f.name) for f in out.schema.fields if f.dataType.typeName() in ("double", "float")})


def ingest_raw(spark: SparkSession, paths: str | Sequence[str], schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Many header CSV files (gzip or plain) -> (rows under ``schema``, quarantine of malformed lines).

    A gzip file is one task, files are read in parallel, and the parsed rows are written once, in even
    partitions, so that later stages do not inherit the files' sizes. A line with too few or too many
    fields or a field that is not of its type goes whole to the quarantine table (file, line, text), with
    its number in the file from 1; nothing becomes NULL unseen. Empty fields and NaN are NULL, empty lines are skipped, a
    quoted field must end on its line. A file whose header is not the schema's columns raises.
    """
    read = spark.read.text(paths if isinstance(paths, str) else list(paths))
    bad = "_bad"
    typed = StructType([*schema.fields, T.StructField(bad, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, "nullValue": "", "emptyValue": ""}
    row = F.from_csv("value", typed.simpleString()[len("struct<"):-1].replace(":", " "), options)
    # ids rise with the lines of a split; a file's splits are told apart by where they begin
    lines = read.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"),
                        F.monotonically_increasing_id().alias("_id"), F.col("value").alias("_text"), row.alias("_row"),
                        (F.trim("value") == "").alias("_blank"))
    kept = F.col(f"_row.{bad}").isNotNull() | F.col("_row").isNull() | _header(schema)  # whose text is wanted later
    lines = staged(lines.withColumn("_text", F.when(kept, F.col("_text"))).repartition("_id"), "raw-lines")
    splits = lines.groupBy("_file", "_at").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))  # one row per split
    before = Window.partitionBy("_file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    splits = staged(splits.select("_file", "_at", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "raw-splits")
    x = lines.join(splits, ["_file", "_at"]).withColumn("_line", F.col("_id") - F.col("_first") + F.col("_before") + 1)
    wrong = x.filter((F.col("_line") == 1) & ~F.coalesce(_header(schema), F.lit(False))).select("_file", "_text").head()
    if wrong is not None:
        raise ValueError(f"{wrong[0]}: the header is {wrong[1]!r}, not the columns {', '.join(schema.names)}")
    data = x.filter("_line > 1 and not _blank").withColumn("_wrong", F.col("_row").isNull() | F.col(f"_row.{bad}").isNotNull())
    good = data.filter("not _wrong").select("_row.*").drop(bad)
    good = good.withColumns({f.name: nan_to_null(f.name) for f in schema.fields if f.dataType.typeName() in ("double", "float")})
    return good, data.filter("_wrong").select(F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_text").alias("text"))


def _header(schema: StructType):
    return F.regexp_replace("_text", r'["\r\x{FEFF}]', "") == ",".join(schema.names)


def stage(df: DataFrame, path: str, partition_by: list[str] | None = None,
          cluster_by: list[str] | None = None) -> DataFrame:
    """Write a stage table and read it back: a lineage cut that survives
    executor loss (the data lives in shared storage, not on executors).

    With ``cluster_by`` the rows are range-partitioned on (partition_by +
    cluster_by) and sorted within tasks, so each task writes few directories
    and each file covers a narrow key range: Parquet min/max statistics then
    prune files for key lookups (e.g. one patient's trace)."""
    out = df
    if cluster_by:
        out = out.repartitionByRange(*[c for c in (partition_by or [])] + list(cluster_by)) \
                 .sortWithinPartitions(*cluster_by)
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header, NULL written as an empty field, no row names."""
    (df.write.mode("overwrite").option("header", True)
       .option("nullValue", "").option("emptyValue", "").csv(path))


def read_model_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Model input and target tables written by ``export_model_tables``."""
    return (spark.read.parquet(os.path.join(path, "model_input")),
            spark.read.parquet(os.path.join(path, "model_target")))


def export_model_tables(inputs: DataFrame, targets: DataFrame, path: str) -> None:
    inputs.write.mode("overwrite").parquet(os.path.join(path, "model_input"))
    targets.write.mode("overwrite").parquet(os.path.join(path, "model_target"))


def fingerprint(df: DataFrame, options: dict | None = None) -> str:
    """SHA-256 over what a frame is computed from: its plan without generated ids, the input files with
    their lengths and modification times, and ``options``. Rows that lie in no file (made by the
    driver) enter with their digest."""
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    files = []
    conf, path_of = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in sorted(df.inputFiles()):
        path = path_of(name)
        status = path.getFileSystem(conf).getFileStatus(path)
        files.append((name, status.getLen(), status.getModificationTime()))
    parts = [re.sub(r"#\d+L?", "", plan), df.schema.json(), json.dumps(files), json.dumps(options or {}, sort_keys=True, default=str)]
    if re.search(r"LogicalRDD|LocalRelation|ExternalRDD|LocalTableScan", plan):
        parts.append(json.dumps([str(v) for v in table_digest(df).agg(*[F.sum(c) for c in SUMS]).first()]))
    return hashlib.sha256("\0".join(parts).encode()).hexdigest()


def cache_table(df: DataFrame, root: str, options: dict | None = None, build: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` computed once per content: written below ``root`` under its fingerprint and read back from there by
    every later call with the same input and options; other input files, a changed file, another plan or
    other options have a folder of their own. With ``build`` the table is ``build(df)``, filed under the fingerprint of
    ``df`` and made only if it is not there: for tables that write stages of their own, whose paths are new each time.
    ``options`` then names what ``build`` depends on.

    The completed-write marker is looked up through the Hadoop file system
    of ``root`` (local, HDFS or object store alike)."""
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{fingerprint(df, options)}"
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    fs = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(marker):
        (build(df) if build else df).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path) if build else spark.read.schema(df.schema).parquet(path)


def cache_sequences(df: DataFrame, root: str, options: dict | None = None, build: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The per-patient sequence table, built once per input and options and reused from Parquet (``cache_table``)."""
    return cache_table(df, root, options, build)


def write_predictions(df: DataFrame, path: str) -> None:
    """Prediction/target rows, one folder per split (validation, test)."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def export_horizons(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """One file set per label horizon (``horizon_h=<i>`` folders)."""
    writer = df.write.mode("overwrite").partitionBy("horizon_h")
    if fmt == "csv":
        writer.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)
    else:
        writer.parquet(path)
