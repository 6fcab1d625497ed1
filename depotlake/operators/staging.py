"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only a local-mode session may go without one."""
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    application = context.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="depotlake-")
    return _local_roots[application]


@dataclass(frozen=True)
class Bucketed:
    """Rows to be stored in buckets by the hash of a column; each writing task adds a file to those it has rows of."""

    df: DataFrame
    by: str
    buckets: int


def stage(df: DataFrame | Bucketed, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and return a reader of the files.

    Cuts the lineage durably: what follows survives lost executors without replaying the joins,
    and, unlike ``checkpoint()``, reads back only the columns it needs. The files are removed when
    the application ends. What groups or joins ``Bucketed`` rows by their column need not shuffle them.
    """
    if isinstance(df, Bucketed):
        return _stage_buckets(df, label)
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _stage_buckets(rows: Bucketed, label: str) -> DataFrame:
    """Only tables of the catalog have buckets; the reader keeps them when the table is forgotten at once."""
    spark = rows.df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    path, table = f"{staging_root(spark)}/{name}", f"spark_catalog.default.{name}"
    writer = rows.df.write.format("parquet").option("compression", "zstd").option("path", path)
    writer.bucketBy(rows.buckets, rows.by).saveAsTable(table)
    _remove_at_exit(spark, path)
    stored = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return stored


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own, removed with all it holds when the application ends."""
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    _remove_at_exit(spark, path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = located(spark, path)
    return file_system.exists(hadoop_path)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = located(spark, path)
    file_system.deleteOnExit(hadoop_path)


def located(spark: SparkSession, path: str):
    """The file system that holds a path, and the path as it takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path.getFileSystem(configuration), hadoop_path
