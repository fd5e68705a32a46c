"""Shared working space."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: `spark.checkpoint.dir` of the session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("start the session with spark.checkpoint.dir, a folder all machines share")
    return configured.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the shared one."""
    return f"{shared_dir(spark)}/deskweave/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any URI Spark can write to."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = hadoop_path(spark, path)
    return fs.exists(jvm_path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written in the shared folder and read again, so that what is behind it runs once."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
