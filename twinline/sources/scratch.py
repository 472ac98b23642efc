"""Intermediate tables in the folder the cluster shares.

A frame with several consumers is written once as Parquet and read back: consumers then read only the
columns they need, and losing an executor costs no recomputation of the lineage before it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a fresh temporary one only where none is set (local tests)."""
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="twinline-")
        spark.conf.set(SETTING, root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/twinline/{label}-{uuid.uuid4().hex}"


def put_in_place(spark: SparkSession, finished: str, path: str) -> None:
    """Give a finished folder its final name. What had the name before goes only when the new folder has it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    new, old, aside = (hadoop.Path(p) for p in (finished, path, f"{finished}.replaced"))
    files = new.getFileSystem(spark._jsc.hadoopConfiguration())
    replaces = files.exists(old)
    if replaces and not files.rename(old, aside):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(new, old):
        if replaces:
            files.rename(aside, old)
        raise OSError(f"cannot move {finished} to {path}")
    if replaces:
        files.delete(aside, True)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, and the folders it lies in."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True).close()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
