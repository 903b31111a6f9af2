"""Shared-storage cut points for multi-stage jobs.

Every cut is a Parquet table below the folder that the session names in ``spark.checkpoint.dir``, so any
executor can read it after another one is lost. A folder of our own is made only where none is set
(single-machine sessions such as the tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; where the setting is missing, a fresh local one on a single machine only."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-tidepool-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def cut(df: DataFrame, name: str = "t", codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and return the table that was written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidepool_path = path
    return out


def drop(*tables: DataFrame | None) -> None:
    """Delete tables made by :func:`cut` that no later step reads."""
    for t in tables:
        path = getattr(t, "_tidepool_path", None)
        if path:
            jvm = t.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(p, True)
