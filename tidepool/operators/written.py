"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Only a session without that setting (a single machine, as in tests) gets a
    folder of its own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = "file://" + tempfile.mkdtemp(prefix="spark-tidepool-")
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` as a Parquet table in the shared folder, so that what reads it several times doesn't work it out again and a lost
    executor costs no more than its own tasks."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
