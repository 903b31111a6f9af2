"""Sinks: partitioned appends, appends of new keys only, snapshots, chunked text and its manifest.

Existing tables are read by path through Spark, so any file system that Spark knows works.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import unseen


def append_daily(df: DataFrame, path: str, ts: str = "ts", key: str = "inst_id", form: str = "parquet") -> None:
    """Append in folders by instrument and UTC day of the event."""
    df.withColumn("date", F.to_date(ts)).write.partitionBy(key, "date").mode("append").format(form).save(path)


def append_new(df: DataFrame, path: str, keys: list[str], form: str = "parquet") -> None:
    """Append the rows whose keys the table doesn't have; running it twice adds nothing."""
    try:
        there = df.sparkSession.read.format(form).load(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        there = None
    fresh = df.dropDuplicates(keys)
    (fresh if there is None else unseen(fresh, there, keys)).write.mode("append").format(form).save(path)


def snapshot(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Replace the table. ``df`` must not read the same path."""
    df.write.mode("overwrite").format(form).save(path)


def inbox(df: DataFrame, path: str, symbol: str, kind: str) -> None:
    """Append derivative points with their ingest time, by symbol and kind."""
    df.withColumns({"symbol": F.lit(symbol), "kind": F.lit(kind), "ingest_time": F.current_timestamp()}).write.partitionBy("symbol", "kind").mode("append").json(path)


def chunks(records: DataFrame, path: str) -> None:
    """Records by chunk_id as JSON lines, one folder a chunk."""
    records.repartition("chunk_id").sortWithinPartitions("chunk_id", "source_file", "place").write.partitionBy("chunk_id").mode("overwrite").json(path)
