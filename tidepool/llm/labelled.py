"""Labelled rows for the classifiers: fold rule, bounded sample, held-out flag."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import flat

SAMPLE_ROWS = 12_000


def remainder(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def sample(docs: DataFrame, labels: DataFrame, column: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` training rows (doc_id, text, y, part) in a reproducible hash order; part 0 is for calibration.

    A row trains only if crc32(doc_id as text) mod 5 is not 0. Several labels of one doc_id: the largest counts;
    null labels don't. Several texts of one doc_id: the smallest. The sample is bounded, so its ids are broadcast.
    """
    y = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max(column) > 0).cast("int").alias("y"))
    y = y.where(remainder(5) != 0).join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    few = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    few = few.withColumn("part", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(4)).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(few), "doc_id").groupBy("doc_id", "y", "part").agg(F.min("text").alias("text")).select("doc_id", "text", "y", "part")


def filtered(docs: DataFrame, scorer, keep) -> DataFrame:
    """The rows of ``docs``, all columns, whose scores ``keep`` accepts; ``scorer()`` gives a function of a text column."""
    rows = docs.withColumn("text", F.col("text").cast("string"))
    names = rows.columns

    def run(batches):
        score = scorer()
        for b in flat.slices(batches):
            yield pa.RecordBatch.from_arrays(b.columns, names=names).filter(pa.array(keep(score(b.column("text")))))

    return rows.mapInArrow(run, rows.schema)
