"""Corpus pipeline: toxicity, quality, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor kept, and returns a table; all but the
last return the columns of ``documents``. ``run`` writes each stage's rows to the shared folder before the next one
reads them, so a lost executor costs one stage at most. No stage can be expressed in SQL as a whole, so there is no
SQL twin; the operators are tested against brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm.ngram_join import one_of_each
from tidepool.llm.packing import pack
from tidepool.llm.quality import good_only
from tidepool.llm.queries import table, vocabulary
from tidepool.llm.scratch import cut
from tidepool.llm.spans import GAP, without_repeats
from tidepool.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_only(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, k=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs, gap=GAP)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, name.replace(" ", "-"))
    return docs
