"""The corpus pipeline: language ID, near-dedup, substring dedup, decontamination, packing.

Every stage takes the documents its predecessor kept and returns documents with
the same columns; the last returns packed pieces.  Stages are written to the
shared folder and read again, so a lost executor costs part of one stage.

* ``language_id`` drops texts without a letter and those whose language the
  model, trained on the labelled documents at hand, is not sure of;
* ``near_dedup`` keeps the smallest id of every group of near copies;
* ``substring_dedup`` cuts passages of 50 words or more that an earlier document
  holds, and drops documents that lose every word;
* ``decontaminate`` drops documents that contain a benchmark item;
* ``packing`` packs what is left into sequences of 2048 tokens.

Documents with a null id pass the middle stages unchanged; an empty table
passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revisor.llm import decontaminate, langid, neardup, packing, substrings
from revisor.llm.common import staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, langid.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express sketches, anchors, random walks or packing; tests run a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
