"""A training corpus from documents: good ones, one of each near-copy, none that leak, mixed and sharded.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and returns the columns of
``documents``; the last returns where each row goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapdelta.llm import decontaminate, mixing, near_dedup, resampling, sharding
from snapdelta.llm.frames import given, stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return resampling.keep_good(docs, given(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, given(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_by_mix(docs, F.array("source"))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(docs)


STAGES = [
    ("quality", good_documents),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("sharding", sharded),
]

#: No SQL: the classifier and the signatures have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
