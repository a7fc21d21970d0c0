"""A training-corpus pipeline: documents in, shards of a decontaminated mixture out.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and decides by row_key (id and text); a decision
is a narrow table, written to the shared folder, so that the planner broadcasts it while it is small and shuffles beyond.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import classifier, decontaminate, mixing, neardup, sharding
from folioforge.llm.common import kept_table, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keyed(docs: DataFrame) -> DataFrame:
    """docs with row_key, 64 hashed bits of id and text: rows without an id, or that share one, are told apart by their texts."""
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    return docs.select(*COLUMNS, key.alias("row_key"))


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """docs but for those whose row_key is in rejected."""
    rejected = kept_table(rejected.select("row_key").distinct())
    return keyed(docs).join(rejected, "row_key", "left_anti").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier samples; rejected ones and those without text go.

    Rows are told apart by id and text, NULL ids included; repeated rows are judged alike. Without good labels all
    documents with text stay; an empty table gives none.
    """
    judged = classifier.classify(keyed(docs), table(spark, sf_dir, "labels"), key_col="row_key")
    return without(docs, judged.where("NOT kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id, one without an id only where none has any.

    Rows that share an id, or have none, are documents of their own, unless they have the same text: these count once. At
    ties the smaller row_key stays. Documents without words stay as they are. An empty table gives none.
    """
    rows = keyed(docs)
    groups = neardup.near_duplicates(rows, id_col="row_key").select(F.col("doc_id").alias("row_key"), "component_id").distinct()
    members = kept_table(groups.join(rows.select("row_key", "doc_id").distinct(), "row_key"))
    first = kept_table(members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first")))
    kept = without(docs, members.join(first, "component_id").where("row_key <> first.row_key"))
    if rows.groupBy("row_key").count().where("count > 1").isEmpty():
        return kept
    return keyed(kept).dropDuplicates(["row_key"]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark. Rows are told apart by id and text; repeated rows go or stay together; empty tables take nothing away."""
    leaks = decontaminate.find_leaks(keyed(docs), table(spark, sf_dir, "benchmark"), id_col="row_key")
    return without(docs, leaks.withColumnRenamed("doc_id", "row_key"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture reads it: at least once, small sources up to twice.

    Rows are told apart by id and text; repeated rows are each read; an empty table gives none.
    """
    return mixing.repeated(keyed(docs), COLUMNS, max_repetition=2.0, id_col="row_key")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each row of the mixture: repeated rows and NULL ids have a slot each; an empty table gives none."""
    return sharding.assign_shards(docs, 16)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontamination),
    ("source mixing", source_mix),
    ("sharding", shards),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = kept_table(docs)
    return docs
