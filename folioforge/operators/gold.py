"""Gold marts over the canonical tables. Each takes a dict of tables; only ACTIVE works contribute.

Fan-out is avoided by shape: relations are made distinct before they are joined, and independent counts are
aggregated apart and joined at one grain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.scalars import empty_if_null, sorted_set

Tables = dict[str, DataFrame]
DISCOVERY = ["work_id", "doi", "title", "publication_year", "publication_date", "work_type", "language", "is_oa", "oa_status", "primary_source_id", "primary_publisher_id"]


def active_works(works: DataFrame) -> DataFrame:
    return works.where("activity_state = 'ACTIVE'")


def deleted_works(works: DataFrame) -> DataFrame:
    return works.where("activity_state = 'DELETED'")


def _active_ids(t: Tables) -> DataFrame:
    return active_works(t["works"]).select("work_id")


def _sets(relation: DataFrame, ids: DataFrame, column: str, name: str) -> DataFrame:
    return relation.join(ids, "work_id", "left_semi").groupBy("work_id").agg(sorted_set(F.col(column)).alias(name))


def research_discovery(t: Tables) -> DataFrame:
    """One row for each active work, with sorted distinct authors, topics and institutions (empty arrays if none)."""
    works, ids = active_works(t["works"]).select(*DISCOVERY), _active_ids(t)
    for relation, column, name in (("work_authors", "author_id", "author_ids"), ("work_topics", "topic_id", "topic_ids"), ("work_author_institutions", "institution_id", "institution_ids")):
        works = works.join(_sets(t[relation], ids, column, name), "work_id", "left").withColumn(name, empty_if_null(F.col(name)))
    return works


def _author_stats(pairs: DataFrame, authors: DataFrame, key: str) -> DataFrame:
    counts = pairs.groupBy(key).agg(F.count("*").alias("active_work_count"))
    distinct = pairs.join(authors.where("author_id IS NOT NULL").select("work_id", "author_id"), "work_id").groupBy(key).agg(F.countDistinct("author_id").alias("unique_author_count"))
    return counts.join(distinct, key, "left").select(key, F.coalesce("unique_author_count", F.lit(0)).alias("unique_author_count"), "active_work_count")


def journal_author_stats(t: Tables) -> DataFrame:
    pairs = t["work_locations"].where("source_id IS NOT NULL").join(_active_ids(t), "work_id", "left_semi").select("source_id", "work_id").distinct()
    return _author_stats(pairs, t["work_authors"], "source_id")


def publisher_author_stats(t: Tables) -> DataFrame:
    pairs = active_works(t["works"]).where("primary_publisher_id IS NOT NULL").select(F.col("primary_publisher_id").alias("publisher_id"), "work_id")
    return _author_stats(pairs, t["work_authors"], "publisher_id")


def _publisher_topics(t: Tables) -> DataFrame:
    works = active_works(t["works"]).where("primary_publisher_id IS NOT NULL").select("work_id", F.col("primary_publisher_id").alias("publisher_id"), "publication_year")
    return works.join(t["work_topics"].where("topic_id IS NOT NULL").select("work_id", "topic_id").distinct(), "work_id")


def publisher_topic_year_stats(t: Tables) -> DataFrame:
    """(work, topic) is made distinct first, so a plain count is the distinct count of works."""
    return _publisher_topics(t).groupBy("publisher_id", "topic_id", "publication_year").agg(F.count("*").alias("active_work_count"))


def publisher_topic_license_year_stats(t: Tables) -> DataFrame:
    """License of the primary location; a NULL license is a bucket of its own."""
    license_ = t["work_locations"].where("is_primary").select("work_id", F.col("license").alias("primary_location_license"))
    rows = _publisher_topics(t).join(license_, "work_id", "left")
    return rows.groupBy("publisher_id", "topic_id", "primary_location_license", "publication_year").agg(F.countDistinct("work_id").alias("active_work_count"))


def institution_topic_stats(t: Tables) -> DataFrame:
    pairs = t["work_author_institutions"].where("institution_id IS NOT NULL").join(_active_ids(t), "work_id", "left_semi").select("institution_id", "work_id").distinct()
    topics = t["work_topics"].where("topic_id IS NOT NULL").select("work_id", "topic_id").distinct()
    return pairs.join(topics, "work_id").groupBy("institution_id", "topic_id").agg(F.count("*").alias("active_work_count"))


def publication_trends(t: Tables) -> DataFrame:
    return active_works(t["works"]).groupBy("publication_year").agg(F.count("*").alias("work_count"))


def open_access_trends(t: Tables) -> DataFrame:
    return active_works(t["works"]).groupBy("publication_year", "oa_status").agg(F.count("*").alias("work_count"))


def citation_edges(t: Tables) -> DataFrame:
    """References of active works with the state of their target: ACTIVE, DELETED, or NULL where it is not known."""
    target = t["works"].select(F.col("work_id").alias("referenced_work_id"), F.col("activity_state").alias("target_activity_state"))
    edges = with_target(t["work_references"].join(_active_ids(t), "work_id", "left_semi"), target)
    return edges.select(F.col("work_id").alias("source_work_id"), "reference_index", "referenced_work_id", "reference_status", "target_activity_state")


def with_target(references: DataFrame, target: DataFrame) -> DataFrame:
    """References left-joined with (referenced_work_id, ...). Those that name no work are not shuffled: they would all meet in one task."""
    added = [c for c in target.columns if c != "referenced_work_id"]
    resolved = references.where("referenced_work_id IS NOT NULL").join(target, "referenced_work_id", "left")
    rest = references.where("referenced_work_id IS NULL").select("*", *[F.lit(None).cast(dict(target.dtypes)[c]).alias(c) for c in added])
    return resolved.unionByName(rest)


MARTS: dict[str, Callable[[Tables], DataFrame]] = {
    f.__name__: f
    for f in (research_discovery, journal_author_stats, publisher_author_stats, publisher_topic_year_stats, publisher_topic_license_year_stats, institution_topic_stats, publication_trends, open_access_trends, citation_edges)
}


def mart_manifest(spark) -> DataFrame:
    return spark.createDataFrame([(m,) for m in MARTS], "mart_id string")


def work_contributions(t: Tables) -> DataFrame:
    """(mart_id, work_id): the active works that feed each mart, once each."""
    works, ids = active_works(t["works"]), _active_ids(t)
    publishers = works.where("primary_publisher_id IS NOT NULL").select("work_id")
    related = lambda name, column=None: (t[name].where(f"{column} IS NOT NULL") if column else t[name]).select("work_id").distinct()
    topics = related("work_topics", "topic_id")
    feeding = {
        "research_discovery": ids,
        "journal_author_stats": ids.join(related("work_locations", "source_id"), "work_id", "left_semi"),
        "publisher_author_stats": publishers,
        "publisher_topic_year_stats": publishers.join(topics, "work_id", "left_semi"),
        "publisher_topic_license_year_stats": publishers.join(topics, "work_id", "left_semi"),
        "institution_topic_stats": ids.join(related("work_author_institutions", "institution_id"), "work_id", "left_semi").join(topics, "work_id", "left_semi"),
        "publication_trends": ids,
        "open_access_trends": ids,
        "citation_edges": ids.join(related("work_references"), "work_id", "left_semi"),
    }
    out = None
    for mart, works_of in feeding.items():
        part = works_of.select(F.lit(mart).alias("mart_id"), "work_id")
        out = part if out is None else out.unionByName(part)
    return out


def staged_citation_edges(t: Tables) -> DataFrame:
    return citation_edges(t).select("source_work_id", "reference_index", F.col("referenced_work_id").alias("target_work_id"), "target_activity_state")


def build_all(t: Tables) -> dict[str, DataFrame]:
    """All marts over the same tables, which should be stored ones, as each mart reads them."""
    return {name: mart(t) for name, mart in MARTS.items()}


def row_counts(marts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in marts.items():
        part = df.agg(F.lit(name).alias("mart_id"), F.count("*").alias("row_count"))
        out = part if out is None else out.unionByName(part)
    return out
