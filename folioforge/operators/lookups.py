"""Parameterized query patterns and paged consumer capabilities.

A filter is only built when its argument is given, so Catalyst prunes partitions and pushes it to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.operators.gold import Tables, active_works, citation_edges

WORK_COLUMNS = ["work_id", "work_id_url", "doi", "title", "publication_year", "publication_date", "work_type", "language", "cited_by_count", "is_oa", "oa_status", "primary_source_id", "primary_publisher_id", "source_updated_date", "activity_state", "source_asset_id", "source_checksum_sha256", "lineage_source_updated_date", "run_id", "processed_at"]
PAGE_LIMITS = (50, 200)  # default, largest
YEARS = (1000, 3000)


def years_between(df: DataFrame, year_from: int | None, year_to: int | None) -> DataFrame:
    """Bounds keep only known years in range; without bounds, rows without a year stay."""
    for y in (year_from, year_to):
        if y is not None and not YEARS[0] <= y <= YEARS[1]:
            raise ValueError(f"year must be {YEARS[0]} to {YEARS[1]}")
    if year_from is not None:
        df = df.where(F.col("publication_year") >= year_from)
    return df if year_to is None else df.where(F.col("publication_year") <= year_to)


def _work_row(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in WORK_COLUMNS if c in df.columns])


def doi_work_lookup(t: Tables, doi: str) -> DataFrame:
    """The active work of a DOI; of several, the lowest id."""
    return _work_row(active_works(t["works"]).where(F.col("doi") == doi).orderBy("work_id").limit(1))


def work_id_lookup(t: Tables, work_id: str) -> DataFrame:
    return _work_row(active_works(t["works"]).where(F.col("work_id") == work_id).limit(1))


def publisher_lookup(t: Tables, publisher_id: str) -> DataFrame:
    return t["publishers"].where(F.col("publisher_id") == publisher_id).limit(1)


def _unique_authors(t: Tables, works: DataFrame, name: str, value: str) -> DataFrame:
    authors = t["work_authors"].where("author_id IS NOT NULL").join(works, "work_id", "left_semi")
    return authors.agg(F.countDistinct("author_id").alias("unique_author_count")).select(F.lit(value).alias(name), "unique_author_count")


def unique_authors_per_journal(t: Tables, source_id: str) -> DataFrame:
    works = t["work_locations"].where(F.col("source_id") == source_id).join(active_works(t["works"]).select("work_id"), "work_id", "left_semi").select("work_id")
    return _unique_authors(t, works, "source_id", source_id)


def unique_authors_per_publisher(t: Tables, publisher_id: str) -> DataFrame:
    return _unique_authors(t, active_works(t["works"]).where(F.col("primary_publisher_id") == publisher_id).select("work_id"), "publisher_id", publisher_id)


def publisher_topic_counts(t: Tables, publisher_id: str) -> DataFrame:
    works = active_works(t["works"]).where(F.col("primary_publisher_id") == publisher_id).select("work_id", F.col("primary_publisher_id").alias("publisher_id"))
    return works.join(t["work_topics"], "work_id").groupBy("publisher_id", "topic_id").agg(F.countDistinct("work_id").alias("work_count"))


def publisher_topic_license_year(t: Tables, publisher_id: str | None = None, year_from: int | None = None, year_to: int | None = None) -> DataFrame:
    """Works without a publisher are kept while no publisher is asked for."""
    works = years_between(active_works(t["works"]), year_from, year_to)
    if publisher_id is not None:
        works = works.where(F.col("primary_publisher_id") == publisher_id)
    license_ = t["work_locations"].where("is_primary").select("work_id", F.col("license").alias("primary_location_license"))
    rows = works.select("work_id", F.col("primary_publisher_id").alias("publisher_id"), "publication_year").join(t["work_topics"], "work_id").join(license_, "work_id", "left")
    return rows.groupBy("publisher_id", "topic_id", "primary_location_license", "publication_year").agg(F.countDistinct("work_id").alias("work_count"))


def institution_topic_relationships(t: Tables, institution_id: str) -> DataFrame:
    works = t["work_author_institutions"].where(F.col("institution_id") == institution_id).select("work_id").distinct().join(active_works(t["works"]).select("work_id"), "work_id", "left_semi")
    return works.join(t["work_topics"], "work_id").groupBy("topic_id").agg(F.countDistinct("work_id").alias("work_count")).select(F.lit(institution_id).alias("institution_id"), "topic_id", "work_count")


def citation_relationships(t: Tables, work_id: str) -> DataFrame:
    edges = citation_edges({**t, "work_references": t["work_references"].where(F.col("work_id") == work_id)})
    return edges.orderBy("reference_index")


def publication_trends(t: Tables, year_from: int | None = None, year_to: int | None = None) -> DataFrame:
    return years_between(active_works(t["works"]), year_from, year_to).groupBy("publication_year").agg(F.count("*").alias("work_count")).orderBy("publication_year")


def open_access_trends(t: Tables, year_from: int | None = None, year_to: int | None = None) -> DataFrame:
    return years_between(active_works(t["works"]), year_from, year_to).groupBy("publication_year", "oa_status").agg(F.count("*").alias("work_count")).orderBy("publication_year", "oa_status")


def keyset_page(df: DataFrame, keys: list[str], after: tuple | None, limit: int = PAGE_LIMITS[0]) -> DataFrame:
    """One page in ascending order of keys, NULLs last: rows strictly after the last page's keys, one more than limit.

    The extra row tells that there is a next page; the keys of the limit-th row are the next `after`.
    """
    if not 1 <= limit <= PAGE_LIMITS[1]:
        raise ValueError(f"limit must be 1 to {PAGE_LIMITS[1]}")
    if after is not None:
        beyond: Column = F.lit(False)
        for i, (key, value) in enumerate(zip(keys, after, strict=True)):
            same = F.lit(True)
            for k, v in zip(keys[:i], after[:i], strict=True):
                same = same & F.col(k).eqNullSafe(F.lit(v))
            more = F.lit(False) if value is None else F.col(key).isNull() | (F.col(key) > F.lit(value))
            beyond = beyond | (same & more)
        df = df.where(beyond)
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(limit + 1)


def get_work(discovery: DataFrame, work_id: str | None = None, doi: str | None = None) -> DataFrame:
    """Exactly one of work_id and doi; no row if the work is unknown or deleted."""
    given = [x.strip() for x in (work_id, doi) if x is not None and x.strip()]
    if len(given) != 1:
        raise ValueError("give exactly one of work_id and doi")
    column = "work_id" if work_id is not None and work_id.strip() else "doi"
    return discovery.where(F.col(column) == given[0]).orderBy("work_id").limit(1)


def search_research(
    discovery: DataFrame,
    publisher_id: str | None = None,
    source_id: str | None = None,
    work_type: str | None = None,
    language: str | None = None,
    oa_status: str | None = None,
    topic_id: str | None = None,
    institution_id: str | None = None,
    author_id: str | None = None,
    year_from: int | None = None,
    year_to: int | None = None,
    after: str | None = None,
    limit: int = PAGE_LIMITS[0],
) -> DataFrame:
    """Discovery rows that meet all given filters, by work_id, one page after `after`."""
    df = years_between(discovery, year_from, year_to)
    for column, value in (("primary_publisher_id", publisher_id), ("primary_source_id", source_id), ("work_type", work_type), ("language", language), ("oa_status", oa_status)):
        if value is not None:
            df = df.where(F.col(column) == value)
    for column, value in (("topic_ids", topic_id), ("institution_ids", institution_id), ("author_ids", author_id)):
        if value is not None:
            df = df.where(F.array_contains(column, value))
    return keyset_page(df, ["work_id"], None if after is None else (after,), limit)


def journal_metrics(journal_stats: DataFrame, source_id: str) -> DataFrame:
    return journal_stats.where(F.col("source_id") == source_id)


def publisher_summary(publisher_stats: DataFrame, publisher_id: str) -> DataFrame:
    return publisher_stats.where(F.col("publisher_id") == publisher_id)


def publisher_topic_analytics(year_stats: DataFrame, publisher_id: str, topic_id: str | None = None, year_from: int | None = None, year_to: int | None = None, after: tuple | None = None, limit: int = PAGE_LIMITS[0]) -> DataFrame:
    df = years_between(year_stats.where(F.col("publisher_id") == publisher_id), year_from, year_to)
    if topic_id is not None:
        df = df.where(F.col("topic_id") == topic_id)
    return keyset_page(df, ["publication_year", "topic_id"], after, limit)


def freshness(works: DataFrame) -> DataFrame:
    """One row: whether there is any work, the newest source date, and the newest run."""
    return works.agg(F.when(F.count("*") > 0, "AVAILABLE").otherwise("EMPTY").alias("status"), F.max("lineage_source_updated_date").alias("source_max_date"), F.max("run_id").alias("run_id"))
