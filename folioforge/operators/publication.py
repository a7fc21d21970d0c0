"""Publication: which assets to work on, how a version becomes visible, and which mart rows a change touches."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.operators import gold
from folioforge.operators.aggregates import content_fingerprint
from folioforge.operators.gold import Tables
from folioforge.sources.scratch import kept, path_exists

IDENTITY = ("source", "entity", "source_uri", "snapshot_date", "updated_date", "content_format")


def classify_assets(incoming: DataFrame, ledger: DataFrame) -> DataFrame:
    """incoming with outcome: CREATED, IDEMPOTENT_REPLAY, ALREADY_SUCCESS, ALREADY_IN_PROGRESS, RETRYABLE_FAILURE, CHECKSUM_CONFLICT or IDENTITY_CONFLICT.

    An asset whose identity columns or known sizes differ from the ledger's is an IDENTITY_CONFLICT, which stops a run.
    """
    same = F.lit(True)
    for c in (c for c in IDENTITY if c in incoming.columns):
        same = same & F.col(f"i.{c}").eqNullSafe(F.col(f"l.{c}"))
    differs = lambda c: F.coalesce(F.col(f"i.{c}") != F.col(f"l.{c}"), F.lit(False))
    outcome = (
        F.when(F.col("l.asset_id").isNull(), "CREATED")
        .when(~same | differs("byte_size"), "IDENTITY_CONFLICT")
        .when(differs("checksum"), "CHECKSUM_CONFLICT")
        .when(F.col("l.status") == "SUCCESS", "ALREADY_SUCCESS")
        .when(F.col("l.status") == "PROCESSING", "ALREADY_IN_PROGRESS")
        .when(F.col("l.status") == "FAILED", "RETRYABLE_FAILURE")
        .otherwise("IDEMPOTENT_REPLAY")
    )
    return incoming.alias("i").join(ledger.alias("l"), F.col("i.asset_id") == F.col("l.asset_id"), "left").select("i.*", outcome.alias("outcome"))


def skip_reason(max_bytes: int, updated_date: date | None = None, entity: str = "works", formats: tuple[str, ...] = ("jsonl", "parquet")) -> Column:
    """The first reason for which an asset can't be taken, or NULL."""
    other_date = F.lit(False) if updated_date is None else ~F.col("updated_date").eqNullSafe(F.lit(updated_date))
    return (
        F.when(F.col("entity") != entity, "WRONG_ENTITY")
        .when(~F.col("format").isin(*formats), "UNSUPPORTED_FORMAT")
        .when(other_date, "UPDATED_DATE_MISMATCH")
        .when(F.col("byte_size").isNull(), "UNKNOWN_SIZE")
        .when(F.col("byte_size") < 0, "INVALID_SIZE")
        .when(F.col("byte_size") > max_bytes, "OVERSIZED")
    )


def select_assets(assets: DataFrame, n: int, max_bytes: int, updated_date: date | None = None) -> DataFrame:
    """assets with reason: NULL for the n smallest eligible ones, FILE_LIMIT_REACHED for the other eligible ones.

    Order: size, undated before dated, date, uri, id. The n rows are found by a distributed top-n and joined back.
    """
    marked = assets.withColumn("reason", skip_reason(max_bytes, updated_date))
    order = [F.col("byte_size"), F.col("updated_date").isNotNull(), F.col("updated_date"), F.col("file_uri"), F.col("asset_id")]
    first = marked.where("reason IS NULL").orderBy(*order).limit(n).select("asset_id", "file_uri").withColumn("taken", F.lit(True))
    joined = marked.join(first, ["asset_id", "file_uri"], "left")
    return joined.withColumn("reason", F.when(F.col("reason").isNull() & F.col("taken").isNull(), "FILE_LIMIT_REACHED").otherwise(F.col("reason"))).drop("taken")


def backfill_window(assets: DataFrame, first: date, last: date, max_days: int, max_files: int) -> DataFrame:
    """Assets dated in a bounded span, the earliest max_files of them."""
    if not 0 <= (last - first).days < max_days:
        raise ValueError(f"the span must be 1 to {max_days} days")
    return assets.where(F.col("updated_date").between(F.lit(first), F.lit(last))).orderBy("updated_date", "file_uri", "asset_id").limit(max_files)


def unique_assets(assets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Assets without exact repeats, and the ids whose descriptions differ."""
    unique = assets.dropDuplicates()
    return unique, unique.groupBy("asset_id").agg(F.count("*").alias("descriptions")).where("descriptions > 1")


def commit_assets(rows: DataFrame, errors: Column) -> DataFrame:
    """Rows of assets none of whose records has an error: an asset counts as a whole or not at all."""
    bad = rows.where(errors).select("asset").distinct()
    return rows.join(bad, "asset", "left_anti")


# --- versions of a published directory: one writer at a time is the condition ------------------------------------


def _pointer(spark: SparkSession, root: str) -> DataFrame | None:
    there = path_exists(spark, f"{root}/pointer")
    return spark.read.schema("sequence long, version string, fingerprint string, previous string").parquet(f"{root}/pointer") if there else None


def active_version(spark: SparkSession, root: str) -> dict | None:
    """The pointer row of the highest sequence."""
    pointer = _pointer(spark, root)
    if pointer is None:
        return None
    row = pointer.orderBy(F.col("sequence").desc()).first()
    return row.asDict() if row else None


def stage(df: DataFrame, root: str, version: str) -> str:
    """Write a version's directory and return its fingerprint; the same content again is a no-op, other content an error."""
    spark, path = df.sparkSession, f"{root}/versions/{version}"
    fingerprint = content_fingerprint(df)
    if path_exists(spark, path):
        if content_fingerprint(spark.read.parquet(path)) != fingerprint:
            raise ValueError(f"version {version} is there with other content")
        return fingerprint
    df.write.parquet(path)
    return fingerprint


def activate(spark: SparkSession, root: str, version: str, fingerprint: str) -> None:
    """Append a pointer row; readers follow the highest sequence, so the swap is one small commit."""
    now = active_version(spark, root)
    if now and now["version"] == version and now["fingerprint"] == fingerprint:
        return
    row = [((now["sequence"] + 1) if now else 0, version, fingerprint, now["version"] if now else None)]
    spark.createDataFrame(row, "sequence long, version string, fingerprint string, previous string").coalesce(1).write.mode("append").parquet(f"{root}/pointer")


def restore(spark: SparkSession, root: str) -> None:
    """Point back to the version before the active one."""
    now = active_version(spark, root)
    if not now or now["previous"] is None:
        raise ValueError("there is no version to go back to")
    old = spark.read.parquet(f"{root}/versions/{now['previous']}")
    activate(spark, root, now["previous"], content_fingerprint(old))


def restore_if_any(spark: SparkSession, root: str) -> None:
    """Point back where there is an earlier version; a first version stays, as nothing was served before it."""
    now = active_version(spark, root)
    if now and now["previous"] is not None:
        restore(spark, root)


def read_active(spark: SparkSession, root: str) -> DataFrame:
    now = active_version(spark, root)
    if now is None:
        raise ValueError("nothing is published")
    return spark.read.parquet(f"{root}/versions/{now['version']}")


def new_version() -> str:
    return uuid.uuid4().hex


def final_validation(discovery: DataFrame, lookup: DataFrame, works: DataFrame) -> DataFrame:
    """(rule, violations): deleted works in what is served, and repeated works, which would break paging."""
    gone = works.where("activity_state = 'DELETED'").select("work_id")
    rules = {
        "deleted_in_discovery": discovery.join(gone, "work_id", "left_semi"),
        "deleted_in_lookup": lookup.join(gone, "work_id", "left_semi"),
        "repeated_in_discovery": discovery.groupBy("work_id").count().where("count > 1"),
    }
    out = None
    for rule, rows in rules.items():
        part = rows.agg(F.lit(rule).alias("rule"), F.count("*").alias("violations"))
        out = part if out is None else out.unionByName(part)
    return out


# --- incremental refresh of marts ----------------------------------------------------------------------------------

# mart -> (relation that ties a work to the mart's keys, column there, column of the mart)
SCOPES = {
    "research_discovery": ("works", "work_id", "work_id"),
    "journal_author_stats": ("work_locations", "source_id", "source_id"),
    "publisher_author_stats": ("works", "primary_publisher_id", "publisher_id"),
    "publisher_topic_year_stats": ("works", "primary_publisher_id", "publisher_id"),
    "publisher_topic_license_year_stats": ("works", "primary_publisher_id", "publisher_id"),
    "institution_topic_stats": ("work_author_institutions", "institution_id", "institution_id"),
    "publication_trends": ("works", "publication_year", "publication_year"),
    "open_access_trends": ("works", "publication_year", "publication_year"),
    "citation_edges": ("works", "work_id", "source_work_id"),
}


def refresh_scope(old: Tables, new: Tables, changed: DataFrame, mart: str) -> DataFrame:
    """Distinct keys of a mart that a change touches: the changed works' keys before and after.

    For citation edges also the works that cite a changed one, as its state stands on their edges.
    """
    relation, column, key = SCOPES[mart]
    keys = [t[relation].join(changed, "work_id", "left_semi").select(F.col(column).alias(key)) for t in (old, new)]
    if mart == "citation_edges":
        target = changed.select(F.col("work_id").alias("referenced_work_id"))
        keys += [t["work_references"].join(target, "referenced_work_id", "left_semi").select(F.col("work_id").alias(key)) for t in (old, new)]
    out = keys[0]
    for k in keys[1:]:
        out = out.unionByName(k)
    return out.distinct()


def refresh_mart(mart_rows: DataFrame, new: Tables, scope: DataFrame, mart: str) -> DataFrame:
    """The mart's next version: rows of keys in scope are recomputed from the new tables, all others stay."""
    _, _, key = SCOPES[mart]
    relation, column, _ = SCOPES[mart]
    marked = scope.select(F.col(key).alias("_key"))
    same = lambda df, c: F.col(c).eqNullSafe(F.col("_key"))
    kept = mart_rows.join(marked, same(mart_rows, key), "left_anti")
    if mart == "citation_edges":
        part = {**new, "work_references": new["work_references"].join(marked, same(None, "work_id"), "left_semi")}
    else:
        works = new[relation].join(marked, same(None, column), "left_semi").select("work_id").distinct()
        part = {**new, "works": new["works"].join(works, "work_id", "left_semi")}
    fresh = gold.MARTS[mart](part).join(marked, same(None, key), "left_semi")
    return kept.unionByName(fresh.select(*mart_rows.columns))


def numbered(df: DataFrame, *keys: str, name: str = "seq") -> DataFrame:
    """Rows with their place in the order of the keys, from 1.

    Rows are sorted into ranges, numbered inside each, and moved by the rows of the ranges before; no task sees them all.
    """
    ranged = df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    inside = kept(ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*keys))))
    sizes = inside.groupBy("_part").agg(F.count("*").alias("c"))
    ahead = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    before = sizes.select("_part", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("before"))
    return inside.join(F.broadcast(before), "_part").withColumn(name, (F.col("before") + F.col("_n")).cast("long")).drop("_part", "_n", "before")


def frozen_decision_order(df: DataFrame) -> DataFrame:
    """Numbers of assets (seq) in their order of processing, from 1."""
    return numbered(df, "processed_at", "asset_id")
