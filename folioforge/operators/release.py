"""Releases: replay from raw observations, render, describe, validate and reconcile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.operators.aggregates import content_fingerprint, fingerprint
from folioforge.operators.entities import reconcile_entities
from folioforge.operators.versions import AssetFold, outcomes_of, winning_relationships
from folioforge.operators.publication import numbered
from folioforge.plans import schemas
from folioforge.sources.scratch import kept, path_exists
from folioforge.sources.writers import append_log


def replay(observations: DataFrame, relationships: dict[str, DataFrame], described: dict[str, tuple[DataFrame, list[str]]], parent: dict[str, DataFrame] | None = None) -> tuple[dict[str, DataFrame], list[int]]:
    """Rebuild state from nothing, or from the tables of a parent: works, barriers, relationships of winning observations and reconciled entities.

    relationships: rows of (work_id, seq, pos, ...). described: entity table -> (rows of (key, fields, date, work_id,
    seq, pos), fields). An asset is left out as a whole if one of its works aborts, or if one of its descriptions of an
    entity clashes with an earlier one without a date to order them. All assets are judged at once and in rounds
    (AssetFold); a round folds again only works and entities that changed assets touch. Returns the tables and the assets left out.

    parent: what an earlier call returned, over assets that all come before the given ones. Only the new assets are read then,
    and the tables equal those of a replay of old and new assets from nothing; conditions of a parent's inputs are parent_mismatches'.
    """
    fold, fed, entities = AssetFold(observations, None if parent is None else fold_state(parent)), None, {}
    while True:
        before, fed = fed, kept(fold.fed())
        clashes, other = [], None
        if before is not None:
            other = kept(fed.join(before, fed.columns, "left_anti").unionByName(before.join(fed, fed.columns, "left_anti")))
        for name, (rows, fields) in described.items():
            key, live = schemas.ENTITIES[name], rows.join(fed, ["work_id", "seq", "pos"])
            stored = None if parent is None else parent[name]
            if other is None:
                entities[name] = kept(reconcile_entities(live, key, fields, stored))
            else:
                touched = kept(rows.join(other, ["work_id", "seq", "pos"], "left_semi").select(key).distinct())
                old = None if stored is None else stored.join(touched, key, "left_semi")
                again = reconcile_entities(live.join(touched, key, "left_semi"), key, fields, old)
                entities[name] = kept(entities[name].join(touched, key, "left_anti").unionByName(again))
            clashes.append(entities[name].select(F.explode("conflict_seqs").alias("seq")))
        if not fold.guess(reduce(DataFrame.unionByName, clashes, fold.aborting()).distinct()):
            break
    folded, dropped = fold.result()
    out = {"works": folded.where("state IS NOT NULL").drop("outcomes"), "barriers": folded.where("barrier IS NOT NULL").select("work_id", F.col("barrier").alias("deleted_date"))}
    for name, rows in relationships.items():
        both = rows if parent is None else parent[name].unionByName(rows)
        out[name] = winning_relationships(both, folded)
    for name, df in entities.items():
        out[name] = df.where("known").drop("conflicts", "conflict_seqs", "known")
    out["outcomes"] = outcomes_of(folded) if parent is None else parent["outcomes"].unionByName(outcomes_of(folded))
    return out, dropped


def fold_state(tables: dict[str, DataFrame]) -> DataFrame:
    """Where a fold of works goes on from the tables of a replay: its works, and the barriers of works that were never seen."""
    unseen = tables["barriers"].join(tables["works"], "work_id", "left_anti").select("work_id", F.col("deleted_date").alias("barrier"))
    return tables["works"].unionByName(unseen, allowMissingColumns=True)


def render_release(tables: dict[str, DataFrame], folder: str, rows_per_part: int) -> DataFrame:
    """Write each table sorted by its key in parts of at most rows_per_part rows; returns (table_name, file_name, rows)."""
    for name, df in tables.items():
        keys = [k for k in schemas.KEYS.get(name, [df.columns[0]]) if k in df.columns]
        df.orderBy(*keys).write.mode("errorifexists").option("maxRecordsPerFile", rows_per_part).parquet(f"{folder}/{name}")
    return part_counts(next(iter(tables.values())).sparkSession, folder, list(tables))


def render_exact_parts(tables: dict[str, DataFrame], folder: str, rows_per_part: int) -> DataFrame:
    """Write each table in order of its key, cut by row number: all parts but the last hold exactly rows_per_part rows.

    A part is one file in a folder of its number, whatever the number of tasks, so the same rows give the same parts.
    An empty table has its schema but no part. Returns (table_name, part, rows, low, high), the bounds by the first key.
    """
    out = None
    for name, df in tables.items():
        keys = [k for k in schemas.KEYS.get(name, [df.columns[0]]) if k in df.columns]
        placed = numbered(df, *keys, name="_row").withColumn("part", F.expr(f"(_row - 1) div {rows_per_part}"))
        placed.repartition("part").sortWithinPartitions("part", "_row").drop("_row").write.mode("errorifexists").partitionBy("part").parquet(f"{folder}/{name}")
        stored = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("part", T.LongType())])).parquet(f"{folder}/{name}")
        part = stored.groupBy("part").agg(F.count("*").alias("rows"), F.min(keys[0]).alias("low"), F.max(keys[0]).alias("high")).select(F.lit(name).alias("table_name"), "part", "rows", F.col("low").cast("string"), F.col("high").cast("string"))
        out = part if out is None else out.unionByName(part)
    return out


def part_counts(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    out = None
    for name in names:
        part = spark.read.parquet(f"{folder}/{name}").groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "file_name", "rows")
        out = part if out is None else out.unionByName(part)
    return out


def release_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, schema_fingerprint, row_count, hash_xor, hash_sum, active, deleted) of each table."""
    out = None
    for name, df in tables.items():
        state = F.col("activity_state") if "activity_state" in df.columns else F.lit(None).cast("string")
        states = df.agg(F.count_if(state == "ACTIVE").alias("active"), F.count_if(state == "DELETED").alias("deleted"))
        schema = schemas.fingerprint(name) if name in schemas.COLUMNS else None
        part = fingerprint(df).crossJoin(states).select(F.lit(name).alias("table_name"), F.lit(schema).cast("string").alias("schema_fingerprint"), "row_count", "hash_xor", "hash_sum", "active", "deleted")  # one row each
        out = part if out is None else out.unionByName(part)
    return out


def compare_manifests(stated: DataFrame, found: DataFrame) -> DataFrame:
    """(table_name, fact) for each fact that differs or stands on one side only."""
    facts = [c for c in stated.columns if c != "table_name"]
    joined = stated.alias("s").join(found.alias("f"), "table_name", "full")
    differs = F.filter(F.array(*[F.when(~F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")), F.lit(c)) for c in facts]), lambda x: x.isNotNull())
    return joined.select("table_name", F.explode(differs).alias("fact"))


def validate_release(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Re-read the tables, recompute their facts, and list what the manifest states otherwise."""
    names = [r["table_name"] for r in manifest.select("table_name").collect()]  # one row for each table
    return compare_manifests(manifest, release_manifest({n: spark.read.parquet(f"{folder}/{n}") for n in names}))


def reconcile_release(released: dict[str, DataFrame], rebuilt: dict[str, DataFrame]) -> DataFrame:
    """(table_name, only_released, only_rebuilt): rows by which two builds of the same tables differ."""
    out = None
    for name, df in released.items():
        other = rebuilt[name].select(*df.columns)
        part = df.exceptAll(other).agg(F.count("*").alias("only_released")).crossJoin(other.exceptAll(df).agg(F.count("*").alias("only_rebuilt")))  # one row each
        part = part.select(F.lit(name).alias("table_name"), "only_released", "only_rebuilt")
        out = part if out is None else out.unionByName(part)
    return out


def input_balance(inputs: DataFrame) -> DataFrame:
    """Inputs (asset, lines, records, rejected, outcomes, rows, unique_rows, duplicates) that break a law of balance."""
    laws = {
        "lines": F.col("lines") == F.col("records") + F.col("rejected"),
        "outcomes": F.col("records") == F.col("outcomes"),
        "rows": F.col("rows") == F.col("unique_rows") + F.col("duplicates"),
    }
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in laws.items()]), lambda x: x.isNotNull())
    return inputs.select("asset", F.explode(broken).alias("law"))


def record_publication(spark: SparkSession, folder: str, sequence: int, release_id: str, manifest: DataFrame, gate_passed: bool, previous: str | None) -> None:
    """Append one publication row; the same (sequence, release) with other content is an error, with the same a no-op."""
    row = spark.createDataFrame([(sequence, release_id, content_fingerprint(manifest), gate_passed, previous)], "sequence long, release_id string, manifest_fingerprint string, gate_passed boolean, previous string")
    if path_exists(spark, folder):
        same = spark.read.schema(row.schema).parquet(folder).where((F.col("sequence") == sequence) & (F.col("release_id") == release_id))
        if not same.join(row, row.columns, "left_anti").drop("previous").isEmpty() and not same.drop("previous").exceptAll(row.drop("previous")).isEmpty():
            raise ValueError(f"publication {sequence} of {release_id} is recorded with other content")
    append_log(row, folder, ["sequence", "release_id"])


def parent_mismatches(parent_inputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """Inputs of a parent release that are not, in the same place and the same, among the first inputs of the new one."""
    return parent_inputs.join(inputs.select(*parent_inputs.columns), parent_inputs.columns, "left_anti")
