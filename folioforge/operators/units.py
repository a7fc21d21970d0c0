"""Publication of a batch into bucketed tables: works are merged and relationships replaced in the buckets that the batch touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators import versions
from folioforge.sources.buckets import BucketStore
from folioforge.sources.scratch import kept


def publish_unit(store: BucketStore, staged: dict[str, DataFrame], version: str, after_table: Callable[[str], None] | None = None) -> DataFrame:
    """Publish a staged batch of works and relationships as one version of the store; returns the frozen decisions.

    In this order: decisions against the works that the batch may meet, written down; works merged; relationships
    of accepted active works replaced; one pointer for all. Only buckets of works that change are read for the merge and
    written: rejected works (STALE, CONFLICT, RESTORE_REQUIRED) touch none. A NULL or repeated key in what is staged, or
    a failure anywhere (after_table is called when each table is written), leaves the old version as it was.
    """
    works = versions.require_unique(versions.require_columns(staged["works"], ["work_id"]), ["work_id"])
    met = store.touched(works)
    decisions = kept(versions.publication_decisions(works, store.read("works", buckets=met)))
    moved = decisions.where(F.col("publication_decision").isin(*versions.ACCEPTED, "IDENTICAL")).select("work_id")
    scope = versions.relationship_scope(decisions)
    buckets, owned = store.touched(moved), store.touched(scope)
    changes: dict[str, tuple[DataFrame, list[int] | None]] = {}
    for name, rows in staged.items():
        touched = buckets if name == "works" else owned
        if not touched:
            continue
        target = store.read(name, buckets=touched)
        if name == "works":
            changes[name] = versions.merge_works(target, rows.join(moved, "work_id", "left_semi"), decisions), touched
        else:
            changes[name] = versions.replace_by_work(target, versions.require_columns(rows, ["work_id"]), scope), touched
    store.commit(changes, version, after_table)
    return decisions
