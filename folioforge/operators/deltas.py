"""Marts kept up by deltas: what changed works contributed before is taken off, what they contribute now is added.

Only rows of changed works are read from the canonical tables. Counts of works are sums over works, so a mart over the changed
works alone is its own delta. Distinct authors are kept by reference counts: of how many works tie an author to a key;
an author counts while that number is above zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators import gold
from folioforge.operators.gold import Tables

#: Marts whose last column counts works by all their others.
COUNTED = ("publisher_topic_year_stats", "publisher_topic_license_year_stats", "institution_topic_stats", "publication_trends", "open_access_trends")
#: Marts of distinct authors, with their key.
AUTHORED = {"journal_author_stats": "source_id", "publisher_author_stats": "publisher_id"}


def part_of(t: Tables, changed: DataFrame) -> Tables:
    """The tables' rows of changed works."""
    return {name: df.join(changed, "work_id", "left_semi") for name, df in t.items()}


def signed(before: DataFrame, now: DataFrame, keys: list[str], count: str) -> DataFrame:
    """now minus before, for keys where they differ; NULL keys are keys."""
    both = now.unionByName(before.withColumn(count, -F.col(count)))
    return both.groupBy(*keys).agg(F.sum(count).alias(count)).where(F.col(count) != 0)


def added(rows: DataFrame, delta: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Counts after a signed change; a key whose count is down to zero goes."""
    return rows.unionByName(delta.select(*rows.columns)).groupBy(*keys).agg(F.sum(count).alias(count)).where(F.col(count) > 0).select(*rows.columns)


def ties(t: Tables, mart: str) -> DataFrame:
    """(key, work_id) of active works, once each."""
    active = gold.active_works(t["works"])
    if mart == "publisher_author_stats":
        return active.where("primary_publisher_id IS NOT NULL").select(F.col("primary_publisher_id").alias("publisher_id"), "work_id")
    return t["work_locations"].where("source_id IS NOT NULL").join(active.select("work_id"), "work_id", "left_semi").select("source_id", "work_id").distinct()


def author_counts(t: Tables, mart: str) -> DataFrame:
    """(key, author_id, n): how many active works tie the author to the key."""
    authors = t["work_authors"].where("author_id IS NOT NULL").select("work_id", "author_id").distinct()
    return ties(t, mart).join(authors, "work_id").groupBy(AUTHORED[mart], "author_id").agg(F.count("*").alias("n"))


def work_counts(t: Tables, mart: str) -> DataFrame:
    return ties(t, mart).groupBy(AUTHORED[mart]).agg(F.count("*").alias("active_work_count"))


def refresh_authored(rows: DataFrame, counts: DataFrame, before: Tables, now: Tables, mart: str) -> tuple[DataFrame, DataFrame]:
    """A mart of distinct authors and its reference counts after a change."""
    key = AUTHORED[mart]
    pairs = signed(author_counts(before, mart), author_counts(now, mart), [key, "author_id"], "n")
    had = pairs.withColumnRenamed("n", "change").join(counts, [key, "author_id"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    crossed = (F.col("n") + F.col("change") > 0).cast("long") - (F.col("n") > 0).cast("long")
    authors = had.groupBy(key).agg(F.sum(crossed).alias("unique_author_count")).withColumn("active_work_count", F.lit(0).cast("long"))
    works = signed(work_counts(before, mart), work_counts(now, mart), [key], "active_work_count").withColumn("unique_author_count", F.lit(0).cast("long"))
    summed = rows.unionByName(authors.select(*rows.columns)).unionByName(works.select(*rows.columns)).groupBy(key).agg(*[F.sum(c).alias(c) for c in rows.columns if c != key])
    return summed.where("active_work_count > 0").select(*rows.columns), added(counts, pairs, [key, "author_id"], "n")


def refresh_edges(rows: DataFrame, now: Tables, changed: DataFrame, states: DataFrame) -> DataFrame:
    """Citation edges after a change: those of changed works anew, those of others with their target's new state.

    states: (work_id, activity_state) of all works, of which the targets of changed works are looked up.
    """
    moved = now["works"].select(F.col("work_id").alias("referenced_work_id"), F.col("activity_state").alias("new_state"))
    stay = gold.with_target(rows.join(changed.select(F.col("work_id").alias("source_work_id")), "source_work_id", "left_anti"), moved)
    stay = stay.withColumn("target_activity_state", F.coalesce("new_state", "target_activity_state"))
    references = now["work_references"].join(gold.active_works(now["works"]).select("work_id"), "work_id", "left_semi")
    wanted = references.where("referenced_work_id IS NOT NULL").select(F.col("referenced_work_id").alias("work_id")).distinct()
    target = states.select("work_id", "activity_state").join(wanted, "work_id", "left_semi").select(F.col("work_id").alias("referenced_work_id"), F.col("activity_state").alias("target_activity_state"))
    fresh = gold.with_target(references, target).withColumnRenamed("work_id", "source_work_id")
    return stay.select(*rows.columns).unionByName(fresh.select(*rows.columns))


def start(t: Tables) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All marts, and the author counts behind two of them, built from nothing."""
    return gold.build_all(t), {mart: author_counts(t, mart) for mart in AUTHORED}


def refresh(marts: dict[str, DataFrame], counts: dict[str, DataFrame], before: Tables, now: Tables, states: DataFrame) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All given marts and author counts after a change.

    before and now hold the rows of changed works only (part_of): new, changed and deleted ones, and ones that cite differently. states
    (work_id, activity_state) tells the present state of works that changed works cite. Applying the same change twice is
    wrong, so marts and counts are published with the version of the works that they follow.
    """
    changed = before["works"].select("work_id").unionByName(now["works"].select("work_id")).distinct()
    out, after = {}, {}
    for mart, rows in marts.items():
        if mart in COUNTED:
            keys, count = rows.columns[:-1], rows.columns[-1]
            build = gold.MARTS[mart]
            out[mart] = added(rows, signed(build(before), build(now), keys, count), keys, count)
        elif mart in AUTHORED:
            out[mart], after[mart] = refresh_authored(rows, counts[mart], before, now, mart)
        elif mart == "citation_edges":
            out[mart] = refresh_edges(rows, now, changed, states)
        else:
            out[mart] = rows.join(changed, "work_id", "left_anti").unionByName(gold.research_discovery(now).select(*rows.columns))
    return out, after
