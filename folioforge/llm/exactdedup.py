"""Exact duplicates: groups by a 128-bit content hash, whose members' bytes are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import SPACE_RE, kept_table, text_or_empty


def normalised(text: Column) -> Column:
    """A text that is not NULL without its white space, in which alone equal texts may differ."""
    return F.regexp_replace(text, SPACE_RE, "")


def first_bits(sha256: Column) -> Column:
    """128 bits of a SHA-256 digest."""
    return F.unhex(F.substring(sha256, 1, 32))


def grouped(marks: DataFrame, *keys: str) -> DataFrame:
    """For each group its size and the row that stays: the smallest of the order columns."""
    best = F.min(F.struct("order", F.col("id").isNull().alias("no_id"), "id", "row"))
    return marks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), best.alias("best"))


def judged(marks: DataFrame, groups: DataFrame, *keys: str) -> DataFrame:
    """Each row with its group's facts; groups has those of more than one row, so that it stays narrow."""
    rows = marks.join(groups.hint("shuffle_hash"), list(keys), "left")
    alone = F.col("n").isNull()
    return rows.select(
        F.col("id").alias("doc_id"),
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("best.row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: bool = True, bits: Callable[[Column], Column] = first_bits) -> DataFrame:
    """One row for each document: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when they are identical without white space; text_sha256 is of that, in UTF-8. Of equal texts the one
    with the most code points as given stays (longest), then the smallest id; without longest, the smallest id.

    Each row is reduced to its id, length and digest first, and these are grouped by 128 bits of the digest (bits, which
    tests replace). Only texts of groups of more than one row are then brought together and told apart by their bytes (at every
    size by shuffling, as the number of groups has no bound; Spark's run-time filter spares large tables most texts that stand alone): the
    text itself is a grouping key, so each task sends a text once, however many copies it has read. Should one
    hash have several texts, its rows are grouped by hash and text instead.

    NULL text is the empty text. An id may be NULL, which comes after all others, and may occur twice; of rows that
    have the same id, length and text one stays, whichever is written first. An empty table gives no rows; other columns are
    ignored.
    """
    text = text_or_empty(text_col)
    norm = normalised(text)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), norm.alias("norm"), (-F.length(text) if longest else F.lit(0)).alias("order"))
    hashed = rows.withColumn("sha", F.sha2("norm", 256)).withColumn("hash", bits(F.col("sha")))
    # The number of a row is settled by writing it down.
    marks = kept_table(hashed.select("id", "order", "sha", "hash", F.monotonically_increasing_id().alias("row")))
    groups = kept_table(grouped(marks, "hash").where("n > 1"))
    texts = kept_table(hashed.join(groups.select("hash").hint("shuffle_hash"), "hash").select("hash", "norm"))
    mixed = kept_table(texts.groupBy("hash", "norm").agg(F.count(F.lit(1)).alias("n")).groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("hash"))
    if mixed.isEmpty():
        return judged(marks, groups, "hash")
    told = kept_table(hashed.join(mixed, "hash").withColumn("row", F.monotonically_increasing_id()))
    apart = judged(told, kept_table(grouped(told, "hash", "norm").where("n > 1")), "hash", "norm")
    return judged(marks.join(mixed, "hash", "left_anti"), groups, "hash").unionByName(apart)
