"""Small shared pieces: word rules, shared-folder tables and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folioforge.sources.scratch import new_folder

#: The six ASCII white-space characters that separate words (fixed value).
SPACE = " \t\n\x0b\x0c\r"
SPACE_RE = r"[ \x09-\x0D]+"
#: Spark's setting by which shuffle files go when the query that made them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_array(text: Column) -> Column:
    """Words of a text that is not NULL, in order; no words give an empty array."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RE))


def word_count(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE_RE))).cast("long")


def kept_table(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, and its size is known to the planner.

    The files outlive any executor. Large results belong here; small repeated steps of a loop use it as well. The
    shuffle files of the write are removed when it ends, as nothing reads them any more.
    """
    spark = df.sparkSession
    path = new_folder(spark, "kept")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of undirected edges (a, b): (node, component), component being the smallest node reachable.

    Alternating stars: every node hangs its larger neighbours on its smallest neighbour, then its smaller ones. The
    number of rounds grows with the logarithm of the longest chain. Each round is written to the shared folder; a hub
    with a third of all edges only meets partial minima and a join that Spark can split. Self loops and repeated
    edges are harmless; an empty input gives no rows.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    stars, before = kept_table(edges.where("a <> b").select(low, high).distinct()), None
    for _ in range(max_rounds):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        large = kept_table(large)
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        watch = Observation()
        watched = small.where("a <> b").distinct().observe(watch, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
        stars, now = kept_table(watched), watch.get
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    centres = stars.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return centres.unionByName(stars.select(F.col("b").alias("node"), F.col("a").alias("component")))
