"""An inverted index of facets: postings in ranges of works, of which a page reads only those that it needs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.operators.lookups import PAGE_LIMITS, YEARS
from folioforge.operators.publication import numbered

EQUAL = {"publisher_id": "primary_publisher_id", "source_id": "primary_source_id", "work_type": "work_type", "language": "language", "oa_status": "oa_status"}
MEMBER = {"topic_id": "topic_ids", "institution_id": "institution_ids", "author_id": "author_ids"}
YEAR = "publication_year"


def build_facet_index(discovery: DataFrame, folder: str, works_per_range: int = 50_000) -> None:
    """Write discovery rows (one for each work) and their postings in ranges of works_per_range works in order of their id.

    `works/range=<r>` has a range's rows by id, `postings/range=<r>` its sorted ids of each (facet, value), `ranges` the
    least and greatest id of each range, `schema` no row but the columns. A posting of a frequent value is dealt over all ranges, so no list is longer than
    works_per_range. The folder must be new; readers get to know it when it is whole (as by publication.activate).
    """
    spark = discovery.sparkSession
    placed = numbered(discovery, "work_id", name="_row").withColumn("range", F.expr(f"((_row - 1) div {works_per_range})").cast("int")).drop("_row")
    placed.repartition("range").sortWithinPartitions("range", "work_id").write.partitionBy("range").parquet(f"{folder}/works")
    discovery.limit(0).write.parquet(f"{folder}/schema")
    stored = spark.read.schema(T.StructType([*discovery.schema.fields, T.StructField("range", T.IntegerType())])).parquet(f"{folder}/works")
    pair = lambda facet, value: F.struct(F.lit(facet).alias("facet"), value.cast("string").alias("value"))
    single = F.array(*[pair(f, F.col(c)) for f, c in {**EQUAL, YEAR: YEAR}.items()])
    pairs_of = lambda facet, column: F.transform(column, lambda v: pair(facet, v))
    several = [pairs_of(f, c) for f, c in MEMBER.items()]
    told = F.filter(F.concat(single, *[F.coalesce(s, F.array().cast("array<struct<facet:string,value:string>>")) for s in several]), lambda x: x["value"].isNotNull())
    pairs = stored.select("range", "work_id", F.explode(told).alias("p")).select("range", "p.facet", "p.value", "work_id")
    postings = pairs.groupBy("range", "facet", "value").agg(F.sort_array(F.collect_set("work_id")).alias("ids"))
    postings.repartition("range").sortWithinPartitions("range", "facet", "value").write.partitionBy("range").parquet(f"{folder}/postings")
    stored.groupBy("range").agg(F.min("work_id").alias("low"), F.max("work_id").alias("high"), F.count("*").alias("works")).coalesce(1).sortWithinPartitions("range").write.parquet(f"{folder}/ranges")


class FacetIndex:
    """Pages of discovery rows by facets, from an index that build_facet_index wrote.

    A page starts in the range of its cursor and takes 1, 2, 4, ... ranges until it is full: it opens their postings, of
    which Parquet skips those of other facets, intersects the ids, and then reads the rows of ranges in which it found
    some. `opened` has the ranges whose postings the last page opened, `read` those whose rows it reads.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.opened, self.read = spark, folder, [], []
        self.works = spark.read.parquet(f"{folder}/schema").schema

    def search(self, after: str | None = None, limit: int = PAGE_LIMITS[0], year_from: int | None = None, year_to: int | None = None, **facets: str | None) -> DataFrame:
        """Rows that meet all given facets and year bounds, by work_id, after `after`; one more than limit, as search_research gives them."""
        if not 1 <= limit <= PAGE_LIMITS[1]:
            raise ValueError(f"limit must be 1 to {PAGE_LIMITS[1]}")
        for y in (year_from, year_to):
            if y is not None and not YEARS[0] <= y <= YEARS[1]:
                raise ValueError(f"year must be {YEARS[0]} to {YEARS[1]}")
        if unknown := facets.keys() - EQUAL.keys() - MEMBER.keys():
            raise ValueError(f"unknown facets: {sorted(unknown)}")
        wanted = [(F.col("facet") == f) & (F.col("value") == v) for f, v in facets.items() if v is not None]
        if year_from is not None or year_to is not None:
            wanted.append((F.col("facet") == YEAR) & F.col("value").cast("int").between(year_from or YEARS[0], year_to or YEARS[1]))
        self.opened, self.read, found = [], [], []
        ranges = self.spark.read.parquet(f"{self.folder}/ranges")
        ahead = ranges if after is None else ranges.where(F.col("high") > after)
        first, last = ahead.agg(F.min("range"), F.max("range")).first()
        wave = 1
        while first is not None and first <= last and len(found) <= limit:
            part = list(range(first, min(first + wave, last + 1)))
            self.opened += part
            found += self._ids(part, wanted, after).orderBy("work_id").limit(limit + 1 - len(found)).collect()
            first, wave = part[-1] + 1, wave * 2
        self.read = sorted({r["range"] for r in found})
        if not found:
            return self.spark.createDataFrame([], self.works)
        paths = [f"{self.folder}/works/range={r}" for r in self.read]
        return self.spark.read.schema(self.works).parquet(*paths).where(F.col("work_id").isin([r["work_id"] for r in found])).orderBy("work_id")

    def _ids(self, part: list[int], wanted: list[Column], after: str | None) -> DataFrame:
        """(range, work_id) of a wave of ranges that meet all conditions."""
        base = f"{self.folder}/{'postings' if wanted else 'works'}"
        rows = self.spark.read.option("basePath", base).parquet(*[f"{base}/range={r}" for r in part])
        if wanted:
            rows = rows.where(reduce(Column.__or__, wanted))
            ids = rows.groupBy("range", "facet").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids"))
            common = F.aggregate("lists", F.element_at("lists", 1), F.array_intersect)
            rows = ids.groupBy("range").agg(F.collect_list("ids").alias("lists")).where(F.size("lists") == len(wanted)).select("range", F.explode(common).alias("work_id"))
        return rows.select("range", "work_id") if after is None else rows.select("range", "work_id").where(F.col("work_id") > after)
