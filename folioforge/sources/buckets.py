"""Tables in hash buckets of works, of which a change rewrites only those that it touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import publication

MANIFEST = "table_name string, bucket int, version string, row_count long, low string, high string"


def bucket_of(key: str | Column, buckets: int) -> Column:
    """The bucket of a key: 28 bits of its MD5 modulo their number, so that other engines can tell it as well. NULL goes to bucket 0."""
    bits = F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("long")
    return F.coalesce(F.pmod(bits, F.lit(buckets)), F.lit(0)).cast("int")


class BucketStore:
    """Several tables by work, in versions that share what did not change.

    A table's rows lie in `data/<table>/version=<v>/bucket=<b>`, sorted by key. A version's manifest says for each
    table and bucket in which version's folder its rows are, how many they are, and their least and greatest key. A commit
    writes the touched buckets of all its tables, then a manifest, and last one pointer row, so all its tables
    become visible at once; a failure before that leaves the old version as it was, and the run may be tried again under the same
    name. One writer at a time is the condition. The manifest has a row for each table and bucket: choose the number of buckets
    when the store is made, so that a bucket holds a file's worth of rows.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int, key: str = "work_id", bloom_keys: int | None = None):
        """bloom_keys: write Parquet Bloom filters of the key, made for so many keys of a file."""
        self.spark, self.root, self.buckets, self.key = spark, root, buckets, key
        self.options = {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(bloom_keys)} if bloom_keys else {}

    def version(self) -> str | None:
        now = publication.active_version(self.spark, self.root)
        return now["version"] if now else None

    def manifest(self, version: str | None = None) -> DataFrame:
        version = version or self.version()
        if version is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifests/{version}")

    def touched(self, ids: DataFrame) -> list[int]:
        """Buckets of the given works: at most one row for each bucket reaches the driver."""
        return sorted(r["bucket"] for r in ids.select(bucket_of(self.key, self.buckets).alias("bucket")).distinct().collect())

    def files(self, name: str, buckets: list[int] | None = None, version: str | None = None) -> list[str]:
        """Folders that hold a table's rows, of all buckets or of the given ones."""
        rows = self.manifest(version).where(F.col("table_name") == name)
        rows = rows if buckets is None else rows.where(F.col("bucket").isin(buckets))
        return sorted(f"{self.root}/data/{name}/version={r['version']}/bucket={r['bucket']}" for r in rows.select("version", "bucket").collect())

    def read(self, name: str, schema: str | None = None, buckets: list[int] | None = None, version: str | None = None) -> DataFrame:
        """A table, or only its rows in the given buckets; other buckets' files are not even listed. The schema is needed where there may be no rows."""
        paths = self.files(name, buckets, version)
        if not paths:
            kept_schema = schema or self.spark.read.parquet(f"{self.root}/data/{name}").drop("version", "bucket").schema
            return self.spark.createDataFrame([], kept_schema)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(*paths)

    def lookup(self, name: str, key: str) -> DataFrame:
        """The rows of one key: its bucket's files, whose sorted row groups Parquet skips by their bounds; none where the bounds exclude it."""
        where = self.manifest().where((F.col("table_name") == name) & (F.col("bucket") == bucket_of(F.lit(key), self.buckets)) & F.lit(key).between(F.col("low"), F.col("high")))
        paths = [f"{self.root}/data/{name}/version={r['version']}/bucket={r['bucket']}" for r in where.collect()]
        rows = self.spark.read.parquet(*paths) if paths else self.read(name, buckets=[])
        return rows.where(F.col(self.key) == key)

    def commit(self, changes: dict[str, tuple[DataFrame, list[int] | None]], version: str, after_table: Callable[[str], None] | None = None, before_pointer: Callable[[], None] | None = None) -> str:
        """Make a version in which each given table's touched buckets hold the given rows; all else stays as it is. None: all buckets.

        The rows of a table must lie in its touched buckets. A version that is active already is a no-op. after_table is
        called when a table is written, before_pointer when all are (the version can be read by its name then); an error in them stops the commit.
        """
        if self.version() == version:
            return version
        manifest = self.manifest()
        for name, (rows, buckets) in changes.items():
            folder = f"{self.root}/data/{name}/version={version}"
            dealt = rows.withColumn("bucket", bucket_of(self.key, self.buckets)).repartition("bucket").sortWithinPartitions("bucket", self.key)
            dealt.write.mode("overwrite").options(**self.options).option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(folder)
            gone = F.col("table_name") == name if buckets is None else (F.col("table_name") == name) & F.col("bucket").isin(buckets)
            manifest = manifest.where(~gone).unionByName(self._facts(name, folder, version, rows.schema))
            if after_table is not None:
                after_table(name)
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifests/{version}")
        if before_pointer is not None:
            before_pointer()
        publication.activate(self.spark, self.root, version, version)
        return version

    def _facts(self, name: str, folder: str, version: str, schema) -> DataFrame:
        if self.spark.read.schema(schema).parquet(folder).isEmpty():
            return self.spark.createDataFrame([], MANIFEST)
        rows = self.spark.read.parquet(folder)
        facts = rows.groupBy(F.col("bucket").cast("int").alias("bucket")).agg(F.count("*").alias("row_count"), F.min(self.key).alias("low"), F.max(self.key).alias("high"))
        return facts.select(F.lit(name).alias("table_name"), "bucket", F.lit(version).alias("version"), "row_count", "low", "high")

    def vacuum(self) -> DataFrame:
        """(table_name, version, bucket) folders that the active version does not use: what may be deleted once no reader holds an older one."""
        current = self.manifest()
        out = None
        for name in [r["table_name"] for r in current.select("table_name").distinct().collect()]:
            there = self.spark.read.parquet(f"{self.root}/data/{name}").select(F.lit(name).alias("table_name"), F.col("version").cast("string"), F.col("bucket").cast("int")).distinct()
            out = there if out is None else out.unionByName(there)
        return out.join(current.select("table_name", "version", "bucket"), ["table_name", "version", "bucket"], "left_anti") if out is not None else current.select("table_name", "version", "bucket")




class LookupFiles:
    """The published lookup rows twice, in buckets of work_id and in buckets of DOI, so that a point lookup opens one bucket's file.

    A miss opens none where the bucket's bounds exclude the key; else Parquet's Bloom filter spares it the row groups. DOIs
    are published first: until both pointers have moved, a DOI may show a newer row than its id.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int, bloom_keys: int = 100_000):
        self.by_id = BucketStore(spark, f"{root}/by_id", buckets, "work_id", bloom_keys)
        self.by_doi = BucketStore(spark, f"{root}/by_doi", buckets, "doi", bloom_keys)

    def publish(self, rows: DataFrame, version: str) -> None:
        """rows: one for each work that is served, as writers.lookup_rows gives them; those without a DOI are not in its buckets."""
        self.by_doi.commit({"lookup": (rows.where("doi IS NOT NULL"), None)}, version)
        self.by_id.commit({"lookup": (rows, None)}, version)

    def work(self, work_id: str) -> DataFrame:
        return self.by_id.lookup("lookup", work_id).limit(1)

    def doi(self, doi: str) -> DataFrame:
        """The work of a DOI; of several, the lowest id."""
        return self.by_doi.lookup("lookup", doi).orderBy("work_id").limit(1)
