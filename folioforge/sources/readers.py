"""Scans of raw works, deletion ledgers, manifests and canonical tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions.scalars import normalize_id, strict_date
from folioforge.plans import schemas

#: Bounds of one asset: bytes of a record, records, decoded bytes; ids and line bytes of a ledger (fixed values).
RECORD_BYTES, RECORDS, ASSET_BYTES = 16_000_000, 50_000, 100_000_000
LEDGER_IDS, LEDGER_LINE = 100_000, 4_096
LEDGER_HEADER = "work_id,deleted_date"


def _numbered(df: DataFrame) -> DataFrame:
    """Lines with their asset and place. A gzip file is one partition, so ids that grow inside it are places in the file."""
    return df.select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("asset"), F.monotonically_increasing_id().alias("pos"))


def read_works_jsonl(spark: SparkSession, path: str | list[str], record_bytes: int | None = None) -> DataFrame:
    """(raw, asset, pos, error): one row for each line that is not blank; error for text that is no JSON object.

    With record_bytes, a longer line is passed over by the line reader and never held; stream_bounds tells its asset, so
    the two go together.
    """
    reader = spark.read if record_bytes is None else spark.read.option("mapreduce.input.linerecordreader.line.maxlength", str(record_bytes + 3))  # with both bytes of its end a line stays below
    lines = _numbered(reader.text(path)).where(F.trim("raw") != "")
    kind = F.schema_of_variant(F.try_parse_json("raw"))
    return lines.withColumn("error", F.when(~F.is_valid_utf8("raw"), "MALFORMED_UTF8").when(F.try_parse_json("raw").isNull(), "MALFORMED_JSON").when(~F.startswith(kind, F.lit("OBJECT")), "NOT_AN_OBJECT"))


def decode_facts(lines: DataFrame) -> DataFrame:
    """Per asset: records, bytes, and bytes of the largest record."""
    size = F.octet_length("raw")
    return lines.groupBy("asset").agg(F.count("*").alias("records"), F.sum(size + 1).alias("bytes"), F.max(size).alias("largest"))


def check_decode_bounds(lines: DataFrame, record_bytes: int = RECORD_BYTES, records: int = RECORDS, asset_bytes: int = ASSET_BYTES) -> DataFrame:
    """Assets beyond a bound, with the first one broken; the exact bound is accepted."""
    facts = decode_facts(lines)
    broken = F.when(F.col("largest") > record_bytes, "RECORD_TOO_LARGE").when(F.col("records") > records, "TOO_MANY_RECORDS").when(F.col("bytes") > asset_bytes, "ASSET_TOO_LARGE")
    return facts.withColumn("bound", broken).where("bound IS NOT NULL")


def listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Names of files; the source leaves contents unread where no column asks for them, and deals files by size."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("asset"))


def chunks(name: str, compression: str | None = "detect", size: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a file in pieces, decoded by its ending unless compression is None."""
    local = re.sub("^file:/+", "/", name)
    where, inner = (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(name)
    with where.open_input_stream(inner, compression=compression) as stream:
        while chunk := stream.read(size):
            yield chunk


def _first_broken(pieces: Iterator[bytes], record_bytes: int, records: int, asset_bytes: int) -> tuple[int, int, int, str | None]:
    """(records, bytes, largest, bound) of lines that are not blank, up to the first bound broken. Of a line only its length is held."""
    count = total = largest = length = trailing = 0
    blank = True

    def ended() -> None:
        nonlocal count, total, largest, length, trailing, blank
        if not blank:
            count, total, largest = count + 1, total + length - trailing + 1, max(largest, length - trailing)
        length, trailing, blank = 0, 0, True

    def bound() -> str | None:
        if max(largest, 0 if blank else length - trailing) > record_bytes:
            return "RECORD_TOO_LARGE"
        return "TOO_MANY_RECORDS" if count > records else "ASSET_TOO_LARGE" if total > asset_bytes else None

    for piece in pieces:
        *whole, last = piece.split(b"\n")
        for i, line in enumerate([*whole, last]):
            if line:
                length, trailing, blank = length + len(line), int(line.endswith(b"\r")), blank and not line.strip()
            if i < len(whole):
                ended()
            if broken := bound():
                return count, total, largest, broken
    ended()
    return count, total, largest, bound()


def stream_bounds(spark: SparkSession, path: str | list[str], record_bytes: int = RECORD_BYTES, records: int = RECORDS, asset_bytes: int = ASSET_BYTES) -> DataFrame:
    """(asset, records, bytes, largest, bound) of each file, decoded as a stream that ends at the first bound broken.

    The exact bound is accepted; counts of an asset with a bound are those up to its end. A record above the bound is never
    held whole, nor a packed file that grows without end decoded. bound is NULL for assets within all; files of no bytes are not listed.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                facts = (name, *_first_broken(chunks(name), record_bytes, records, asset_bytes))
                yield pa.RecordBatch.from_pylist([dict(zip(shape.names, facts, strict=True))], schema=shape)

    shape = pa.schema([("asset", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("largest", pa.int64()), ("bound", pa.string())])
    return listing(spark, path).mapInArrow(scan, "asset string, records long, bytes long, largest long, bound string")


def read_deletions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(work_id, deleted_date, asset, pos, error) of ledgers whose header is exact; blank lines are skipped, bad rows carry an error."""
    lines = _numbered(spark.read.text(path)).where(F.trim("raw") != "")
    first = lines.groupBy("asset").agg(F.min("pos").alias("first"))
    lines = lines.join(first, "asset")
    parts = F.split("raw", ",", -1)
    work, day = normalize_id(F.get(parts, F.lit(0)), "W"), strict_date(F.get(parts, F.lit(1)))
    header = F.col("pos") == F.col("first")
    error = (
        F.when(header & (F.col("raw") != LEDGER_HEADER), "BAD_HEADER")
        .when(header, F.lit(None))
        .when(F.octet_length("raw") > LEDGER_LINE, "LINE_TOO_LONG")
        .when(F.size(parts) != 2, "BAD_COLUMNS")
        .when(work.isNull(), "BAD_ID")
        .when(day.isNull(), "BAD_DATE")
    )
    out = lines.select(work.alias("work_id"), day.alias("deleted_date"), "asset", "pos", error.alias("error"), header.alias("header"))
    return out.where("NOT header OR error IS NOT NULL").drop("header")


def oversized_ledgers(deletions: DataFrame, most: int = LEDGER_IDS) -> DataFrame:
    return deletions.where("error IS NULL").groupBy("asset").agg(F.countDistinct("work_id").alias("ids")).where(F.col("ids") > most)


MANIFEST = "date string, format string, entity string, record_count long, content_length long, files array<struct<url:string,meta:struct<content_length:long,record_count:long>>>"


def asset_id(source: Column, snapshot: Column, entity: Column, uri: Column) -> Column:
    """oa- and the SHA-256 of the JSON array of the four."""
    quoted = [F.to_json(F.array(c)) for c in (source, snapshot, entity, uri)]
    inner = [F.substring(q, F.lit(2), F.length(q) - 2) for q in quoted]
    return F.concat(F.lit("oa-"), F.sha2(F.concat(F.lit("["), F.array_join(F.array(*inner), ","), F.lit("]")), 256))


def read_manifest(spark: SparkSession, path: str, source: str = "works") -> DataFrame:
    """One row for each file of a manifest: (asset_id, file_uri, entity, format, snapshot_date, updated_date, byte_size, record_count, error)."""
    files = spark.read.schema(MANIFEST).json(path, multiLine=True).select(F.col("date").alias("snapshot_date"), "format", "entity", F.explode("files").alias("f"))
    dates = F.regexp_extract_all(F.col("f.url"), F.lit("updated_date=([0-9-]+)"), F.lit(1))
    size, records = F.col("f.meta.content_length"), F.col("f.meta.record_count")
    error = F.when(F.col("f.url").isNull(), "NO_URL").when(size.isNull() | records.isNull(), "NO_COUNTS").when((size < 0) | (records < 0), "NEGATIVE_COUNT").when(F.size(dates) > 1, "SEVERAL_DATES").when((F.size(dates) == 1) & strict_date(F.get(dates, F.lit(0))).isNull(), "BAD_DATE")
    return files.select(
        asset_id(F.lit(source), F.col("snapshot_date"), F.col("entity"), F.col("f.url")).alias("asset_id"), F.col("f.url").alias("file_uri"), "entity", "format", strict_date(F.col("snapshot_date")).alias("snapshot_date"),
        strict_date(F.get(dates, F.lit(0))).alias("updated_date"), size.alias("byte_size"), records.alias("record_count"), error.alias("error"),
    )


def schema_differences(df: DataFrame, wanted: T.StructType) -> list[str]:
    """What differs from the exact ordered names and types."""
    have, want = [(f.name, f.dataType.simpleString()) for f in df.schema], [(f.name, f.dataType.simpleString()) for f in wanted]
    return [f"column {i}: {a} is not {b}" for i, (a, b) in enumerate(zip(have, want, strict=False)) if a != b] + ([f"{len(have)} columns, not {len(want)}"] if len(have) != len(want) else [])


def require_table(df: DataFrame, name: str) -> DataFrame:
    """df if it has the canonical table's exact schema and no NULL in a required column, else an error."""
    wanted = schemas.schema(name)
    differs = schema_differences(df, wanted)
    if differs:
        raise ValueError(f"{name}: {'; '.join(differs)}")
    required = [f.name for f in wanted if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
    bad = [c for c in required if counts[c]]
    if bad:
        raise ValueError(f"{name}: NULL in {', '.join(bad)}")
    return df


def read_canonical(spark: SparkSession, name: str, path: str) -> DataFrame:
    return require_table(spark.read.parquet(path), name)


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, rows) of each Parquet file."""
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"))


def read_works_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet form of works as JSON lines: dates as text, maps as sorted objects."""
    df = spark.read.parquet(path)
    shaped = {f.name: F.date_format(f.name, "yyyy-MM-dd") if isinstance(f.dataType, T.DateType) else F.map_from_entries(F.array_sort(F.map_entries(f.name))) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in df.schema}
    return df.select(F.to_json(F.struct(*[c.alias(n) for n, c in shaped.items()])).alias("raw"), F.col("_metadata.file_path").alias("asset"), F.monotonically_increasing_id().alias("pos"))
