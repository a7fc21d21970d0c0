"""Profiles of raw sources: fields of JSON and Parquet, lines, manifests, pairs of parts and ledgers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.operators.publication import numbered, skip_reason
from folioforge.sources.readers import chunks, listing
from folioforge.sources.scratch import kept


#: Levels of nesting that one pass over the records opens; deeper ones take another pass over what is left.
LEVELS = 6


def _opened(rows: DataFrame, level: int, dynamic: frozenset[str]) -> DataFrame:
    """rows with the value v at path opened: one row for each value inside it, or the row itself for a leaf, an empty object or list.

    The path, kind and place of what was opened stay as columns of the level; path and v are those of the inner value.
    """
    inner = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
    named, placed = F.col("key").isNotNull(), F.col("pos").isNotNull()
    inner = inner.withColumn("shape", F.when(~placed, F.schema_of_variant("v")))
    # JSON integers are BIGINT, those beyond 64 bits DECIMAL(19 or more, 0); 1.0 is a DECIMAL(1,0).
    whole = (F.col("shape") == "BIGINT") | F.col("shape").rlike(r"^DECIMAL\((19|2\d|3\d),0\)$")
    is_ = lambda start: F.startswith("shape", F.lit(start))
    leaf = F.when(F.col("shape") == "STRING", "string").when(whole, "integer").when(is_("VOID"), "null").when(is_("BOOLEAN"), "boolean").when(is_("OBJECT"), "object").when(is_("ARRAY"), "array").otherwise("number")
    kind = F.when(named, "object").when(placed, "array").when(F.col("shape").isNotNull(), leaf)
    key = F.when(F.col("path").isin(*dynamic), "{value}").otherwise(F.col("key")) if dynamic else F.col("key")
    below = F.when(named, F.when(F.col("path") == "", key).otherwise(F.concat("path", F.lit("."), key))).when(placed, F.concat("path", F.lit("[]")))
    before = [c for c in rows.columns if c not in ("path", "v")]
    return inner.select(*before, F.col("path").alias(f"path{level}"), kind.alias(f"kind{level}"), F.col("pos").alias(f"pos{level}"), below.alias("path"), F.col("value").alias("v"))


def json_field_profile(raw: DataFrame, dynamic: frozenset[str] = frozenset()) -> DataFrame:
    """(path, kind, present) over JSON texts in raw: how often each kind of value stands at each path.

    List elements are `[]`; keys of the objects at a dynamic path are one `{value}`. Texts that the parser refuses (objects
    that repeat a key among them) count under the path `<invalid>`. NULLs are skipped; no rows give none. Records are
    opened level by level inside their task, down to one row for each leaf; a value that holds others is counted on its
    first leaf. Only counts are shuffled, so an object with very many keys that is not named as dynamic costs rows of the
    result and no task's memory. The depth has no limit: LEVELS levels are one pass, and what is deeper is written down
    for the next.
    """
    parsed = raw.where("raw IS NOT NULL").select(F.try_parse_json("raw").alias("v"))
    rows = parsed.select(F.when(F.col("v").isNull(), "<invalid>").otherwise("").alias("path"), "v")
    later = F.lit(None).cast("string")
    passes = []
    while True:
        for level in range(LEVELS):
            rows = _opened(rows, level, dynamic)
        first, seen = F.lit(True), []
        for level in reversed(range(LEVELS)):
            first = first & (F.coalesce(f"pos{level}", F.lit(0)) == 0)
            kind = F.when(F.col(f"path{level}") == "<invalid>", "invalid").otherwise(F.col(f"kind{level}")) if level == 0 else F.col(f"kind{level}")
            seen.append(F.when(kind.isNotNull() & first, F.struct(F.col(f"path{level}").alias("path"), kind.alias("kind"))))
        seen.append(F.when(F.col("v").isNotNull(), F.struct("path", later.alias("kind"))))
        counted = kept(rows.select(F.inline(F.array_compact(F.array(*seen)))).groupBy("path", "kind").agg(F.count("*").alias("present")))
        passes.append(counted.where("kind IS NOT NULL"))
        if counted.where("kind IS NULL").isEmpty():
            break
        rows = kept(rows.where("v IS NOT NULL").select("path", "v"))
    return reduce(DataFrame.unionByName, passes).groupBy("path", "kind").agg(F.sum("present").alias("present"))


def missing_counts(profile: DataFrame) -> DataFrame:
    """(path, present, nulls, missing): missing is how often the parent object stands without the field."""
    paths = profile.groupBy("path").agg(F.sum("present").alias("present"), F.coalesce(F.sum(F.when(F.col("kind") == "null", F.col("present"))), F.lit(0)).alias("nulls"))
    objects = profile.where("kind = 'object'").select(F.col("path").alias("parent"), F.col("present").alias("parents"))
    inner = paths.where("path <> '' AND NOT endswith(path, '[]') AND path <> '<invalid>'").withColumn("parent", F.regexp_replace("path", r"\.?[^.]+$", ""))
    return inner.join(objects, "parent", "left").select("path", "present", "nulls", (F.coalesce("parents", F.lit(0)) - F.col("present")).alias("missing"))


def schema_paths(schema: T.DataType, path: str = "") -> list[tuple[str, str]]:
    """(path, family) of every field of a schema, named as in the JSON profile."""
    if isinstance(schema, T.StructType):
        inner = [x for f in schema for x in schema_paths(f.dataType, f"{path}.{f.name}" if path else f.name)]
        return [(path, "object"), *inner] if path else inner
    if isinstance(schema, T.ArrayType):
        return [(path, "array"), *schema_paths(schema.elementType, f"{path}[]")]
    if isinstance(schema, T.MapType):
        return [(path, "object"), *schema_paths(schema.valueType, f"{path}.{{value}}")]
    family = "boolean" if isinstance(schema, T.BooleanType) else "integer" if isinstance(schema, T.IntegralType) else "number" if isinstance(schema, T.NumericType) else "string"
    return [(path, family)]


def parquet_field_profile(df: DataFrame) -> DataFrame:
    """(path, family, nulls): the schema's fields, with NULL counts of the top-level ones from one scan."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first().asDict()
    return df.sparkSession.createDataFrame([(p, k, counts.get(p)) for p, k in schema_paths(df.schema)], "path string, family string, nulls long")


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Per file: records, blank lines, and whether the last line lacks its end (NULL for a packed file, whose bytes are not its text's).

    Lines are read as lines, so a large file is split and a packed one decoded. Files without any line are not listed.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("asset"), F.col("_metadata.file_size").alias("size"))
    counts = lines.groupBy("asset", "size").agg(F.count_if(F.trim("value") != "").alias("records"), F.count_if(F.trim("value") == "").alias("blank"), F.sum(F.octet_length("value") + 1).alias("bytes"))
    packed = F.col("asset").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$")
    return counts.select("asset", "records", "blank", F.when(~packed, F.col("bytes") == F.col("size") + 1).alias("unterminated"))


def record_count_reconcile(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """(asset, declared, observed) where the two differ; an absent side is NULL."""
    joined = declared.select("asset", F.col("record_count").alias("declared")).join(observed.select("asset", F.col("records").alias("observed")), "asset", "full")
    return joined.where(~F.col("declared").eqNullSafe(F.col("observed")))


def duplicate_keys(raw: DataFrame, key: str) -> DataFrame:
    """Rows whose object at a top-level key repeats one of its own keys."""
    inner = F.json_object_keys(F.get_json_object("raw", f"$.{key}"))
    return raw.where(F.size(inner) > F.size(F.array_distinct(inner)))


def asset_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(asset, checksum, bytes) of whole files, each read as a stream in its task: a file of any size is never one value.

    The listing is Spark's (without contents, so that files are dealt by their size); repeated names do not occur.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                sha, size = hashlib.sha256(), 0
                for chunk in chunks(name, None):
                    sha.update(chunk)
                    size += len(chunk)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sha.hexdigest()]), pa.array([size], pa.int64())], names=["asset", "checksum", "bytes"])

    return listing(spark, path).mapInArrow(digest, "asset string, checksum string, bytes long")


def pair_parts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Parts of two representations side by side by (updated_date, part)."""
    a = left.select("updated_date", "part", F.col("record_count").alias("left_records"), F.col("byte_size").alias("left_bytes"))
    b = right.select("updated_date", "part", F.col("record_count").alias("right_records"), F.col("byte_size").alias("right_bytes"))
    return a.join(b, ["updated_date", "part"], "full")


def pair_summary(pairs: DataFrame, cap: int) -> DataFrame:
    both = F.col("left_records").isNotNull() & F.col("right_records").isNotNull()
    return pairs.agg(F.count_if(both).alias("pairs"), F.count_if(~both).alias("single"), F.count_if(both & (F.col("left_records") != F.col("right_records"))).alias("count_mismatches"), F.count_if(both & (F.col("left_bytes") <= cap) & (F.col("right_bytes") <= cap)).alias("within_cap"))


def select_pair(pairs: DataFrame, cap: int, least_records: int) -> DataFrame:
    """The pair of the latest date and lowest part that is within the cap on both sides and large enough."""
    fits = (F.col("left_bytes") <= cap) & (F.col("right_bytes") <= cap) & (F.col("left_records") >= least_records) & (F.col("right_records") >= least_records)
    return pairs.where(fits).orderBy(F.col("updated_date").desc(), "part").limit(1)


def manifest_listing_reconcile(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Files missing in a listing, of another size, or not referenced."""
    joined = manifest.select("file_uri", F.col("byte_size").alias("declared")).join(listing.select("file_uri", F.col("byte_size").alias("listed")), "file_uri", "full")
    return joined.agg(F.count_if(F.col("listed").isNull()).alias("missing"), F.count_if(F.col("declared") != F.col("listed")).alias("size_mismatch"), F.count_if(F.col("declared").isNull()).alias("unreferenced"))


def ledger_profile(ledger: DataFrame, block: int = 100_000) -> DataFrame:
    """Per date: rows, rows of bad shape, and rows whose numeric id is below the one before it on that date.

    Rows are numbered in order of (deleted_date, pos) and compared inside blocks of that order; the first row of a block is
    compared with the last one of the block before. So a date on which very many works were deleted is no group of its own.
    """
    number = F.regexp_extract("work_id", "^W([0-9]+)$", 1)
    shaped = ledger.select("deleted_date", "pos", F.when(number != "", number.cast("long")).alias("number"))
    placed = numbered(shaped, "deleted_date", "pos", name="place").withColumn("block", F.expr(f"place div {block}"))
    inside = Window.partitionBy("block", "deleted_date").orderBy("place")
    told = placed.withColumn("before", F.lag("number").over(inside)).withColumn("starts", F.row_number().over(inside) == 1)
    ends = placed.groupBy("deleted_date", "block").agg(F.max_by("number", "place").alias("end")).withColumn("block", F.col("block") + 1)
    same = told["deleted_date"].eqNullSafe(ends["deleted_date"]) & (told["block"] == ends["block"])
    joined = told.join(ends, same & told["starts"], "left").select(told["deleted_date"], "number", F.when(F.col("starts"), F.col("end")).otherwise(F.col("before")).alias("before"))
    return joined.groupBy("deleted_date").agg(F.count("*").alias("rows"), F.count_if(F.col("number").isNull()).alias("bad_shape"), F.count_if(F.col("number") < F.col("before")).alias("out_of_order"))



def schema_fidelity(json_profile: DataFrame, parquet_profile: DataFrame) -> DataFrame:
    """(path, kind, family, verdict) of JSON fields: MATCH, MISSING in Parquet, or CONFLICT of families; integers may be numbers."""
    kinds = json_profile.where("kind <> 'null' AND path <> ''").select("path", "kind")
    joined = kinds.join(parquet_profile.select("path", "family"), "path", "left")
    fits = (F.col("kind") == F.col("family")) | ((F.col("kind") == "integer") & (F.col("family") == "number"))
    return joined.withColumn("verdict", F.when(F.col("family").isNull(), "MISSING").when(fits, "MATCH").otherwise("CONFLICT"))


def value_fidelity(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(field, exact, float32, mismatch, one_side): how two representations of the same records agree, field by field."""
    joined = left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"))
    kinds = dict(left.dtypes)
    rows = []
    for f in fields:
        a, b = F.col(f"l.{f}"), F.col(f"r.{f}")
        narrow = (a.cast("float") == b.cast("float")) if kinds[f] in ("double", "float") else F.lit(False)
        rows.append(F.struct(F.lit(f).alias("field"), F.when(a.eqNullSafe(b), "exact").when(a.isNull() | b.isNull(), "one_side").when(narrow, "float32").otherwise("mismatch").alias("verdict")))
    told = joined.select(F.explode(F.array(*rows)).alias("x")).select("x.field", "x.verdict")
    return told.groupBy("field").agg(*[F.count_if(F.col("verdict") == v).alias(v) for v in ("exact", "float32", "mismatch", "one_side")])


def sub_millisecond(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.unix_micros(F.col(column).cast("timestamp")) % 1000 != 0).alias("sub_ms"), F.count(column).alias("n"))


# --- redaction -----------------------------------------------------------------------------------------------------


def pseudonyms(values: DataFrame) -> DataFrame:
    """(kind, value, pseudonym) for (kind, value, pos): equal values get equal numbers within their kind, by first occurrence.

    Numbers come from a range-sorted order: each range is numbered inside and moved by the rows of the ranges before
    it, so no kind is numbered in one task; only one count for each range is added up.
    """
    firsts = values.where("value IS NOT NULL").groupBy("kind", "value").agg(F.min("pos").alias("pos"))
    ranged = firsts.repartitionByRange("kind", "pos", "value").withColumn("part", F.spark_partition_id())
    inside = F.row_number().over(Window.partitionBy("kind", "part").orderBy("pos", "value"))
    counted = kept(ranged.withColumn("n", inside))  # written down, as sizes and numbers must see the same ranges
    sizes = counted.groupBy("kind", "part").agg(F.count("*").alias("c"))
    before = sizes.withColumn("before", F.coalesce(F.sum("c").over(Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = counted.join(F.broadcast(before.select("kind", "part", "before")), ["kind", "part"])  # one row for each kind and range
    return joined.select("kind", "value", F.concat_ws("-", "kind", (F.col("before") + F.col("n")).cast("string")).alias("pseudonym"))


def pseudonymize(df: DataFrame, columns: dict[str, str], pos: str) -> DataFrame:
    """df with the given columns (name -> kind) replaced by pseudonyms."""
    values = None
    for c, kind in columns.items():
        part = df.select(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("value"), F.col(pos).alias("pos"))
        values = part if values is None else values.unionByName(part)
    names = pseudonyms(values)
    for c, kind in columns.items():
        mine = names.where(F.col("kind") == kind).select(F.col("value").alias(f"_{c}"), F.col("pseudonym").alias(f"_new_{c}"))
        df = df.join(mine, F.col(c).cast("string") == F.col(f"_{c}"), "left").withColumn(c, F.col(f"_new_{c}")).drop(f"_{c}", f"_new_{c}")
    return df


ACTIONS = ("keep", "mask_person", "replace_text", "mask_price")


def _masked(c: Column, kind: T.DataType, path: str, policy: dict[str, str], unknown: list[str]) -> Column:
    """c with every leaf below path masked by its rule; leaves without one are added to unknown."""
    if isinstance(kind, T.StructType):
        inner = [_masked(c[f.name], f.dataType, f"{path}.{f.name}", policy, unknown).alias(f.name) for f in kind]
        return F.when(c.isNotNull(), F.struct(*inner))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _masked(x, kind.elementType, f"{path}[]", policy, unknown))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, x: _masked(x, kind.valueType, f"{path}.{{value}}", policy, unknown))
    action = policy.get(path)
    if action not in ACTIONS:
        unknown.append(path)
    if action == "mask_person":
        return F.when(c.isNotNull(), F.lit("Person"))
    if action == "replace_text":
        return F.repeat(F.lit("x"), F.length(c))
    return F.when(c.isNotNull(), F.lit(0)).cast(kind) if action == "mask_price" else c


def redact(df: DataFrame, policy: dict[str, str]) -> DataFrame:
    """Apply a policy of paths: keep, mask_person (a fixed name), replace_text (length kept), mask_price (0).

    Paths reach into structs (a.b), lists (a[]) and maps (a.{value}), as in the JSON profile; map keys stay. A leaf without
    a rule is an error, so nothing passes by oversight.
    """
    unknown: list[str] = []
    columns = [_masked(F.col(f"`{f.name}`"), f.dataType, f.name, policy, unknown).alias(f.name) for f in df.schema]
    if unknown:
        raise ValueError(f"no rule for {', '.join(sorted(set(unknown)))}")
    return df.select(*columns)


def leaks(original: DataFrame, masked: DataFrame, key: str, person: str, text: str, least: int = 4, identifiers: tuple[str, ...] = ()) -> DataFrame:
    """Keys whose masked text still holds a token, of at least `least` characters, of the original person, or one of the original identifiers as a whole."""
    from folioforge.functions.scalars import tokens

    names = F.filter(tokens(F.col(person)), lambda w: F.length(w) >= least).alias("p")
    ids = F.array_compact(F.array(*[F.lower(F.col(c)) for c in identifiers], F.lit(None).cast("string"))).alias("ids")
    both = original.select(key, names, ids).join(masked.select(key, tokens(F.col(text)).alias("t"), F.lower(F.col(text)).alias("l")), key)
    return both.where(F.arrays_overlap("p", "t") | F.exists("ids", lambda x: F.contains(F.col("l"), x))).select(key)


def postconditions(masked: DataFrame, text: str, person: str, price: str) -> DataFrame:
    """(rule, violations): no mail address in texts, only the fixed name, only zero prices."""
    from folioforge.functions.scalars import has_email

    counts = masked.agg(F.count_if(has_email(F.col(text))).alias("email"), F.count_if(F.col(person).isNotNull() & (F.col(person) != "Person")).alias("person"), F.count_if(F.col(price) != 0).alias("price"))
    return counts.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in counts.columns]), F.array(*counts.columns)))).toDF("rule", "violations")


def _violations(c: Column, kind: T.DataType, path: str, policy: dict[str, str]) -> list[tuple[str, str, Column]]:
    """(path, rule, how many values of one row break it) for every leaf below path."""
    from folioforge.functions.scalars import has_email

    count = lambda broken: F.coalesce(broken, F.lit(False)).cast("long")

    def over(items: Column, inner: T.DataType, below: str) -> list[tuple[str, str, Column]]:
        parts = len(_violations(F.lit(None).cast(inner), inner, below, policy))
        add = lambda i: F.coalesce(F.aggregate(items, F.lit(0).cast("long"), lambda n, x: n + _violations(x, inner, below, policy)[i][2]), F.lit(0))
        names = _violations(F.lit(None).cast(inner), inner, below, policy)
        return [(names[i][0], names[i][1], add(i)) for i in range(parts)]

    if isinstance(kind, T.StructType):
        return [x for f in kind for x in _violations(c[f.name], f.dataType, f"{path}.{f.name}", policy)]
    if isinstance(kind, T.ArrayType):
        return over(c, kind.elementType, f"{path}[]")
    if isinstance(kind, T.MapType):
        keys = over(F.map_keys(c), kind.keyType, f"{path}{{key}}") if f"{path}{{key}}" in policy else []
        return [*keys, *over(F.map_values(c), kind.valueType, f"{path}.{{value}}")]
    action = policy.get(path)
    rules = [] if action in ACTIONS else [(path, "no_rule", count(c.isNotNull()))]
    if action == "mask_person":
        rules.append((path, action, count(c != "Person")))
    if action == "replace_text":
        rules.append((path, action, count(c.rlike("[^x]"))))
    if action == "mask_price":
        rules.append((path, action, count(c != 0)))
    return [*rules, (path, "email", count(has_email(c)))] if isinstance(kind, T.StringType) else rules


def masking_violations(masked: DataFrame, policy: dict[str, str]) -> DataFrame:
    """(path, rule, violations) of masked rows against the policy of redact, at every depth; only what is broken is listed.

    Each value is held against its path's rule (a text of x, the fixed name, price 0), each text against the shape of a mail
    address (rule email), and a path without a rule counts its values (no_rule). Keys of maps are checked where the policy
    names `path{key}`. NULLs break nothing; an empty table, or one in order, gives no rows. One pass, sums only are shuffled.
    """
    found = [x for f in masked.schema for x in _violations(F.col(f"`{f.name}`"), f.dataType, f.name, policy)]
    if not found:
        return masked.sparkSession.createDataFrame([], "path string, rule string, violations long")
    sums = masked.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(f"n{i}") for i, (_, _, n) in enumerate(found)])
    rows = F.array(*[F.struct(F.lit(path).alias("path"), F.lit(rule).alias("rule"), F.col(f"n{i}").alias("violations")) for i, (path, rule, _) in enumerate(found)])
    return sums.select(F.inline(rows)).where("violations > 0")


# --- what a manifest offers ------------------------------------------------------------------------------------------


def manifest_pick(assets: DataFrame, max_bytes: int) -> DataFrame:
    """One row about the listed works files: how many there are and may be taken, their sizes and dates, and the one taken by default.

    The default is the first of the order of select_assets; its columns are NULL where none may be taken. An empty listing has zeros.
    """
    marked = assets.withColumn("reason", skip_reason(max_bytes))
    size, fits = F.col("byte_size"), F.col("reason").isNull()
    order = F.struct("byte_size", F.col("updated_date").isNotNull(), "updated_date", "file_uri", "asset_id", "record_count")
    first = F.min(F.when(fits, order))
    facts = marked.agg(
        F.count("*").alias("listed"), F.count_if(fits).alias("eligible"), F.count_if(F.col("reason") == "OVERSIZED").alias("oversized"), F.count_if(F.col("reason") == "UNKNOWN_SIZE").alias("unknown_size"),
        F.min(size).alias("size_min"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY byte_size)").cast("long").alias("size_median_low"), F.max(size).alias("size_max"),
        F.countDistinct("updated_date").alias("partitions"), F.min("updated_date").alias("first_date"), F.max("updated_date").alias("last_date"), first.alias("first"),
    )
    chosen = [F.col("first.file_uri").alias("picked_uri"), F.col("first.byte_size").alias("picked_bytes"), F.col("first.record_count").alias("picked_records")]
    return facts.select(*[c for c in facts.columns if c != "first"], *chosen)
