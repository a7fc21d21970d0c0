"""Sources, profiles, fidelity, redaction and releases as registered queries over what Spark derives from the base tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.operators import profiling, release, versions
from folioforge.plans.gold_queries import _plain
from folioforge.plans.mapping_queries import RELATIONS, raw_works
from folioforge.plans.registry import base_query, query
from folioforge.plans.version_queries import FOLD, STATE, observations
from folioforge.sources import readers
from folioforge.sources.scratch import kept, new_folder


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@base_query("src2_decode_bounds", sql="SELECT source AS asset, count(*) AS records, CAST(sum(octet_length(encode(text))+1) AS BIGINT) AS bytes, max(octet_length(encode(text))) AS largest FROM documents GROUP BY 1")
def src2(spark, sf_dir):
    return readers.decode_facts(_read(spark, sf_dir, "documents").select(F.col("source").alias("asset"), F.col("text").alias("raw")))


STREAM_SQL = """WITH f AS (SELECT source AS asset, count(*) AS n, sum(size+1) AS b, max(size) AS m FROM (SELECT source, octet_length(encode(replace(replace(text,chr(10),' '),chr(13),' '))) AS size FROM documents WHERE trim(replace(replace(replace(text,chr(10),' '),chr(13),' '),chr(9),' '))<>'') GROUP BY 1)
SELECT asset, CASE WHEN m>10000 THEN 'RECORD_TOO_LARGE' END AS bound FROM f UNION ALL SELECT asset, CASE WHEN n>50 THEN 'TOO_MANY_RECORDS' END FROM f UNION ALL SELECT asset, CASE WHEN b>120000 THEN 'ASSET_TOO_LARGE' END FROM f"""


@base_query("src2_stream_bounds", sql=STREAM_SQL)
def src2_stream(spark, sf_dir):
    """Packed files of the documents, one a source and a document a line, held against each bound alone."""
    folder = new_folder(spark, "bounded")
    lines = _read(spark, sf_dir, "documents").select(F.regexp_replace("text", "[\\r\\n]", " ").alias("value"), "source")
    lines.repartition("source").write.partitionBy("source").option("compression", "gzip").text(folder)
    off = 1 << 60
    each = [(10_000, off, off), (off, 50, off), (off, off, 120_000)]
    asset = F.regexp_extract("asset", "source=([^/]+)/", 1).alias("asset")
    return reduce(DataFrame.unionByName, [readers.stream_bounds(spark, f"{folder}/*", *bounds).select(asset, "bound") for bounds in each])


@base_query("src5_asset_identity", sql="""SELECT o_orderkey AS k, 'oa-'||sha256('["works","2024-01-01","'||o_orderstatus||'","s3://x/part_'||o_orderkey||'"]') AS asset_id FROM orders""")
def src5(spark, sf_dir):
    uri = F.concat(F.lit("s3://x/part_"), F.col("o_orderkey").cast("string"))
    return _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), readers.asset_id(F.lit("works"), F.lit("2024-01-01"), F.col("o_orderstatus"), uri).alias("asset_id"))


@base_query("src7_exact_schema", sql="SELECT 'supplier' AS name, count(*) FILTER (column_type <> CASE column_name WHEN 's_suppkey' THEN 'BIGINT' WHEN 's_name' THEN 'VARCHAR' WHEN 's_nationkey' THEN 'INTEGER' ELSE 'DOUBLE' END) AS as_declared, count(*) FILTER (column_type <> 'BIGINT') AS all_long FROM (DESCRIBE supplier)")
def src7(spark, sf_dir):
    df = _read(spark, sf_dir, "supplier")
    declared = T.StructType([T.StructField(n, k) for n, k in (("s_suppkey", T.LongType()), ("s_name", T.StringType()), ("s_nationkey", T.IntegerType()), ("s_acctbal", T.DoubleType()))])
    long = T.StructType([T.StructField(f.name, T.LongType()) for f in declared])
    differs = [len(readers.schema_differences(df, wanted)) for wanted in (declared, long)]
    return spark.createDataFrame([("supplier", *differs)], "name string, as_declared long, all_long long")


@base_query("src8_file_facts")
def src8(spark, sf_dir):
    return readers.file_facts(spark, f"{sf_dir}/lineitem.parquet").select("bytes", "rows")


@base_query("prf1_json_field_profile", sql="SELECT '' AS path, 'object' AS kind, count(*) AS present FROM events UNION ALL SELECT 'k', 'integer', count(*) FROM events WHERE json_extract(props,'$.k') IS NOT NULL")
def prf1(spark, sf_dir):
    return profiling.json_field_profile(_read(spark, sf_dir, "events").select(F.col("props").alias("raw")))


_IN_WORKS = "SELECT a.*, CAST(substr(w.work_id,2) AS BIGINT)%2=1 AS odd FROM {} a JOIN works w ON w.work_id=a.work_id"
#: Where the parent objects of a group of fields come from, and each field with its value. Odd works write their NULLs, even ones leave them out.
_FIELDS = {
    "works": {
        "id": "work_id_url", "doi": "doi", "title": "title", "display_name": "work_id", "type": "work_type", "language": "language", "publication_year": "publication_year",
        "publication_date": "publication_date", "cited_by_count": "cited_by_count", "open_access": "1", "open_access.is_oa": "is_oa", "open_access.oa_status": "oa_status",
        "primary_location": "1", "primary_location.source": "primary_source_id", "primary_location.landing_page_url": "1",
        **{to: f"(SELECT min(1) FROM {name} x WHERE x.work_id=a.work_id)" for to, name in {"authorships": "work_authors", "topics": "work_topics", "keywords": "work_keywords", "mesh": "work_mesh", "referenced_works": "work_references", "locations": "work_locations", "grants": "work_grants"}.items()},
    },
    "(SELECT * FROM works WHERE primary_source_id IS NOT NULL)": {"primary_location.source.id": "1", "primary_location.source.host_organization": "primary_publisher_id"},
    "work_authors": {"authorships[].author": "1", "authorships[].author_position": "1", "authorships[].author.id": "author_id", "authorships[].author.display_name": "author_id"},
    "work_topics": {"topics[].id": "topic_id", "topics[].display_name": "topic_id", "topics[].score": "1"},
    "work_keywords": {"keywords[].id": "keyword_id"},
    "work_mesh": {"mesh[].descriptor_ui": "descriptor_ui"},
    "work_locations": {"locations[].source": "source_id", "locations[].landing_page_url": "1", "locations[].license": "license"},
    "(SELECT * FROM work_locations WHERE source_id IS NOT NULL)": {"locations[].source.id": "1"},
    "work_grants": {"grants[].funder": "funder_id", "grants[].award_id": "1"},
}
_COUNTS = "SELECT path, count(*) FILTER (v OR odd) AS present, count(*) FILTER (NOT v AND odd) AS nulls, count(*) FILTER (NOT v AND NOT odd) AS missing FROM ({}) GROUP BY 1 HAVING count(*) FILTER (v OR odd)>0"
PRF1_SQL = _COUNTS.format(" UNION ALL ".join(f"SELECT '{path}' AS path, {value} IS NOT NULL AS v, odd FROM ({_IN_WORKS.format(origin)}) a" for origin, fields in _FIELDS.items() for path, value in fields.items()))


@query("prf1_work_field_profile", *RELATIONS, sql=PRF1_SQL)
def prf1_works(t):
    return profiling.missing_counts(profiling.json_field_profile(raw_works(t)))


@base_query("prf2_parquet_field_profile", sql="SELECT unnest(['c_custkey','c_name','c_nationkey','c_acctbal','c_mktsegment']) AS path, unnest(['integer','string','integer','number','string']) AS family, unnest([count(*) FILTER (c_custkey IS NULL), count(*) FILTER (c_custkey%4=0), count(*) FILTER (c_nationkey IS NULL), count(*) FILTER (c_custkey%3=0), count(*) FILTER (c_mktsegment='BUILDING')]) AS nulls FROM customer")
def prf2(spark, sf_dir):
    k = F.col("c_custkey")
    sparse = {"c_name": F.when(k % 4 != 0, F.col("c_name")), "c_acctbal": F.when(k % 3 != 0, F.col("c_acctbal")), "c_mktsegment": F.nullif("c_mktsegment", F.lit("BUILDING"))}
    return profiling.parquet_field_profile(_read(spark, sf_dir, "customer").withColumns(sparse))


@query("prf4_record_count_reconcile", "assets", sql="SELECT file_uri AS asset, record_count AS declared, record_count+CASE WHEN record_count%3=0 THEN 1 ELSE 0 END AS observed FROM assets WHERE record_count%3=0")
def prf4(t):
    a = t["assets"].select(F.col("file_uri").alias("asset"), "record_count")
    return profiling.record_count_reconcile(a, a.select("asset", (F.col("record_count") + (F.col("record_count") % 3 == 0).cast("long")).alias("records")))


@base_query("prf5_duplicate_dynamic_keys", sql="SELECT event_id FROM events WHERE event_id%10=0")
def prf5(spark, sf_dir):
    twice = F.when(F.col("event_id") % 10 == 0, F.lit('{"m":{"a":1,"a":2}}')).otherwise(F.lit('{"m":{"a":1,"b":2}}'))
    return profiling.duplicate_keys(_read(spark, sf_dir, "events").select("event_id", twice.alias("raw")), "m").select("event_id")


def _parts(t):
    part = F.regexp_extract("file_uri", "([0-9]+)", 1).cast("long")
    base = t["assets"].select("updated_date", part.alias("part"), "record_count", "byte_size")
    return base.where("part % 3 <> 0"), base.where("part % 4 <> 0").withColumn("record_count", F.col("record_count") + (F.col("part") % 5 == 0).cast("long"))


PAIRS = """WITH p AS (SELECT updated_date, CAST(regexp_extract(file_uri,'([0-9]+)') AS BIGINT) AS part, record_count AS n, byte_size AS b FROM assets),
 l AS (SELECT * FROM p WHERE part%3<>0), r AS (SELECT updated_date, part, n+CASE WHEN part%5=0 THEN 1 ELSE 0 END AS n, b FROM p WHERE part%4<>0),
 j AS (SELECT coalesce(l.updated_date, r.updated_date) AS updated_date, coalesce(l.part, r.part) AS part, l.n AS ln, r.n AS rn, l.b AS lb, r.b AS rb FROM l FULL JOIN r ON l.updated_date=r.updated_date AND l.part=r.part)"""
query("j11_pair_parts", "assets", sql=PAIRS + " SELECT CAST(updated_date AS VARCHAR) AS updated_date, part, ln AS left_records, lb AS left_bytes, rn AS right_records, rb AS right_bytes FROM j")(lambda t: _plain(profiling.pair_parts(*_parts(t))))
query("prf8_pair_selection", "assets", sql=PAIRS + " SELECT CAST(updated_date AS VARCHAR) AS updated_date, part FROM j WHERE lb<=300000 AND rb<=300000 AND ln>=100 AND rn>=100 ORDER BY j.updated_date DESC, part LIMIT 1")(lambda t: _plain(profiling.select_pair(profiling.pair_parts(*_parts(t)), 300_000, 100)).select("updated_date", "part"))
query("prf9_pair_summary", "assets", sql=PAIRS + " SELECT count(*) FILTER (ln IS NOT NULL AND rn IS NOT NULL) AS pairs, count(*) FILTER (ln IS NULL OR rn IS NULL) AS single, count(*) FILTER (ln<>rn) AS count_mismatches, count(*) FILTER (ln IS NOT NULL AND rn IS NOT NULL AND lb<=300000 AND rb<=300000) AS within_cap FROM j")(lambda t: profiling.pair_summary(profiling.pair_parts(*_parts(t)), 300_000))
query("j12_manifest_listing", "assets", sql="SELECT count(*) FILTER (record_count%7=0) AS missing, count(*) FILTER (record_count%7<>0 AND record_count%5=0 AND byte_size IS NOT NULL) AS size_mismatch, count(*) FILTER (record_count%7=0) AS unreferenced FROM (SELECT file_uri, record_count, coalesce(byte_size,0) AS byte_size FROM assets)")(
    lambda t: profiling.manifest_listing_reconcile(
        t["assets"].select("file_uri", F.coalesce("byte_size", F.lit(0)).alias("byte_size")),
        t["assets"].select(F.when(F.col("record_count") % 7 == 0, F.concat("file_uri", F.lit("x"))).otherwise(F.col("file_uri")).alias("file_uri"), (F.coalesce("byte_size", F.lit(0)) + (F.col("record_count") % 5 == 0).cast("long")).alias("byte_size")),
    )
)


@query("prf10_deletion_ledger_profile", "ledger", sql="""WITH s AS (SELECT deleted_date, CAST(substr(work_id,2) AS BIGINT) AS n, lag(CAST(substr(work_id,2) AS BIGINT)) OVER (PARTITION BY deleted_date ORDER BY work_id) AS b FROM ledger)
SELECT CAST(deleted_date AS VARCHAR) AS deleted_date, count(*) AS rows, 0 AS bad_shape, count(*) FILTER (n<b) AS out_of_order FROM s GROUP BY s.deleted_date""")  # fmt: skip
def prf10(t):
    return _plain(profiling.ledger_profile(t["ledger"].withColumn("pos", F.col("work_id"))))


@query("fid1_schema_fidelity", "works", sql="SELECT unnest(['work_id','is_oa','cited_by_count','title']) AS path, unnest(['string','boolean','integer','string']) AS kind, unnest(['string','boolean','string',NULL]) AS family, unnest(['MATCH','MATCH','CONFLICT','MISSING']) AS verdict FROM (SELECT count(*) AS n FROM works)")
def fid1(t):
    shaped = t["works"].where("title IS NOT NULL").select("work_id", "is_oa", "cited_by_count", "title")
    kinds = profiling.json_field_profile(shaped.select(F.to_json(F.struct("*")).alias("raw")))
    return profiling.schema_fidelity(kinds, profiling.parquet_field_profile(shaped.select("work_id", "is_oa", F.col("cited_by_count").cast("string"))))


@base_query("fid2_value_fidelity", sql="""SELECT field, count(*) FILTER (v='exact') AS exact, count(*) FILTER (v='float32') AS float32, count(*) FILTER (v='mismatch') AS mismatch, count(*) FILTER (v='one_side') AS one_side FROM (
 SELECT 'o_totalprice' AS field, CASE WHEN o_orderkey%2=0 OR CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE)=o_totalprice THEN 'exact' ELSE 'float32' END AS v FROM orders
 UNION ALL SELECT 'o_orderstatus', CASE WHEN o_orderkey%5=0 THEN 'one_side' WHEN o_orderkey%7=0 THEN 'mismatch' ELSE 'exact' END FROM orders) GROUP BY 1""")  # fmt: skip
def fid2(spark, sf_dir):
    k = F.col("o_orderkey")
    a = _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    b = a.select("o_orderkey", F.when(k % 2 == 0, F.col("o_totalprice")).otherwise(F.col("o_totalprice").cast("float").cast("double")).alias("o_totalprice"), F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, F.lit("?")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return profiling.value_fidelity(a, b, "o_orderkey", ["o_totalprice", "o_orderstatus"])


@base_query("fid3_sub_ms_timestamps", sql="SELECT count(*) FILTER (epoch_us(ts)%1000<>0) AS sub_ms, count(ts) AS n FROM events")
def fid3(spark, sf_dir):
    return profiling.sub_millisecond(_read(spark, sf_dir, "events"), "ts")


@base_query("red1_pseudonymize", sql="SELECT o_orderkey, 'customer-'||dense_rank() OVER (ORDER BY f, o_custkey) AS customer FROM (SELECT o_orderkey, o_custkey, min(o_orderkey) OVER (PARTITION BY o_custkey) AS f FROM orders)")
def red1(spark, sf_dir):
    o = _read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    return profiling.pseudonymize(o, {"customer": "customer"}, "o_orderkey")


POLICY = {"c_custkey": "keep", "c_name": "mask_person", "c_nationkey": "keep", "c_acctbal": "mask_price", "c_mktsegment": "replace_text"}


@base_query("red2_redact_records", sql="SELECT c_custkey, 'Person' AS c_name, c_nationkey, 0.0::DOUBLE AS c_acctbal, repeat('x', length(c_mktsegment)) AS c_mktsegment FROM customer")
def red2(spark, sf_dir):
    return profiling.redact(_read(spark, sf_dir, "customer"), POLICY)


NESTED = {"work_id": "keep", "authorships[].author.id": "keep", "authorships[].author.display_name": "mask_person", "authorships[].raw_author_name": "mask_person", "authorships[].fee": "mask_price", "notes.{value}": "replace_text"}


def nested_records(t):
    author = F.struct(F.struct(F.col("author_id").alias("id"), F.concat(F.lit("Name "), "author_id").alias("display_name")).alias("author"), F.col("author_id").alias("raw_author_name"), F.col("authorship_index").alias("fee"))
    listed = t["work_authors"].groupBy("work_id").agg(F.sort_array(F.collect_list(author)).alias("authorships"))
    return listed.withColumn("notes", F.create_map(F.lit("a"), F.col("work_id")))


@query("red2_redact_nested_paths", "work_authors", sql="SELECT work_id, count(author_id) AS ids, count(author_id) AS people, 0 AS fees, repeat('x', length(work_id)) AS note FROM work_authors GROUP BY 1")
def red2_nested(t):
    out = profiling.redact(nested_records(t), NESTED)
    count = lambda f: F.size(F.filter("authorships", f)).cast("long")
    fees = F.aggregate("authorships", F.lit(0).cast("long"), lambda s, a: s + a["fee"])
    return out.select("work_id", count(lambda a: a["author"]["id"].isNotNull()).alias("ids"), count(lambda a: (a["author"]["display_name"] == "Person") & (a["raw_author_name"] == "Person")).alias("people"), fees.alias("fees"), F.element_at("notes", "a").alias("note"))


@query("red2_unknown_path_is_rejected", "work_authors", sql="SELECT true AS rejected, count(DISTINCT work_id) AS n FROM work_authors")
def red2_unknown(t):
    rows, rejected = nested_records(t), False
    try:
        profiling.redact(rows, {k: v for k, v in NESTED.items() if not k.endswith("raw_author_name")})
    except ValueError as e:
        rejected = "authorships[].raw_author_name" in str(e)
    return rows.agg(F.count("*").alias("n")).withColumn("rejected", F.lit(rejected))


@base_query("red3_identifier_leaks", sql="SELECT s_suppkey FROM supplier WHERE s_suppkey%4=0 OR s_suppkey%5=0")
def red3_ids(spark, sf_dir):
    k = F.col("s_suppkey")
    s = _read(spark, sf_dir, "supplier").select(k, F.lit("Al").alias("person"), F.concat(F.lit("A"), k.cast("string"), F.lit(".")).alias("author"), F.concat(F.lit("0000-0001-"), F.lpad(k.cast("string"), 8, "0")).alias("orcid"))
    text = F.when(k % 4 == 0, F.concat(F.lit("see "), "author", F.lit(" there"))).when(k % 5 == 0, F.concat(F.lit("https://orcid.org/"), "orcid")).otherwise("by Person")
    return profiling.leaks(s, s.select("s_suppkey", text.alias("text")), "s_suppkey", "person", "text", identifiers=("author", "orcid"))


@base_query("red3_leak_check", sql="SELECT s_suppkey FROM supplier WHERE s_suppkey%4=0")
def red3(spark, sf_dir):
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("Quixote"), F.col("s_suppkey").cast("string")).alias("person"))
    masked = s.select("s_suppkey", F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("by "), F.col("person"), F.lit(", again"))).otherwise("by Person").alias("text"))
    return profiling.leaks(s, masked, "s_suppkey", "person", "text")


@base_query("red4_postcondition_check", sql=r"SELECT unnest(['email','person','price']) AS rule, unnest([n, people, prices]) AS violations FROM (SELECT count(*) FILTER (regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+')) AS n, count(*) FILTER (doc_id%5=0 AND source IS NOT NULL) AS people, count(*) FILTER (doc_id%7=0 AND n_chars<>0) AS prices FROM documents)")
def red4(spark, sf_dir):
    """Real output of redact, into which some rows come back unmasked."""
    rows = _read(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("person"), F.col("n_chars").alias("price"))
    masked = profiling.redact(rows, {"doc_id": "keep", "text": "keep", "person": "mask_person", "price": "mask_price"}).alias("m").join(rows.alias("r"), F.col("m.doc_id") == F.col("r.doc_id"))
    mixed = masked.select("m.text", F.when(F.col("m.doc_id") % 5 == 0, F.col("r.person")).otherwise(F.col("m.person")).alias("person"), F.when(F.col("m.doc_id") % 7 == 0, F.col("r.price")).otherwise(F.col("m.price")).alias("price"))
    return profiling.postconditions(mixed, "text", "person", "price")


EMAIL_SQL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
RED4_SQL = rf"""WITH m AS (SELECT conv_id, turn, role, text, conv_id%5=0 AS person, conv_id%7=0 AS price FROM conversations),
v AS (SELECT 'authors[].name' AS path, 'mask_person' AS rule, count(*) FILTER (person AND role IS NOT NULL) AS violations FROM m UNION ALL SELECT 'fees.{{value}}', 'mask_price', count(*) FILTER (price AND turn<>0) FROM m
UNION ALL SELECT 'body.text', 'replace_text', count(*) FILTER (person AND regexp_matches(text, '[^x]')) FROM m UNION ALL SELECT 'body.text', 'email', count(*) FILTER (person AND regexp_matches(text, '{EMAIL_SQL}')) FROM m
UNION ALL SELECT 'note', 'email', count(*) FILTER (conv_id%3=0) FROM m) SELECT * FROM v WHERE violations>0"""


@base_query("red4_nested_postconditions", sql=RED4_SQL)
def red4_nested(spark, sf_dir):
    """Real output of redact over lists, structs and maps, into which some values come back unmasked."""
    c = _read(spark, sf_dir, "conversations")
    shaped = lambda name, text, fee: [F.array(F.struct(name.alias("name"))).alias("authors"), F.struct(text.alias("text")).alias("body"), F.create_map(F.lit("list"), fee).alias("fees")]
    note = F.concat(F.lit("to "), F.when(F.col("conv_id") % 3 == 0, "a.b@example.org").otherwise("nobody")).alias("note")
    rows = c.select("conv_id", *shaped(F.col("role"), F.col("text"), F.col("turn")), note)
    policy = {"conv_id": "keep", "authors[].name": "mask_person", "body.text": "replace_text", "fees.{value}": "mask_price", "note": "keep"}
    done = profiling.redact(rows.withColumn("raw", F.struct("authors", "body", "fees")), {**policy, "raw.authors[].name": "keep", "raw.body.text": "keep", "raw.fees.{value}": "keep"})
    k5, k7 = F.col("conv_id") % 5 == 0, F.col("conv_id") % 7 == 0
    mixed = done.select("conv_id", F.when(k5, F.col("raw.authors")).otherwise(F.col("authors")).alias("authors"), F.when(k5, F.col("raw.body")).otherwise(F.col("body")).alias("body"), F.when(k7, F.col("raw.fees")).otherwise(F.col("fees")).alias("fees"), "note")
    return profiling.masking_violations(mixed, policy)


# --- releases ----------------------------------------------------------------------------------------------------


@query("rel1_replay", "target", "ledger", "staging", "work_topics", sql=STATE + " SELECT state, count(*) AS works FROM st WHERE state IS NOT NULL GROUP BY 1")
def rel1(t):
    seen = observations(t)
    topics = seen.where("kind = 'work'").select("work_id", "seq", "pos").join(t["work_topics"], "work_id")
    built, _ = release.replay(seen, {"work_topics": topics}, {})
    return built["works"].groupBy("state").agg(F.count("*").alias("works"))


@query("rel1_replay_from_parent", "target", "ledger", "staging", "work_topics", sql=STATE + " SELECT st.work_id, st.state, count(w.work_id) AS topics FROM st LEFT JOIN work_topics w ON w.work_id=st.work_id WHERE st.state IS NOT NULL GROUP BY ALL")
def rel1_parent(t):
    """A release of the first assets, and a second one that goes on from its tables with the last asset only."""
    seen = observations(t)
    topics = seen.where("kind = 'work'").select("work_id", "seq", "pos").join(t["work_topics"], "work_id")
    last = seen.agg(F.max("seq")).first()[0]
    parent, _ = release.replay(seen.where(F.col("seq") < last), {"work_topics": topics.where(F.col("seq") < last)}, {})
    parent = {n: kept(df) for n, df in parent.items()}
    built, _ = release.replay(seen.where(F.col("seq") == last), {"work_topics": topics.where(F.col("seq") == last)}, {}, parent)
    counts = built["work_topics"].groupBy("work_id").agg(F.count("*").alias("topics"))
    return built["works"].join(counts, "work_id", "left").select("work_id", "state", F.coalesce("topics", F.lit(0)).alias("topics"))


query("rel3_release_manifest", "works", "work_topics", "publishers", sql=" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count, {a} AS active, {d} AS deleted FROM {n}" for n, a, d in (("works", "count(*) FILTER (activity_state='ACTIVE')", "count(*) FILTER (activity_state='DELETED')"), ("work_topics", "0", "0"), ("publishers", "count(*) FILTER (activity_state='ACTIVE')", "count(*) FILTER (activity_state='DELETED')"))))(lambda t: release.release_manifest({n: t[n] for n in ("works", "work_topics", "publishers")}).select("table_name", "row_count", "active", "deleted"))


@query("rel5_reconcile_release", "target", "staging", sql="SELECT 'works' AS table_name, count(*) FILTER (work_id LIKE '%7') AS only_released, 0 AS only_rebuilt FROM target")
def rel5(t):
    return release.reconcile_release({"works": t["target"]}, {"works": t["target"].where("work_id NOT LIKE '%7'").repartition(7)})


@query("rel4_validate_release", "works", "work_topics", sql="SELECT 'work_topics' AS table_name, f.fact FROM (SELECT unnest(['row_count','hash_xor','hash_sum']) AS fact) f WHERE (SELECT count(*) FROM work_topics WHERE work_id = 'W1001' OR work_id LIKE '%9') > 0")
def rel4(t):
    stated = release.release_manifest({n: t[n] for n in ("works", "work_topics")})
    return release.compare_manifests(stated, release.release_manifest({"works": t["works"].repartition(5), "work_topics": t["work_topics"].where("work_id <> 'W1001' AND work_id NOT LIKE '%9'")}))


@query("rel6_input_balance", "assets", sql="SELECT file_uri AS asset, 'rows' AS law FROM assets WHERE record_count%10=0")
def rel6(t):
    n = F.col("record_count")
    inputs = t["assets"].select(F.col("file_uri").alias("asset"), n.alias("lines"), (n - 1).alias("records"), F.lit(1).alias("rejected"), (n - 1).alias("outcomes"), n.alias("rows"), (n - (n % 10 == 0).cast("long")).alias("unique_rows"), F.lit(0).alias("duplicates"))
    return release.input_balance(inputs)


@query("rel8_parent_check", "assets", sql="SELECT asset_id, file_uri FROM assets WHERE record_count%9=0")
def rel8(t):
    inputs = t["assets"].select("asset_id", "file_uri", "record_count")
    return release.parent_mismatches(inputs, inputs.where("record_count % 9 <> 0")).select("asset_id", "file_uri")


@query("str3_late_data", "target", "ledger", "staging", sql=f"SELECT CASE WHEN seq=2 THEN 'deletion' ELSE 'work' END AS kind, outcome, count(*) AS n FROM ({FOLD}) WHERE outcome IN ('STALE','BLOCKED','ALREADY_DELETED') GROUP BY ALL")
def str3(t):
    from folioforge.streaming.ingest import late_outcomes

    return late_outcomes(versions.outcomes_of(versions.fold_observations(observations(t))))
