"""Scans, sinks, streams and jobs as registered queries: files that Spark writes from the base tables are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge.operators import gold, profiling, publication, release, versions
from folioforge.plans import jobs, schemas
from folioforge.plans.gold_queries import ALL, _plain
from folioforge.plans.mapping_queries import RELATIONS, raw_works
from folioforge.plans.registry import base_query, query
from folioforge.plans.version_queries import MERGED, STATE, TARGET_DECISIONS, observations
from folioforge.sources import readers, writers
from folioforge.sources.scratch import new_folder
from folioforge.streaming import ingest


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- scans -------------------------------------------------------------------------------------------------------


def event_lines(spark, sf_dir):
    """A folder of packed JSON lines of the events, some of them broken or blank."""
    k = F.col("event_id") % 10
    line = F.when(k == 0, F.lit("{bad")).when(k == 1, F.lit("[1]")).when(k == 2, F.lit("  ")).otherwise(F.to_json(F.struct("event_id", "event_type")))
    folder = new_folder(spark, "lines")
    _read(spark, sf_dir, "events").select(line.alias("value")).write.option("compression", "gzip").text(folder)
    return folder


@base_query("src1_works_jsonl_scan", sql="SELECT CASE event_id%10 WHEN 0 THEN 'MALFORMED_JSON' WHEN 1 THEN 'NOT_AN_OBJECT' END AS error, count(*) AS n FROM events WHERE event_id%10<>2 GROUP BY 1")
def src1(spark, sf_dir):
    return readers.read_works_jsonl(spark, event_lines(spark, sf_dir)).groupBy("error").agg(F.count("*").alias("n"))


LEDGER_LINES = """SELECT CASE WHEN work_id LIKE '%5' THEN 'X'||work_id ELSE work_id END AS work_id, CASE WHEN work_id LIKE '%3' THEN '2024-02-31' ELSE CAST(deleted_date AS STRING) END AS deleted_date FROM ledger"""


def ledger_file(t):
    t["ledger"].createOrReplaceTempView("ledger")
    spark = t["ledger"].sparkSession
    folder = new_folder(spark, "ledger")
    spark.sql(LEDGER_LINES).write.option("header", True).csv(folder)
    return folder


@query("src3_deletion_csv_scan", "ledger", sql="SELECT CASE WHEN work_id NOT LIKE '%5' THEN work_id END AS work_id, CASE WHEN work_id NOT LIKE '%3' THEN CAST(deleted_date AS VARCHAR) END AS deleted_date, CASE WHEN work_id LIKE '%5' THEN 'BAD_ID' WHEN work_id LIKE '%3' THEN 'BAD_DATE' END AS error FROM ledger")
def src3(t):
    return _plain(readers.read_deletions(t["ledger"].sparkSession, ledger_file(t)).select("work_id", "deleted_date", "error"))


MANIFEST_FILES = 5_000


@query("src4_manifest_scan", "assets", sql="SELECT file_uri, format, byte_size, record_count, CASE WHEN byte_size IS NULL THEN 'NO_COUNTS' WHEN byte_size<0 THEN 'NEGATIVE_COUNT' END AS error FROM assets")
def src4(t):
    spark, folder = t["assets"].sparkSession, new_folder(t["assets"].sparkSession, "manifests")
    meta = F.struct(F.col("byte_size").alias("content_length"), "record_count")
    # A manifest is one value to its reader, so each lists a bounded number of files and has a file of its own.
    numbered = t["assets"].withColumn("part", F.expr(f"monotonically_increasing_id() div {MANIFEST_FILES}"))
    files = numbered.groupBy("format", "entity", "part").agg(F.collect_list(F.struct(F.col("file_uri").alias("url"), meta.alias("meta"))).alias("files"))
    files.select(F.lit("2024-01-01").alias("date"), "entity", "files", "format").write.option("maxRecordsPerFile", 1).partitionBy("format").json(folder)
    return readers.read_manifest(spark, folder).select("file_uri", "format", "byte_size", "record_count", "error")


@query("src9_works_parquet_scan", "works", sql="SELECT work_id, CAST(publication_date AS VARCHAR) AS publication_date, 'b' AS last_key, CASE WHEN title IS NULL THEN 'b,work_id' ELSE 'b,title,work_id' END AS told FROM works")
def src9(t):
    spark, folder = t["works"].sparkSession, new_folder(t["works"].sparkSession, "parquet")
    t["works"].select("work_id", "publication_date", "title", F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2)).alias("counts")).write.parquet(folder)
    raw = readers.read_works_parquet(spark, folder)
    told = F.array_join(F.array_sort(F.array_append(F.filter(F.json_object_keys("raw"), lambda k: k.isin("work_id", "title")), F.element_at(F.json_object_keys(F.get_json_object("raw", "$.counts")), -1))), ",")
    return raw.select(F.get_json_object("raw", "$.work_id").alias("work_id"), F.get_json_object("raw", "$.publication_date").alias("publication_date"), F.element_at(F.json_object_keys(F.get_json_object("raw", "$.counts")), -1).alias("last_key"), told.alias("told"))


@base_query("src8_file_rows", sql="SELECT count(*) AS rows, 6 AS largest_within FROM lineitem")
def src8(spark, sf_dir):
    folder = new_folder(spark, "parts")
    _read(spark, sf_dir, "lineitem").write.option("maxRecordsPerFile", 5000).parquet(folder)
    return readers.file_facts(spark, folder).agg(F.sum("rows").alias("rows"), F.when((F.max("rows") <= 5000) & (F.min("bytes") > 0), 6).otherwise(0).alias("largest_within"))


@base_query("prf3_line_counts", sql="SELECT count(*) FILTER (event_id%10<>2) AS records, count(*) FILTER (event_id%10=2) AS blank FROM events")
def prf3(spark, sf_dir):
    return profiling.line_counts(spark, event_lines(spark, sf_dir)).agg(F.sum("records").alias("records"), F.sum("blank").alias("blank"))


@base_query("prf6_asset_checksum", sql="SELECT sha256(n_name||chr(10)) AS checksum, strlen(n_name)+1 AS bytes FROM nation")
def prf6(spark, sf_dir):
    folder = new_folder(spark, "assets")
    _read(spark, sf_dir, "nation").select(F.col("n_name").alias("value"), "n_nationkey").write.partitionBy("n_nationkey").text(folder)
    return profiling.asset_checksums(spark, f"{folder}/*").select("checksum", "bytes")


# --- sinks -------------------------------------------------------------------------------------------------------


def canonical(df, name):
    """df in the exact shape of a canonical table; what it lacks is NULL or a fixed lineage."""
    wanted = schemas.schema(name)
    given = {"source_asset_id": F.lit("a1"), "source_checksum_sha256": F.lit("c1"), "run_id": F.lit("r1"), "processed_at": F.lit("2024-01-01 00:00:00").cast("timestamp"), "activity_state": F.lit("ACTIVE"), "lineage_source_updated_date": F.lit("2024-01-01").cast("date")}
    cols = [F.col(f.name) if f.name in df.columns else given.get(f.name, F.lit(None) if f.nullable else F.lit("PRESENT")) for f in wanted]
    return df.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, wanted, strict=True)])


@query("snk1_canonical_parquet_write", "work_topics", sql="SELECT topic_id, count(*) AS n, 'a1' AS source_asset_id FROM work_topics GROUP BY 1")
def snk1(t):
    spark, folder = t["work_topics"].sparkSession, new_folder(t["work_topics"].sparkSession, "canonical")
    writers.write_canonical({"work_topics": canonical(t["work_topics"], "work_topics")}, folder)
    return readers.read_canonical(spark, "work_topics", f"{folder}/work_topics").groupBy("topic_id").agg(F.count("*").alias("n"), F.max("source_asset_id").alias("source_asset_id"))


@query("snk2_partitioned_warehouse_write", "works", sql="SELECT publication_year, count(*) AS n, count(DISTINCT work_id) AS works FROM works GROUP BY 1")
def snk2(t):
    spark, folder = t["works"].sparkSession, new_folder(t["works"].sparkSession, "warehouse")
    writers.write_warehouse({"works": canonical(t["works"], "works")}, folder)
    stored = spark.read.parquet(f"{folder}/works")
    return stored.groupBy("publication_year").agg(F.count("*").alias("n"), F.countDistinct("work_id").alias("works"))


@query("snk3_append_event_log", "ledger", sql="SELECT count(*) AS rows, count(DISTINCT work_id) AS works FROM (SELECT DISTINCT work_id FROM ledger)")
def snk3(t):
    spark, folder = t["ledger"].sparkSession, new_folder(t["ledger"].sparkSession, "log")
    rows = t["ledger"].select("work_id", "deleted_date")
    writers.append_log(rows.where("work_id LIKE '%0'"), folder, ["work_id"])
    for _ in range(2):  # what is there already, and repeats, are not appended again
        writers.append_log(rows.unionByName(rows), folder, ["work_id"])
    return spark.read.parquet(folder).agg(F.count("*").alias("rows"), F.countDistinct("work_id").alias("works"))


@query("snk4_lookup_projection_publish", "works", sql="SELECT work_id, doi, true AS first_written, false AS again_written FROM works WHERE activity_state='ACTIVE'")
def snk4(t):
    spark, folder = t["works"].sparkSession, new_folder(t["works"].sparkSession, "lookup")
    told = [writers.publish_lookup(t["works"], folder, ["work_id", "doi"])["written"] for _ in range(2)]
    return publication.read_active(spark, folder).select("work_id", "doi", F.lit(told[0]).alias("first_written"), F.lit(told[1]).alias("again_written"))


@query("pub3_rollback", "works", sql="SELECT activity_state, count(*) AS n FROM works WHERE activity_state='ACTIVE' GROUP BY 1")
def pub3(t):
    spark, root = t["works"].sparkSession, new_folder(t["works"].sparkSession, "versions")
    for version, rows in (("v1", t["works"].where("activity_state = 'ACTIVE'")), ("v2", t["works"])):
        publication.activate(spark, root, version, publication.stage(rows, root, version))
    publication.restore(spark, root)
    return publication.read_active(spark, root).groupBy("activity_state").agg(F.count("*").alias("n"))


@query("rel2_render_release", "works", sql="SELECT 'works' AS table_name, count(*) AS rows, true AS within, count(*)>1 AS sorted FROM works")
def rel2(t):
    folder = new_folder(t["works"].sparkSession, "release")
    parts = release.render_release({"works": t["works"]}, folder, 500)
    out = t["works"].sparkSession.read.parquet(f"{folder}/works").groupBy("_metadata.file_name").agg(F.min("work_id").alias("low"), F.max("work_id").alias("high"))
    overlaps = out.alias("a").join(out.alias("b"), (F.col("a.low") < F.col("b.low")) & (F.col("a.high") >= F.col("b.low"))).isEmpty()  # one row for each file
    return parts.groupBy("table_name").agg(F.sum("rows").alias("rows"), (F.max("rows") <= 500).alias("within")).withColumn("sorted", F.lit(overlaps))


@query("rel7_publication_record", "works", "work_topics", sql="SELECT sequence, 'r'||sequence AS release_id, sequence=2 AS gate_passed, CASE WHEN sequence=2 THEN 'r1' END AS previous FROM (SELECT unnest([1,2]) AS sequence) WHERE (SELECT count(*) FROM works)>0")
def rel7(t):
    spark, folder = t["works"].sparkSession, new_folder(t["works"].sparkSession, "publications")
    manifests = {1: release.release_manifest({"works": t["works"]}), 2: release.release_manifest({"works": t["works"], "work_topics": t["work_topics"]})}
    for sequence, passed, previous in ((1, False, None), (1, False, None), (2, True, "r1")):  # the repeat changes nothing
        release.record_publication(spark, folder, sequence, f"r{sequence}", manifests[sequence], passed, previous)
    return spark.read.parquet(folder).select("sequence", "release_id", "gate_passed", "previous")


# --- streams -----------------------------------------------------------------------------------------------------

def observation_files(t, *seqs):
    """A folder that gets one delivery of observations for each asset, in order."""
    folder = new_folder(t["target"].sparkSession, "observations")
    seen = observations(t)
    for seq in seqs:
        seen.where(F.col("seq") == seq).coalesce(1).write.mode("append").json(folder)
    return folder


def run_stream(t, *seqs, after=None):
    spark = t["target"].sparkSession
    root = new_folder(spark, "stream")
    state = ingest.StateTable(spark, root)
    ingest.run_once(ingest.file_stream(spark, observation_files(t, *seqs), max_files=1), state, f"{root}/checkpoint", after)
    return state


@query("str1_incremental_file_source", "target", "ledger", "staging", sql="SELECT 'work' AS kind, count(*) AS n FROM target UNION ALL SELECT 'deletion', count(*) FROM ledger")
def str1(t):
    return run_stream(t, 1, 2).outcomes().groupBy("kind").agg(F.count("*").alias("n"))


@query("str2_stateful_upsert", "target", "ledger", "staging", sql=STATE + " SELECT * FROM st")
def str2(t):
    return run_stream(t, 1, 2).read().select("work_id", "state")


@query("str4_duplicate_delivery", "target", "ledger", "staging", sql=STATE + " SELECT * FROM st")
def str4(t):
    return run_stream(t, 1, 2, 2).read().select("work_id", "state")


@query("str5_incremental_gold_refresh", "target", "ledger", "staging", "works", sql=STATE + " SELECT publication_year, count(*) AS work_count FROM works w JOIN st ON st.work_id=w.work_id WHERE st.state='ACTIVE' GROUP BY 1")
def str5(t):
    spark, stored = t["works"].sparkSession, {}
    start = {"works": t["works"].withColumn("activity_state", F.lit("ACTIVE"))}
    stored["publication_trends"] = gold.publication_trends(start)

    def old_new(state):
        now = t["works"].drop("activity_state").join(state.select("work_id", F.col("state").alias("activity_state")), "work_id")
        return start, {"works": now}

    def store(name, df):
        folder = new_folder(spark, "mart")
        df.write.parquet(folder)
        stored[name] = spark.read.parquet(folder)

    run_stream(t, 1, 2, after=ingest.refresh_after(old_new, ["publication_trends"], store, stored.__getitem__))
    return stored["publication_trends"]


@query("str6_gated_publish", "target", "ledger", "staging", sql="SELECT 'ACTIVE' AS state, count(*) AS works, true AS stopped FROM target")
def str6(t):
    spark, folder = t["target"].sparkSession, new_folder(t["target"].sparkSession, "published")
    gate = ingest.gated(lambda state: state.where("state = 'DELETED'").isEmpty(), lambda state: state.write.mode("overwrite").parquet(folder))
    stopped = False
    try:
        run_stream(t, 1, 2, after=gate)
    except Exception as e:  # the second batch holds deletions, so its gate fails and nothing of it is published
        stopped = "quality gate" in str(e)
    return spark.read.parquet(folder).groupBy("state").agg(F.count("*").alias("works")).withColumn("stopped", F.lit(stopped))


# --- jobs --------------------------------------------------------------------------------------------------------

#: Works that an asset is given: an asset of more than RECORDS counts as broken, and these of some kilobytes each stay below ASSET_BYTES as well.
ASSET_WORKS = readers.RECORDS // 5


def ledger_files(rows, folder):
    """Rows (work_id, deleted_date) as ledgers, none of them with more ids than one may have."""
    rows.write.option("maxRecordsPerFile", readers.LEDGER_IDS).option("header", True).csv(folder)
    return folder


def works_file(t):
    """A folder of packed works, in as many assets as the bounds of one ask for."""
    folder = new_folder(t["works"].sparkSession, "raw")
    # One source may stand with several publishers in these tables; such a clash would abort the asset, so hosts are left out.
    raw = F.regexp_replace("raw", '"host_organization":"[^"]*",?', "")
    lines = raw_works(t).select(F.regexp_replace(raw, ",}", "}").alias("value"))
    lines.write.option("maxRecordsPerFile", ASSET_WORKS).option("compression", "gzip").text(f"{folder}/updated_date=2024-01-01")
    return f"{folder}/updated_date=2024-01-01"


INGESTED = """SELECT 'works' AS table_name, count(*) AS n FROM works UNION ALL SELECT 'work_authors', count(*) FROM work_authors WHERE work_id IN (SELECT work_id FROM works)
UNION ALL SELECT 'work_topics', count(*) FROM work_topics WHERE work_id IN (SELECT work_id FROM works) UNION ALL SELECT 'work_references', count(*) FROM work_references WHERE work_id IN (SELECT work_id FROM works)
UNION ALL SELECT 'sources', count(DISTINCT s) FROM (SELECT primary_source_id AS s FROM works UNION ALL SELECT source_id FROM work_locations WHERE work_id IN (SELECT work_id FROM works)) UNION ALL SELECT 'decoded', count(*) FROM works UNION ALL SELECT 'rejected', 0 UNION ALL SELECT 'deleted', count(*) FROM works WHERE work_id LIKE '%7'"""


@query("job1_ingest_works", *RELATIONS, sql=INGESTED)
def job1(t):
    spark = t["works"].sparkSession
    ledger = ledger_files(t["works"].where("work_id LIKE '%7'").select("work_id", F.lit("2024-06-01").alias("deleted_date")), new_folder(spark, "ledger"))
    tables, counters, _ = jobs.ingest_works(spark, works_file(t), ledger)
    out = counters.select(F.explode(F.map_from_arrays(F.array(F.lit("decoded"), F.lit("rejected")), F.array("decoded", "rejected"))).alias("table_name", "n"))
    for name in ("works", "work_authors", "work_topics", "work_references", "sources"):
        out = out.unionByName(tables[name].agg(F.lit(name).alias("table_name"), F.count("*").alias("n")))
    return out.unionByName(tables["works"].where("activity_state = 'DELETED'").agg(F.lit("deleted").alias("table_name"), F.count("*").alias("n")))


@query("job2_ingest_deletions", "ledger", sql="SELECT 0 AS bad, count(*) AS observed, CAST(max(deleted_date) AS VARCHAR) AS last_date FROM ledger")
def job2(t):
    spark = t["ledger"].sparkSession
    seen, bad = jobs.ingest_deletions(spark, ledger_files(t["ledger"], new_folder(spark, "ledger")))
    return _plain(seen.agg(F.count("*").alias("observed"), F.max("lineage_date").alias("last_date")).withColumn("bad", F.lit(bad.count())))


@query("job2_ledgers_apart", "ledger", sql="SELECT work_id, CAST(deleted_date AS VARCHAR) AS deleted_date, NULL AS error FROM ledger WHERE work_id LIKE '%0' UNION ALL SELECT NULL, NULL, unnest(['DATE_CONFLICT','TOO_MANY_IDS'])")
def job2_apart(t):
    """Three ledgers: a clean one, one that gives each work two dates, and one with too many ids. The works of the first are in the last as well."""
    spark, folder = t["ledger"].sparkSession, new_folder(t["ledger"].sparkSession, "ledgers")
    twice = t["ledger"].where("work_id LIKE '%5'")
    ledgers = {"1": t["ledger"].where("work_id LIKE '%0'"), "2": twice.unionByName(twice.withColumn("deleted_date", F.date_add("deleted_date", 1))), "3": t["ledger"]}
    for day, rows in ledgers.items():
        rows.coalesce(1).write.option("header", True).csv(f"{folder}/updated_date=2024-01-0{day}")
    seen, bad = jobs.ingest_deletions(spark, f"{folder}/*", most_ids=t["ledger"].count() * 3 // 4)
    return _plain(seen.select("work_id", F.col("lineage_date").alias("deleted_date"), F.lit(None).cast("string").alias("error")).unionByName(bad.select(F.lit(None).cast("string").alias("work_id"), F.lit(None).cast("date").alias("deleted_date"), "error")))


@query("job3_full_pipeline", *RELATIONS, sql="""SELECT 'publication_trends' AS mart_id, count(*) AS row_count FROM (SELECT DISTINCT publication_year FROM works) UNION ALL SELECT 'open_access_trends', count(*) FROM (SELECT DISTINCT publication_year, oa_status FROM works)
UNION ALL SELECT 'research_discovery', count(*) FROM works UNION ALL SELECT 'citation_edges', count(*) FROM work_references WHERE work_id IN (SELECT work_id FROM works)""")  # fmt: skip
def job3(t):
    spark = t["works"].sparkSession
    report = jobs.run_pipeline(spark, works_file(t), None, new_folder(spark, "pipeline"), "run-1")
    counts = report.get("counts", {})
    told = [(m, counts.get(m)) for m in ("publication_trends", "open_access_trends", "research_discovery", "citation_edges")]
    return spark.createDataFrame(told, "mart_id string, row_count long")


PUBLISHED = MERGED + """, scope AS (SELECT work_id FROM d WHERE publication_decision IN ('INSERT','APPLY_UPDATE') AND source_activity_state='ACTIVE'),
 topics AS (SELECT * FROM work_topics WHERE work_id NOT IN (FROM scope) UNION ALL SELECT * FROM staging_topics WHERE work_id IN (FROM scope))
SELECT m.run_id, m.activity_state, count(*) AS works, CAST(sum(coalesce(n, 0)) AS BIGINT) AS topics FROM merged m LEFT JOIN (SELECT work_id, count(*) AS n FROM topics GROUP BY 1) x ON x.work_id=m.work_id GROUP BY ALL"""


def _published(t):
    spark = t["target"].sparkSession
    out = jobs.publish_batch({"works": t["target"], "work_topics": t["work_topics"]}, {"works": t["staging"], "work_topics": t["staging_topics"]}, new_folder(spark, "batch"))
    n = out["work_topics"].groupBy("work_id").agg(F.count("*").alias("n"))
    return out["works"].join(n, "work_id", "left").groupBy("run_id", "activity_state").agg(F.count("*").alias("works"), F.sum(F.coalesce("n", F.lit(0))).alias("topics"))


query("job4_publish_batch", "target", "staging", "work_topics", "staging_topics", sql=PUBLISHED)(_published)
query("mrg5_publish_unit", "target", "staging", "work_topics", "staging_topics", sql=PUBLISHED)(_published)


@query("del5_preserve_relationships", "target", "staging", "work_topics", "staging_topics", sql=TARGET_DECISIONS + " SELECT t.work_id, t.topic_id FROM work_topics t JOIN d ON d.work_id=t.work_id WHERE publication_decision='APPLY_UPDATE' AND source_activity_state='DELETED'")
def del5(t):
    decisions = versions.publication_decisions(t["staging"], t["target"])
    after = versions.replace_by_work(t["work_topics"], t["staging_topics"], versions.relationship_scope(decisions))
    gone = decisions.where("publication_decision = 'APPLY_UPDATE' AND source_activity_state = 'DELETED'").select("work_id")
    return after.join(gone, "work_id", "left_semi").select("work_id", "topic_id")


@query("job5_reconcile_release", "works", "work_topics", sql="SELECT 'work_topics' AS table_name, count(*) FILTER (topic_id LIKE '%1') AS only_released, 0 AS only_rebuilt FROM work_topics UNION ALL SELECT 'works', 0, count(*) FILTER (work_id LIKE '%9') FROM works")
def job5(t):
    spark, folder = t["works"].sparkSession, new_folder(t["works"].sparkSession, "release")
    tables = {"works": t["works"].where("work_id NOT LIKE '%9'"), "work_topics": t["work_topics"]}
    manifest = jobs.build_release(tables, folder)
    if not release.validate_release(spark, folder, manifest).isEmpty():
        raise ValueError("the written release differs from its manifest")
    released = {n: spark.read.parquet(f"{folder}/{n}") for n in tables}
    return release.reconcile_release(released, {"works": t["works"], "work_topics": t["work_topics"].where("topic_id NOT LIKE '%1'")})


@base_query("job6_inspect_source", sql="SELECT 'event_id' AS path, count(*) AS present, 0 AS nulls, 0 AS missing FROM events WHERE event_id%10>2 UNION ALL SELECT 'event_type', count(*), 0, 0 FROM events WHERE event_id%10>2")
def job6(spark, sf_dir):
    return jobs.inspect(spark, event_lines(spark, sf_dir))["fields"].where("path IN ('event_id', 'event_type')")


VALUES_SQL = """WITH e AS (SELECT * FROM events WHERE event_id%10>2), c AS (SELECT count(*) AS n, count(*) FILTER (event_id%7=0) AS other, count(*) FILTER (event_id%11=0) AS absent FROM e)
SELECT 'kind' AS field, n-other AS exact, 0 AS float32, other AS mismatch, 0 AS one_side FROM c UNION ALL SELECT 'rate', 0, n, 0, 0 FROM c UNION ALL SELECT 'at', n-absent, 0, 0, absent FROM c"""


@base_query("job6_value_fidelity", sql=VALUES_SQL)
def job6_values(spark, sf_dir):
    """JSON lines of the events beside a Parquet form with narrowed numbers, some other kinds and some absent structs."""
    at = F.struct(F.col("event_id").alias("n"), F.create_map(F.lit("k"), "event_type").alias("m")).alias("at")
    rows = _read(spark, sf_dir, "events").where("event_id % 10 > 2").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), (F.col("event_id") + F.lit(0.1)).cast("double").alias("rate"), at)
    lines, stored = new_folder(spark, "lines"), new_folder(spark, "stored")
    rows.select(F.to_json(F.struct("*")).alias("value")).write.option("compression", "gzip").text(lines)
    other = F.when(F.col("id") % 7 == 0, F.concat("kind", F.lit("?"))).otherwise(F.col("kind")).alias("kind")
    rows.select("id", other, F.col("rate").cast("float").alias("rate"), F.when(F.col("id") % 11 != 0, F.col("at")).alias("at")).write.parquet(stored)
    return jobs.inspect(spark, lines, stored)["values"]


@base_query("job7_named_parameter_query", sql="SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 100.5 AND c_mktsegment <> 'BUILDING' GROUP BY 1")
def job7(spark, sf_dir):
    return jobs.named_query(spark, "SELECT c_mktsegment, count(*) AS n FROM customers WHERE c_acctbal > :least AND c_mktsegment <> :segment GROUP BY 1", {"least": 100.5, "segment": "BUILDING"}, {"customers": _read(spark, sf_dir, "customer")})


__all__ = ["ALL"]
