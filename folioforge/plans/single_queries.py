"""One query for each small rule, join, aggregate and order that others only use in passing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions import scalars as S
from folioforge.operators import aggregates, gold, lookups, mapping, profiling, quality, release, versions
from folioforge.plans.gold_queries import ALL, DISCOVERY, LIST, _plain
from folioforge.plans.mapping_queries import BROKEN, RELATIONS, _broken
from folioforge.plans.registry import ORACLES, QUERIES, base_query, query
from folioforge.sources.scratch import kept


def part_of(name: str, of: str, *columns: str) -> None:
    """Register some columns of another query as a query of their own."""
    QUERIES[name] = lambda spark, sf_dir: QUERIES[of](spark, sf_dir).select(*columns)
    ORACLES[name] = f"SELECT {', '.join(columns)} FROM ({ORACLES[of]})"


# --- scalars -----------------------------------------------------------------------------------------------------



def told(name: str, rule: Callable[[Column], Column], *cases: tuple[str | None, str | None]) -> None:
    """Register a rule over given texts, dealt to the customers by number, whose results the SQL states one by one.

    {k} stands for the customer's number, {4} and {2} for its last digits.
    """
    n = len(cases)
    quoted = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'"
    want = " ".join(f"WHEN {i} THEN {quoted(w)}" for i, (_, w) in enumerate(cases))
    digits = {"{k}": "CAST(c_custkey AS VARCHAR)", "{4}": "lpad(CAST(c_custkey%10000 AS VARCHAR),4,'0')", "{2}": "lpad(CAST(c_custkey%100 AS VARCHAR),2,'0')"}
    sql = f"CASE c_custkey%{n} {want} END"
    for mark, number in digits.items():
        sql = f"replace({sql}, '{mark}', {number})"

    def run(spark, sf_dir):
        k = F.col("c_custkey")  # not above: without a session there are no columns
        given = F.lit(None).cast("string")
        for i, (x, _) in enumerate(cases):
            given = F.when(k % n == i, F.lit(x).cast("string")).otherwise(given)
        for mark, number in {"{k}": k.cast("string"), "{4}": F.lpad((k % 10000).cast("string"), 4, "0"), "{2}": F.lpad((k % 100).cast("string"), 2, "0")}.items():
            given = F.replace(given, F.lit(mark), number)
        return spark.read.parquet(f"{sf_dir}/customer.parquet").select(k.alias("k"), rule(given).alias("value"))

    base_query(name, sql=f"SELECT c_custkey AS k, {sql} AS value FROM customer")(run)


told(
    "s2_try_normalize_id", lambda c: F.concat(F.coalesce(S.normalize_id(c, "W"), F.lit("-")), F.when(S.bad_id(c, "W"), " bad").otherwise("")),
    ("W{k}", "W{k}"), ("https://openalex.org/W{k}", "W{k}"), (" HTTPS://OpenAlex.org/W{k}\t", "W{k}"), ("\u00a0W{k}\n", "W{k}"), (None, "-"), ("", "-"), (" \t", "-"), ("w{k}", "- bad"), ("W", "- bad"),
    ("W{k}.0", "- bad"), ("A{k}", "- bad"), ("https://openalex.org/", "- bad"), ("http://openalex.org/W{k}", "- bad"), ("W\uff11", "- bad"), ("W{k} W1", "- bad"),
)
told(
    "s3_normalize_keyword", S.normalize_keyword, ("keywords/a-{k}", "keywords/a-{k}"), ("https://openalex.org/keywords/b_{k}", "keywords/b_{k}"), ("HTTPS://OPENALEX.ORG/keywords/C{k}", "keywords/C{k}"),
    (" keywords/{k}\n", "keywords/{k}"), ("keywords/-{k}", None), ("keywords/", None), ("keyword/a", None), ("Keywords/a", None), ("keywords/a b", None), ("keywords/\u00e9", None), ("", None), (None, None),
)
told(
    "s4_work_url", lambda c: S.entity_url(S.normalize_id(c, "W")), ("W{k}", "https://openalex.org/W{k}"), ("https://openalex.org/W{k}", "https://openalex.org/W{k}"), (" HTTPS://OPENALEX.ORG/W{k} ", "https://openalex.org/W{k}"), ("A{k}", None), ("", None), (None, None),
)
told(
    "s6_normalize_orcid", S.normalize_orcid, ("https://orcid.org/0000-0001-{4}-123x", "0000-0001-{4}-123X"), ("HTTP://ORCID.ORG/0000-0001-{4}-1234", "0000-0001-{4}-1234"), (" 0000-0001-{4}-1234\t", "0000-0001-{4}-1234"),
    ("0000-0001-{4}-12345", None), ("0000 0001 {4} 1234", None), ("00000001{4}1234", None), ("0000-0001-{4}-X234", None), ("https://www.orcid.org/0000-0001-{4}-1234", None), ("https://orcid.org/", None), ("", None), (None, None),
)
told(
    "s7_normalize_ror", S.normalize_ror, ("https://ror.org/0ABCDEF{2}", "0abcdef{2}"), ("HTTPS://ROR.ORG/0a1b2c3{2}", "0a1b2c3{2}"), (" 0a1b2c3{2}\n", "0a1b2c3{2}"), ("http://ror.org/0abcdef{2}", None), ("1abcdef{2}", None), ("0abcde{2}", None),
    ("0abcdefg{2}", None), ("0abc-ef{2}", None), ("0abcdef{2}/", None), ("", None), (None, None),
)
told(
    "s8_normalize_issn", S.normalize_issn, ("{4}-123x", "{4}-123X"), ("\t{4}-1234 ", "{4}-1234"), ("{4} - 1234", "{4}-1234"), ("{4}1234", None), ("{4}-12345", None), ("{4}-X234", None), ("9{4}-1234", None), ("{4}\u20131234", None), ("", None), (None, None),
)
told("s10_optional_text", S.optional_text, ("a{k}", "a{k}"), ("\t a {k}\n", "a {k}"), ("\u00a0b\u2003", "b"), (" a  b ", "a  b"), ("\u3000", None), (" ", None), ("", None), (None, None))


@base_query("s12_safe_divide", sql="SELECT c_custkey AS k, CASE c_custkey%6 WHEN 2 THEN CAST(c_custkey AS DOUBLE)/-2 WHEN 3 THEN 0.0 WHEN 5 THEN 1.0715086071862673e301 END AS value FROM customer")
def s12(spark, sf_dir):
    """A divisor of 0, a NULL on either side, a negative divisor, 0 over a number, a very small divisor."""
    k, none = F.col("c_custkey"), F.lit(None).cast("double")
    a = F.when(k % 6 == 3, F.lit(0.0)).when(k % 6 == 4, none).when(k % 6 == 5, F.lit(1.0)).otherwise(k.cast("double"))
    b = F.when(k % 6 == 0, F.lit(0.0)).when(k % 6 == 1, none).when(k % 6 == 2, F.lit(-2.0)).when(k % 6 == 5, F.lit(2.0**-1000)).otherwise(F.lit(4.0))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(k.alias("k"), S.safe_divide(a, b).alias("value"))


@base_query("s15_float32_rounding", sql="SELECT c_custkey AS k, CASE c_custkey%6 WHEN 0 THEN 0.10000000149011612::DOUBLE WHEN 1 THEN 16777216::DOUBLE WHEN 2 THEN 0::DOUBLE WHEN 3 THEN -0.30000001192092896::DOUBLE WHEN 4 THEN CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE) END AS value FROM customer")
def s15(spark, sf_dir):
    """Numbers between two narrow ones, beyond 24 bits, below the smallest, and NULL."""
    k = F.col("c_custkey")
    given = F.when(k % 6 == 0, F.lit(0.1)).when(k % 6 == 1, F.lit(16777217.0)).when(k % 6 == 2, F.lit(1e-46)).when(k % 6 == 3, F.lit(-0.3)).when(k % 6 == 4, F.col("c_acctbal").cast("double"))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(k.alias("k"), S.float32(given).alias("value"))


@base_query("s11_typed_optional", sql="SELECT CASE c_custkey%5 WHEN 0 THEN NULL WHEN 1 THEN 'cited_by_count' WHEN 2 THEN 'title' WHEN 3 THEN NULL ELSE 'open_access.is_oa' END AS error, count(*) AS n FROM customer WHERE c_custkey%5 NOT IN (0,3) GROUP BY 1")
def s11(spark, sf_dir):
    k = F.col("c_custkey")
    id_ = F.concat(F.lit('"id":"W'), k.cast("string"), F.lit('"'))
    wrong = F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.lit(',"cited_by_count":"7"')).when(k % 5 == 2, F.lit(',"title":7')).when(k % 5 == 3, F.lit(',"cited_by_count":7,"title":null,"open_access":{"is_oa":true}')).otherwise(F.lit(',"open_access":{"is_oa":1}'))
    arrays = F.lit("".join(f',"{a}":[]' for a in mapping.ARRAYS))
    raw = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.concat(F.lit("{"), id_, wrong, arrays, F.lit("}")).alias("raw"))
    return mapping.broken_rules(mapping.parse_works(raw)).groupBy("error").agg(F.count("*").alias("n"))


@query("s13_empty_array", "works", "work_topics", sql="SELECT w.work_id, count(DISTINCT topic_id) AS n FROM works w LEFT JOIN work_topics t ON t.work_id=w.work_id GROUP BY 1")
def s13(t):
    sets = t["work_topics"].groupBy("work_id").agg(F.collect_set("topic_id").alias("topics"))
    return t["works"].join(sets, "work_id", "left").select("work_id", F.size(S.empty_if_null(F.col("topics"))).cast("long").alias("n"))


@base_query("s16_ms_timestamp", sql="SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.')||lpad(CAST((epoch_us(ts)//1000)%1000 AS VARCHAR),3,'0')||'Z' AS told FROM events")
def s16(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", S.millis_text(F.col("ts").cast("timestamp")).alias("told"))


# --- filters -----------------------------------------------------------------------------------------------------

FACETS = {
    "f5_facet_publisher": ({"publisher_id": "P3"}, "primary_publisher_id='P3'"),
    "f5_facet_source": ({"source_id": "S7"}, "primary_source_id='S7'"),
    "f5_facet_type": ({"work_type": "book"}, "work_type='book'"),
    "f5_facet_language": ({"language": "fr"}, "language='fr'"),
    "f5_facet_oa_status": ({"oa_status": "green"}, "oa_status='green'"),
    "f6_facet_topic": ({"topic_id": "TBrand#12"}, "list_contains(string_split(topic_ids,'|'), 'TBrand#12')"),
    "f6_facet_institution": ({"institution_id": "I3"}, "list_contains(string_split(institution_ids,'|'), 'I3')"),
    "f6_facet_author": ({"author_id": "A5"}, "list_contains(string_split(author_ids,'|'), 'A5')"),
}
for _name, (_facet, _where) in FACETS.items():
    query(_name, *ALL, sql=DISCOVERY + f" SELECT * FROM discovery WHERE {_where} ORDER BY work_id LIMIT 201")(
        lambda t, facet=_facet: _plain(lookups.search_research(gold.research_discovery(t), limit=200, **facet)).select(*gold.DISCOVERY, LIST("author_ids"), LIST("topic_ids"), LIST("institution_ids"))
    )
query("f7_point_lookup_by_id", "works", sql="SELECT work_id, title FROM works WHERE work_id='W1001' AND activity_state='ACTIVE'")(lambda t: lookups.work_id_lookup(t, "W1001").select("work_id", "title"))
query("f8_point_lookup_by_doi", "works", sql="SELECT work_id, doi FROM works WHERE doi='10.5555/1003' AND activity_state='ACTIVE' ORDER BY 1 LIMIT 1")(lambda t: lookups.doi_work_lookup(t, "10.5555/1003").select("work_id", "doi"))


# --- joins -------------------------------------------------------------------------------------------------------

query("j1_inner", "works", "work_topics", sql="SELECT w.work_id, topic_id FROM works w JOIN work_topics t ON t.work_id=w.work_id WHERE activity_state='ACTIVE'")(lambda t: gold.active_works(t["works"]).select("work_id").join(t["work_topics"], "work_id"))
part_of("j2_left_outer_absent", "g9_citation_edges", "source_work_id", "reference_index", "target_activity_state")
query("j3_self_join", "works", "work_references", sql="SELECT s.publication_year AS source_year, t.publication_year AS target_year, count(*) AS n FROM works s JOIN work_references r ON r.work_id=s.work_id JOIN works t ON t.work_id=r.referenced_work_id GROUP BY ALL")(
    lambda t: t["works"]
    .select("work_id", F.col("publication_year").alias("source_year"))
    .join(t["work_references"].where("referenced_work_id IS NOT NULL"), "work_id")
    .join(t["works"].select(F.col("work_id").alias("referenced_work_id"), F.col("publication_year").alias("target_year")), "referenced_work_id")
    .groupBy("source_year", "target_year")
    .agg(F.count("*").alias("n"))
)
query("j4_left_anti", "works", "work_keywords", sql="SELECT work_id, keyword_id FROM work_keywords WHERE work_id NOT IN (SELECT work_id FROM works)")(lambda t: t["work_keywords"].join(t["works"].select("work_id"), "work_id", "left_anti"))
part_of("j6_distinct_then_join", "g2_journal_author_stats", "source_id", "unique_author_count")
part_of("j7_independent_aggregates", "g1_research_discovery", "work_id", "author_ids", "topic_ids")
query("j8_cross_join_of_totals", "works", "work_topics", sql="SELECT (SELECT count(*) FROM works WHERE activity_state='ACTIVE') AS works, (SELECT count(*) FROM work_topics) AS topics")(lambda t: gold.active_works(t["works"]).agg(F.count("*").alias("works")).crossJoin(t["work_topics"].agg(F.count("*").alias("topics"))))  # one row each
part_of("j9_literal_list", "dq14_reference_reconciliation", "category", "reference_count")
query("j10_staging_against_target", "target", "staging", sql="SELECT s.work_id, t.work_id IS NULL AS unknown FROM staging s LEFT JOIN target t ON t.work_id=s.work_id")(lambda t: versions.publication_decisions(t["staging"], t["target"]).select("work_id", (F.col("publication_decision") == "INSERT").alias("unknown")))
part_of("j13_compare_by_id", "fid2_value_fidelity", "field", "exact", "mismatch")


# --- aggregates --------------------------------------------------------------------------------------------------

part_of("agg1_count_with_null_key", "g7_publication_trends", "publication_year", "work_count")
part_of("agg2_count_distinct", "g5_publisher_topic_license_year_stats", "publisher_id", "topic_id", "primary_location_license", "publication_year", "active_work_count")
query("agg3_sorted_distinct_array", "work_authors", sql="SELECT work_id, coalesce(string_agg(DISTINCT author_id, '|' ORDER BY author_id), '') AS author_ids FROM work_authors GROUP BY 1")(lambda t: t["work_authors"].groupBy("work_id").agg(F.array_join(S.sorted_set(F.col("author_id")), "|").alias("author_ids")))
part_of("agg4_conditional_count", "dq9_missing_title", "observed", "denominator")
query("agg5_duplicate_keys", "work_authors", sql="SELECT count(*) AS observed FROM (SELECT work_id FROM work_authors GROUP BY 1 HAVING count(*)>1)")(lambda t: quality.work_id_unique({"works": t["work_authors"]}).select(F.col("observed").cast("long").alias("observed")))
query("agg6_aggregate_of_nothing", *ALL, sql="SELECT 'S-none' AS source_id, 0 AS unique_author_count FROM (SELECT count(*) FROM works)")(lambda t: lookups.unique_authors_per_journal(t, "S-none"))
query("agg7_category_count", "work_references", sql="SELECT count(*) FILTER (reference_status='MISSING') AS missing, count(*) FILTER (reference_status='MALFORMED') AS malformed, count(*) FILTER (reference_status='RESOLVED_ID') AS resolved_id, count(*) AS total FROM work_references")(lambda t: aggregates.outcome_counters(t["work_references"], "reference_status", ["MISSING", "MALFORMED", "RESOLVED_ID"]))
query("agg8_excess_duplicates", "work_topics", sql="SELECT count(*) FILTER (topic_id='TBrand#12') AS excess FROM work_topics")(
    lambda t: quality.manifest_coverage(t["work_topics"].select(F.when(F.col("topic_id") == "TBrand#12", "citation_edges").alias("mart_id")).where("mart_id IS NOT NULL").unionByName(gold.mart_manifest(t["work_topics"].sparkSession))).select(F.col("duplicate_manifest_mart_count").alias("excess"))
)


# --- deletions, order, sets, windows ------------------------------------------------------------------------------

query("del6_no_silent_restore", "target", "staging", sql="SELECT s.work_id FROM staging s JOIN target t ON t.work_id=s.work_id WHERE t.activity_state='DELETED' AND s.activity_state='ACTIVE' AND s.source_checksum_sha256<>t.source_checksum_sha256")(lambda t: versions.rejected(versions.publication_decisions(t["staging"], t["target"])).where("publication_decision = 'RESTORE_REQUIRED'").select("work_id"))
query("prf7_manifest_summary", "assets", sql="SELECT entity, count(*) AS files, CAST(sum(record_count) AS BIGINT) AS records, CAST(sum(byte_size) AS BIGINT) AS bytes, CAST(min(updated_date) AS VARCHAR) AS first_date, CAST(max(updated_date) AS VARCHAR) AS last_date, count(DISTINCT updated_date) AS partitions FROM assets GROUP BY 1")(
    lambda t: _plain(aggregates.manifest_summary(t["assets"]))
)
PICK_SQL = """WITH m AS (SELECT *, entity='works' AND format IN ('jsonl','parquet') AND byte_size BETWEEN 0 AND 150000 AS fits FROM assets),
p AS (SELECT file_uri, byte_size, record_count FROM m WHERE fits ORDER BY byte_size, updated_date IS NOT NULL, updated_date, file_uri LIMIT 1)
SELECT count(*) AS listed, count(*) FILTER (fits) AS eligible, count(*) FILTER (byte_size>150000) AS oversized, count(*) FILTER (byte_size IS NULL) AS unknown_size, min(byte_size) AS size_min, quantile_disc(byte_size, 0.5) AS size_median_low, max(byte_size) AS size_max, count(DISTINCT updated_date) AS partitions,
CAST(min(updated_date) AS VARCHAR) AS first_date, CAST(max(updated_date) AS VARCHAR) AS last_date, (SELECT file_uri FROM p) AS picked_uri, (SELECT byte_size FROM p) AS picked_bytes, (SELECT record_count FROM p) AS picked_records FROM m"""
query("prf7_default_pick", "assets", sql=PICK_SQL)(lambda t: _plain(profiling.manifest_pick(t["assets"], 150_000)))
query("ord1_order_by_keys", "works", sql="SELECT publication_year, oa_status, count(*) AS work_count FROM works WHERE activity_state='ACTIVE' AND publication_year>=1997 GROUP BY ALL ORDER BY ALL")(lambda t: lookups.open_access_trends(t, 1997, None))
part_of("ord4_smallest_by_five_keys", "pub2_asset_selection", "asset_id", "file_uri", "reason")
query("ord5_first_of_each_key", "work_topics", "work_locations", sql="SELECT work_id, min(location_index) AS location_index FROM work_locations WHERE source_id IS NOT NULL GROUP BY 1")(lambda t: mapping._first(t["work_locations"].where("source_id IS NOT NULL"), ["work_id"], "location_index", ["location_index"]))
query("set1_union_all", "works", "target", sql="SELECT activity_state, count(*) AS n FROM (SELECT activity_state FROM works UNION ALL SELECT activity_state FROM target) GROUP BY 1")(lambda t: t["works"].select("activity_state").unionByName(t["target"].select("activity_state")).groupBy("activity_state").agg(F.count("*").alias("n")))
query("win1_latest_first", "ledger", "target", sql="""SELECT work_id, CAST(max(d) AS VARCHAR) AS d FROM (SELECT work_id, lineage_source_updated_date AS d FROM target UNION ALL SELECT work_id, deleted_date FROM ledger) WHERE d IS NOT NULL GROUP BY 1""")(
    lambda t: _plain(versions.latest_first(t["target"].select("work_id", F.col("lineage_source_updated_date").alias("d")).unionByName(t["ledger"].select("work_id", F.col("deleted_date").alias("d"))).where("d IS NOT NULL"), ["work_id"], [F.col("d").desc()]))
)


# --- checks and releases over inputs that break them ----------------------------------------------------------------

DQ5_SQL = BROKEN + """, c AS (SELECT count(*) AS n, count(*) FILTER (k=3) AS no_object FROM b), x AS (SELECT n AS observed, n AS expected FROM c UNION ALL SELECT n, n-no_object FROM c)
SELECT 'ingest.decode_balance' AS check_id, 'HARD_GATE' AS kind, CASE WHEN observed=expected THEN 'PASS' ELSE 'FAIL' END AS status, CAST(observed AS DOUBLE) AS observed, CAST(expected AS DOUBLE) AS expected FROM x"""


@query("dq5_balance_of_broken_records", *RELATIONS, sql=DQ5_SQL)
def dq5_broken(t):
    """Lines, mapped works and rejects of records of which some break a rule, each counted apart; once more with texts that are no object forgotten."""
    parsed = kept(mapping.parse_works(_broken(t)).withColumn("errors", mapping.record_errors()))
    mapped = mapping.works(parsed.where(F.size("errors") == 0).drop("errors")).agg(F.count("work_id").alias("mapped"))
    bad = F.size("errors") > 0
    sides = parsed.agg(F.count("*").alias("decoded"), F.count_if(bad).alias("every"), F.count_if(bad & ~F.array_contains("errors", "record")).alias("some"))
    counters = kept(sides.crossJoin(mapped))  # one row each
    found = [quality.decode_balance(counters.withColumnRenamed(c, "rejected")) for c in ("every", "some")]
    return found[0].unionByName(found[1]).select("check_id", "kind", "status", "observed", "expected")


DQ7_SQL = """WITH m AS (SELECT CASE CAST(substr(work_id,2) AS BIGINT)%10 WHEN 0 THEN 'citation_edges' WHEN 1 THEN NULL WHEN 2 THEN 'x'||language END AS id, CAST(substr(work_id,2) AS BIGINT)%10 AS k FROM works),
g AS (SELECT id, count(*) AS n FROM m WHERE k<3 GROUP BY 1), u AS (SELECT work_id FROM work_keywords UNION ALL SELECT work_id FROM work_references)
SELECT 1 AS missing_manifest_mart_count, (SELECT count(*) FROM g WHERE id LIKE 'x%') AS unexpected_manifest_mart_count, (SELECT CAST(sum(CASE WHEN id LIKE 'x%' THEN n-1 ELSE n END) AS BIGINT) FROM g WHERE id IS NOT NULL) AS duplicate_manifest_mart_count,
(SELECT CAST(sum(n) AS BIGINT) FROM g WHERE id IS NULL) AS invalid_manifest_mart_count, count(*) FILTER (w.work_id IS NULL) AS missing_source_work_count, count(*) FILTER (w.activity_state<>'ACTIVE') AS inactive_source_work_count FROM u LEFT JOIN works w ON w.work_id=u.work_id"""


@query("dq7_faulty_manifest_and_sources", "works", "work_keywords", "work_references", sql=DQ7_SQL)
def dq7_faulty(t):
    """A manifest with a mart missing and others repeated, unknown or NULL, and contributions of unknown and deleted works."""
    k = F.substring("work_id", 2, 20).cast("long") % 10
    listed = t["works"].where(k < 3).select(F.when(k == 0, "citation_edges").when(k == 2, F.concat(F.lit("x"), "language")).alias("mart_id"))
    manifest = gold.mart_manifest(t["works"].sparkSession).where("mart_id <> 'open_access_trends'").unionByName(listed)
    return quality.deleted_work_exclusion_counts(t, manifest, t["work_keywords"], t["work_references"].select(F.col("work_id").alias("source_work_id")))


REL5_SQL = """SELECT 'works' AS table_name, count(*) FILTER (work_id LIKE '%7' OR work_id LIKE '%3') AS only_released, count(*) FILTER (work_id LIKE '%3')+(SELECT count(*) FROM staging WHERE work_id NOT IN (SELECT work_id FROM target)) AS only_rebuilt FROM target"""


@query("rel5_builds_that_differ_on_both_sides", "target", "staging", sql=REL5_SQL)
def rel5_both(t):
    """A rebuild with some works lost, some changed, and the new ones of a batch."""
    changed = t["target"].where("work_id NOT LIKE '%7'").withColumn("payload", F.when(F.col("work_id").endswith("3"), F.col("payload") + 1).otherwise(F.col("payload")))
    new = t["staging"].join(t["target"].select("work_id"), "work_id", "left_anti").select(*[F.col(c).cast(k).alias(c) for c, k in t["target"].dtypes])
    return release.reconcile_release({"works": t["target"]}, {"works": changed.unionByName(new)})


REL6_SQL = """WITH i AS (SELECT file_uri AS asset, record_count AS n FROM assets) SELECT asset, 'lines' AS law FROM i WHERE n%4=0 UNION ALL SELECT asset, 'outcomes' FROM i WHERE n%6=0 OR n%11=0 UNION ALL SELECT asset, 'rows' FROM i WHERE n%10=0 OR n%13=0"""


@query("rel6_each_law_broken", "assets", sql=REL6_SQL)
def rel6_each(t):
    """Inputs that break one law, several, or have a NULL where a count is due."""
    n, off = F.col("record_count"), lambda by: (F.col("record_count") % by == 0).cast("long")
    facts = t["assets"].select(
        F.col("file_uri").alias("asset"), (n + 1 + off(4)).alias("lines"), n.alias("records"), F.lit(1).alias("rejected"), F.when(n % 11 != 0, n - off(6)).alias("outcomes"), (n + 2).alias("rows"),
        F.when(n % 13 != 0, n + off(10)).alias("unique_rows"), F.lit(2).alias("duplicates"),
    )
    return release.input_balance(facts)
