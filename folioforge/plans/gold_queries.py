"""Marts, query patterns, capabilities, joins, filters and sorts as registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge.operators import aggregates, gold, lookups
from folioforge.plans.registry import ORACLES, QUERIES, query

ALL = ("works", "work_authors", "work_topics", "work_author_institutions", "work_locations", "work_references")
LIST = lambda c: F.array_join(c, "|").alias(c)

G1_SQL = """WITH a AS (SELECT * FROM works WHERE activity_state='ACTIVE'),
 aa AS (SELECT work_id, string_agg(DISTINCT author_id, '|' ORDER BY author_id) AS s FROM work_authors GROUP BY 1),
 ta AS (SELECT work_id, string_agg(DISTINCT topic_id, '|' ORDER BY topic_id) AS s FROM work_topics GROUP BY 1),
 ia AS (SELECT work_id, string_agg(DISTINCT institution_id, '|' ORDER BY institution_id) AS s FROM work_author_institutions GROUP BY 1)
SELECT a.work_id, doi, title, publication_year, CAST(publication_date AS VARCHAR) AS publication_date, work_type, language, is_oa, oa_status, primary_source_id, primary_publisher_id,
 coalesce(aa.s,'') AS author_ids, coalesce(ta.s,'') AS topic_ids, coalesce(ia.s,'') AS institution_ids
 FROM a LEFT JOIN aa USING (work_id) LEFT JOIN ta USING (work_id) LEFT JOIN ia USING (work_id)"""  # fmt: skip


@query("g1_research_discovery", *ALL, sql=G1_SQL)
def g1(t):
    out = gold.research_discovery(t).withColumn("publication_date", F.col("publication_date").cast("string"))
    return out.select(*gold.DISCOVERY, LIST("author_ids"), LIST("topic_ids"), LIST("institution_ids"))


query("g2_journal_author_stats", *ALL, sql="""WITH sw AS (SELECT DISTINCT source_id, l.work_id FROM work_locations l JOIN works w ON w.work_id=l.work_id WHERE activity_state='ACTIVE' AND source_id IS NOT NULL)
SELECT source_id, count(DISTINCT author_id) AS unique_author_count, count(DISTINCT sw.work_id) AS active_work_count FROM sw LEFT JOIN work_authors a ON a.work_id=sw.work_id GROUP BY 1""")(gold.journal_author_stats)  # fmt: skip
query("g3_publisher_author_stats", *ALL, sql="""SELECT primary_publisher_id AS publisher_id, count(DISTINCT author_id) AS unique_author_count, count(DISTINCT w.work_id) AS active_work_count
FROM works w LEFT JOIN work_authors a ON a.work_id=w.work_id WHERE activity_state='ACTIVE' AND primary_publisher_id IS NOT NULL GROUP BY 1""")(gold.publisher_author_stats)  # fmt: skip
query("g4_publisher_topic_year_stats", *ALL, sql="""SELECT primary_publisher_id AS publisher_id, topic_id, publication_year, count(DISTINCT w.work_id) AS active_work_count
FROM works w JOIN work_topics t ON t.work_id=w.work_id WHERE activity_state='ACTIVE' AND primary_publisher_id IS NOT NULL AND topic_id IS NOT NULL GROUP BY ALL""")(gold.publisher_topic_year_stats)  # fmt: skip
query("g5_publisher_topic_license_year_stats", *ALL, sql="""SELECT primary_publisher_id AS publisher_id, topic_id, license AS primary_location_license, publication_year, count(DISTINCT w.work_id) AS active_work_count
FROM works w JOIN work_topics t ON t.work_id=w.work_id LEFT JOIN (SELECT work_id, license FROM work_locations WHERE is_primary) l ON l.work_id=w.work_id
WHERE activity_state='ACTIVE' AND primary_publisher_id IS NOT NULL AND topic_id IS NOT NULL GROUP BY ALL""")(gold.publisher_topic_license_year_stats)  # fmt: skip
query("g6_institution_topic_stats", *ALL, sql="""SELECT institution_id, topic_id, count(DISTINCT w.work_id) AS active_work_count FROM work_author_institutions i JOIN works w ON w.work_id=i.work_id JOIN work_topics t ON t.work_id=w.work_id
WHERE activity_state='ACTIVE' AND institution_id IS NOT NULL AND topic_id IS NOT NULL GROUP BY ALL""")(gold.institution_topic_stats)  # fmt: skip
query("g7_publication_trends", "works", sql="SELECT publication_year, count(*) AS work_count FROM works WHERE activity_state='ACTIVE' GROUP BY 1")(gold.publication_trends)
query("g8_open_access_trends", "works", sql="SELECT publication_year, oa_status, count(*) AS work_count FROM works WHERE activity_state='ACTIVE' GROUP BY ALL")(gold.open_access_trends)
EDGES = "SELECT r.work_id AS source_work_id, reference_index, referenced_work_id, reference_status, t.activity_state AS target_activity_state FROM work_references r JOIN works s ON s.work_id=r.work_id LEFT JOIN works t ON t.work_id=r.referenced_work_id WHERE s.activity_state='ACTIVE'"
query("g9_citation_edges", "works", "work_references", sql=EDGES)(gold.citation_edges)


@query("g10_staged_manifest", "works", sql="SELECT unnest(['research_discovery','journal_author_stats','publisher_author_stats','publisher_topic_year_stats','publisher_topic_license_year_stats','institution_topic_stats','publication_trends','open_access_trends','citation_edges']) AS mart_id, (SELECT count(*) FROM works WHERE activity_state='ACTIVE') AS active_work_count")
def g10(t):
    return gold.mart_manifest(t["works"].sparkSession).crossJoin(gold.active_works(t["works"]).agg(F.count("*").alias("active_work_count")))


CONTRIBUTIONS = """WITH a AS (SELECT work_id, primary_publisher_id AS p FROM works WHERE activity_state='ACTIVE'),
 x AS (SELECT DISTINCT work_id FROM work_topics WHERE topic_id IS NOT NULL),
 contributions AS (SELECT 'research_discovery' AS mart_id, work_id FROM a UNION ALL SELECT 'publication_trends', work_id FROM a UNION ALL SELECT 'open_access_trends', work_id FROM a
 UNION ALL SELECT 'journal_author_stats', work_id FROM a WHERE work_id IN (SELECT work_id FROM work_locations WHERE source_id IS NOT NULL)
 UNION ALL SELECT 'publisher_author_stats', work_id FROM a WHERE p IS NOT NULL
 UNION ALL SELECT 'publisher_topic_year_stats', work_id FROM a WHERE p IS NOT NULL AND work_id IN (FROM x)
 UNION ALL SELECT 'publisher_topic_license_year_stats', work_id FROM a WHERE p IS NOT NULL AND work_id IN (FROM x)
 UNION ALL SELECT 'institution_topic_stats', work_id FROM a WHERE work_id IN (SELECT work_id FROM work_author_institutions WHERE institution_id IS NOT NULL) AND work_id IN (FROM x)
 UNION ALL SELECT 'citation_edges', work_id FROM a WHERE work_id IN (SELECT work_id FROM work_references))"""  # fmt: skip
query("g11_staged_contributions", *ALL, sql=CONTRIBUTIONS + " SELECT * FROM contributions")(gold.work_contributions)
query("g12_staged_citation_edges", "works", "work_references", sql=f"SELECT source_work_id, reference_index, referenced_work_id AS target_work_id, target_activity_state FROM ({EDGES})")(gold.staged_citation_edges)


@query("g13_build_all_counts", *ALL)
def g13(t):
    return gold.row_counts(gold.build_all(t))


_MART_QUERIES = {name.partition("_")[2]: name for name in list(QUERIES) if name.partition("_")[2] in gold.MARTS}
ORACLES["g13_build_all_counts"] = " UNION ALL ".join(f"SELECT '{mart}' AS mart_id, count(*) AS row_count FROM ({ORACLES[name]})" for mart, name in _MART_QUERIES.items())


# --- query patterns ----------------------------------------------------------------------------------------------

Q12 = "work_id, work_id_url, doi, title, publication_year, CAST(publication_date AS VARCHAR) AS publication_date, work_type, language, cited_by_count, is_oa, oa_status, primary_source_id, primary_publisher_id, activity_state, source_checksum_sha256, CAST(lineage_source_updated_date AS VARCHAR) AS lineage_source_updated_date"


def _plain(df):
    return df.select(*[F.col(c).cast("string").alias(c) if k == "date" else F.col(c) for c, k in df.dtypes])


@query("q1_doi_work_lookup", "works", sql=f"SELECT {Q12} FROM works WHERE activity_state='ACTIVE' AND doi='10.5555/1003' ORDER BY work_id LIMIT 1")
def q1(t):
    return _plain(lookups.doi_work_lookup(t, "10.5555/1003"))


@query("q2_work_id_lookup", "works", sql=f"SELECT {Q12} FROM works WHERE activity_state='ACTIVE' AND work_id='W1001' LIMIT 1")
def q2(t):
    return _plain(lookups.work_id_lookup(t, "W1001"))


@query("q3_publisher_lookup", "publishers", sql="SELECT * FROM publishers WHERE publisher_id='P6' LIMIT 1")
def q3(t):
    return lookups.publisher_lookup(t, "P6")


@query("q4_unique_authors_per_journal", *ALL, sql="SELECT 'S7' AS source_id, count(DISTINCT author_id) AS unique_author_count FROM work_authors WHERE work_id IN (SELECT l.work_id FROM work_locations l JOIN works w ON w.work_id=l.work_id WHERE activity_state='ACTIVE' AND source_id='S7')")
def q4(t):
    return lookups.unique_authors_per_journal(t, "S7")


@query("q5_unique_authors_per_publisher", *ALL, sql="SELECT 'P3' AS publisher_id, count(DISTINCT author_id) AS unique_author_count FROM work_authors WHERE work_id IN (SELECT work_id FROM works WHERE activity_state='ACTIVE' AND primary_publisher_id='P3')")
def q5(t):
    return lookups.unique_authors_per_publisher(t, "P3")


@query("q6_publisher_topic_counts", *ALL, sql="SELECT 'P3' AS publisher_id, topic_id, count(DISTINCT w.work_id) AS work_count FROM works w JOIN work_topics t ON t.work_id=w.work_id WHERE activity_state='ACTIVE' AND primary_publisher_id='P3' GROUP BY topic_id")
def q6(t):
    return lookups.publisher_topic_counts(t, "P3")


Q7_SQL = """SELECT primary_publisher_id AS publisher_id, topic_id, license AS primary_location_license, publication_year, count(DISTINCT w.work_id) AS work_count FROM works w JOIN work_topics t ON t.work_id=w.work_id
LEFT JOIN (SELECT work_id, license FROM work_locations WHERE is_primary) l ON l.work_id=w.work_id WHERE activity_state='ACTIVE' {} GROUP BY ALL"""  # fmt: skip
query("q7_publisher_topic_license_year", *ALL, sql=Q7_SQL.format(""))(lookups.publisher_topic_license_year)


@query("q7_publisher_topic_license_year_bounded", *ALL, sql=Q7_SQL.format("AND primary_publisher_id='P3' AND publication_year>=1996 AND publication_year<=1998"))
def q7(t):
    return lookups.publisher_topic_license_year(t, "P3", 1996, 1998)


@query("q8_institution_topic_relationships", *ALL, sql="SELECT 'I3' AS institution_id, topic_id, count(DISTINCT w.work_id) AS work_count FROM work_author_institutions i JOIN works w ON w.work_id=i.work_id JOIN work_topics t ON t.work_id=w.work_id WHERE activity_state='ACTIVE' AND institution_id='I3' GROUP BY topic_id")
def q8(t):
    return lookups.institution_topic_relationships(t, "I3")


@query("q9_citation_relationships", "works", "work_references", sql=EDGES + " AND r.work_id='W1001' ORDER BY reference_index")
def q9(t):
    return lookups.citation_relationships(t, "W1001")


@query("q10_publication_trends", "works", sql="SELECT publication_year, count(*) AS work_count FROM works WHERE activity_state='ACTIVE' AND publication_year>=1996 AND publication_year<=1999 GROUP BY 1 ORDER BY 1")
def q10(t):
    return lookups.publication_trends(t, 1996, 1999)


@query("q11_open_access_trends", "works", sql="SELECT publication_year, oa_status, count(*) AS work_count FROM works WHERE activity_state='ACTIVE' AND publication_year<=1998 GROUP BY ALL ORDER BY ALL")
def q11(t):
    return lookups.open_access_trends(t, None, 1998)


# --- capabilities ------------------------------------------------------------------------------------------------

DISCOVERY = G1_SQL.replace("\nSELECT a.work_id", ",\n discovery AS (SELECT a.work_id") + ")"


def _told(df):
    return _plain(df).select(*gold.DISCOVERY, LIST("author_ids"), LIST("topic_ids"), LIST("institution_ids"))


@query("c1_get_work", *ALL, sql=DISCOVERY + " SELECT * FROM discovery WHERE doi='10.5555/1003' ORDER BY work_id LIMIT 1")
def c1(t):
    return _told(lookups.get_work(gold.research_discovery(t), doi=" 10.5555/1003 "))


@query("c2_search_research", *ALL, sql=DISCOVERY + " SELECT * FROM discovery WHERE primary_publisher_id='P3' AND language='en' AND publication_year BETWEEN 1996 AND 2000 AND list_contains(string_split(topic_ids,'|'), 'TBrand#12') AND work_id > 'W1' ORDER BY work_id LIMIT 51")
def c2(t):
    return _told(lookups.search_research(gold.research_discovery(t), publisher_id="P3", language="en", year_from=1996, year_to=2000, topic_id="TBrand#12", after="W1"))


@query("c3_journal_metrics", *ALL, sql="""WITH sw AS (SELECT DISTINCT source_id, l.work_id FROM work_locations l JOIN works w ON w.work_id=l.work_id WHERE activity_state='ACTIVE' AND source_id='S9')
SELECT source_id, count(DISTINCT author_id) AS unique_author_count, count(DISTINCT sw.work_id) AS active_work_count FROM sw LEFT JOIN work_authors a ON a.work_id=sw.work_id GROUP BY 1""")  # fmt: skip
def c3(t):
    return lookups.journal_metrics(gold.journal_author_stats(t), "S9")


@query("c4_publisher_summary", *ALL, sql="""SELECT primary_publisher_id AS publisher_id, count(DISTINCT author_id) AS unique_author_count, count(DISTINCT w.work_id) AS active_work_count
FROM works w LEFT JOIN work_authors a ON a.work_id=w.work_id WHERE activity_state='ACTIVE' AND primary_publisher_id='P3' GROUP BY 1""")  # fmt: skip
def c4(t):
    return lookups.publisher_summary(gold.publisher_author_stats(t), "P3")


@query("c5_publisher_topic_analytics", *ALL, sql="""SELECT primary_publisher_id AS publisher_id, topic_id, publication_year, count(DISTINCT w.work_id) AS active_work_count FROM works w JOIN work_topics t ON t.work_id=w.work_id
WHERE activity_state='ACTIVE' AND primary_publisher_id='P3' AND topic_id IS NOT NULL AND (publication_year>2000 OR (publication_year=2000 AND topic_id>'TBrand#13') OR publication_year IS NULL) GROUP BY ALL ORDER BY publication_year NULLS LAST, topic_id LIMIT 51""")  # fmt: skip
def c5(t):
    return lookups.publisher_topic_analytics(gold.publisher_topic_year_stats(t), "P3", after=(2000, "TBrand#13"))


@query("c6_freshness", "works", sql="SELECT CASE WHEN count(*)>0 THEN 'AVAILABLE' ELSE 'EMPTY' END AS status, CAST(max(lineage_source_updated_date) AS VARCHAR) AS source_max_date FROM works")
def c6(t):
    return _plain(lookups.freshness(t["works"].withColumn("run_id", F.lit("r"))).drop("run_id"))


# --- filters, joins, sorts, sets ----------------------------------------------------------------------------------

query("f1_active_works", "works", sql=f"SELECT {Q12} FROM works WHERE activity_state='ACTIVE'")(lambda t: _plain(gold.active_works(t["works"])).select(*[c.split(" AS ")[-1].strip() for c in Q12.split(", ")]))
query("f2_deleted_works", "works", sql="SELECT work_id, activity_state FROM works WHERE activity_state='DELETED'")(lambda t: gold.deleted_works(t["works"]).select("work_id", "activity_state"))
query("f3_year_range", "works", sql="SELECT work_id, publication_year FROM works WHERE publication_year>=1997")(lambda t: lookups.years_between(t["works"], 1997, None).select("work_id", "publication_year"))
query("f4_unbounded_years", "works", sql="SELECT publication_year IS NULL AS undated, count(*) AS n FROM works GROUP BY 1")(lambda t: lookups.years_between(t["works"], None, None).groupBy(F.col("publication_year").isNull().alias("undated")).agg(F.count("*").alias("n")))
query("f9_domain_checks", "works", sql="SELECT work_id FROM works WHERE activity_state NOT IN ('ACTIVE','DELETED') OR oa_status IS NULL OR oa_status NOT IN ('gold','green','hybrid')")(lambda t: t["works"].where(~F.col("activity_state").isin("ACTIVE", "DELETED") | F.col("oa_status").isNull() | ~F.col("oa_status").isin("gold", "green", "hybrid")).select("work_id"))
query("j5_left_semi", "works", "work_topics", sql="SELECT work_id, topic_id FROM work_topics WHERE work_id IN (SELECT work_id FROM works WHERE activity_state='DELETED')")(lambda t: t["work_topics"].join(gold.deleted_works(t["works"]).select("work_id"), "work_id", "left_semi"))
query("j14_fanout_audit", *ALL, sql="""WITH u AS (SELECT w.work_id, count(*) AS unsafe_rows, count(DISTINCT author_id) AS author_count, count(DISTINCT topic_id) AS topic_count FROM works w JOIN work_authors a ON a.work_id=w.work_id JOIN work_topics t ON t.work_id=w.work_id WHERE activity_state='ACTIVE' GROUP BY 1)
SELECT * FROM u""")(aggregates.fanout_audit)  # fmt: skip
query("agg9_publisher_topic_rollup", *ALL, sql="SELECT primary_publisher_id AS publisher_id, topic_id, CAST(count(DISTINCT w.work_id) AS BIGINT) AS active_work_count FROM works w JOIN work_topics t ON t.work_id=w.work_id WHERE activity_state='ACTIVE' AND primary_publisher_id IS NOT NULL GROUP BY ALL")(lambda t: aggregates.publisher_topic_rollup(gold.publisher_topic_year_stats(t)))
query("agg14_state_counts", "works", "work_authors", "work_topics", "work_references", sql=" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) FILTER (activity_state='ACTIVE') AS active, count(*) FILTER (activity_state='DELETED') AS deleted FROM {'works' if n == 'works' else f'{n} r JOIN works w ON w.work_id=r.work_id'}" for n in ("works", "work_authors", "work_topics", "work_references")))(lambda t: aggregates.state_counts(t, ["work_authors", "work_topics", "work_references"]))
RELATIONS = ("authors", "funders", "institutions", "publishers", "sources", "topics", "work_author_institutions", "work_authors", "work_grants", "work_keywords", "work_locations", "work_mesh", "work_references", "work_topics")
query("agg15_table_counts", *RELATIONS, sql=" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in RELATIONS))(aggregates.table_counts)
query("agg17_topic_work_counts", "works", "work_topics", sql="SELECT topic_id, count(DISTINCT t.work_id) AS work_count FROM work_topics t JOIN works w ON w.work_id=t.work_id WHERE activity_state='ACTIVE' GROUP BY 1")(aggregates.topic_work_counts)
query("agg18_work_author_topic_counts", *ALL, sql="SELECT w.work_id, count(DISTINCT author_id) AS author_count, count(DISTINCT topic_id) AS topic_count FROM works w LEFT JOIN work_authors a ON a.work_id=w.work_id LEFT JOIN work_topics t ON t.work_id=w.work_id WHERE activity_state='ACTIVE' GROUP BY 1")(aggregates.work_author_topic_counts)
def _fingerprint_sql(table: str, columns: list[str]) -> str:
    told = ", ".join(f"{c} := {c}" for c in sorted(columns))
    digest = f"('0x' || substr(md5(CAST(to_json(struct_pack({told})) AS VARCHAR)), 1, 15))::BIGINT"
    return f"SELECT count(*) AS row_count, coalesce(bit_xor(h), 0) AS hash_xor, CAST(coalesce(sum(CAST(h AS HUGEINT)), 0) AS VARCHAR) AS hash_sum FROM (SELECT {digest} AS h FROM {table})"


WORK_FIELDS = ["work_id", "work_id_url", "doi", "title", "publication_year", "publication_date", "work_type", "language", "cited_by_count", "is_oa", "oa_status", "primary_source_id", "primary_publisher_id", "source_checksum_sha256", "lineage_source_updated_date", "activity_state"]
query("agg12_content_fingerprint", "works", sql=_fingerprint_sql("works", WORK_FIELDS))(lambda t: aggregates.fingerprint(t["works"]))
query("agg19_table_fingerprint", "work_topics", sql=_fingerprint_sql("work_topics", ["work_id", "topic_id"]))(lambda t: aggregates.fingerprint(t["work_topics"]))
query("ord2_nulls_last_page", "works", sql="SELECT work_id, publication_year FROM works WHERE publication_year IS NULL AND work_id>'W2' ORDER BY work_id LIMIT 101")(lambda t: lookups.keyset_page(t["works"].select("work_id", "publication_year"), ["publication_year", "work_id"], (None, "W2"), 100))
query("ord3_keyset_page", "works", sql="SELECT work_id, title FROM works WHERE work_id>'W3' ORDER BY work_id LIMIT 51")(lambda t: lookups.keyset_page(t["works"].select("work_id", "title"), ["work_id"], ("W3",)))
query("set2_id_difference", "works", "work_references", sql="SELECT DISTINCT referenced_work_id FROM work_references WHERE referenced_work_id IS NOT NULL EXCEPT SELECT work_id FROM works")(lambda t: t["work_references"].where("referenced_work_id IS NOT NULL").select("referenced_work_id").distinct().join(t["works"].select(F.col("work_id").alias("referenced_work_id")), "referenced_work_id", "left_anti"))


@query("set3_id_set_equality", "target", "staging", sql="SELECT count(*) FILTER (s.work_id IS NULL) AS only_left, count(*) FILTER (t.work_id IS NULL) AS only_right, count(*) FILTER (s.work_id IS NOT NULL AND t.work_id IS NOT NULL) AS both_sides FROM target t FULL JOIN staging s ON s.work_id=t.work_id")
def set3(t):
    left, right = t["target"].select("work_id", F.lit(1).alias("l")), t["staging"].select("work_id", F.lit(1).alias("r"))
    joined = left.join(right, "work_id", "full")
    return joined.agg(F.count_if(F.col("r").isNull()).alias("only_left"), F.count_if(F.col("l").isNull()).alias("only_right"), F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("both_sides"))
