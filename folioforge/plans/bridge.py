"""Bibliographic tables over the star schema: the same SQL text runs in Spark and in an oracle database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("customer", "supplier", "part", "orders", "lineitem", "nation", "region", "events", "documents", "conversations", "pages", "benchmark", "labels", "embeddings")

CTES: dict[str, str] = {
    "works": """SELECT 'W'||CAST(o.o_orderkey AS STRING) AS work_id,
  'https://openalex.org/W'||CAST(o.o_orderkey AS STRING) AS work_id_url,
  CASE WHEN o.o_orderkey%7=0 THEN NULL ELSE '10.5555/'||CAST(o.o_orderkey AS STRING) END AS doi,
  CASE WHEN o.o_orderkey%11=0 THEN NULL WHEN o.o_orderkey%13=0 THEN '' ELSE 'Title '||CAST(o.o_orderkey AS STRING) END AS title,
  CASE WHEN o.o_orderkey%17=0 THEN NULL ELSE CAST(year(o.o_orderdate) AS INT) END AS publication_year,
  CASE WHEN o.o_orderkey%17=0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS publication_date,
  CASE WHEN o.o_orderkey%19=0 THEN NULL WHEN o.o_orderkey%3=0 THEN 'book' ELSE 'article' END AS work_type,
  CASE WHEN o.o_orderkey%5=0 THEN 'fr' ELSE 'en' END AS language,
  CAST(floor(o.o_totalprice) AS BIGINT) AS cited_by_count,
  o.o_orderpriority IN ('1-URGENT','2-HIGH') AS is_oa,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'gold' WHEN '2-HIGH' THEN 'green' WHEN '3-MEDIUM' THEN 'closed'
       WHEN '4-NOT SPECIFIED' THEN 'hybrid' ELSE NULL END AS oa_status,
  CASE WHEN o.o_custkey%23=0 THEN NULL ELSE 'S'||CAST(o.o_custkey%50 AS STRING) END AS primary_source_id,
  CASE WHEN o.o_custkey%23=0 THEN NULL ELSE 'P'||CAST(c.c_nationkey AS STRING) END AS primary_publisher_id,
  'a'||CAST(o.o_orderkey AS STRING) AS source_checksum_sha256,
  CASE WHEN o.o_orderkey%37=0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS lineage_source_updated_date,
  CASE WHEN o.o_orderstatus='F' THEN 'DELETED' ELSE 'ACTIVE' END AS activity_state
  FROM orders o LEFT JOIN customer c ON c.c_custkey=o.o_custkey""",
    "line_keys": "SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem",
    "work_authors": """SELECT 'W'||CAST(l_orderkey AS STRING) AS work_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_suppkey,l_partkey)-1 AS INT) AS authorship_index,
  CASE WHEN l_suppkey%29=0 THEN NULL ELSE 'A'||CAST(l_suppkey AS STRING) END AS author_id FROM line_keys""",
    "work_topics": """SELECT DISTINCT 'W'||CAST(k.l_orderkey AS STRING) AS work_id, 'T'||p.p_brand AS topic_id
  FROM line_keys k JOIN part p ON p.p_partkey=k.l_partkey""",
    "work_author_institutions": """SELECT DISTINCT 'W'||CAST(k.l_orderkey AS STRING) AS work_id, k.l_linenumber AS authorship_index,
  CASE WHEN s.s_nationkey=0 THEN NULL ELSE 'I'||CAST(s.s_nationkey AS STRING) END AS institution_id
  FROM line_keys k JOIN supplier s ON s.s_suppkey=k.l_suppkey""",
    "work_locations": """SELECT 'W'||CAST(l_orderkey AS STRING) AS work_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_suppkey,l_partkey)-1 AS INT) AS location_index,
  CASE WHEN l_partkey%31=0 THEN NULL ELSE 'S'||CAST(l_partkey%50 AS STRING) END AS source_id,
  CASE l_partkey%3 WHEN 0 THEN 'cc-by' WHEN 1 THEN 'cc0' ELSE NULL END AS license,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_suppkey,l_partkey)=1 AS is_primary FROM line_keys""",
    "work_references": """SELECT 'W'||CAST(l_orderkey AS STRING) AS work_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_suppkey,l_partkey)-1 AS INT) AS reference_index,
  CASE WHEN l_partkey%10 IN (0,1) THEN NULL ELSE 'W'||CAST(l_partkey*8 AS STRING) END AS referenced_work_id,
  CASE l_partkey%10 WHEN 0 THEN 'MISSING' WHEN 1 THEN 'MALFORMED' ELSE 'RESOLVED_ID' END AS reference_status FROM line_keys""",
    "work_keywords": "SELECT DISTINCT 'W'||CAST(l_orderkey+CASE WHEN l_partkey%97=0 THEN 90000000 ELSE 0 END AS STRING) AS work_id, 'keywords/k'||CAST(l_partkey%40 AS STRING) AS keyword_id FROM line_keys",
    "work_mesh": "SELECT 'W'||CAST(l_orderkey AS STRING) AS work_id, l_linenumber AS mesh_index, 'D'||CAST(l_partkey%60 AS STRING) AS descriptor_ui FROM line_keys WHERE l_suppkey%4=0",
    "work_grants": "SELECT 'W'||CAST(l_orderkey AS STRING) AS work_id, l_linenumber AS grant_index, CASE WHEN l_suppkey%5=0 THEN NULL ELSE 'F'||CAST(l_suppkey%30 AS STRING) END AS funder_id FROM line_keys WHERE l_suppkey%3=0",
    "authors": "SELECT 'A'||CAST(s_suppkey AS STRING) AS author_id, s_name AS display_name FROM supplier WHERE s_suppkey%41<>0",
    "institutions": "SELECT DISTINCT 'I'||CAST(s_nationkey AS STRING) AS institution_id FROM supplier",
    "sources": "SELECT DISTINCT 'S'||CAST(p_partkey%50 AS STRING) AS source_id FROM part WHERE p_partkey%50<>7",
    "publishers": "SELECT 'P'||CAST(n_nationkey AS STRING) AS publisher_id, n_name AS display_name, CASE WHEN n_nationkey%6=0 THEN 'DELETED' ELSE 'ACTIVE' END AS activity_state FROM nation",
    "topics": "SELECT DISTINCT 'T'||p_brand AS topic_id FROM part",
    "funders": "SELECT DISTINCT 'F'||CAST(s_suppkey%30 AS STRING) AS funder_id FROM supplier WHERE s_suppkey%30<>3",
    "target": """SELECT 'W'||CAST(o_orderkey AS STRING) AS work_id,
  CASE WHEN o_orderkey%37=0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS lineage_source_updated_date,
  'a'||CAST(o_orderkey AS STRING) AS source_checksum_sha256,
  CASE WHEN o_orderstatus='F' THEN 'DELETED' ELSE 'ACTIVE' END AS activity_state, o_totalprice AS payload, 'run1' AS run_id FROM orders""",
    "staging": """SELECT 'W'||CAST(CASE WHEN o_orderkey%50=0 THEN o_orderkey+10000000 ELSE o_orderkey END AS STRING) AS work_id,
  CASE WHEN o_orderkey%41=0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE)+CAST(o_orderkey%5-2 AS INT) AS DATE) END AS lineage_source_updated_date,
  CASE WHEN o_orderkey%4=0 THEN 'a' ELSE 'b' END||CAST(o_orderkey AS STRING) AS source_checksum_sha256,
  CASE WHEN o_orderkey%9=0 THEN 'DELETED' ELSE 'ACTIVE' END AS activity_state, o_totalprice*2 AS payload, 'run2' AS run_id
  FROM orders WHERE o_orderkey%3=0""",
    "staging_topics": "SELECT work_id, topic_id||'x' AS topic_id FROM work_topics WHERE work_id LIKE '%3' OR work_id LIKE '%6'",
    "ledger": """SELECT 'W'||CAST(o_orderkey+CASE WHEN o_orderkey%13=0 THEN 50000000 ELSE 0 END AS STRING) AS work_id,
  CAST(CAST(o_orderdate AS DATE)+CAST(o_orderkey%7-3 AS INT) AS DATE) AS deleted_date FROM orders WHERE o_orderkey%5=0""",
    "assets": """SELECT 'as'||CAST(o_custkey AS STRING) AS asset_id, 'works' AS entity,
  CASE WHEN o_orderkey%29=0 THEN 'parquet' ELSE 'jsonl' END AS format,
  CASE WHEN o_orderkey%31=0 THEN NULL WHEN o_orderkey%53=0 THEN -1 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS byte_size,
  CASE WHEN o_orderkey%37=0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS updated_date,
  'part_'||CAST(o_orderkey AS STRING) AS file_uri, o_orderkey%1000 AS record_count FROM orders""",
}


def with_clause(*names: str) -> str:
    """WITH text that defines the named tables and what they need, in order; base tables need no definition."""
    needed: list[str] = []
    needs = {n: [m for m in CTES if m != n and f" {m} " in f"{CTES[n]} ".replace("\n", " ")] for n in CTES}

    def add(name: str) -> None:
        for m in needs[name]:
            add(m)
        if name not in needed:
            needed.append(name)

    for n in names:
        if n in CTES:
            add(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)


#: Tables that were written once, by name; they are read instead of being derived again.
STORED: dict[str, DataFrame] = {}


def store(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write all bibliographic tables once, as a warehouse holds them, and read them from now on."""
    for name, df in tables(spark, sf_dir, *CTES).items():
        df.write.parquet(f"{folder}/{name}")
    STORED.update({name: spark.read.parquet(f"{folder}/{name}") for name in CTES})


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named bibliographic tables as DataFrames over the parquet tables in sf_dir, or the stored ones; base tables as they are."""
    given = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names if n in BASE}
    names = tuple(n for n in names if n not in given)
    if STORED:
        return given | {n: STORED[n] for n in names}
    for base in BASE:
        if any(f" {base}" in CTES[n] for n in [*names, "line_keys", "work_topics"]):
            spark.read.parquet(f"{sf_dir}/{base}.parquet").createOrReplaceTempView(base)
    return given | {n: spark.sql(f"{with_clause(n)} SELECT * FROM {n}") for n in names}
