"""Quality checks, versions, merges, deletions, publication and aggregates as registered queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from folioforge.operators import aggregates, entities, gold, publication, quality, versions
from folioforge.plans.gold_queries import ALL, CONTRIBUTIONS, EDGES, _plain
from folioforge.plans.registry import ORACLES, base_query, query
from folioforge.sources.scratch import new_folder

OWNED = quality.OWNED
ENTITIES = tuple(e for _, e, _ in quality.DIMENSIONS)


# --- quality -----------------------------------------------------------------------------------------------------


def _check_sql(check: str, kind: str, observed: str, expected: str = "NULL", denominator: str = "NULL", diagnostics: str = "NULL", source: str = "") -> str:
    status = f"CASE WHEN CAST({observed} AS DOUBLE) IS NOT DISTINCT FROM CAST({expected} AS DOUBLE) THEN 'PASS' ELSE 'FAIL' END" if kind == "HARD_GATE" else "'PASS'"
    return f"SELECT '{check}' AS check_id, '{kind}' AS kind, {status} AS status, CAST({observed} AS DOUBLE) AS observed, CAST({expected} AS DOUBLE) AS expected, CAST({denominator} AS BIGINT) AS denominator, CAST({diagnostics} AS VARCHAR) AS diagnostics {source}"


def _missing(check: str, table: str) -> str:
    return f"SELECT '{check}', 'HARD_GATE', 'ERROR', NULL, NULL, NULL, 'missing table {table}'"


def _parts(*names: str) -> str:
    """The SQL of registered checks, one after the other."""
    return " UNION ALL ".join(f"SELECT * FROM ({ORACLES[n]})" for n in names)


query("dq1_work_id_not_null", "works", sql=_check_sql("works.work_id_not_null", "HARD_GATE", "count(*) FILTER (work_id IS NULL)", "0", source="FROM works"))(quality.work_id_not_null)
query("dq2_work_id_unique", "works", sql=_check_sql("works.work_id_unique", "HARD_GATE", "count(*)", "0", source="FROM (SELECT work_id FROM works WHERE work_id IS NOT NULL GROUP BY 1 HAVING count(*)>1)"))(quality.work_id_unique)
ORPHANS = " UNION ALL ".join(f"SELECT '{r}' AS relationship_name, count(*) AS orphan_count FROM {r} WHERE work_id NOT IN (SELECT work_id FROM works)" for r in OWNED)
query("dq3_source_work_orphans", "works", *OWNED, sql=ORPHANS)(quality.orphan_counts)
query("dq3_source_work_integrity", "works", *OWNED, sql=_check_sql("relationships.source_work_integrity", "HARD_GATE", "sum(orphan_count)", "0", diagnostics="string_agg(relationship_name||'='||orphan_count, ';' ORDER BY relationship_name||'='||orphan_count)", source=f"FROM ({ORPHANS})"))(quality.source_work_integrity)
LOST = " UNION ALL ".join(f"SELECT '{r}.{k}' AS ref_name, count(*) AS orphan_count FROM {r} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM {e})" for r, e, k in quality.DIMENSIONS)
query("dq4_dimension_orphans", *{x for r, e, _ in quality.DIMENSIONS for x in (r, e)}, sql=LOST)(quality.dimension_orphan_counts)
query("dq4_dimension_integrity", *{x for r, e, _ in quality.DIMENSIONS for x in (r, e)}, sql=_check_sql("relationships.dimension_integrity", "HARD_GATE", "sum(orphan_count)", "0", diagnostics="string_agg(ref_name||'='||orphan_count, ';' ORDER BY ref_name||'='||orphan_count)", source=f"FROM ({LOST})"))(quality.dimension_integrity)


@query("dq5_decode_balance", "works", sql=_check_sql("ingest.decode_balance", "HARD_GATE", "count(*)", "count(*) FILTER (title IS NOT NULL)+count(*) FILTER (title IS NULL)", source="FROM works"))
def dq5(t):
    return quality.decode_balance(t["works"].agg(F.count("*").alias("decoded"), F.count_if(F.col("title").isNotNull()).alias("mapped"), F.count_if(F.col("title").isNull()).alias("rejected")))


def _decision_counters(t):
    counts = aggregates.outcome_counters(versions.publication_decisions(t["staging"], t["target"]), "publication_decision", ["INSERT", "APPLY_UPDATE", "IDENTICAL", "STALE", "CONFLICT", "RESTORE_REQUIRED"])
    return counts.select(F.col("insert").alias("inserted"), F.col("apply_update").alias("updated"), "identical", "stale", "conflict", "restore_required", F.col("total").alias("evaluated"))


query("dq6_decision_balance", "target", "staging", sql=_check_sql("publication.decision_balance", "HARD_GATE", "count(DISTINCT work_id)", "count(*)", source="FROM staging"))(lambda t: quality.decision_balance(_decision_counters(t)))

EXCLUSION = CONTRIBUTIONS + f""",
 used AS (SELECT work_id FROM contributions UNION ALL SELECT source_work_id FROM ({EDGES}))
SELECT 0 AS missing_manifest_mart_count, 0 AS unexpected_manifest_mart_count, 0 AS duplicate_manifest_mart_count, 0 AS invalid_manifest_mart_count,
 count(*) FILTER (w.work_id IS NULL) AS missing_source_work_count, count(*) FILTER (w.activity_state<>'ACTIVE') AS inactive_source_work_count FROM used u LEFT JOIN works w ON w.work_id=u.work_id"""


@query("dq7_deleted_source_exclusion", *ALL, sql=EXCLUSION)
def dq7(t):
    return quality.deleted_work_exclusion_counts(t, gold.mart_manifest(t["works"].sparkSession), gold.work_contributions(t), gold.citation_edges(t))


RATE = "CASE WHEN {a}=0 THEN NULL ELSE CAST({m} AS DOUBLE)/{a} END"
query("dq8_missing_doi", "works", sql=_check_sql("metric.missing_doi", "INFORMATIONAL", RATE.format(a="count(*)", m="count(*) FILTER (doi IS NULL)"), denominator="count(*)", source="FROM works WHERE activity_state='ACTIVE'"))(quality.missing_doi)
query("dq9_missing_title", "works", sql=_check_sql("metric.missing_title", "INFORMATIONAL", RATE.format(a="count(*)", m="count(*) FILTER (title IS NULL OR title='')"), denominator="count(*)", source="FROM works WHERE activity_state='ACTIVE'"))(quality.missing_title)
query("dq10_without_topics", "works", "work_topics", sql=_check_sql("metric.works_without_topics", "INFORMATIONAL", RATE.format(a="count(*)", m="count(*) FILTER (work_id NOT IN (SELECT work_id FROM work_topics))"), denominator="count(*)", source="FROM works WHERE activity_state='ACTIVE'"))(quality.works_without_topics)
query("dq11_without_authors", "works", "work_authors", sql=_check_sql("metric.works_without_authors", "INFORMATIONAL", RATE.format(a="count(*)", m="count(*) FILTER (work_id NOT IN (SELECT work_id FROM work_authors WHERE author_id IS NOT NULL))"), denominator="count(*)", source="FROM works WHERE activity_state='ACTIVE'"))(quality.works_without_authors)
query("dq12_year_distribution", "works", sql="SELECT publication_year, count(*) AS work_count FROM works WHERE activity_state='ACTIVE' GROUP BY 1")(quality.year_distribution)
query("dq13_type_distribution", "works", sql="SELECT work_type, count(*) AS work_count FROM works WHERE activity_state='ACTIVE' GROUP BY 1")(quality.type_distribution)
query("dq14_reference_reconciliation", "works", "work_references", sql="""WITH c AS (SELECT CASE WHEN reference_status='MISSING' THEN 'REFERENCE_MISSING' WHEN reference_status='MALFORMED' THEN 'REFERENCE_MALFORMED' WHEN t.activity_state='ACTIVE' THEN 'TARGET_ACTIVE' WHEN t.activity_state='DELETED' THEN 'TARGET_DELETED' ELSE 'TARGET_ABSENT' END AS category
 FROM work_references r JOIN works s ON s.work_id=r.work_id AND s.activity_state='ACTIVE' LEFT JOIN works t ON t.work_id=r.referenced_work_id)
SELECT x.category, count(c.category) AS reference_count FROM (SELECT unnest(['REFERENCE_MISSING','REFERENCE_MALFORMED','TARGET_ACTIVE','TARGET_DELETED','TARGET_ABSENT']) AS category) x LEFT JOIN c ON c.category=x.category GROUP BY 1""")(quality.reference_reconciliation)  # fmt: skip
def _stale(t):
    """The tables as they were before any work was deleted."""
    return {**t, "works": t["works"].withColumn("activity_state", F.lit("ACTIVE"))}


query("dq17_mart_leakage", *ALL, sql="SELECT 'research_discovery' AS mart_id, count(*) AS leaked FROM works WHERE activity_state='DELETED' UNION ALL SELECT 'citation_edges', count(*) FROM work_references r JOIN works w ON w.work_id=r.work_id AND activity_state='DELETED'")(
    lambda t: quality.mart_leakage(t, {"research_discovery": gold.research_discovery(_stale(t)), "citation_edges": gold.citation_edges(_stale(t))})
)
query("dq17_fresh_marts_do_not_leak", *ALL, sql="SELECT unnest(['research_discovery','citation_edges']) AS mart_id, (SELECT count(*) FROM works WHERE activity_state NOT IN ('ACTIVE','DELETED')) AS leaked")(lambda t: quality.mart_leakage(t, {"research_discovery": gold.research_discovery(t), "citation_edges": gold.citation_edges(t)}))

# The decision for each kind of change and order of dates (1 later, 0 the same, -1 earlier, 9 both undated; a dated side is later than an
# undated one). What has no row is not known yet.
RULES = {
    "same": dict.fromkeys((1, 0, -1, 9), "IDENTICAL"),
    "revived": dict.fromkeys((1, 0, -1, 9), "RESTORE_REQUIRED"),
    "retired": {1: "APPLY_UPDATE", 0: "APPLY_UPDATE", -1: "STALE", 9: "CONFLICT"},
    "kept": {1: "APPLY_UPDATE", 0: "CONFLICT", -1: "STALE", 9: "CONFLICT"},
}
_RULE_ROWS = ", ".join(f"('{kind}', {order}, '{decision}')" for kind, by in RULES.items() for order, decision in by.items())
_DAY = "coalesce({0}.lineage_source_updated_date, DATE '1000-01-01')"
TARGET_DECISIONS = f"""WITH rules(kind, dates, decision) AS (VALUES {_RULE_ROWS}),
 kinds(was, becomes, kind) AS (VALUES ('ACTIVE', 'ACTIVE', 'kept'), ('DELETED', 'DELETED', 'kept'), ('ACTIVE', 'DELETED', 'retired'), ('DELETED', 'ACTIVE', 'revived')),
 facts AS (SELECT s.work_id, s.activity_state AS source_activity_state, IF(s.source_checksum_sha256 = t.source_checksum_sha256, 'same', k.kind) AS kind,
  IF(coalesce(s.lineage_source_updated_date, t.lineage_source_updated_date) IS NULL, 9, sign({_DAY.format("s")} - {_DAY.format("t")})) AS dates
  FROM staging s LEFT JOIN target t ON t.work_id=s.work_id LEFT JOIN kinds k ON k.was=t.activity_state AND k.becomes=s.activity_state),
 d AS (SELECT work_id, source_activity_state, coalesce(decision, 'INSERT') AS publication_decision FROM facts LEFT JOIN rules ON rules.kind=facts.kind AND rules.dates=facts.dates)"""
MERGED = TARGET_DECISIONS + """,
 merged AS (SELECT coalesce(t.work_id, s.work_id) AS work_id,
  CASE WHEN d.publication_decision IN ('INSERT','APPLY_UPDATE') THEN s.lineage_source_updated_date ELSE t.lineage_source_updated_date END AS lineage_source_updated_date,
  CASE WHEN d.publication_decision IN ('INSERT','APPLY_UPDATE') THEN s.source_checksum_sha256 ELSE t.source_checksum_sha256 END AS source_checksum_sha256,
  CASE WHEN d.publication_decision IN ('INSERT','APPLY_UPDATE') THEN s.activity_state ELSE t.activity_state END AS activity_state,
  CASE WHEN d.publication_decision IN ('INSERT','APPLY_UPDATE') THEN s.payload ELSE t.payload END AS payload,
  CASE WHEN d.publication_decision IN ('INSERT','APPLY_UPDATE','IDENTICAL') THEN s.run_id ELSE t.run_id END AS run_id
  FROM target t FULL JOIN staging s ON s.work_id=t.work_id LEFT JOIN d ON d.work_id=s.work_id WHERE t.work_id IS NOT NULL OR d.publication_decision='INSERT')"""  # fmt: skip


def _decide(t):
    return versions.publication_decisions(t["staging"], t["target"])


@query("dq18_rejected_rows_unchanged", "target", "staging", sql=TARGET_DECISIONS + " SELECT count(*) AS rejected_rows, 0 AS changed_rows FROM d WHERE publication_decision IN ('STALE','CONFLICT','RESTORE_REQUIRED')")
def dq18(t):
    decisions = _decide(t)
    ids = versions.rejected(decisions).select("work_id")
    before = t["target"].join(ids, "work_id", "left_semi")
    after = versions.merge_works(t["target"], t["staging"], decisions).join(ids, "work_id", "left_semi")
    return before.agg(F.count("*").alias("rejected_rows")).crossJoin(before.exceptAll(after).agg(F.count("*").alias("changed_rows")))  # one row each


query("dq19_dml_count_reconcile", "target", "staging", sql=MERGED + """ SELECT d.publication_decision, count(*) AS decided, count(*) FILTER (CASE WHEN d.publication_decision IN ('INSERT','APPLY_UPDATE') THEN m.source_checksum_sha256=s.source_checksum_sha256
 WHEN d.publication_decision='IDENTICAL' THEN m.run_id=s.run_id ELSE m.source_checksum_sha256<>s.source_checksum_sha256 END) AS done FROM d JOIN staging s ON s.work_id=d.work_id LEFT JOIN merged m ON m.work_id=d.work_id GROUP BY 1""")(lambda t: versions.merge_counts(t["target"], t["staging"], _decide(t)))


@query("dq15_run_checks", "works", *OWNED, *ENTITIES)
def dq15(t):
    return quality.run_checks(t, quality.PRE_BUILD)[0]


_COUNTERS = f" UNION ALL {_missing('ingest.decode_balance', 'decode_counters')} UNION ALL {_missing('publication.decision_balance', 'decision_counters')}"
ORACLES["dq15_run_checks"] = _parts("dq1_work_id_not_null", "dq2_work_id_unique", "dq3_source_work_integrity", "dq4_dimension_integrity", "dq8_missing_doi", "dq9_missing_title", "dq10_without_topics", "dq11_without_authors") + _COUNTERS


@query("dq16_publication_allowed", "works", "work_topics")
def dq16(t):
    results, allowed = quality.run_checks(t, quality.PRE_BUILD)
    return results.groupBy("kind", "status").agg(F.count("*").alias("checks")).withColumn("publication_allowed", F.lit(allowed))


_TWO_TABLES = _parts("dq1_work_id_not_null", "dq2_work_id_unique", "dq8_missing_doi", "dq9_missing_title", "dq10_without_topics") + _COUNTERS + f" UNION ALL {_missing('relationships.source_work_integrity', 'work_authors')} UNION ALL {_missing('relationships.dimension_integrity', 'work_authors')}"
ORACLES["dq16_publication_allowed"] = f"SELECT kind, status, count(*) AS checks, bool_and(NOT (kind='HARD_GATE' AND status<>'PASS')) AND false AS publication_allowed FROM ({_TWO_TABLES} UNION ALL SELECT 'metric.works_without_authors', 'INFORMATIONAL', 'ERROR', NULL, NULL, NULL, 'missing table work_authors') GROUP BY ALL"


# --- versions, merges, deletions -----------------------------------------------------------------------------------


@query("ver1_compare_versions", "target", "staging", sql="""SELECT s.work_id, CASE WHEN s.source_checksum_sha256=t.source_checksum_sha256 THEN 'IDENTICAL' WHEN s.lineage_source_updated_date > t.lineage_source_updated_date THEN 'NEWER' WHEN s.lineage_source_updated_date < t.lineage_source_updated_date THEN 'STALE'
 WHEN s.lineage_source_updated_date IS NOT NULL AND t.lineage_source_updated_date IS NULL THEN 'NEWER' WHEN s.lineage_source_updated_date IS NULL AND t.lineage_source_updated_date IS NOT NULL THEN 'STALE' ELSE 'CONFLICT' END AS outcome FROM staging s JOIN target t ON t.work_id=s.work_id""")  # fmt: skip
def ver1(t):
    joined = t["staging"].alias("s").join(t["target"].alias("t"), F.col("s.work_id") == F.col("t.work_id"))
    c = lambda a, b: F.col(f"{a}.{b}")
    return joined.select("s.work_id", versions.version_outcome(c("t", "source_checksum_sha256"), c("t", "lineage_source_updated_date"), c("s", "source_checksum_sha256"), c("s", "lineage_source_updated_date")).alias("outcome"))


query("ver2_publication_decisions", "target", "staging", sql=TARGET_DECISIONS + " SELECT * FROM d")(_decide)
query("ver3_accepted_ids", "target", "staging", sql=TARGET_DECISIONS + " SELECT work_id FROM d WHERE publication_decision IN ('INSERT','APPLY_UPDATE')")(lambda t: versions.accepted_ids(_decide(t)))
query("ver4_relationship_scope", "target", "staging", sql=TARGET_DECISIONS + " SELECT work_id FROM d WHERE publication_decision IN ('INSERT','APPLY_UPDATE') AND source_activity_state='ACTIVE'")(lambda t: versions.relationship_scope(_decide(t)))
query("ver5_rejected", "target", "staging", sql=TARGET_DECISIONS + " SELECT work_id, publication_decision FROM d WHERE publication_decision IN ('STALE','CONFLICT','RESTORE_REQUIRED')")(lambda t: versions.rejected(_decide(t)))
query("ver6_decision_alias", "target", "staging", sql=TARGET_DECISIONS + " SELECT work_id, publication_decision AS classification FROM d")(lambda t: versions.decision_alias(_decide(t)))
query("mrg1_merge_works", "target", "staging", sql=MERGED + " SELECT * REPLACE (CAST(lineage_source_updated_date AS VARCHAR) AS lineage_source_updated_date) FROM merged")(lambda t: _plain(versions.merge_works(t["target"], versions.require_unique(t["staging"], ["work_id"]), _decide(t))))


@query("mrg2_replace_by_work_id", "target", "staging", "work_topics", "staging_topics", sql=TARGET_DECISIONS + """, scope AS (SELECT work_id FROM d WHERE publication_decision IN ('INSERT','APPLY_UPDATE') AND source_activity_state='ACTIVE')
SELECT * FROM work_topics WHERE work_id NOT IN (FROM scope) UNION ALL SELECT * FROM staging_topics WHERE work_id IN (FROM scope)""")  # fmt: skip
def mrg2(t):
    staged = versions.require_columns(t["staging_topics"], ["work_id", "topic_id"])
    return versions.replace_by_work(t["work_topics"], staged, versions.relationship_scope(_decide(t)))


@query("mrg3_required_columns", "staging", sql="SELECT unnest(['work_id','source_checksum_sha256','lineage_source_updated_date']) AS name, unnest([count(*) FILTER (work_id IS NULL)>0, count(*) FILTER (source_checksum_sha256 IS NULL)>0, count(*) FILTER (lineage_source_updated_date IS NULL)>0]) AS aborts FROM staging")
def mrg3(t):
    def aborts(column):
        try:
            versions.require_columns(t["staging"], [column])
        except ValueError:
            return True
        return False

    names = ("work_id", "source_checksum_sha256", "lineage_source_updated_date")
    return t["staging"].sparkSession.createDataFrame([(c, aborts(c)) for c in names], "name string, aborts boolean")


@query("del1_classify_deletion", "target", "ledger", sql="""SELECT d.work_id, CAST(d.deleted_date AS VARCHAR) AS deleted_date, CASE WHEN w.work_id IS NULL THEN 'UNKNOWN_WORK' WHEN w.activity_state='DELETED' THEN CASE WHEN d.deleted_date < w.lineage_source_updated_date THEN 'STALE' ELSE 'ALREADY_DELETED' END
 WHEN w.lineage_source_updated_date IS NULL OR d.deleted_date < w.lineage_source_updated_date THEN 'STALE' ELSE 'DELETED' END AS outcome FROM ledger d LEFT JOIN target w ON w.work_id=d.work_id""")  # fmt: skip
def del1(t):
    return _plain(versions.classify_deletions(t["target"], t["ledger"]))


@query("del2_tombstone", "target", "ledger", sql="""SELECT w.work_id, CASE WHEN h THEN 'sum' ELSE source_checksum_sha256 END AS source_checksum_sha256, CAST(CASE WHEN h THEN d.deleted_date ELSE lineage_source_updated_date END AS VARCHAR) AS lineage_source_updated_date, CASE WHEN h THEN 'DELETED' ELSE activity_state END AS activity_state, payload, CASE WHEN h THEN 'r9' ELSE run_id END AS run_id
FROM (SELECT w.*, d.deleted_date, coalesce(w.activity_state='ACTIVE' AND d.deleted_date >= w.lineage_source_updated_date, false) AS h FROM target w LEFT JOIN ledger d ON d.work_id=w.work_id) w LEFT JOIN ledger d ON d.work_id=w.work_id""")  # fmt: skip
def del2(t):
    return _plain(versions.tombstone(t["target"], versions.classify_deletions(t["target"], t["ledger"]), "asset", "sum", "r9"))


@query("del3_dedupe_ledger", "ledger", sql="WITH l AS (SELECT * FROM ledger UNION ALL SELECT * FROM ledger WHERE work_id LIKE '%0') SELECT work_id, CAST(min(deleted_date) AS VARCHAR) AS deleted_date, count(*)-1 AS duplicates FROM l GROUP BY 1 HAVING count(DISTINCT deleted_date)<=1")
def del3(t):
    return _plain(versions.dedupe_ledger(t["ledger"].unionByName(t["ledger"].where("work_id LIKE '%0'")))[0])


@query("del4_update_barriers", "target", "ledger", sql="WITH l AS (SELECT * FROM ledger WHERE work_id NOT IN (SELECT work_id FROM target)) SELECT work_id, CAST(max(deleted_date) AS VARCHAR) AS deleted_date FROM (SELECT * FROM l UNION ALL SELECT work_id, CAST(deleted_date+1 AS DATE) FROM l WHERE work_id LIKE '%5') GROUP BY 1")
def del4(t):
    unknown = versions.classify_deletions(t["target"], t["ledger"]).where("outcome = 'UNKNOWN_WORK'").select("work_id", "deleted_date")
    return _plain(versions.update_barriers(unknown, unknown.where("work_id LIKE '%5'").withColumn("deleted_date", F.date_add("deleted_date", 1))))


query("del7_barrier_violations", "target", "ledger", sql="SELECT w.work_id, activity_state FROM target w LEFT JOIN (SELECT DISTINCT work_id FROM ledger) d ON d.work_id=w.work_id WHERE (activity_state='ACTIVE' AND d.work_id IS NOT NULL) OR (activity_state='DELETED' AND d.work_id IS NULL)")(lambda t: versions.barrier_violations(t["target"], t["ledger"]))


def observations(t):
    """Observations of works in three assets: the target's, the ledger's, and the staging's."""
    work = lambda df, seq: df.select("work_id", F.lit(seq).alias("seq"), F.xxhash64("work_id").alias("pos"), F.lit("work").alias("kind"), F.col("source_checksum_sha256").alias("checksum"), F.col("lineage_source_updated_date").alias("lineage_date"), F.lit(None).cast("date").alias("work_date"))
    gone = t["ledger"].select("work_id", F.lit(2).alias("seq"), F.xxhash64("work_id").alias("pos"), F.lit("deletion").alias("kind"), F.lit("del").alias("checksum"), F.col("deleted_date").alias("lineage_date"), F.lit(None).cast("date").alias("work_date"))
    return work(t["target"], 1).unionByName(gone).unionByName(work(t["staging"], 3))


FOLD = """WITH a AS (SELECT coalesce(t.work_id, l.work_id) AS work_id, t.work_id IS NOT NULL AS known, t.lineage_source_updated_date AS d1, t.source_checksum_sha256 AS c1, l.deleted_date AS x FROM target t FULL JOIN ledger l ON l.work_id=t.work_id),
 b AS (SELECT *, CASE WHEN x IS NULL THEN NULL WHEN NOT known THEN 'UNKNOWN_WORK' WHEN d1 IS NULL OR x < d1 THEN 'STALE' ELSE 'DELETED' END AS o2 FROM a),
 s AS (SELECT b.*, s.work_id AS sid, s.lineage_source_updated_date AS d3, s.source_checksum_sha256 AS c3 FROM b FULL JOIN staging s ON s.work_id=b.work_id),
 r AS (SELECT coalesce(work_id, sid) AS work_id, CASE WHEN known THEN 'INSERTED' END AS o1, o2, CASE WHEN sid IS NULL THEN NULL WHEN NOT coalesce(known,false) THEN CASE WHEN o2 IS NULL THEN 'INSERTED' WHEN d3 IS NULL OR d3 <= x THEN 'BLOCKED' ELSE 'RESTORE_REQUIRED' END
  WHEN o2='DELETED' THEN CASE WHEN d3 <= x THEN 'BLOCKED' ELSE 'RESTORE_REQUIRED' END WHEN c1=c3 THEN 'IDENTICAL' WHEN d3 > d1 THEN 'REPLACED' WHEN d3 < d1 THEN 'STALE' WHEN d3 IS NOT NULL AND d1 IS NULL THEN 'REPLACED' WHEN d3 IS NULL AND d1 IS NOT NULL THEN 'STALE' ELSE 'CONFLICT' END AS o3 FROM s)
SELECT work_id, seq, outcome FROM (SELECT work_id, 1 AS seq, o1 AS outcome FROM r UNION ALL SELECT work_id, 2, o2 FROM r UNION ALL SELECT work_id, 3, o3 FROM r) WHERE outcome IS NOT NULL"""  # fmt: skip
query("ups1_works_upsert_fold", "target", "ledger", "staging", sql=FOLD)(lambda t: versions.outcomes_of(versions.fold_observations(observations(t))).select("work_id", "seq", "outcome"))


_OUTCOMES = FOLD[: FOLD.index("\nSELECT work_id, seq, outcome")]


@query("ups2_relationship_effects", "target", "ledger", "staging", "work_topics", sql=_OUTCOMES + " SELECT r.work_id, CASE WHEN o3 IN ('INSERTED','REPLACED') THEN 3 ELSE 1 END AS seq, topic_id FROM r JOIN work_topics w ON w.work_id=r.work_id WHERE o1 IS NOT NULL OR o3 IN ('INSERTED','REPLACED')")
def ups2(t):
    seen = observations(t)
    folded = versions.fold_observations(seen)
    topics = seen.where("kind = 'work'").select("work_id", "seq", "pos").join(t["work_topics"], "work_id")
    return versions.winning_relationships(topics, folded).select("work_id", "seq", "topic_id")


@query("rec3_enrichment_rows", "target", "ledger", "staging", sql=FOLD.replace("WHERE outcome IS NOT NULL", "WHERE outcome IN ('INSERTED','REPLACED','IDENTICAL','STALE') AND seq<>2").replace("SELECT work_id, seq, outcome FROM", "SELECT work_id, seq FROM"))
def rec3(t):
    seen = observations(t)
    return versions.enrichment_rows(seen, versions.fold_observations(seen)).select("work_id", "seq")


#: State of works after the target's works and the ledger's deletions.
STATE = FOLD[: FOLD.index(",\n s AS")] + ", st AS (SELECT work_id, CASE WHEN NOT known THEN NULL WHEN o2='DELETED' THEN 'DELETED' ELSE 'ACTIVE' END AS state FROM b)"


@query("pub5_asset_atomicity", "target", "ledger", "staging", sql=STATE + " SELECT state, count(*) AS works, 1 AS assets_left_out FROM st GROUP BY 1")
def pub5(t):
    folded, dropped = versions.fold_assets(observations(t))
    return folded.groupBy("state").agg(F.count("*").alias("works")).withColumn("assets_left_out", F.lit(len(dropped)))


def descriptions(spark, sf_dir):
    """Embedded descriptions of parts in orders: an asset for each ship year, dated by it."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    keyed = lines.select(F.concat(F.lit("E"), F.col("l_partkey").cast("string")).alias("entity_id"), F.year("l_shipdate").alias("seq"), F.xxhash64(*lines.columns).alias("pos"), F.when(F.col("l_suppkey") % 3 == 0, None).otherwise(F.concat(F.lit("n"), (F.col("l_suppkey") % 2).cast("string"))).alias("name"), F.when(F.col("l_linenumber") > 3, F.lit("x")).alias("kind"))
    return keyed.withColumn("date", F.make_date("seq", F.lit(1), F.lit(1)))


@base_query("rec1_reconcile_entities")
def rec1(spark, sf_dir):
    return _plain(entities.reconcile_entities(descriptions(spark, sf_dir), "entity_id", ["name", "kind"]))


@base_query("rec2_enrich_merge", sql="""SELECT c_custkey AS k, coalesce(CASE WHEN c_custkey%3=0 THEN NULL ELSE c_name END, CASE WHEN c_custkey%2=0 THEN NULL ELSE c_name END) AS name, CASE WHEN c_custkey%3=0 AND c_custkey%2<>0 THEN true ELSE false END AS from_new FROM customer""")
def rec2(spark, sf_dir):
    name, k = F.col("c_name"), F.col("c_custkey")
    merged, filled = entities.enrich({"name": F.when(k % 3 != 0, name)}, {"name": F.when(k % 2 != 0, name)})
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(k.alias("k"), merged["name"].alias("name"), filled.alias("from_new"))


@base_query("mrg4_dimension_merge")
def mrg4(spark, sf_dir):
    seen = descriptions(spark, sf_dir)
    first = entities.reconcile_entities(seen.where("seq < 1998"), "entity_id", ["name", "kind"])
    return _plain(entities.merge_dimension(first, seen.where("seq >= 1998"), "entity_id", ["name", "kind"]))


# --- publication -------------------------------------------------------------------------------------------------


@query("pub1_registration_outcome", "assets", sql="""SELECT asset_id, file_uri, CASE WHEN k%4=0 THEN 'CREATED' WHEN k%5=0 THEN 'IDENTITY_CONFLICT' WHEN k%7=0 THEN 'CHECKSUM_CONFLICT' WHEN k%3=0 THEN 'ALREADY_SUCCESS' WHEN k%3=1 THEN 'RETRYABLE_FAILURE' ELSE 'IDEMPOTENT_REPLAY' END AS outcome FROM (SELECT *, record_count AS k FROM assets)""")
def pub1(t):
    k = F.col("record_count")
    now = t["assets"].select(F.concat("asset_id", F.lit("/"), "file_uri").alias("asset_id"), F.col("file_uri").alias("source_uri"), F.lit("c1").alias("checksum"), F.col("byte_size"), k.alias("record_count"))
    ledger = now.where(k % 4 != 0).select("asset_id", F.when(k % 5 == 0, "elsewhere").otherwise(F.col("source_uri")).alias("source_uri"), F.when(k % 7 == 0, "c2").otherwise("c1").alias("checksum"), "byte_size", F.when(k % 3 == 0, "SUCCESS").when(k % 3 == 1, "FAILED").otherwise("DISCOVERED").alias("status"))
    out = publication.classify_assets(now, ledger)
    return out.select(F.split_part("asset_id", F.lit("/"), F.lit(1)).alias("asset_id"), F.col("source_uri").alias("file_uri"), "outcome")


REASON = "CASE WHEN format NOT IN ('jsonl') THEN 'UNSUPPORTED_FORMAT' WHEN byte_size IS NULL THEN 'UNKNOWN_SIZE' WHEN byte_size<0 THEN 'INVALID_SIZE' WHEN byte_size>300000 THEN 'OVERSIZED' END"


@query("f10_asset_eligibility", "assets", sql=f"SELECT reason, count(*) AS n FROM (SELECT {REASON} AS reason FROM assets) GROUP BY 1")
def f10(t):
    return t["assets"].select(publication.skip_reason(300_000, formats=("jsonl",)).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("pub2_asset_selection", "assets", sql="""WITH m AS (SELECT *, CASE WHEN byte_size IS NULL THEN 'UNKNOWN_SIZE' WHEN byte_size<0 THEN 'INVALID_SIZE' WHEN byte_size>300000 THEN 'OVERSIZED' END AS r FROM assets),
 n AS (SELECT *, row_number() OVER (ORDER BY r IS NOT NULL, byte_size, updated_date IS NOT NULL, updated_date NULLS FIRST, file_uri, asset_id) AS k FROM m)
SELECT asset_id, file_uri, CASE WHEN r IS NULL AND k>100 THEN 'FILE_LIMIT_REACHED' ELSE r END AS reason FROM n""")  # fmt: skip
def pub2(t):
    return publication.select_assets(t["assets"], 100, 300_000).select("asset_id", "file_uri", "reason")


@query("f11_backfill_window", "assets", sql="SELECT asset_id, file_uri FROM assets WHERE updated_date BETWEEN DATE '1997-01-01' AND DATE '1997-01-20' ORDER BY updated_date, file_uri, asset_id LIMIT 20")
def f11(t):
    return publication.backfill_window(t["assets"], date(1997, 1, 1), date(1997, 1, 20), 31, 20).select("asset_id", "file_uri")


@query("src6_unique_assets", "assets", sql="SELECT asset_id, count(*) AS descriptions FROM (SELECT DISTINCT * FROM assets) GROUP BY 1 HAVING count(*)>1")
def src6(t):
    return publication.unique_assets(t["assets"].unionByName(t["assets"].where("record_count < 500")))[1]


@query("pub4_final_validation", *ALL, sql="""SELECT 'deleted_in_discovery' AS rule, count(*) FILTER (activity_state='DELETED') + count(*) FILTER (activity_state='DELETED' AND work_id LIKE '%4') AS violations FROM works
UNION ALL SELECT 'deleted_in_lookup', count(*) FILTER (activity_state='DELETED' AND work_id LIKE '%2') FROM works UNION ALL SELECT 'repeated_in_discovery', count(*) FILTER (work_id LIKE '%4') FROM works""")
def pub4(t):
    discovery = gold.research_discovery(_stale(t))
    twice = discovery.unionByName(discovery.where("work_id LIKE '%4'"))
    return publication.final_validation(twice, discovery.where("work_id LIKE '%2'").select("work_id"), t["works"])


def _changed(t):
    """The tables after every work of even digits became deleted, and which changed."""
    now = {**t, "works": t["works"].withColumn("activity_state", F.when(F.col("work_id").rlike("[02468]$"), "DELETED").otherwise(F.col("activity_state")))}
    ids = t["works"].where("activity_state = 'ACTIVE' AND work_id RLIKE '[02468]$'").select("work_id")
    return now, ids


AFTER = "WITH later AS (SELECT * REPLACE (CASE WHEN regexp_matches(work_id,'[02468]$') THEN 'DELETED' ELSE activity_state END AS activity_state) FROM works)"


@query("pub6_gold_refresh_scope", *ALL, sql=AFTER + """ SELECT primary_publisher_id AS publisher_id, topic_id, publication_year, count(DISTINCT w.work_id) AS active_work_count FROM later w JOIN work_topics t ON t.work_id=w.work_id
WHERE activity_state='ACTIVE' AND primary_publisher_id IS NOT NULL GROUP BY ALL""")  # fmt: skip
def pub6(t):
    now, ids = _changed(t)
    mart = "publisher_topic_year_stats"
    return publication.refresh_mart(gold.MARTS[mart](t), now, publication.refresh_scope(t, now, ids, mart), mart)


@query("pub6_citation_refresh", *ALL, sql=AFTER + " " + EDGES.replace("JOIN works s", "JOIN later s").replace("JOIN works t", "JOIN later t"))
def pub6_citations(t):
    now, ids = _changed(t)
    mart = "citation_edges"
    return publication.refresh_mart(gold.MARTS[mart](t), now, publication.refresh_scope(t, now, ids, mart), mart)


# --- aggregates over manifests and events ---------------------------------------------------------------------------

SUMMARY = "SELECT entity, count(*) AS files, CAST(sum(record_count) AS BIGINT) AS records, CAST(sum(byte_size) AS BIGINT) AS bytes, CAST(min(updated_date) AS VARCHAR) AS first_date, CAST(max(updated_date) AS VARCHAR) AS last_date, count(DISTINCT updated_date) AS partitions FROM assets GROUP BY 1"
query("agg10_manifest_totals", "assets", sql=SUMMARY)(lambda t: _plain(aggregates.manifest_summary(t["assets"])))
query("agg11_size_distribution", "assets", sql="SELECT min(byte_size) AS least, CAST(quantile_disc(byte_size, 0.5) AS BIGINT) AS median, max(byte_size) AS largest FROM assets")(lambda t: aggregates.size_distribution(t["assets"]))


@base_query("agg13_latency_percentiles", sql="SELECT event_type AS kind, count(*) AS requests, quantile_disc(value,0.5) AS p50, quantile_disc(value,0.95) AS p95, quantile_disc(value,0.99) AS p99, quantile_disc(value,0.95)<=100 AS meets_target FROM events GROUP BY 1")
def agg13(spark, sf_dir):
    return aggregates.latency_verdict(spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("kind"), "value"), 100.0)


query("agg16_outcome_counters", "target", "staging", sql=TARGET_DECISIONS + " SELECT count(*) FILTER (publication_decision='INSERT') AS insert, count(*) FILTER (publication_decision='APPLY_UPDATE') AS apply_update, count(*) FILTER (publication_decision='IDENTICAL') AS identical, count(*) FILTER (publication_decision='STALE') AS stale, count(*) FILTER (publication_decision='CONFLICT') AS conflict, count(*) FILTER (publication_decision='RESTORE_REQUIRED') AS restore_required, count(*) AS total FROM d")(lambda t: aggregates.outcome_counters(_decide(t), "publication_decision", ["INSERT", "APPLY_UPDATE", "IDENTICAL", "STALE", "CONFLICT", "RESTORE_REQUIRED"]))


@base_query("agg20_partition_summary", sql="SELECT count(*) AS files, CAST(sum(n) AS BIGINT) AS rows, min(n) AS least, quantile_disc(n, 0.5) AS median, max(n) AS largest FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)")
def agg20(spark, sf_dir):
    folder = new_folder(spark, "parts")
    spark.read.parquet(f"{sf_dir}/customer.parquet").repartition(F.col("c_mktsegment")).write.partitionBy("c_mktsegment").parquet(folder)
    return aggregates.file_summary(spark.read.parquet(folder))
