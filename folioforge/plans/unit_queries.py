"""Bucketed publication, lookups, delta-kept marts, keyed streaming state and entity folds as registered queries."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioforge.operators import deltas, entities, gold, lookups, release, units, versions
from folioforge.plans.gold_queries import _MART_QUERIES, ALL, LIST, _plain
from folioforge.plans.io_queries import run_stream
from folioforge.plans.registry import RAW, base_query, query
from folioforge.plans.version_queries import MERGED, STATE, TARGET_DECISIONS
from folioforge.sources import writers
from folioforge.sources.buckets import BucketStore, LookupFiles, bucket_of
from folioforge.sources.scratch import kept, new_folder
from folioforge.streaming import ingest

BUCKETS = 64
#: The last days' share of the staging is a batch of its own.
BATCH = "SELECT * FROM staging WHERE lineage_source_updated_date > (SELECT max(lineage_source_updated_date) - INTERVAL 3 DAY FROM staging)"
BUCKET = f"(('0x'||substr(md5(work_id),1,7))::BIGINT % {BUCKETS})::INT"


def batch_of(t):
    last = t["staging"].agg(F.date_sub(F.max("lineage_source_updated_date"), 3)).first()[0]
    return t["staging"].where(F.col("lineage_source_updated_date") > F.lit(last))


def stored(t, **tables):
    spark = t["target"].sparkSession
    store = BucketStore(spark, new_folder(spark, "store"), BUCKETS)
    store.commit({n: (df, None) for n, df in tables.items()}, "v1")
    return store


def over_batch(sql):
    """SQL over the batch in the place of the whole staging."""
    return re.sub(r"\bstaging s\b", f"({BATCH}) s", sql)


WRITTEN = ", hit AS (SELECT DISTINCT " + BUCKET + " AS bucket FROM d WHERE publication_decision IN ('INSERT','APPLY_UPDATE','IDENTICAL'))"


@query("mrg1_merge_by_touched_buckets", "target", "staging", sql=over_batch(MERGED) + WRITTEN + f""" SELECT work_id, CAST(lineage_source_updated_date AS VARCHAR) AS lineage_source_updated_date, source_checksum_sha256, activity_state, payload, run_id, {BUCKET} AS bucket, {BUCKET} IN (SELECT bucket FROM hit) AS rewritten FROM merged""")
def mrg1_buckets(t):
    """The merged table, and for each row whether its file was written anew."""
    store = stored(t, works=t["target"])
    units.publish_unit(store, {"works": batch_of(t)}, "v2")
    files = store.manifest().select("bucket", (F.col("version") == "v2").alias("rewritten"))
    rows = store.read("works").withColumn("bucket", bucket_of("work_id", BUCKETS)).join(files, "bucket")
    return rows.withColumn("lineage_source_updated_date", F.col("lineage_source_updated_date").cast("string")).select("work_id", "lineage_source_updated_date", "source_checksum_sha256", "activity_state", "payload", "run_id", "bucket", "rewritten")


SCOPED = over_batch(TARGET_DECISIONS) + ", scope AS (SELECT work_id FROM d WHERE publication_decision IN ('INSERT','APPLY_UPDATE') AND source_activity_state='ACTIVE'), hit AS (SELECT DISTINCT " + BUCKET + " AS bucket FROM scope)"


@query("mrg2_replace_by_touched_buckets", "target", "staging", "work_topics", "staging_topics", sql=SCOPED + f""" SELECT work_id, topic_id, {BUCKET} IN (SELECT bucket FROM hit) AS rewritten FROM (SELECT * FROM work_topics WHERE work_id NOT IN (FROM scope) UNION ALL SELECT * FROM staging_topics WHERE work_id IN (FROM scope))""")
def mrg2_buckets(t):
    store = stored(t, works=t["target"], work_topics=t["work_topics"])
    units.publish_unit(store, {"works": batch_of(t), "work_topics": t["staging_topics"]}, "v2")
    files = store.manifest().where("table_name = 'work_topics'").select("bucket", (F.col("version") == "v2").alias("rewritten"))
    return store.read("work_topics").withColumn("bucket", bucket_of("work_id", BUCKETS)).join(files, "bucket").select("work_id", "topic_id", "rewritten")


UNIT = MERGED + """, scope AS (SELECT work_id FROM d WHERE publication_decision IN ('INSERT','APPLY_UPDATE') AND source_activity_state='ACTIVE'),
 topics AS (SELECT * FROM work_topics WHERE work_id NOT IN (FROM scope) UNION ALL SELECT * FROM staging_topics WHERE work_id IN (FROM scope)),
 states AS (SELECT 'failed' AS phase, work_id, source_checksum_sha256 AS told FROM target UNION ALL SELECT 'published', work_id, source_checksum_sha256 FROM merged),
 tt AS (SELECT 'failed' AS phase, work_id, topic_id FROM work_topics UNION ALL SELECT 'published', work_id, topic_id FROM topics)
SELECT phase, 'works' AS table_name, work_id, told FROM states UNION ALL SELECT phase, 'work_topics', work_id, topic_id FROM tt"""


@query("mrg5_failure_between_tables", "target", "staging", "work_topics", "staging_topics", sql=UNIT)
def mrg5_failure(t):
    """What readers see after a failure between the tables of a unit, and after the same unit is tried again."""
    store = stored(t, works=t["target"], work_topics=t["work_topics"])

    def fail(name):
        raise InterruptedError(name)

    seen, staged = [], {"works": t["staging"], "work_topics": t["staging_topics"]}
    for phase, step in (("failed", fail), ("published", None)):
        try:
            units.publish_unit(store, staged, "v2", step)
        except InterruptedError:
            pass
        for name, column in (("works", "source_checksum_sha256"), ("work_topics", "topic_id")):
            seen.append(store.read(name).select(F.lit(phase).alias("phase"), F.lit(name).alias("table_name"), "work_id", F.col(column).alias("told")))
    return seen[0].unionByName(seen[1]).unionByName(seen[2]).unionByName(seen[3])


# --- lookups and releases ------------------------------------------------------------------------------------------


def lookup_files(t):
    """The lookup published in buckets, first with nothing and then with all active works."""
    files = LookupFiles(t["works"].sparkSession, new_folder(t["works"].sparkSession, "lookup"), 16)
    rows = writers.lookup_rows(t["works"], [c for c in lookups.WORK_COLUMNS if c in t["works"].columns])
    files.publish(rows.limit(0), "v1")
    files.publish(rows, "v2")
    return files


@query("q1_doi_lookup_by_bucket", "works", sql=RAW["q1_doi_work_lookup"])
def q1_bucket(t):
    return _plain(lookup_files(t).doi("10.5555/1003"))


@query("q2_work_lookup_by_bucket", "works", sql=RAW["q2_work_id_lookup"])
def q2_bucket(t):
    return _plain(lookup_files(t).work("W1001"))


@query("rel2_exact_parts", "works", "work_topics", sql="""WITH n AS (SELECT 'works' AS table_name, work_id, row_number() OVER (ORDER BY work_id) AS r FROM works UNION ALL SELECT 'work_topics', work_id, row_number() OVER (ORDER BY work_id, topic_id) FROM work_topics)
SELECT table_name, (r - 1) // 500 AS part, count(*) AS rows, min(work_id) AS low, max(work_id) AS high FROM n GROUP BY ALL""")  # fmt: skip
def rel2_exact(t):
    return release.render_exact_parts({n: t[n] for n in ("works", "work_topics")}, new_folder(t["works"].sparkSession, "release"), 500)


# --- marts by deltas ---------------------------------------------------------------------------------------------

# A mixed change of the tables: works of last digit 4 are new, of 8 they change (year, publisher, status, authors, topics), of 0 they
# are deleted, of 6 the deleted ones are active again. The same text runs in both engines.
OLD = {n: f"SELECT * FROM {n} WHERE work_id NOT LIKE '%4'" for n in ALL}
NEW = {n: f"SELECT * FROM {n}" for n in ALL} | {
    "works": """SELECT work_id, work_id_url, doi, title, CASE WHEN work_id LIKE '%8' THEN publication_year + 1 ELSE publication_year END AS publication_year, publication_date, work_type, language, cited_by_count, is_oa,
 CASE WHEN work_id LIKE '%8' THEN 'gold' ELSE oa_status END AS oa_status, primary_source_id, CASE WHEN work_id LIKE '%8' THEN 'P1' ELSE primary_publisher_id END AS primary_publisher_id, source_checksum_sha256, lineage_source_updated_date,
 CASE WHEN work_id LIKE '%0' THEN 'DELETED' WHEN work_id LIKE '%6' THEN 'ACTIVE' ELSE activity_state END AS activity_state FROM works""",
    "work_authors": "SELECT work_id, authorship_index, CASE WHEN work_id LIKE '%8' AND authorship_index = 0 THEN 'A1' ELSE author_id END AS author_id FROM work_authors",
    "work_topics": "SELECT * FROM work_topics WHERE NOT (work_id LIKE '%8' AND topic_id LIKE '%1')",
}


def mixed_change(t):
    """(tables before, tables after, changed works)."""
    spark = t["works"].sparkSession
    for n in ALL:
        t[n].createOrReplaceTempView(n)
    old, new = ({n: kept(spark.sql(text[n])) for n in ALL} for text in (OLD, NEW))
    return old, new, new["works"].where("work_id RLIKE '[0468]$'").select("work_id")


def by_deltas(mart):
    def run(t):
        old, new, changed = mixed_change(t)
        marts = {mart: gold.MARTS[mart](old)}
        counts = {mart: deltas.author_counts(old, mart)} if mart in deltas.AUTHORED else {}
        rows = deltas.refresh(marts, counts, deltas.part_of(old, changed), deltas.part_of(new, changed), new["works"])[0][mart]
        if mart != "research_discovery":
            return rows
        rows = rows.withColumn("publication_date", F.col("publication_date").cast("string"))
        return rows.select(*gold.DISCOVERY, LIST("author_ids"), LIST("topic_ids"), LIST("institution_ids"))

    return run


def over_new(name):
    """A mart's SQL over the tables after the change."""
    sql = re.sub(r"\b(" + "|".join(ALL) + r")\b", r"new_\1", RAW[name])
    defined = "WITH " + ", ".join(f"new_{n} AS ({NEW[n]})" for n in ALL)
    return f"{defined}, {sql[5:]}" if sql[:5].upper() == "WITH " else f"{defined} {sql}"


for _mart, _name in _MART_QUERIES.items():
    query(f"pub6_delta_{_mart}", *ALL, sql=over_new(_name))(by_deltas(_mart))


# --- streams -----------------------------------------------------------------------------------------------------


@query("str2_bucketed_state", "target", "ledger", "staging", sql=STATE + f" SELECT work_id, state, {BUCKET} AS bucket FROM st")
def str2_buckets(t):
    """The state after the target's and the ledger's deliveries, each work in its bucket's file."""
    state = run_stream(t, 1, 2)
    at = F.regexp_extract("_metadata.file_path", "bucket=([0-9]+)", 1).cast("int").alias("bucket")
    return state.store.read("state").select("work_id", "state", at)


@query("str5_marts_by_deltas", "target", "ledger", "staging", "works", sql=STATE + " SELECT publication_year, oa_status, count(*) AS work_count FROM works w JOIN st ON st.work_id=w.work_id WHERE st.state='ACTIVE' GROUP BY ALL")
def str5_deltas(t):
    """Open-access trends over works as they arrive and are deleted, kept up by deltas of each micro-batch."""
    spark, box = t["works"].sparkSession, {}
    facts = kept(t["works"].drop("activity_state"))
    empty = facts.withColumn("activity_state", F.lit("ACTIVE")).limit(0)
    box["marts"], box["seen"] = {"open_access_trends": kept(gold.open_access_trends({"works": empty}))}, spark.createDataFrame([], "work_id string, activity_state string")

    def old_new(changed, state):
        now = state.where("state IS NOT NULL").select("work_id", F.col("state").alias("activity_state"))
        before, box["next"] = box["seen"], kept(now)
        part = lambda states: {"works": facts.join(states.join(changed, "work_id", "left_semi"), "work_id")}
        return part(before), part(box["next"]), box["next"]

    def store(marts, counts):
        box["marts"], box["seen"] = {n: kept(df) for n, df in marts.items()}, box["next"]

    run_stream(t, 1, 2, after=ingest.deltas_after(old_new, lambda: (box["marts"], {}), store))
    return box["marts"]["open_access_trends"]



# --- entities ----------------------------------------------------------------------------------------------------


def described_parts(spark, sf_dir):
    """Descriptions of parts in orders: an asset for each ship year, dated by it but for one that is undated, in the order of orders."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate").distinct()
    seq = F.year("l_shipdate")
    place = F.row_number().over(Window.partitionBy("l_partkey", seq).orderBy("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"))
    name = F.when(F.col("l_suppkey") % 3 != 0, F.concat(F.lit("n"), (F.col("l_suppkey") % 2).cast("string")))
    rows = lines.select(F.concat(F.lit("E"), F.col("l_partkey").cast("string")).alias("entity_id"), seq.alias("seq"), place.alias("pos"), name.alias("name"), F.when(F.col("l_linenumber") > 3, F.lit("x")).alias("kind"))
    return rows.withColumn("date", F.when(F.col("seq") != 1995, F.make_date("seq", F.lit(1), F.lit(1))))


def folded_sql(first):
    """The ordered fold as a recursion over each entity's descriptions; conflicts count from asset first on."""
    return f"""WITH RECURSIVE k AS (SELECT 'E'||l_partkey AS entity_id, year(l_shipdate) AS seq, row_number() OVER (PARTITION BY l_partkey, year(l_shipdate) ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate) AS pos,
  CASE WHEN l_suppkey%3<>0 THEN 'n'||(l_suppkey%2) END AS name, CASE WHEN l_linenumber>3 THEN 'x' END AS kind FROM (SELECT DISTINCT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_shipdate FROM lineitem)),
 b AS (SELECT *, lag(name) OVER w AS name_before, lag(kind) OVER w AS kind_before FROM k WINDOW w AS (PARTITION BY entity_id, seq ORDER BY pos)),
 o AS (SELECT entity_id, seq, pos, CASE WHEN seq<>1995 THEN make_date(seq, 1, 1) END AS day, name, kind, row_number() OVER (PARTITION BY entity_id ORDER BY seq, pos) AS n
  FROM b WHERE pos=1 OR name IS DISTINCT FROM name_before OR kind IS DISTINCT FROM kind_before),
 f AS (SELECT entity_id, n, seq, pos, day, name, kind, 0 AS conflicts FROM o WHERE n=1
  UNION ALL SELECT entity_id, n+1, CASE WHEN takes THEN new_seq ELSE seq END, CASE WHEN takes THEN new_pos ELSE pos END, CASE WHEN takes THEN new_day ELSE day END,
   CASE WHEN clash THEN CASE WHEN takes THEN new_name ELSE name END ELSE coalesce(name, new_name) END, CASE WHEN clash THEN CASE WHEN takes THEN new_kind ELSE kind END ELSE coalesce(kind, new_kind) END,
   conflicts + CASE WHEN clash AND new_seq>={first} AND (new_day=day OR (new_day IS NULL AND day IS NULL)) THEN 1 ELSE 0 END
  FROM (SELECT *, CASE WHEN clash THEN coalesce(new_day>day, day IS NULL AND new_day IS NOT NULL) ELSE (name IS NULL AND new_name IS NOT NULL) OR (kind IS NULL AND new_kind IS NOT NULL) END AS takes
   FROM (SELECT f.*, o.seq AS new_seq, o.pos AS new_pos, o.day AS new_day, o.name AS new_name, o.kind AS new_kind, coalesce(f.name<>o.name, false) OR coalesce(f.kind<>o.kind, false) AS clash
    FROM f JOIN o ON o.entity_id=f.entity_id AND o.n=f.n+1)))
SELECT entity_id, name, kind, CAST(day AS VARCHAR) AS date, seq, pos, conflicts FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY n DESC) AS back FROM f) WHERE back=1"""


def _entity_rows(df):
    return df.select("entity_id", "name", "kind", F.col("date").cast("string").alias("date"), "seq", "pos", "conflicts")


@base_query("rec1_entity_fold", sql=folded_sql(0))
def rec1_fold(spark, sf_dir):
    return _entity_rows(entities.reconcile_entities(described_parts(spark, sf_dir), "entity_id", ["name", "kind"]))


@base_query("mrg4_entities_over_stored_ones", sql=folded_sql(1998))
def mrg4_stored(spark, sf_dir):
    """Earlier years are folded and stored; later ones are merged over them, and only their conflicts are counted."""
    rows = described_parts(spark, sf_dir)
    first = kept(entities.reconcile_entities(rows.where("seq < 1998"), "entity_id", ["name", "kind"]))
    return _entity_rows(entities.merge_dimension(first, rows.where("seq >= 1998"), "entity_id", ["name", "kind"]))


@base_query("rec1_entity_in_blocks", sql=folded_sql(0))
def rec1_blocks(spark, sf_dir):
    """The same fold where entities of more than 40 descriptions are cut into blocks, as a hot entity is."""
    return _entity_rows(entities.reconcile_entities(described_parts(spark, sf_dir), "entity_id", ["name", "kind"], block=40))


# --- assets that abort -------------------------------------------------------------------------------------------


@base_query("pub5_many_clashing_assets", sql="""WITH bad AS (SELECT DISTINCT o_custkey AS c FROM orders WHERE o_orderkey%11=0)
SELECT o_custkey+1 AS asset, 'W'||o_orderkey AS work_id, CASE WHEN b.c IS NULL AND o_orderkey%3=0 THEN 'new' ELSE 'old' END AS checksum, b.c IS NOT NULL AS left_out FROM orders LEFT JOIN bad b ON b.c=o_custkey""")  # fmt: skip
def pub5_many(spark, sf_dir):
    """A first asset has all works; then each customer's asset tells of its orders anew, some with another text of the same day."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    own = (F.col("o_custkey") + 1).cast("long")
    works = orders.select(F.concat(F.lit("W"), k.cast("string")).alias("work_id"), own.alias("asset"), k.cast("long").alias("pos"), F.to_date("o_orderdate").alias("day"), F.when(k % 11 == 0, "clash").when(k % 3 == 0, "new").otherwise("old").alias("checksum"), ((k % 11 != 0) & (k % 3 == 0)).cast("int").alias("later"))
    told = lambda seq, checksum, day: works.select("work_id", seq.alias("seq"), "pos", F.lit("work").alias("kind"), checksum.alias("checksum"), day.alias("lineage_date"), F.lit(None).cast("date").alias("work_date"))
    seen = told(F.lit(0).cast("long"), F.lit("old"), F.col("day")).unionByName(told(F.col("asset"), F.col("checksum"), F.date_add("day", F.col("later"))))
    folded, dropped = versions.fold_assets(kept(seen))
    out = spark.createDataFrame([(d,) for d in dropped], "asset long").withColumn("left_out", F.lit(True))
    return folded.select("work_id", "checksum").join(works.select("work_id", "asset"), "work_id").join(out, "asset", "left").select("asset", "work_id", "checksum", F.coalesce("left_out", F.lit(False)).alias("left_out"))
