"""Bucketed tables, publication of units, marts kept by deltas, keyed streaming state."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from folioforge.operators import deltas, facets, gold, lookups, release, units, versions
from folioforge.sources.buckets import BucketStore, LookupFiles, bucket_of
from folioforge.streaming import ingest
from tests import fixtures

DAY = date(2024, 1, 1)
WORKS = "work_id string, lineage_source_updated_date date, source_checksum_sha256 string, activity_state string, run_id string, processed_at string"
STATE = ["work_id", "state", "checksum", "lineage_date", "barrier"]


def works(spark, n):
    return spark.createDataFrame([(f"W{i}", DAY, f"c{i}", "ACTIVE", "r1", "p1") for i in range(n)], WORKS)


def store_of(spark, path, n=3000, buckets=400):
    store = BucketStore(spark, str(path / "store"), buckets)
    topics = spark.createDataFrame([(f"W{i}", f"T{i % 7}") for i in range(n)], "work_id string, topic_id string")
    store.commit({"works": (works(spark, n), None), "work_topics": (topics, None)}, "v1")
    return store


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_a_small_batch_rewrites_only_its_buckets(spark, tmp_path):
    store = store_of(spark, tmp_path)
    staged = [(f"W{i}", DAY + timedelta(1), "new", "ACTIVE", "r2", "p2") for i in range(0, 60, 4)] + [("W5", DAY, "c5", "ACTIVE", "r2", "p2"), ("W9", DAY - timedelta(1), "old", "ACTIVE", "r2", "p2"), ("W13", DAY, "clash", "ACTIVE", "r2", "p2"), ("W17", DAY, "gone", "DELETED", "r2", "p2"), ("W9000", DAY, "fresh", "ACTIVE", "r2", "p2")]
    batch = spark.createDataFrame(staged, WORKS)
    topics = spark.createDataFrame([(w, "T-new") for w, *_ in staged], "work_id string, topic_id string")
    old = {n: store.read(n) for n in ("works", "work_topics")}
    before = {n: set(store.files(n)) for n in old}
    decisions = units.publish_unit(store, {"works": batch, "work_topics": topics}, "v2")
    told = {r["work_id"]: r["publication_decision"] for r in decisions.collect()}
    assert (told["W5"], told["W9"], told["W13"], told["W17"], told["W9000"]) == ("IDENTICAL", "STALE", "CONFLICT", "APPLY_UPDATE", "INSERT")
    moved = {w for w, d in told.items() if d in ("INSERT", "APPLY_UPDATE", "IDENTICAL")}
    hit = {r["b"] for r in spark.createDataFrame([(w,) for w in moved], "w string").select(bucket_of("w", 400).alias("b")).collect()}
    after = set(store.files("works"))
    assert {f.rpartition("=")[2] for f in after - before["works"]} == {str(b) for b in hit} and len(after & before["works"]) >= 400 - len(hit) - 2
    assert {f.rpartition("=")[2] for f in before["work_topics"] - set(store.files("work_topics"))} <= {str(b) for b in hit}
    whole = versions.publication_decisions(batch, old["works"])
    assert rows_of(store.read("works")) == rows_of(versions.merge_works(old["works"], batch, whole))
    assert rows_of(store.read("work_topics")) == rows_of(versions.replace_by_work(old["work_topics"], topics, versions.relationship_scope(whole)))
    assert rows_of(store.read("works", version="v1")) == rows_of(old["works"])
    assert {(r["table_name"], r["version"]) for r in store.vacuum().collect()} == {("works", "v1"), ("work_topics", "v1")}


def test_lookups_open_one_bucket(spark, tmp_path):
    store = store_of(spark, tmp_path, 300, 20)
    assert [r["source_checksum_sha256"] for r in store.lookup("works", "W7").collect()] == ["c7"]
    assert len(store.lookup("works", "W7").inputFiles()) == 1
    assert store.lookup("works", "A").count() == 0 and store.lookup("works", "A").inputFiles() == []  # below every bucket's least key
    assert store.lookup("works", "W7x").count() == 0


def test_point_lookups_in_two_orders(spark, tmp_path):
    rows = spark.createDataFrame([(f"W{i}", None if i % 5 == 0 else f"10.1/{i % 90}") for i in range(100)], "work_id string, doi string")
    files = LookupFiles(spark, str(tmp_path / "lookup"), 8, bloom_keys=1000)
    files.publish(rows, "v1")
    assert [r["work_id"] for r in files.doi("10.1/3").collect()] == ["W3"] and len(files.doi("10.1/3").inputFiles()) == 1  # W93 has it as well
    assert [r["doi"] for r in files.work("W10").collect()] == [None]
    assert files.doi("9").count() == 0 and files.doi("9").inputFiles() == [] and files.work("W100x").count() == 0


def test_exact_parts(spark, tmp_path):
    rows = spark.range(103).selectExpr("concat('W', lpad(id, 3, '0')) AS work_id", "id AS n").repartition(7)
    one = release.render_exact_parts({"works": rows, "empty": rows.limit(0)}, str(tmp_path / "a"), 20)
    two = release.render_exact_parts({"works": rows.repartition(3)}, str(tmp_path / "b"), 20)
    assert [(r["part"], r["rows"], r["low"], r["high"]) for r in one.orderBy("part").collect()] == [(k, 20 if k < 5 else 3, f"W{20 * k:03}", f"W{min(20 * k + 19, 102):03}") for k in range(6)]
    assert rows_of(one) == rows_of(two)
    assert len(list((tmp_path / "a" / "works").glob("part=*/*.parquet"))) == 6


def test_a_failure_leaves_the_old_version(spark, tmp_path):
    store = store_of(spark, tmp_path, 50, 8)
    batch = works(spark, 20).withColumn("lineage_source_updated_date", F.date_add("lineage_source_updated_date", 1)).withColumn("source_checksum_sha256", F.lit("x"))
    topics = spark.createDataFrame([("W1", "T-new")], "work_id string, topic_id string")
    before = rows_of(store.read("works")), rows_of(store.read("work_topics"))

    def fail(name):
        if name == "works":
            raise InterruptedError

    with pytest.raises(InterruptedError):
        units.publish_unit(store, {"works": batch, "work_topics": topics}, "v2", fail)
    assert (rows_of(store.read("works")), rows_of(store.read("work_topics"))) == before and store.version() == "v1"
    with pytest.raises(ValueError, match="NULL"):
        units.publish_unit(store, {"works": batch, "work_topics": topics.withColumn("work_id", F.lit(None).cast("string"))}, "v2")
    with pytest.raises(ValueError, match="repeated"):
        units.publish_unit(store, {"works": batch.unionByName(batch)}, "v2")
    assert (rows_of(store.read("works")), rows_of(store.read("work_topics"))) == before
    units.publish_unit(store, {"works": batch, "work_topics": topics}, "v2")
    assert store.read("works").where("source_checksum_sha256 = 'x'").count() == 20
    now = rows_of(store.read("works"))
    units.publish_unit(store, {"works": batch, "work_topics": topics}, "v2")  # the same unit again
    assert rows_of(store.read("works")) == now


def test_marts_by_deltas_equal_a_rebuild(spark):
    old = fixtures.tables(spark)
    was = old["works"].columns
    changed = spark.createDataFrame([("W1",), ("W2",), ("W4",), ("W7",)], "work_id string")
    # W1 moves, W2 is active again, W4 is deleted, W7 is new, cites W4 and shares the last author of W4's journal
    new_works = old["works"].withColumn("activity_state", F.expr("CASE work_id WHEN 'W2' THEN 'ACTIVE' WHEN 'W4' THEN 'DELETED' ELSE activity_state END")).withColumn("publication_year", F.expr("IF(work_id = 'W1', NULL, publication_year)")).withColumn("primary_publisher_id", F.expr("IF(work_id = 'W1', 'P2', primary_publisher_id)"))
    extra = new_works.where("work_id = 'W1'").withColumn("work_id", F.lit("W7")).select(*was)
    add = lambda name, *rows: old[name].unionByName(spark.createDataFrame(list(rows), old[name].schema))
    new = {
        "works": new_works.select(*was).unionByName(extra),
        "work_authors": add("work_authors", ("W7", 0, "A1")).where("NOT (work_id = 'W1' AND author_id = 'A2')"),
        "work_topics": add("work_topics", ("W7", "T1"), ("W7", "T8")),
        "work_locations": add("work_locations", ("W7", 0, "S2", None, True)),
        "work_author_institutions": add("work_author_institutions", ("W7", 0, 0, "I9")),
        "work_references": add("work_references", ("W7", 0, "W4", "RESOLVED_ID"), ("W7", 1, None, "MISSING")),
    }
    marts, counts = deltas.start(old)
    out, after = deltas.refresh(marts, counts, deltas.part_of(old, changed), deltas.part_of(new, changed), new["works"])
    for name, build in gold.MARTS.items():
        assert rows_of(out[name]) == rows_of(build(new)), name
    for name in deltas.AUTHORED:
        assert rows_of(after[name].select("*")) == rows_of(deltas.author_counts(new, name)), name
    # and back again
    back, counts = deltas.refresh(out, after, deltas.part_of(new, changed), deltas.part_of({**old, "works": old["works"]}, changed), old["works"])
    assert rows_of(back["journal_author_stats"]) == rows_of(gold.journal_author_stats(old)) and rows_of(back["citation_edges"]) == rows_of(gold.citation_edges(old))


def test_ten_batches_equal_one_fold(spark, tmp_path):
    rng, seen = random.Random(5), []
    for k in range(10):
        for w in rng.sample(range(60), 6):
            late = DAY + timedelta(rng.randint(0, 9))
            seen.append((f"W{w}", k + 1, w, "work", f"c{k}-{w}", late, None) if rng.random() < 0.7 else (f"W{w}", k + 1, w, "deletion", f"d{k}", late, None))
    df = spark.createDataFrame(seen, ingest.OBSERVATION)
    state, written = ingest.StateTable(spark, str(tmp_path / "state"), buckets=200), []
    for k in range(10):
        batch = df.where(F.col("seq") == k + 1)
        before = {(r["bucket"], r["version"]) for r in state.store.manifest().collect()}
        state.apply(batch.unionByName(batch.limit(2)), k)
        state.apply(batch, k)  # delivered again
        now = {(r["bucket"], r["version"]) for r in state.store.manifest().collect()}
        hit = {r["b"] for r in batch.select(bucket_of("work_id", 200).alias("b")).collect()}
        assert {b for b, _ in now - before} <= hit and all(x in now for x in before if x[0] not in hit)  # works of an aborted delivery alone have no state
        written.append(len(now - before))
    assert max(written) <= 6
    whole, _ = versions.fold_assets(df)
    assert rows_of(state.read().select(*STATE)) == rows_of(whole.select(*STATE))
    assert state.outcomes().groupBy("work_id", "seq").count().where("count > 1").isEmpty()


def test_facets_by_index_equal_the_scan(spark, tmp_path):
    rng, rows = random.Random(3), []
    for i in range(230):
        pick = lambda *xs: rng.choice([None, *xs])
        rows.append((f"W{i:03}", pick("P1", "P2"), pick("S1"), pick("book", "article"), pick("en", "en", "fr"), pick("gold"), pick(1999, 2000, 2001), rng.sample(["T1", "T2", "T3"], rng.randint(0, 3)), [], ["A1"] * rng.randint(0, 2)))
    discovery = spark.createDataFrame(rows, "work_id string, primary_publisher_id string, primary_source_id string, work_type string, language string, oa_status string, publication_year int, topic_ids array<string>, institution_ids array<string>, author_ids array<string>")
    facets.build_facet_index(discovery, str(tmp_path / "index"), 20)
    index = facets.FacetIndex(spark, str(tmp_path / "index"))
    asked = [{"publisher_id": "P1"}, {"topic_id": "T2", "language": "en", "work_type": "book"}, {"author_id": "A1", "year_from": 2000}, {"year_to": 2000, "topic_id": "T1"}, {"institution_id": "I1"}, {}]
    for given in asked:
        after, pages = None, 0
        while True:
            want = lookups.search_research(discovery, after=after, limit=7, **given).collect()
            assert index.search(after=after, limit=7, **given).collect() == want, (given, after)
            pages += 1
            if len(want) <= 7 or pages == 4:
                break
            after = want[6]["work_id"]
    page = index.search(after="W105", limit=3, language="en")
    assert page.count() == 4 and index.opened == [5] and all("range=5" in f for f in page.inputFiles())
    assert index.search(publisher_id="P9").count() == 0 and index.search(after="W999", language="en").count() == 0
    with pytest.raises(ValueError):
        index.search(colour="red")
    facets.build_facet_index(discovery.limit(0), str(tmp_path / "empty"))
    assert facets.FacetIndex(spark, str(tmp_path / "empty")).search(language="en").columns == discovery.columns
