import datetime
import gzip
import hashlib
import json
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from folioforge.functions import scalars as S
from folioforge.operators import mapping, profiling, release
from folioforge.plans import bridge, io_queries, jobs, mapping_queries, registry, schemas
from folioforge.sources import readers, writers

SF = "/root/testdata/sf0.001"
WORK = {
    "id": "https://openalex.org/W1", "doi": "https://doi.org/10.1/ABC", "title": " T ", "publication_year": 2020, "publication_date": "2020-01-02", "type": "article",
    "open_access": {"is_oa": True, "oa_status": "gold"},
    "primary_location": {"source": {"id": "https://openalex.org/S1", "display_name": "J", "issn_l": "1234-567x", "host_organization": "https://openalex.org/P1", "host_organization_name": "Pub"}, "landing_page_url": "u"},
    "locations": [{"source": {"id": "S2"}, "landing_page_url": "x"}, {"source": {"id": "S1"}, "landing_page_url": "u", "license": "cc-by"}],
    "authorships": [{"author": {"id": "A1", "display_name": "Ann", "orcid": "https://orcid.org/0000-0000-0000-000x"}, "institutions": [{"id": "I1", "country_code": "us"}, {"id": None}]}, {"author": {}, "institutions": None}],
    "topics": [{"id": "T1", "score": 0.5}, {"id": "T1", "score": 0.9}], "keywords": [], "mesh": None, "referenced_works": ["W2", None, "bad", " "], "grants": [{"funder": "F1", "award_id": "a"}],
}


def raw(spark, *records):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "raw string")


def test_mapping_of_one_work(spark):
    p = mapping.parse_works(raw(spark, WORK))
    t = {n: [r.asDict() for r in df.collect()] for n, df in mapping.map_all(p).items()}
    w = t["works"][0]
    assert (w["work_id"], w["doi"], w["title"], w["primary_source_id"], w["primary_publisher_id"]) == ("W1", "10.1/abc", "T", "S1", "P1")
    assert (w["keywords_presence"], w["mesh_presence"], w["topics_presence"]) == ("EMPTY", "NULL", "PRESENT")
    assert [r["is_primary"] for r in sorted(t["work_locations"], key=lambda r: r["location_index"])] == [False, True]
    assert [(r["referenced_work_id"], r["reference_status"]) for r in sorted(t["work_references"], key=lambda r: r["reference_index"])] == [("W2", "RESOLVED_ID"), (None, "MISSING"), (None, "MALFORMED"), (None, "MISSING")]
    assert t["work_topics"] == [{"work_id": "W1", "topic_id": "T1", "score": 0.5}]
    assert [r["author_id"] for r in t["work_authors"]] == ["A1", None] and t["authors"][0]["orcid"] == "0000-0000-0000-000X"
    assert [r["institution_id"] for r in t["work_author_institutions"]] == ["I1", None] and t["institutions"][0]["country_code"] == "US"
    assert {r["source_id"] for r in t["sources"]} == {"S1", "S2"} and t["publishers"][0]["display_name"] == "Pub"
    assert t["work_mesh"] == [] and t["work_keywords"] == [] and t["work_grants"][0]["funder_id"] == "F1"
    assert mapping.split_errors(p)[1].count() == 0


def test_fallback_location_and_errors(spark):
    alone = {k: v for k, v in WORK.items() if k != "locations"}
    rows = mapping.work_locations(mapping.parse_works(raw(spark, alone))).collect()
    assert [(r["location_origin"], r["is_primary"], r["source_id"]) for r in rows] == [("PRIMARY_LOCATION_FALLBACK", True, "S1")]
    bad = [{**WORK, "id": "A1"}, {**WORK, "doi": "a b"}, {**WORK, "publication_year": True}, {**WORK, "publication_date": "2020-1-2"}, {**WORK, "topics": {}}, {**WORK, "mesh": [{}]}, "[1]", "nonsense", {**WORK, "grants": [{"funder": "X"}]}]
    errors = [r["errors"] for r in mapping.split_errors(mapping.parse_works(raw(spark, *bad)))[1].collect()]
    assert sorted(e[0] for e in errors) == sorted(["id", "doi", "publication_year", "publication_date", "topics", "mesh", "record", "record", "grant"])


def test_jsonl_and_ledger_scans(spark, tmp_path):
    with gzip.open(tmp_path / "w.gz", "wt") as f:
        f.write('{"id":"W1"}\n\n{"id":"W1"\n[1]\n')
    rows = readers.read_works_jsonl(spark, str(tmp_path / "w.gz")).orderBy("pos").collect()
    assert [r["error"] for r in rows] == [None, "MALFORMED_JSON", "NOT_AN_OBJECT"]
    lines = readers.read_works_jsonl(spark, str(tmp_path / "w.gz"))
    assert readers.check_decode_bounds(lines, records=3).count() == 0
    assert readers.check_decode_bounds(lines, records=2).first()["bound"] == "TOO_MANY_RECORDS"
    with gzip.open(tmp_path / "d.csv.gz", "wt") as f:
        f.write("work_id,deleted_date\nW1,2024-01-01\n\nhttps://openalex.org/W2,2024-02-30\nX,2024-01-01\nW3\n")
    rows = readers.read_deletions(spark, str(tmp_path / "d.csv.gz")).orderBy("pos").collect()
    assert [(r["work_id"], r["error"]) for r in rows] == [("W1", None), ("W2", "BAD_DATE"), (None, "BAD_ID"), ("W3", "BAD_COLUMNS")]


def test_manifest_scan(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"date": "2024-01-01", "format": "jsonl", "entity": "works", "files": [{"url": "s3://b/updated_date=2024-01-05/p.gz", "meta": {"content_length": 5, "record_count": 1}}, {"url": "s3://b/p2.gz", "meta": {"content_length": -5, "record_count": 1}}]}, indent=1))
    rows = readers.read_manifest(spark, str(tmp_path / "m.json")).orderBy("file_uri").collect()
    assert [r["error"] for r in rows] == ["NEGATIVE_COUNT", None] and str(rows[1]["updated_date"]) == "2024-01-05" and rows[1]["asset_id"].startswith("oa-")


def test_exact_schema(spark):
    df = spark.createDataFrame([], schemas.schema("topics"))
    assert readers.require_table(df, "topics") is df
    with pytest.raises(ValueError):
        readers.require_table(df.drop("deleted_at"), "topics")


def test_append_log_and_publish(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 1)], "k string, v int")
    for _ in range(2):
        writers.append_log(df, str(tmp_path / "log"), ["k"])
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    works = spark.createDataFrame([("W1", "ACTIVE"), ("W2", "DELETED")], "work_id string, activity_state string")
    assert writers.publish_lookup(works, str(tmp_path / "lookup"), ["work_id"])["written"]
    assert not writers.publish_lookup(works.repartition(3), str(tmp_path / "lookup"), ["work_id"])["written"]
    with pytest.raises(ValueError):
        writers.publish_lookup(works.union(works), str(tmp_path / "lookup"), ["work_id"])


def test_partitioned_warehouse(spark, tmp_path):
    works = spark.createDataFrame([("W1", None, 2020, None, None), ("W2", None, None, None, None)], "work_id string, doi string, publication_year int, primary_publisher_id string, primary_source_id string")
    writers.write_warehouse({"works": works}, str(tmp_path))
    back = spark.read.parquet(str(tmp_path / "works"))
    assert {r["work_id"]: r["publication_year"] for r in back.collect()} == {"W1": 2020, "W2": None}


def test_profiles(spark, tmp_path):
    p = profiling.json_field_profile(raw(spark, '{"a":1,"m":{"x":[1]}}', '{"a":null,"m":{"y":[2,3]},"b":"t"}', "{bad"), frozenset({"m"}))
    seen = {(r["path"], r["kind"]): r["present"] for r in p.collect()}
    assert seen["a", "integer"] == 1 and seen["a", "null"] == 1 and seen["m.{value}[]", "integer"] == 3 and seen["<invalid>", "invalid"] == 1
    assert {r["path"]: r["missing"] for r in profiling.missing_counts(p).collect()}["b"] == 1
    (tmp_path / "x.txt").write_text("a\n\nb")
    r = profiling.line_counts(spark, str(tmp_path / "x.txt")).first()
    assert (r["records"], r["blank"], r["unterminated"]) == (2, 1, True)


def test_profile_of_deep_wide_and_odd_records(spark):
    deep = {"z": 1.5}
    for _ in range(2 * profiling.LEVELS + 1):
        deep = {"n": deep}
    wide, none = {f"k{i}": i for i in range(3000)}, spark.createDataFrame([(None,)], "raw string")
    p = profiling.json_field_profile(raw(spark, deep, {"w": wide}, '{"a":1,"a":2}', "[]", "null", '[[1],{"b":12345678901234567890}]', '{"c":[{},[],1.0,true]}').unionByName(none))
    seen = {(r["path"], r["kind"]): r["present"] for r in p.collect()}
    assert seen[".".join(["n"] * (2 * profiling.LEVELS + 1) + ["z"]), "number"] == 1 and seen["n.n.n.n.n.n.n.n", "object"] == 1
    assert sum(path.startswith("w.k") for path, _ in seen) == 3000 and seen["w", "object"] == 1
    assert seen["<invalid>", "invalid"] == 1 and seen["", "null"] == 1 and seen["", "array"] == 2 and seen["", "object"] == 3
    assert seen["[][]", "integer"] == 1 and seen["[].b", "integer"] == 1
    assert [seen["c[]", k] for k in ("object", "array", "number", "boolean")] == [1, 1, 1, 1]
    assert "Python" not in p._jdf.queryExecution().toString() and profiling.json_field_profile(none).count() == 0


def test_bounds_hold_while_reading(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"a":1}\r\n\n   \n{"b":22}\n{"c":3}')
    with gzip.open(tmp_path / "b c.gz", "wb") as f:
        f.write(b"x" * 3_000_000 + b"\nabc\n")
    facts = lambda **k: [tuple(r)[1:] for r in readers.stream_bounds(spark, str(tmp_path), **k).orderBy("asset").collect()]
    assert facts() == [(3, 25, 8, None), (2, 3_000_005, 3_000_000, None)]
    assert facts(record_bytes=8) == [(3, 25, 8, None), (0, 0, 0, "RECORD_TOO_LARGE")]
    assert [r[3] for r in facts(records=2)] == ["TOO_MANY_RECORDS", None] and [r[3] for r in facts(asset_bytes=24)] == ["ASSET_TOO_LARGE", "ASSET_TOO_LARGE"]
    assert [r["raw"] for r in readers.read_works_jsonl(spark, str(tmp_path / "b c.gz"), 100).collect()] == ["abc"]
    sums = {r["asset"].rsplit("/", 1)[-1]: (r["checksum"], r["bytes"]) for r in profiling.asset_checksums(spark, str(tmp_path)).collect()}
    assert sums == {p.name: (hashlib.sha256(p.read_bytes()).hexdigest(), p.stat().st_size) for p in tmp_path.iterdir()}


def test_an_asset_beyond_a_bound_is_left_out_and_told(spark, tmp_path):
    long = {**WORK, "id": "https://openalex.org/W77", "title": "t" * 5000}
    for name, records in (("a", [WORK]), ("b", [long, {**WORK, "id": "https://openalex.org/W78"}])):
        with gzip.open(tmp_path / f"{name}.gz", "wt") as f:
            f.write("".join(json.dumps(r) + "\n" for r in records))
    good, bad, _ = jobs.observe_works(spark, str(tmp_path), limits={"record_bytes": 4000})
    assert good.count() == 1 and [(r["asset"].rsplit("/", 1)[-1], r["errors"]) for r in bad.collect()] == [("b.gz", ["RECORD_TOO_LARGE"])]
    assert jobs.observe_works(spark, str(tmp_path))[0].count() == 3


def test_canonical_json_and_case_folding(spark):
    odd = '\u00e9"\\u00E9\x7f\x1f\U0001f600/\\\n'
    df = spark.createDataFrame([(odd, None, {"b": 1, "a": None}, [(2, "x")]), (None, None, {}, [])], "t string, n int, m map<string,int>, s array<struct<z:int,a:string>>")
    texts = [r[0] for r in df.select(S.canonical_json(df, "t", "n", "m", "s")).collect()]
    want = [{"t": odd, "n": None, "m": {"b": 1, "a": None}, "s": [{"z": 2, "a": "x"}]}, {"t": None, "n": None, "m": {}, "s": []}]
    assert texts == [json.dumps(w, sort_keys=True, separators=(",", ":")) for w in want]
    words = "Stra\u00dfe \ufb01n \u017fo \u1e9e \u0149 \u1e96x \ufb06e A\u00e9b"
    fold = re.sub(r"[^0-9a-z]+", " ", words.casefold()).split()
    assert spark.createDataFrame([(words,)], "t string").select(S.tokens(F.col("t"))).first()[0] == fold


def test_masking_violations_at_every_depth(spark):
    policy = {"p[].name": "mask_person", "p[].fee.{value}": "mask_price", "t": "replace_text", "m{key}": "replace_text", "m.{value}": "keep"}
    kind = "p array<struct<name:string,fee:map<string,int>>>, t string, m map<string,string>"
    clean = spark.createDataFrame([([("Ann", {"a": 5}), (None, None)], "hello", {"k": "v"}), (None, None, None)], kind)
    masked = profiling.redact(clean, policy)
    assert [tuple(r) for r in profiling.masking_violations(masked, policy).collect()] == [("m{key}", "replace_text", 1)]  # redact keeps keys
    broken = {(r[0], r[1]): r[2] for r in profiling.masking_violations(clean.unionByName(spark.createDataFrame([([], "a@b.org", {"x": "c@d.org"})], kind)), policy).collect()}
    assert broken == {("p[].name", "mask_person"): 1, ("p[].fee.{value}", "mask_price"): 1, ("t", "replace_text"): 2, ("t", "email"): 1, ("m{key}", "replace_text"): 1, ("m.{value}", "email"): 1}
    assert profiling.masking_violations(clean.limit(0), policy).count() == 0
    assert ("t", "no_rule") in {(r[0], r[1]) for r in profiling.masking_violations(clean, {k: v for k, v in policy.items() if k != "t"}).collect()}


def test_default_pick(spark):
    kind = "asset_id string, entity string, format string, byte_size long, updated_date date, file_uri string, record_count long"
    rows = [("a", "works", "jsonl", 5, None, "u1", 1), ("b", "works", "jsonl", 5, datetime.date(2024, 1, 1), "u0", 2), ("c", "works", "jsonl", 50, None, "u2", 3), ("d", "works", "csv", 1, None, "u3", 4), ("e", "works", "jsonl", None, None, "u4", 5)]
    r = profiling.manifest_pick(spark.createDataFrame(rows, kind), 10).first()
    assert (r["listed"], r["eligible"], r["oversized"], r["unknown_size"], r["picked_uri"], r["picked_records"], r["size_median_low"]) == (5, 2, 1, 1, "u1", 1, 5)
    none = profiling.manifest_pick(spark.createDataFrame([], kind), 10).first()
    assert none["listed"] == 0 and none["picked_uri"] is None


def test_release_round_trip(spark, tmp_path):
    t = {"topics": spark.createDataFrame([(f"T{i}", "u", "d") for i in range(25)], "topic_id string, topic_id_url string, display_name string"), "empty": spark.createDataFrame([], "k string")}
    manifest = jobs.build_release(t, str(tmp_path / "r"), rows_per_part=10)
    assert release.validate_release(spark, str(tmp_path / "r"), manifest).count() == 0
    assert release.part_counts(spark, str(tmp_path / "r"), ["topics"]).agg({"rows": "max"}).first()[0] <= 10


def test_full_pipeline(spark, tmp_path):
    folder = tmp_path / "in" / "updated_date=2024-01-01"
    folder.mkdir(parents=True)
    refs = {"W1": ["W2"], "W2": [], "W3": ["W1"]}
    with gzip.open(folder / "part.gz", "wt") as f:
        for w, r in refs.items():
            f.write(json.dumps({**WORK, "id": w, "doi": f"10.1/{w}", "referenced_works": r}) + "\n")
    with gzip.open(tmp_path / "gone.csv.gz", "wt") as f:
        f.write("work_id,deleted_date\nW2,2024-02-01\nW9,2024-02-01\n")
    report = jobs.run_pipeline(spark, f"{tmp_path}/in/*/*.gz", f"{tmp_path}/gone.csv.gz", str(tmp_path / "out"), "run1")
    assert report["published"] and report["counts"]["research_discovery"] == 2 and report["counts"]["citation_edges"] == 2
    barriers = spark.read.parquet(f"{tmp_path}/out/runs/run1/barriers")
    assert {r["work_id"] for r in barriers.collect()} == {"W2", "W9"}


def test_ledgers_count_apart(spark, tmp_path):
    """Two ledgers with two dates for a work both count, in their order; one that contradicts itself goes, is reported, and stops publication."""
    works = tmp_path / "in" / "updated_date=2024-01-01"
    works.mkdir(parents=True)
    with gzip.open(works / "part.gz", "wt") as f:
        for w in ("W1", "W2", "W3"):
            f.write(json.dumps({**WORK, "id": w, "doi": f"10.1/{w}", "referenced_works": []}) + "\n")

    def ledger(day, *rows):
        folder = tmp_path / "gone" / f"updated_date={day}"
        folder.mkdir(parents=True)
        (folder / "l.csv").write_text("\n".join(["work_id,deleted_date", *rows]) + "\n")

    ledger("2024-03-01", "W1,2024-02-01", "W9,2024-02-01")
    ledger("2024-02-15", "W1,2024-02-02", "W1,2024-02-02")
    tables, _, _ = jobs.ingest_works(spark, f"{tmp_path}/in/*/*.gz", f"{tmp_path}/gone/*")
    assert tables["rejected_ledgers"].count() == 0
    assert {(r["work_id"], r["activity_state"], str(r["lineage_source_updated_date"])) for r in tables["works"].collect()} == {("W1", "DELETED", "2024-02-02"), ("W2", "ACTIVE", "2024-01-01"), ("W3", "ACTIVE", "2024-01-01")}
    seqs = {r["seq"]: r["kind"] for r in tables["observed"].collect()}
    assert [seqs[k] for k in sorted(seqs)] == ["work", "deletion", "deletion"]
    ledger("2024-04-01", "W2,2024-02-01", "W2,2024-02-03")
    tables, _, _ = jobs.ingest_works(spark, f"{tmp_path}/in/*/*.gz", f"{tmp_path}/gone/*")
    assert [r["error"] for r in tables["rejected_ledgers"].collect()] == ["DATE_CONFLICT"]
    assert {r["work_id"] for r in tables["works"].where("activity_state = 'DELETED'").collect()} == {"W1"}
    report = jobs.run_pipeline(spark, f"{tmp_path}/in/*/*.gz", f"{tmp_path}/gone/*", str(tmp_path / "out"), "run1")
    assert not report["published"] and report["failed"] == ["ingest.deletion_ledgers"] and "2024-04-01" in report["rejected_ledgers"][0]


def test_a_query_writes_works_within_the_bounds_of_an_asset(spark, monkeypatch):
    monkeypatch.setattr(io_queries, "ASSET_WORKS", 100)
    folder = io_queries.works_file(bridge.tables(spark, SF, *mapping_queries.RELATIONS))
    facts = readers.stream_bounds(spark, folder, records=100)
    assert facts.where("bound IS NOT NULL").isEmpty() and facts.agg(F.sum("records")).first()[0] == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_manifests_list_a_bounded_number_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(io_queries, "MANIFEST_FILES", 100)
    monkeypatch.setattr(io_queries, "new_folder", lambda *_: str(tmp_path / "manifests"))
    files = registry.QUERIES["src4_manifest_scan"](spark, SF)
    written = spark.read.json(str(tmp_path / "manifests"), multiLine=True).select(F.size("files").alias("n"))
    assert written.agg(F.max("n")).first()[0] <= 100 and files.count() == written.agg(F.sum("n")).first()[0] == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_raw_records_bring_each_line_to_its_work_once(spark):
    """Exchanges with and without their sides: orders and lines by work, customers and parts by their keys."""
    plan = mapping_queries.raw_works(bridge.tables(spark, SF, *mapping_queries.RELATIONS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 6


def test_a_record_is_parsed_once_for_its_items(spark):
    parsed = mapping.parse_works(raw(spark, WORK))
    for name, table in mapping.map_all(parsed).items():
        if name not in ("works", "work_locations", "sources", "publishers"):  # these ask for several parts of the record, and it stays one column
            assert "size(from_json" not in table._jdf.queryExecution().optimizedPlan().toString(), name


def test_keywords_of_a_line_with_another_work(spark, tmp_path):
    """Repeated lines, a part without a row, keywords that move to a work that stands and to one that does not."""
    day = datetime.datetime(2024, 1, 2)
    spark.createDataFrame([(k, 1, "O", 10.5, day, "1-URGENT") for k in (1, 2, 3, 90000001)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    lines = [(1, 97, 4, 1), (1, 97, 4, 1), (1, 5, 12, 1), (1, 194, 29, 2), (2, 194, 3, 1), (90000001, 6, 60, 1), (7, 5, 1, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(5, "Brand#11"), (97, "Brand#12"), (194, "Brand#11")], "p_partkey long, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    for name in set(bridge.BASE) - {"orders", "lineitem", "part"}:
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    for name in bridge.BASE:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name in ("map3_work_authors", "map5_work_topics", "map6_work_keywords", "map7_work_mesh", "map8_work_references", "map9_work_locations", "map11_work_grants"):
        got = registry.QUERIES[name](spark, str(tmp_path)).toPandas()
        want = con.sql(registry.ORACLES[name]).df()[list(got.columns)]
        told = lambda df: sorted(tuple("NULL" if v is None or v != v else str(v) for v in r) for r in df.itertuples(index=False, name=None))
        assert told(got) == told(want), name


def test_a_query_writes_ledgers_within_their_bound(spark, tmp_path):
    """One task holds more ids than a ledger may have."""
    rows = spark.range(readers.LEDGER_IDS + 1, numPartitions=1).selectExpr("concat('W', id) AS work_id", "DATE '2024-01-01' AS deleted_date")
    seen, bad = jobs.ingest_deletions(spark, io_queries.ledger_files(rows, str(tmp_path / "ledger")))
    assert bad.count() == 0 and seen.count() == readers.LEDGER_IDS + 1


def test_named_query_binds_values(spark):
    t = {"works_named": spark.createDataFrame([("W1", 2020), ("W2", None)], "work_id string, y int")}
    text = "SELECT work_id FROM works_named WHERE (:y IS NULL OR y >= :y)"
    assert jobs.named_query(spark, text, {"y": None}, t).count() == 2 and jobs.named_query(spark, text, {"y": 2000}, t).count() == 1
    with pytest.raises(TypeError):
        jobs.named_query(spark, text, {"y": [1]}, t)
