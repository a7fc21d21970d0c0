import pytest

from folioforge.operators import gold, lookups, quality
from tests.fixtures import tables


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def test_marts_of_the_six_works(spark):
    t = tables(spark)
    discovery = {r["work_id"]: r for r in gold.research_discovery(t).collect()}
    assert set(discovery) == {"W1", "W3", "W4", "W5", "W6"}
    assert (discovery["W1"]["author_ids"], discovery["W1"]["topic_ids"], discovery["W1"]["institution_ids"]) == (["A1", "A2"], ["T1", "T2", "T3"], ["I1", "I2"])
    assert discovery["W6"]["author_ids"] == discovery["W6"]["topic_ids"] == discovery["W6"]["institution_ids"] == []
    assert ("S1", 2, 2) in rows(gold.journal_author_stats(t))
    assert ("P1", 2, 2) in rows(gold.publisher_author_stats(t))
    years = rows(gold.publisher_topic_year_stats(t).where("publisher_id = 'P1' AND topic_id = 'T1'"))
    assert years == [("P1", "T1", 2019, 1), ("P1", "T1", 2020, 1)]
    licenses = [tuple(r) for r in gold.publisher_topic_license_year_stats(t).collect()]
    assert not any(r[2] == "cc-by-nc" for r in licenses) and ("P2", "T2", None, 2020, 1) in licenses
    assert ("I1", "T1", 1) in rows(gold.institution_topic_stats(t))
    assert (None, 1) in [tuple(r) for r in gold.publication_trends(t).collect()]
    oa = [tuple(r) for r in gold.open_access_trends(t).collect()]
    assert (None, None, 1) in oa and not any(r[0] == 2021 for r in oa)
    edges = gold.citation_edges(t).orderBy("source_work_id", "reference_index").collect()
    assert [r["target_activity_state"] for r in edges if r["source_work_id"] == "W1"] == ["DELETED", None, None]
    assert all(r["source_work_id"] != "W2" for r in edges)


def test_lookups(spark):
    t = tables(spark)
    assert lookups.doi_work_lookup(t, "10.1/bbb").count() == 0  # deleted
    assert lookups.work_id_lookup(t, "W1").first()["doi"] == "10.1/aaa"
    assert lookups.unique_authors_per_journal(t, "nowhere").first()["unique_author_count"] == 0
    assert rows(lookups.publisher_topic_counts(t, "P1"), "topic_id", "work_count") == [("T1", 2), ("T2", 1), ("T3", 1)]
    bounded = lookups.publication_trends(t, 2020, 2022).collect()
    assert [tuple(r) for r in bounded] == [(2020, 2), (2022, 1)]
    with pytest.raises(ValueError):
        lookups.years_between(t["works"], 12, None)
    with pytest.raises(ValueError):
        lookups.get_work(gold.research_discovery(t), "W1", "10.1/aaa")


def test_keyset_pages_cover_everything_once(spark):
    df = spark.createDataFrame([(y, f"T{i}") for i, y in enumerate([2020, None, 2019, 2020, None, 2021, 2019])], "publication_year int, topic_id string")
    seen, after = [], None
    while True:
        page = [tuple(r) for r in lookups.keyset_page(df, ["publication_year", "topic_id"], after, 2).collect()]
        seen += page[:2]
        if len(page) <= 2:
            break
        after = page[1]
    assert seen == sorted([tuple(r) for r in df.collect()], key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_fan_out_safe(spark):
    from folioforge.operators.aggregates import fanout_audit

    r = fanout_audit(tables(spark)).where("work_id = 'W1'").first()
    assert (r["unsafe_rows"], r["author_count"], r["topic_count"]) == (9, 2, 3)


def test_quality_gates(spark):
    t = tables(spark)
    results, allowed = quality.run_checks(t, quality.PRE_BUILD)
    status = {r["check_id"]: r["status"] for r in results.collect()}
    assert not allowed and status["works.work_id_unique"] == "PASS" and status["ingest.decode_balance"] == "ERROR"
    twice = {**t, "works": t["works"].union(t["works"].where("work_id = 'W1'"))}
    assert quality.work_id_unique(twice).first()["status"] == "FAIL"
    assert not quality.run_checks(t, quality.PRE_BUILD, ["metric.missing_doi"])[1]
    assert not quality.run_checks(t, quality.PRE_BUILD, ["no.such"])[1]
    staged = {"staged_manifest": gold.mart_manifest(spark), "staged_contributions": gold.work_contributions(t), "staged_edges": gold.citation_edges(t)}
    assert quality.run_checks({**t, **staged}, quality.PRE_PUBLISH)[1]
    bad = {**staged, "staged_manifest": staged["staged_manifest"].limit(8)}
    assert not quality.run_checks({**t, **bad}, quality.PRE_PUBLISH)[1]
    refs = {r["category"]: r["reference_count"] for r in quality.reference_reconciliation(t).collect()}
    assert refs == {"REFERENCE_MISSING": 1, "REFERENCE_MALFORMED": 0, "TARGET_ACTIVE": 1, "TARGET_DELETED": 1, "TARGET_ABSENT": 1}
