"""The six-work fixture, as rows."""

WORKS = [
    ("W1", "10.1/aaa", "Alpha", 2020, "gold", "S1", "P1", "ACTIVE"),
    ("W2", "10.1/bbb", "Beta", 2021, "closed", "S1", "P1", "DELETED"),
    ("W3", None, "Gamma", 2020, "green", "S2", "P2", "ACTIVE"),
    ("W4", "10.1/ccc", "Delta", 2019, "closed", "S1", "P1", "ACTIVE"),
    ("W5", "10.1/ddd", None, None, None, "S3", "P3", "ACTIVE"),
    ("W6", "10.1/eee", "Zeta", 2022, "closed", "S4", "P4", "ACTIVE"),
]
AUTHORS = [("W1", 0, "A1"), ("W1", 1, "A2"), ("W1", 2, "A1"), ("W2", 0, "A1"), ("W3", 0, "A2"), ("W3", 1, "A3"), ("W4", 0, "A1"), ("W5", 0, None)]
TOPICS = [("W1", "T1"), ("W1", "T2"), ("W1", "T3"), ("W2", "T1"), ("W3", "T2"), ("W4", "T1"), ("W5", "T9")]
LOCATIONS = [("W1", 0, "S1", "cc-by", True), ("W1", 1, "S9", "cc-by-nc", False), ("W1", 2, "S1", "other", False), ("W3", 0, "S2", None, True), ("W4", 0, "S1", "cc-by", True), ("W5", 0, "S3", "cc0", True), ("W2", 0, "S1", "cc-by", True)]
INSTITUTIONS = [("W1", 0, 0, "I1"), ("W1", 1, 0, "I1"), ("W1", 1, 1, "I2"), ("W3", 0, 0, "I1"), ("W2", 0, 0, "I1"), ("W4", 0, 0, "I2")]
REFERENCES = [("W1", 0, "W2", "RESOLVED_ID"), ("W1", 1, "W999", "RESOLVED_ID"), ("W1", 2, None, "MISSING"), ("W2", 0, "W3", "RESOLVED_ID"), ("W4", 0, "W1", "RESOLVED_ID")]


def tables(spark):
    df = spark.createDataFrame
    works = df(WORKS, "work_id string, doi string, title string, publication_year int, oa_status string, primary_source_id string, primary_publisher_id string, activity_state string")
    works = works.selectExpr("*", "CAST(NULL AS date) AS publication_date", "'article' AS work_type", "'en' AS language", "true AS is_oa", "DATE '2024-01-01' AS lineage_source_updated_date", "'r1' AS run_id")
    return {
        "works": works,
        "work_authors": df(AUTHORS, "work_id string, authorship_index int, author_id string"),
        "work_topics": df(TOPICS, "work_id string, topic_id string"),
        "work_locations": df(LOCATIONS, "work_id string, location_index int, source_id string, license string, is_primary boolean"),
        "work_author_institutions": df(INSTITUTIONS, "work_id string, authorship_index int, institution_index int, institution_id string"),
        "work_references": df(REFERENCES, "work_id string, reference_index int, referenced_work_id string, reference_status string"),
    }
