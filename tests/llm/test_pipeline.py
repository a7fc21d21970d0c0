"""The pipeline's stages on a small fixture, and the queries against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioforge.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    clean = [f"the river and the hill of the town number {i} was by the sea for a while and then it is this place with an old mill " * 4 + f"end {i} " + " ".join(f"u{i}x{k}" for k in range(60)) for i in range(30)]
    leak = "one special benchmark passage with seventeen or more words that nobody would write by chance at any time"
    texts = [*clean, clean[0] + " tail", "### $$$ %%% !!! " * 60, clean[1] + " " + leak, None]
    rows = [(i, t, "en", "big" if i % 3 else "small", 0) for i, t in enumerate(texts)] + [(2, clean[2], "en", "big", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 30, 2)] + [(31, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        if i + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == corpus_pipeline.COLUMNS, name
        docs.write.parquet(f"{tmp_path}/out{i}")
        docs = spark.read.parquet(f"{tmp_path}/out{i}")
        kept.append(sorted(r["doc_id"] for r in docs.select("doc_id").collect()))
    assert set(kept[0]) == set(range(33)) - {31}  # junk and the empty one go
    assert kept[1] == [i for i in range(30)]  # copies go, one of each group stays; the leak's document is near document 1
    assert kept[2] == kept[1]
    assert set(kept[3]) == set(kept[2]) and len(kept[3]) > len(kept[2])
    assert sorted(kept[4]) == sorted(kept[3])
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == kept[4]


def test_decontamination_stage(spark, tmp_path):
    leak = " ".join(f"b{k}" for k in range(20))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "clean text", "en", "s", 0), (2, f"x {leak} y", "en", "s", 0), (None, leak, "en", "s", 0), (3, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()) == [1, 3]


def test_stages_tell_rows_without_an_id_apart(spark, tmp_path):
    clean = [f"the river and the hill of the town number {i} was by the sea for a while " + " ".join(f"u{i}x{k}" for k in range(80)) for i in range(34)]
    leak = " ".join(f"b{k}" for k in range(20))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(15)] + [(99, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    junk = "### $$$ %%% !!! " * 60

    def left(stage, rows):
        docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        return sorted([(r["doc_id"], r["text"]) for r in stage(spark, docs, str(tmp_path)).collect()], key=str)

    def want(rows):
        return sorted(rows, key=str)

    good = [(None, clean[0] + " and more"), (40, clean[1] + " and more")]
    got = left(corpus_pipeline.quality, [*enumerate(clean[:30]), *good, (99, junk), (None, junk), (None, ""), (40, junk)])
    assert [x for x in got if x[0] in (None, 40, 99)] == want(good)
    good = [(5, clean[0]), (5, clean[1]), (None, clean[2]), (None, clean[3]), (6, clean[4])]
    assert left(corpus_pipeline.near_dedup, [*good, (5, clean[0]), (None, clean[3]), (None, clean[4] + " tail"), (8, clean[1])]) == want(good)
    good = [(5, clean[0]), (None, clean[1])]
    assert left(corpus_pipeline.decontamination, [*good, (5, f"x {leak}"), (None, f"{leak} y")]) == want(good)
    assert left(corpus_pipeline.source_mix, good) == want(good)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda df: sorted(map(str, df[columns].itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


def test_operators_survive_odd_tables(spark):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "", "", 0), (1, "x " * 5, None, None, 1), (1, "x " * 5, None, None, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    from folioforge.llm import classifier, licenses, lmscore, mixing, neardup, quality_rules, secrets, sharding

    for run in (neardup.near_duplicates, sharding.assign_shards, mixing.mix, quality_rules.apply_rules, secrets.scan, lmscore.score, lambda d: classifier.classify(d, labels)):
        assert run(odd.withColumn("shard", F.lit("clash")).withColumn("copies", F.lit(1))).count() == 4
    assert licenses.scan_licenses(odd).count() == 0
