"""Published bundles, counts taken on the way, and source configuration."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from versemill.operators import cleaning
from versemill.plans import catalog, setup
from versemill.plans.harmonize import clean_pool
from versemill.session import stage_table
from versemill.sources import tables
from versemill.sources.config import SourceConfig

SF = "/root/testdata/sf0.001"


def test_bundle_versions_and_absent_split(spark, tmp_path):
    path = str(tmp_path / "bundle")
    rows = spark.range(10).selectExpr("id", "if(id < 7, 'train', 'test') as split", "array(id) as ids")
    words = spark.range(3).selectExpr("concat('w', id) as term")
    assert tables.bundle_versions(spark, path) == []
    assert tables.write_bundle(spark, path, {"rows": rows, "words": words}) == 1
    assert tables.write_bundle(spark, path, {"rows": rows.where("id > 5"), "words": words}) == 2
    assert tables.bundle_versions(spark, path) == [1, 2]
    assert tables.read_bundle(spark, path, "rows").count() == 4
    assert tables.read_bundle(spark, path, "rows", version=1).dtypes == rows.dtypes
    assert tables.read_bundle(spark, path, "rows", "train", 1).count() == 7
    absent = tables.read_bundle(spark, path, "rows", "eval")
    assert absent.count() == 0 and absent.columns == rows.columns
    assert tables.read_bundle(spark, path, "words").count() == 3
    for bad in (lambda: tables.read_bundle(spark, path, "other"), lambda: tables.read_bundle(spark, path, "rows", "dev")):
        with pytest.raises(ValueError):
            bad()


def test_half_a_bundle_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "bundle")
    good = spark.range(3).selectExpr("id", "'train' as split")
    tables.write_bundle(spark, path, {"rows": good})
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).cast("int").alias("x"))
    with pytest.raises(Exception, match="stop"):
        tables.write_bundle(spark, path, {"rows": good.where("id = 0"), "worse": broken})
    assert tables.bundle_versions(spark, path) == [1]
    assert tables.read_bundle(spark, path, "rows").count() == 3


def test_audit_of_a_run_equals_the_audit_query(spark):
    audit = cleaning.StageAudit()
    pool = clean_pool(setup.raw_sources(spark, SF), setup.GENRE_MAP, setup.LABEL2ID, audit=audit)
    counted = {(r["src"], r["stage"]): (r["n_before"], r["n_after"]) for r in audit.counts(spark).collect()}
    docs, talks = setup.documents(spark, SF), setup.conversations(spark, SF)
    lines = cleaning.stage_audit(docs, setup.DOCUMENTS).unionByName(cleaning.stage_audit(talks, setup.CONVERSATIONS))
    assert counted == {(r["src"], r["stage"]): (r["n_before"], r["n_after"]) for r in lines.collect()}
    assert pool.count() == clean_pool(setup.raw_sources(spark, SF), setup.GENRE_MAP, setup.LABEL2ID).count()


def test_sources_come_from_their_files():
    assert setup.DOCUMENTS.target_language == "en" and setup.CONVERSATIONS.language_col is None
    assert setup.DOCUMENTS.stop_words() == list(setup.STOP_WORDS)


def test_a_bare_stop_word_name_raises():
    assert SourceConfig("s").stop_words() == []
    with pytest.raises(ValueError, match="english"):
        SourceConfig("s", vectorizer_config={"stop_words": "english"}).stop_words()


def test_texts_that_lie_together_are_counted_by_many_tasks(spark, tmp_path, monkeypatch):
    parts = 2 * spark.sparkContext.defaultParallelism
    rows = spark.range(20 * parts).selectExpr("id AS doc_id", "concat('word', id % 7, ' other') AS text")
    rows.repartitionByRange(parts, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    splits = spark.range(20).selectExpr("id", "int(id % 2) AS label", "if(id < 15, 'train', 'test') AS split")
    written = []
    monkeypatch.setattr(setup, "stage_table", lambda df: written.append(df) or stage_table(df))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert setup.text_features(spark, str(tmp_path), splits).where("size(term_ids) = 3").count() == 20
        assert written[0].select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_both_versions_share_one_making_of_the_features(spark, tmp_path, monkeypatch):
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('word', id, ' other') AS text", "'en' AS lang", "concat('src', id % 18) AS source", "10L AS n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    talks = spark.range(40).selectExpr("id AS conv_id", "0L AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('talk', id, ' more') AS text")
    talks.write.parquet(f"{tmp_path}/conversations.parquet")
    features_made, tokens_made = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def counted(table, made):
        def passing(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        return table.mapInArrow(passing, table.schema)

    def encode(*args):
        data = encoded(*args)
        return replace(data, features=counted(data.features, features_made), tokens=counted(data.tokens, tokens_made))

    encoded = catalog.encode
    monkeypatch.setattr(catalog, "encode", encode)
    found = catalog.QUERIES["feature_bundle"](spark, str(tmp_path)).groupBy("version").count().collect()
    n = {r["version"]: r["count"] for r in found}
    assert 0 < n[1] < n[2]
    assert (features_made.value, tokens_made.value) == (n[2], n[2])
