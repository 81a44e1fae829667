"""Scans and persisted tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from versemill.session import stage_table
from versemill.sources import tables


def test_csv_with_line_breaks(spark, tmp_path):
    path = tmp_path / "lyrics.csv"
    path.write_text('key,lyrics,genre\n1,"a ""b""\nc, d",rap\n2,plain,rock\n')
    df = tables.scan_source(spark, str(path), 3, F.col("key"), "key long, lyrics string, genre string", "csv")
    rows = df.orderBy("id").collect()
    assert rows[0]["lyrics"] == 'a "b"\nc, d' and rows[0]["src"] == 3 and rows[1]["id"] == 2
    with pytest.raises(ValueError):
        tables.scan_source(spark, str(path), 3, F.col("key"), fmt="csv")


def test_splits_round_trip_and_absent_split(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "if(id < 7, 'train', 'test') as split")
    path = str(tmp_path / "splits")
    tables.write_splits(df, path)
    assert tables.read_split(spark, path, "train").count() == 7
    assert tables.read_split(spark, path, "eval").count() == 0
    plan = tables.read_split(spark, path, "test")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(ValueError):
        tables.read_split(spark, path, "validation")


def test_split_view(spark):
    df = spark.range(2).selectExpr("id", "'train' as split", "1 as label", "array(1) as term_ids", "array(1.0D) as weights")
    assert tables.split_view(df, "train", "baseline").columns == ["id", "term_ids", "weights", "label"]
    with pytest.raises(ValueError):
        tables.split_view(df, "train", "transformer")
    with pytest.raises(ValueError):
        tables.split_view(df, "train", "other")


def test_embeddings_are_computed_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "emb")
    assert tables.materialise_embeddings(spark, path, compute).count() == 3
    assert tables.materialise_embeddings(spark, path, compute).count() == 3
    assert len(calls) == 1


def test_staged_table_prunes_columns(spark):
    staged = stage_table(spark.range(5).selectExpr("id", "id % 2 as p", "'x' as wide"), ("p",))
    plan = staged.where("p = 1").select("id")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and "PartitionFilters" in plan
    assert staged.where("p = 1").count() == 2
