"""Exact ranks, balancing, split sizes and samples."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from versemill.functions.keys import order_digest
from versemill.operators import sampling


def classes(spark, sizes):
    rows, at = [], 0
    for label, n in sizes.items():
        rows += [(at + i, label) for i in range(n)]
        at += n
    return spark.createDataFrame(rows, "id long, label int")


@pytest.mark.parametrize("digits", [1, 3])
def test_rank_equals_a_plain_window(spark, digits):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 3).cast("int").alias("label"))
    plain = Window.partitionBy("label").orderBy(order_digest(42, "id"), "id")
    both = sampling.class_rank(df, hex_digits=digits).join(
        df.withColumn("want", F.row_number().over(plain)), ["id", "label"]
    )
    assert both.count() == 5000 and both.where("class_rank != want").count() == 0


def test_balance_sizes(spark):
    df = classes(spark, {0: 1, 1: 5, 2: 100})
    for replace in (True, False):
        out = sampling.balance_classes(df, replace=replace)
        assert {r["label"]: r["n"] for r in sampling.class_counts(out).collect()} == {0: 1, 1: 1, 2: 1}
    one = sampling.balance_classes(classes(spark, {4: 9}))
    assert one.count() == 9 and one.select("draw").distinct().count() == 9


def test_bootstrap_repeats_rows_and_keys_stay_unique(spark):
    out = sampling.balance_classes(classes(spark, {0: 200, 1: 230}))
    assert out.groupBy("label").count().where("count != 200").count() == 0
    assert out.select("id", "draw", "label").distinct().count() == 400
    assert out.where("label = 0").select("id").distinct().count() < 200
    without = sampling.balance_classes(classes(spark, {0: 200, 1: 230}), replace=False)
    assert without.select("id").distinct().count() == 400


def test_published_split_sizes(spark):
    df = spark.range(4 * 79_396).select("id", (F.col("id") % 4).cast("int").alias("label"))
    out = sampling.stratified_split(df)
    sizes = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes == {"train": 222_308, "eval": 47_638, "test": 47_638}
    spread = out.groupBy("split", "label").count().groupBy("split").agg(F.max("count") - F.min("count"))
    assert all(r[1] <= 1 for r in spread.collect())
    assert out.select("id").distinct().count() == 4 * 79_396


def test_split_small_and_absent_parts(spark):
    df = classes(spark, {0: 5, 1: 3, 2: 2})
    sizes = lambda **kw: {
        r["split"]: r["count"] for r in sampling.stratified_split(df, **kw).groupBy("split").count().collect()
    }
    assert sizes() == {"train": 7, "eval": 1, "test": 2}
    assert sizes(test_split=None, eval_split=0.25) == {"train": 7, "eval": 3}
    assert sizes(eval_split=None, test_split=0.25) == {"train": 7, "test": 3}
    assert sizes(eval_split=None, test_split=None) == {"train": 10}


def test_split_sizes_agree_with_the_split(spark):
    df = classes(spark, {0: 57, 1: 33, 2: 21})
    want = {(r["label"], s): r[f"n_{s}"] for r in sampling.split_sizes(df).collect() for s in ("train", "eval", "test")}
    got = {(r["label"], r["split"]): r["count"] for r in sampling.stratified_split(df).groupBy("label", "split").count().collect()}
    assert got == want


def test_samples(spark):
    df = classes(spark, {0: 60, 1: 7})
    assert sampling.sample_n(df, 10).select("id").distinct().count() == 10
    assert sampling.sample_n(df, 100).count() == 67
    per = {r["label"]: r["count"] for r in sampling.class_sample(df, 50).groupBy("label").count().collect()}
    assert per == {0: 50, 1: 7}
    coded = sampling.class_sample(df, 50, per_class=False, classes=[0, 1])
    assert {r["label"]: r["count"] for r in coded.groupBy("label").count().collect()} == {0: 50, 1: 50}
    shuffled = [r["id"] for r in sampling.shuffle_rows(df).collect()]
    assert sorted(shuffled) == list(range(67)) and shuffled != sorted(shuffled)
    assert shuffled == [r["id"] for r in sampling.shuffle_rows(df.repartition(5)).collect()]


def test_many_classes_split_with_or_without_a_broadcast(spark, monkeypatch):
    df = classes(spark, {c: 3 for c in range(300)})
    split = {tuple(r) for r in sampling.stratified_split(df).select("id", "label", "split").collect()}
    monkeypatch.setattr(sampling, "broadcast_if_small", lambda table: table)
    assert split == {tuple(r) for r in sampling.stratified_split(df).select("id", "label", "split").collect()}
    assert len(split) == 900
