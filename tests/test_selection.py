"""Selection, ranks and joins that must not send a hot key, or everything, to one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from versemill.operators import approx, features, joins, knn, ranks, sampling
from versemill.session import Staging


@pytest.mark.parametrize("k", [1, 3, 7, 40, 99, 500])
def test_top_terms_with_ties_cut_by_letters(spark, k):
    rows = [(f"{a}{b}{c}", n, 1) for i, a in enumerate("abéz") for b in "xyz" for c in "12345" for n in [1 if i else 5]]
    rows += [(a, 1, 1) for a in "abéz"] + [("top", 1000, 9), ("next", 999, 9), ("", 1, 1)]
    counted = spark.createDataFrame(rows, "term string, n_total long, n_docs long").repartition(4)
    want = sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:k]
    got = features.top_terms(counted, k).collect()
    assert sorted((r["term"], r["n_total"]) for r in got) == sorted((t, n) for t, n, _ in want)


def test_top_terms_sorts_no_more_than_it_keeps(spark):
    counted = spark.range(5000).selectExpr("concat('w', lpad(id, 5, '0')) as term", "1L as n_total", "1L as n_docs")
    top = features.top_terms(counted, 20)
    assert [r["term"] for r in top.orderBy("term").collect()] == [f"w{i:05d}" for i in range(20)]
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit" in plan and "substring(term" in plan
    assert features.top_terms(counted.where("n_total > 5"), 20).count() == 0


def test_token_ids_follow_frequency_then_word(spark):
    docs = spark.createDataFrame([("bb bb aa",), ("cc aa bb dd",), (None,)], "text string")
    ids = {r["term"]: r["token_id"] for r in features.token_vocabulary(docs).collect()}
    assert ids == {"bb": 2, "aa": 3, "cc": 4, "dd": 5}
    few = {r["term"]: r["token_id"] for r in features.token_vocabulary(docs, size=3).collect()}
    assert few == {"bb": 2, "aa": 3, "cc": 4}


def test_ranks_of_equal_rows(spark):
    with Staging(spark) as staging:
        rows = spark.range(0, 3000, 1, 6).selectExpr("if(id % 10 = 0, 'b', 'a') as g", "if(id < 2000, 5L, id) as k", "id")
        got = ranks.ranked(rows, ["g"], ["k"], "place", staging, size="n").collect()
    for g, n in (("a", 2700), ("b", 300)):
        mine = sorted((r["place"], r["k"]) for r in got if r["g"] == g)
        assert [p for p, _ in mine] == list(range(n)) and [k for _, k in mine] == sorted(k for _, k in mine)
        assert {r["n"] for r in got if r["g"] == g} == {n}


def test_wanted_rows_reach_the_join_and_few_others(spark):
    table = spark.range(100_000).selectExpr("id", "repeat('x', 20) as text")
    wanted = spark.range(0, 100_000, 100).union(spark.createDataFrame([(None,), (10**9,)], "id long"))
    some = joins.wanted_rows(table, wanted, "id")
    assert some.columns == ["id", "text"]
    ids = {r["id"] for r in some.select("id").collect()}
    assert set(range(0, 100_000, 100)) <= ids and len(ids) < 1100
    # A small bitmap lets more rows pass and still loses none.
    rough = {r["id"] for r in joins.wanted_rows(table, wanted, "id", bits=16).select("id").collect()}
    assert set(range(0, 100_000, 100)) <= rough and len(rough) < 5000
    assert joins.wanted_rows(table, wanted.where("id < 0"), "id").count() == 0


def test_neighbour_texts_are_filtered_at_the_scan(spark):
    found = spark.range(20).selectExpr("id as qid", "1 as rank", "id % 3 as nid")
    named = knn.attach_neighbor_metadata(found, spark.range(1000).selectExpr("id", "concat('t', id) as text"), cols=["text"])
    assert named.where("n_text = concat('t', nid)").count() == 20
    assert "bitmap_construct_agg" in named._jdf.queryExecution().optimizedPlan().toString()


def test_spread_join_leaves_hot_facts_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_KEYS", 10)
    facts = spark.range(5000).selectExpr("id", "if(id % 3 = 0, -1L, id % 700) as k")
    counts = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k % 2 != 0").withColumn("v", F.col("k") * 2)
    with Staging(spark) as staging:
        joined = joins.spread_join(facts, staging.table(counts), ["k"], "n")
        assert joined.columns == ["k", "id", "v"]
        got = sorted((r["id"], r["k"], r["v"]) for r in joined.collect())
    want = [(i, k, 2 * k) for i in range(5000) for k in [-1 if i % 3 == 0 else i % 700] if k % 2]
    assert got == sorted(want)


def test_class_ranks_use_more_slices_for_more_rows(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id", "cast(id % 2 as int) as label")
    whole = {r["id"]: r["class_rank"] for r in sampling.class_rank(df).collect()}
    monkeypatch.setattr(sampling, "SLICE_ROWS", 5)
    assert {r["id"]: r["class_rank"] for r in sampling.class_rank(df).collect()} == whole
    plan = sampling.class_rank(df)._jdf.queryExecution().optimizedPlan().toString()
    assert ", 1, 3) AS _slice" in plan


def test_dedup_shuffles_digests_and_no_text(spark):
    rows = [(0, 1, "a", 7), (0, 2, "b", 7), (1, 1, "a", 8), (1, 2, None, 8), (1, 3, None, 9), (0, 1, "a", 10), (2, 0, "", 1)]
    df = spark.createDataFrame(rows, "src int, id long, text string, other int").repartition(3)
    once = sampling.dedup_keep_first(df)
    assert once.columns == df.columns
    # Of the two rows with equal text and order, either stays.
    kept = sorted(((r["src"], r["id"], r["text"]) for r in once.collect()), key=str)
    assert kept == sorted([(0, 1, "a"), (0, 2, "b"), (1, 2, None), (2, 0, "")], key=str)
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def vectors_of(spark, rows, first=0):
    return spark.createDataFrame([(first + i, [float(x) for x in v], i % 3) for i, v in enumerate(rows)], "id long, embedding array<float>, label int")


@pytest.mark.parametrize("shape", ["spread", "clustered"])
def test_recall_of_approximate_neighbours(spark, monkeypatch, shape):
    import numpy as np

    monkeypatch.setattr(knn, "BLOCK_BYTES", 8 * 16 * 64)  # many blocks and batches a bucket
    rng = np.random.default_rng(8)
    data = rng.normal(size=(900, 16))
    if shape == "clustered":
        data = rng.normal(size=(12, 16))[rng.integers(0, 12, 900)] * 5 + data * 0.5
        data[::3] = data[0]  # a third of all vectors are equal
    q, c = vectors_of(spark, data[800:], 10_000), vectors_of(spark, data[:800])
    exact = {(r["qid"], r["nid"]): r["distance"] for r in knn.knn_join(q, c, 5).collect()}
    got = approx.knn_join_approx(q, c, 5, corpus_cols=["label"]).collect()
    ranks_of = {}
    for r in got:
        ranks_of.setdefault(r["qid"], []).append(r["rank"])
        assert r["n_label"] == r["nid"] % 3
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in ranks_of.values())
    farthest = {q: max(d for (a, _), d in exact.items() if a == q) for q in {a for a, _ in exact}}
    hits = sum(r["distance"] <= farthest[r["qid"]] + 1e-9 for r in got)
    assert hits >= 0.9 * len(exact) and len(got) == len({(r["qid"], r["nid"]) for r in got})


def test_approximate_search_of_edge_vectors(spark):
    c = vectors_of(spark, [[0, 0], [1, 0], [1, 0], [-1, 0.1]])
    q = vectors_of(spark, [[1, 0.01], [0, 0]], 100)
    got = [(r["qid"], r["nid"]) for r in approx.knn_join_approx(q, c, 2, bits=1, probes=1).orderBy("qid", "rank").collect()]
    assert got == [(100, 1), (100, 2), (101, 0), (101, 1)]
    assert approx.knn_join_approx(q, c.where("id < 0"), 2).count() == 0
    with pytest.raises(ValueError):
        approx.knn_join_approx(q, c, 2, bits=2, probes=3)
    with pytest.raises(ValueError):
        approx.knn_join_approx(q, vectors_of(spark, [[1, 2, 3]]), 2)
