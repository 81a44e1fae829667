"""The neighbour join against brute force, on data that tries to break it."""

from __future__ import annotations

import numpy as np
import pytest

from versemill.operators import knn
from versemill.operators.sampling import class_counts

SCHEMA = "id long, embedding array<float>, label int"


@pytest.fixture(autouse=True, params=["cells", "few"])
def path(request, monkeypatch):
    """Every case runs through the cells, and with the queries sent to the corpus."""
    monkeypatch.setattr(knn, "FEW_BYTES", -1 if request.param == "cells" else 1 << 30)
    return request.param


def frame(spark, vectors, first_id=0, labels=None, schema=SCHEMA, ids=None):
    ids = ids or [first_id + i for i in range(len(vectors))]
    labels = labels or [i % 3 for i in range(len(vectors))]
    return spark.createDataFrame([(i, [float(x) for x in v], l) for i, v, l in zip(ids, vectors, labels)], schema)


def brute(queries, corpus, k, metric, corpus_ids):
    q, c = np.float32(queries).astype(float), np.float32(corpus).astype(float)
    out = []
    for row in q:
        if metric == "cosine":
            norms = np.sqrt((row**2).sum()) * np.sqrt((c**2).sum(axis=1))
            d = 1 - np.divide(c @ row, norms, out=np.zeros(len(c)), where=norms > 0)
        else:
            d = np.sqrt(((c - row) ** 2).sum(axis=1))
        order = sorted(range(len(c)), key=lambda j: (round(d[j], 9), corpus_ids[j]))[:k]
        out.append([(corpus_ids[j], round(float(d[j]), 6)) for j in order])
    return out


def found(df):
    rows = sorted(df.collect(), key=lambda r: (r["qid"], r["rank"]))
    out = {}
    for r in rows:
        out.setdefault(r["qid"], []).append((r["nid"], round(r["distance"], 6) + 0.0))
    return [out[q] for q in sorted(out)]


def clustered(rng, n, dim=8, centers=10, width=0.01):
    middle = rng.normal(size=(centers, dim)) * 10
    return middle[rng.integers(0, centers, n)] + rng.normal(size=(n, dim)) * width


@pytest.mark.parametrize("metric", knn.METRICS)
@pytest.mark.parametrize("shape", ["spread", "clustered", "hot", "integer"])
def test_equals_brute_force(spark, metric, shape):
    rng = np.random.default_rng(7)
    if shape == "spread":
        corpus, queries = rng.normal(size=(400, 8)), rng.normal(size=(60, 8))
    elif shape == "clustered":
        data = clustered(rng, 460, width=0.5)
        corpus, queries = data[:400], data[400:]
    elif shape == "hot":
        corpus, queries = rng.normal(size=(400, 8)), rng.normal(size=(60, 8))
        corpus[::3] = corpus[0]
        queries[:20] = corpus[0]
    else:
        corpus, queries = rng.integers(0, 3, size=(400, 4)), rng.integers(0, 3, size=(60, 4))
    got = found(knn.knn_join(frame(spark, queries, 1000), frame(spark, corpus), 5, metric))
    assert got == brute(queries, corpus, 5, metric, list(range(400)))


def test_many_blocks_and_batches(spark, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(knn, "BLOCK_BYTES", 8 * 8 * 40)
    monkeypatch.setattr(knn, "PAIR_BUDGET", 100)
    corpus, queries = rng.normal(size=(500, 8)), rng.normal(size=(130, 8))
    corpus[100:300] = corpus[100]
    q, c = frame(spark, queries, 1000), frame(spark, corpus)
    layout = knn.plan_cells(q, c, 5, "euclidean", "id", "embedding")
    assert layout.blocks.max() > 1 and layout.batches.max() > 1
    assert found(knn.knn_join(q, c, 5, "euclidean")) == brute(queries, corpus, 5, "euclidean", list(range(500)))


def test_cells_out_of_reach_are_skipped(spark):
    data = clustered(np.random.default_rng(1), 3000, width=0.001)
    q, c = frame(spark, data[2800:], 10_000), frame(spark, data[:2800])
    layout = knn.plan_cells(q, c, 5, "euclidean", "id", "embedding")
    _, wanted = layout.reach(data[2800:])
    assert len(layout.pivots) >= 10 and wanted.mean() < 0.5
    assert found(knn.knn_join(q, c, 5, "euclidean")) == brute(data[2800:], data[:2800], 5, "euclidean", list(range(2800)))


def test_metrics_disagree_on_unnormalised_vectors(spark):
    q, c = frame(spark, [[1, 0]], 100), frame(spark, [[10, 0], [0.9, 0.3]])
    assert found(knn.knn_join(q, c, 1, "cosine"))[0][0][0] == 0
    assert found(knn.knn_join(q, c, 1, "euclidean"))[0][0][0] == 1


def test_zero_vectors_are_at_cosine_distance_one(spark):
    q, c = frame(spark, [[0, 0], [1, 0]], 100), frame(spark, [[0, 0], [-1, 0], [1, 0.1]])
    got = found(knn.knn_join(q, c, 3, "cosine"))
    assert got[0] == [(0, 1.0), (1, 1.0), (2, 1.0)]
    assert [n for n, _ in got[1]] == [2, 0, 1] and got[1][1][1] == 1.0


def test_small_and_empty_corpus(spark):
    q = frame(spark, [[1, 2], [3, 4]], 100)
    assert [len(n) for n in found(knn.knn_join(q, frame(spark, [[0, 1], [5, 5]]), 5))] == [2, 2]
    assert knn.knn_join(q, frame(spark, [[0, 1]]).where("id < 0"), 5, query_cols=["label"]).count() == 0
    assert knn.knn_join(q.where("id < 0"), frame(spark, [[0, 1]]), 5).count() == 0


def test_string_ids(spark):
    schema = "id string, embedding array<double>, label int"
    c = frame(spark, [[1, 0], [1, 0], [0, 1]], schema=schema, ids=["b", "a", "c"])
    q = frame(spark, [[1, 0]], schema=schema, ids=["q"])
    rows = knn.knn_join(q, c, 2, corpus_cols=["label"]).orderBy("rank").collect()
    assert [(r["nid"], r["n_label"]) for r in rows] == [("a", 1), ("b", 0)]


def test_metadata_join_with_hot_neighbors(spark, monkeypatch):
    from versemill.operators import joins

    found_rows = spark.range(300_000).selectExpr("id as qid", "1 as rank", "if(id % 3 = 0, 7L, id % 50) as nid")
    table = spark.range(60).selectExpr("id as id", "concat('t', id) as text")
    named = knn.attach_neighbor_metadata(found_rows, table, cols=["text"])
    assert named.count() == 300_000
    assert named.where("n_text != concat('t', nid) or n_text is null").count() == 0
    missing = knn.attach_neighbor_metadata(found_rows.limit(10), table.where("id < 0"), cols=["text"])
    assert missing.where("n_text is null").count() == 10
    assert joins.HOT_KEYS == 1000


def neighbors(spark, lists):
    rows = [(q, i + 1, lab) for q, labels in enumerate(lists) for i, lab in enumerate(labels)]
    return spark.createDataFrame(rows, "qid long, rank int, n_label int")


def test_votes(spark):
    n = neighbors(spark, [[2, 1, 2, 1, 0], [4, 3, 2, 1, 0], [3, 3, 3, 0, 0]])
    votes = {r["qid"]: r["y_pred"] for r in knn.majority_vote(n).collect()}
    assert votes == {0: 1, 1: 0, 2: 3}
    lists = knn.vote_distribution(knn.neighbor_lists(n), 5, 5)
    shares = {r["qid"]: r["p_knn"] for r in lists.collect()}
    assert shares[0] == [0.2, 0.4, 0.4, 0.0, 0.0] and shares[2] == [0.4, 0.0, 0.0, 0.6, 0.0]


def test_precision_and_recall_with_absent_class(spark):
    n = neighbors(spark, [[1, 1, 0, 0, 0], [0, 0, 0, 0, 0]]).selectExpr("*", "if(qid = 0, 1, 9) as label")
    train = spark.createDataFrame([(i, i % 2) for i in range(8)], "id long, label int")
    rows = {r["qid"]: r for r in knn.precision_recall_at_k(n, class_counts(train), 5).collect()}
    assert (rows[0]["precision_at_k"], rows[0]["recall_at_k"]) == (0.4, 0.5)
    assert (rows[1]["precision_at_k"], rows[1]["recall_at_k"], rows[1]["n_relevant"]) == (0.0, 0.0, 0)


def test_slices_cover_all_rows_once(monkeypatch):
    monkeypatch.setattr(knn, "PAIR_BUDGET", 10)
    for lengths in ([3, 3, 3, 3, 3], [0, 0, 0], [25, 1, 25], [10, 10]):
        parts = list(knn._slices(np.array(lengths)))
        assert [i for s in parts for i in range(s.start, s.stop)] == list(range(len(lengths)))
        assert all(sum(lengths[s]) < 10 + max(lengths) + 1 for s in parts)


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        knn.knn_join(frame(spark, [[1]]), frame(spark, [[1]]), 1, "manhattan")


def test_few_queries_shuffle_no_corpus_row(spark, path):
    rng = np.random.default_rng(5)
    q, c = frame(spark, rng.normal(size=(20, 8)), 10_000), frame(spark, rng.normal(size=(900, 8)))
    plan = knn.knn_join(q, c, 3, corpus_cols=["label"])._jdf.queryExecution().executedPlan().toString()
    assert ("FlatMapCoGroups" in plan) == (path == "cells")
    if path == "few":
        assert plan.count("Exchange") == 1 and plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.index("MapInArrow")


def test_rows_of_cells_out_of_reach_are_not_shuffled(spark, path):
    data = clustered(np.random.default_rng(1), 3000, width=0.001)
    q, c = frame(spark, data[:1], 10_000), frame(spark, data[1:])
    layout = knn.plan_cells(q, c, 5, "euclidean", "id", "embedding")
    assert (layout.batches == 0).any()
    rows = c.selectExpr("xxhash64('block', id) as spread", "id as nid", "embedding as vector")
    groups = rows.mapInArrow(knn._corpus_groups(layout, 2), "groups array<long>, nid long, vector array<float>")
    assert groups.count() < 2999 / 2
    assert found(knn.knn_join(q, c, 5, "euclidean")) == brute(data[:1], data[1:], 5, "euclidean", list(range(2999)))


def test_queries_are_copied_once_a_pack_of_cells(spark, monkeypatch):
    monkeypatch.setattr(knn, "MIN_BLOCKS", 2, raising=False)
    rng = np.random.default_rng(11)
    corpus, queries = rng.normal(size=(3000, 8)), rng.normal(size=(50, 8))
    q, c = frame(spark, queries, 10_000), frame(spark, corpus)
    layout = knn.plan_cells(q, c, 5, "cosine", "id", "embedding")
    assert len(layout.pivots) >= 10
    rows = q.selectExpr("xxhash64('batch', id) as spread", "id as qid", "embedding as vector")
    groups = rows.mapInArrow(knn._query_groups(layout, 2), "groups array<long>, bound double, qid long, vector array<float>")
    assert max(r[0] for r in groups.selectExpr("size(groups)").collect()) <= 4
    assert found(knn.knn_join(q, c, 5, "cosine")) == brute(queries, corpus, 5, "cosine", list(range(3000)))


@pytest.mark.parametrize("metric", knn.METRICS)
def test_most_pairs_are_neither_partitioned_nor_measured(metric, monkeypatch):
    rng = np.random.default_rng(13)
    vectors = knn.searchable(rng.normal(size=(6000, 16)), metric, is_query=False)
    queries, corpus, order = vectors[:1000], vectors[1000:], rng.permutation(5000)
    asked, partition = [], np.partition
    monkeypatch.setattr(np, "partition", lambda a, *args, **kw: asked.append(a.size) or partition(a, *args, **kw))
    monkeypatch.setattr(knn, "PAIR_BUDGET", 1 << 20)
    parts = list(knn.nearest_in_block(queries, np.full(1000, np.inf), corpus, order, metric, 5))
    q, c, distance = (np.concatenate(p) for p in zip(*parts))
    exact = 1 - queries @ corpus.T if metric == "cosine" else np.sqrt(knn.squared_distances(queries, corpus))
    assert (c.reshape(1000, 5) == np.argsort(exact, axis=1)[:, :5]).all()
    assert np.allclose(distance.reshape(1000, 5), np.sort(exact, axis=1)[:, :5], atol=1e-9)
    assert sum(asked) < 1000 * 5000 / 2


def test_equal_vectors_are_searched_for_once(monkeypatch):
    rng = np.random.default_rng(17)
    queries = knn.searchable(np.repeat(rng.normal(size=(3, 8)), 200, axis=0), "cosine", is_query=True)
    corpus = knn.searchable(np.vstack([np.zeros((300, 8)), np.repeat(rng.normal(size=(2, 8)), 200, axis=0)]), "cosine", is_query=False)
    one, order = np.ones(1, np.int64), rng.permutation(700)
    layout = knn.CellLayout(
        metric="cosine", k=4, pivots=corpus[:1], inner=np.zeros(1), outer=np.full(1, 2.0), nearest=np.full((1, 4), np.inf), blocks=one,
        batches=one, pack=one - 1, pack_blocks=one, pack_batches=one, sample=corpus[:1],
    )
    shown, look = [], knn._Search.look
    monkeypatch.setattr(knn._Search, "look", lambda self, rows, block, *rest: shown.append(len(rows) * len(block)) or look(self, rows, block, *rest))
    parts = list(knn.nearest_in_cells(queries, np.full(600, np.inf), corpus, order, layout))
    q, c, distance = (np.concatenate(p) for p in zip(*parts))
    exact = np.array([np.lexsort((order, np.round(1 - corpus @ v, 9)))[:4] for v in queries[::200]])
    assert sum(shown) <= 3 * 3 * 4
    assert all((c[np.flatnonzero(q == i)] == exact[i // 200]).all() for i in range(600))


@pytest.mark.parametrize("scale", [1e-30, 1e-3, 1e8, 1e30])
def test_tight_clusters_and_extreme_lengths(scale):
    rng = np.random.default_rng(19)
    data = clustered(rng, 3000, width=1e-3) * scale
    q, c, order = data[:300], data[300:], np.arange(2700)
    parts = list(knn.nearest_in_block(q, np.full(300, np.inf), c, order, "euclidean", 5))
    found_rows = np.concatenate([p[1] for p in parts]).reshape(300, 5)
    exact = np.sqrt(((q[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)) if scale < 1e20 else np.sqrt((((q / scale)[:, None, :] - (c / scale)[None, :, :]) ** 2).sum(axis=2))
    assert (found_rows == np.argsort(exact, axis=1, kind="stable")[:, :5]).all()
