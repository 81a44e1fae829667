"""Manifest, shards and prefix trie: against plain Python, over edge rows and forced paths."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from compare import connect
from versemill.llm import merkle, queries, sharding, trie
from versemill.operators import ranks
from versemill.session import Staging

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree int, level int, at int, digest string, shard int, size int, place int"
CONV_SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, mark string, key string, block int, at int"
BIG = 2**63 - 1


@pytest.fixture(scope="module")
def staging(spark):
    with Staging(spark) as owner:
        yield owner


def edge_documents():
    texts = [None, "", "a", "ä😀", "x" * 100_000, "same", "same"]
    rows = [(i, t, lang, None if i % 3 else "s", len(t or "")) for i, (t, lang) in enumerate((t, g) for t in texts for g in (None, "", "en", "dé"))]
    rows += [(5, "same", "en", "s", 4)] * 9 + [(None, "n", "en", "s", 1), (None, None, None, None, None), (7, "y", "z", "s", None), (35, "big", "en", "s", BIG)]
    return rows


def as_docs(spark, rows):
    wide = [(d, t, lang, source, n, 1, 2, 3, "d", 4, 5, 6) for d, t, lang, source, n in rows]
    return spark.createDataFrame(wide, DOC_SCHEMA).repartition(3)


def manifest_rows(docs, staging, monkeypatch):
    monkeypatch.setattr(queries, "documents", lambda spark, sf: docs)
    got = queries.QUERIES["op11_merkle_manifest"](docs.sparkSession, "")
    return sorted(map(tuple, got.collect()), key=str)


def expected(rows):
    return sorted(brute.manifest([(d, source, lang, n, t) for d, t, lang, source, n in rows]), key=str)


@pytest.mark.parametrize("limit", [merkle.BROADCAST_BYTES, -1])
def test_manifest_of_edge_rows(spark, staging, monkeypatch, limit):
    # Without broadcasts the jumps are shuffled joins.
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", limit)
    rows = edge_documents()
    assert manifest_rows(as_docs(spark, rows), staging, monkeypatch) == expected(rows)


@pytest.mark.parametrize("langs", [1, 40])
def test_manifest_of_tall_and_wide_trees(spark, staging, monkeypatch, langs):
    rows = [(i, f"t{i}", f"l{i * i % langs}", "s", i) for i in range(2100 if langs == 1 else 130)]
    assert manifest_rows(as_docs(spark, rows), staging, monkeypatch) == expected(rows)


def test_manifest_of_few_rows(spark, staging, monkeypatch):
    assert manifest_rows(as_docs(spark, []), staging, monkeypatch) == []
    for n in (1, 2, 3):
        rows = [(i, "t", "en", "s", 1) for i in range(n)]
        assert manifest_rows(as_docs(spark, rows), staging, monkeypatch) == expected(rows)


def test_manifest_is_written_and_checked_row_by_row(spark, staging):
    docs = as_docs(spark, edge_documents())
    path = staging.path()
    root = merkle.write_manifest(docs, path, staging)
    read = spark.read.parquet(path)
    assert read.where(merkle.folded(F.col("digest"), F.col("segment")) != root).count() == 0
    other = F.unhex(F.sha2(F.lit("other"), 256))
    assert read.where(merkle.folded(other, F.col("segment")) == root).count() == 0


# --- shards ---------------------------------------------------------------------------


@pytest.mark.parametrize("n_slots, n_shards", [(64, 1), (64, 7), (64, 63), (4096, 8)])
def test_grown_map_is_the_map_of_one_more_shard(spark, n_slots, n_shards):
    first = sharding.first_map(spark, n_shards, n_slots)
    grown = {r["virtual_slot"]: r for r in sharding.grown_map(first).collect()}
    direct = {r["virtual_slot"]: r for r in sharding.first_map(spark, n_shards + 1, n_slots).collect()}
    assert {s: (r["shard"], r["ordinal"]) for s, r in grown.items()} == {s: (r["shard"], r["ordinal"]) for s, r in direct.items()}
    before = {r["virtual_slot"]: r["shard"] for r in first.collect()}
    assert all(r["shard"] in (before[s], n_shards) for s, r in grown.items())
    sizes = np.bincount([r["shard"] for r in grown.values()], minlength=n_shards + 1)
    assert sizes.max() - sizes.min() <= 1


def test_evened_map_moves_whole_slots_off_full_shards(spark, staging):
    first = sharding.first_map(spark, 5, 500)
    loads = spark.range(500).select(F.col("id").cast("int").alias("virtual_slot"), (F.col("id") % 17 + F.when(F.col("id") < 100, 90).otherwise(1)).alias("bytes"))
    path = staging.path()
    sharding.save_map(first, path)
    sharding.save_map(sharding.evened_map(sharding.load_map(spark, path), loads), path)
    load = lambda m: sorted(r["b"] for r in m.join(loads, "virtual_slot").groupBy("shard").agg(F.sum("bytes").alias("b")).collect())
    old, new = sharding.load_map(spark, path, 0), sharding.load_map(spark, path)
    mean = sum(load(old)) / 5
    assert load(new)[-1] - load(new)[0] < load(old)[-1] - load(old)[0]
    assert load(new)[-1] <= mean + 107 and load(new)[0] >= mean - 107
    by_slot = {r["virtual_slot"]: r["shard"] for r in new.collect()}
    assert len(by_slot) == 500
    places = new.groupBy("shard").agg(F.array_sort(F.collect_list("ordinal")).alias("o")).collect()
    assert all(r["o"] == list(range(len(r["o"]))) for r in places)
    with pytest.raises(Exception, match="(?i)exists"):
        sharding.save_map(first, path)


def test_placed_documents(spark, staging):
    rows = edge_documents() + [(None, f"n{i}", "en", "s", 1) for i in range(50)]
    first = sharding.first_map(spark, 8)
    placed = sharding.placed_documents(as_docs(spark, rows), first, sharding.grown_map(first), staging).collect()
    bare = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in placed)
    assert bare == sorted((d is not None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert len({(r["doc_id"], r["shard"], r["grown_shard"]) for r in placed}) == len({d for d, *_ in rows})
    for shard in {r["shard"] for r in placed}:
        assert sorted(r["place"] for r in placed if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in placed)))
    assert sharding.placed_documents(as_docs(spark, []), first, sharding.grown_map(first), staging).count() == 0


def test_shards_are_written_whole(spark, staging):
    docs, path = as_docs(spark, edge_documents()), staging.path()
    sharding.write_shards(docs, sharding.first_map(spark, 8), path)
    read = spark.read.parquet(path)
    assert read.columns == [*docs.columns, "_x_shard"]
    assert sorted(map(str, read.drop("_x_shard").collect())) == sorted(map(str, docs.collect()))


def test_a_hot_key_is_ranked_by_all_tasks(spark, staging):
    rows = spark.range(0, 8000, 1, 4).select(F.lit("g").alias("g"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    sizes = [n for n in ranks.in_range_order(rows, ["g", "k"]).rdd.glom().map(len).collect() if n]
    spark.conf.set(merging, "true")
    assert len(sizes) > 4 and max(sizes) < 3000
    places = [r["place"] for r in ranks.ranked(rows, ["g"], ["k"], "place", staging).orderBy("k").collect()]
    assert sorted(places) == list(range(8000))
    assert sorted(r["x"] for r in ranks.counted_up(spark.createDataFrame([(3, 70_000)], "a bigint, b bigint"), "a", "b", "x").collect()) == list(range(3, 70_001))


# --- prefix trie ----------------------------------------------------------------------


def edge_conversations(seed):
    rng = random.Random(seed)
    rows = [(None, 0, "user", "lost"), (200, None, None, None), (200, 1, "user", None), (200, 1, "user", "tie"), (200, 1, "user", "tie")]
    rows += [(c, t, "user", "hi") for c in range(200, 260) for t in range(c % 4)]
    rows += [(c, t, rng.choice(["user", None]), rng.choice(["a", "b", "ä😀", "", None])) for c in range(-130, 180) for t in range(rng.randrange(9))]
    rows += [(c, t, "user", f"line {t}") for c in (300, 301, 302, 303) for t in range(40)] + [(400, t, "user", f"own {t}" if t > 30 else f"line {t}") for t in range(90)]
    rng.shuffle(rows)
    return [(*r, 1, "m", "k", 2, 3) for r in rows]


def nodes(found):
    return sorted(map(tuple, found.select(*trie.NODE).collect()), key=lambda r: (r[1], r[0]))


def expected_nodes(rows):
    return brute.trie(brute.rebuilt([r[:4] for r in rows]))


@pytest.mark.parametrize("block_rows, block_turns, long, hot", [(1 << 16, 1 << 18, 256, 10**6), (5, 40, 3, 30), (1, 1, 10, 10**6), (9, 10**6, 20, 1)])
def test_trie_of_edge_conversations(spark, staging, block_rows, block_turns, long, hot):
    rows = edge_conversations(block_rows)
    conversations = spark.createDataFrame(rows, CONV_SCHEMA).repartition(3)
    turns, convs = trie.rebuilt(trie.numbered(trie.turns(conversations), staging, hot), staging)
    turns, convs = staging.table(turns), staging.table(convs)
    assert nodes(trie.prefix_trie(trie.keyed(turns, convs, staging, long), staging, block_rows, block_turns)) == expected_nodes(rows)


def test_trie_of_many_equal_conversations(spark, staging):
    """Most conversations are one; the block borders fall inside their run."""
    rows = [(c, t, "user", f"same {t}") for c in range(1000, 1300) for t in range(7 if c % 50 else 9)]
    conversations = spark.createDataFrame([(*r, 1, "m", "k", 2, 3) for r in rows], CONV_SCHEMA)
    turns, convs = trie.rebuilt(trie.numbered(trie.turns(conversations), staging), staging)
    turns, convs = staging.table(turns), staging.table(convs)
    assert nodes(trie.prefix_trie(trie.keyed(turns, convs, staging), staging, 11, 10**6)) == expected_nodes(rows)


def test_trie_of_nothing_and_of_one(spark, staging):
    assert trie.conversation_trie(spark.createDataFrame([], CONV_SCHEMA), staging).count() == 0
    for c in (3, 7):  # 3 has no base and loses all its turns or keeps some
        rows = [(c, t, "user", "x", 1, "m", "k", 2, 3) for t in range(4)]
        assert nodes(trie.conversation_trie(spark.createDataFrame(rows, CONV_SCHEMA), staging)) == expected_nodes(rows)


def test_sparse_table_against_scans():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 6, 50)
    table = trie.SparseTable(values)
    for p in range(50):
        for d in range(7):
            left, right = p, p
            while left > 0 and values[left] >= d:
                left -= 1
            while right < 49 and values[right + 1] >= d:
                right += 1
            start, depth = np.array([p]), np.array([d])
            assert table.left_end(start, depth)[0] == left and table.right_end(start, depth)[0] == right
        assert table.least(np.array([p // 2]), np.array([p]))[0] == values[p // 2 : p + 1].min()


@pytest.mark.parametrize("name, table", [("op11_merkle_manifest", "documents"), ("op13_prefix_trie", "conversations")])
def test_sql_agrees_with_plain_python(name, table):
    database = connect("/root/testdata/sf0.001")
    rows = database.execute(f"SELECT {'doc_id, source, lang, n_chars, text' if table == 'documents' else 'conv_id, turn, role, text'} FROM {table}").fetchall()
    want = brute.manifest(rows) if table == "documents" else brute.trie(brute.rebuilt(rows))
    assert sorted(database.execute(queries.SQL[name]).fetchall(), key=str) == sorted(want, key=str)
