"""The registered queries over the dealt operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versemill.llm import bpe, exact, licenses, merkle, minhash, mix, quality, secrets, sharding, substring, trie, vectors, warc
from versemill.llm.sql import SQL
from versemill.session import Staging

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
__all__ = ["QUERIES", "SQL"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op1_mix_sources(spark, sf):
    return mix.mixed_sizes(documents(spark, sf))


@query
def op2_bpe_round_trip(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    done = bpe.round_trip_documents(documents(spark, sf).select("doc_id", "text"), path)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")


@query
def op3_warc_round_trip(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return warc.round_trip(pages).select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"),
    )


@query
def op4_exact_dedup(spark, sf):
    return exact.exact_groups(documents(spark, sf))


@query
def op5_minhash_near_dedup(spark, sf):
    classes = minhash.near_classes(documents(spark, sf), size=4)
    return classes.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


@query
def op6_substring_dedup(spark, sf):
    return substring.dedup_substrings(documents(spark, sf))


@query
def op7_quality_classifier(spark, sf):
    docs = documents(spark, sf)
    network = quality.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scored = quality.score_documents(docs.select("doc_id", "text"), network, out_col="score", keep_text=False)
    return scored.select(
        "doc_id",
        quality.is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op8_embedding_near_dedup(spark, sf):
    linked = vectors.linked_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))
    return linked.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query
def op9_secret_scan(spark, sf):
    found = secrets.scan_secrets(documents(spark, sf).select("doc_id", "text"), keep_text=False)
    count = lambda kind: F.size(secrets.of_kind(F.col("spans"), kind)).cast("long")
    base = secrets.spans_text(secrets.of_kind(F.col("spans"), *secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


@query
def op10_license_scan(spark, sf):
    found = licenses.scan_licenses(documents(spark, sf).select("doc_id", "text"), keep_text=False)
    named = lambda *arrays: F.array_join(F.array_sort(F.array_distinct(F.concat(*arrays))), ",")
    labels = F.transform("places", lambda p: p["label"])
    n_base = F.size("places").cast("long")
    best = F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["word"])).alias("last_word"),
        named(labels).alias("base_labels"),
        named(labels, F.transform("blocks", lambda b: b["label"])).alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )


@query
def op11_merkle_manifest(spark, sf):
    more_chars = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, 1).otherwise(0)
    n_chars = F.col("n_chars").cast("decimal(20,0)") + more_chars
    altered = merkle.record_digest("doc_id", "source", "lang", n_chars.cast("decimal(20,0)"), "text")
    tampered = F.when((more_chars == 1) & F.col("n_chars").isNotNull(), altered)
    found, root = merkle.manifest(documents(spark, sf), Staging(spark), more={"tampered": tampered})
    folded = merkle.folded(F.coalesce("tampered", "digest"), F.col("segment"))
    return found.select(
        "doc_id",
        merkle.as_hex(F.col("digest")).alias("leaf"),
        merkle.as_hex(F.col("subroot")).alias("subroot"),
        F.lit(root).alias("root"),
        merkle.proof_digest(F.col("segment")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op12_virtual_slots(spark, sf):
    staging = Staging(spark)
    maps = staging.path()
    sharding.save_map(sharding.first_map(spark, sharding.SHARDS), maps)
    sharding.save_map(sharding.grown_map(sharding.load_map(spark, maps)), maps)
    now, later = (sharding.load_map(spark, maps, version) for version in (0, 1))
    placed = sharding.placed_documents(documents(spark, sf), now, later, staging)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(sharding.LAW).alias("law"),
        "shard",
        F.col("place").alias("slot"),
        "grown_shard",
        "virtual_slot",
    )


@query
def op13_prefix_trie(spark, sf):
    return trie.conversation_trie(spark.read.parquet(f"{sf}/conversations.parquet"), Staging(spark))
