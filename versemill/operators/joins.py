"""Join helpers that stay balanced when a key is hot or a side may not be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_KEYS = 1000
SALTS = 32
#: A bitmap of this many places (8 MB) tells which keys are wanted.
FILTER_BITS = 26


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when its measured size is under ``limit_bytes``.

    Otherwise the frame comes back unmarked and joins through a shuffle. The size is one
    aggregate over ``df``, so ``df`` should be a table already written.
    """
    per_row = F.lit(16 * len(df.columns))
    for name, kind in df.dtypes:
        if kind == "string":
            per_row = per_row + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
        elif kind.startswith("array"):
            per_row = per_row + F.coalesce(F.size(F.col(name)), F.lit(0)) * 16
    measured = df.agg(F.coalesce(F.sum(per_row.cast("long")), F.lit(0)).alias("b")).first()["b"]
    return F.broadcast(df) if measured <= limit_bytes else df


def lookup_join(facts: DataFrame, table: DataFrame, key: str, spread_by: str) -> DataFrame:
    """``facts`` left-joined to ``table`` (unique on ``key``), when few keys may own most facts.

    The most frequent keys, if frequent enough to matter, are salted: their facts spread
    over ``SALTS`` tasks by ``spread_by`` and their single table row is copied to each.
    At most ``HOT_KEYS`` keys are marked; every other key owns under 1/``HOT_KEYS`` of the
    facts. Nothing is dropped.
    """
    hot = (
        facts.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= 100_000)
        .orderBy(F.desc("_n"), key)
        .limit(HOT_KEYS)
        .select(key, F.lit(True).alias("_hot"))
    )
    salt = F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted_facts = (
        facts.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0)))
        .drop("_hot")
    )
    salted_table = (
        table.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    )
    return salted_facts.join(salted_table, [key, "_salt"], "left").drop("_salt")


def spread_join(facts: DataFrame, table: DataFrame, keys: list[str], n_col: str) -> DataFrame:
    """``facts`` joined to ``table`` (written, unique on ``keys``, ``n_col`` counts the facts of a key).

    Keys that own more than one in ``HOT_KEYS`` of all matches, fewer than ``HOT_KEYS`` of them, are
    broadcast and their facts stay where they are; all others meet in a shuffle.
    """
    total = table.agg(F.sum(n_col)).first()[0] or 0
    is_hot = F.col(n_col) > max(total // HOT_KEYS, HOT_KEYS)
    hot, rest = F.broadcast(table.where(is_hot).drop(n_col)), table.where(~is_hot).drop(n_col)
    others = facts.join(hot.select(*keys), keys, "left_anti").join(rest, keys)
    return facts.join(hot, keys).unionByName(others)


def wanted_rows(table: DataFrame, wanted: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``table`` whose ``key`` may be among those of ``wanted``, told where they are scanned.

    The wanted keys set bits of one bitmap of ``2 ** bits`` places by their hash; the bitmap, whose
    size is fixed, is broadcast, and only rows whose place is set go on. No wanted row is lost;
    others pass as often as places are taken, so an exact join follows.
    """
    place = F.pmod(F.xxhash64(F.lit("wanted"), F.col(key)), F.lit(1 << bits))
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    marks = wanted.where(F.col(key).isNotNull()).select(bucket.alias("_bucket"), bit.alias("_bit"))
    bitmap = marks.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1
    tested = table.withColumns({"_bucket": bucket, "_bit": bit}).join(F.broadcast(bitmap), "_bucket")
    return tested.where(is_set).select(*table.columns)
