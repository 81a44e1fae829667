"""Sharding by fixed virtual slots, in built-in functions only.

A record's id is hashed into one of ``SLOTS`` virtual slots, which never changes. A versioned
map, a table of one row a slot, says which shard holds each slot; it is the only thing edited
when shards are added or loads are evened out, and every version stays readable. Adding a shard
hands the last slots of the fullest shards to the new one, so records only move into it. Loads
are evened out by bytes per slot, aggregated once. The map of a given number of shards is the
map of one shard grown that often, so id and number of shards alone decide (the `key` law).

Inside a shard every record has a place, gapless from 0: by virtual slot, then id, size and
checksum. Places come from a range-dealt sort, so a hot id, or one row repeated very often,
is numbered by all tasks; it still shares one shard, as the law demands. Only id, size and
checksum are shuffled.

Defined results: a null id is an id of its own; a null text has no bytes (size 1, checksum 0);
an empty text has size 1 too. Repeated rows share a shard and get places of their own. Columns
other than id and text are not read by :func:`placed_documents`; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from versemill.operators.ranks import ranked
from versemill.session import Staging

SLOTS = 4096
SHARDS = 8
SEED = 42
LAW = "key"


def virtual_slot(key: Column, n_slots: int = SLOTS, seed: int = SEED) -> Column:
    """The fixed slot of a record id; a null id has one too."""
    return F.pmod(F.xxhash64(F.lit(seed), key.cast("string")), F.lit(n_slots)).cast("int")


# --- the map --------------------------------------------------------------------------


def first_map(spark: SparkSession, n_shards: int, n_slots: int = SLOTS) -> DataFrame:
    """Version 0: ``version, virtual_slot, shard, ordinal`` with equal numbers of slots a shard.

    ``ordinal`` counts the slots of a shard. Growing from ``n`` to ``n + 1`` shards, shard ``k``
    keeps its first ``quota(k, n + 1)`` slots and the others go, shard by shard, to the new one.
    """
    if not 0 < n_shards <= n_slots:
        raise ValueError("there must be at least one shard and no more shards than slots")
    all_slots = F.lit(n_slots).cast("long")

    def quota(k: Column, n: Column) -> Column:
        return F.floor(all_slots / n) + F.when(k < all_slots % n, 1).otherwise(0)

    def upto(k: Column, n: Column) -> Column:
        return k * F.floor(all_slots / n) + F.least(k, all_slots % n)

    def grow(at: Column, n: Column) -> Column:
        k, place = at["shard"], at["ordinal"]
        kept = quota(k, n)
        arrived = place - kept + upto(k, n - 1) - upto(k, n)
        return F.when(place < kept, at).otherwise(F.struct((n - 1).alias("shard"), arrived.alias("ordinal")))

    start = F.struct(F.lit(0).cast("long").alias("shard"), F.col("id").alias("ordinal"))
    steps = F.sequence(F.lit(1).cast("long"), F.lit(n_shards).cast("long"))
    slots = spark.range(n_slots).withColumn("at", F.aggregate(steps, start, grow))
    return slots.select(
        F.lit(0).alias("version"),
        F.col("id").cast("int").alias("virtual_slot"),
        F.col("at.shard").cast("int").alias("shard"),
        F.col("at.ordinal").alias("ordinal"),
    )


def grown_map(slot_map: DataFrame) -> DataFrame:
    """The next version with one more shard, which takes slots from the fullest shards."""
    everywhere = Window.partitionBy()  # one row a slot: a fixed number
    fullest = Window.orderBy(F.desc("ordinal"), F.desc("shard"))
    marked = slot_map.withColumns(
        {"n": F.max("shard").over(everywhere) + 1, "turn": F.row_number().over(fullest), "n_slots": F.count(F.lit(1)).over(everywhere)}
    ).withColumn("taken", F.col("turn") <= F.floor(F.col("n_slots") / (F.col("n") + 1)))
    arrived = F.row_number().over(Window.partitionBy("taken").orderBy("shard", "ordinal")) - 1
    return marked.withColumn("arrived", arrived).select(
        (F.col("version") + 1).alias("version"),
        "virtual_slot",
        F.when(F.col("taken"), F.col("n")).otherwise(F.col("shard")).alias("shard"),
        F.when(F.col("taken"), F.col("arrived")).otherwise(F.col("ordinal")).cast("long").alias("ordinal"),
    )


def slot_loads(records: DataFrame) -> DataFrame:
    """``virtual_slot, n, bytes``: what the slots hold; counted before the shuffle."""
    return records.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


def evened_map(slot_map: DataFrame, loads: DataFrame) -> DataFrame:
    """The next version with bytes evened out, moving whole slots only.

    A shard above the mean gives up the last slots that fit into its excess; the slots given up
    stand in one line, the shards below the mean share the line by what they lack, and a slot
    goes to the shard in whose part its middle lies. Shards keep all other slots.
    """
    everywhere = Window.partitionBy()
    of_shard = Window.partitionBy("shard")
    held = slot_map.join(F.broadcast(loads.select("virtual_slot", "bytes")), "virtual_slot", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0)))
    n_shards = F.max("shard").over(everywhere) + 1
    held = held.withColumns(
        {
            "over": F.sum("bytes").over(of_shard) - F.sum("bytes").over(everywhere) / n_shards,
            "tail": F.sum("bytes").over(of_shard.orderBy(F.desc("ordinal"))),
        }
    ).withColumn("given", (F.col("bytes") > 0) & (F.col("tail") <= F.col("over")))
    lacking = held.groupBy("shard").agg(F.greatest(-F.first("over"), F.lit(0.0)).alias("lacks")).where("lacks > 0")
    line = Window.orderBy("shard")
    parts = lacking.select(
        F.col("shard").alias("to_shard"),
        (F.sum("lacks").over(line) - F.col("lacks")).alias("from_byte"),
        F.sum("lacks").over(line).alias("to_byte"),
    )
    in_line = F.sum("bytes").over(Window.orderBy("shard", "ordinal")) - F.col("bytes") / 2
    moved = held.where("given").select("virtual_slot", in_line.alias("middle"))
    moved = moved.join(F.broadcast(parts), (F.col("middle") >= F.col("from_byte")) & (F.col("middle") < F.col("to_byte")))
    edited = held.join(F.broadcast(moved.select("virtual_slot", "to_shard")), "virtual_slot", "left")
    shard = F.coalesce("to_shard", "shard")
    kept_first = Window.partitionBy(shard).orderBy(F.col("to_shard").isNotNull(), "ordinal", "virtual_slot")
    return edited.select(
        (F.col("version") + 1).alias("version"),
        "virtual_slot",
        shard.alias("shard"),
        (F.row_number().over(kept_first) - 1).cast("long").alias("ordinal"),
    )


def save_map(slot_map: DataFrame, path: str) -> None:
    """Adds one version to the maps under ``path``; a version that is there already is an error."""
    version = slot_map.agg(F.max("version")).first()[0]
    slot_map.drop("version").coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A saved version of the map, by default the newest."""
    schema = "virtual_slot int, shard int, ordinal bigint, version int"
    maps = spark.read.schema(schema).option("basePath", path).parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version)


# --- records --------------------------------------------------------------------------


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot``: what sharding needs to know of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        virtual_slot(F.col(id_col), n_slots).alias("virtual_slot"),
    )


def placed_documents(
    docs: DataFrame, slot_map: DataFrame, next_map: DataFrame, staging: Staging, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot, shard, grown_shard, place`` of every row.

    ``shard`` is by ``slot_map``, ``grown_shard`` by ``next_map``. Maps have a fixed number of
    rows and are broadcast. The intermediate tables belong to ``staging``.
    """
    both = slot_map.select("virtual_slot", "shard").join(next_map.select("virtual_slot", F.col("shard").alias("grown_shard")), "virtual_slot")
    # Dealing by range reads its input twice; texts are read once.
    held = staging.table(records(docs, id_col, text_col)).join(F.broadcast(both), "virtual_slot")
    return ranked(held, ["shard"], ["virtual_slot", "doc_id", "size", "text_crc32"], "place", staging)


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Writes ``docs`` with all their columns as Parquet, one folder a shard (``_x_shard=...``).

    Rows are dealt by virtual slot, so one shard is written by many tasks.
    """
    keyed = docs.withColumn("_x_slot", virtual_slot(F.col(id_col)))
    sharded = keyed.join(F.broadcast(slot_map.select(F.col("virtual_slot").alias("_x_slot"), F.col("shard").alias("_x_shard"))), "_x_slot")
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(64))
    dealt = sharded.withColumn("_x_spread", spread).repartition("_x_shard", "_x_spread")
    dealt.sortWithinPartitions("_x_slot").drop("_x_slot", "_x_spread").write.partitionBy("_x_shard").parquet(path)
