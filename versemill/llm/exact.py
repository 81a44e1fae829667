"""Exact dedup by content-defined chunk recipes, in built-in functions only.

A text is normalised (each run of ``[\\x20\\x09-\\x0D]`` becomes one space) and cut into chunks
whose ends depend on nearby characters alone, so equal passages give equal chunks wherever
they stand. Each chunk gets a 64-bit identifier that is verified once over the whole corpus:
occurrences are aggregated to ``(identifier, SHA-256 of the chunk)``, and when an identifier
turns out to name two different chunks, the digests themselves become the identifiers. A
document is then its ordered list of identifiers, its recipe, and documents are equal when
their recipes are. Texts never leave their task: digests and identifiers are shuffled.

Defined results: null text counts as empty, empty texts form one group, a null id sorts after
all others, and of repeated rows with the smallest id exactly one is kept. No row is dropped
by :func:`exact_groups`. Columns other than id and text are not read by it; helper columns
start with ``_x_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from versemill.session import Staging, stage_table

LAST_ID = 2**63 - 1
CHUNK_LEAST, CHUNK_MOST = 512, 4096
#: A chunk may end after one of these characters and a space; digits and stops are frequent in any language.
CUT_AFTER = "cdglnr.,;:!?0-9"

# A run that is not already a single space.
_LOOSE_SPACE = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _LOOSE_SPACE, " ")


def content_chunks(text: Column) -> Column:
    """``text`` cut at content-defined places; the chunks joined give ``text`` back.

    Within ``CHUNK_LEAST`` to ``CHUNK_MOST`` characters the first place where a cut is
    allowed ends the chunk. Text without such places is cut every ``CHUNK_MOST`` characters.
    """
    pattern = f"(?s).{{{CHUNK_LEAST},{CHUNK_MOST}}}?[{CUT_AFTER}] |.{{1,{CHUNK_MOST}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def document_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, text_sha256, chunks array<struct<id, sha>>``, one row per document."""
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("_x_text"))
    return text.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.sha2("_x_text", 256).alias("text_sha256"),
        F.transform(content_chunks(F.col("_x_text")), _identified).alias("chunks"),
    )


def _identified(chunk: Column) -> Column:
    return F.struct(F.xxhash64(chunk).alias("id"), F.unhex(F.sha2(chunk, 256)).alias("sha"))


def chunk_store(chunks: DataFrame) -> DataFrame:
    """Distinct chunks of :func:`document_chunks`: ``id, sha, n_uses``."""
    uses = chunks.select(F.explode("chunks").alias("c"))
    return uses.groupBy(F.col("c.id").alias("id"), F.col("c.sha").alias("sha")).agg(
        F.count(F.lit(1)).alias("n_uses")
    )


def with_recipes(chunks: DataFrame) -> DataFrame:
    """``doc_id, row, text_sha256, recipe`` with identifiers that are verified to be unambiguous."""
    per_id = chunk_store(chunks).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    ambiguous = per_id.where("n > 1").limit(1).count() > 0
    recipe = F.col("chunks.sha") if ambiguous else F.col("chunks.id")
    return chunks.select("doc_id", "row", "text_sha256", recipe.alias("recipe"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Groups are counted before their shuffle, so a group holding a third of all rows costs one
    row per task. Only groups of two and more go back to the documents, in a join whose large
    partitions adaptive execution splits.
    """
    with Staging(docs.sparkSession) as staging:
        recipes = with_recipes(staging.table(document_chunks(docs, id_col, text_col)))
        order = F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("at"), "doc_id", "row")
        groups = (
            recipes.groupBy("recipe")
            .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
            .where("n > 1")
            .select("recipe", F.col("first.doc_id").alias("keep"), F.col("first.row").alias("keep_row"), "n")
        )
        joined = recipes.join(groups, "recipe", "left")
        alone = F.col("n").isNull()
        result = joined.select(
            "doc_id",
            F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
            "text_sha256",
        )
        return stage_table(result)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` does not keep, all columns as they were."""
    kept = exact_groups(docs, id_col, text_col).where("kept")
    keys = kept.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("_x_id"), F.col("text_sha256").alias("_x_sha"))
    marked = docs.withColumns(
        {
            "_x_id": F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)),
            "_x_sha": F.sha2(normalised(F.col(text_col)), 256),
        }
    )
    # Repeated rows share id and text: the join leaves them side by side, and one of them stays.
    copies = F.row_number().over(Window.partitionBy("_x_id", "_x_sha").orderBy("_x_id", "_x_sha"))
    return (
        marked.join(keys, ["_x_id", "_x_sha"], "left_semi")
        .withColumn("_x_copy", copies)
        .where("_x_copy = 1")
        .select(*docs.columns)
    )
