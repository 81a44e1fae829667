"""Deduplication, class counts, exact seeded ranks, balancing, splitting, sampling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from versemill.functions.keys import DEFAULT_SEED, digest_number, order_digest
from versemill.operators.joins import broadcast_if_small
from versemill.session import stage_table

SLICE_ROWS = 100_000


def dedup_keep_first(
    df: DataFrame,
    text_col: str = "text",
    order_cols: Sequence[str] = ("src", "id"),
    keep_text: bool = True,
) -> DataFrame:
    """Of the rows with equal text, the first in ``order_cols`` order.

    Rows are grouped by the text's SHA-256. Only digests and order columns are shuffled: each map
    task sends at most one short row per distinct text, so copies never meet in bulk. The rows
    themselves are written once and read back past the groups that hold more than one row,
    which are broadcast when they measure small; then no text crosses the network at all.
    With ``keep_text=False`` the other columns travel with their digest, for callers that
    need no text. Rows without text count as equal.
    """
    key = F.coalesce(F.sha2(F.col(text_col), 256), F.lit(""))
    if not keep_text:
        winner = F.min_by(F.struct(*[c for c in df.columns if c != text_col]), F.struct(*order_cols)).alias("row")
        return df.groupBy(key.alias("_digest")).agg(winner).select("row.*")
    rows = stage_table(df.withColumns({"_digest": F.unhex(key), "_row": F.monotonically_increasing_id()}))
    first = F.min(F.struct(*order_cols, "_row"))["_row"]
    groups = rows.groupBy("_digest").agg(first.alias("_first"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    repeated = broadcast_if_small(stage_table(groups.drop("_n")))
    kept = F.col("_first").isNull() | (F.col("_first") == F.col("_row"))
    return rows.join(repeated, "_digest", "left").where(kept).select(*df.columns)


def class_counts(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A1: rows per class (``label, n``)."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def min_class_count(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A2: the size of the smallest class present, as one row (``min_n``)."""
    return class_counts(df, label_col).agg(F.min("n").alias("min_n"))


def distinct_labels(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A3: the classes present."""
    return df.select(label_col).distinct()


def with_class_values(df: DataFrame, table: DataFrame, label_col: str, *value_cols: str) -> DataFrame:
    """``df`` with the values of its class from a per-class ``table``; null where there is none.

    The table has one row per class and is broadcast when it measures small, so the rows of a
    class stay where they are. The measurement runs a job.
    """
    return df.join(broadcast_if_small(table.select(label_col, *value_cols)), label_col, "left")


def class_rank(
    df: DataFrame,
    label_col: str = "label",
    key_cols: Sequence[str] = ("id",),
    seed: int = DEFAULT_SEED,
    hex_digits: int | None = None,
    rank_col: str = "class_rank",
) -> DataFrame:
    """Exact rank 1..n inside each class, in seeded order.

    A window per class would send a class to one task. The leading hex digits of the
    order digest cut each class into ``16 ** hex_digits`` equal slices that keep the
    order, so rows are ranked inside their slice and shifted by the size of the slices
    before it. Unless given, the digits follow from the number of rows (one count), so that
    no slice holds much more than ``SLICE_ROWS``; ``df`` should be a written table.
    """
    if hex_digits is None:
        n_rows, hex_digits = df.count(), 1
        while n_rows > SLICE_ROWS * 16**hex_digits:
            hex_digits += 1
    sliced = df.withColumn("_digest", order_digest(seed, *key_cols)).withColumn(
        "_slice", F.substring("_digest", 1, hex_digits)
    )
    earlier = Window.partitionBy(label_col).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(label_col, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(label_col, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(label_col, "_slice").orderBy("_digest", *key_cols)
    return (
        sliced.withColumn("_position", F.row_number().over(inside))
        .join(offsets, [label_col, "_slice"])
        .withColumn(rank_col, F.col("_offset") + F.col("_position"))
        .select(*df.columns, rank_col)
    )


def balance_classes(
    df: DataFrame,
    label_col: str = "label",
    key_cols: Sequence[str] = ("id",),
    seed: int = DEFAULT_SEED,
    replace: bool = True,
) -> DataFrame:
    """As many rows of every class as the smallest class has.

    ``replace=True`` draws with replacement: draw ``i`` of class ``c`` takes the row of
    rank ``1 + hash(seed, c, i) mod n_c``. The rows ranked 1..m stand for the draw
    numbers, so nothing is generated on the driver. ``(key, draw)`` is the new key.
    ``df`` should hold keys and label only; attach wide columns afterwards.
    """
    ranked = class_rank(df, label_col, key_cols, seed)
    smallest = min_class_count(df, label_col).scalar()
    numbered = ranked.where(F.col("class_rank") <= smallest)
    if not replace:
        return numbered.withColumn("draw", F.lit(1).cast("long")).drop("class_rank")
    sizes = class_counts(df, label_col).withColumnRenamed("n", "_n")
    draws = (
        with_class_values(numbered.select(label_col, F.col("class_rank").alias("draw")), sizes, label_col, "_n")
        .select(
            label_col,
            "draw",
            (F.lit(1) + digest_number(order_digest(seed, label_col, "draw")) % F.col("_n")).alias("class_rank"),
        )
    )
    return ranked.join(draws, [label_col, "class_rank"]).select(*df.columns, "draw")


def _apportion(table: DataFrame, size_col: str, total_col: str, want_col: str, out_col: str) -> DataFrame:
    """Share ``want_col`` rows over the classes in proportion, by largest remainder."""
    product = F.col(size_col).cast("decimal(19,0)") * F.col(want_col).cast("decimal(19,0)")
    everything = Window.partitionBy(F.lit(0))
    by_remainder = Window.partitionBy(F.lit(0)).orderBy(F.desc("_rest"), "label")
    return (
        table.withColumn("_rest", product % F.col(total_col))
        .withColumn("_base", F.floor((product - F.col("_rest")) / F.col(total_col)).cast("long"))
        .withColumn("_spare", F.col(want_col) - F.sum("_base").over(everything))
        .withColumn(
            out_col,
            F.col("_base") + (F.row_number().over(by_remainder) <= F.col("_spare")).cast("long"),
        )
        .drop("_rest", "_base", "_spare")
    )


def split_sizes(
    df: DataFrame,
    label_col: str = "label",
    eval_split: float | None = 0.15,
    test_split: float | None = 0.15,
) -> DataFrame:
    """W5 sizes: ``label, n, n_train, n_eval, n_test`` (one row per class).

    The held-out total is ``ceil(fraction * n)``; with both fractions, the test part is
    then ``ceil(test / (eval + test) * held_out)``. Both totals are met exactly.
    """
    counts = class_counts(df, label_col).withColumnRenamed(label_col, "label")
    totals = Window.partitionBy(F.lit(0))
    held = (eval_split or 0.0) + (test_split or 0.0)
    sized = (
        counts.withColumn("_total", F.sum("n").over(totals))
        .withColumn("_want", F.ceil(F.lit(held) * F.col("_total")).cast("long"))
        .transform(_apportion, "n", "_total", "_want", "_held")
    )
    if eval_split is not None and test_split is not None:
        sized = (
            sized.withColumn("_want_test", F.ceil(F.lit(test_split / held) * F.col("_want")).cast("long"))
            .transform(_apportion, "_held", "_want", "_want_test", "n_test")
        )
    else:
        sized = sized.withColumn("n_test", F.col("_held") if test_split is not None else F.lit(0).cast("long"))
    return sized.select(
        F.col("label").alias(label_col),
        "n",
        (F.col("n") - F.col("_held")).alias("n_train"),
        (F.col("_held") - F.col("n_test")).alias("n_eval"),
        "n_test",
    )


def stratified_split(
    df: DataFrame,
    label_col: str = "label",
    key_cols: Sequence[str] = ("id",),
    eval_split: float | None = 0.15,
    test_split: float | None = 0.15,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Adds ``split`` (train, eval, test) with exact sizes and class shares.

    Inside a class the first rows in seeded order go to test, the next to eval. A
    fraction of ``None`` means that split does not exist.
    """
    if eval_split is None and test_split is None:
        return df.withColumn("split", F.lit("train"))
    cuts = split_sizes(df, label_col, eval_split, test_split).select(
        label_col, F.col("n_test").alias("_n_test"), F.col("n_eval").alias("_n_eval")
    )
    ranked = class_rank(df, label_col, key_cols, seed)
    return (
        with_class_values(ranked, cuts, label_col, "_n_test", "_n_eval")
        .withColumn(
            "split",
            F.when(F.col("class_rank") <= F.col("_n_test"), "test")
            .when(F.col("class_rank") <= F.col("_n_test") + F.col("_n_eval"), "eval")
            .otherwise("train"),
        )
        .select(*df.columns, "split")
    )


def sample_n(
    df: DataFrame, n: int, key_cols: Sequence[str] = ("id",), seed: int = DEFAULT_SEED
) -> DataFrame:
    """``n`` distinct rows (all of them when there are fewer), in seeded order."""
    return df.orderBy(order_digest(seed, *key_cols), *key_cols).limit(n)


def shuffle_rows(
    df: DataFrame, key_cols: Sequence[str] = ("id",), seed: int = DEFAULT_SEED
) -> DataFrame:
    """All rows in seeded order (a distributed range sort)."""
    return df.orderBy(order_digest(seed, *key_cols), *key_cols)


def class_sample(
    df: DataFrame,
    n: int = 50,
    label_col: str = "label",
    key_cols: Sequence[str] = ("id",),
    seed: int = DEFAULT_SEED,
    per_class: bool = True,
    classes: Sequence[int] = (),
) -> DataFrame:
    """Up to ``n`` distinct rows for every class, with ``sample_rank``.

    Rows are ranked by key inside slices of their class first, and only the first ``n`` of each
    slice are ranked per class; the other columns join the chosen keys last. ``per_class=False`` gives each class in ``classes`` a draw from all rows,
    whatever their label.
    """
    if per_class:
        keys = df.select(label_col, *key_cols).withColumn("_digest", order_digest(seed, *key_cols))
        in_slice = Window.partitionBy(label_col, "_slice").orderBy("_digest", *key_cols)
        in_class = Window.partitionBy(label_col).orderBy("_digest", *key_cols)
        first = (
            keys.withColumn("_slice", F.substring("_digest", 1, 2))
            .withColumn("_place", F.row_number().over(in_slice))
            .where(F.col("_place") <= n)
            .withColumn("sample_rank", F.row_number().over(in_class))
            .where(F.col("sample_rank") <= n)
            .select(label_col, *key_cols, "sample_rank")
        )
        if set(df.columns) == {label_col, *key_cols}:
            return first.select(*df.columns, "sample_rank")
        # At most ``n`` keys a class.
        return df.join(broadcast_if_small(first), [label_col, *key_cols]).select(*df.columns, "sample_rank")
    draws = []
    for c in classes:
        digest = order_digest(seed, F.lit(c), *key_cols)
        picked = df.orderBy(digest, *key_cols).limit(n)
        order = Window.partitionBy(F.lit(c)).orderBy(digest, *key_cols)
        draws.append(
            picked.withColumn("sample_rank", F.row_number().over(order)).withColumn(
                label_col, F.lit(c).cast(df.schema[label_col].dataType)
            )
        )
    return reduce(DataFrame.unionByName, draws)
