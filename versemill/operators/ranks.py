"""Exact places in groups of any size, in built-in functions only.

Rows are dealt by range over (group, order, a row number that only breaks ties), so a group
that holds most rows, or rows that are all equal, still spread over all tasks. Each task numbers
its sorted rows; the first number and the count of every (group, task) cell shift them to places
in the group. Cells number at most the groups plus the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from versemill.operators.joins import broadcast_if_small
from versemill.session import Staging

#: Rows that one row may turn into inside a task; more are dealt out again first.
COPIES = 1 << 16


def in_range_order(rows: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``rows`` sorted over all tasks, with ``_r_at`` (task) and ``_r_in`` (row of the task).

    Rows that tie are interchangeable to the caller; only they are told apart by where they lay.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = [k.alias(f"_r_{i}") for i, k in enumerate(keys)]
    dealt = rows.select("*", *keys, F.monotonically_increasing_id().alias("_r_tie"))
    names = [f"_r_{i}" for i in range(len(keys))] + ["_r_tie"]
    number = F.monotonically_increasing_id()
    return (
        dealt.repartitionByRange(*names)
        .sortWithinPartitions(*names)
        .withColumn("_r_id", number)
        .withColumns({"_r_at": F.shiftright("_r_id", 33), "_r_in": F.col("_r_id").bitwiseAND(F.lit((1 << 33) - 1))})
        .drop("_r_id", *names)
    )


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str | Column], out: str, staging: Staging, size: str | None = None) -> DataFrame:
    """``rows`` with ``out``: the place from 0 in its group (columns without nulls), by ``order``.

    ``size`` names a column for the number of rows of the group. The sorted rows are staged.
    """
    dealt = staging.table(in_range_order(rows, [*group, *order]))
    cells = dealt.groupBy(*group, "_r_at").agg(F.min("_r_in").alias("_r_first"), F.count(F.lit(1)).alias("_r_n"))
    by_task = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = F.sum("_r_n").over(by_task.orderBy("_r_at")) - F.col("_r_n")
    cells = cells.withColumns({"_r_shift": before - F.col("_r_first"), "_r_all": F.sum("_r_n").over(by_task)})
    cells = broadcast_if_small(staging.table(cells.drop("_r_first", "_r_n")))
    placed = dealt.join(cells, [*group, "_r_at"]).withColumn(out, F.col("_r_in") + F.col("_r_shift"))
    if size:
        placed = placed.withColumn(size, F.col("_r_all"))
    return placed.drop("_r_at", "_r_in", "_r_shift", "_r_all")


def counted_up(rows: DataFrame, first: str, last: str, out: str) -> DataFrame:
    """Each row once for every number from ``first`` to ``last`` (none if it is smaller).

    Rows that stand for more than ``COPIES`` numbers are dealt out in runs of that many first.
    """
    plain = rows.where((F.col(last) >= F.col(first)) & (F.col(last) - F.col(first) < COPIES))
    long = rows.where(F.col(last) - F.col(first) >= COPIES)
    runs = long.withColumn("_r_from", F.explode(F.sequence(F.col(first), F.col(last), F.lit(COPIES).cast("long"))))
    runs = runs.repartition("_r_from").withColumn(out, F.explode(F.sequence("_r_from", F.least(F.col(last), F.col("_r_from") + (COPIES - 1)))))
    return plain.withColumn(out, F.explode(F.sequence(first, last))).unionByName(runs.drop("_r_from"))
