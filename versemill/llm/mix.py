"""Mixing sources to target weights, in built-in functions only.

Every source is cut into blocks of about ``block_words`` words by a hash of its rows, which
also permutes them. A source's target in words becomes an exact block quota: whole passes over
all its blocks, then the first blocks of one more pass, the last of them cut at a document.
The quotas are dealt out to output shards by a multivariate-hypergeometric splitting tree: a
node that covers a range of shards draws how many blocks of each source go to its left half,
given the capacity of that half, and hands the rest to the right. A leaf knows how many blocks
of each source its shard takes and where they start in the source's permuted sequence, so
shards draw disjoint blocks without seeing each other. Rows of a shard are then shuffled
inside the shard by a seeded hash.

Nothing depends on task order: permutation and draws are hashes of seed, row content and tree
node, so reruns and retried tasks agree. Per-source rows (one a source) and the blocks of one
source's cut (about ``block_words`` words) are the only groups that meet in one task; running
sums over the blocks of a source are taken in two levels.

Defined results: a null text has size 0, a null source is a source of its own and comes last,
sources of size 0 get target 0, an empty table gives an empty mix, and equal rows are
drawn one by one, as if they were different. Other columns are carried along; helper columns start with ``_x_``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from versemill.functions.binding import bind
from versemill.operators.joins import broadcast_if_small
from versemill.operators.ranks import ranked
from versemill.session import Staging, stage_table

# Parameters of the registered query.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BLOCK_WORDS = 65_536
BLOCKS_PER_SHARD = 64
SEED = 42

BLOCKS_PER_SUM = 1024
_SPACE = r"\x20\x09-\x0D"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in ``text``: each word with the space after it becomes one character."""
    inner = F.ltrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.length(F.regexp_replace(inner, f"[^{_SPACE}]+[{_SPACE}]*", ".")).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with its size in words, the name of its source as a key, and its permutation key."""
    source = F.col(source_col).cast("string")
    return docs.withColumns(
        {
            "_x_source": F.coalesce(F.concat(F.lit("="), source), F.lit("")),
            "_x_size": word_count(F.col(text_col)),
            "_x_key": F.xxhash64(F.lit(SEED), F.col(id_col), source, F.col(text_col)),
        }
    )


def _repeated(rows: DataFrame, staging: Staging) -> DataFrame | None:
    """The keys that several ``rows`` (a staged table) share, if there are any."""
    keys = staging.table(rows.groupBy("_x_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_x_key"))
    return broadcast_if_small(keys) if keys.limit(1).count() else None


def _told_apart(rows: DataFrame, repeated: DataFrame | None, staging: Staging) -> DataFrame:
    """``rows`` with equal rows numbered into their keys, so that each is drawn by itself.

    Equal rows are interchangeable, so any numbering gives the same mix. They are numbered by
    all tasks, however many are equal.
    """
    if repeated is None:
        return rows
    again = ranked(rows.join(repeated, "_x_key", "left_semi"), ["_x_key"], [], "_x_place", staging)
    key = F.when(F.col("_x_place") > 0, F.xxhash64(F.lit(SEED), "_x_key", "_x_place")).otherwise(F.col("_x_key"))
    again = again.withColumn("_x_key", key)
    return rows.join(repeated, "_x_key", "left_anti").select(*rows.columns).unionByName(again.select(*rows.columns))


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row a source: ``_x_source, rank, source_size, n_rows, target``.

    Sources in code-point order take the weights in turn. They share ``share`` times all words
    by weight; a target stops at ``most`` times its source and what is over goes to the others
    by weight. With the sources in order of limit by weight that is one pass: a level of water
    rises until the words are used up, and sources below it are full.
    """
    totals = rows.groupBy("_x_source").agg(
        F.sum("_x_size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")
    )
    # The key of a null source is empty and would sort first.
    by_name = Window.orderBy(F.col("_x_source") == "", "_x_source")
    everywhere = Window.partitionBy()
    rank = (F.row_number().over(by_name) - 1).cast("int")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn("rank", rank).withColumns(
        {
            "weight": F.element_at(turn, F.col("rank") % len(weights) + 1),
            "limit": F.lit(float(most)) * F.col("source_size"),
            "words": F.sum("source_size").over(everywhere) * F.lit(float(share)),
        }
    )
    fill = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    level = (F.col("words") - F.col("full_before")) / F.col("weight_left")
    leveled = (
        ranked.withColumns(
            {
                "step": F.row_number().over(fill),
                "full_before": F.coalesce(F.sum("limit").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
                "weight_left": F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)),
            }
        )
        .withColumn("level", level)
        .withColumn("open", F.col("limit") > F.col("level") * F.col("weight"))
    )
    surface = F.min(F.when(F.col("open"), F.struct("step", "level"))).over(everywhere)["level"]
    target = F.least("limit", F.coalesce(F.col("weight") * F.col("surface"), F.col("limit")))
    return (
        leveled.withColumn("surface", surface)
        .withColumn("target", target)
        .select("_x_source", "rank", "source_size", "n_rows", "target")
    )


def _with_passes(targets: DataFrame, block_words: int) -> DataFrame:
    """Whole passes over a source, words of the last pass, and number of blocks."""
    filled = F.col("source_size") > 0
    passes = F.when(filled, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    # A row counts as a word more, so that rows without words cannot pile up in one block.
    blocks = F.greatest(F.ceil((F.col("source_size") + F.col("n_rows")) / block_words), F.lit(1)).cast("long")
    return targets.withColumns({"passes": passes, "n_blocks": blocks}).withColumn(
        "rest", F.col("target") - F.col("passes") * F.col("source_size")
    )


def _in_blocks(rows: DataFrame, sources: DataFrame) -> DataFrame:
    return rows.join(broadcast_if_small(sources), "_x_source").withColumn(
        "_x_block", F.pmod(F.col("_x_key"), F.col("n_blocks"))
    )


def _running_words(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``before``, the words in earlier blocks of the source."""
    part = F.floor(F.col("_x_block") / BLOCKS_PER_SUM)
    inside = Window.partitionBy("_x_source", "part").orderBy("_x_block").rowsBetween(Window.unboundedPreceding, -1)
    split = blocks.withColumn("part", part).withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    earlier = Window.partitionBy("_x_source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        split.groupBy("_x_source", "part")
        .agg(F.sum("words").alias("w"))
        .select("_x_source", "part", F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("outside"))
    )
    return split.join(parts, ["_x_source", "part"]).withColumn("before", F.col("inside") + F.col("outside")).drop("part", "inside", "outside")


def _cuts(rows: DataFrame, cut_blocks: DataFrame) -> DataFrame:
    """Where the cut block of each source ends: ``_x_source, cut_key, small_size, small_key``.

    Documents are taken in permuted order while they fit; what is then missing is filled with
    the smallest of the others. A row belongs to the cut when its key is at most ``cut_key`` or
    its (size, key) is at most (``small_size``, ``small_key``).
    """
    inside = (
        rows.join(broadcast_if_small(cut_blocks.select("_x_source", "_x_block", "need")), ["_x_source", "_x_block"])
        .groupBy("_x_source", "need", "_x_key", "_x_size")
        .agg((F.count(F.lit(1)) * F.col("_x_size")).alias("w"))
    )
    in_order = Window.partitionBy("_x_source").orderBy("_x_key", "_x_size")
    taken = inside.withColumn("upto", F.sum("w").over(in_order)).withColumn("fits", F.col("upto") <= F.col("need"))
    filled = F.max(F.when(F.col("fits"), F.col("upto"))).over(Window.partitionBy("_x_source"))
    left = taken.withColumn("gap", F.col("need") - F.coalesce(filled, F.lit(0)))
    by_size = Window.partitionBy("_x_source", "fits").orderBy("_x_size", "_x_key")
    small = left.withColumn("small_upto", F.sum("w").over(by_size)).withColumn(
        "small", ~F.col("fits") & (2 * F.col("small_upto") - F.col("w") <= 2 * F.col("gap"))
    )
    last_small = F.max(F.when(F.col("small"), F.struct("_x_size", "_x_key")))
    return (
        small.groupBy("_x_source")
        .agg(F.max(F.when(F.col("fits"), F.col("_x_key"))).alias("cut_key"), last_small.alias("s"))
        .select("_x_source", "cut_key", F.col("s._x_size").alias("small_size"), F.col("s._x_key").alias("small_key"))
    )


# --- the splitting tree ---------------------------------------------------------------


def _log_factorial(n: Column) -> Column:
    x = n.cast("double")
    stirling = x * F.log(x) - x + F.log(F.lit(2 * math.pi) * x) / 2 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5)))
    return F.when(n < 2, F.lit(0.0)).otherwise(stirling)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``marked``, at quantile ``u``.

    The probabilities are summed over the whole range that can occur, or, where that is wide,
    over twelve standard deviations and twelve more on either side.
    """
    p = marked / F.greatest(total, F.lit(1))
    mean = drawn * p
    spread = F.sqrt(F.greatest(mean * (1 - p) * ((total - drawn) / F.greatest(total - 1, F.lit(1))), F.lit(0.0)))
    reach = 12 * spread + 12
    low = F.greatest(F.lit(0).cast("long"), drawn + marked - total, F.floor(mean - reach).cast("long"))
    high = F.least(drawn, marked, F.ceil(mean + reach).cast("long"))

    def log_p(k: Column) -> Column:
        ways = _log_factorial(k) + _log_factorial(marked - k) + _log_factorial(drawn - k)
        return -(ways + _log_factorial(total - marked - drawn + k))

    def choose(b: Column) -> Column:
        middle = F.greatest(b["low"], F.least(b["high"], F.floor(mean).cast("long")))
        weights = F.transform(F.sequence(b["low"], b["high"]), lambda k: F.exp(log_p(k) - log_p(middle)))
        return bind(weights, lambda w: at_quantile(b, w))

    def at_quantile(b: Column, weights: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("k"))

        def pick(mark: Column) -> Column:
            def step(s: Column, w: Column) -> Column:
                upto = s["sum"] + w
                return F.struct(upto.alias("sum"), (s["k"] + F.when(upto < mark, 1).otherwise(0)).cast("long").alias("k"))

            return F.aggregate(weights, start, step, lambda s: F.least(b["low"] + s["k"], b["high"]))

        return bind(F.aggregate(weights, F.lit(0.0), lambda a, w: a + w) * u, pick)

    return bind(F.struct(low.alias("low"), high.alias("high")), choose)


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0**-53)


def _left_quotas(quotas: Column, capacity: Column, lo: Column, hi: Column, seed: int) -> Column:
    """Multivariate-hypergeometric draw of ``capacity`` blocks from ``quotas``, source after source."""
    whole = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q)
    nothing = F.array().cast("array<bigint>")
    start = F.struct(capacity.alias("n"), whole.alias("all"), F.lit(0).alias("i"), nothing.alias("out"))

    def step(s: Column, quota: Column) -> Column:
        drawn = hypergeometric(s["all"], quota, s["n"], _uniform(F.lit(seed), lo, hi, s["i"]))
        return bind(
            drawn,
            lambda x: F.struct(
                (s["n"] - x).alias("n"),
                (s["all"] - quota).alias("all"),
                (s["i"] + 1).alias("i"),
                F.concat(s["out"], F.array(x)).alias("out"),
            ),
        )

    return F.aggregate(quotas, start, step, lambda s: s["out"])


def splitting_tree(quotas: DataFrame, n_shards: int, n_blocks: int, seed: int = SEED) -> DataFrame:
    """``shard, quotas, starts`` from one row ``quotas array<long>`` that sums to ``n_blocks``.

    ``starts`` are positions in the block sequence of each source. Shard ``k`` holds blocks
    ``k * n_blocks // n_shards`` up to the same of ``k + 1``, so sizes differ by one at most.
    """
    zero = F.transform("quotas", lambda q: F.lit(0).cast("long"))
    nodes = quotas.select(F.lit(0).cast("long").alias("lo"), F.lit(n_shards).cast("long").alias("hi"), "quotas", zero.alias("starts"))
    for depth in range(max(n_shards - 1, 0).bit_length()):
        if depth and depth % 6 == 0:
            nodes = nodes.repartition("lo")
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("long")
        edge = lambda at: F.floor(at * F.lit(n_blocks) / n_shards).cast("long")
        split = nodes.withColumn("mid", middle).withColumn(
            "left", _left_quotas(F.col("quotas"), edge(F.col("mid")) - edge(F.col("lo")), F.col("lo"), F.col("hi"), seed)
        )
        right = F.struct(
            F.col("mid").alias("lo"),
            "hi",
            F.zip_with("quotas", "left", lambda q, x: q - x).alias("quotas"),
            F.zip_with("starts", "left", lambda s, x: s + x).alias("starts"),
        )
        left = F.struct("lo", F.col("mid").alias("hi"), F.col("left").alias("quotas"), "starts")
        leaf = F.array(F.struct("lo", "hi", "quotas", "starts"))
        both = F.when(F.col("hi") - F.col("lo") == 1, leaf).otherwise(F.array(left, right))
        nodes = split.select(F.inline(both))
    return nodes.select(F.col("lo").alias("shard"), "quotas", "starts")


def _dealt(blocks: DataFrame, sources: DataFrame, staging: Staging, blocks_per_shard: int, seed: int) -> DataFrame:
    """``_x_source, _x_block, draws array<struct<pass, shard>>`` for every block that is drawn."""
    draws = blocks.join(sources.select("_x_source", "rank", "passes", "n_blocks", "n_last"), "_x_source").select(
        "_x_source",
        "_x_block",
        "rank",
        F.inline(
            F.transform(
                F.sequence(F.lit(0).cast("long"), F.col("passes")),
                lambda p: F.struct(p.alias("pass"), F.col("n_blocks").alias("n"), (p == F.col("passes")).alias("last"), F.col("n_last").alias("m"), F.col("passes").alias("of")),
            )
        ),
    )
    # Each pass goes through the blocks from another place.
    turned = lambda n: F.pmod(F.col("_x_block") + F.abs(F.xxhash64(F.lit(seed), "rank", "pass") % 1_000_003), n)
    place = F.when(F.col("last"), F.col("of") * F.col("n") + turned(F.greatest("m", F.lit(1)))).otherwise(
        F.col("pass") * F.col("n") + turned(F.col("n"))
    )
    draws = draws.where(~F.col("last") | (F.col("_x_block") < F.col("m"))).withColumn("place", place)
    quota = F.col("passes") * F.col("n_blocks") + F.col("n_last")
    quotas = sources.agg(F.array_sort(F.collect_list(F.struct("rank", quota.alias("q")))).alias("a")).select(
        F.transform("a", lambda x: x["q"]).alias("quotas")
    )
    total = sources.agg(F.sum(quota)).first()[0] or 0
    shards = max(1, math.ceil(total / blocks_per_shard))
    leaves = splitting_tree(quotas, shards, total, seed)
    per_source = leaves.select(
        "shard", F.posexplode(F.arrays_zip("quotas", "starts")).alias("rank", "z")
    ).where("z.quotas > 0")
    slots = per_source.select("rank", "shard", F.explode(F.sequence(F.col("z.starts"), F.col("z.starts") + F.col("z.quotas") - 1)).alias("place"))
    return (
        draws.join(slots, ["rank", "place"])
        .groupBy("_x_source", "_x_block")
        .agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("draws"))
    )


def mix_plan(
    rows: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block_words: int = BLOCK_WORDS,
    blocks_per_shard: int = BLOCKS_PER_SHARD,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The mix of ``rows`` (made by :func:`sized`, staged): one table of sources, one of drawn blocks."""
    spark = rows.sparkSession
    with Staging(spark) as staging:
        sources = staging.table(_with_passes(source_targets(rows, weights, share, most), block_words))
        words = _in_blocks(rows.select("_x_source", "_x_size", "_x_key"), sources)
        blocks = words.groupBy("_x_source", "_x_block").agg(F.sum("_x_size").alias("words"))
        in_line = _running_words(blocks).join(sources.select("_x_source", "rest"), "_x_source")
        whole = F.col("before") + F.col("words") <= F.col("rest")
        cut = (F.col("before") < F.col("rest")) & ~whole
        in_line = staging.table(
            in_line.select("_x_source", "_x_block", whole.alias("whole"), cut.alias("cut"), (F.col("rest") - F.col("before")).alias("need"))
        )
        # Blocks without words at the end of the last pass are of no use: it stops at the cut.
        last = in_line.where((F.col("cut") | F.col("whole")) & (F.col("need") > 0))
        n_last = last.groupBy("_x_source").agg((F.max("_x_block") + 1).alias("n_last"))
        cuts = _cuts(words, in_line.where("cut")).join(
            in_line.where("cut").select("_x_source", F.col("_x_block").alias("cut_block")), "_x_source"
        )
        planned = stage_table(
            sources.join(n_last, "_x_source", "left")
            .join(cuts, "_x_source", "left")
            .withColumn("n_last", F.coalesce("n_last", F.lit(0)).cast("long"))
        )
        return planned, stage_table(_dealt(in_line, planned, staging, blocks_per_shard, seed))


def drawn(rows: DataFrame, sources: DataFrame, blocks: DataFrame) -> DataFrame:
    """``rows`` with ``source_size, target`` and ``draws array<struct<pass, shard>>`` (empty if not drawn)."""
    placed = _in_blocks(rows, sources).join(broadcast_if_small(blocks), ["_x_source", "_x_block"], "left")
    small = F.struct("_x_size", "_x_key") <= F.struct(F.col("small_size").alias("_x_size"), F.col("small_key").alias("_x_key"))
    inside = F.coalesce(F.col("_x_key") <= F.col("cut_key"), F.lit(False)) | F.coalesce(F.col("small_size").isNotNull() & small, F.lit(False))
    cut_off = F.coalesce(F.col("_x_block") == F.col("cut_block"), F.lit(False)) & ~inside
    draws = F.coalesce("draws", F.array().cast("array<struct<pass:bigint,shard:bigint>>"))
    return placed.withColumn(
        "draws", F.when(cut_off, F.filter(draws, lambda d: d["pass"] < F.col("passes"))).otherwise(draws)
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **parameters) -> DataFrame:
    """The mix itself: the columns of ``docs``, once for each draw, shard by shard, shuffled inside."""
    # Packed, so that no column of theirs can be taken for one of the plan's.
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_x_row")
    rows = sized(docs, id_col, text_col, source_col).select("_x_source", "_x_size", "_x_key", packed)
    staging = Staging(docs.sparkSession)  # the tables of the plan belong to the result
    keys = staging.table(rows.drop("_x_row"))
    repeated = _repeated(keys, staging)
    sources, blocks = mix_plan(_told_apart(keys, repeated, staging), **parameters)
    rows = _told_apart(rows, repeated, staging)
    seed = parameters.get("seed", SEED)
    draws = drawn(rows, sources, blocks).select("_x_row", "_x_key", F.explode("draws").alias("_x_draw"))
    order = F.xxhash64(F.lit(seed), F.col("_x_draw.shard"), F.col("_x_draw.pass"), "_x_key")
    return (
        draws.withColumn("_x_shard", F.col("_x_draw.shard"))
        .withColumn("_x_order", order)
        .repartition("_x_shard")
        .sortWithinPartitions("_x_shard", "_x_order")
        .select("_x_row.*")
    )


def mixed_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **parameters) -> DataFrame:
    """``doc_id, size, source_size, target, taken, shards``: what :func:`mix` takes of every row."""
    rows = sized(docs, id_col, text_col, source_col)
    staging = Staging(docs.sparkSession)
    rows = staging.table(rows.select(F.col(id_col).alias("doc_id"), "_x_source", "_x_size", "_x_key"))
    rows = _told_apart(rows, _repeated(rows, staging), staging)
    placed = drawn(rows, *mix_plan(rows, **parameters))
    return placed.select(
        "doc_id",
        F.col("_x_size").alias("size"),
        "source_size",
        "target",
        (F.col("_x_size") * F.size("draws")).alias("taken"),
        F.transform("draws", lambda d: d["shard"]).alias("shards"),
    )
