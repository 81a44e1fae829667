"""Prefix trie of conversations: every distinct run of first turns, with who starts with it.

Conversations are sorted by their turns, so those that share a prefix stand next to each other,
and the number of first turns a conversation shares with the one before it (LCP) tells where
prefixes begin: conversation ``p`` is the first with each of its prefixes longer than its LCP.
The members of a prefix of length ``d`` are the longest stretch around ``p`` in which every LCP
is at least ``d``. A sparse table holds the least LCP of every stretch of 1, 2, 4, ... rows, and
each prefix binary-searches its left and its right end in it, independently of all others; no
stack and no order of processing is needed. A second table gives the smallest id of a stretch.

The sorted conversations are cut into blocks of bounded size, and each block is searched on its
own. A prefix that goes on across a border is a piece in each block it touches; only the prefixes
of a block's first and last row can be. A piece finds the block in which its prefix begins by
the same search over a sparse table of the blocks, as joins, and pieces of one prefix are added
up: every number returned is a sum (or a least value) over its pieces.

Turns are told apart by 128 bits of SHA-256; texts never leave the task that reads them. A
conversation's key holds its turns as far as another can share them: turns beyond ``LONG`` are
only kept while the same turn stands at the same depth of another conversation, so one huge
conversation is no huge row; its further prefixes have one member each and need no search.
Conversations with more than ``HOT_TURNS`` turns are numbered by all tasks. The ids that end at
one prefix are hashed in order, as SHA-256 demands, by one task that streams them.

Defined results: turns go by number, null first, and equal numbers by content. Null role or
text is empty. Rows without ``conv_id`` belong to no conversation and are left out. Repeated
rows are turns of their own. A conversation without turns is a member of the root. Columns
other than the four are not read; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from versemill.operators.ranks import counted_up, in_range_order, ranked
from versemill.operators.joins import broadcast_if_small
from versemill.session import Staging

LONG = 256
HOT_TURNS = 1_000_000
BLOCK_ROWS = 1 << 16
BLOCK_TURNS = 1 << 18
BASE_EVERY, MOST_SHARED = 100, 6
_WIDTH = 16
NOTHING = hashlib.sha256(b"").hexdigest()


# --- turns ----------------------------------------------------------------------------


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, mark, points``: 16 bytes that stand for role and text, and the text's code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    spelled = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.substring(F.sha2(spelled, 256), 1, 2 * _WIDTH)).alias("mark"),
        F.char_length(text).cast("long").alias("points"),
    )


def numbered(rows: DataFrame, staging: Staging, hot_turns: int = HOT_TURNS) -> DataFrame:
    """``conv_id, depth, mark, points``: depth counts the turns of a conversation from 1."""
    hot = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_turns).select("conv_id")
    hot = staging.table(hot)
    in_turn = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "mark")
    if not hot.limit(1).count():
        return rows.select("conv_id", F.row_number().over(in_turn).cast("long").alias("depth"), "mark", "points")
    # At most one conversation in ``hot_turns`` rows is hot.
    hot = broadcast_if_small(hot)
    usual = rows.join(hot, "conv_id", "left_anti").withColumn("depth", F.row_number().over(in_turn).cast("long"))
    large = ranked(rows.join(hot, "conv_id", "left_semi"), ["conv_id"], ["turn", "mark"], "place", staging)
    large = large.withColumn("depth", F.col("place") + 1)
    return usual.unionByName(large.drop("place")).select("conv_id", "depth", "mark", "points")


def shared_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string")) % MOST_SHARED).cast("long")


def rebuilt(rows: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of their base: turns, and ``conv_id, n_turns`` for each.

    The base of ``c`` is ``c - c % 100``; its first ``crc32(c) % 6`` turns come first, then
    the own turns of ``c`` after as many. A base serves fewer than 200 conversations.
    """
    rows = staging.table(rows)
    sizes = staging.table(rows.groupBy("conv_id").agg(F.max("depth").alias("own")))
    base = F.col("conv_id") - F.col("conv_id") % BASE_EVERY
    wanted = sizes.withColumns({"base": base, "shared": shared_turns(F.col("conv_id"))})
    found = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    plan = wanted.join(found, "base", "left").withColumn("head", F.least("shared", F.coalesce("base_own", F.lit(0))))
    plan = staging.table(plan.select("conv_id", "base", "own", "shared", "head"))
    lead = rows.where((F.col("conv_id") % BASE_EVERY == 0) & (F.col("depth") < MOST_SHARED)).withColumnRenamed("conv_id", "base")
    from_base = plan.where("head > 0").select("conv_id", "base", "head").join(lead, "base").where("depth <= head")
    own = rows.where(F.col("depth") > shared_turns(F.col("conv_id")))
    moved = own.join(plan.select("conv_id", F.col("head") - F.col("shared")).toDF("conv_id", "by"), "conv_id")
    moved = moved.withColumn("depth", F.col("depth") + F.col("by"))
    columns = ["conv_id", "depth", "mark", "points"]
    left = F.greatest(F.col("own") - F.col("shared"), F.lit(0))
    return (
        from_base.select(*columns).unionByName(moved.select(*columns)),
        plan.select("conv_id", (F.col("head") + left).alias("n_turns")),
    )


def keyed(rows: DataFrame, convs: DataFrame, staging: Staging, long: int = LONG) -> DataFrame:
    """``conv_id, n_turns, key array<binary>, points array<long>``: turns as far as others may share them."""
    beyond = rows.where(F.col("depth") > long)
    places = beyond.groupBy("depth", "mark").agg(F.count(F.lit(1)).alias("n")).where("n = 1")
    first_own = beyond.join(places, ["depth", "mark"]).groupBy("conv_id").agg(F.min("depth").alias("stop"))
    stops = broadcast_if_small(staging.table(first_own))
    kept = rows.join(stops, "conv_id", "left").where("stop IS NULL OR depth < stop")
    entries = kept.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("depth", "mark", "points"))).alias("e"))
    listed = convs.join(entries, "conv_id", "left").withColumn("e", F.coalesce("e", F.array().cast("array<struct<depth:bigint,mark:binary,points:bigint>>")))
    return listed.select("conv_id", "n_turns", F.col("e.mark").alias("key"), F.col("e.points").alias("points"))


# --- sorted conversations and their blocks --------------------------------------------

_SORTED = "conv_id bigint, n_turns bigint, points array<bigint>, lcp int, block bigint, at int, first_key array<binary>, last_key array<binary>"


def _flat(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All turns of a batch of keys as rows of two numbers, and where each key begins."""
    places = keys.offsets.to_numpy().astype(np.int64)
    joined = b"".join(keys.flatten().to_pylist())
    return np.frombuffer(joined, np.uint64).reshape(-1, 2), places - places[0]


def _neighbour_lcp(marks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each key but the first, the number of first turns it shares with the key before it."""
    sizes = np.diff(places)
    both = np.minimum(sizes[1:], sizes[:-1])
    if not both.sum():
        return np.zeros(len(both), np.int64)
    row = np.repeat(np.arange(len(both)), both)
    step = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
    differ = (marks[places[:-2][row] + step] != marks[places[1:-1][row] + step]).any(axis=1)
    lcp = both.copy()
    np.minimum.at(lcp, row[differ], step[differ])
    return lcp


def in_sorted_blocks(convs: DataFrame, block_rows: int = BLOCK_ROWS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Conversations sorted by key and id, each with its ``lcp`` and its ``block`` (ascending).

    A task's first row has no LCP yet (-1); one more row a task carries its first and last key.
    """
    # Of equal keys, those that go on unshared come last.
    ordered = in_range_order(convs, ["key", F.col("n_turns") > F.size("key"), "conv_id"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        block, n_rows, n_turns = task << 32, 0, 0
        first = last = None
        kind = pa.list_(pa.binary())
        names = ["conv_id", "n_turns", "points", "lcp", "block", "at", "first_key", "last_key"]
        for batch in batches:
            keys = batch.column("key")
            if not len(keys):
                continue
            if first is None:
                first = keys[:1]
            chained = pa.concat_arrays([last if last is not None else pa.array([[]], keys.type), keys])
            lcp = _neighbour_lcp(*_flat(chained))
            if last is None:
                lcp[0] = -1
            last = keys[-1:]
            blocks, at = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int32)
            for i, size in enumerate(np.diff(keys.offsets.to_numpy()).tolist()):
                if n_rows and (n_rows >= block_rows or n_turns + size > block_turns):
                    block, n_rows, n_turns = block + 1, 0, 0
                blocks[i], at[i] = block, n_rows
                n_rows, n_turns = n_rows + 1, n_turns + size
            nothing = pa.nulls(len(keys), kind)
            columns = [batch.column(c) for c in ("conv_id", "n_turns", "points")]
            columns += [pa.array(lcp, pa.int32()), pa.array(blocks), pa.array(at), nothing, nothing]
            yield pa.RecordBatch.from_arrays(columns, names)
        if first is not None:
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32()]
            columns = [pa.nulls(1, t) for t in kinds] + [pa.array([task << 32]), pa.nulls(1, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, first.cast(kind), last.cast(kind)], names)

    narrow = ordered.select("conv_id", "n_turns", "key", "points")
    return narrow.mapInArrow(cut, _SORTED)


def _common(a: Column, b: Column) -> Column:
    """Number of equal first elements of two arrays."""
    equal = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    at = F.array_position(equal, F.lit(False))
    return F.when(at == 0, F.size(equal)).otherwise(at - 1).cast("int")


def block_table(rows: DataFrame, staging: Staging) -> DataFrame:
    """``block, number, left_lcp, right_lcp, through``: one row for a block of many conversations.

    ``left_lcp`` and ``right_lcp`` are the LCPs across its borders, -1 at the ends of the
    table. Prefixes up to ``through`` long cover the block and come from the block before.
    """
    in_order = Window.orderBy("block")
    edges = rows.where("first_key IS NOT NULL").select("block", "first_key", F.lag("last_key").over(in_order).alias("before"))
    edges = edges.select("block", F.coalesce(_common(F.col("before"), F.col("first_key")), F.lit(-1)).alias("edge_lcp"))
    first = F.min(F.struct("at", "lcp"))["lcp"]
    body = (
        rows.where("first_key IS NULL")
        .groupBy("block")
        .agg(first.alias("first_lcp"), F.min(F.when(F.col("at") > 0, F.col("lcp"))).alias("inner"))
    )
    joined = body.join(edges, "block", "left").withColumn("left_lcp", F.coalesce("edge_lcp", "first_lcp"))
    right = F.coalesce(F.lead("left_lcp").over(in_order), F.lit(-1))
    through = F.least("left_lcp", F.coalesce("inner", F.lit(2**31 - 1)))
    number = F.row_number().over(in_order) - 1
    return staging.table(joined.select("block", number.alias("number"), "left_lcp", right.alias("right_lcp"), through.alias("through")))


# --- the search inside a block --------------------------------------------------------


class SparseTable:
    """The least value of any stretch, from the least values of stretches of 1, 2, 4, ... entries."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 * (half := 1 << (len(self.levels) - 1)) <= len(values):
            lower = self.levels[-1]
            self.levels.append(np.minimum(lower[:-half], lower[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least value from ``first`` to ``last``, both included."""
        level = np.frexp(last - first + 1)[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            here, table = level == k, self.levels[k]
            out[here] = np.minimum(table[first[here]], table[last[here] - (1 << k) + 1])
        return out

    def right_end(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last ``r`` such that all values after ``start`` up to ``r`` are at least ``depth``."""
        at, n = start.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            fits = at + (1 << k) < n
            step = np.flatnonzero(fits)
            step = step[self.levels[k][at[step] + 1] >= depth[step]]
            at[step] += 1 << k
        return at

    def left_end(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first ``l`` such that all values after ``l`` up to ``start`` are at least ``depth``."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            step = np.flatnonzero(at - (1 << k) >= 0)
            step = step[self.levels[k][at[step] - (1 << k) + 1] >= depth[step]]
            at[step] -= 1 << k
        return at


_PIECES = (
    "block bigint, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, "
    "ends_sha256 string, end_ids array<bigint>, goes_left boolean, goes_right boolean, parent_conv_id bigint, parent_side string"
)


def block_pieces(conv: np.ndarray, total: np.ndarray, sizes: np.ndarray, points: np.ndarray, lcp: np.ndarray, left: int, right: int) -> dict:
    """The pieces of all prefixes in one block of sorted conversations, as columns.

    ``total`` counts a conversation's turns, ``sizes`` those in its key, ``points`` holds the
    code points of all keys' turns in a row; ``left`` and ``right`` are the LCPs across the borders.
    """
    n = len(conv)
    lcp = lcp.copy()
    lcp[0] = -1  # every prefix of the first row, the root too, has a piece that begins here
    table, ids = SparseTable(lcp), SparseTable(conv)
    # A prefix begins at p for each length above its LCP.
    counts = sizes - lcp
    at = np.repeat(np.arange(n), counts)
    first_of = np.cumsum(counts) - counts
    depth = np.arange(len(at)) - first_of[at] + lcp[at] + 1
    begins, ends = table.left_end(at, depth), table.right_end(at, depth)
    members = ends - begins + 1
    goes_left = (begins == 0) & (depth <= left)
    goes_right = (ends == n - 1) & (depth <= right)
    # The parent, one turn shorter, begins at the left end of its own stretch.
    parent_at = table.left_end(at, depth - 1)
    inner = depth > 0
    parent = np.where(inner, first_of[parent_at] + depth - lcp[parent_at] - 2, 0)

    # Rows with equal keys: those that end here come first, then those that go on unshared.
    equal = np.zeros(n, bool)
    equal[1:] = (lcp[1:] == sizes[1:]) & (sizes[1:] == sizes[:-1])
    run = np.cumsum(~equal) - 1
    run_size = np.bincount(run)
    run_tails = np.bincount(run, weights=total > sizes).astype(np.int64)
    whole = depth == sizes[at]
    tails = np.where(whole, run_tails[run[at]], 0)
    enders = np.where(whole, run_size[run[at]], 0) - tails

    inside = np.bincount(parent[inner], minlength=len(at)) + tails
    children = np.bincount(parent[inner & ~goes_left], minlength=len(at)) + tails
    # A piece that goes on to the right leaves it to the next block to tell whether it is a leaf.
    leaves = tails + ((inside == 0) & ~goes_right)
    start = np.cumsum(sizes) - sizes
    last_points = np.zeros(len(at), np.int64)
    last_points[inner] = points[start[at[inner]] + depth[inner] - 1]
    saved = (members - ~goes_left) * last_points
    past = first_of + counts

    def subtree(values: np.ndarray) -> np.ndarray:
        """Sums over each prefix and all that go on from it: longer ones of its row, all of its later rows."""
        upto = np.concatenate([[0], np.cumsum(values)])
        return upto[past[ends]] - upto[: len(at)]

    conv_id = ids.least(begins, ends)
    is_open = goes_left | goes_right
    hashes = np.full(len(at), NOTHING, object)
    for i in np.flatnonzero((enders > 0) & ~is_open):
        hashes[i] = _ids_hash(conv[begins[i] : begins[i] + enders[i]])
    end_ids = [conv[b : b + e] if o and e else None for b, e, o in zip(begins, enders, is_open)]
    side = np.where(goes_left, "L", np.where(goes_right, "R", None))
    columns = {
        "depth": depth, "conv_id": conv_id, "n_convs": members, "n_children": children, "n_leaves": subtree(leaves),
        "saved_tokens": subtree(saved), "ends_sha256": hashes, "end_ids": end_ids, "goes_left": goes_left,
        "goes_right": goes_right, "parent_conv_id": np.where(inner, conv_id[parent], 0), "parent_side": np.where(inner, side[parent], None),
    }
    # The first unshared turn of a conversation whose key stops before its end.
    cut = np.flatnonzero(total > sizes)
    if len(cut):
        key_piece = past[np.maximum.accumulate(np.where(equal, 0, np.arange(n)))[cut]] - 1
        goes_on = total[cut] > sizes[cut] + 1
        first_turns = {
            "depth": sizes[cut] + 1, "conv_id": conv[cut], "n_convs": np.ones(len(cut), np.int64), "n_children": goes_on.astype(np.int64),
            "n_leaves": np.ones(len(cut), np.int64), "saved_tokens": np.zeros(len(cut), np.int64),
            "ends_sha256": np.array([NOTHING if more else _ids_hash([c]) for c, more in zip(conv[cut], goes_on)], object),
            "end_ids": [None] * len(cut), "goes_left": np.zeros(len(cut), bool), "goes_right": np.zeros(len(cut), bool),
            "parent_conv_id": conv_id[key_piece], "parent_side": side[key_piece],
        }
        columns = {k: v + first_turns[k] if isinstance(v, list) else np.concatenate([v, first_turns[k]]) for k, v in columns.items()}
    return columns


def _ids_hash(ids) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def pieces(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """The pieces of all blocks; a block, whose size is bounded, is one group."""
    schema = pa.schema(
        [(c, pa.int64()) for c in "block depth conv_id n_convs n_children n_leaves saved_tokens".split()]
        + [("ends_sha256", pa.string()), ("end_ids", pa.list_(pa.int64())), ("goes_left", pa.bool_()), ("goes_right", pa.bool_())]
        + [("parent_conv_id", pa.int64()), ("parent_side", pa.string())]
    )

    def search(block: pa.Table) -> pa.Table:
        block = block.sort_by("at").combine_chunks()
        listed = block.column("points").combine_chunks()
        number = lambda name: block.column(name).to_numpy().astype(np.int64)
        sizes = np.diff(listed.offsets.to_numpy()).astype(np.int64)
        points = listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        left, right = (block.column(c)[0].as_py() for c in ("left_lcp", "right_lcp"))
        found = block_pieces(number("conv_id"), number("n_turns"), sizes, points, number("lcp"), left, right)
        found["block"] = np.full(len(found["depth"]), block.column("block")[0].as_py())
        return pa.Table.from_arrays([pa.array(found[f.name], f.type) for f in schema], schema=schema)

    borders = broadcast_if_small(blocks.select("block", "left_lcp", "right_lcp"))
    body = rows.where("first_key IS NULL").select("block", "at", "conv_id", "n_turns", "points", "lcp")
    return body.join(borders, "block").groupBy("block").applyInArrow(search, _PIECES)


# --- prefixes that cross borders ------------------------------------------------------


def _with_owner(found: DataFrame, blocks: DataFrame, staging: Staging) -> DataFrame:
    """``found`` with ``owner``: the number of the block in which the prefix of a piece begins.

    A piece that goes left came from the block before; from there the search goes on to the
    left as long as prefixes of its length come through, in steps of halving size.
    """
    n_blocks = blocks.count()
    steps = n_blocks.bit_length()
    in_order = Window.orderBy("number")
    table = blocks.select("block", "number", F.col("through").alias("least_0"))
    for k in range(1, steps):
        before = F.lag(f"least_{k - 1}", 1 << (k - 1), -1).over(in_order)
        table = table.withColumn(f"least_{k}", F.least(f"least_{k - 1}", before))
    table = staging.table(table)
    here = found.join(broadcast_if_small(table.select("block", "number")), "block")
    here = here.withColumn("owner", F.when(F.col("goes_left"), F.col("number") - 1).otherwise(F.col("number")))
    for k in range(steps - 1, -1, -1):
        least = broadcast_if_small(table.select(F.col("number").alias("owner"), F.col(f"least_{k}").alias("least")))
        through = F.col("goes_left") & (F.col("least") >= F.col("depth"))
        here = here.join(least, "owner").withColumn("owner", F.when(through, F.col("owner") - (1 << k)).otherwise(F.col("owner"))).drop("least")
    return here.drop("number")


def _streamed_hashes(ends: DataFrame) -> DataFrame:
    """``owner, depth, ends_sha256`` of ``owner, depth, id``: ids in order, joined by commas, read as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        names = ["owner", "depth", "ends_sha256"]
        row = lambda: pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([digest.hexdigest()])], names)
        for batch in batches:
            owner, depth, ids = (batch.column(c).to_numpy() for c in ("owner", "depth", "id"))
            cuts = np.flatnonzero((owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                if a == b:
                    continue
                spelled = ",".join(map(str, ids[a:b].tolist())).encode()
                if now == (key := (int(owner[a]), int(depth[a]))):
                    digest.update(b"," + spelled)
                    continue
                if now is not None:
                    yield row()
                now, digest = key, hashlib.sha256(spelled)
        if now is not None:
            yield row()

    dealt = ends.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "id")
    return dealt.mapInArrow(run, "owner bigint, depth bigint, ends_sha256 string")


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(convs: DataFrame, staging: Staging, block_rows: int = BLOCK_ROWS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row a prefix of ``convs`` (made by :func:`keyed`): the columns of ``NODE``.

    ``conv_id`` is the smallest member, ``n_convs`` counts members, ``n_leaves`` the prefixes
    without longer ones below (itself included), ``saved_tokens`` sums, over the prefix and all
    below, the code points of the last turn times the members but one; ``ends_sha256`` hashes
    the ids that end here. The intermediate tables belong to ``staging``.
    """
    convs = staging.table(convs)
    rows = staging.table(in_sorted_blocks(convs, block_rows, block_turns))
    blocks = block_table(rows, staging)
    found = staging.table(pieces(rows, blocks))
    crossing = F.col("goes_left") | F.col("goes_right")
    side = F.when(F.col("goes_left"), "L").otherwise("R")
    open_pieces = staging.table(_with_owner(found.where(crossing), blocks, staging).withColumn("side", side))
    start = F.when(~F.col("goes_left"), F.struct("block", "parent_side"))
    merged = open_pieces.groupBy("owner", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max(start).alias("start"),
    )
    merged = staging.table(merged.select("*", "start.block", "start.parent_side").drop("start"))
    smallest = open_pieces.select("block", "depth", "side", "owner").join(merged.select("owner", "depth", F.col("conv_id").alias("at_id")), ["owner", "depth"])
    smallest = staging.table(smallest.select("block", (F.col("depth") + 1).alias("depth"), F.col("side").alias("parent_side"), "at_id"))
    known = broadcast_if_small(smallest)
    # Prefixes inside a block; only their parents may cross.
    inside = found.where(~crossing)
    under = inside.where("parent_side IS NOT NULL").join(known, ["block", "depth", "parent_side"]).withColumn("parent_conv_id", F.col("at_id"))
    plain = inside.where("parent_side IS NULL").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("parent_conv_id")))
    ids = open_pieces.where("end_ids IS NOT NULL").select("owner", "depth", F.explode("end_ids").alias("id"))
    hashes = _streamed_hashes(ids)
    over = merged.join(known, ["block", "depth", "parent_side"], "left").join(hashes, ["owner", "depth"], "left")
    over = over.withColumns({"parent_conv_id": F.col("at_id"), "ends_sha256": F.coalesce("ends_sha256", F.lit(NOTHING))})
    # Turns beyond the first unshared one: one member each.
    tails = convs.select("conv_id", (F.size("key") + 2).cast("long").alias("first"), F.col("n_turns").alias("last"))
    tails = counted_up(tails, "first", "last", "depth")
    at_end = F.col("depth") == F.col("last")
    chain = tails.select(
        "conv_id",
        "depth",
        F.col("conv_id").alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(at_end, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(at_end, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )
    return plain.select(*NODE).unionByName(under.select(*NODE)).unionByName(over.select(*NODE)).unionByName(chain)


def conversation_trie(conversations: DataFrame, staging: Staging) -> DataFrame:
    """The prefix trie of the rebuilt ``conversations`` (``conv_id, turn, role, text``)."""
    rows, convs = rebuilt(numbered(staging.table(turns(conversations)), staging), staging)
    rows, convs = staging.table(rows), staging.table(convs)
    return prefix_trie(keyed(rows, convs, staging), staging)
