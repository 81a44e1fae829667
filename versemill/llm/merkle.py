"""Merkle dataset manifest with a proof for every row, by pointer jumping.

Rows become leaves, the leaves of one group (a language) form a tree, and the roots of the
groups, in order of the group, form the tree above them. Levels are hashed 10 at a time:
``2 ** 10`` neighbouring nodes meet in one row, which holds the whole subtree over them. Every
node then has a hop: a pointer to its parent and, as its segment, the sibling it is hashed with.
Each round joins the table of hops with itself: a node takes over the pointer of the node it
points to and appends that node's segment to its own, so distances double and after
``log2(depth)`` rounds every leaf has reached the root, its segments joined from bottom to top.

A round's join sends each leaf to one of the nodes ``2 ** r`` levels above: these are at most
one in ``2 ** 2 ** r`` leaves. Nodes that no later round can point to are left out. The nodes
are broadcast where they measure small; where they do not, there are enough of them that no
single one is pointed to by many leaves. Every round is written, which cuts lineage.

Defined results: leaves ascend by id, null ids first, and equal ids by digest (rows that are
equal in all hashed fields are interchangeable). A null group is a group of its own and comes
first. A lone leaf is its group's root, a lone group's root is the root. Null fields are hashed
as ``-`` and differ from empty ones. Columns that are not hashed do not matter; an empty table
has no root and no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versemill.operators.ranks import ranked
from versemill.operators.joins import BROADCAST_BYTES, broadcast_if_small
from versemill.session import Staging

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that are hashed in one row.
LEVELS = 10
#: The tree over the groups' roots; the groups' own trees count from 0.
TOP = -1
# How a segment's entries begin: hashed alone, sibling on the left, sibling on the right.
_ALONE, _LEFT, _RIGHT = b"\x00", b"\x01", b"\x02"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def record_digest(*values: str | Column) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its byte count, a colon and its text."""
    columns = [F.col(v) if isinstance(v, str) else v for v in values]
    return F.unhex(F.sha2(F.concat(*[_field(c) for c in columns]), 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _parents(nodes: Column) -> Column:
    """Digests one level up: every two neighbours hashed together, a last one alone."""
    pair = lambda i: F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit("")))
    places = F.sequence(F.lit(0), F.floor((F.size(nodes) + 1) / 2).cast("int") - 1)
    return F.transform(places, lambda i: F.sha2(pair(i), 256))


def _depth(n: Column) -> Column:
    """Levels above the leaves of a tree with ``n`` leaves."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.bin(n - 1)))


def _subtrees(nodes: DataFrame, base: int) -> DataFrame:
    """``tree, n, at, levels``: up to ``LEVELS`` levels above ``2 ** LEVELS`` neighbours at level ``base``."""
    leaf = F.struct("at", as_hex(F.col("digest")).alias("digest"))
    held = nodes.groupBy("tree", "n", F.shiftright("at", LEVELS).alias("above")).agg(F.array_sort(F.collect_list(leaf)).alias("leaves"))
    lowest = F.transform("leaves", lambda x: x["digest"])
    steps = F.least(F.lit(LEVELS), _depth(F.col("n")) - base)
    up = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    levels = F.aggregate(up, F.array(lowest), lambda done, _: F.concat(done, F.array(_parents(F.element_at(done, -1)))))
    return held.select("tree", "n", F.col("above").alias("at"), levels.alias("levels"))


def _hops(subtrees: DataFrame, base: int) -> DataFrame:
    """``tree, n, level, at, segment`` of all nodes below the uppermost level of ``subtrees``."""

    def entry(nodes: Column, j: Column) -> Column:
        other = F.unhex(F.get(nodes, j.bitwiseXOR(F.lit(1))))
        left = F.concat(F.lit(_LEFT), other)
        return F.when(other.isNull(), F.lit(_ALONE)).otherwise(F.when(j % 2 == 1, left).otherwise(F.concat(F.lit(_RIGHT), other)))

    def of_level(nodes: Column, i: Column) -> Column:
        first = F.col("at") * F.pow(F.lit(2), F.lit(LEVELS) - i).cast("long")
        return F.transform(
            nodes,
            lambda _, j: F.struct((i + base).alias("level"), (first + j).alias("place"), F.array(entry(nodes, j)).alias("segment")),
        )

    below = F.slice("levels", F.lit(1), F.size("levels") - 1)
    return subtrees.select("tree", "n", F.inline(F.flatten(F.transform(below, of_level)))).withColumnRenamed("place", "at")


def _grow(leaves: DataFrame, depth: int, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """The hops of all nodes but the roots, and the roots ``tree, digest``, of trees over ``tree, n, at, digest``."""
    hops, nodes = [], leaves
    for base in range(0, max(depth, 1), LEVELS):
        held = staging.table(_subtrees(nodes, base))
        hops.append(_hops(held, base))
        uppermost = F.unhex(F.element_at(F.element_at("levels", -1), 1))
        tops = held.select("tree", "n", "at", uppermost.alias("digest"))
        done = _depth(F.col("n")) <= base + LEVELS
        roots = tops.where(done) if base == 0 else roots.unionByName(tops.where(done))
        nodes = tops.where(~done)
    return reduce(DataFrame.unionByName, hops), roots.select("tree", "digest")


def _jump(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``rows`` pointed on: their segment goes on with that of the node pointed to."""
    to = targets.select(
        F.struct("tree", "level", "at").alias("pointer"), F.col("pointer").alias("_next"), F.col("segment").alias("_more")
    )
    moved = rows.where("pointer IS NOT NULL").join(to, "pointer")
    moved = moved.withColumns({"pointer": F.col("_next"), "segment": F.concat("segment", "_more")}).drop("_next", "_more")
    return moved.unionByName(rows.where("pointer IS NULL"))


def _small(targets: DataFrame) -> DataFrame:
    size = targets.agg(F.sum(F.lit(96) + 64 * F.size("segment"))).first()[0] or 0
    return F.broadcast(targets) if size <= BROADCAST_BYTES else targets


def proofs(leaves: DataFrame, staging: Staging) -> tuple[DataFrame, str | None]:
    """``leaves`` with ``subroot`` and ``segment array<binary>``, and the root in hex.

    ``leaves``: ``group`` (string, null allowed), ``order`` (the id) and ``digest``; further columns are carried
    along. A segment has an entry for every level from the leaf to the root: how the node
    below is hashed (alone, after or before its sibling) and the sibling's digest.
    """
    keyed = leaves.withColumn("group", F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit("")))
    keyed = staging.table(keyed)  # dealing by range reads its input twice; texts are hashed once
    placed = ranked(keyed, ["group"], ["order", "digest"], "at", staging, size="n")
    trees = ranked(placed.groupBy("group").agg(F.first("n").alias("n")), [], ["group"], "tree", staging)
    trees = staging.table(trees)
    widest, n_trees = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    if not n_trees:
        return placed.select("*", F.lit("").cast("binary").alias("subroot"), F.array().cast("array<binary>").alias("segment")), None
    depth, top_depth = (widest - 1).bit_length(), (n_trees - 1).bit_length()
    placed = staging.table(placed.join(broadcast_if_small(trees.select("group", "tree")), "group"))
    below, subroots = _grow(placed.select("tree", "n", "at", "digest"), depth, staging)
    subroots = staging.table(subroots)
    over = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(n_trees).alias("n"), F.col("tree").alias("at"), "digest")
    above, root = _grow(over, top_depth, staging)
    # A group's root is a leaf of the upper tree; the root of all has nowhere to point to.
    parent = F.struct("tree", (F.col("level") + 1).alias("level"), F.shiftright("at", 1).alias("at"))
    is_root = F.col("level") + 1 == _depth(F.col("n"))
    subroot = F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("at"))
    nowhere = F.lit(None).cast("struct<tree:bigint,level:int,at:bigint>")
    if top_depth:
        below = below.withColumn("pointer", F.when(is_root, subroot).otherwise(parent))
    else:
        below = below.withColumn("pointer", F.when(is_root, nowhere).otherwise(parent))
    hops = staging.table(below.unionByName(above.withColumn("pointer", F.when(is_root, nowhere).otherwise(parent))).drop("n"))

    # Leaves start at their own node, with nothing in their segment.
    own = F.struct("tree", F.lit(0).alias("level"), "at")
    start = F.when(F.col("n") > 1, own).otherwise(subroot if top_depth else nowhere)
    rows = placed.withColumns({"pointer": start, "segment": F.array().cast("array<binary>")}).drop("at", "n", "group")
    rows = staging.table(_jump(rows, hops))
    height = F.when(F.col("tree") == TOP, F.col("level") + depth).otherwise(F.col("level"))
    for r in range(max(depth + top_depth - 1, 0).bit_length()):
        targets = _small(hops.where(height >= 2**r))
        rows = staging.table(_jump(rows, targets))
        hops = staging.table(_jump(hops.where(height >= 2 ** (r + 1)), targets))
    found = rows.join(broadcast_if_small(subroots.select("tree", F.col("digest").alias("subroot"))), "tree")
    return found.drop("pointer", "tree"), root.select(as_hex(F.col("digest"))).first()[0]


def proof_digest(segment: Column) -> Column:
    """SHA-256 of the siblings of a proof, bottom to top, as hex text."""
    siblings = F.transform(segment, lambda s: F.lower(F.hex(F.substring(s, 2, 32))))
    return F.sha2(F.array_join(siblings, ""), 256)


def folded(digest: Column, segment: Column) -> Column:
    """The root (hex) that follows from a leaf's digest and its proof."""

    def up(below: Column, s: Column) -> Column:
        side, other = F.substring(s, 1, 1), F.lower(F.hex(F.substring(s, 2, 32)))
        left = F.concat(other, below)
        return F.sha2(F.when(side == F.lit(_LEFT), left).otherwise(F.concat(below, other)), 256)

    return F.aggregate(segment, as_hex(digest), up)


def manifest(
    docs: DataFrame, staging: Staging, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", more: Mapping[str, Column] | None = None
) -> tuple[DataFrame, str | None]:
    """Id, ``digest``, ``subroot``, ``segment`` of every row of ``docs``, and the root in hex.

    ``more`` names further columns (made from those of ``docs``) to carry along.
    """
    leaves = docs.select(
        F.col(id_col).alias("order"),
        F.col(group_col).cast("string").alias("group"),
        record_digest(*fields).alias("digest"),
        *[column.alias(name) for name, column in (more or {}).items()],
    )
    found, root = proofs(leaves, staging)
    return found.withColumnRenamed("order", id_col), root


def write_manifest(docs: DataFrame, path: str, staging: Staging, **parameters) -> str | None:
    """Writes leaves with proofs under ``path`` and gives the root, with which any row can be checked alone."""
    found, root = manifest(docs, staging, **parameters)
    found.write.parquet(path)
    return root
