"""Near-duplicate documents by min-max hashing, with every link confirmed on full sets.

A document is the set of its word shingles. Under each of ``PERMUTATIONS`` permutations the
smallest and the largest shingle are kept, so that each hash evaluation gives two values; both
agree between two sets with a probability equal to their similarity. ``ROWS`` values make a
band; two sets of similarity 0.8 miss each other in all bands about once in two million times.

Documents with equal sets become one class before anything is paired. The classes of a band
are compared with one of them first, the pivot. Where a band then still holds classes that are
not connected, a small band is compared pair by pair, and a larger one block against block: its
members are dealt to blocks of about ``BLOCK_BYTES``, and a task compares two blocks on their
full sets at once and returns a spanning forest of the links it finds. Only pairs that cannot
be linked, told by their sizes and by their distances to the pivot, and pairs that are
connected already are passed over. The pairs of a large band are never rows, and no task holds
more than two blocks of it.

Defined results: a null text has no words; fewer words than a shingle make one shingle; an
empty set is linked with nothing; nulls among the ids sort last. Repeated rows are linked like
any equal sets. Other columns are not read; helper columns start with ``_x_``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from versemill.llm.components import connected_components
from versemill.llm.words import gram_hashes, gram_weights, hashed_words, mixed, slices
from versemill.operators.joins import broadcast_if_small, lookup_join
from versemill.session import Staging, stage_table

PERMUTATIONS = 90
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
SHINGLE = 5
THRESHOLD = 80  # of 100
SMALL_BAND = 16
BLOCK_BYTES, ROW_BYTES = 2 << 20, 1024  # a text counts with ROW_BYTES more, which bounds the rows of a block
DENSE_COLUMNS, LIGHT_COLUMN = 4096, 32
LAST_ID = 2**63 - 1

_rng = np.random.default_rng(5)
_XOR = _rng.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)
_ODD = _rng.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
_BAND = _rng.integers(0, 2**64, 2 * PERMUTATIONS, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, begins = hashed_words(texts, lower=True)
    grams = gram_hashes(words, size)
    sets = []
    for start, stop in zip(begins[:-1].tolist(), begins[1:].tolist()):
        n = stop - start
        if n >= size:
            sets.append(np.unique(grams[start : stop - size + 1]))
        else:
            short = words[start:stop] * gram_weights(size, n)[:n]
            sets.append(mixed(short.sum(keepdims=True)) if n else short)
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Band keys of non-empty sets, one row a set."""
    hashes = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets[:-1])])
    values = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64)
    for p in range(PERMUTATIONS):
        permuted = (hashes ^ _XOR[p]) * _ODD[p]
        values[:, p] = np.minimum.reduceat(permuted, first)
        values[:, PERMUTATIONS + p] = np.maximum.reduceat(permuted, first)
    keys = mixed(values) * _BAND
    return mixed(keys.reshape(len(sets), BANDS, ROWS).sum(axis=2) + np.arange(BANDS, dtype=np.uint64))


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def document_signatures(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_a, set_b, bands``; ``set_a, set_b`` are a digest of the set."""
    schema = "doc_id bigint, text_key bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"
    salts = mixed(np.array([11, 12], np.uint64))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), size)
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            bands: list = [[]] * len(sets)
            if len(full):
                for i, row in zip(full.tolist(), signatures([sets[i] for i in full]).view(np.int64)):
                    bands[i] = row
            digests = [np.array([mixed(s + salt).sum() for s in sets], np.uint64).view(np.int64) for salt in salts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes),
                    *map(pa.array, digests),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_key", "n_shingles", "set_a", "set_b", "bands"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), _text_key(text_col).alias("text_key"))
    return rows.mapInArrow(sign, schema)


def _similarities(pairs: DataFrame, size: int) -> DataFrame:
    """``a, b, similarity`` of ``pairs`` (``a, b, text_a, text_b``), on full sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a"):
            sets_a = shingle_sets(batch.column("text_a"), size)
            sets_b = shingle_sets(batch.column("text_b"), size)
            shared = np.zeros(batch.num_rows, np.int64)
            union = np.zeros(batch.num_rows, np.int64)
            for i, (one, two) in enumerate(zip(sets_a, sets_b)):
                both = np.concatenate([one, two])
                both.sort()
                shared[i] = (both[1:] == both[:-1]).sum()
                union[i] = len(both) - shared[i]
            columns = [batch.column("a"), batch.column("b"), pa.array(shared), pa.array(union)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "shared", "total"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a bigint, b bigint, shared bigint, total bigint")


def _alike(one: str, two: str, threshold: int) -> Column:
    """Whether sets of these sizes can be similar enough at all."""
    return 100 * F.least(one, two) >= threshold * F.greatest(one, two)


def _pivot_pairs(members: DataFrame, threshold: int) -> DataFrame:
    """Every member of a band with the band's pivot, its smallest member."""
    return (
        members.where((F.col("id") != F.col("pivot")) & _alike("size", "pivot_size", threshold))
        .select(F.col("pivot").alias("a"), F.col("id").alias("b"))
        .distinct()
    )


def _open_members(members: DataFrame, compared: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of bands that hold several components, with ``label`` and ``apart``, the distance to the pivot."""
    held = members.join(labels, "id", "left").withColumn("label", F.coalesce("root", "id")).drop("root")
    spread = held.groupBy("band").agg(F.min("label").alias("l"), F.max("label").alias("m")).where("l < m")
    apart = compared.select(F.col("a").alias("pivot"), F.col("b").alias("id"), (1 - F.col("shared") / F.col("total")).alias("apart"))
    return held.join(spread.select("band"), "band").join(apart, ["pivot", "id"], "left").withColumn(
        "apart", F.when(F.col("id") == F.col("pivot"), F.lit(0.0)).otherwise(F.col("apart"))
    )


def _cross_pairs(members: DataFrame, threshold: int) -> DataFrame:
    """Pairs of unconnected members of small bands, each pair once.

    The distance of sets obeys the triangle inequality, so members whose distances to the pivot
    differ by more than a link's distance cannot be linked. A pair is taken in the first band
    that it shares.
    """
    names = ["id", "label", "size", "apart", "bands"]
    c = members.select("band", *[F.col(x).alias(f"c_{x}") for x in names])
    reach = 1 - threshold / 100 + 1e-9
    near = F.coalesce(F.abs(F.col("apart") - F.col("c_apart")) <= reach, F.lit(True))
    first = F.array_position(F.zip_with("bands", "c_bands", lambda x, y: x == y), True) == F.col("place") + 1
    wanted = (F.col("id") < F.col("c_id")) & (F.col("label") != F.col("c_label")) & _alike("size", "c_size", threshold) & near & first
    return members.join(c, "band").where(wanted).select(F.col("id").alias("a"), F.col("c_id").alias("b")).distinct()


def shared_sizes(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``one`` with every set of ``two``.

    Values in few sets are counted entry by entry, the others as products of 0/1 matrices of
    ``DENSE_COLUMNS`` values at a time.
    """
    rows = [np.repeat(np.arange(len(sets)), [len(s) for s in sets]) for sets in (one, two)]
    values, columns = np.unique(np.concatenate([*one, *two]), return_inverse=True)
    columns = np.split(columns, [len(rows[0])])
    often = [np.bincount(c, minlength=len(values)) for c in columns]
    both = often[0] * often[1]
    light = (both > 0) & (both <= LIGHT_COLUMN)
    at, by = [(r[light[c]], c[light[c]]) for r, c in zip(rows, columns)]
    order = np.argsort(by[1], kind="stable")
    first = np.searchsorted(by[1][order], at[1])
    times = often[1][at[1]]
    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    cells = np.repeat(at[0], times) * len(two) + by[0][order][np.repeat(first, times) + within]
    shared = np.bincount(cells, minlength=len(one) * len(two)).reshape(len(one), len(two))
    number = np.cumsum(both > LIGHT_COLUMN) - 1
    heavy = int((both > LIGHT_COLUMN).sum())
    for low in range(0, heavy, DENSE_COLUMNS):
        parts = []
        for sets, r, c in zip((one, two), rows, columns):
            picked = (both[c] > LIGHT_COLUMN) & (number[c] >= low) & (number[c] < low + DENSE_COLUMNS)
            part = np.zeros((len(sets), min(DENSE_COLUMNS, heavy - low)), np.float32)
            part[r[picked], number[c[picked]] - low] = 1
            parts.append(part)
        shared += np.rint(parts[0] @ parts[1].T).astype(np.int64)
    return shared


def spanning_links(linked: np.ndarray) -> list[tuple[int, int]]:
    """A forest over the nodes of a symmetric link matrix, as pairs (root, other node)."""
    unseen = linked.any(axis=1)
    forest = []
    for root in np.flatnonzero(unseen).tolist():
        if not unseen[root]:
            continue
        unseen[root] = False
        waiting = [root]
        while waiting:
            found = np.flatnonzero(linked[waiting.pop()] & unseen).tolist()
            unseen[found] = False
            forest += [(root, x) for x in found]
            waiting += found
    return forest


def _block_links(members: DataFrame, texts: DataFrame, size: int, threshold: int, staging: Staging) -> DataFrame:
    """``a, b`` links that connect what the links of ``members`` (``band, id, label``) connect."""
    weighed = staging.table(members.select("band", "id", "label").join(texts.select("id", "bytes"), "id"))
    counts = weighed.groupBy("band").agg(F.ceil(F.sum(F.col("bytes") + ROW_BYTES) / BLOCK_BYTES).alias("n_blocks"))
    block = F.pmod(F.xxhash64(F.lit(7), "id"), F.col("n_blocks"))
    placed = weighed.join(broadcast_if_small(counts), "band").withColumn("block", block)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("other")
    dealt = placed.select("band", "id", "label", "block", every).join(texts.select("id", "text"), "id")
    dealt = dealt.select("band", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "id", "label", "text")

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, labels, block = (table.column(c).to_numpy() for c in ("id", "label", "block"))
        one, two = key[1].as_py(), key[2].as_py()
        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        forest = []
        if len(left) and len(right) and (labels != labels[0]).any():
            sets = [s for part in table.column("text").chunks for s in shingle_sets(part, size)]
            sizes = np.array([len(s) for s in sets])
            shared = shared_sizes([sets[i] for i in left], [sets[i] for i in right])
            total = sizes[left][:, None] + sizes[right][None, :] - shared
            hit = (100 * shared >= threshold * total) & (labels[left][:, None] != labels[right][None, :])
            linked = np.zeros((len(ids), len(ids)), bool)
            linked[np.ix_(left, right)] = hit
            forest = spanning_links(linked | linked.T)
        a, b = (ids[[x[i] for x in forest]].astype(np.int64) if forest else np.zeros(0, np.int64) for i in (0, 1))
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("band", "one", "two").applyInArrow(compare, "a bigint, b bigint")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """``row, doc_id, text_key, n_shingles, component_id, first_row`` for every row of ``docs``.

    ``component_id`` is the smallest id connected with the row, ``first_row`` one row that has it.
    """
    spark = docs.sparkSession
    with Staging(spark) as staging:
        rows = staging.table(
            document_signatures(docs, id_col, text_col, size).withColumn("row", F.monotonically_increasing_id())
        )
        set_key = ["set_a", "set_b", "n_shingles"]
        classes = staging.table(
            rows.where("n_shingles > 0").groupBy(*set_key).agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("copies"))
        )
        named = rows.join(classes.select("id"), rows["row"] == classes["id"], "left_semi")
        bands = staging.table(
            named.select(F.col("row").alias("id"), F.col("n_shingles").alias("size"), F.posexplode("bands").alias("place", "band"))
        )
        shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("pivot")).where("n > 1")
        members = staging.table(bands.join(shared, "band"))
        candidates = staging.table(members.select("id").distinct())
        where = rows.join(broadcast_if_small(candidates), rows["row"] == candidates["id"]).select("id", "doc_id", "text_key")
        texts = docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), _text_key(text_col).alias("text_key")
        )
        same_row = texts["doc_id"].eqNullSafe(F.col("w.doc_id")) & (texts["text_key"] == F.col("w.text_key"))
        texts = staging.table(
            texts.join(broadcast_if_small(staging.table(where)).alias("w"), same_row).select("id", F.octet_length("text").alias("bytes"), "text")
        )

        def compared(pairs: DataFrame) -> DataFrame:
            with_a = staging.table(pairs).join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
            with_b = with_a.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
            return staging.table(_similarities(with_b, size))

        linked = (F.col("shared") > 0) & (100 * F.col("shared") >= threshold * F.col("total"))
        sizes = staging.table(members.where("id = pivot").select("pivot", F.col("size").alias("pivot_size")).distinct())
        to_pivot = compared(_pivot_pairs(members.join(sizes, "pivot"), threshold))
        links = to_pivot.where(linked).select("a", "b")
        labels = connected_components(links)
        signed = staging.table(rows.join(candidates, rows["row"] == candidates["id"]).select("id", "bands"))
        small = staging.table(_open_members(members.where(F.col("n").between(3, SMALL_BAND)), to_pivot, labels))
        found = compared(_cross_pairs(small.join(signed, "id"), threshold))
        links = links.unionByName(found.where(linked).select("a", "b"))
        labels = connected_components(links)
        large = staging.table(_open_members(members.where(F.col("n") > SMALL_BAND), to_pivot, labels))
        links = links.unionByName(staging.table(_block_links(large, texts, size, threshold, staging)))
        labels = connected_components(links)
        # Rows without words, and classes of one row that are linked with nothing, need no lookup.
        rooted = classes.join(labels, "id", "left").where("copies > 1 OR root IS NOT NULL")
        rooted = broadcast_if_small(staging.table(rooted.select(*set_key, F.coalesce("root", "id").alias("root"))))
        narrow = rows.select("row", "doc_id", "text_key", *set_key)
        grouped = staging.table(narrow.where("n_shingles > 0").join(rooted, set_key, "left"))
        connected = grouped.where("root IS NOT NULL")
        order = F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("at"), "doc_id", "row")
        firsts = staging.table(connected.groupBy("root").agg(F.min(order).alias("f")).select("root", "f.doc_id", "f.row").toDF("root", "f_id", "f_row"))
        # A component may hold most rows: its first row is broadcast, or copied to salts.
        small = broadcast_if_small(firsts)
        found = connected.join(small, "root") if small is not firsts else lookup_join(connected, firsts, "root", "row")
        alone = grouped.where("root IS NULL").drop("root").unionByName(narrow.where("n_shingles = 0"))
        alone = alone.withColumns({"f_id": F.col("doc_id"), "f_row": F.col("row")})
        columns = ["row", "doc_id", "text_key", "n_shingles", F.col("f_id").alias("component_id"), F.col("f_row").alias("first_row")]
        return stage_table(found.select(*columns).unionByName(alone.select(*columns)))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest id; all columns as they were."""
    classes = near_classes(docs, id_col, text_col, size, threshold)
    kept = classes.where("row = first_row").groupBy(F.coalesce("doc_id", F.lit(LAST_ID)).alias("_x_id"), F.col("text_key").alias("_x_key"))
    kept = kept.agg(F.count(F.lit(1)).alias("_x_rows"))
    marked = docs.withColumns({"_x_id": F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)), "_x_key": _text_key(text_col)})
    # Repeated rows share id and text; as many of them stay as were chosen.
    number = F.row_number().over(Window.partitionBy("_x_id", "_x_key").orderBy("_x_id", "_x_key"))
    return marked.join(kept, ["_x_id", "_x_key"]).withColumn("_x_number", number).where("_x_number <= _x_rows").select(*docs.columns)
