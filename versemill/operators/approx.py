"""Approximate k-nearest neighbours by multi-probe random hyperplanes and a cosine rerank.

Each of ``tables`` hash tables cuts space by ``bits`` hyperplanes through the origin; the sides a
vector lies on are its bucket. A query looks into its own bucket and into those that differ from
it in any of the ``probes`` hyperplanes it lies closest to, where a near vector may have fallen on
the other side. What it meets is compared by exact cosine, so distances are exact and only a
neighbour that shares no probed bucket can be missed; :func:`versemill.operators.knn.knn_join` is
the exact way.

Buckets are counted first (at most ``tables * 2 ** bits`` numbers) and cut into blocks, queries into
batches, as in the exact join, so a bucket that holds most vectors becomes many groups.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from versemill.functions.keys import DEFAULT_SEED
from versemill.operators import knn

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLES, BITS, PROBES = 8, 4, 2


def hyperplanes(tables: int, bits: int, dim: int, seed: int = DEFAULT_SEED) -> np.ndarray:
    """Normals with entries 1 and -1: the first half byte of a digest of seed, table, bit and place."""
    signs = [
        1.0 if md5(f"{seed}:{t}:{b}:{i}".encode()).hexdigest()[0] < "8" else -1.0
        for t in range(tables) for b in range(bits) for i in range(dim)
    ]
    return np.array(signs).reshape(tables, bits, dim)


@dataclass(frozen=True)
class HashLayout:
    """Hyperplanes, and how many blocks and batches each (table, bucket) is cut into."""

    planes: np.ndarray
    probes: int
    blocks: np.ndarray
    batches: np.ndarray

    def _sides(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        margins = np.einsum("nd,tbd->ntb", vectors, self.planes)
        weights = 1 << np.arange(self.planes.shape[1])
        own = (margins > 0) @ weights + (np.arange(len(self.planes)) << self.planes.shape[1])
        return margins, own

    def own_cells(self, vectors: np.ndarray) -> np.ndarray:
        """``(vectors, tables)``: the bucket of each vector in each table."""
        return self._sides(vectors)[1]

    def probed_cells(self, vectors: np.ndarray) -> np.ndarray:
        """``(vectors, tables * 2 ** probes)``: buckets across any of the nearest hyperplanes."""
        margins, own = self._sides(vectors)
        nearest = np.argsort(np.abs(margins), axis=2, kind="stable")[:, :, : self.probes]
        crossed = (np.arange(1 << self.probes)[:, None] >> np.arange(self.probes)) & 1
        flips = ((1 << nearest)[:, :, None, :] * crossed).sum(axis=3)
        return (own[:, :, None] ^ flips).reshape(len(vectors), -1)

    @property
    def first_group(self) -> np.ndarray:
        sizes = self.blocks * self.batches
        return np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)


def _cell_counts(rows: DataFrame, vector_col: str, layout: HashLayout, is_query: bool) -> np.ndarray:
    n_cells = len(layout.planes) << layout.planes.shape[1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_cells, np.int64)
        for batch in batches:
            vectors = knn.matrix_of(batch.column(0))
            if len(vectors):
                cells = layout.probed_cells(vectors) if is_query else layout.own_cells(vectors)
                total += np.bincount(cells.ravel(), minlength=n_cells)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["cell", "n"])

    found = rows.select(vector_col).mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(n_cells, np.int64)
    for row in found.collect():  # one row a bucket
        counts[row["cell"]] = row["n"]
    return counts


def _assigned(layout: HashLayout, schema: T.StructType, is_query: bool):
    """Each row with every group it belongs to: a corpus row in all batches, a query in all blocks of a cell."""
    names = schema.names

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = layout.first_group
        for whole in batches:
            # A row is copied for every table and probe: short slices bound a batch.
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                vectors = knn.matrix_of(batch.column("vector"))
                if not len(vectors):
                    continue
                spread = batch.column("spread").to_numpy()
                cells = layout.probed_cells(vectors) if is_query else layout.own_cells(vectors)
                row, cell = np.repeat(np.arange(len(cells)), cells.shape[1]), cells.ravel()
                useful = (layout.blocks[cell] > 0) & (layout.batches[cell] > 0)
                row, cell = row[useful], cell[useful]
                copies = layout.blocks[cell] if is_query else layout.batches[cell]
                within = knn._counting_within(copies)
                row, cell = np.repeat(row, copies), np.repeat(cell, copies)
                if is_query:
                    group = first[cell] + within * layout.batches[cell] + spread[row] % layout.batches[cell]
                else:
                    group = first[cell] + spread[row] % layout.blocks[cell] * layout.batches[cell] + within
                for start in range(0, len(row), 20_000):
                    rows = pa.array(row[start : start + 20_000])
                    columns = [pa.array(group[start : start + 20_000]), *[batch.column(n).take(rows) for n in names[1:]]]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return assign


def knn_join_approx(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    tables: int = TABLES,
    bits: int = BITS,
    probes: int = PROBES,
    query_id: str = "id",
    corpus_id: str = "id",
    vector_col: str = "embedding",
    corpus_cols: Sequence[str] = (),
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Of the corpus rows a query meets in its buckets, the ``k`` nearest by cosine distance.

    Columns ``qid, rank, nid, distance`` and ``corpus_cols`` prefixed ``n_``. Ties go to the smaller id.
    A query that meets fewer than ``k`` rows has fewer lines. More tables or probes find more;
    more bits make smaller buckets. Vectors are checked as in the exact join, and zero vectors,
    which have no direction, are at distance 1 to everything they meet.
    """
    if not 0 <= probes <= bits:
        raise ValueError("probes are hyperplanes of one table, so there are at most as many as bits")
    n_queries, n_rows, dim = knn.check_vectors(queries, corpus, vector_col)
    carried = [F.col(c).alias(f"n_{c}") for c in corpus_cols]
    right = corpus.select(F.xxhash64(F.lit("block"), corpus_id).alias("spread"), F.col(corpus_id).alias("nid"), F.col(vector_col).alias("vector"), *carried)
    left = queries.select(F.xxhash64(F.lit("batch"), query_id).alias("spread"), F.col(query_id).alias("qid"), F.col(vector_col).alias("vector"))
    names = [f"n_{c}" for c in corpus_cols]
    schema = T.StructType([left.schema["qid"], right.schema["nid"], T.StructField("distance", T.DoubleType()), *[right.schema[n] for n in names]])
    if not n_queries or not n_rows:
        return knn._ranked(queries.sparkSession.createDataFrame([], schema), k, (), corpus_cols)
    none = np.zeros(tables << bits, np.int64)
    layout = HashLayout(hyperplanes(tables, bits, dim, seed), probes, none, none)
    block_rows = max(1, knn.BLOCK_BYTES // (8 * dim))
    held = _cell_counts(corpus, vector_col, layout, is_query=False)
    asked = _cell_counts(queries, vector_col, layout, is_query=True)
    layout = HashLayout(layout.planes, probes, -(-held // block_rows), -(-asked // block_rows))

    group = T.StructField("group", T.LongType())
    right_schema = T.StructType([group, *right.schema.fields[1:]])
    left_schema = T.StructType([group, *left.schema.fields[1:]])

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        found = ()
        if q.num_rows and c.num_rows:
            order = np.unique(c.column("nid").to_numpy(), return_inverse=True)[1]
            one = knn.searchable(knn.matrix_of(q.column("vector")), "cosine", is_query=True)
            two = knn.searchable(knn.matrix_of(c.column("vector")), "cosine", is_query=False)
            found = knn.nearest_in_block(one, np.full(len(one), np.inf), two, order, "cosine", k)
        return knn.joined_pairs(q.drop_columns(["vector"]), c.drop_columns(["vector"]), found, schema.names)

    tasks = int(min(knn.MAX_TASKS, max(1, (layout.blocks * layout.batches).sum())))
    placed_left = left.mapInArrow(_assigned(layout, left_schema, True), left_schema).repartition(tasks, "group").groupBy("group")
    placed_right = right.mapInArrow(_assigned(layout, right_schema, False), right_schema).repartition(tasks, "group").groupBy("group")
    met = placed_left.cogroup(placed_right).applyInArrow(search, schema)
    # A pair is met in every table in which it shares a bucket.
    return knn._ranked(met.dropDuplicates(["qid", "nid"]), k, (), corpus_cols)
