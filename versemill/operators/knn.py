"""Exact k-nearest-neighbour join and what is read from neighbours.

The join is exact for any data and never ranks all pairs in one place:

1. A bounded set of pivots cuts the corpus into cells; per cell Spark gathers the row
   count, the inner and outer radius and the k smallest distances to the pivot.
2. From its distances to the pivots and to a sample of the corpus a query gets an upper bound
   for its k-th neighbour distance. The triangle inequality then rules out each cell that lies farther away.
3. Neighbouring cells are packed into blocks of bounded size, cells beyond that are cut into
   several; queries are cut into batches of bounded size. A query is copied once a block it
   reaches, not once a cell. A (block, batch) group goes through its cells with the queries
   that reach each, by matrix products in single precision whose rounding is allowed for, and
   keeps the k nearest per query, measured in double precision.
4. A window keeps the k nearest over all blocks of a query.

Queries that measure small (``FEW_BYTES``) need none of that: they travel with the tasks that
scan the corpus, each task keeps the k nearest it has seen per query, and only those are
shuffled.

A cell that holds a third of the corpus becomes many blocks, so no task grows with it.
Cosine distance is searched as Euclidean distance of unit vectors (d_e^2 = 2 d_cos).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from versemill.functions.vectors import vote_shares
from versemill.operators.joins import lookup_join, wanted_rows
from versemill.operators.sampling import with_class_values
from versemill.session import stage_table

# Task functions travel with their code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

METRICS = ("cosine", "euclidean")
MAX_PIVOTS = 1024
# Both sides of a group are cut to this size. Shuffled copies shrink as it grows, because
# each block meets fewer batches, so it is as large as a task can hold with ease: a group
# needs some eight times as much.
BLOCK_BYTES = 32 * 1024 * 1024
#: Cells are packed into so many blocks at least, if there are as many, to occupy a cluster.
MIN_BLOCKS = 24
PAIR_BUDGET = 1_000_000
#: Products are made in squares of this side, which a core's cache holds.
TILE = 1024
#: A query with more shortlisted rows in a square is looked at more closely.
CROWD = 32
#: Queries up to this size are sent to the corpus instead of being joined with it.
FEW_BYTES = 4 * 1024 * 1024
MAX_TASKS = 50_000
REL_TOLERANCE = 1e-6


def matrix_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equally long vectors as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    rows = len(column)
    if not rows:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if flat.size % rows:
        raise ValueError("vectors of different length in one column")
    return flat.reshape(rows, -1)


def check_vectors(queries: DataFrame, corpus: DataFrame, vector_col: str) -> tuple[int, int, int]:
    """Numbers of queries and corpus rows, and the length of the vectors; one aggregate a side.

    Raises when the two sides are not finite vectors of one length.
    """
    vector = F.col(vector_col)
    lengths, counts = set(), []
    for side, df in (("queries", queries), ("corpus", corpus)):
        bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        found = df.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(vector.isNull()).alias("null vectors"),
            F.count_if(bad).alias("vectors with null or non-finite numbers"),
            F.min(F.size(vector)).alias("low"),
            F.max(F.size(vector)).alias("high"),
        ).first()
        for what in ("null vectors", "vectors with null or non-finite numbers"):
            if found[what]:
                raise ValueError(f"the {side} hold {found[what]} {what}")
        lengths |= {n for n in (found["low"], found["high"]) if n is not None}
        counts.append(found["n"])
    if len(lengths) > 1:
        raise ValueError(f"vectors of different length: {min(lengths)} to {max(lengths)}")
    return counts[0], counts[1], max(lengths, default=0)


def searchable(vectors: np.ndarray, metric: str, is_query: bool) -> np.ndarray:
    """Vectors whose Euclidean distance orders like ``metric``.

    For cosine they are scaled to length one. A zero vector has cosine distance 1 to
    everything; two spare coordinates, one per side, give it exactly that.
    """
    if metric == "euclidean" or not len(vectors):
        return vectors
    out = np.zeros((len(vectors), vectors.shape[1] + 2))
    step = max(1, PAIR_BUDGET // max(1, vectors.shape[1]))
    for start in range(0, len(vectors), step):
        part = vectors[start : start + step]
        norms = np.sqrt((part * part).sum(axis=1))
        zero = norms == 0.0
        np.divide(part, np.where(zero, 1.0, norms)[:, None], out=out[start : start + step, :-2])
        out[start : start + step, -2 + int(is_query)] = zero
    return out


def _row_slices(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch``, so many at a time that ``width`` numbers for each fit ``PAIR_BUDGET``."""
    step = max(1, PAIR_BUDGET // max(1, width))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d2 = (-2.0 * a) @ b.T
    d2 += (a * a).sum(axis=1)[:, None]
    d2 += (b * b).sum(axis=1)[None, :]
    return np.maximum(d2, 0.0, out=d2)


def _scale(a: np.ndarray, b: np.ndarray) -> float:
    """Magnitude that rounding errors of a distance between ``a`` and ``b`` relate to."""
    return 1.0 + _longest(a) + _longest(b)


def _longest(vectors: np.ndarray) -> float:
    step = max(1, PAIR_BUDGET // max(1, vectors.shape[1]))
    tops = [(part * part).sum(axis=1).max() for part in (vectors[at : at + step] for at in range(0, len(vectors), step))]
    return float(np.sqrt(max(tops, default=0.0)))


@dataclass(frozen=True)
class CellLayout:
    """Driver-side summary of the corpus cells; its size depends on pivots and k only.

    ``sample`` holds rows of the corpus, pivots first: its k nearest bound a query's k-th distance.
    ``blocks`` tells how many blocks each cell would fill, ``batches`` how many batches of
    queries the blocks of its pack meet, none if no query reaches the cell. Cells of one
    ``pack`` lie in the same blocks.
    """

    metric: str
    k: int
    pivots: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    nearest: np.ndarray
    blocks: np.ndarray
    batches: np.ndarray
    pack: np.ndarray
    pack_blocks: np.ndarray
    pack_batches: np.ndarray
    sample: np.ndarray

    @property
    def first_group(self) -> np.ndarray:
        """The first group of each pack."""
        sizes = self.pack_blocks * self.pack_batches
        return np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)

    def packs_of(self, wanted: np.ndarray) -> np.ndarray:
        """The packs that hold any of the ``wanted`` cells, row by row."""
        members = self.pack[:, None] == np.arange(len(self.pack_blocks))[None, :]
        return (wanted.astype(np.float32) @ members.astype(np.float32)) > 0

    def reach(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query: bound of the k-th neighbour distance, and the cells within it."""
        to_pivot = np.sqrt(squared_distances(vectors, self.pivots))
        slack = REL_TOLERANCE * _scale(vectors, self.pivots)
        bound = np.full(len(vectors), np.inf)
        lists = self.nearest[np.isfinite(self.nearest).any(axis=1)]
        owners = np.flatnonzero(np.isfinite(self.nearest).any(axis=1))
        if np.isfinite(lists).sum() >= self.k:
            step = max(1, PAIR_BUDGET // max(1, lists.size))
            for start in range(0, len(vectors), step):
                part = to_pivot[start : start + step][:, owners]
                through = (part[:, :, None] + lists[None, :, :]).reshape(len(part), -1)
                bound[start : start + step] = np.partition(through, self.k - 1, axis=1)[:, self.k - 1]
        nearest = _Search(vectors, bound + slack, self.metric, self.k)
        nearest.look(np.arange(len(vectors)), self.sample, np.arange(len(self.sample)))
        bound = nearest.bounds + slack
        return bound, (self._lower(to_pivot, slack) <= bound[:, None]) & (self.blocks > 0)[None, :]

    def lower(self, vectors: np.ndarray) -> np.ndarray:
        """Per query and cell: no row of the cell is nearer than this."""
        return self._lower(np.sqrt(squared_distances(vectors, self.pivots)), REL_TOLERANCE * _scale(vectors, self.pivots))

    def _lower(self, to_pivot: np.ndarray, slack: float) -> np.ndarray:
        shell = np.maximum(to_pivot - self.outer[None, :], self.inner[None, :] - to_pivot)
        plane = (to_pivot - to_pivot.min(axis=1, keepdims=True)) / 2.0
        return np.maximum(np.maximum(shell, plane), 0.0) - slack


def _nearest_cell(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distances = np.sqrt(squared_distances(vectors, pivots))
    return distances.argmin(axis=1), distances


def _sampled_rows(corpus: DataFrame, id_col: str, vector_col: str, n_rows: int, dim: int) -> tuple[np.ndarray, int]:
    """A seeded sample of corpus vectors, and how many of them, the first, are pivots.

    Both are bounded by count and by bytes.
    """
    by_bytes = BLOCK_BYTES // 8 // (8 * max(1, dim))
    n_pivots = max(1, min(MAX_PIVOTS, by_bytes, int(np.sqrt(n_rows)) // 4))
    wanted = max(n_pivots, min(by_bytes, n_rows // 16))
    rows = corpus.select(vector_col).orderBy(F.xxhash64(F.lit("pivot"), id_col), id_col).limit(wanted)
    return matrix_of(rows.toArrow().column(0)), n_pivots


def _cell_summary(corpus: DataFrame, vector_col: str, pivots: np.ndarray, metric: str, k: int) -> dict:
    n_cells = len(pivots)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(n_cells, dtype=np.int64)
        inner = np.full(n_cells, np.inf)
        outer = np.zeros(n_cells)
        near = np.full((n_cells, k), np.inf)
        for batch in (part for whole in batches for part in _row_slices(whole, n_cells)):
            vectors = searchable(matrix_of(batch.column(0)), metric, is_query=False)
            cell, distances = _nearest_cell(vectors, pivots)
            count += np.bincount(cell, minlength=n_cells)
            best = distances[np.arange(len(cell)), cell]
            # A row almost as near to a second pivot widens that cell too, so a rounding
            # difference between two passes over the row cannot hide it.
            close = distances <= best[:, None] + REL_TOLERANCE * _scale(vectors, pivots)
            outer = np.maximum(outer, np.where(close, distances, 0.0).max(axis=0))
            inner = np.minimum(inner, np.where(close, distances, np.inf).min(axis=0))
            for c in np.unique(cell):
                merged = np.concatenate([near[c], best[cell == c]])
                near[c] = np.sort(np.partition(merged, k - 1)[:k])
        seen = np.flatnonzero(np.isfinite(inner))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(seen.astype(np.int32)),
                pa.array(count[seen]),
                pa.array(inner[seen]),
                pa.array(outer[seen]),
                pa.array([row[np.isfinite(row)].tolist() for row in near[seen]], pa.list_(pa.float64())),
            ],
            names=["cell", "n", "inner", "outer", "near"],
        )

    # At most a line per pivot and task: written, so the corpus is read once for both uses.
    partial = stage_table(
        corpus.select(vector_col).mapInArrow(summarise, "cell int, n long, inner double, outer double, near array<double>")
    )
    smallest = Window.partitionBy("cell").orderBy("d")
    # Every partial list holds k values at most; only the k smallest per cell are kept.
    near = (
        partial.select("cell", F.explode("near").alias("d"))
        .withColumn("r", F.row_number().over(smallest))
        .where(F.col("r") <= k)
        .groupBy("cell")
        .agg(F.sort_array(F.collect_list("d")).alias("near"))
    )
    sizes = partial.groupBy("cell").agg(
        F.sum("n").alias("n"), F.min("inner").alias("inner"), F.max("outer").alias("outer")
    )
    summary = {
        "n": np.zeros(n_cells, dtype=np.int64),
        "inner": np.zeros(n_cells),
        "outer": np.zeros(n_cells),
        "near": np.full((n_cells, k), np.inf),
        "blocks_needed": np.zeros(n_cells, dtype=np.int64),
    }
    for row in sizes.join(near, "cell", "left").collect():  # one row per pivot
        summary["n"][row["cell"]] = row["n"]
        # A cell that owns no row but was widened by one may still receive it.
        summary["blocks_needed"][row["cell"]] = max(1, row["n"])
        summary["inner"][row["cell"]] = row["inner"]
        summary["outer"][row["cell"]] = row["outer"]
        found = row["near"] or []
        summary["near"][row["cell"], : len(found)] = found
    return summary


def _query_targets(queries: DataFrame, vector_col: str, layout: CellLayout) -> tuple[np.ndarray, np.ndarray]:
    """How many queries reach each cell, and how many any cell of each pack."""
    n_cells, n_packs = len(layout.pivots), len(layout.pack_blocks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_cells + n_packs, dtype=np.int64)
        for batch in (part for whole in batches for part in _row_slices(whole, n_cells)):
            wanted = layout.reach(searchable(matrix_of(batch.column(0)), layout.metric, is_query=True))[1]
            total += np.concatenate([wanted.sum(axis=0), layout.packs_of(wanted).sum(axis=0)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n_cells + n_packs, dtype=np.int32)), pa.array(total)], names=["cell", "n"]
        )

    partial = queries.select(vector_col).mapInArrow(count, "cell int, n long")
    totals = np.zeros(n_cells + n_packs, dtype=np.int64)
    for row in partial.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # two rows per pivot at most
        totals[row["cell"]] = row["n"]
    return totals[:n_cells], totals[n_cells:]


def _packed(pivots: np.ndarray, rows: np.ndarray, block_rows: int) -> np.ndarray:
    """The pack of each cell: cells whose pivots follow each other, nearest next, up to ``block_rows``."""
    pack = np.zeros(len(pivots), dtype=np.int64)
    apart, left = squared_distances(pivots, pivots), np.ones(len(pivots), dtype=bool)
    at, number, filled = 0, -1, block_rows
    for _ in range(len(pivots)):
        if filled + rows[at] > block_rows:
            number, filled = number + 1, 0
        pack[at], left[at] = number, False
        filled += rows[at]
        at = int(np.where(left, apart[at], np.inf).argmin())
    return pack


def plan_cells(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str,
    corpus_id: str,
    vector_col: str,
    n_rows: int | None = None,
    dim: int | None = None,
) -> CellLayout:
    """Pivots, cell summaries and block counts; cells that no query reaches get no batch.

    ``corpus`` has rows; their number and the length of the vectors are counted if not given.
    """
    if n_rows is None or dim is None:
        n_rows, dim = corpus.count(), len(corpus.select(vector_col).first()[0])
    sample, n_pivots = _sampled_rows(corpus, corpus_id, vector_col, n_rows, dim)
    sample = searchable(sample, metric, is_query=False)
    pivots = sample[:n_pivots]
    cells = _cell_summary(corpus, vector_col, pivots, metric, k)
    block_rows = max(1, BLOCK_BYTES // (8 * dim))
    rows = cells["blocks_needed"]
    pack = _packed(pivots, rows, max(1, min(block_rows, -(-int(rows.sum()) // MIN_BLOCKS))))
    pack_rows = np.bincount(pack, rows).astype(np.int64)
    layout = CellLayout(
        metric=metric,
        k=k,
        pivots=pivots,
        inner=cells["inner"],
        outer=cells["outer"],
        nearest=cells["near"],
        blocks=-(-rows // block_rows),
        batches=np.ones(len(pivots), dtype=np.int64),
        pack=pack,
        pack_blocks=-(-pack_rows // block_rows),
        pack_batches=np.ones(len(pack_rows), dtype=np.int64),
        sample=sample,
    )
    by_cell, by_pack = _query_targets(queries, vector_col, layout)
    pack_batches = -(-by_pack // block_rows)
    batches = np.where(by_cell > 0, pack_batches[pack], 0)
    return CellLayout(**{**layout.__dict__, "batches": batches, "pack_batches": pack_batches})


def _list_array(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64)))


def _slices(lengths: np.ndarray) -> Iterator[slice]:
    """Row ranges whose lists hold about ``PAIR_BUDGET`` values in all, so no batch outgrows a task."""
    share = (np.cumsum(lengths) - lengths) // PAIR_BUDGET
    starts = np.flatnonzero(np.diff(share, prepend=-1))
    for start, stop in zip(starts, [*starts[1:], len(lengths)]):
        yield slice(int(start), int(stop))


def _counting_within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. inside each of consecutive runs of the given lengths."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _corpus_groups(layout: CellLayout, vector_at: int):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = layout.first_group
        for batch in (part for whole in batches for part in _row_slices(whole, len(layout.pivots))):
            vectors = searchable(matrix_of(batch.column(vector_at)), layout.metric, is_query=False)
            cell, _ = _nearest_cell(vectors, layout.pivots)
            reached = layout.batches[cell] > 0
            if not reached.all():  # rows no query can have among its nearest stay where they are
                batch, cell = batch.filter(pa.array(reached)), cell[reached]
            width, pack = layout.batches[cell], layout.pack[cell]
            start = first[pack] + batch.column(0).to_numpy() % layout.pack_blocks[pack] * width
            for rows in _slices(width):
                w = width[rows]
                groups = _list_array(np.repeat(start[rows], w) + _counting_within(w), w)
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays(
                    [groups, *part.columns[1:]], names=["groups", *batch.schema.names[1:]]
                )

    return assign


def _query_groups(layout: CellLayout, vector_at: int):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = layout.first_group
        for batch in (part for whole in batches for part in _row_slices(whole, len(layout.pivots))):
            bound, wanted = layout.reach(searchable(matrix_of(batch.column(vector_at)), layout.metric, is_query=True))
            wanted = layout.packs_of(wanted) & (layout.pack_batches > 0)[None, :]
            spread = batch.column(0).to_numpy()
            lengths = wanted @ layout.pack_blocks
            for rows in _slices(lengths):
                row, pack = np.nonzero(wanted[rows])
                width, n_blocks = layout.pack_batches[pack], layout.pack_blocks[pack]
                start = first[pack] + spread[rows][row] % width
                values = np.repeat(start, n_blocks) + _counting_within(n_blocks) * np.repeat(width, n_blocks)
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays(
                    [_list_array(values, lengths[rows]), pa.array(bound[rows]), *part.columns[1:]],
                    names=["groups", "bound", *batch.schema.names[1:]],
                )

    return assign


def _taken(scratch: dict, name: str, kind: type, *shape: int) -> np.ndarray:
    """An array out of ``scratch``, whose memory is used again: fresh memory costs more than a product."""
    size = int(np.prod(shape))
    if scratch.get((name, kind), np.empty(0)).size < size:
        scratch[name, kind] = np.empty(size, kind)
    return scratch[name, kind][:size].reshape(shape)


def _shortlist(
    queries: np.ndarray, rows: np.ndarray, least: np.ndarray, margin: float, keep: int, scratch: dict
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row) of one tile whose product is not under ``least``, and the queries with a crowd of them.

    Crowded queries ask for their ``keep``-th product in the tile as well.
    """
    products = _taken(scratch, "products", queries.dtype.type, len(queries), len(rows))
    np.matmul(queries, rows.T, out=products)
    wide = _taken(scratch, "flags", np.bool_, len(queries), -(-len(rows) // 8) * 8)
    wide[:, len(rows) :] = False
    mask = wide[:, : len(rows)]
    np.greater_equal(products, least[:, None], out=mask)
    crowded = np.empty(0, dtype=np.int64)
    if np.count_nonzero(wide) > 4 * len(queries):
        many = np.flatnonzero(np.count_nonzero(mask, axis=1) > CROWD)
        last = max(0, len(rows) - keep)
        cut = np.partition(products[many], last, axis=1)[:, last] - 2 * margin
        mask[many] &= products[many] >= cut[:, None]
        crowded = many[np.count_nonzero(mask[many], axis=1) > CROWD]
    # Eight flags are looked at as one word: nearly all are empty.
    words = np.flatnonzero(wide.view(np.uint64) != 0)
    word, flag = np.nonzero(wide.reshape(-1, 8)[words])
    q, c = np.divmod(words[word] * 8 + flag, wide.shape[1])
    return q, c, crowded


class _Search:
    """The k nearest rows of each query among the blocks of rows looked at so far.

    Matrix products shortlist, in single precision with a margin for its rounding; where that
    leaves a crowd, in double precision. Shortlisted pairs are then measured one by one, so
    equal vectors get equal distances and ties fall to the smaller id. What a query has found
    narrows its bound for the next tile.
    """

    def __init__(self, queries: np.ndarray, bounds: np.ndarray, metric: str, k: int) -> None:
        self.queries, self.bounds, self.metric, self.k = queries, bounds.copy(), metric, k
        self.distance = np.full((len(queries), k), np.inf)
        self.order = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.row = np.full((len(queries), k), -1)
        self.longest, self.scratch = _longest(queries), {}
        self.half = np.ones(len(queries)) if metric == "cosine" else (queries * queries).sum(axis=1) / 2
        self.single = self._factors(queries, True, np.float32)

    def _factors(self, vectors: np.ndarray, is_query: bool, kind: type) -> np.ndarray:
        """Their products, query by row, are the larger the nearer: q c for unit vectors, else q c - c c / 2."""
        if self.metric == "cosine":  # the spare coordinates add nothing to a product
            return np.ascontiguousarray(vectors[:, :-2], dtype=kind)
        out = np.empty((len(vectors), vectors.shape[1] + 1), dtype=kind)
        with np.errstate(over="ignore"):  # numbers too large for single precision are not used in it
            out[:, :-1] = vectors
            out[:, -1] = 1 if is_query else (vectors * vectors).sum(axis=1) / -2
        return out

    def look(self, rows: np.ndarray, corpus: np.ndarray, order: np.ndarray, first: int = 0) -> None:
        """Show a block, whose rows count from ``first``, to the queries ``rows``."""
        longest = _longest(corpus)
        tolerance = REL_TOLERANCE * (1.0 + self.longest + longest)
        kinds = (np.float32, np.float64) if 1e-15 < longest < 1e15 and self.longest < 1e15 else (np.float64,)
        size = 1.5 if self.metric == "cosine" else longest * (self.longest + longest)
        margins = {kind: (corpus.shape[1] + 8) * float(np.finfo(kind).eps) * size for kind in kinds}
        whole = len(rows) == len(self.queries)
        for at in range(0, len(corpus), TILE):
            block = corpus[at : at + TILE]
            factors = self._factors(block, False, kinds[0])
            for start in range(0, len(rows), TILE):
                q = rows[start : start + TILE]
                for kind in kinds:
                    if not len(q):
                        break
                    if kind is np.float32:
                        asked = self.single[start : start + TILE] if whole else self.single[q]
                    else:
                        asked = self._factors(self.queries[q], True, kind)
                        if kind is not kinds[0]:
                            factors64 = self._factors(block, False, kind)
                    limit = self.bounds[q] + tolerance
                    least = (self.half[q] - limit * limit / 2 - margins[kind]).astype(kind)
                    one, two, crowded = _shortlist(asked, factors if kind is kinds[0] else factors64, least, margins[kind], self.k, self.scratch)
                    if kind is not kinds[-1] and len(crowded):  # these are told apart by the next kind
                        clear = ~np.isin(one, crowded)
                        one, two = one[clear], two[clear]
                    self._offer(q[one], two, block, order[at : at + TILE], first + at)
                    q = q[crowded]

    def _offer(self, q: np.ndarray, c: np.ndarray, corpus: np.ndarray, order: np.ndarray, first: int) -> None:
        if not len(q):
            return
        distance = np.empty(len(q))
        for at in range(0, len(q), TILE):
            here = slice(at, at + TILE)
            a, b = (_taken(self.scratch, name, np.float64, len(q[here]), corpus.shape[1]) for name in "ab")
            np.take(self.queries, q[here], axis=0, out=a, mode="clip")
            np.take(corpus, c[here], axis=0, out=b, mode="clip")
            if self.metric == "cosine":
                distance[here] = np.clip(1.0 - np.multiply(a, b, out=a).sum(axis=1), 0.0, 2.0)
            else:
                distance[here] = np.sqrt(np.square(np.subtract(a, b, out=a), out=a).sum(axis=1))
        near = distance <= self.distance[q, -1]
        q, c, distance = q[near], c[near], distance[near]
        if not len(q):
            return
        touched, at = np.unique(q, return_inverse=True)
        at = np.concatenate([np.repeat(np.arange(len(touched)), self.k), at])
        distance = np.concatenate([self.distance[touched].ravel(), distance])
        order = np.concatenate([self.order[touched].ravel(), order[c]])
        row = np.concatenate([self.row[touched].ravel(), c + first])
        by = np.lexsort((order, distance, at))
        by = by[np.arange(len(by)) - np.searchsorted(at[by], at[by]) < self.k]  # k lines a query: it had as many before
        shape = (len(touched), self.k)
        self.distance[touched], self.order[touched], self.row[touched] = (x[by].reshape(shape) for x in (distance, order, row))
        farthest = self.distance[touched, -1]
        self.bounds[touched] = np.minimum(self.bounds[touched], np.sqrt(2 * farthest) if self.metric == "cosine" else farthest)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, distance), nearest first in each query."""
        q, place = np.nonzero(self.row >= 0)
        return q, self.row[q, place], self.distance[q, place]


def nearest_in_block(
    query_vectors: np.ndarray,
    bounds: np.ndarray,
    corpus_vectors: np.ndarray,
    corpus_order: np.ndarray,
    metric: str,
    k: int,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of (query row, corpus row, distance): the k nearest of a block per query."""
    step = max(1, PAIR_BUDGET // TILE)
    for start in range(0, len(query_vectors), step):
        search = _Search(query_vectors[start : start + step], bounds[start : start + step], metric, k)
        search.look(np.arange(len(search.queries)), corpus_vectors, corpus_order)
        q, c, distance = search.found()
        if len(q):
            yield q + start, c, distance


def _runs_of_equals(vectors: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions that bring equal vectors together, smaller ``order`` first, and where a run of equals starts."""
    odd = np.random.default_rng(0).integers(1 << 62, size=vectors.shape[1]) * 2 + 1
    step = max(1, PAIR_BUDGET // max(1, vectors.shape[1]))
    parts = [vectors[at : at + step] for at in range(0, len(vectors), step)]
    key = np.concatenate([(np.ascontiguousarray(part).view(np.int64) * odd).sum(axis=1) for part in parts])
    by = np.lexsort((order, key))
    starts = np.ones(len(by), dtype=bool)
    starts[1:] = key[by[1:]] != key[by[:-1]]
    pairs = np.flatnonzero(~starts)
    for at in range(0, len(pairs), step):
        here = pairs[at : at + step]
        starts[here] = (vectors[by[here]] != vectors[by[here - 1]]).any(axis=1)
    return by, starts


def nearest_in_cells(
    query_vectors: np.ndarray, bounds: np.ndarray, corpus_vectors: np.ndarray, corpus_order: np.ndarray, layout: CellLayout
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What :func:`nearest_in_block` finds, cell by cell of the block and only for queries that reach the cell.

    What a query has found so far narrows its reach. Rows are dealt to cells anew here; a row
    that rounding moves to another cell has widened that one as well. Equal queries are searched
    for once, and of equal rows only the k with the smallest ids can be among the nearest.
    """
    step, k = max(1, PAIR_BUDGET // len(layout.pivots)), layout.k
    by, starts = _runs_of_equals(corpus_vectors, corpus_order)
    kept = np.sort(by[np.arange(len(by)) - np.maximum.accumulate(np.where(starts, np.arange(len(by)), 0)) < k])
    corpus_vectors, corpus_order = corpus_vectors[kept], corpus_order[kept]
    cell = np.concatenate([_nearest_cell(corpus_vectors[at : at + step], layout.pivots)[0] for at in range(0, len(corpus_vectors), step)])
    by_cell = np.argsort(cell, kind="stable")
    cells, cell_starts = np.unique(cell[by_cell], return_index=True)
    corpus_vectors, corpus_order, kept = corpus_vectors[by_cell], corpus_order[by_cell], kept[by_cell]
    cell_starts = np.append(cell_starts, len(cell))
    members, starts = _runs_of_equals(query_vectors, np.arange(len(query_vectors)))
    starts = np.append(np.flatnonzero(starts), len(members))
    for at in range(0, len(starts) - 1, step):
        runs = starts[at : at + step + 1]
        asked = members[runs[0] : runs[-1]]
        part, sizes = query_vectors[members[runs[:-1]]], np.diff(runs)
        search = _Search(part, np.minimum.reduceat(bounds[asked], runs[:-1] - runs[0]), layout.metric, k)
        lower = layout.lower(part)[:, cells]
        for place in np.argsort(lower.mean(axis=0)):
            rows = np.flatnonzero(lower[:, place] <= search.bounds)
            if len(rows):
                here = slice(cell_starts[place], cell_starts[place + 1])
                search.look(rows, corpus_vectors[here], corpus_order[here], cell_starts[place])
        q, c, distance = search.found()
        if len(q):
            # Each run's lines are given to every member of the run.
            lines = np.bincount(q, minlength=len(part))
            own = np.repeat(np.arange(len(part)), sizes)
            line = np.repeat((np.cumsum(lines) - lines)[own], lines[own]) + _counting_within(lines[own])
            yield np.repeat(asked, lines[own]), kept[c[line]], distance[line]


def joined_pairs(q: pa.Table, c: pa.Table, found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], names: Sequence[str]) -> pa.Table:
    """The columns ``names`` of found pairs; of both sides only these are copied, vectors are not."""
    found = list(found)
    at_q, at_c, distance = (np.concatenate(parts) for parts in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    del found
    sides = {n: (q.column(n), at_q) if n in q.column_names else (c.column(n), at_c) for n in names if n != "distance"}
    columns = [pa.chunked_array([pa.array(distance)]) if n == "distance" else sides[n][0].take(pa.array(sides[n][1])) for n in names]
    return pa.table(columns, names=names)


def knn_join(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    metric: str = "cosine",
    query_id: str = "id",
    corpus_id: str = "id",
    vector_col: str = "embedding",
    query_cols: Sequence[str] = (),
    corpus_cols: Sequence[str] = (),
) -> DataFrame:
    """For each query its ``k`` nearest corpus rows, nearest first.

    Columns ``qid, rank, nid, distance``, then ``query_cols`` as named and ``corpus_cols``
    prefixed ``n_`` (carry a label here; fetch text afterwards with
    :func:`attach_neighbor_metadata`). Ties go to the smaller id. A corpus smaller than
    ``k`` gives fewer rows. Zero vectors have cosine distance 1 to everything. Null vectors,
    vectors that hold null or non-finite numbers, and vectors of different lengths raise a
    ``ValueError`` that tells how many there are: no row is left out in silence.

    Planning runs jobs: one that checks and counts each side and, unless the queries are few,
    one each that draws pivots, summarises the cells and counts the queries' targets before
    the join reads both sides, so both should be tables
    (:func:`versemill.session.stage_table`), not long plans.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {METRICS}")
    n_queries, n_rows, dim = check_vectors(queries, corpus, vector_col)
    spread = F.xxhash64
    carried = [F.col(c).alias(f"n_{c}") for c in corpus_cols]
    right = corpus.select(
        spread(F.lit("block"), corpus_id).alias("spread"),
        F.col(corpus_id).alias("nid"),
        F.col(vector_col).alias("vector"),
        *carried,
    )
    left = queries.select(
        spread(F.lit("batch"), query_id).alias("spread"),
        F.col(query_id).alias("qid"),
        F.col(vector_col).alias("vector"),
        *query_cols,
    )
    out_schema = T.StructType(
        [left.schema["qid"], right.schema["nid"], T.StructField("distance", T.DoubleType())]
        + [left.schema[c] for c in query_cols]
        + [right.schema[f"n_{c}"] for c in corpus_cols]
    )
    if not n_queries or not n_rows:
        empty = queries.sparkSession.createDataFrame([], out_schema)
        return _ranked(empty, k, query_cols, corpus_cols)
    if n_queries * dim * 8 <= FEW_BYTES:
        asked = left.drop("spread").toArrow()  # FEW_BYTES of vectors at most
        found = _scan_for(asked, right.drop("spread"), k, metric, out_schema)
        return _ranked(found, k, query_cols, corpus_cols)
    layout = plan_cells(queries, corpus, k, metric, corpus_id, vector_col, n_rows, dim)

    groups = T.StructField("groups", T.ArrayType(T.LongType()))
    bound = T.StructField("bound", T.DoubleType())
    placed_right = right.mapInArrow(
        _corpus_groups(layout, 2), T.StructType([groups, *right.schema.fields[1:]])
    ).withColumn("group", F.explode("groups"))
    placed_left = left.mapInArrow(
        _query_groups(layout, 2), T.StructType([groups, bound, *left.schema.fields[1:]])
    ).withColumn("group", F.explode("groups"))

    names = [f.name for f in out_schema.fields]

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        found = ()
        if q.num_rows and c.num_rows:
            found = nearest_in_cells(
                searchable(matrix_of(q.column("vector")), layout.metric, is_query=True),
                q.column("bound").to_numpy(),
                searchable(matrix_of(c.column("vector")), layout.metric, is_query=False),
                np.unique(c.column("nid").to_numpy(), return_inverse=True)[1],
                layout,
            )
        return joined_pairs(q.drop_columns(["vector"]), c.drop_columns(["vector"]), found, names)

    # About one group per task: a full group is minutes of work, so a fixed number of
    # shuffle partitions would leave most of a large cluster idle.
    tasks = int(min(MAX_TASKS, max(1, (layout.pack_blocks * layout.pack_batches).sum())))
    candidates = (
        placed_left.drop("groups")
        .repartition(tasks, "group")
        .groupBy("group")
        .cogroup(placed_right.drop("groups").repartition(tasks, "group").groupBy("group"))
        .applyInArrow(search, out_schema)
    )
    return _ranked(candidates, k, query_cols, corpus_cols)


def _scan_for(asked: pa.Table, corpus: DataFrame, k: int, metric: str, out_schema: T.StructType) -> DataFrame:
    """The k nearest rows of every task's part of ``corpus`` for each of the ``asked`` queries."""
    query_vectors = searchable(matrix_of(asked.column("vector")), metric, is_query=True)
    asked = asked.drop_columns(["vector"]).combine_chunks()
    carried = [n for n in corpus.columns if n != "vector"]
    names = out_schema.names

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # the rows nearest so far, by query and distance
        bounds = np.full(len(query_vectors), np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = searchable(matrix_of(batch.column("vector")), metric, is_query=False)
            order = np.unique(batch.column("nid").to_numpy(zero_copy_only=False), return_inverse=True)[1]
            found = list(nearest_in_block(query_vectors, bounds, vectors, order, metric, k))
            if not found:
                continue
            q, c, distance = (np.concatenate(parts) for parts in zip(*found))
            rows = [batch.column(n).take(pa.array(c)) for n in carried]
            part = pa.table([pa.array(q), pa.array(distance), *rows], names=["_q", "distance", *carried])
            kept = part if kept is None else pa.concat_tables([kept, part])
            kept = kept.sort_by([("_q", "ascending"), ("distance", "ascending"), ("nid", "ascending")])
            q = kept.column("_q").to_numpy()
            place = np.arange(len(q)) - np.searchsorted(q, q)
            kept = kept.filter(pa.array(place < k))
            last = place == k - 1
            farthest = kept.column("distance").to_numpy()[(place[place < k]) == k - 1]
            bounds[q[last]] = np.sqrt(2 * farthest) if metric == "cosine" else farthest
        if kept is not None:
            found = asked.take(kept.column("_q").combine_chunks())
            columns = [found.column(n) if n in found.column_names else kept.column(n) for n in names]
            yield from pa.table(columns, names=names).to_batches()

    return corpus.mapInArrow(nearest, out_schema)


def _ranked(candidates: DataFrame, k: int, query_cols: Sequence[str], corpus_cols: Sequence[str]) -> DataFrame:
    nearest = Window.partitionBy("qid").orderBy("distance", "nid")
    return (
        candidates.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("qid", "rank", "nid", "distance", *query_cols, *[f"n_{c}" for c in corpus_cols])
    )


def attach_neighbor_metadata(
    neighbors: DataFrame, corpus: DataFrame, corpus_id: str = "id", cols: Sequence[str] = ("text", "label")
) -> DataFrame:
    """Original columns of each neighbour, joined after the top-k.

    A corpus row can be the neighbour of a large share of all queries, so hot ids are
    salted. Neighbours are read again for that, hence written first (k narrow rows a query).
    A bitmap of the ids that are neighbours, applied at the scan, keeps all other rows of the
    corpus, with their texts, out of the join.
    """
    table = corpus.select(F.col(corpus_id).alias("nid"), *[F.col(c).alias(f"n_{c}") for c in cols])
    kept = [c for c in neighbors.columns if c not in table.columns or c == "nid"]
    found = stage_table(neighbors.select(*kept))
    return lookup_join(found, wanted_rows(table, found, "nid"), "nid", "qid")


def neighbor_lists(neighbors: DataFrame, query_cols: Sequence[str] = (), label_col: str = "n_label") -> DataFrame:
    """One row per query with its neighbours' labels, nearest first (at most k)."""
    entry = F.struct("rank", F.col(label_col).alias("label"))
    return (
        neighbors.groupBy("qid", *query_cols)
        .agg(F.sort_array(F.collect_list(entry)).alias("_n"))
        .select("qid", *query_cols, F.col("_n.label").alias("labels"))
    )


def majority_vote(neighbors: DataFrame, query_cols: Sequence[str] = (), label_col: str = "n_label") -> DataFrame:
    """A4: most frequent neighbour label per query; the lowest label wins a tie."""
    counts = neighbors.groupBy("qid", *query_cols, label_col).agg(F.count(F.lit(1)).alias("_n"))
    winner = F.max_by(F.col(label_col), F.struct(F.col("_n"), -F.col(label_col)))
    return counts.groupBy("qid", *query_cols).agg(winner.alias("y_pred"))


def vote_distribution(
    lists: DataFrame, n_classes: int, k: int, labels: str | Column = "labels"
) -> DataFrame:
    """A5: adds ``p_knn``, the share of each class among the neighbours, zeros included."""
    column = F.col(labels) if isinstance(labels, str) else labels
    return lists.withColumn("p_knn", vote_shares(column, n_classes, k))


def precision_recall_at_k(
    neighbors: DataFrame,
    class_sizes: DataFrame,
    k: int,
    query_label: str = "label",
    neighbor_label: str = "n_label",
) -> DataFrame:
    """A6/A7/J6 per query: hits over ``k``, and hits over the class size in the corpus.

    ``class_sizes`` is ``(label, n)``; a class missing from it counts as empty (recall 0).
    """
    sizes = class_sizes.select(F.col("label").alias(query_label), F.col("n").alias("_n"))
    hits = neighbors.groupBy("qid", query_label).agg(
        F.count_if(F.col(neighbor_label) == F.col(query_label)).alias("n_hits")
    )
    return (
        with_class_values(hits, sizes, query_label, "_n")
        .withColumn("n_relevant", F.coalesce("_n", F.lit(0)))
        .select(
            "qid",
            query_label,
            "n_hits",
            "n_relevant",
            (F.col("n_hits") / F.lit(float(k))).alias("precision_at_k"),
            F.when(F.col("n_relevant") > 0, F.col("n_hits") / F.col("n_relevant"))
            .otherwise(F.lit(0.0))
            .alias("recall_at_k"),
        )
    )


def mean_precision_recall(per_query: DataFrame) -> DataFrame:
    """Mean Precision@k and Recall@k over all queries, one row."""
    return per_query.agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.avg("precision_at_k").alias("precision_at_k"),
        F.avg("recall_at_k").alias("recall_at_k"),
    )
