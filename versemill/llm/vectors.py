"""Near-duplicate vectors by product quantisation with an exact cosine rerank.

Vectors of unit length are assigned to coarse inverted lists; what is left of them after their
list's centre is coded in subspaces. A query probes every list that can hold a link: a vector
within ``radius`` of the query lies on its own centre's side of the border between two centres,
so a list can be left out when the query is further than that beyond the border. ``slack``
scales the distance: at 1 no link can be lost, at the default of a half only links that lie
across a border by over four standard deviations of a random direction (in 64 dimensions), and
much less is probed. In a probed list, distances to coded vectors are
sums of table look-ups, and a vector is reranked by its exact cosine unless look-up distance
and its own coding error together rule it out, which again loses nothing.

The quantisers are fitted on a bounded sample (``SAMPLE_ROWS``); every vector is indexed and
every vector is a query. Equal vectors of a label are one class before anything is compared.
Lists are cut into blocks of ``BLOCK`` vectors and blocks are compared two by two, so no list
meets in one task. A pair of blocks returns the number of links of each query and a spanning
forest of its links, at most a row a vector; pairs of a group of copies are not listed.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers, and
vectors without label, link with nothing; vectors are compared with those of the same length
only. Repeated rows link with each other. A null id sorts last.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from versemill.llm.components import connected_components
from versemill.operators.joins import broadcast_if_small
from versemill.session import Staging, stage_table

COSINE = 0.93
SAMPLE_ROWS = 20_000
SUBSPACES = 8
CODES = 256
BLOCK = 512
SLACK = 0.5
RERANKED = 16_384
LAST_ID = 2**63 - 1


@dataclass
class Quantiser:
    """Coarse centres and subspace codebooks for vectors of one length."""

    centres: np.ndarray
    cuts: list[slice]
    books: list[np.ndarray]

    def lists(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centre of each vector, and squared distances to all centres."""
        square = np.maximum((unit**2).sum(1)[:, None] + (self.centres**2).sum(1) - 2 * unit @ self.centres.T, 0)
        return square.argmin(1), square

    def probes(self, unit: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """``(vector, list)`` of all lists that can hold a vector within ``radius``."""
        own, square = self.lists(unit)
        lengths = (self.centres**2).sum(1)
        apart = np.sqrt(np.maximum(lengths[own][:, None] + lengths - 2 * self.centres[own] @ self.centres.T, 0))
        beyond = square - square[np.arange(len(own)), own][:, None]
        return np.nonzero(beyond <= 2 * radius * apart + 1e-9)

    def encode(self, unit: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and how far each decoded vector is from the vector."""
        rest = unit - self.centres[own]
        codes = np.stack([_nearest(rest[:, cut], book) for cut, book in zip(self.cuts, self.books)], axis=1)
        decoded = np.hstack([book[codes[:, m]] for m, book in enumerate(self.books)])
        return codes.astype(np.uint8), np.linalg.norm(rest - decoded, axis=1)

    def distances(self, queries: np.ndarray, own: int, codes: np.ndarray) -> np.ndarray:
        """Distances from ``queries`` to the decoded vectors of list ``own``, by table look-up."""
        rest = queries - self.centres[own]
        total = np.zeros((len(queries), len(codes)))
        for m, (cut, book) in enumerate(zip(self.cuts, self.books)):
            part = rest[:, cut]
            table = (part**2).sum(1)[:, None] + (book**2).sum(1) - 2 * part @ book.T
            total += table[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * rows @ centres.T).argmin(1)


def _k_means(rows: np.ndarray, k: int, rng: np.random.Generator, turns: int = 8) -> np.ndarray:
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(turns):
        near = _nearest(rows, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def fit_quantiser(unit: np.ndarray, n_lists: int, seed: int = 8) -> Quantiser:
    """Centres and codebooks from a sample of unit vectors."""
    rng = np.random.default_rng(seed)
    centres = _k_means(unit, n_lists, rng)
    rest = unit - centres[_nearest(unit, centres)]
    ends = np.linspace(0, unit.shape[1], min(SUBSPACES, unit.shape[1]) + 1).astype(int)
    cuts = [slice(a, b) for a, b in zip(ends[:-1], ends[1:])]
    return Quantiser(centres, cuts, [_k_means(rest[:, cut], CODES, rng) for cut in cuts])


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Unit rows, in double precision, of packed vectors of one length."""
    packed = column.to_pylist()
    rows = np.frombuffer(b"".join(packed), "<f4" if len(packed[0]) == 4 * size else "<f8").reshape(-1, size).astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_quantisers(classes: DataFrame, sample_rows: int) -> dict[int, Quantiser]:
    """One quantiser for each vector length in the sample; other lengths are compared in full."""
    n = classes.count()
    share = min(1.0, sample_rows / max(n, 1))
    draw = F.pmod(F.xxhash64(F.lit(8), "vector"), F.lit(1 << 30)) < int(share * (1 << 30))
    table = classes.where(draw).select(F.size("vector").alias("size"), "vector").toArrow()
    sizes = table["size"].to_numpy()
    if not len(sizes):
        return {}
    vectors = np.asarray(table["vector"].combine_chunks().flatten(), np.float64)
    ends = np.append(0, np.cumsum(sizes))
    models = {}
    for size in sorted(set(sizes.tolist())):
        rows = np.array([vectors[ends[i] : ends[i + 1]] for i in np.flatnonzero(sizes == size)])
        rows = rows[np.lexsort(rows.T[::-1])]  # the order of tasks must not matter
        unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
        models[size] = fit_quantiser(unit, int(min(max(1, round(n**0.5 / 2)), max(1, len(unit) // 8))))
    return models


def _index_rows(classes: DataFrame, models: dict[int, Quantiser], radius: float, single: bool) -> DataFrame:
    """Index and query rows: ``label, size, list, query, cls, n, vector, codes, error``.

    ``single`` tells that the vectors came in single precision, in which they travel without loss.
    """
    schema = "label int, size int, list int, query boolean, cls bigint, n bigint, vector binary, codes binary, error double"

    def rows_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = batch.column("size").to_numpy()
        for size in sorted(set(sizes.tolist())):
            part = batch.filter(pa.array(sizes == size))
            values = np.asarray(part.column("vector").flatten(), np.float64).reshape(-1, size)
            packed = pa.array([v.tobytes() for v in (values.astype("<f4") if single else values)], pa.binary())
            unit = values / np.linalg.norm(values, axis=1, keepdims=True)
            model = models.get(size)
            if model is None:
                own, codes, error = np.zeros(len(unit), int), np.zeros((len(unit), 0), np.uint8), np.zeros(len(unit))
                who, where = np.arange(len(unit)), own
            else:
                own = model.lists(unit)[0]
                codes, error = model.encode(unit, own)
                who, where = model.probes(unit, radius)
            sides = (False, np.arange(len(unit)), own), (True, who, where)
            for query, of, lists in sides:
                for at in range(0, len(of), 20_000):
                    rows = of[at : at + 20_000]
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("label").take(take),
                            pa.array(np.full(len(rows), size, np.int32)),
                            pa.array(lists[at : at + 20_000].astype(np.int32)),
                            pa.array(np.full(len(rows), query)),
                            part.column("cls").take(take),
                            part.column("n").take(take),
                            packed.take(take),
                            pa.array([b"" if query else codes[i].tobytes() for i in rows], pa.binary()),
                            pa.array(error[rows]),
                        ],
                        names=["label", "size", "list", "query", "cls", "n", "vector", "codes", "error"],
                    )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                yield from rows_of(batch.slice(at, 1024))

    return classes.select("label", F.size("vector").alias("size"), "cls", "n", "vector").mapInArrow(index, schema)


def _in_block_pairs(rows: DataFrame) -> DataFrame:
    """Each row once for every block of the other side of its list: ``qb`` and ``ib`` name the pair."""
    key = ["label", "size", "list"]
    sides = rows.groupBy(*key).agg(
        F.ceil(F.sum(F.when(F.col("query"), 1).otherwise(0)) / BLOCK).cast("int").alias("nq"),
        F.ceil(F.sum(F.when(F.col("query"), 0).otherwise(1)) / BLOCK).cast("int").alias("ni"),
    )
    held = rows.join(broadcast_if_small(sides.where("nq > 0 AND ni > 0")), key)
    all_of = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = lambda n: F.array(F.pmod(F.xxhash64("cls"), F.col(n)).cast("int"))
    return (
        held.withColumn("qb", F.explode(F.when(F.col("query"), own("nq")).otherwise(all_of("nq"))))
        .withColumn("ib", F.explode(F.when(F.col("query"), all_of("ni")).otherwise(own("ni"))))
        .drop("nq", "ni")
    )


def _forest(linked: np.ndarray) -> np.ndarray:
    """For each query the first query connected with it in the block, through ``linked[query, vector]``."""
    far = len(linked)
    names = np.arange(far)
    while True:
        through = np.where(linked, names[:, None], far).min(axis=0)
        new = np.minimum(names, np.where(linked, through[None], far).min(axis=1))
        if (new == names).all():
            return names
        names = new


def _links(pairs: DataFrame, models: dict[int, Quantiser], cosine: float, radius: float) -> DataFrame:
    """``a, b, n``: links of a class where ``b`` is null, else two classes that are connected."""
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        size, own = key[1].as_py(), key[2].as_py()
        table = table.combine_chunks()
        query = table["query"].to_numpy()
        asked, held = table.filter(pa.array(query)), table.filter(pa.array(~query))
        if not len(asked) or not len(held):
            return none
        q, x = _matrix(asked["vector"], size), _matrix(held["vector"], size)
        q_cls, x_cls, x_n = asked["cls"].to_numpy(), held["cls"].to_numpy(), held["n"].to_numpy()
        maybe = q_cls[:, None] != x_cls[None]
        model = models.get(size)
        if model is not None:
            codes = np.frombuffer(b"".join(held["codes"].to_pylist()), np.uint8).reshape(len(x), -1)
            maybe &= model.distances(q, own, codes) <= radius + held["error"].to_numpy()[None] + 1e-6
        linked = np.zeros_like(maybe)
        one, two = np.nonzero(maybe)
        for at in range(0, len(one), RERANKED):
            i, j = one[at : at + RERANKED], two[at : at + RERANKED]
            linked[i, j] = np.einsum("ij,ij->i", q[i], x[j]) >= cosine
        counts = linked @ x_n
        hit_q, hit_x = np.flatnonzero(counts), np.flatnonzero(linked.any(axis=0))
        names = _forest(linked)
        through = linked[:, hit_x].argmax(axis=0)
        a = np.concatenate([q_cls[hit_q], q_cls[hit_q], x_cls[hit_x]])
        b = np.concatenate([q_cls[names[hit_q]], q_cls[names[through]]])
        n = np.concatenate([counts[hit_q], np.zeros(len(b), np.int64)])
        of_count = np.arange(len(a)) < len(hit_q)
        b = np.concatenate([np.zeros(len(hit_q), np.int64), b])
        return pa.table({"a": pa.array(a), "b": pa.array(b, mask=of_count), "n": pa.array(n.astype(np.int64))})

    return pairs.groupBy("label", "size", "list", "qb", "ib").applyInArrow(compare, "a bigint, b bigint, n bigint")


def linked_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
    slack: float = SLACK,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id`` for every row of ``vectors``."""
    radius = (2 - 2 * cosine) ** 0.5
    single = vectors.schema[vector_col].dataType.elementType == T.FloatType()
    with Staging(vectors.sparkSession) as staging:
        rows = staging.table(
            vectors.select(
                F.col(id_col).cast("long").alias("vec_id"),
                F.col(label_col).cast("int").alias("label"),
                F.col(vector_col).cast("array<double>").alias("vector"),
                F.monotonically_increasing_id().alias("row"),
            )
        )
        usable = (
            F.col("label").isNotNull()
            & (F.size("vector") > 0)
            & ~F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
            & F.exists("vector", lambda v: v != 0)
        )
        good = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
        classes = staging.table(
            good.where("usable")
            .groupBy("label", "vector")
            .agg(F.min("row").alias("cls"), F.count(F.lit(1)).alias("n"), F.min(F.coalesce("vec_id", F.lit(LAST_ID))).alias("least"))
        )
        models = fit_quantisers(classes, sample_rows)
        index = staging.table(_index_rows(classes, models, radius * slack, single))
        found = staging.table(_links(_in_block_pairs(index), models, cosine, radius))
        counts = found.where("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("links"))
        roots = connected_components(found.where("b IS NOT NULL").select("a", "b"))
        rooted = (
            classes.join(counts, "cls", "left")
            .join(roots.withColumnRenamed("id", "cls"), "cls", "left")
            .select("label", "vector", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "cls").alias("root"))
        )
        rooted = staging.table(rooted)
        firsts = rooted.groupBy("root").agg(F.min("least").alias("first"))
        known = rooted.join(firsts, "root").select("label", "vector", "n_links", "first")
        # Vectors that cannot be compared look nothing up: their keys hold nulls.
        nothing = good.where("NOT usable").select("vec_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("first"))
        met = good.where("usable").join(known, ["label", "vector"]).select("vec_id", "n_links", "first")
        result = met.unionByName(nothing).select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("first").isNull() | (F.col("first") == LAST_ID), F.col("vec_id")).otherwise(F.col("first")).alias("component_id"),
        )
        return stage_table(result)
