"""Nearest vectors of many queries: exact by blocks, and through cells of small codes.

Vectors and queries are both tables with ids of any type that can be ordered. Work is dealt into pairs
of a block of vectors and a block of queries whose sizes are counted first, so neither a popular cell
nor a long list of queries gathers in one task; each pair is one matrix product and sends on only the
best rows of each query.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trialspark.functions.vectors import cosine, norm
from trialspark.session import cut_lineage

#: Bytes of the vectors, and number of queries, that one task multiplies at a time.
BLOCK_BYTES, BLOCK_QUERIES = 16_000_000, 1_000
#: Scores that are held at one time: rows of a block times the queries that meet them together.
SCORES_AT_ONCE = 2_000_000
#: A cosine counts in steps of 1e-12.
STEPS = 1e12
#: Largest code of a component; components of a unit vector are about 1 / sqrt(dimension), which is code 16.
MOST = 127


def usable(df: DataFrame, vector_col: str, dim: int) -> DataFrame:
    """Rows whose vector has the right size, no null or non-finite component and a length."""
    x = F.col(vector_col).cast("array<double>")
    fit = F.size(x) == dim
    fit &= ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return df.filter(F.coalesce(fit, F.lit(False)) & F.coalesce(norm(vector_col) > 0, F.lit(False)))


def dimension(df: DataFrame, vector_col: str) -> int:
    """The size that most vectors have; of several the largest."""
    sizes = df.select(F.size(vector_col).alias("n")).filter("n > 0").groupBy("n").count()
    first = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    return 0 if first is None else first["n"]


def _whole(unit: np.ndarray) -> np.ndarray:
    """Components of unit vectors in whole steps, a byte each."""
    return np.clip(np.floor(unit * (16 * math.sqrt(unit.shape[1])) + 0.5), -MOST, MOST).astype("i1")


def _packed(df: DataFrame, id_col: str, vector_col: str, kind: str) -> DataFrame:
    """``id_col`` and ``payload``: the bytes of each unit vector, or of its codes where ``kind`` is i1."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
            rows = _whole(unit) if kind == "i1" else unit
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array([r.tobytes() for r in rows], pa.binary())], [id_col, "payload"])

    rows = df.select(id_col, F.col(vector_col).cast("array<double>").alias("values"))
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, payload binary")


def _best(kind: str, steps: float, keep: int, id_col: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids, queries = rows.column(id_col).combine_chunks(), asked.column("query_id").combine_chunks()
        if not len(ids) or not len(queries):
            empty = [queries.slice(0, 0), ids.slice(0, 0), pa.array([], pa.int64())]
            return pa.Table.from_arrays(empty, ["query_id", id_col, "points"])
        order = pc.sort_indices(ids)
        ids = ids.take(order)

        def matrix(column) -> np.ndarray:
            made = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)
            # sums of products of codes stay exact
            return made.astype(np.float32 if kind == "i1" and made.shape[1] <= 1000 else np.float64)

        vectors, wanted = matrix(rows.column("payload").take(order)), matrix(asked.column("payload"))
        n, kept = len(vectors), min(keep, len(vectors))
        found_q, found_i, points = [], [], []
        together = max(1, min(128, SCORES_AT_ONCE // n))
        for a in range(0, len(wanted), together):
            scores = np.rint(vectors @ wanted[a : a + together].T * steps).astype(np.int64)
            # ids ascend, so one number orders by score, then by smaller id
            ranked = scores * n + (n - 1 - np.arange(n))[:, None]
            top = np.argpartition(-ranked, kept - 1, axis=0)[:kept]
            found_q.append(np.repeat(np.arange(a, a + top.shape[1]), kept))
            found_i.append(top.T.ravel())
            points.append(np.take_along_axis(scores, top, axis=0).T.ravel())
        return pa.Table.from_arrays(
            [queries.take(pa.array(np.concatenate(found_q))), ids.take(pa.array(np.concatenate(found_i))), pa.array(np.concatenate(points))],
            ["query_id", id_col, "points"],
        )

    return run


def _in_cells(
    rows: DataFrame, asked: DataFrame, id_col: str, kind: str, steps: float, keep: int, exclude_self: bool
) -> DataFrame:
    """The ``keep`` best rows of each query over the cells it asks: ``query_id``, the row's id and ``points``.

    ``rows`` and ``asked`` have ``cell``, an id and ``payload``.
    """
    sizes = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max(F.length("payload")).alias("width")).join(
        asked.groupBy("cell").agg(F.count("*").alias("m")), "cell"
    )
    sizes = sizes.select(
        "cell", F.ceil(F.col("n") * F.col("width") / BLOCK_BYTES).cast("int").alias("blocks"),
        F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("chunks"),
    )
    place = ["cell", "block", "chunk"]
    dealt = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(sizes, "cell").select(
        "cell", dealt(id_col, F.col("blocks")).alias("block"), copies("chunks").alias("chunk"), id_col, "payload"
    )
    right = asked.join(sizes, "cell").select(
        "cell", copies("blocks").alias("block"), dealt("query_id", F.col("chunks")).alias("chunk"), "query_id", "payload"
    )
    types = {n: f.schema[n].dataType.simpleString() for f, n in ((asked, "query_id"), (rows, id_col))}
    found = left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(
        _best(kind, steps, keep + int(exclude_self), id_col), f"query_id {types['query_id']}, `{id_col}` {types[id_col]}, points long"
    )
    if exclude_self:
        found = found.filter(~F.col(id_col).eqNullSafe(F.col("query_id")))
    return _ranked(found, id_col, keep).drop("rank")


def _ranked(found: DataFrame, id_col: str, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("points"), F.asc(id_col))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def exact_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    exclude_self: bool = False,
) -> DataFrame:
    """The k vectors nearest by cosine to each query: ``query_id``, the id, ``score``, ``rank``.

    Scores are compared in steps of 1e-12, ties go to the smaller id. Vectors that are null, of another
    size, without length or with a null or non-finite component take no part, on either side. With
    ``exclude_self`` a query is not its own neighbour.
    """
    dim = dimension(vectors, vector_col)
    cell = lambda df: df.withColumn("cell", F.lit(0))
    rows = _packed(usable(vectors, vector_col, dim), id_col, vector_col, "f8")
    asked = _packed(usable(queries, vector_col, dim), id_col, vector_col, "f8")
    found = _in_cells(cell(rows), cell(asked.withColumnRenamed(id_col, "query_id")), id_col, "f8", STEPS, k, exclude_self)
    return _ranked(found, id_col, k).select("query_id", id_col, (F.col("points") / STEPS).alias("score"), "rank")


# --- cells ---


def fit_cells(
    vectors: DataFrame, cells: int, vector_col: str = "embedding", sample_rows: int = 100_000, seed: int = 7
) -> list[list[int]]:
    """Codes of the centres of ``cells`` clusters, fitted on about ``sample_rows`` of the vectors.

    The sample is drawn by Bernoulli trials; every vector is indexed whatever the sample held.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    dim = dimension(vectors, vector_col)
    rows = usable(vectors, vector_col, dim)
    share = min(1.0, sample_rows / max(1, rows.count()))
    drawn = rows.sample(share, seed).select(
        array_to_vector(F.col(vector_col).cast("array<double>")).alias("features")
    )
    model = KMeans(k=cells, seed=seed, distanceMeasure="cosine", maxIter=20).fit(drawn)
    centres = np.array([c for c in model.clusterCenters()])
    centres /= np.maximum(np.linalg.norm(centres, axis=1), 1e-300)[:, None]
    return _whole(centres).astype(int).tolist()


def _cells_of(df: DataFrame, id_col: str, centres: Sequence[Sequence[int]], probes: int) -> DataFrame:
    """Each row once for each of its ``probes`` nearest cells; ties to the smaller cell."""
    grid = np.array(centres, np.int32)
    if grid.nbytes > 64 << 20:
        raise ValueError("cells take over 64 MB; they travel with every task")
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.frombuffer(b"".join(batch.column("payload").to_pylist()), "i1").reshape(batch.num_rows, -1)
            near = np.argsort(-(own.astype(np.int32) @ grid.T), axis=1, kind="stable")[:, :probes]
            take = pa.array(np.repeat(np.arange(len(near)), near.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(near.ravel().astype(np.int32)), batch.column(id_col).take(take), batch.column("payload").take(take)],
                ["cell", id_col, "payload"],
            )

    return df.mapInArrow(run, f"cell int, `{id_col}` {id_type}, payload binary")


def cell_index(
    vectors: DataFrame, centres: Sequence[Sequence[int]], id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per vector: its ``cell``, id and ``payload``, a byte for each component."""
    dim = len(centres[0])
    coded = _packed(usable(vectors, vector_col, dim), id_col, vector_col, "i1")
    return _cells_of(coded, id_col, centres, 1)


def write_index(index: DataFrame, path: str) -> str:
    """A folder for each cell, so that a search reads the cells it probes; large cells are several files."""
    index.hint("rebalance", F.col("cell")).write.mode("overwrite").partitionBy("cell").parquet(path)
    return path


def approximate_neighbours(
    index: DataFrame,
    vectors: DataFrame,
    queries: DataFrame,
    centres: Sequence[Sequence[int]],
    k: int,
    probes: int,
    survivors: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    exclude_self: bool = True,
) -> DataFrame:
    """About the k nearest vectors of each query: ``query_id``, the id, ``score``, ``rank``.

    1. A query asks its ``probes`` nearest cells; other cells are not read.
    2. There it meets codes, not vectors, and keeps the ids of the ``survivors`` best.
    3. Only the vectors of those are fetched and compared exactly.

    Results depend on nothing but the given centres and numbers: all approximate scores are whole
    numbers, ties go to the smaller id. The more the vectors cluster, the fewer probes a recall needs;
    see :func:`recall_of` and :func:`choose_probes`.
    """
    dim = len(centres[0])
    wanted = usable(queries, vector_col, dim)
    asked = _packed(wanted, id_col, vector_col, "i1")
    probed = _cells_of(asked, id_col, centres, probes).withColumnRenamed(id_col, "query_id")
    found = _in_cells(index, probed, id_col, "i1", 1.0, survivors, exclude_self)
    mine = vectors.select(id_col, F.col(vector_col).alias("_v"))
    theirs = wanted.select(F.col(id_col).alias("query_id"), F.col(vector_col).alias("_q"))
    met = usable(found.drop("points").join(mine, id_col), "_v", dim).join(theirs, "query_id")
    scored = met.select("query_id", id_col, F.rint(cosine("_q", "_v") * STEPS).cast("bigint").alias("points"))
    return _ranked(scored, id_col, k).select("query_id", id_col, (F.col("points") / STEPS).alias("score"), "rank")


def recall_of(found: DataFrame, exact: DataFrame, id_col: str = "vec_id") -> float:
    """The share of the exact neighbours that were found; 1 where there are none."""
    hits = exact.select("query_id", id_col).join(
        found.select("query_id", id_col, F.lit(1).alias("hit")), ["query_id", id_col], "left"
    )
    return hits.agg(F.coalesce(F.count("hit") / F.count("*"), F.lit(1.0)).alias("r")).first()["r"]


def choose_probes(
    index: DataFrame,
    vectors: DataFrame,
    queries: DataFrame,
    centres: Sequence[Sequence[int]],
    k: int,
    survivors: int,
    target: float = 0.9,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[int, float]:
    """The first of 1, 2, 4 ... cells with which the given queries reach the recall, and that recall.

    ``queries`` should be a few hundred; all cells are the last resort.
    """
    exact = cut_lineage(exact_neighbours(vectors, queries, k, id_col, vector_col, exclude_self=True))
    probes = 1
    while True:
        found = approximate_neighbours(index, vectors, queries, centres, k, probes, survivors, id_col, vector_col)
        reached = recall_of(found, exact, id_col)
        if reached >= target or probes >= len(centres):
            return probes, reached
        probes = min(2 * probes, len(centres))
