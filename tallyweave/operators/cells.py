"""Approximate vector search: cells of near vectors with product codes, and exact scores in the end.

The space is cut into cells by k-means. A vector is kept as the number of its
cell and a code of a few bytes for what is left of it: that is cut into parts,
and each byte names the nearest of 256 typical parts. A query looks into the
cells whose centre has the largest product with it, estimates the products from
the codes by table, and only the most promising vectors are compared exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, stored
from .numbering import first_rows
from .scoring import SCORE_DIGITS, matrix

# The model is fitted on at most so many vectors, those of the least id hashes.
TRAIN_ROWS = 50_000
MOST_CELLS = 1_024
PARTS = 16
TYPICAL = 256
ROUNDS = 8  # of the fitting of typical parts
SEED = 11
SLICE_ROWS = 500_000  # coded vectors that one task looks through
BLOCK_QUERIES = 2_000

_FOUND = "query_id long, passage_id long, estimate double"


@dataclass
class CellModel:
    """Centres of the cells and, for each part of a vector, its typical values."""

    centres: np.ndarray  # cells x width
    typical: np.ndarray  # parts x TYPICAL x width of a part

    def parts_of(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors as vectors x parts x width of a part, filled up with zeros."""
        parts, _, size = self.typical.shape
        whole = np.zeros((len(vectors), parts * size))
        whole[:, :vectors.shape[1]] = vectors
        return whole.reshape(len(vectors), parts, size)

    def nearest_cell(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors @ self.centres.T - (self.centres ** 2).sum(axis=1) / 2).argmax(axis=1)

    def codes(self, vectors: np.ndarray, cells: np.ndarray) -> np.ndarray:
        left = self.parts_of(vectors - self.centres[cells])
        return np.stack([
            _nearest(left[:, part], self.typical[part]) for part in range(left.shape[1])
        ], axis=1).astype(np.uint8)


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points @ centres.T - (centres ** 2).sum(axis=1) / 2).argmax(axis=1)


def _typical(points: np.ndarray, count: int) -> np.ndarray:
    """Up to `count` centres of some points, by Lloyd's rounds from a seeded start."""
    pick = np.random.default_rng(SEED)
    centres = points[pick.permutation(len(points))[:count]].copy()
    for _ in range(ROUNDS):
        own = _nearest(points, centres)
        sizes = np.bincount(own, minlength=len(centres))
        sums = np.stack([np.bincount(own, column, len(centres)) for column in points.T], axis=1)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def fit_cells(vectors: DataFrame, cells: int | None = None, parts: int = PARTS) -> CellModel:
    """A model from `vectors` (passage_id, vector), on a sample of at most TRAIN_ROWS.

    By default there are about as many cells as the root of the number of
    vectors, at most MOST_CELLS. All vectors have one length and finite values.
    """
    usable = vectors.filter("vector is not null").select("passage_id", F.col("vector").cast("array<double>"))
    if cells is None:
        cells = max(1, min(MOST_CELLS, int(usable.count() ** 0.5)))
    sample = stored(
        usable.orderBy(F.xxhash64("passage_id", F.lit(SEED)), "passage_id").limit(TRAIN_ROWS), "cell-sample"
    )
    points = sample.select("passage_id", array_to_vector("vector").alias("features"))
    fitted = KMeans(k=max(2, cells), seed=SEED, maxIter=15).fit(points)
    centres = np.array(fitted.clusterCenters())
    rows = matrix(sample.select("vector").toArrow()["vector"])
    size = -(-rows.shape[1] // parts)
    model = CellModel(centres, np.zeros((parts, 1, size)))
    left = model.parts_of(rows - centres[model.nearest_cell(rows)])
    model.typical = np.stack([_typical(left[:, part], TYPICAL) for part in range(parts)])
    return model


def cell_index(vectors: DataFrame, model: CellModel) -> DataFrame:
    """passage_id, cell and code for every vector, stored."""

    ship_package(vectors.sparkSession)

    def coded(batches):
        for batch in batches:
            if batch.num_rows:
                rows = matrix(batch.column(1))
                cells = model.nearest_cell(rows)
                codes = model.codes(rows, cells)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(cells.astype(np.int32)),
                     pa.array([code.tobytes() for code in codes], pa.binary())],
                    ["passage_id", "cell", "code"])

    usable = vectors.filter("vector is not null").select("passage_id", "vector")
    return stored(usable.mapInArrow(coded, "passage_id long, cell int, code binary"), "cell-index")


def near_top_k(
    index: DataFrame, vectors: DataFrame, queries: DataFrame, model: CellModel, k: int, probes: int,
    candidates: int, skip_same: bool = False, slice_rows: int = SLICE_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """About the k nearest vectors of every query: query_id, passage_id, score, rank.

    Each query looks into `probes` cells and compares its `candidates` best
    estimates exactly with `vectors`; scores and ties are those of exact
    search. With all cells and as many candidates as there are vectors the
    result is that of exact search. A cell with more than `slice_rows` vectors
    is cut by id, the queries of a cell into blocks; pairs never become rows
    before they are candidates.
    """
    ship_package(vectors.sparkSession)
    probes = min(probes, len(model.centres))

    def probing(batches):
        for batch in batches:
            if batch.num_rows:
                rows = matrix(batch.column(1))
                near = np.argsort(-(rows @ model.centres.T), axis=1, kind="stable")[:, :probes]
                ids = np.repeat(batch.column(0).to_numpy(), near.shape[1])
                at = pa.array(np.repeat(np.arange(len(rows)), near.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(near.ravel().astype(np.int32)), batch.column(1).take(at)],
                    ["query_id", "cell", "vector"])

    asked = queries.filter("vector is not null").select("query_id", F.col("vector").cast("array<double>"))
    probed = stored(
        asked.mapInArrow(probing, "query_id long, cell int, vector array<double>"), "cell-probes"
    )
    # one row per cell
    sizes = index.groupBy("cell").count().select(
        "cell", F.expr(f"count div {slice_rows} + 1").alias("_slices"))
    loads = probed.groupBy("cell").count().select(
        "cell", F.expr(f"count div {block_queries} + 1").alias("_blocks"))
    plan = F.broadcast(sizes.join(loads, "cell"))
    left = index.join(plan, "cell").select(
        "passage_id", "code", "cell", F.expr("pmod(xxhash64(passage_id), _slices)").alias("_slice"),
        F.explode(F.expr("sequence(0, _blocks - 1)")).alias("_block"))
    right = probed.join(plan, "cell").select(
        "query_id", "vector", "cell", F.expr("pmod(xxhash64(query_id), _blocks)").alias("_block"),
        F.explode(F.expr("sequence(0, _slices - 1)")).alias("_slice"))

    def estimated(coded: pa.Table, questions: pa.Table) -> pa.Table:
        owners, ids, estimates = [], [], []
        if coded.num_rows and questions.num_rows:
            passages = coded["passage_id"].to_numpy()
            parts = model.typical.shape[0]
            codes = np.frombuffer(b"".join(coded["code"].to_pylist()), np.uint8).reshape(-1, parts)
            rows = matrix(questions["vector"])
            base = rows @ model.centres[coded["cell"][0].as_py()]
            tables = np.einsum("qps,pts->qpt", model.parts_of(rows), model.typical)
            for at, query in enumerate(questions["query_id"].to_pylist()):
                guess = base[at] + sum(tables[at, part][codes[:, part]] for part in range(parts))
                if skip_same:
                    guess = np.where(passages == query, -np.inf, guess)
                best = np.argsort(-guess, kind="stable")[:candidates]
                best = best[np.isfinite(guess[best])]
                owners.append(np.full(len(best), query, np.int64))
                ids.append(passages[best])
                estimates.append(guess[best])
        none = np.zeros(0, np.int64)
        return pa.table({
            "query_id": np.concatenate([none, *owners]), "passage_id": np.concatenate([none, *ids]),
            "estimate": np.concatenate([np.zeros(0), *estimates])})

    group = ["cell", "_slice", "_block"]
    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(estimated, _FOUND)
    order = [F.col("estimate").desc(), F.col("passage_id")]
    some = first_rows(found, ["query_id"], order, candidates, "_place").select("query_id", "passage_id")
    product = F.aggregate(
        F.zip_with(F.col("vector"), F.col("_asked"), lambda a, b: a.cast("double") * b), F.lit(0.0),
        lambda total, value: total + value)
    scored = (
        some.join(vectors.select("passage_id", "vector"), "passage_id")
        .join(asked.withColumnRenamed("vector", "_asked"), "query_id")
        .select("query_id", "passage_id", F.round(product, SCORE_DIGITS).alias("score"))
    )
    order = [F.col("score").desc(), F.col("passage_id")]
    return first_rows(scored, ["query_id"], order, k, "rank").withColumn("rank", F.col("rank").cast("long"))
