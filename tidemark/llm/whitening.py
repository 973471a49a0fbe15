"""Whitening of embeddings with MLlib's distributed block matrices.

Each entry becomes an integer on a fixed grid, so sums and deviations are exact. The
different vectors, centred, are indexed into blocks of rows; the transposed block matrix
times itself is the scatter matrix, which is as small as the dimension squared and is
decomposed on the driver. The whitening matrix, a single block, then multiplies the block
matrix of all rows.

Block products are grouped along the row dimension, so that a task holds a few blocks
however many rows there are. MLlib plans a product from the list of its blocks on the
driver; a matrix is therefore built for ``SLAB_ROWS`` rows at a time, and scatter matrices
are added.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark import SparkContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

#: The grid: ``floor(STEPS * entry) + SHIFT``.
STEPS = 64
SHIFT = 1_000_000
COMPONENTS = 16

#: Rows of one block matrix; its row numbers and its list of blocks stay small.
SLAB_ROWS = 1 << 30
#: Rows of a block, at least and at most, and the most bytes of a block.
BLOCK_ROWS = (1024, 65536)
BLOCK_BYTES = 32 << 20
#: Blocks of either factor that one task multiplies.
BLOCKS_PER_TASK = 4

OUTPUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


class Fit(NamedTuple):
    """The different vectors: how many, their sums, and what their covariance gives."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def usable(self) -> np.ndarray:
        """Components whose variance is more than rounding."""
        floor = len(self.sums) * np.finfo(float).eps * max(self.values[0], 0.0)
        return self.values > floor

    def whitening(self) -> np.ndarray:
        """One column for each component; zeros where there is no variance."""
        scale = np.zeros(len(self.values))
        scale[self.usable()] = 1 / np.sqrt(self.values[self.usable()])
        return self.vectors * scale


def gridded(embeddings: DataFrame, column: str) -> DataFrame:
    """``vec_id, x`` of the rows whose vector is whole and finite."""
    entries = F.col(column).cast("array<double>")
    scaled = F.transform(entries, lambda c: F.floor(c * STEPS))
    top = float(1 << 62)
    fine = F.forall(
        entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < top / STEPS)
    )
    return (
        embeddings.where(fine & (F.size(entries) > 0))
        .select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("x"))
        .withColumn("x", F.transform("x", lambda x: x.cast("long") + SHIFT))
    )


def same_length(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows of the most frequent length (of equally frequent ones the greatest), and it."""
    sizes = rows.groupBy(F.size("x").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    if most is None:
        return rows, 0
    return rows.where(F.size("x") == most["size"]), most["size"]


def indexed(rows: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """The stored rows with an ``index`` from 0 without gaps, and their number.

    The first numbers are kept with the rows, so a repeated task changes nothing; a number of
    rows for each part closes the gaps.
    """
    kept = stored(rows.withColumn("number", F.monotonically_increasing_id()), purpose)
    part = F.shiftrightunsigned("number", 33)
    counts = sorted(
        (row["part"], row["count"]) for row in kept.groupBy(part.alias("part")).count().collect()
    )
    total, offsets = 0, []
    for own, count in counts:
        offsets.append((own, total))
        total += count
    # One row for each task that wrote.
    starts = rows.sparkSession.createDataFrame(offsets, "part long, start long")
    numbered = kept.join(F.broadcast(starts), part == F.col("part")).withColumn(
        "index", F.col("start") + F.col("number").bitwiseAND((1 << 33) - 1)
    )
    return numbered.drop("number", "part", "start"), total


def sums_of(points: DataFrame, size: int) -> list[int]:
    """Exact sums of each dimension."""
    found = (
        points.select(F.posexplode("x").alias("place", "x"))
        .groupBy("place")
        .agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("total"))
        .collect()
    )
    totals = {row["place"]: int(row["total"]) for row in found}
    return [totals[place] for place in range(size)]


def centred(x: str, sums: list[int], n: int) -> Column:
    """``x - S / n``: whole parts first, so that a common offset costs no digits."""
    whole = F.array(*[F.lit(total // n) for total in sums])
    rest = F.array(*[F.lit(total % n / n) for total in sums])
    return F.zip_with(
        F.zip_with(x, whole, lambda a, q: (a - q).cast("double")), rest, lambda a, r: a - r
    )


def deviation(x: str, sums: list[int], n: int) -> Column:
    """Sum of ``(n * x - S) ** 2``, exact; null where a long cannot hold it."""
    whole = F.array(*[F.lit(total // n) for total in sums])
    rest = F.array(*[F.lit(total % n) for total in sums])
    apart = F.zip_with(x, whole, lambda a, q: F.try_multiply(F.lit(n), a - q))
    apart = F.zip_with(apart, rest, lambda a, r: F.try_subtract(a, r))
    return F.aggregate(
        apart, F.lit(0).cast("long"), lambda total, a: F.try_add(total, F.try_multiply(a, a))
    )


def block_rows(n: int, size: int) -> int:
    least, most = BLOCK_ROWS
    return max(1, min(max(least, -(-n // 4096)), most, BLOCK_BYTES // (8 * size)))


def slabs(rows: DataFrame, n: int, size: int):
    """Block matrices of the ``index, centred`` rows, and the first index of each."""
    for first in range(0, n, SLAB_ROWS):
        own = rows.where(F.col("index").between(first, first + SLAB_ROWS - 1)) if n > SLAB_ROWS else rows
        frame = own.select(
            (F.col("index") - first).alias("index"), array_to_vector("centred").alias("vector")
        )
        height = min(SLAB_ROWS, n - first)
        matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(frame, "vector"), height, size)
        yield first, matrix.toBlockMatrix(block_rows(height, size), size)


def gram(matrix: BlockMatrix, size: int) -> np.ndarray:
    """The transposed matrix times the matrix, its products dealt along the rows."""
    flipped = matrix.transpose()
    groups = max(1, -(-matrix.numRowBlocks // BLOCKS_PER_TASK))
    product = flipped._java_matrix_wrapper.call(
        "multiply", matrix._java_matrix_wrapper._java_model, groups
    )
    return BlockMatrix(product, size, size).toLocalMatrix().toArray()


def projected(matrix: BlockMatrix, whitening: np.ndarray) -> BlockMatrix:
    size, k = whitening.shape
    block = DenseMatrix(size, k, whitening.ravel(order="F").tolist())
    # A few thousand numbers at most, whatever the number of rows.
    context = SparkContext.getOrCreate()
    return matrix.multiply(BlockMatrix(context.parallelize([((0, 0), block)], 1), size, k))


def fitted(points: DataFrame, n: int, size: int) -> Fit:
    sums = sums_of(points, size)
    rows = points.withColumn("centred", centred("x", sums, n))
    scatter = sum(gram(matrix, size) for _, matrix in slabs(rows, n, size))
    covariance = (scatter + scatter.T) / 2 / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:COMPONENTS]
    return Fit(n, sums, values[order], vectors[:, order], float(np.trace(covariance)))


def identity_error(points: DataFrame, fit: Fit, size: int) -> float | None:
    """Largest entry of the whitened vectors' covariance minus the identity, measured."""
    rows = points.withColumn("centred", centred("x", fit.sums, fit.n))
    k, usable = len(fit.values), fit.usable()
    found = sum(
        gram(projected(matrix, fit.whitening()), k) for _, matrix in slabs(rows, fit.n, size)
    )
    off = np.abs(found / fit.n - np.eye(k))[np.ix_(usable, usable)]
    return float(off.max()) if off.size else None


def whitened(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """One row for each usable vector and component, projected and scaled to unit variance.

    Rows go whose vector is null or empty, holds null or non-finite entries, or entries whose
    grid value no long holds. Vectors of another length than the most frequent one go too.
    Equal grid vectors count once in the fit, repeated rows and null ids are projected like
    others. Components without variance beyond rounding (all of them, for a single vector)
    have a null ``whitened`` and are left out of ``identity_error``, which is null without any;
    ``explained`` is null where nothing varies. ``deviation`` is null where it exceeds a long.
    No usable vector gives no rows. Only ``vec_id`` and the vector are read. The dimension
    squared must fit the driver: the covariance is decomposed there.

    Columns: ``vec_id, component, n, deviation, whitened, explained, identity_error``.
    """
    spark = embeddings.sparkSession
    rows, size = same_length(gridded(embeddings, column))
    if not size:
        return spark.createDataFrame([], OUTPUT)
    rows, total = indexed(rows, "whitening-rows")
    points, n = indexed(rows.select("x").distinct(), "whitening-points")
    fit = fitted(points, n, size)
    error = identity_error(points, fit, size)
    own = rows.withColumn("centred", centred("x", fit.sums, n))
    parts = []
    for first, matrix in slabs(own, total, size):
        found = projected(matrix, fit.whitening()).toIndexedRowMatrix()
        frame = callMLlibFunc("getIndexedRows", found._java_matrix_wrapper._java_model)
        parts.append(
            frame.select((F.col("index") + first).alias("index"), vector_to_array("vector").alias("w"))
        )
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.union(part)
    has_variance = F.array(*[F.lit(bool(flag)) for flag in fit.usable()])
    shares = F.array(
        *[F.lit(float(max(v, 0.0)) / fit.trace if fit.trace > 0 else None).cast("double") for v in fit.values]
    )
    return (
        rows.select("index", "vec_id", deviation("x", fit.sums, n).alias("deviation"))
        .join(scores, "index")
        .select("vec_id", "deviation", F.posexplode("w").alias("place", "whitened"))
        .select(
            "vec_id",
            (F.col("place") + 1).alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            F.when(F.get(has_variance, "place"), F.col("whitened")).alias("whitened"),
            F.get(shares, "place").alias("explained"),
            F.lit(error).cast("double").alias("identity_error"),
        )
    )
