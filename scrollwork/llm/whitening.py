"""Whitening of embeddings by the singular values of centred distributed rows.

Entries become integers first, so sums and deviations are exact whatever the order of the rows. MLlib's computeSVD takes
the rows, centred one by one, and gives right singular vectors and singular values s; the eigenvalues of the covariance
are s^2 / n. The total variance does not come from these but from the exact deviations. Rows are projected where they
lie, and how far the result is from white is measured on the whole of it. All that comes to the driver is of the size of the dimensions: their sums and
MLlib's square matrix of products.

Defined results: a vector that is null, or holds a null, NaN or infinite entry, is dropped; an empty vector has no
dimensions and is dropped too. Rows with a null or repeated vec_id are rows of their own. Directions without variance (under
RANK of the largest singular value) are no components, so equal vectors, a single one, or none give no rows. Vectors of
different lengths, and entries too large to be squared exactly in 64 bits, stop the query with an error. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Components that are returned, and the share of the largest singular value that makes one.
COMPONENTS, RANK = 32, 1e-6
#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000


def integers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and x, the entries as 64-bit integers, of the vectors that can be used."""
    entries = F.col(embedding).cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    usable = F.forall(entries, finite)
    # Spark may work this out before it drops a vector, so only what is kept may be an error
    whole = F.transform(entries, lambda c: F.when(F.abs(c) < 2.0**56 / SCALE, F.floor(c * SCALE) + SHIFT).when(finite(c), F.raise_error(F.lit("an entry is too large")).cast("long")))
    return vectors.where(F.col(embedding).isNotNull() & (F.size(embedding) > 0) & usable).select(F.col(vec_id).alias("vec_id"), whole.alias("x"))


@dataclass(frozen=True)
class Whitening:
    """What is learnt from all rows. `components`: a column for each, over the square root of its eigenvalue."""

    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray
    total_variance: float

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.total_variance

    def apart(self) -> Column:
        """n * x - S, in 64 bits."""
        sums = F.lit(np.asarray(self.sums, np.int64))
        return F.zip_with("x", sums, lambda x, s: F.try_subtract(F.try_multiply(x, F.lit(self.n)), s))

    def centred(self) -> Column:
        return F.transform(self.apart(), lambda a: a / F.lit(float(self.n)))

    def deviation(self) -> Column:
        """The squared distance from the mean, times n^2."""
        total = F.aggregate(self.apart(), F.lit(0).cast("long"), lambda t, a: F.try_add(t, F.try_multiply(a, a)))
        return F.coalesce(total, F.raise_error(F.lit("a deviation does not fit 64 bits")).cast("long"))

    def project(self, rows: DataFrame) -> DataFrame:
        """vec_id, deviation and whitened, an array with an entry for each component."""
        n, sums, matrix = self.n, self.sums, self.components

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(sums))
                    z = ((n * x - sums) / n) @ matrix
                    offsets = np.arange(0, z.size + 1, z.shape[1], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.ListArray.from_arrays(pa.array(offsets), pa.array(z.ravel()))], names=["vec_id", "deviation", "whitened"])

        kind = rows.schema["vec_id"].dataType.simpleString()
        return rows.select("vec_id", "x", self.deviation().alias("deviation")).mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def _totals(rows: DataFrame, column: str) -> tuple[int, list]:
    """Rows, and the sum of each dimension."""
    got = sorted(rows.select(F.posexplode(column).alias("k", "v")).groupBy("k").agg(F.sum("v"), F.count("*")).collect())
    if len({r[2] for r in got}) > 1:
        raise ValueError("the vectors have different lengths")
    return (got[0][2], [r[1] for r in got]) if got else (0, [])


def _matrix(rows: DataFrame, column: Column) -> RowMatrix:
    made = rows.select(array_to_vector(column).alias("row"))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(made, "row"))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learnt from all rows of `integers`; nothing if they have no variance."""
    n, sums = _totals(rows, "x")
    if not n:
        return None
    start = Whitening(n, np.array(sums, np.int64), np.zeros(0), np.zeros((len(sums), 0)), 0.0)
    total = int(rows.agg(F.sum(start.deviation().cast("decimal(38,0)"))).first()[0])
    if not total:
        return None
    found = _matrix(rows, start.centred()).computeSVD(len(sums), computeU=False, rCond=RANK)
    eigenvalues = np.square(found.s.toArray()[:components]) / n
    vectors = found.V.toArray()[:, :components]
    return Whitening(n, start.sums, eigenvalues, vectors / np.sqrt(eigenvalues), total / n**3)


def identity_error(projected: DataFrame) -> float:
    """The largest entry, in absolute value, of the covariance of `whitened` minus the identity."""
    n, sums = _totals(projected, "whitened")
    means = F.lit(np.array(sums, np.float64) / n)
    products = _matrix(projected, F.zip_with("whitened", means, lambda z, m: z - m)).computeGramianMatrix().toArray()
    return float(np.abs(products / n - np.eye(len(sums))).max())


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = integers(table(spark, sf_dir, "embeddings"))
    learnt = fit(rows)
    if learnt is None:
        return spark.createDataFrame([], OUT)
    projected = learnt.project(rows)
    error = identity_error(projected)
    each = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return each.select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(learnt.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.lit(learnt.explained), F.col("k")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def brute_force(vectors: list[list[float]], components: int = COMPONENTS) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Deviations, whitened rows (up to the sign of each column) and explained shares, from the covariance itself in long doubles."""
    x = np.array([[int(np.floor(SCALE * np.float64(c))) + SHIFT for c in v] for v in vectors], np.int64)
    n, sums = len(x), [sum(map(int, column)) for column in x.T]
    apart = [[n * int(c) - s for c, s in zip(row, sums, strict=True)] for row in x]
    deviations = [sum(a * a for a in row) for row in apart]
    centred = np.array(apart, np.longdouble) / n
    values, vectors = np.linalg.eigh((centred.T @ centred / n).astype(np.float64))
    order = np.argsort(-values)[:components]
    with np.errstate(invalid="ignore", divide="ignore"):
        whitened = centred.astype(np.float64) @ vectors[:, order] / np.sqrt(values[order])
    return deviations, whitened, values[order] / (sum(deviations) / n**3)
