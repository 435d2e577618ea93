"""Whitened embeddings on the leading principal components, by Spark MLlib's BlockMatrix.

Method: the distinct quantised vectors are numbered and centred exactly, and indexed as rows
of a matrix of distributed blocks. Its transpose multiplied with itself is the scatter
matrix, of which only that square of the dimensions comes to the driver for a local
eigendecomposition. A second block product, with the whitening matrix, projects all rows.

Quantising: a component c becomes the whole number floor(scale * c) + shift. Sums are exact, and
n * x - S, a centred component times n, is a whole number, so nothing is lost to the shift.
Covariances have the divisor n. Components are numbered by falling eigenvalue; a sign makes the
largest entry of an eigenvector positive.

Sizes: the driver and each task hold the square of the dimensions and one block of
`BLOCK_ROWS` rows (or as many more as keep the matrix at `MOST_BLOCKS` blocks, up to 64 times
as many) at a time; MLlib plans a product on the driver, by the coordinates of the blocks.
The scatter product is split over as many tasks as the row blocks allow, and their partial
squares are added up. Rows find their vector's result by a digest of the vector: vectors
with more than one row in `HOT_SHARE`, of which there are at most `HOT_SHARE`, by broadcast,
all others by a shuffle.

Edge cases: vectors that are null or hold a null or non-finite component take no part, nor
do those of another length than most vectors have (the longer one on a tie) or of none;
repeated vectors count once in the fit, and each of their rows gets its result; directions
without variance (beyond the rank of the vectors) are no components; null ids are kept as
they are; an empty table, or one vector only, gives no rows. Only the named columns are
read, whatever the others are called.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.topk import usable
from tidemark.sources.files import store

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000

BLOCK_ROWS = 1024
MOST_BLOCKS = 50_000
HOT_SHARE = 10_000

# a sum of squares below this is exact in a long
_LONG = 2**63 - 1


def quantised(vector: str, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * c) + shift of each component, c as double."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(shift).cast("bigint"))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Stored, with a gapless number from 0 for each row, in no particular order. One count for
    each partition of the table is gathered."""
    held = store(df.withColumn("_slot", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_slot", 33)
    counts = held.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("rows"), F.min("_slot").alias("_first"))
    start, starts = 0, []
    for row in counts.orderBy("_part").collect():
        starts.append((row["_part"], start - row["_first"]))
        start += row["rows"]
    # one row for each partition of the table written just now
    offsets = F.broadcast(held.sparkSession.createDataFrame(starts, "_part long, _offset long"))
    return (
        held.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(name, F.col("_slot") + F.col("_offset"))
        .drop("_part", "_slot", "_offset")
    )


def rows_per_block(n: int, block_rows: int = BLOCK_ROWS) -> int:
    """`block_rows`, and more where that made more than `MOST_BLOCKS` blocks, up to 64 times."""
    return min(max(block_rows, -(-n // MOST_BLOCKS)), 64 * block_rows)


def block_matrix(rows: DataFrame, n: int, width: int, block_rows: int = BLOCK_ROWS) -> BlockMatrix:
    """Rows (index, values as array of doubles) as blocks of `block_rows` rows. Each product
    reads the blocks several times, so they are kept until `release`; lost ones are made
    again from the stored rows."""
    vectors = MLUtils.convertVectorColumnsFromML(
        rows.select(F.col("index").cast("bigint"), array_to_vector("values").alias("vector")), "vector"
    )
    indexed = IndexedRowMatrix(callMLlibFunc("createIndexedRowMatrix", vectors, n, width))
    return indexed.toBlockMatrix(block_rows, width).persist(StorageLevel.MEMORY_AND_DISK)


def release(matrix: BlockMatrix) -> None:
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)


def scatter(matrix: BlockMatrix, splits: int) -> np.ndarray:
    """The transpose multiplied with the matrix, its rows dealt over `splits` tasks."""
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def whitening_matrix(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns that project on the leading components, over the root of their eigenvalue; and
    the share of the trace each component has."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    real = values > max(float(values[0]) if len(values) else 0.0, 0.0) * len(covariance) * np.finfo(float).eps
    values, vectors = values[real], vectors[:, real]
    if not len(values):
        return np.zeros((len(covariance), 0)), np.zeros(0)
    largest = np.abs(vectors).argmax(0)
    vectors = vectors * np.sign(vectors[largest, np.arange(len(values))])
    return vectors / np.sqrt(values), values / np.trace(covariance)


def project(matrix: BlockMatrix, by: np.ndarray) -> BlockMatrix:
    """The matrix multiplied with a local one."""
    context = matrix.blocks.context
    local = DenseMatrix(by.shape[0], by.shape[1], by.T.ravel().tolist())
    right = BlockMatrix(context.parallelize([((0, 0), local)], 1), by.shape[0], by.shape[1])
    return matrix.multiply(right)


def rows_of(matrix: BlockMatrix) -> DataFrame:
    """index and values of each row."""
    indexed = matrix.toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", indexed._java_matrix_wrapper._java_model).toDF("index", "vector")
    return rows.select("index", vector_to_array("vector").alias("values"))


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct x once, with `size`, the rows that have it, and `index`, its number."""
    return numbered(vectors.groupBy("x").agg(F.count(F.lit(1)).alias("size")), "index")


def whiten(
    embeddings: DataFrame,
    components: int = COMPONENTS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = SCALE,
    shift: int = SHIFT,
    block_rows: int = BLOCK_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """For each row that takes part: id, n (distinct vectors), deviation (sum over the
    dimensions of (n * x - S)^2, a long where that holds it, else a decimal), `whitened` (an array with
    one value for each component), `explained` (the components' shares of the variance) and
    identity_error (the largest entry of the whitened covariance minus the identity)."""
    given = embeddings.where(usable(vector_column)).select(
        F.col(id_column).alias("id"), quantised(vector_column, scale, shift).alias("x")
    )
    lengths = given.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("rows")).where("width > 0")
    most = lengths.orderBy(F.desc("rows"), F.desc("width")).first()
    schema = embeddings.select(F.col(id_column).alias("id")).schema["id"].dataType.simpleString()
    result = f"id {schema}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    spark = embeddings.sparkSession
    if most is None:
        return spark.createDataFrame([], result)
    width = most["width"]
    given = given.where(F.size("x") == width)
    fit = fit_list(given)

    cells = fit.select(F.posexplode("x").alias("dimension", "x"))
    sums = (
        cells.groupBy("dimension")
        .agg(F.sum("x").alias("total"), F.min("x").alias("least"), F.max("x").alias("most"), F.count(F.lit(1)).alias("n"))
        .orderBy("dimension")
        .collect()
    )
    n = sums[0]["n"]
    furthest = max(max(abs(n * r["least"] - r["total"]), abs(n * r["most"] - r["total"])) for r in sums)
    exact = "bigint" if width * furthest**2 <= _LONG else "decimal(38,0)"

    # whole numbers n * x - S, and as doubles x - S / n
    totals = F.array(*[F.lit(r["total"]).cast("bigint") for r in sums])
    apart = F.transform(F.arrays_zip(F.col("x").alias("x"), totals.alias("s")), lambda c: F.lit(n).cast("bigint") * c["x"] - c["s"])
    deviation = F.aggregate("apart", F.lit(0).cast(exact), lambda total, a: (total + a.cast(exact) * a.cast(exact)).cast(exact))
    centred = store(
        fit.select("index", "size", _digest("x").alias("key"), apart.alias("apart")).select(
            "index",
            "size",
            "key",
            deviation.alias("deviation"),
            F.transform("apart", lambda a: a.cast("double") / F.lit(float(n))).alias("values"),
        ),
        "centred",
    )
    block_rows = rows_per_block(n, block_rows)
    matrix = block_matrix(centred, n, width, block_rows)
    splits = max(1, min(-(-n // block_rows), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    by, explained = whitening_matrix(scatter(matrix, splits) / n, components)
    if not len(explained):
        release(matrix)
        return spark.createDataFrame([], result)
    projected = store(rows_of(project(matrix, by)), "projected")
    release(matrix)
    matrix = block_matrix(projected, n, len(explained), block_rows)
    again = scatter(matrix, splits) / n
    release(matrix)
    error = float(np.abs(again - np.eye(len(explained))).max())

    ready = store(
        centred.select("index", "size", "key", "deviation")
        .join(projected, "index")
        .select(F.col("key").alias("_key"), "size", "deviation", F.col("values").alias("whitened")),
        "whitened",
    )
    asked = store(given.select("id", _digest("x").alias("key")), "asked")
    # more than 1 / hot_share of all rows each: at most `hot_share` of them, so a bounded table
    hot = F.col("size") > asked.count() / hot_share
    same = F.col("key") == F.col("_key")
    frequent = F.broadcast(ready.where(hot))
    rows = asked.join(frequent, same).unionAll(
        asked.join(frequent, same, "left_anti").join(ready.where(~hot), same)
    )
    return rows.select(
        "id",
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(float(e)) for e in explained]).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _digest(vector: str) -> Column:
    return F.sha2(F.array_join(F.col(vector).cast("array<string>"), ",").cast("binary"), 256)
