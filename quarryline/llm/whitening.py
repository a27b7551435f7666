"""Whitening of embeddings with distributed block matrices.

Entries are taken as floor(256 c).  Each different vector is one row of the fit
list; its rows get consecutive numbers, are centred and dealt into blocks
(``BlockMatrix``).  The transposed matrix times the matrix gives the scatter, a
d x d block whose eigenvectors are found on the driver; the block matrix times the
whitening matrix projects the rows.  The inner dimension of the first product is
split, since a product of one result block would otherwise be one task.

Sums, the number of rows and ``deviation`` are exact whole numbers.  The driver
sees d sums and a d x d block, of at most MOST_DIMENSIONS.

Defined cases: vectors that are null, empty or hold null or non-finite entries go;
so do vectors of another length than most have (the shorter of equally frequent
ones).  Components without spread (an eigenvalue of a millionth of a millionth of
the trace or less) are left out, so equal vectors and a single one give no rows, as
an empty table does.  A deviation that no long can hold is null.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.session import pin

SCALE = 256
COMPONENTS = 4
MOST_DIMENSIONS = 8_192
ROWS_PER_BLOCK = 1_024
LEAST_SHARE = 1e-12


def whole_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is whole, with it as longs (``_ql_x``)."""
    entry = F.col(vector)
    bad = F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = embeddings.where(entry.isNotNull() & (F.size(entry) > 0)).where(~bad)
    return whole.withColumn("_ql_x", F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE).cast("long")))


def _usual_length(rows: DataFrame) -> int | None:
    counted = rows.groupBy(F.size("_ql_x").alias("d")).agg(F.count("*").alias("n"))
    first = counted.orderBy(F.desc("n"), "d").first()
    return first["d"] if first else None


def numbered(rows: DataFrame) -> DataFrame:
    """``rows``, pinned, with consecutive numbers from 0 (``_ql_row``): rows before in
    the partition plus the rows of earlier partitions."""
    rows = pin(rows.withColumn("_ql_at", F.monotonically_increasing_id()))
    part = F.shiftright("_ql_at", 33)
    counts = {r["p"]: r["n"] for r in rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    offsets, total = {}, 0
    for p in sorted(counts):
        offsets[p], total = total, total + counts[p]
    lookup = F.create_map(*[F.lit(v) for kv in offsets.items() for v in kv]) if offsets else F.lit(None)
    at = F.element_at(lookup, part) if offsets else F.lit(0)
    within = F.col("_ql_at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("_ql_row", (at + within).cast("long")).drop("_ql_at")


def _blocks(rows: DataFrame, n: int, d: int) -> BlockMatrix:
    """Rows (_ql_row, array of doubles ``_ql_c``) as blocks."""
    vectors = rows.select(F.col("_ql_row").alias("index"), array_to_vector("_ql_c").alias("vector"))
    indexed = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    return IndexedRowMatrix(indexed, n, d).toBlockMatrix(ROWS_PER_BLOCK, d)


def _scatter(blocks: BlockMatrix, splits: int) -> np.ndarray:
    """The transposed matrix times the matrix; ``splits`` tasks add up parts of it."""
    java = blocks._java_matrix_wrapper._java_model
    product = java.transpose().multiply(java, splits)
    d = int(blocks.numCols())
    return np.array(product.toLocalMatrix().toArray()).reshape(d, d, order="F")


def _deviation(n: int, sums: list[int], most: int) -> Column:
    """Sum over dimensions of (n x - S)^2, in longs where they hold it."""
    fits = len(sums) * (n * most + max(abs(s) for s in sums)) ** 2 < 2**63
    kind = "long" if fits else "decimal(38,0)"
    each = F.zip_with("_ql_x", F.array(*[F.lit(s) for s in sums]), lambda x, s: F.lit(n).cast(kind) * x.cast(kind) - s.cast(kind))
    if fits:
        return F.aggregate(each, F.lit(0).cast("long"), lambda total, x: total + x * x)
    squares = F.transform(each, lambda x: (x * x).cast("decimal(38,0)"))
    total = F.aggregate(squares, F.lit(0).cast("decimal(38,0)"), lambda total, x: (total + x).cast("decimal(38,0)"))
    return total.try_cast("long")


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The whole rows, once for each component: ``_ql_component``, ``_ql_n``,
    ``_ql_deviation``, ``_ql_whitened``, ``_ql_explained``, ``_ql_identity_error``."""
    spark = embeddings.sparkSession
    rows = whole_vectors(embeddings, vector)
    d = _usual_length(rows)
    if d is None:
        return _expanded(rows, [], 0, F.lit(0).cast("long"), F.lit(0.0), [], 0.0)
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} entries; at most {MOST_DIMENSIONS} are whitened")
    rows = rows.where(F.size("_ql_x") == d)
    fit = numbered(rows.select("_ql_x").distinct())
    facts = fit.select(F.posexplode("_ql_x").alias("at", "x")).groupBy("at")
    facts = sorted(facts.agg(F.count("*").alias("n"), F.sum("x").alias("s"), F.max(F.abs("x")).alias("m")).collect())
    n, sums, most = facts[0]["n"], [r["s"] for r in facts], max(r["m"] for r in facts)
    means = F.array(*[F.lit(s / n) for s in sums])
    centred = fit.select("_ql_row", F.zip_with("_ql_x", means, lambda x, m: x.cast("double") - m).alias("_ql_c"))
    blocks = _blocks(centred, n, d)
    covariance = _scatter(blocks, max(1, min(-(-n // ROWS_PER_BLOCK), spark.sparkContext.defaultParallelism * 4))) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(covariance))
    k = sum(bool(v > LEAST_SHARE * trace) for v in values[:components])
    if not k:
        return _expanded(rows, [], n, F.lit(0).cast("long"), F.lit(0.0), [], 0.0)
    whitening = vectors[:, :k] / np.sqrt(values[:k])
    matrix = DenseMatrix(d, k, whitening.ravel(order="F").tolist())
    factor = BlockMatrix(spark.sparkContext.parallelize([((0, 0), matrix)], 1), d, k, d, k)
    projected = _row_frame(blocks.multiply(factor))
    error = _identity_error(projected, n, k)
    placed = fit.join(projected, "_ql_row").select("_ql_x", "_ql_w")
    with_rows = rows.join(placed, "_ql_x")
    return _expanded(with_rows, values[:k], n, _deviation(n, sums, most), F.col("_ql_w"), values[:k] / trace, error)


def _row_frame(blocks: BlockMatrix) -> DataFrame:
    """(_ql_row, array ``_ql_w``) of a block matrix."""
    rows = callMLlibFunc("getIndexedRows", blocks.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("_ql_row"), vector_to_array("vector").alias("_ql_w"))


def _identity_error(projected: DataFrame, n: int, k: int) -> float:
    """The largest entry of the projected rows' covariance minus the identity."""
    w = [F.col("_ql_w")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(w)]
    first = projected.agg(*sums).first()
    means = [first[f"s{i}"] / n for i in range(k)]
    products = [F.sum((w[i] - means[i]) * (w[j] - means[j])).alias(f"p{i}_{j}") for i, j in pairs]
    second = projected.agg(*products).first()
    return max(abs(second[f"p{i}_{j}"] / n - (i == j)) for i, j in pairs)


def _expanded(rows, values, n, deviation, whitened, explained, error) -> DataFrame:
    """A row for each component of each row."""
    shares = F.array(*[F.lit(float(e)) for e in explained]) if len(explained) else F.array().cast("array<double>")
    rows = rows.withColumn("_ql_deviation", deviation)
    rows = rows.select("*", F.posexplode(shares).alias("_ql_at", "_ql_explained")).withColumns({
        "_ql_component": (F.col("_ql_at") + 1).cast("int"),
        "_ql_n": F.lit(n).cast("long"),
        "_ql_whitened": F.get(whitened, F.col("_ql_at")) if len(explained) else F.lit(0.0),
        "_ql_identity_error": F.lit(float(error)),
    })
    return rows.drop("_ql_x", "_ql_at", "_ql_w")
