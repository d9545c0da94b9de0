"""Whitening of embedding vectors with distributed block matrices."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, functions as F

from lexikin.llm.common import written

#: A component c of a vector becomes floor(1024 * c) + 100000.
SCALE, SHIFT = 1024, 100_000
#: Components of larger size don't fit a long and count as not finite.
LARGEST = 2.0**40
BLOCK_ROWS = 2048
#: Rows of one block matrix; its row numbers are 32 bits wide inside Spark.
SLAB = 1 << 30
#: Eigenvalues below this share of the largest are rounding, not spread.
FLAT = 1e-12


def _numbered(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Rows with numbers 0..n-1 in ``_i``, from one written copy and its parts' sizes."""
    placed = written(df.withColumn("_at", F.monotonically_increasing_id()), name)
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()
    bases, total = [], 0
    for r in sizes:
        bases.append((r["_part"], total))
        total += r["n"]
    table = df.sparkSession.createDataFrame(bases, "_part long, _base long")
    numbered = placed.withColumn("_part", part).join(F.broadcast(table), "_part")
    return numbered.select(*df.columns, (F.col("_base") + place).alias("_i")), total


def _width(rows: DataFrame) -> int:
    """The length that most vectors have, the larger one of a tie."""
    best = rows.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return best["d"] if best else 0


def _blocks(rows: DataFrame, width: int) -> BlockMatrix:
    """Rows (index, array) as a block matrix; indices start at 0 and have no gaps."""
    vectors = rows.select("index", array_to_vector("values").alias("vector"))
    vectors = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    return IndexedRowMatrix(vectors, 0, width).toBlockMatrix(BLOCK_ROWS, width)


def _product(a: BlockMatrix, b: BlockMatrix, parts: int) -> BlockMatrix:
    """a * b, the inner dimension dealt to ``parts`` tasks and added up after."""
    made = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, parts)
    return BlockMatrix(made, a.rowsPerBlock, b.colsPerBlock)


def _scatter(block: BlockMatrix) -> np.ndarray:
    """The sum of the outer products of the rows: transpose times matrix."""
    parts = -(-block.numRows() // BLOCK_ROWS)
    return _product(block.transpose(), block, parts).toLocalMatrix().toArray()


def _rows(block: BlockMatrix) -> DataFrame:
    """index, values of a block matrix."""
    rows = callMLlibFunc("getIndexedRows", block.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("values"))


def _clean(vector: Column) -> Column:
    fit = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)
    return F.forall(vector.cast("array<double>"), fit)


def whitened(vectors: DataFrame, vector: str = "embedding", components: int = 8) -> DataFrame:
    """row (all columns as a struct), n, deviation, whitened (array), explained (array) and
    identity_error, for every row whose vector is whole.

    Rows whose vector is null, or holds null, NaN, infinite or 2^40 and larger entries,
    take no part; nor do vectors of another length than most of the table's, or of length
    0. Rows with equal vectors or ids all count. A component without spread (all vectors
    on one plane, one row) has ``whitened`` null. ``deviation`` is exact as a decimal and
    null beyond 38 digits. Extra columns may have any name. An empty table gives an empty
    one.

    Centred rows are indexed into blocks; the transposed block matrix times itself is the
    scatter; a local eigenvalue decomposition gives the whitening matrix, and a last block
    product projects the rows.
    """
    x = F.transform(F.col(f"`{vector}`"), lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    rows = vectors.where(_clean(F.col(f"`{vector}`"))).select(F.struct("*").alias("row"), x.alias("_x"))
    width = _width(rows.where(F.size("_x") > 0))
    kept, n = _numbered(rows.where(F.size("_x") == width).where(F.lit(width > 0)), "vectors")
    by_place = kept.select(F.posexplode("_x").alias("j", "v")).groupBy("j")
    sums = by_place.agg(F.sum(F.col("v").cast("decimal(18,0)")).alias("s")).orderBy("j").collect()
    sums = [int(r["s"]) for r in sums]
    s = F.array(*[F.lit(str(v)).cast("decimal(38,0)") for v in sums])
    mean = F.array(*[F.lit(v / n) for v in sums])
    centred = F.zip_with("_x", mean, lambda v, m: v.cast("double") - m)
    slabs = range(0, n, SLAB)
    blocks = [
        _blocks(
            kept.where((F.col("_i") >= lo) & (F.col("_i") < lo + SLAB)).select(
                (F.col("_i") - lo).alias("index"), centred.alias("values")
            ),
            width,
        )
        for lo in slabs
    ]
    variance = sum((_scatter(b) for b in blocks), np.zeros((width, width))) / max(n, 1)
    values, axes = np.linalg.eigh((variance + variance.T) / 2)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    total = float(np.trace(variance))
    spread = values > FLAT * max(values.max(initial=0), 0)
    scale = np.where(spread, 1 / np.sqrt(np.where(spread, values, 1)), 0)
    spark = vectors.sparkSession
    made, error = None, 0.0
    second = np.zeros((len(values), len(values)))
    for lo, block in zip(slabs, blocks):
        matrix = spark.createDataFrame(
            [(i, r) for i, r in enumerate((axes * scale).tolist())], "index long, values array<double>"
        )
        weights = IndexedRowMatrix(
            MLUtils.convertVectorColumnsFromML(
                matrix.select("index", array_to_vector("values").alias("vector")), "vector"
            ),
            width,
            len(values),
        ).toBlockMatrix(width, len(values))
        projected = written(_rows(_product(block, weights, 1)), "projected")
        second += _scatter(_blocks(projected, len(values)))
        projected = projected.select((F.col("index") + lo).alias("_i"), F.col("values").alias("_w"))
        made = projected if made is None else made.union(projected)
    if made is not None:
        held = np.flatnonzero(spread)
        error = float(np.abs(second[np.ix_(held, held)] / n - np.eye(len(held))).max(initial=0.0))
    else:
        made = spark.createDataFrame([], "_i long, _w array<double>")
    known = F.array(*[F.lit(bool(v)) for v in spread]) if len(spread) else F.lit(None).cast("array<boolean>")
    shares = F.array(*[F.lit(float(v) / total if total > 0 else 0.0) for v in values]).cast("array<double>")
    wide = "decimal(38,0)"
    apart = F.zip_with("_x", s, lambda v, t: F.try_subtract(F.lit(n).cast("decimal(20,0)") * v.cast("decimal(18,0)"), t))
    square = F.transform(apart, lambda d: F.try_multiply(d.cast(wide), d.cast(wide)).cast(wide))
    deviation = F.aggregate(square, F.lit(0).cast(wide), lambda a, b: F.try_add(a, b).cast(wide))
    return kept.select("_i", "row", deviation.alias("deviation")).join(made, "_i").select(
        "row",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.zip_with("_w", known, lambda w, k: F.when(k, w)).alias("whitened"),
        shares.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
