"""Whitening of embeddings with distributed block matrices.

Every entry c becomes the whole number x = floor(64 * c) + 1000000. Rows, centred on the
exact mean, are indexed and dealt into blocks of a BlockMatrix; the transposed matrix times
itself gives the scatter, whose sums Spark adds up over slices of the rows. A local `eigh` of the
small covariance gives the components, and the blocks times the whitening matrix are the
whitened rows. The driver holds the sums and the covariance of one dimension, d and d x d
numbers, and the coordinates of the blocks (a block has `BLOCK` entries).

Left out: rows whose vector is null, or holds null or non-finite entries, or an entry whose x is
no long. Empty vectors have no components and so no rows. Vectors of different length are lists of
their own, each with its own fit. A repeated row or id is a row like any other, and a null id
stays null. A component without variance (as in a list of one vector) has a null `whitened` and is
not in `identity_error`; `explained` is null if there is no variance at all. `deviation` is
null where a long can't hold it. Further columns are left alone; no rows give no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotewise.session import keep

COMPONENTS = 32
#: Entries of a block: 8 MB of doubles.
BLOCK = 1 << 20
#: Row blocks that one task of the scatter multiplies and adds up.
TOGETHER = 8
#: A share of the trace at or below which a component counts as without variance.
NOTHING = 1e-13
SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whole(entry: Column) -> Column:
    return F.floor(entry.cast("double") * 64) + 1000000


def indexed(vectors: DataFrame) -> DataFrame:
    """(vec_id, x, dim, index): the rows that remain, numbered from 0 within each dimension."""
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * 64) < float(1 << 62)))
    rows = keep(
        vectors.filter(F.coalesce(sound, F.lit(False)) & (F.size("embedding") > 0)).select(
            "vec_id",
            F.transform("embedding", _whole).alias("x"),
            F.size("embedding").alias("dim"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "whole",
    )
    part = F.shiftright("place", 33)
    dims = [r[0] for r in rows.select("dim").distinct().orderBy("dim").collect()]
    if len(dims) < 2:  # places within a partition are gapless already
        within = rows.withColumns({"part": part, "at": F.col("place").bitwiseAND((1 << 33) - 1)})
    else:
        order = W.partitionBy("dim", "part").orderBy("place")
        within = rows.withColumn("part", part).withColumn("at", F.row_number().over(order) - 1)
    before = W.partitionBy("dim").orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row for each partition
    starts = within.groupBy("dim", "part").agg(F.count(F.lit(1)).alias("rows")).select(
        "dim", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    numbered = within.join(starts, ["dim", "part"])
    return keep(numbered.select("vec_id", "x", "dim", (F.col("start") + F.col("at")).alias("index")), "indexed")


def sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each dimension the number of rows and the exact sum of each place."""
    added = (
        rows.select("dim", F.posexplode("x").alias("at", "x"))
        .groupBy("dim", "at")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("s"))
        .orderBy("dim", "at")
    )
    out: dict[int, tuple[int, list[int]]] = {}
    for dim, _, n, s in added.collect():
        out.setdefault(dim, (n, []))[1].append(int(s))
    return out


def _blocks(rows: DataFrame, values: Column, n: int, width: int) -> BlockMatrix:
    """`values`, arrays of `width` doubles, as blocks; rows are placed by `index`."""
    vectors = rows.select("index", array_to_vector(values).alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, width)
    return matrix.toBlockMatrix(max(1, BLOCK // width), width)


def _scatter(blocks: BlockMatrix, n: int) -> np.ndarray:
    """The transposed matrix times itself, added up in slices of the rows."""
    slices = -(-n // (blocks.rowsPerBlock * TOGETHER))
    turned = blocks.transpose()
    # the public multiply() has no argument for slices of the middle dimension; the JVM's has
    product = turned._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, slices)
    return BlockMatrix(product, turned.rowsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def _array_of(values: list, kind: str) -> Column:
    return F.from_json(F.lit("[" + ",".join(map(str, values)) + "]"), f"array<{kind}>")


def _whitened(rows: DataFrame, dim: int, n: int, total: list[int], components: int) -> DataFrame:
    """The result for the rows of one dimension."""
    spark = rows.sparkSession
    offset = F.zip_with(
        "x", _array_of(total, "decimal(38,0)"), lambda x, s: F.try_subtract(x.cast("decimal(38,0)") * F.lit(n), s)
    )
    centred = F.transform(offset, lambda v: v.cast("double") / n)
    blocks = _blocks(rows, centred, n, dim)
    covariance = _scatter(blocks, n) / n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    trace, last = float(np.trace(covariance)), min(components, dim)
    values, axes = values[::-1][:last], axes[:, ::-1][:, :last]
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(last)])
    live = values > NOTHING * trace
    explained = [float(v) / trace if trace > 0 else None for v in values]

    scale = np.where(live, 1 / np.sqrt(np.where(live, values, 1)), 0)
    whitening = Matrices.dense(dim, last, (axes * scale).ravel(order="F").tolist())
    by = BlockMatrix(spark.sparkContext.parallelize([((0, 0), whitening)], 1), dim, last, dim, last)
    projected = callMLlibFunc("getIndexedRows", blocks.multiply(by).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    square = F.aggregate(
        "offset",
        F.lit(0).cast("long"),
        lambda a, v: F.try_add(a, F.try_multiply(v.try_cast("long"), v.try_cast("long"))),
    )
    placed = rows.select("index", "vec_id", offset.alias("offset")).select("index", "vec_id", square.alias("deviation"))
    # rows that are all zero may have no block row
    white = placed.join(projected.select("index", vector_to_array("vector").alias("z")), "index", "left")
    white = keep(white.withColumn("z", F.coalesce("z", _array_of([0.0] * last, "double"))), "whitened")

    means = white.select(F.posexplode("z").alias("at", "z")).groupBy("at").agg(F.avg("z").alias("m")).orderBy("at")
    mean = [r["m"] for r in means.collect()]
    again = _blocks(white, F.zip_with("z", _array_of(mean, "double"), lambda z, m: z - m), n, last)
    excess = np.abs(_scatter(again, n) / n - np.eye(last))[np.ix_(live, live)]
    error = float(excess.max()) if excess.size else None

    one = white.select("vec_id", "deviation", F.posexplode("z").alias("at", "z"))
    return one.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.when(F.get(F.lit([bool(x) for x in live]), F.col("at")), F.col("z")).alias("whitened"),
        F.get(_array_of(["null" if x is None else x for x in explained], "double"), F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each remaining vector (vec_id, embedding) and component."""
    rows = indexed(vectors.select("vec_id", "embedding"))
    parts = [
        _whitened(rows.filter(F.col("dim") == dim), dim, n, total, components) for dim, (n, total) in sums(rows).items()
    ]
    if not parts:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, {SCHEMA}")
    return reduce(DataFrame.unionByName, parts)
