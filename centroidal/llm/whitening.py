"""Whitening of embeddings by Spark's distributed block matrices.

Entries become integers of 1/``scale``; the fit list is each distinct integer vector once. Rows are packed as they are read
into blocks of up to ``BLOCK_ROWS`` vectors and written, one row a block, so rows keep their place and need no
shuffle to become matrix blocks. Centred blocks form a ``BlockMatrix`` B (rows outside the fit list are zero there and
add nothing); B transposed times B is the scatter matrix, as large as the dimension allows; its eigenvectors come from a
local ``eigh``. A second ``BlockMatrix`` of all centred rows times the whitening matrix projects every row. Row blocks are
the middle dimension of the first product and are dealt to as many partial products as needed. The second product has
blocks of columns too, because Spark deals a tall product to about the square root of its input partitions, times the
number of middle blocks.

Counts and sums of the fit list and deviations are exact integers. The driver holds one number a task of the first pass,
the indices of blocks (Spark's product collects these), and matrices of the dimension's size.

Rows go if their vector is null, empty, holds a null or non-finite entry or one beyond 2^60 steps, or has another length
than most vectors (the longest of equally frequent lengths counts). Ids may be null or repeat. A direction without
variance has no component value: ``whitened`` is null there, and ``explained`` too if no direction has any. An empty table
gives no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from centroidal.llm.frames import dropped, pieces, written

COMPONENTS, SCALE = 4, 256
BLOCK_ROWS, BLOCK_BYTES = 1024, 2 << 20
#: Blocks of columns of the projected matrix; row blocks in a partial product of the scatter matrix.
COLUMN_BLOCKS, SPLIT_BLOCKS = 8, 64
#: Variance, as a share of the whole, below which a direction counts as flat.
FLAT = 1e-12
LIMIT = float(1 << 60)


def steps(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, x``: the rows that remain, as integers."""
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].cast("array<double>").alias("v"))
    # comparisons with null or NaN: NaN is greater than any number in Spark, null makes the entry not valid
    fits = F.forall("v", lambda c: F.coalesce(F.abs(c * scale) < LIMIT, F.lit(False)))
    return rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & fits) \
        .select("id", F.transform("v", lambda c: F.floor(c * scale).cast("long")).alias("x"))


def _packer(dim: int, rows: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values, held = [], [], 0

        def block() -> pa.RecordBatch:
            names, x = pa.concat_arrays(ids), np.concatenate(values)
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), pa.array([x.tobytes()], pa.binary())], names=["ids", "x"])

        for batch in pieces(batches):
            for start in range(0, batch.num_rows, rows):
                cut = batch.slice(start, rows)
                while cut.num_rows:
                    part = cut.slice(0, rows - held)
                    ids.append(part.column("id"))
                    values.append(part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype("<i8"))
                    held, cut = held + part.num_rows, cut.slice(part.num_rows)
                    if held == rows:
                        yield block()
                        ids, values, held = [], [], 0
        if held:
            yield block()
    return run


def _keys(dim: int, rows: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every vector as bytes (two bytes an entry where all fit) with the place of its row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("x")):
                x = np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, dim)
                small = (np.abs(x) < 1 << 15).all(axis=1)
                keys = [(b"s" + v.astype("<i2").tobytes()) if s else b"l" + v.tobytes() for v, s in zip(x, small)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(block * rows + np.arange(len(x)))], names=["key", "at"])
    return run


def _exact_sums(dim: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows and exact sums of each dimension over the fit list of a partition."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            for raw, rows in zip(batch.column("x"), batch.column("fit")):
                x = np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, dim)[rows.values.to_numpy()]
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)  # no int64 overflow within a block
                n += len(x)
                total = [t + (int(h) << 32) + int(s) for t, h, s in zip(total, high, low)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()), pa.array(map(Decimal, [n, *total]), pa.decimal128(38, 0))],
                                             names=["dim", "total"])
    return run


def _matrix(blocks: DataFrame, count: int, dim: int, rows: int, mean: np.ndarray, column_blocks: int) -> BlockMatrix:
    """The centred rows (those of the fit list where ``blocks`` has one) as a block matrix; absent rows are zero."""
    width = -(-dim // column_blocks)

    def split(row) -> Iterator[tuple[tuple[int, int], DenseMatrix]]:
        x = np.frombuffer(row["x"], "<i8").reshape(-1, dim)
        centred = np.zeros((rows, dim))
        at = np.arange(len(x)) if "fit" not in row.__fields__ else np.array(row["fit"], int)
        centred[at] = x[at] - mean
        for j in range(0, dim, width):
            part = centred[:, j:j + width]
            yield (int(row["block"]), j // width), DenseMatrix(rows, part.shape[1], part.ravel(), isTransposed=True)

    return BlockMatrix(blocks.rdd.flatMap(split), rows, width, count * rows, dim)


def _product(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """``a`` times ``b`` with the middle dimension dealt to ``splits`` partial products (the Python method lacks the
    argument of the Scala one)."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def _moments(k: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums and products of the projected rows of the fit list."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for raw, rows in zip(batch.column("w"), batch.column("fit")):
                w = np.frombuffer(raw.as_buffer(), "<f8").reshape(-1, k)[rows.values.to_numpy()]
                total += np.vstack([w.sum(axis=0), w.T @ w])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["cell", "total"])
    return run


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """The squared distances of n times each row from the sums, exactly."""
    bound = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if bound * bound * x.shape[1] < 1 << 62:
        d = n * x - np.array(sums, np.int64)
        return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
    d = n * x.astype(object) - np.array(sums, object)
    return pa.array([Decimal(int(v)) if v < 10 ** 38 else None for v in (d * d).sum(axis=1)], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: a row for each remaining vector and component.

    With the fit list's n vectors x, sums S and covariance V (divisor n): ``deviation`` is the sum over dimensions of
    (n x - S)^2, exactly (null from 10^38); ``whitened`` is (x - S/n) projected on a unit eigenvector of V over the root of
    its eigenvalue, numbered from 1 by falling eigenvalue; ``explained`` is the eigenvalue over the trace;
    ``identity_error`` is the largest absolute entry of the fit list's whitened covariance minus the identity.
    """
    spark = vectors.sparkSession
    rows = steps(vectors, id_col, vector_col, scale)
    kind = rows.schema["id"].dataType
    out_schema = T.StructType([T.StructField("id", kind)] + [T.StructField(n, t) for n, t in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.DecimalType(38, 0)), ("whitened", T.DoubleType()),
        ("explained", T.DoubleType()), ("identity_error", T.DoubleType()))])
    common = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return spark.createDataFrame([], out_schema)
    dim = int(common["dim"])
    per_block = int(max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dim))))

    # blocks of rows, numbered without gaps
    packed = rows.filter(F.size("x") == dim).mapInArrow(
        _packer(dim, per_block), T.StructType([T.StructField("ids", T.ArrayType(kind)), T.StructField("x", T.BinaryType())]))
    packed = written(spark, packed.withColumn("place", F.monotonically_increasing_id()), "whiten-rows")
    part = F.shiftright("place", 33)  # the task that wrote the block
    counts = packed.groupBy(part.alias("part")).count().orderBy("part").collect()
    firsts, blocks = [], 0
    for r in counts:
        firsts.append((r["part"], blocks))
        blocks += r["count"]
    offsets = spark.createDataFrame(firsts, "part long, first long")
    packed = packed.withColumn("part", part).join(offsets, "part") \
        .select((F.col("first") + (F.col("place").bitwiseAND((1 << 33) - 1))).alias("block"), "ids", "x")

    # the fit list: of equal vectors the first row, as places in the blocks
    first = packed.select("block", "x").mapInArrow(_keys(dim, per_block), "key binary, at long").groupBy("key").agg(F.min("at").alias("at"))
    fit = written(spark, first.groupBy(F.floor(F.col("at") / per_block).alias("block")).agg(
        F.collect_list((F.col("at") % per_block).cast("int")).alias("fit")), "whiten-fit")
    fitted = packed.select("block", "x").join(fit, "block")
    sums = fitted.select("x", "fit").mapInArrow(_exact_sums(dim), "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total"))
    n, *totals = (int(r["total"]) for r in sums.orderBy("dim").collect())
    mean = np.array([t / n for t in totals])

    # scatter of the fit list, its eigenvectors, and the matrix that whitens
    b = _matrix(fitted, blocks, dim, per_block, mean, 1).persist(StorageLevel.MEMORY_AND_DISK)
    splits = max(-(-blocks // SPLIT_BLOCKS), min(blocks, spark.sparkContext.defaultParallelism))
    covariance = _product(b.transpose(), b, splits).toLocalMatrix().toArray() / n
    b._java_matrix_wrapper._java_model.blocks().unpersist(False)
    values, vectors_ = np.linalg.eigh((covariance + covariance.T) / 2)
    k = min(components, dim)
    values, basis, trace = values[::-1][:k], vectors_[:, ::-1][:, :k], float(np.trace(covariance))
    live = (values > FLAT * trace) & (trace > 0)
    whitening = np.where(live, basis / np.sqrt(np.where(live, values, 1.0)), 0.0)

    # every row times that matrix
    every = _matrix(packed.select("block", "x"), blocks, dim, per_block, mean, COLUMN_BLOCKS).persist(StorageLevel.MEMORY_AND_DISK)
    width = every.colsPerBlock
    small = [((j // width, 0), DenseMatrix(len(whitening[j:j + width]), k, whitening[j:j + width].ravel(), isTransposed=True))
             for j in range(0, dim, width)]
    product = _product(every, BlockMatrix(spark.sparkContext.parallelize(small, 1), width, k, dim, k), len(small))
    projected = written(spark, spark.createDataFrame(
        product.blocks.map(lambda block: (block[0][0], bytearray(block[1].toArray().astype("<f8").tobytes()))), "block long, w binary"), "whiten-projected")
    every._java_matrix_wrapper._java_model.blocks().unpersist(False)

    cells = projected.join(fit, "block").select("w", "fit").mapInArrow(_moments(k), "cell int, total double") \
        .groupBy("cell").agg(F.sum("total").alias("total")).orderBy("cell").collect()
    dropped(fit)
    moments = np.array([r["total"] for r in cells]).reshape(k + 1, k) / n
    off = np.abs(moments[1:] - np.outer(moments[0], moments[0]) - np.eye(k))[np.ix_(live, live)]
    error = float(off.max()) if off.size else None
    explained = [float(v) / trace if trace > 0 else None for v in values]

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw, projection in zip(batch.column("ids"), batch.column("x"), batch.column("w")):
                x = np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, dim)
                w = np.frombuffer(projection.as_buffer(), "<f8").reshape(-1, k)[:len(x)]
                deviation = _deviations(x, n, totals)
                for c in range(k):
                    columns = [ids.values, np.full(len(x), c + 1, np.int32), np.full(len(x), n), deviation,
                               w[:, c].copy() if live[c] else pa.nulls(len(x), pa.float64()),
                               pa.array([explained[c]] * len(x), pa.float64()), pa.array([error] * len(x), pa.float64())]
                    yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns], names=out_schema.names)

    return packed.join(projected, "block").select("ids", "x", "w").mapInArrow(spread, out_schema)
