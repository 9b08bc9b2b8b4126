"""Whitening of embeddings by a two-pass covariance.

Vectors become integers floor(256 c); each different one counts once for the fit. The first pass sums
them exactly, the second sums outer products of centred rows by GEMM, one matrix a task, which
``treeAggregate`` merges. The driver holds one such matrix (dimensions squared), takes its symmetric
eigenvectors and broadcasts the projection.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE = 256
COMPONENTS = 4
_SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _scaled(rows: DataFrame, vector_col: str) -> DataFrame:
    """``rows`` of usable vectors with ``x``: floor(256 c) of each entry, all as long as the longest."""
    c = F.col(vector_col).cast("array<double>")
    odd = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fine = rows.where(F.col(vector_col).isNotNull() & ~odd)
    dims = fine.agg(F.max(F.size(vector_col))).first()[0]
    whole = F.transform(c, lambda v: F.floor(v * float(SCALE)))
    return fine.withColumn("x", F.concat(whole, F.array_repeat(F.lit(0).cast("long"), F.lit(dims or 0) - F.size(c)))), dims or 0


def _matrix(column, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _centred(x: np.ndarray, model: dict) -> np.ndarray:
    """x - S / n: the mean's whole part goes off as an integer, so no digit is lost to it."""
    most = 2**61
    if -most < min(x.min(initial=0), model["floor"].min()) and max(x.max(initial=0), model["floor"].max()) < most:
        return (x - model["floor"]) - model["rest"]
    return x.astype(np.float64) - model["floor"] - model["rest"]


def _sums(dims: int):
    """(dim, high, low): sums of the upper and lower 32 bits, so none can overflow; dim -1 counts rows."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros((2, dims), dtype=np.int64)
        n = 0
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            total += np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
            n += len(x)
        at = np.arange(-1, dims, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([0, *total[0]]), pa.array([n, *total[1]])], names=["dim", "high", "low"])

    return run


def _products(shared, dims: int):
    """One row a task: its sum of outer products of centred rows, as bytes."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros((dims, dims))
        for batch in batches:
            c = _centred(_matrix(batch.column(0), dims), shared.value)
            total += c.T @ c
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["products"])

    return run


def _merged(table: DataFrame, work, dims: int) -> np.ndarray:
    """The sum of every task's dims x dims matrix."""
    parts = table.mapInArrow(work, "products binary").rdd.map(lambda r: np.frombuffer(r[0]).reshape(dims, dims))
    add = lambda a, b: a + b
    return parts.treeAggregate(np.zeros((dims, dims)), add, add)


def _whitened_products(shared, dims: int, k: int):
    def run(batches):
        import pyarrow as pa

        total = np.zeros((k, k))
        for batch in batches:
            w = _centred(_matrix(batch.column(0), dims), shared.value) @ shared.value["axes"]
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["products"])

    return run


def _deviations(x: np.ndarray, model: dict) -> list:
    """Exact sums of (n x - S)^2; None where such a sum is no 64-bit integer."""
    n, sums = model["n"], model["sums"]
    most = n * max(-int(x.min(initial=0)), int(x.max(initial=0))) + max(map(abs, sums), default=0)
    if most * most * max(len(sums), 1) < 2**63:
        return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    found = (sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
    return [v if v < 2**63 else None for v in found]


def _projected(shared, dims: int, k: int):
    def run(batches):
        import pyarrow as pa

        model = shared.value
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            white = _centred(x, model) @ model["axes"]
            size = len(x) * k
            each = np.repeat(np.arange(len(x)), k)
            held = np.tile(model["held"], len(x))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, model["n"], dtype=np.int64)),
                    pa.array(_deviations(x, model), pa.int64()).take(pa.array(each)),
                    pa.array(white.reshape(-1), mask=~held),
                    pa.array(np.tile(model["explained"], len(x)), mask=np.full(size, not model["varies"])),
                    pa.array(np.full(size, model["error"]), mask=np.full(size, not model["varies"])),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whitened(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable row and component: id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds a null or non-finite entry are left out. Entries become
    floor(256 c), at the limit of 64 bits where that is beyond it; shorter vectors are filled up
    with zeros. The fit takes each different vector once; every row is projected, rows without id
    and repeated ones too. Components are the first ``components``, fewer if vectors are shorter.
    A component without variance (to double precision) has no whitened value and does not enter
    identity_error; where nothing varies, explained and identity_error are null. deviation is null
    where it is no 64-bit integer. Equal eigenvalues share a space, any axes of which may come out.
    Other columns are not read; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    usable, dims = _scaled(rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")), "vector")
    kind = f"id {usable.schema['id'].dataType.simpleString()}, {_SCHEMA}"
    k = min(components, dims)
    if not k:
        return spark.createDataFrame([], kind).withColumnRenamed("id", id_col)
    fit = written(usable.select("x").distinct(), "fit")
    parts = fit.mapInArrow(_sums(dims), "dim int, high long, low long").groupBy("dim")
    sums = {r["dim"]: (int(r["high"]) << 32) + int(r["low"]) for r in parts.agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    n = sums.pop(-1)
    sums = [sums[d] for d in range(dims)]
    model = {"n": n, "sums": sums, "floor": np.array([s // n for s in sums], dtype=np.int64), "rest": np.array([(s % n) / n for s in sums])}
    shared = spark.sparkContext.broadcast(model)
    covariance = _merged(fit, _products(shared, dims), dims) / n
    shared.unpersist()
    values, axes = np.linalg.eigh(covariance)
    values, axes = np.maximum(values[::-1][:k], 0.0), axes[:, ::-1][:, :k]
    # the largest entry of an axis is positive
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(k)])
    trace = float(np.trace(covariance))
    held = values > values[0] * dims * np.finfo(float).eps
    model |= {"held": held, "varies": trace > 0, "explained": values / trace if trace > 0 else np.zeros(k)}
    model["axes"] = np.where(held, axes / np.sqrt(np.where(held, values, 1.0)), 0.0)
    shared = spark.sparkContext.broadcast(model)
    whole = _merged(fit, _whitened_products(shared, dims, k), k) / n
    shared.unpersist()
    model["error"] = float(np.abs(whole - np.eye(k))[np.ix_(held, held)].max(initial=0.0))
    shared = spark.sparkContext.broadcast(model)
    return usable.select("id", "x").mapInArrow(_projected(shared, dims, k), kind).withColumnRenamed("id", id_col)
