"""Whitening of embeddings onto their leading principal components.

Components are integers (``floor(256 * c)``). The fit counts each distinct vector once: exact sums give
its centre, centred blocks add up its covariance, and the driver, which sees that one matrix
only, takes the leading eigenpairs of it (:mod:`nestweave.llm.eigen`). Rows are projected where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestweave.llm.eigen import leading
from nestweave.llm.storage import stage
from nestweave.llm.vectors import as_integers, common_length, is_whole, matrix

COMPONENTS = 4
#: Eigenvalues below this share of their sum are rounding: no direction to whiten.
LEAST_SHARE = 1e-13
#: Numbers of a block that is worked on at a time.
BLOCK = 1 << 19
_LOW = (1 << 32) - 1


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, BLOCK // max(dims, 1))
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def exact_sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in _blocks(batches, dims):
            x = matrix(batch.column("x"), dims)
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & _LOW).sum(axis=0)
        at = np.arange(-1, dims)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(np.append(0, high)), pa.array(np.append(n, low))], ["at", "high", "low"]
        )

    parts = fit.mapInArrow(run, "at long, high long, low long").groupBy("at")
    total = {r["at"]: (int(r["high"]) << 32) + int(r["low"]) for r in parts.agg(
        F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")
    ).collect()}
    return total.get(-1, 0), [total.get(k, 0) for k in range(dims)]


def covariance(fit: DataFrame, centre: np.ndarray, n: int) -> np.ndarray:
    """Covariance about the centre, divisor ``n``: blocks are centred, then multiplied, then added."""
    dims = len(centre)
    row, column = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in _blocks(batches, dims):
            centred = matrix(batch.column("x"), dims) - centre
            total += centred.T @ centred
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(column), pa.array(total[row, column])], ["i", "j", "sum"])

    parts = fit.mapInArrow(run, "i long, j long, sum double").groupBy("i", "j").agg(F.sum("sum").alias("sum"))
    table = parts.toArrow()
    out = np.zeros((dims, dims))
    i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
    out[i, j] = out[j, i] = table.column("sum").to_numpy()
    return out / n


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """``sum((n * x - S) ** 2)`` of each row, exact; null beyond 64 bits."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most**2 * x.shape[1] < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    found = ((x.astype(object) * n - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in found]


def whiten(df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each row and leading component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries are left out. ``n`` is the number
    of distinct integer vectors, ``deviation`` the row's ``sum((n * x - S) ** 2)`` (null where 64 bits do not
    hold it), ``whitened`` its centred vector along the component over the root of the eigenvalue,
    ``explained`` the component's share of all variance, ``identity_error`` the largest entry of the
    whitened vectors' covariance less the identity.

    Null ids stay null, repeated rows get repeated rows, other columns are ignored. A component without
    variance (all vectors equal, fewer vectors than components) gives no rows, and so do empty tables and
    vectors of no entries. Vectors of different lengths are an error. The driver holds a
    matrix of dimension squared.
    """
    spark = df.sparkSession
    kind = df.schema[id].dataType
    schema = T.StructType(
        [T.StructField("vec_id", kind), *T.StructType.fromDDL(
            "component int, n long, deviation long, whitened double, explained double, identity_error double")]
    )
    rows = stage(df.where(is_whole(vector)).select(F.col(id).alias("vec_id"), as_integers(vector).alias("x")), "integers")
    dims = common_length(rows, "x")
    if not dims:
        return spark.createDataFrame([], schema)
    # equal vectors meet in their task before the shuffle
    fit = stage(rows.select("x").distinct(), "distinct")
    n, sums = exact_sums(fit, dims)
    centre = np.array([float(Fraction(s, n)) for s in sums])
    spread = covariance(fit, centre, n)
    values, axes = leading(spread, components)
    trace = float(np.trace(spread))
    values = values[values > LEAST_SHARE * trace] if trace > 0 else values[:0]
    if not len(values):
        return spark.createDataFrame([], schema)
    k = len(values)
    projection = (axes[:k] / np.sqrt(values)[:, None]).T
    shares = values / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, dims):
            x = (matrix(batch.column("x"), dims) - centre) @ projection
            yield pa.RecordBatch.from_arrays([pa.array(x[:, j]) for j in range(k)], [f"w{j}" for j in range(k)])

    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    projected = fit.mapInArrow(project, ", ".join(f"w{j} double" for j in range(k)))
    found = projected.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
    error = max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, dims):
            x = matrix(batch.column("x"), dims)
            which = np.repeat(np.arange(len(x)), k)
            made = [
                batch.column("vec_id").take(pa.array(which)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(which), n)),
                pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(which)),
                pa.array(((x - centre) @ projection).reshape(-1)),
                pa.array(np.tile(shares, len(x))),
                pa.array(np.full(len(which), error)),
            ]
            yield pa.RecordBatch.from_arrays(made, schema.names)

    return rows.mapInArrow(run, schema)
