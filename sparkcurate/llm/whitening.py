"""Whitening of embeddings: leading eigenvectors of their covariance by LOBPCG over distributed block products.

The driver holds a few blocks of (dimensions x block) numbers; rows stay where they are. Each step asks the
executors for the covariance's product with one block, made from centred rows, and projects the
covariance onto the span of three blocks: the iterate, its residual, and the direction of the last step.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import bounded_batches, forget, load, written

#: Components that are returned.
COMPONENTS = 16
#: Vectors that iterate beside them, so that the last component has a gap to what isn't iterated.
GUARDS = 8
#: Residuals of components that were certified are at most so much of the largest eigenvalue.
CERTIFIED = 1e-12
#: Eigenvalues below this part of the largest are rounding, not directions.
RANK = 1e-12
#: Steps, after which what isn't certified is an error.
STEPS = 500
SCALE, SHIFT = 64, 1_000_000


@dataclass(frozen=True)
class Fit:
    """Eigenvalues e, unit vectors (dimensions x components), and what they were fitted on: n vectors, their sums, their covariance's trace."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    steps: int


def whole(vector: Column) -> Column:
    """floor(64 c) + 1000000 of each entry, in double precision."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)


def usable(vector: Column) -> Column:
    """Whether a vector isn't null or empty and has no null or non-finite entries."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, from n x - sums in whole numbers where those fit."""
    low, rest = np.divmod(sums, n)  # sums / n = low + rest / n
    return (x - low) - rest / n


def count_and_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors of d entries, and each entry's sum."""

    def run(batches):
        n, total = 0, np.zeros(d, np.int64)
        for batch in batches:
            n += batch.num_rows
            if batch.num_rows:
                total += _matrix(batch.column("x"), d).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array(np.append(total, n))], ["row", "s"])

    parts = rows.select("x").mapInArrow(run, "row long, s long").groupBy("row").agg(F.sum("s").alias("s")).orderBy("row")
    found = [r["s"] for r in parts.collect()]
    return found[d], found[:d]


def block_product(rows: DataFrame, n: int, sums: list[int], block: np.ndarray) -> tuple[np.ndarray, float]:
    """The covariance's product with block, and its trace; each task gives its sum, and sums are added by rows of the block."""
    d, m = block.shape
    total = np.array(sums, np.int64)

    def run(batches):
        out, square = np.zeros((d, m)), 0.0
        for batch in batches:
            if batch.num_rows:
                centred = _centred(_matrix(batch.column("x"), d), n, total)
                out += centred.T @ (centred @ block)
                square += float(np.einsum("ij,ij->", centred, centred))
        table = np.concatenate([out, np.full((1, m), square)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), *(pa.array(np.ascontiguousarray(c)) for c in table.T)], ["row", *(f"c{k}" for k in range(m))])

    names = [f"c{k}" for k in range(m)]
    parts = rows.select("x").mapInArrow(run, ", ".join(["row long", *(f"{c} double" for c in names)]))
    found = parts.groupBy("row").agg(*(F.sum(c).alias(c) for c in names)).orderBy("row").collect()
    table = np.array([[r[c] for c in names] for r in found]) / n
    return table[:d], float(table[d, 0])


def orthonormal(block: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """An orthonormal basis of what block adds to the orthonormal blocks in against; directions that add next to nothing go."""
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 0] / size[size > 0]
    for _ in range(2):
        for other in against:
            block = block - other @ (other.T @ block)
        left, s, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, s > 1e-10 * max(1.0, s[0] if len(s) else 0)] if len(s) else left[:, :0]
    return block


def lobpcg(product: Callable[[np.ndarray], np.ndarray], d: int, components: int = COMPONENTS, guards: int = GUARDS, seed: int = 5, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, int]:
    """(eigenvalues, unit vectors, steps) of the largest components eigenvalues of a symmetric operator, falling.

    Rayleigh-Ritz in the span of iterate X, residuals W and direction P. Products with X and P follow from
    those with W; what they have lost by rounding shows in the certificate: before it ends, the
    iterate's product is made anew, and residuals |AX - X e| must be CERTIFIED of the largest
    eigenvalue. Where not, it goes on from there without a direction. Raises where steps don't do.
    """
    m = min(d, components + guards)
    want = min(d, components)
    x = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, m)))[0]
    ax = product(x)
    p, ap = np.zeros((d, 0)), np.zeros((d, 0))
    fresh = True
    for step in range(1, steps + 1):
        e, turn = np.linalg.eigh((x.T @ ax + ax.T @ x) / 2)
        e, turn = e[::-1], turn[:, ::-1]
        x, ax = x @ turn, ax @ turn
        residual = ax - x * e
        size = np.linalg.norm(residual, axis=0)
        bound = CERTIFIED * max(abs(e[0]), np.finfo(float).tiny)
        if (size[:want] <= bound).all():
            if fresh:
                return e[:want], x[:, :want], step
            x = np.linalg.qr(x)[0]
            ax, fresh = product(x), True
            p, ap = p[:, :0], ap[:, :0]
            continue
        w = orthonormal(residual[:, size > bound / 10], [x, p])
        if not w.shape[1]:
            if fresh and not p.shape[1]:
                raise ArithmeticError(f"residuals of {size[:want].max():.3g} can't be lowered")
            x = np.linalg.qr(x)[0]
            ax, fresh = product(x), True
            p, ap = p[:, :0], ap[:, :0]
            continue
        basis, image = np.hstack([x, w, p]), np.hstack([ax, product(w), ap])
        e, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        turn = turn[:, ::-1][:, :m]
        new, new_image = basis @ turn, image @ turn
        # the direction is the step without its part along the old iterate, made orthonormal to the new one
        part = np.vstack([np.zeros((m, turn.shape[1])), turn[m:]])
        part -= turn @ (turn.T @ part)
        left, s, _ = np.linalg.svd(part, full_matrices=False)
        left = left[:, s > 1e-10]
        p, ap = basis @ left, image @ left
        x, ax, fresh = new, new_image, False
    raise ArithmeticError(f"residuals of {size[:want].max():.3g} after {steps} steps")


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """LOBPCG of the covariance of rows (x, whole numbers, each vector once); None without rows. rows are read once a step.

    Components are numbered by falling eigenvalue; ones that are 0 but for rounding are left out.
    """
    first = rows.first()
    if first is None:
        return None
    d = len(first["x"])
    n, total = count_and_sums(rows, d)
    trace = [0.0]

    def product(block: np.ndarray) -> np.ndarray:
        out, trace[0] = block_product(rows, n, total, block)
        return out

    values, vectors, steps = lobpcg(product, d, components)
    real = values > RANK * max(trace[0], np.finfo(float).tiny) if trace[0] > 0 else np.zeros(len(values), bool)
    return Fit(n, total, trace[0], values[real], vectors[:, real], steps)


def _projected(x: np.ndarray, found: Fit, sums: np.ndarray) -> np.ndarray:
    return (_centred(x, found.n, sums) @ found.vectors) / np.sqrt(found.values)


def identity_error(rows: DataFrame, found: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, from the rows themselves."""
    d, k = found.vectors.shape
    if not k:
        return 0.0
    sums = np.array(found.sums, np.int64)

    def run(batches):
        out, first = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                z = _projected(_matrix(batch.column("x"), d), found, sums)
                out += z.T @ z
                first += z.sum(0)
        table = np.concatenate([out, first[None]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k + 1)), *(pa.array(np.ascontiguousarray(c)) for c in table.T)], ["row", *(f"c{j}" for j in range(k))])

    names = [f"c{j}" for j in range(k)]
    parts = rows.select("x").mapInArrow(run, ", ".join(["row long", *(f"{c} double" for c in names)]))
    got = parts.groupBy("row").agg(*(F.sum(c).alias(c) for c in names)).orderBy("row").collect()
    table = np.array([[r[c] for c in names] for r in got]) / found.n
    return float(np.abs(table[:k] - np.outer(table[k], table[k]) - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum over dimensions of (n x - sums)^2, exact; None where it doesn't fit a long."""
    low, rest = np.divmod(sums, n)
    apart = x - low
    most = (int(np.abs(apart).max(initial=0)) + 1) * n
    if most * most * x.shape[1] < 1 << 63:
        return ((apart * n - rest) ** 2).sum(1).tolist()
    out = []
    for row in apart.astype(object) * n - rest.astype(object):
        total = int((row * row).sum())
        out.append(total if total < 1 << 63 else None)
    return out


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: id, component, n, deviation, whitened, explained, identity_error.

    Rows drop out whose vector is null or empty or has null, NaN or infinite entries. Entries become whole
    numbers, floor(64 c) + 1000000. The covariance is that of the distinct vectors of those, with
    divisor n; it is fitted on all of them, by LOBPCG, to residuals that are checked. Repeated rows and
    null or repeated ids give rows as any other. Vectors have one length, the most common (the longest
    of equally common ones); rows of other lengths drop out. 64 c must fit a long by far. Components whose eigenvalue is 0 but for
    rounding are left out, so that equal vectors, a single one or an empty table give no rows. deviation
    is null where it doesn't fit a long. Other columns, of any name, are ignored.
    """
    spark = embeddings.sparkSession
    bounded_batches(spark)
    id_type = embeddings.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v"))).select("id", whole(F.col("v")).alias("x"))
    rows = written(rows, "whole")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return _named(spark.createDataFrame([], schema), id_col)
    d = lengths[0]["d"]
    rows = rows.where(F.size("x") == d)
    distinct = written(rows.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "distinct")
    found = fit(distinct, components)
    error = identity_error(distinct, found)
    forget(distinct)
    k = len(found.values)
    sums = np.array(found.sums, np.int64)

    def run(batches):
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _matrix(batch.column("x"), d)
            z = _projected(x, found, sums)
            far = _deviations(x, found.n, sums)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, found.n, np.int64)),
                    pa.array(far, pa.int64()).take(each),
                    pa.array(z.reshape(-1)),
                    pa.array(np.tile(found.values / found.trace, len(x))),
                    pa.array(np.full(len(x) * k, error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return _named(rows.mapInArrow(run, schema), id_col)


def _named(df: DataFrame, id_col: str) -> DataFrame:
    return df.withColumnRenamed("id", id_col)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(load(spark, sf_dir, "embeddings"))


def certified(found: Fit, rows: DataFrame) -> float:
    """The largest residual of the components, by the largest eigenvalue, from a product made anew."""
    image, _ = block_product(rows, found.n, found.sums, found.vectors)
    return float(np.linalg.norm(image - found.vectors * found.values, axis=0).max() / found.values[0]) if math.isfinite(found.trace) and len(found.values) else 0.0
