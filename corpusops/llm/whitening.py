"""Embedding whitening: the leading eigenvectors of a covariance that is never formed, by Jacobi-Davidson with products on Spark.

The covariance V only enters through V B for a thin block B: a pass over the stored vectors that centres them, multiplies, and adds up one
block per task. Rayleigh-Ritz on a growing subspace gives candidates; for all those that have not converged, the projected correction
equations are solved by some steps of MINRES at once, one pass per step, and the corrections widen the subspace. Converged pairs are
locked. What the driver holds are blocks of vector length times a few dozen columns, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.llm.store import Workspace

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
BLOCK_VALUES = 1 << 17  # numbers in one stored block of vectors
SUBSPACE = 4  # the subspace is restarted at this many times the wanted components
INNER_STEPS = 8
OUTER_STEPS = 100
GROUPS = 32  # sums of tasks meet in so many groups before they go to the driver
EPS = float(np.finfo(float).eps)


def _pack(dimension: int):
    """Blocks of whole numbers, with the ids of their vectors."""
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("x", pa.binary())])
    most = max(1, BLOCK_VALUES // max(1, dimension))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                c = np.asarray(part.column("v").flatten(), np.float64)
                x = np.clip(np.floor(SCALE * c), -(2.0**62), 2.0**62).astype(np.int64) + SHIFT
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("id"))
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary())], schema=schema)

    return run


def usable(rows: DataFrame, key: str, column: str) -> tuple[DataFrame, int]:
    """(id, v) of the rows whose vector is not null and holds numbers only, and their dimension: the commonest length, the greater of equally common ones. Others are left out."""
    bad = F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = rows.where(F.col(column).isNotNull()).where(~F.coalesce(bad, F.lit(True))).select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v"))
    counts = whole.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    most = counts.agg(F.max(F.struct("n", "d")).alias("m")).first()["m"]
    dimension = most["d"] if most else 0
    return whole.where(F.size("v") == dimension), dimension


class Vectors:
    """Stored blocks of whole-number vectors, and sums over all of them of what a function makes of a block."""

    def __init__(self, packed: DataFrame, dimension: int) -> None:
        self.packed, self.dimension = packed, dimension
        self.n = packed.agg(F.sum(F.size("ids")).alias("n")).first()["n"]
        self.total = self.sums(lambda x: x.sum(axis=0), np.int64, centred=False)

    def deviations(self) -> Callable[[np.ndarray], np.ndarray]:
        """n times a block minus the sums; whole numbers."""
        n, total = self.n, self.total
        return lambda x: x * n - total

    def sums(self, f: Callable[[np.ndarray], np.ndarray], kind: type = np.float64, centred: bool = True) -> np.ndarray:
        """The sum of f(block) over all blocks, `centred` or as stored. Tasks add in a fixed order and their sums meet in groups."""
        d, n, away = self.dimension, self.n, self.deviations() if centred else None

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for x in batch.column("x"):
                    x = np.frombuffer(x.as_buffer(), np.int64).reshape(-1, d)
                    part = np.ravel(f(away(x) / n if away else x))
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.astype(kind).tobytes()], pa.binary())], names=["s"])

        def added(table: pa.Table) -> pa.Table:
            rows = sorted(zip(table.column("task").to_pylist(), table.column("s").to_pylist(), strict=True))
            return pa.table({"s": pa.array([sum(np.frombuffer(s, kind) for _, s in rows).tobytes()], pa.binary())})

        parts = self.packed.select("x").mapInArrow(partial, "s binary").withColumn("task", F.spark_partition_id())
        groups = parts.withColumn("group", F.col("task") % GROUPS).groupBy("group").applyInArrow(added, "s binary")
        return sum(np.frombuffer(s, kind) for s in sorted(r.s for r in groups.collect()))

    def product(self, block: np.ndarray) -> np.ndarray:
        """V times a block of columns."""
        return self.sums(lambda y: y.T @ (y @ block)).reshape(block.shape) / self.n

    def trace(self) -> float:
        return float(self.sums(lambda y: np.array([np.square(y).sum()]))[0]) / self.n


def orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Columns that widen `basis` to the span of both; what is already in it is left out."""
    for _ in range(2):
        new = new - basis @ (basis.T @ new)
        size = np.linalg.norm(new, axis=0)
        new = new[:, size > 0] / size[size > 0]
    left, values, _ = np.linalg.svd(new, full_matrices=False)
    new = left[:, values > 1e-8 * max(1.0, values.max(initial=0))]
    for _ in range(2):
        new, _ = np.linalg.qr(new - basis @ (basis.T @ new))
    return new[:, : basis.shape[0] - basis.shape[1]]


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Some steps of MINRES for each column of `right` at once, until all residuals are below `enough` of their start."""
    tiny = np.finfo(float).tiny
    size = np.linalg.norm(right, axis=0)
    x, last, v = np.zeros_like(right), np.zeros_like(right), right.copy()
    w0, w1 = np.zeros_like(right), np.zeros_like(right)
    g, eta = size.copy(), size.copy()
    c0, c1, s0, s1 = np.ones_like(size), np.ones_like(size), np.zeros_like(size), np.zeros_like(size)
    for _ in range(steps):
        v = v / np.maximum(g, tiny)
        av = apply(v)
        d = (v * av).sum(axis=0)
        ahead = av - d * v - g * last
        g1 = np.linalg.norm(ahead, axis=0)
        a0, a2, a3 = c1 * d - c0 * s1 * g, s1 * d + c0 * c1 * g, s0 * g
        a1 = np.maximum(np.hypot(a0, g1), tiny)
        c0, c1, s0, s1 = c1, a0 / a1, s1, g1 / a1
        w0, w1 = w1, (v - a3 * w0 - a2 * w1) / a1
        x = x + c1 * eta * w1
        eta = -s1 * eta
        last, v, g = v, ahead, g1
        if (np.abs(eta) <= enough * size).all():
            break
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(values falling, vectors as columns, greatest residual of each round) of the `wanted` greatest pairs of a symmetric product.

    It ends when every residual is at the rounding of the products, some units in the last place of the greatest value times the
    root of the dimension. Where rounding is rougher, it ends when a whole round no longer halves the worst residual and that is
    below 1e-12 of the greatest value; anything worse after `OUTER_STEPS` rounds is an error.
    """
    wanted = min(wanted, dimension)
    basis = orthonormal(np.random.default_rng(seed).standard_normal((dimension, wanted)), np.zeros((dimension, 0)))
    image = product(basis)
    worst: list[float] = []
    for _ in range(OUTER_STEPS):
        small = basis.T @ image
        values, rotation = np.linalg.eigh((small + small.T) / 2)
        values, rotation = values[::-1], rotation[:, ::-1]
        ritz, residual = basis @ rotation[:, :wanted], image @ rotation[:, :wanted]
        residual = residual - ritz * values[:wanted]
        size = np.linalg.norm(residual, axis=0)
        scale = max(float(np.abs(values).max(initial=0)), np.finfo(float).tiny)
        worst.append(float(size.max(initial=0)) / scale)
        open_ = size > 8 * EPS * np.sqrt(dimension) * scale  # the others are locked
        full = basis.shape[1] >= dimension
        stalled = len(worst) > 1 and worst[-1] > worst[-2] / 2 and worst[-1] < 1e-12
        if not open_.any() or stalled or (full and worst[-1] < 1e-12):
            return values[:wanted], ritz, worst
        if basis.shape[1] + int(open_.sum()) > max(SUBSPACE * wanted, wanted + 1) and not full:
            keep = min(2 * wanted, basis.shape[1])
            basis, image = basis @ rotation[:, :keep], image @ rotation[:, :keep]

        def outside(t: np.ndarray, ritz: np.ndarray = ritz) -> np.ndarray:
            return t - ritz @ (ritz.T @ t)

        target = values[:wanted][open_]
        shifted = lambda t: outside(product(outside(t)) - target * t)  # noqa: B023, E731
        correction = minres(shifted, -outside(residual[:, open_]), INNER_STEPS, 0.5 ** min(len(worst), 10))
        new = orthonormal(correction, basis)
        if not new.shape[1]:
            new = orthonormal(np.random.default_rng(len(worst)).standard_normal((dimension, wanted)), basis)
        basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
    raise ArithmeticError(f"residual {worst[-1]:.1e} of the greatest eigenvalue after {OUTER_STEPS} rounds")


def _exact_squares(away: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; null beyond a long."""
    most = int(np.abs(away).max(initial=0))
    if most * most * max(1, away.shape[1]) < 1 << 63:
        return np.square(away).sum(axis=1).tolist()
    sums = [sum(int(v) ** 2 for v in row) for row in away]
    return [s if s < 1 << 63 else None for s in sums]


def whitened(rows: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(frame, values, vectors): one row per usable vector and component, see `usable`; the frame is `op11`'s.

    Directions whose eigenvalue is below 1e-12 of the greatest hold rounding only and are left out, so a table of equal vectors, or of one,
    has no components and gives no rows, like an empty one. Repeated rows, ids and null ids all count and are kept. `deviation` is null
    where it is beyond a long. Extra columns are not read.
    """
    spark, work = rows.sparkSession, Workspace(rows.sparkSession, "whitening")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    whole, dimension = usable(rows, key, column)
    nothing = spark.createDataFrame([], schema), np.zeros(0), np.zeros((dimension, 0))
    if not dimension:
        return nothing
    vectors = Vectors(work.keep(whole.mapInArrow(_pack(dimension), "ids array<long>, x binary"), "vectors"), dimension)
    trace = vectors.trace()
    if trace <= 0:
        return nothing
    values, found, _ = jacobi_davidson(vectors.product, dimension, components)
    real = values > 1e-12 * values[0]
    values, found = values[real], found[:, real]
    if not len(values):
        return nothing
    scaled, k, n, away = found / np.sqrt(values), len(values), vectors.n, vectors.deviations()
    mean = vectors.sums(lambda y: (y @ scaled).sum(axis=0)) / n
    covariance = vectors.sums(lambda y: (y @ scaled - mean).T @ (y @ scaled - mean)).reshape(k, k) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = values / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column("ids"), batch.column("x"), strict=True):
                d = away(np.frombuffer(x.as_buffer(), np.int64).reshape(-1, dimension))
                m = len(d)
                squares = pa.array(_exact_squares(d), pa.int64())
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), squares.take(each),
                    pa.array(((d / n) @ scaled).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.packed.mapInArrow(project, schema), values, found


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))[0]
