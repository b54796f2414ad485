"""Embedding whitening by matrix-free block Lanczos.

Vectors are put on a grid of integers, so sums and deviations are exact. Components are the
leading eigenvectors of the covariance of the fit list (each distinct vector once). The covariance
is never formed: a pass over the fit list gives X'(X v) of the centred rows for a whole block of
vectors v, summed in two levels of tasks, and only arrays of the size of one block come to the driver.
The basis is orthogonalised in full, twice; directions that vanish (breakdown) are replaced by new random
ones; the residuals of the wanted components decide when to stop. A basis that spans the whole space is
exact. The trace is the sum of the rows' exact deviations, which gives each component's share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, sliced, written

STEPS, SHIFT = 64, 1_000_000
COMPONENTS = 16
FARTHEST = 1 << 53  # grid values beyond are set to it
RESIDUAL = 1e-13  # of the largest eigenvalue
SMALLEST = 1e-10  # components below this share of the largest eigenvalue have no direction of their own
MOST_STEPS = 1000  # passes, far beyond what the residuals need
SLOTS = 16  # sums that reach the driver from one pass
LONG = 1 << 63
SCHEMA = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def on_grid(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``__id, __x``: each vector of finite entries as integers floor(64 c) + 1000000."""
    entries = F.col(vec_col)
    whole = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    edge = float(FARTHEST)
    place = F.transform(entries, lambda c: F.floor(F.greatest(F.least(c.cast("double") * STEPS, F.lit(edge)), F.lit(-edge))).cast("long") + SHIFT)
    return df.where(entries.isNotNull() & (F.size(entries) > 0)).where(whole).select(F.col(id_col).alias("__id"), place.alias("__x"))


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, a row each."""
    return batch.column("__x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def totals(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], shape: tuple, kind: type = np.float64, join: Callable = np.add) -> np.ndarray:
    """``of`` every batch of vectors, joined in the tasks, then in ``SLOTS`` tasks, then here."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in sliced(batches):
            part = of(matrix(batch)).astype(kind)
            held = part if held is None else join(held, part)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % SLOTS], pa.int32()), pa.array([held.tobytes()], pa.binary())], names=["slot", "part"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for value in batch.column("part"):
                part = np.frombuffer(value.as_py(), kind)
                held = part if held is None else join(held, part)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], names=["part"])

    found = rows.mapInArrow(own, "slot int, part binary").repartition(SLOTS, "slot").mapInArrow(joined, "part binary").collect()
    return reduce(join, [np.frombuffer(r["part"], kind) for r in found]).reshape(shape)


@dataclass
class Fit:
    """What tasks need of the fit list: its size, the vectors' length, their sums, and whether deviations fit a long."""

    n: int
    width: int
    sums: list[int]
    fits: bool

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: longs where they and their squares fit, else Python integers."""
        if self.fits:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def deviations(self, x: np.ndarray) -> list[int]:
        """The exact squared length of n x - S, for each row."""
        return (self.differences(x) ** 2).sum(1).tolist()

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.differences(x).astype(np.float64) / self.n


def fit_list(vectors: DataFrame) -> tuple[DataFrame, Fit, int]:
    """The distinct vectors of the commonest length as a table, what tasks need of them, and the sum of their deviations."""
    table = written(vectors.select("__x").distinct(), "fit-list")
    lengths = table.groupBy(F.size("__x").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not lengths:
        return table, Fit(0, 0, [], True), 0
    n, width = lengths[0]["count"], lengths[0]["size"]
    rows = table.where(F.size("__x") == width)
    low = (1 << 26) - 1  # sums in two halves, so that no long overflows
    halves = totals(rows, lambda x: np.stack([(x >> 26).sum(0), (x & low).sum(0)]), (2, width), np.int64)
    sums = [(int(high) << 26) + int(rest) for high, rest in zip(*halves, strict=True)]
    ends = totals(rows, lambda x: np.stack([x.min(0), -x.max(0)]), (2, width), np.int64, np.minimum)
    widest = max(-int(top) - int(bottom) for bottom, top in zip(*ends, strict=True))
    fit = Fit(n, width, sums, width * (n * widest) ** 2 < LONG and max(map(abs, sums)) < LONG)

    def deviation(x: np.ndarray) -> np.ndarray:
        total = sum(fit.deviations(x))
        return np.array([float(total >> 32) if not fit.fits else total >> 32, total & 0xFFFFFFFF])

    whole, rest = totals(rows, deviation, (2,), np.int64 if fit.fits else np.float64)
    return rows, fit, (int(whole) << 32) + int(rest)


def covariance_times(rows: DataFrame, fit: Fit, block: np.ndarray) -> np.ndarray:
    """The covariance of the fit list times ``block``, by one pass."""

    def product(x: np.ndarray) -> np.ndarray:
        centred = fit.centred(x)
        return centred.T @ (centred @ block)

    return totals(rows, product, block.shape) / fit.n


def orthonormal(block: np.ndarray, basis: np.ndarray, rng: np.random.Generator, wanted: int) -> np.ndarray:
    """``wanted`` unit vectors orthogonal to ``basis`` and each other: what of ``block`` is new, then random directions."""
    scale = np.linalg.norm(block, axis=0).max(initial=0.0)
    out = np.zeros((len(basis), 0))
    for _ in range(50):
        for _ in range(2):
            held = np.hstack([basis, out])
            block = block - held @ (held.T @ block)
        left, sizes, _ = np.linalg.svd(block, full_matrices=False)
        fresh = left[:, sizes > 1e-12 * max(scale, 1e-300)][:, : wanted - out.shape[1]]
        for _ in range(2):  # the basis has to stay orthogonal where what was new is tiny
            fresh = fresh - held @ (held.T @ fresh)
            fresh = np.linalg.qr(fresh)[0] if fresh.shape[1] else fresh
        out = np.hstack([out, fresh])
        if out.shape[1] == wanted:
            break
        block = rng.standard_normal((len(basis), wanted - out.shape[1]))  # breakdown: start again beside what is known
        scale = 1.0
    return out


def block_lanczos(times: Callable[[np.ndarray], np.ndarray], size: int, wanted: int = COMPONENTS, residual: float = RESIDUAL, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of the symmetric operator ``times``.

    The block is as wide as the number of wanted pairs, so repeated eigenvalues are found as often as they occur.
    """
    rng = np.random.default_rng(seed)
    wanted = min(wanted, size)
    basis, images = np.zeros((size, 0)), np.zeros((size, 0))
    block = orthonormal(rng.standard_normal((size, wanted)), basis, rng, wanted)
    for _ in range(MOST_STEPS):
        out = times(block)
        basis, images = np.hstack([basis, block]), np.hstack([images, out])
        inner = basis.T @ images
        values, mix = np.linalg.eigh((inner + inner.T) / 2)
        values, mix = values[::-1][:wanted], mix[:, ::-1][:, :wanted]
        vectors = basis @ mix
        off = np.linalg.norm(images @ mix - vectors * values, axis=0)
        if basis.shape[1] == size or (off <= residual * max(values[0], 0.0)).all():
            break
        block = orthonormal(out, basis, rng, min(wanted, size - basis.shape[1]))
    return values, vectors / np.linalg.norm(vectors, axis=0)


def whiten(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every whole vector and component.

    Null vectors, empty ones and those with null or non-finite entries are left out, as are vectors of another
    length than most distinct ones have (of the shorter one in a tie). Repeated rows get equal values and
    count once in the fit list; null ids stay. A direction without variance is no component, so a table
    with one distinct vector, as an empty one, gives no rows. A deviation beyond a long is null.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    kind = dict(df.select(F.col(id_col).alias("k")).dtypes)["k"]
    schema = SCHEMA.format(kind)
    vectors = on_grid(df, id_col, vec_col)
    rows, fit, deviation = fit_list(vectors)
    if not deviation:
        return spark.createDataFrame([], schema)
    values, directions = block_lanczos(partial(covariance_times, rows, fit), fit.width, components)
    real = values > SMALLEST * values[0]
    values, directions = values[real], directions[:, real]
    project, count, n = directions / np.sqrt(values), len(values), fit.n
    explained = values / (deviation / n**3)  # the trace

    def spread(x: np.ndarray) -> np.ndarray:
        own = fit.centred(x) @ project
        return own.T @ own

    error = float(np.abs(totals(rows, spread, (count, count)) / n - np.eye(count)).max())

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            x, m = matrix(batch), batch.num_rows
            deviation = pa.array([v if v < LONG else None for v in fit.deviations(x)], pa.int64())
            each = pa.array(np.repeat(np.arange(m), count))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__id").take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * count, n, np.int64)),
                    deviation.take(each),
                    pa.array((fit.centred(x) @ project).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * count, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.where(F.size("__x") == fit.width).mapInArrow(projected, schema)


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
