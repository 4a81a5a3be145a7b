"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers, so that counts, sums and deviations are exact at any size. Tasks
add up the centred scatter of their rows; only that square of the vector length reaches the
driver, which factors it by pivoted Cholesky and turns the triangular factor's columns
orthogonal by one-sided Jacobi. Column norms give the eigenvalues, the scaled columns the
components. All rows are then projected where they lie.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import bounded_batches

STEPS = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: A pivot below this share of the trace counts as none: the vectors span no more directions.
RANK_TOLERANCE = 1e-12
MAX_SWEEPS = 60
LONG_MAX = 2**63 - 1
#: Whole entries end here on both sides, far beyond what a deviation can hold.
LARGEST = 1 << 60


class Whitening(NamedTuple):
    """Fit of one vector length: ``n`` rows, exact ``sums``, their rounded mean ``centre``, what
    the mean lies beyond it (``rest``), ``weights`` (length x components, over the roots of the
    eigenvalues) and the ``explained`` shares of the trace."""

    n: int
    sums: list[int]
    centre: np.ndarray
    rest: np.ndarray
    weights: np.ndarray
    explained: np.ndarray


def pivoted_cholesky(v: np.ndarray, tolerance: float = RANK_TOLERANCE) -> np.ndarray:
    """Factor ``g`` with ``g @ g.T = v``, lower triangular in the order of its pivots.

    Each step takes the row with the most variance left; it ends when what is left is nothing.
    """
    left, total = v.astype(np.float64), float(np.trace(v))
    columns = []
    for _ in range(len(v)):
        pivot = int(np.argmax(left.diagonal()))
        if not left[pivot, pivot] > tolerance * total:
            break
        column = left[:, pivot] / np.sqrt(left[pivot, pivot])
        left = left - np.outer(column, column)
        # Taken rows have no variance left, whatever rounding says.
        left[pivot, :] = left[:, pivot] = 0.0
        columns.append(column)
    return np.stack(columns, axis=1) if columns else np.empty((len(v), 0))


def _rounds(m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``m`` columns in rounds of disjoint pairs, as in a tournament."""
    ring = list(range(m)) + [-1] * (m % 2)
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], ring[::-1]) if a >= 0 and b >= 0]
        yield np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def orthogonal_columns(g: np.ndarray) -> np.ndarray:
    """``g`` turned from the right until its columns are orthogonal, longest first."""
    g = g.copy()
    for _ in range(MAX_SWEEPS):
        turned = False
        for i, j in _rounds(g.shape[1]):
            a, b = g[:, i], g[:, j]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            some = np.abs(ab) > 1e-15 * np.sqrt(aa * bb)
            if not some.any():
                continue
            turned = True
            i, j, a, b = i[some], j[some], a[:, some], b[:, some]
            zeta = (bb[some] - aa[some]) / (2 * ab[some])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, t)
            g[:, i], g[:, j] = cos * a - cos * t * b, cos * t * a + cos * b
        if not turned:
            break
    return g[:, np.argsort(-(g * g).sum(axis=0), kind="stable")]


def fit(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit components (as columns), eigenvalues and explained shares of a covariance.

    The largest entry of a component is positive, so that reruns agree in sign.
    """
    g = orthogonal_columns(pivoted_cholesky(v))[:, :components]
    norms = np.sqrt((g * g).sum(axis=0))
    units = g / norms
    if units.size:
        units = units * np.sign(units[np.abs(units).argmax(axis=0), np.arange(units.shape[1])])
    return units, norms**2, norms**2 / max(float(np.trace(v)), np.finfo(float).tiny)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Length, ids and whole numbers (rows x length) of each vector length of a batch."""
    lists = batch.column(1)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        here = pa.array(sizes == size)
        x = lists.filter(here).flatten().to_numpy(zero_copy_only=False)
        yield int(size), batch.column(0).filter(here), x.reshape(-1, int(size))


def _products(rows: DataFrame, project: Callable[[int, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """Sum over all rows of the outer product of ``project(length, x)``, for each vector length.

    A task holds one matrix a length and sends it once; the matrices are added up by place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x in _by_length(batch):
                y = project(size, x)
                totals[size] = totals[size] + y.T @ y if size in totals else y.T @ y
        for size, total in totals.items():
            n = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(list(total))],
                names=["size", "i", "line"],
            )

    lines = rows.mapInArrow(run, "size int, i int, line array<double>").select("size", "i", F.posexplode("line").alias("j", "part"))
    found: dict[int, np.ndarray] = {}
    for row in lines.groupBy("size", "i", "j").agg(F.sum("part").alias("part")).collect():
        if row.size not in found:
            found[row.size] = np.zeros((0, 0))
        need = max(row.i, row.j) + 1
        if need > len(found[row.size]):
            grown = np.zeros((max(need, 2 * len(found[row.size])),) * 2)
            grown[: len(found[row.size]), : len(found[row.size])] = found[row.size]
            found[row.size] = grown
        found[row.size][row.i, row.j] = row.part
    return found


def _centred(fits: dict[int, Whitening], size: int, x: np.ndarray) -> np.ndarray:
    return (x - fits[size].centre).astype(np.float64) - fits[size].rest


def _deviation(one: Whitening, x: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n * x - S)^2 as exact long, null where it does not fit one."""
    reach = max((abs(one.n * int(edge) - s) for edge, s in zip((*x.min(axis=0), *x.max(axis=0)), one.sums * 2)), default=0)
    if reach * reach * x.shape[1] <= LONG_MAX:
        apart = one.n * x - np.array(one.sums, np.int64)
        return pa.array((apart * apart).sum(axis=1))
    exact = [sum((one.n * int(v) - s) ** 2 for v, s in zip(row, one.sums)) for row in x]
    return pa.array([v if v <= LONG_MAX else None for v in exact], pa.int64())


def whitened(
    df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: one row per
    remaining vector and component, numbered from 1 by falling variance.

    Vectors that are null, empty or hold null or non-finite entries are left out. Vectors of
    each length are whitened among themselves. Repeated rows and rows that share an id count
    each for themselves; a null id stays null. Directions without variance have no component, so
    a table of equal vectors, or an empty one, gives an empty result. A deviation beyond a long
    is null. The driver holds a matrix of the vector length squared for each length.
    """
    spark = df.sparkSession
    bounded_batches(spark, 4096)
    parts = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), parts.alias("c"))
    broken = F.exists("c", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where((F.size("c") > 0) & ~broken)
    whole = F.transform("c", lambda c: F.greatest(F.least(F.floor(c * STEPS), F.lit(LARGEST)), F.lit(-LARGEST)) + F.lit(OFFSET).cast("long"))
    rows = rows.select("vec_id", whole.alias("x"))

    places = rows.select(F.size("x").alias("size"), F.posexplode("x").alias("i", "x"))
    sums = places.groupBy("size", "i").agg(F.count("x").alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("s"))
    fits: dict[int, Whitening] = {}
    for row in sums.orderBy("size", "i").collect():
        one = fits.setdefault(row.size, Whitening(row.n, [], None, None, None, None))
        one.sums.append(int(row.s))
    for size, one in fits.items():
        centre = [(2 * s + one.n) // (2 * one.n) for s in one.sums]
        rest = [(s - one.n * c) / one.n for s, c in zip(one.sums, centre)]
        fits[size] = one._replace(centre=np.array(centre, np.int64), rest=np.array(rest))

    scatter = _products(rows, lambda size, x: _centred(fits, size, x)) if fits else {}
    for size, total in scatter.items():
        units, values, explained = fit(total[:size, :size] / fits[size].n, components)
        fits[size] = fits[size]._replace(weights=units / np.sqrt(values), explained=explained)

    def project(size: int, x: np.ndarray) -> np.ndarray:
        return _centred(fits, size, x) @ fits[size].weights

    identity_error = 0.0
    for size, total in (_products(rows, project) if fits else {}).items():
        k = fits[size].weights.shape[1]
        identity_error = max(identity_error, float(np.abs(total[:k, :k] / fits[size].n - np.eye(k)).max(initial=0.0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, ids, x in _by_length(batch):
                one, z = fits[size], project(size, x)
                n, k = z.shape
                each = pa.array(np.repeat(np.arange(n), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                        pa.array(np.full(n * k, one.n, np.int64)),
                        _deviation(one, x).take(each),
                        pa.array(z.ravel()),
                        pa.array(np.tile(one.explained, n)),
                        pa.array(np.full(n * k, identity_error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(
        run,
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double",
    )
