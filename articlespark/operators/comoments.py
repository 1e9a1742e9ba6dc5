"""Correlations of many features from one pass: co-moments of blocks of features, merged by tree."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Features of a block's side; a block's sums are merged apart from the others.
BLOCK = 256
#: Partial sums per block after the first merge.
LANES = 64
#: Numbers of a batch that are multiplied at once.
CHUNK = 4_000_000
PARTS = ["n", "mx", "my", "cxx", "cyy", "cxy"]


def _measure(x: np.ndarray) -> list[np.ndarray]:
    """Counts, means and central co-moments of every pair of columns of a matrix; where no value is missing, counts, means
    and variances have one number instead of one per pair."""
    there = ~np.isnan(x)
    with np.errstate(invalid="ignore"):
        shift = np.where(there.any(axis=0), np.nansum(x, axis=0) / np.maximum(there.sum(axis=0), 1), 0.0)
    if there.all():
        z = x - shift
        square = (z * z).sum(axis=0)
        return [np.full((1, 1), float(len(x))), shift[:, None], shift[None, :], square[:, None], square[None, :], z.T @ z]
    z, w = np.where(there, x - shift, 0.0), there.astype(np.float64)
    n, sx, sxx = w.T @ w, z.T @ w, (z * z).T @ w
    some = np.maximum(n, 1.0)
    return [n, shift[:, None] + sx / some, shift[None, :] + sx.T / some, sxx - sx * sx / some, sxx.T - sx.T * sx.T / some, z.T @ z - sx * sx.T / some]


def _merge(a: list[np.ndarray] | None, b: list[np.ndarray]) -> list[np.ndarray]:
    """Co-moments of two parts together."""
    if a is None:
        return b
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1.0)
    dx, dy, weight = b[1] - a[1], b[2] - a[2], a[0] * share
    # the mean of no values does not count
    return [n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * weight, a[4] + b[4] + dy * dy * weight, a[5] + b[5] + dx * dy * weight]


def _cut(v: np.ndarray, a: int, b: int) -> np.ndarray:
    """A block of the numbers per pair, or the part of those per feature that it needs."""
    v = v[a:a + BLOCK] if v.shape[0] > 1 else v
    return v[:, b:b + BLOCK] if v.shape[1] > 1 else v


def _varies(square: np.ndarray, mean: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether the squares are more than what rounding the mean leaves behind."""
    return square > n * (1e-13 * mean) ** 2


def _shape(part: str, values: np.ndarray, rows: int, cols: int) -> np.ndarray:
    if len(values) == rows * cols:
        return values.reshape(rows, cols)
    return values.reshape((-1, 1) if part in ("mx", "cxx") else (1, -1))


def co_moments(df: DataFrame, values: Column, size: int) -> DataFrame:
    """Blocks (i, j, n, mx, my, cxx, cyy, cxy) over features i * BLOCK and on, j * BLOCK and on, i <= j: for pairs of features, how many rows
    have both, their means, variances and covariance over those rows, times the rows.

    ``values`` is an array of ``size`` doubles; null and NaN are missing. Each task holds the sums of all pairs
    (``size`` squared numbers, meant for some thousands of features); what is shuffled is a block per task, merged in two steps.
    """
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("lane", pa.int32())] + [(p, pa.list_(pa.float64())) for p in PARTS])
    ddl = "i int, j int, lane int, " + ", ".join(f"{p} array<double>" for p in PARTS)
    starts = range(0, size, BLOCK)

    def batch_of(i: int, j: int, lane: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"i": [i], "j": [j], "lane": [lane]} | {p: [v.ravel()] for p, v in zip(PARTS, parts)}, schema=schema)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            flat = batch.column(0).flatten()
            x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
            step = max(1, CHUNK // size)
            for first in range(0, len(x), step):
                total = _merge(total, _measure(x[first:first + step]))
        if total is None:
            return
        lane = TaskContext.get().partitionId() % LANES
        for bi, a in enumerate(starts):
            for bj, b in enumerate(starts):
                if bi <= bj:
                    yield batch_of(bi, bj, lane, [_cut(v, a, b) for v in total])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j = key[0].as_py(), key[1].as_py()
        rows, cols = (min(BLOCK, size - k * BLOCK) for k in (i, j))
        total = None
        for batch in batches:
            for row in range(batch.num_rows):
                total = _merge(total, [_shape(p, np.asarray(batch.column(p)[row].values), rows, cols) for p in PARTS])
        yield batch_of(i, j, 0, total)

    measured = df.select(F.transform(values, lambda v: F.coalesce(v.cast("double"), F.lit(float("nan")))).alias("_x")).mapInArrow(measure, ddl)
    return measured.groupBy("i", "j", "lane").applyInArrow(add, ddl).groupBy("i", "j").applyInArrow(add, ddl).drop("lane")


def correlations(blocks: DataFrame, names: Sequence[str]) -> DataFrame:
    """(earlier, feature, n, correlation): a row per pair of features. Null where a feature is constant over the pair's rows."""
    size, names = len(names), list(names)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                i, j = batch.column("i")[row].as_py(), batch.column("j")[row].as_py()
                rows, cols = (min(BLOCK, size - k * BLOCK) for k in (i, j))
                n, mx, my, cxx, cyy, cxy = (np.broadcast_to(_shape(p, np.asarray(batch.column(p)[row].values), rows, cols), (rows, cols)) for p in PARTS)
                with np.errstate(invalid="ignore", divide="ignore"):
                    r = cxy / np.sqrt(cxx * cyy)
                a, b = np.triu_indices(rows, 1) if i == j else np.indices((rows, cols)).reshape(2, -1)
                r[~(_varies(cxx, mx, n) & _varies(cyy, my, n))] = np.nan
                r, n = r[a, b], n[a, b]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[k] for k in a + i * BLOCK], pa.string()), pa.array([names[k] for k in b + j * BLOCK], pa.string()),
                     pa.array(n.astype(np.int64)), pa.array(r, mask=~np.isfinite(r))], ["earlier", "feature", "n", "correlation"])

    return blocks.mapInArrow(pairs, "earlier string, feature string, n long, correlation double")
