"""Embedding whitening by shifted CholeskyQR.

Vectors become whole numbers, and the components are fitted on the distinct ones. Their rows, centred by
their exact mean, are orthogonalised in passes: each task adds up its part of the Gram matrix of the rows
divided by all factors so far (triangular solves), Spark sums these parts row by row, and the driver takes
the Cholesky factor, in the first pass of the shifted matrix. When the Gram matrix is the identity, its
square root times the composed factors is the R of the centred rows, and R's singular vectors and values
are the components and their standard deviations. The driver holds a few matrices of the dimension
squared, at most ``MAX_DIMENSION``, whatever the number of rows is.

Rows are left out if their vector is null or empty, holds a null or a number that isn't finite or whose
64-fold doesn't fit in 2**53, or has another length than most distinct vectors have (of equally frequent
lengths the larger counts). A null id stays null; repeated rows are returned one by one and count once in
the fit; other columns are ignored; no rows give no rows. Directions without variance come last:
``whitened`` is null there and ``explained`` 0 (null if there is no variance at all). ``deviation`` is null
where it doesn't fit in a long."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesmith.cluster import cut_lineage

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Widest vectors that can be fitted: a matrix of 2048 x 2048 doubles takes 32 MB.
MAX_DIMENSION = 2048
#: Passes end when the Gram matrix is this close to the identity, or after so many.
CLOSE, PASSES = 1e-9, 5
#: Variances below this share of the largest one are none.
NO_VARIANCE = 1e-13
BLOCK = 1 << 17  # numbers worked on at once
_LIMIT, _HALF = float(1 << 53), 27


def whole_numbers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``floor(64 c) + 1000000`` of all entries, one after another, the rows' lengths (0 for rows that are
    left out) and the place of each row's first number."""
    vectors = vectors.cast(pa.list_(pa.float64()))
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten()  # a null row has no values there
    missing = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.fill_null(0.0).to_numpy(zero_copy_only=False) * SCALE
    bad = missing | ~(np.abs(values) < _LIMIT)
    starts = np.cumsum(lengths) - lengths
    rows = np.repeat(np.arange(len(lengths)), lengths)
    lengths = lengths.copy()
    lengths[rows[bad]] = 0
    values[bad] = 0.0
    return np.floor(values).astype(np.int64) + OFFSET, lengths, starts


def _matrix(numbers: np.ndarray, lengths: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of that length as a matrix, and which they are."""
    rows = np.flatnonzero(lengths == width)
    return numbers[starts[rows][:, None] + np.arange(width)], rows


def _to_numbers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers, lengths, starts = whole_numbers(batch.column(0))
        kept = np.repeat(np.arange(len(lengths)), lengths)
        firsts = np.repeat(np.cumsum(lengths) - lengths, lengths)
        flat = numbers[starts[kept] + np.arange(len(kept)) - firsts]
        sizes = lengths[lengths > 0]
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["x"])


def fit_list(vectors: DataFrame) -> DataFrame:
    """``x``: every distinct vector of whole numbers, once. Copies collapse before they are shuffled."""
    return vectors.mapInArrow(_to_numbers, "x array<long>").distinct()


def _fit_rows(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    numbers = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    step = max(1, BLOCK // width)
    for i in range(0, len(numbers), step):
        yield numbers[i : i + step]


def _sums(width: int):
    """Sums of each dimension, in two parts, so that they fit in a long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            high += (x >> _HALF).sum(axis=0)
            low += (x & ((1 << _HALF) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(high), pa.array(low)], ["dimension", "high", "low"])

    return run


class Mean(NamedTuple):
    """The mean of ``n`` vectors: a whole part and what is left of each dimension's sum."""

    n: int
    whole: np.ndarray
    left: np.ndarray

    def far(self, x: np.ndarray) -> np.ndarray | None:
        """``n x`` less the sums, exact; None if that doesn't fit in a long."""
        near = x - self.whole
        if self.n * int(np.abs(near).max(initial=0)) >= 1 << 62:
            return None
        return self.n * near - self.left

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x`` less the mean, the difference taken in whole numbers, so that nothing cancels."""
        far = self.far(x)
        return (x - self.whole) - self.left / self.n if far is None else far / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of ``(n x - sums) ** 2``, exact; null if it doesn't fit in a long."""
        far = self.far(x)
        most = None if far is None else int(np.abs(far).max(initial=0))
        if most is not None and most * most * x.shape[1] < 1 << 63:
            return pa.array((far * far).sum(axis=1))
        left = self.left.tolist()
        exact = [sum((self.n * v - w) ** 2 for v, w in zip(row, left, strict=True)) for row in (x - self.whole).tolist()]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular factor, by substitution from column to column."""
    out = np.array(rows.T)
    for j in range(len(factor)):
        out[j] -= factor[:j, j] @ out[:j]
        out[j] /= factor[j, j]
    return out.T


def _gram(width: int, mean: Mean, factors: list[np.ndarray], last: np.ndarray | None = None):
    """Rows of the task's part of the Gram matrix of the rows divided by ``factors``, or times ``last``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            for x in _fit_rows(batch, width):
                rows = mean.centred(x)
                for factor in factors:
                    rows = solved(rows, factor)
                rows = rows if last is None else rows @ last
                total = total + rows.T @ rows
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(list(total))], ["row", "part"])

    return run


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the parts of each row; all parts of a row come to one task, one after another."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for row, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            values = part.values.to_numpy(zero_copy_only=False)
            sums[row] = sums[row] + values if row in sums else values.copy()
    for row, values in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([row]), pa.array([values])], ["row", "part"])


_PARTS = "row long, part array<double>"


def gram_matrix(fit: DataFrame, width: int, mean: Mean, factors: list[np.ndarray], last: np.ndarray | None = None) -> np.ndarray:
    parts = fit.mapInArrow(_gram(width, mean, factors, last), _PARTS)
    rows = parts.repartition("row").mapInArrow(_added, _PARTS).collect()  # as many rows as the matrix has
    found = np.zeros((len(rows), len(rows)))
    for row, part in rows:
        found[row] = part
    return (found + found.T) / 2


class Whitening(NamedTuple):
    width: int
    mean: Mean
    #: A column per component; the largest entry of each is positive.
    vectors: np.ndarray
    #: Variances in falling order, 0.0 where there is none.
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    def projection(self) -> np.ndarray:
        """What centred rows are multiplied with; columns without variance are zero."""
        has = self.variances > 0
        return np.where(has, self.vectors / np.sqrt(np.where(has, self.variances, 1.0)), 0.0)


def r_factor(fit: DataFrame, width: int, mean: Mean) -> np.ndarray:
    """A matrix R with RᵀR = AᵀA for the centred rows A, without forming AᵀA to full accuracy at once."""
    unit = np.finfo(float).eps / 2
    factors: list[np.ndarray] = []
    for i in range(PASSES):
        gram = gram_matrix(fit, width, mean, factors)
        close = np.abs(gram - np.eye(width)).max() <= CLOSE
        if close or i == PASSES - 1:
            break
        shift = 11 * (mean.n * width + width * (width + 1)) * unit * np.linalg.norm(gram, 2) if i == 0 else 0.0
        shift = min(shift, 1e-3 * np.linalg.norm(gram, 2))  # many rows: more than that is never needed
        try:
            factors.append(np.linalg.cholesky(gram + shift * np.eye(width)).T)
        except np.linalg.LinAlgError:  # directions without variance: what is left of them is rounding
            break
    values, turned = np.linalg.eigh(gram)
    root = np.sqrt(np.maximum(values, 0.0))[:, None] * turned.T
    for factor in reversed(factors):
        root = root @ factor
    return root


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components of the written fit list; None if it is empty."""
    lengths = fit.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if lengths is None:
        return None
    width, n = lengths
    if width > MAX_DIMENSION:
        raise ValueError(f"vectors of {width} numbers; at most {MAX_DIMENSION} can be fitted")
    fit = fit.where(F.size("x") == width)
    parts = fit.mapInArrow(_sums(width), "dimension long, high long, low long").groupBy("dimension").agg(F.sum("high"), F.sum("low"))
    sums = [(high << _HALF) + low for _, high, low in sorted(map(tuple, parts.collect()))]  # a row per dimension
    mean = Mean(n, np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64))
    _, deviations, turned = np.linalg.svd(r_factor(fit, width, mean))
    variances = deviations**2 / n
    variances[variances <= NO_VARIANCE * variances[0]] = 0.0
    total, k = variances.sum(), min(components, width)
    signs = np.sign(turned[np.arange(width), np.abs(turned).argmax(axis=1)])
    found = Whitening(width, mean, (turned * signs[:, None])[:k].T, variances[:k],
                      variances[:k] / total if total else np.full(k, np.nan), 0.0)
    has = int((found.variances > 0).sum())
    if not has:
        return found
    covariance = gram_matrix(fit, width, mean, [], found.projection()[:, :has]) / n
    return found._replace(identity_error=float(np.abs(covariance - np.eye(has)).max()))


def _whiten(model: Whitening, key_type: pa.DataType):
    columns = model.projection()
    k = columns.shape[1]
    none = model.variances == 0
    explained = pa.array([None if np.isnan(v) else v for v in model.explained.tolist()], pa.float64())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, BLOCK // model.width)
        for whole in batches:
            for i in range(0, len(whole), step):
                batch = whole.slice(i, step)
                x, rows = _matrix(*whole_numbers(batch.column("vector")), model.width)
                if not len(rows):
                    continue
                white = model.mean.centred(x) @ columns
                each = pa.array(np.repeat(np.arange(len(rows)), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column("key").take(pa.array(np.repeat(rows, k))).cast(key_type),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(rows) * k, model.mean.n)),
                    model.mean.deviations(x).take(each),
                    pa.array(white.ravel(), mask=np.tile(none, len(rows))),
                    explained.take(pa.array(np.tile(np.arange(k), len(rows)))),
                    pa.array(np.full(len(rows) * k, model.identity_error)),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


_REST = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def apply_whitening(keyed: DataFrame, model: Whitening | None) -> DataFrame:
    """A row per component of each usable row of ``keyed`` (``key``, ``vector``)."""
    if model is None:
        spark: SparkSession = keyed.sparkSession
        return spark.createDataFrame([], f"vec_id long, {_REST}")
    return keyed.mapInArrow(_whiten(model, pa.int64()), f"vec_id long, {_REST}")


def whiten(embeddings: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, a row per usable row and component."""
    keyed = embeddings.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"))
    fit = cut_lineage(fit_list(keyed.select("vector")))
    return apply_whitening(keyed, fit_whitening(fit, components))
