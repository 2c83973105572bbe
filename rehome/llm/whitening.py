"""Whitening of embeddings by the polarisation identity.

An entry ``c`` becomes the integer ``floor(SCALE * c) + OFFSET``.  The passes:

1. the number ``n`` of vectors and the exact sum ``S`` of every dimension;
2. for every dimension and every sum of two dimensions the exact sum of the
   squared centred values.  Values are centred at the integer part of the mean
   before they are squared; the fraction left is put right afterwards, so that
   each total is the exact variance times ``n * n``.  By polarisation
   ``2 cov(a, b) = var(a + b) - var(a) - var(b)``: no product of two different
   dimensions is ever formed;
3. ``eigh`` of the covariance, on the driver (its size depends on the vectors'
   length alone), and the covariance of the whitened rows themselves, whose
   distance from the identity is reported;
4. the rows projected on the first ``components`` eigenvectors.

Passes 1 to 3 send one total per task and dimension pair, added up by key, so
nothing that grows with the rows reaches one task or the driver.

Edge cases.  Vectors that are null or empty, hold a null or non-finite entry,
or an entry of 2^52 or more (its integer would not fit a long) take no part.
Vectors of different length are fitted apart.  Rows with a null id and repeated
rows count like any other.  Components without variance have null ``whitened``
values and are left out of the identity error, which is null if there is none;
``explained`` is null if nothing varies.  Columns beside id and vector are not
read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
LIMIT = float(1 << 52)
SLICE_ROWS = 4096
# Totals of any size are added up by Spark as two decimals.
LIMB = 10 ** 18
# Whitened products are rounded to this many digits a task, so that their sum
# does not depend on the order of the tasks.
DIGITS = 14


def integer_vectors(col: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, row numbers, integer matrix) of a batch's usable vectors, in slices."""
    flat = col.values.to_numpy(zero_copy_only=False)  # a null entry becomes NaN
    offsets = col.offsets.to_numpy()
    starts, lengths = offsets[:-1], np.diff(offsets)
    some = col.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0)
    for dim in np.unique(lengths[some]).tolist():
        rows = np.flatnonzero(some & (lengths == dim))
        for at in range(0, len(rows), SLICE_ROWS):
            part = rows[at:at + SLICE_ROWS]
            c = flat[starts[part][:, None] + np.arange(dim)].astype(np.float64)
            ok = (np.abs(c) < LIMIT).all(axis=1)
            if ok.any():
                yield dim, part[ok], np.floor(SCALE * c[ok]).astype(np.int64) + OFFSET


def exact_sums(x: np.ndarray) -> np.ndarray:
    """Column sums as Python integers."""
    high = (x >> 31).sum(axis=0).astype(object)
    return high * (1 << 31) + (x & ((1 << 31) - 1)).sum(axis=0).astype(object)


def polarised_squares(d: np.ndarray) -> np.ndarray:
    """Exact sums of squares of every column and of every sum of two columns,
    row by row of the upper triangle, as Python integers."""
    rows, dim = d.shape
    if 4 * rows * int(np.abs(d).max()) ** 2 >= 1 << 63:
        d = d.astype(object)
    out = np.empty(dim * (dim + 1) // 2, object)
    at = 0
    for i in range(dim):
        own = d[:, i]
        out[at] = int((own * own).sum())
        pair = d[:, i + 1:] + d[:, i:i + 1]
        out[at + 1:at + dim - i] = (pair * pair).sum(axis=0).astype(object)
        at += dim - i
    return out


def _totals(vectors: DataFrame, measure: Callable[[int, np.ndarray], np.ndarray]) -> dict:
    """{dimension: (n, exact totals)} of ``measure`` over all usable vectors."""
    def run(batches):
        totals, counts = {}, {}
        for batch in batches:
            for dim, _, x in integer_vectors(batch.column(0)):
                got = measure(dim, x)
                totals[dim] = totals[dim] + got if dim in totals else got
                counts[dim] = counts.get(dim, 0) + len(x)
        for dim, total in totals.items():
            high = [Decimal(int(v) // LIMB) for v in total]
            low = [Decimal(int(v) % LIMB) for v in total]
            k = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * k, pa.int32()), pa.array(range(k), pa.int32()),
                 pa.array([counts[dim]] * k, pa.int64()),
                 pa.array(high, pa.decimal128(38)), pa.array(low, pa.decimal128(38))],
                names=["dim", "at", "n", "high", "low"])

    found = vectors.select("_v").mapInArrow(
        run, "dim int, at int, n bigint, high decimal(38,0), low decimal(38,0)")
    out: dict[int, tuple[int, list]] = {}
    for r in found.groupBy("dim", "at").agg(
            F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")) \
            .orderBy("dim", "at").toLocalIterator():
        out.setdefault(r["dim"], (r["n"], []))[1].append(int(r["high"]) * LIMB + int(r["low"]))
    return out


class Model:
    """Mean and whitening projection of the vectors of one length."""

    def __init__(self, n: int, sums: list[int], squares: list[int], components: int):
        dim = len(sums)
        self.n = n
        centre = [s // n for s in sums]
        rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
        self.centre = np.array(centre, np.int64)
        self.rest = np.array(rest, np.int64)
        self.covariance = self._assemble(n, rest, squares)
        values, vectors = np.linalg.eigh(self.covariance)
        values, vectors = values[::-1], vectors[:, ::-1]
        k = min(components, dim)
        top = vectors[:, :k]
        signs = np.sign(top[np.abs(top).argmax(axis=0), np.arange(k)])
        trace = float(np.trace(self.covariance))
        self.values = values[:k]
        self.real = self.values > dim * np.finfo(float).eps * max(trace, 0.0)
        self.weights = top * signs / np.sqrt(np.where(self.real, self.values, np.nan))
        self.explained = [float(v) / trace if trace > 0 else None for v in self.values]
        self.identity_error: float | None = None

    @staticmethod
    def _assemble(n: int, rest: list[int], squares: list[int]) -> np.ndarray:
        """Covariances from variances: ``n * squares - residual^2`` is exactly
        the sum of (n z - sum z)^2 over n; one rounding at the division."""
        dim = len(rest)
        out = np.empty((dim, dim))
        rows, at = [], 0
        for i in range(dim):
            rows.append(squares[at:at + dim - i])
            at += dim - i
        own = [n * rows[i][0] - rest[i] ** 2 for i in range(dim)]
        for i in range(dim):
            out[i, i] = own[i] / (n * n)
            for j in range(i + 1, dim):
                pair = n * rows[i][j - i] - (rest[i] + rest[j]) ** 2
                out[i, j] = out[j, i] = (pair - own[i] - own[j]) / (2 * n * n)
        return out

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(np.float64) - self.rest / self.n) @ self.weights

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sum over the dimensions of (n x - S)^2."""
        d = x - self.centre
        n, dim = self.n, x.shape[1]
        if dim * (n * (int(np.abs(d).max()) + 1)) ** 2 < 1 << 63:
            a = n * d - self.rest
            return (a * a).sum(axis=1).tolist()
        d, r = d.astype(object), self.rest.astype(object)
        a = n * d - r
        return (a * a).sum(axis=1).tolist()


def fit(vectors: DataFrame, components: int = COMPONENTS, vec_col: str = "embedding",
        ) -> dict[int, Model]:
    """{vector length: model} over all usable vectors."""
    src = vectors.select(F.col(f"`{vec_col}`").cast("array<double>").alias("_v"))
    sums = _totals(src, lambda _dim, x: exact_sums(x))
    centres = {dim: np.array([s // n for s in total], np.int64)
               for dim, (n, total) in sums.items()}
    squares = _totals(src, lambda dim, x: polarised_squares(x - centres[dim]))
    models = {dim: Model(n, total, squares[dim][1], components)
              for dim, (n, total) in sums.items()}
    _measure_identity(src, models)
    return models


def _measure_identity(src: DataFrame, models: dict[int, Model]) -> None:
    """The largest absolute entry of cov(whitened rows) minus the identity."""
    def run(batches):
        sums = {}
        for batch in batches:
            for dim, _, x in integer_vectors(batch.column(0)):
                model = models[dim]
                y = model.whiten(x)[:, model.real]
                if y.shape[1]:
                    part = np.vstack((y.sum(axis=0), y.T @ y))
                    sums[dim] = sums[dim] + part if dim in sums else part
        for dim, total in sums.items():
            i, j = (a.ravel() for a in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * total.size, pa.int32()), pa.array(i, pa.int32()),
                 pa.array(j, pa.int32()),
                 pa.array([round(Decimal(float(v)), DIGITS) for v in total.ravel()],
                          pa.decimal128(38, DIGITS))], names=["dim", "i", "j", "v"])

    found = src.mapInArrow(run, f"dim int, i int, j int, v decimal(38,{DIGITS})")
    totals: dict[int, np.ndarray] = {
        dim: np.zeros((int(m.real.sum()) + 1, int(m.real.sum()))) for dim, m in models.items()}
    for r in found.groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect():
        totals[r["dim"]][r["i"], r["j"]] = float(r["v"])
    for dim, total in totals.items():
        if total.shape[1]:
            mean = total[0] / models[dim].n
            cov = total[1:] / models[dim].n - np.outer(mean, mean)
            models[dim].identity_error = float(np.abs(cov - np.eye(len(mean))).max())


def transform(vectors: DataFrame, models: dict[int, Model], id_col: str = "vec_id",
              vec_col: str = "embedding") -> DataFrame:
    """A row per usable vector and component; ``deviation`` is a decimal, null
    beyond 38 digits."""
    src = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"),
                         F.col(f"`{vec_col}`").cast("array<double>").alias("_v"))
    biggest = 10 ** 38

    def run(batches):
        for batch in batches:
            for dim, rows, x in integer_vectors(batch.column(1)):
                m = models[dim]
                k = len(m.values)
                each = pa.array(np.repeat(np.arange(len(rows)), k))
                y = m.whiten(x).ravel()
                deviation = pa.array([Decimal(v) if v < biggest else None
                                      for v in m.deviations(x)], pa.decimal128(38))
                total = len(rows) * k
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)).take(each),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                     pa.array(np.full(total, m.n, np.int64)),
                     deviation.take(each),
                     pa.array(y, mask=np.isnan(y)),
                     pa.array(m.explained * len(rows), pa.float64()),
                     pa.array([m.identity_error] * total, pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"])

    out = src.mapInArrow(run, "vec_id bigint, component int, n bigint, deviation decimal(38,0), "
                              "whitened double, explained double, identity_error double")
    return out.withColumnRenamed("vec_id", id_col)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    return transform(vectors, fit(vectors, components, vec_col), id_col, vec_col)
