"""Embedding whitening by spectral divide and conquer on polar decompositions.

Entries become integers, ``x = floor(256 * c)``.  The fit list holds every distinct x vector
once; Spark aggregates its size, its exact sums and its centred second moments.  The
covariance has as many cells as the dimension squared, whatever the number of rows, and is
taken apart on the driver: the polar factor of the covariance shifted by its mean eigenvalue
(QR-based, dynamically weighted Halley iterations) is a matrix sign, so half of sign plus
identity projects on the eigenvectors above the shift.  Its range and complement are two
smaller symmetric problems, split again until each holds one eigenvalue.  Only parts that hold
wanted components are split.  The projection is then broadcast and applied to all rows.

Defined cases: rows whose vector is null, empty or holds a null, NaN or infinite entry are
dropped, and so are vectors whose length is not the most frequent one (the longer on ties);
an empty table, or one without a usable vector, gives an empty result; repeated rows and null
ids are returned each; ties between eigenvalues leave any orthonormal basis of their space;
a component without variance has a null ``whitened`` and takes no part in ``identity_error``
(null if there is none with variance), ``explained`` is null if nothing varies; ``deviation``
is null where it exceeds 64 bits.  Only id and vector are read, so extra columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, store, table

SCALE = 256
COMPONENTS = 4
_EPS = float(np.finfo(float).eps)


# ------------------------------------------------------------- driver: d x d matrices


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix; for one without eigenvalue 0, its sign."""
    m = len(a)
    eye = np.eye(m)
    x = a / np.linalg.norm(a)
    low = max(float(np.abs(np.diag(np.linalg.qr(x, mode="r"))).min()) / (2 * m), _EPS)
    for _ in range(40):
        gamma = np.cbrt(4 * max(1 - low * low, 0) / low**4)
        root = np.sqrt(1 + gamma)
        k = root + np.sqrt(8 - 4 * gamma + 8 * (2 - low * low) / (low * low * root)) / 2
        b = (k - 1) ** 2 / 4
        c = k + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
        new = (b / c) * x + (k - b / c) / np.sqrt(c) * (q[:m] @ q[m:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        low = min(low * (k + b * low * low) / (1 + c * low * low), 1.0)
        if 1 - low < 10 * _EPS and moved < np.cbrt(5 * _EPS):
            return x
    return x


def split_space(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors of ``a`` above and below its mean eigenvalue.

    None where all eigenvalues are equal to rounding.
    """
    m = len(a)
    eye = np.eye(m)
    mean = np.trace(a) / m
    spread = np.linalg.norm(a - mean * eye)
    if spread <= 4 * _EPS * m * max(abs(mean), np.linalg.norm(a) / m):
        return None
    random = np.random.default_rng(m)
    best = None
    # an eigenvalue may lie on the shift itself: shifts beside it follow
    for off in (0.0, 0.11, -0.13, 0.03, -0.05, 0.007, -0.011):
        p = (polar_factor(a - (mean + off * spread / np.sqrt(m)) * eye) + eye) / 2
        k = int(round(np.trace(p)))
        if not 0 < k < m:
            continue
        basis = random.standard_normal((m, k))
        for _ in range(3):
            q, _ = np.linalg.qr(p @ basis, mode="complete")
            basis = q[:, :k]
        coupled = np.linalg.norm(q[:, k:].T @ a @ basis)
        if best is None or coupled < best[0]:
            best = (coupled, basis, q[:, k:])
        if coupled <= 8 * _EPS * m * np.linalg.norm(a):
            break
    return None if best is None else best[1:]


def components_of(cov: np.ndarray, wanted: int) -> np.ndarray:
    """Columns: unit eigenvectors of the ``wanted`` largest eigenvalues, falling."""
    found: list[np.ndarray] = []
    parts = [np.eye(len(cov))]  # a stack, largest eigenvalues on top
    while parts and len(found) < wanted:
        v = parts.pop()
        inner = v.T @ cov @ v
        halves = split_space((inner + inner.T) / 2) if v.shape[1] > 1 else None
        if halves is None:
            found += list(v.T)
        else:
            parts += [v @ halves[1], v @ halves[0]]
    out, _ = np.linalg.qr(np.array(found[:wanted]).T)
    values = np.einsum("ij,ij->j", out, cov @ out)
    return out[:, np.argsort(-values, kind="stable")]


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: everything a task needs, as large as a few vectors."""

    n: int
    sums: list[int]
    directions: np.ndarray  # d x k
    values: np.ndarray  # eigenvalues, k
    explained: list[float | None]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def scale(self) -> np.ndarray:
        """1 / sqrt(eigenvalue); NaN for a component without variance."""
        return np.array([e**-0.5 if x else np.nan for e, x in zip(self.values, self.explained)])

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.directions * self.scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)^2 of each row, exact."""
        if not len(x):
            return []
        reach = max(abs(int(x.min())), abs(int(x.max()))) * self.n + max(map(abs, self.sums))
        if reach * reach * x.shape[1] < 2**63:
            off = self.n * x - np.array(self.sums, dtype=np.int64)
            return np.einsum("ij,ij->i", off, off).tolist()
        wide = (sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x)
        return [w if w < 2**63 else None for w in wide]


# ------------------------------------------------------------------- Spark: the rows


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<bigint>) of the usable vectors."""
    usable = (
        "size(v) > 0 AND forall(v, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))")
    v = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    x = v.where("v IS NOT NULL").where(usable).select("vec_id", F.expr(f"transform(v, c -> floor({SCALE}D * c) + 0L)").alias("x"))
    length = F.struct("n", "d")
    dims = x.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).agg(F.max(length).alias("m")).first()["m"]
    return x.where(F.size("x") == (dims["d"] if dims else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """A batch of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(fit: DataFrame, cells, dtype: str) -> dict[int, object]:
    """Sums over all rows of what ``cells(matrix)`` gives per batch, added per task and then
    by Spark; as many values reach the driver as there are cells."""

    def partial(batches):
        total = None
        for b in batches:
            if b.num_rows:
                part = cells(_matrix(b.column(0))).ravel()
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total.tolist(), kind)], ["cell", "v"])

    kind = pa.decimal128(38, 0) if dtype.startswith("decimal") else pa.float64()
    sums = fit.select("x").mapInArrow(partial, f"cell int, v {dtype}").groupBy("cell").agg(F.sum("v").alias("v"))
    return {r["cell"]: r["v"] for r in sums.collect()}


def _square(cells: dict[int, float], d: int) -> np.ndarray:
    out = np.array([cells[i] for i in range(d * d)]).reshape(d, d)
    return (out + out.T) / 2


def _exact_sums(x: np.ndarray) -> np.ndarray:
    # sums of halves cannot overflow within a batch; Python integers after that
    high, low = x >> 32, x & 0xFFFFFFFF
    return high.sum(axis=0).astype(object) * 2**32 + low.sum(axis=0).astype(object)


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of a stored list of distinct x vectors; None if it is empty."""
    n = fit.count()
    if n == 0:
        return None
    sums = _summed(fit, _exact_sums, "decimal(38,0)")
    d = len(sums)
    totals = [int(sums[i]) for i in range(d)]
    mean = np.array([s / n for s in totals])

    def moments(x):
        off = x - mean
        return off.T @ off

    cov = _square(_summed(fit, moments, "double"), d) / n
    directions = components_of(cov, min(components, d))
    values = np.einsum("ij,ij->j", directions, cov @ directions)
    trace = float(np.trace(cov))
    flat = 4 * _EPS * d * trace
    explained = [float(e) / trace if e > flat else 0.0 for e in values] if trace > 0 else [None] * len(values)
    return Whitening(n, totals, directions, values, explained)


def identity_error(fit: DataFrame, w: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    used = [j for j, e in enumerate(w.explained) if e]
    if not used:
        return None
    sums = _summed(fit, lambda x: w.project(x)[:, used].sum(axis=0), "double")
    mean = np.array([sums[j] for j in range(len(used))]) / w.n

    def moments(x):
        off = w.project(x)[:, used] - mean
        return off.T @ off

    cov = _square(_summed(fit, moments, "double"), len(used)) / w.n
    return float(np.abs(cov - np.eye(len(used))).max())


OUT_SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def whiten(spark: SparkSession, rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component (contract of the module docstring)."""
    ship(spark)
    x = integer_vectors(rows)
    fit = store(spark, x.select("x").distinct(), "whitening-fit")
    w = fit_whitening(fit, components)
    if w is None:
        return spark.createDataFrame([], OUT_SCHEMA)
    error = identity_error(fit, w)
    fitted = spark.sparkContext.broadcast(w)

    def apply(batches):
        w = fitted.value
        k = len(w.values)
        explained = pa.array(w.explained, pa.float64())
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            matrix = _matrix(b.column(1))
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, w.n)),
                pa.array(w.deviations(matrix), pa.int64()).take(pa.array(each)),
                pa.array(w.project(matrix).ravel(), from_pandas=True),
                explained.take(pa.array(np.tile(np.arange(k), m))),
                pa.array([error] * (m * k), pa.float64()),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(apply, OUT_SCHEMA)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark, table(spark, sf_dir, "embeddings"))
