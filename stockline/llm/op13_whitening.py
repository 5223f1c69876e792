"""Embedding whitening by incremental eigendecomposition.

1. Every task keeps the spectrum (eigenvalues and eigenvectors) of the scatter
   matrix of its rows and applies each row, centred on the mean so far, as a
   rank-one update: the new eigenvalues are the roots of the secular equation,
   each found in its own interval; directions that the update does not touch and
   equal eigenvalues are deflated first; the eigenvectors follow from the roots
   with the update vector that has them exactly, so they stay orthogonal. Equal
   rows of a batch are one update with their number as weight.
2. Spectra are combined in a tree of groups of ``FAN_IN``: the eigenvectors of
   one, scaled, and the difference of the means are rank-one updates of the other.
3. One more pass projects every centred row on the combined basis and sums the
   products (Rayleigh-Ritz); the eigenvectors of that nearly diagonal matrix turn
   the basis into the components, to double precision. A last pass measures the
   covariance of the whitened rows.

What travels or reaches the driver are matrices of d x d numbers for vectors of
d dimensions, one a task, whatever the number of rows. Components are scaled to
integers, so counts, sums and centred rows (n*x - sum, over n) are exact.

Handling: a row whose vector is null or holds a null or non-finite component (or
one that reaches 2^31 when scaled) is dropped; shorter vectors count as filled
with zeros; equal rows and equal or null ids are rows of their own; components
whose eigenvalue is zero but for rounding (constant or dependent dimensions, a
single row, equal rows only) have no whitened form and are not returned; an empty
table gives an empty result; a ``deviation`` beyond a long is null; extra columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, release

#: Spectra merged by one task of a level; rows taken at once.
FAN_IN, AT_ONCE = 16, 4_096
EPS = np.finfo(np.float64).eps
#: Scaled components from here on count as not finite.
LARGEST = 1 << 31


# ---- rank-one updates ------------------------------------------------------

def secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(w / (d - x)) for rising distinct ``d`` and w > 0, one
    right of each d. Returned as the matrix d[i] - root[j], computed from the
    pole next to each root so that small differences keep their digits, and the
    roots."""
    k = len(d)
    right = np.append(d[1:], d[-1] + w.sum())
    gap = right - d
    at = np.arange(k)
    away = d[:, None] - d[None, :]
    # the half of the interval that holds the root tells its origin
    mid = 1 + (w[:, None] / (away - gap / 2)).sum(0)
    from_right = (mid < 0) & (at < k - 1)
    origin = np.where(from_right, right, d)
    away = d[:, None] - origin[None, :]
    low = np.where(from_right, -gap / 2, np.where(mid < 0, gap / 2, 0))
    high = np.where(from_right, 0, np.where(mid < 0, gap, gap / 2))
    x = (low + high) / 2
    left_pole = np.where(from_right, -gap, 0)
    below = np.triu(np.broadcast_to(w[:, None], (k, k)))  # weights of the poles left of each root
    for _ in range(40):
        inverse = 1 / (away - x)
        f, left_part = 1 + w @ inverse, np.einsum("ij,ij->j", below, inverse)
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        # left terms are negative, right ones positive: their sizes add up to f - 1 - 2 * left_part
        done = np.abs(f) <= 8 * EPS * (f - 2 * left_part)
        if done.all():
            break
        inverse *= inverse
        total, psi = w @ inverse, np.einsum("ij,ij->j", below, inverse)
        # two-pole model of f: both neighbours of the root, weights from the slopes
        l, r = left_pole - x, left_pole + gap - x  # noqa: E741
        c = f - l * psi - r * (total - psi)
        a = (l + r) * f - l * r * total
        b = l * r * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        new = x + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = np.where((new > low) & (new < high), new, (low + high) / 2)
        if (new == x).all():
            break
        x = np.where(done, x, new)
    return away - x, origin + x


@np.errstate(divide="ignore", invalid="ignore", over="ignore")
def rank_one(d: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of q diag(d) q' + v v' for rising ``d``."""
    z = q.T @ v
    size = np.sqrt(z @ z)
    if not size:
        return d, q
    tiny = 4 * EPS * (d[-1] + size * size)
    d, fresh = d.copy(), False
    # equal eigenvalues: turn the pair so that only one of them is touched
    live = np.flatnonzero(z * z > tiny * EPS * 16)
    near = live[:-1][np.diff(d[live]) <= tiny] if len(live) > 1 else ()
    if len(near):
        q, fresh = q.copy(), True
        held = live[0]
        for i in live[1:]:
            if d[i] - d[held] <= tiny:
                r = np.hypot(z[held], z[i])
                c, s = z[i] / r, z[held] / r
                q[:, held], q[:, i] = c * q[:, held] - s * q[:, i], s * q[:, held] + c * q[:, i]
                z[i], z[held] = r, 0.0
            held = i
        live = np.flatnonzero(z * z > tiny * EPS * 16)
    if not len(live):
        return d, q
    p, w = d[live], z[live] ** 2
    apart, roots = secular_roots(p, w)
    # the vector whose update has exactly these roots
    poles = p[:, None] - p[None, :]
    np.fill_diagonal(poles, -1.0)
    exact = np.sqrt(np.abs(np.prod(apart / poles, axis=1))) * np.sign(z[live])
    turn = exact[:, None] / apart
    turn /= np.sqrt((turn * turn).sum(0))
    if len(live) == len(d):
        return roots, q @ turn
    q = q if fresh else q.copy()
    q[:, live] = q[:, live] @ turn
    d[live] = roots
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


@dataclass
class Spectrum:
    """Count, exact sums and the spectrum of the scatter matrix of some rows."""

    n: int
    sums: np.ndarray
    d: np.ndarray
    q: np.ndarray

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, np.zeros(width, np.int64), np.zeros(width), np.eye(width))

    def add(self, x: np.ndarray, times: int) -> None:
        """``times`` rows equal to ``x``."""
        if self.n:
            v = (self.n * x - self.sums) / self.n
            self.d, self.q = rank_one(self.d, self.q, v * np.sqrt(self.n * times / (self.n + times)))
        self.n, self.sums = self.n + times, self.sums + times * x

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        if not self.n:
            self.n, self.sums, self.d, self.q = other.n, other.sums, other.d, other.q
            return
        apart = self.sums / self.n - other.sums / other.n
        for scale, direction in zip(other.d, other.q.T, strict=True):
            if scale > 0:
                self.d, self.q = rank_one(self.d, self.q, np.sqrt(scale) * direction)
        self.d, self.q = rank_one(self.d, self.q, apart * np.sqrt(self.n * other.n / (self.n + other.n)))
        self.n, self.sums = self.n + other.n, self.sums + other.sums

    def row(self, part: int) -> dict:
        return {"part": part, "n": self.n, "sums": self.sums.tobytes(), "d": self.d.tobytes(),
                "q": np.ascontiguousarray(self.q).tobytes()}

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        d = np.frombuffer(row["d"])
        return cls(row["n"], np.frombuffer(row["sums"], np.int64), d, np.frombuffer(row["q"]).reshape(len(d), len(d)))


SPECTRUM = "part int, n long, sums binary, d binary, q binary"
SPECTRUM_TYPE = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("sums", pa.binary()), ("d", pa.binary()), ("q", pa.binary())])
MOMENTS = "part int, total binary, products binary"
MOMENTS_TYPE = pa.schema([("part", pa.int32()), ("total", pa.binary()), ("products", pa.binary())])


# ---- over DataFrames -------------------------------------------------------

def usable(vectors: DataFrame, factor: int = 64, offset: int = 1_000_000, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """(vec_id, x): x = floor(factor * c) + offset of the rows that take part."""
    c = F.col(vector)
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double") * factor) >= float(LARGEST)))
    x = F.transform(c, lambda v: F.floor(F.lit(float(factor)) * v.cast("double")) + F.lit(offset).cast("long"))
    return vectors.select(F.col(vec_id).alias("vec_id"), F.when(c.isNotNull() & ~bad, x).alias("x")).filter("x is not null")


def _matrix(column: pa.Array, width: int, fill: int) -> np.ndarray:
    """Lists of a batch as rows; missing entries at the end are ``fill``."""
    flat, lengths = column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.full((len(lengths), width), fill, np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _slices(batches, width: int, fill: int):
    for b in batches:
        for s in range(0, b.num_rows, AT_ONCE):
            part = b.slice(s, AT_ONCE)
            yield part, _matrix(part.column("x"), width, fill)
    release()


def _tree(parts: DataFrame, count: int, merge, schema: str) -> dict | None:
    """Merge rows (part, ...) in groups of FAN_IN until one is left."""
    while count > 1:
        parts = (parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("part")
                 .applyInArrow(merge, schema))
        count = -(-count // FAN_IN)
    row = parts.first()
    return row.asDict() if row else None


def _merge_spectra(table: pa.Table) -> pa.Table:
    rows = table.sort_by([("n", "descending"), ("sums", "ascending")]).to_pylist()
    whole = Spectrum.of(rows[0])
    for row in rows[1:]:
        whole.merge(Spectrum.of(row))
    release()
    return pa.Table.from_pylist([whole.row(rows[0]["part"])], SPECTRUM_TYPE)


def _merge_moments(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["products"])  # one order, one sum
    out = {c: np.sum([np.frombuffer(r[c]) for r in rows], axis=0).tobytes() for c in ("total", "products")}
    return pa.Table.from_pylist([{"part": rows[0]["part"], **out}], MOMENTS_TYPE)


def _numbered(parts: DataFrame) -> tuple[DataFrame, int]:
    """Rows of tasks, in the shared folder, with the task's number as part."""
    parts = cut(parts.withColumn("part", F.spark_partition_id()))
    most = parts.agg(F.max("part")).first()[0]
    return parts, 0 if most is None else most + 1


@dataclass
class Whitening:
    """What ``fit`` finds: centre ``sums / n``, unit eigenvectors of the
    covariance as columns, their eigenvalues (falling) and all eigenvalues' sum."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    fill: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.eigenvalues)


def spectrum(rows: DataFrame, width: int, fill: int) -> Spectrum | None:
    """Spectrum of the scatter matrix of all rows (vec_id, x)."""
    def each(batches):
        own = Spectrum.empty(width)
        for _, x in _slices(batches, width, fill):
            for row, times in zip(*np.unique(x, axis=0, return_counts=True), strict=True):
                own.add(row, int(times))
        if own.n:
            yield pa.RecordBatch.from_pylist([own.row(0)], SPECTRUM_TYPE)

    parts, count = _numbered(rows.select("x").mapInArrow(each, SPECTRUM))
    found = _tree(parts, count, _merge_spectra, SPECTRUM)
    return Spectrum.of(found) if found else None


def moments(rows: DataFrame, width: int, fill: int, project) -> tuple[np.ndarray, np.ndarray]:
    """Sum and sum of products of project(x) over all rows."""
    def each(batches):
        total, products = 0.0, 0.0
        for _, x in _slices(batches, width, fill):
            y = project(x)
            total, products = total + y.sum(0), products + y.T @ y
        if np.ndim(total):
            yield pa.RecordBatch.from_pylist([{"part": 0, "total": total.tobytes(), "products": products.tobytes()}], MOMENTS_TYPE)

    parts, count = _numbered(rows.select("x").mapInArrow(each, MOMENTS))
    found = _tree(parts, count, _merge_moments, MOMENTS)
    total = np.frombuffer(found["total"])
    return total, np.frombuffer(found["products"]).reshape(len(total), len(total))


def fit(rows: DataFrame, components: int = 32, fill: int = 1_000_000) -> Whitening | None:
    """The whitening of all rows (vec_id, x), None without rows or spread."""
    width = rows.agg(F.max(F.size("x"))).first()[0]
    whole = spectrum(rows, width, fill) if width else None
    if whole is None:
        return None
    basis, _ = np.linalg.qr(whole.q)
    centre = Whitening(whole.n, whole.sums, basis, np.ones(width), 0.0, fill)
    _, products = moments(rows, width, fill, centre.whitened)
    values, turn = np.linalg.eigh(products / whole.n)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    kept = min(components, int((values > 4 * width * EPS * max(values[0], 0)).sum()))
    vectors = vectors[:, :kept]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(kept)] < 0, -1, 1)
    return Whitening(whole.n, whole.sums, vectors, values[:kept].copy(), float(values.sum()), fill) if kept else None


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    total, products = moments(rows, len(w.sums), w.fill, w.whitened)
    mean = total / w.n
    return float(np.abs(products / w.n - np.outer(mean, mean) - np.eye(len(mean))).max())


def deviations(c: np.ndarray) -> pa.Array:
    """Exact sums of squares of integer rows; null beyond a long."""
    if int(np.abs(c).max(initial=0)) ** 2 * max(c.shape[1], 1) < 1 << 63:
        return pa.array((c * c).sum(1))
    exact = [sum(int(v) ** 2 for v in row) for row in c]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(rows: DataFrame, components: int = 32, fill: int = 1_000_000) -> DataFrame:
    """One row per row and component: vec_id, component, n, deviation, whitened,
    explained and identity_error."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    w = fit(rows, components, fill)
    if w is None:
        return rows.sparkSession.createDataFrame([], schema)
    error, kept = identity_error(rows, w), len(w.eigenvalues)
    explained = w.eigenvalues / w.trace

    def each(batches):
        for b, x in _slices(batches, len(w.sums), w.fill):
            k = len(x)
            at = pa.array(np.repeat(np.arange(k), kept))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(at), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), k)),
                 pa.array(np.full(k * kept, w.n)), deviations(w.n * x - w.sums).take(at), pa.array(w.whitened(x).ravel()),
                 pa.array(np.tile(explained, k)), pa.array(np.full(k * kept, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(each, schema)
