"""Embedding whitening by an incremental eigendecomposition.

Entries become whole numbers x = floor(256 * entry). The components are the unit eigenvectors of
the covariance of the distinct x vectors (the fit list, divisor n), numbered by falling eigenvalue. Each task
takes a slice of the fit list and keeps the eigenvalues and eigenvectors of its centred scatter: a vector
adds a rank-one matrix, and the new eigenvalues are the roots of a secular equation between the
old ones. Directions that the vector does not touch, and those of equal eigenvalues after a reflection, are deflated.
Spectra of MERGED slices are joined in a task by as many rank-one updates as there are eigenvectors
and one for the difference of means, level by level until one is left. A last pass over the fit list
gives the covariance in that basis (Rayleigh-Ritz), whose eigenvectors mend what thousands of updates rounded.

A slice holds SLICE vectors, a join MERGED spectra, and the driver sees one spectrum and one matrix of d * d numbers for
vectors of d entries, however long the table is. Equal vectors count once: they are reduced in each task before
the shuffle, so a vector with a third of all rows is a row per task.

Rows whose vector is null, empty, or holds a null or non-finite entry are left out. Vectors of
different lengths are refused (ValueError). Repeated rows, null ids and extra columns do not matter: rows are kept as
they are, and only the vector is read. A component without variance (an eigenvalue below RANK of the trace, as
when the fit list has few vectors) has a null whitened value and is not part of the identity error. Without any
variance the explained shares and the identity error are null. An empty table gives no rows. Equal eigenvalues have no
unique eigenvectors; any orthonormal ones serve. The largest entry of an eigenvector is positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewater.llm.staging import staged

SCALE = 256
SLICE = 4096
MERGED = 8
# Eigenvalues below this share of their sum count as none.
RANK = 1e-12

_EPS = np.finfo(float).eps
_SPECTRUM = "part long, n long, sums array<bigint>, values array<double>, vectors array<double>"


def secular_roots(poles: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots t of 1 + sum(z2 / (poles - t)) = 0, one above each of the rising poles.

    Returns the pole that each root is nearest to and the root's distance from it, so that the difference of a root and
    any pole has full precision. All roots are found at once: each step fits, left and right of every root, a rational function
    with the nearest pole to value and slope, and steps that leave a root's bracket are halved instead.
    """
    k = len(poles)
    above = np.r_[poles[1:], poles[-1] + 1.01 * z2.sum()]
    gap = above - poles
    j = np.arange(k)
    middle = gap / 2
    at_middle = 1 + (z2[:, None] / ((poles[:, None] - poles) - middle)).sum(0)
    right = (at_middle < 0) & (j < k - 1)
    origin = np.where(right, j + 1, j)
    shift = np.where(right, gap, 0.0)
    low = np.where(at_middle < 0, middle, 0.0) - shift
    high = np.where(at_middle < 0, gap, middle) - shift
    delta = poles[:, None] - poles[origin]
    own, after = -shift, gap - shift  # the poles on either side of a root, as seen from its origin
    left = (j[:, None] <= j).astype(float)
    tau = (low + high) / 2
    for _ in range(100):
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            w = 1 / (delta - tau)
            terms = z2[:, None] * w
            slopes = terms * w
            psi, d_psi = (terms * left).sum(0), (slopes * left).sum(0)
            phi, d_phi = terms.sum(0) - psi, slopes.sum(0) - d_psi
            phi[-1], d_phi[-1] = 0.0, 0.0
            f = 1 + psi + phi
            low, high = np.where(f < 0, tau, low), np.where(f < 0, high, tau)
            done = (np.abs(f) <= 4 * _EPS * (1 + np.abs(psi) + np.abs(phi))) | (high - low <= 2 * _EPS * np.abs(tau))
            if done.all():
                break
            d1, d2 = own - tau, after - tau
            s1, s2 = d1 * d1 * d_psi, d2 * d2 * d_phi
            c = 1 + psi - d1 * d_psi + phi - d2 * d_phi
            a, b = c * (d1 + d2) + s1 + s2, d1 * d2 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
            step[-1] = d1[-1] + s1[-1] / c[-1]
            new = tau + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        tau = np.where(done, tau, np.where(inside, new, (low + high) / 2))
    return origin, tau


@dataclass
class Spectrum:
    """n vectors: exact sums, and eigenvalues (rising) and eigenvectors (columns) of their centred scatter."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, np.zeros(d, np.int64), np.zeros(d), np.eye(d))

    def add(self, x: np.ndarray) -> None:
        """One more vector."""
        if self.n:
            self.update(np.sqrt(self.n / (self.n + 1)) * (x - self.sums / self.n))
        self.n += 1
        self.sums = self.sums + x

    def join(self, other: Spectrum) -> None:
        """The vectors of another spectrum."""
        if not other.n or not self.n:
            if other.n:
                self.n, self.sums, self.values, self.vectors = other.n, other.sums, other.values, other.vectors
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(np.sqrt(value) * vector)
        apart = other.sums / other.n - self.sums / self.n
        self.update(np.sqrt(self.n * other.n / (self.n + other.n)) * apart)
        self.n += other.n
        self.sums = self.sums + other.sums

    def update(self, v: np.ndarray) -> None:
        """Add the matrix of rank one v v'."""
        z = self.vectors.T @ v
        norm2 = float(z @ z)
        if norm2 == 0:
            return
        values, vectors = self.values.copy(), self.vectors
        small = 8 * _EPS * max(values[-1], norm2)
        close = np.flatnonzero(np.diff(values) <= small)
        if len(close):
            # A reflection within each run of equal eigenvalues leaves the vector one direction of the run.
            vectors = vectors.copy()
            for run in np.split(close, np.flatnonzero(np.diff(close) > 1) + 1):
                at = slice(run[0], run[-1] + 2)
                u = z[at].copy()
                length = np.linalg.norm(u)
                if length > 0:
                    sign = 1.0 if u[-1] >= 0 else -1.0
                    u[-1] += sign * length
                    vectors[:, at] -= np.outer(vectors[:, at] @ u, 2 * u / (u @ u))
                    z[at] = 0
                    z[at.stop - 1] = -sign * length
        active = np.flatnonzero(np.abs(z) * np.sqrt(norm2) > small)
        if not len(active):
            return
        poles = values[active]
        origin, tau = secular_roots(poles, z[active] ** 2)
        # The vector whose exact roots these are: eigenvectors made from it are orthogonal to full precision.
        apart = (poles[:, None] - poles[origin]) - tau
        between = poles[:, None] - poles
        np.fill_diagonal(between, -1.0)
        exact = np.sqrt(np.abs(np.prod(apart / between, axis=1))) * np.sign(z[active])
        turn = exact[:, None] / apart
        turn /= np.linalg.norm(turn, axis=0)
        values[active] = poles[origin] + tau
        vectors = vectors.copy()
        vectors[:, active] = vectors[:, active] @ turn
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], vectors[:, order]

    def row(self, part: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int64()),
                pa.array([self.n], pa.int64()),
                pa.array([self.sums], pa.list_(pa.int64())),
                pa.array([self.values], pa.list_(pa.float64())),
                pa.array([self.vectors.ravel()], pa.list_(pa.float64())),
            ],
            names=["part", "n", "sums", "values", "vectors"],
        )

    @classmethod
    def of(cls, n: int, sums, values, vectors) -> Spectrum:
        d = len(values)
        return cls(n, np.array(sums, np.int64), np.array(values, float), np.array(vectors, float).reshape(d, d))


def quantised(vector: Column) -> Column:
    """x = floor(256 * entry) of each entry (array<bigint>); null where the vector does not take part."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    return F.when(finite & (F.size(vector) > 0), x)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    spectrum = None
    for batch in batches:
        for x in _matrix(batch.column("x")):
            spectrum = spectrum or Spectrum.empty(len(x))
            spectrum.add(x)
    if spectrum:
        yield spectrum.row(TaskContext.get().partitionId())


def _join_spectra(rows: pa.Table) -> pa.Table:
    spectra = sorted(rows.to_pylist(), key=lambda r: r["part"])
    out = Spectrum.of(*[spectra[0][c] for c in ("n", "sums", "values", "vectors")])
    for r in spectra[1:]:
        out.join(Spectrum.of(r["n"], r["sums"], r["values"], r["vectors"]))
    return pa.Table.from_batches([out.row(spectra[0]["part"] // MERGED)])


def spectrum_of(fit: DataFrame, n: int) -> Spectrum:
    """The spectrum of the n vectors ``x`` of a table that is cheap to read."""
    parts = -(-n // SLICE)
    # Groups of slices are joined until one is left, so that no task holds more than a few spectra.
    spectra = staged(fit.repartition(parts, "x").mapInArrow(_slices, _SPECTRUM), "spectra")
    last = spectra.agg(F.max("part")).first()[0]
    while last:
        grouped = spectra.groupBy(F.floor(F.col("part") / MERGED).alias("slot"))
        spectra, last = staged(grouped.applyInArrow(_join_spectra, _SPECTRUM), "spectra"), last // MERGED
    return Spectrum.of(*spectra.select("n", "sums", "values", "vectors").first())


def _summed(fit: DataFrame, products: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all vectors of a matrix that ``products`` gives for a batch of them."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = products(_matrix(batch.column("x")))
                total = own if total is None else total + own
        if total is not None:
            cells = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "value"])

    cells = fit.mapInArrow(partial, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(shape[0] * shape[1])
    for r in cells.collect():  # as many rows as the matrix has entries
        out[r["cell"]] = r["value"]
    return out.reshape(shape)


@dataclass
class Model:
    """What whitening needs: n and sums of the fit list, the first components, and how good they are."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray  # a column for each component
    explained: list[float | None]
    identity_error: float | None

    @property
    def scaled(self) -> np.ndarray:
        """The components over the roots of their eigenvalues; nan without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.vectors / np.sqrt(np.where(self.values > 0, self.values, np.nan))


def fit(vectors: DataFrame, k: int = 4) -> Model | None:
    """The model of the distinct x of a table with a column ``x`` (null: left out); None without any."""
    seen = Observation()
    distinct = vectors.where(F.col("x").isNotNull()).select("x").distinct()
    size = F.size("x")
    distinct = distinct.observe(seen, F.count(F.lit(1)).alias("n"), F.min(size).alias("least"), F.max(size).alias("most"))
    distinct = staged(distinct, "fit-list")
    n, least, most = (seen.get[c] for c in ("n", "least", "most"))
    if not n:
        return None
    if least != most:
        raise ValueError(f"vectors of {least} to {most} entries")
    spectrum = spectrum_of(distinct, n)
    basis, _ = np.linalg.qr(spectrum.vectors[:, ::-1])
    mean = spectrum.sums / n
    projected = _summed(distinct, lambda x: (y := (x - mean) @ basis).T @ y, basis.shape) / n
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    vectors_ = (basis @ turn)[:, ::-1][:, :k]
    trace = float(np.trace(projected))
    values = values[::-1][:k]
    largest = vectors_[np.abs(vectors_).argmax(0), np.arange(vectors_.shape[1])]
    vectors_ = vectors_ * np.where(largest < 0, -1.0, 1.0)
    values = np.where(values > RANK * trace, values, 0.0)
    explained = [float(v) / trace if trace > 0 else None for v in values]
    model = Model(n, spectrum.sums, values, vectors_, explained, None)
    some = values > 0
    if some.any():
        scaled = model.scaled[:, some]
        moments = _summed(
            distinct,
            lambda x: (y := np.c_[(x - mean) @ scaled, np.ones(len(x))]).T @ y,
            (scaled.shape[1] + 1, scaled.shape[1] + 1),
        )
        means = moments[-1, :-1] / n
        covariance = moments[:-1, :-1] / n - np.outer(means, means)
        model.identity_error = float(np.abs(covariance - np.eye(len(covariance))).max())
    return model


def _deviations(n: int, sums: np.ndarray, x: np.ndarray) -> list[int]:
    """Exact sums of (n * x - sums) ** 2 of each row."""
    most = n * max(int(x.max()), -int(x.min())) + int(np.abs(sums).max()) if x.size else 0
    if most * most * max(1, x.shape[1]) < 1 << 63:
        return ((n * x - sums) ** 2).sum(1).tolist()
    exact = n * x.astype(object) - sums.astype(object)
    return (exact * exact).sum(1).tolist()


def whiten(x: Column, model: Model) -> Column:
    """struct<deviation decimal(38,0), whitened array<double>> of a column of x vectors; null for a null one."""
    n, sums, mean, scaled = model.n, model.sums, model.sums / model.n, model.scaled
    kind = pa.struct([("deviation", pa.decimal128(38, 0)), ("whitened", pa.list_(pa.float64()))])

    def of_batch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            there = ~np.asarray(rows.is_null())
            held = rows.filter(pa.array(there))
            vectors = _matrix(held) if len(held) else np.zeros((0, len(sums)), np.int64)
            out = np.full((len(rows), scaled.shape[1]), np.nan)
            out[there] = (vectors - mean) @ scaled
            apart = iter(_deviations(n, sums, vectors))
            deviation = pa.array([next(apart) if t else None for t in there.tolist()], pa.decimal128(38, 0))
            flat = pa.array(out.ravel(), pa.float64(), mask=np.isnan(out.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * scaled.shape[1]), flat)
            yield pa.StructArray.from_arrays([deviation, lists], fields=list(kind), mask=pa.array(~there))

    of_batch.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(of_batch, "struct<deviation:decimal(38,0),whitened:array<double>>")(x)


def whitened(rows: DataFrame, vector: str = "embedding", k: int = 4) -> DataFrame:
    """A row for each row that takes part and component: ``row`` has all columns but the vector; ``component``, ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error`` are the results."""
    carried = [F.col(f"`{c}`") for c in rows.columns if c != vector]
    taking = rows.select(F.struct(*carried).alias("row"), quantised(F.col(f"`{vector}`")).alias("x"))
    model = fit(taking, k)
    columns = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    if model is None:
        kinds = ("int", "long", "decimal(38,0)", "double", "double", "double")
        none = [F.lit(None).cast(kind).alias(c) for c, kind in zip(columns, kinds)]
        return taking.where(F.lit(False)).select("row", *none)
    done = taking.where(F.col("x").isNotNull()).select("row", whiten(F.col("x"), model).alias("done"))
    each = done.select("row", "done.deviation", F.posexplode("done.whitened").alias("place", "whitened"))
    explained = F.element_at(F.array(*[F.lit(e).cast("double") for e in model.explained]), F.col("place") + 1)
    return each.select(
        "row",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
