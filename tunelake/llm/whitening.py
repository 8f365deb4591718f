"""Whitening of embeddings by incremental eigendecomposition.

The spectrum of some vectors is their number, their mean and the eigenvalues and eigenvectors of their
scatter, the sum of the products of centred vectors. A partition grows its spectrum by rank-one updates:
in the basis of the eigenvectors an update is a diagonal matrix plus ``z z'``, whose eigenvalues are the
roots of the secular equation

    1 + sum_i z_i^2 / (d_i - x) = 0,

one between each two of the old ones. Directions in which ``z`` is nothing, and all but one of those with
equal eigenvalues (after a rotation), keep theirs: they are deflated. The eigenvectors come from the
``z`` for which the roots found are exact, which keeps them orthogonal. Vectors come in blocks; one with
more rows than dimensions is first condensed by a QR decomposition to as many centred rows as there are
dimensions, which have the same scatter, so the number of updates does not follow the number of rows.
Two spectra become one by an update for each eigenvector of the second and one for the distance of the
means; they meet in groups of ``FAN`` until one is left.

That basis is refined by one Rayleigh-Ritz step: a pass over all vectors sums the products of their
projections, centred at the exact mean, and the eigenvectors of that small, almost diagonal matrix turn
the basis into the final components. What is broadcast and gathered has the size of a square of the
dimension, whatever the number of rows.

Whole numbers: ``floor(1024 c) + 100000`` of each entry, at most 2**53; sums are exact. A deviation
beyond 64 bits is held at the border.

Defined results: vectors that are null, empty, or hold a null or non-finite entry take no part; of
several lengths the most frequent takes part (of equally frequent ones the longest); a null or repeated
id stays as it is, and repeated rows count as often as they are there; a component without variance has no
whitened value (null), nor an entry in the identity error, and nothing is explained (null) where no
component has any; ties of eigenvalues leave the choice of components open; an empty table gives an
empty table; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tunelake.session import ship_package, written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Vectors in a block (16 for each dimension, if that is more), and spectra that meet in a task.
BLOCK_ROWS, FAN = 2048, 8

_EPS = np.finfo(np.float64).eps
_ROUNDS = 60


def _roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of the secular equation: the place of the nearest pole, and the distance from it.

    ``d`` rises strictly and ``z2`` is positive. Each root is bracketed by two poles; the equation's
    two sides are fitted by one pole each, and a step that leaves its bracket becomes a bisection.
    """
    count = len(d)
    ends = np.append(d[1:], d[-1] + z2.sum())
    middle = d + (ends - d) / 2
    at_middle = 1 + (z2 / (d[None, :] - middle[:, None])).sum(axis=1)
    near_end = (at_middle < 0) & (np.arange(count) < count - 1)
    nearest = np.arange(count) + near_end
    poles = d[None, :] - d[nearest][:, None]  # seen from the nearest pole
    width = ends - d
    low = np.where(near_end, -width / 2, 0.0)
    high = np.where(near_end, 0.0, np.where(at_middle < 0, width, width / 2))
    low = np.where(~near_end & (at_middle < 0), width / 2, low)
    left, right = np.where(near_end, -width, 0.0), np.where(near_end, 0.0, width)
    before = np.tri(count, dtype=bool)
    x = (low + high) / 2
    for _ in range(_ROUNDS):
        gaps = poles - x[:, None]
        terms = z2 / gaps
        slopes = terms / gaps
        value = 1 + terms.sum(axis=1)
        low, high = np.where(value < 0, x, low), np.where(value > 0, x, high)
        psi, phi = (slopes * before).sum(axis=1), (slopes * ~before).sum(axis=1)
        a, b = left - x, right - x
        c = value - a * psi - b * phi
        linear = c * (a + b) + a * a * psi + b * b * phi
        root = np.sqrt(np.maximum(linear * linear - 4 * c * a * b * value, 0))
        with np.errstate(all="ignore"):
            step = np.where(linear > 0, 2 * a * b * value / (linear + root), (linear - root) / (2 * c))
        tried = x + step
        inside = np.isfinite(tried) & (tried > low) & (tried < high)
        following = np.where(inside, tried, (low + high) / 2)
        done = (np.abs(following - x) <= 2 * _EPS * np.abs(x)) | (value == 0)
        x = np.where(value == 0, x, following)
        if done.all():
            break
    return nearest, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of ``vectors diag(values) vectors' + v v'``."""
    z = vectors.T @ v
    length = np.sqrt(z @ z)
    if not length:
        return values, vectors
    largest = max(np.abs(values).max(), length * length)
    tiny = 8 * _EPS * largest
    order = np.argsort(values, kind="stable")
    values, vectors, z = values[order].copy(), vectors[:, order].copy(), z[order]
    active: list[int] = []
    for i in range(len(z)):
        if abs(z[i]) * length <= tiny:
            continue
        if active and values[i] - values[active[-1]] <= tiny:
            j = active.pop()  # equal eigenvalues: turn the plane so that one of the two has no z
            r = np.hypot(z[i], z[j])
            c, s = z[i] / r, z[j] / r
            first, second = vectors[:, j].copy(), vectors[:, i].copy()
            vectors[:, j], vectors[:, i] = c * first - s * second, s * first + c * second
            low, high = values[j], values[i]
            values[j], values[i] = c * c * low + s * s * high, s * s * low + c * c * high
            z[i], z[j] = r, 0.0
        active.append(i)
    if active:
        d, own = values[active], z[active]
        nearest, x = _roots(d, own * own)
        gaps = (d[nearest][:, None] - d[None, :]) + x[:, None]  # root minus pole
        others = d[:, None] - d[None, :]
        np.fill_diagonal(others, 1.0)
        z2 = np.abs(np.prod(gaps / others, axis=0))
        fitted = np.copysign(np.sqrt(z2), own)
        turned = fitted[None, :] / -gaps
        turned /= np.linalg.norm(turned, axis=1, keepdims=True)
        values[active] = d[nearest] + x
        vectors[:, active] = vectors[:, active] @ turned.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number, mean, and eigenvalues and eigenvectors of the scatter of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> Spectrum:
        return cls(0, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def _update(self, v: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, v)

    def _joined(self, n: int, mean: np.ndarray) -> None:
        """Room for ``n`` more vectors of that mean, whose own scatter is added apart."""
        apart, both = mean - self.mean, self.n + n
        if self.n:
            self._update(np.sqrt(self.n * n / both) * apart)
        self.mean, self.n = self.mean + apart * (n / both), both

    def add(self, rows: np.ndarray) -> None:
        """One update for each row; of a block with more rows than dimensions, for each condensed row."""
        if len(rows) <= rows.shape[1]:
            for row in rows:
                self._joined(1, row)
            return
        mean = rows.mean(axis=0)
        self._joined(len(rows), mean)
        for row in np.linalg.qr(rows - mean, mode="r"):
            self._update(row)

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        self._joined(other.n, other.mean)
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self._update(np.sqrt(value) * vector)

    def packed(self) -> bytes:
        return np.concatenate([self.mean, self.values, self.vectors.ravel()]).tobytes()

    @classmethod
    def unpacked(cls, n: int, raw: bytes, dims: int) -> Spectrum:
        flat = np.frombuffer(raw, np.float64)
        return cls(n, flat[:dims].copy(), flat[dims : 2 * dims].copy(), flat[2 * dims :].reshape(dims, dims).copy())


def whole(vectors: pa.Array, dims: int) -> np.ndarray:
    """Rows of whole numbers of list arrays of that length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
    return np.clip(np.floor(SCALE * flat) + SHIFT, -(2.0**53), 2.0**53).astype(np.int64)


def _sums(x: np.ndarray) -> list[int]:
    """Exact sums of the columns."""
    if len(x) * float(np.abs(x).max(initial=0)) < 2.0**62:
        return x.sum(axis=0).tolist()
    return x.astype(object).sum(axis=0).tolist()


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """For each row the sum over dimensions of (n x - S)^2, exact."""
    most = n * float(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most < 2.0**62:
        apart = x * n - np.array(sums, np.int64)
        if float(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
            return (apart * apart).sum(axis=1)
    apart = x.astype(object) * n - np.array(sums, object)
    return np.array([min(int(s), 2**63 - 1) for s in (apart * apart).sum(axis=1)], np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, column: int = 0) -> Iterator[np.ndarray]:
    """Whole numbers in blocks of bounded size."""
    size = max(BLOCK_ROWS, 16 * dims)
    waiting: list[np.ndarray] = []
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            waiting.append(whole(batch.column(column).slice(start, size), dims))
            if sum(map(len, waiting)) >= size:
                yield np.concatenate(waiting)
                waiting = []
    if waiting:
        yield np.concatenate(waiting)


_PART = "part int, n long, sums array<string>, state binary"
_PART_ARROW = pa.schema(
    {"part": pa.int32(), "n": pa.int64(), "sums": pa.list_(pa.string()), "state": pa.binary()}
)
Part = tuple[int, list[int], bytes]


def _combined(parts: DataFrame, merge: Callable[[Part, Part], Part], label: str) -> Part | None:
    """All ``parts`` (a row for each partition) as one, merged in groups of ``FAN``."""
    parts = written(parts, label)
    last = parts.agg(F.max("part")).first()[0]
    if last is None:
        return None

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        total = None
        for row in rows.sort_values("part").itertuples():
            one = (int(row.n), [int(s) for s in row.sums], bytes(row.state))
            total = one if total is None else merge(total, one)
        n, sums, state = total
        return pd.DataFrame(
            {"part": [int(rows["part"].iloc[0]) // FAN], "n": [n], "sums": [[str(s) for s in sums]], "state": [state]}
        )

    while last:
        parts = parts.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(meet, _PART)
        last //= FAN
    row = parts.first()
    return row["n"], [int(s) for s in row["sums"]], bytes(row["state"])


def _by_partition(rows: DataFrame, start: Callable[[], object], add: Callable, packed: Callable, dims: int) -> DataFrame:
    """One row for each partition with vectors: their number, exact sums and what ``add`` made of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, state = 0, [0] * dims, start()
        for block in _blocks(batches, dims):
            n, sums = n + len(block), [a + b for a, b in zip(sums, _sums(block))]
            state = add(state, block)
        if n:
            yield pa.RecordBatch.from_pylist(
                [{"part": TaskContext.get().partitionId(), "n": n, "sums": [str(s) for s in sums],
                  "state": packed(state)}],
                _PART_ARROW,
            )

    return rows.mapInArrow(run, _PART)


@dataclass
class Whitener:
    """What whitening needs: the exact mean, the components and their eigenvalues, largest first."""

    dims: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def usable(self, components: int) -> np.ndarray:
        """Which of the first components have variance."""
        least = 8 * self.dims * _EPS * max(self.values[0], 0.0)
        return self.values[: min(components, self.dims)] > least

    def whitened(self, x: np.ndarray, components: int) -> np.ndarray:
        """A column for each component; NaN where it has no variance."""
        use = self.usable(components)
        scale = np.sqrt(np.where(use, self.values[: len(use)], np.nan))
        return (x - self.mean) @ self.vectors[:, : len(use)] / scale


def _vectors(df: DataFrame, vector: str) -> DataFrame:
    """The rows that take part but for their length."""
    finite = F.forall(
        F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    )
    return df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)))


def incremental(rows: DataFrame, dims: int) -> tuple[int, list[int], Spectrum] | None:
    """Number, exact sums and spectrum of the vectors in the only column of ``rows``."""

    def add(state: Spectrum, block: np.ndarray) -> Spectrum:
        state.add(block.astype(np.float64))
        return state

    def merge(a: Part, b: Part) -> Part:
        both = Spectrum.unpacked(a[0], a[2], dims)
        both.merge(Spectrum.unpacked(b[0], b[2], dims))
        return both.n, [x + y for x, y in zip(a[1], b[1])], both.packed()

    parts = _by_partition(rows, lambda: Spectrum.empty(dims), add, Spectrum.packed, dims)
    found = _combined(parts, merge, "spectra")
    return found and (found[0], found[1], Spectrum.unpacked(found[0], found[2], dims))


def _products(rows: DataFrame, dims: int, project: Callable[[np.ndarray], np.ndarray], label: str) -> np.ndarray:
    """Over all rows: the sum of the products of their projections with themselves."""

    def add(state: np.ndarray, block: np.ndarray) -> np.ndarray:
        y = project(block)
        return state + y.T @ y

    def merge(a: Part, b: Part) -> Part:
        return a[0] + b[0], a[1], (np.frombuffer(a[2]) + np.frombuffer(b[2])).tobytes()

    parts = _by_partition(rows, lambda: np.zeros(()), add, lambda s: s.astype(np.float64).tobytes(), dims)
    flat = np.frombuffer(_combined(parts, merge, label)[2])
    size = int(np.sqrt(len(flat)))
    return flat.reshape(size, size)


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitener | None:
    """The whitener of all vectors of ``df`` that take part; None without any."""
    ship_package(df.sparkSession)
    rows = _vectors(df, vector).select(vector)
    lengths = rows.groupBy(F.size(vector).alias("dims")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    if most is None:
        return None
    dims = most["dims"]
    rows = rows.filter(F.size(vector) == dims)
    n, sums, spectrum = incremental(rows, dims)
    basis = np.linalg.qr(spectrum.vectors)[0]
    rough = Whitener(dims, n, sums, spectrum.values[::-1] / n, basis)
    mean = rough.mean
    covariance = _products(rows, dims, lambda x: (x - mean) @ basis, "projections") / n
    values, turn = np.linalg.eigh(covariance)
    found = Whitener(dims, n, sums, values[::-1].copy(), (basis @ turn)[:, ::-1].copy())
    use = found.usable(components)
    if use.any():
        products = _products(rows, dims, lambda x: found.whitened(x, components)[:, use], "whitened") / n
        found.identity_error = float(np.abs(products - np.eye(len(products))).max())
    return found


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row for each vector and component: deviation, whitened value, what the component explains."""
    schema = T.StructType(
        [df.schema[key], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
         T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
         T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())]
    )
    whitener = fit(df, vector, components)
    if whitener is None:
        return df.sparkSession.createDataFrame([], schema)
    arrow = to_arrow_schema(schema)
    trace = float(whitener.values.sum())
    count = min(components, whitener.dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                x = whole(part.column(1), whitener.dims)
                values = whitener.whitened(x, components).ravel()
                explained = whitener.values[:count] / trace if trace > 0 else np.full(count, np.nan)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(len(x)), count))),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(x) * count, whitener.n)),
                        pa.array(np.repeat(deviations(x, whitener.n, whitener.sums), count)),
                        pa.array(values, mask=np.isnan(values)),
                        pa.array(np.tile(explained, len(x)), mask=np.isnan(np.tile(explained, len(x)))),
                        pa.array(np.full(len(x) * count, whitener.identity_error)),
                    ],
                    schema=arrow,
                )

    rows = _vectors(df, vector).filter(F.size(vector) == whitener.dims)
    return rows.select(key, vector).mapInArrow(run, schema)
