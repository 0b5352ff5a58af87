"""Whitening of embeddings by spectrum slicing.

Sums and products of the components are integers and are added up exactly, so the covariance of all vectors is the
exact one rounded once. From there on:

* An LDL' factorization of the covariance less a shift has as many positive pivots as there are eigenvalues above
  the shift (inertia). Bisection by such counts isolates each leading eigenvalue in an interval of its own.
* A Rayleigh quotient iteration from within the interval converges to its eigenpair, cubically.
* The counts just below and above the found value certify its number. Values that no count can tell apart are found
  together, as any orthonormal basis of their space will do.

Only the number of vectors, their sums and the products of their components, dimension squared over two, leave
the executors; tasks add their own rows up first. Vectors are read once for the sums, once for the products, which are
of differences from the rounded mean, and once for each result.

Defined results: vectors that are NULL, empty or hold a NULL or non-finite component take no part; vectors of unlike
dimensions are whitened apart, each dimension by the vectors it has; directions in which the vectors do not vary, to double
precision, have no component, so a single vector or equal vectors give no rows; repeated rows give a row each, NULL ids too.
Components whose 64-fold is 2^53 or more lose no part but are floored as doubles; a deviation beyond a long is NULL.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Rows multiplied at once.
ROWS = 4_096
EPSILON = float(np.finfo(float).eps)
#: The pivot choice that bounds the growth of LDL' factors (Bunch and Parlett): (1 + sqrt 17) / 8.
PIVOT = (1 + 17 ** 0.5) / 8


# --- eigenpairs of one symmetric matrix ----------------------------------------------------------------------

def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``matrix`` exceed ``shift``: the positive pivots of the LDL' of their difference."""
    rest = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(rest):
        sizes = np.abs(rest)
        diagonal = np.diagonal(sizes)
        at = int(diagonal.argmax())
        largest = float(sizes.max())
        if largest == 0:
            break
        if diagonal[at] >= PIVOT * largest:
            pivot, out = rest[at, at], [at]
            positive += pivot > 0
            others = np.delete(np.arange(len(rest)), at)
            column = rest[others, at]
            rest = rest[np.ix_(others, others)] - np.outer(column, column) / pivot
        else:
            # A pivot of two rows with a large entry beside small ones has one value of either sign.
            i, j = divmod(int(sizes.argmax()), len(rest))
            out = [i, j]
            positive += 1
            others = np.delete(np.arange(len(rest)), out)
            columns = rest[np.ix_(others, out)]
            rest = rest[np.ix_(others, others)] - columns @ np.linalg.solve(rest[np.ix_(out, out)], columns.T)
        rest = (rest + rest.T) / 2
    return positive


@dataclass
class Slice:
    """An interval that holds the eigenvalues numbered ``first`` to ``last``, from 0 by falling value."""

    low: float
    high: float
    first: int
    last: int


def slices(matrix: np.ndarray, wanted: int) -> list[Slice]:
    """Disjoint intervals of the leading eigenvalues, each with one, or with some that counts cannot tell apart."""
    radius = np.abs(matrix).sum(axis=1) - np.abs(np.diagonal(matrix))
    low, high = float((np.diagonal(matrix) - radius).min()), float((np.diagonal(matrix) + radius).max())
    width = max(abs(low), abs(high), np.finfo(float).tiny)
    finest = 64 * len(matrix) * EPSILON * width
    low, high = low - width * 1e-3, high + width * 1e-3
    open_, out = [Slice(low, high, 0, len(matrix) - 1)], []
    while open_:
        one = open_.pop()
        if one.first >= wanted:
            continue
        if one.first == one.last and one.high - one.low < (high - low) / 4 or one.high - one.low <= finest:
            out.append(one)
            continue
        middle = (one.low + one.high) / 2
        upper = min(max(above(matrix, middle), one.first), one.last + 1)
        if upper <= one.last:
            open_.append(Slice(one.low, middle, upper, one.last))
        if upper > one.first:
            open_.append(Slice(middle, one.high, one.first, upper - 1))
    return sorted(out, key=lambda one: one.first)


def _solved(matrix: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray | None:
    try:
        found = np.linalg.solve(matrix - shift * np.eye(len(matrix)), right)
    except np.linalg.LinAlgError:
        return None
    return found if np.isfinite(found).all() else None


def _rayleigh(matrix: np.ndarray, one: Slice, start: np.ndarray) -> tuple[float, np.ndarray] | None:
    """The eigenpair of an interval with one eigenvalue; None if the iteration leaves it."""
    vector, shift = start / np.linalg.norm(start), (one.low + one.high) / 2
    norm = float(np.abs(matrix).sum(axis=1).max())
    for step in range(40):
        found = _solved(matrix, shift, vector)
        if found is None:  # the shift is an eigenvalue to the last bit
            shift += EPSILON * norm
            continue
        vector = found / np.linalg.norm(found)
        value = float(vector @ matrix @ vector)
        residue = float(np.linalg.norm(matrix @ vector - value * vector))
        if residue <= 4 * len(matrix) ** 0.5 * EPSILON * norm:
            return (value, vector) if one.low <= value <= one.high else None
        # Fixed shifts first, so that the quotient starts near the one eigenvalue of the interval.
        if one.low <= value <= one.high and residue < (one.high - one.low) / 2:
            shift = value
    return None


def _together(matrix: np.ndarray, one: Slice, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and an orthonormal basis of an interval too narrow to be cut."""
    shift = one.high
    block = np.linalg.qr(seed[:, :one.last - one.first + 1])[0]
    for _ in range(6):
        found = _solved(matrix, shift, block)
        if found is None:
            shift += EPSILON * float(np.abs(matrix).sum(axis=1).max())
            continue
        block = np.linalg.qr(found)[0]
    values = np.einsum("ik,ik->k", block, matrix @ block)
    order = np.argsort(-values)
    return values[order], block[:, order]


def leading_eigenpairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix by falling value, and unit eigenvectors as columns."""
    size = len(matrix)
    wanted = min(wanted, size)
    scale = float(np.abs(matrix).max(initial=0))
    if scale == 0:
        return np.zeros(wanted), np.eye(size)[:, :wanted]
    scaled = matrix / scale
    starts = np.random.default_rng(0).standard_normal((size, size))
    values, vectors = np.zeros(0), np.zeros((size, 0))
    open_ = slices(scaled, wanted)[::-1]
    while open_:
        one = open_.pop()
        if one.first == one.last:
            pair = _rayleigh(scaled, one, starts[:, one.first])
            if pair is None and one.high - one.low > 64 * size * EPSILON:
                middle = (one.low + one.high) / 2
                upper = above(scaled, middle) > one.first
                open_.append(Slice(middle, one.high, one.first, one.last) if upper
                             else Slice(one.low, middle, one.first, one.last))
                continue
            found = (np.array([pair[0]]), pair[1][:, None]) if pair else _together(scaled, one, starts)
        else:
            found = _together(scaled, one, starts)
        _certify(scaled, one, found[0])
        # Eigenvectors of close values: what rounding left of those before goes.
        fresh = found[1] - vectors @ (vectors.T @ found[1])
        fresh = np.linalg.qr(fresh)[0]
        values, vectors = np.concatenate([values, found[0]]), np.column_stack([vectors, fresh])
    return values[:wanted] * scale, vectors[:, :wanted]


def _certify(matrix: np.ndarray, one: Slice, values: np.ndarray) -> None:
    """Counts just outside the found values must be those of their numbers."""
    margin = 256 * len(matrix) * EPSILON * max(1.0, float(np.abs(matrix).sum(axis=1).max()))
    if above(matrix, values.max() + margin) > one.first or above(matrix, values.min() - margin) <= one.last:
        raise ArithmeticError(f"eigenvalues {one.first + 1} to {one.last + 1} are not certified")


# --- vectors -------------------------------------------------------------------------------------------------

def _usable(vector: Column) -> Column:
    return (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < F.lit(float("inf"))))


def _entries(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """floor(SCALE * c) of every component, as int64 or, beyond that, as Python integers."""
    flat = batch.column("d").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    whole = np.floor(flat * SCALE)
    if np.abs(whole).max(initial=0) < 2 ** 52:
        return whole.astype(np.int64)
    return np.array([[int(x) if np.isfinite(x) else int(c) * SCALE for x, c in zip(row, raw)]
                     for row, raw in zip(whole, flat)], object).reshape(-1, dim)


def _largest(values: np.ndarray) -> int:
    return int(max(abs(values.min()), abs(values.max()))) if values.size else 0


def _products(values: np.ndarray) -> np.ndarray:
    """The exact products of the columns; as doubles where no sum can leave their whole numbers."""
    bound = _largest(values) ** 2 * max(1, len(values))
    if bound < 2 ** 53:
        doubles = values.astype(float)
        return (doubles.T @ doubles).astype(np.int64)
    values = values if bound < 2 ** 63 else values.astype(object)
    return values.T @ values


def _less(values: np.ndarray, middle: list[int]) -> np.ndarray:
    if max(_largest(values), max(map(abs, middle))) < 2 ** 61 and values.dtype != object:
        return values - np.array(middle, np.int64)
    return values.astype(object) - np.array(middle, object)


def _added(rows: DataFrame, width: int, parts, dim: int) -> list[list]:
    """Lists of ``width`` Python integers or floats that ``parts`` makes of blocks, added up over all rows.

    A task adds its own rows; the sums of tasks meet by position, so no key gets more rows than there are tasks.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                one = parts(batch.slice(start, ROWS)).astype(object)
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(list(map(repr, total.tolist())), pa.string())],
                names=["place", "part"])

    sums = rows.mapInArrow(partial, "place int, part string").groupBy("place").agg(F.collect_list("part").alias("parts"))
    # One job: a local iterator would start one for each reducer, in turn.
    exact = {row["place"]: row["parts"] for row in sums.collect()}
    return [exact.get(place, []) for place in range(width)]


@dataclass
class Whitening:
    """The fitted transform of the vectors of one dimension; sums are of floor(SCALE * c)."""

    dim: int
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    #: ``trace`` and ``values`` are of entries over 2^bits, so that squares of very large ones stay finite.
    bits: int = 0

    @functools.cached_property
    def middle(self) -> list[int]:
        return [round(s / self.n) if abs(s) < 2 ** 52 else s // self.n for s in self.sums]

    def project(self, entries: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of entries."""
        rest = [(s - self.n * m) / self.n for s, m in zip(self.sums, self.middle)]
        centred = _less(entries, self.middle).astype(float) - np.array(rest)
        return np.ldexp(centred, -self.bits) @ self.vectors / np.sqrt(self.values)

    def deviations(self, entries: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n * x - S) squared of each row."""
        least, rest = _less(entries, self.middle), [s - self.n * m for s, m in zip(self.sums, self.middle)]
        bound = (self.n * _largest(least) + max(map(abs, rest))) ** 2 * self.dim
        if bound < 2 ** 63:
            return (np.square(least.astype(np.int64) * self.n - np.array(rest, np.int64)).sum(axis=1)).tolist()
        far = [sum(x * x for x in row) for row in (least.astype(object) * self.n - np.array(rest, object)).tolist()]
        return [x if x < 2 ** 63 else None for x in far]


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """Whitening of ``rows`` (one column ``d``, arrays of ``dim`` doubles)."""
    def sums(batch: pa.RecordBatch) -> np.ndarray:
        entries = _entries(batch, dim)
        return np.concatenate([[batch.num_rows], entries.astype(object).sum(axis=0)])

    n, *total = [sum(map(int, parts)) for parts in _added(rows, dim + 1, sums, dim)]
    model = Whitening(dim, n, total, 0.0, np.zeros(0), np.zeros((dim, 0)))
    upper = np.triu_indices(dim)

    def products(batch: pa.RecordBatch) -> np.ndarray:
        return _products(_less(_entries(batch, dim), model.middle))[upper]

    moments = [sum(map(int, parts)) for parts in _added(rows, len(upper[0]), products, dim)]
    rest = [s - n * m for s, m in zip(total, model.middle)]
    places = list(zip(*map(np.ndarray.tolist, upper)))
    exact = [n * moment - rest[i] * rest[j] for (i, j), moment in zip(places, moments)]
    model.bits = max(0, max(map(abs, exact)).bit_length() - 900) // 2
    covariance = np.zeros((dim, dim))
    for (i, j), product in zip(places, exact):
        covariance[i, j] = covariance[j, i] = product / (n * n << 2 * model.bits)
    values, vectors = leading_eigenpairs(covariance, components)
    model.trace = float(np.trace(covariance))
    varies = values > 16 * dim * EPSILON * max(model.trace, 0.0)
    model.values, model.vectors = values[varies], vectors[:, varies]
    return model


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of all whitened rows less the identity."""
    k = len(model.values)
    if not k:
        return 0.0
    upper = np.triu_indices(k)

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        return model.project(_entries(batch, model.dim)).sum(axis=0)

    mean = np.array([sum(map(float, parts)) for parts in _added(rows, k, sums, model.dim)]) / model.n

    def products(batch: pa.RecordBatch) -> np.ndarray:
        white = model.project(_entries(batch, model.dim)) - mean
        return (white.T @ white)[upper]

    found = np.array([sum(map(float, parts)) for parts in _added(rows, len(upper[0]), products, model.dim)]) / model.n
    return float(np.abs(found - (upper[0] == upper[1])).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id",
             vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every vector that takes part."""
    doubles = vectors.select(F.col(vec_id).alias("vec_id"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("d"))
    rows = doubles.where(F.col("d").isNotNull() & _usable(F.col("d")))
    dims = sorted(row[0] for row in rows.select(F.size("d")).distinct().collect())
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, deviation bigint, white array<double>"
    out = None
    for dim in dims:
        mine = rows.where(F.size("d") == dim)
        only = mine.select("d")
        model = fit(only, dim, components)

        def project(batches: Iterator[pa.RecordBatch], model: Whitening = model) -> Iterator[pa.RecordBatch]:
            k = len(model.values)
            for batch in batches:
                entries = _entries(batch, model.dim)
                white = model.project(entries)
                offsets = pa.array(np.arange(len(white) + 1, dtype=np.int32) * k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(model.deviations(entries), pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(white.ravel()))], names=["vec_id", "deviation", "white"])

        share = F.array(*[F.lit(float(value / model.trace)) for value in model.values]).cast("array<double>")
        part = mine.mapInArrow(project, schema).select(
            "vec_id", "deviation", F.posexplode("white").alias("place", "whitened")).select(
            "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
            "whitened", F.get(share, F.col("place")).alias("explained"),
            F.lit(identity_error(only, model)).alias("identity_error"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return vectors.sparkSession.createDataFrame([], (
            f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, "
            "identity_error double"))
    return out
