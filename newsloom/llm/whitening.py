"""Embedding whitening: leading eigenpairs of the covariance by spectrum slicing.

Entries become whole numbers, so counts, sums and the covariance are exact
before they are rounded once. Tasks add up their own rows; Spark sums what they
return per cell, and only the covariance, whose size is that of one vector
squared, reaches the driver.

There the spectrum is sliced: the signs of the pivots of V - s = L D L^T count
the eigenvalues above s (Sylvester's law of inertia), so halving an interval
isolates each leading eigenvalue. Rayleigh quotient iteration from inside its
interval then converges cubically, and two more counts, just below and above
the result, certify its number. Eigenvalues that no count can part are taken
together by subspace iteration.

Defined results: rows drop out whose vector is null, holds a null or non-finite
entry, or an entry c for which 64c does not fit into a long; vectors of another
length than the commonest one (the longest of those) drop out too, as do those
without entries. Repeated rows and rows without an id count as any other. There
are no components beyond the rank of the covariance, so equal vectors, or a
single one, give no rows; neither does an empty table. ``deviation`` is null
where it does not fit into a long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from ..session import ship_package

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Largest dimension; its covariance on the driver has the square of it.
MAX_DIMENSION = 4096
#: Rows of a task that are multiplied at once.
CHUNK = 4096
#: Sums of products below this are exact in doubles.
_EXACT = float(1 << 52)
_LIMIT = float(1 << 62)
_LONG = (1 << 63) - 1
#: Groups of nine digits that a sum of a task may have.
_LIMBS = 8


def usable(vectors: pa.Array, dimension: int | None = None) -> np.ndarray:
    """Which vectors have only finite entries that fit, and the given length."""
    vectors = vectors.cast(pa.list_(pa.float64()))
    values = vectors.values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    good = np.append(0, np.cumsum(~(np.abs(SCALE * values) < _LIMIT)))
    ends = vectors.offsets.to_numpy()
    fine = (good[ends[1:]] == good[ends[:-1]]) & vectors.is_valid().to_numpy(zero_copy_only=False)
    length = np.diff(ends)
    return fine & (length == dimension if dimension is not None else length > 0)


def whole(vectors: pa.Array, dimension: int) -> np.ndarray:
    """``floor(64 c)`` of usable vectors, one row each; the offset of a million is left out."""
    values = vectors.cast(pa.list_(pa.float64())).flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * values.reshape(-1, dimension)).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], column: int, dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            part = part.filter(pa.array(usable(part.column(column), dimension)))
            if part.num_rows:
                yield part, whole(part.column(column), dimension)


def _product(rows: np.ndarray) -> np.ndarray:
    """``rows.T @ rows`` in whole numbers, of any size."""
    most = float(np.abs(rows).max(initial=0))
    if most * most * len(rows) < _EXACT:
        doubles = rows.astype(np.float64)
        return (doubles.T @ doubles).astype(np.int64)
    return rows.astype(object).T @ rows.astype(object)


def _cells(df: DataFrame, per_task: Callable[[Iterator[pa.RecordBatch]], dict[tuple[int, int], int]]) -> dict[tuple[int, int], int]:
    """Sum over all tasks of what each has per cell; the cells do not grow with the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = per_task(batches)
        cells = list(sums)
        yield pa.RecordBatch.from_pydict(
            {"i": [i for i, _ in cells], "j": [j for _, j in cells], "v": [str(sums[c]) for c in cells]},
            schema=pa.schema([("i", pa.int32()), ("j", pa.int32()), ("v", pa.string())]),
        )

    # whole numbers travel as text and are summed in parts of nine digits, which no count of tasks can overflow
    digits = F.lpad(F.ltrim(F.col("v"), F.lit("-")), 9 * _LIMBS, "0")
    part = df.mapInArrow(run, "i int, j int, v string").withColumn("d", digits)
    sign = F.when(F.col("v").startswith("-"), -1).otherwise(1)
    limbs = [F.sum(sign * F.substring("d", 9 * k + 1, 9).cast("long")).alias(f"l{k}") for k in range(_LIMBS)]
    found = part.groupBy("i", "j").agg(*limbs).collect()
    return {(r.i, r.j): sum(r[f"l{k}"] * 10 ** (9 * (_LIMBS - 1 - k)) for k in range(_LIMBS)) for r in found}


@dataclass
class Covariance:
    """Over ``n`` whole-number vectors: sums per dimension (without the offset) and n^2 times the covariance."""

    n: int
    sums: list[int]
    scaled: list[list[int]]

    @property
    def matrix(self) -> np.ndarray:
        return np.array([[cell / self.n**2 for cell in row] for row in self.scaled], dtype=np.float64)


def dimension_of(df: DataFrame, vector: str) -> int:
    """The commonest length of usable vectors, 0 for none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = np.diff(batch.column(0).offsets.to_numpy())[usable(batch.column(0))]
            sizes, counts = np.unique(length, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(counts, pa.int64())], names=["size", "n"])

    vectors = df.select(F.col(vector).cast("array<double>"))
    best = (
        vectors.mapInArrow(run, "size int, n long").groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size"))
    ).first()
    return best["size"] if best else 0


def covariance(df: DataFrame, vector: str, dimension: int) -> Covariance:
    """Two passes: sums, then products of what is centred on the rounded mean."""
    vectors = df.select(F.col(vector).cast("array<double>"))

    def add_up(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, int], int]:
        n, sums = 0, [0] * dimension
        for part, rows in _chunks(batches, 0, dimension):
            n += part.num_rows
            exact = np.abs(rows).max() < _LIMIT / CHUNK
            sums = [a + int(b) for a, b in zip(sums, (rows if exact else rows.astype(object)).sum(axis=0), strict=True)]
        return {(-1, -1): n} | {(-1, i): s for i, s in enumerate(sums)} if n else {}

    totals = _cells(vectors, add_up)
    n = totals.get((-1, -1), 0)
    sums = [totals.get((-1, i), 0) for i in range(dimension)]
    if not n:
        return Covariance(0, sums, [])
    centre = [round(s / n) if abs(s) < 1 << 50 else (2 * s + n) // (2 * n) for s in sums]

    def multiply(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, int], int]:
        total = np.zeros((dimension, dimension), dtype=object)
        middle, held = np.array(centre, dtype=object), np.zeros((dimension, dimension), dtype=np.int64)
        for _, rows in _chunks(batches, 0, dimension):
            small = np.abs(rows).max() < _LIMIT / 4 and max(map(abs, centre)) < _LIMIT / 4
            product = _product(rows - middle.astype(np.int64) if small else rows - middle)
            if product.dtype == object:
                total = total + product
                continue
            held = held + product
            if np.abs(held).max() > _LIMIT / 2:
                total, held = total + held, np.zeros_like(held)
        total = total + held
        return {(i, j): int(total[i, j]) for i in range(dimension) for j in range(i, dimension) if total[i, j]}

    products = _cells(vectors, multiply)
    off = [s - n * c for s, c in zip(sums, centre, strict=True)]
    scaled = [
        [n * products.get((min(i, j), max(i, j)), 0) - off[i] * off[j] for j in range(dimension)] for i in range(dimension)
    ]
    return Covariance(n, sums, scaled)


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: positive pivots of L D L^T with blocks of one or two."""
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        magnitude = np.abs(a)
        diagonal = magnitude.diagonal()
        d = int(diagonal.argmax())
        i, j = divmod(int(magnitude.argmax()), len(a))
        if diagonal[d] >= 0.6404 * magnitude[i, j]:
            if diagonal[d] == 0:
                return above
            keep = np.arange(len(a)) != d
            pivot, column = a[d, d], a[keep, d]
            above += int(pivot > 0)
            a = a[np.ix_(keep, keep)] - np.outer(column / pivot, column)
        else:
            # a block of two whose determinant is negative: one eigenvalue on either side
            keep = np.ones(len(a), dtype=bool)
            keep[[i, j]] = False
            block, columns = a[np.ix_([i, j], [i, j])], a[np.ix_(keep, [i, j])]
            above += 1
            a = a[np.ix_(keep, keep)] - columns @ np.linalg.solve(block, columns.T)
    return above


@dataclass
class Eigenpairs:
    """By falling value; ``certified`` tells which numbers two inertia counts confirm."""

    values: np.ndarray
    vectors: np.ndarray
    certified: np.ndarray


def _solve(shifted: np.ndarray, right: np.ndarray, tiny: float) -> np.ndarray:
    try:
        out = np.linalg.solve(shifted, right)
    except np.linalg.LinAlgError:
        out = np.linalg.solve(shifted + tiny * np.eye(len(shifted)), right)
    return out if np.isfinite(out).all() else np.linalg.solve(shifted + tiny * np.eye(len(shifted)), right)


def _rayleigh(matrix: np.ndarray, low: float, high: float, tiny: float, start: np.ndarray) -> tuple[float, np.ndarray] | None:
    """The eigenpair inside an interval; None if the iteration leaves it."""
    identity, vector = np.eye(len(matrix)), start
    shift = (low + high) / 2
    for _ in range(3):
        vector = _solve(matrix - shift * identity, vector, tiny)
        vector /= np.linalg.norm(vector)
    for _ in range(30):
        shift = float(vector @ matrix @ vector)
        residual = np.linalg.norm(matrix @ vector - shift * vector)
        if residual <= tiny:
            break
        vector = _solve(matrix - shift * identity, vector, tiny)
        vector /= np.linalg.norm(vector)
    shift = float(vector @ matrix @ vector)
    return (shift, vector) if low - tiny <= shift <= high + tiny else None


def leading(matrix: np.ndarray, most: int = COMPONENTS) -> Eigenpairs:
    """The ``most`` largest eigenvalues above the rounding error of the matrix, with unit eigenvectors."""
    size = len(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if not size or bound == 0:
        return Eigenpairs(np.empty(0), np.empty((0, size)), np.empty(0, dtype=bool))
    scaled = matrix / bound
    tiny = size * np.finfo(float).eps
    floor = 4 * size * tiny
    wanted = min(most, inertia(scaled, floor))
    generator = np.random.default_rng(0)
    counts: dict[float, int] = {1 + 4 * tiny: 0, floor: inertia(scaled, floor)}

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = inertia(scaled, shift)
        return counts[shift]

    values: list[float] = []
    vectors: list[np.ndarray] = []
    certified: list[bool] = []
    while len(values) < wanted:
        number = len(values)
        # the eigenvalue in question lies between a shift with fewer and one with more above it
        high = min(s for s, n in counts.items() if n <= number)
        low = max(s for s, n in counts.items() if n > number)
        found, attempts = None, 0
        while high - low > 4 * tiny:
            inside = count(low) - count(high)
            if inside == 1 and high - low <= max(1e-3 * high, 64 * tiny) or attempts > 60 and inside == 1:
                found = _rayleigh(scaled, low, high, tiny / 4, generator.standard_normal(size))
                if found:
                    break
            middle = (low + high) / 2
            attempts += 1
            if count(middle) > number:
                low = middle
            else:
                high = middle
        if found:
            block = [found]
        else:
            # no count parts these: an orthonormal basis of their common space
            many = max(1, count(low) - number)
            space = generator.standard_normal((size, many))
            for _ in range(8):
                for v in vectors:
                    space -= np.outer(v, v @ space)
                space = np.linalg.qr(_solve(scaled - (low + high) / 2 * np.eye(size), space, tiny))[0]
            block = [(float(v @ scaled @ v), v) for v in space.T]
        for value, vector in block:
            for other, at in zip(vectors, values, strict=True):
                if abs(at - value) < 1e-6:
                    vector = vector - (other @ vector) * other
            vector = vector / np.linalg.norm(vector)
            reach = 8 * tiny + 2 * float(np.linalg.norm(scaled @ vector - value * vector))
            certified.append(inertia(scaled, value - reach) == len(values) + 1 and inertia(scaled, value + reach) == len(values))
            values.append(value)
            vectors.append(vector)
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    return Eigenpairs(np.array(values)[order] * bound, np.array(vectors)[order], np.array(certified)[order])


def _whitener(found: Covariance, pairs: Eigenpairs) -> Callable[[np.ndarray], np.ndarray]:
    """Whole-number vectors to whitened ones; the mean is taken off before anything is multiplied."""
    centre = [s // found.n for s in found.sums]
    rest = np.array([(s - c * found.n) / found.n for s, c in zip(found.sums, centre, strict=True)])
    middle = np.array(centre, dtype=np.float64) if max(map(abs, centre)) > 1 << 52 else np.array(centre, dtype=np.int64)
    weights = (pairs.vectors / np.sqrt(pairs.values)[:, None]).T
    return lambda rows: ((rows - middle).astype(np.float64) - rest) @ weights


def identity_error(df: DataFrame, vector: str, dimension: int, whiten_rows: Callable, n: int, components: int) -> float:
    """Largest entry of the covariance of all whitened rows minus the identity, from their own products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((components + 1, components + 1))
        for _, rows in _chunks(batches, 0, dimension):
            white = np.column_stack([whiten_rows(rows), np.ones(len(rows))])
            gram += white.T @ white
        i, j = np.triu_indices(components + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(gram[i, j], pa.float64())], names=["i", "j", "v"]
        )

    vectors = df.select(F.col(vector).cast("array<double>"))
    cells = vectors.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    gram = np.zeros((components + 1, components + 1))
    for r in cells:
        gram[r.i, r.j] = gram[r.j, r.i] = r.v
    mean = gram[:-1, -1] / n
    return float(np.abs(gram[:-1, :-1] / n - np.outer(mean, mean) - np.eye(components)).max())


def _deviations(rows: np.ndarray, found: Covariance) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, in whole numbers; n times the offset is in S as in n x."""
    reach = float(np.abs(rows).max(initial=0)) * found.n + max(map(abs, found.sums))
    if reach < _LIMIT and reach * reach * rows.shape[1] < _LIMIT:
        off = rows * found.n - np.array(found.sums, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    off = rows.astype(object) * found.n - np.array(found.sums, dtype=object)
    sums = (off * off).sum(axis=1)
    return [int(s) if s <= _LONG else None for s in sums]


SCHEMA = [
    StructField("component", IntegerType()),
    StructField("n", LongType()),
    StructField("deviation", LongType()),
    StructField("whitened", DoubleType()),
    StructField("explained", DoubleType()),
    StructField("identity_error", DoubleType()),
]


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    ship_package(df.sparkSession)
    full = StructType([StructField("vec_id", df.schema[vec_id].dataType), *SCHEMA])
    empty = df.sparkSession.createDataFrame([], full)
    dimension = dimension_of(df, vector)
    if dimension > MAX_DIMENSION:
        raise ValueError(f"vectors of {dimension} entries; at most {MAX_DIMENSION}")
    found = covariance(df, vector, dimension) if dimension else None
    if not found or not found.n:
        return empty
    matrix = found.matrix
    pairs = leading(matrix, components)
    if not pairs.values.size:
        return empty
    if not pairs.certified.all():
        # equal eigenvalues have no numbers of their own; anything else must be confirmed
        gaps = np.diff(pairs.values, prepend=np.inf, append=-np.inf)
        near = np.minimum(np.abs(gaps[:-1]), np.abs(gaps[1:])) <= 1e-9 * pairs.values[0]
        if not (near | pairs.certified | (pairs.values <= 1e-9 * pairs.values[0])).all():
            raise ArithmeticError("an eigenvalue is not where the inertia counts have it")
    trace = float(sum(found.scaled[i][i] for i in range(dimension)) / found.n**2)
    explained = pairs.values / trace
    white = _whitener(found, pairs)
    error = identity_error(df, vector, dimension, white, found.n, len(explained))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, many = to_arrow_schema(full), len(explained)
        for part, rows in _chunks(batches, 1, dimension):
            count = len(rows)
            deviations = pa.array(_deviations(rows, found), type=pa.int64())
            each = pa.array(np.repeat(np.arange(count), many))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(each),
                    pa.array(np.tile(np.arange(1, many + 1), count), type=pa.int32()),
                    pa.array(np.full(count * many, found.n), type=pa.int64()),
                    deviations.take(each),
                    pa.array(white(rows).ravel(), type=pa.float64()),
                    pa.array(np.tile(explained, count), type=pa.float64()),
                    pa.array(np.full(count * many, error), type=pa.float64()),
                ],
                schema=arrow,
            )

    return df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>")).mapInArrow(run, full)
