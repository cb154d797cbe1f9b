"""Whitening of embeddings from an exact covariance found by polarisation.

Vectors become whole numbers, `floor(64 c) + 1000000`. With n vectors and the sums S of each dimension,
y = n x - S is a centred whole number. The job sums y_i ** 2 for every dimension and (y_i + y_j) ** 2 for
every pair, exactly; the cross-covariance of i and j is half of what the variance of the sum exceeds the
two variances by. The matrix is assembled where the query is built (its size is that of the dimension,
not of the table) and `eigh` gives the components.

The table is read four times (sums, squares, check, result) and never shuffled or gathered: a task
sends one row per dimension or pair.

Defined cases: a vector that is null or holds null or non-finite entries gives no row; vectors of
different length are whitened among themselves, each length with its own fit (at most LENGTHS of
them, else an error); an empty vector has no components and gives no row; repeated rows and identifiers
count each; a component without variance has `whitened` 0 and stays out of the check; an entry beyond
the range of a long takes its end; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Different lengths of vectors in one table: each has a matrix of its own on the driver.
LENGTHS = 16
#: Vectors whose squares are summed at once inside a task.
STRIP = 4_096
#: Bits of one piece of a whole number on its way through Spark's sums.
PIECE = 40
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class Fit:
    """What whitening needs of one length: count, sums, components (columns) and their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if self.trace > 0 else np.zeros(len(self.eigenvalues))

    @property
    def useful(self) -> np.ndarray:
        """Components with variance, apart from what rounding leaves of none."""
        least = len(self.sums) * np.finfo(np.float64).eps * (self.eigenvalues.max(initial=0.0))
        return self.eigenvalues > least


# ------------------------------------------------------------------------- whole numbers
def whole(values: np.ndarray) -> np.ndarray:
    """`floor(64 c) + 1000000` of finite doubles, as longs; an entry beyond that range takes its end."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * SCALE)
    inside = np.abs(scaled) < 2.0**62
    out = np.where(inside, scaled, 0).astype(np.int64) + OFFSET
    if not inside.all():
        out[~inside] = [min(max(int(c * SCALE) if np.isfinite(c * SCALE) else (_HIGH if c > 0 else _LOW), _LOW), _HIGH)
                        for c in values[~inside].tolist()]
    return out


def vectors_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length in a batch: rows and their x-vectors. Vectors that do not count are left out."""
    column = batch.column("vector")
    lengths = pa.compute.fill_null(pa.compute.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        flat = column.take(pa.array(rows)).flatten()
        values = pa.compute.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(-1, length)
        finite = np.isfinite(values).all(axis=1)
        if finite.any():
            yield rows[finite], whole(values[finite])


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n x - S, exactly: longs, or Python's numbers where longs are too short."""
    most = max(abs(int(x.max())), abs(int(x.min())))
    if n * most + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def exact_squares(z: np.ndarray) -> list[int]:
    """The sum of squares of each column, exactly.

    Longs are squared as they are while no sum can exceed 62 bits, and otherwise in two pieces of
    24 bits below and the rest above; Python's numbers do what is left.
    """
    if z.dtype == object:
        return [int(v) for v in (z * z).sum(axis=0)]
    most = max(abs(int(z.max())), abs(int(z.min())))
    rows = len(z)
    if rows * most * most < 1 << 62:
        return np.einsum("ij,ij->j", z, z).tolist()
    if most < 1 << 48 and rows <= 1 << 13:
        low, high = z & 0xFFFFFF, z >> 24
        parts = [np.einsum("ij,ij->j", a, b).tolist() for a, b in ((high, high), (high, low), (low, low))]
        return [(h << 48) + (m << 25) + s for h, m, s in zip(*parts)]
    return exact_squares(z.astype(object))


def pieces_of(value: int) -> list[int]:
    """A whole number in pieces of PIECE bits, lowest first; the highest one has the sign."""
    out = []
    while not -(1 << PIECE) <= value < 1 << PIECE:
        out.append(value & ((1 << PIECE) - 1))
        value >>= PIECE
    return [*out, value]


# --------------------------------------------------------------------------------- passes
def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (length, dimension, count, piece, sum) of one task; dimension -1 counts the vectors."""
    total: dict[int, list[int]] = {}
    count: dict[int, int] = {}
    for batch in batches:
        for _, x in vectors_of(batch):
            most = max(abs(int(x.max())), abs(int(x.min())))
            sums = (x if most * len(x) < 1 << 62 else x.astype(object)).sum(axis=0).tolist()
            length = len(sums)
            total[length] = [a + b for a, b in zip(total.get(length, [0] * length), sums)]
            count[length] = count.get(length, 0) + len(x)
    yield _rows([(d, -1, -1, count[d]) for d in total] + [(d, i, i, v) for d, values in total.items() for i, v in enumerate(values)])


def _rows(values: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    flat = [(d, i, j, k, piece) for d, i, j, value in values for k, piece in enumerate(pieces_of(value))]
    columns = zip(*flat) if flat else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32()] * 4 + [pa.int64()])],
                                      ["dim", "i", "j", "piece", "value"])


def _polarised(known: dict[int, tuple[int, tuple[int, ...]]]):
    """Rows of the exact squares of every dimension (i = j) and of every sum of two (i < j)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[int]] = {}
        for batch in batches:
            for _, x in vectors_of(batch):
                length = x.shape[1]
                into = held.setdefault(length, [0] * (length * (length + 1) // 2))
                for begin in range(0, len(x), STRIP):
                    y = centred(x[begin : begin + STRIP], *known[length])
                    at = 0
                    for i in range(length):
                        z = y[:, i:] + y[:, i : i + 1]
                        z[:, 0] = y[:, i]
                        for value in exact_squares(z):
                            into[at] += value
                            at += 1
        yield _rows([(d, i, j, values[at]) for d, values in held.items()
                     for at, (i, j) in enumerate((i, j) for i in range(d) for j in range(i, d))])

    return run


_PARTIAL = "dim int, i int, j int, piece int, value long"


def _gathered(rows: DataFrame) -> dict[tuple[int, int, int], int]:
    """Exact sums by (length, i, j); as many as a matrix has entries."""
    found: dict[tuple[int, int, int], int] = {}
    sums = rows.groupBy("dim", "i", "j", "piece").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    for r in sums.collect():
        key = (r["dim"], r["i"], r["j"])
        found[key] = found.get(key, 0) + (int(r["value"]) << (PIECE * r["piece"]))
    return found


def covariance(n: int, squares: dict[tuple[int, int], int], length: int) -> np.ndarray:
    """Covariance from the squares of n x - S: half of what a pair exceeds its dimensions by."""
    out = np.empty((length, length))
    for i in range(length):
        out[i, i] = squares[i, i] / n**3
        for j in range(i + 1, length):
            out[i, j] = out[j, i] = (squares[i, j] - squares[i, i] - squares[j, j]) / (2 * n**3)
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of each length in `vectors(vector)`."""
    lengths = vectors.select(F.size("vector").alias("dim")).where("dim > 0").distinct().limit(LENGTHS + 1).count()
    if lengths > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} different lengths")
    found = _gathered(vectors.mapInArrow(_partial_sums, _PARTIAL))
    known = {d: (n, tuple(found[d, i, i] for i in range(d))) for (d, i, _), n in found.items() if i == -1}
    squares = _gathered(vectors.mapInArrow(_polarised(known), _PARTIAL)) if known else {}
    fits = {}
    for d, (n, sums) in known.items():
        matrix = covariance(n, {(i, j): v for (e, i, j), v in squares.items() if e == d}, d)
        values, axes = np.linalg.eigh(matrix)
        order = np.argsort(-values, kind="stable")[:components]
        fits[d] = Fit(n, sums, np.ascontiguousarray(axes[:, order]), np.maximum(values[order], 0.0), float(np.trace(matrix)))
    return fits


def project(y: np.ndarray, found: Fit) -> np.ndarray:
    """Whitened values of centred whole numbers: columns are components."""
    scale = np.where(found.useful, 1 / np.sqrt(np.where(found.useful, found.eigenvalues, 1.0)), 0.0)
    return (y.astype(np.float64) / found.n) @ found.components * scale


def _moments(fits: dict[int, Fit]):
    """Sums of the whitened values and of their products, for each length, once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in vectors_of(batch):
                found = fits[x.shape[1]]
                w = project(centred(x, found.n, found.sums), found)
                w = np.column_stack((np.ones(len(w)), w))
                held[x.shape[1]] = held.get(x.shape[1], 0.0) + w.T @ w
        flat = [(d, i, j, float(m[i, j])) for d, m in held.items() for i in range(len(m)) for j in range(i, len(m))]
        columns = zip(*flat) if flat else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32()] * 3 + [pa.float64()])], ["dim", "i", "j", "value"])

    return run


def identity_error(vectors: DataFrame, fits: dict[int, Fit]) -> float:
    """The largest entry of |covariance of the whitened values - identity| over components with variance."""
    rows = vectors.mapInArrow(_moments(fits), "dim int, i int, j int, value double")
    found = {(r["dim"], r["i"], r["j"]): r["value"] for r in rows.groupBy("dim", "i", "j").agg(F.sum("value").alias("value")).collect()}
    worst = 0.0
    for d, one in fits.items():
        use = (np.flatnonzero(one.useful) + 1).tolist()
        for a, i in enumerate(use):
            for j in use[a:]:
                entry = found[d, i, j] / one.n - found[d, 0, i] / one.n * (found[d, 0, j] / one.n)
                worst = max(worst, abs(entry - (i == j)))
    return worst


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector: `_id, n, deviation, whitened, explained, identity_error`.

    `deviation` is the exact sum of (n x - S) ** 2 over the dimensions as a decimal (null if it has over 38 digits);
    `whitened` and `explained` are arrays by component, of falling eigenvalue.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{vector_col}`").alias("vector"))
    fits = fit(rows.select("vector"), components)
    error = identity_error(rows.select("vector"), fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        for batch in batches:
            for at, x in vectors_of(batch):
                found = fits[x.shape[1]]
                y = centred(x, found.n, found.sums)
                w = project(y, found)
                far = exact_squares(np.ascontiguousarray(y.T))
                width = w.shape[1]
                whitened = pa.ListArray.from_arrays(np.arange(0, w.size + 1, width, dtype=np.int32), pa.array(np.ascontiguousarray(w).ravel()))
                explained = pa.ListArray.from_arrays(np.arange(0, w.size + 1, width, dtype=np.int32), pa.array(np.tile(found.explained, len(w))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(pa.array(at)), pa.array(np.full(len(at), found.n)),
                     pa.array([Decimal(v) if v < 10**38 else None for v in far], pa.decimal128(38, 0)), whitened, explained],
                    ["_id", "n", "deviation", "whitened", "explained"])

    out = rows.mapInArrow(run, "_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>")
    return out.withColumn("identity_error", F.lit(error))
