"""Whitening of embeddings: exact integer scatter, exact characteristic polynomial, unit components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.spectrum import principal_components
from cdclake.llm.tables import column, numpy_column, written

COMPONENTS = 32
#: Steps of the grid that entries are put on in a unit, and what is added.
STEPS, SHIFT = 64, 1_000_000
#: Entries beyond these are taken for them: a long holds no more.
_MOST = float(1 << 62)
_LIMB, _DIGIT = 21, 30
#: Rows whose products of limbs a double still adds up exactly.
_ROWS = 1 << (53 - 2 * _LIMB)


def _grid(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """Entries as whole steps, without the shift: it changes no deviation from the mean."""
    values = batch.column(batch.schema.get_field_index("embedding")).flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        steps = np.floor(STEPS * values.astype(np.float64))
    return np.clip(steps, -_MOST, _MOST).astype(np.int64).reshape(-1, dim)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Doubles of at most 21 bits, the last one with the sign, that make up the numbers."""
    parts = []
    while y.size and max(int(y.max()), -int(y.min())) >= 1 << _LIMB:
        parts.append((y & ((1 << _LIMB) - 1)).astype(np.float64))
        y = y >> _LIMB
    return [*parts, y.astype(np.float64)]


class _Sums:
    """Exact sums of entries and of their products."""

    def __init__(self, dim: int):
        self.n = 0
        self._dim = dim
        self.sums = np.zeros(dim, dtype=object)
        self.products = np.zeros((dim, dim), dtype=object)
        self._held: dict[int, np.ndarray] = {}
        self._added = 0

    def add(self, y: np.ndarray) -> None:
        self.n += len(y)
        parts = _limbs(y)
        for a, left in enumerate(parts):
            self.sums += left.sum(axis=0).astype(np.int64).astype(object) << (_LIMB * a)
            for b, right in enumerate(parts):
                held = self._held.setdefault(_LIMB * (a + b), np.zeros((self._dim, self._dim), dtype=np.int64))
                held += (left.T @ right).astype(np.int64)
        # Each addition is below 2^53 for a pair of limbs, and at most three pairs share a place.
        self._added += 3
        if self._added > 1000:
            self._settle()

    def _settle(self) -> None:
        for bits, held in self._held.items():
            self.products += held.astype(object) << bits
        self._held, self._added = {}, 0

    def cells(self) -> list[int]:
        """The count, the sums, and the products of each two dimensions once."""
        self._settle()
        return [self.n, *self.sums, *self.products[np.triu_indices(self._dim)]]


def _digits(cells: list[int]) -> pa.RecordBatch:
    """Numbers of any size as digits of 30 bits, the last one with the sign: sums of digits fit into a long."""
    cell, place, digit = [], [], []
    for k, value in enumerate(cells):
        at, value = 0, int(value)
        while value:
            last = -(1 << _DIGIT) <= value < 1 << _DIGIT
            cell.append(k)
            place.append(at)
            digit.append(value if last else value & ((1 << _DIGIT) - 1))
            value = 0 if last else value >> _DIGIT
            at += 1
    arrays = [pa.array(cell, pa.int64()), pa.array(place, pa.int64()), pa.array(digit, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["cell", "place", "digit"])


def _usable(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, int | None]:
    """Rows with finite vectors of the length that most of them have (of several the greatest), and that length."""
    rows = vectors.select(column(vec_id).alias("vec_id"), column(embedding).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.coalesce(finite & (F.size("embedding") > 0), F.lit(False)))
    size = F.size("embedding").alias("size")
    most = rows.groupBy(size).count().orderBy(F.desc("count"), F.desc("size")).first()
    return (rows.filter(F.size("embedding") == most["size"]), most["size"]) if most else (rows, None)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, _ROWS):
            yield batch.slice(low, _ROWS)


@dataclass
class Whitening:
    """What is fitted: all of it grows with the number of dimensions only."""

    n: int
    sums: list[int]
    #: Eigenvalues of n^2 times the covariance, its unit vectors, and its trace.
    eigenvalues: list
    vectors: list[list[float]]
    trace: int

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.eigenvalues]


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """The components of all rows of ``embedding``, from exact sums.

    With x the entries on the grid, n times the sum of products x_i x_j less the product of both sums is n^2 times their
    covariance, in integers and without any rounding, so it is the same as if entries were centred first. Tasks add up
    their own rows; digits of what they found are added by Spark.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(dim)
        for part in _pieces(batches):
            sums.add(_grid(part, dim))
        if sums.n:
            yield _digits(sums.cells())

    parts = rows.select("embedding").mapInArrow(run, "cell long, place long, digit long")
    cells = [0] * (1 + dim + dim * (dim + 1) // 2)
    for r in parts.groupBy("cell", "place").agg(F.sum("digit").alias("digit")).toArrow().to_pylist():
        cells[r["cell"]] += r["digit"] << (_DIGIT * r["place"])
    n, sums = cells[0], cells[1 : dim + 1]
    products = np.zeros((dim, dim), dtype=object)
    products[np.triu_indices(dim)] = cells[dim + 1 :]
    upper = [[int(products[min(i, j), max(i, j)]) for j in range(dim)] for i in range(dim)]
    scatter = [[n * upper[i][j] - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]
    found = principal_components(rows.sparkSession, scatter, min(components, dim))
    return Whitening(n, sums, [e for e, _ in found], [v for _, v in found], sum(scatter[k][k] for k in range(dim)))


def transform(rows: DataFrame, dim: int, model: Whitening) -> DataFrame:
    """Rows (vec_id, deviation, whitened): the exact sum of squared n-fold deviations, and a coordinate per component."""
    n, sums, k = model.n, np.array(model.sums, dtype=object), len(model.vectors)
    # A deviation is n^2 times the covariance's, so its root is n times that of the eigenvalue.
    scale = [math.sqrt(e) for e in model.eigenvalues]
    turn = np.array(model.vectors).reshape(k, dim).T / np.array(scale).reshape(1, k)
    largest = max((abs(s) for s in model.sums), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches):
            y = _grid(part, dim)
            bound = n * max(int(y.max()), -int(y.min())) + largest
            if bound * bound * dim < 1 << 63:
                centred = n * y - sums.astype(np.int64)
                deviation = pa.array((centred * centred).sum(axis=1))
            else:
                centred = n * y.astype(object) - sums
                exact = (centred * centred).sum(axis=1)
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            out = centred.astype(np.float64) @ turn
            offsets = pa.array(np.arange(len(y) + 1, dtype=np.int32) * k)
            whitened = pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), deviation, whitened], names=["vec_id", "deviation", "whitened"])

    ids = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {ids}, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, n: int, k: int) -> float | None:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity; null without components."""
    if not k:
        return None

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for part in _pieces(batches):
            yield numpy_column(pa.RecordBatch.from_arrays([part.column(0).flatten()], names=["v"]), "v").reshape(-1, k)

    def added(work, cells: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(cells)
            for matrix in matrices(batches):
                total += work(matrix)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array(total)], names=["cell", "value"])

        table = whitened.select("whitened").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(cells)
        out[table.column("cell").to_numpy()] = table.column("value").to_numpy()
        return out / n

    means = added(lambda w: w.sum(axis=0), k)
    covariance = added(lambda w: ((w - means).T @ (w - means)).ravel(), k * k).reshape(k, k)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error): one per vector and component.

    Entries become whole numbers x = floor(64 c) + 1000000. Components are the unit eigenvectors of the covariance of all
    x (divisor n), numbered from 1 by falling eigenvalue e; ``whitened`` is the deviation from the mean along one, over the
    root of e; ``deviation`` the exact sum over all dimensions of (n x - S)^2, S the sums; ``explained`` is e over the trace.
    ``identity_error`` is how far the covariance of ``whitened``, centred, is from the identity.

    The scatter is summed in integers, its characteristic polynomial computed modulo primes by Hessenberg reduction and put
    together by remainders, its roots isolated and narrowed as fractions, and each vector found by inverse iteration in
    fixed point, with as many bits as its distance to the next root asks for. Where an eigenvalue is several times there,
    any vectors at right angles in its space are right. The same signs hold for all rows: the largest entry is positive.

    Rows whose vector is null or empty or holds null or non-finite entries are dropped, and those of another length than
    most have (of several the greatest). Rows are not told apart by id: repeated rows and null ids count and return as they
    are. Entries beyond 2^62 steps are taken for that; ``deviation`` is null where a long can't hold it. A component without
    variance has null ``whitened`` and 0 ``explained``, null if nothing varies; ``identity_error`` leaves it out, and is
    null where none is left. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    rows, dim = _usable(vectors, vec_id, embedding)
    model = fit(rows, dim, components) if dim else Whitening(0, [], [], [], 0)
    told = written(transform(rows, dim or 1, model), "whitened")
    k, shown = len(model.vectors), min(components, dim or 0)
    error = identity_error(told, model.n, k)
    shares = [*model.explained, *[0.0 if model.trace else None] * (shown - k)]
    shares = spark.createDataFrame([(j + 1, s) for j, s in enumerate(shares)], "component int, explained double")
    # One small row per component is all that is joined.
    filled = told.select("vec_id", "deviation", F.explode(F.sequence(F.lit(1), F.lit(shown))).alias("component"), "whitened") if shown else None
    if filled is None:
        filled = told.select("vec_id", "deviation", F.lit(None).cast("int").alias("component"), "whitened").limit(0)
    return filled.join(F.broadcast(shares), "component").select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation",
        F.get("whitened", F.col("component") - 1).alias("whitened"), "explained", F.lit(error).cast("double").alias("identity_error"),
    )
