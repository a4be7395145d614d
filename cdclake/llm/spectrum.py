"""Eigenvalues and eigenvectors of an integer matrix from its exact characteristic polynomial.

Numbers here are Python integers and fractions; only the work modulo a prime is done in arrays. All of it depends
on the number of dimensions alone, and the costly parts (one prime, one eigenvalue) are each a row of a Spark job.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Bits to which an eigenvector is right, beside what the distance to the next eigenvalue costs.
_GUARD = 80
_WITNESSES = (2, 3, 5, 7)


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test, which is exact below 2^31 with these witnesses."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in _WITNESSES:
        x = pow(a, odd, n)
        if x in (1, n - 1):
            continue
        if not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes(bits: int) -> list[int]:
    """Primes below 2^31, from the largest on, with a product of more than ``bits`` bits."""
    found, product, n = [], 1, (1 << 31) - 1
    while product.bit_length() <= bits:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def coefficient_bits(trace: int, dim: int) -> int:
    """Bits of the largest coefficient that a matrix without negative eigenvalues can have (Maclaurin's bound), and a sign."""
    return max((math.comb(dim, k) * trace**k // dim**k + 1).bit_length() for k in range(dim + 1)) + 1


def hessenberg_polynomial(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(xI - A) modulo a prime, of x^0 first, by reduction to Hessenberg form."""
    h = matrix.copy() % p
    dim = len(h)
    for k in range(1, dim - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        swap = k + int(below[0])
        if swap != k:
            h[[k, swap]] = h[[swap, k]]
            h[:, [k, swap]] = h[:, [swap, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factor % p).sum(axis=1)) % p
    # The polynomial of each leading part follows from those before it.
    parts = np.zeros((dim + 1, dim + 1), dtype=np.int64)
    parts[0, 0] = 1
    for k in range(1, dim + 1):
        weights, product = np.zeros(k, dtype=np.int64), 1
        for row in range(k - 1, -1, -1):
            weights[row] = h[row, k - 1] * product % p
            product = product * int(h[row, row - 1]) % p if row else 0
        parts[k, 1:] = parts[k - 1, :-1]
        parts[k] = (parts[k] - (weights[:, None] * parts[:k] % p).sum(axis=0)) % p
    return parts[dim]


def combined(residues: list[tuple[int, list[int]]]) -> list[int]:
    """Integers from their residues modulo primes, between minus and plus half of the product."""
    product = math.prod(p for p, _ in residues)
    total = [0] * len(residues[0][1])
    for p, values in residues:
        rest = product // p
        unit = rest * pow(rest, -1, p)
        total = [t + unit * int(v) for t, v in zip(total, values, strict=True)]
    return [t % product - product if t % product > product // 2 else t % product for t in total]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(xI - A), of x^0 first, of a symmetric integer matrix without negative eigenvalues.

    Each prime is a row of a Spark job; what comes back grows with the number of dimensions only.
    """
    dim = len(matrix)
    moduli = primes(coefficient_bits(sum(matrix[k][k] for k in range(dim)), dim) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for p in batch.column(0).to_pylist():
                found.append(hessenberg_polynomial(np.array([[v % p for v in row] for row in matrix], dtype=np.int64), p))
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["p", "c"])

    rows = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(max(1, min(len(moduli) // 8, 1024)))
    return combined([(r["p"], r["c"]) for r in rows.mapInArrow(run, "p long, c array<long>").collect()])


# Roots

def _trimmed(c: list[int]) -> list[int]:
    while c and c[-1] == 0:
        c = c[:-1]
    return c


def _gcd_modulo(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """The monic greatest common divisor of two polynomials modulo a prime."""
    a, b = np.trim_zeros(a % p, "b"), np.trim_zeros(b % p, "b")
    while len(b):
        lead = pow(int(b[-1]), -1, p)
        while len(a) >= len(b):
            factor = int(a[-1]) * lead % p
            a = a.copy()
            a[len(a) - len(b) :] = (a[len(a) - len(b) :] - factor * b % p) % p
            a = np.trim_zeros(a, "b")
        a, b = b, a
    return a * pow(int(a[-1]), -1, p) % p


def _divided(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Quotient and rest of a division by a monic polynomial."""
    rest, out = list(a), [0] * (len(a) - len(b) + 1)
    for k in range(len(out) - 1, -1, -1):
        out[k] = rest[k + len(b) - 1]
        if out[k]:
            for j, v in enumerate(b):
                rest[k + j] -= out[k] * v
    return out, _trimmed(rest)


def square_free(c: list[int]) -> list[int]:
    """The monic polynomial with the same roots, each once.

    The common divisor with the derivative is found modulo primes, put together, and divides exactly.
    """
    slope = [k * v for k, v in enumerate(c)][1:]
    if len(c) < 3:
        return c
    bits = max(abs(v) for v in c).bit_length() + 2 * len(c)
    found: list[tuple[int, list[int]]] = []
    for p in primes(bits):
        g = _gcd_modulo(np.array([v % p for v in c], dtype=np.int64), np.array([v % p for v in slope], dtype=np.int64), p)
        if len(g) == 1:
            return c
        # A prime may be unlucky and show a divisor of higher degree than there is.
        if found and len(g) > len(found[0][1]):
            continue
        if found and len(g) < len(found[0][1]):
            found = []
        found.append((p, g.tolist()))
    quotient, rest = _divided(c, combined(found))
    if rest:
        raise ArithmeticError("the common divisor does not divide the polynomial")
    return quotient


def roots_above(c: list[int], at: Fraction) -> int:
    """How many roots of a polynomial with real roots only are greater than a dyadic number.

    Shifted there, its sign changes are as many as its positive roots (Descartes), each counted as often as it is one.
    """
    shift, bits = at.numerator, at.denominator.bit_length() - 1
    top = len(c) - 1
    c = [v << (bits * (top - k)) for k, v in enumerate(c)]
    for low in range(top):
        for k in range(top - 1, low - 1, -1):
            c[k] += shift * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs[:-1], signs[1:], strict=True))


def _sign(c: list[int], at: Fraction) -> int:
    shift, bits = at.numerator, at.denominator.bit_length() - 1
    total = 0
    for k, v in enumerate(reversed(c)):
        total = total * shift + (v << (bits * k))
    return (total > 0) - (total < 0)


@dataclass
class Root:
    """A root in the interval (low, high], or at its end, how often it is one, and how far the next one is at least."""

    low: Fraction
    high: Fraction
    times: int
    apart: Fraction = Fraction(0)

    def narrow(self, c: list[int], width: Fraction) -> None:
        if self.low == self.high:
            return
        above = _sign(c, self.high)
        if above == 0:
            self.low = self.high
            return
        while self.high - self.low > width:
            middle = (self.low + self.high) / 2
            found = _sign(c, middle)
            if found == 0:
                self.low = self.high = middle
            elif found == above:
                self.high = middle
            else:
                self.low = middle

    @property
    def value(self) -> Fraction:
        return (self.low + self.high) / 2


def isolated_roots(polynomial: list[int], wanted: int) -> list[Root]:
    """The greatest roots, at least ``wanted`` of them counted with their multiplicity and one more, in falling order.

    The polynomial is monic, with integer coefficients and real roots that are not negative. Each root is alone in
    its interval, which is by 80 bits narrower than the distance to the next root.
    """
    zeros = next(k for k, v in enumerate(polynomial) if v)
    rest = polynomial[zeros:]
    simple = square_free(rest)
    top = Fraction(1 << (abs(rest[-2]).bit_length() if len(rest) > 1 else 1))
    found: list[Root] = []
    stack = [(Fraction(0), top, roots_above(simple, Fraction(0)), 0)]
    while stack and sum(r.times for r in found) <= wanted:
        low, high, more, less = stack.pop()
        if more - less == 0:
            continue
        if more - less == 1:
            times = 1 if simple is rest else roots_above(rest, low) - roots_above(rest, high)
            found.append(Root(low, high, times))
            continue
        middle = (low + high) / 2
        between = roots_above(simple, middle)
        stack += [(low, middle, more, between), (middle, high, between, less)]
    if zeros and not stack:
        found.append(Root(Fraction(0), Fraction(0), zeros))
    width = top / (1 << (_GUARD + 32))
    while True:
        for root in found:
            root.narrow(simple, width)
        gaps = [a.low - b.high for a, b in zip(found[:-1], found[1:], strict=True)]
        for k, root in enumerate(found):
            root.apart = min([*gaps[max(0, k - 1) : k + 1], *([top] if len(found) == 1 else [])])
        if all(r.apart > 0 and (r.high - r.low) * (1 << _GUARD) <= r.apart for r in found):
            return found
        width /= 1 << 64


# Vectors

def _solved(rows: np.ndarray, order: list[int], right: list[int], bits: int) -> list[int]:
    """The solution of a factored system, in fixed point."""
    dim = len(order)
    y = [right[k] for k in order]
    for k in range(dim):
        y[k] -= sum(int(rows[k, j]) * y[j] for j in range(k)) >> bits
    for k in range(dim - 1, -1, -1):
        y[k] -= sum(int(rows[k, j]) * y[j] for j in range(k + 1, dim)) >> bits
        y[k] = (y[k] << bits) // int(rows[k, k])
    return y


def _factored(matrix: list[list[int]], value: Fraction, scale: int, bits: int) -> tuple[np.ndarray, list[int]]:
    """Triangular factors of A - value, its greatest entry about 1, in one matrix, and the order of its rows."""
    dim = len(matrix)
    top, below = value.numerator, value.denominator
    rows = np.empty((dim, dim), dtype=object)
    for i in range(dim):
        for j in range(dim):
            rows[i, j] = ((matrix[i][j] * below - (top if i == j else 0)) << bits) // (below << scale)
    order = list(range(dim))
    for k in range(dim):
        pivot = max(range(k, dim), key=lambda i: abs(rows[i, k]))
        if pivot != k:
            rows[[k, pivot]] = rows[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if rows[k, k] == 0:
            rows[k, k] = 1
        for i in range(k + 1, dim):
            factor = (rows[i, k] << bits) // rows[k, k]
            rows[i, k] = factor
            if factor:
                rows[i, k + 1 :] -= (factor * rows[k, k + 1 :]) >> bits
    return rows, order


def null_vectors(matrix: list[list[int]], root: Root) -> list[list[float]]:
    """Unit vectors, at right angles to each other, of the space that belongs to an eigenvalue.

    Inverse iteration in fixed point, with more bits until what is left of (A - value)v, divided by the distance to the
    next eigenvalue, bounds the error of v below the precision of a double.
    """
    dim = len(matrix)
    scale = max(abs(v) for row in matrix for v in row).bit_length()
    lost = max(0, scale - root.apart.numerator.bit_length() + root.apart.denominator.bit_length() + 1)
    bits = 4 * _GUARD + 2 * lost
    value = root.value
    while True:
        rows, order = _factored(matrix, value, scale, bits)
        vectors: list[list[int]] = []
        for number in range(root.times):
            # Any start will do that is not at right angles to the space; these differ in every entry.
            v = [pow(3, 1 + number + k * (number + 2), 1_000_003) - 500_000 for k in range(dim)]
            for _ in range(3):
                v = _solved(rows, order, v, bits)
                for u in vectors:
                    share = (sum(a * b for a, b in zip(u, v, strict=True)) << bits) // sum(a * a for a in u)
                    v = [b - ((share * a) >> bits) for a, b in zip(u, v, strict=True)]
                excess = max(max(abs(a) for a in v).bit_length() - bits, 0)
                v = [a >> excess for a in v]
            vectors.append(v)
        if all(_is_close(matrix, value, v, root.apart) for v in vectors):
            return [_unit(v) for v in vectors]
        bits *= 2


def _is_close(matrix: list[list[int]], value: Fraction, v: list[int], apart: Fraction) -> bool:
    left = [sum(a * b for a, b in zip(row, v, strict=True)) * value.denominator - value.numerator * x for row, x in zip(matrix, v, strict=True)]
    size = sum(x * x for x in left)
    bound = (apart * value.denominator) ** 2 * sum(x * x for x in v) / (1 << 120)
    return size <= bound


def _unit(v: list[int]) -> list[float]:
    norm = math.isqrt(sum(x * x for x in v) << 128)
    sign = -1 if v[max(range(len(v)), key=lambda k: abs(v[k]))] < 0 else 1
    return [sign * (x << 64) / norm for x in v]


def principal_components(spark: SparkSession, matrix: list[list[int]], wanted: int) -> list[tuple[Fraction, list[float]]]:
    """The greatest eigenvalues and their unit vectors, in falling order, of a symmetric integer matrix without negative ones.

    Eigenvalues of zero are left out, so there may be fewer than ``wanted``.
    """
    shared = math.gcd(*[v for row in matrix for v in row])
    if not shared:
        return []
    matrix = [[v // shared for v in row] for row in matrix]
    roots = isolated_roots(characteristic_polynomial(spark, matrix), wanted)
    roots = [r for r in roots if r.high > 0]
    # The last root is there to bound the distance of the one before it.
    needed = [r for k, r in enumerate(roots) if sum(x.times for x in roots[:k]) < wanted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                vectors = null_vectors(matrix, needed[k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(vectors)), pa.array(range(len(vectors)), pa.int64()), pa.array(vectors, pa.list_(pa.float64()))],
                    names=["root", "number", "vector"],
                )

    rows = spark.createDataFrame([(k,) for k in range(len(needed))], "root long").repartition(len(needed), "root")
    found = sorted((r["root"], r["number"], r["vector"]) for r in rows.mapInArrow(run, "root long, number long, vector array<double>").collect())
    return [(needed[k].value * shared, list(v)) for k, _, v in found][:wanted]
