"""Embedding whitening from an exact characteristic polynomial.

Vectors become integer vectors, whose scatter is an integer matrix. Its
characteristic polynomial is found modulo many primes (reduction to Hessenberg
form), each prime by a task of its own, and put together by Chinese
remaindering. All its roots are real, so the sign changes of the polynomial
shifted to a point count the roots beyond it: bisection on dyadic numbers
isolates and refines the greatest roots to any precision. A component is the
null vector at its root, by inverse iteration in integers of many bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.common import bounded_batches, written

# An entry c becomes floor(SCALE * c) + SHIFT; products of entries up to LIMIT fit the sums.
SCALE, SHIFT, LIMIT = 64, 1_000_000, 1 << 50
COMPONENTS = 16
# Bits that a root is found to beyond its greatest one, and bits of the null vectors.
ROOT_BITS, VECTOR_BITS = 160, 640
# Rows that are multiplied at once: products of 20-bit limbs stay exact in doubles.
CHUNK, LIMB = 4096, 20
LEAST_PRIME, PRIME_BITS = 1 << 30, 30


# --- integer vectors and their scatter -----------------------------------------
def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, x: array<long> without the shift.

    Rows whose vector is null, empty or holds null or non-finite entries go, and
    so do rows of another length than most have (of equally many the longest).
    Entries beyond +-2^50 after scaling count as that.
    """
    finite = F.forall(F.col("v"), lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v")).where((F.size("v") > 0) & F.coalesce(finite, F.lit(False)))
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("long"))
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (size["d"] if size else 0)).select("vec_id", x.alias("x"))


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """x as a sum of limbs of 20 bits, the last with the sign."""
    out = []
    while len(out) == 0 or np.abs(x).max(initial=0) >= 1 << LIMB:
        out.append((x & ((1 << LIMB) - 1)).astype(np.float64))
        x = x >> LIMB
    return [*out, x.astype(np.float64)]


def exact_scatter(x: np.ndarray) -> np.ndarray:
    """Sum of the outer products of the rows, as Python integers."""
    d = x.shape[1]
    total = np.zeros((d, d), dtype=object)
    for at in range(0, len(x), CHUNK):
        limbs = _limbs(x[at : at + CHUNK])
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["x"].to_list()).astype(np.int64)


def _scatter_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """i, j, part: sums over a task's rows; j = -1 are sums of entries, i = j = -1 counts the rows."""
    n, sums, total = 0, 0, 0
    for pdf in batches:
        if len(pdf):
            x = _matrix(pdf)
            n, sums, total = n + len(x), sums + x.sum(axis=0, dtype=object), total + exact_scatter(x)
    if n:
        d = len(sums)
        i, j = np.triu_indices(d)
        yield pd.DataFrame({
            "i": [-1, *range(d), *i], "j": [-1, *[-1] * d, *j],
            "part": [str(v) for v in (n, *sums, *total[i, j])],
        })


def scatter(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """n, S and n * sum(x x') - S S' of the vectors ``x`` (one row a dimension pair reaches the driver)."""
    parts = fit.mapInPandas(_scatter_parts, "i int, j int, part string")
    rows = parts.groupBy("i", "j").agg(F.sum(F.col("part").cast("decimal(38,0)")).cast("string").alias("total")).collect()
    found = {(r["i"], r["j"]): int(r["total"]) for r in rows}
    n = found.get((-1, -1), 0)
    d = sum(1 for i, j in found if j == -1 and i >= 0)
    sums = [found[i, -1] for i in range(d)]
    matrix = np.zeros((d, d), dtype=object)
    for i in range(d):
        for j in range(i, d):
            matrix[i, j] = matrix[j, i] = n * found[i, j] - sums[i] * sums[j]
    return n, sums, matrix


# --- characteristic polynomial -----------------------------------------------------
def _is_prime(n: int) -> bool:
    if any(n % p == 0 for p in (2, 3, 5, 7, 11, 13)):
        return n in (2, 3, 5, 7, 11, 13)
    r = ((n - 1) & (1 - n)).bit_length() - 1
    for a in (2, 3, 5, 7):  # decides below 3 * 10^9
        x = pow(a, (n - 1) >> r, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(r - 1)):
            return False
    return True


def primes(count: int, above: int = LEAST_PRIME) -> list[int]:
    """The first primes above 2^30: products of two residues fit 63 bits."""
    out, n = [], above + 1
    while len(out) < count:
        if _is_prime(n):
            out.append(n)
        n += 2
    return out


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Characteristic polynomial modulo p, lowest power first: Hessenberg form, then its recurrence."""
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        h[[k + 1, pivot]] = h[[pivot, k + 1]]
        h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(d):
        new = -int(h[k, k]) % p * polys[k] % p
        new[1:] += polys[k, :-1]
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            new = new - int(h[i, k]) * chain % p * polys[i] % p
        polys[k + 1] = new % p
    return polys[d]


def coefficient_bits(matrix: np.ndarray) -> int:
    """Bits that hold every coefficient and its sign: the k-th is at most C(d, k) (trace / d)^k."""
    d = len(matrix)
    mean = -(-int(np.trace(matrix)) // d) + 1
    return max(math.comb(d, k) * mean**k for k in range(d + 1)).bit_length() + 1


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Integer coefficients of det(t I - matrix), lowest power first, for a positive semidefinite integer matrix.

    A task takes a prime; the driver gets d + 1 residues for each. Their number
    grows with the square of d and the logarithm of the number of rows.
    """
    d = len(matrix)
    chosen = primes(coefficient_bits(matrix) // PRIME_BITS + 1)
    text = [[str(v) for v in row] for row in matrix.tolist()]

    def residues(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = np.array([[int(v) for v in row] for row in text], dtype=object)
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"p": pdf["p"], "poly": [polynomial_mod(whole, int(p)).tolist() for p in pdf["p"]]})

    tasks = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(max(1, min(len(chosen), 4 * spark.sparkContext.defaultParallelism)), "p")
    rows = tasks.mapInPandas(residues, "p long, poly array<long>").collect()
    found, modulus = [0] * (d + 1), 1
    for row in rows:
        inverse = pow(modulus, -1, row["p"])
        found = [c + modulus * ((r - c) * inverse % row["p"]) for c, r in zip(found, row["poly"], strict=True)]
        modulus *= row["p"]
    return [c - modulus if c > modulus // 2 else c for c in found]


# --- roots ----------------------------------------------------------------------------
def roots_beyond(poly: list[int], point: int, bits: int) -> int:
    """Roots greater than point / 2^bits of a polynomial whose roots are all real (each as often as it occurs).

    The roots beyond a point are the positive roots of the shifted polynomial,
    and of those a real-rooted polynomial has as many as its coefficients change sign.
    """
    d = len(poly) - 1
    shifted = [c << (bits * (d - k)) for k, c in enumerate(poly)]  # of 2^(bits d) p(t / 2^bits)
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            shifted[k] += point * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(poly: list[int], point: int, bits: int) -> int:
    """Sign of the polynomial at point / 2^bits."""
    value = 0
    for k, c in enumerate(reversed(poly)):
        value = value * point + (c << (bits * k))
    return (value > 0) - (value < 0)


def _refined(poly: list[int], low: int, high: int, beyond: int, bits: int) -> int:
    """The end of the unit interval that holds the only root of (low, high], which ``beyond`` others exceed."""
    after = -1 if beyond % 2 else 1
    while high - low > 1:
        middle = (low + high) // 2
        if _sign(poly, middle, bits) == -after:
            low = middle
        else:
            high = middle
    return high


def greatest_roots(poly: list[int], count: int, bound: int, bits: int = ROOT_BITS) -> list[Fraction]:
    """The ``count`` greatest roots to 2^-bits of the bound, repeated ones as often as they occur.

    All roots lie in [0, bound]. Counting the roots beyond a middle isolates
    them; one that is alone in its interval is refined by signs.
    """
    extra = max(0, bits - bound.bit_length())
    found: list[Fraction] = []
    # Intervals (low, high] of whole multiples of 2^-extra, with the roots beyond their ends.
    todo = [(-1, bound << extra, len(poly) - 1, 0)]
    while todo and len(found) < count:
        low, high, beyond_low, beyond_high = todo.pop()
        if beyond_low - beyond_high == 1:
            found.append(Fraction(_refined(poly, low, high, beyond_high, extra), 1 << extra))
        elif beyond_low > beyond_high and high - low == 1:
            found += [Fraction(high, 1 << extra)] * (beyond_low - beyond_high)
        elif beyond_low > beyond_high:
            middle = (low + high) // 2
            beyond = roots_beyond(poly, middle, extra)
            todo += [(low, middle, beyond_low, beyond), (middle, high, beyond, beyond_high)]
    return found[:count]


# --- null vectors ---------------------------------------------------------------------
def _solver(matrix: np.ndarray, root: Fraction, bits: int):
    """Fixed-point elimination of matrix - root I, and the substitution for a right side."""
    d = len(matrix)
    a = np.array([[int(v) << bits for v in row] for row in matrix.tolist()], dtype=object)
    for i in range(d):
        a[i, i] -= (root.numerator << bits) // root.denominator
    steps = []
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        a[[k, pivot]] = a[[pivot, k]]
        a[k, k] = a[k, k] or 1
        factor = (a[k + 1 :, k] << bits) // a[k, k]
        a[k + 1 :, k:] -= (factor[:, None] * a[k, k:]) >> bits
        steps.append((pivot, factor))

    def solve(b: np.ndarray) -> np.ndarray:
        b = b.copy()
        for k, (pivot, factor) in enumerate(steps):
            b[[k, pivot]] = b[[pivot, k]]
            b[k + 1 :] -= (factor * b[k]) >> bits
        for k in range(d - 1, -1, -1):
            b[k] = ((b[k] - ((a[k, k + 1 :] * b[k + 1 :]).sum() >> bits if k < d - 1 else 0)) << bits) // a[k, k]
        return b

    return solve


def _unit(v: np.ndarray, bits: int) -> np.ndarray:
    v = v << max(0, 2 * bits - max(abs(c) for c in v).bit_length())
    length = math.isqrt(int((v * v).sum()))
    return (v << bits) // length


def null_vectors(matrix: np.ndarray, roots: list[Fraction], bits: int = VECTOR_BITS) -> np.ndarray:
    """A unit vector for every root, in descending order, by inverse iteration; roots that agree get orthogonal ones."""
    found: list[np.ndarray] = []
    d = len(matrix)
    scale = max(int(np.trace(matrix)), 1)
    solve, of = None, None
    for k, root in enumerate(roots):
        near = [v for r, v in zip(roots, found, strict=False) if abs(r - root) * (1 << 100) <= scale]
        if solve is None or of != root:
            solve, of = _solver(matrix, root, bits), root
        v = _unit(np.array([((i * 2654435761 + k * 40503 + 12345) % 65521) + 1 << bits for i in range(d)], dtype=object), bits)
        for _ in range(4):
            for other in near:
                v = v - (((v * other).sum() >> bits) * other >> bits)
            v = _unit(solve(_unit(v, bits)), bits)
        for other in near:
            v = v - (((v * other).sum() >> bits) * other >> bits)
        found.append(_unit(v, bits))
    return np.array([[float(Fraction(int(c), 1 << bits)) for c in v] for v in found]).reshape(len(found), d)


# --- the operator ------------------------------------------------------------------------
class Whitening:
    """What a fit keeps: n, the sums, and per component its eigenvalue of the covariance and unit vector."""

    def __init__(self, n: int, sums: list[int], roots: list[Fraction], trace: int, vectors: np.ndarray):
        self.n, self.sums, self.vectors = n, sums, vectors
        self.values = [root / n**2 for root in roots]
        self.explained = [float(root / trace) for root in roots]
        self.scale = [math.sqrt(v) for v in self.values]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S: exact, as integers."""
        wide = self.n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, self.sums), default=0)
        if wide < 1 << 62:
            return x * self.n - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return deviations.astype(np.float64) / self.n @ (self.vectors / np.array(self.scale)[:, None]).T


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening learned from the distinct vectors ``x``; components of no variance are left out, None where all are."""
    n, sums, matrix = scatter(fit)
    trace = int(np.trace(matrix)) if len(sums) else 0
    if not trace:
        return None
    # A common divisor of all entries makes the numbers smaller and scales the roots alone.
    common = math.gcd(*matrix.ravel().tolist())
    matrix = matrix // common
    poly = characteristic_polynomial(fit.sparkSession, matrix)
    wanted = min(components, len(sums) - next(k for k, c in enumerate(poly) if c))
    roots = greatest_roots(poly, wanted, trace // common + 1)
    return Whitening(n, sums, [r * common for r in roots], trace, null_vectors(matrix, roots))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, over ``fit``."""
    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = 0
        for pdf in batches:
            if len(pdf):
                w = model.whitened(model.deviations(_matrix(pdf)))
                total = total + np.hstack([w, np.ones((len(w), 1))]).T @ np.hstack([w, np.ones((len(w), 1))])
        if not np.isscalar(total):
            i, j = np.triu_indices(len(total))
            yield pd.DataFrame({"i": i, "j": j, "part": total[i, j]})

    rows = fit.mapInPandas(parts, "i int, j int, part double").groupBy("i", "j").agg(F.sum("part").alias("total")).collect()
    k = len(model.scale)
    sums = {(r["i"], r["j"]): r["total"] / model.n for r in rows}
    off = (sums[i, j] - sums[i, k] * sums[j, k] - (i == j) for i in range(k) for j in range(i, k))
    return max(map(abs, off))


def _whole(deviations: np.ndarray) -> list[int | None]:
    """Sums of squares, exact; null beyond 63 bits."""
    most = int(np.abs(deviations).max(initial=0))
    if most * most * deviations.shape[1] < 1 << 62:
        return (deviations * deviations).sum(axis=1).tolist()
    wide = deviations.astype(object)
    return [v if v < 1 << 63 else None for v in (wide * wide).sum(axis=1).tolist()]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Fitted on the distinct integer vectors, applied to every row that
    :func:`integer_vectors` keeps (repeated rows and ids, and null ids, as often
    as they occur; other columns are ignored). A deviation that no long holds is
    null. Without rows, or where all vectors are equal, there are no components
    and no rows. Only sums by pair of dimensions and residues by prime reach the driver.
    """
    rows = bounded_batches(integer_vectors(vectors))
    fit = written(rows.select("x").distinct(), "vectors")
    model = fit_whitening(fit, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    error, k = identity_error(fit, model), len(model.scale)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            deviations = model.deviations(_matrix(pdf))
            yield pd.DataFrame({
                "vec_id": np.repeat(pdf["vec_id"].array, k), "component": np.tile(np.arange(1, k + 1), len(pdf)), "n": model.n,
                "deviation": np.repeat(np.array(_whole(deviations), dtype=object), k), "whitened": model.whitened(deviations).ravel(),
                "explained": np.tile(model.explained, len(pdf)), "identity_error": error,
            })

    return rows.mapInPandas(project, schema)


def op12_whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, their 16 greatest components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
