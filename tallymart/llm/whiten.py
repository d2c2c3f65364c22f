"""Embedding whitening through the exact characteristic polynomial of the integer scatter.

Every entry c becomes the integer x = floor(1024 c) + 100000. With n vectors and sums S the scatter
M = n * sum(x x') - S S' is an integer matrix, and the covariance is M / n^2.

1. Spark sums x and x x' exactly, in integers of any size (the constant 100000 cancels in M).
2. The characteristic polynomial of M is computed modulo many primes, one row per prime: similarity
   transformations bring M to Hessenberg form, whose polynomial follows by a recurrence. Coefficients
   are put together by Chinese remaindering, one group per coefficient; as many primes are taken as
   the bound (1 + trace / d)^d on the coefficients of a positive semidefinite matrix asks for.
3. All roots are real, so the sign changes of the polynomial shifted by a count its roots above a,
   exactly (Budan-Fourier). Bisection isolates the largest roots to ``ROOT_BITS`` bits below the
   trace; roots that stay together are one eigenvalue of that multiplicity.
4. For each root, inverse iteration in ``WORK_BITS``-bit fixed point finds the null space of
   M - root, to far beyond double precision.
5. Rows are projected where they lie.

What steps 2 to 4 hold depends on the dimensions of a vector, not on the number of rows: d^2 sums
and polynomials of degree d. They suit hundreds of dimensions.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.workspace import scratch_dir, write_and_read

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
ROOT_BITS = 128  # roots are known to trace / 2**ROOT_BITS
SAME_BITS = 100  # roots nearer than trace / 2**SAME_BITS count as one
WORK_BITS = 320
SUM_BITS = 40  # sums travel as digits of this many bits, so that no long overflows
LIMIT = float(1 << 62)  # entries beyond +-2**62 / 1024 saturate


def usable(vector: Column) -> Column:
    """Neither NULL nor with NULL or non-finite entries."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (
        F.abs(x.cast("double")) == F.lit(float("inf"))))


def integers(vectors: pd.Series, dimensions: int) -> np.ndarray:
    """floor(1024 c) of every entry, one row per vector."""
    values = np.array([np.asarray(v, dtype=np.float64) for v in vectors], dtype=np.float64)
    with np.errstate(over="ignore"):
        scaled = np.floor(values.reshape(len(vectors), dimensions) * SCALE)
    return np.clip(scaled, -LIMIT, LIMIT).astype(np.int64)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed digits to the base 2**15, lowest first, as doubles; their products sum up exactly."""
    digits = []
    while np.any(y):
        low = ((y + (1 << 14)) & ((1 << 15) - 1)) - (1 << 14)
        digits.append(low.astype(np.float64))
        y = (y - low) >> 15
    return digits


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for at in range(0, len(y), 1 << 20):  # 2**28 each, so a sum stays below 2**53
        digits = _limbs(y[at:at + (1 << 20)])
        for i, a in enumerate(digits):
            for j, b in enumerate(digits):
                total += (a.T @ b).astype(np.int64).astype(object) << (15 * (i + j))
    return total


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """(place, digit) to the base 2**SUM_BITS; digits have the sign of the value."""
    sign, rest, place = (1 if value >= 0 else -1), abs(value), 0
    while rest:
        yield place, sign * (rest & ((1 << SUM_BITS) - 1))
        rest >>= SUM_BITS
        place += 1


def scatter(vectors: DataFrame, dimensions: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums of floor(1024 c), and M; ``vectors`` has one usable column ``v``."""
    d = dimensions

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, first, second = 0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)
        for batch in batches:
            y = integers(batch["v"], d)
            n += len(y)
            first += y.astype(object).sum(axis=0) if len(y) else 0
            second += exact_products(y)
        rows = [(-1, place, digit) for place, digit in _digits(n)]
        for i in range(d):
            rows += [(i, place, digit) for place, digit in _digits(first[i])]
            for j in range(i, d):
                rows += [(d + i * d + j, place, digit) for place, digit in _digits(second[i, j])]
        yield pd.DataFrame(rows, columns=["cell", "place", "digit"])

    found: dict[int, int] = {}
    for r in (vectors.select("v").mapInPandas(sums, "cell int, place int, digit long")
              .groupBy("cell", "place").agg(F.sum("digit").alias("digit")).collect()):
        found[r["cell"]] = found.get(r["cell"], 0) + (r["digit"] << (SUM_BITS * r["place"]))
    n, s = found.get(-1, 0), [found.get(i, 0) for i in range(d)]
    return n, s, [[n * found.get(d + min(i, j) * d + max(i, j), 0) - s[i] * s[j]
                   for j in range(d)] for i in range(d)]


def primes_below(limit: int, product: int) -> list[int]:
    """Primes from ``limit`` downwards whose product exceeds ``product``."""
    found, total, candidate = [], 1, limit - 1 | 1
    while total <= product:
        if all(_no_witness(candidate, base) for base in (2, 3, 5, 7)):  # exact below 3.2 * 10**9
            found.append(candidate)
            total *= candidate
        candidate -= 2
    return found


def _no_witness(n: int, base: int) -> bool:
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    power = pow(base, odd, n)
    return power in (1, n - 1) or any(
        (power := power * power % n) == n - 1 for _ in range(twos - 1))


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo p, lowest first; entries are in [0, p), p < 2**31."""
    h, d = matrix.copy(), len(matrix)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factors = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - factors[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factors % p).sum(axis=1)) % p
    # The recurrence of the leading blocks' polynomials.
    blocks = np.zeros((d + 1, d + 1), dtype=np.int64)
    blocks[0, 0] = 1
    for k in range(1, d + 1):
        blocks[k, 1:] = blocks[k - 1, :-1]
        weights, chain = np.empty(k, dtype=np.int64), 1
        for i in range(k, 0, -1):
            weights[i - 1] = chain * int(h[i - 1, k - 1]) % p
            if i > 1:
                chain = chain * int(h[i - 1, i - 2]) % p
        blocks[k] = (blocks[k] - (weights[:, None] * blocks[:k] % p).sum(axis=0)) % p
    return blocks[d].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x - matrix), lowest first, for a positive semidefinite integer matrix."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    bound = (-(-trace // d) + 1) ** d  # (1 + trace / d)^d
    primes = primes_below(1 << 31, 2 * bound)
    shared = spark.sparkContext.broadcast(matrix)  # d^2 integers

    def residues(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p in batch["p"].tolist():
                reduced = np.array([[x % p for x in row] for row in shared.value], dtype=np.int64)
                yield pd.DataFrame({"power": range(d + 1), "p": p,
                                    "residue": polynomial_modulo(reduced, p)})

    def remainder(rows: pd.DataFrame) -> pd.DataFrame:
        product = math.prod(rows["p"].tolist())
        value = 0
        for p, residue in zip(rows["p"].tolist(), rows["residue"].tolist()):
            rest = product // p
            value += residue * rest * pow(rest, -1, p)
        value %= product
        value -= product if 2 * value > product else 0
        return pd.DataFrame({"power": rows["power"].iloc[:1], "value": [str(value)]})

    rows = (
        spark.createDataFrame([(p,) for p in primes], "p long")
        .repartition(min(len(primes), spark.sparkContext.defaultParallelism), "p")
        .mapInPandas(residues, "power int, p long, residue long")
        .groupBy("power").applyInPandas(remainder, "power int, value string").collect())
    return [int(r["value"]) for r in sorted(rows, key=lambda r: r["power"])]


def shifted(coefficients: list[int], by: int) -> list[int]:
    """Coefficients of p(x + by)."""
    c = list(coefficients)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += by * c[k + 1]
    return c


def roots_above(coefficients: list[int], bound: int) -> int:
    """How many roots exceed ``bound``, with multiplicity, of a polynomial with real roots only."""
    signs = [c > 0 for c in shifted(coefficients, bound) if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(coefficients: list[int], trace: int, wanted: int) -> list[tuple[int, int]]:
    """(root in units of 2**-ROOT_BITS of the trace's power of two, multiplicity), from the largest.

    Roots are scaled to integers, so that bisection ends at adjacent ones; zero roots are left out.
    """
    d = len(coefficients) - 1
    bits = max(0, ROOT_BITS - trace.bit_length())
    scaled = [c << (bits * (d - k)) for k, c in enumerate(coefficients)]
    together = max(1, trace << bits >> SAME_BITS)
    found: list[tuple[int, int]] = []
    stack = [(0, trace << bits, roots_above(scaled, 0), 0)]  # low, high, roots above each
    while stack and sum(m for _, m in found) < wanted:
        low, high, above_low, above_high = stack.pop()
        if above_low == above_high:
            continue
        single = above_low - above_high == 1
        if high - low <= (1 if single else together):
            found.append(((low + high + 1) // 2, above_low - above_high))
            continue
        middle = (low + high) // 2
        above = _above_single(scaled, middle, above_high) if single \
            else roots_above(scaled, middle)
        stack += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found


def _above_single(coefficients: list[int], at: int, above_high: int) -> int:
    """Roots above ``at`` if there is one root, perhaps, between it and a point with above_high.

    The leading coefficient is 1, so the sign of p(at) tells whether the number is even or odd.
    """
    value = reduce(lambda total, c: total * at + c, reversed(coefficients), 0)
    if value == 0:
        return above_high  # the root itself is not above
    return above_high + ((value < 0) != (above_high % 2 == 1))


def null_space(matrix: list[list[int]], trace: int, root: int, multiplicity: int) -> np.ndarray:
    """Unit eigenvectors of ``matrix`` for a root from :func:`largest_roots`, one per row.

    Gaussian elimination with pivoting in fixed point, then inverse iteration on seeded vectors that
    are kept orthonormal.
    """
    d, one = len(matrix), 1 << WORK_BITS
    unit = max(trace, 1)
    bits = max(0, ROOT_BITS - trace.bit_length())
    a = np.array([[(x << WORK_BITS) // unit for x in row] for row in matrix], dtype=object)
    a[np.diag_indices(d)] -= (root << WORK_BITS) // (unit << bits)
    swaps = []
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        swaps.append(pivot)
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
        if a[k, k] == 0:
            a[k, k] = 1  # the smallest step of the fixed point
        a[k + 1:, k] = (a[k + 1:, k] << WORK_BITS) // a[k, k]
        if k + 1 < d:
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:]) >> WORK_BITS

    def solved(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for k, pivot in enumerate(swaps):
            x[k], x[pivot] = x[pivot], x[k]
            x[k + 1:] -= a[k + 1:, k] * x[k] >> WORK_BITS
        for k in range(d - 1, -1, -1):
            rest = x[k] - (sum(a[k, k + 1:] * x[k + 1:]) >> WORK_BITS if k + 1 < d else 0)
            x[k] = (rest << WORK_BITS) // a[k, k]
        return x

    def normed(x: np.ndarray) -> np.ndarray:
        length = math.isqrt(sum(int(v) * int(v) for v in x))
        return np.array([(int(v) << WORK_BITS) // max(length, 1) for v in x], dtype=object)

    rng = random.Random(d)
    basis = [normed(np.array([rng.randrange(-one, one) for _ in range(d)], dtype=object))
             for _ in range(multiplicity)]
    for _ in range(6):
        done: list[np.ndarray] = []
        for x in basis:
            x = normed(solved(x))
            for _ in range(2):  # twice, as the first pass loses what vectors have in common
                for y in done:
                    x = x - (y * (sum(x * y) >> WORK_BITS) >> WORK_BITS)
                x = normed(x)
            done.append(x)
        basis = done
    vectors = np.array([[float(v) / one if abs(v) < (1 << 1000) else 0.0 for v in x]
                        for x in basis])
    lead = np.abs(vectors).argmax(axis=1)
    return vectors * np.where(vectors[np.arange(len(vectors)), lead] < 0, -1.0, 1.0)[:, None]


@dataclass
class Whitening:
    """Sums and components of a fit list; ``vectors`` has one unit eigenvector per row."""

    n: int
    sums: list[int]  # of floor(1024 c)
    eigenvalues: np.ndarray  # of the covariance
    explained: np.ndarray
    vectors: np.ndarray


def fit(vectors: DataFrame, dimensions: int, components: int = COMPONENTS) -> Whitening:
    """The largest components of the usable vectors in column ``v``."""
    spark = vectors.sparkSession
    n, sums, m = scatter(vectors, dimensions)
    trace = sum(m[i][i] for i in range(dimensions))
    if trace == 0:
        return Whitening(n, sums, np.empty(0), np.empty(0), np.empty((0, dimensions)))
    roots = largest_roots(characteristic_polynomial(spark, m), trace, components)
    shared = spark.sparkContext.broadcast((m, trace))

    def spaces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, root, multiplicity in batch.itertuples(index=False):
                found = null_space(*shared.value, int(root), int(multiplicity))
                yield pd.DataFrame({"number": number, "vector": [v.tolist() for v in found]})

    rows = [(i, str(root), multiplicity) for i, (root, multiplicity) in enumerate(roots)]
    found = (spark.createDataFrame(rows, "number int, root string, multiplicity int")
             .repartition(len(rows), "number")
             .mapInPandas(spaces, "number int, vector array<double>").collect())
    found.sort(key=lambda r: r["number"])
    scale = trace << max(0, ROOT_BITS - trace.bit_length())
    share = np.array([roots[r["number"]][0] / scale for r in found])[:components]
    return Whitening(n, sums, share * (trace / (n * n)), share,
                     np.array([r["vector"] for r in found])[:components])


def deviations(y: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """n x - S of every row as doubles, and the exact sum of its squares (None beyond a long)."""
    reach = max((abs(n * int(y.max()) - min(sums)), abs(n * int(y.min()) - max(sums)))) if y.size \
        else 0
    if reach * reach * max(y.shape[1], 1) < 1 << 63:
        apart = n * y - np.array(sums, dtype=np.int64)
        return apart.astype(np.float64), (apart * apart).sum(axis=1).tolist()
    apart = n * y.astype(object) - np.array(sums, dtype=object)
    squares = [int(x) for x in (apart * apart).sum(axis=1)]
    return apart.astype(np.float64), [x if x < 1 << 63 else None for x in squares]


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row for each
    usable vector and component.

    Defined cases: NULL vectors and those with NULL or non-finite entries drop out; vectors of
    another length than most (of equally frequent ones, the longest) drop out too, as they have no
    common space; entries beyond +-2**52 saturate. Components with eigenvalue zero cannot be scaled
    to one and are left out, so that equal vectors, a single one and an empty table give an empty
    result. Repeated rows, NULL vec_ids and ties are rows like others; components of equal
    eigenvalues are some orthonormal basis of their space. deviation is NULL where it does not fit a
    long. Further columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select("vec_id", F.col("embedding").alias("v")).where(usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    d = most["d"] if most else 0
    same = rows.where(F.size("v") == d)
    fitted = fit(same, d, components) if d else None
    k = len(fitted.eigenvalues) if fitted else 0
    if k == 0:
        return rows.where("false").select(
            "vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"),
            F.lit(0).cast("long").alias("deviation"),
            *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")])

    shared = spark.sparkContext.broadcast(fitted)

    @F.pandas_udf("deviation long, whitened array<double>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        scaled = (known.vectors / np.sqrt(known.eigenvalues)[:, None]).T
        for batch in batches:
            apart, squares = deviations(integers(batch, d), known.n, known.sums)
            yield pd.DataFrame({
                "deviation": pd.array(squares, dtype="Int64"),
                "whitened": list((apart / known.n) @ scaled)})

    written = write_and_read(
        same.select("vec_id", project("v").alias("p")).select("vec_id", "p.*"),
        scratch_dir(spark, "whiten/projected"))
    at = [F.element_at("whitened", i + 1) for i in range(k)]
    # covar_pop keeps running means and centres each product before it is added.
    errors = [F.abs(F.covar_pop(at[i], at[j]) - F.lit(float(i == j)))
              for i in range(k) for j in range(i, k)]
    error = written.agg(F.array(*errors).alias("e")).select(F.array_max("e")).first()[0]
    explained = F.array(*[F.lit(float(x)) for x in fitted.explained])
    return written.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("place") + 1).alias("explained"),
        F.lit(float(error)).alias("identity_error"))
