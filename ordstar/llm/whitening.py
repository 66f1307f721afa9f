"""Whitening of embedding vectors with an exactly known characteristic polynomial.

Every vector entry c becomes the integer x = floor(scale * c). The scatter of the
distinct x vectors is gathered exactly as integers: each task adds up its rows'
outer products in blocks small enough for exact float products, Spark adds the
tasks' cells, and only the d x d cells reach the driver (d is the vector length,
the one bound here: the driver's work is a constant of d, whatever the rows).
There, with C = n * sum(x x') - S S' (n squared times the covariance, integer):

1. the characteristic polynomial of C is computed modulo as many 31-bit primes as
   its coefficients' proven bound asks for (Hessenberg form by similar row and
   column steps, then its recurrence) and put together by Chinese remaindering;
2. C is positive semidefinite, so all roots are real and the sign changes of the
   polynomial shifted to a point count the roots beyond it exactly (with
   multiplicity): the k-th largest root is isolated by bisection over integers;
3. a unit vector of the null space of C - root * I comes from inverse iteration
   in 80-digit arithmetic, made orthogonal to the vectors before it.

Then every row, copies included, is projected in a map over the table: no shuffle
beyond the one that finds the distinct vectors.

Defined cases. Rows whose vector is null, or holds a null or non-finite entry,
are dropped; so are vectors of another length than the most frequent one (of
equally frequent lengths the shortest) and vectors without entries. x saturates
at the ends of a 64-bit integer. A component whose eigenvalue is 0 (fewer distinct
vectors than components, constant dimensions) has whitened null; with trace 0
explained is null too, and identity_error covers the components that have a value
(null if none has). Equal eigenvalues: some orthonormal basis of their space. An
empty table gives an empty result. ``deviation`` is exact, null beyond 38 digits.
Columns named like a result are replaced, all others pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from decimal import Context, Decimal, localcontext

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordstar.llm.common import without
from ordstar.session import materialize, ship_package

#: Bits of a limb: products of two limbs, summed over a block, stay exact in a double.
LIMB_BITS = 20
BLOCK_ROWS = 4_096
#: Relative precision of an isolated root, in bits, and digits of the null-space arithmetic.
ROOT_BITS = 80
DIGITS = 80
#: A cell's value travels as this many 32-bit parts, each added up as a long.
PARTS = 6


# --- exact sums ---------------------------------------------------------------------

def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * c) of every entry."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    """True for a vector with entries, all of them finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def outer_sums(x: np.ndarray) -> np.ndarray:
    """Exact sum over rows of y y' for y = (1, x), as Python integers."""
    y = np.concatenate([np.ones((len(x), 1), dtype=np.int64), x], axis=1)
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for at in range(0, len(y), BLOCK_ROWS):
        block = y[at:at + BLOCK_ROWS]
        limbs, rest = [], block
        while True:
            low, rest = rest & ((1 << LIMB_BITS) - 1), rest >> LIMB_BITS
            if np.all((rest == 0) | (rest == -1)):  # the sign closes the last limb
                limbs.append((low - (-rest << LIMB_BITS)).astype(np.float64))
                break
            limbs.append(low.astype(np.float64))
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) * (1 << (LIMB_BITS * (i + j)))
    return total


def split_parts(value: int) -> list[int]:
    """An integer as 32-bit parts, lowest first; the last one carries the sign."""
    return [(value >> (32 * i)) & 0xFFFFFFFF for i in range(PARTS - 1)] + [value >> (32 * (PARTS - 1))]


def joined_parts(parts: Sequence[int]) -> int:
    return sum(int(p) << (32 * i) for i, p in enumerate(parts))


def scatter(fit: DataFrame, column: str, dims: int) -> np.ndarray:
    """Exact (d + 1) x (d + 1) sums of y y', y = (1, x), over the rows of ``fit``.
    Only these cells reach the driver."""
    schema = T.StructType([T.StructField("cell", T.IntegerType()), *[T.StructField(f"p{i}", T.LongType()) for i in range(PARTS)]])
    width = dims + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width), dtype=object)
        for pdf in batches:
            if len(pdf):
                total = total + outer_sums(np.stack(pdf[column].to_numpy()).astype(np.int64))
        rows = [(i * width + j, *split_parts(int(total[i, j]))) for i in range(width) for j in range(i, width)]
        yield pd.DataFrame(rows, columns=schema.names)

    ship_package(fit.sparkSession)
    cells = fit.select(F.col(column)).mapInPandas(partial, schema)
    out = np.zeros((width, width), dtype=object)
    for r in cells.groupBy("cell").agg(*[F.sum(f"p{i}").alias(f"p{i}") for i in range(PARTS)]).collect():
        i, j = divmod(r["cell"], width)
        out[i, j] = out[j, i] = joined_parts(r[1:])
    return out


# --- the characteristic polynomial -----------------------------------------------------

def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 3,215,031,751."""
    if n % 2 == 0:
        return n == 2
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x in (1, n - 1) or a % n == 0:
            continue
        if not any((x := x * x % n) == n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2 ** 31, largest first, whose product is above ``bound``."""
    out, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def hessenberg_polynomials(a: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Characteristic polynomials, lowest coefficient first, of matrices ``a[i]``
    (entries below ``primes[i]``), one for each prime, all primes at once."""
    count, d = len(primes), a.shape[1]
    p = primes[:, None, None]
    a, every = a.copy(), np.arange(count)
    for k in range(d - 2):
        # A row below the diagonal with an entry in this column, for each prime its own.
        pivot = k + 1 + np.argmax(a[:, k + 1:, k] != 0, axis=1)
        for axis in (0, 1):
            view = a if axis == 0 else a.swapaxes(1, 2)
            first, other = view[:, k + 1].copy(), view[every, pivot].copy()
            view[every, pivot] = first
            view[:, k + 1] = other
        inverse = np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(a[:, k + 1, k], primes)], dtype=np.int64)
        u = a[:, k + 2:, k] * inverse[:, None] % primes[:, None]
        a[:, k + 2:] = (a[:, k + 2:] - u[:, :, None] * a[:, None, k + 1] % p) % p
        a[:, :, k + 1] = (a[:, :, k + 1] + (a[:, :, k + 2:] * u[:, None, :] % p).sum(axis=2)) % primes[:, None]
    polys = [np.zeros((count, d + 1), dtype=np.int64)]
    polys[0][:, 0] = 1
    q = primes[:, None]
    for k in range(d):
        last = polys[k]
        new = (np.roll(last, 1, axis=1) - a[:, k, k][:, None] * last % q) % q
        path = np.ones(count, dtype=np.int64)
        for i in range(k - 1, -1, -1):
            path = path * a[:, i + 1, i] % primes
            new = (new - (a[:, i, k] * path % primes)[:, None] * polys[i] % q) % q
        polys.append(new)
    return polys[d]


def characteristic_polynomial(c: np.ndarray) -> list[int]:
    """Exact coefficients, lowest first, of det(z I - C) for an integer positive
    semidefinite matrix. No coefficient is larger than the binomial number times
    that power of the mean eigenvalue (Maclaurin), which fixes the primes."""
    d = len(c)
    mean = -(-max(int(np.trace(c)), 1) // d)
    bound = max(math.comb(d, k) * mean ** k for k in range(d + 1))
    primes = primes_beyond(2 * bound + 1)
    residues = np.array([[[int(v) % p for v in row] for row in c] for p in primes], dtype=np.int64)
    polys = hessenberg_polynomials(residues, np.array(primes, dtype=np.int64))
    modulus = math.prod(primes)
    weights = [(modulus // p) * pow(modulus // p, -1, p) for p in primes]
    out = []
    for column in polys.T:
        value = sum(int(r) * w for r, w in zip(column, weights)) % modulus
        out.append(value - modulus if value > modulus // 2 else value)
    return out


# --- roots and null spaces ---------------------------------------------------------------

def roots_beyond(poly: Sequence[int], point: int) -> int:
    """Roots above ``point`` of a polynomial with real roots only, counted with
    multiplicity: the sign changes of its coefficients around ``point``."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += point * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(poly: Sequence[int], count: int, bits: int = ROOT_BITS) -> list[tuple[int, int]]:
    """The ``count`` largest roots of a polynomial whose roots are real and not
    negative, falling, as (m, s) for m / 2 ** s with a relative error of at most
    2 ** -bits; (0, 0) for a root of exactly 0."""
    zeros = next(i for i, v in enumerate(poly) if v)
    poly, d = list(poly[zeros:]), len(poly) - 1 - zeros
    out = []
    ceiling = -(-abs(poly[d - 1]) // abs(poly[d])) + 1 if d else 1  # the sum of the roots, rounded up
    for k in range(1, min(count, d) + 1):
        # Steps of 2 ** -s, fine enough for the root found so far.
        s, low, high = 0, 0, ceiling
        scaled = poly
        while True:
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if roots_beyond(scaled, mid) >= k else (low, mid)
            if low.bit_length() > bits:
                break
            more = max(bits + 1 - low.bit_length(), 8)
            low, high, s = low << more, high << more, s + more
            scaled = [v << (s * (d - i)) for i, v in enumerate(poly)]
        out.append((low, s))
        ceiling = (high >> s) + 1
    return out + [(0, 0)] * (count - len(out))


def null_vector(c: np.ndarray, root: Decimal, before: Sequence[np.ndarray]) -> np.ndarray:
    """Unit vector (decimals) of the null space of C - root * I by inverse
    iteration, at right angles to the vectors ``before``. Call inside a decimal
    context; C is a matrix of decimals."""
    d = len(c)
    a = c.copy()
    for i in range(d):
        a[i, i] = a[i, i] - root
    tiny = max(max(abs(v) for v in a.ravel()), Decimal(1)).scaleb(-DIGITS)
    order, lower = list(range(d)), np.full((d, d), Decimal(0), dtype=object)
    for k in range(d):
        best = max(range(k, d), key=lambda r: abs(a[r, k]))
        if best != k:
            a[[k, best]], lower[[k, best]] = a[[best, k]], lower[[best, k]]
            order[k], order[best] = order[best], order[k]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        if k + 1 < d:
            lower[k + 1:, k] = a[k + 1:, k] / a[k, k]
            a[k + 1:, k:] = a[k + 1:, k:] - np.outer(lower[k + 1:, k], a[k, k:])

    def straight(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for b in before:
                v = v - b * (b @ v)
        return v / (v @ v).sqrt()

    # Fixed start with no symmetry that a component is likely to share.
    v = straight(np.array([Decimal(1) + Decimal((i * 37 + 11) % 101) / 100 for i in range(d)], dtype=object))
    for _ in range(6):
        w = v[order]
        for k in range(1, d):
            w[k] = w[k] - lower[k, :k] @ w[:k]
        for k in range(d - 1, -1, -1):
            tail = a[k, k + 1:] @ w[k + 1:] if k + 1 < d else Decimal(0)
            w[k] = (w[k] - tail) / a[k, k]
        v = straight(w / max(abs(x) for x in w))
    return v


def principal_components(sums: np.ndarray, count: int) -> tuple[int, list[int], list[float], np.ndarray, list[float]]:
    """(n, S, eigenvalues, components as rows, explained) of the covariance behind
    exact sums of y y', y = (1, x). Eigenvalues fall; a component of eigenvalue 0
    is a row of zeros."""
    n, d = int(sums[0, 0]), len(sums) - 1
    s = [int(v) for v in sums[0, 1:]]
    c = n * sums[1:, 1:] - np.outer(np.array(s, dtype=object), np.array(s, dtype=object))
    count = min(count, d)
    trace = int(np.trace(c))
    if trace == 0:
        return n, s, [0.0] * count, np.zeros((count, d)), [math.nan] * count
    roots = largest_roots(characteristic_polynomial(c), count)
    with localcontext(Context(prec=DIGITS)):
        exact = np.array([[Decimal(int(v)) for v in row] for row in c], dtype=object)
        found: list[np.ndarray] = []
        values, explained = [], []
        for m, shift in roots:
            root = Decimal(m) / Decimal(1 << shift)
            values.append(float(root / (Decimal(n) * n)))
            explained.append(float(root / trace))
            if m:
                found.append(null_vector(exact, root, found))
    vectors = np.zeros((count, d))
    for i, v in enumerate(found):
        vectors[i] = [float(x) for x in v]
    return n, s, values, vectors, explained


# --- the operator --------------------------------------------------------------------------

def centred(x: np.ndarray, n: int, sums: Sequence[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit integers where they hold it, else Python's."""
    most = int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0
    if (most * n + max(abs(v) for v in sums)) < 1 << 62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def squares(v: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    if v.dtype != object and v.size and int(np.abs(v).max()) ** 2 * v.shape[1] < 1 << 62:
        return [int(t) for t in (v * v).sum(axis=1)]
    w = v.astype(object)
    return [int(t) for t in (w * w).sum(axis=1)] if len(w) else []


def whiten(df: DataFrame, vector: str = "embedding", components: int = 4, scale: int = 256) -> DataFrame:
    """One row for each usable row of ``df`` and component (from 1, by falling
    eigenvalue), with ``component``, ``n`` (distinct vectors), ``deviation`` (exact
    sum of (n * x - S) squared, decimal), ``whitened``, ``explained`` and
    ``identity_error`` (the largest absolute entry of the whitened fit vectors'
    covariance minus the identity, measured over them)."""
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    base = without(df, [c for c in names if c != vector.lower()])
    rows = base.withColumn("__x", F.when(usable(F.col(f"`{vector}`")), quantised(F.col(f"`{vector}`"), scale))).filter(F.col("__x").isNotNull())
    lengths = rows.groupBy(F.size("__x").alias("d")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "d").first()
    dims = lengths["d"] if lengths else 0
    rows = rows.filter(F.size("__x") == dims)
    kept = [c for c in base.columns if c.lower() not in names]
    if not dims:
        nothing = rows.select(*[F.col(f"`{c}`") for c in kept], F.lit(0).alias("component"), F.lit(0).cast("bigint").alias("n"),
                              F.lit(None).cast("decimal(38,0)").alias("deviation"), *[F.lit(None).cast("double").alias(c) for c in names[3:]])
        return nothing.filter(F.lit(False))
    # Equal vectors meet once here; a very common one is combined before it moves.
    fit = materialize(rows.select("__x").distinct(), "whitening-fit")
    n, sums, values, vectors, explained = principal_components(scatter(fit, "__x", dims), components)
    weights = np.array([v / math.sqrt(e) / n if e > 0 else np.full(dims, math.nan) for v, e in zip(vectors, values)])

    def project(batch: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        moved = centred(np.stack(batch.to_numpy()).astype(np.int64), n, sums)
        return moved, moved.astype(np.float64) @ weights.T

    error = identity_error(fit, project, len(weights), n, [e > 0 for e in values])
    result = T.StructType([T.StructField("deviation", T.StringType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    @F.pandas_udf(result)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                yield pd.DataFrame({"deviation": [], "whitened": []})
                continue
            moved, white = project(batch)
            yield pd.DataFrame({"deviation": [str(t) for t in squares(moved)], "whitened": list(white)})

    share = F.element_at(F.array(*[F.lit(e) for e in explained]), F.col("component"))
    out = rows.withColumn("__w", judge("__x"))
    out = out.select(*[F.col(f"`{c}`") for c in kept], F.col("__w.deviation").try_cast("decimal(38,0)").alias("deviation"),
                     F.posexplode("__w.whitened").alias("__at", "whitened")).withColumn("component", F.col("__at") + 1)
    return out.select(*[F.col(f"`{c}`") for c in kept], "component", F.lit(n).cast("bigint").alias("n"), "deviation",
                      F.nanvl("whitened", F.lit(None).cast("double")).alias("whitened"),
                      F.nanvl(share, F.lit(None).cast("double")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def identity_error(fit: DataFrame, project, count: int, n: int, real: Sequence[bool]) -> float | None:
    """Largest absolute entry of the whitened fit vectors' covariance minus the
    identity: task sums of w and w w', added up by Spark (count squared cells)."""
    if not any(real):
        return None
    width = count + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for pdf in batches:
            if len(pdf):
                white = np.nan_to_num(project(pdf["__x"])[1])
                y = np.concatenate([np.ones((len(white), 1)), white], axis=1)
                total += y.T @ y
        yield pd.DataFrame([(i * width + j, float(total[i, j])) for i in range(width) for j in range(width)], columns=["cell", "v"])

    ship_package(fit.sparkSession)
    sums = np.zeros((width, width))
    for r in fit.mapInPandas(partial, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():
        sums[divmod(r["cell"], width)] = r["v"]
    mean = sums[0, 1:] / n
    off = sums[1:, 1:] / n - np.outer(mean, mean) - np.eye(count)
    keep = np.array(real)
    return float(np.abs(off[np.ix_(keep, keep)]).max())
