"""Embedding whitening by the exact characteristic polynomial.

Entries c become integers x = floor(``scale`` * c). The fit list is each
distinct x once, n vectors with sums S. The integer scatter
M = n * sum(x x') - S S' equals n^2 times their covariance, without rounding.

1. Spark adds up the integers: products of 20-bit limbs are exact in floating
   point, partial sums are added as decimals of 60-bit digits.
2. The characteristic polynomial of M comes from modular Hessenberg reduction
   under enough 31-bit primes, spread over tasks, and Chinese remaindering.
3. All its roots are real, so the sign changes of p(x + a) count its roots over
   a. Exact bisection isolates the largest distinct roots, with multiplicity;
   equal roots are told from close ones by the polynomial without its
   repeated factors. Roots are then narrowed to as many digits as their
   distance to their neighbours asks for.
4. Inverse iteration with M - root * I, in decimals of that precision, gives
   the null space. For a multiple root it is an orthonormal basis.
5. Each row is centred and projected; one more pass over the fit list measures
   the covariance of the result.

Rows whose vector is null or holds nulls or non-finite entries are left out,
and so are vectors whose length is not the most frequent one (ties: the
longest) and empty ones. Components without variance do not exist, so tables
whose fit list has one vector, or no row, give no row. Repeated rows and ids
each get their rows. Other columns are not read. The largest entry of each
unit vector (ties: the first) is positive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback.session import cut_lineage

SCALE = 256
LIMB_BITS = 20
#: Rows whose limb products add up to less than 2^53.
EXACT_ROWS = 1 << 12
DIGIT_BITS = 60
PRIMES_A_TASK = 16
LARGEST, SMALLEST = np.iinfo(np.int64).max, np.iinfo(np.int64).min


# ---- integers of a vector ---------------------------------------------------

def integers(c: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * c) as longs; beyond their range the nearest long."""
    x = np.floor(scale * c)
    inside = np.clip(x, -(2.0 ** 62), 2.0 ** 62).astype(np.int64)
    big = np.abs(x) > 2.0 ** 62
    if big.any():
        inside[big] = [min(LARGEST, max(SMALLEST, int(v))) if math.isfinite(v) else (LARGEST if v > 0 else SMALLEST)
                       for v in x[big].tolist()]
    return inside


def packed(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest integers that hold it; equal rows, equal bytes."""
    if not x.size:
        return [b""] * len(x)
    low, high = x.min(axis=1), x.max(axis=1)
    width = np.full(len(x), 8)
    for bits in (32, 16, 8):
        width[(low >= -(1 << bits - 1)) & (high < 1 << bits - 1)] = bits // 8
    out: list[bytes] = [b""] * len(x)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        flat = x[rows].astype(f"<i{w}").tobytes()
        step = w * x.shape[1]
        for k, r in enumerate(rows.tolist()):
            out[r] = flat[k * step:(k + 1) * step]
    return out


def unpacked(raw: list[bytes], size: int) -> np.ndarray:
    out = np.zeros((len(raw), size), dtype=np.int64)
    widths = np.array([len(r) // size for r in raw])
    for w in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == w)
        out[rows] = np.frombuffer(b"".join(raw[r] for r in rows.tolist()), dtype=f"<i{w}").reshape(-1, size)
    return out


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """x as a sum of limb_k * 2^(20 k), each limb of at most 20 bits, as floats."""
    parts = []
    while True:
        if not len(x) or int(np.abs(x.astype(np.float64)).max()) < 1 << LIMB_BITS:
            return [*parts, x.astype(np.float64)]
        parts.append((x & ((1 << LIMB_BITS) - 1)).astype(np.float64))
        x = x >> LIMB_BITS


def exact_products(x: np.ndarray) -> list[list[int]]:
    """x' x as exact integers."""
    size = x.shape[1]
    total = np.zeros((size, size), dtype=object)
    for at in range(0, len(x), EXACT_ROWS):
        parts = limbs(x[at:at + EXACT_ROWS])
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                cell = (a.T @ b).astype(np.int64).astype(object)
                total += cell * (1 << LIMB_BITS * (i + j))
    return total.tolist()


def usable(docs: DataFrame, vector: str) -> DataFrame:
    """Rows with a vector of finite entries of the usual length."""
    c = F.col(vector)
    finite = c.isNotNull() & (F.size(c) > 0) & ~F.exists(
        c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == F.lit(float("inf"))))
    return docs.where(finite)


def usual_length(rows: DataFrame, vector: str) -> int:
    sizes = rows.groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return top["size"] if top else 0


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def fit_list(rows: DataFrame, vector: str, size: int, scale: int) -> DataFrame:
    """Distinct integer vectors, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = packed(integers(_matrix(batch.column(0), size), scale))
                yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.binary())], names=["x"])

    return rows.select(vector).mapInArrow(run, "x binary").distinct()


def sums(fit: DataFrame, size: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums and the sums of products of the fit list, exact.

    Each task adds up its rows; Spark adds the tasks' sums cell by cell, as
    three 60-bit digits. Row 0 and column 0 stand for the constant 1.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, plain = np.zeros((size, size), dtype=object), 0, np.zeros(size, dtype=object)
        for batch in batches:
            if batch.num_rows:
                x = unpacked(batch.column(0).to_pylist(), size)
                total += np.array(exact_products(x), dtype=object)
                plain += x.astype(object).sum(axis=0)
                n += len(x)
        if n:
            cells = [(0, 0, n)] + [(0, j + 1, int(plain[j])) for j in range(size)]
            cells += [(i + 1, j + 1, int(total[i, j])) for i in range(size) for j in range(i, size)]
            mask = (1 << DIGIT_BITS) - 1
            digits = [[(v >> DIGIT_BITS * k) & mask if k < 2 else v >> 2 * DIGIT_BITS for _, _, v in cells]
                      for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()),
                 *(pa.array([Decimal(v) for v in d], pa.decimal128(28, 0)) for d in digits)],
                names=["i", "j", "d0", "d1", "d2"])

    parts = fit.mapInArrow(run, "i int, j int, d0 decimal(28,0), d1 decimal(28,0), d2 decimal(28,0)")
    added = parts.groupBy("i", "j").agg(*[F.sum(d).alias(d) for d in ("d0", "d1", "d2")]).collect()
    n, plain, products = 0, [0] * size, [[0] * size for _ in range(size)]
    for r in added:  # size^2 / 2 cells at any number of rows
        v = sum(int(r[f"d{k}"]) << DIGIT_BITS * k for k in range(3))
        if r["i"] == 0 and r["j"] == 0:
            n = v
        elif r["i"] == 0:
            plain[r["j"] - 1] = v
        else:
            products[r["i"] - 1][r["j"] - 1] = products[r["j"] - 1][r["i"] - 1] = v
    return n, plain, products


# ---- characteristic polynomial ----------------------------------------------

def is_prime(n: int) -> bool:
    """Exact below 3.2e9 by three bases."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7, 61)):
        return n in (2, 3, 5, 7, 61)
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 7, 61):
        x = pow(a, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(r - 1)):
            return False
    return True


def prime_numbers(below: int = 1 << 31) -> Iterator[int]:
    """Primes under ``below``, from the largest on."""
    return filter(is_prime, range(below - 1, 1, -1))


def primes(count: int) -> list[int]:
    return list(islice(prime_numbers(), count))


def inverse_mod(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.array([pow(x, -1, q) if x else 0 for x, q in zip(a.tolist(), p.tolist())], dtype=np.int64)


def hessenberg_polynomials(matrices: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Characteristic polynomials, constant term first, of matrices [k, d, d]
    with entries modulo the primes p [k]: similarity transforms to Hessenberg
    form, then the recurrence over its leading minors."""
    h = matrices.astype(np.int64) % p[:, None, None]
    k, d, _ = h.shape
    every, m = np.arange(k), p[:, None]
    for c in range(d - 2):
        pivot = c + 1 + np.argmax(h[:, c + 1:, c] != 0, axis=1)
        row = h[every, c + 1].copy()  # swap rows and columns c + 1 and pivot
        h[every, c + 1] = h[every, pivot]
        h[every, pivot] = row
        column = h[every, :, c + 1].copy()
        h[every, :, c + 1] = h[every, :, pivot]
        h[every, :, pivot] = column
        factor = h[:, c + 2:, c] * inverse_mod(h[:, c + 1, c], p)[:, None] % m
        h[:, c + 2:, :] = (h[:, c + 2:, :] - factor[:, :, None] * h[:, None, c + 1, :] % p[:, None, None]) % p[:, None, None]
        moved = np.zeros((k, d), dtype=np.int64)
        for r in range(d - c - 2):
            moved = (moved + h[:, :, c + 2 + r] * factor[:, None, r]) % m
        h[:, :, c + 1] = (h[:, :, c + 1] + moved) % m
    minors = [np.zeros((k, d + 1), dtype=np.int64)]
    minors[0][:, 0] = 1 % p
    for i in range(d):
        now = np.zeros((k, d + 1), dtype=np.int64)
        now[:, 1:] = minors[i][:, :-1]
        now = (now - h[:, i, i][:, None] * minors[i]) % m
        below = np.ones(k, dtype=np.int64)
        for j in range(i - 1, -1, -1):
            below = below * h[:, j + 1, j] % p
            now = (now - (below * h[:, j, i] % p)[:, None] * minors[j]) % m
        minors.append(now)
    return minors[d]


def coefficient_bits(matrix: list[list[int]]) -> int:
    """Bits that hold every coefficient of the characteristic polynomial and
    its sign: with no negative root, C(d, k) times the mean root to the k."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    if not trace:
        return 2
    largest = max(math.comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    return largest.bit_length() + 2


def remaindered(residues: list[list[int]], moduli: list[int]) -> list[int]:
    """Integers by Chinese remaindering, of the smallest absolute value."""
    product = math.prod(moduli)
    weights = [(product // q) * pow(product // q, -1, q) for q in moduli]
    out = []
    for values in zip(*residues):
        v = sum(w * r for w, r in zip(weights, values)) % product
        out.append(v - product if 2 * v > product else v)
    return out


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Of a positive semidefinite integer matrix, constant term first; the
    primes are spread over Spark tasks."""
    d = len(matrix)
    wanted = primes(coefficient_bits(matrix) // 30 + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            for at in range(0, len(own), PRIMES_A_TASK):
                p = own[at:at + PRIMES_A_TASK]
                residues = np.array([[[v % q for v in line] for line in matrix] for q in p], dtype=np.int64)
                found = hessenberg_polynomials(residues, np.array(p, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))],
                                                 names=["prime", "polynomial"])

    tasks = -(-len(wanted) // PRIMES_A_TASK)
    rows = (spark.createDataFrame([(p,) for p in wanted], "prime long").repartition(tasks)
            .mapInArrow(run, "prime long, polynomial array<long>").collect())  # d + 1 numbers a prime
    found = {r["prime"]: list(r["polynomial"]) for r in rows}
    out = remaindered([found[p] for p in wanted], wanted)
    assert len(out) == d + 1 and out[d] == 1
    return out


# ---- roots -------------------------------------------------------------------

def roots_over(poly: list[int], a: int, shift: int) -> int:
    """Number of roots, with multiplicity, over a / 2^shift of a polynomial
    whose roots are all real (constant term first)."""
    d = len(poly) - 1
    c = [v << shift * (d - k) for k, v in enumerate(poly)]  # roots times 2^shift
    for i in range(d):  # Taylor shift
        for k in range(d - 1, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _trimmed(p: list) -> list:
    while p and not p[-1]:
        p.pop()
    return p


def _monic_gcd_mod(a: list[int], b: list[int], q: int) -> list[int]:
    a, b = _trimmed([v % q for v in a]), _trimmed([v % q for v in b])
    while b:
        inverse = pow(b[-1], -1, q)
        while len(a) >= len(b):
            f, off = a[-1] * inverse % q, len(a) - len(b)
            for i, v in enumerate(b):
                a[off + i] = (a[off + i] - f * v) % q
            _trimmed(a)
        a, b = b, a
    inverse = pow(a[-1], -1, q)
    return [v * inverse % q for v in a]


def _divided(a: list[int], b: list[int]) -> list[int] | None:
    """a / b for a monic b, None if there is a rest."""
    a, out = list(a), [0] * (len(a) - len(b) + 1)
    for off in range(len(out) - 1, -1, -1):
        out[off] = f = a[off + len(b) - 1]
        for i, v in enumerate(b):
            a[off + i] -= f * v
    return None if any(a) else out


def without_repeats(poly: list[int]) -> list[int]:
    """The monic integer polynomial with the same roots, each once: divided by
    its common divisor with its derivative, which is put together from primes."""
    slope = [k * v for k, v in enumerate(poly)][1:]
    moduli, residues, before = [], [], None
    for q in prime_numbers():
        g = _monic_gcd_mod(poly, slope, q)
        if len(g) == 1:
            return poly
        if residues and len(g) > len(residues[0]):
            continue  # an unlucky prime
        if residues and len(g) < len(residues[0]):
            moduli, residues, before = [], [], None
        moduli.append(q)
        residues.append(g)
        now = remaindered(residues, moduli)
        if now == before and _divided(slope, now) is not None and (rest := _divided(poly, now)) is not None:
            return rest
        before = now
    raise AssertionError("primes do not end")


class Root:
    """A root in (low, low + 1] / 2^shift, its multiplicity, and the distance
    to the nearest other root, at least."""

    def __init__(self, low: int, shift: int, times: int):
        self.low, self.shift, self.times = low, shift, times
        self.gap = Fraction(0)

    def value(self) -> Fraction:
        return Fraction(2 * self.low + 1, 2 << self.shift)


def largest_roots(poly: list[int], wanted: int) -> list[Root]:
    """The largest positive roots, at least ``wanted`` of them with
    multiplicity (or all), in falling order, each in an interval with no other
    distinct root. The polynomial's roots are real and not negative."""
    simple = without_repeats(poly)
    top = max(1, -simple[-2])  # the sum of the roots
    positive = roots_over(simple, 0, 0)
    found: list[Root] = []
    todo = [(0, top, 0, positive)]  # (low, high, shift, distinct roots in between), the highest last
    while todo and sum(r.times for r in found[:-1]) < wanted:  # one more, for the last one's gap
        low, high, shift, inside = todo.pop()
        if not inside:
            continue
        if high - low == 1 and inside == 1:
            found.append(Root(low, shift, roots_over(poly, low, shift) - roots_over(poly, high, shift)))
            continue
        if high - low == 1:
            low, high, shift = 2 * low, 2 * high, shift + 1
        middle = (low + high) // 2
        upper = roots_over(simple, middle, shift) - roots_over(simple, high, shift)
        todo.append((low, middle, shift, inside - upper))
        todo.append((middle, high, shift, upper))
    bits = 64
    while True:
        for root in found:
            narrow(simple, root, root.low.bit_length() + bits if root.low else bits)
        widths = [Fraction(1, 1 << r.shift) for r in found]
        gaps = [x.value() - y.value() for x, y in zip(found, found[1:])]
        if all(gap >= 8 * (u + v) for gap, u, v in zip(gaps, widths, widths[1:])):
            break
        bits *= 2
    for at, root in enumerate(found):
        root.gap = min([*gaps[max(0, at - 1):at + 1], root.value()])
    while sum(r.times for r in found[:-1]) >= wanted:
        found.pop()
    return found


def narrow(poly: list[int], root: Root, bits: int) -> None:
    """Bisects until the interval is at most 2^-bits of the root."""
    over = roots_over(poly, root.low + 1, root.shift)
    while root.low.bit_length() < bits:
        middle = 2 * root.low + 1
        root.shift += 1
        root.low = middle if roots_over(poly, middle, root.shift) > over else 2 * root.low


# ---- components --------------------------------------------------------------

def null_space(matrix: list[list[int]], root: Root, digits: int) -> list[list[Decimal]]:
    """Orthonormal vectors with matrix v = root v, by inverse iteration."""
    d = len(matrix)
    with localcontext() as context:
        context.prec = digits
        context.Emax, context.Emin = 999_999_999, -999_999_999
        value = root.value()
        shift = Decimal(value.numerator) / Decimal(value.denominator)
        a = [[Decimal(matrix[i][j]) - (shift if i == j else 0) for j in range(d)] for i in range(d)]
        order = list(range(d))
        least = Decimal(10) ** -(digits - 5) * max(shift, Decimal(1))
        for c in range(d):  # rows are swapped for the largest pivot
            best = max(range(c, d), key=lambda r: abs(a[r][c]))
            a[c], a[best] = a[best], a[c]
            order[c], order[best] = order[best], order[c]
            if abs(a[c][c]) < least:
                a[c][c] = least
            line, pivot = a[c], a[c][c]
            for r in range(c + 1, d):
                row = a[r]
                if row[c]:
                    row[c] = f = row[c] / pivot
                    for k in range(c + 1, d):
                        row[k] -= f * line[k]

        def solved(b: list[Decimal]) -> list[Decimal]:
            b = [b[i] for i in order]
            for r in range(d):
                b[r] -= sum((a[r][k] * b[k] for k in range(r)), Decimal(0))
            for r in range(d - 1, -1, -1):
                b[r] = (b[r] - sum((a[r][k] * b[k] for k in range(r + 1, d)), Decimal(0))) / a[r][r]
            return b

        basis: list[list[Decimal]] = []
        for t in range(root.times):
            v = [Decimal(1 + (i * (2 * t + 3) + t) % 7 + (d if i == t else 0)) for i in range(d)]
            for _ in range(3):
                v = solved(v)
                for _ in range(2):
                    for u in basis:
                        dot = sum((x * y for x, y in zip(u, v)), Decimal(0))
                        v = [y - dot * x for x, y in zip(u, v)]
                norm = sum((x * x for x in v), Decimal(0)).sqrt()
                v = [x / norm for x in v]
            basis.append(v)
    return basis


def fitted(spark, n: int, plain: list[int], products: list[list[int]], components: int
           ) -> tuple[list[list[float]], list[float], list[float]]:
    """Unit vectors, standard deviations and shares of variance of the leading components."""
    d = len(plain)
    matrix = [[n * products[i][j] - plain[i] * plain[j] for j in range(d)] for i in range(d)]
    trace = sum(matrix[i][i] for i in range(d))
    if not trace:
        return [], [], []
    content = math.gcd(*(v for line in matrix for v in line))
    matrix = [[v // content for v in line] for line in matrix]
    poly = characteristic_polynomial(spark, matrix)
    zero = next(k for k, v in enumerate(poly) if v)  # roots that are zero
    poly = poly[zero:]
    simple = without_repeats(poly)
    vectors, deviations, shares = [], [], []
    for root in largest_roots(poly, components):
        ratio = root.value() / root.gap
        close = ratio.numerator.bit_length() - ratio.denominator.bit_length() + 2
        narrow(simple, root, 160 + 2 * close)
        with localcontext() as context:
            context.prec = 60
            value = Decimal(root.value().numerator) / Decimal(root.value().denominator)
            deviation = float((value * content).sqrt() / n)
            share = float(value * content / trace)
        digits = 60 + math.ceil((160 + 4 * close) * 0.302) + len(str(trace))
        for v in null_space(matrix, root, digits):
            largest = max(range(d), key=lambda i: (abs(v[i]), -i))
            sign = -1 if v[largest] < 0 else 1
            vectors.append([float(sign * x) for x in v])
            deviations.append(deviation)
            shares.append(share)
    return vectors[:components], deviations[:components], shares[:components]


# ---- rows --------------------------------------------------------------------

def centred(x: np.ndarray, n: int, plain: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(n x - S) / n as floats and the exact sum of squares of n x - S (objects)."""
    wide = max(abs(n) * int(np.abs(x.astype(np.float64)).max(initial=0)), max(abs(v) for v in plain)) * 2 + 1
    if wide * wide * x.shape[1] < 1 << 62:
        away = n * x - np.array(plain, dtype=np.int64)
        return away / n, (away * away).sum(axis=1)
    away = x.astype(object) * n - np.array(plain, dtype=object)
    # true division of integers rounds once, whatever their size
    return (away / n).astype(np.float64), (away * away).sum(axis=1)


def _decimals(values: np.ndarray) -> pa.Array:
    kind = pa.decimal128(38, 0)
    if values.dtype != object:
        return pa.array(values).cast(kind)
    return pa.array([Decimal(v) if v < 10 ** 38 else None for v in values], kind)


def whitened(docs: DataFrame, *, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding",
             scale: int = SCALE) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row
    for each usable row and leading component. ``deviation`` is an exact
    decimal (null from 10^38 on)."""
    spark = docs.sparkSession
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType())])
    rows = usable(docs.select(F.col(id_col), F.col(vector_col).alias("_v")), "_v")
    size = usual_length(rows, "_v")
    if not size:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("_v") == size)
    fit = cut_lineage(fit_list(rows, "_v", size, scale), "whitening_fit")
    n, plain, products = sums(fit, size)
    vectors, deviations, shares = fitted(spark, n, plain, products, components)
    if not vectors:
        return spark.createDataFrame([], schema)
    project = (np.array(vectors) / np.array(deviations)[:, None]).T
    error = identity_error(fit, size, n, plain, project)
    k = len(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                away, squares = centred(integers(_matrix(part.column(1), size), scale), n, plain)
                m = len(away)
                ids = part.column(0).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                    _decimals(np.repeat(squares, k)),
                    pa.array((away @ project).ravel()), pa.array(np.tile(np.array(shares), m)),
                    pa.array(np.full(m * k, error))], names=schema.names)

    return rows.select(id_col, "_v").mapInArrow(run, schema)


def identity_error(fit: DataFrame, size: int, n: int, plain: list[int], project: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = project.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = centred(unpacked(batch.column(0).to_pylist(), size), n, plain)[0] @ project
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k), k)), pa.array(np.tile(np.arange(k), k)),
                                          pa.array(total.ravel())], names=["i", "j", "v"])

    cells = fit.mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    return max(abs(r["v"] / n - (r["i"] == r["j"])) for r in cells)
