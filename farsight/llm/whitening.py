"""Operator 12 -- whitening through the exact characteristic polynomial.

Vectors are integer, so sums and scatter of the distinct ones are exact
integers, added up in tasks.  The scatter's characteristic polynomial is
computed modulo as many primes as a bound of its coefficients asks for: a task
reduces the matrix to Hessenberg form modulo its primes, and Chinese
remaindering joins the residues.  All its roots are real, so the sign
variations of a shifted polynomial count the roots beyond a point exactly (Descartes):
bisection isolates the largest roots, multiple ones too, and refines them to
PRECISION bits.  Inverse iteration in decimals of DIGITS places then gives
each root's null space; one task works on one root.

What reaches the driver is of the size of the scatter: dims x dims numbers.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.llm.topk import integer_vectors
from farsight.llm.util import dense_sums, table, trimmed
from farsight.session import saved

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Relative width, in bits, to which a root is refined, and decimal places of the inverse iteration.
PRECISION, DIGITS = 128, 90
_LIMB = 31
_ROWS = 4096


# ---------------------------------------------------------------- exact sums

def _limbs(z: np.ndarray) -> list[np.ndarray]:
    """z = sum of limb * 2**(20 * i), each limb under 2**20 in size."""
    out = []
    while True:
        top = z >> 20
        if not ((z >= 1 << 20) | (z <= -(1 << 20))).any():
            return [*out, z.astype(np.float64)]
        out.append((z - (top << 20)).astype(np.float64))
        z = top


def _scatter(z: np.ndarray) -> np.ndarray:
    """z^T z as Python integers; ``z`` has at most _ROWS rows, so each product of limbs is exact."""
    parts = _limbs(z)
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total = total + (a.T @ b).astype(np.int64).astype(object) * (1 << 20 * (i + j))
    return total


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dims)


def exact_sums(fit: DataFrame, dims: int, offset: int = OFFSET) -> tuple[int, list[int], np.ndarray]:
    """(rows, sums of z, sums of z z^T) of ``fit`` (x), z = x - offset."""
    cells = dims * (dims + 1) + 1
    limbs = 6  # 186 bits
    length = -(-2 * limbs * cells // 4096) * 4096

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        rows, total, square = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for b in batches:
            for at in range(0, b.num_rows, _ROWS):
                z = _matrix(b.column(0).slice(at, _ROWS), dims) - offset
                rows += len(z)
                total = total + z.astype(object).sum(axis=0)
                square = square + _scatter(z)
        out = np.zeros(length, np.int64)
        flat = [rows, *total, *square.reshape(-1)]
        for sign in (1, -1):
            for k in range(limbs):
                out[((sign < 0) * limbs + k) * cells:][:cells] = [(max(0, sign * int(v)) >> _LIMB * k) & ((1 << _LIMB) - 1) for v in flat]
        return out

    got = dense_sums(fit.select("x"), count, length)[:2 * limbs * cells].reshape(2, limbs, cells).tolist()
    flat = [sum((p - m) << _LIMB * k for k, (p, m) in enumerate(zip(plus, minus)))
            for plus, minus in zip(zip(*got[0]), zip(*got[1]))]
    return flat[0], flat[1:dims + 1], np.array(flat[dims + 1:], object).reshape(dims, dims)


# ------------------------------------------------- characteristic polynomial

def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 2**32."""
    if n % 2 == 0:
        return n == 2
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 7, 61):
        x = pow(a, d, n)
        if a % n and x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes(bits: float) -> list[int]:
    """Primes below 2**31 whose product has more than ``bits`` bits."""
    out, p = [], (1 << 31) - 1
    while len(out) * 30 <= bits:
        if _is_prime(p):
            out.append(p)
        p -= 2
    return out


def hessenberg_polynomial(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, highest first, of the characteristic polynomial of the integer matrix ``a`` modulo the prime ``p``."""
    n = len(a)
    h = (a % p).astype(np.int64)
    for m in range(1, n - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        i = m + int(below[0])
        if i != m:
            h[[m, i]] = h[[i, m]]
            h[:, [m, i]] = h[:, [i, m]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u % p).sum(axis=1)) % p
    polys = [np.array([1], np.int64)]  # lowest first
    for k in range(n):
        new = np.zeros(k + 2, np.int64)
        new[1:] = polys[k]
        new[:k + 1] = (new[:k + 1] - h[k, k] * polys[k]) % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            new[:i + 1] = (new[:i + 1] - int(h[i, k]) * chain % p * polys[i]) % p
        polys.append(new)
    return polys[n][::-1]


def characteristic_polynomial(spark: SparkSession, a: np.ndarray) -> list[int]:
    """Coefficients, highest first, for a symmetric positive semidefinite integer matrix."""
    n, trace = len(a), int(sum(a[i, i] for i in range(len(a))))
    # the k-th coefficient is the k-th symmetric sum of roots that are not negative and sum up to the trace
    most = max(comb(n, k) * (trace // n + 1) ** k for k in range(n + 1))
    mods = primes(most.bit_length() + 2)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"p": pa.array([p], pa.int64()), "c": [hessenberg_polynomial(a, p).tolist()]})

    tasks = min(len(mods), 2 * spark.sparkContext.defaultParallelism)
    got = (spark.createDataFrame([(p,) for p in mods], "p long").repartition(tasks)
           .mapInArrow(reduce, "p long, c array<long>").toArrow())
    whole = 1
    for p in mods:
        whole *= p
    out = [0] * (n + 1)
    for p, c in zip(got["p"].to_pylist(), got["c"].to_pylist()):
        rest = whole // p
        rest *= pow(rest % p, -1, p)
        out = [x + r * rest for x, r in zip(out, c)]
    return [x - whole if (x := v % whole) * 2 > whole else x for v in out]


# --------------------------------------------------------------------- roots

def _stretched(c: list[int], k: int) -> list[int]:
    """The polynomial whose roots are 2**k times as large."""
    return [v << k * i for i, v in enumerate(c)]


def roots_above(c: list[int], at: int, k: int) -> int:
    """Roots of ``c`` above at / 2**k, with multiplicity; all roots are real."""
    s = _stretched(c, k)
    for stop in range(len(s), 1, -1):
        for i in range(1, stop):
            s[i] += s[i - 1] * at
    signs = [v > 0 for v in s if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def isolate(c: list[int], most: int) -> list[tuple[int, int, int, int]]:
    """The ``most`` largest positive roots (all, if fewer), falling: (low,
    high, k, m) says that m roots, with multiplicity, lie above low / 2**k and
    up to high / 2**k; m is over 1 only where the interval is PRECISION bits narrow."""
    top = 1
    while roots_above(c, top, 0):
        top <<= 1
    todo, out, found = [(0, top, 0, roots_above(c, 0, 0), 0)], [], 0
    while todo and found < most:
        low, high, k, n_low, n_high = todo.pop()
        m = n_low - n_high
        if not m:
            continue
        if m == 1 and low or low and high - low <= low >> PRECISION:
            out.append((low, high, k, m))
            found += m
            continue
        low, high, k = 2 * low, 2 * high, k + 1
        mid = (low + high) // 2
        n_mid = roots_above(c, mid, k)
        todo += [(low, mid, k, n_low, n_mid), (mid, high, k, n_mid, n_high)]
    return out


def refine(c: list[int], low: int, high: int, k: int, m: int) -> tuple[int, int]:
    """(v, k): the root of an interval of isolate() as v / 2**k."""
    if m > 1:
        return low + high, k + 1

    def sign(at: int, k: int) -> int:
        v, scale = 0, 0
        for i, x in enumerate(c):
            v = v * at + (x << k * i)
        return (v > 0) - (v < 0)

    end = sign(high, k)
    if not end:
        return high, k
    while high - low > low >> PRECISION:
        low, high, k = 2 * low, 2 * high, k + 1
        mid = (low + high) // 2
        s = sign(mid, k)
        if not s:
            return mid, k
        if s == end:
            high = mid
        else:
            low = mid
    return low + high, k + 1


def null_space(a: np.ndarray, v: int, k: int, m: int) -> list[list[decimal.Decimal]]:
    """``m`` orthonormal vectors that ``a`` maps to v / 2**k times themselves, by inverse iteration."""
    n = len(a)
    with decimal.localcontext() as ctx:
        ctx.prec, ctx.Emax, ctx.Emin = DIGITS, decimal.MAX_EMAX, decimal.MIN_EMIN
        lu = np.array([[decimal.Decimal(int(x)) for x in row] for row in a], object)
        root = decimal.Decimal(v) / decimal.Decimal(1 << k)
        tiny = root.scaleb(-DIGITS + 10)
        for i in range(n):
            lu[i, i] -= root
        order = list(range(n))
        for i in range(n):
            j = i + max(range(n - i), key=lambda r: abs(lu[i + r, i]))
            lu[[i, j]] = lu[[j, i]]
            order[i], order[j] = order[j], order[i]
            if abs(lu[i, i]) < tiny:
                lu[i, i] = tiny
            lu[i + 1:, i] = lu[i + 1:, i] / lu[i, i]
            lu[i + 1:, i + 1:] = lu[i + 1:, i + 1:] - np.outer(lu[i + 1:, i], lu[i, i + 1:])
        g = np.random.default_rng(12)
        space = [np.array([decimal.Decimal(int(x)) for x in g.integers(1, 1000, n)], object) for _ in range(m)]
        for _ in range(3):
            done: list[np.ndarray] = []
            for x in space:
                y = x[order]
                for i in range(n):
                    y[i] -= lu[i, :i].dot(y[:i]) if i else 0
                for i in range(n - 1, -1, -1):
                    y[i] = (y[i] - (lu[i, i + 1:].dot(y[i + 1:]) if i + 1 < n else 0)) / lu[i, i]
                for _ in range(2):
                    for z in done:
                        y = y - z * z.dot(y)
                    y = y / y.dot(y).sqrt()
                done.append(y)
            space = done
        # either sign is right: the largest entry is positive
        return [list(-x if x[int(np.argmax(np.abs(x.astype(float))))] < 0 else x) for x in space]


def components(spark: SparkSession, a: np.ndarray, most: int = COMPONENTS) -> list[tuple[decimal.Decimal, list[float], list[float]]]:
    """Of the scatter ``a``, by falling root and for positive ones only:
    (root, unit vector, unit vector over the root's square root)."""
    if not any(a[i, i] for i in range(len(a))):
        return []
    c = characteristic_polynomial(spark, a)
    found = isolate(c, most)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                v, k = refine(c, *found[i])
                with decimal.localcontext() as ctx:
                    ctx.prec = DIGITS
                    root = decimal.Decimal(v) / decimal.Decimal(1 << k)
                    for j, x in enumerate(null_space(a, v, k, found[i][3])):
                        yield pa.RecordBatch.from_pydict({"i": pa.array([i * len(a) + j], pa.int64()), "root": [str(root)],
                                                          "vector": [[float(e) for e in x]], "white": [[float(e / root.sqrt()) for e in x]]})

    got = (spark.range(len(found)).repartition(max(1, len(found)))
           .mapInArrow(trimmed(solve), "i long, root string, vector array<double>, white array<double>").collect())
    return [(decimal.Decimal(r.root), r.vector, r.white) for r in sorted(got, key=lambda r: r.i)][:most]


# ------------------------------------------------------------------ whitening

def _projector(n: int, sums: list[int], white: np.ndarray, offset: int):
    """Function from x-vectors to (n * x - S whitened, upper and lower 62 bits of the squared deviation)."""
    least = np.array(sums, object)

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = x - offset
        most = n * int(np.abs(z).max(initial=0)) + max(map(abs, sums), default=0)
        if most * most * max(1, len(sums)) < 1 << 62:
            y = n * z - least.astype(np.int64)
            return y.astype(np.float64) @ white.T, np.zeros(len(y), np.int64), (y * y).sum(axis=1)
        y = n * z.astype(object) - least
        d = (y * y).sum(axis=1)
        return y.astype(np.float64) @ white.T, (d >> 62).astype(np.int64), (d & ((1 << 62) - 1)).astype(np.int64)
    return project


def whiten(rows: DataFrame, most: int = COMPONENTS, offset: int = OFFSET) -> DataFrame:
    """One row per row of ``rows`` (vec_id, x) and component: vec_id,
    component, n, deviation (decimal), whitened, explained, identity_error.

    The fit takes each distinct x once.  A component of no variance has no
    whitened value and is left out, so fewer distinct vectors than dimensions
    give fewer components, and one distinct vector or an empty table gives no
    rows.  Equal eigenvalues share their space, in which the components are
    any orthonormal basis, the same for all rows.  Vectors have to be of one
    length: the most frequent one counts (the longest, if two are), others
    and empty vectors are left out.  Rows that repeat are each returned, a null vec_id too; other
    columns are not read.  ``offset`` is taken off x before products are
    formed and changes no result.
    """
    spark = rows.sparkSession
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    usual = (rows.groupBy(F.size("x").alias("dims")).count().where("dims > 0").orderBy(F.desc("count"), F.desc("dims")).first())
    if usual is None:
        return spark.createDataFrame([], schema)
    dims = usual["dims"]
    rows = rows.select("vec_id", "x").where(F.size("x") == dims)
    fit = saved(rows.select("x").distinct(), "fit")
    n, sums, squares = exact_sums(fit, dims, offset)
    s = np.array(sums, object)
    a = n * squares - np.outer(s, s)
    found = components(spark, a, most)
    if not found:
        return spark.createDataFrame([], schema)
    trace = sum(int(a[i, i]) for i in range(dims))
    white = np.array([w for _, _, w in found])
    project, many = _projector(n, sums, white, offset), len(found)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(many * (many + 1))
        for b in batches:
            for at in range(0, b.num_rows, _ROWS):
                w = project(_matrix(b.column(0).slice(at, _ROWS), dims))[0]
                total += np.append(w.sum(axis=0), (w.T @ w).reshape(-1))
        yield pa.RecordBatch.from_pydict({"sums": [total.tolist()]})

    got = (fit.mapInArrow(trimmed(spread), "sums array<double>").select(F.posexplode("sums").alias("i", "v"))
           .groupBy("i").agg(F.sum("v").alias("v")).toArrow().sort_by("i")["v"].to_numpy() / n)
    mean, cov = got[:many], got[many:].reshape(many, many)
    error = float(np.abs(cov - np.outer(mean, mean) - np.eye(many)).max())

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, _ROWS):
                part = b.slice(at, _ROWS)
                w, high, low = project(_matrix(part.column(1), dims))
                cuts = pa.array(np.arange(0, w.size + 1, many), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(high), pa.array(low), pa.ListArray.from_arrays(cuts, pa.array(w.reshape(-1)))],
                                                 ["vec_id", "high", "low", "w"])

    shares = F.array(*[F.lit(float(root / trace)) for root, _, _ in found])
    big = F.col("high").cast("decimal(20,0)") * F.lit(1 << 62).cast("decimal(20,0)") + F.col("low").cast("decimal(20,0)")
    return (rows.mapInArrow(trimmed(out), "vec_id long, high long, low long, w array<double>")
            .select("vec_id", F.when(F.col("high") == 0, F.col("low").cast("decimal(38,0)")).otherwise(big.cast("decimal(38,0)")).alias("deviation"),
                    F.posexplode("w").alias("i", "whitened"))
            .select("vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(shares, F.col("i") + 1).alias("explained"), F.lit(error).alias("identity_error")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviation as long; one beyond 64 bits fails the query."""
    rows = integer_vectors(table(spark, sf_dir, "embeddings"), scale=SCALE)
    rows = rows.select("vec_id", F.transform("x", lambda x: x + F.lit(OFFSET)).alias("x"))
    return whiten(rows).withColumn("deviation", F.col("deviation").cast("long"))
