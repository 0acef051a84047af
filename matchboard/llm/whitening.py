"""Embedding whitening by the exact characteristic polynomial of the scatter matrix.

Every entry c becomes the whole number floor(1024 * c) + 100000. Tasks add up entries and products of entries as
whole numbers, so the scatter matrix n * sum(x x') - S S' (n squared times the covariance) is exact however rows
are dealt. Its characteristic polynomial comes from Hessenberg reductions modulo many primes, dealt to tasks, and
Chinese remaindering up to a bound that all coefficients keep. All roots are real, so Descartes' rule counts those
beyond any point exactly; bisection isolates the largest ones, multiplicities included, and narrows them far below
the distance to their neighbours. Inverse iteration in long decimals, close to a singular matrix, then gives the
unit vectors that span the null space of each root.

What passes through the driver depends on the number of dimensions alone (the matrix, its polynomial and the
components); the polynomial's cost grows with their fourth power, which suits some hundred dimensions.

Rows whose vector is null, or holds null or non-finite entries, or entries whose whole number is beyond 2**62, are
dropped. So are vectors of another length than most rows have (the longer one, if tied). Repeated rows and ids, and
null ids, count as often as given. Components without spread (eigenvalue zero) are left out, so equal vectors, a
single row, empty vectors and an empty table give no rows. Other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchboard.llm.common import stored

SCALE, OFFSET = 1024, 100_000
LARGEST = 1 << 62  # of the whole numbers
LIMB, LIMBS = 32, 6  # sums travel as limbs that longs can add up without overflow
SAME_ROOT = 256  # roots that agree in so many leading bits count as one root
SPARE = 70  # bits by which a root is known better than the distance to the next one
PRIME_TOP = 1 << 31  # products of two residues and sums of reduced products stay within a long


@dataclass(frozen=True)
class Fit:
    """Components of a table of vectors; ``vectors[k]`` belongs to ``roots[k]``, an eigenvalue of the scatter matrix."""

    n: int
    sums: tuple[int, ...]  # of the whole numbers without the offset
    trace: int  # of the scatter matrix
    roots: tuple[float, ...]
    vectors: np.ndarray

    @property
    def dimensions(self) -> int:
        return len(self.sums)


# ---- from rows to the scatter matrix


def _clean(df: DataFrame, vector_col: str, id_col: str | None = None) -> DataFrame:
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(*([F.col(id_col).alias("vec_id")] if id_col else []), vector.alias("vector"))
    fine = lambda c: F.coalesce(F.abs(c) < (LARGEST - OFFSET) / SCALE, F.lit(False))  # noqa: E731  false for null, infinity and (as it is the largest) NaN
    return rows.where(F.col("vector").isNotNull() & F.forall("vector", fine))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Whole numbers without the offset, exact in doubles."""
    return np.floor(column.flatten().to_numpy(zero_copy_only=False) * float(SCALE)).reshape(-1, size)


def _exact(matrix: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in matrix.tolist()], dtype=object).reshape(matrix.shape)


def _products(matrix: np.ndarray) -> np.ndarray:
    """Sum over rows of the outer products, as exact whole numbers."""
    size = matrix.shape[1]
    total = np.zeros((size, size), dtype=object)
    most = float(np.abs(matrix).max(initial=1.0))
    rows = int((1 << 53) // max(1.0, most * most))  # sums of so many products are exact in doubles
    if rows == 0:
        big = _exact(matrix)
        return total + big.T.dot(big)
    for low in range(0, len(matrix), rows):
        part = matrix[low : low + rows]
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _scatter(clean: DataFrame, size: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, sums and product sums of the whole numbers; a row per matrix cell and task is shuffled."""
    wide = size + 1  # a constant in front, whose products are the number of rows and the sums
    upper = np.triu_indices(wide)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide, wide), dtype=object)
        for batch in batches:
            matrix = _matrix(batch.column(0), size)
            total += _products(np.concatenate([np.ones((len(matrix), 1)), matrix], axis=1))
        values, mask = total[upper], (1 << LIMB) - 1
        limbs = [[int(v) >> LIMB * k & (mask if k < LIMBS - 1 else -1) for v in values] for k in range(LIMBS)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(values)), pa.int32()), *[pa.array(x, pa.int64()) for x in limbs]], ["cell", *[f"l{k}" for k in range(LIMBS)]]
        )

    schema = "cell int, " + ", ".join(f"l{k} long" for k in range(LIMBS))
    cells = clean.select("vector").mapInArrow(partial, schema).groupBy("cell").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)])
    products = [[0] * wide for _ in range(wide)]
    for r in cells.collect():  # as many as the matrix has cells
        i, j = int(upper[0][r.cell]), int(upper[1][r.cell])
        products[i][j] = products[j][i] = sum(r[k + 1] << LIMB * k for k in range(LIMBS))
    return products[0][0], products[0][1:], [row[1:] for row in products[1:]]


# ---- the characteristic polynomial


def _is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every number below 3,215,031,751."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bits: int) -> list[int]:
    """The largest primes below ``PRIME_TOP`` whose product has more than ``bits`` bits."""
    found, product, candidate = [], 1, PRIME_TOP
    while product.bit_length() <= bits:
        candidate -= 1
        if _is_prime(candidate):
            found.append(candidate)
            product *= candidate
    return found


def hessenberg_polynomial(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(t I - matrix) modulo the prime ``p``, constant term first."""
    a = np.array([[v % p for v in row] for row in matrix], dtype=np.int64)
    size = len(a)
    for k in range(size - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        times = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - times[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * times % p).sum(axis=1)) % p
    rows = np.zeros((size + 1, size + 1), dtype=np.int64)  # row m: the polynomial of the leading m by m block
    rows[0, 0] = 1
    for m in range(1, size + 1):
        below, weight = 1, np.zeros(m, dtype=np.int64)
        for i in range(m - 1, -1, -1):
            weight[i] = int(a[i, m - 1]) * below % p
            below = below * int(a[i, i - 1]) % p if i else 0
        rows[m, 1:] = rows[m - 1, :-1]
        rows[m] = (rows[m] - (weight[:, None] * rows[:m] % p).sum(axis=0)) % p
    return rows[size].tolist()


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients for a symmetric positive semidefinite matrix, constant term first; tasks take primes."""
    size = len(matrix)
    trace = sum(matrix[i][i] for i in range(size))
    # the m-th coefficient is a sum of products of m roots, which is largest when all roots are equal
    bound = max(math.comb(size, m) * (trace // size + 1) ** m for m in range(size + 1))
    primes = primes_for(bound.bit_length() + 1)  # and a bit for the sign

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([hessenberg_polynomial(matrix, p) for p in of], pa.list_(pa.int64()))], ["p", "residues"]
            )

    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), 2 * spark.sparkContext.defaultParallelism))
    residues = {r.p: r.residues for r in dealt.mapInArrow(reduce, "p long, residues array<long>").collect()}
    product, coefficients = 1, [0] * (size + 1)
    for p in primes:
        inverse = pow(product, -1, p)
        coefficients = [c + product * ((r - c) * inverse % p) for c, r in zip(coefficients, residues[p])]
        product *= p
    return [c - product if 2 * c > product else c for c in coefficients]


# ---- its largest roots


def _beyond(coefficients: list[int], numerator: int, bits: int) -> int:
    """How many roots (all real) exceed numerator / 2**bits: sign changes after shifting the polynomial there."""
    degree = len(coefficients) - 1
    shifted = [c << bits * (degree - i) for i, c in enumerate(coefficients)]  # its roots are 2**bits times as large
    for i in range(degree):
        for j in range(degree - 1, i - 1, -1):
            shifted[j] += numerator * shifted[j + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


@dataclass
class Root:
    """The only distinct root in (low, high], in units of 2**-bits."""

    low: int
    high: int
    bits: int
    times: int

    def halved(self, coefficients: list[int], above: int) -> Root:
        low, high, bits = 2 * self.low, 2 * self.high, self.bits + 1
        middle = (low + high) // 2
        inside = _beyond(coefficients, middle, bits) - above > 0
        return Root(middle if inside else low, high if inside else middle, bits, self.times)


def largest_roots(coefficients: list[int], count: int) -> list[Root]:
    """Isolating intervals of the largest positive roots, falling, until ``count`` roots are held with multiplicity.

    ``coefficients``: integers, constant term first, leading coefficient 1, all roots real and none negative.
    """
    zeros = next(i for i, c in enumerate(coefficients) if c)  # roots at zero
    coefficients = coefficients[zeros:]
    degree = len(coefficients) - 1
    if degree == 0:
        return []
    top = 1 << (-coefficients[-2]).bit_length()  # above the sum of the roots
    # stack of (low, high, bits, roots above low, roots above high), the largest interval last
    found, held, stack = [], 0, [(0, top, 0, degree, 0)]
    while stack and held < min(count + 1, degree):  # one more, to know the distance below the last
        low, high, bits, above_low, above_high = stack.pop()
        times = above_low - above_high
        if not times:
            continue
        narrow = low > 0 and (high - low) << SAME_ROOT <= low
        if times == 1 or narrow:
            found.append((Root(low, high, bits, times), above_high))
            held += times
            continue
        low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        above = _beyond(coefficients, middle, bits)
        stack += [(low, middle, bits, above_low, above), (middle, high, bits, above, above_high)]
    done = []
    for at, (root, above) in enumerate(found):
        while True:
            width = root.high - root.low
            gaps = [root.low]
            for other, _ in found[max(0, at - 1) : at] + found[at + 1 : at + 2]:
                bits = max(root.bits, other.bits)
                mine, theirs = (root.low << bits - root.bits, root.high << bits - root.bits), (other.low << bits - other.bits, other.high << bits - other.bits)
                gaps.append(max(mine[0] - theirs[1], theirs[0] - mine[1]) >> bits - root.bits)
            if width << SPARE <= min(gaps) or (root.low and width << SAME_ROOT + SPARE <= root.low):
                break
            root = root.halved(coefficients, above)
        found[at] = (root, above)
        done.append(root)
    kept, held = [], 0
    for root in done:
        if held < count:
            kept.append(root)
            held += root.times
    return kept


# ---- and their vectors


def null_vectors(matrix: list[list[int]], root: Root, spread: int) -> list[list[Decimal]]:
    """Orthonormal vectors spanning the null space of matrix - root I, as many as the root has times.

    ``spread``: decimal digits of the largest root; inverse iteration near the singular matrix, in long decimals.
    """
    size = len(matrix)
    with localcontext() as context:
        known = len(str(max(1, root.low))) - len(str(max(1, root.high - root.low)))  # leading digits of the root
        context.prec = 60 + spread + 2 * max(0, known)
        context.Emax, context.Emin = 10**9, -(10**9)
        shift = Decimal(root.low + root.high) / (Decimal(2) ** (root.bits + 1))
        rows = [[Decimal(v) - shift if i == j else Decimal(v) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
        largest = max(abs(v) for row in rows for v in row) or Decimal(1)
        tiny, order = largest.scaleb(-context.prec), list(range(size))
        for k in range(size):  # factors of the elimination take the place of what they clear
            pivot = max(range(k, size), key=lambda i: abs(rows[i][k]))
            rows[k], rows[pivot], order[k], order[pivot] = rows[pivot], rows[k], order[pivot], order[k]
            above = rows[k]
            if abs(above[k]) < tiny:
                above[k] = tiny
            for row in rows[k + 1 :]:
                row[k] = times = row[k] / above[k]
                for j in range(k + 1, size):
                    row[j] -= times * above[j]

        def solved(right: list[Decimal]) -> list[Decimal]:
            y = [right[i] for i in order]
            for k in range(size):
                y[k] -= sum(rows[k][j] * y[j] for j in range(k))
            for k in range(size - 1, -1, -1):
                y[k] = (y[k] - sum(rows[k][j] * y[j] for j in range(k + 1, size))) / rows[k][k]
            return y

        def unit(v: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
            for _ in range(2):
                for w in others:
                    along = sum(a * b for a, b in zip(v, w))
                    v = [a - along * b for a, b in zip(v, w)]
                length = sum(a * a for a in v).sqrt()
                v = [a / length for a in v]
            return v

        found: list[list[Decimal]] = []
        draw = 1
        for _ in range(root.times):
            v = []
            for _ in range(size):  # a fixed start that is orthogonal to no vector but by chance
                draw = draw * 6364136223846793005 % (1 << 64) + 1442695040888963407
                v.append(Decimal((draw >> 20) % 2_000_003 - 1_000_001))
            for _ in range(3):
                v = unit(solved(unit(v, found)), found)
            found.append(v)
        return found


def fit(df: DataFrame, components: int = 8, vector_col: str = "embedding") -> Fit | None:
    """Fit all vectors of the table; None where no component has any spread."""
    clean = _clean(df, vector_col)
    lengths = clean.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).head(1)
    if not lengths or not lengths[0].size:
        return None
    size = lengths[0].size
    n, sums, products = _scatter(clean.where(F.size("vector") == size), size)
    scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)]
    trace = sum(scatter[i][i] for i in range(size))
    roots = largest_roots(characteristic_polynomial(df.sparkSession, scatter), components) if trace else []
    values, vectors = [], []
    for root in roots:
        value = (root.low + root.high) / (1 << root.bits + 1)  # a quotient of whole numbers, rounded once
        for vector in null_vectors(scatter, root, len(str(trace))):
            values.append(value)
            vectors.append([float(v) for v in vector])
    if not values:
        return None
    return Fit(n, tuple(sums), trace, tuple(values[:components]), np.array(vectors[:components]))


# ---- applied to the rows


def whitened(df: DataFrame, model: Fit | None, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """Rows (vec_id, n, deviation, whitened): the coordinates of every row along the components of ``model``.

    deviation: sum over dimensions of (n * x - S) squared, exact; null where 38 digits do not hold it.
    """
    clean = _clean(df, vector_col, id_col)
    id_type = dict(clean.dtypes)["vec_id"]
    if model is None:
        return clean.limit(0).select("vec_id", F.lit(0).cast("long").alias("n"), F.lit(None).cast("decimal(38,0)").alias("deviation"), "vector")
    n, size = model.n, model.dimensions
    spread = model.vectors.T / np.sqrt(np.array(model.roots))
    sums_exact = np.array(model.sums, dtype=object)
    largest_sum = max(map(abs, model.sums))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch.column(1), size)
            if not len(matrix):
                continue
            most = n * int(np.abs(matrix).max()) + largest_sum
            if most < 1 << 62:
                away = n * matrix.astype(np.int64) - np.array(model.sums, dtype=np.int64)
            else:
                away = n * _exact(matrix) - sums_exact
            if size * most * most < 1 << 63:
                deviation = [int(v) for v in (away * away).sum(axis=1)]
            else:
                deviation = [int(v) for v in (away.astype(object) ** 2).sum(axis=1)]
            coordinates = away.astype(np.float64) @ spread
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n] * len(matrix), pa.int64()),
                    pa.array([Decimal(v) if v < 10**38 else None for v in deviation], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(np.arange(len(matrix) + 1, dtype=np.int32) * coordinates.shape[1], pa.array(coordinates.ravel())),
                ],
                ["vec_id", "n", "deviation", "whitened"],
            )

    fitting = clean.where(F.size("vector") == size)
    return fitting.mapInArrow(project, f"vec_id {id_type}, n long, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` (divisor n, centred first) minus the identity."""
    parts = rows.select(*[F.col("whitened")[k].alias(f"w{k}") for k in range(components)])
    means = parts.agg(*[F.avg(f"w{k}") for k in range(components)]).head()
    centred = parts.select(*[(F.col(f"w{k}") - F.lit(means[k])).alias(f"w{k}") for k in range(components)])
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    entries = centred.agg(*[F.avg(F.col(f"w{i}") * F.col(f"w{j}")) for i, j in pairs]).head()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, entries))


def whiten(df: DataFrame, components: int = 8, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """A row per fitted row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    model = fit(df, components, vector_col)
    rows = whitened(df, model, vector_col, id_col)
    if model is None:
        empty = "component int, whitened double, explained double, identity_error double"
        return rows.select("vec_id", "n", "deviation", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in empty.split(", ")])
    rows = stored(rows, "whitened")
    share = F.array(*[F.lit(v / model.trace) for v in model.roots])
    error = identity_error(rows, len(model.roots))
    each = rows.select("vec_id", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
