"""Whitening of embeddings by an exact characteristic polynomial.

A component c counts as the whole number x = floor(64 * c) + 1000000. Spark adds up the exact integer sums S of x and of x x^T
(as floor(64 * c), which the shift does not change), so n times the scatter, M = n * sum(x x^T) - S S^T, is an exact integer
matrix, n**2 times the covariance. Its characteristic polynomial is found modulo many primes, each by a reduction to
Hessenberg form, in a Spark job over the primes; Chinese remaindering joins them to the exact integer coefficients, which
Newton's bound on a positive matrix's eigenvalues limits. The polynomial has real roots only, so the sign changes of its
coefficients after a shift count the roots beyond a point exactly, with multiplicity; halving the interval isolates them and
then narrows them to ``BITS`` bits. An eigenvector spans the null space of M less its root: inverse iteration in fixed-point
integers finds it, in the whole space of a multiple root with orthogonal vectors.

The rows are read three times (sums, covariance of the result, result) and never shuffled: tasks hand on sums per pair of
dimensions. The matrix, d x d, is all that the driver sees.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries, and vectors not of the commonest length
(of equally common, the largest), take no part; floor(64 * c) is held within +-2**62; rows that repeat count as often as they
stand there, null ids stay. Components whose eigenvalue is 0 have no unit of scale and are left out, so that a table of one
distinct vector, or an empty one, gives no rows. Equal eigenvalues have any orthonormal vectors of their space, the same for
all rows. A deviation beyond a long (some 30 million rows) is null in the query, and exact in ``whitened``. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import table

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Roots are narrowed to this share of the largest, and vectors iterated with as many bits and a reserve.
BITS, RESERVE = 128, 128
#: Whole numbers below 2**LIMB have exact products and sums of ``AT_ONCE`` of them in double precision.
LIMB, AT_ONCE = 20, 4096
LARGEST_PRIME = 2**31


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, values (doubles) of the rows that take part."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("values"))
    finite = F.forall("values", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("values").isNotNull() & (F.size("values") > 0) & finite)
    kinds = rows.groupBy(F.size("values").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.filter(F.size("values") == (kinds[0].d if kinds else 0))


def counted(values: np.ndarray) -> np.ndarray:
    """floor(64 * c): x without the shift."""
    scaled = np.floor(values * float(SCALE))
    return np.clip(scaled, -2.0**62, 2.0**62).astype(np.int64)


def _values(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as signed digits to the base 2**LIMB, the last of any sign."""
    out = []
    while True:
        if not len(x) or np.abs(x).max() < 1 << LIMB:
            return [*out, x.astype(float)]
        out.append((x & ((1 << LIMB) - 1)).astype(float))
        x = x >> LIMB


def exact_products(x: np.ndarray) -> np.ndarray:
    """x^T x in Python integers."""
    total = np.zeros((x.shape[1],) * 2, object)
    for begin in range(0, len(x), AT_ONCE):
        limbs = _limbs(x[begin:begin + AT_ONCE])
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << LIMB * (i + j)
    return total


def moments(rows: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """n, the sums of floor(64 * c), and the sums of their products, exact."""
    def run(batches):
        n, total, products = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = counted(_values(batch.column("values")))
                n, total = n + len(x), total + (((x >> 31).sum(axis=0).astype(object) << 31) + (x & (1 << 31) - 1).sum(axis=0))
                products = products + exact_products(x)
        if n:
            d = len(total)
            at = [(-1, -1, n), *((-1, i, total[i]) for i in range(d)), *((i, j, products[i, j]) for i in range(d) for j in range(i, d))]
            # In two parts, so that sums over all tasks fit a decimal of 38 digits.
            columns = [pa.array([a[0] for a in at], pa.int32()), pa.array([a[1] for a in at], pa.int32()),
                       *(pa.array([str(part(a[2])) for a in at]) for part in (lambda v: v >> 60, lambda v: v & ((1 << 60) - 1)))]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", "high", "low"])

    sums = rows.select("values").mapInArrow(run, "i int, j int, high string, low string").groupBy("i", "j").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]).collect()
    value = {(r.i, r.j): (int(r.high) << 60) + int(r.low) for r in sums}
    n = value.pop((-1, -1), 0)
    d = sum(i < 0 for i, _ in value)
    products = np.array([[value[min(i, j), max(i, j)] for j in range(d)] for i in range(d)], object).reshape(d, d)
    return n, [value[-1, j] for j in range(d)], products


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test, certain below 3.2 * 10**9 with these bases."""
    if n < 11 or not n % 2:
        return n in (2, 3, 5, 7)
    s = ((n - 1) & -(n - 1)).bit_length() - 1
    for a in (2, 3, 5, 7):
        x = pow(a, (n - 1) >> s, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes from ``LARGEST_PRIME`` downwards whose product is over the bound."""
    out, product, p = [], 1, LARGEST_PRIME + 1
    while product <= bound:
        p -= 2
        if _is_prime(p):
            out.append(p)
            product *= p
    return out


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``a`` modulo p, with zeros below the first subdiagonal. Entries below 2**31: products fit a long."""
    a, d = a.copy(), len(a)
    for k in range(d - 2):
        pivots = np.flatnonzero(a[k + 1:, k])
        if not len(pivots):
            continue
        r = k + 1 + int(pivots[0])
        if r != k + 1:
            a[[k + 1, r]] = a[[r, k + 1]]
            a[:, [k + 1, r]] = a[:, [r, k + 1]]
        factor = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - factor[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * factor % p).sum(axis=1)) % p  # the inverse step keeps it similar
    return a


def polynomial_modulo(a: np.ndarray, p: int) -> list[int]:
    """det(t - a) modulo p, the constant term first: the leading minors' polynomials by the Hessenberg recurrence."""
    h, d = hessenberg(a, p), len(a)
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(d):
        following = np.zeros(d + 1, np.int64)
        following[1:] = polys[k, :-1]
        following = (following - polys[k] * h[k, k] % p) % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(h[i + 1, i]) % p
            if not below:
                break
            following = (following - polys[i] * (int(h[i, k]) * below % p) % p) % p
        polys[k + 1] = following
    return polys[d].tolist()


def characteristic_polynomial(spark: SparkSession, m: np.ndarray) -> list[int]:
    """det(t - m) of a positive semi-definite integer matrix, exact, the constant term first."""
    d, trace = len(m), int(np.trace(m))
    # A coefficient is an elementary symmetric sum of eigenvalues, which is largest when they are equal (Maclaurin).
    bound = 2 * max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1)) + 1
    primes = primes_for(bound)
    shared = spark.sparkContext.broadcast(m)

    def run(batches):
        for batch in batches:
            ps = batch.column("p").to_pylist()
            coefficients = [polynomial_modulo((shared.value % p).astype(np.int64), p) for p in ps]
            yield pa.RecordBatch.from_arrays([batch.column("p"), pa.array(coefficients, pa.list_(pa.int64()))], ["p", "coefficients"])

    parts = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    residues = spark.createDataFrame([(p,) for p in primes], "p long").repartition(parts).mapInArrow(
        run, "p long, coefficients array<long>").collect()
    product = math.prod(primes)
    weights = [(product // r.p) * pow(product // r.p, -1, r.p) for r in residues]
    out = []
    for k in range(d + 1):
        c = sum(w * r.coefficients[k] for w, r in zip(weights, residues)) % product
        out.append(c - product if 2 * c > product else c)
    return out


def roots_beyond(poly: list[int], t: int) -> int:
    """The number of roots over t, with multiplicity, of a polynomial with real roots only: the sign changes of its
    coefficients after a shift by t (Descartes' rule, which is exact for such polynomials)."""
    shifted = list(poly)
    for i in range(len(shifted) - 1):
        for j in range(len(shifted) - 2, i - 1, -1):
            shifted[j] += t * shifted[j + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _above(poly: list[int], t: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * t + c
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], count: int, trace: int) -> list[tuple[int, int]]:
    """The largest positive roots, falling, as (root * 2**s, multiplicity), s = ``scale_of(trace)``. Roots that agree in all
    those bits count as one."""
    d, s = len(poly) - 1, scale_of(trace)
    poly = [c << s * (d - k) for k, c in enumerate(poly)]  # its roots are 2**s times larger
    # (low, high], the roots over low and over high.
    stack, out = [(0, (trace + 1) << s, roots_beyond(poly, 0), 0)], []
    while stack and sum(m for _, m in out) < count:
        low, high, over_low, over_high = stack.pop()
        if over_low == over_high:
            continue
        if high - low == 1:
            out.append((high, over_low - over_high))
        elif over_low - over_high == 1:
            # One simple root: the sign tells on which side it is.
            side = _above(poly, high)
            if side == 0:
                out.append((high, 1))
                continue
            while high - low > 1:
                middle = (low + high) // 2
                at = _above(poly, middle)
                low, high = (low, middle) if at == side or at == 0 else (middle, high)
            out.append((high, 1))
        else:
            middle = (low + high) // 2
            over = roots_beyond(poly, middle)
            stack += [(low, middle, over_low, over), (middle, high, over, over_high)]
    return out


def scale_of(trace: int) -> int:
    return max(0, BITS - trace.bit_length())


def null_vectors(m: np.ndarray, root: int, s: int, multiplicity: int) -> list[list[int]]:
    """Vectors that m - root / 2**s takes nearly to zero, by inverse iteration in fixed-point integers."""
    d = len(m)
    bits = BITS + RESERVE
    size = max(int(np.trace(m)), 1).bit_length()
    # Entries as shares of 2**size, with ``bits`` bits.
    a = [[(int(m[i, j]) << bits) >> size for j in range(d)] for i in range(d)]
    for i in range(d):
        a[i][i] -= (root << bits) >> (size + s)
    a, order, steps = np.array(a, object), [], []
    for k in range(d):  # factors with the largest pivot of a column
        r = k + int(np.argmax(np.abs(a[k:, k])))
        order.append(r)
        if r != k:
            a[[k, r]] = a[[r, k]]
        if not a[k, k]:
            a[k, k] = 1  # singular in all bits: any tiny pivot leads into the null space
        factor = (a[k + 1:, k] << bits) // a[k, k]
        steps.append(factor)
        a[k + 1:, k:] -= (factor[:, None] * a[k, k:]) >> bits
    found = []
    for v in range(multiplicity):
        rng = np.random.default_rng(v)
        x = np.array([int(c) << bits - 20 for c in rng.integers(1 << 18, 1 << 20, d)], object)
        for _ in range(3):
            for k in range(d):
                x[[k, order[k]]] = x[[order[k], k]]
                x[k + 1:] -= (steps[k] * x[k]) >> bits
            for k in range(d - 1, -1, -1):
                x[k] = ((x[k] << bits) - (int((a[k, k + 1:] * x[k + 1:]).sum()) if k + 1 < d else 0)) // a[k, k]
            for other in found:  # orthogonal to the vectors of the same root
                x -= other * int((x * other).sum()) // int((other * other).sum())
            top = max(int(max(abs(c) for c in x)), 1)
            x = np.array([(int(c) << bits) // top for c in x], object)
        found.append(x)
    return found


def components(spark: SparkSession, m: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues of m, their shares of its trace, unit vectors as columns) of the largest positive eigenvalues. Roots are
    dealt to tasks, which find their vectors."""
    trace = int(np.trace(m))
    s = scale_of(trace)
    roots = largest_roots(characteristic_polynomial(spark, m), count, trace) if trace else []
    shared = spark.sparkContext.broadcast(m)

    def run(batches):
        for batch in batches:
            out = []
            for number, root, multiplicity in zip(*(batch.column(c).to_pylist() for c in ("number", "root", "multiplicity"))):
                for x in null_vectors(shared.value, int(root), s, multiplicity):
                    v = np.array([c / (1 << BITS + RESERVE) for c in x])
                    v /= np.sqrt((v * v).sum())
                    out.append((number, root, v * np.sign(v[np.argmax(np.abs(v))])))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.string()),
                                              pa.array([o[2] for o in out], pa.list_(pa.float64()))], ["number", "root", "vector"])

    # A space is cut to the components that are asked for.
    rows, left = [], count
    for i, (root, multiplicity) in enumerate(roots):
        rows.append((i, str(root), min(multiplicity, left)))
        left -= rows[-1][2]
    found = spark.createDataFrame(rows, "number int, root string, multiplicity int").repartition(max(len(rows), 1), "number").mapInArrow(
        run, "number int, root string, vector array<double>").collect()
    found.sort(key=lambda r: r.number)
    values = [int(r.root) for r in found]
    return (np.array([v / (1 << s) for v in values]), np.array([v / (trace << s) for v in values]),
            np.array([r.vector for r in found]).T.reshape(len(m), -1))


def _projected(values: np.ndarray, n: int, sums: np.ndarray, projection: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n * x - S as floats, whitened). The difference is taken in whole numbers, so that nothing cancels."""
    x = counted(values)
    if len(x) and max(abs(int(x.max())), abs(int(x.min()))) * n < 2**62 and max(abs(int(v)) for v in sums) < 2**62:
        away = x * n - sums.astype(np.int64)
    else:
        away = x.astype(object) * n - sums
    return away, (away.astype(float) / n) @ projection


def whitened(vectors: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error, eigenvalue."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    n, sums, products = moments(rows)
    d = len(sums)
    sums = np.array(sums, object)
    m = n * products - np.outer(sums, sums) if d else products
    values, shares, units = components(spark, m, count) if d else ([], [], np.zeros((0, 0)))
    answer = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double, eigenvalue double"
    if not len(values):
        return spark.createDataFrame([], answer)
    eigenvalues = values / n / n  # of the covariance
    k = len(values)
    model = spark.sparkContext.broadcast((sums, units / np.sqrt(eigenvalues)))

    def spread(batches):
        for batch in batches:
            if batch.num_rows:
                w = _projected(_values(batch.column("values")), n, *model.value)[1]
                mean = w.mean(axis=0)
                away = w - mean
                i, j = np.triu_indices(k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([np.full(k, -1), i]).astype(np.int32)), pa.array(np.concatenate([np.arange(k), j]).astype(np.int32)),
                     pa.array(np.concatenate([mean * len(w), (away.T @ away + len(w) * np.outer(mean, mean))[i, j]]))], ["i", "j", "v"])

    total = {(r.i, r.j): r.v for r in rows.select("values").mapInArrow(spread, "i int, j int, v double")
             .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    error = max(abs(v / n - total[-1, i] * total[-1, j] / n / n - (i == j)) for (i, j), v in total.items() if i >= 0)
    numbers, explained = np.arange(1, k + 1, dtype=np.int32), np.array(shares)

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(begin, AT_ONCE)
                away, w = _projected(_values(part.column("values")), n, *model.value)
                if away.dtype != object and len(away) and np.abs(away).max() < 2**31 / math.sqrt(d):
                    deviation = (away * away).sum(axis=1).tolist()
                else:
                    deviation = [sum(int(c) * int(c) for c in row) for row in away]
                deviation = [str(v) if v < 10**38 else None for v in deviation]
                at = pa.array(np.repeat(np.arange(len(w)), k))
                rows_of = lambda x: pa.array(np.tile(x, len(w)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(at), rows_of(numbers), pa.array(np.full(len(at), n)),
                     pa.array(deviation, pa.string()).take(at), pa.array(w.ravel()), rows_of(explained), pa.array(np.full(len(at), error)),
                     rows_of(eigenvalues)], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"])

    kind = dict(rows.dtypes)["vec_id"]
    return rows.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation string, whitened double, explained double, "
                                "identity_error double, eigenvalue double").withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``embeddings`` on up to 32 components."""
    rows = whitened(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))
