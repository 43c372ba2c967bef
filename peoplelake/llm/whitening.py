"""Operator 13, embedding whitening: eigenvalues as roots of the exact characteristic polynomial of the integer scatter."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction
from math import prod

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplelake.llm.common import ship, staged

COMPONENTS = 4
SCALE = 256
#: Bits that a root is narrowed to beyond its own size, and decimal digits of the null-space iteration.
BITS = 160
DIGITS = 80
#: Exact values leave Spark as decimals of this many digits; beyond them the job fails.
WIDE = "decimal(38,0)"


# -- the characteristic polynomial ------------------------------------------------------------------------------------------
def is_prime(n: int) -> bool:
    """For n below 3.2e9; the bases are those known to decide that range."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2**31 whose product exceeds ``bound``."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients, constant first, of det(x - matrix) modulo ``p``: similarity to Hessenberg form, then its recurrence."""
    h, n = matrix.copy() % p, len(matrix)
    for j in range(n - 2):
        below = np.flatnonzero(h[j + 1:, j])
        if not len(below):
            continue
        pivot = j + 1 + int(below[0])
        if pivot != j + 1:
            h[[j + 1, pivot]] = h[[pivot, j + 1]]
            h[:, [j + 1, pivot]] = h[:, [pivot, j + 1]]
        factor = h[j + 2:, j] * pow(int(h[j + 1, j]), -1, p) % p
        h[j + 2:] = (h[j + 2:] - factor[:, None] * h[j + 1][None, :]) % p
        h[:, j + 1] = (h[:, j + 1] + (h[:, j + 2:] * factor[None, :] % p).sum(axis=1)) % p
    found = np.zeros((n + 1, n + 1), np.int64)
    found[0, 0] = 1
    for k in range(n):
        found[k + 1, 1:] = found[k, :-1]
        chain = 1
        found[k + 1] = (found[k + 1] - int(h[k, k]) * found[k]) % p
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if chain == 0:
                break
            found[k + 1] = (found[k + 1] - (chain * int(h[i, k]) % p) * found[i]) % p
    return found[n].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients, constant first, of det(x - matrix) for a symmetric integer matrix without negative eigenvalues.

    The eigenvalues' mean is the trace over n, so no coefficient exceeds (1 + trace / n)**n. Primes are dealt over tasks, and
    the remainders of each coefficient are put together by Chinese remaindering.
    """
    n = len(matrix)
    bound = 2 * (1 + -(-sum(matrix[i][i] for i in range(n)) // max(1, n))) ** n + 1
    primes = primes_beyond(bound)

    def remainders(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p in frame["p"].tolist():
                own = np.array([[x % p for x in row] for row in matrix], np.int64).reshape(n, n)
                yield pd.DataFrame({"p": [p], "found": [polynomial_mod(own, p)]})

    tasks = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(min(len(primes), 64), "p")
    found = {r["p"]: r["found"] for r in tasks.mapInPandas(remainders, "p bigint, found array<bigint>").collect()}
    whole = prod(primes)
    weights = {p: (whole // p) * pow(whole // p, -1, p) for p in primes}
    out = [sum(weights[p] * found[p][k] for p in primes) % whole for k in range(n + 1)]
    return [c - whole if c > whole // 2 else c for c in out]


# -- its largest roots ------------------------------------------------------------------------------------------------------
def roots_above(polynomial: Sequence[int], numerator: int, bits: int) -> int:
    """How many roots exceed numerator / 2**bits, repeats counted: sign changes of the polynomial shifted there, which is
    exact as all its roots are real."""
    n = len(polynomial) - 1
    c = [a << bits * (n - k) for k, a in enumerate(polynomial)]  # roots times 2**bits
    for i in range(n):
        for k in range(n - 1, i - 1, -1):
            c[k] += numerator * c[k + 1]
    signs = [a > 0 for a in c if a]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(polynomial: Sequence[int], numerator: int, bits: int) -> int:
    """The polynomial's sign at numerator / 2**bits."""
    value = shift = 0
    for a in reversed(polynomial):
        value = value * numerator + (a << shift)
        shift += bits
    return (value > 0) - (value < 0)


def largest_roots(polynomial: Sequence[int], most: int, precision: int = BITS) -> list[Fraction]:
    """The ``most`` largest roots, repeats counted and all if fewer, of a polynomial whose roots are real and not negative.

    An interval is halved by the count of roots beyond its middle until the root is alone in it, then by the sign there; at
    last it is narrower than its lower end by ``precision`` bits. A root 0 is exact. Repeated roots come from equal intervals.
    """
    n = len(polynomial) - 1
    zeros = next((k for k, a in enumerate(polynomial) if a), n)
    polynomial = polynomial[zeros:]
    positive = n - zeros
    found: list[Fraction] = []
    top = max(1, abs(polynomial[-2])) if positive else 1  # the sum of the roots
    # more than `place` roots exceed low, at most `place` exceed high
    for place in range(min(most, positive)):
        low, high, bits = 0, top, 0
        at_low, at_high, side = positive, 0, 0  # roots beyond either end; the sign at the upper end once a root is alone
        while low == 0 or (high - low) << precision > low:
            if high - low <= 1:
                low, high, bits = low << 1, high << 1, bits + 1
            middle = (low + high) >> 1
            if not side and at_low - at_high == 1:
                side = _sign(polynomial, high, bits)
            if side:
                below = _sign(polynomial, middle, bits) == -side
            else:
                count = roots_above(polynomial, middle, bits)
                below = count > place
                at_low, at_high = (count, at_high) if below else (at_low, count)
            low, high = (middle, high) if below else (low, middle)
        found.append(Fraction(low + high, 2 << bits))
    return found + [Fraction(0)] * (min(most, n) - len(found))


# -- their eigenvectors -------------------------------------------------------------------------------------------------------
def eigenvectors(matrix: list[list[int]], roots: Sequence[Fraction], digits: int = DIGITS) -> list[list[float]]:
    """A unit eigenvector per root, orthogonal to those before it, by inverse iteration on the near-singular matrix.

    Elimination with row exchanges of matrix - root runs in decimals of ``digits`` digits. The null-space vector grows from
    the start by the inverse of the root's error; vectors of earlier roots are taken out in each step, so that equal roots
    give a basis of their space. The entry of largest size is positive.
    """
    n = len(matrix)
    with localcontext() as context:
        context.prec = digits
        scale = Decimal(max(1, sum(matrix[i][i] for i in range(n))))
        out: list[list[Decimal]] = []
        for root in roots:
            shift = Decimal(root.numerator) / Decimal(root.denominator)
            a = [[(Decimal(x) - (shift if i == j else 0)) / scale for j, x in enumerate(row)] for i, row in enumerate(matrix)]
            steps = []
            tiny = Decimal(10) ** (10 - digits)
            for k in range(n):
                pivot = max(range(k, n), key=lambda i: abs(a[i][k]))
                a[k], a[pivot] = a[pivot], a[k]
                if abs(a[k][k]) < tiny:
                    a[k][k] = tiny
                factors = [a[i][k] / a[k][k] for i in range(k + 1, n)]
                for i, f in enumerate(factors, k + 1):
                    if f:
                        row, top = a[i], a[k]
                        for j in range(k + 1, n):
                            row[j] -= f * top[j]
                steps.append((pivot, factors))

            def solved(b: list[Decimal]) -> list[Decimal]:
                b = b[:]
                for k, (pivot, factors) in enumerate(steps):
                    b[k], b[pivot] = b[pivot], b[k]
                    for i, f in enumerate(factors, k + 1):
                        b[i] -= f * b[k]
                for k in range(n - 1, -1, -1):
                    b[k] = (b[k] - sum((a[k][j] * b[j] for j in range(k + 1, n)), Decimal(0))) / a[k][k]
                return b

            def apart(v: list[Decimal]) -> list[Decimal]:
                for _ in range(2):
                    for u in out:
                        along = sum((x * y for x, y in zip(u, v)), Decimal(0))
                        v = [y - along * x for x, y in zip(u, v)]
                    length = sum((x * x for x in v), Decimal(0)).sqrt()
                    v = [x / length for x in v]
                return v

            # any start with a part in the null space will do; this one is fixed and has no symmetry
            vector = apart([1 + Decimal((k * k * 7 + len(out) * 13 + 1) % 101) / 101 for k in range(n)])
            for _ in range(3):
                vector = apart(solved(vector))
            largest = max(vector, key=abs)
            out.append([x if largest > 0 else -x for x in vector])
        return [[float(x) for x in v] for v in out]


# -- whole tables -------------------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Whitening:
    """The fitted map: ``n`` vectors with per-dimension ``sums``, the trace of n**2 times their covariance, and per component
    n**2 times its eigenvalue as an exact-to-160-bits fraction with its unit vector."""

    n: int
    sums: list[int]
    trace: int
    roots: list[Fraction]
    vectors: list[list[float]]

    @property
    def eigenvalues(self) -> list[float]:
        return [float(r / self.n**2) for r in self.roots]

    @property
    def explained(self) -> list[float | None]:
        return [float(r / self.trace) if self.trace else None for r in self.roots]


def integer_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): the rows that take part, components c as floor(256 * c), all as long as the longest by zeros at the end."""
    c = F.col(vector_col).cast("array<double>")
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.filter(F.coalesce(finite, F.lit(False))).select(
        F.col(id_col).alias("id"), F.transform(c, lambda v: F.floor(v * SCALE)).alias("x"))
    rows = staged(rows, "whitening-rows")
    width = rows.agg(F.max(F.size("x")).alias("width")).first()["width"] or 0
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("x")))
    return rows.select("id", padded.alias("x"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(x, np.int64) for x in column], np.int64).reshape(len(column), -1)


def _moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(i, j, value) of a task: the products of dimensions i <= j summed, with i = -1 the sums, with i = j = -1 the rows."""
    total = None
    for frame in frames:
        x = _matrix(frame["x"])
        if not len(x):
            continue
        x = np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1)
        exact = x if int(np.abs(x).max()) ** 2 * len(x) < 1 << 62 else x.astype(object)
        own = (exact.T @ exact).astype(object)
        total = own if total is None else total + own
    if total is not None:
        i, j = np.triu_indices(len(total))
        yield pd.DataFrame({"i": i - 1, "j": j - 1, "value": [str(v) for v in total[i, j]]})


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the different vectors of ``rows`` (column ``x``), each once; None if there are none.

    Tasks add up integer products, Spark adds those of all tasks as decimals; what reaches the driver is one number per
    pair of dimensions, whatever the number of rows. n times the products less the products of the sums is n**2 times
    the centred covariance, without rounding.
    """
    spark = rows.sparkSession
    parts = rows.select("x").mapInPandas(_moments, "i int, j int, value string")
    moments = parts.groupBy("i", "j").agg(F.sum(F.col("value").cast(WIDE)).alias("value"))
    found = {(r["i"], r["j"]): int(r["value"]) for r in moments.collect()}
    if not found:
        return None
    n = found[-1, -1]
    width = max(j for _, j in found) + 1
    sums = [found[-1, j] for j in range(width)]
    scatter = [[n * found[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    trace = sum(scatter[i][i] for i in range(width))
    if not width or not trace:
        roots = [Fraction(0)] * min(components, width)
    else:
        roots = largest_roots(characteristic_polynomial(spark, scatter), components)
    return Whitening(n, sums, trace, roots, eigenvectors(scatter, roots))


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - sums, exact: 64-bit integers if the squares of a row add up to less, else Python's."""
    largest = int(np.abs(x).max(initial=0)) * model.n + max(map(abs, model.sums))
    kind = np.int64 if largest**2 * x.shape[1] < 1 << 62 else object
    return x.astype(kind) * model.n - np.array(model.sums, kind)


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened values, a column per component, NaN where the eigenvalue is 0."""
    centred = _centred(x, model).astype(np.float64) / model.n
    out = np.full((len(x), len(model.roots)), np.nan)
    for k, (value, vector) in enumerate(zip(model.eigenvalues, model.vectors)):
        if value > 0:
            out[:, k] = (centred * np.array(vector)).sum(axis=1) / value**0.5
    return out


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened ``rows`` less the identity, over the components with a
    positive eigenvalue, 0 if there are none. Each pair's covariance is one centred aggregate."""
    live = [k for k, r in enumerate(model.roots) if r > 0]
    if not live:
        return 0.0
    names = [f"w{k}" for k in live]

    def project(frames):
        for frame in frames:
            yield pd.DataFrame(_projected(_matrix(frame["x"]), model)[:, live], columns=names)

    whitened = rows.select("x").mapInPandas(project, ", ".join(f"{c} double" for c in names))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    found = whitened.agg(*[F.covar_pop(a, b).alias(f"{a}_{b}") for a, b in pairs]).first()
    return max(abs(found[f"{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per row that takes part and component: (id, component, n, deviation, whitened, explained, identity_error).

    Components of vectors count as integers x = floor(256 * c). The fit list is each distinct x vector once, so copies and ties
    weigh once; all rows are projected. ``deviation`` is the sum over dimensions of (n * x - sum)**2, exact as decimal(38,0);
    ``whitened`` the centred x on the component over the root of its eigenvalue; ``explained`` the eigenvalue's share of the
    trace; ``identity_error`` the largest entry of the whitened fit list's covariance less the identity.

    Rows whose vector is null or has null or non-finite entries are left out; a null id passes. Shorter vectors, empty
    ones too, are padded with zeros at the end. With fewer dimensions than ``components`` there is one component for each; no
    dimensions or no rows give no rows. A component without variance has null ``whitened``, and null ``explained`` if there is no
    variance at all. Other columns are not looked at. Sums beyond 38 digits fail the job.
    """
    ship(vectors.sparkSession)
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = integer_rows(vectors, id_col, vector_col)
    fitted_on = staged(rows.select("x").distinct(), "whitening-fit")
    model = fit(fitted_on, components)
    schema = (f"`{id_col}` {kind}, component int, n bigint, deviation {WIDE}, whitened double, explained double, "
              "identity_error double")
    if model is None or not model.roots:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(fitted_on, model)
    many = len(model.roots)

    def project(frames):
        for frame in frames:
            x = _matrix(frame["x"])
            deviation = [str(d) for d in (_centred(x, model) ** 2).sum(axis=1).tolist()]
            values = _projected(x, model)
            yield pd.DataFrame({
                id_col: frame["id"].repeat(many).reset_index(drop=True), "component": np.tile(np.arange(1, many + 1), len(x)), "n": model.n,
                "deviation": np.repeat(deviation, many),
                "whitened": pd.array(values.ravel(), "Float64"), "explained": model.explained * len(x), "identity_error": error})

    made = rows.select("id", "x").mapInPandas(project, schema.replace(f"deviation {WIDE}", "deviation string"))
    return made.withColumn("deviation", F.col("deviation").cast(WIDE))
