"""Correlation matrices with significance, as long ``(x, y, ...)`` tables.

The matrix is one pass: tasks add up pairwise-complete moments of all pairs of columns
in numpy, and these are added up by tile, so the data is read
once whatever ``k`` is.  The p-value needs the regularised incomplete beta
function, which Spark lacks; it runs as an Arrow-batched ``pandas_udf`` over
the ``k^2`` result rows only (never over data rows).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Significance thresholds for one, two and three stars.
STAR_THRESHOLDS = (0.05, 0.01, 0.001)


def _pair_stats(x: Column, y: Column) -> list[Column]:
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    n = F.count_if(both)
    cov = F.covar_pop(xx, yy)
    den = F.stddev_pop(xx) * F.stddev_pop(yy)
    # try_divide: a constant column gives null instead of an ANSI error.
    return [F.try_divide(cov, den), n]


TILE = 16  # columns of a tile of the moment matrix
GROUPS = 64


class Moments:
    """Pairwise-complete counts, means, squares and products of the columns ``x`` with the columns ``y``; they can be added up.

    ``mx[i, j]``: the mean of x_i over the rows that also have y_j, ``my`` that of y_j;
    ``vx``, ``vy`` and ``c``: sums of squared deviations and of products of deviations from them.
    """

    NAMES = ("n", "mx", "my", "vx", "vy", "c")

    def __init__(self, n, mx, my, vx, vy, c):
        self.n, self.mx, self.my, self.vx, self.vy, self.c = n, mx, my, vx, vy, c

    @classmethod
    def of(cls, x: np.ndarray, y: np.ndarray) -> "Moments":
        # deviations from a value of the column itself, so that a constant column has none
        sx, sy = (np.array([col[~np.isnan(col)][0] if (~np.isnan(col)).any() else 0.0 for col in a.T]) for a in (x, y))
        hx, hy = (~np.isnan(x)).astype(float), (~np.isnan(y)).astype(float)
        dx, dy = np.nan_to_num(x - sx), np.nan_to_num(y - sy)
        n = hx.T @ hy
        some = np.maximum(n, 1.0)
        tx, ty = dx.T @ hy, hx.T @ dy
        return cls(n, sx[:, None] + tx / some, sy[None, :] + ty / some, (dx * dx).T @ hy - tx * tx / some,
                   hx.T @ (dy * dy) - ty * ty / some, dx.T @ dy - tx * ty / some)

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        some = np.maximum(n, 1.0)
        dx = np.where((self.n > 0) & (other.n > 0), other.mx - self.mx, 0.0)
        dy = np.where((self.n > 0) & (other.n > 0), other.my - self.my, 0.0)
        share, both = other.n / some, self.n * other.n / some
        mx, my = (np.where(self.n > 0, a + d * share, b) for a, d, b in ((self.mx, dx, other.mx), (self.my, dy, other.my)))
        return Moments(n, mx, my, self.vx + other.vx + dx * dx * both, self.vy + other.vy + dy * dy * both, self.c + other.c + dx * dy * both)

    def pack(self) -> bytes:
        return np.stack([getattr(self, x) for x in self.NAMES]).tobytes()

    @classmethod
    def unpack(cls, data: bytes, shape: tuple[int, int]) -> "Moments":
        return cls(*np.frombuffer(data, np.float64).reshape(len(cls.NAMES), *shape))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """ST1: ``(x, y, r, n)`` for every ordered pair (diagonal included).

    Pearson r on pairwise-complete rows; null for a constant column.  Each task adds up
    one matrix of moments and gives it in tiles of ``TILE`` columns; the tiles of all
    tasks are added up in two steps, whatever the number of columns.
    """
    cols = list(columns)
    parts = [range(a, min(a + TILE, len(cols))) for a in range(0, len(cols), TILE)]
    tiles = [(i, j) for i in range(len(parts)) for j in range(i, len(parts))]
    # columns are told apart by place: a name may stand twice
    data = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(cols)])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            for i, j in tiles:
                own = Moments.of(values[:, parts[i]], values[:, parts[j]])
                total[i, j] = total[i, j] + own if (i, j) in total else own
        group = TaskContext.get().partitionId() % GROUPS
        yield pa.RecordBatch.from_pylist([{"i": i, "j": j, "g": group, "m": m.pack()} for (i, j), m in total.items()], _MOMENTS)

    def added(table: pa.Table) -> pa.Table:
        first = {c: table[c][0].as_py() for c in ("i", "j", "g")}
        shape = len(parts[first["i"]]), len(parts[first["j"]])
        total = sum((Moments.unpack(m, shape) for m in table["m"].to_pylist()[1:]), Moments.unpack(table["m"][0].as_py(), shape))
        return pa.Table.from_pylist([first | {"m": total.pack()}], _MOMENTS)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                i, j = parts[row["i"]], parts[row["j"]]
                m = Moments.unpack(row["m"], (len(i), len(j)))
                with np.errstate(divide="ignore", invalid="ignore"):
                    r = np.where((m.vx > 0) & (m.vy > 0), m.c / np.sqrt(m.vx) / np.sqrt(m.vy), np.nan)
                found = {}
                for a, x in enumerate(i):
                    for b, y in enumerate(j):
                        found[x, y] = found[y, x] = (None if np.isnan(r[a, b]) else float(r[a, b])), int(m.n[a, b])
                yield pa.RecordBatch.from_pylist([{"x": cols[x], "y": cols[y], "r": r, "n": n} for (x, y), (r, n) in found.items()], _PAIRS)

    schema = "i int, j int, g int, m binary"
    sums = data.mapInArrow(gathered, schema).groupBy("i", "j", "g").applyInArrow(added, schema)
    return sums.groupBy("i", "j").applyInArrow(added, schema).mapInArrow(listed, "x string, y string, r double, n long")


_MOMENTS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("g", pa.int32()), ("m", pa.binary())])
_PAIRS = pa.schema([("x", pa.string()), ("y", pa.string()), ("r", pa.float64()), ("n", pa.int64())])


def grouped_correlation(df: DataFrame, group: str, x: str, columns: Sequence[str]) -> DataFrame:
    """ST6: per group, ``(group, x, y, r, n)`` for ``x`` with each of ``columns``."""
    entries = []
    for c in columns:
        r, n = _pair_stats(F.col(f"`{x}`").cast("double"), F.col(f"`{c}`").cast("double"))
        entries.append(F.struct(F.lit(c).alias("y"), r.alias("r"), n.cast("long").alias("n")))
    return df.groupBy(group).agg(F.array(*entries).alias("e")).select(
        group, F.lit(x).alias("x"), F.explode("e").alias("e")).select(group, "x", "e.y", "e.r", "e.n")


def _betacf(a: np.ndarray, b: np.ndarray, x: np.ndarray, iters: int = 300) -> np.ndarray:
    """Continued fraction of the incomplete beta (modified Lentz), vectorised."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < tiny, tiny, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        delta = d * c
        h *= delta
        if np.all(np.abs(delta - 1.0) < 1e-15):
            return h
    raise ArithmeticError(f"the incomplete beta function did not converge in {iters} steps")


def betainc(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta ``I_x(a, b)`` for arrays."""
    a, b, x = (np.asarray(v, dtype=np.float64) for v in (a, b, x))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0)
    out[ok & (x <= 0)] = 0.0
    out[ok & (x >= 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if mid.any():
        am, bm, xm = a[mid], b[mid], x[mid]
        lg = np.vectorize(math.lgamma)
        front = np.exp(lg(am + bm) - lg(am) - lg(bm) + am * np.log(xm) + bm * np.log1p(-xm))
        direct = xm < (am + 1.0) / (am + bm + 2.0)
        res = np.empty_like(xm)
        res[direct] = front[direct] * _betacf(am[direct], bm[direct], xm[direct]) / am[direct]
        flip = ~direct
        res[flip] = 1.0 - front[flip] * _betacf(bm[flip], am[flip], 1.0 - xm[flip]) / bm[flip]
        out[mid] = res
    return out


def pearson_pvalue_np(r: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Two-sided p of Pearson r with n pairs: ``I_{1-r^2}((n-2)/2, 1/2)``."""
    r = np.asarray(r, dtype=np.float64)
    n = np.asarray(n, dtype=np.float64)
    nu = n - 2.0
    p = np.full(r.shape, np.nan)
    ok = np.isfinite(r) & (nu > 0)
    rr = np.clip(r[ok], -1.0, 1.0)
    p_ok = betainc(nu[ok] / 2.0, np.full(rr.shape, 0.5), 1.0 - rr * rr)
    p_ok[np.abs(rr) >= 1.0] = 0.0
    p[ok] = p_ok
    return p


@F.pandas_udf(T.DoubleType())
def pearson_pvalue(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series(pearson_pvalue_np(r.to_numpy(dtype=np.float64, na_value=np.nan),
                                       n.to_numpy(dtype=np.float64, na_value=np.nan)))


def stars(p: Column, divisor: Column | float = 1.0) -> Column:
    """ST3/ST4: one star per threshold met, thresholds divided by ``divisor``."""
    d = divisor if isinstance(divisor, Column) else F.lit(float(divisor))
    count = sum((F.when(p <= F.lit(t) / d, 1).otherwise(0) for t in STAR_THRESHOLDS), F.lit(0))
    return F.repeat(F.lit("*"), count)


def significance(matrix: DataFrame, bonferroni: bool = False, k: int | None = None) -> DataFrame:
    """ST2-ST5: adds ``p``, ``stars`` and the display cell ``round(r, 2) || stars``.

    The diagonal keeps r = 1 with p = 0 (three stars), as the reference
    shows it.  With ``bonferroni`` the thresholds are divided by
    ``k^2 - k`` with k the number of columns of the matrix (counted with a
    small job when not given).
    """
    if bonferroni and k is None:
        k = matrix.select("x").distinct().count()
    divisor = float(k * k - k) if bonferroni and k and k > 1 else 1.0
    p = F.when(F.col("x") == F.col("y"), F.lit(0.0)).otherwise(pearson_pvalue(F.col("r"), F.col("n")))
    out = matrix.withColumn("p", p)
    return out.withColumn("stars", F.when(F.col("p").isNotNull(), stars(F.col("p"), divisor)).otherwise(F.lit(""))) \
        .withColumn("cell", F.concat(F.round(F.col("r"), 2).cast("string"), F.col("stars")))
