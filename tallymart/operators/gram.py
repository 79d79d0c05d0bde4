"""Many linear models of one table from one scan: the co-moments of all columns, then a sweep for each model.

The scan keeps means and central co-moments, which Spark merges, for each pattern of missing values: as many rows as
the table has patterns, so every model can use the rows that are complete in its own columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# a predictor whose variance, given the earlier ones, is below this share of its own adds nothing
TOLERANCE = 1e-10


@dataclass(frozen=True)
class LinearFit:
    """Least squares of ``y`` on ``predictors`` with an intercept. A predictor that the earlier ones determine has
    coefficient 0 and no standard error; without rows all values are NaN."""

    y: str
    predictors: tuple[str, ...]
    n: int
    intercept: float
    coefficients: np.ndarray
    se: np.ndarray  # of the coefficients, then of the intercept; NaN if not defined
    r2: float
    r2_adj: float
    df: int


@dataclass(frozen=True)
class Gram:
    """Number of rows, means and mean products of deviations of ``columns``."""

    columns: tuple[str, ...]
    n: int
    mean: np.ndarray
    products: np.ndarray

    def part(self, columns: list[str]) -> Gram:
        at = [self.columns.index(c) for c in columns]
        return Gram(tuple(columns), self.n, self.mean[at], self.products[np.ix_(at, at)])

    def plus(self, other: Gram) -> Gram:
        n = self.n + other.n
        if not self.n or not other.n:
            return other if other.n else self
        share, off = other.n / n, other.mean - self.mean
        products = (1 - share) * self.products + share * other.products + share * (1 - share) * np.outer(off, off)
        return Gram(self.columns, n, self.mean + share * off, products)

    def fit(self, y: str, predictors: list[str]) -> LinearFit:
        own = self.part([y, *predictors])
        p = len(predictors)
        if not own.n:
            none = np.full(p, np.nan)
            return LinearFit(y, tuple(predictors), 0, np.nan, none, np.full(p + 1, np.nan), np.nan, np.nan, -p - 1)
        swept, used = swept_on(own.products, range(1, p + 1))
        weights = np.where(used[1:], swept[1:, 0], 0.0)
        inverse = np.where(np.outer(used[1:], used[1:]), swept[1:, 1:], 0.0) / own.n
        df = own.n - 1 - int(used.sum())
        total, rest = own.products[0, 0], max(swept[0, 0], 0.0)
        s2 = rest * own.n / df if df > 0 else np.nan
        centre = own.mean[1:]
        spread = np.append(np.where(used[1:], np.diag(inverse), np.nan), 1 / own.n + centre @ inverse @ centre)
        r2 = 1 - rest / total if total > 0 else np.nan
        r2_adj = 1 - (1 - r2) * (own.n - 1) / df if df > 0 else np.nan
        intercept = float(own.mean[0] - weights @ centre)
        return LinearFit(y, tuple(predictors), own.n, intercept, weights, np.sqrt(s2 * spread), r2, r2_adj, df)

    def mean_squared_error(self, fit: LinearFit) -> float | None:
        """Of a model, which may come from another table, over the rows behind these moments; None without rows."""
        if not self.n or not np.isfinite(fit.intercept):
            return None
        own = self.part([fit.y, *fit.predictors])
        weights = np.append(1.0, -fit.coefficients)
        bias = own.mean @ weights - fit.intercept
        return float(max(weights @ own.products @ weights, 0.0) + bias * bias)


def swept_on(products: np.ndarray, pivots: range) -> tuple[np.ndarray, np.ndarray]:
    """``products`` swept on ``pivots`` in turn, and which of them were. Columns are first brought to length 1."""
    length = np.sqrt(np.diag(products))
    length = np.where(length > 0, length, 1.0)
    a = products / np.outer(length, length)
    used = np.zeros(len(a), bool)
    for k in pivots:
        d = a[k, k]
        if not d > TOLERANCE:
            continue
        row, column = a[k] / d, a[:, k].copy()
        a = a - np.outer(column, row)
        a[k], a[:, k], a[k, k] = row, -column / d, 1 / d
        used[k] = True
    # back to the columns' own lengths: a pivot's row and column carry its inverse
    left = np.where(used, 1 / length, length)
    return a * np.outer(left, left), used


@dataclass(frozen=True)
class Grams:
    columns: tuple[str, ...]
    parts: dict[str, Gram]

    def of(self, columns: list[str]) -> Gram:
        """Over the rows that have a value in each of ``columns``."""
        at = [self.columns.index(c) for c in columns]
        total = Gram(tuple(columns), 0, np.zeros(len(at)), np.zeros((len(at), len(at))))
        for pattern, gram in sorted(self.parts.items()):
            if all(pattern[i] == "1" for i in at):
                total = total.plus(gram.part(columns))
        return total


def grams(df: DataFrame, columns: list[str]) -> Grams:
    """The moments of all columns in one scan of ``df``."""
    values = [F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)]
    rows = df.select(*values)
    names = rows.columns
    pattern = F.concat(*(F.when(F.col(c).isNull(), "0").otherwise("1") for c in names))
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    found = rows.groupBy(pattern.alias("pattern")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*(F.avg(c) for c in names)).alias("mean"),
        F.array(*(F.covar_pop(names[i], names[j]) for i, j in pairs)).alias("products"),
    )
    parts = {}
    for row in found.collect():  # one row for each pattern of missing values
        products = np.zeros((len(names), len(names)))
        for (i, j), value in zip(pairs, row.products):
            products[i, j] = products[j, i] = np.nan if value is None else value
        mean = np.array([np.nan if m is None else m for m in row.mean])
        parts[row.pattern] = Gram(tuple(columns), row.n, mean, products)
    return Grams(tuple(columns), parts)
