"""SVM with the radial kernel exp(-gamma |x - y|^2), by random Fourier features.

Spark ML's SVM is linear.  ``n`` random directions w ~ N(0, 2 gamma) and phases
b ~ U(0, 2 pi) give each row the features sqrt(2 / n) cos(w x + b); their inner
product has the kernel as its mean.  A product lies in [-2, 2], so for two
given rows it is off by e or more with a probability of at most
2 exp(-n e^2 / 8): at n = 1,000, by 0.2 with 1.4 %.  The linear SVC on these
features is then a kernel SVM whose fit is a distributed aggregation, linear in
the rows; the kernel matrix (rows x rows) is never formed, nor are the features
of all rows: Spark ML's own fit would keep n numbers a row in memory or on disk,
so each pass of the fit here projects the rows anew, some thousand at a time.
The objective is that of ``LinearSVC``: mean hinge loss and an L2 penalty on
the coefficients of standardised features, by L-BFGS.

The directions follow from ``seed`` alone (n x columns numbers, a parameter),
and the projection is a row-wise expression: no shuffle, equal under any
partitioning.  Nulls and NaN take their column's mean; a column without spread
or without values is 0 everywhere.  Rows without a label are left out of a fit;
a fit needs rows of both classes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinreach.session import cut_lineage

CHUNK = 1024  # rows projected at once
MEMORY = 10  # steps that L-BFGS remembers


def directions(columns: int, n: int, gamma: float, seed: int) -> np.ndarray:
    """n rows of ``columns`` weights and a phase."""
    rng = np.random.default_rng(seed)
    return np.column_stack([rng.normal(0, np.sqrt(2 * gamma), (n, columns)), rng.uniform(0, 2 * np.pi, n)])


def fourier_features(values: list[Column], weights: np.ndarray) -> Column:
    """The features of a row as ``array<double>``."""
    x = F.array(*values, F.lit(1.0))
    scale = float(np.sqrt(2 / len(weights)))
    return F.transform(F.lit(weights.tolist()), lambda w: F.lit(scale) * F.cos(
        F.aggregate(F.zip_with(w, x, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)))


def project(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``fourier_features`` of rows of numbers, in single precision."""
    turn = (x @ weights[:, :-1].T + weights[:, -1]).astype(np.float32)
    return np.cos(turn, out=turn) * np.float32(np.sqrt(2 / len(weights)))


@dataclass
class KernelSvm:
    columns: list[str]
    means: list[float]
    spreads: list[float]
    weights: np.ndarray
    coefficients: np.ndarray  # of the features
    intercept: float

    def vector(self) -> Column:
        return array_to_vector(fourier_features(_values(self.columns, self.means, self.spreads), self.weights))

    def margin(self) -> Column:
        """Signed distance, in units of the margin."""
        weights, coefficients, intercept = self.weights, self.coefficients.astype(np.float32), self.intercept

        @F.pandas_udf("double")
        def margin(x: pd.DataFrame) -> pd.Series:
            rows = x.to_numpy(float)
            return pd.Series(np.concatenate(
                [np.zeros(0), *(project(rows[a:a + CHUNK], weights) @ coefficients + intercept
                                for a in range(0, len(rows), CHUNK))]))

        return margin(F.struct(*[v.alias(f"x{i}") for i, v in enumerate(
            _values(self.columns, self.means, self.spreads))]))

    def score(self, df: DataFrame, keep=None) -> DataFrame:
        """``keep`` columns (default: all) and ``prediction`` as int."""
        cols = list(keep) if keep is not None else df.columns
        return df.select(*cols, (self.margin() > 0).cast("int").alias("prediction"))


def _values(columns, means, spreads) -> list[Column]:
    values = []
    for c, mean, spread in zip(columns, means, spreads):
        x = F.col(c).cast("double")
        x = F.when(x.isNull() | F.isnan(x), F.lit(mean)).otherwise(x)
        values.append((x - F.lit(mean)) * F.lit(1 / spread if spread else 0.0))
    return values


def _summed(rows: DataFrame, weights: np.ndarray, part) -> np.ndarray:
    """Sum of ``part(features, label, times)`` over all rows; a task sends one sum."""

    def run(batches):
        total = None
        for batch in batches:
            *x, y, times = (batch.column(i).to_numpy() for i in range(batch.num_columns))
            x = np.column_stack(x)
            for a in range(0, len(y), CHUNK):
                one = part(project(x[a:a + CHUNK], weights), y[a:a + CHUNK], times[a:a + CHUNK])
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    return np.sum([r["sums"] for r in rows.mapInArrow(run, "sums array<double>").collect()], axis=0)


def _spread_sums(z, y, times):
    z = z.astype(float)
    return np.concatenate((times @ z, times @ (z * z)))


def _hinge(coefficients: np.ndarray, intercept: float):
    coefficients = coefficients.astype(np.float32)

    def part(z, y, times):
        sign = 2 * y - 1
        short = 1 - sign * (z @ coefficients + intercept)
        pull = np.where(short > 0, -sign * times, 0.0)
        return np.concatenate(([np.maximum(short, 0) @ times, pull.sum()], pull.astype(np.float32) @ z)).astype(float)

    return part


def minimise(loss, x: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    """L-BFGS with halved steps; ``loss`` gives value and gradient.  Stops when
    five steps together gain less than ``tol`` of the value, and takes
    ``max_iter`` steps and twice as many passes at most."""
    value, grad = loss(x)
    past, values, passes = [], [value], 2 * max_iter
    for _ in range(max_iter):
        way, used = -grad, []
        for s, y in reversed(past):
            a = s @ way / (s @ y)
            used.append(a)
            way = way - a * y
        if past:
            s, y = past[-1]
            way = way * (s @ y / (y @ y))
        for (s, y), a in zip(past, reversed(used)):
            way = way + (a - y @ way / (s @ y)) * s
        slope = grad @ way
        if slope >= 0:
            past, way, slope = [], -grad, -(grad @ grad)
        if slope == 0:
            break
        step = 1.0 if past else min(1.0, 1 / np.sqrt(grad @ grad))
        for _ in range(20):
            if not passes:
                return x
            passes -= 1
            there = x + step * way
            new_value, new_grad = loss(there)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            if not past:
                break
            past = []  # once more, down the gradient
            continue
        s, y = there - x, new_grad - grad
        if s @ y > 1e-10 * np.sqrt((s @ s) * (y @ y)):
            past = [*past, (s, y)][-MEMORY:]
        x, value, grad = there, new_value, new_grad
        values.append(value)
        if len(values) > 5 and values[-6] - value <= tol * abs(value):
            break
    return x


def fit_kernel_svm(train: DataFrame, columns, label: str = "label", gamma: float | None = None,
                   n: int = 200, seed: int = 42, reg: float = 1e-4, max_iter: int = 100,
                   tol: float = 1e-6) -> KernelSvm:
    """Standardise ``columns``, project, fit the linear SVC on the projection.
    ``gamma`` defaults to 1 / number of columns (their variances are 1 then).
    Written is one table of the columns, the label and how often they occur
    together (no more rows than ``train`` has); labels are 0 and 1."""
    columns, rows = list(columns), train.where(F.col(label).isNotNull())
    num = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    mark = F.col(label).cast("double")
    moments = rows.agg(F.count(F.lit(1)).alias("rows"), F.max(mark).alias("top"),
                       F.count(F.when(~mark.isin(0.0, 1.0), 1)).alias("other"),
                       *[f(num[c]).alias(f"{k}{i}") for i, c in enumerate(columns)
                         for k, f in (("m", F.avg), ("s", F.stddev_samp))]).first()  # one row
    if moments["other"] or not moments["top"]:
        raise ValueError("labels are 0 and 1, and rows of both are needed")
    means = [moments[f"m{i}"] or 0.0 for i in range(len(columns))]
    spreads = [moments[f"s{i}"] or 0.0 for i in range(len(columns))]
    weights = directions(len(columns), n, gamma if gamma is not None else 1 / len(columns), seed)
    narrow = rows.select(*[v.alias(f"_ks_{i}") for i, v in enumerate(_values(columns, means, spreads))],
                         mark.alias("_ks_label"))
    data = cut_lineage(narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).cast("double").alias("_ks_n")))
    count = moments["rows"]
    sums = _summed(data, weights, _spread_sums)
    middle = sums[:n] / count
    spread = np.sqrt(np.maximum(sums[n:] / count - middle ** 2, 0.0))
    scale = np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-6), 0.0)  # single precision

    def unscaled(at):
        coefficients = at[:n] * scale
        return coefficients, float(at[n] - coefficients @ middle)

    def loss(at):
        total = _summed(data, weights, _hinge(*unscaled(at)))
        grad = (total[2:] - middle * total[1]) * scale / count + reg * at[:n]
        return total[0] / count + reg / 2 * (at[:n] @ at[:n]), np.append(grad, total[1] / count)

    return KernelSvm(columns, means, spreads, weights, *unscaled(minimise(loss, np.zeros(n + 1), max_iter, tol)))
