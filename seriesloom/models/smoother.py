"""Smooth daily curves: Gaussian process regression for many series.

Constant mean, squared-exponential correlation, a nugget, and the length scale
by maximum likelihood: a coarse grid, then a search around each of its peaks. The
correlation over a group's span is a form in Chebyshev polynomials, exact to
rounding, whose basis does not depend on the length scale. Products of two
polynomials are again such polynomials, so their sums over parts of a group,
taken once, give the normal equations of every length scale, and no matrix
grows with a group's rows. Polynomials needed: about six times the span in
standard deviations times the root of the largest theta, and 20 more. A group of
few fitted rows is solved from its rows instead, all groups of equal size at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Length scales looked at first, evenly spaced in the logarithm over [0.001, 100].
THETAS = [float(t) for t in np.logspace(-3, 2, 11)]
# Correlations below exp(-REACH) are rounding; the search ends at this ratio of two thetas.
REACH, CLOSE = 36.0, 1.0005
# Fitted rows up to which a group is solved from its rows, and numbers of all correlations held at once.
FEW, HELD = 48, 4_000_000


def degree(theta: float, half: float) -> int:
    """Polynomials that carry the correlation on a span of twice ``half`` standard deviations."""
    return int(np.ceil(2 * np.sqrt(REACH * theta) * half)) + 20


def factor(theta: float, half: float) -> np.ndarray:
    """F (polynomials x rank) with T F F' T' = correlations, for polynomials T over the span."""
    m = degree(theta, half)
    at = np.pi * (np.arange(m) + 0.5) / m
    z, waves = np.cos(at), np.cos(np.outer(np.arange(m), at)) * (2 / m)
    waves[0] /= 2
    form = waves @ np.exp(-theta * half**2 * (z[:, None] - z) ** 2) @ waves.T
    size, axes = np.linalg.eigh((form + form.T) / 2)
    keep = size > size[-1] * 1e-14
    return axes[:, keep] * np.sqrt(size[keep])


class Sums:
    """What the likelihood of any length scale needs to know of a group."""

    def __init__(self, waves: np.ndarray, v_waves: np.ndarray, n: int, v1: float, vv: float, noise: float, half: float):
        self.waves, self.v_waves, self.n, self.v1, self.vv, self.noise, self.half = waves, v_waves, n, v1, vv, noise, half

    def fit(self, theta: float) -> tuple[float, float, np.ndarray]:
        """Likelihood, mean and weights of the polynomials."""
        f = factor(theta, self.half)
        m = len(f)
        i, k = np.indices((m, m))
        gram = f.T @ ((self.waves[i + k] + self.waves[np.abs(i - k)]) / 2) @ f
        root = np.linalg.cholesky(gram + self.noise * np.eye(len(gram)))
        ones, target = np.linalg.solve(root, f.T @ np.column_stack([self.waves[:m], self.v_waves[:m]])).T
        mean = (self.v1 - ones @ target) / (self.n - ones @ ones)
        rest = (self.vv - target @ target - mean * (self.v1 - ones @ target)) / self.noise
        variance = max(rest / self.n, np.finfo(float).tiny)
        log_det = (self.n - len(gram)) * np.log(self.noise) + 2 * np.log(np.diag(root)).sum()
        return -np.log(variance) - log_det / self.n, mean, f @ np.linalg.solve(root.T, target - mean * ones)

    def best(self, thetas: list[float], search: bool) -> float:
        """The likeliest of the given length scales; with ``search``, the top of the best peak among them."""
        like = [self.fit(t)[0] for t in thetas]
        if not search:
            return thetas[int(np.argmax(like))]
        found = []
        for i, value in enumerate(like):
            low, high = max(i - 1, 0), min(i + 1, len(like) - 1)
            if value >= max(like[low : high + 1]):
                found.append(self._peak(np.log(thetas[low]), np.log(thetas[high])))
        return max([*found, *zip(like, thetas)])[1]

    def _peak(self, low: float, high: float) -> tuple[float, float]:
        """Golden section in the logarithm of theta."""
        part = (np.sqrt(5) - 1) / 2
        a, b = high - part * (high - low), low + part * (high - low)
        at_a, at_b = self.fit(np.exp(a))[0], self.fit(np.exp(b))[0]
        while high - low > np.log(CLOSE):
            if at_a >= at_b:
                high, b, at_b = b, a, at_a
                a = high - part * (high - low)
                at_a = self.fit(np.exp(a))[0]
            else:
                low, a, at_a = a, b, at_b
                b = low + part * (high - low)
                at_b = self.fit(np.exp(b))[0]
        return max((at_a, float(np.exp(a))), (at_b, float(np.exp(b))))


class Few:
    """Groups of as many fitted rows each, from the rows: places z and values v are groups x rows."""

    def __init__(self, z: np.ndarray, v: np.ndarray, noise: np.ndarray, half: np.ndarray):
        self.v, self.noise = v, noise
        self.apart = (half[:, None, None] * (z[:, :, None] - z[:, None, :])) ** 2

    def fit(self, theta: np.ndarray, which: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Likelihood, mean and weights of the rows, of some groups by their thetas."""
        v, n = self.v[which], self.v.shape[1]
        corr = np.exp(-theta[:, None, None] * self.apart[which])
        corr[:, np.arange(n), np.arange(n)] += self.noise[which][:, None]
        root = np.linalg.cholesky(corr)
        ones, target = np.moveaxis(np.linalg.solve(root, np.stack([np.ones_like(v), v], axis=2)), 2, 0)
        mean = (ones * target).sum(axis=1) / (ones * ones).sum(axis=1)
        rest = target - mean[:, None] * ones
        variance = np.maximum((rest * rest).sum(axis=1) / n, np.finfo(float).tiny)
        log_det = 2 * np.log(np.diagonal(root, axis1=1, axis2=2)).sum(axis=1)
        weights = np.linalg.solve(root.transpose(0, 2, 1), rest[:, :, None])[:, :, 0]
        return -np.log(variance) - log_det / n, mean, weights

    def best(self, thetas: list[float], search: bool) -> np.ndarray:
        """As ``Sums.best``, for every group."""
        like = np.stack([self.fit(np.full(len(self.v), t))[0] for t in thetas])
        if not search:
            return np.array(thetas)[like.argmax(axis=0)]
        around = np.pad(like, ((1, 1), (0, 0)), constant_values=-np.inf)
        at, which = np.nonzero(like >= np.maximum(around[:-2], around[2:]))
        line = np.log(thetas)
        tops, found = self._peaks(line[np.maximum(at - 1, 0)], line[np.minimum(at + 1, len(line) - 1)], which)
        group = np.concatenate([which, np.tile(np.arange(len(self.v)), len(thetas))])
        every = np.concatenate([found, np.repeat(thetas, len(self.v))])
        order = np.lexsort((every, np.concatenate([tops, like.ravel()]), group))
        return every[order[np.append(np.diff(group[order]) > 0, True)]]

    def _peaks(self, low: np.ndarray, high: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Golden sections in the logarithm of theta, side by side."""
        part = (np.sqrt(5) - 1) / 2
        a, b = high - part * (high - low), low + part * (high - low)
        at_a, at_b = self.fit(np.exp(a), which)[0], self.fit(np.exp(b), which)[0]
        while len(on := np.flatnonzero(high - low > np.log(CLOSE))):
            left = at_a[on] >= at_b[on]
            down, up = on[left], on[~left]
            high[down], b[down], at_b[down] = b[down], a[down], at_a[down]
            low[up], a[up], at_a[up] = a[up], b[up], at_b[up]
            a[down] = high[down] - part * (high[down] - low[down])
            b[up] = low[up] + part * (high[up] - low[up])
            fresh = self.fit(np.exp(np.where(left, a[on], b[on])), which[on])[0]
            at_a[down], at_b[up] = fresh[left], fresh[~left]
        top = np.where(at_a > at_b, a, b)
        top = np.where(at_a == at_b, np.maximum(a, b), top)
        return np.maximum(at_a, at_b), np.exp(top)


def solve_few(z: list[np.ndarray], v: list[np.ndarray], noise: np.ndarray, half: np.ndarray, thetas: list[float], search: bool) -> list[tuple]:
    """(theta, mean, weights) of each group, from the places and values of its rows."""
    size, out = np.array([len(own) for own in v]), [()] * len(v)
    for n in np.unique(size):
        equal = np.flatnonzero(size == n)
        step = max(1, HELD // int(n * n * len(thetas)))
        for first in range(0, len(equal), step):
            some = equal[first : first + step]
            groups = Few(np.stack([z[i] for i in some]), np.stack([v[i] for i in some]), noise[some], half[some])
            theta = groups.best(thetas, search)
            _, mean, weights = groups.fit(theta)
            for i, *fit in zip(some, theta, mean, weights):
                out[i] = tuple(fit)
    return out


def _per_group(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the columns of its group's one row; null keys are groups, too."""
    named = groups.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.join(named, same, "left").drop(*[f"__{k}" for k in keys])


def smooth(
    df: DataFrame,
    keys: list[str],
    x: str,
    y: str,
    nugget: str,
    thetas: list[float] | None = None,
    chunk: int = 16_384,
    few: int = FEW,
) -> DataFrame:
    """``keys, x, y_hat, theta`` for every row; rows whose ``y`` is NULL are
    predicted, the others are fitted too.

    ``nugget`` is positive and the same in all rows of a group. ``thetas`` are the
    only length scales then; without them the likeliest in [0.001, 100] is searched for.
    Groups are summed in parts of about ``chunk`` rows, so one may hold any number of them;
    those of at most ``few`` fitted rows are solved from the rows, many in one call.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    key_schema = ", ".join(f"`{k}` {types[k]}" for k in keys)
    grid = thetas or THETAS
    rows = df.select(*keys, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
                     F.col(nugget).cast("double").alias("nugget"))
    rows = rows.withColumn("y", F.when(F.col("x").isNotNull(), F.col("y")))
    seen = F.when(F.col("y").isNotNull(), F.col("x"))

    def spread(values):
        return F.when(F.stddev_pop(values) > 0, F.stddev_pop(values)).otherwise(1.0)

    extent = rows.groupBy(*keys).agg(
        F.avg(seen).alias("x0"), spread(seen).alias("dx"), F.avg("y").alias("y0"), spread("y").alias("dy"),
        F.min("x").alias("low"), F.max("x").alias("high"), F.count("y").alias("n"),
    )
    placed = _per_group(rows, extent, keys).withColumns(
        {
            "z": F.try_divide(2 * F.col("x") - F.col("low") - F.col("high"), F.col("high") - F.col("low")),
            "v": (F.col("y") - F.col("y0")) / F.col("dy"),
            "half": (F.col("high") - F.col("low")) / F.col("dx") / 2,
            "part": F.expr(f"pmod(xxhash64(x, y), greatest(1, ceil(n / {chunk})))"),
        }
    ).withColumn("z", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce("z", F.lit(0.0))))).withColumn("angle", F.acos("z"))
    most = max(grid)

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of one part: sums of all polynomials up to twice the highest, and times v up to it."""
        angle, v, half = pdf["angle"].to_numpy(), pdf["v"].to_numpy(), pdf["half"].iloc[0]
        m = degree(most, half)
        waves, v_waves = np.zeros(2 * m), np.zeros(m)
        for at in range(0, len(v), 2048):
            wave = np.cos(np.outer(np.arange(2 * m), angle[at : at + 2048]))
            waves += wave.sum(axis=1)
            v_waves += wave[:m] @ v[at : at + 2048]
        return pdf[[*keys, "half", "nugget"]].iloc[:1].assign(n=len(v), v1=v.sum(), vv=v @ v, sums=[np.concatenate([waves, v_waves])])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        """Length scale, mean and weights of the polynomials, for one group."""
        waves, v_waves = np.split(np.sum(np.stack(pdf["sums"]), axis=0), [2 * degree(most, pdf["half"].iloc[0])])
        group = Sums(waves, v_waves, pdf["n"].sum(), pdf["v1"].sum(), pdf["vv"].sum(), pdf["nugget"].iloc[0], pdf["half"].iloc[0])
        theta = group.best(grid, thetas is None)
        _, mean, coefs = group.fit(theta)
        return pdf[keys].iloc[:1].assign(theta=theta, mean=mean, coefs=[coefs], places=None)

    def solve_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The same for many groups of few rows: weights of the rows, and their places."""
        for b in batches:
            own = dict(zip(b.schema.names, b.columns))
            z, v = ([np.array(o) for o in own[c].to_pylist()] for c in ("z", "v"))
            found = solve_few(z, v, own["nugget"].to_numpy(), own["half"].to_numpy(), grid, thetas is None)
            theta, mean, weights = zip(*found) if found else ((), (), ())
            fit = [pa.array(theta, pa.float64()), pa.array(mean, pa.float64()), pa.array(list(weights), pa.list_(pa.float64())), own["z"]]
            yield pa.RecordBatch.from_arrays([*(own[k] for k in keys), *fit], names=[*keys, "theta", "mean", "coefs", "places"])

    schema = f"{key_schema}, theta double, mean double, coefs array<double>, places array<double>"
    known = placed.where(F.col("v").isNotNull())
    rows_of = F.sort_array(F.collect_list(F.struct("z", "v")))
    small = known.where(F.col("n") <= few).groupBy(*keys).agg(rows_of.alias("rows"), F.first("half").alias("half"), F.first("nugget").alias("nugget"))
    small = small.select(*keys, "half", "nugget", F.col("rows.z").alias("z"), F.col("rows.v").alias("v"))
    parts = known.where(F.col("n") > few).groupBy(*keys, "part").applyInPandas(
        sums, f"{key_schema}, half double, nugget double, n long, v1 double, vv double, sums array<double>"
    )
    # A row a part: some hundred sums for every ``chunk`` rows of the group.
    best = parts.groupBy(*keys).applyInPandas(solve, schema).unionByName(small.mapInArrow(solve_all, schema))
    fitted = _per_group(placed, best.select(*keys, F.struct("theta", "mean", "coefs", "places").alias("fit")), keys)
    waves = F.transform(F.col("fit.coefs"), lambda c, j: c * F.cos(j * F.col("angle")))
    scale = F.col("fit.theta") * F.col("half") * F.col("half")
    near = F.zip_with("fit.coefs", "fit.places", lambda c, z: c * F.exp(-scale * (F.col("z") - z) * (F.col("z") - z)))
    terms = F.when(F.col("fit.places").isNull(), waves).otherwise(near)
    curve = F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)
    level = F.col("y0") + F.col("dy") * (F.col("fit.mean") + curve)
    return fitted.select(*keys, "x", F.when(F.col("fit").isNotNull(), level).alias("y_hat"), F.col("fit.theta").alias("theta"))
