"""Axis fits and decay fits.

Plain least squares is an aggregate. What depends on the data step by step (pruning, consensus, a nonlinear fit) runs on one
axis or curve at a time, a few dozen points, through grouped Arrow batches.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import deal

# Inlier and duplicate distances in pixels, the ratio that makes a log axis likely, pruning, decades.
INLIER, DUPLICATE, LOG_RATIO = 15.0, 5.0, 10.0
PRUNE_TIMES, PRUNE_LEAST, MIN_N, DECADES, LOG_BETTER = 4.0, 8.0, 3, 2.0, 1.2
# Fixed value: triples of points that a task counts inliers for, some 600 bytes each.
TRIPLES = 400_000


def ols(rows: DataFrame, by: list[str], y: str, x: str) -> DataFrame:
    """``by + (slope, intercept, r2, n)`` of y over x; a flat x gives NULL."""
    return rows.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


def line(x: np.ndarray, y: np.ndarray) -> tuple[float, float] | None:
    """Least-squares slope and intercept; None for fewer than two places."""
    if len(x) < 2 or np.ptp(x) == 0:
        return None
    slope = float(((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum())
    return slope, float(y.mean() - slope * x.mean())


def pruned_line(values: np.ndarray, pixels: np.ndarray, min_n: int = MIN_N) -> tuple[float, float, np.ndarray] | None:
    """Least squares without the worst point, again and again, while it is over 4 medians and 8 pixels off."""
    keep = np.arange(len(values))
    while len(keep) >= min_n:
        fit = line(values[keep], pixels[keep])
        if fit is None:
            return None
        off = np.abs(fit[0] * values[keep] + fit[1] - pixels[keep])
        worst = int(off.argmax())
        if len(keep) <= min_n or off[worst] <= max(PRUNE_TIMES * np.median(off), PRUNE_LEAST):
            return (*fit, keep)
        keep = np.delete(keep, worst)
    return None


def consensus(values: np.ndarray, pixels: np.ndarray) -> np.ndarray:
    """The first largest set of points within ``INLIER`` pixels of a line through any three (two if there are two).

    Exhaustive over one axis' labels, of which there are some twenty at most.
    """
    best = np.empty(0, np.int64)
    for own in combinations(range(len(values)), 3 if len(values) >= 3 else 2):
        fit = line(values[list(own)], pixels[list(own)])
        if fit is None:
            continue
        near = np.nonzero(np.abs(fit[0] * values + fit[1] - pixels) <= INLIER)[0]
        if len(near) > len(best):
            best = near
    return best


def roundness(v: float) -> float:
    """How far a value is from a power of ten (from a whole number, if not positive)."""
    e = np.log10(v) if v > 0 else v
    return float(abs(e - round(e)))


def near_twins(values: np.ndarray, pixels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels by pixel; of two within ``DUPLICATE`` pixels of the last kept, the rounder value stays."""
    kept: list[tuple[float, float]] = []
    for p, v in sorted(zip(pixels.tolist(), values.tolist())):
        if kept and p - kept[-1][0] <= DUPLICATE:
            if roundness(v) < roundness(kept[-1][1]):
                kept[-1] = (p, v)
        else:
            kept.append((p, v))
    return np.array([v for _, v in kept]), np.array([p for p, _ in kept])


def axis(values: np.ndarray, pixels: np.ndarray, min_n: int = 2) -> dict | None:
    """Calibration of an axis: consensus on a linear and (all positive) a log scale; log if more agree, or as many from
    ``min_n`` and the values span a factor of ``LOG_RATIO``; then least squares on those that agree."""
    v, p = near_twins(values, pixels)
    if len(v) < min_n:
        return None
    linear = consensus(v, p)
    log = consensus(np.log10(v), p) if (v > 0).all() else np.empty(0, np.int64)
    ratio = v.max() / v.min() if (v > 0).all() else 0.0
    is_log = len(log) > len(linear) or (len(log) == len(linear) and len(log) >= min_n and ratio >= LOG_RATIO)
    own = log if is_log else linear
    fit = line(np.log10(v[own]) if is_log else v[own], p[own]) if len(own) >= min_n else None
    return None if fit is None or fit[0] == 0 else {"slope": fit[0], "intercept": fit[1], "log": is_log, "inliers": len(own)}


def auto_axis(values: np.ndarray, pixels: np.ndarray) -> dict | None:
    """Pruned fits on both scales; log from two decades on if its residual is within 1.2 of the linear one's, else linear,
    else log."""
    lin = pruned_line(values, pixels)
    log = pruned_line(np.log10(values), pixels) if len(values) and (values > 0).all() else None

    def residual(fit, v):
        return float(np.abs(fit[0] * v[fit[2]] + fit[1] - pixels[fit[2]]).mean() / max(np.ptp(pixels[fit[2]]), 1e-9)) if fit else np.inf

    wide = log is not None and np.log10(values.max() / values.min()) >= DECADES
    if wide and residual(log, np.log10(values)) <= LOG_BETTER * residual(lin, values):
        chosen, is_log = log, True
    else:
        chosen, is_log = (lin, False) if lin else (log, True)
    return None if chosen is None else {"slope": chosen[0], "intercept": chosen[1], "log": is_log, "inliers": len(chosen[2])}


def fit_axes(ticks: DataFrame, by: list[str], value: str = "value", pixel: str = "pixel", how=axis) -> DataFrame:
    """``by + (slope, intercept, log, inliers)``: a fit for each group of ticks that has one. Groups are axes, so small."""

    @F.pandas_udf("slope double, intercept double, log boolean, inliers int")
    def one(values: pd.Series, pixels: pd.Series) -> pd.DataFrame:
        fits = [how(np.array(v, float), np.array(p, float)) or {} for v, p in zip(values, pixels)]
        return pd.DataFrame({c: pd.Series([f.get(c) for f in fits], dtype=t) for c, t in (("slope", "float64"), ("intercept", "float64"), ("log", "boolean"), ("inliers", "Int32"))})

    return _arrays(ticks, by, value, pixel).select(*by, one("a", "b").alias("f")).where("f.slope IS NOT NULL").select(*by, "f.*")


def _arrays(rows: DataFrame, by: list[str], first: str, second: str) -> DataFrame:
    """A row for each group with its pairs as two arrays in order, so that one Arrow batch carries many groups."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(first).cast("double").alias("a"), F.col(second).cast("double").alias("b"))))
    g = rows.where(F.col(first).isNotNull() & F.col(second).isNotNull()).groupBy(*by).agg(pairs.alias("p"))
    return g.select(*by, F.col("p.a").alias("a"), F.col("p.b").alias("b"))


def dual_side(fits: DataFrame, by: list[str]) -> DataFrame:
    """Of fits to the default (side 0) and the opposite side (1) the one with more inliers; ties to the default."""
    from .review import latest

    return latest(fits, by, [F.desc("inliers"), F.asc("side")])


def calibration(x: DataFrame, y: DataFrame, by: list[str]) -> DataFrame:
    """Both axes of a figure, where both have a fit."""
    a, b = (d.select(*by, *[F.col(c).alias(f"{k}_{c}") for c in ("slope", "intercept", "log")]) for k, d in (("x", x), ("y", y)))
    return a.join(b, by)


def dealt(points: DataFrame, by: list[str], triples: int = TRIPLES) -> DataFrame:
    """Whole groups of points in so many partitions that a task has about ``triples`` triples, however many groups there are."""
    n = F.col("n").cast("double")
    total = points.groupBy(*by).agg(F.count("*").alias("n")).agg(F.sum(n * (n - 1) * (n - 2) / 6)).first()[0] or 0.0
    return points.repartition(deal.partitions(points.sparkSession, total, triples), *by)


def ransac_sql(points: DataFrame, by: list[str], triples: int = TRIPLES) -> DataFrame:
    """Consensus without Python, for groups of a few points ``(i, x, y)``: all triples by a self-join, closed-form lines, inliers
    counted, the first largest set wins: ``by + (i1, i2, i3, inliers)``. A group's triples are counted in one task."""
    points = dealt(points, by, triples)
    p1, p2, p3 = (points.select(*by, F.col("i").alias(f"i{k}"), F.col("x").alias(f"x{k}"), F.col("y").alias(f"y{k}")) for k in (1, 2, 3))
    t = p1.join(p2, by).where("i1 < i2").join(p3, by).where("i2 < i3")
    mx, my = (F.col("x1") + F.col("x2") + F.col("x3")) / 3, (F.col("y1") + F.col("y2") + F.col("y3")) / 3
    t = t.withColumns({"mx": mx, "my": my})
    sxx = sum(((F.col(f"x{k}") - F.col("mx")) * (F.col(f"x{k}") - F.col("mx")) for k in (2, 3)), (F.col("x1") - F.col("mx")) * (F.col("x1") - F.col("mx")))
    sxy = sum(((F.col(f"x{k}") - F.col("mx")) * (F.col(f"y{k}") - F.col("my")) for k in (2, 3)), (F.col("x1") - F.col("mx")) * (F.col("y1") - F.col("my")))
    t = t.withColumn("s", F.try_divide(sxy, F.when(sxx > 0, sxx))).where("s IS NOT NULL")
    near = t.join(points.select(*by, "x", "y"), by).groupBy(*by, "i1", "i2", "i3").agg(F.count_if(F.abs(F.col("my") + F.col("s") * (F.col("x") - F.col("mx")) - F.col("y")) <= INLIER).alias("inliers"))
    from .review import latest

    return latest(near, by, [F.desc("inliers"), F.asc("i1"), F.asc("i2"), F.asc("i3")])


def foster(t: np.ndarray, z: np.ndarray, r_fixed: float | None = None) -> dict | None:
    """R (1 - exp(-t / tau)) by least squares: for a given tau R is in closed form, so log tau alone is searched, on a
    grid that narrows around the best place. From six points with t > 0 and z >= 0."""
    ok = np.isfinite(t) & np.isfinite(z) & (t > 0) & (z >= 0)
    t, z = t[ok], z[ok]
    if len(t) < 6:
        return None

    low, high = np.log(t.min()) - 7, np.log(t.max()) + 7
    for _ in range(5):
        grid = np.linspace(low, high, 120)
        e = 1 - np.exp(-t[None, :] / np.exp(grid)[:, None])
        r = np.full(len(grid), r_fixed) if r_fixed is not None else np.maximum(0.0, (e @ z) / np.maximum((e * e).sum(axis=1), 1e-300))
        cost = ((z[None, :] - r[:, None] * e) ** 2).sum(axis=1)
        at = int(np.argmin(cost))
        low, high = grid[max(0, at - 1)], grid[min(len(grid) - 1, at + 1)]
    res, r, tau = float(cost[at]), float(r[at]), float(np.exp(grid[at]))
    total = float(((z - z.mean()) ** 2).sum())
    return {"r": r, "tau": tau, "r_squared": 1.0 if total <= 1e-12 else 1 - res / total}


def fit_foster(points: DataFrame, by: list[str], t: str = "t", z: str = "z") -> DataFrame:
    """``by + (r, tau, r_squared, n)`` for every curve that can be fitted; a curve's points are few."""

    @F.pandas_udf("r double, tau double, r_squared double")
    def one(ts: pd.Series, zs: pd.Series) -> pd.DataFrame:
        fits = [foster(np.array(a, float), np.array(b, float)) or {} for a, b in zip(ts, zs)]
        return pd.DataFrame({c: pd.Series([f.get(c) for f in fits], dtype="float64") for c in ("r", "tau", "r_squared")})

    return _arrays(points, by, t, z).select(*by, one("a", "b").alias("f"), F.size("a").alias("n")).where("f.r IS NOT NULL").select(*by, "f.*", "n")


# The gates of a thermal curve.
MIN_POINTS, RISE, LATE, SCALE, R2 = 6, (1.0, 1e6), 100.0, (0.05, 3.0), 0.5


def thermal_gate(n: Column, left: Column, right: Column, r_known: Column, r_fit: Column, r2: Column) -> Column:
    """Why a thermal curve isn't believed, NULL if it is: points, rise from its first to its last fifth, level, scale to a known
    resistance, fit."""
    rise, scale = F.try_divide(right, left), F.try_divide(r_fit, r_known)
    return F.coalesce(
        F.when(n < MIN_POINTS, "too few points"), F.when(~F.coalesce(rise.between(*RISE), F.lit(False)), "implausible rise"), F.when(r_known.isNull() & (right > LATE), "implausible level"),
        F.when(r_known.isNotNull() & ~F.coalesce(scale.between(*SCALE), F.lit(False)), "scale differs from the printed resistance"), F.when(F.coalesce(r2, F.lit(0.0)) < R2, "poor fit"),
    )


def pair_rows(r_rows: list[tuple[float, float]], tau_rows: list[tuple[float, float]], reach: float = 35.0) -> list[tuple[float, float]]:
    """(value, y) of a table's two columns paired: each resistance from the top takes the nearest time not taken yet."""
    left, out = list(tau_rows), []
    for r, y in sorted(r_rows, key=lambda x: x[1]):
        near = min(left, key=lambda x: abs(x[1] - y), default=None)
        if near is not None and abs(near[1] - y) <= reach:
            left.remove(near)
            if 1e-6 <= r <= 1e3 and 1e-9 <= near[0] <= 1e3:
                out.append((r, near[0]))
    return out if len(out) >= 2 else []


def printed_pairs(rows: DataFrame, by: list[str]) -> DataFrame:
    """``by + pairs array<struct(r, tau)>`` from ``(column in r/tau, value, y)`` rows of one printed table for each group."""
    own = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in by)

    def one(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        cols = [list(df.loc[df["column"] == k, ["value", "y"]].itertuples(index=False, name=None)) for k in ("r", "tau")]
        return pd.DataFrame([(*key, [{"r": a, "tau": b} for a, b in pair_rows(*cols)])], columns=[*by, "pairs"])

    return rows.groupBy(*by).applyInPandas(one, f"{own}, pairs array<struct<r:double,tau:double>>")
