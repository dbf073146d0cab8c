"""Holt and Holt-Winters smoothing with given or fitted parameters.

``smooth`` folds a series, one array of its months, over a state of level, trend, seasons
and squared error with the ``aggregate`` higher-order function: it runs in the JVM, no
Python worker takes part, and a scan of a million series is one pass without an exchange
beyond the grouping. Parameters and initial states are columns, so each series may have its
own (``refine`` returns them in that form).

``refine`` fits the parameters. For given alpha, beta and gamma the one-step errors are
linear in the initial states, which are found by least squares; what is left are three
bounded numbers. A coarse grid gives starting points, and a damped Gauss-Newton iteration
inside the bounds goes on from the best of them; it takes only steps that lower the error, so
a fit is never worse than its grid. Series are spread over the tasks and fitted in
batches: each numpy operation works on all series of a batch.

Additive model, of a month with value y (a missing one moves the states on by themselves):
prediction p = level + trend + season, level' = alpha (y - season) + (1 - alpha)(level + trend),
trend' = beta (level' - level) + (1 - beta) trend, season' = gamma (y - level - trend) + (1 - gamma) season.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .forecast import complete_calendar

STARTS = 3  # grid points that the iteration goes on from
STEPS = 40  # iterations at most
BATCH = 512  # series that are fitted together


def pack(series: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys..., y ARRAY<DOUBLE>, t_last, m_last)``: each series' months from its first
    known value to its last, NULL where one is missing."""
    keys = list(keys)
    whole = complete_calendar(series.filter(F.col(value).isNotNull()), keys, [value])
    months = F.array_sort(F.collect_list(F.struct("t", F.col(value).cast("double").alias("y"))))
    return whole.groupBy(*keys).agg(F.transform(months, lambda x: x["y"]).alias("y"), F.max("t").alias("t_last"),
                                    F.max("month").alias("m_last"))


def _mean(a: Column) -> Column:
    known = F.filter(a, lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda s, x: s + x), F.size(known).cast("double"))


def with_start(packed: DataFrame, period: int = 0) -> DataFrame:
    """Add the states before the first month: ``level0``, ``trend0``, ``seasons0``.

    Without seasons: the line through the first two known months. With them: the trend from
    the mean of the first period to that of the second, the level on that line, each season
    what its first month lies above it (0 if that is missing). NULL where a series has
    fewer than two known months, or less than two periods."""
    y = F.col("y")
    if not period:
        known = F.filter(F.transform(y, lambda x, i: F.struct(x.alias("y"), i.alias("i"))), lambda p: p["y"].isNotNull())
        a, b = F.get(known, F.lit(0)), F.get(known, F.lit(1))
        return (packed.withColumn("trend0", (b["y"] - a["y"]) / (b["i"] - a["i"]).cast("double"))
                .withColumn("level0", a["y"] - F.col("trend0")).withColumn("seasons0", F.array().cast("array<double>")))
    first, second = _mean(F.slice(y, 1, period)), _mean(F.slice(y, period + 1, period))
    trend = F.when(F.size(y) >= 2 * period, (second - first) / F.lit(float(period)))
    out = packed.withColumn("trend0", trend).withColumn(
        "level0", first - F.col("trend0") * F.lit((period + 1) / 2.0))
    above = F.transform(F.slice(y, 1, period), lambda x, i: F.coalesce(
        x - (F.col("level0") + F.col("trend0") * (i + 1).cast("double")), F.lit(0.0)))
    return out.withColumn("seasons0", F.when(F.col("trend0").isNotNull(), above))


def smooth(packed: DataFrame, alpha: Column | float, beta: Column | float, gamma: Column | float = 0.0,
           period: int = 0, horizon: int = 3) -> DataFrame:
    """F3/F4 with given parameters: ``packed`` (of ``with_start``, or with fitted ``level0``,
    ``trend0`` and ``seasons0``) with ``level``, ``trend``, ``seasons`` after the last month, ``sse``
    of the one-step errors, ``n`` known months, and ``ahead`` (the next ``horizon`` values).
    All NULL where there are no initial states."""
    a, b, g = (x if isinstance(x, Column) else F.lit(float(x)) for x in (alpha, beta, gamma))
    one = F.lit(1.0)
    start = F.struct(F.col("level0").alias("level"), F.col("trend0").alias("trend"), F.col("seasons0").alias("seasons"),
                     F.lit(0.0).alias("sse"), F.lit(0).alias("n"))

    def step(s: Column, y: Column) -> Column:
        season = F.get(s["seasons"], F.lit(0)) if period else F.lit(0.0)
        line = s["level"] + s["trend"]
        level = F.when(y.isNull(), line).otherwise(a * (y - season) + (one - a) * line)
        trend = F.when(y.isNull(), s["trend"]).otherwise(b * (level - s["level"]) + (one - b) * s["trend"])
        turned = s["seasons"]
        if period:  # the season just used goes to the end of the queue
            new = F.when(y.isNull(), season).otherwise(g * (y - line) + (one - g) * season)
            turned = F.concat(F.slice(s["seasons"], 2, period - 1), F.array(new))
        error = F.coalesce(y - (line + season), F.lit(0.0))
        return F.struct(level.alias("level"), trend.alias("trend"), turned.alias("seasons"),
                        (s["sse"] + error * error).alias("sse"), (s["n"] + y.isNotNull().cast("int")).alias("n"))

    out = packed.withColumn("__s", F.when(F.col("level0").isNotNull(), F.aggregate("y", start, step)))
    state = F.col("__s")

    def after(h: Column) -> Column:
        season = F.get(state["seasons"], (h - 1) % period) if period else F.lit(0.0)
        return state["level"] + h.cast("double") * state["trend"] + season

    ahead = F.when(state.isNotNull(), F.transform(F.sequence(F.lit(1), F.lit(horizon)), after))
    return (out.withColumn("ahead", ahead).withColumns({c: state[c] for c in ("level", "trend", "seasons", "sse", "n")})
            .drop("__s"))


def ahead_rows(smoothed: DataFrame, keys: Sequence[str] = (), more: Sequence[str] = ()) -> DataFrame:
    """``(keys..., h, t, month, forecast, more...)`` from ``ahead``; series without a fit
    have no rows."""
    return smoothed.select(*keys, "t_last", "m_last", *more, F.posexplode("ahead").alias("__i", "forecast")).select(
        *keys, (F.col("__i") + 1).alias("h"), (F.col("t_last") + F.col("__i") + 1).alias("t"),
        F.add_months("m_last", F.col("__i") + 1).alias("month"), "forecast", *more)


def holt_winters_fixed(series: DataFrame, value: str, keys: Sequence[str], alpha: float, beta: float,
                       gamma: float = 0.0, period: int = 0, horizon: int = 3) -> DataFrame:
    """F3 (``period`` > 0) or F4 with given parameters and the states of ``with_start``."""
    packed = with_start(pack(series, value, keys), period)
    return ahead_rows(smooth(packed, alpha, beta, gamma, period, horizon), keys, ["sse"])


# --- fitted parameters ---------------------------------------------------------------------------
def _design(y: np.ndarray, known: np.ndarray, p: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """One-step predictions of many series (rows of ``y``, with ``known`` months) as linear
    functions of the initial states (level, trend, seasons) plus a constant: (S x T x
    (2 + m), S x T). ``p`` has alpha, beta, gamma of each series."""
    s, t = y.shape
    dim = 2 + m
    a, b, g = (p[:, i, None] for i in range(3))
    level, trend = np.zeros((s, dim + 1)), np.zeros((s, dim + 1))
    level[:, 0] = trend[:, 1] = 1.0
    seasons = np.zeros((m, s, dim + 1))
    for i in range(m):
        seasons[i, :, 2 + i] = 1.0
    out = np.empty((s, t, dim + 1))
    for i in range(t):
        season = seasons[i % m] if m else 0.0
        line = level + trend
        out[:, i] = line + season
        value = np.zeros((s, dim + 1))
        value[:, -1] = y[:, i]
        new = a * (value - season) + (1 - a) * line
        on = known[:, i, None]
        if m:
            seasons[i % m] = np.where(on, g * (value - line) + (1 - g) * season, season)
        trend, level = np.where(on, b * (new - level) + (1 - b) * trend, trend), np.where(on, new, line)
    return out[:, :, :-1], out[:, :, -1]


def _residuals(y: np.ndarray, known: np.ndarray, p: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(errors with the best initial states, 0 where a month is missing; those states)."""
    x, c = _design(y, known, p, m)
    x = x * known[:, :, None]
    left = np.where(known, y - c, 0.0)
    # level and seasons share a constant: the pseudo-inverse takes the shortest states
    z = np.einsum("sij,sj->si", np.linalg.pinv(x, rcond=1e-10), left)
    return left - np.einsum("stk,sk->st", x, z), z


def _parameters(u: np.ndarray) -> np.ndarray:
    """alpha, beta, gamma of numbers between 0 and 1 each: alpha, beta as a share of alpha,
    gamma as a share of 1 - alpha. So 0 <= beta <= alpha <= 1 and 0 <= gamma <= 1 - alpha."""
    return np.stack([u[:, 0], u[:, 1] * u[:, 0], u[:, 2] * (1 - u[:, 0])], axis=1)


def _shares(p: np.ndarray) -> np.ndarray:
    a = p[:, 0]
    with np.errstate(invalid="ignore", divide="ignore"):
        # where a share has no effect, it starts in the middle
        return np.stack([a, np.where(a > 0, p[:, 1] / a, 0.5), np.where(a < 1, p[:, 2] / (1 - a), 0.5)], axis=1).clip(0, 1)


def _grid(steps: int, m: int) -> np.ndarray:
    x = np.linspace(0.0, 1.0, steps)
    return np.array([(a, b, g) for a in x for b in x if b <= a + 1e-12 for g in (x if m else [0.0]) if g <= 1 - a + 1e-12])


def fit_batch(y: np.ndarray, m: int, grid: int) -> dict[str, np.ndarray]:
    """Fit many series (rows; NaN where a month is missing or a shorter series has ended):
    ``p``, ``sse``, ``states`` of each, ``grid_sse``, the least error on the grid, and
    ``line_sse``, the error without smoothing."""
    known = ~np.isnan(y)
    y = np.where(known, y, 0.0)
    points = _grid(grid, m)
    errors = np.empty((len(points), len(y)))
    for i, point in enumerate(points):
        r, _ = _residuals(y, known, np.tile(point, (len(y), 1)), m)
        errors[i] = (r * r).sum(axis=1)
    order = np.argsort(errors, axis=0, kind="stable")
    # the grid's first point smooths nothing: a line, with fixed seasons
    found = {"p": points[order[0]], "sse": errors.min(axis=0), "grid_sse": errors.min(axis=0), "line_sse": errors[0]}
    free = 3 if m else 2
    for start in range(min(STARTS, len(points))):
        u = _shares(points[order[start]])
        r, _ = _residuals(y, known, _parameters(u), m)
        sse = (r * r).sum(axis=1)
        damping = np.full(len(y), 1e-2)
        for _ in range(STEPS):
            slope = np.zeros((*r.shape, free))
            for j in range(free):
                h = np.where(u[:, j] > 0.5, -1e-5, 1e-5)  # to the inside of the bounds
                moved = u.copy()
                moved[:, j] += h
                near, _ = _residuals(y, known, _parameters(moved), m)
                slope[:, :, j] = (near - r) / h[:, None]
            downhill = -np.einsum("sti,st->si", slope, r)
            # a number at its bound that would leave it stays there
            held = ((u[:, :free] <= 0) & (downhill < 0)) | ((u[:, :free] >= 1) & (downhill > 0))
            slope *= ~held[:, None, :]
            normal = np.einsum("sti,stj->sij", slope, slope)
            scale = np.maximum(np.einsum("sii->si", normal), 1e-9)
            normal = normal + damping[:, None, None] * np.einsum("si,ij->sij", scale, np.eye(free)) + np.einsum("si,ij->sij", held, np.eye(free))
            step = np.linalg.solve(normal, np.where(held, 0.0, downhill)[:, :, None])[:, :, 0]
            tried = u.copy()
            tried[:, :free] = np.clip(tried[:, :free] + step, 0.0, 1.0)
            new, _ = _residuals(y, known, _parameters(tried), m)
            new_sse = (new * new).sum(axis=1)
            better = new_sse < sse
            u = np.where(better[:, None], tried, u)
            r = np.where(better[:, None], new, r)
            done = ~better & (damping > 1e6) | (better & (sse - new_sse <= 1e-12 * sse))
            sse = np.where(better, new_sse, sse)
            damping = np.clip(np.where(better, damping / 4, damping * 4), 1e-9, 1e9)
            if done.all():
                break
        wins = sse < found["sse"]
        found["p"] = np.where(wins[:, None], _parameters(u), found["p"])
        found["sse"] = np.where(wins, sse, found["sse"])
    _, found["states"] = _residuals(y, known, found["p"], m)
    return found


def refine(series: DataFrame, value: str, keys: Sequence[str] = (), period: int = 0, grid: int = 6) -> DataFrame:
    """F3/F4 with fitted parameters: ``pack``'s columns with ``alpha``, ``beta``, ``gamma``,
    ``level0``, ``trend0``, ``seasons0``, ``fit_sse``, ``grid_sse`` (the least error on the
    starting grid) and ``line_sse`` (the error without smoothing); ``smooth`` takes it on from there. A series needs as many known months
    as it has initial states and one more, else all of them are NULL."""
    keys = list(keys)
    packed = pack(series, value, keys)
    # one row for each series; whole series, spread over the tasks
    packed = packed.repartition(*(keys or [F.lit(0)]))
    fields = ("alpha", "beta", "gamma", "level0", "trend0", "seasons0", "fit_sse", "grid_sse", "line_sse")
    more = ", ".join(f"{c} {'array<double>' if c == 'seasons0' else 'double'}" for c in fields)
    schema = T.StructType([*packed.schema.fields, *T.StructType.fromDDL(more).fields])
    least = 2 + (period - 1 if period else 0) + 1

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), BATCH):
                part = frame.iloc[at:at + BATCH]
                rows = [np.asarray(x, float) for x in part["y"]]
                y = np.full((len(rows), max(map(len, rows))), np.nan)
                for i, x in enumerate(rows):
                    y[i, :len(x)] = x
                enough = (~np.isnan(y)).sum(axis=1) >= least
                out = {c: [None] * len(rows) for c in fields}
                if enough.any():
                    got = fit_batch(y[enough], period, grid)
                    for j, i in enumerate(np.flatnonzero(enough)):
                        z = got["states"][j]
                        values = (*got["p"][j].tolist(), z[0], z[1], z[2:].tolist(), *(got[c][j] for c in ("sse", "grid_sse", "line_sse")))
                        for c, v in zip(out, values, strict=True):
                            out[c][i] = v
                yield part.assign(**{c: pd.Series(v, index=part.index, dtype=object) for c, v in out.items()})

    return packed.mapInPandas(fit, schema)


def holt_winters_refined(series: DataFrame, value: str, keys: Sequence[str] = (), period: int = 0, horizon: int = 3,
                         grid: int = 6) -> DataFrame:
    """``(keys..., h, t, month, forecast, alpha, beta, gamma, sse)`` with fitted parameters:
    ``refine``, then the native smoother."""
    fitted = refine(series, value, keys, period, grid)
    done = smooth(fitted, F.col("alpha"), F.col("beta"), F.col("gamma"), period, horizon)
    return ahead_rows(done, keys, ["alpha", "beta", "gamma", "sse"])
