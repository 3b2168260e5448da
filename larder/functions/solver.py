"""Coefficients of one product's demand model. Runs inside Spark tasks, on one product's days."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from larder.fixed_values import (
    HOLIDAY_FLAGS,
    MODEL_REGRESSORS,
    TREND_PRIOR,
    WEEK_PERIOD,
    WEEKLY_ORDER,
    YEAR_PERIOD,
    YEARLY_ORDER,
)

# Share of the cost that a full step may still gain at the end; that from which on steps are taken unseen; and the share
# by which the variance may still move. Fits end after some tens of rounds; one that has not ended after the last says
# so in ``converge``.
TOLERANCE, CLOSE, STEADY = 1e-18, 1e-9, 1e-10
MOST_ROUNDS = 2000
STUCK = 1e12
SMALLEST_VARIANCE = 1e-10


@dataclass(frozen=True)
class Config:
    name: str
    multiplicative: bool
    yearly: int
    weekly: int
    changepoint_prior: float
    seasonality_prior: float
    holidays_prior: float
    outside: bool
    # Whether the prior of the trend's breaks is a Laplace distribution, under which most breaks are exactly 0.
    sparse: bool = False


def _waves(day: np.ndarray, order: int, period: float) -> np.ndarray:
    angle = 2.0 * np.pi * np.outer(day, np.arange(1, order + 1)) / period
    return np.stack([np.sin(angle), np.cos(angle)], axis=2).reshape(len(day), 2 * order)


def _downhill(curvature: np.ndarray, gradient: np.ndarray) -> np.ndarray | None:
    """The Newton step, where the curvature is that of a minimum."""
    try:
        np.linalg.cholesky(curvature)
    except np.linalg.LinAlgError:
        return None
    return np.linalg.solve(curvature, -gradient)


@dataclass(frozen=True)
class Solution:
    trend: np.ndarray
    season: np.ndarray
    outside: np.ndarray
    sigma: float
    variance: float
    outside_spread: np.ndarray
    converged: bool
    rounds: int
    # Joint covariance of all coefficients, trend, season and outside in this order.
    covariance: np.ndarray


def solve(y: np.ndarray, trend: np.ndarray, season: np.ndarray, outside: np.ndarray,
          priors: tuple[np.ndarray, np.ndarray, np.ndarray], multiplicative: bool, most_rounds: int = MOST_ROUNDS) -> Solution:
    """Coefficients and noise variance of greatest penalised likelihood.

    Given the variance, the coefficients minimise the squares over it plus the squares over the prior deviations: one
    linear solve for additive models, damped Newton steps over all coefficients at once for multiplicative ones. The
    variance is then that of the residuals, until neither moves. ``converged`` says whether that was reached. The
    deviations come from the precision of all coefficients, so they count the trend's uncertainty.
    """
    sizes = [trend.shape[1], season.shape[1], outside.shape[1]]
    in_trend, in_season = slice(0, sizes[0]), slice(sizes[0], sizes[0] + sizes[1])
    penalty = np.concatenate(priors) ** -2.0

    def state(b, variance):
        b_trend, b_season, b_outside = np.split(b, np.cumsum(sizes)[:-1])
        g, level = trend @ b_trend, 1.0 + season @ b_season
        fitted = g * level + outside @ b_outside if multiplicative else g + level - 1.0 + outside @ b_outside
        residual = y - fitted
        slopes = np.hstack([trend * level[:, None], season * g[:, None], outside] if multiplicative else [trend, season, outside])
        return residual, slopes, 0.5 * (residual @ residual / variance + penalty @ b**2)

    variance = max(float(np.var(y)), SMALLEST_VARIANCE)
    b = np.zeros(sum(sizes))
    b[in_trend] = np.linalg.solve(trend.T @ trend / variance + np.diag(penalty[in_trend]), trend.T @ y / variance)
    damping, converged, rounds = 0.0, False, 0
    while rounds < most_rounds and not converged and damping < STUCK:
        rounds += 1
        residual, slopes, cost = state(b, variance)
        gradient = penalty * b - slopes.T @ residual / variance
        precision = slopes.T @ slopes / variance + np.diag(penalty)
        curvature = precision.copy()
        if multiplicative:
            cross = trend.T @ (season * residual[:, None]) / variance
            curvature[in_trend, in_season] -= cross
            curvature[in_season, in_trend] -= cross.T
        full = _downhill(curvature, gradient)
        gain = np.inf if full is None else float(-gradient @ full) / (1.0 + cost)
        if gain <= CLOSE:
            # So near that rounding hides whether the cost falls.
            b, damping = b + full, 0.0
            noise = max(float(np.mean(state(b, variance)[0] ** 2)), SMALLEST_VARIANCE)
            converged = gain <= TOLERANCE and abs(noise - variance) <= STEADY * variance
            variance = variance if converged else noise
            continue
        # Away from the optimum a full step may lead uphill; then the damping grows.
        while damping < STUCK:
            step = full if damping == 0.0 else _downhill(curvature + damping * np.diag(np.diag(precision)), gradient)
            if step is not None and state(b + step, variance)[2] < cost:
                b = b + step
                damping = damping / 4.0 if damping > 1e-6 else 0.0
                break
            damping = max(4.0 * damping, 1e-3)
    residual, slopes, _ = state(b, variance)
    covariance = np.linalg.inv(slopes.T @ slopes / variance + np.diag(penalty))
    spread = np.sqrt(np.diag(covariance))[sum(sizes[:2]):]
    b_trend, b_season, b_outside = np.split(b, np.cumsum(sizes)[:-1])
    return Solution(b_trend, b_season, b_outside, float(np.std(residual)), variance, spread, converged, rounds, covariance)


def lasso(S: np.ndarray, c: np.ndarray, weight: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The z of least z'Sz/2 + c'z + weight'|z|, S positive definite, by feature-sign search from a first guess.

    Coefficients away from 0 are solved for with their signs held; the way there ends at the best of the places where one of
    them changes sign, and such a one becomes 0. Then the coefficient at 0 that is pushed hardest beyond its weight joins in.
    The cost falls with every turn, so no set of signs comes twice.
    """
    z = z.copy()
    sign = np.sign(z)

    def cost(x):
        return 0.5 * x @ S @ x + c @ x + weight @ np.abs(x)

    for _ in range(50 * (len(z) + 1)):
        on = np.flatnonzero(sign)
        if len(on):
            goal = z.copy()
            goal[on] = np.linalg.solve(S[np.ix_(on, on)], -(c[on] + weight[on] * sign[on]))
            if np.all(goal[on] * sign[on] >= 0):
                z = goal
            else:
                way = goal - z
                crossed = [i for i in on if z[i] * goal[i] < 0]
                stops = [(-z[i] / way[i], i) for i in crossed] + [(1.0, None)]
                best = None
                for share, i in stops:
                    x = z + share * way
                    if i is not None:
                        x[i] = 0.0
                    if best is None or cost(x) < best[0]:
                        best = (cost(x), x)
                moved = not np.array_equal(best[1], z)
                z = best[1]
                sign = np.sign(z)
                if moved:
                    continue
            sign = np.sign(z)
        push = S @ z + c
        off = np.where(sign == 0, np.abs(push) - weight, -np.inf)
        joins = int(np.argmax(off)) if len(off) else 0
        if not len(off) or off[joins] <= 1e-12 * (1.0 + weight[joins]):
            return z
        sign[joins] = -np.sign(push[joins])
    return z


def solve_sparse(y: np.ndarray, trend: np.ndarray, season: np.ndarray, outside: np.ndarray, priors: tuple[np.ndarray, np.ndarray, np.ndarray],
                 multiplicative: bool, most_rounds: int = MOST_ROUNDS) -> Solution:
    """As ``solve``, with Laplace priors of the given scales on the trend's breaks: all of its columns but the first two.

    Proximal Newton steps: the squares are replaced by their parabola, the other coefficients are eliminated from it, and what
    is left is a lasso over the breaks. Steps are halved until the cost falls as it should; the last ones are full, so breaks
    that the prior keeps out are exactly 0.
    """
    sizes = [trend.shape[1], season.shape[1], outside.shape[1]]
    in_trend, in_season = slice(0, sizes[0]), slice(sizes[0], sizes[0] + sizes[1])
    scales = np.concatenate(priors)
    breaks, rest = np.arange(2, sizes[0]), np.concatenate([[0, 1], np.arange(sizes[0], sum(sizes))]).astype(int)
    penalty, weight = scales**-2.0, 1.0 / scales[breaks]
    penalty[breaks] = 0.0

    def state(b, variance):
        b_trend, b_season, b_outside = np.split(b, np.cumsum(sizes)[:-1])
        g, level = trend @ b_trend, 1.0 + season @ b_season
        fitted = g * level + outside @ b_outside if multiplicative else g + level - 1.0 + outside @ b_outside
        residual = y - fitted
        slopes = np.hstack([trend * level[:, None], season * g[:, None], outside] if multiplicative else [trend, season, outside])
        return residual, slopes, 0.5 * (residual @ residual / variance + penalty @ b**2) + weight @ np.abs(b[breaks])

    variance = max(float(np.var(y)), SMALLEST_VARIANCE)
    b, converged, rounds = np.zeros(sum(sizes)), False, 0
    b[:2] = np.linalg.solve(trend[:, :2].T @ trend[:, :2] / variance + np.diag(penalty[:2]), trend[:, :2].T @ y / variance)
    # So much is enough for a parabola where nothing else bends it: a break that no training day follows.
    floor = 1e-9
    while rounds < most_rounds and not converged:
        rounds += 1
        residual, slopes, cost = state(b, variance)
        gradient = penalty * b - slopes.T @ residual / variance
        precision = slopes.T @ slopes / variance + np.diag(penalty) + floor * np.eye(len(b))
        curvature = precision.copy()
        if multiplicative:
            cross = trend.T @ (season * residual[:, None]) / variance
            curvature[in_trend, in_season] -= cross
            curvature[in_season, in_trend] -= cross.T
            try:
                np.linalg.cholesky(curvature)
            except np.linalg.LinAlgError:
                curvature = precision
        inner, across = curvature[np.ix_(rest, rest)], curvature[np.ix_(rest, breaks)]
        solved = np.linalg.solve(inner, np.column_stack([gradient[rest], across]))
        S = curvature[np.ix_(breaks, breaks)] - across.T @ solved[:, 1:]
        pushed = gradient[breaks] - across.T @ solved[:, 0]
        z = lasso((S + S.T) / 2, pushed - S @ b[breaks], weight, b[breaks])
        step = np.zeros(len(b))
        step[breaks] = z - b[breaks]
        step[rest] = -solved[:, 0] - solved[:, 1:] @ step[breaks]
        gain = -float(gradient @ step + weight @ (np.abs(z) - np.abs(b[breaks])))
        full = b + step
        full[breaks] = z
        if gain / (1.0 + cost) <= CLOSE:
            # So near that rounding hides whether the cost falls.
            b = full
            noise = max(float(np.mean(state(b, variance)[0] ** 2)), SMALLEST_VARIANCE)
            converged = gain / (1.0 + cost) <= TOLERANCE and abs(noise - variance) <= STEADY * variance
            variance = variance if converged else noise
            continue
        share, there = 1.0, full
        while share > 1.0 / STUCK and state(there, variance)[2] > cost - 1e-4 * share * gain:
            share /= 2.0
            there = b + share * step
        if share <= 1.0 / STUCK:
            break
        b = there
    residual, slopes, _ = state(b, variance)
    # Breaks at 0 take no part in the uncertainty of the others.
    used = np.concatenate([rest, breaks[b[breaks] != 0]])
    held = slopes[:, used]
    covariance = np.zeros((len(b), len(b)))
    covariance[np.ix_(used, used)] = np.linalg.inv(held.T @ held / variance + np.diag(penalty[used] + floor))
    spread = np.sqrt(np.diag(covariance))[sum(sizes[:2]):]
    b_trend, b_season, b_outside = np.split(b, np.cumsum(sizes)[:-1])
    return Solution(b_trend, b_season, b_outside, float(np.std(residual)), variance, spread, converged, rounds, covariance)


def _padded(values: np.ndarray, length: int) -> list[float]:
    return [*values.tolist(), *[0.0] * (length - len(values))]


PARTS = ["tendance", "annuel", "hebdo", "feries", "effet_regresseurs"]
# Each part's value, and the deviation that the coefficients' joint uncertainty gives it.
PART_TYPE = pa.struct([("ds", pa.date32()), ("y", pa.float64()), *[(p, pa.float64()) for p in PARTS], *[(f"{p}_ecart", pa.float64()) for p in PARTS]])
FIT_SCHEMA = pa.schema([
    ("nom_produit", pa.string()),
    ("modele", pa.string()),
    ("multiplicatif", pa.bool_()),
    ("debut", pa.date32()),
    ("duree", pa.int32()),
    ("sigma", pa.float64()),
    ("converge", pa.bool_()),
    ("tours", pa.int32()),
    ("variance", pa.float64()),
    ("echelle_y", pa.float64()),
    ("tendance", pa.list_(pa.float64())),
    ("annuel", pa.list_(pa.float64())),
    ("hebdo", pa.list_(pa.float64())),
    ("evenements", pa.list_(pa.float64())),
    ("evenements_ecart", pa.list_(pa.float64())),
    ("regresseurs", pa.list_(pa.float64())),
    ("regresseurs_ecart", pa.list_(pa.float64())),
    ("centres", pa.list_(pa.float64())),
    ("echelles", pa.list_(pa.float64())),
    ("jours", pa.list_(PART_TYPE)),
])


def fit_group(configs: Sequence[Config]):
    """Function of one product's days: fits on rows ``appris``, evaluates rows ``predit``."""

    def fit(key: tuple[pa.Scalar, ...], days: pa.Table) -> pa.Table:
        days = days.sort_by("ds").combine_chunks()

        def column(name):
            return days[name].to_numpy().astype(float)

        def matrix(name):
            return days[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(days.num_rows, -1)

        train, shown = (days[c].to_numpy().astype(bool) for c in ("appris", "predit"))
        if not train.any():
            return FIT_SCHEMA.empty_table()
        t, day, breaks = column("t"), column("jour"), matrix("ruptures")
        y = column("y")[train]
        scale = float(np.max(np.abs(y))) or 1.0
        trend = np.column_stack([np.ones_like(t), t, breaks])
        shown_days = days.select(["ds", "y"]).filter(pa.array(shown))
        lines = []
        for c in configs:
            events = matrix("evenements") if c.outside else np.empty((len(t), 0))
            outside = matrix("regresseurs") if c.outside else np.empty((len(t), 0))
            groups = [_waves(day, c.yearly, YEAR_PERIOD), _waves(day, c.weekly, WEEK_PERIOD), events]
            season = np.hstack(groups)
            priors = (
                np.array([TREND_PRIOR] * 2 + [c.changepoint_prior] * breaks.shape[1]),
                np.array([c.seasonality_prior] * (2 * c.yearly + 2 * c.weekly) + [c.holidays_prior] * events.shape[1]),
                np.array([prior for _, prior, _ in MODEL_REGRESSORS][: outside.shape[1]], dtype=float),
            )
            found = (solve_sparse if c.sparse else solve)(y / scale, trend[train], season[train], outside[train], priors, c.multiplicative)
            b_trend, b_outside, spread = found.trend * scale, found.outside * scale, found.outside_spread * scale
            b_season = found.season if c.multiplicative else found.season * scale
            b_groups = np.split(b_season, np.cumsum([g.shape[1] for g in groups])[:-1])
            parts = [trend @ b_trend, *[g @ b for g, b in zip(groups, b_groups)], outside @ b_outside]
            unit = 1.0 if c.multiplicative else scale
            spreads, at = [], 0
            for columns, size in zip([trend, *groups, outside], [scale, unit, unit, unit, scale]):
                own = slice(at, at + columns.shape[1])
                days_in, at = columns[shown], own.stop
                spreads.append(size * np.sqrt(np.maximum(np.sum(days_in @ found.covariance[own, own] * days_in, axis=1), 0.0)))
            shown_parts = pa.StructArray.from_arrays(
                [*[col.combine_chunks() for col in shown_days.columns], *[pa.array(p[shown]) for p in parts], *[pa.array(s) for s in spreads]],
                fields=list(PART_TYPE),
            )
            yearly, weekly, event = b_groups
            event_at = trend.shape[1] + season.shape[1] - events.shape[1]
            event_spread = unit * np.sqrt(np.diag(found.covariance)[event_at : event_at + events.shape[1]])
            lines.append({
                "nom_produit": [key[0].as_py()],
                "modele": [c.name],
                "multiplicatif": [c.multiplicative],
                "debut": [days["ds"][0].as_py()],
                "duree": [max(int(day[train].max() - day[0]), 1)],
                "sigma": [found.sigma * scale],
                "converge": [found.converged],
                "tours": [found.rounds],
                "variance": [found.variance],
                "echelle_y": [scale],
                "tendance": [b_trend.tolist()],
                "annuel": [_padded(yearly, 2 * YEARLY_ORDER)],
                "hebdo": [_padded(weekly, 2 * WEEKLY_ORDER)],
                "evenements": [_padded(event, len(HOLIDAY_FLAGS))],
                "evenements_ecart": [_padded(event_spread, len(HOLIDAY_FLAGS))],
                "regresseurs": [_padded(b_outside, len(MODEL_REGRESSORS))],
                "regresseurs_ecart": [_padded(spread, len(MODEL_REGRESSORS))],
                "centres": [days["centres"][0].as_py()],
                "echelles": [days["echelles"][0].as_py()],
                "jours": pa.ListArray.from_arrays(pa.array([0, len(shown_parts)], pa.int32()), shown_parts),
            })
        return pa.concat_tables([pa.Table.from_pydict(line, schema=FIT_SCHEMA) for line in lines])

    return fit
