"""Fits whose trend breaks have Laplace priors."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.functions import solver
from larder.operators import ridge

START = dt.date(2020, 1, 1)


@pytest.mark.parametrize("seed", range(20))
def test_lasso_meets_its_conditions(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 30))
    A = rng.normal(size=(n + 5, n)) @ np.diag(10.0 ** rng.uniform(-3, 3, n))
    S, c, weight = A.T @ A, rng.normal(0, 50, n), rng.uniform(0.1, 60, n)
    z = solver.lasso(S, c, weight, np.where(rng.random(n) < 0.5, 0.0, rng.normal(size=n)))
    push = S @ z + c
    assert np.all(np.abs(push[z == 0]) <= weight[z == 0] * (1 + 1e-9) + 1e-9)
    np.testing.assert_allclose(push[z != 0], -(weight * np.sign(z))[z != 0], rtol=1e-6, atol=1e-6)


def problem(seed, multiplicative, n=900, breaks=25):
    rng = np.random.default_rng(seed)
    t = np.linspace(0, 1, n)
    trend = np.column_stack([np.ones(n), t, *[np.maximum(0, t - s) for s in np.linspace(0.03, 0.8, breaks)]])
    season = np.hstack([solver._waves(np.arange(n), 4, 365.25), solver._waves(np.arange(n), 3, 7.0)])
    outside = rng.normal(size=(n, 2))
    true = np.zeros(trend.shape[1])
    true[:2], true[[8, 20]] = (3.0, 1.0), (-4.0, 5.0)
    s = season @ rng.normal(0, 0.2, season.shape[1])
    y = (trend @ true * (1 + s) if multiplicative else trend @ true + s) + outside @ np.array([0.3, -0.2]) + rng.normal(0, 0.05, n)
    return y, trend, season, outside, (np.concatenate([[5.0, 5.0], np.full(breaks, 0.05)]), np.full(season.shape[1], 10.0), np.full(2, 0.5)), true


@pytest.mark.parametrize("multiplicative", [False, True])
@pytest.mark.parametrize("seed", range(6))
def test_sparse_fit_is_at_its_optimum(seed, multiplicative):
    y, trend, season, outside, priors, true = problem(seed, multiplicative)
    found = solver.solve_sparse(y, trend, season, outside, priors, multiplicative)
    assert found.converged
    level, rhythm = trend @ found.trend, 1 + season @ found.season
    residual = y - (level * rhythm if multiplicative else level + rhythm - 1) - outside @ found.outside
    slopes = np.hstack([trend * rhythm[:, None], season * level[:, None], outside] if multiplicative else [trend, season, outside])
    pull = slopes.T @ residual / found.variance
    b, scales = np.concatenate([found.trend, found.season, found.outside]), np.concatenate(priors)
    size = np.sqrt((slopes**2).sum(axis=0) / found.variance)
    breaks = slice(2, trend.shape[1])
    smooth = np.ones(len(b), bool)
    smooth[breaks] = False
    assert np.abs((b / scales**2 - pull)[smooth] / size[smooth]).max() < 1e-5
    at, of, hold, unit = b[breaks], pull[breaks], 1 / scales[breaks], size[breaks]
    assert np.all(np.abs(of[at == 0]) <= hold[at == 0] * (1 + 1e-9))
    assert np.abs((of - hold * np.sign(at))[at != 0] / unit[at != 0]).max() < 1e-5
    assert found.variance == pytest.approx(np.mean(residual**2), rel=1e-8)
    # Most breaks are exactly 0, and the slope changes where it did.
    assert (at == 0).sum() >= 15
    change = np.cumsum(found.trend[2:]) - np.cumsum(true[2:])
    assert np.abs(change[[3, 12, 24]]).max() < 0.6


def test_without_pull_all_breaks_are_zero():
    y, trend, season, outside, priors, _ = problem(1, False)
    line = 2.0 + trend[:, 1] + np.random.default_rng(0).normal(0, 0.3, len(y))
    found = solver.solve_sparse(line, trend, season, outside, priors, False)
    assert found.converged and not found.trend[2:].any()
    assert found.trend[1] == pytest.approx(1.0, abs=0.2)


def test_a_sparse_fit_that_does_not_end_says_so():
    y, trend, season, outside, priors, _ = problem(2, True)
    assert not solver.solve_sparse(y, trend, season, outside, priors, True, most_rounds=1).converged


def test_known_break_is_found_by_product(spark):
    n = 1000
    t = np.arange(n)
    noise = np.random.default_rng(3).normal(0, 0.5, n)
    series = {"plat": 20 + noise, "casse": 20 + 0.01 * t + 0.1 * np.maximum(0, t - 400) + noise, "nul": np.zeros(n), "constant": np.full(n, 3.0), "seul": np.ones(1)}
    rows = [(name, START + dt.timedelta(days=int(i)), float(v)) for name, values in series.items() for i, v in enumerate(values)]
    dense = spark.createDataFrame(rows, "nom_produit string, ds date, y double")
    input_rows, config = ridge.forecast_rows(dense, None), ridge.CONFIGS["base_creux"]
    fitted = ridge.fit_ridge(input_rows, config, predict=F.col("futur")).cache()
    breaks = {}
    for r in ridge.trend_breaks(fitted).collect():
        breaks.setdefault(r.nom_produit, []).append((r.changepoint, r.delta))
    # Noise may move the slope of the flat series a little.
    assert set(breaks) <= {"casse", "plat"} and len(breaks["casse"]) <= 10
    assert sum(abs(delta) for _, delta in breaks.get("plat", [])) < 0.005
    near = [delta for day, delta in breaks["casse"] if abs((day - START).days - 400) <= 80]
    assert sum(near) == pytest.approx(0.1, abs=0.02)
    optimal = {r.nom_produit: r.optimal for r in ridge.optimality(input_rows, fitted, config).collect()}
    assert optimal["plat"] and optimal["casse"]
    ahead = {r.nom_produit: r.yhat for r in ridge.components(fitted).where(F.col("ds") == START + dt.timedelta(days=n + 27)).collect()}
    assert ahead["casse"] == pytest.approx(20 + 0.01 * (n + 27) + 0.1 * (n + 27 - 400), rel=0.03)


def test_intervals_widen_as_trends_may_turn(spark):
    rng = np.random.default_rng(9)
    rate, size, sigma, h, n = 0.25, 0.02, 0.4, 90, 40_000
    # Trends whose slope takes Laplace steps at random times, seen 90 days ahead.
    moved = np.array([(rng.laplace(0, size, k) * rng.uniform(0, h, k)).sum() for k in rng.poisson(rate * h, n)])
    from larder.functions.columns import drift_variance
    variance = spark.range(1).select(drift_variance(F.lit(rate), F.lit(size), F.lit(h)).alias("v")).first().v
    assert variance == pytest.approx(moved.var(), rel=0.05)
    half = 1.4395314709384563 * np.sqrt(sigma**2 + variance)
    assert np.mean(np.abs(moved + rng.normal(0, sigma, n)) <= half) == pytest.approx(0.85, abs=0.02)


def test_widening_forecasts(spark, sf):
    from larder.plans.catalog import QUERIES
    for plain, wide in (("forecast_native", "forecast_native_widening"), ("forecast_28d", "forecast_28d_widening")):
        narrow = {(r.nom_produit, r.ds): r for r in QUERIES[plain](spark, sf).collect()}
        width = {}
        for r in QUERIES[wide](spark, sf).collect():
            same = narrow[r.nom_produit, r.ds]
            assert r.yhat == same.yhat and r.yhat_upper - r.yhat_lower >= same.yhat_upper - same.yhat_lower - 2e-4
            width.setdefault(r.nom_produit, []).append((r.ds, r.yhat_upper - r.yhat_lower))
        if plain == "forecast_native":
            # Both ends are rounded to four digits.
            assert all(b[1] > a[1] - 3e-4 for v in map(sorted, width.values()) for a, b in zip(v, v[1:]))
            assert any(v[-1][1] > v[0][1] for v in map(sorted, width.values()))


def test_intervals_of_parts_come_from_the_joint_covariance(spark):
    n = 400
    rng = np.random.default_rng(5)
    y = 10 + 0.01 * np.arange(n) + np.sin(2 * np.pi * np.arange(n) / 7) + rng.normal(0, 0.3, n)
    rows = [("riz", START + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)]
    config = ridge.CONFIGS["base"]
    input_rows = ridge.forecast_rows(spark.createDataFrame(rows, "nom_produit string, ds date, y double"), None)
    found = ridge.components(ridge.fit_ridge(input_rows, config, predict=F.lit(True))).orderBy("ds").toPandas()
    days = input_rows.orderBy("ds").toPandas()
    day, t = days.jour.to_numpy(float), days.t.to_numpy()
    trend = np.column_stack([np.ones(len(t)), t, np.stack(days.ruptures)])
    parts = {"tendance": trend, "annuel": solver._waves(day, config.yearly, 365.25), "hebdo": solver._waves(day, config.weekly, 7.0)}
    X, scale = np.hstack(list(parts.values())), np.abs(y).max()
    priors = np.concatenate([[5.0, 5.0], np.full(trend.shape[1] - 2, 0.05), np.full(X.shape[1] - trend.shape[1], 10.0)])
    residual = (y - found.yhat.to_numpy()[:n]) / scale
    sigma = np.linalg.inv(X[:n].T @ X[:n] / np.mean(residual**2) + np.diag(priors**-2.0))
    at = 0
    for name, columns in parts.items():
        own = slice(at, at + columns.shape[1])
        at = own.stop
        half = 1.4395314709384563 * scale * np.sqrt(np.einsum("ij,jk,ik->i", columns, sigma[own, own], columns))
        np.testing.assert_allclose((found[f"{name}_upper"] - found[f"{name}_lower"]).to_numpy() / 2, half, rtol=1e-5)
        np.testing.assert_allclose(((found[f"{name}_upper"] + found[f"{name}_lower"]) / 2).to_numpy(), found[name].to_numpy(), atol=1e-9)
    # What lies ahead of the data is less certain.
    width = (found.tendance_upper - found.tendance_lower).to_numpy()
    assert width[-1] > width[n - 100]
