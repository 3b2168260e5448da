"""The regression model on series with known coefficients."""

import datetime as dt
import pickle
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from larder.functions import solver
from larder.operators import evaluate, ridge

START = dt.date(2020, 1, 1)
SCHEMA = ("nom_produit string, ds date, y double, temperature double, taux_occupation double, nb_patients double, "
          "epidemie_grippe int, vacances_scolaires int, jour_ferie int, covid_impact int")


def dense(spark, **products):
    """Series of the given values; regressors vary by day unless overridden."""
    out = []
    for name, (y, over) in products.items():
        rng = np.random.default_rng(7)
        n = len(y)
        cols = {
            "temperature": rng.normal(15, 5, n), "taux_occupation": rng.normal(70, 8, n), "nb_patients": rng.normal(100, 9, n),
            "epidemie_grippe": np.zeros(n, int), "vacances_scolaires": np.zeros(n, int), "jour_ferie": np.zeros(n, int),
            "covid_impact": np.zeros(n, int),
        } | over
        for i in range(n):
            out.append((name, START + dt.timedelta(days=i), float(y[i]), *[float(cols[c][i]) for c in list(cols)[:3]],
                        *[int(cols[c][i]) for c in list(cols)[3:]]))
    return spark.createDataFrame(out, SCHEMA)


def known_series(n=900):
    rng = np.random.default_rng(7)
    temperature, occupancy = rng.normal(15, 5, n), rng.normal(70, 8, n)
    t = np.arange(n)
    y = 50 + 0.02 * t + 0.5 * temperature - 0.3 * occupancy
    return y, {"temperature": temperature, "taux_occupation": occupancy}


@pytest.fixture(scope="module")
def fitted(spark):
    rows = ridge.forecast_rows(dense(spark, p=known_series()), ["2021-01-01"])
    return ridge.fit_ridge(rows, ridge.CONFIGS["enrichi"], predict=F.lit(True)).cache()


def test_recovers_regressor_effects(fitted):
    found = {r["regresseur"]: r for r in ridge.regressor_coefficients(fitted).collect()}
    assert found["temperature"]["coef"] == pytest.approx(0.5, abs=0.02)
    assert found["taux_occupation"]["coef"] == pytest.approx(-0.3, abs=0.02)
    assert abs(found["nb_patients"]["coef"]) < 0.02
    assert (found["temperature"]["effet"], found["taux_occupation"]["effet"]) == ("positif", "negatif")
    for r in found.values():
        assert r["coef_lower"] <= r["coef"] <= r["coef_upper"]


def test_parts_add_up_and_bounds_enclose(fitted):
    parts = ridge.components(fitted)
    wrong = parts.where(
        (F.abs(F.col("tendance") * (1 + F.col("annuel") + F.col("hebdo") + F.col("feries")) + F.col("effet_regresseurs") - F.col("yhat")) > 1e-9)
        | (F.col("yhat_lower") > F.col("yhat")) | (F.col("yhat_upper") < F.col("yhat")))
    assert wrong.count() == 0
    assert parts.where("y is null").count() == 28
    assert evaluate.metrics(parts.where("y is not null")).first()["mae"] < 0.2


def test_trend_break_is_found(spark):
    t = np.arange(800)
    y = 10 + 0.05 * np.maximum(0, t - 366)
    fitted = ridge.fit_ridge(ridge.forecast_rows(dense(spark, p=(y, {})), ["2021-01-01", "2030-01-01"]), ridge.CONFIGS["base"])
    found = ridge.changepoint_effects(fitted, ["2021-01-01", "2030-01-01"]).collect()
    assert [r["changepoint"] for r in found] == [dt.date(2021, 1, 1)]
    assert found[0]["delta"] == pytest.approx(0.05, abs=0.01)


def test_additive_solve_matches_a_plain_ridge():
    rng = np.random.default_rng(0)
    trend, season, outside = rng.normal(size=(300, 2)), rng.normal(size=(300, 4)), rng.normal(size=(300, 1))
    y = trend @ [1.0, 2.0] + season @ [0.5, 0, -1, 0.2] + outside @ [0.3] + rng.normal(0, 0.1, 300)
    priors = (np.full(2, 5.0), np.full(4, 10.0), np.full(1, 0.5))
    found = solver.solve(y, trend, season, outside, priors, False)
    X = np.hstack([trend, season, outside])
    expected = np.linalg.solve(X.T @ X / found.variance + np.diag(1 / np.concatenate(priors) ** 2), X.T @ y / found.variance)
    np.testing.assert_allclose(np.concatenate([found.trend, found.season, found.outside]), expected, rtol=1e-8)
    assert found.converged and found.variance == pytest.approx(np.mean((y - X @ expected) ** 2), rel=1e-9)


def test_multiplicative_season_is_recovered():
    t = np.linspace(0, 1, 1400)
    day = np.arange(1400.0)
    trend = np.column_stack([np.ones_like(t), t])
    season = solver._waves(day, 3, 7.0)
    y = (1 + 0.5 * t) * (1 + season @ np.array([0.2, 0, 0, 0.1, 0, 0])) / 2
    found = solver.solve(y, trend, season, np.empty((1400, 0)), (np.full(2, 5.0), np.full(6, 10.0), np.empty(0)), True)
    np.testing.assert_allclose(found.season, [0.2, 0, 0, 0.1, 0, 0], atol=1e-3)
    np.testing.assert_allclose(found.trend, [0.5, 0.25], atol=1e-3)
    assert found.converged


def random_problem(seed, n=500):
    rng = np.random.default_rng(seed)
    t = np.linspace(0, 1, n)
    trend = np.column_stack([np.ones(n), t, np.maximum(0, t - 0.4)])
    season = np.hstack([solver._waves(np.arange(n), 8, 365.25), solver._waves(np.arange(n), 3, 7.0)])
    outside = rng.normal(size=(n, 2))
    y = (trend @ rng.normal(size=3)) * (1 + season @ rng.normal(0, 0.3, season.shape[1])) + outside @ rng.normal(size=2) + rng.normal(0, 0.5, n)
    return y, trend, season, outside, (np.full(3, 5.0), np.full(season.shape[1], 10.0), np.full(2, 0.5))


@pytest.mark.parametrize("seed", range(12))
def test_multiplicative_fit_is_at_its_optimum(seed):
    y, trend, season, outside, priors = random_problem(seed)
    found = solver.solve(y, trend, season, outside, priors, True)
    assert found.converged
    v = found.variance
    level, rhythm = trend @ found.trend, 1 + season @ found.season
    residual = y - level * rhythm - outside @ found.outside
    slopes = np.hstack([trend * rhythm[:, None], season * level[:, None], outside])
    b = np.concatenate([found.trend, found.season, found.outside])
    gradient = b / np.concatenate(priors) ** 2 - slopes.T @ residual / v
    assert np.abs(gradient / np.sqrt((slopes**2).sum(axis=0) / v + 1 / np.concatenate(priors) ** 2)).max() < 1e-5
    assert v == pytest.approx(np.mean(residual**2), rel=1e-8)
    again = solver.solve(y, trend, season, outside, priors, True, most_rounds=2 * solver.MOST_ROUNDS)
    np.testing.assert_allclose(again.trend, found.trend, atol=1e-9)


def test_a_fit_that_does_not_end_says_so():
    assert not solver.solve(*random_problem(1), True, most_rounds=1).converged


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_twice_the_work_changes_no_forecast(spark, folder, monkeypatch):
    from larder.plans import catalog

    rows = ridge.backtest_rows(catalog._dense_regressors(spark, f"/root/testdata/{folder}"), catalog.CHANGEPOINTS).cache()

    def forecasts():
        found = ridge.components(ridge.fit_ridge(rows, ridge.CONFIGS["enrichi"], predict=~F.col("appris")))
        return np.array([r["yhat"] for r in found.select("yhat", "nom_produit", "ds").orderBy("nom_produit", "ds").collect()])

    once = forecasts()
    monkeypatch.setattr(solver, "TOLERANCE", 0.0)
    monkeypatch.setattr(solver.solve, "__defaults__", (300,))
    twice = forecasts()
    rows.unpersist()
    assert np.abs(once - twice).max() < 1e-6


def test_result_does_not_depend_on_partitions(spark):
    data = dense(spark, a=known_series(500), b=(np.arange(500.0) % 7, {}))

    def run(df):
        fc = ridge.forecast_ridge(df, ["2020-06-01"])
        return [tuple(r) for r in fc.select("nom_produit", "ds", F.round("yhat", 8)).orderBy("nom_produit", "ds").collect()]

    assert run(data.repartition(1)) == run(data.repartition(13, "ds"))


@pytest.mark.parametrize("values", [np.zeros(60), np.full(60, 5.0), np.array([3.0])])
@pytest.mark.parametrize("config", ["enrichi", "base"])
def test_degenerate_series(spark, values, config):
    flat = {c: np.full(len(values), 4.0) for c in ("temperature", "taux_occupation", "nb_patients")}
    fc = ridge.forecast_ridge(dense(spark, p=(values, flat)), ["2020-01-20"], ridge.CONFIGS[config]).collect()
    assert len(fc) == 28
    assert all(np.isfinite([r["yhat"], r["yhat_lower"], r["yhat_upper"]]).all() for r in fc)
    if len(values) > 1:  # one day cannot tell the level from a season
        assert fc[0]["yhat"] == pytest.approx(values[-1], abs=0.3)


def test_history_shorter_than_the_test_span_gives_no_backtest(spark):
    assert ridge.backtest_ridge(dense(spark, p=(np.ones(100), {})), [], ridge.CONFIGS["enrichi"]).count() == 0


def test_blind_backtest_hides_test_regressors(spark):
    y, over = known_series()
    data = dense(spark, p=(y, over))
    seen = evaluate.metrics(ridge.backtest_ridge(data, [], ridge.CONFIGS["enrichi"])).first()["mae"]
    blind = evaluate.metrics(ridge.backtest_ridge(data, [], ridge.CONFIGS["enrichi"], blind=True)).first()["mae"]
    assert seen < 0.5 < blind


def test_solver_travels_with_the_task(tmp_path):
    """Executors unpickle the solver without this package on their path."""
    path = tmp_path / "fit.pkl"
    path.write_bytes(cloudpickle.dumps(solver.fit_group([ridge.CONFIGS["enrichi"]])))
    pickle.loads(path.read_bytes())
    code = f"import pickle, sys; pickle.load(open({str(path)!r}, 'rb')); sys.exit('larder' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin"}).returncode == 0
