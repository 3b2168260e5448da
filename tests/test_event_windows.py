"""Effects of the days around events, and scores at several cut dates."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import evaluate, ridge, series

START = dt.date(2020, 1, 1)
WINDOWS = [("jour_ferie", -2, 1), ("vacances_scolaires", -1, 1)]
EFFECTS = {-2: 0.3, -1: 0.5, 0: -0.6, 1: 0.2}


def nearest(days, first, last, length):
    """Offset of each day from the nearest event, the earlier of two."""
    out = {}
    for d in range(length):
        reach = sorted((abs(d - e), e - d, d - e) for e in days if first <= d - e <= last)
        if reach:
            out[d] = reach[0][2]
    return out


def dense(spark, flags, y, product="riz"):
    """Rows of one product; ``flags`` names the days of each event."""
    rows = [(product, START + dt.timedelta(i), float(v), 10.0, 50.0, 100.0, 0,
             int(i in flags.get("vacances_scolaires", ())), int(i in flags.get("jour_ferie", ())), int(i in flags.get("covid_impact", ())))
            for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "nom_produit string, ds date, y double, temperature double, taux_occupation double, nb_patients double, "
                                       "epidemie_grippe int, vacances_scolaires int, jour_ferie int, covid_impact int")


def test_offsets_belong_to_the_nearest_event(spark):
    flags = {"jour_ferie": [0, 10, 12, 13, 20, 39], "vacances_scolaires": [13, 14, 15, 16], "covid_impact": [5]}
    series_rows = dense(spark, flags, np.ones(40)).unionByName(dense(spark, {"jour_ferie": [3]}, np.ones(6), "lait"))
    found = {(r.nom_produit, (r.ds - START).days, r.holiday): r.offset for r in series.holiday_offsets(series_rows, WINDOWS).collect()}
    expected = {("riz", d, "covid_19"): 0 for d in (5,)}
    expected |= {("riz", d, "jour_ferie"): o for d, o in nearest(flags["jour_ferie"], -2, 1, 40).items()}
    expected |= {("riz", d, "vacances_scolaires"): o for d, o in nearest(flags["vacances_scolaires"], -1, 1, 40).items()}
    expected |= {("lait", d, "jour_ferie"): o for d, o in nearest([3], -2, 1, 6).items()}
    assert found == expected
    assert found["riz", 11, "jour_ferie"] == 1 and series.holiday_offsets(series_rows.limit(0), WINDOWS).isEmpty()


def test_windows_must_hold_the_day_and_name_known_events():
    assert series.event_terms() == [("jour_ferie", 0), ("vacances_scolaires", 0), ("covid_19", 0)]
    for windows in ([("jour_ferie", 1, 2)], [("noel", 0, 0)]):
        with pytest.raises(ValueError):
            series.event_terms(windows)


def test_holidays_state_their_windows(spark):
    found = series.holidays(dense(spark, {"jour_ferie": [1], "covid_impact": [2]}, np.ones(4)), WINDOWS).collect()
    assert sorted((r.holiday, r.lower_window, r.upper_window) for r in found) == [("covid_19", 0, 0), ("jour_ferie", -2, 1)]


def history(days=900, seed=3):
    rng = np.random.default_rng(seed)
    events = sorted(rng.choice(np.arange(3, days - 3), 60, replace=False).tolist())
    place = nearest(events, -2, 1, days)
    season = 0.2 * np.sin(2 * np.pi * np.arange(days) / 7)
    y = 20 * (1 + season + np.array([EFFECTS.get(place.get(d, 9), 0.0) for d in range(days)])) + rng.normal(0, 0.3, days)
    return events, y


def test_known_effects_are_recovered_and_the_fit_is_at_its_optimum(spark):
    events, y = history()
    rows = ridge.forecast_rows(dense(spark, {"jour_ferie": events}, y), None, windows=WINDOWS)
    config = ridge.CONFIGS["enrichi"]
    fitted = ridge.fit_ridge(rows, config)
    found = {(r.holiday, r.offset): r for r in ridge.event_effects(fitted, WINDOWS).collect()}
    assert set(found) == set(series.event_terms(WINDOWS))
    for offset, effect in EFFECTS.items():
        line = found["jour_ferie", offset]
        assert line.effet == pytest.approx(effect, abs=0.03) and line.effet_lower < line.effet < line.effet_upper and line.converge
    # No day carries a school holiday: nothing moves its effects away from 0.
    assert found["vacances_scolaires", -1].effet == pytest.approx(0.0, abs=1e-9)
    assert [r.optimal for r in ridge.optimality(rows, fitted, config, windows=WINDOWS).collect()] == [True]


def test_forecast_sees_the_days_before_a_coming_event(spark):
    events, y = history()
    rows = dense(spark, {"jour_ferie": events}, y)
    ahead = START + dt.timedelta(len(y) + 9)
    coming = spark.createDataFrame([(ahead, "jour_ferie")], "ds date, holiday string")
    forecasts = [{r.ds: r.yhat for r in ridge.forecast_ridge(rows, None, events=coming, windows=w).collect()} for w in (WINDOWS, series.NO_WINDOWS)]
    step = {o: forecasts[0][ahead + dt.timedelta(o)] / forecasts[0][ahead + dt.timedelta(o - 7 if o > -1 else o + 7)] for o in (-1, 0)}
    assert step[-1] > 1.25 and step[0] < 0.6
    plain = forecasts[1]
    assert plain[ahead - dt.timedelta(1)] / plain[ahead + dt.timedelta(6)] == pytest.approx(1.0, abs=0.1)


def test_blind_backtest_knows_no_event_of_its_test_days(spark):
    flags = {"jour_ferie": [100, 301, 350]}
    y = np.arange(400) % 7 + 5.0
    rows = ridge.backtest_rows(dense(spark, flags, y), None, days=100, blind=True, windows=WINDOWS)
    terms = series.event_terms(WINDOWS)
    seen = {((r.ds - START).days, terms[i]) for r in rows.collect() for i, v in enumerate(r.evenements) if v}
    assert seen == {(98, ("jour_ferie", -2)), (99, ("jour_ferie", -1)), (100, ("jour_ferie", 0)), (101, ("jour_ferie", 1))}


def test_presets_are_scored_at_every_cut_that_leaves_training_days(spark):
    rng = np.random.default_rng(5)
    long = dense(spark, {}, 20 + rng.normal(0, 1, 400))
    short = dense(spark, {}, 20 + rng.normal(0, 1, 150), "lait")
    configs = [ridge.CONFIGS[n] for n in ("enrichi", "contre_sur_apprentissage")]
    pairs = ridge.backtest_origins(long.unionByName(short), None, *configs, origins=3, days=100)
    scores = evaluate.over_origins(evaluate.metrics(pairs, ["nom_produit", "date_coupure", "modele"]))
    rows = scores.collect()
    last = START + dt.timedelta(399)
    assert {r.date_coupure for r in rows if r.nom_produit == "riz"} == {last - dt.timedelta(100 * k) for k in (1, 2, 3)}
    assert {r.date_coupure for r in rows if r.nom_produit == "lait"} == {START + dt.timedelta(49)}
    assert all(r.nb_jours == 100 and r.nb_coupures == (3 if r.nom_produit == "riz" else 1) for r in rows)
    for product, cut in {(r.nom_produit, r.date_coupure) for r in rows}:
        here = sorted((r.rang, round(r.mae, 6)) for r in rows if (r.nom_produit, r.date_coupure) == (product, cut))
        assert [rank for rank, _ in here] == [1, 2] and here[0][1] <= here[1][1]
    # The latest cut is the plain backtest.
    plain = evaluate.metrics(ridge.backtest_ridge(long, None, *configs, days=100), ["nom_produit", "modele"]).collect()
    latest = {r.modele: r.mae for r in rows if r.nom_produit == "riz" and r.date_coupure == last - dt.timedelta(100)}
    assert latest == pytest.approx({r.modele: r.mae for r in plain})
