"""Reading, checking and writing tables."""

import pytest
from pyspark.sql import functions as F

from conftest import day
from larder.fixed_values import MOVEMENT_COLUMNS
from larder.operators import demand, forecast, series
from larder.sources import movements as readers
from larder.sources import runs, sinks

CSV_FORECAST = sinks.FORECAST_CSV_SCHEMA


def test_csv_round_trip(spark, make, tmp_path):
    mv = make({}, {"nom_produit": "lait, demi", "type_sortie": None, "temperature_stockage": None})
    mv.write.option("header", True).csv(str(tmp_path / "mv"))
    back = readers.read_movements(spark, str(tmp_path / "mv"))
    assert back.columns == MOVEMENT_COLUMNS
    assert sorted(map(str, back.collect())) == sorted(map(str, mv.collect()))


def test_base_layout_moves_storage_temperature(spark, tmp_path):
    (tmp_path / "base.csv").write_text(
        "date,type_operation,id_lot,numero_lot,id_produit,nom_produit,type_produit,unite,quantite,stock_theorique,"
        "temperature,date_expiration,id_fournisseur,nom_fournisseur,id_arrivage\n"
        "2022-01-01,SORTIE,1,L1,5,Riz,Aliment,kg,2.5,10,4.5,2022-02-01,1,A,7\n")
    row = readers.read_movements(spark, str(tmp_path / "base.csv"), layout="base").first()
    assert row["temperature_stockage"] == 4.5 and "temperature" not in row.asDict()
    report = readers.schema_report(readers.read_movements(spark, str(tmp_path / "base.csv"), layout="base"))
    missing = {r["colonne"] for r in report.where("not presente").collect()}
    assert missing == {"type_sortie", "temperature", "taux_occupation", "nb_patients", "epidemie_grippe",
                       "vacances_scolaires", "jour_ferie", "covid_impact"}


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_movements(spark, str(tmp_path / "none.csv"))


def test_other_header_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="(?i)header|column|malformed"):
        readers.read_movements(spark, str(tmp_path / "x.csv")).collect()


def test_dates(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2024-02-30",), (None,)], "d string")
    assert [r[0] for r in readers.parse_dates(df, ["d"], strict=False).collect()] == [day("2024-02-29"), None, None]
    with pytest.raises(Exception, match="(?i)date|parse"):
        readers.parse_dates(df, ["d"]).collect()
    assert readers.date_parse_report(df, ["d"]).first().asDict()["nb_rejets"] == 1


def test_nan_becomes_null(spark):
    df = readers.nan_to_null(spark.createDataFrame([(float("nan"),), (2.0,)], "x double"))
    assert df.agg(F.avg("x"), F.count("x")).first()[:] == (2.0, 1)


def test_parquet_filters_and_columns_reach_the_scan(spark, make, tmp_path):
    make({}).write.parquet(str(tmp_path / "mv"))
    mv = readers.read_movements(spark, str(tmp_path / "mv"), fmt="parquet")
    plan = demand.daily_demand(demand.consumed(mv))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(type_sortie,CONSOMMATION)" in plan
    assert "ReadSchema: struct<date:date,nom_produit:string,type_sortie:string,quantite:double>" in plan


@pytest.fixture(scope="module")
def export(make):
    mv = make({"quantite": 3.0}, {"nom_produit": "lait", "unite": "L"}, {"nom_produit": "lait", "unite": "L", "date": day("2024-01-02")})
    average = forecast.forecast_moving_average(series.dense_daily(demand.daily_demand(mv)))
    return sinks.forecast_export(average, sinks.product_units(mv))


def test_runs_are_listed_newest_first_and_rewritten_in_place(spark, export, tmp_path):
    base = str(tmp_path)
    for run in ("20240101_080000", "20240103_080000", "20240102_080000", "20240103_080000"):
        runs.write_run(export, base, "predictions", run, "csv")
    runs.write_run(runs.as_text(runs.summary_lines(spark.createDataFrame([("riz", 1.5)], "nom_produit string, mae double"))),
                   base, "resume", "20240103_080000", "text")
    table = runs.read_table(spark, base, "predictions", "csv", CSV_FORECAST)
    assert table.count() == 3 * 56
    assert table.where("run_id = '20240103_080000'").count() == 56
    history = runs.run_history(spark, base, table).collect()
    assert [r["run_id"] for r in history] == ["20240103_080000", "20240102_080000", "20240101_080000"]
    assert history[0]["nb_txt"] >= 1 and history[0]["nb_produits"] == 2 and history[1]["nb_txt"] == 0
    assert len(runs.run_history(spark, base, table, limit=2).collect()) == 2
    lines = spark.read.text(f"{base}/resume").select("value").collect()
    assert [r[0] for r in lines] == ["riz | mae: 1.5"]


def test_reading_one_run_prunes_the_others(spark, export, tmp_path):
    for run in ("20240101_080000", "20240102_080000"):
        runs.write_run(export, str(tmp_path), "predictions", run, "csv")
    one = runs.read_table(spark, str(tmp_path), "predictions", "csv", CSV_FORECAST).where("run_id = '20240102_080000'")
    assert len(one.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(run_id" in one._jdf.queryExecution().executedPlan().toString()


def test_export_keeps_unit_and_rounds(export):
    row = export.where("produit = 'lait'").orderBy("date").first()
    assert (row["unite"], row["confiance"], row["date"]) == ("L", "85%", day("2024-01-03"))
    assert (row["quantite_prevue"], row["quantite_min"]) == (1.0, 0.85)


def test_run_id_format():
    import datetime as dt

    assert runs.new_run_id(dt.datetime(2025, 11, 12, 10, 47, 13)) == "20251112_104713"
