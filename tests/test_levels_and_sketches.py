"""Waste rates on several levels, and sketches that merge."""

import datetime as dt

from pyspark.sql import functions as F

from larder.operators import quality


def test_levels_of_the_waste_rate(make):
    rows = [
        {"type_produit": "Aliment", "nom_produit": "riz", "type_sortie": "DESTRUCTION", "quantite": 1.0},
        {"type_produit": "Aliment", "nom_produit": "riz", "type_sortie": "CONSOMMATION", "quantite": 3.0},
        {"type_produit": "Aliment", "nom_produit": "lait", "type_sortie": None, "quantite": 9.0},
        {"type_produit": "Aliment", "nom_produit": None, "type_sortie": "DESTRUCTION", "quantite": 2.0},
        {"type_produit": None, "nom_produit": "sel", "type_sortie": "CONSOMMATION", "quantite": 4.0},
    ]
    found = {(r.niveau, r.type_produit, r.nom_produit): (r.quantite_detruite, r.quantite_consommee, r.taux_gaspillage) for r in quality.waste_rate_levels(make(*rows)).collect()}
    assert found == {
        ("total", None, None): (3.0, 7.0, 30.0),
        ("type_produit", "Aliment", None): (3.0, 3.0, 50.0),
        ("nom_produit", "Aliment", "riz"): (1.0, 3.0, 25.0),
        ("nom_produit", "Aliment", "lait"): (0.0, 0.0, None),
    }


def test_levels_take_one_exchange(make):
    df = quality.waste_rate_levels(make({}, {"nom_produit": "lait"}))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1


def test_sketches_of_months_merge_to_those_of_all(make):
    rows = [{"date": dt.date(2024, 1 + i % 6, 1 + i % 28), "id_lot": i % 700, "id_produit": i % 9, "id_fournisseur": None, "id_arrivage": i} for i in range(2000)]
    mv = make(*rows)
    months = quality.distinct_sketches(mv)
    assert months.count() == 6
    whole, exact = quality.merged_counts(months).first(), quality.distinct_counts(mv).first()
    single = quality.merged_counts(quality.distinct_sketches(mv.withColumn("tout", F.lit(1)), ["tout"])).first()
    for name in quality.DISTINCT_COLUMNS:
        assert abs(whole[name] - exact[name]) <= 0.02 * exact[name] and abs(single[name] - exact[name]) <= 0.02 * exact[name]
    # A new month is one more row.
    late = make({"date": dt.date(2024, 9, 1), "id_lot": 100_000, "id_produit": 10_000})
    more = quality.merged_counts(months.unionByName(quality.distinct_sketches(late))).first()
    assert more.nb_produits == exact.nb_produits + 1
    assert {r.mois: r.nb_produits for r in quality.merged_counts(months, ["mois"]).collect()}[dt.date(2024, 1, 1)] == 9 / 3
