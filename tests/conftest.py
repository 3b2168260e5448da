from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larder.session import build_session  # noqa: E402
from larder.sources.movements import MOVEMENT_SCHEMA  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


DEFAULTS = {
    "date": dt.date(2024, 1, 1), "id_produit": 1, "nom_produit": "riz", "type_produit": "Aliment",
    "type_operation": "SORTIE", "type_sortie": "CONSOMMATION", "quantite": 1.0, "unite": "kg", "id_lot": 1,
    "id_arrivage": 1, "id_fournisseur": 1, "nom_fournisseur": "A", "date_expiration": dt.date(2024, 1, 5),
    "stock_theorique": 10.0, "temperature_stockage": 4.0, "temperature": 15.0, "taux_occupation": 70.0,
    "nb_patients": 100, "epidemie_grippe": 0, "vacances_scolaires": 0, "jour_ferie": 0, "covid_impact": 0,
}


@pytest.fixture(scope="session")
def make(spark):
    """Movements from partial rows; what a row leaves out takes a default."""

    def build(*rows):
        return spark.createDataFrame([tuple((DEFAULTS | row)[f.name] for f in MOVEMENT_SCHEMA) for row in rows], MOVEMENT_SCHEMA)

    return build


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)
