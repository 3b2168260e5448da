"""The queries as plain SQL over the same tables, written independently of the Spark plans.

Each text is a chain of named steps, so the SQL below reads top down. Doubles are
rounded to 4 digits as in the catalog.
"""

from __future__ import annotations

import re

from larder.fixed_values import (
    BASE_COLUMNS,
    EVENT_WINDOWS,
    FLAG_REGRESSORS,
    MEAN_REGRESSORS,
    MONTHS,
    MOVEMENT_COLUMNS,
    REGRESSOR_COLUMNS,
    REGRESSORS_BY_CATEGORY,
    SEASON_ADVICE,
    WASTE_ACTIONS,
    WEEKDAYS,
    Z_85,
)
from larder.sources.sample_tables import CHANGEPOINTS, FOCUS_PRODUCT, PUBLIC_HOLIDAYS

# --- shared steps ---------------------------------------------------------------

STEPS: dict[str, str] = {}

STEPS["pat"] = """
  SELECT CAST(o_orderdate AS DATE) AS jour, count(DISTINCT o_custkey) AS nb
  FROM orders GROUP BY 1"""

STEPS["reg"] = f"""
  SELECT jour,
    15e0 - 10e0 * cos(2e0 * pi() * dayofyear(jour) / 365.25e0) AS temperature,
    100e0 * nb / (SELECT max(nb) FROM pat) AS taux_occupation,
    CAST(nb AS INTEGER) AS nb_patients,
    CASE WHEN month(jour) <= 3 AND nb % 2 = 0 THEN 1 ELSE 0 END AS epidemie_grippe,
    CASE WHEN month(jour) IN (7, 8) THEN 1 ELSE 0 END AS vacances_scolaires,
    CASE WHEN month(jour) * 100 + day(jour) IN ({", ".join(map(str, PUBLIC_HOLIDAYS))}) THEN 1 ELSE 0 END AS jour_ferie,
    CASE WHEN jour BETWEEN DATE '1998-03-15' AND DATE '1998-06-15' THEN 1 ELSE 0 END AS covid_impact
  FROM pat"""

STEPS["raw"] = """
  SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS id_produit, p_name AS nom_produit,
    CASE WHEN regexp_matches(p_name, '(gear|gizmo|widget)$') THEN 'Entretien' ELSE 'Aliment' END AS type_produit,
    CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'ENTREE' ELSE 'SORTIE' END AS type_operation,
    CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL
         WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN 'DESTRUCTION' ELSE 'CONSOMMATION' END AS type_sortie,
    CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 5 * l_quantity ELSE l_quantity END AS quantite,
    CASE WHEN p_name LIKE '%bolt' THEN 'L' ELSE 'kg' END AS unite,
    l_orderkey * 8 + l_linenumber AS id_lot, l_orderkey AS id_arrivage,
    l_suppkey AS id_fournisseur, s_name AS nom_fournisseur,
    CAST(l_shipdate AS DATE)
      + CAST(CASE WHEN p_name LIKE '%ring' THEN 3 WHEN p_name LIKE '%rod' THEN 5 WHEN p_name LIKE '%bolt' THEN 8
                  WHEN p_name LIKE '%anvil' THEN 30 ELSE 180 END
             + CASE WHEN l_linenumber = 7 THEN -5 ELSE l_linenumber % 3 - 1 END AS INTEGER) AS date_expiration,
    CASE WHEN regexp_matches(p_name, '(gear|gizmo|widget)$') THEN NULL ELSE p_size / 10e0 END AS temperature_stockage,
    l_extendedprice
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey"""

STEPS["mv"] = f"""
  SELECT raw.date, {", ".join(c for c in BASE_COLUMNS[1:] if c != "stock_theorique")},
    sum(CASE WHEN type_operation = 'ENTREE' THEN quantite ELSE -quantite END) OVER (
      PARTITION BY nom_produit
      ORDER BY raw.date, type_operation, id_lot, id_produit, l_extendedprice, quantite
      ROWS UNBOUNDED PRECEDING) AS stock_theorique,
    {", ".join(REGRESSOR_COLUMNS)}
  FROM raw LEFT JOIN reg ON raw.date = reg.jour"""

STEPS["sorties"] = "SELECT *, date_diff('day', date, date_expiration) AS vie FROM mv WHERE type_operation = 'SORTIE'"
STEPS["aliments"] = "SELECT *, date_diff('day', date, date_expiration) AS vie FROM mv WHERE type_produit = 'Aliment'"

STEPS["jours"] = f"""
  SELECT nom_produit, date, sum(quantite) AS quantite,
    {", ".join(f"avg({c}) AS {c}" for c in MEAN_REGRESSORS)},
    {", ".join(f"max({c}) AS {c}" for c in FLAG_REGRESSORS)}
  FROM mv WHERE type_sortie = 'CONSOMMATION' GROUP BY nom_produit, date"""

STEPS["bornes"] = "SELECT nom_produit, min(date) AS debut, max(date) AS fin, avg(temperature) AS m_t, avg(taux_occupation) AS m_o, avg(nb_patients) AS m_p FROM jours GROUP BY nom_produit"

STEPS["cal"] = """
  SELECT nom_produit, CAST(unnest(generate_series(CAST(debut AS TIMESTAMP), CAST(fin AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS ds
  FROM bornes"""

STEPS["dense"] = f"""
  SELECT cal.nom_produit, cal.ds, coalesce(quantite, 0e0) AS y,
    coalesce(temperature, m_t) AS temperature, coalesce(taux_occupation, m_o) AS taux_occupation,
    coalesce(nb_patients, m_p) AS nb_patients,
    {", ".join(f"coalesce({c}, 0) AS {c}" for c in FLAG_REGRESSORS)}
  FROM cal LEFT JOIN jours ON cal.nom_produit = jours.nom_produit AND cal.ds = jours.date
  JOIN bornes ON cal.nom_produit = bornes.nom_produit"""

STEPS["etendue"] = "SELECT nom_produit, min(ds) AS debut, max(ds) AS fin, count(*) AS n FROM dense GROUP BY nom_produit"

STEPS["futurs"] = """
  SELECT nom_produit, fin + CAST(k AS INTEGER) AS ds FROM etendue, generate_series(1, 28) AS g(k)"""


def _native(suffix: str, train: str, all_rows: str) -> dict[str, str]:
    """Least squares trend, weekday and month means of the residuals, residual deviation."""
    s = suffix
    return {
        f"app{s}": train,
        f"tout{s}": all_rows,
        f"tend{s}": f"""
  SELECT nom_produit, avg(y) AS m,
    CASE WHEN count(*) > 1 THEN regr_slope(y, date_diff('day', debut, ds)) END AS a,
    CASE WHEN count(*) > 1 THEN regr_intercept(y, date_diff('day', debut, ds)) END AS b
  FROM app{s} JOIN etendue USING (nom_produit) GROUP BY nom_produit""",
        f"res{s}": f"""
  SELECT nom_produit, ds, y, coalesce(b + a * date_diff('day', debut, ds), m) AS tendance
  FROM app{s} JOIN etendue USING (nom_produit) JOIN tend{s} USING (nom_produit)""",
        f"sem{s}": f"SELECT nom_produit, isodow(ds) AS j, avg(y - tendance) AS w FROM res{s} GROUP BY 1, 2",
        f"moi{s}": f"""
  SELECT r.nom_produit, month(ds) AS mo, avg(y - tendance - coalesce(w, 0)) AS e
  FROM res{s} r LEFT JOIN sem{s} x ON r.nom_produit = x.nom_produit AND isodow(r.ds) = x.j GROUP BY 1, 2""",
        f"aju{s}": f"""
  SELECT t.nom_produit, t.ds, t.y, t.app,
    coalesce(b + a * date_diff('day', debut, t.ds), m) AS tendance,
    coalesce(w, 0) AS effet_semaine, coalesce(e, 0) AS effet_mois,
    coalesce(b + a * date_diff('day', debut, t.ds), m) + coalesce(w, 0) + coalesce(e, 0) AS yhat
  FROM tout{s} t JOIN etendue USING (nom_produit) JOIN tend{s} USING (nom_produit)
  LEFT JOIN sem{s} x ON t.nom_produit = x.nom_produit AND isodow(t.ds) = x.j
  LEFT JOIN moi{s} z ON t.nom_produit = z.nom_produit AND month(t.ds) = z.mo""",
        f"prev{s}": f"""
  SELECT nom_produit, ds, y, app, yhat, yhat - {Z_85}e0 * coalesce(sigma, 0) AS yhat_lower,
    yhat + {Z_85}e0 * coalesce(sigma, 0) AS yhat_upper
  FROM aju{s} JOIN (SELECT nom_produit, stddev_samp(y - yhat) AS sigma FROM aju{s} WHERE app GROUP BY 1) USING (nom_produit)""",
    }


STEPS |= _native(
    "_f",
    "SELECT nom_produit, ds, y FROM dense",
    "SELECT nom_produit, ds, y, true AS app FROM dense UNION ALL SELECT nom_produit, ds, NULL, false FROM futurs",
)
STEPS |= _native(
    "_t",
    "SELECT d.nom_produit, ds, y FROM dense d JOIN etendue e ON d.nom_produit = e.nom_produit WHERE ds <= fin - 365",
    "SELECT d.nom_produit, ds, y, ds <= fin - 365 AS app FROM dense d JOIN etendue e ON d.nom_produit = e.nom_produit",
)
STEPS["natif"] = "SELECT nom_produit, ds, yhat, yhat_lower, yhat_upper FROM prev_f WHERE NOT app"
STEPS["essai"] = "SELECT nom_produit, ds, y, yhat, yhat_lower, yhat_upper FROM prev_t WHERE NOT app"
STEPS["recents"] = "SELECT nom_produit, avg(y) AS m FROM dense JOIN etendue USING (nom_produit) WHERE date_diff('day', ds, fin) < 30 GROUP BY 1"
STEPS["moyenne"] = """
  SELECT nom_produit, ds, m AS yhat, m * 0.85e0 AS yhat_lower, m * 1.15e0 AS yhat_upper
  FROM futurs JOIN recents USING (nom_produit)"""
STEPS["recents_t"] = """
  SELECT nom_produit, avg(y) AS m FROM dense JOIN etendue USING (nom_produit)
  WHERE ds <= fin - 365 AND date_diff('day', ds, CAST(fin - 365 AS DATE)) < 30 GROUP BY 1"""
STEPS["deux"] = """
  SELECT nom_produit, 'natif' AS modele, y, yhat FROM essai
  UNION ALL
  SELECT nom_produit, 'moyenne_mobile', y, m FROM essai JOIN recents_t USING (nom_produit)"""

METRICS = """count(*) AS nb_jours, avg(abs(y - yhat)) AS mae, avg(abs((y - yhat) / (y + 0.01e0))) * 100 AS mape,
    sqrt(avg((y - yhat) * (y - yhat))) AS rmse, sum(abs(y - yhat)) / nullif(sum(abs(y)), 0) * 100 AS wape"""
STEPS["notes"] = f"SELECT nom_produit, {METRICS} FROM essai GROUP BY nom_produit"

STEPS["stock"] = """
  SELECT v.nom_produit, stock_actuel, duree_vie_moyenne,
    CASE WHEN duree_vie_moyenne < 7 THEN greatest(CAST(trunc(duree_vie_moyenne) AS INTEGER), 0) ELSE 7 END AS horizon
  FROM (SELECT nom_produit, avg(vie) AS duree_vie_moyenne FROM sorties GROUP BY 1) v
  JOIN (SELECT nom_produit, stock_theorique AS stock_actuel FROM sorties
        QUALIFY row_number() OVER (PARTITION BY nom_produit
          ORDER BY date DESC, type_operation DESC, id_lot DESC, id_produit DESC, quantite DESC, stock_theorique DESC) = 1) s
    ON v.nom_produit = s.nom_produit"""


def _orders(suffix: str, forecast: str, stock: str = "stock") -> dict[str, str]:
    return {
        f"besoins{suffix}": f"""
  SELECT nom_produit, stock_actuel, duree_vie_moyenne, horizon,
    coalesce(sum(yhat) FILTER (WHERE rang <= horizon), 0e0) AS besoin,
    coalesce(sum(yhat_lower) FILTER (WHERE rang <= horizon), 0e0) AS besoin_min,
    coalesce(sum(yhat_upper) FILTER (WHERE rang <= horizon), 0e0) AS besoin_max,
    sum(yhat) AS total_prevu, avg(yhat) AS moyenne_jour, min(yhat) AS minimum, max(yhat) AS maximum, max(yhat_upper) AS haut
  FROM (SELECT *, row_number() OVER (PARTITION BY nom_produit ORDER BY ds) AS rang FROM {forecast}) JOIN {stock} USING (nom_produit)
  GROUP BY ALL""",
        f"ordres{suffix}": f"""
  SELECT *, CASE WHEN stock_actuel IS NOT NULL THEN greatest(0e0, besoin - stock_actuel) END AS commande_suggeree,
    CASE WHEN stock_actuel IS NOT NULL THEN greatest(0e0, besoin_min - stock_actuel) END AS commande_min,
    CASE WHEN stock_actuel IS NOT NULL THEN greatest(0e0, besoin_max - stock_actuel) END AS commande_max,
    CASE WHEN moyenne_jour > 0 THEN stock_actuel / moyenne_jour END AS duree_stock_jours,
    duree_vie_moyenne * moyenne_jour AS capacite_consommation,
    CASE WHEN stock_actuel IS NOT NULL THEN greatest(0e0, stock_actuel - duree_vie_moyenne * moyenne_jour) END AS risque_gaspillage,
    moyenne_jour * 7 AS commande_hebdomadaire, haut * 1.2e0 AS stock_securite
  FROM besoins{suffix}""",
        f"conseil{suffix}": f"""
  SELECT *, CASE WHEN stock_actuel IS NULL THEN 'inconnu' WHEN duree_stock_jours < 1 THEN 'critique' WHEN duree_stock_jours < 2 THEN 'faible'
                 WHEN duree_stock_jours IS NOT NULL THEN 'suffisant' END AS statut_stock,
    CASE WHEN risque_gaspillage > 0 THEN risque_gaspillage * 100e0 / stock_actuel END AS pct_risque,
    CASE WHEN risque_gaspillage > 0 THEN '{";".join(WASTE_ACTIONS)}' END AS actions
  FROM ordres{suffix}""",
    }


STEPS |= _orders("_m", "moyenne")
STEPS |= _orders("_n", "natif")
STEPS["stock_lacunaire"] = """
  SELECT * REPLACE (CASE WHEN nom_produit NOT LIKE '%ring' THEN stock_actuel END AS stock_actuel) FROM stock"""
STEPS |= _orders("_u", "moyenne", "stock_lacunaire")

STEPS["resume"] = """
  SELECT nom_produit, j.debut, j.fin, j.nb_jours, j.ecart_type, stock_actuel, duree_vie_moyenne, horizon,
    besoin, besoin_min, besoin_max, total_prevu, moyenne_jour, minimum, maximum,
    commande_suggeree, commande_min, commande_max, duree_stock_jours, capacite_consommation, risque_gaspillage,
    commande_hebdomadaire, stock_securite, statut_stock, pct_risque, actions, mae, mape, rmse,
    moyenne_jour AS consommation_moyenne_jour,
    CASE WHEN mape < 15 THEN 'excellente' WHEN mape < 25 THEN 'bonne' WHEN mape IS NOT NULL THEN 'moyenne' END AS verdict
  FROM conseil_n
  JOIN (SELECT nom_produit, min(date) AS debut, max(date) AS fin,
          CAST(date_diff('day', min(date), max(date)) + 1 AS INTEGER) AS nb_jours, stddev_samp(quantite) AS ecart_type
        FROM jours GROUP BY 1) j USING (nom_produit)
  LEFT JOIN notes USING (nom_produit)"""

# --- queries --------------------------------------------------------------------

ORACLE: dict[str, str] = {}


def _needed(sql: str) -> list[str]:
    """Steps that ``sql`` builds on, in the order they are defined."""
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in STEPS:
            if name not in seen and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                seen.add(name)
                visit(STEPS[name])

    visit(sql)
    return [name for name in STEPS if name in seen]


def oracle(name: str, sql: str, doubles: str = "") -> None:
    steps = ",\n".join(f"{step} AS ({STEPS[step]})" for step in _needed(sql))
    body = f"({sql})"
    if doubles:
        body = f"(SELECT * REPLACE ({', '.join(f'round({c}, 4) + 0e0 AS {c}' for c in doubles.split())}) FROM {body})"
    ORACLE[name] = f"WITH {steps}\nSELECT * FROM {body}" if steps else f"SELECT * FROM {body}"


MEANS = "temperature taux_occupation nb_patients"
_all_doubles = "quantite stock_theorique temperature_stockage temperature taux_occupation"
oracle("scan_movements", f"SELECT {', '.join(MOVEMENT_COLUMNS)} FROM mv", _all_doubles)
oracle("scan_movements_csv", f"SELECT {', '.join(MOVEMENT_COLUMNS)} FROM mv", _all_doubles)

_base_columns = [c for c in MOVEMENT_COLUMNS if c not in ("type_sortie", *REGRESSOR_COLUMNS)]
oracle("scan_movements_base", f"SELECT {', '.join(_base_columns)}, 'L' || id_lot AS numero_lot FROM mv", "quantite stock_theorique temperature_stockage")

# The broken files: lots divisible by 97 have a date in another notation, by 89 none, by 83 a quantity in words, by 79 a
# supplier number with a letter; lines of lots divisible by 73 are cut short, by 71 have a column too many.
STEPS["lignes"] = """
  SELECT *, concat_ws(',',
      CASE WHEN id_lot % 97 = 0 THEN strftime(date, '%d/%m/%Y') WHEN id_lot % 89 <> 0 THEN CAST(date AS VARCHAR) ELSE '' END,
      type_operation, id_lot, 'L' || id_lot, id_produit, nom_produit, type_produit, unite,
      CASE WHEN id_lot % 83 = 0 THEN 'douze' ELSE CAST(quantite AS VARCHAR) END) AS debut_ligne,
    concat_ws(',', CAST(stock_theorique AS VARCHAR), coalesce(CAST(temperature_stockage AS VARCHAR), ''), CAST(date_expiration AS VARCHAR),
      CASE WHEN id_lot % 79 = 0 THEN 'F' ELSE '' END || id_fournisseur, nom_fournisseur, id_arrivage) AS fin_ligne,
    id_lot % 73 = 0 AS courte, id_lot % 73 <> 0 AND id_lot % 71 = 0 AS longue,
    id_lot % 97 = 0 AS f1, id_lot % 83 = 0 AS f2, id_lot % 79 = 0 AND id_lot % 73 <> 0 AS f3, id_lot % 97 <> 0 AND id_lot % 89 = 0 AS vide
  FROM mv"""
STEPS["rebuts"] = """
  SELECT type_operation AS fichier, debut_ligne || CASE WHEN courte THEN '' ELSE ',' || fin_ligne END || CASE WHEN longue THEN ',surplus' ELSE '' END AS ligne,
    CASE WHEN f1 OR f2 OR f3 THEN 'valeur illisible' WHEN courte OR longue THEN 'nombre de colonnes' ELSE 'valeur obligatoire absente' END AS motif,
    CASE WHEN f1 OR f2 OR f3 THEN concat_ws('; ', CASE WHEN f1 THEN 'date' END, CASE WHEN f2 THEN 'quantite' END, CASE WHEN f3 THEN 'id_fournisseur' END)
         WHEN courte OR longue THEN '' ELSE 'date' END AS colonnes,
    CASE WHEN f1 OR f2 OR f3 THEN concat_ws('; ', CASE WHEN f1 THEN strftime(date, '%d/%m/%Y') END, CASE WHEN f2 THEN 'douze' END, CASE WHEN f3 THEN 'F' || id_fournisseur END)
         ELSE '' END AS valeurs
  FROM lignes WHERE courte OR longue OR f1 OR f2 OR f3 OR vide"""
oracle("scan_movements_rejects", f"SELECT {', '.join(_base_columns)}, 'L' || id_lot AS numero_lot FROM lignes WHERE NOT (courte OR longue OR f1 OR f2 OR f3 OR vide)",
       "quantite stock_theorique temperature_stockage")
oracle("movement_rejects", "SELECT * FROM rebuts")
oracle("movement_reject_counts", "SELECT motif, colonnes, count(*) AS nb_lignes, count(DISTINCT fichier) AS nb_fichiers FROM rebuts GROUP BY ALL")

# First in, first out as a range join of running totals.
for _name, _test in (("recus", "="), ("tires", "<>")):
    STEPS[_name] = f"""
  SELECT nom_produit, date, id_lot, date_expiration, fin - quantite AS debut, fin FROM (
    SELECT *, sum(quantite) OVER (PARTITION BY nom_produit ORDER BY raw.date, id_lot, id_produit, quantite, date_expiration ROWS UNBOUNDED PRECEDING) AS fin
    FROM raw WHERE type_operation {_test} 'ENTREE' AND quantite > 0)"""
STEPS["tirages"] = """
  SELECT t.nom_produit, t.fin AS rang_sortie, t.date AS date_sortie, t.id_lot AS lot_sortie, t.date_expiration AS expiration_sortie,
    r.fin AS rang_entree, r.date AS date_entree, r.id_lot AS lot_entree, r.date_expiration AS expiration_entree,
    least(t.fin, r.fin) - greatest(t.debut, r.debut) AS quantite
  FROM tires t JOIN recus r ON t.nom_produit = r.nom_produit AND r.debut < t.fin AND t.debut < r.fin
  UNION ALL
  SELECT nom_produit, fin, date, id_lot, date_expiration, NULL, NULL, NULL, NULL, fin - greatest(debut, recu)
  FROM tires JOIN (SELECT p.nom_produit, coalesce(max(r.fin), 0) AS recu FROM (SELECT DISTINCT nom_produit FROM tires) p LEFT JOIN recus r ON p.nom_produit = r.nom_produit GROUP BY 1)
    USING (nom_produit) WHERE fin > recu"""
STEPS["constats"] = """
  SELECT *, CASE WHEN rang_entree IS NULL THEN 'sans_lot' WHEN date_entree > date_sortie THEN 'avant_arrivage'
    WHEN expiration_entree < date_sortie THEN 'lot_perime' WHEN expiration_sortie > expiration_entree THEN 'lot_plus_recent' ELSE 'conforme' END AS constat
  FROM tirages"""
oracle("fifo_allocation", "SELECT * FROM tirages", "rang_sortie rang_entree quantite")
oracle("fifo_violations", """
  SELECT nom_produit, constat, nb_affectations, nb_sorties, quantite, quantite * 100 / total AS pct_quantite FROM (
    SELECT nom_produit, constat, count(*) AS nb_affectations, count(DISTINCT rang_sortie) AS nb_sorties, sum(quantite) AS quantite,
      sum(sum(quantite)) OVER (PARTITION BY nom_produit) AS total FROM constats GROUP BY nom_produit, constat) WHERE constat <> 'conforme'""",
       "quantite pct_quantite")

oracle("parse_dates", " UNION ALL ".join(
    f"SELECT '{c}' AS colonne, count({c}) AS nb_valeurs, count({c}) FILTER (WHERE id_lot % {n} <> 0) AS nb_dates, "
    f"count({c}) FILTER (WHERE id_lot % {n} = 0) AS nb_rejets, min({c}) FILTER (WHERE id_lot % {n} <> 0) AS premiere_date, "
    f"max({c}) FILTER (WHERE id_lot % {n} <> 0) AS derniere_date FROM mv" for c, n in (("date", 97), ("date_expiration", 89))))

oracle("schema_check", " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS colonne, '{'base' if c in BASE_COLUMNS else 'regresseur'}' AS groupe, "
    f"{'false' if c in ('temperature_stockage', 'covid_impact') else 'true'} AS presente" for i, c in enumerate(MOVEMENT_COLUMNS, 1))
    + " UNION ALL SELECT CAST(23 AS INTEGER), 'commentaire', 'inattendue', true")

oracle("profile_shape", "SELECT count(*) AS nb_lignes, CAST(22 AS INTEGER) AS nb_colonnes FROM mv")

_types = dict.fromkeys(MOVEMENT_COLUMNS, "string")
_types |= dict.fromkeys(["date", "date_expiration"], "date")
_types |= dict.fromkeys(["id_produit", "id_lot", "id_arrivage", "id_fournisseur"], "bigint")
_types |= dict.fromkeys(["quantite", "stock_theorique", "temperature_stockage", "temperature", "taux_occupation"], "double")
_types |= dict.fromkeys(["nb_patients", *FLAG_REGRESSORS], "int")
oracle("profile_info", " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS colonne, '{_types[c]}' AS type, count({c}) AS nb_non_nuls FROM mv"
    for i, c in enumerate(MOVEMENT_COLUMNS, 1)))

oracle("profile_describe", " UNION ALL ".join(
    f"SELECT '{c}' AS colonne, count({c}) AS nb, avg({c}) AS moyenne, stddev_samp({c}) AS ecart_type, "
    f"CAST(min({c}) AS DOUBLE) AS minimum, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, "
    f"CAST(max({c}) AS DOUBLE) AS maximum FROM mv"
    for c in MOVEMENT_COLUMNS if _types[c] in ("bigint", "double", "int")),
    "moyenne ecart_type minimum q25 q50 q75 maximum")

oracle("missing_values", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS colonne, count(*) - count({c}) AS nb_manquants, "
    f"round_even((count(*) - count({c})) * 100e0 / count(*), 2) AS pct_manquants FROM mv" for c in MOVEMENT_COLUMNS)
    + ") WHERE nb_manquants > 0")

oracle("period_span", """
  SELECT min(date) AS debut, max(date) AS fin, CAST(date_diff('day', min(date), max(date)) AS INTEGER) AS nb_jours,
    date_diff('day', min(date), max(date)) / 365e0 AS nb_annees FROM mv""", "nb_annees")

oracle("dq_counts", """
  SELECT count(*) FILTER (WHERE quantite < 0) AS nb_quantites_negatives,
    count(*) FILTER (WHERE stock_theorique < 0) AS nb_stocks_negatifs,
    count(*) FILTER (WHERE date_expiration < date) AS nb_perimes FROM mv""")

oracle("expired_use", """
  SELECT nom_produit, count(*) AS nb_lignes, count(*) FILTER (WHERE date_expiration < date) AS nb_perimes,
    count(*) FILTER (WHERE date_expiration < date) * 100e0 / count(*) AS pct_perimes
  FROM mv GROUP BY 1 HAVING count(*) FILTER (WHERE date_expiration < date) > 0""", "pct_perimes")

oracle("expired_rows", """
  SELECT nom_produit, date, date_expiration, id_lot, id_produit, quantite FROM mv WHERE date_expiration < date""")

for _name, _col in (("value_counts_operation", "type_operation"), ("value_counts_type", "type_produit")):
    oracle(_name, f"SELECT {_col}, count(*) AS nb_lignes FROM mv WHERE {_col} IS NOT NULL GROUP BY 1")

oracle("distinct_counts", """
  SELECT count(DISTINCT id_produit) AS nb_produits, count(DISTINCT id_lot) AS nb_lots,
    count(DISTINCT id_fournisseur) AS nb_fournisseurs, count(DISTINCT id_arrivage) AS nb_arrivages FROM mv""")

oracle("regressor_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS regresseur, avg({c}) AS moyenne, CAST(min({c}) AS DOUBLE) AS minimum, CAST(max({c}) AS DOUBLE) AS maximum FROM mv"
    for c in MEAN_REGRESSORS), "moyenne minimum maximum")

_years = "(SELECT date_diff('day', min(date), max(date)) / 365e0 FROM mv)"
oracle("event_flag_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS indicateur, CAST(sum({c}) AS BIGINT) AS nb_lignes, sum({c}) * 100e0 / count(*) AS pct_lignes, "
    f"count(DISTINCT date) FILTER (WHERE {c} = 1) AS nb_jours, CAST(sum({c}) AS DOUBLE) / {_years} AS lignes_par_an, "
    f"count(DISTINCT date) FILTER (WHERE {c} = 1) / {_years} AS jours_par_an, sum({c}) / 30e0 AS mois_cumules_lignes, "
    f"count(DISTINCT date) FILTER (WHERE {c} = 1) / 30e0 AS mois_cumules_jours FROM mv" for c in FLAG_REGRESSORS),
    "pct_lignes lignes_par_an jours_par_an mois_cumules_lignes mois_cumules_jours")

oracle("split_regressor_coverage", """
  SELECT nom_produit, count(*) AS nb_test, count(temperature) AS nb_temperature, count(taux_occupation) AS nb_taux_occupation,
    count(nb_patients) AS nb_nb_patients, count(epidemie_grippe) AS nb_epidemie_grippe
  FROM dense JOIN etendue USING (nom_produit) WHERE ds > fin - 365 GROUP BY 1""")

oracle("product_names", "SELECT DISTINCT nom_produit FROM sorties ORDER BY 1 LIMIT 10")
oracle("product_names_all", "SELECT DISTINCT nom_produit FROM mv")

oracle("operation_shares", """
  SELECT type_operation, type_sortie, count(*) AS nb_lignes,
    count(*) * 100e0 / (SELECT count(*) FROM mv) AS pct_total,
    count(*) * 100e0 / sum(count(*)) OVER (PARTITION BY type_operation) AS pct_operation
  FROM mv GROUP BY 1, 2""", "pct_total pct_operation")

_waste = """
    coalesce(sum(quantite) FILTER (WHERE type_sortie = 'DESTRUCTION'), 0e0) AS quantite_detruite,
    coalesce(sum(quantite) FILTER (WHERE type_sortie = 'CONSOMMATION'), 0e0) AS quantite_consommee,
    sum(quantite) FILTER (WHERE type_sortie = 'DESTRUCTION') * 100e0
      / sum(quantite) FILTER (WHERE type_sortie IN ('DESTRUCTION', 'CONSOMMATION')) AS taux_gaspillage"""
oracle("waste_rate", f"SELECT {_waste} FROM mv", "taux_gaspillage")
oracle("waste_rate_by_product", f"SELECT nom_produit, {_waste} FROM mv GROUP BY 1", "taux_gaspillage")

oracle("calendar_features", """
  SELECT id_lot, id_produit, date, CAST(year(date) AS INTEGER) AS annee, CAST(month(date) AS INTEGER) AS mois,
    CAST(day(date) AS INTEGER) AS jour_mois, CAST(isodow(date) - 1 AS INTEGER) AS jour_semaine, dayname(date) AS nom_jour,
    CAST(weekofyear(date) AS INTEGER) AS semaine FROM mv""")
oracle("shelf_life", """
  SELECT id_lot, id_produit, date, date_expiration, CAST(date_diff('day', date, date_expiration) AS INTEGER) AS duree_vie_jours FROM mv""")

_class = "CASE WHEN avg(vie) < 3 THEN 'critique' WHEN avg(vie) < 7 THEN 'attention' ELSE 'stable' END"
oracle("perishability_class", f"SELECT nom_produit, round_even(avg(vie), 2) AS duree_moyenne, {_class} AS classe FROM aliments GROUP BY 1")
oracle("season_flags", """
  SELECT id_lot, id_produit, date, month(date) IN (12, 1, 2) AS saison_froide, isodow(date) >= 6 AS week_end FROM mv""")
oracle("product_slug", """
  SELECT DISTINCT nom_produit, lower(replace(nom_produit, ' ', '_')) AS slug, replace(nom_produit, ' ', '_') AS slug_casse FROM mv""")

oracle("outgoing", "SELECT nom_produit, date, type_operation, quantite, id_lot, unite FROM mv WHERE type_operation = 'SORTIE'")
oracle("food_only", "SELECT nom_produit, type_produit, date, date_expiration, id_lot, quantite FROM mv WHERE type_produit = 'Aliment'")
oracle("product_focus", f"""
  SELECT nom_produit, date, type_operation, quantite, id_lot FROM mv
  WHERE type_operation = 'SORTIE' AND nom_produit = '{FOCUS_PRODUCT}'""")
oracle("consumption_only", "SELECT nom_produit, date, type_sortie, quantite, id_lot FROM mv WHERE type_sortie = 'CONSOMMATION'")

_shelf = f"""
  SELECT nom_produit, round_even(avg(vie), 2) AS duree_moyenne, CAST(min(vie) AS INTEGER) AS duree_min,
    CAST(max(vie) AS INTEGER) AS duree_max, {_class} AS classe FROM aliments GROUP BY 1"""
oracle("shelf_life_by_product", _shelf)
oracle("perishable_products", f"SELECT * FROM ({_shelf}) WHERE duree_moyenne < 7")
oracle("most_perishable", f"""
  SELECT nom_produit, avg(vie) AS duree_moyenne, {_class} AS classe FROM aliments GROUP BY 1
  ORDER BY 2, 1 LIMIT 10""", "duree_moyenne")

oracle("top_products", """
  SELECT nom_produit, type_produit, unite, sum(quantite) AS volume_total, count(id_lot) AS nb_sorties
  FROM sorties GROUP BY 1, 2, 3 ORDER BY volume_total DESC, 1, 2, 3 LIMIT 10""")
oracle("top_products_by_name", """
  SELECT nom_produit, sum(quantite) AS volume_total, count(id_lot) AS nb_sorties
  FROM sorties GROUP BY 1 ORDER BY volume_total DESC, 1 LIMIT 10""")

_months = """
  SELECT CAST(date_trunc('month', date) AS DATE) AS mois, sum(quantite) AS volume_total, count(id_lot) AS nb_sorties
  FROM sorties GROUP BY 1"""
oracle("monthly_volume", _months)
oracle("monthly_volume_first_year", _months + " ORDER BY 1 LIMIT 12")

STEPS["mensuel"] = """
  SELECT CAST(month(date) AS INTEGER) AS mois, avg(quantite) AS brute, round_even(avg(quantite), 2) AS moyenne,
    round_even(sum(quantite), 2) AS total, round_even(stddev_samp(quantite), 2) AS ecart FROM sorties GROUP BY 1"""
oracle("month_seasonality", f"""
  SELECT m.mois, libelle, moyenne AS moyenne_quotidienne, total AS total_mensuel, ecart AS ecart_type,
    m.mois IN (12, 1, 2) AS saison_froide
  FROM mensuel m JOIN (VALUES {", ".join(f"({n}, '{label}')" for n, label in MONTHS)}) AS l(mois, libelle) ON m.mois = l.mois""")
oracle("seasonal_extremes", """
  SELECT h.mois AS mois_max, h.moyenne AS moyenne_max, b.mois AS mois_min, b.moyenne AS moyenne_min,
    (h.moyenne - b.moyenne) * 100e0 / b.moyenne AS variation_pct
  FROM (SELECT mois, moyenne FROM mensuel ORDER BY moyenne DESC, mois LIMIT 1) h,
       (SELECT mois, moyenne FROM mensuel ORDER BY moyenne, mois LIMIT 1) b""", "variation_pct")
oracle("annual_mean_line", "SELECT avg(brute) AS moyenne_annuelle FROM mensuel", "moyenne_annuelle")

STEPS["hebdo"] = f"""
  SELECT l.jour_semaine, l.nom_jour, l.libelle, s.moyenne
  FROM (VALUES {", ".join(f"({n}, '{en}', '{fr}')" for n, en, fr in WEEKDAYS)}) AS l(jour_semaine, nom_jour, libelle)
  LEFT JOIN (SELECT dayname(date) AS nom, round_even(avg(quantite), 2) AS moyenne FROM sorties GROUP BY 1) s
    ON l.nom_jour = s.nom"""
oracle("weekday_pattern", """
  SELECT CAST(jour_semaine AS INTEGER) AS jour_semaine, nom_jour, libelle, moyenne, jour_semaine >= 5 AS week_end FROM hebdo""")
oracle("weekend_gap", """
  SELECT s AS moyenne_semaine, w AS moyenne_week_end, (w - s) * 100e0 / s AS ecart_pct
  FROM (SELECT avg(moyenne) FILTER (WHERE jour_semaine < 5) AS s, avg(moyenne) FILTER (WHERE jour_semaine >= 5) AS w FROM hebdo)""",
    "moyenne_semaine moyenne_week_end ecart_pct")

_suppliers = """
  SELECT nom_fournisseur, count(DISTINCT id_arrivage) AS nb_arrivages, sum(quantite) AS volume_total,
    count(DISTINCT id_produit) AS nb_produits_fournis FROM mv GROUP BY 1"""
oracle("supplier_performance", _suppliers)
oracle("top_suppliers", _suppliers + " ORDER BY 2 DESC, 1 LIMIT 3")
oracle("supplier_volume_by_unit", "SELECT nom_fournisseur, unite, sum(quantite) AS volume_total FROM mv GROUP BY 1, 2")

oracle("product_card", """
  SELECT nom_produit, count(*) AS nb_sorties, min(date) AS debut, max(date) AS fin, sum(quantite) AS volume_total,
    avg(quantite) AS moyenne_sortie, avg(vie) AS duree_vie_moyenne FROM sorties GROUP BY 1""",
    "moyenne_sortie duree_vie_moyenne")
oracle("daily_demand", "SELECT nom_produit, date, quantite FROM jours")
oracle("daily_stats", """
  SELECT nom_produit, avg(quantite) AS moyenne, median(quantite) AS mediane, min(quantite) AS minimum,
    max(quantite) AS maximum, stddev_samp(quantite) AS ecart_type FROM jours GROUP BY 1""", "moyenne mediane ecart_type")
oracle("daily_demand_outgoing", "SELECT nom_produit, date, sum(quantite) AS quantite FROM sorties GROUP BY 1, 2")
oracle("daily_stats_outgoing", """
  SELECT nom_produit, avg(q) AS moyenne, median(q) AS mediane, min(q) AS minimum, max(q) AS maximum, stddev_samp(q) AS ecart_type
  FROM (SELECT nom_produit, date, sum(quantite) AS q FROM sorties GROUP BY 1, 2) GROUP BY 1""", "moyenne mediane ecart_type")
oracle("daily_with_regressors", f"SELECT nom_produit, date, quantite, {', '.join(REGRESSOR_COLUMNS)} FROM jours", MEANS)
oracle("moving_avg", """
  SELECT nom_produit, date, quantite,
    avg(quantite) OVER (PARTITION BY nom_produit ORDER BY date ROWS 6 PRECEDING) AS ma7,
    avg(quantite) OVER (PARTITION BY nom_produit ORDER BY date ROWS 29 PRECEDING) AS ma30 FROM jours""", "ma7 ma30")
oracle("dense_daily", "SELECT nom_produit, ds, y FROM dense")
oracle("dense_daily_regressors", f"SELECT nom_produit, ds, y, {', '.join(REGRESSOR_COLUMNS)} FROM dense", MEANS)
oracle("active_days", """
  SELECT nom_produit, count(*) FILTER (WHERE y > 0) AS jours_avec, count(*) FILTER (WHERE y = 0) AS jours_sans FROM dense GROUP BY 1""")
oracle("last_30_days", """
  SELECT nom_produit, ds, y, avg(y) OVER (PARTITION BY nom_produit) AS moyenne_recente
  FROM (SELECT nom_produit, ds, y FROM dense QUALIFY row_number() OVER (PARTITION BY nom_produit ORDER BY ds DESC) <= 30)""",
    "moyenne_recente")

STEPS["fetes"] = """
  SELECT nom_produit, ds, 'jour_ferie' AS holiday FROM dense WHERE jour_ferie = 1
  UNION ALL SELECT nom_produit, ds, 'vacances_scolaires' FROM dense WHERE vacances_scolaires = 1
  UNION ALL SELECT nom_produit, ds, 'covid_19' FROM dense WHERE covid_impact = 1"""
oracle("holidays", "SELECT nom_produit, ds, holiday, CAST(0 AS INTEGER) AS lower_window, CAST(0 AS INTEGER) AS upper_window FROM fetes")
oracle("holiday_calendar", """
  SELECT ds, holiday, CAST(0 AS INTEGER) AS lower_window, CAST(0 AS INTEGER) AS upper_window FROM (
    SELECT DISTINCT date AS ds, 'jour_ferie' AS holiday FROM mv WHERE jour_ferie = 1
    UNION ALL SELECT DISTINCT date, 'vacances_scolaires' FROM mv WHERE vacances_scolaires = 1
    UNION ALL SELECT DISTINCT date, 'covid_19' FROM mv WHERE covid_impact = 1)""")
_windows = ", ".join(f"('{label}', {first}, {last})" for label, first, last in EVENT_WINDOWS)
oracle("holiday_offsets", f"""
  SELECT nom_produit, ds, holiday, CAST(ecart AS INTEGER) AS "offset" FROM (
    SELECT f.nom_produit, CAST(f.ds + CAST(k AS INTEGER) AS DATE) AS ds, f.holiday, k AS ecart,
      row_number() OVER (PARTITION BY f.nom_produit, f.ds + CAST(k AS INTEGER), f.holiday ORDER BY abs(k), k DESC) AS rang
    FROM fetes f JOIN (VALUES {_windows}) AS w(holiday, premier, dernier) USING (holiday), generate_series(-9, 9) AS g(k)
    WHERE k BETWEEN premier AND dernier) JOIN etendue USING (nom_produit)
  WHERE rang = 1 AND ds BETWEEN debut AND fin""")
oracle("holiday_counts", "SELECT nom_produit, holiday, count(*) AS nb_jours FROM fetes GROUP BY 1, 2")

_known = f"(VALUES {', '.join(f'(DATE {chr(39)}{d}{chr(39)})' for d in CHANGEPOINTS)}) AS c(changepoint)"
oracle("changepoints", f"SELECT nom_produit, changepoint FROM etendue, {_known} WHERE changepoint > debut AND changepoint <= fin")
oracle("auto_changepoints", """
  SELECT nom_produit, CAST(k AS INTEGER) AS rang,
    debut + CAST(round_even(CAST(k * (tete - 1) AS DOUBLE) / least(25, tete - 1), 0) AS INTEGER) AS changepoint
  FROM (SELECT nom_produit, debut, CAST(floor(n * 0.9e0) AS BIGINT) AS tete FROM etendue), generate_series(1, 25) AS g(k)
  WHERE k <= least(25, tete - 1)""")


def _split(boundary: str) -> str:
    return f"""
  SELECT nom_produit, coupure AS date_coupure, count(*) FILTER (WHERE ds <= coupure) AS nb_apprentissage,
    count(*) FILTER (WHERE ds > coupure) AS nb_test,
    min(ds) FILTER (WHERE ds <= coupure) AS debut_apprentissage, max(ds) FILTER (WHERE ds <= coupure) AS fin_apprentissage,
    min(ds) FILTER (WHERE ds > coupure) AS debut_test, max(ds) FILTER (WHERE ds > coupure) AS fin_test,
    count(*) FILTER (WHERE ds <= coupure) * 100e0 / count(*) AS pct_apprentissage
  FROM dense JOIN (SELECT nom_produit, CAST({boundary} AS DATE) AS coupure FROM etendue) USING (nom_produit) GROUP BY 1, 2"""


oracle("split_80_20", _split("fin - CAST(trunc(n * 0.2e0) AS INTEGER)"), "pct_apprentissage")
oracle("split_365", _split("fin - 365"), "pct_apprentissage")

_future_flags = "CASE WHEN month(ds) <= 3 THEN 1 ELSE 0 END AS epidemie_grippe, 0 AS vacances_scolaires, 0 AS jour_ferie, 0 AS covid_impact"
STEPS["moyennes"] = "SELECT nom_produit, avg(temperature) AS t, avg(taux_occupation) AS o, avg(nb_patients) AS p FROM dense GROUP BY 1"
oracle("future_frame", f"""
  SELECT nom_produit, ds, y, false AS futur, {", ".join(REGRESSOR_COLUMNS)} FROM dense
  UNION ALL
  SELECT nom_produit, ds, NULL, true, t, o, p, {_future_flags} FROM futurs JOIN moyennes USING (nom_produit)""", "y " + MEANS)
oracle("future_regressors_monthly", f"""
  SELECT f.nom_produit, f.ds, CAST(NULL AS DOUBLE) AS y, true AS futur, coalesce(x.tm, t) AS temperature,
    o AS taux_occupation, p AS nb_patients, {_future_flags.replace("month(ds)", "month(f.ds)")}
  FROM futurs f JOIN moyennes USING (nom_produit)
  LEFT JOIN (SELECT nom_produit, month(ds) AS mo, avg(temperature) AS tm FROM dense GROUP BY 1, 2) x
    ON f.nom_produit = x.nom_produit AND month(f.ds) = x.mo""", MEANS)

_waves = {
    f"{name}_{fn}{k}": f"{fn}({2 * k}e0 * pi() * n / {period}e0)"
    for name, order, period in (("annuel", 20, 365.25), ("hebdo", 5, 7.0))
    for k in range(1, order + 1) for fn in ("sin", "cos")
}
oracle("fourier_features", f"""
  SELECT date, {", ".join(f"{expr} AS {name}" for name, expr in _waves.items())}
  FROM (SELECT DISTINCT date, date_diff('day', DATE '1970-01-01', date) AS n FROM mv)""", " ".join(_waves))

_hinges = ", ".join(
    f"CAST(CASE WHEN DATE '{c}' > debut AND DATE '{c}' <= fin THEN greatest(0, date_diff('day', DATE '{c}', ds)) ELSE 0 END AS INTEGER) AS rupture_{i}"
    for i, c in enumerate(CHANGEPOINTS, 1))
oracle("trend_features", f"""
  SELECT nom_produit, ds, CAST(date_diff('day', debut, ds) AS INTEGER) AS t, {_hinges} FROM dense JOIN etendue USING (nom_produit)""")

_z = ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END AS {c}_z" for c in MEAN_REGRESSORS)
oracle("standardized_regressors", f"""
  SELECT nom_produit, ds, ds <= fin - 365 AS apprentissage, {_z}, CAST(epidemie_grippe AS DOUBLE) AS epidemie_grippe_z
  FROM dense JOIN etendue USING (nom_produit)
  JOIN (SELECT nom_produit, {", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in MEAN_REGRESSORS)}
        FROM dense JOIN etendue USING (nom_produit) WHERE ds <= fin - 365 GROUP BY 1) USING (nom_produit)""",
    " ".join(f"{c}_z" for c in [*MEAN_REGRESSORS, "epidemie_grippe"]))

_rules = ", ".join(f"('{cat}', '{r}')" for cat, rs in REGRESSORS_BY_CATEGORY.items() for r in rs)
oracle("regressor_choice", f"""
  SELECT nom_produit, categorie, regresseur FROM (
    SELECT nom_produit, CASE WHEN type_produit = 'Entretien' THEN 'entretien'
      WHEN avg(date_diff('day', date, date_expiration)) < 3 THEN 'ultra_perissable'
      WHEN avg(date_diff('day', date, date_expiration)) < 7 THEN 'legumes_fruits' ELSE 'stable' END AS categorie
    FROM mv GROUP BY nom_produit, type_produit) JOIN (VALUES {_rules}) AS r(categorie, regresseur) USING (categorie)""")

_bands = "yhat yhat_lower yhat_upper"
oracle("forecast_native", "SELECT * FROM natif", _bands)
oracle("forecast_moving_average", "SELECT * FROM moyenne", _bands)
_totals = """
  SELECT nom_produit, sum(yhat) AS total_prevu, avg(yhat) AS moyenne_jour, min(yhat) AS minimum, max(yhat) AS maximum,
    stddev_samp(yhat) AS ecart_type, sum(yhat_lower) AS scenario_bas, sum(yhat_upper) AS scenario_haut"""
_total_columns = "total_prevu moyenne_jour minimum maximum ecart_type scenario_bas scenario_haut"
oracle("forecast_summary", f"{_totals} FROM natif GROUP BY 1", _total_columns)
oracle("history_and_forecast", """
  SELECT nom_produit, ds, 'historique' AS nature, y AS valeur, CAST(NULL AS DOUBLE) AS yhat_lower, CAST(NULL AS DOUBLE) AS yhat_upper
  FROM dense QUALIFY row_number() OVER (PARTITION BY nom_produit ORDER BY ds DESC) <= 30
  UNION ALL SELECT nom_produit, ds, 'prevision', yhat, yhat_lower, yhat_upper FROM natif""", "valeur yhat_lower yhat_upper")
oracle("backtest_join", "SELECT nom_produit, ds, y, yhat, yhat_lower, yhat_upper FROM essai", _bands)
oracle("forecast_metrics", "SELECT * FROM notes", "mae mape rmse wape")


def _verdict(col: str) -> str:
    return f"CASE WHEN {col} < 15 THEN 'excellente' WHEN {col} < 25 THEN 'bonne' WHEN {col} IS NOT NULL THEN 'moyenne' END"


oracle("forecast_verdict", f"""
  SELECT nom_produit, mape, wape, {_verdict("mape")} AS verdict, {_verdict("wape")} AS verdict_wape FROM notes""", "mape wape")
oracle("model_comparison", f"""
  SELECT *, CAST(row_number() OVER (PARTITION BY nom_produit ORDER BY round(mae, 6), modele) AS INTEGER) AS rang
  FROM (SELECT nom_produit, modele, {METRICS} FROM deux GROUP BY 1, 2)""", "mae mape rmse wape")

oracle("current_stock", "SELECT nom_produit, stock_actuel FROM stock")
oracle("order_horizon", "SELECT nom_produit, duree_vie_moyenne, horizon FROM stock", "duree_vie_moyenne")
_order_columns = "nom_produit, stock_actuel, duree_vie_moyenne, horizon, besoin, besoin_min, besoin_max, commande_suggeree, commande_min, commande_max"
_order_doubles = "duree_vie_moyenne besoin besoin_min besoin_max commande_suggeree commande_min commande_max"
oracle("order_recommendation", f"SELECT {_order_columns} FROM conseil_m", _order_doubles)
oracle("order_recommendation_native", f"SELECT {_order_columns} FROM conseil_n", _order_doubles)
oracle("stock_unknown", """
  SELECT nom_produit, stock_actuel, besoin, commande_suggeree, duree_stock_jours, risque_gaspillage, pct_risque, statut_stock, actions
  FROM conseil_u""", "besoin commande_suggeree duree_stock_jours risque_gaspillage pct_risque")
STEPS["pentes"] = """
  SELECT nom_produit, year(ds) AS an, regr_slope(y, dayofyear(ds) - 1) AS pente, count(*) AS nb FROM dense GROUP BY ALL HAVING count(*) >= 180"""
STEPS["elan"] = """
  SELECT nom_produit, count(pas) / sum(nb) AS rythme, coalesce(avg(abs(pas)), 0) AS taille
  FROM (SELECT *, pente - lag(pente) OVER (PARTITION BY nom_produit ORDER BY an) AS pas FROM pentes) GROUP BY nom_produit"""
oracle("forecast_native_widening", f"""
  SELECT nom_produit, ds, yhat, yhat - demi AS yhat_lower, yhat + demi AS yhat_upper FROM (
    SELECT n.nom_produit, ds, yhat, sqrt(power((yhat_upper - yhat_lower) / 2, 2)
      + {Z_85 * Z_85}e0 * coalesce(rythme, 0) * 2 * coalesce(taille * taille, 0) * power(date_diff('day', fin, ds), 3) / 3) AS demi
    FROM natif n JOIN etendue e ON n.nom_produit = e.nom_produit LEFT JOIN elan l ON n.nom_produit = l.nom_produit)""", "yhat yhat_lower yhat_upper")
oracle("distinct_counts_sketch", """
  SELECT count(DISTINCT id_produit) AS nb_produits, true AS nb_produits_proche, count(DISTINCT id_lot) AS nb_lots, true AS nb_lots_proche,
    count(DISTINCT id_fournisseur) AS nb_fournisseurs, true AS nb_fournisseurs_proche,
    count(DISTINCT id_arrivage) AS nb_arrivages, true AS nb_arrivages_proche FROM mv""")
oracle("waste_rate_levels", """
  SELECT *, quantite_detruite * 100 / (quantite_detruite + quantite_consommee) AS taux_gaspillage FROM (
    SELECT CASE WHEN GROUPING(nom_produit) = 0 THEN 'nom_produit' WHEN GROUPING(type_produit) = 0 THEN 'type_produit' ELSE 'total' END AS niveau,
      type_produit, nom_produit, coalesce(sum(quantite) FILTER (WHERE type_sortie = 'DESTRUCTION'), 0) AS quantite_detruite,
      coalesce(sum(quantite) FILTER (WHERE type_sortie = 'CONSOMMATION'), 0) AS quantite_consommee
    FROM mv GROUP BY ROLLUP (type_produit, nom_produit))""", "quantite_detruite quantite_consommee taux_gaspillage")
oracle("fit_optimality", """
  SELECT nom_produit, modele, true AS optimal, true AS converge FROM etendue,
    (VALUES ('enrichi'), ('contre_sous_apprentissage'), ('contre_sur_apprentissage'), ('base')) AS m(modele)""")
oracle("fit_optimality_sparse", """
  SELECT nom_produit, modele, true AS optimal, true AS converge FROM etendue, (VALUES ('enrichi_creux'), ('base_creux')) AS m(modele)""")
oracle("fit_optimality_event_windows", "SELECT nom_produit, 'enrichi' AS modele, true AS optimal, true AS converge FROM etendue")
oracle("stock_cover", "SELECT nom_produit, stock_actuel, moyenne_jour, duree_stock_jours, statut_stock FROM conseil_m",
       "moyenne_jour duree_stock_jours")
oracle("waste_risk", """
  SELECT nom_produit, stock_actuel, capacite_consommation, risque_gaspillage, pct_risque, actions FROM conseil_m""",
    "capacite_consommation risque_gaspillage pct_risque")
oracle("weekly_order_safety_stock", """
  SELECT nom_produit, avg(yhat) * 7 AS commande_hebdomadaire, max(yhat_upper) * 1.2e0 AS stock_securite FROM natif GROUP BY 1""",
    "commande_hebdomadaire stock_securite")
oracle("product_summary", "SELECT * FROM resume",
       "ecart_type stock_actuel duree_vie_moyenne besoin besoin_min besoin_max total_prevu moyenne_jour minimum maximum "
       "commande_suggeree commande_min commande_max duree_stock_jours capacite_consommation risque_gaspillage "
       "commande_hebdomadaire stock_securite pct_risque mae mape rmse consommation_moyenne_jour")

STEPS["unites"] = "SELECT nom_produit, min(unite) AS unite FROM mv GROUP BY 1"
oracle("forecast_export", """
  SELECT ds AS date, round_even(yhat, 2) AS quantite_prevue, round_even(yhat_lower, 2) AS quantite_min,
    round_even(yhat_upper, 2) AS quantite_max, nom_produit AS produit, unite, '85%' AS confiance, '20250101_080000' AS run_id
  FROM natif JOIN unites USING (nom_produit)""")
_two = ", ".join(f"round_even({c}, 2) AS {c}" for c in (
    "consommation_moyenne_jour", "duree_vie_moyenne", "ecart_type", "total_prevu", "minimum", "maximum", "stock_actuel",
    "commande_suggeree", "commande_min", "commande_max", "commande_hebdomadaire", "stock_securite"))
oracle("summary_export", f"""
  SELECT nom_produit AS produit, strftime(debut, '%Y-%m-%d') AS debut, strftime(fin, '%Y-%m-%d') AS fin, nb_jours,
    round_even(mae, 2) AS "MAE", round_even(mape, 2) AS "MAPE", round_even(rmse, 2) AS "RMSE", verdict, 'natif' AS methode,
    true AS date_analyse_lisible, '3.0' AS version, '28 jours' AS "horizon", '85%' AS intervalle_confiance,
    round_even(moyenne_jour, 2) AS moyenne_jour, '' AS holidays, CAST(NULL AS BIGINT) AS nb_holidays, '' AS changepoints,
    CAST(0 AS INTEGER) AS nb_changepoints, '' AS regresseurs,
    CAST(NULL AS INTEGER) AS yearly, CAST(NULL AS INTEGER) AS weekly, CAST(NULL AS VARCHAR) AS mode,
    (SELECT count(*) FROM mv) AS nb_lignes_total,
    (SELECT strftime(min(date), '%Y-%m-%d') || ' → ' || strftime(max(date), '%Y-%m-%d') FROM mv) AS periode_donnees,
    '{SEASON_ADVICE}' AS attention,
    strftime(CAST(fin + 1 AS DATE), '%Y-%m-%d') || ' → ' || strftime(CAST(fin + 28 AS DATE), '%Y-%m-%d') AS periode,
    {_two}, horizon AS horizon_commande_jours,
    CASE WHEN moyenne_jour <= 0 THEN 0e0 ELSE round_even(duree_stock_jours, 1) END AS duree_stock_actuel_jours,
    round_even(risque_gaspillage, 2) AS risque_gaspillage_kg
  FROM resume""")
oracle("runs", """
  SELECT run_id, count(*) AS nb_lignes, count(DISTINCT nom_produit) AS nb_produits
  FROM futurs, (VALUES ('20250101_080000'), ('20250102_080000')) AS r(run_id) GROUP BY 1""")

oracle("run_summary", f"""
  SELECT produit, cle, CAST(valeur AS VARCHAR) AS valeur FROM (
    UNPIVOT (SELECT nom_produit AS produit, {", ".join(f"round({c}, 4) + 0e0 AS {c}" for c in _total_columns.split())}
             FROM ({_totals} FROM moyenne GROUP BY 1))
    ON {", ".join(_total_columns.split())} INTO NAME cle VALUE valeur)""")

oracle("run_files", """
  SELECT * FROM (VALUES ('20250101_080000', 'predictions', 'csv'), ('20250102_080000', 'predictions', 'csv'),
    ('20250102_080000', 'totaux', 'json'), ('20250102_080000', 'resume', 'txt')) AS f(run_id, "table", type)""")
oracle("run_text", """
  SELECT '20250102_080000' AS run_id, count(DISTINCT nom_produit) * 7 AS nb_lignes, count(DISTINCT nom_produit) AS nb_produits,
    CAST(7 AS BIGINT) AS nb_cles FROM moyenne""")

oracle("run_history", """
  SELECT run_id, CAST(0 AS BIGINT) AS nb_graphs, CAST(1 AS BIGINT) AS nb_csv, CAST(n AS BIGINT) AS nb_json, CAST(n AS BIGINT) AS nb_txt,
    CAST(1 + 2 * n AS BIGINT) AS nb_fichiers, count(DISTINCT nom_produit) AS nb_produits
  FROM futurs, (VALUES ('20250101_080000', 0), ('20250102_080000', 1)) AS r(run_id, n) GROUP BY run_id, n""")
