"""Column names, labels, thresholds and model settings.

Results depend on these exact values, so they are stated plainly here and
nowhere else.
"""

# --- Fixed values: movement columns -----------------------------------------
BASE_COLUMNS = [
    "date", "id_produit", "nom_produit", "type_produit", "type_operation",
    "type_sortie", "quantite", "unite", "id_lot", "id_arrivage",
    "id_fournisseur", "nom_fournisseur", "date_expiration",
    "stock_theorique", "temperature_stockage",
]
MEAN_REGRESSORS = ["temperature", "taux_occupation", "nb_patients"]
FLAG_REGRESSORS = ["epidemie_grippe", "vacances_scolaires", "jour_ferie", "covid_impact"]
REGRESSOR_COLUMNS = MEAN_REGRESSORS + FLAG_REGRESSORS
MOVEMENT_COLUMNS = BASE_COLUMNS + REGRESSOR_COLUMNS

# --- Fixed values: operation codes ------------------------------------------
INCOMING = "ENTREE"
OUTGOING = "SORTIE"
CONSUMED = "CONSOMMATION"
DESTROYED = "DESTRUCTION"
FOOD = "Aliment"
CLEANING = "Entretien"

# --- Fixed values: calendar labels, in order --------------------------------
WEEKDAYS = [
    (0, "Monday", "Lundi"), (1, "Tuesday", "Mardi"), (2, "Wednesday", "Mercredi"),
    (3, "Thursday", "Jeudi"), (4, "Friday", "Vendredi"), (5, "Saturday", "Samedi"),
    (6, "Sunday", "Dimanche"),
]
MONTHS = [
    (1, "Jan"), (2, "Fév"), (3, "Mar"), (4, "Avr"), (5, "Mai"), (6, "Jun"),
    (7, "Jul"), (8, "Aoû"), (9, "Sep"), (10, "Oct"), (11, "Nov"), (12, "Déc"),
]
COLD_MONTHS = [12, 1, 2]
FLU_MONTHS = [1, 2, 3]
FIRST_WEEKEND_DAY = 5

# --- Fixed values: holiday label -> flag column -----------------------------
HOLIDAY_FLAGS = [
    ("jour_ferie", "jour_ferie"),
    ("vacances_scolaires", "vacances_scolaires"),
    ("covid_19", "covid_impact"),
]

# Days before and after an event that have effects of their own: label, first offset, last offset.
EVENT_WINDOWS = [("jour_ferie", -2, 1), ("vacances_scolaires", -1, 1), ("covid_19", 0, 0)]

# --- Fixed values: thresholds -----------------------------------------------
CRITICAL_LIFE_DAYS = 3
PERISHABLE_LIFE_DAYS = 7
TEST_SHARE = 0.2
TEST_DAYS = 365
FORECAST_DAYS = 28
RECENT_DAYS = 30
FALLBACK_BAND = 0.15
MAPE_GUARD = 0.01
MAPE_EXCELLENT = 15
MAPE_GOOD = 25
COVER_CRITICAL_DAYS = 1
COVER_LOW_DAYS = 2
SAFETY_FACTOR = 1.2
UNKNOWN_STOCK = "inconnu"
DAYS_PER_YEAR = 365
DAYS_PER_MONTH = 30
CONFIDENCE_LABEL = "85%"
DATASET_VERSION = "3.0"
# Two-sided 85 % normal quantile: P(|Z| < Z_85) = 0.85.
Z_85 = 1.4395314709384563

# --- Fixed values: forecast model settings ----------------------------------
YEAR_PERIOD = 365.25
WEEK_PERIOD = 7.0
YEARLY_ORDER = 20
WEEKLY_ORDER = 5
MODEL_REGRESSORS = [
    # column, prior scale, standardise
    ("temperature", 0.5, True),
    ("taux_occupation", 1.0, True),
    ("nb_patients", 0.5, True),
    ("epidemie_grippe", 0.5, False),
]
AUTO_CHANGEPOINTS = 25
AUTO_CHANGEPOINT_SHARE = 0.8
GUIDE_CHANGEPOINT_SHARE = 0.9
# A year with fewer days than this has no slope of its own.
BREAK_YEAR_DAYS = 180

# --- Fixed values: regressors by product category ---------------------------
REGRESSORS_BY_CATEGORY = {
    "ultra_perissable": ["taux_occupation", "nb_patients", "jour_ferie"],
    "legumes_fruits": ["temperature", "taux_occupation"],
    "entretien": ["epidemie_grippe", "covid_impact", "nb_patients"],
    "stable": ["taux_occupation"],
}

# --- Fixed values: advice given with a waste risk ---------------------------
WASTE_ACTIONS = ["adapter_menus", "reduire_commande", "verifier_fifo", "proposer_promotions"]
SEASON_ADVICE = "Tenir compte des variations saisonnières"

# --- Fixed values: model configurations -------------------------------------
# name, multiplicative, yearly order, weekly order, changepoint prior,
# seasonality prior, holidays prior, with regressors and holidays
MODEL_CONFIGS = [
    ("enrichi", True, 20, 5, 0.5, 10.0, 10.0, True),
    ("contre_sous_apprentissage", True, 20, 5, 0.5, 15.0, 10.0, True),
    ("contre_sur_apprentissage", True, 5, 5, 0.001, 0.1, 10.0, True),
    ("base", False, 10, 3, 0.05, 10.0, 10.0, False),
]
# The same two with the reports' own kind of prior on trend breaks, a Laplace distribution.
SPARSE_CONFIGS = [
    ("enrichi_creux", True, 20, 5, 0.5, 10.0, 10.0, True, True),
    ("base_creux", False, 10, 3, 0.05, 10.0, 10.0, False, True),
]
TREND_PRIOR = 5.0
