"""Reading movement tables: explicit schema, strict dates, column report."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.fixed_values import BASE_COLUMNS, MOVEMENT_COLUMNS, REGRESSOR_COLUMNS

_TYPES = {
    "date": T.DateType(),
    "date_expiration": T.DateType(),
    "id_produit": T.LongType(),
    "id_lot": T.LongType(),
    "id_arrivage": T.LongType(),
    "id_fournisseur": T.LongType(),
    "quantite": T.DoubleType(),
    "stock_theorique": T.DoubleType(),
    "temperature_stockage": T.DoubleType(),
    "temperature": T.DoubleType(),
    "taux_occupation": T.DoubleType(),
    "nb_patients": T.IntegerType(),
    "epidemie_grippe": T.IntegerType(),
    "vacances_scolaires": T.IntegerType(),
    "jour_ferie": T.IntegerType(),
    "covid_impact": T.IntegerType(),
}

# --- Fixed values: column order of the first-generation file ------------------
# Storage temperature sits in `temperature`, lots
# carry a printed number, and outgoing rows are not told apart.
_BASE_LAYOUT = [
    "date", "type_operation", "id_lot", "numero_lot", "id_produit", "nom_produit",
    "type_produit", "unite", "quantite", "stock_theorique", "temperature",
    "date_expiration", "id_fournisseur", "nom_fournisseur", "id_arrivage",
]


def _schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES.get(n, T.StringType())) for n in names])


MOVEMENT_SCHEMA = _schema(MOVEMENT_COLUMNS)
BASE_SCHEMA = _schema(_BASE_LAYOUT)
EXPECTED_COLUMNS = [(c, "base") for c in BASE_COLUMNS] + [(c, "regresseur") for c in REGRESSOR_COLUMNS]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers are null everywhere, so that averages skip them."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in doubles})


def read_movements(spark: SparkSession, path: str, fmt: str = "csv", layout: str = "enriched") -> DataFrame:
    """Movements from CSV (with header) or Parquet; the base layout is renamed on the way.

    A missing path raises ``FileNotFoundError`` before any job starts. CSV values
    that do not fit the schema raise when the rows are read.

    CSV columns are matched to the schema by position, so the header is enforced:
    a file with other columns is refused instead of being misread.
    """
    schema = {"enriched": MOVEMENT_SCHEMA, "base": BASE_SCHEMA}[layout]
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.schema(schema).options(header=True, enforceSchema=False, mode="FAILFAST")
    try:
        df = reader.load(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from err
        raise
    if layout == "base":
        df = df.withColumnRenamed("temperature", "temperature_stockage")
    return nan_to_null(df)


def parse_dates(df: DataFrame, columns: list[str], strict: bool = True) -> DataFrame:
    """Text to dates. Strict parsing raises on a bad value, else it becomes null."""
    parse = F.to_date if strict else F.try_to_date
    return df.withColumns({c: parse(F.col(c), "yyyy-MM-dd") for c in columns})


def date_parse_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per text column: values, values that are dates, rejects, first and last date."""
    from larder.functions.columns import unpivot_aggregates

    def row(c):
        day = F.try_to_date(F.col(c), "yyyy-MM-dd")
        return {
            "colonne": F.lit(c),
            "nb_valeurs": F.count(c),
            "nb_dates": F.count(day),
            "nb_rejets": F.count(c) - F.count(day),
            "premiere_date": F.min(day),
            "derniere_date": F.max(day),
        }

    return unpivot_aggregates(df, [row(c) for c in columns])


def schema_report(df: DataFrame) -> DataFrame:
    """Expected columns and whether they are there, then columns that nobody expects. The schema tells; counts are in ``quality.info``."""
    known = dict(EXPECTED_COLUMNS)
    names = [*EXPECTED_COLUMNS, *[(c, "inattendue") for c in df.columns if c not in known]]
    lines = [(i, name, group, name in df.columns) for i, (name, group) in enumerate(names, 1)]
    return df.sparkSession.createDataFrame(lines, "position int, colonne string, groupe string, presente boolean")
