"""Reading movement files that hold broken rows: good rows and rejects out of one scan.

``read_movements`` refuses a file at its first broken row, which is right for a file one made oneself and wrong for years
of files from elsewhere. Here a broken row becomes a line of the reject table and the others are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.session import open_folders, scratch_path
from larder.sources.movements import BASE_SCHEMA, MOVEMENT_SCHEMA, nan_to_null

LAYOUTS = {"enriched": MOVEMENT_SCHEMA, "base": BASE_SCHEMA}
REQUIRED = ("date", "type_operation", "quantite")

# --- Fixed values: why a row is rejected --------------------------------------
UNREADABLE = "valeur illisible"
WRONG_COLUMNS = "nombre de colonnes"
MISSING = "valeur obligatoire absente"

REJECT_COLUMNS = ["fichier", "ligne", "motif", "colonnes", "valeurs"]
_RAW = "_ligne"


def _listed(found: Column, field: str) -> Column:
    return F.concat_ws("; ", F.transform(found, lambda x: F.coalesce(x[field], F.lit(""))))


def _judged(rows: DataFrame, schema: T.StructType, required: Sequence[str]) -> DataFrame:
    """The rows with a null ``motif``, or why they are rejected, from the raw line and what could be read of it."""
    # The raw line is there only where Spark could not read it; its fields as text show which ones.
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    fields = F.from_csv(F.col(_RAW), F.lit(as_text.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")))

    def field(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("colonne"), value.alias("valeur"))

    unread = F.filter(F.array(*[
        F.when(F.col(f.name).isNull() & F.col("_champs").getField(f.name).isNotNull(), field(f.name, F.col("_champs").getField(f.name)))
        for f in schema]), lambda x: x.isNotNull())
    absent = F.filter(F.array(*[F.when(F.col(c).isNull(), field(c, F.lit(None).cast("string"))) for c in required]), lambda x: x.isNotNull())
    raw, incomplete = F.col(_RAW).isNotNull(), F.lit(False)
    for c in required:
        incomplete = incomplete | F.col(c).isNull()
    motif = F.when(raw & (F.size("_illisibles") > 0), UNREADABLE).when(raw, WRONG_COLUMNS).when(incomplete, MISSING)
    which = F.when(F.col("motif") == UNREADABLE, F.col("_illisibles")).when(F.col("motif") == MISSING, absent).otherwise(F.array())

    def of_reject(value: Column) -> Column:
        return F.when(F.col("motif").isNotNull(), value)

    # Nothing of this is worked out or written for a good row.
    return (
        rows.withColumn("_champs", fields)
        .withColumn("_illisibles", F.when(raw, unread))
        .withColumn("motif", motif)
        .withColumns({
            "fichier": of_reject(F.col("fichier")),
            "colonnes": of_reject(_listed(which, "colonne")),
            "valeurs": of_reject(_listed(which, "valeur")),
            "ligne": of_reject(F.coalesce(F.col(_RAW), F.to_csv(F.struct(*[F.col(f.name) for f in schema])))),
        })
    )


def split_movements(
    spark: SparkSession, path: str, layout: str = "enriched", header: bool = True, required: Sequence[str] = REQUIRED,
) -> tuple[DataFrame, DataFrame]:
    """Movements of CSV files as (good rows, rejects). A missing path raises ``FileNotFoundError``.

    Rejected is a row with a value that does not fit its column, with too few or too many columns, or without a required value.
    A reject has its file, the raw line, the reason, and the columns and values at fault; a good row is as ``read_movements``
    gives it. The files are scanned once: rows and rejects are written to the shared folder, apart, and read from there.
    """
    schema = LAYOUTS[layout]
    with_raw = T.StructType([*schema, T.StructField(_RAW, T.StringType())])
    reader = spark.read.schema(with_raw).options(header=header, enforceSchema=not header, mode="PERMISSIVE", columnNameOfCorruptRecord=_RAW)
    try:
        rows = reader.csv(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from err
        raise
    rows = rows.select("*", F.col("_metadata.file_path").alias("fichier"))
    names = [f.name for f in schema]
    out = scratch_path(spark, "movements")
    judged = _judged(rows, schema, required).select(*names, *REJECT_COLUMNS, F.col("motif").isNotNull().alias("rejete"))
    with open_folders(spark, 2):
        judged.write.partitionBy("rejete").parquet(out)
    # Each side reads its own partition.
    both = spark.read.schema(", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema], *[f"{c} string" for c in REJECT_COLUMNS], "rejete boolean"])).parquet(out)
    good = both.where(~F.col("rejete")).select(names)
    if layout == "base":
        good = good.withColumnRenamed("temperature", "temperature_stockage")
    return nan_to_null(good), both.where("rejete").select(REJECT_COLUMNS)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejects per reason and columns at fault, with the number of files they come from."""
    return rejects.groupBy("motif", "colonnes").agg(F.count("*").alias("nb_lignes"), F.count_distinct("fichier").alias("nb_fichiers"))
