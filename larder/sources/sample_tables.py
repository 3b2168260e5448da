"""Movements derived from the order tables used for tests and benchmarks.

``lineitem`` with ``part`` and ``supplier`` becomes the movement table, ``orders``
the daily regressors. The mapping is made up so that every rule of the library
has rows on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.fixed_values import CLEANING, CONSUMED, DESTROYED, FOOD, INCOMING, MOVEMENT_COLUMNS, OUTGOING, REGRESSOR_COLUMNS
from larder.functions.columns import last_word
from larder.functions.running import running_total

# --- Fixed values: the mapping ----------------------------------------------
CLEANING_WORDS = ["gear", "gizmo", "widget"]
LITRE_WORD = "bolt"
LIFE_DAYS = [("ring", 3), ("rod", 5), ("bolt", 8), ("anvil", 30)]
OTHER_LIFE_DAYS = 180
PUBLIC_HOLIDAYS = [101, 501, 508, 714, 815, 1101, 1111, 1225]
COVID_FROM, COVID_TO = "1998-03-15", "1998-06-15"
CHANGEPOINTS = ["1996-06-01", "1997-03-15", "1998-03-15", "1999-01-01", "2000-06-01"]
FOCUS_PRODUCT = "small ring"

# Movement columns that need `part`. Parts and suppliers are joined to the left, so the rows
# are the same whichever columns are asked for, and a join that gives no column is left out.
PART_COLUMNS = {
    "nom_produit", "type_produit", "unite", "date_expiration", "temperature_stockage", "stock_theorique",
}

# Blocks for the running stock of hot days: 2^20 lot numbers each, incoming rows first.
LOT_BLOCK_BITS = 20
OUTGOING_BLOCKS = 1 << (63 - LOT_BLOCK_BITS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _life_days(word: Column) -> Column:
    base = F.lit(OTHER_LIFE_DAYS)
    for name, days in LIFE_DAYS:
        base = F.when(word == name, days).otherwise(base)
    line = F.col("l_linenumber")
    return base + F.when(line == 7, -5).otherwise(line % 3 - 1)


def daily_regressors(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order date: patients, occupation, outdoor temperature, flags."""
    patients = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.count_distinct("o_custkey").cast("int").alias("nb_patients"))
    )
    busiest = patients.select(F.max("nb_patients")).scalar()
    month_day = F.month("date") * 100 + F.dayofmonth("date")
    return patients.select(
        "date",
        (15.0 - 10.0 * F.cos(2 * F.pi() * F.dayofyear("date") / 365.25)).alias("temperature"),
        (100.0 * F.col("nb_patients") / busiest).alias("taux_occupation"),
        "nb_patients",
        (F.month("date").between(1, 3) & (F.col("nb_patients") % 2 == 0)).cast("int").alias("epidemie_grippe"),
        F.month("date").isin(7, 8).cast("int").alias("vacances_scolaires"),
        month_day.isin(PUBLIC_HOLIDAYS).cast("int").alias("jour_ferie"),
        F.col("date").between(F.lit(COVID_FROM).cast("date"), F.lit(COVID_TO).cast("date"))
        .cast("int").alias("covid_impact"),
    )


def movements(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The movement table, or just some of its columns.

    Naming the columns keeps out the joins and the running stock that the caller
    does not need: a join that only adds columns is not dropped by the optimizer.
    """
    wanted = list(columns) or MOVEMENT_COLUMNS
    needs = set(wanted)

    word = last_word("p_name")
    incoming = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")
    destroyed = (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N")
    cleaning = word.isin(CLEANING_WORDS)

    df = table(spark, folder, "lineitem").withColumn("date", F.col("l_shipdate").cast("date"))
    if needs & PART_COLUMNS:
        df = df.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")

    derived = {
        "date": F.col("date"),
        "id_produit": F.col("l_partkey"),
        "nom_produit": F.col("p_name"),
        "type_produit": F.when(cleaning, CLEANING).otherwise(FOOD),
        "type_operation": F.when(incoming, INCOMING).otherwise(OUTGOING),
        "type_sortie": F.when(incoming, F.lit(None).cast("string")).when(destroyed, DESTROYED).otherwise(CONSUMED),
        "quantite": F.when(incoming, F.col("l_quantity") * 5).otherwise(F.col("l_quantity")),
        "unite": F.when(word == LITRE_WORD, "L").otherwise("kg"),
        "id_lot": F.col("l_orderkey") * 8 + F.col("l_linenumber"),
        "id_arrivage": F.col("l_orderkey"),
        "id_fournisseur": F.col("l_suppkey"),
        "date_expiration": F.date_add("date", _life_days(word)),
        "temperature_stockage": F.when(~cleaning, F.col("p_size") / F.lit(10.0)),
        "stock_theorique": F.col("stock_theorique"),
    }
    if "stock_theorique" in needs:
        # Before the other columns are derived, so that the shuffle moves the few plain ones they come from.
        lots = F.shiftright(derived["id_lot"], LOT_BLOCK_BITS)
        df = running_total(
            df, group=["p_name"], day="date",
            block=F.when(incoming, lots).otherwise(lots + OUTGOING_BLOCKS),
            order=[*[derived[c] for c in ("type_operation", "id_lot", "id_produit")], F.col("l_extendedprice"), derived["quantite"]],
            value=F.when(incoming, derived["quantite"]).otherwise(-derived["quantite"]), out="stock_theorique",
        )
    if "nom_fournisseur" in needs:
        needs.add("id_fournisseur")
    if needs & set(REGRESSOR_COLUMNS):
        needs.add("date")
    df = df.select(*[column.alias(c) for c, column in derived.items() if c in needs])

    if "nom_fournisseur" in needs:
        suppliers = table(spark, folder, "supplier").select(
            F.col("s_suppkey").alias("id_fournisseur"), F.col("s_name").alias("nom_fournisseur"))
        df = df.join(suppliers, "id_fournisseur", "left")
    if needs & set(REGRESSOR_COLUMNS):
        # One row per calendar day, whatever the number of movements: safe to broadcast.
        df = df.join(F.broadcast(daily_regressors(spark, folder)), "date", "left")
    return df.select(*wanted)
