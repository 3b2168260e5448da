"""Profiling and data quality of movement tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.fixed_values import (
    CONSUMED,
    DAYS_PER_MONTH,
    DAYS_PER_YEAR,
    DESTROYED,
    FLAG_REGRESSORS,
    MEAN_REGRESSORS,
)
from larder.functions.columns import half_even, percent, shelf_life, total, unpivot_aggregates, with_keys
from larder.functions.quantiles import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def shape(df: DataFrame, columns: int | None = None) -> DataFrame:
    """Rows and columns. Counting needs no column, so ``df`` may be narrowed and ``columns`` given from the schema."""
    return df.agg(F.count("*").alias("nb_lignes")).withColumn("nb_colonnes", F.lit(columns or len(df.columns)))


def info(df: DataFrame) -> DataFrame:
    """Type and non-null count of every column, in one pass."""
    return unpivot_aggregates(df, [
        {
            "position": F.lit(i),
            "colonne": F.lit(f.name),
            "type": F.lit(f.dataType.simpleString()),
            "nb_non_nuls": F.count(f.name),
        }
        for i, f in enumerate(df.schema, 1)
    ])


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values: how many, and their share in percent."""
    rows = [
        {
            "colonne": F.lit(c),
            "nb_manquants": F.count_if(F.col(c).isNull()),
            "pct_manquants": half_even(percent(F.count_if(F.col(c).isNull()), F.count("*"))),
        }
        for c in df.columns
    ]
    return unpivot_aggregates(df, rows).where(F.col("nb_manquants") > 0)


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum of numeric columns, worked out right away.

    Moments are plain aggregates of one pass; the quartiles take a few passes of counting. NaN counts as missing.
    """
    columns = list(columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)])
    numbers = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    measures = {"nb": F.count, "moyenne": F.avg, "ecart_type": F.stddev_samp, "minimum": F.min, "maximum": F.max}
    # A line per value and one group per column: with an aggregate per column and measure the pass took three times as long.
    numbered = numbers.select(F.posexplode(F.array(*[f"`{c}`" for c in columns])).alias("place", "valeur"))
    found = {r["place"]: r for r in numbered.groupBy("place").agg(*[f("valeur").alias(m) for m, f in measures.items()]).collect()}
    nothing = dict.fromkeys(measures) | {"nb": 0}
    moments = {c: {m: found[i][m] for m in measures} if i in found else nothing for i, c in enumerate(columns)}
    quartiles = exact_quantiles(numbers, columns, QUARTILES, {c: (m["nb"], m["minimum"], m["maximum"]) for c, m in moments.items()})
    lines = [
        (c, m["nb"], m["moyenne"], m["ecart_type"], m["minimum"], *quartiles[c], m["maximum"])
        for c, m in moments.items()
    ]
    kinds = "colonne string, nb long, moyenne double, ecart_type double, minimum double, q25 double, q50 double, q75 double, maximum double"
    return df.sparkSession.createDataFrame(lines, kinds)


def period_span(df: DataFrame, day: str = "date") -> DataFrame:
    span = F.datediff(F.max(day), F.min(day))
    return df.agg(
        F.min(day).alias("debut"),
        F.max(day).alias("fin"),
        span.alias("nb_jours"),
        (span / F.lit(float(DAYS_PER_YEAR))).alias("nb_annees"),
    )


def consistency_counts(mv: DataFrame) -> DataFrame:
    """Rows breaking a rule: negative quantity, negative stock, used after expiry."""
    return mv.agg(
        F.count_if(F.col("quantite") < 0).alias("nb_quantites_negatives"),
        F.count_if(F.col("stock_theorique") < 0).alias("nb_stocks_negatifs"),
        F.count_if(shelf_life() < 0).alias("nb_perimes"),
    )


def expired_rows(mv: DataFrame) -> DataFrame:
    return mv.where(shelf_life() < 0)


def expired_use(mv: DataFrame) -> DataFrame:
    """Per product: rows dated after their expiry, and their share in percent."""
    late = F.count_if(shelf_life() < 0)
    return (
        with_keys(mv, ["nom_produit"]).groupBy("nom_produit")
        .agg(F.count("*").alias("nb_lignes"), late.alias("nb_perimes"), percent(late, F.count("*")).alias("pct_perimes"))
        .where(F.col("nb_perimes") > 0)
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        with_keys(df, [column]).groupBy(column).agg(F.count("*").alias("nb_lignes"))
        .orderBy(F.desc("nb_lignes"), column)
    )


def distinct_counts(mv: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct products, lots, suppliers and deliveries; sketches if ``approximate``."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return mv.agg(
        count("id_produit").alias("nb_produits"),
        count("id_lot").alias("nb_lots"),
        count("id_fournisseur").alias("nb_fournisseurs"),
        count("id_arrivage").alias("nb_arrivages"),
    )


DISTINCT_COLUMNS = {"nb_produits": "id_produit", "nb_lots": "id_lot", "nb_fournisseurs": "id_fournisseur", "nb_arrivages": "id_arrivage"}
# Registers of a sketch, as a power of two: the standard error is 1.04 / sqrt(2^14), 0.8 %.
SKETCH_BITS = 14


def distinct_sketches(mv: DataFrame, by: Sequence[str] = ("mois",), bits: int = SKETCH_BITS) -> DataFrame:
    """Mergeable sketches of the identifiers, one row per month (first day) or other keys: a table to be kept.

    A new month adds its own row; counts over any span of months come from ``merged_counts`` without a look at old movements.
    A sketch holds 2^bits registers at most, whatever it has seen, and is combined map-side.
    """
    keyed = mv.withColumn("mois", F.trunc("date", "month")) if "mois" in by else mv
    return keyed.groupBy(*by).agg(*[F.hll_sketch_agg(c, bits).alias(name) for name, c in DISTINCT_COLUMNS.items()])


def merged_counts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct identifiers over all rows of a sketch table, or per key."""
    measures = [F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in DISTINCT_COLUMNS]
    return sketches.groupBy(*by).agg(*measures) if by else sketches.agg(*measures)


def regressor_stats(mv: DataFrame) -> DataFrame:
    return unpivot_aggregates(mv, [
        {
            "regresseur": F.lit(c),
            "moyenne": F.avg(c),
            "minimum": F.min(c).cast("double"),
            "maximum": F.max(c).cast("double"),
        }
        for c in MEAN_REGRESSORS
    ])


def event_flag_stats(mv: DataFrame) -> DataFrame:
    """Per flag: flagged rows with their share, and the days they really cover.

    Rows are folded to one line per day first, so days need no distinct count.
    """
    days = mv.groupBy("date").agg(
        F.count("*").alias("nb"),
        *[F.sum(f).alias(f"{f}_lignes") for f in FLAG_REGRESSORS],
        *[F.max(f).alias(f"{f}_jour") for f in FLAG_REGRESSORS],
    )
    years = F.datediff(F.max("date"), F.min("date")) / F.lit(float(DAYS_PER_YEAR))

    def row(flag):
        rows = F.coalesce(F.sum(f"{flag}_lignes"), F.lit(0))
        on = F.count_if((F.col(f"{flag}_jour") == 1) & F.col("date").isNotNull())
        return {
            "indicateur": F.lit(flag),
            "nb_lignes": rows,
            "pct_lignes": percent(rows, F.sum("nb")),
            "nb_jours": on,
            "lignes_par_an": F.try_divide(rows.cast("double"), years),
            "jours_par_an": F.try_divide(on.cast("double"), years),
            "mois_cumules_lignes": rows / F.lit(float(DAYS_PER_MONTH)),
            "mois_cumules_jours": on / F.lit(float(DAYS_PER_MONTH)),
        }

    return unpivot_aggregates(days, [row(f) for f in FLAG_REGRESSORS])


def product_names(mv: DataFrame, n: int | None = None) -> DataFrame:
    """Product names in order: all of them, or the first ``n``."""
    names = with_keys(mv, ["nom_produit"]).select("nom_produit").distinct().orderBy("nom_produit")
    return names if n is None else names.limit(n)


def operation_shares(mv: DataFrame) -> DataFrame:
    """Rows per operation and exit type, with their share overall and within the operation."""
    counts = (
        with_keys(mv, ["type_operation"]).groupBy("type_operation", "type_sortie")
        .agg(F.count("*").alias("nb_lignes"))
    )
    of_operation = F.sum("nb_lignes").over(Window.partitionBy("type_operation"))
    everything = with_keys(mv, ["type_operation"]).select(F.count("*")).scalar()
    return counts.select(
        "type_operation",
        "type_sortie",
        "nb_lignes",
        percent(F.col("nb_lignes"), everything).alias("pct_total"),
        percent(F.col("nb_lignes"), of_operation).alias("pct_operation"),
    )


def waste_rate(mv: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Destroyed quantity as a percentage of destroyed plus consumed."""
    destroyed = total(F.when(F.col("type_sortie") == DESTROYED, F.col("quantite")))
    consumed = total(F.when(F.col("type_sortie") == CONSUMED, F.col("quantite")))
    measures = [
        destroyed.alias("quantite_detruite"),
        consumed.alias("quantite_consommee"),
        percent(destroyed, destroyed + consumed).alias("taux_gaspillage"),
    ]
    return with_keys(mv, by).groupBy(*by).agg(*measures) if by else mv.agg(*measures)


def waste_rate_levels(mv: DataFrame, levels: Sequence[str] = ("type_produit", "nom_produit")) -> DataFrame:
    """The waste rate on every level at once: total, then by the first level, then by the first two, and so on.

    One scan and one exchange of partial sums for all levels (grouping sets). ``niveau`` names the level, the finest keys that
    a row has; keys above it are null. Rows without one of the keys count in the levels that do without it only.
    """
    sums = {
        "quantite_detruite": total(F.when(F.col("type_sortie") == DESTROYED, F.col("quantite"))),
        "quantite_consommee": total(F.when(F.col("type_sortie") == CONSUMED, F.col("quantite"))),
    }
    # The set with the first n keys has a grouping_id of as many ones at the end as keys are left out.
    rolled = mv.rollup(*levels).agg(F.grouping_id().alias("_omis"), *[value.alias(name) for name, value in sums.items()])
    names = F.lit("total")
    present = F.lit(True)
    for n, level in enumerate(levels, 1):
        inside = F.col("_omis") < 2 ** (len(levels) - n + 1) - 1
        names = F.when(inside, level).otherwise(names)
        present = present & (~inside | F.col(level).isNotNull())
    rate = percent(F.col("quantite_detruite"), F.col("quantite_detruite") + F.col("quantite_consommee"))
    return rolled.where(present).select(names.alias("niveau"), *levels, *sums, rate.alias("taux_gaspillage"))
