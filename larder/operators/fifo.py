"""First in, first out: which lot each issue should have drawn on, and where the goods issued were others.

Receipts and issues of a product lie one behind the other on an axis of quantity: the first receipt covers it from 0 to its
quantity, the next one from there, and so do the issues. What an issue draws on a lot is the length that both cover.
Such a match of intervals is a range join; here it is an ordered sweep. The axis of each product is cut into stretches, every
interval is cut at their borders, and within a stretch one window carries along the receipt and the issue that cover each
place. A stretch holds as many units as ``ROWS_PER_STRETCH`` movements of the product move on average, so a hot product is many
stretches, and no two tables are joined by ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.fixed_values import INCOMING
from larder.functions.columns import percent, with_keys
from larder.functions.running import running_total
from larder.session import materialize

ROWS_PER_STRETCH = 4096
# Blocks of lot numbers, so that the running totals of a hot day are several.
LOT_BLOCK_BITS = 20

# --- Fixed values: what may be wrong with an allocation -----------------------
NO_LOT = "sans_lot"
BEFORE_ARRIVAL = "avant_arrivage"
EXPIRED_LOT = "lot_perime"
FRESHER_LOT = "lot_plus_recent"
IN_ORDER = "conforme"


def _intervals(mv: DataFrame, incoming: bool) -> DataFrame:
    """Receipts or issues with the stretch of the quantity axis they cover, in order of day, lot, part and quantity."""
    side = F.col("type_operation") == INCOMING
    rows = with_keys(mv, ["nom_produit", "date", "type_operation"]).where((side if incoming else ~side) & (F.col("quantite") > 0))
    rows = rows.select("nom_produit", "date", "id_lot", "id_produit", "quantite", "date_expiration")
    placed = running_total(
        rows, ["nom_produit"], "date", F.shiftright(F.coalesce("id_lot", F.lit(0).cast("long")), LOT_BLOCK_BITS),
        ["id_lot", "id_produit", "quantite", "date_expiration"], "quantite", "fin")
    return placed.select(
        "nom_produit", F.lit(incoming).alias("entree"), (F.col("fin") - F.col("quantite")).alias("debut"), "fin", "quantite",
        F.struct("fin", "date", "id_lot", "date_expiration").alias("mouvement"))


def allocate(mv: DataFrame, rows_per_stretch: int = ROWS_PER_STRETCH) -> DataFrame:
    """Quantity that each issue draws on each lot by first in, first out; the lot is null where receipts don't suffice.

    One row per issue and lot that meet. Receipts of the same day come in the order of their lot numbers. Movements without
    product, day or operation, or with a quantity that is not positive, take no part. ``rang_sortie`` and ``rang_entree`` are the
    units issued or received up to and with the movement, which tell movements of one lot and day apart.
    """
    # Read twice below; written, the running totals are worked out once.
    both = materialize(_intervals(mv, True).unionByName(_intervals(mv, False)), "intervals")
    sizes = both.groupBy("nom_produit").agg(
        F.greatest(F.max("fin") / F.ceil(F.count("*") / F.lit(rows_per_stretch)), F.lit(1e-9)).alias("_pas"),
        F.max(F.when(F.col("entree"), F.col("fin"))).alias("_recu"))
    placed = both.join(sizes, "nom_produit")
    last = F.floor((F.col("fin") / F.col("_pas"))).cast("long")
    pieces = placed.withColumn("troncon", F.explode(F.sequence(F.floor(F.col("debut") / F.col("_pas")).cast("long"), last)))
    start = F.greatest("debut", F.col("troncon") * F.col("_pas"))
    # An event is a place from which on a movement covers the axis; the end of the last receipt is one of none.
    events = pieces.where(start < F.col("fin")).select(
        "nom_produit", "troncon", start.alias("place"), ((F.col("troncon") + 1) * F.col("_pas")).alias("_bord"), "fin",
        F.when(F.col("entree"), F.col("mouvement")).alias("entree"), F.when(~F.col("entree"), F.col("mouvement")).alias("sortie"))
    nothing = F.lit(None).cast(placed.schema["mouvement"].dataType)
    ends = sizes.where("_recu IS NOT NULL").withColumn("troncon", F.floor(F.col("_recu") / F.col("_pas")).cast("long"))
    events = events.unionByName(ends.select(
        "nom_produit", "troncon", F.col("_recu").alias("place"), ((F.col("troncon") + 1) * F.col("_pas")).alias("_bord"), F.col("_recu").alias("fin"),
        nothing.alias("entree"), nothing.alias("sortie")))
    order = Window.partitionBy("nom_produit", "troncon").orderBy("place")
    sofar = order.rowsBetween(Window.unboundedPreceding, 0)
    swept = events.select(
        "nom_produit", "place", F.least(F.coalesce(F.lead("place").over(order), F.col("_bord")), F.col("_bord")).alias("suivant"),
        F.last("entree", True).over(sofar).alias("entree"), F.last("sortie", True).over(sofar).alias("sortie"))
    # A movement carried along covers the axis up to its own end only.
    until = F.when(F.col("entree.fin") > F.col("place"), F.col("entree"))
    drawn = swept.withColumn("entree", until).withColumn("suivant", F.least("suivant", "sortie.fin")).where(
        F.col("sortie").isNotNull() & (F.col("suivant") > F.col("place")))
    return drawn.groupBy(
        "nom_produit",
        F.col("sortie.fin").alias("rang_sortie"), F.col("sortie.date").alias("date_sortie"), F.col("sortie.id_lot").alias("lot_sortie"),
        F.col("sortie.date_expiration").alias("expiration_sortie"),
        F.col("entree.fin").alias("rang_entree"), F.col("entree.date").alias("date_entree"), F.col("entree.id_lot").alias("lot_entree"),
        F.col("entree.date_expiration").alias("expiration_entree"),
    ).agg(F.sum(F.col("suivant") - F.col("place")).alias("quantite"))


def finding() -> Column:
    """What is wrong with an allocation, the gravest first."""
    return (
        F.when(F.col("rang_entree").isNull(), NO_LOT)
        .when(F.col("date_entree") > F.col("date_sortie"), BEFORE_ARRIVAL)
        .when(F.col("expiration_entree") < F.col("date_sortie"), EXPIRED_LOT)
        .when(F.col("expiration_sortie") > F.col("expiration_entree"), FRESHER_LOT)
        .otherwise(IN_ORDER)
    )


def violations(allocated: DataFrame) -> DataFrame:
    """Per product and finding: allocations, issues, quantity, and its share of what the product issued.

    ``sans_lot``: nothing received is left; ``avant_arrivage``: the lot due came after the issue, so there was no stock;
    ``lot_perime``: the lot due had expired by then; ``lot_plus_recent``: goods that keep longer than those of the lot due were issued.
    """
    found = allocated.withColumn("constat", finding())
    counts = found.groupBy("nom_produit", "constat").agg(
        F.count("*").alias("nb_affectations"), F.count_distinct("rang_sortie").alias("nb_sorties"), F.sum("quantite").alias("quantite"))
    everything = F.sum("quantite").over(Window.partitionBy("nom_produit"))
    return counts.withColumn("pct_quantite", percent(F.col("quantite"), everything)).where(F.col("constat") != IN_ORDER)
