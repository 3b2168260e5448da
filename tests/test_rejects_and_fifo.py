"""Reading files with broken rows, and the first-in-first-out audit."""

import datetime as dt
import random

import pytest

from larder.operators import fifo
from larder.plans import catalog
from larder.session import TEXT_OPTIONS, open_folders
from larder.sources import rejects
from larder.sources.movements import BASE_SCHEMA, read_movements

HEADER = ",".join(f.name for f in BASE_SCHEMA)
GOOD = "2024-01-02,SORTIE,7,L7,1,riz,Aliment,kg,2.5,10.0,4.0,2024-01-09,3,Dupont,12"


def lines(*texts):
    return "\n".join([HEADER, *texts]) + "\n"


def test_broken_rows_are_set_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text(lines(
        GOOD,
        GOOD.replace("2024-01-02", "02/01/2024"),
        GOOD.replace(",2.5,", ",deux,").replace(",12", ",douze"),
        GOOD.rsplit(",", 2)[0],
        GOOD + ",surplus",
        GOOD.replace("2024-01-02", ""),
        GOOD.replace("riz", '"riz, long"').replace("4.0", ""),
        GOOD.replace("4.0", "NaN"),
    ))
    (tmp_path / "b.csv").write_text(lines(GOOD, GOOD.replace(",10.0,", ",?,")))
    good, bad = rejects.split_movements(spark, str(tmp_path), "base")
    assert sorted((r.nom_produit, r.temperature_stockage is None) for r in good.collect()) == [("riz", False), ("riz", False), ("riz", True), ("riz, long", True)]
    found = {(r.fichier.rsplit("/", 1)[1], r.motif, r.colonnes, r.valeurs) for r in bad.collect()}
    assert found == {
        ("a.csv", "valeur illisible", "date", "02/01/2024"),
        ("a.csv", "valeur illisible", "quantite; id_arrivage", "deux; douze"),
        ("a.csv", "nombre de colonnes", "", ""),
        ("a.csv", "valeur obligatoire absente", "date", ""),
        ("b.csv", "valeur illisible", "stock_theorique", "?"),
    }
    assert {r.ligne for r in bad.collect()} >= {GOOD + ",surplus", GOOD.rsplit(",", 2)[0], GOOD.replace("2024-01-02", "02/01/2024")}
    counts = {(r.motif, r.colonnes): (r.nb_lignes, r.nb_fichiers) for r in rejects.reject_counts(bad).collect()}
    assert counts["nombre de colonnes", ""] == (2, 1) and sum(n for n, _ in counts.values()) == bad.count() == 6


def test_good_rows_are_written_without_reject_columns(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rejects, "scratch_path", lambda spark, name: str(tmp_path / "out"))
    (tmp_path / "a.csv").write_text(lines(GOOD, GOOD.replace("2024-01-02", ""), GOOD + ",surplus"))
    rejects.split_movements(spark, str(tmp_path / "a.csv"), "base")
    good = spark.read.parquet(str(tmp_path / "out/rejete=false")).select(rejects.REJECT_COLUMNS).collect()
    assert [tuple(r) for r in good] == [(None,) * 5]
    bad = spark.read.parquet(str(tmp_path / "out/rejete=true")).select("ligne", "motif", "fichier").collect()
    assert len(bad) == 2 and all(None not in tuple(r) for r in bad)


def test_rows_are_not_sorted_to_be_set_apart(spark, tmp_path):
    """Rows of both folders in turn are written as they come, in one file per folder."""
    usual = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = spark.range(0, 100, 1, 1).selectExpr("id % 2 AS side", "id")
    with open_folders(spark, 2):
        rows.write.partitionBy("side").parquet(str(tmp_path / "out"))
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "2"
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == usual
    assert [len(list((tmp_path / f"out/side={i}").glob("*.parquet"))) for i in (0, 1)] == [1, 1]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100


@pytest.mark.parametrize("name, folder, ending", [
    ("scan_movements_csv", "movements_csv", ".csv.lz4"), ("scan_movements_base", "movements_base", ".csv.lz4"),
    ("schema_check", "movements_header", ".csv.lz4"), ("movement_rejects", "movements_broken", ".txt.lz4")])
def test_text_is_written_compressed(spark, sf, tmp_path, monkeypatch, name, folder, ending):
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: str(tmp_path / name))
    assert catalog.QUERIES[name](spark, sf).count()
    files = [p for p in (tmp_path / folder).rglob("part-*")]
    assert files and all(p.name.endswith(ending) for p in files)


def test_compressed_files_are_cut_by_rows(spark, tmp_path):
    assert TEXT_OPTIONS["maxRecordsPerFile"] <= 1_000_000
    df = spark.range(0, 95, 1, 1)
    df.write.options(**TEXT_OPTIONS | {"maxRecordsPerFile": 10}).option("header", True).csv(str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("part-*"))) == 10
    assert spark.read.schema("id long").option("header", True).csv(str(tmp_path / "out")).count() == 95


def test_good_files_read_as_before(spark, tmp_path):
    (tmp_path / "a.csv").write_text(lines(GOOD, GOOD))
    good, bad = rejects.split_movements(spark, str(tmp_path), "base")
    plain = read_movements(spark, str(tmp_path), layout="base")
    assert good.columns == plain.columns and good.collect() == plain.collect() and bad.isEmpty()
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty/a.csv").write_text(lines())
    assert all(side.isEmpty() for side in rejects.split_movements(spark, str(tmp_path / "empty"), "base"))


def test_missing_files_and_other_headers_are_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        rejects.split_movements(spark, str(tmp_path / "none"))
    (tmp_path / "a.csv").write_text(lines(GOOD).replace("date,", "jour,", 1))
    with pytest.raises(Exception, match="(?i)header"):
        rejects.split_movements(spark, str(tmp_path), "base")


def plain_fifo(rows):
    """Quantity by (product, issue end, receipt end), by walking through both queues."""
    out = {}
    for product in {r["nom_produit"] for r in rows}:
        def queue(kind):
            own = [r for r in rows if r["nom_produit"] == product and r["type_operation"] == kind and r["quantite"] > 0]
            return sorted(own, key=lambda r: (r["date"], r["id_lot"], r["id_produit"], r["quantite"], r["date_expiration"]))
        receipts, issued = [[r, r["quantite"]] for r in queue("ENTREE")], 0
        received, at = 0, 0
        for s in queue("SORTIE"):
            left, issued = s["quantite"], issued + s["quantite"]
            while left > 0:
                while at < len(receipts) and receipts[at][1] == 0:
                    received, at = received + receipts[at][0]["quantite"], at + 1
                if at == len(receipts):
                    out[product, issued, None, None] = left
                    break
                lot, rest = receipts[at]
                part = min(left, rest)
                receipts[at][1] -= part
                left -= part
                out[product, issued, received + lot["quantite"], lot["id_lot"]] = part
    return out


@pytest.mark.parametrize("per_stretch", [1, 3, 4096])
def test_allocation_equals_two_queues(spark, make, per_stretch):
    rng, rows = random.Random(per_stretch), []
    for i in range(160):
        rows.append({"nom_produit": rng.choice(["riz", "riz", "riz", "lait", "sel"]), "type_operation": rng.choice(["ENTREE", "SORTIE"]),
                     "date": dt.date(2024, 1, 1) + dt.timedelta(rng.randint(0, 9)), "id_lot": rng.randint(1, 40), "id_produit": i,
                     "quantite": rng.choice([0.0, -3.0, 0.25, 1.0, 2.5, 40.0])})
    rows = [r | {"type_operation": "SORTIE"} if r["nom_produit"] == "sel" else r for r in rows]
    rows.append({"nom_produit": "huile", "type_operation": "ENTREE", "quantite": 5.0, "id_produit": 1, "id_lot": 1, "date": dt.date(2024, 1, 1)})
    rows = [r | {"date_expiration": r["date"] + dt.timedelta(3)} for r in rows]
    found = fifo.allocate(make(*rows), per_stretch).collect()
    assert {(r.nom_produit, r.rang_sortie, r.rang_entree, r.lot_entree): pytest.approx(r.quantite) for r in found} == plain_fifo(rows)
    assert len(found) == len(plain_fifo(rows))


def test_movements_without_a_place_take_no_part(make):
    rows = [{"nom_produit": None}, {"date": None}, {"type_operation": None}, {"quantite": None}, {"quantite": -1.0}]
    assert fifo.allocate(make(*rows)).isEmpty()
    assert fifo.violations(fifo.allocate(make(*rows))).isEmpty()


def test_findings(make):
    def on(d):
        return dt.date(2024, 1, d)
    rows = [
        {"type_operation": "ENTREE", "id_lot": 1, "quantite": 10.0, "date": on(1), "date_expiration": on(4)},
        {"type_operation": "ENTREE", "id_lot": 2, "quantite": 10.0, "date": on(8), "date_expiration": on(20)},
        {"id_lot": 11, "quantite": 4.0, "date": on(2), "date_expiration": on(4)},
        {"id_lot": 12, "quantite": 4.0, "date": on(3), "date_expiration": on(9)},
        {"id_lot": 13, "quantite": 5.0, "date": on(6), "date_expiration": on(6)},
        {"id_lot": 14, "quantite": 10.0, "date": on(9), "date_expiration": on(12)},
    ]
    found = {r.constat: (r.nb_affectations, r.nb_sorties, r.quantite) for r in fifo.violations(fifo.allocate(make(*rows))).collect()}
    # 4 in order; 4 fresher than the lot due; of 5 two from the expired lot and three ahead of the next; of 10 seven in order, three without a lot.
    assert found == {"lot_plus_recent": (1, 1, 4.0), "lot_perime": (1, 1, 2.0), "avant_arrivage": (1, 1, 3.0), "sans_lot": (1, 1, 3.0)}
