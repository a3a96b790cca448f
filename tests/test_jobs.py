"""The jobs end to end, on small client files."""

import datetime as dt

import pytest

from benefacta.functions import labels
from benefacta.plans import jobs
from benefacta.sources import readers, registry, schemas

NOW = dt.date(2022, 7, 1)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("client")
    (base / "Archivos_Cliente").mkdir()

    def write(name, layout, records):
        source = registry.SOURCES[name]
        lines = [source.sep.join(f.raw for f in layout)]
        lines += [source.sep.join(str(r.get(f.name, "")) for f in layout) for r in records]
        (base / source.path).write_bytes("\n".join(lines).encode("latin-1"))

    donors = [dict(donor_id=i, age=20 + i % 50, churn_prob=5 + i % 20, lapsed_prob=1, is_active=1, children=i % 3,
                   has_children="Si", capture_date="2019-02-03", city="bogota", department="NARIÑO",
                   instalments_paid=4, instalments_unpaid=1) for i in range(1, 61)]
    donors += [dict(donor_id=90, age=30, is_active=1, capture_date="2022-06-30"),
               dict(donor_id=91, age=3, is_active=1, capture_date="2019-01-01", churn_prob=0),
               dict(donor_id=92, age=30, capture_date="Nº de error")]
    write("donors", schemas.DONORS, donors)
    tx = [dict(donor_id=i, tx_date=f"0{1 + n}/02/{2020 + n}", amount=f"{100 * (1 + i % 3) + n},5",
               stage="Cobrada" if (i + n) % 4 else "Perdida", record_type="DI - Regular")
          for i in range(1, 61) for n in range(3)]
    write("transactions", schemas.TRANSACTIONS, tx)
    write("cancellations", schemas.CANCELLATIONS, [dict(donor_id=5, cancel_date="03/02/2021", reason="otro")])
    rates = [f"{y}{m:02d};{y - 2018}" for y in (2020, 2021, 2022) for m in (1, 2)]
    (base / "inflation.csv").write_bytes("\n".join(["Serie", "", "a;b", *rates, "fin"]).encode("latin-1"))
    return str(base)


def test_all_jobs(spark, root, tmp_path):
    out = str(tmp_path / "out")
    jobs.run_cleaning(spark, root, out, NOW)
    status = {r["row_status"]: r["count"] for r in spark.read.parquet(f"{out}/donors").groupBy("row_status").count().collect()}
    assert status == {"ok": 61, "new": 1, "text_date": 1}

    jobs.run_lifetime_value(spark, out, f"{root}/inflation.csv", NOW)
    values = {r["donor_id"]: r for r in spark.read.parquet(f"{out}/lifetime_value").collect()}
    assert len(values) == 60
    two = values[2]  # amounts 300.5, 301.5, 302.5 in 2020..2022, the last of which is lost
    assert two["total_value"] == pytest.approx((300.5 * 1.02 + 301.5) * 1.03)
    assert two["lifespan"] == pytest.approx(100 / 7) and two["first_year"] == 2020

    path = jobs.run_training(spark, out, "0.0.1", k=3, restarts=2)
    trained = spark.read.parquet(f"{out}/segments")
    assert trained.count() == 61 and trained.filter("cluster is not null").count() == 60
    codes = {r["donor_id"]: r["cluster"] for r in trained.collect()}

    named = {r["donor_id"]: r["segment"] for r in jobs.run_assignment(spark, out, path).collect()}
    assert named[90] == labels.NEW_DONOR and named[91] == labels.UNASSIGNED and 92 not in named
    assert all(named[i] == labels.SEGMENTS[codes[i]] for i in range(1, 61))
    normal, outside = jobs.split_values(spark, out)
    assert normal.count() + outside.count() == 60

    jobs.run_experiments(spark, out, "run")
    metrics = spark.read.parquet(f"{out}/metrics").collect()
    assert {r["experiment"] for r in metrics} == {"training", "kmeans", "pca"}
    scores = {(r["experiment"], r["metric"]): r["value"] for r in metrics if r["cluster"] is None and r["parameter"] is None}
    assert scores["training", "n_clusters"] == 3 and scores["kmeans", "best_k"] == 5 and -1 <= scores["pca", "silhouette"] <= 1
    given = {(r["experiment"], r["metric"]): r["parameter"] for r in metrics if r["parameter"] is not None}
    assert given["pca", "n_components"] == "3" and given["training", "restarts"] == "2"

    jobs.export_lifetime_value(spark, out, str(tmp_path / "csv"))
    lfv = readers.read_delimited(spark, f"{tmp_path}/csv/Archivos_Cliente/lfv.csv")
    assert lfv.columns == [f.published for f in schemas.LIFETIME_VALUE] and lfv.count() == 60

    jobs.export_cleaned(spark, out, str(tmp_path / "csv"))
    again = readers.read_delimited(spark, f"{tmp_path}/csv/Archivos_Cliente/Base_donantes_preprocesada.csv")
    assert again.columns == [f.published for f in schemas.DONORS] and again.count() == 61
    assert again.filter("ID_Donante = '1'").first()["CD_Ciudad"] == "Bogotá"
