import glob

import pytest
from pyspark.sql import functions as F

from benefacta import session
from benefacta.plans import cleaning_jobs, lifetime
from benefacta.queries import segments
from benefacta.queries.inputs import Tables
from benefacta.sources import readers, registry, schemas, sinks
from benefacta.streaming.scoring import score_available
from conftest import AS_OF


def test_latin1_round_trip(spark, tmp_path):
    path = tmp_path / "Archivos_Cliente"
    path.mkdir()
    header = ",".join(f.raw for f in schemas.DONORS)
    line = ["1"] + [""] * (len(schemas.DONORS) - 1)
    line[11], line[18], line[2] = "Señora", "MEDELLÍN", "2020-01-05"
    (path / "Base_donantes.csv").write_bytes(f"{header}\n{','.join(line)}\n".encode("latin-1"))
    raw = registry.load(spark, "donors", str(tmp_path))
    assert raw.columns == [f.raw for f in schemas.DONORS] and raw.first()["Género"] == "Señora"
    assert spark.sql("SELECT count(*) AS n FROM donors").first()["n"] == 1

    cleaned = cleaning_jobs.clean_donors(raw, AS_OF)
    out = {n: str(tmp_path / n) for n in ("good", "new", "age_errors")}
    cleaning_jobs.write_clean_donors(cleaned, **out)
    again = readers.read_delimited(spark, out["good"])
    row = again.first()
    assert row["ID_Donante"] == "1" and row["CD_Ciudad"] == "Medellín" and row["FK_ID_Genero"] == "Señora"
    assert readers.read_delimited(spark, out["age_errors"]).count() == 1
    written = b"".join(open(f, "rb").read() for f in glob.glob(out["good"] + "/*.csv"))
    assert "Medellín".encode("latin-1") in written


def test_semicolon_source(spark, tmp_path):
    path = tmp_path / "Archivos_Cliente"
    path.mkdir()
    header = ";".join(f.raw for f in schemas.TRANSACTIONS)
    (path / "Transacciones_Individuales.csv").write_bytes(
        f"{header}\n7;03/02/2021;;;;12,5;Cobrada;Télé;;;;DI - Regular\n".encode("latin-1"))
    row = cleaning_jobs.clean_transactions(registry.load(spark, "transactions", str(tmp_path))).first()
    assert (row["donor_id"], row["amount"], row["campaign_channel"]) == (7, 12.5, "Télé")


def test_unknown_source(spark):
    with pytest.raises(KeyError):
        registry.load(spark, "nowhere", "/tmp")


def test_registered_parquet_source(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    registry.register("t", registry.Source("t", file_format="parquet"))
    assert registry.load(spark, "t", str(tmp_path)).count() == 3


def test_inflation_export(spark, tmp_path):
    lines = ["Banco", "", "Serie histórica", "x;y", "", "", "nota", f"{schemas.INFLATION_PERIOD};{schemas.INFLATION_RATE}",
             "202102;3,5", " 202101 ;1.5", "202001;2", "Nota: 202001", "fin"] + ["pie"] * 6
    path = tmp_path / "inflation.csv"
    path.write_bytes("\n".join(lines).encode("latin-1"))
    monthly = readers.read_inflation_export(spark, str(path))
    assert sorted(tuple(r) for r in monthly.collect()) == [("202001", 2.0), ("202101", 1.5), ("202102", 3.5)]
    yearly = lifetime.inflation_yearly(monthly)
    sinks.write_csv(yearly.select(F.col("year").alias("anio"), F.col("rate").alias(schemas.INFLATION_RATE)), str(tmp_path / "y"))
    assert sorted(tuple(r) for r in readers.read_yearly_inflation(spark, str(tmp_path / "y")).collect()) == [(2020, 0.02), (2021, 0.025)]


def test_request_bodies(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"inputs": [{"Churn": 0.01, "DLTV": 2000000, "Efectividad_cobro": 0.98}, {"Churn": null}]}\n')
    out = readers.parse_requests(readers.read_requests(spark, str(tmp_path / "r.json"))).collect()
    assert [tuple(r) for r in out] == [(0, "0.01", "2000000", "0.98"), (1, None, None, None)]


def test_metrics_append(spark, tmp_path):
    df = spark.createDataFrame([("r", 0, "size", 2.0)], "run_id string, cluster int, metric string, value double")
    path = str(tmp_path / "m")
    sinks.append_metrics(df, path, "kmeans")
    sinks.append_metrics(df, path, "pca")
    assert spark.read.parquet(path).groupBy("experiment").count().count() == 2
    sinks.write_table(df, str(tmp_path / "t"), ("cluster",))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_materialise_uses_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = session.shared_folder(spark)
    assert root == named.rstrip("/") if named else root
    df = session.materialise(spark.range(5), "test")
    assert df.count() == 5 and df.inputFiles()


def test_stream_equals_batch(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    stream = score_available(spark, t.folder, "events.parquet", lambda e: t.view("requests", events=e), segments.SERVICE_CENTROIDS,
                             session.fresh_path(spark, "scores"), session.fresh_path(spark, "progress"))
    from benefacta.operators.scoring import score_requests
    batch = score_requests(t.requests, segments.SERVICE_CENTROIDS)
    assert sorted(map(str, stream.collect())) == sorted(map(str, batch.select(*stream.columns).collect()))


def test_a_restarted_stream_goes_on(spark, tmp_path):
    folder, output, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    columns = "request_id long, churn string, dltv string, effectiveness string"
    sizes = []
    for part in ([(1, "0.5", "100", "1"), (2, "n/a", None, "1")], [(3, "0.7", "5", "0")]):
        spark.createDataFrame(part, columns).coalesce(1).write.mode("append").parquet(folder)
        out = score_available(spark, folder, "*.parquet", lambda e: e, segments.SERVICE_CENTROIDS, output, progress)
        sizes.append(sorted(r["request_id"] for r in out.collect()))
    assert sizes == [[1, 2], [1, 2, 3]]


def test_dataset_of_the_data_folder(spark, tmp_path):
    (tmp_path / "train.csv").write_text("a,b\n1,ñ\n", encoding="utf-8")
    assert [tuple(r) for r in readers.read_dataset(spark, str(tmp_path), "train.csv").collect()] == [("1", "ñ")]


def test_no_machine_local_folder_for_tables(spark):
    import inspect
    assert "mkdtemp" not in inspect.getsource(session)
    assert session.application_folder(spark).startswith(session.shared_folder(spark))
