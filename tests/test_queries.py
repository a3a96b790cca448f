"""Every query with a SQL twin gives the same rows as DuckDB; the others give rows."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import compare
from benefacta.queries import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FITTED = [n for n in registry.QUERIES if n not in registry.ORACLES]


@pytest.fixture(scope="module")
def con():
    return compare.oracle(FOLDER)


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows_as_sql(spark, con, name):
    outcome = compare.compare(spark, con, FOLDER, name)
    assert outcome.startswith("ok"), outcome


@pytest.mark.parametrize("name", FITTED)  # their ``_facts`` are among the twins
def test_fits_give_rows(spark, name):
    assert f"{name}_facts" in registry.ORACLES or name == "kprototypes_cost"
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_silhouettes_score_every_row(spark, tmp_path):
    vectors = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.sin(F.col("id") * (i + 1)).cast("float"))
    table = spark.range(1500).select(F.col("id").alias("vec_id"), (F.col("id") % 3).cast("int").alias("label"), vectors.alias("embedding"))
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    names = [n for n in registry.QUERIES if n.startswith("silhouette")]
    assert {n: entry.queries()[n](spark, str(tmp_path)).select("vec_id").distinct().count() for n in names} == {
        "silhouette_squared": 1500, "silhouette_euclidean": 1500}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "donor_id" and "dltv" in df.columns
    assert df.count() > 0
