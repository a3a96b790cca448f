"""The jobs from named files to named files, as a scheduler would call them.

Client files are text. Each is turned into columns once, in the shared folder; every later pass
(means, place dictionaries, the result) then reads only the columns it needs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import features, outliers, reduction
from ..session import materialise
from ..sources import readers, registry, schemas, sinks, spreadsheet
from . import cleaning_jobs, experiments, lifetime, segmentation

# Tables between the jobs, below the output folder, as parquet with this package's column names.
TABLES = ("donors", "transactions", "cancellations", "lifetime_value", "segments")


def _table(spark: SparkSession, out: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{out.rstrip('/')}/{name}")


def _transactions(spark: SparkSession, out: str) -> DataFrame:
    """The accepted transactions; the filter prunes the stored folders."""
    return cleaning_jobs.accepted(_table(spark, out, "transactions")).drop("row_status")


def run_cleaning(spark: SparkSession, root: str, out: str, as_of: dt.date) -> None:
    """Clean the three client files; all rows are stored, by row status, transactions also by stage."""
    def staged(name):
        return materialise(registry.load(spark, name, root), f"{name}-raw")

    donors = cleaning_jobs.clean_donors(staged("donors"), as_of)
    sinks.write_table(donors, f"{out}/donors", ("row_status",))
    # each of the others is one narrow pass, so the text is read directly
    transactions = cleaning_jobs.clean_transactions(registry.load(spark, "transactions", root))
    sinks.write_table(transactions, f"{out}/transactions", ("row_status", "stage"))
    cancellations = cleaning_jobs.clean_cancellations(registry.load(spark, "cancellations", root))
    sinks.write_table(cancellations, f"{out}/cancellations", ("row_status",))


def export_cleaned(spark: SparkSession, out: str, csv_root: str) -> None:
    """The cleaned tables as CSV files with the published headers."""
    def target(name):
        return f"{csv_root.rstrip('/')}/{registry.SOURCES[name].path}"

    donors = _table(spark, out, "donors")
    for name, rows in (("donors_clean", F.col("row_status") == "ok"), ("donors_new", F.col("row_status") == "new"),
                       ("donors_age_errors", F.col("age_was_error") & (F.col("row_status") != "text_date"))):
        part = donors.filter(rows).select(*[f.name for f in schemas.DONORS])
        sinks.write_csv(part, target(name), schemas.DONORS)
    for name, table, layout in (("transactions_clean", "transactions", schemas.TRANSACTIONS),
                                ("cancellations_clean", "cancellations", schemas.CANCELLATIONS)):
        rows = cleaning_jobs.accepted(_table(spark, out, table))
        sinks.write_csv(rows.select(*[f.name for f in layout]), target(name), layout)


def export_lifetime_value(spark: SparkSession, out: str, csv_root: str) -> None:
    """The stored lifetime values as a CSV file with the published headers."""
    values = _table(spark, out, "lifetime_value").select(*[f.name for f in schemas.LIFETIME_VALUE])
    sinks.write_csv(values, f"{csv_root.rstrip('/')}/{registry.SOURCES['lifetime_value'].path}", schemas.LIFETIME_VALUE)


def run_lifetime_value(spark: SparkSession, out: str, inflation_export: str, as_of: dt.date) -> None:
    """Lifetime values of the accepted donors; the stage filter prunes the stored transactions."""
    donors = cleaning_jobs.accepted(_table(spark, out, "donors"))
    read = spreadsheet.read_inflation_sheet if inflation_export.lower().endswith(".xlsx") else readers.read_inflation_export
    monthly = read(spark, inflation_export)
    values = lifetime.donor_lifetime_value(donors, _transactions(spark, out), monthly, as_of)
    sinks.write_table(values, f"{out}/lifetime_value")


def segmentation_table(spark: SparkSession, out: str) -> DataFrame:
    donors = cleaning_jobs.accepted(_table(spark, out, "donors"))
    values = features.donor_features(_table(spark, out, "lifetime_value"), _transactions(spark, out))
    return features.segmentation_input(values, donors)


def run_training(spark: SparkSession, out: str, version: str, k: int | None = None, restarts: int = 10) -> str:
    """Train, label all donors, store the labels, the run's metrics and the model; returns the path of the model."""
    training = segmentation.train_segments(segmentation_table(spark, out), k=k, restarts=restarts)
    donors = cleaning_jobs.accepted(_table(spark, out, "donors"))
    sinks.write_table(segmentation.with_segments(donors, training.labelled), f"{out}/segments")
    record = experiments.run_record(training, segmentation.FEATURES, version, restarts=restarts)
    sinks.append_metrics(record, f"{out}/metrics", "training")
    return sinks.save_model(training.model, f"{out}/models", version)


def run_assignment(spark: SparkSession, out: str, model_path: str) -> DataFrame:
    """Label the accepted donors with a stored model and name the segments; new donors are marked."""
    table = _table(spark, out, "donors")
    donors = cleaning_jobs.accepted(table).drop("row_status")
    new = table.filter(F.col("row_status") == "new").drop("row_status")
    labelled = segmentation.assign_with_model(segmentation_table(spark, out), readers.load_model(model_path))
    coded = segmentation.with_segments(donors, labelled)
    named = segmentation.label_donors(coded, new)
    sinks.write_table(named, f"{out}/segments")
    return _table(spark, out, "segments")


def run_experiments(spark: SparkSession, out: str, run_id: str) -> None:
    """K-means on the stored lifetime values, and the same on component scores; their records go to the metrics."""
    values = _table(spark, out, "lifetime_value")
    fitted = experiments.kmeans_experiment(values)
    sinks.append_metrics(experiments.run_record(fitted, experiments.KMEANS_COLUMNS, run_id), f"{out}/metrics", "kmeans")
    donors = cleaning_jobs.accepted(_table(spark, out, "donors"))
    table = features.experiment_table(lifetime.with_instalment_averages(values, donors), donors, _transactions(spark, out))
    fitted = experiments.pca_experiment(table)
    names = list(reduction.SCORE_NAMES)
    record = experiments.run_record(fitted, names, run_id, n_components=len(names))
    sinks.append_metrics(record, f"{out}/metrics", "pca")


def split_values(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """Stored lifetime values without and with outliers."""
    return outliers.split_outliers(_table(spark, out, "lifetime_value"), "dltv")
