from collections import Counter

import pytest

from benefacta.queries.segments import SERVICE_CENTROIDS
from benefacta.streaming import scoring

ROWS = [(1, "200", "1000", "1"), (2, "n/a", "1000", "1"), (3, None, "5", "0.5"), (4, "x", "y", None), (5, "1", "NaN", "2")]
SCHEMA = "request_id long, churn string, dltv string, effectiveness string"


def rows(frames):
    scores, rejected = frames
    return (sorted((r["request_id"], r["churn"], r["segment"] is not None) for r in scores.collect()),
            sorted((r["request_id"], r["churn"], r["dltv"], r["errors"]) for r in rejected.collect()))


WANTED = ([(1, 200.0, True), (3, None, True), (5, 1.0, True)], [(2, "n/a", "1000", ["churn"]), (4, "x", "y", ["churn", "dltv"])])


def test_scores_and_rejected_records_are_both_kept(spark, tmp_path):
    folder, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(folder)
    args = (spark, folder, "*.parquet", lambda e: e, SERVICE_CENTROIDS, out, progress)
    assert rows(scoring.score_available_apart(*args)) == WANTED
    spark.createDataFrame([(6, "9", "8", "7"), (7, "?", "8", "7")], SCHEMA).write.mode("append").parquet(folder)
    scores, rejected = rows(scoring.score_available_apart(*args))
    assert [r[0] for r in scores] == [1, 3, 5, 6] and [r[0] for r in rejected] == [2, 4, 7]


def test_a_batch_written_again_leaves_no_row_twice(spark, tmp_path, monkeypatch):
    folder, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(folder)
    args = (spark, folder, "*.parquet", lambda e: e, SERVICE_CENTROIDS, out, progress)

    def broken(df):  # fails when the scores are already written
        raise RuntimeError("lost between the two")

    monkeypatch.setattr(scoring, "validate", broken)
    with pytest.raises(Exception, match="lost between the two"):
        scoring.score_available_apart(*args)
    assert spark.read.parquet(f"{out}/scores").count() == 3
    monkeypatch.undo()
    assert rows(scoring.score_available_apart(*args)) == WANTED
    batch = spark.createDataFrame(ROWS, SCHEMA)
    scoring.write_batch(batch, 0, SERVICE_CENTROIDS, out)  # the same number once more
    found = spark.read.parquet(f"{out}/scores")
    assert Counter(r["request_id"] for r in found.collect()) == {1: 1, 3: 1, 5: 1}
    assert spark.read.parquet(f"{out}/rejected").count() == 2
