import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for path in (ROOT, os.path.join(ROOT, "tools")):
    if path not in sys.path:
        sys.path.insert(0, path)

from benefacta.session import local_session  # noqa: E402

AS_OF = dt.date(2023, 6, 15)


@pytest.fixture(scope="session")
def spark():
    return local_session("benefacta-tests", cores="8", shuffle_partitions=4)


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of a column expression over a list of inputs, in order."""
    def run(values, ddl, fn, name="v"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, {name} {ddl}")
        out = df.select("i", fn(df[name]).alias("out")).collect()
        return [r["out"] for r in sorted(out, key=lambda r: r["i"])]
    return run
