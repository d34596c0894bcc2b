"""Tables that don't need each other are stored at the same time."""

import threading

import pytest

from cityweave import session


def test_jobs_run_at_the_same_time_and_keep_their_order(spark):
    met = threading.Barrier(3, timeout=20)  # passed only if all three run
    assert session.at_once(spark, *[lambda n=n: (met.wait(), n)[1] for n in range(3)]) == [0, 1, 2]


def test_a_job_that_fails_is_told(spark):
    def fails():
        raise ValueError("lost")

    with pytest.raises(ValueError, match="lost"):
        session.at_once(spark, lambda: 1, fails)


def test_tables_stored_at_once_are_whole(spark):
    frames = [spark.range(n).selectExpr("id", f"{n} AS n") for n in (0, 3, 5)]
    stored = session.all_materialised([(df, "t") for df in frames])
    assert [sorted(map(tuple, df.collect())) for df in stored] == [[(i, n) for i in range(n)] for n in (0, 3, 5)]
    assert all("FileScan parquet" in df._jdf.queryExecution().executedPlan().toString() for df in stored)
