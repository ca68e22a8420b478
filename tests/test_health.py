import pytest
from pyspark.sql import functions as F

from ebbtide.streaming import health


@pytest.mark.parametrize(
    "states, stale_after, want",
    [
        (["RUNNING", "RUNNING"], 60, "current"),
        (["RUNNING", "FAILED"], 60, "failed"),
        (["FINISHED"], 60, "stopped"),
        ([], 60, "stopped"),
        (["RUNNING"], 40, "stale"),
    ],
)
def test_job_verdict(spark, states, stale_after, want):
    rows = [(f"q{i}", s, 1, 1, "boom" if s == "FAILED" else None) for i, s in enumerate(states)]
    jobs = spark.createDataFrame(rows, health.JOB_SCHEMA)
    windows = spark.sql("SELECT TIMESTAMP'2024-01-01 00:59:10' AS window_end")
    now = F.expr("TIMESTAMP'2024-01-01 01:00:00'")
    found = health.job_verdict(jobs, windows, stale_after, now).first()
    assert found["verdict"] == want and found["age_seconds"] == "50"
    assert found["failed"] == [f"q{i}" for i, s in enumerate(states) if s == "FAILED"]
    assert health.job_verdict(jobs, windows.limit(0), 60, now).first()["age_seconds"] == "n/a"
