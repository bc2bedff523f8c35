"""Job analysis against DuckDB where numbers stand next to a half and where runs have no seconds."""

import datetime

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

# Per job, its click and view; quotients next to a half in the third or seventh decimal.
SECONDS = [(77.77, 0.4), (36.0, 36.54), (39.36, 12.8), (0.4, 13.57), (16.98, 0.8), (0.0, 2.0), (1.0, 640.0), (1.0, None)]


@pytest.mark.parametrize("name", ["job_analysis", "job_analysis_readings"])
def test_numbers_next_to_a_half(spark, tmp_path, name):
    at = datetime.datetime(2024, 1, 1)
    rows = [(job * 100 + run, at, job, kind, pair[i], "{}") for job, pair in enumerate(SECONDS)
            for i, (run, kind) in enumerate([(10, "click"), (79, "view")])]
    rows += [(751, at, 7, "view", 4.0, "{}"), (790, at, 7, "view", 5.0, "{}"), (720, at, 8, "view", None, "{}"),
             (850, at, 8, "view", 2.5, "{}"), (860, at, 8, "click", 3.0, "{}")]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).coalesce(1).write.parquet(str(tmp_path / "written"))
    path = next((tmp_path / "written").glob("*.parquet"))
    path.rename(tmp_path / "events.parquet")
    assert compare(entry.queries()[name](spark, str(tmp_path)), connect(str(tmp_path)), entry.oracle_sql()[name]) == []


# Factors that are infinite, no number, have more digits than a double tells apart, or round to a zero with a sign.
ODD_SECONDS = [(float("inf"), 2.0), (2.0, float("inf")), (-float("inf"), 2.0), (float("nan"), 2.0), (2.0, float("nan")),
               (1e300, 1e-300), (-3.7, 1e-9), (-1e300, 1e-300), (1e-320, 2.0), (-0.0, 2.0), (-1e-8, 2.0), (1.0, -2.0),
               (123456789.125, 1e-9), (-1e-10, 59.03e7)]


@pytest.mark.parametrize("name", ["job_analysis", "job_analysis_readings"])
def test_factors_that_are_no_plain_number(spark, tmp_path, name):
    at = datetime.datetime(2024, 1, 1)
    rows = [(job * 100 + run, at, job, kind, pair[i], "{}") for job, pair in enumerate(ODD_SECONDS)
            for i, (run, kind) in enumerate([(10, "click"), (79, "view")])]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).coalesce(1).write.parquet(str(tmp_path / "written"))
    path = next((tmp_path / "written").glob("*.parquet"))
    path.rename(tmp_path / "events.parquet")
    assert compare(entry.queries()[name](spark, str(tmp_path)), connect(str(tmp_path)), entry.oracle_sql()[name]) == []
