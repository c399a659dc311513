"""Gate, profiles, range checks and scores."""

import logging

import pytest
from pyspark.sql import functions as F

from airhour.operators.quality import (
    DataValidationError,
    null_profile,
    quality_score,
    range_check_report,
    status_domain_report,
    table_quality,
    table_range_report,
    table_status_report,
    validate_data_quality_score,
    validate_dataframe,
)
from airhour.sources.events import event_source, separate_event_source

T = "2024-01-01T10:00:00Z"
SF = "/root/testdata/sf0.001"


def test_gate_passes(frame):
    assert validate_dataframe(frame([(T, "a", "k", 1.0)])) is True


def test_gate_custom_columns(frame):
    rows = frame([(T, "a", "k", 1.0)])
    assert validate_dataframe(rows, ["time", "location", "co_mean"]) is True
    assert validate_dataframe(rows, []) is True
    with pytest.raises(DataValidationError, match="Missing required columns"):
        validate_dataframe(rows, ["no_mean"])


def test_gate_empty(spark, frame):
    for rows in (frame([]), spark.createDataFrame([], "")):
        with pytest.raises(DataValidationError, match="DataFrame is empty"):
            validate_dataframe(rows)


def test_gate_missing_column(frame):
    with pytest.raises(DataValidationError, match="status"):
        validate_dataframe(frame([(T, "a", "k", 1.0)]).drop("status"))


def test_gate_null_time(frame):
    with pytest.raises(DataValidationError, match="Time column contains 1 null"):
        validate_dataframe(frame([(T, "a", "k", 1.0), (None, "a", "k", 1.0)]))


def test_gate_text_time(spark):
    rows = spark.createDataFrame([("2024-01-01", "a", "k")], "time string, location string, status string")
    with pytest.raises(DataValidationError, match="Time column has invalid type"):
        validate_dataframe(rows)


def test_gate_null_time_comes_before_its_type(spark):
    rows = spark.createDataFrame([(None, "a", None)], "time string, location string, status string")
    with pytest.raises(DataValidationError, match="Time column contains"):
        validate_dataframe(rows)


def test_gate_null_status(frame):
    with pytest.raises(DataValidationError, match="Status column contains 1 null"):
        validate_dataframe(frame([(T, "a", "k", 1.0), (T, "a", None, 1.0)]))


def test_unknown_status_only_warns(frame, caplog):
    with caplog.at_level(logging.WARNING):
        assert validate_dataframe(frame([(T, "a", "k", 1.0), (T, "a", "zz", 1.0)]))
    assert "1 rows have a status outside" in caplog.text


def test_out_of_range_only_warns(frame, caplog):
    with caplog.at_level(logging.WARNING):
        assert validate_dataframe(frame([(T, "a", "k", 100.5)]), pollutant_type="co")
    assert "co.co_mean lies in [100.5, 100.5]" in caplog.text


@pytest.mark.parametrize("values", [[0.0, 100.0], [None, None], [float("nan"), 50.0], [float("nan")]])
def test_range_is_inclusive_and_skips_null_and_nan(frame, caplog, values):
    with caplog.at_level(logging.WARNING):
        validate_dataframe(frame([(T, "a", "k", v) for v in values]), pollutant_type="co")
        validate_dataframe(frame([(T, "a", "k", 1e9)]), pollutant_type="meteo")
    assert "lies in" not in caplog.text


def test_range_report(frame):
    rows = frame([(T, "a", "k", v) for v in [-1.0, 0.0, 100.0, 101.0, None, float("nan")]])
    assert [tuple(r) for r in range_check_report(rows, "co").collect()] == [
        ("co", "co_mean", 0.0, 100.0, -1.0, 101.0, 2, 5)
    ]
    assert range_check_report(frame([(T, "a", "k", None)]), "co").count() == 0
    assert range_check_report(rows, "meteo") is None
    assert range_check_report(rows.drop("co_mean"), "co") is None


def test_status_report(frame):
    rows = frame([(T, "a", s, 1.0) for s in ["k", "v", "s", "m", "x", "x", "", None]])
    assert {tuple(r) for r in status_domain_report(rows).collect()} == {("x", 2), ("", 1)}


def test_null_profile(frame):
    rows = frame([(T, "a", "k", None), (T, None, "k", None)])
    got = {r["column_name"]: (r["null_count"], r["total_rows"]) for r in null_profile(rows).collect()}
    assert got == {"time": (0, 2), "location": (1, 2), "status": (0, 2), "co_mean": (2, 2)}


def test_scores(spark, frame):
    assert validate_data_quality_score(frame([(T, "a", s, 1.0) for s in "kkvv"])) == 0.75
    assert validate_data_quality_score(frame([(T, "a", "k", 1.0)])) == 1.0
    assert validate_data_quality_score(frame([])) == 0.0
    assert validate_data_quality_score(spark.createDataFrame([], "")) == 0.0
    # Half of one of three columns is missing: (5/6 + 1) / 2.
    assert validate_data_quality_score(frame([(T, "a", "k", 1.0), (T, "a", "k", None)])) == pytest.approx(11 / 12)


def test_score_without_status_or_other_columns(frame):
    rows = frame([(T, "a", "k", 1.0), (T, "a", "v", None)])
    assert validate_data_quality_score(rows.drop("status")) == pytest.approx((0.75 + 1.0) / 2)
    assert validate_data_quality_score(rows.select("time")) == 1.0


def test_score_by_group(frame):
    rows = frame([(T, "a", "k", 1.0), (T, "b", "v", 1.0)])
    got = {r["location"]: r["quality_score"] for r in quality_score(rows, ["location"]).collect()}
    assert got == {"a": 1.0, "b": 0.5}


@pytest.mark.parametrize("report", [table_quality, table_range_report, table_status_report])
def test_reports_of_many_tables_agree_with_separate_tables(spark, report):
    shared = report(event_source(spark, SF).readings())
    separate = report(separate_event_source(spark, SF).readings()).select(shared.columns)
    assert sorted(map(tuple, shared.collect())) == sorted(map(tuple, separate.collect()))


def test_reports_scan_a_shared_base_once(spark):
    for report in (table_quality, table_range_report, table_status_report):
        text = report(event_source(spark, SF).readings())._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan") == 1


def test_grouped_quality(spark):
    keys = {"location": F.col("location")}
    rows = table_quality(event_source(spark, SF).readings(["co", "nox"]), keys)
    assert rows.count() == 10 and rows.where(~F.col("quality_score").between(0, 1)).count() == 0
