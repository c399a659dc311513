"""Table, partition and report sinks."""

import logging
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from airhour.schema import OUTPUT_COLUMNS, OUTPUT_SCHEMA
from airhour.sources.ranges import backfill_range
from airhour.sinks.tables import (
    AppendSink,
    HourPartitionSink,
    NarrowTableSink,
    ReportSink,
    Scope,
    export,
    materialise,
)


@pytest.fixture
def facts(spark):
    def make(*rows):
        columns = "time string, location string, metrica string, valor double, count_ok bigint, version string"
        return spark.createDataFrame(list(rows), columns).withColumn("time", F.col("time").cast("timestamp"))

    return make


TEN = ("2024-01-01T10:00:00Z", "a", "co", 1.25, 4, "v1")
ELEVEN = ("2024-01-01T11:00:00Z", "a", "co", None, 2, None)


def test_append_adds_rows_and_counts_them(spark, facts, tmp_path, caplog):
    sink = AppendSink(path=str(tmp_path / "t"), verify=True)
    df = facts(TEN, ELEVEN)
    with caplog.at_level(logging.INFO):
        assert export(df, [sink]) == ["append"] and sink.row_count(spark) == 2
        export(df, [sink])
    assert sink.row_count(spark) == 4 and "holds 4 rows now" in caplog.text
    assert spark.read.parquet(sink.path).columns == OUTPUT_COLUMNS


def test_append_to_a_table_and_another_format(spark, facts, tmp_path):
    table = AppendSink(table="facts_append")
    orc = AppendSink(path=str(tmp_path / "o"), fmt="orc")
    assert export(facts(TEN), [table, orc]) == ["append", "append"]
    assert table.row_count(spark) == orc.row_count(spark) == 1
    assert spark.table("facts_append").schema["time"].dataType == OUTPUT_SCHEMA["time"].dataType


def test_append_requires_all_columns(facts, tmp_path):
    with pytest.raises(ValueError, match="version"):
        export(facts(TEN).drop("version"), [AppendSink(path=str(tmp_path / "t"))])


def test_append_requires_a_target(facts):
    with pytest.raises(ValueError, match="required"):
        AppendSink().write(facts(TEN), 1)


@pytest.mark.parametrize("column", ["time", "location", "metrica", "count_ok"])
def test_null_in_a_required_column_fails(facts, tmp_path, column):
    broken = facts(TEN).withColumn(column, F.when(F.col("valor") > 9, F.col(column)))
    with pytest.raises(Exception, match=f"null in required column {column}"):
        export(broken, [AppendSink(path=str(tmp_path / "t"))])


def test_nothing_is_written_for_no_rows(facts, tmp_path, caplog):
    targets = [tmp_path / n for n in "abc"]
    with caplog.at_level(logging.WARNING):
        written = export(
            facts(),
            [AppendSink(path=str(targets[0])), ReportSink(path=str(targets[1])), HourPartitionSink(str(targets[2]))],
        )
    assert written == [] and not any(t.exists() for t in targets)
    assert "nothing to export" in caplog.text


def test_unconfigured_sink_is_skipped(facts, tmp_path, caplog):
    with caplog.at_level(logging.WARNING):
        written = export(facts(TEN), [AppendSink(), NarrowTableSink(), ReportSink(path=str(tmp_path / "r"))])
    assert written == ["report"]
    assert "append skipped: missing configuration" in caplog.text


def test_narrow_table(spark, facts, tmp_path):
    sink = NarrowTableSink(table="narrow_facts", location=str(tmp_path / "n"))
    export(facts((*TEN[:3], 0.1, 4, "v1"), ELEVEN), [sink])
    export(facts(TEN), [sink])
    stored = spark.table("narrow_facts")
    assert [k for _, k in stored.dtypes] == ["timestamp", "string", "string", "float", "int", "string"]
    assert stored.count() == 3
    assert stored.select(F.max("valor")).first()[0] == 1.25
    assert stored.where("valor < 1").select(F.col("valor").cast("double")).first()[0] == pytest.approx(0.1, abs=1e-8)


def test_narrow_table_rejects_a_count_that_does_not_fit(facts, tmp_path):
    sink = NarrowTableSink(table="narrow_small", location=str(tmp_path / "n"))
    with pytest.raises(Exception, match="OVERFLOW|overflow"):
        export(facts((*TEN[:4], 2**31, "v1")), [sink])


def test_reports_are_kept_for_each_run(spark, facts, tmp_path):
    sink = ReportSink(path=str(tmp_path / "deep" / "er" / "report"), single_file=True)
    export(facts(TEN, ELEVEN).repartition(4), [sink])
    first = sink.written
    export(facts(TEN).repartition(4), [sink])
    assert first != sink.written and len(list(Path(sink.written).glob("*.csv"))) == 1
    files = list(Path(first).glob("*.csv"))
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert lines[0] == ",".join(OUTPUT_COLUMNS) and len(lines) == 3
    assert any(line.startswith("2024-01-01T10:00:00.000,a,co,1.25,4,v1") for line in lines)


def test_reports_have_as_many_files_as_partitions(spark, facts, tmp_path):
    sink = ReportSink(path=str(tmp_path / "r"))
    rows = facts(*[(f"2024-01-01T{h:02d}:00:00Z", "a", "co", float(h), 1, "v") for h in range(20)])
    export(rows.repartition(4), [sink])
    assert len(list(Path(sink.written).glob("*.csv"))) == 4
    assert spark.read.csv(sink.written, header=True).count() == 20


def test_null_key_fails_before_any_sink(facts, tmp_path):
    path = tmp_path / "report"
    with pytest.raises(Exception, match="null in required column location"):
        export(facts(("2024-01-01T10:00:00Z", None, "co", 1.0, 1, "v")), [ReportSink(path=str(path))])
    assert not path.exists()


def test_emptied_hours_of_a_scope_go(spark, facts, tmp_path):
    sink = HourPartitionSink(path=str(tmp_path / "p"))
    export(facts(TEN, ELEVEN), [sink])
    scope = [Scope(("co",), backfill_range("2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z"))]
    only = facts(("2024-01-01T12:00:00Z", "a", "co", 2.0, 1, "v3"))
    export(only, [sink], 1, scope)
    left = {(r.metrica, r.hour) for r in spark.read.parquet(sink.path).select("metrica", F.hour("time").alias("hour")).collect()}
    assert ("co", 12) in left and ("co", 10) not in left


def test_repeated_hours_are_replaced(spark, facts, tmp_path):
    sink = HourPartitionSink(path=str(tmp_path / "p"))
    export(facts(TEN, ELEVEN), [sink])
    export(facts((*TEN[:3], 9.0, 1, "v2")), [sink])
    got = {tuple(r) for r in spark.read.parquet(sink.path).select("valor", "version").collect()}
    assert got == {(9.0, "v2"), (None, None)}
    export(facts((*TEN[:3], 9.0, 1, "v2")), [sink])
    assert spark.read.parquet(sink.path).count() == 2


def test_day_unit_keeps_other_hours(spark, facts, tmp_path):
    sink = HourPartitionSink(path=str(tmp_path / "p"), unit="day")
    next_day = ("2024-01-02T10:00:00Z", "a", "co", 5.0, 1, "v")
    export(facts(TEN, ELEVEN, next_day), [sink])
    export(facts(TEN), [sink])
    assert spark.read.parquet(sink.path).count() == 3
    with pytest.raises(ValueError, match="unit"):
        export(facts(TEN), [HourPartitionSink(path=str(tmp_path / "q"), unit="week")])


def test_materialised_rows_are_computed_once(spark, facts):
    kept, rows = materialise(spark.range(1000).select(F.rand().alias("r")))
    assert rows == 1000
    assert kept.agg(F.sum("r")).first() == kept.agg(F.sum("r")).first()
    assert "Range" not in kept._jdf.queryExecution().executedPlan().toString()
