"""Clustered layout, and the gate on a stream."""

import pytest
from pyspark.sql import functions as F

from airhour.session import prepare_streaming
from airhour.sinks.clustering import clustered, compact_clustered, folder_bytes, interleaved, write_clustered
from airhour.streaming.gate import GatedStream, GateListener, broken, gate_rules
from airhour.streaming.hourly import read_stream


def test_interleaved_bits(spark):
    pairs = [(0, 0), (1, 0), (0, 1), (65535, 0), (0, 65535), (65535, 65535), (0b1010, 0b0110), (4097, 300)]
    frame = spark.createDataFrame(pairs, "a int, b int")
    for row in frame.withColumn("key", interleaved(F.col("a"), F.col("b"))).collect():
        expected = sum(((row.a >> k & 1) << (2 * k + 1)) | ((row.b >> k & 1) << (2 * k)) for k in range(16))
        assert row.key == expected


def readings(spark, n=200_000):
    return spark.range(n).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.xxhash64("id"), F.lit(90 * 86400))).alias("time"),
        F.concat(F.lit("s"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64))).alias("location"),
        F.rand(1).alias("value"),
    )


def scanned_rows(df):
    """Rows that the file scan gave, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.getClass().getSimpleName() else plan
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


NARROW = "time >= '2024-02-10' AND time < '2024-02-12' AND location = 's17'"


def test_narrow_ranges_read_few_row_groups(spark, tmp_path):
    rows = readings(spark)
    plain, laid_out = str(tmp_path / "plain"), str(tmp_path / "clustered")
    rows.repartition(8).write.option("parquet.block.size", 64 << 10).parquet(plain)
    write_clustered(rows, laid_out, 8, group_bytes=64 << 10)
    result = [sorted(map(str, spark.read.parquet(p).where(NARROW).collect())) for p in (plain, laid_out)]
    assert result[0] == result[1] and result[0]
    assert scanned_rows(spark.read.parquet(plain).where(NARROW)) > 100_000
    assert scanned_rows(spark.read.parquet(laid_out).where(NARROW)) < 20_000
    assert scanned_rows(spark.read.parquet(laid_out).where("location = 's17'")) < 60_000
    assert scanned_rows(spark.read.parquet(laid_out).where("time >= '2024-02-10' AND time < '2024-02-12'")) < 60_000


def test_compaction_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "small")
    rows = readings(spark, 5000).cache()
    rows.repartition(40).write.parquet(path)
    assert compact_clustered(spark.read.parquet(path), path, folder_bytes(spark, path), file_bytes=64 << 10) < 5
    assert len(list((tmp_path / "small").glob("*.parquet"))) < 5
    assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, rows.collect()))


def test_clustering_odd_rows(spark):
    rows = spark.createDataFrame([(None, "a"), ("2024-01-01", None), (None, None)], "time string, location string")
    rows = rows.withColumn("time", F.col("time").cast("timestamp"))
    assert clustered(rows, 3).count() == 3
    assert clustered(rows.where("location = 'a'"), 3).count() == 1
    assert clustered(rows.limit(0), 3).count() == 0


SCHEMA = "time timestamp, location string, status string, co_mean double"


@pytest.fixture
def inbox(spark, tmp_path):
    prepare_streaming(spark)

    def drop(*rows):
        texts = "time string, location string, status string, co_mean double"
        frame = spark.createDataFrame(list(rows), texts).withColumn("time", F.col("time").cast("timestamp"))
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "inbox"))

    return drop


GOOD = ("2024-01-01 10:00:00", "a", "k", 1.0)


def test_gate_of_a_stream(spark, inbox, tmp_path):
    gate = GatedStream(str(tmp_path / "gate"), gate_rules("co", strict=True))
    seen = {}
    listener = GateListener(lambda batch, counts: seen.update({batch: counts}))
    spark.streams.addListener(listener)
    try:
        batches = [
            [GOOD, (None, "a", "k", 1.0), ("2024-01-01 10:00:00", None, None, 101.0)],
            [GOOD, GOOD, ("2024-01-01 10:00:00", "a", "x", None)],
        ]
        for rows in batches:
            inbox(*rows)
            stream = read_stream(spark, str(tmp_path / "inbox"), stream_schema(spark))
            gate.start(stream, str(tmp_path / "checkpoint")).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert sorted(map(tuple, gate.counts(spark).collect())) == [(0, 3, 1, 2), (1, 3, 2, 1)]
    assert gate.valid(spark).count() == 3 and gate.valid(spark).columns == ["time", "location", "status", "co_mean"]
    reasons = sorted((r.batch, sorted(r.broken)) for r in gate.quarantined(spark).collect())
    assert reasons == [(0, ["co_mean out of range", "null location", "null status"]), (0, ["null time"]), (1, ["unknown status"])]
    assert {b: (c["rows_read"], c["rows_valid"], c["rows_quarantined"]) for b, c in seen.items()} == {0: (3, 1, 2), 1: (3, 2, 1)}


def stream_schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_a_repeated_batch_is_kept_once(spark, tmp_path):
    gate = GatedStream(str(tmp_path / "gate"))
    rows = spark.createDataFrame([GOOD, (None, "a", "k", 1.0)], "time string, location string, status string, co_mean double")
    for _ in range(2):
        gate.apply(gate.marked(rows), 0)
    assert [tuple(r) for r in gate.counts(spark).collect()] == [(0, 2, 1, 1)]
    assert gate.valid(spark).count() == 1


def test_no_rules(spark):
    assert spark.range(2).withColumn("b", broken({})).where("size(b) = 0").count() == 2
