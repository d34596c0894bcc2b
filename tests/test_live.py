"""Live state per key and the log of the rules on a stream."""

import time

import pytest
from pyspark.sql import functions as F

from cityweave.operators.clean import latest_per_key
from cityweave.streaming import flows, live

SCHEMA = "_id string, report_time string, v double, tags array<string>"


def _run(spark, tmp_path, batches, cuts=1, pause=0.0, **options):
    """The changes after each batch, a run of the query for every one of them."""
    landed, out = str(tmp_path / "in"), {}
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(landed, ignoreNullFields=False)
        stream = spark.readStream.schema(SCHEMA).json(landed)
        got = []
        sink = lambda batch, batch_id, got=got: got.extend(tuple(r) for r in batch.collect())
        flows.start_upserts(live.live_latest(stream, "_id", "report_time", cuts=cuts, **options), sink, str(tmp_path / "state"), 2).awaitTermination()
        out[number] = sorted(got, key=repr)
        time.sleep(pause)
    return out


BATCHES = [
    [("a", "1", 1.0, ["x"]), ("a", "3", 2.0, None), ("b", None, 1.0, ["x"]), (None, "5", 0.0, []), ("c", "1", 1.0, ["x"]), ("c", "1", 1.0, ["x", "y"])],
    [("a", "2", 9.0, None), ("b", "0", 5.0, None), ("c", "1", 1.0, ["x"]), (None, "5", 0.0, ["z"])],
    [("a", "3", 2.0, None), ("b", "0", None, None), ("d", "1", float("nan"), None), ("d", "1", 7.0, ["q"])],
]


def test_changes_are_those_of_the_latest_row_after_every_batch(spark, tmp_path):
    found, so_far, before = _run(spark, tmp_path, BATCHES), [], set()
    for number, rows in enumerate(BATCHES):
        so_far += rows
        df = spark.createDataFrame(so_far, SCHEMA)
        now = {repr(tuple(r)) for r in latest_per_key(df, "_id", "report_time").collect()}
        assert {repr(r) for r in found[number]} == now - before
        assert len(found[number]) == len(now - before)
        before = now


def test_parts_of_a_hot_key_give_the_same_table(spark, tmp_path):
    found = _run(spark, tmp_path, BATCHES, cuts=3)
    rows = spark.createDataFrame([r for batch in found.values() for r in batch], SCHEMA)
    every = spark.createDataFrame([r for batch in BATCHES for r in batch], SCHEMA)
    tables = [{repr(tuple(r)) for r in latest_per_key(df, "_id", "report_time").collect()} for df in (rows, every)]
    assert tables[0] == tables[1]


def test_a_key_is_forgotten_after_its_time(spark, tmp_path):
    found = _run(spark, tmp_path, [[("a", "3", 1.0, None)], [("a", "1", 2.0, None)]], pause=0.2, ttl_ms=100)
    assert found[1] == [("a", "1", 2.0, None)]


def test_maps_and_the_name_of_the_part_are_refused(spark):
    rows = spark.range(1).select("id", F.lit("1").alias("report_time"))
    with pytest.raises(ValueError, match="maps"):
        live.live_latest(rows.withColumn("m", F.array(F.create_map(F.lit(1), F.lit(2)))), "id", "report_time")
    with pytest.raises(ValueError, match="_cut"):
        live.live_latest(rows.withColumn("_cut", F.lit(1)), "id", "report_time")


def test_rules_of_each_batch_are_kept_over_restarts(spark, tmp_path):
    landed, rules = str(tmp_path / "in"), [("RowCount", ">=", 4), (("Completeness", "v"), ">=", 0.5)]
    log = live.RuleLog(spark, str(tmp_path / "log"), rules)
    spark.streams.addListener(log)
    try:
        for rows in ([(1, 1.0), (2, None), (3, None), (4, None)], [(5, 1.0)]):
            spark.createDataFrame(rows, "id long, v double").coalesce(1).write.mode("append").parquet(landed)
            stream = spark.readStream.schema("id long, v double").parquet(landed)
            running = flows.start_files(log.watched(stream), str(tmp_path / "out"), str(tmp_path / "state"))
            running.awaitTermination()
            log.wait(running.runId)
    finally:
        spark.streams.removeListener(log)
    found = {(r.batch, r.rule.split(" ")[0], r.outcome, r.actual) for r in live.read_rules(spark, log.path).collect()}
    assert found == {
        (0, "RowCount", "Passed", 4.0), (0, "Completeness", "Failed", 0.25), (1, "RowCount", "Failed", 1.0), (1, "Completeness", "Passed", 1.0)
    }
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_a_log_that_hears_of_no_end_says_so(spark, tmp_path):
    with pytest.raises(TimeoutError):
        live.RuleLog(spark, str(tmp_path)).wait("nothing", seconds=0.01)
