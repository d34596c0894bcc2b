"""Streams: restarts, repeats, buffers, polled feeds."""

import json

from pyspark.sql import functions as F

from cityweave.operators import quality
from cityweave.schemas import RAW
from cityweave.sources.polled import PolledFeed, PollReader
from cityweave.streaming import flows


def _drain(stream, tmp_path, name="out"):
    flows.start_files(stream, str(tmp_path / name), str(tmp_path / f"{name}-state")).awaitTermination()


def test_each_record_lands_once_over_restarts(spark, tmp_path):
    landed = tmp_path / "in"
    for day in range(3):
        spark.range(day * 10, day * 10 + 10).write.mode("append").json(str(landed))
        stream = spark.readStream.schema("id bigint").json(str(landed))
        _drain(stream, tmp_path)
        _drain(stream, tmp_path)
    ids = [r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(ids) == list(range(30))


def test_repeats_across_batches_are_dropped(spark, tmp_path):
    landed = str(tmp_path / "in")
    rows = spark.createDataFrame([("1", "2025-01-01 10:00:00"), ("2", "2025-01-01 10:01:00")], "_id string, report_time string")
    for _ in range(3):
        rows.coalesce(1).write.mode("append").json(landed)
        stream = flows.with_event_time(spark.readStream.schema(rows.schema).json(landed))
        _drain(flows.stream_dedupe(stream, "event_ts", "10 minutes"), tmp_path)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_upsert_keeps_the_latest_and_a_replayed_batch_changes_nothing(spark, tmp_path):
    write = flows.upsert_sink(str(tmp_path / "t"), "_id", "report_time")
    schema = "_id string, report_time string, v int"
    first = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "1", 3)], schema)
    second = spark.createDataFrame([("a", "3", 4), ("b", "0", 5)], schema)
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        write(batch, number)
    rows = flows.read_upserted(spark, str(tmp_path / "t"), "_id", "report_time").collect()
    assert {(r["_id"], r["v"]) for r in rows} == {("a", 4), ("b", 3)}


def test_failed_flush_is_sent_again(spark, tmp_path):
    landed = str(tmp_path / "in")
    spark.range(5).write.json(landed)
    sent, fail = [], [True]

    def sink(batch, number):
        if fail[0]:
            raise OSError("down")
        sent.extend(r["id"] for r in batch.collect())

    stream = spark.readStream.schema("id bigint").json(landed)
    for _ in range(2):
        query = flows.start_batches(stream, sink, str(tmp_path / "state"), trigger=flows.DRAIN)
        try:
            query.awaitTermination()
        except Exception:
            fail[0] = False
    assert sorted(sent) == list(range(5))


def test_rules_on_a_stream(spark, tmp_path):
    landed = str(tmp_path / "in")
    spark.range(5).write.json(landed)
    stream = quality.observed(spark.readStream.schema("id bigint").json(landed), [("RowCount", ">", 0)])
    query = flows.start_files(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    seen = [p["observedMetrics"]["quality"] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p.get("observedMetrics")]
    assert sum(row["rows"] if isinstance(row, dict) else row[0] for row in seen) == 5


def test_polled_feed(spark, tmp_path):
    spark.dataSource.register(PolledFeed)
    stream = (
        spark.readStream.format("polled_feed").option("fetch", "fake_feed:fetch")
        .option("locations", json.dumps(["Hanoi", "Nowhere"])).option("interval", "1").load()
    )
    query = flows.start_files(stream, str(tmp_path / "out"), str(tmp_path / "state"), trigger={"processingTime": "1 second"})
    for _ in range(60):
        query.awaitTermination(1)
        if any(p["numInputRows"] for p in query.recentProgress):
            break
    query.stop()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["location"]: r["value"] for r in rows} == {"Hanoi": '{"name": "Hanoi"}', "Nowhere": None}
    assert all((r["error"] is None) == (r["location"] == "Hanoi") for r in rows)


def test_a_missed_poll_is_not_made_up():
    reader = PollReader({"fetch": "fake_feed:fetch", "locations": '["a", "b"]', "interval": "15"})
    assert len(reader.partitions({"tick": 1}, {"tick": 9})) == 2
    assert reader.partitions({"tick": 9}, {"tick": 9}) == []


def test_a_topic_has_its_own_interval():
    options = {"fetch": "fake_feed:fetch", "locations": "[]"}
    assert [PollReader({**options, "topic": t}).interval for t in ("air", "weather", "traffic")] == [15, 15, 60]


def test_event_time_from_each_kind_of_text(spark):
    df = spark.createDataFrame([("2025-01-01 10:00:00",), ("2025-01-01T10:00:00Z",), ("2025-01-01T17:00:00+07:00",)], "report_time string")
    got = {str(r["event_ts"]) for r in flows.with_event_time(df).select(F.col("event_ts").cast("string").alias("event_ts")).collect()}
    assert got == {"2025-01-01 10:00:00"}
    assert "report_time" in RAW["air"].names


def test_alignment_is_the_batch_one_in_another_zone(spark, tmp_path):
    """Clocks are UTC in a session of +07:00 too, buckets of four hours begin where the batch has them, repeats go."""
    from cityweave.operators import align
    from cityweave.operators.clean import clean_rows
    from cityweave.functions.timeparts import split_report_time

    times = ["2025-01-01 23:30:00", "2025-01-02 01:00:00", "2025-01-02 03:59:59", "2025-01-02 04:00:00"]
    topics = {n: [("Hanoi", t, i) for i, t in enumerate(times)] * 2 for n in "twa"}
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    try:
        streams, batches = [], []
        for n, rows in topics.items():
            df = spark.createDataFrame(rows, f"city string, report_time string, {n} int")
            df.write.parquet(str(tmp_path / n))
            streams.append(flows.with_event_time(spark.readStream.schema(df.schema).parquet(str(tmp_path / n))).drop("report_time"))
            batches.append(clean_rows(split_report_time(df)))
        joined = flows.stream_align(*streams, bucket_minutes=240, delay="10 days", cuts=3)
        flows.start_files(joined, str(tmp_path / "out"), str(tmp_path / "state"), state_partitions=2).awaitTermination()
        columns = ["date", "city", "hour", "minute", "t", "w", "a"]
        got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(columns).collect()))
        assert got == sorted(map(tuple, align.align_topics(*batches, bucket_minutes=240).select(columns).collect()))
        assert len(got) == 1 + 2**3 + 1 and ("2025-01-02", "ha noi", 0, 0, 1, 2, 1) in got
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_compaction_keeps_a_row_per_key(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "_id string, report_time string, v int"
    first = spark.createDataFrame([], schema)
    assert flows.read_upserted(spark, path, "_id", "report_time", first.schema).count() == 0
    write = flows.upsert_sink(path, "_id", "report_time", compact_every=2)
    for n in range(5):
        for _ in range(2):  # each batch is run again
            write(spark.createDataFrame([("a", str(n), n), (f"b{n}", "0", n)], schema), n)
    rows = flows.read_upserted(spark, path, "_id", "report_time").collect()
    assert {(r["_id"], r["v"]) for r in rows} == {("a", 4), *((f"b{n}", n) for n in range(5))}
    assert spark.read.parquet(f"{path}/compacted/upto=3").count() == 5


def test_combinations_with_traffic_are_not_kept_as_state(spark, tmp_path):
    sizes, streams = {"t": 40, "w": 3, "a": 2}, []
    for name, rows in sizes.items():
        df = spark.range(rows).selectExpr("'Hanoi' AS city", "timestamp'2025-01-01 10:05:00' AS event_ts", f"id AS {name}")
        df.write.parquet(str(tmp_path / name))
        streams.append(spark.readStream.schema(df.schema).parquet(str(tmp_path / name)))
    joined = flows.stream_align(*streams, bucket_minutes=60, delay="10 days")
    assert [c for c in joined.columns if c in sizes] == ["t", "w", "a"]
    started = flows.start_files(joined, str(tmp_path / "out"), str(tmp_path / "state"), state_partitions=2)
    started.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.select("t", "w", "a").distinct().count() == found.count() == 40 * 3 * 2
    operators = [o for p in started.recentProgress for o in p.stateOperators if o.operatorName == "symmetricHashJoin"]
    assert max(o.numRowsTotal for o in operators) == 40 + 3 * 2


def test_records_delivered_again_are_made_once(spark, tmp_path, monkeypatch):
    from workload import queries

    made = []
    lines = spark.createDataFrame([('{"_id": "1"}',), ('{"_id": "1"}',), ('{"_id": "2"}',)], "value string")
    monkeypatch.setattr(queries.feeds, "feed", lambda *_: made.append(1) or lines)
    monkeypatch.setattr(queries, "work_path", lambda spark, name: str(tmp_path / name))
    for copies in (1, 2):
        queries._event_stream(spark, "", ("air", "weather")[copies - 1], copies)
    landed = [sorted(r.value for r in spark.read.text(str(tmp_path / f"{t}_landed")).collect()) for t in ("air", "weather")]
    assert landed[0] == sorted(r.value for r in lines.collect()) and landed[1] == sorted(landed[0] * 2)
    assert len(made) == 2
