"""Polls of the past, fan-out with a ledger, partial delivery, repeats with other times, bookmarked increments, duplicates of all types."""

import datetime
import json
import os
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cityweave.operators import align, profile
from cityweave.plans import bookmarks
from cityweave.schemas import CLEAN
from cityweave.sinks.delivery import DELIVERED, PARKED, deliver, delivery_sink
from cityweave.sinks.ledger import Ledger, fan_out_sink, read_outcomes
from cityweave.sources.polled import PollReader
from cityweave.streaming import flows

# --- polled feeds


def test_the_past_is_polled_tick_by_tick():
    reader = PollReader({"fetch": "fake_feed:fetch", "locations": '["a", "b"]', "interval": "15", "history": "true", "first_tick": "3", "last_tick": "9"})
    assert reader.initialOffset() == {"tick": 2} and reader.latestOffset() == {"tick": 9}
    polls = reader.partitions({"tick": 2}, {"tick": 5})
    assert [(p.tick, p.location) for p in polls] == [(t, x) for t in (3, 4, 5) for x in "ab"]
    assert reader.partitions({"tick": 9}, {"tick": 9}) == []


def test_arguments_reach_the_feed():
    reader = PollReader({"fetch": "fake_feed:located", "locations": '["a"]', "interval": "1", "history": "true", "arguments": json.dumps({"root": "r"})})
    (poll,) = reader.partitions({"tick": 6}, {"tick": 7})
    location, _, body, error, tick = next(reader.read(poll))
    assert (location, body, error, tick) == ("a", "a/7/r", None, 7)


# --- fan-out


def _append(path):
    return lambda rows, batch_id: rows.write.mode("append").parquet(path)


def _three_files(spark, path):
    for part in range(3):
        spark.range(part * 10, part * 10 + 10).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("failing", ["first", "second"])
def test_each_sink_takes_each_batch_once(spark, tmp_path, failing):
    out, state, calls = str(tmp_path / "out"), str(tmp_path / "state"), []
    stream = _three_files(spark, str(tmp_path / "in"))

    def sink(name):
        def write(batch, batch_id):
            calls.append((name, batch_id))
            if name == failing and calls.count((name, batch_id)) <= 2 and batch_id == 1:
                raise OSError("away")
            _append(f"{out}/{name}")(batch, batch_id)

        return write

    both = fan_out_sink({n: sink(n) for n in ("first", "second")}, out, [("RowCount", ">", 9), ("RowCount", ">", 10)])
    ended = []
    for _ in range(3):
        running = flows.start_batches(stream, both, state, trigger=flows.DRAIN)
        try:
            running.awaitTermination()
            ended.append(True)
        except StreamingQueryException:
            ended.append(False)
    assert ended == [False, False, True]
    for name in ("first", "second"):
        assert sorted(r.id for r in spark.read.parquet(f"{out}/{name}").collect()) == list(range(30))
    other = {"first": "second", "second": "first"}[failing]
    assert calls.count((failing, 1)) == 3 and all(calls.count((other, b)) == 1 for b in range(3))
    entries = {(r.batch, r.sink): r.rows for r in Ledger(f"{out}/ledger").entries(spark).collect()}
    assert entries == {(b, s): 10 for b in range(3) for s in ("first", "second", "rules")}
    found = sorted((r.batch, r.outcome, r.actual) for r in read_outcomes(spark, out).collect())
    assert found == sorted((b, o, 10.0) for b in range(3) for o in ("Passed", "Failed"))


def test_a_batch_that_all_sinks_took_is_left_alone(spark, tmp_path):
    calls = []
    sink = fan_out_sink({"only": lambda rows, batch_id: calls.append((batch_id, rows.count()))}, str(tmp_path))
    for _ in range(2):
        sink(spark.range(3), 0)
    sink(spark.range(0), 1)
    assert calls == [(0, 3), (1, 0)]
    with pytest.raises(ValueError):
        fan_out_sink({"rules": lambda rows, batch_id: None}, str(tmp_path))


# --- partial delivery


def test_refused_records_alone_are_sent_again(spark, tmp_path):
    rows = spark.range(100).select("id", F.lit("x").alias("value"))
    report = deliver(rows, "receivers:picky", str(tmp_path / "report"), tries=3, batch_records=25, pause=0.0)
    got = {r.id: (r.status, r.tries, r.error) for r in report.collect()}
    assert len(got) == 100

    def want(i, lost):
        refused = i // 10 if i % 10 == 0 else 0
        tries = max(refused, 1 if lost else 0) + 1
        return (DELIVERED, tries, None) if tries <= 3 else (PARKED, 3, f"no {i}")

    # Record 50 takes its whole call down once; which records share it depends on the parts.
    assert all(got[i] in (want(i, False), want(i, True)) for i in got)
    assert sum(s == PARKED for s, _, _ in got.values()) == 7 and got[50][0] == PARKED and got[10] [:2] == (DELIVERED, 2)
    assert sorted(report.columns) == ["error", "id", "status", "tries", "value"]


def test_a_receiver_has_to_answer_for_all(spark, tmp_path):
    report = deliver(spark.range(3), "receivers:short", str(tmp_path / "r"), tries=2, pause=0.0).collect()
    assert {(r.status, r.tries) for r in report} == {(PARKED, 2)} and "every record" in report[0].error
    assert deliver(spark.range(0), "receivers:short", str(tmp_path / "e"), pause=0.0).count() == 0
    with pytest.raises(ValueError):
        deliver(spark.range(1).withColumn("status", F.lit(1)), "receivers:short", str(tmp_path / "x"))


def test_delivery_of_a_stream(spark, tmp_path):
    stream = _three_files(spark, str(tmp_path / "in"))
    out = str(tmp_path / "report")
    flows.start_batches(stream, delivery_sink("receivers:picky", out, tries=2, pause=0.0, arguments={"worst": 11}), str(tmp_path / "s"), trigger=flows.DRAIN).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.groupBy("batch").count().where("count = 10").count() == 3
    assert sorted(r.id for r in rows.where(F.col("status") == PARKED).collect()) == [22]


# --- repeats with other times


def test_a_repeat_with_another_time_is_known_by_its_key(spark, tmp_path):
    landed = str(tmp_path / "in")
    for minute in (0, 7, 14):
        rows = [(str(i), f"2025-01-01 10:{minute:02}:00") for i in range(4)] + [(f"only{minute}", f"2025-01-01 10:{minute:02}:30")]
        spark.createDataFrame(rows, "_id string, report_time string").coalesce(1).write.mode("append").json(landed)
        stream = flows.with_event_time(spark.readStream.schema("_id string, report_time string").json(landed))
        flows.start_files(flows.stream_dedupe_moving(stream, ["_id"], "event_ts", "1 hour"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = sorted((r._id, r.report_time) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted([(str(i), "2025-01-01 10:00:00") for i in range(4)] + [(f"only{m}", f"2025-01-01 10:{m:02}:30") for m in (0, 7, 14)])


# --- bookmarks


def _topic(spark, topic, rows):
    filler = {"string": "x", "int": 1, "double": 1.5, "bigint": 1}
    full = [tuple(r.get(f.name, filler[f.dataType.simpleString()]) for f in CLEAN[topic]) for r in rows]
    return spark.createDataFrame(full, CLEAN[topic])


def _readings(spark, n):
    at = lambda k: {"city": "Hanoi" if k % 2 else "Da Nang", "date": "2025-01-01", "time": f"10:{k % 3:02}:00"}
    return {
        "traffic": _topic(spark, "traffic", [{"_id": f"{n}-{k}", **at(k)} for k in range(5)]),
        "weather": _topic(spark, "weather", [{"temperature": float(n * 10 + k), **at(k)} for k in range(4)]),
        "air": _topic(spark, "air", [{"uv": float(n), **at(k)} for k in range(3)] * 2),
    }


def _plain(df):
    return sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


def test_increments_give_what_one_run_gives(spark, tmp_path, monkeypatch):
    paths, state = {t: str(tmp_path / t) for t in bookmarks.TOPICS}, str(tmp_path / "state")
    assert bookmarks.combine_increment(spark, paths, state) is None and bookmarks.read_combined(spark, state) is None
    arrivals = [("traffic", "weather"), ("air",), ("traffic", "weather", "air"), ("weather",)]
    for n, topics in enumerate(arrivals):
        for topic, rows in _readings(spark, n).items():
            if topic in topics:
                rows.write.mode("append").parquet(paths[topic])
        if n == 2:  # a run that is cut off before its manifest doesn't count, and is done again

            def cut_off(*_):
                raise OSError("lost")

            with monkeypatch.context() as m:
                m.setattr(type(spark), "createDataFrame", cut_off)
                with pytest.raises(OSError):
                    bookmarks.combine_increment(spark, paths, state)
        assert bookmarks.combine_increment(spark, paths, state) == n
        assert bookmarks.combine_increment(spark, paths, state) is None
        if n:
            whole = align.align_topics(*[spark.read.schema(CLEAN[t]).parquet(paths[t]) for t in bookmarks.TOPICS])
            assert _plain(bookmarks.read_combined(spark, state)) == _plain(whole)


# --- duplicates


_CLOCK = "timestamp'2025-01-01 10:00:00.{:06}'"
_OF_A_TYPE = {
    "clock": [_CLOCK.format(k) for k in (0, 1, 1, 2)],
    "naive": [_CLOCK.replace("timestamp", "timestamp_ntz").format(k) for k in (0, 1, 1, 2)],
    "double": ["0.0D", "-0.0D", "double('nan')", "double('nan')", "1e300D", "cast(null as double)"],
    "float": ["float(0)", "float(-0.0)", "float('inf')", "float('inf')"],
    "array": ["array(0.0D)", "array(-0.0D)", "array(cast(null as double))", "cast(null as array<double>)", "cast(array() as array<double>)"],
    "array of structs": ["array(named_struct('a', -0.0D))", "array(named_struct('a', 0.0D))", "array(cast(null as struct<a:double>))"],
    "struct": [f"named_struct('a', named_struct('t', {_CLOCK.format(k)}))" for k in (1, 2, 2)],
    "empty struct": ["cast(null as struct<a:int>)", "named_struct('a', cast(null as int))", "named_struct('a', 1)"],
    "date": ["date'2025-01-01'", "date'2025-01-01'", "date'0001-01-01'"],
    "decimal": ["cast(1.10 as decimal(9,2))", "cast(1.1 as decimal(9,2))", "cast(1.11 as decimal(9,2))"],
    "binary": ["X'00'", "X'01'", "X''", "X'00'"],
    "boolean": ["true", "false", "cast(null as boolean)", "true"],
    "text": ["'1'", "''", "cast(null as string)", "' '", "''"],
    "interval": ["interval 1 day", "interval 24 hour", "interval 2 day"],
}


@pytest.mark.parametrize("name", sorted(_OF_A_TYPE))
def test_duplicates_of_every_type(spark, name):
    df = spark.sql(" UNION ALL ".join(f"SELECT {v} AS v, 1 AS w" for v in _OF_A_TYPE[name]))
    assert profile.profile_duplicates(df).first().duplicates == df.count() - df.distinct().count()


def test_duplicates_across_a_change_of_clocks(spark):
    rows = [(datetime.datetime(2025, 10, 26, 0, 30, tzinfo=datetime.UTC), Decimal("1")), (datetime.datetime(2025, 10, 26, 1, 30, tzinfo=datetime.UTC), Decimal("1"))]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert profile.profile_duplicates(spark.createDataFrame(rows, "t timestamp, d decimal(9,2)")).first().duplicates == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


# --- the entry


@pytest.mark.parametrize("absent", ["ahocorasick", "regex", "public_tokenizers", "tokenizers"])
def test_an_absent_package_takes_no_other_query_away(absent):
    code = f"import sys; sys.modules[{absent!r}] = None\nimport __spark_entry__ as e\nfrom workload.queries import REGISTRY\nassert set(REGISTRY) <= set(e.queries())\nassert set(e.oracle_sql()) <= set(e.queries())"
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": str(root) + os.pathsep + os.environ.get("PYTHONPATH", "")}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
