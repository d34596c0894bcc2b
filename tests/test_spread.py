"""Work that few files, wide texts and rows that multiply must not leave to few tasks."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from cityweave import session
from cityweave.operators import align, clean, cluster
from cityweave.plans import jobs
from workload import feeds, queries


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def one_file(spark, tmp_path):
    """Events of one file and one row group, with repeats and nulls."""
    start = dt.datetime(2024, 1, 1)
    rows = [
        (i % 250 if i % 11 else None, start + dt.timedelta(minutes=37 * (i % 250)), i % 7, ("click", "error", "purchase")[i % 3], i / 4, f'{{"k": {i % 100}}}')
        for i in range(500)
    ]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("topic", ["traffic", "weather", "air"])
def test_one_file_is_parsed_by_all_cores(spark, one_file, topic):
    rows = feeds.raw(spark, one_file, topic)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1
    assert sum(sizes) == feeds.table(spark, one_file, "events").where(F.col("event_type") == feeds.EVENT_TYPES[topic]).count()


def test_a_text_is_made_once_before_it_is_parsed(spark):
    lines = spark.range(10).select(F.to_json(F.struct(F.col("id").cast("string").alias("a"))).alias("value"))
    parsed = clean.parse_records(lines, StructType().add("a", StringType()))
    assert plan(parsed).count("StructsToJsonEvaluator") == 1
    assert sorted(r.a for r in parsed.collect()) == sorted(map(str, range(10)))


def test_null_text_stays_a_record(spark):
    rows = clean.parse_records(spark.createDataFrame([(None,), ('{"a": "x"}',)], "value string"), StructType().add("a", StringType())).collect()
    assert sorted((r.a, r._corrupt_record) for r in rows if r.a) == [("x", None)] and len(rows) == 2


def _topics(spark):
    def topic(n, **columns):
        values = [f"{v} AS {k}" for k, v in columns.items()]
        return spark.range(n).selectExpr("'Hanoi' AS city", "concat('2025-01-0', id % 4 + 1) AS date", "'10:00:00' AS time", *values)

    return topic(40, t="id", u="id % 2"), topic(20, w="id"), topic(12, a="id")


def test_join_is_dealt_by_its_rows_out(spark, monkeypatch):
    plain = sorted(map(tuple, align.align_topics(*_topics(spark)).collect()))
    monkeypatch.setattr(align, "PART_ROWS", 50)
    each = align.align_counted(*_topics(spark))
    assert each.rdd.getNumPartitions() == 12  # 600 rows
    assert sorted(map(tuple, align.align_topics(*_topics(spark)).collect())) == plain and len(plain) == 600


def test_only_columns_asked_for_meet(spark):
    narrow = align.align_counted(*_topics(spark), columns=["u", "w"])
    whole = align.align_counted(*_topics(spark))
    assert set(narrow.columns) == {"date", "city", "hour", "minute", "u", "w", "copies"}
    again = whole.groupBy("date", "city", "hour", "minute", "u", "w").agg(F.sum("copies").alias("copies"))
    assert sorted(map(tuple, narrow.select(again.columns).collect())) == sorted(map(tuple, again.collect()))
    assert narrow.count() < whole.count()


def test_fit_is_the_same_on_fewer_columns(spark, one_file):
    topics = feeds.stored(spark, one_file)
    fits = [cluster.fit_pollution(align.align_counted(*topics, 1440, columns=c), weight="copies") for c in (None, cluster.CLUSTERED)]
    assert fits[0].columns == fits[1].columns
    for one, other in zip(fits[0].centres, fits[1].centres, strict=True):
        assert one == pytest.approx(other)


def test_given_levels_need_no_stored_alignment(spark, one_file, monkeypatch):
    topics, names = feeds.stored(spark, one_file), []
    monkeypatch.setattr(jobs, "materialised", lambda df, name: names.append(name) or df)
    jobs.combine_job(*topics, bucket_minutes=240, model=feeds.fixed_model())
    assert names == []
    jobs.combine_job(*topics, bucket_minutes=1440)
    assert names == ["aligned"]


def test_encoding_takes_short_batches(spark):
    from cityweave.llm import binary_ids
    from cityweave.llm.common import BATCH_ROWS
    from cityweave.llm.queries import WORD_BPE

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "10000")
    binary_ids.encode(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), WORD_BPE)
    assert int(spark.conf.get(key)) == BATCH_ROWS


def test_topics_and_sides_are_stored_at_once(spark, one_file, monkeypatch):
    met = threading.Barrier(3, timeout=20)  # three are stored at the same time, or none
    plain = session.materialised
    monkeypatch.setattr(session, "materialised", lambda df, name: (met.wait(), plain(df, name))[1])
    topics = feeds.stored(spark, one_file)
    assert [df.columns for df in topics] == [feeds.clean(spark, one_file, t).columns for t in ("traffic", "weather", "air")]
    rows = align.align_counted(*topics, 1440)
    monkeypatch.undo()
    assert rows.count() == align.align_counted(*[feeds.clean(spark, one_file, t) for t in ("traffic", "weather", "air")], 1440).count() > 0


@pytest.mark.parametrize("topic", ["traffic", "weather", "air"])
def test_the_texts_of_a_clock_are_written_once(spark, one_file, topic):
    for line in ("yyyy-MM-dd, ", "HH:mm:ss"):
        written = [x for x in plan(feeds.clean(spark, one_file, topic)).splitlines() if f", {line}" in x and "to_json" not in x and "StructsToJson" not in x]
        assert sum(x.count(f", {line}") for x in written) == 1


def test_labelled_rows_are_stored_for_training_only(spark, one_file, monkeypatch):
    names, plain = [], feeds.materialised
    monkeypatch.setattr(feeds, "materialised", lambda df, name: names.append(name) or plain(df, name))
    once = queries.classify_pollution(spark, one_file)
    assert names == []
    stored = feeds.combined(spark, one_file)
    assert names == ["combined"]
    assert sorted(map(str, once.collect())) == sorted(map(str, stored.collect()))
