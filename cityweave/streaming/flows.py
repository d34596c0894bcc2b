"""Topic flows on Structured Streaming. Each has the same result as its batch twin."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from cityweave.functions.columns import field
from cityweave.functions.timeparts import iso_to_naive, utc_clock
from cityweave.functions.values import CITY_ALIASES, normalise_city
from cityweave.operators.clean import latest_per_key

# Fixed value: seconds between uploads of buffered incidents.
FLUSH_SECONDS = 300

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
_starting = threading.Lock()

Trigger = Mapping[str, object]
DRAIN: Trigger = {"availableNow": True}


def start_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    format: str = "parquet",
    trigger: Trigger = DRAIN,
    partition_by: Sequence[str] = (),
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append to files. Each record lands once, also when the query stops and starts again.

    ``DRAIN`` takes what has arrived since the last run and ends, like a job with a bookmark.
    ``state_partitions`` is the number of parts that state is kept in, on disk; the first start of a
    query fixes it for as long as its checkpoint lives. Unset, number and store are the session's.
    """
    writer = stream.writeStream.format(format).option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(stream.sparkSession, writer.outputMode("append").trigger(**trigger), state_partitions)


def _start(spark: SparkSession, writer: DataStreamWriter, state_partitions: int | None, **more: str) -> StreamingQuery:
    if state_partitions is None:
        return writer.start()
    conf = spark.conf
    wanted = {"spark.sql.shuffle.partitions": str(state_partitions), _STORE: _ROCKS, **more}
    with _starting:  # one at a time, as the settings are the session's
        before = {key: conf.get(key) for key in wanted}
        for key, value in wanted.items():
            conf.set(key, value)
        try:
            return writer.start()  # a started query keeps its own copy of the settings
        finally:
            for key, value in before.items():
                conf.set(key, value)


def start_upserts(
    changes: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, state_partitions: int, trigger: Trigger = DRAIN
) -> StreamingQuery:
    """Hand each batch of a stream of changes to ``sink``; its state lies on disk, in ``state_partitions`` parts.

    Batches without data are off: a state that forgets by processing time asks for one after the other, and ``DRAIN`` would never end.
    What is due to be forgotten goes with the next batch that has data.
    """
    writer = changes.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("update").trigger(**trigger)
    return _start(changes.sparkSession, writer, state_partitions, **{_NO_DATA: "false"})


def start_batches(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Trigger = {"processingTime": f"{FLUSH_SECONDS} seconds"},
) -> StreamingQuery:
    """Collect records between triggers and hand each buffer to ``sink``.

    A sink that raises gets the same batch again after a restart.
    """
    return (
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def upsert_sink(path: str, key: str, order: str, compact_every: int = 0) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that keeps one row per key of each batch.

    A batch owns the folder ``batches/batch=<id>`` and overwrites it when it is run again. Nothing that
    earlier batches wrote is rewritten; ``read_upserted`` picks the survivor. Every ``compact_every``
    batches, all that came so far is brought down to a row per key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, key, order).write.mode("overwrite").parquet(f"{path}/batches/batch={batch_id}")
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_upserted(batch.sparkSession, path, key, order, batch_id)

    return write


def _parts(spark: SparkSession, path: str, level: str) -> DataFrame | None:
    """A folder of numbered parts, None as long as there is none."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return found if level in found.columns else None


def _upserted(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame | None:
    """The rows of the last compaction and of the batches after it, in no order."""
    batches, base = _parts(spark, f"{path}/batches", "batch"), _parts(spark, f"{path}/compacted", "upto")
    if batches is None:
        return None
    if upto is not None:
        batches = batches.where(F.col("batch") <= upto)
        base = None if base is None else base.where(F.col("upto") < upto)
    last = None if base is None else base.agg(F.max("upto")).first()[0]  # folder names only
    if last is None:
        return batches.drop("batch")
    return batches.where(F.col("batch") > last).drop("batch").unionByName(base.where(F.col("upto") == last).drop("upto"))


def compact_upserted(spark: SparkSession, path: str, key: str, order: str, upto: int) -> None:
    """Brings all batches up to number ``upto`` down to one row per key; run again, it gives the same folder."""
    rows = _upserted(spark, path, upto)
    if rows is not None:
        latest_per_key(rows, key, order).write.mode("overwrite").parquet(f"{path}/compacted/upto={upto}")


def read_upserted(spark: SparkSession, path: str, key: str, order: str, schema: StructType | None = None) -> DataFrame:
    """The surviving row of each key; no rows of ``schema`` as long as no batch came."""
    rows = _upserted(spark, path)
    if rows is None:
        if schema is None:
            raise ValueError("no batch came yet; give the schema")
        return spark.createDataFrame([], schema)
    return latest_per_key(rows, key, order)


def stream_dedupe(stream: DataFrame, event_time: str, delay: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Drop repeats of a record that is polled again and again.

    The event time is part of the key, so state older than ``delay`` can go and a repeat is
    found however many batches lie between, unless it is later than that.
    """
    columns = list(keys or stream.columns)
    if event_time not in columns:
        columns.append(event_time)
    return stream.withWatermark(event_time, delay).dropDuplicates(columns)


def stream_dedupe_moving(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeats of a record by its keys alone, whatever time the repeat carries.

    A feed that is asked again stamps the same incident anew. Its first delivery stays; a repeat is known by its keys until the watermark is
    ``delay`` beyond the event time of that delivery, and only so long is it kept as state.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def with_event_time(flat: DataFrame, source: str = "report_time", output: str = "event_ts") -> DataFrame:
    """Event time as ``timestamp``, the type watermarks need, from clock text, ISO text or a clock.

    Clocks are UTC, whatever the session's zone.
    """
    value, kind = field(source), flat.schema[source].dataType.typeName()
    if kind == "string":
        value = iso_to_naive(value)
    if kind != "timestamp":
        value = F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), value))
    return flat.withColumn(output, value)


def stream_align(
    traffic: DataFrame,
    weather: DataFrame,
    air: DataFrame,
    bucket_minutes: int = 1,
    delay: str = "10 minutes",
    event_time: str = "event_ts",
    aliases=CITY_ALIASES,
    cuts: int = 1,
) -> DataFrame:
    """Rows of three streams that share city and time bucket, each combination of distinct rows once.

    Repeats go first, as the batch jobs' clean step does. Every side has a watermark and the bucket is part of
    the join key, so the join forgets a bucket once all sides have passed it. With ``cuts`` the traffic
    of a key is dealt into so many parts and the other sides are copied to each, so that a key's
    state is spread over as many tasks. Weather and air meet first: traffic, taken for the largest side, is
    held as state by its own rows only, not by its combinations with another side.
    """
    if bucket_minutes < 1 or 1440 % bucket_minutes:
        raise ValueError("bucket_minutes has to divide the 1440 minutes of a day")
    size = f"{bucket_minutes} minutes"
    sides = []
    for topic in (traffic, weather, air):
        timed = stream_dedupe(normalise_city(topic, aliases=aliases), event_time, delay)
        own = F.pmod(F.xxhash64(*[field(c) for c in timed.columns]), F.lit(cuts)).cast("int")
        cut = F.explode(F.sequence(F.lit(0), F.lit(cuts - 1))) if sides else own
        sides.append(timed.withColumn("cut", cut).withColumn("bucket", F.window(event_time, size)).drop(event_time))
    keys = ["city", "bucket", "cut"]
    joined = sides[0].join(sides[1].join(sides[2], keys), keys)
    clock = utc_clock(F.col("bucket")["start"])
    return joined.withColumns(
        {"date": F.date_format(clock, "yyyy-MM-dd"), "hour": F.hour(clock), "minute": F.minute(clock)}
    ).drop("bucket", "cut")
