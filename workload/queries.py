"""One query per operator. Each reads whole tables under ``sf_dir``."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import partial
from pathlib import Path

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cityweave.functions import timeparts, values
from cityweave.functions.columns import field
from cityweave.operators import align, choices, clean, cluster, features, flatten, kept, lines, models, profile, quality, quantiles, stats
from cityweave.plans import bookmarks
from cityweave.schemas import INT, LONG, PARTITION_LEVELS, REAL, TEXT, struct
from cityweave.session import at_once, materialised, work_path
from cityweave.sinks.delivery import deliver
from cityweave.sinks.files import UPLOAD_RECORDS, fan_out, write_documents, write_json
from cityweave.sinks.ledger import fan_out_sink, read_outcomes
from cityweave.sources.concat_json import read_concat_json
from cityweave.sources.polled import PolledFeed
from cityweave.sources.topics import read_collection, read_stream, read_topic
from cityweave.streaming import flows, live
from workload import feeds
from workload.feeds import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
DAY_MS = 86_400_000


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str, places: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(field(c), places) for c in columns})


# --- sources ---------------------------------------------------------------------------------


def _land_raw(spark: SparkSession, sf_dir: str, topic: str, name: str) -> str:
    """Store the raw feed as JSON lines, as the delivery stream leaves it."""
    path = work_path(spark, name)
    feeds.feed(spark, sf_dir, topic).select("value").write.text(path)
    return path


@query
def scan_topic(spark, sf_dir):
    path = work_path(spark, "traffic_raw")
    write_json(feeds.raw(spark, sf_dir, "traffic"), path, partition_by=PARTITION_LEVELS)
    topic = read_topic(spark, "traffic", path)
    return topic.select("_id", "properties.city", "properties.delay", *PARTITION_LEVELS)


@query
def collection_scan(spark, sf_dir):
    """A stored document collection whose ``_id`` is not text."""
    path = work_path(spark, "collection")
    feeds.events(spark, sf_dir).select(F.col("event_id").alias("_id"), "city", "value").write.parquet(path)
    return read_collection(spark, "parquet", {"path": path})


def _notes() -> Column:
    """Texts that look like the place between two objects."""
    texts = ["plain", "a } { b", "}", "{", 'say "}{" \\', "{}}{{", "tail \\\\"]
    return F.get(F.array(*[F.lit(t) for t in texts]), (F.col("event_id") % len(texts)).cast("int"))


@query
def concat_json(spark, sf_dir):
    """Uploads of touching objects, some with blanks or line ends between, read by whole file and cut by the reader."""
    path = work_path(spark, "concat")
    record = F.to_json(F.struct("event_id", "k", "value", _notes().alias("note")))
    gap = F.get(F.array(*[F.lit(g) for g in ("", "", "\n", " \r\n ", " ")]), (F.col("event_id") % 5).cast("int"))
    uploads = (
        feeds.events(spark, sf_dir)
        .groupBy(F.floor(F.col("event_id") / UPLOAD_RECORDS).alias("upload"))  # at most 100 rows each
        .agg(F.concat_ws("", F.collect_list(F.concat(record, gap))).alias("value"))
    )
    uploads.select("value").write.option("maxRecordsPerFile", 1000).option("lineSep", " ").text(path)
    schema = struct(event_id=LONG, k=INT, value=REAL, note=TEXT)
    out = None
    for mode, whole in (("files", True), ("cut", False)):
        records, rejected = clean.valid_records(read_concat_json(spark, path, schema, whole_files=whole))
        bad = rejected.agg(F.count("*").alias("event_id")).select("event_id", *[F.lit(None).cast(t).alias(c) for c, t in (("k", "int"), ("value", "double"))], F.lit("rejects").alias("note"))
        part = records.unionByName(bad).withColumn("mode", F.lit(mode))
        out = part if out is None else out.unionByName(part)
    return out


@query
def topic_rejects(spark, sf_dir):
    """Every line of a damaged feed as good or bad, by batch and by stream: some are cut off, some hold two records."""
    path, out = work_path(spark, "damaged"), work_path(spark, "damaged_out")
    lines = feeds.feed(spark, sf_dir, "traffic").select("value", F.get_json_object("value", "$._id").cast("bigint").alias("n"))
    value = F.when(F.col("n") % 10 == 0, F.expr("substring(value, 1, length(value) - 3)"))
    value = value.when(F.col("n") % 15 == 1, F.concat("value", "value")).otherwise(F.col("value"))
    lines.select(value.alias("value")).write.text(path)
    stream = read_stream(spark, "traffic", path, rejects=True)
    flows.start_files(stream, out, work_path(spark, "state")).awaitTermination()
    batch = read_topic(spark, "traffic", path, layout="bare", rejects=True)
    both = batch.select("_id", "_corrupt_record", F.lit("batch").alias("mode")).unionByName(
        spark.read.schema(stream.schema).parquet(out).select("_id", "_corrupt_record", F.lit("stream").alias("mode"))
    )
    bad = F.regexp_extract("_corrupt_record", '"_id":"([0-9]+)"', 1)
    rejected = F.col("_corrupt_record").isNotNull()
    return both.select(
        "mode", F.when(rejected, bad).otherwise(F.col("_id")).alias("_id"), F.when(rejected, "bad").otherwise("good").alias("state")
    )


@query
def explode_incidents(spark, sf_dir):
    polls = (
        feeds.incidents(spark, sf_dir)
        .groupBy(F.floor(F.col("event_id") / 50).alias("poll"), F.col("city").alias("polled"))  # at most 50 rows each
        .agg(F.collect_list("incident").alias("incidents"))
    )
    single = flatten.explode_incidents(polls)
    stamped = flatten.stamp_incident(single, F.col("polled"))
    return stamped.select("_id", "properties.city", "properties.delay", "poll")


# --- nested extraction and reshaping -----------------------------------------------------------


@query
def flatten_air(spark, sf_dir):
    return flatten.flatten_air(feeds.raw(spark, sf_dir, "air"))


@query
def flatten_traffic(spark, sf_dir):
    flat = flatten.flatten_traffic(feeds.raw(spark, sf_dir, "traffic"))
    return flat.withColumn("event_code", F.col("event_code").cast("double"))


@query
def first_event(spark, sf_dir):
    raw = feeds.raw(spark, sf_dir, "traffic")
    event = flatten.first_of(F.col("properties.events"))
    return raw.select(
        "_id",
        F.size("properties.events").alias("n_events"),
        event["code"].cast("double").alias("event_code"),
        event["description"].alias("event_desc"),
    )


def _weather_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: timeparts.clock_text(field(c)) for c in ("sunrise", "sunset") if c in df.columns})


@query
def flatten_weather(spark, sf_dir):
    return _weather_text(flatten.flatten_weather(feeds.raw(spark, sf_dir, "weather")))


@query
def drop_columns(spark, sf_dir):
    flat = flatten.flatten_weather(feeds.raw(spark, sf_dir, "weather"))
    return flatten.drop_columns(flat, "sunrise", "sunset", "country", "base", "partition_0")


@query
def stamp_records(spark, sf_dir):
    clock = F.lit("2024-02-01 08:30:00").cast("timestamp_ntz")
    raw = flatten.stamp_incident(feeds.raw(spark, sf_dir, "traffic").drop("_id"), F.lit("Da Nang"))
    return flatten.stamp(raw, report_time=timeparts.clock_text(clock)).select("_id", "properties.city", "report_time")


@query
def columns_by_type(spark, sf_dir):
    return profile.columns_by_type(table(spark, sf_dir, "customer"), "number")


@query
def head_n(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


# --- cleaning ------------------------------------------------------------------------------------


def _gappy_lineitem(spark, sf_dir) -> DataFrame:
    """Line items in which a discount of 0 counts as missing."""
    return table(spark, sf_dir, "lineitem").withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))


@query
def dropna_any(spark, sf_dir):
    rows = _gappy_lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_returnflag")
    return clean.dropna_any(rows)


@query
def dedupe_rows(spark, sf_dir):
    return clean.dedupe_rows(table(spark, sf_dir, "documents").select("text", "lang"))


@query
def category_filter(spark, sf_dir):
    flat = flatten.flatten_traffic(feeds.raw(spark, sf_dir, "traffic"))
    return clean.category_filter(flat).select("_id", "city", "iconCategory")


# Boxes that the cities are asked for.
CITY_BOXES = [
    ("Ho Chi Minh City", 106.532129, 10.66594, 106.831575, 10.883411),
    ("Hanoi", 105.2849, 20.5645, 106.0201, 21.3853),
    ("Da Nang", 107.818782, 15.917955, 108.574858, 16.344307),
]


@query
def bbox_assign(spark, sf_dir):
    boxes = _city_boxes(spark)
    raw = feeds.raw(spark, sf_dir, "traffic")
    points = raw.select("_id", flatten.first_vertex(F.col("geometry.coordinates")).alias("v")).select("_id", "v.lon", "v.lat")
    return clean.bbox_assign(points, boxes)


def _city_boxes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITY_BOXES, "city string, min_lon double, min_lat double, max_lon double, max_lat double")


def _line_text() -> Column:
    """Coordinates around each city: points, lines with their ends outside, several lines, upright ones, and texts that are none."""
    n, k, pick = F.col("event_id"), F.col("k"), F.col("user_id") % 3
    x, y = (F.get(F.array(*map(F.lit, c)), pick.cast("int")) for c in ((105.65, 108.2, 106.68), (20.97, 16.13, 10.77)))
    eighth = lambda c, width: (c % width - width // 2) / F.lit(8.0)

    def position(lon: Column, lat: Column) -> Column:
        return F.concat(F.lit("["), lon.cast("string"), F.lit(", "), lat.cast("string"), F.lit("]"))

    def several(*parts: Column) -> Column:
        return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))

    near = position(x + eighth(k, 9), y + eighth(n, 5))
    across = several(position(x - 2, y + eighth(k, 17)), position(x + 2, y + eighth(n, 17)), position(x + 2, y + 3))
    upright = several(position(x + eighth(k, 9), y - 3), position(x + eighth(k, 9), y + 3))
    text = F.when(n % 6 == 0, near).when(n % 6 == 1, across).when(n % 6 == 2, several(several(position(x - 2, y - 2), position(x + 2, y + 2)), upright))
    return text.when(n % 6 == 3, several(near)).when(n % 6 == 4, F.lit("[[106.0, null], [105.0, 21.0]]"))


@query
def lines_in_boxes(spark, sf_dir):
    rows = feeds.events(spark, sf_dir).where("event_type = 'click'")
    found = lines.lines_in_boxes(rows.select("event_id", _line_text().alias("coordinates")), _city_boxes(spark))
    return rounded(found, "inside", places=6)


@query
def valid_records(spark, sf_dir):
    cut = F.when(F.col("event_id") % 10 == 0, F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    lines = table(spark, sf_dir, "events").select("event_id", cut.alias("value"))
    good, bad = clean.valid_records(clean.parse_records(lines, struct(k=INT)))
    good = good.select("event_id", F.col("k").cast("double").alias("k"), F.lit("good").alias("state"))
    return good.unionByName(bad.select("event_id", F.lit(None).cast("double").alias("k"), F.lit("bad").alias("state")))


@query
def latest_per_key(spark, sf_dir):
    rows = feeds.events(spark, sf_dir).select(
        F.col("user_id").alias("_id"), timeparts.clock_text(F.col("ts")).alias("report_time"), "event_id", "event_type", "value"
    )
    return clean.latest_per_key(rows, "_id", "report_time", tie_break=["event_id"])


# --- values ----------------------------------------------------------------------------------------


@query
def normalise_city(spark, sf_dir):
    return values.normalise_city(feeds.events(spark, sf_dir).select("event_id", "city"))


@query
def split_report_time(spark, sf_dir):
    """Every third time carries its fraction."""
    text = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(
        timeparts.clock_text(F.col("ts"))
    )
    return timeparts.split_report_time(table(spark, sf_dir, "events").select("event_id", text.alias("report_time")))


@query
def hour_minute(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "HH:mm:ss").alias("time"))
    return timeparts.hour_minute(rows)


@query
def iso_to_naive(spark, sf_dir):
    """Every second text is in a +07:00 zone."""
    iso = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, "Z").otherwise("+07:00")
    )
    return table(spark, sf_dir, "events").select(
        "event_id", timeparts.clock_text(timeparts.iso_to_naive(iso)).alias("report_time")
    )


@query
def epoch_to_ts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(o_orderdate as timestamp_ntz))")
    return orders.select(
        "o_orderkey", timeparts.clock_text(timeparts.epoch_to_clock(seconds + F.col("o_orderkey") % 86400)).alias("at")
    )


@query
def resolve_choice(spark, sf_dir):
    """``length`` by turns as double only, integer only, both, neither."""
    kind = F.col("event_id") % 4
    choice = F.struct(
        F.when(kind.isin(0, 2), F.col("value")).alias("double"), F.when(kind.isin(1, 2), F.col("k")).alias("int")
    )
    return (
        feeds.events(spark, sf_dir)
        .select("event_id", choice.alias("length"))
        .withColumn("length", values.resolve_choice(F.col("length")))
    )


def _unsettled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents whose ``length`` comes as double, integer, two kinds of text, null, or not at all; some records are cut off."""
    kind, value = F.col("event_id") % 6, F.col("value").cast("string")
    length = F.when(kind == 0, value).when(kind == 1, F.col("k").cast("string")).when(kind == 2, F.concat(F.lit('"'), value, F.lit('"')))
    length = length.when(kind == 3, F.lit('"far"')).when(kind == 4, F.lit("null"))
    inner = F.concat_ws(", ", F.concat(F.lit('"k": '), F.col("k")), F.concat(F.lit('"length": '), length))
    text = F.concat(F.lit('{"id": '), F.col("event_id"), F.lit(', "properties": {'), inner, F.lit("}}"))
    text = F.when(F.col("event_id") % 10 == 9, F.substring(text, 1, 12)).otherwise(text)
    return feeds.events(spark, sf_dir).select("event_id", choices.open_record(text).alias("record"))


@query
def variant_choice(spark, sf_dir):
    value = choices.nested(F.col("record"), "properties", "length")
    return _unsettled(spark, sf_dir).select("event_id", choices.kind(value).alias("kind"), choices.number_of(value).alias("length"))


@query
def variant_fields(spark, sf_dir):
    """Every field with the kinds in which it comes, and whether they make it a choice."""
    kinds = materialised(choices.field_kinds(_unsettled(spark, sf_dir)), "field_kinds")
    unsettled = choices.choices(kinds).select("path", F.concat_ws(",", "kinds").alias("choice"))
    return kinds.join(unsettled, "path", "left").select(F.concat_ws(".", "path").alias("path"), "kind", "rows", "choice")


@query
def map_labels(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", values.map_labels(F.col("label") % 4).alias("level"))


@query
def to_json_record(spark, sf_dir):
    text = values.json_record(feeds.events(spark, sf_dir).select("event_id", "city", "value"))
    return text.select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
        F.get_json_object("value", "$.city").alias("city"),
        F.get_json_object("value", "$.value").cast("double").alias("value"),
    )


@query
def json_roundtrip(spark, sf_dir):
    path = work_path(spark, "air_clean")
    write_json(feeds.clean(spark, sf_dir, "air"), path)
    return read_topic(spark, "air", path, stage="clean")


# --- topic jobs and alignment ------------------------------------------------------------------------


@query
def clean_air(spark, sf_dir):
    return feeds.clean(spark, sf_dir, "air")


@query
def clean_traffic(spark, sf_dir):
    return feeds.clean(spark, sf_dir, "traffic")


@query
def clean_weather(spark, sf_dir):
    return feeds.clean(spark, sf_dir, "weather")


@query
def align_topics(spark, sf_dir):
    return feeds.aligned(spark, sf_dir, 60)


@query
def unmatched_cities(spark, sf_dir):
    """Traffic and weather agree on the cities; the third topic misses one alias."""
    traffic, weather, air = (feeds.raw(spark, sf_dir, t) for t in ("traffic", "weather", "air"))
    return align.unmatched_cities(
        traffic.select("properties.city"),
        weather.select(F.col("name").alias("city")),
        air.select(F.when(F.col("location.name") == "Ap Ba", "Ap Bac").otherwise(F.col("location.name")).alias("city")),
    )


# --- profiling and statistics ------------------------------------------------------------------------


@query
def profile_shape(spark, sf_dir):
    return profile.profile_shape(table(spark, sf_dir, "lineitem"))


@query
def profile_duplicates(spark, sf_dir):
    return profile.profile_duplicates(table(spark, sf_dir, "documents").select("text", "lang"))


@query
def profile_duplicates_clocks(spark, sf_dir):
    """Rows whose clocks differ in microseconds only, and zeros of either sign inside of a struct."""
    rows = table(spark, sf_dir, "events").select(
        "event_type",
        F.timestamp_add("MICROSECOND", (F.col("event_id") % 3).cast("int"), F.date_trunc("DAY", "ts")).alias("ts"),
        F.array(F.struct((F.when(F.col("event_id") % 2 == 0, 0.0).otherwise(-0.0) * F.lit(1.0)).alias("zero"), (F.col("user_id") % 5).alias("user"))).alias("nested"),
    )
    return profile.profile_duplicates(rows)


@query
def profile_nulls(spark, sf_dir):
    return profile.profile_nulls(_gappy_lineitem(spark, sf_dir))


@query
def profile_info(spark, sf_dir):
    return profile.profile_info(_gappy_lineitem(spark, sf_dir))


@query
def profile_zeros(spark, sf_dir):
    return profile.profile_zeros(_gappy_lineitem(spark, sf_dir))


@query
def profile_outliers(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("unit_price_sq", F.col("l_extendedprice") * F.col("l_quantity"))
    return profile.profile_outliers(rows, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "unit_price_sq"])


@query
def kept_profiles(spark, sf_dir):
    """Profiles stored per topic and day in two arrivals, merged per topic, and whether each quartile's exact rank is within twice the stated error."""
    path, probs = work_path(spark, "profiles"), (0.25, 0.5, 0.75)
    value = F.when(F.col("event_id") % 11 > 0, F.col("value"))
    rows = feeds.events(spark, sf_dir).select("event_id", F.col("event_type").alias("topic"), F.to_date("ts").alias("day"), value.alias("value"), "k")
    for arrival in (0, 1):
        daily = kept.profiles(rows.where(F.col("event_id") % 2 == arrival), ["topic", "day"], ["value", "k"])
        daily.write.mode("append").parquet(path)
    found = kept.kept_quantiles(kept.merged(spark.read.schema(daily.schema).parquet(path), ["topic"]), probs)
    found = materialised(found.drop("sketch"), "profiles_merged")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), field(c).cast("double").alias("x")) for c in ("value", "k")])
    met = rows.select("topic", F.inline(cells)).join(found.select("topic", "column", "quantiles"), ["topic", "column"])
    places = [F.get("quantiles", F.lit(i)) for i in range(len(probs))]
    ranks = met.groupBy("topic", "column").agg(
        *[F.count_if(F.col("x") < at).alias(f"below_{i}") for i, at in enumerate(places)],
        *[F.count_if(F.col("x") <= at).alias(f"upto_{i}") for i, at in enumerate(places)],
    )
    room, present = 2 * kept.rank_error(), F.col("rows") - F.col("missing")
    close = [
        (F.col(f"below_{i}") <= (p + room) * present) & (F.col(f"upto_{i}") >= (p - room) * present) for i, p in enumerate(probs)
    ]
    named = [c.alias(n) for c, n in zip(close, ("q1_close", "median_close", "q3_close"), strict=True)]
    return found.join(ranks, ["topic", "column"]).select("topic", "column", "rows", "missing", "zeros", "low", "high", *named)


@query
def iqr_outliers(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") * F.col("l_quantity")).alias("weight")
    )
    return rounded(profile.iqr_outliers(rows, "weight"), "weight", places=2)


@query
def histogram20(spark, sf_dir):
    bins = profile.histogram(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])
    return rounded(bins, "bin_low", "bin_high")


@query
def histogram_scaled(spark, sf_dir):
    rows = features.robust_scale(table(spark, sf_dir, "customer"), ["c_acctbal"])
    return rounded(profile.histogram(rows, ["c_acctbal"]), "bin_low", "bin_high")


@query
def kde_curve(spark, sf_dir):
    curve = profile.kde_curve(table(spark, sf_dir, "customer"), ["c_acctbal"])
    return curve.select(
        "column", "point", F.round("x", 4).alias("x"), F.round("density", 10).alias("density"), F.round("height", 4).alias("height")
    )


@query
def kde_binned(spark, sf_dir):
    curve = profile.kde_curve(table(spark, sf_dir, "lineitem"), ["l_extendedprice"], mode="binned")
    return curve.select(
        "column", "point", F.round("x", 4).alias("x"), F.round("density", 10).alias("density"), F.round("height", 4).alias("height")
    )


@query
def boxplot_stats(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("weight", F.col("l_extendedprice") * F.col("l_quantity"))
    box = profile.boxplot_stats(rows, ["l_quantity", "l_extendedprice", "weight"])
    return rounded(box, "q1", "median", "q3", "whisker_low", "whisker_high", places=2)


@query
def dq_rules(spark, sf_dir):
    rules = [("ColumnCount", ">", 0), ("RowCount", ">", 0), (("Completeness", "l_discount"), ">=", 0.95)]
    return rounded(quality.evaluate_rules(_gappy_lineitem(spark, sf_dir), rules), "actual")


def _labelled_orders(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("weekday", F.date_format("o_orderdate", "E"))
    return features.label_encode(orders, "o_orderpriority", "target")


@query
def group_moments(spark, sf_dir):
    moments = stats.group_moments(_labelled_orders(spark, sf_dir), ["o_orderstatus", "weekday"], "target")
    return rounded(moments, "mean", "variance")


@query
def anova_f(spark, sf_dir):
    tested = stats.anova_f(_labelled_orders(spark, sf_dir), ["o_orderstatus", "weekday"], "target")
    return rounded(tested, "f_stat", "p_value")


# --- features ------------------------------------------------------------------------------------------


@query
def label_encode(spark, sf_dir):
    return features.label_encode(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "code")


@query
def string_index(spark, sf_dir):
    return features.string_index(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", "code")


def _gappy_part(spark, sf_dir) -> DataFrame:
    """Parts with null sizes and NaN prices."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_size")).alias("p_size"),
        F.when(F.col("p_partkey") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("p_retailprice")).alias("p_retailprice"),
    )


@query
def impute_mean(spark, sf_dir):
    filled = features.impute_mean(_gappy_part(spark, sf_dir), ["p_size", "p_retailprice"])
    return rounded(filled, "p_size", "p_retailprice")


@query
def zscore(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(features.zscore(rows, ["p_size", "p_retailprice"]), "p_size", "p_retailprice")


@query
def robust_scale(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(features.robust_scale(rows, ["p_size", "p_retailprice"]), "p_size", "p_retailprice")


@query
def robust_scale_ml(spark, sf_dir):
    """Whether each row's scale lies between those of exact quartiles at the ranks that the stated error allows."""
    columns, error = ["p_size", "p_retailprice"], 0.001
    rows = table(spark, sf_dir, "part").select("p_partkey", *columns)
    scaled = features.vector_values(features.robust_scale_ml(rows, columns), "scaled_features")
    exact = quantiles.exact_quantiles(rows, columns, [0.25 - error, 0.25 + error, 0.75 - error, 0.75 + error])
    within = []
    for i, c in enumerate(columns):
        low, high = exact[c][2] - exact[c][1], exact[c][3] - exact[c][0]
        scale = field(c) / F.nullif(F.get("scaled_features", F.lit(i)), F.lit(0.0))
        # Ranks fall on rows, so an end may be off by the step to the next value: a hundredth is allowed for.
        within.append(F.coalesce(scale.between(low * 0.99, high * 1.01), field(c) == 0).alias(f"within_{i}"))
    return scaled.select("p_partkey", *within)


@query
def hash_split(spark, sf_dir):
    first, second = features.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    return first.withColumn("part", F.lit("train")).unionByName(second.withColumn("part", F.lit("test")))


@query
def assemble_features(spark, sf_dir):
    rows = features.assemble_features(table(spark, sf_dir, "part"), ["p_size", "p_retailprice"])
    return features.vector_values(rows).select("p_partkey", F.posexplode("features").alias("pos", "value"))


# --- clustering --------------------------------------------------------------------------------------


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CENTRES = [[-1.0, -0.8, 0.3, 0.1], [0.1, 0.0, -0.6, 0.7], [1.1, 1.2, 0.2, -0.4]]


def _scored_lineitem(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *MEASURES)
    return features.zscore(rows, MEASURES)


@query
def kmeans_assign(spark, sf_dir):
    assigned = cluster.kmeans_assign(_scored_lineitem(spark, sf_dir), MEASURES, CENTRES)
    return assigned.select("l_orderkey", "l_linenumber", "l_partkey", "cluster", F.round("distance", 4).alias("distance"))


@query
def centroid_profile(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    stats_ = features.centre_and_spread(rows, MEASURES)
    return rounded(cluster.centroid_profile(rows, MEASURES, CENTRES, stats_), "value")


def _fit_facts(rows: DataFrame, columns: list[str], centres: list, weight: str | None = None) -> DataFrame:
    """One row: how many clusters, how many rows they hold, and whether each centre is the mean of its rows."""
    times = F.lit(1) if weight is None else F.col(weight)
    means = [(F.sum(field(c) * times) / F.sum(times)).alias(f"m{i}") for i, c in enumerate(columns)]
    own = cluster.kmeans_assign(rows, columns, centres).groupBy("cluster").agg(F.sum(times).alias("rows"), *means)
    centre = F.get(F.array(*[F.array(*map(F.lit, c)) for c in centres]), F.col("cluster"))
    far = F.greatest(*[F.abs(F.get(centre, F.lit(i)) - F.col(f"m{i}")) for i in range(len(columns))], F.lit(0.0))
    return own.agg(
        F.count("*").alias("clusters"), F.sum("rows").cast("bigint").alias("rows"), (F.max(far) < 1e-3).alias("centred")
    )


@query
def kmeans_fit(spark, sf_dir):
    """A fit that has converged: every row in a cluster, every centre the mean of its rows."""
    scores = features.zscore(table(spark, sf_dir, "lineitem").select(*MEASURES), MEASURES)
    model = cluster.kmeans_fit(scores, F.array(*[field(c) for c in MEASURES]))
    return _fit_facts(scores, MEASURES, [list(map(float, c)) for c in model.clusterCenters()])


@query
def classify_pollution(spark, sf_dir):
    """The combine job end to end, with levels of a model that is given."""
    return feeds.labelled(spark, sf_dir)


@query
def pollution_fit(spark, sf_dir):
    """The combine job's fit on combinations that count as often as they occur."""
    each = materialised(align.align_counted(*feeds.stored(spark, sf_dir), bucket_minutes=60, columns=cluster.CLUSTERED), "aligned")
    model = cluster.fit_pollution(each, weight="copies")
    scores = each.select("copies", *[features.scaled(each, c, *model.stats[c]).alias(c) for c in model.columns])
    facts = _fit_facts(scores, list(model.columns), model.centres, "copies")
    return facts.withColumn("levels", F.lit(",".join(sorted(model.names.values()))))


# --- models ----------------------------------------------------------------------------------------------


ROW_KEY = ("_id", "date", "city", "hour", "minute")


def trained(rows: DataFrame, kind: str) -> models.Trained:
    train_df, test_df = features.hash_split(rows, "_id")
    return models.train(train_df, test_df, kind)


def _training(spark, sf_dir, kind: str) -> DataFrame:
    """Rows of each set and level, and whether the metrics are those of MLlib's own evaluator."""
    rows = feeds.combined(spark, sf_dir)
    found = trained(rows, kind)
    ours = {(r.dataset, r.metric): r.value for r in found.metrics.collect()}
    cells = _scored_cells(found, dict(zip(("train", "test"), features.hash_split(rows, "_id"), strict=True)))
    out = None
    for name in ("train", "test"):
        scored = cells.where(F.col("dataset") == name)
        theirs = MulticlassClassificationEvaluator(labelCol=models.LABEL_INDEX, metricName="accuracy", weightCol="times").evaluate(scored)
        same = abs(theirs - ours[name, "accuracy"]) < 1e-9 and all(0 <= ours[name, m] <= 1 for m in ("accuracy", "f1", "recall"))
        own = scored.groupBy("dataset", models.LABEL).agg(F.sum("rows").alias("rows")).withColumn("sound", F.lit(same))
        out = own if out is None else out.unionByName(own)
    return out


def _scored_cells(found: models.Trained, parts: dict[str, DataFrame]) -> DataFrame:
    """How many rows of each set have a level and a prediction, from one pass over the rows: levels x levels rows per set, kept here."""
    cells = None
    for name, part in parts.items():
        scored = found.model.transform(found.labels.transform(models.distinct_inputs(part)))
        counted = scored.groupBy(models.LABEL, models.LABEL_INDEX, "prediction").agg(F.sum(models.TIMES).alias("rows"))
        counted = counted.select(F.lit(name).alias("dataset"), "*", F.col("rows").cast("double").alias("times"))
        cells = counted if cells is None else cells.unionByName(counted)
    return cells.sparkSession.createDataFrame(cells.collect(), cells.schema)


@query
def train_lr(spark, sf_dir):
    return _training(spark, sf_dir, "lr")


@query
def train_dt(spark, sf_dir):
    return _training(spark, sf_dir, "dt")


@query
def train_rf(spark, sf_dir):
    return _training(spark, sf_dir, "rf")


@query
def train_rf_tuned(spark, sf_dir):
    return _training(spark, sf_dir, "rf_tuned")


@query
def train_pipeline(spark, sf_dir):
    """The fitted nested feature pipeline applied to its rows."""
    rows = feeds.combined(spark, sf_dir)
    stages: PipelineModel = models.feature_stages(scale=True).fit(rows)
    wide = stages.transform(rows.withColumn("row_id", F.col("_id")))
    return features.vector_values(features.vector_values(wide), "scaled_features").select(
        "row_id", "city", "hour", F.col("features")[0].alias("city_index"), F.size("features").alias("inputs"),
        F.size("scaled_features").alias("scaled"),
    )


@query
def class_metrics(spark, sf_dir):
    scored = models.class_metrics(table(spark, sf_dir, "labels"), "all", "quality", "toxic")
    return rounded(scored, "value")


@query
def score_batch(spark, sf_dir):
    """A stored model on rows without a label: every row gets a known level and a distribution."""
    rows = feeds.combined(spark, sf_dir)
    path = work_path(spark, "model")
    models.save_model(trained(rows, "dt").model, path)
    scored = models.score(models.load_model(path), rows.drop(models.LABEL), keep=ROW_KEY)
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    known = F.coalesce(F.col("level").isin(*values.LEVELS.values()), F.lit(False))
    return scored.select(*ROW_KEY, known.alias("known"), (F.abs(total - 1) < 1e-9).alias("whole"))


@query
def model_roundtrip(spark, sf_dir):
    """Rows whose score by a stored model differs from that by the model before it was stored."""
    rows = feeds.combined(spark, sf_dir)
    path = work_path(spark, "model")
    model = trained(rows, "dt").model
    models.save_model(model, path)
    before, after = (models.score(m, rows, keep=ROW_KEY) for m in (model, models.load_model(path)))
    both = _side_by_side(before, after, [*ROW_KEY, "prediction", "probability"], "before", "after")
    return both.agg(F.sum("before").alias("rows"), F.sum(F.abs(F.col("before") - F.col("after"))).alias("differing"))


def _side_by_side(one: DataFrame, other: DataFrame, keys: list[str], *names: str) -> DataFrame:
    """How often either frame has each row, 0 if it doesn't: both are counted by one shuffle."""
    marked = [df.select(*keys, *[F.lit(int(n == name)).cast("bigint").alias(n) for n in names]) for df, name in zip((one, other), names, strict=True)]
    return marked[0].unionByName(marked[1]).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


# --- streams ------------------------------------------------------------------------------------------------


@query
def stream_ingest(spark, sf_dir):
    """Landed records -> flat rows. The second run of the same stream finds nothing new."""
    landed = _land_raw(spark, sf_dir, "traffic", "landed")
    out, state = work_path(spark, "ingested"), work_path(spark, "state")
    flat = None
    for _ in range(2):
        flat = flatten.flatten_traffic(read_stream(spark, "traffic", landed))
        flows.start_files(flat, out, state).awaitTermination()
    rows = spark.read.schema(flat.schema).parquet(out)
    return rows.withColumn("event_code", F.col("event_code").cast("double"))


# The landed history covers a month in no order, so nothing in it may count as late.
HISTORY = "45 days"


def _event_stream(spark, sf_dir, topic: str, copies: int = 1) -> DataFrame:
    path = work_path(spark, f"{topic}_landed")
    records = feeds.feed(spark, sf_dir, topic).select("value")
    if copies > 1:  # a text is made once and delivered again
        records = records.select("value", F.explode(F.sequence(F.lit(1), F.lit(copies)))).select("value")
    records.write.text(path)
    raw = read_stream(spark, topic, path)
    if topic == "traffic":
        flat = flatten.incident_time(flatten.flatten_traffic(raw))
    elif topic == "weather":
        flat = flatten.drop_columns(flatten.flatten_weather(raw), "sunrise", "sunset", "country")
    else:
        flat = flatten.flatten_air(raw)
    return flows.with_event_time(clean.dropna_any(flat)).drop("report_time")


@query
def stream_dedupe(spark, sf_dir):
    """Every incident is delivered twice."""
    incidents = _event_stream(spark, sf_dir, "traffic", copies=2)
    out = work_path(spark, "deduped")
    flows.start_files(
        flows.stream_dedupe(incidents, "event_ts", HISTORY),
        out,
        work_path(spark, "state"),
        state_partitions=spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    rows = spark.read.parquet(out)
    return rows.select("_id", "city", "delay", "event_code", timeparts.clock_text(F.col("event_ts")).alias("event_ts"))


@query
def stream_upsert(spark, sf_dir):
    """One surviving row per key of a stream that repeats keys."""
    path, out = work_path(spark, "landed"), work_path(spark, "upserted")
    rows = feeds.events(spark, sf_dir).select(
        F.col("user_id").alias("_id"), timeparts.clock_text(F.col("ts")).alias("report_time"), "event_id", "value"
    )
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    flows.start_batches(
        stream, flows.upsert_sink(out, "_id", "report_time"), work_path(spark, "state"), trigger=flows.DRAIN
    ).awaitTermination()
    return flows.read_upserted(spark, out, "_id", "report_time")


@query
def stream_align(spark, sf_dir):
    """Every record of the three topics is delivered twice."""
    topics = ("traffic", "weather", "air")
    traffic, weather, air = at_once(spark, *[partial(_event_stream, spark, sf_dir, t, copies=2) for t in topics])
    joined = flows.stream_align(traffic, weather, air, bucket_minutes=60, delay=HISTORY, cuts=2)
    out = work_path(spark, "stream_aligned")
    cores = spark.sparkContext.defaultParallelism
    flows.start_files(joined, out, work_path(spark, "state"), state_partitions=cores).awaitTermination()
    return spark.read.parquet(out)


@query
def stream_score(spark, sf_dir):
    """The stored model on a stream of rows: as many of each score as the batch gives, key by key."""
    path, model_path = work_path(spark, "requests"), work_path(spark, "model")
    rows = feeds.combined(spark, sf_dir)
    models.save_model(trained(rows, "dt").model, model_path)
    rows = rows.drop(models.LABEL)
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    model = models.load_model(model_path)
    scored = models.score(model, stream, keep=ROW_KEY)
    out = work_path(spark, "scored")
    flows.start_files(scored, out, work_path(spark, "state")).awaitTermination()
    batch = models.score(model, rows, keep=ROW_KEY)
    both = _side_by_side(spark.read.schema(scored.schema).parquet(out), batch, [*ROW_KEY, "level"], "streamed", "batch")
    same = F.bool_and(F.col("streamed") == F.col("batch"))
    return both.groupBy(*ROW_KEY).agg(F.sum(F.nullif("streamed", F.lit(0))).alias("rows"), same.alias("same"))


# --- sinks and triggers ---------------------------------------------------------------------------------------


@query
def document_sink(spark, sf_dir):
    """Documents through a connector and back, their ids as text."""
    path = work_path(spark, "documents")
    rows = feeds.clean(spark, sf_dir, "traffic").withColumn("_id", F.col("_id").cast("bigint"))
    write_documents(rows, "parquet", {"path": path})
    return read_collection(spark, "parquet", {"path": path})


@query
def fan_out_sinks(spark, sf_dir):
    """Rows in the document sink and in the files, and the rules' outcomes, of one frame."""
    docs, files = work_path(spark, "documents"), work_path(spark, "files")
    rules = [("ColumnCount", ">", 0), ("RowCount", ">", 0), (("Completeness", "l_discount"), ">=", 0.95)]
    outcome = fan_out(_gappy_lineitem(spark, sf_dir), files, ("parquet", {"path": docs}), rules)
    written = [("documents", spark.read.parquet(docs)), ("files", spark.read.text(files))]
    out = rounded(outcome, "actual")
    for name, rows in written:
        out = out.unionByName(rows.agg(F.lit(name).alias("rule"), F.lit("Written").alias("outcome"), F.count("*").cast("double").alias("actual")))
    return out


@query
def upload_batches(spark, sf_dir):
    """Incidents in files of at most 100 records: how many records of each id, and whether its file keeps to that."""
    path = work_path(spark, "uploads")
    write_json(feeds.clean(spark, sf_dir, "traffic"), path, max_records=UPLOAD_RECORDS)
    rows = spark.read.schema("_id string").json(path).withColumn("file", F.input_file_name())
    sizes = rows.groupBy("file").agg(F.count("*").alias("in_file"))
    return rows.join(sizes, "file").groupBy("_id").agg(F.count("*").alias("records"), (F.max("in_file") <= UPLOAD_RECORDS).alias("bounded"))


@query
def timed_batches(spark, sf_dir):
    """A stream that is flushed to documents on a timer until all that landed went through."""
    path, out = work_path(spark, "landed"), work_path(spark, "flushed")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(path)

    def flush(batch: DataFrame, batch_id: int) -> None:
        write_documents(batch, "parquet", {"path": f"{out}/batch={batch_id}"}, mode="overwrite")

    running = flows.start_batches(stream, flush, work_path(spark, "state"), trigger={"processingTime": "1 second"})
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(out).drop("batch")


@query
def stream_upsert_compacted(spark, sf_dir):
    """Keys that repeat over many batches, brought down to a row per key as the batches come."""
    path, out = work_path(spark, "landed"), work_path(spark, "upserted")
    rows = feeds.events(spark, sf_dir).select(
        F.col("user_id").alias("_id"), timeparts.clock_text(F.col("ts")).alias("report_time"), "event_id", "value"
    )
    rows.repartition(6, "event_id").write.parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    sink = flows.upsert_sink(out, "_id", "report_time", compact_every=2)
    flows.start_batches(stream, sink, work_path(spark, "state"), trigger=flows.DRAIN).awaitTermination()
    return flows.read_upserted(spark, out, "_id", "report_time", rows.schema)


# --- polls, deliveries and bookmarks ----------------------------------------------------------------------------


def _address(path: str) -> str:
    """A path of the shared folder as readers outside of Spark need it."""
    return path if "://" in path else Path(path.removeprefix("file:")).absolute().as_uri()


@query
def polled_events(spark, sf_dir):
    """Every location is polled once at each tick, an hour of the day; one location always fails and stops no other."""
    root, out = work_path(spark, "served"), work_path(spark, "polled")
    served = feeds.events(spark, sf_dir).select(
        F.col("city").alias("location"), (F.hour("ts") + 1).alias("tick"), F.to_json(F.struct("event_id", "value")).alias("text")
    )
    served.repartition("location", "tick").write.partitionBy("location", "tick").text(root)
    spark.dataSource.register(PolledFeed)
    options = {
        "fetch": "workload.served:fetch", "arguments": json.dumps({"root": _address(root)}), "interval": "15", "history": "true",
        "locations": json.dumps(["Hanoi", "Nowhere", "Ap Ba", "Ho Chi Minh City"]), "first_tick": "1", "last_tick": "24",
    }
    stream = spark.readStream.format("polled_feed").options(**options).load()
    flows.start_files(stream, out, work_path(spark, "state")).awaitTermination()
    polls = spark.read.schema(stream.schema).parquet(out)
    records = F.when(F.col("error").isNotNull(), F.array(F.lit("{}"))).otherwise(F.filter(F.split("value", "\n"), lambda x: x != ""))
    rows = polls.select("location", "tick", "error", F.explode(records).alias("record"))
    rows = rows.withColumn("r", F.from_json("record", "event_id bigint, value double"))
    return rows.select("location", "tick", "r.event_id", "r.value", "error")


def _append(path: str):
    return lambda rows, batch_id: rows.write.mode("append").parquet(path)


@query
def stream_fan_out(spark, sf_dir):
    """Three batches to two sinks and the rules. The second sink fails once, after the first took the batch, and the stream is started again.

    Both sinks append, so a batch that went to a sink twice would show.
    """
    landed, out, state = (work_path(spark, n) for n in ("landed", "fanned", "state"))
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "user_id")
    for part in range(3):
        rows.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    broken = [True]

    def fragile(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 1 and broken:
            broken.clear()
            raise OSError("the sink is away")
        _append(f"{out}/documents")(batch, batch_id)

    sink = fan_out_sink({"files": _append(f"{out}/files"), "documents": fragile}, out, [("RowCount", ">", 0), (("Completeness", "value"), ">=", 0.5)])
    for _ in range(2):
        running = flows.start_batches(stream, sink, state, trigger=flows.DRAIN)
        try:
            running.awaitTermination()
        except StreamingQueryException:
            continue
    passed = read_outcomes(spark, out).where("outcome = 'Passed'").select(F.col("rule").alias("name"), F.lit(1).cast("bigint").alias("event_id"), F.lit(None).cast("double").alias("value"))
    read = [spark.read.parquet(f"{out}/{n}").select(F.lit(n).alias("name"), "event_id", "value") for n in ("files", "documents")]
    every = read[0].unionByName(read[1]).unionByName(passed)
    return every.groupBy("name").agg(F.count("*").alias("rows"), F.countDistinct("event_id").alias("different"), F.round(F.sum("value"), 2).alias("total"))


@query
def stream_dedupe_moving(spark, sf_dir):
    """Every event is delivered again later with another time and value; its first delivery stays."""
    landed, out, state = (work_path(spark, n) for n in ("landed", "deduped", "state"))
    rows = feeds.events(spark, sf_dir).select("event_id", "city", "value", "ts")
    for moved in range(3):
        again = rows.withColumn("ts", F.timestamp_add("MINUTE", F.lit(7 * moved), F.col("ts"))).withColumn("value", F.col("value") + moved)
        again.write.mode("append").parquet(landed)
        stream = flows.with_event_time(spark.readStream.schema(again.schema).parquet(landed), "ts").drop("ts")
        first = flows.stream_dedupe_moving(stream, ["event_id"], "event_ts", HISTORY)
        flows.start_files(first, out, state, state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return spark.read.parquet(out).withColumn("event_ts", timeparts.clock_text(F.col("event_ts")))


@query
def partial_delivery(spark, sf_dir):
    """Records that a receiver refuses are sent again alone and parked after three tries; what the receiver holds beside the report."""
    folder = work_path(spark, "received")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    report = deliver(rows, "workload.served:receive", work_path(spark, "report"), pause=0.0, arguments={"folder": _address(folder)})
    held = spark.read.schema("event_id bigint").json(folder).groupBy("event_id").agg(F.count("*").alias("received"))
    both = report.join(held, "event_id", "left")
    return both.select("event_id", "status", "tries", "error", F.coalesce("received", F.lit(0)).alias("received"))


@query
def combine_increments(spark, sf_dir):
    """The topics' clean tables arrive in three parts, a run of the combine job after each, and one run with nothing new."""
    stored = dict(zip(bookmarks.TOPICS, feeds.stored(spark, sf_dir), strict=True))
    paths, state = {t: work_path(spark, f"{t}_growing") for t in stored}, work_path(spark, "bookmarks")
    for part in range(3):
        for n, (topic, rows) in enumerate(stored.items()):
            own = F.pmod(F.xxhash64(*[field(c) for c in rows.columns]), F.lit(3)) == (part + n) % 3
            rows.where(own).write.mode("append").parquet(paths[topic])
        bookmarks.combine_increment(spark, paths, state, bucket_minutes=60)
    bookmarks.combine_increment(spark, paths, state, bucket_minutes=60)
    found = bookmarks.read_combined(spark, state)
    return align.align_topics(*stored.values(), bucket_minutes=60).limit(0) if found is None else found


# --- live state, rules on a stream --------------------------------------------------------------------------------


def _arriving(spark, rows: DataFrame, parts: int = 4) -> tuple[DataFrame, str]:
    """A stream of the events in as many batches as ``parts``: those with the id's remainder 0 first."""
    path = work_path(spark, "landed")
    for part in range(parts):
        rows.where(F.col("event_id") % parts == part).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path), path


@query
def stream_latest_live(spark, sf_dir):
    """The latest row per key as live state: what changed in each of four batches, and the keyed table that the changes were merged into."""
    rows = feeds.events(spark, sf_dir).select(
        F.col("user_id").alias("_id"), timeparts.clock_text(F.col("ts")).alias("report_time"), "event_id", "value"
    )
    stream, _ = _arriving(spark, rows)
    changes = live.live_latest(stream, "_id", "report_time", ["event_id"], ttl_ms=DAY_MS)
    seen, table_path = work_path(spark, "changes"), work_path(spark, "latest")
    upsert = flows.upsert_sink(table_path, "_id", "report_time", compact_every=2)

    def sink(batch: DataFrame, batch_id: int) -> None:
        kept = materialised(batch, "changed")
        kept.write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")
        upsert(kept, batch_id)

    flows.start_upserts(changes, sink, work_path(spark, "state"), spark.sparkContext.defaultParallelism).awaitTermination()
    changed = spark.read.schema(StructType([*rows.schema.fields, StructField("batch", LongType())])).parquet(seen)
    last = flows.read_upserted(spark, table_path, "_id", "report_time", rows.schema).withColumn("batch", F.lit(-1).cast("bigint"))
    return changed.unionByName(last)


@query
def stream_rules(spark, sf_dir):
    """The rules' outcomes of each of four batches, gathered by a listener while the stream is written."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value").withColumn("value", F.when(F.col("event_id") % 12 > 2, F.col("value")))
    stream, _ = _arriving(spark, rows)
    log = live.RuleLog(spark, work_path(spark, "rules"), [("ColumnCount", ">", 3), ("RowCount", ">", 0), (("Completeness", "value"), ">=", 0.7)])
    spark.streams.addListener(log)
    try:
        running = flows.start_files(log.watched(stream), work_path(spark, "watched"), work_path(spark, "state"))
        running.awaitTermination()
        log.wait(running.runId)
    finally:
        spark.streams.removeListener(log)
    return rounded(live.read_rules(spark, log.path), "actual")
