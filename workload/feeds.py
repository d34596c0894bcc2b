"""The three raw feeds, derived from the ``events`` table with column expressions.

click -> traffic, error -> weather, purchase -> air; ``user_id % 3`` picks the city.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.operators.align import align_topics
from cityweave.operators.clean import parse_records, valid_records
from cityweave.operators.cluster import PollutionModel, level_order
from cityweave.plans.jobs import combine_job, materialised, topic_job
from cityweave.schemas import PARTITION_LEVELS, RAW
from cityweave.session import all_materialised, spread

EVENT_TYPES = {"traffic": "click", "weather": "error", "air": "purchase"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, *names: str) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), index.cast("int"))


def events(spark: SparkSession, sf_dir: str, topic: str | None = None) -> DataFrame:
    """The events, or those of a topic dealt over all cores, with ``k`` of their JSON text and the feed's city name."""
    rows = table(spark, sf_dir, "events")
    if topic is not None:
        rows = spread(rows.where(F.col("event_type") == EVENT_TYPES[topic]))
    return rows.withColumns(
        {
            "k": F.get_json_object("props", "$.k").cast("int"),
            "city": _pick(F.col("user_id") % 3, "Hanoi", "Ap Ba", "Ho Chi Minh City"),
        }
    )


def _incident() -> dict[str, Column]:
    k = F.col("k")
    lon, lat = (_pick(F.col("user_id") % 3, *x) for x in (("105.65", "108.2", "106.68"), ("20.97", "16.13", "10.77")))
    # Every seventh incident lies east of its city.
    lon = F.when(F.col("event_id") % 7 == 0, "-1e1").otherwise(lon)
    vertex = F.concat(F.lit("["), lon, F.lit(","), lat, F.lit("]"))

    def event(base: int) -> Column:
        code = (base + F.col("event_id") % 7).cast("int")
        return F.struct(
            code.alias("code"),
            F.concat(F.lit("event "), code.cast("string")).alias("description"),
            (k % 12).alias("iconCategory"),
        )

    return {
        "type": F.lit("Feature"),
        "geometry": F.struct(
            F.when(F.col("event_id") % 2 == 0, "Point").otherwise("LineString").alias("type"),
            F.when(F.col("event_id") % 2 == 0, vertex).otherwise(F.concat(F.lit("[ "), vertex, F.lit(", [0, 0.5]]"))).alias("coordinates"),
        ),
        "properties": F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.col("city"),
            (k % 12).alias("iconCategory"),
            (k % 5).alias("magnitudeOfDelay"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("startTime"),
            F.date_format(F.col("ts") + F.expr("interval 1 hour"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("endTime"),
            F.col("value").alias("length"),
            (k * 10).alias("delay"),
            F.slice(F.array(event(100), event(200)), F.lit(1), (F.col("event_id") % 3).cast("int")).alias("events"),
        ),
    }


def _weather() -> dict[str, Column]:
    k = F.col("k")
    temp = (280 + k % 30).cast("double")
    sunrise = (1704067200 + k * 60).cast("bigint")
    return {
        "coord": F.struct(
            (105 + F.col("user_id") % 3).cast("double").alias("lon"), (10 + F.col("user_id") % 3).cast("double").alias("lat")
        ),
        "weather": F.array(
            F.struct(
                _pick(k % 3, "Clear", "Clouds", "Rain").alias("main"),
                _pick(k % 5, "clear sky", "few clouds", "mist", "light rain", "heavy rain").alias("description"),
            )
        ),
        "main": F.struct(
            temp.alias("temp"), (temp - 1).alias("feels_like"), (1000 + k % 20).alias("pressure"), k.alias("humidity")
        ),
        "wind": F.struct((F.col("value") / 10).alias("speed"), (k * 3 % 360).alias("deg")),
        "clouds": F.struct((100 - k).alias("all")),
        "sys": F.struct(F.lit("VN").alias("country"), sunrise.alias("sunrise"), (sunrise + 43200).alias("sunset")),
        "name": F.col("city"),
        "visibility": 10000 - k * 10,
        "base": F.lit("stations"),
        "dt": sunrise,
        "cod": F.lit(200),
        "id": F.col("event_id"),
        "timezone": F.lit(25200),
        "report_time": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    }


def _air() -> dict[str, Column]:
    k, value = F.col("k"), F.col("value")
    quality = F.struct(
        (value * 10).alias("co"),
        k.cast("double").alias("o3"),
        (value / 5).alias("so2"),
        F.nullif(k % 7, F.lit(0)).cast("double").alias("pm2_5"),
        value.alias("pm10"),
        (k % 6 + 1).alias("us-epa-index"),
        (k % 10 + 1).alias("gb-defra-index"),
    )
    return {
        "location": F.struct(F.col("city").alias("name")),
        "current": F.struct((k % 12).cast("double").alias("uv"), quality.alias("air_quality")),
        "report_time": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    }


_FIELDS = {"traffic": _incident, "weather": _weather, "air": _air}


def feed(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """JSON text ``value`` per record, and the folder levels it would land under."""
    fields = _FIELDS[topic]()
    if topic == "traffic":
        fields = {"_id": F.col("event_id").cast("string"), **fields}
    rows = events(spark, sf_dir, topic)
    quarter = F.lpad((F.floor(F.hour("ts") / 6) * 6).cast("string"), 2, "0")  # of the day, by its first hour
    levels = [F.date_format("ts", p) for p in ("yyyy", "MM", "dd")] + [quarter]
    levels = [level.alias(n) for level, n in zip(levels, PARTITION_LEVELS)]
    return rows.select(F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("value"), *levels)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic records as the API gives them, before they are stamped, with the polled city."""
    rows = events(spark, sf_dir, "traffic")
    return rows.select("event_id", "city", F.struct(*[c.alias(n) for n, c in _incident().items()]).alias("incident"))


def raw(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    good, _ = valid_records(parse_records(feed(spark, sf_dir, topic), RAW[topic]))
    return good


def clean(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return topic_job(raw(spark, sf_dir, topic), topic)


def stored(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The three clean tables as the topic jobs leave them for the combine job."""
    return all_materialised([(clean(spark, sf_dir, t), f"{t}_clean") for t in ("traffic", "weather", "air")])


def aligned(spark: SparkSession, sf_dir: str, bucket_minutes: int) -> DataFrame:
    return align_topics(*stored(spark, sf_dir), bucket_minutes)


# A model that was fitted elsewhere, so that levels can be repeated in SQL.
STATS = {
    "humidity": (50.5, 28.7), "pressure": (1009.4, 5.8), "temperature": (294.6, 8.7), "wind_speed": (5.1, 2.9),
    "magnitudeOfDelay": (2.1, 1.4), "pm10": (50.3, 28.9), "pm2_5": (3.4, 1.7), "co": (503.0, 289.0), "so2": (10.1, 5.8), "o3": (49.7, 28.8),
}
CENTRES = [
    [0.11, -0.23, 0.31, 0.07, 0.43, 0.83, 0.37, 0.79, 0.81, 0.29],
    [-0.17, 0.41, -0.13, 0.57, -0.61, -0.47, 0.53, -0.43, -0.51, 0.67],
    [0.19, -0.37, -0.29, -0.71, 0.23, -0.59, -0.83, -0.61, -0.53, -0.89],
]


def fixed_model() -> PollutionModel:
    return PollutionModel(tuple(STATS), STATS, CENTRES, level_order(CENTRES))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the combine job gives with levels by the fixed model, for whoever passes over it once."""
    return combine_job(*stored(spark, sf_dir), bucket_minutes=60, model=fixed_model())


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled table that training reads again and again, stored; built anew by each call."""
    return materialised(labelled(spark, sf_dir), "combined")
