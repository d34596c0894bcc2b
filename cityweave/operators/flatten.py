"""Raw nested records -> flat columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.functions.columns import field
from cityweave.functions.timeparts import epoch_to_clock, iso_to_naive


def first_of(array: Column) -> Column:
    """First element, null for a null or empty array."""
    return F.get(array, F.lit(0))


def flatten_air(raw: DataFrame) -> DataFrame:
    current, quality = F.col("current"), F.col("current")["air_quality"]
    readings = ("co", "o3", "so2", "pm2_5", "pm10", "us-epa-index", "gb-defra-index")
    return raw.select(
        F.col("location")["name"].alias("city"),
        current["uv"].alias("uv"),
        *[quality[name].alias(name) for name in readings],
        "report_time",
    )


def flatten_traffic(raw: DataFrame) -> DataFrame:
    incident = F.col("properties")
    event = first_of(incident["events"])
    return raw.select(
        "_id",
        *[
            incident[name].alias(name)
            for name in ("city", "iconCategory", "magnitudeOfDelay", "startTime", "endTime", "length", "delay")
        ],
        event["code"].alias("event_code"),
        event["description"].alias("event_desc"),
    )


def first_vertex(coordinates: Column) -> Column:
    """``struct(lon, lat)`` of the first position in the coordinates of any geometry, as text; nulls where there is none."""
    number = r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
    position = rf"^[\s\[]*{number}\s*,\s*{number}"
    lon, lat = (F.regexp_extract(coordinates, position, n).try_cast("double") for n in (1, 2))
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def incident_time(df: DataFrame) -> DataFrame:
    """``report_time`` of an incident is its start; start and end text go away."""
    return df.withColumn("report_time", iso_to_naive(F.col("startTime"))).drop("startTime", "endTime")


def flatten_weather(raw: DataFrame) -> DataFrame:
    """All fields of a weather record; ``select`` keeps unlisted raw fields out."""
    sky = first_of(F.col("weather"))
    return raw.select(
        F.col("name").alias("city"),
        F.col("coord")["lon"].alias("longitude"),
        F.col("coord")["lat"].alias("latitude"),
        sky["main"].alias("weather_main"),
        sky["description"].alias("weather_desc"),
        F.col("main")["temp"].alias("temperature"),
        F.col("main")["feels_like"].alias("feels_like"),
        F.col("main")["pressure"].alias("pressure"),
        F.col("main")["humidity"].alias("humidity"),
        F.col("wind")["speed"].alias("wind_speed"),
        F.col("wind")["deg"].alias("wind_deg"),
        F.col("clouds")["all"].alias("cloudiness"),
        F.col("sys")["country"].alias("country"),
        epoch_to_clock(F.col("sys")["sunrise"]).alias("sunrise"),
        epoch_to_clock(F.col("sys")["sunset"]).alias("sunset"),
        "visibility",
        "report_time",
    )


def drop_columns(df: DataFrame, *names: str, strict: bool = False) -> DataFrame:
    """Drop columns; ``strict`` refuses names the frame does not have."""
    absent = [n for n in names if n not in df.columns]
    if strict and absent:
        raise ValueError(f"no such columns: {absent}")
    return df.drop(*names)


def stamp(df: DataFrame, **constants: Column | str) -> DataFrame:
    """Add constant columns, e.g. the city of a poll or the time it was made."""
    return df.withColumns(
        {k: v if isinstance(v, Column) else F.lit(v) for k, v in constants.items()}
    )


def stamp_incident(raw: DataFrame, city: Column | None = None) -> DataFrame:
    """Lift ``properties.id`` to ``_id`` and write the polled city into ``properties``."""
    if city is not None:
        raw = raw.withColumn("properties", F.col("properties").withField("city", city))
    return raw.withColumn("_id", F.col("properties")["id"])


def explode_incidents(polls: DataFrame, envelope: str = "incidents") -> DataFrame:
    """One row per incident of each polled response; other columns of the poll stay."""
    rest = [field(c) for c in polls.columns if c != envelope]
    return polls.select(*rest, F.explode(field(envelope)).alias("incident")).select(
        *rest, "incident.*"
    )
