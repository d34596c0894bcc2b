"""Fixed schemas of the three topics, raw and clean. No reader in the package infers types."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, LongType, StringType, StructType

KEYS = ("date", "city", "hour", "minute")
PARTITION_LEVELS = ("partition_0", "partition_1", "partition_2", "partition_3")

TEXT, INT, LONG, REAL = StringType(), IntegerType(), LongType(), DoubleType()


def struct(**fields: DataType) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    return schema


# Field names of the feeds; they have to equal those the feeds send.
_QUALITY = {"us-epa-index": INT, "gb-defra-index": INT}
_TMC = struct(
    countryCode=TEXT, tableNumber=TEXT, tableVersion=TEXT, direction=TEXT, points=ArrayType(struct(location=INT, offset=INT))
)
_INCIDENT = struct(
    type=TEXT,
    geometry=struct(type=TEXT, coordinates=TEXT),
    properties=struct(
        id=TEXT, city=TEXT, iconCategory=INT, magnitudeOfDelay=INT, startTime=TEXT, endTime=TEXT,
        length=REAL, delay=INT, events=ArrayType(struct(code=INT, description=TEXT, iconCategory=INT)),
        **{"from": TEXT, "to": TEXT}, roadNumbers=ArrayType(TEXT), timeValidity=TEXT, probabilityOfOccurrence=TEXT,
        numberOfReports=INT, lastReportTime=TEXT, tmc=_TMC,
    ),
)

RAW = {
    "air": struct(
        location=struct(name=TEXT),
        current=struct(uv=REAL, air_quality=struct(co=REAL, o3=REAL, so2=REAL, pm2_5=REAL, pm10=REAL, **_QUALITY)),
        report_time=TEXT,
    ),
    "traffic": StructType([*struct(_id=TEXT), *_INCIDENT]),
    "weather": struct(
        coord=struct(lon=REAL, lat=REAL),
        weather=ArrayType(struct(main=TEXT, description=TEXT)),
        main=struct(temp=REAL, feels_like=REAL, pressure=INT, humidity=INT),
        wind=struct(speed=REAL, deg=INT),
        clouds=struct(all=INT),
        sys=struct(country=TEXT, sunrise=LONG, sunset=LONG),
        name=TEXT, visibility=INT, base=TEXT, dt=LONG, cod=INT, id=LONG, timezone=INT, report_time=TEXT,
    ),
}

CLEAN = {
    "air": struct(city=TEXT, uv=REAL, co=REAL, o3=REAL, so2=REAL, pm2_5=REAL, pm10=REAL, **_QUALITY, date=TEXT, time=TEXT),
    "traffic": struct(
        _id=TEXT, city=TEXT, iconCategory=INT, magnitudeOfDelay=INT, length=REAL, delay=INT,
        event_code=INT, event_desc=TEXT, date=TEXT, time=TEXT,
    ),
    "weather": struct(
        city=TEXT, longitude=REAL, latitude=REAL, weather_main=TEXT, weather_desc=TEXT, temperature=REAL,
        feels_like=REAL, pressure=INT, humidity=INT, wind_speed=REAL, wind_deg=INT, cloudiness=INT,
        visibility=INT, date=TEXT, time=TEXT,
    ),
}

# One poll of the incident feed: many incidents in one response.
ENVELOPE = struct(incidents=ArrayType(_INCIDENT))
