"""Timestamps and the text and number columns cut from them.

Everything is computed on zone-less timestamps, so results do not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.functions.columns import field

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def utc_clock(ts: Column) -> Column:
    """Wall clock in UTC of an instant."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(_EPOCH))


def parse_clock(text: Column, source_tz: str = "UTC") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text written on a clock in ``source_tz`` -> UTC wall clock.

    Text that is no timestamp gives null.
    """
    parsed = text.try_cast("timestamp_ntz")
    if source_tz.upper() == "UTC":
        return parsed
    return F.convert_timezone(F.lit(source_tz), F.lit("UTC"), parsed)


def iso_to_naive(text: Column) -> Column:
    """ISO-8601 text with a zone -> UTC wall clock; text without a zone is taken as UTC."""
    zoned = text.rlike(r"(?i)(Z|[+-]\d{2}:?\d{2})$")
    return F.when(zoned, utc_clock(text.try_cast("timestamp"))).otherwise(
        text.try_cast("timestamp_ntz")
    )


def epoch_to_clock(seconds: Column) -> Column:
    """Epoch seconds -> UTC wall clock."""
    return utc_clock(F.timestamp_seconds(seconds))


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def time_text(ts: Column) -> Column:
    """``HH:mm:ss``, with six fraction digits only when the fraction is not zero."""
    return F.replace(F.date_format(ts, "HH:mm:ss.SSSSSS"), F.lit(".000000"), F.lit(""))


def split_report_time(df: DataFrame, column: str = "report_time", source_tz: str = "UTC") -> DataFrame:
    """Replace a timestamp (text or timestamp_ntz) by the text columns ``date`` and ``time``.

    The clock and its two texts come out of generators, which later filters are not pushed through: a filter on
    both would otherwise read the clock and write the texts again.
    """
    ts = field(column)
    if df.schema[column].dataType.typeName() == "string":
        ts = parse_clock(ts, source_tz)
    elif df.schema[column].dataType.typeName() == "timestamp":
        ts = utc_clock(ts)
    clocks = df.select(*map(field, df.columns), F.explode(F.array(ts)).alias("_clock"))
    clock = F.col("_clock")
    texts = F.struct(F.date_format(clock, "yyyy-MM-dd").alias("date"), time_text(clock).alias("time"))
    split = clocks.select(*map(field, df.columns), F.explode(F.array(texts)).alias("_texts"))
    return split.withColumns({"date": F.col("_texts")["date"], "time": F.col("_texts")["time"]}).drop(column, "_texts")


def hour_minute(df: DataFrame, column: str = "time") -> DataFrame:
    """Replace ``HH:mm...`` text by the integers ``hour`` and ``minute``."""
    parts = F.split(field(column), ":")
    return df.withColumns(
        {
            "hour": F.get(parts, F.lit(0)).try_cast("int"),
            "minute": F.get(parts, F.lit(1)).try_cast("int"),
        }
    ).drop(column)


def bucket_start(df: DataFrame, minutes: int) -> DataFrame:
    """Move ``hour`` and ``minute`` back to the start of their bucket of ``minutes`` minutes."""
    if minutes < 1 or 1440 % minutes:
        raise ValueError("bucket_minutes has to divide the 1440 minutes of a day")
    if minutes == 1:
        return df
    of_day = F.col("hour") * 60 + F.col("minute")
    start = of_day - of_day % minutes
    return df.withColumns(
        {"hour": F.floor(start / 60).cast("int"), "minute": (start % 60).cast("int")}
    )
