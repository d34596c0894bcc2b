"""Value repair and lookup."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.functions.columns import field

# Spellings of a place that differ between feeds.
CITY_ALIASES = {"Ap Ba": "Da Nang", "Hanoi": "Ha Noi"}

# Names of the pollution levels by cluster number.
LEVELS = {0: "High", 1: "Moderate", 2: "Low"}


def normalise_city(
    df: DataFrame, column: str = "city", aliases: Mapping[str, str] = CITY_ALIASES
) -> DataFrame:
    """Whole-value, case-sensitive replacement of aliases, then lower case."""
    if aliases:
        df = df.replace(dict(aliases), subset=[column])
    return df.withColumn(column, F.lower(field(column)))


def resolve_choice(choice: Column) -> Column:
    """A ``struct<double, int>`` left by a field of unsettled type -> one double."""
    return F.coalesce(choice["double"].cast("double"), choice["int"].cast("double"))


def map_labels(code: Column, labels: Mapping[int, str] = LEVELS) -> Column:
    """Code -> label; a code without a label gives null."""
    if not labels:
        return F.lit(None).cast("string")
    return F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])[code.cast("int")]


def percent(part: Column, whole: Column) -> Column:
    """Share of ``whole`` in percent, two decimals, ties to even; null when ``whole`` is 0."""
    return F.rint(part / F.nullif(whole, F.lit(0)) * 100 * 100) / 100


def json_record(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct(*[field(c) for c in df.columns])).alias(name))
