"""Row filters, exact de-duplication and keyed survivors."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cityweave.functions.columns import field

# Incident categories the feed is asked for.
CATEGORIES = (1, 2, 4, 6, 8, 9, 10, 11)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop exact repeats of whole rows. Repeats collapse in each task before the shuffle."""
    return df.dropDuplicates()


def dropna_any(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which any value is null or NaN."""
    return df.na.drop("any", subset=[c for c in (subset or df.columns)])


def clean_rows(df: DataFrame) -> DataFrame:
    """Incomplete rows first, so that they are not shuffled; the result equals the other order."""
    return dedupe_rows(dropna_any(df))


def category_filter(df: DataFrame, column: str = "iconCategory", keep: Sequence[int] = CATEGORIES) -> DataFrame:
    return df.where(field(column).isin(list(keep)))


def bbox_assign(
    points: DataFrame, boxes: DataFrame, lon: str = "lon", lat: str = "lat", cell: float = 1.0
) -> DataFrame:
    """Points with each city whose box ``(city, min_lon, min_lat, max_lon, max_lat)`` holds them.

    Both sides meet on the grid cell they lie in, so the join has equality keys however many
    boxes there are: Spark broadcasts a small box table by itself, and a cell that holds most of
    the points is split by the adaptive skew join. Edges belong to the box.
    """

    def cells(low: str, high: str):
        return F.explode(F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell)))

    gridded = boxes.withColumn("_cx", cells("min_lon", "max_lon")).withColumn("_cy", cells("min_lat", "max_lat"))
    placed = points.withColumns({"_cx": F.floor(field(lon) / cell), "_cy": F.floor(field(lat) / cell)})
    return (
        placed.join(gridded, ["_cx", "_cy"])
        .where(field(lon).between(F.col("min_lon"), F.col("max_lon")) & field(lat).between(F.col("min_lat"), F.col("max_lat")))
        .drop("_cx", "_cy", "min_lon", "min_lat", "max_lon", "max_lat")
    )


def without_strings(text: Column) -> Column:
    """JSON text without its quoted strings; a quote that stays has no partner."""
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    return F.regexp_replace(plain, '"[^"]*"', "")


def parse_records(lines: DataFrame, schema: StructType, column: str = "value", bad: str = "_corrupt_record") -> DataFrame:
    """JSON text -> columns of ``schema``; ``bad`` holds the text of records that do not parse.

    A text that holds more than one object, or anything beside one, is rejected as a whole. The parser stops after
    the first value, so it is given the text twice: as the only field of an object, where it fails at anything but the object's end, a
    comma apart, and as the only element of an array, which must have that one element and fails at anything but a comma or the
    array's end. No rest of a text passes both. The record comes out of a generator, which later filters are not
    pushed through: a filter on many columns would otherwise parse the text once per column.
    """
    record = f"{bad}_"
    wide = StructType().add(record, schema).add(bad, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    rest = [c for c in lines.columns if c != column]
    # So does the text, which is used several times and may be costly to make.
    lines = lines.select(*map(field, rest), F.explode(F.array(field(column))).alias("_text"))
    text = F.col("_text")
    as_field = F.from_json(F.concat(F.lit(json.dumps({record: 0})[:-2]), text, F.lit("}")), wide, options)
    elements = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<struct<_:string>>")
    single = F.regexp_like(text, F.lit(r"^\s*\{")) & (F.size(elements) == 1)
    parsed = lines.select(*map(field, rest), text, F.coalesce(single, F.lit(False)).alias("_single"), F.inline(F.array(as_field)))
    rejected = ~F.col("_single") | field(bad).isNotNull()
    return parsed.select(
        *map(field, rest), *[field(record)[name].alias(name) for name in schema.names], F.when(rejected, F.coalesce("_text", F.lit(""))).alias(bad)
    )


def valid_records(parsed: DataFrame, bad: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Split ``parse_records`` output in (good rows, rejected rows)."""
    return parsed.where(field(bad).isNull()).drop(bad), parsed.where(field(bad).isNotNull())


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: str, tie_break: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest ``order`` for each key; ties go to the greatest other columns.

    A maximum over structs, not a window: each task keeps one row per key before the shuffle, so
    a key that holds a third of all rows costs one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != order]
    lead = list(tie_break or [])
    ranked = [order, *lead, *sorted(c for c in rest if c not in lead)]
    best = df.groupBy(*[field(k) for k in keys]).agg(
        F.max(F.struct(*[field(c) for c in ranked])).alias("_best")
    )
    return best.select(
        *[field(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns]
    )
