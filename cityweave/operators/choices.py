"""Fields whose type isn't known beforehand: what a feed sends in each, and one value out of any of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.functions.columns import field

#: Objects inside of objects that are told apart; what lies deeper counts as one object.
DEPTH = 6


def open_record(text: Column) -> Column:
    """JSON text as a ``VARIANT``, null if it doesn't parse."""
    return F.try_parse_json(text)


def place(*keys: str) -> str:
    """The path of a nested field, whatever signs its keys hold, but not both kinds of quotes."""
    if any("'" in key and '"' in key for key in keys):
        raise ValueError(f"no path can name {keys}")
    return "$" + "".join(f'["{key}"]' if "'" in key else f"['{key}']" for key in keys)


def kind(value: Column) -> Column:
    """``int``, ``double``, ``string``, ``boolean``, ``array``, ``object``, ``null`` or ``missing``.

    A number with a point or an exponent is a ``double``, also if it is whole, and so is one beyond 64 bits.
    """
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    known = {"BIGINT": "int", "DECIMAL": "double", "DOUBLE": "double", "FLOAT": "double", "VOID": "null"}
    out = F.when(value.isNull(), "missing")
    for sign, plain in known.items():
        out = out.when(name == sign, plain)
    return out.otherwise(F.lower(name))


def nested(record: Column, *keys: str) -> Column:
    """A field of a record as a ``VARIANT``, null where a key is absent."""
    return F.try_variant_get(record, place(*keys), "variant")


def number_of(value: Column) -> Column:
    """One double out of an integer, a double or a text that spells a finite one; null for anything else."""
    number = F.try_variant_get(value, "$", "double")
    return F.when(kind(value).isin("int", "double", "string") & (F.abs(number) < float("inf")), number)


def field_kinds(records: DataFrame, column: str = "record", depth: int = DEPTH) -> DataFrame:
    """``path``, ``kind`` and ``rows`` of every field of a feed, by its records in a ``VARIANT`` column.

    Objects are opened level by level in one pass without a shuffle; then counts are added up inside
    the tasks first. Arrays count as a whole, an empty object as an object, a key that is absent not
    at all. ``path`` is an array of keys; that of a record that is no object is empty. Null records are left out.
    """
    spark = records.sparkSession
    level = records.select(F.array().cast("array<string>").alias("path"), field(column).alias("at")).where("at is not null")
    for _ in range(depth):
        # A record that is no object any more comes through as it is.
        inner = F.when(kind(F.col("at").outer()) == "object", F.col("at").outer())
        opened = level.lateralJoin(spark.tvf.variant_explode_outer(inner))
        level = opened.select(
            F.when(F.col("key").isNull(), F.col("path")).otherwise(F.concat("path", F.array("key"))).alias("path"),
            F.when(F.col("key").isNull(), F.col("at")).otherwise(F.col("value")).alias("at"),
        )
    return level.select("path", kind(F.col("at")).alias("kind")).groupBy("path", "kind").agg(F.count("*").alias("rows"))


def choices(kinds: DataFrame) -> DataFrame:
    """Fields that come in more than one kind, nulls aside: ``path``, ``kinds`` in alphabetical order, ``rows``."""
    told = kinds.where("kind <> 'null'").groupBy("path")
    return told.agg(F.sort_array(F.collect_list("kind")).alias("kinds"), F.sum("rows").alias("rows")).where(F.size("kinds") > 1)
