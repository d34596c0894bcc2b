"""Column helpers: names with hyphens, column lists by type, missing values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def field(name: str) -> Column:
    """The column with exactly this name, hyphens and dots included."""
    return F.col(quoted(name))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def is_missing(df: DataFrame, name: str) -> Column:
    """True for null and, in floating point columns, NaN."""
    missing = field(name).isNull()
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        missing = missing | F.isnan(field(name))
    return missing


def number(df: DataFrame, name: str) -> Column:
    """The column as a double in which every missing value is null."""
    value = field(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        value = F.when(~F.isnan(value), value)
    return value.cast("double")


def long_form(df: DataFrame, columns: Iterable[str], name: str = "column", value: str = "value") -> DataFrame:
    """One row per (column, non-missing value). Reads only the columns named."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias(name), number(df, c).alias(value)) for c in columns]
    )
    return df.select(F.inline(pairs)).where(F.col(value).isNotNull())
