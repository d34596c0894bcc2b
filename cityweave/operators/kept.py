"""Profiles that are kept up: one small row per group and column, merged later without the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.functions.columns import field, is_missing, number, numeric_columns

#: Size parameter of the sketches; a larger one is more exact. Profiles merge whatever theirs is.
ACCURACY = 4096


def rank_error(k: int = ACCURACY) -> float:
    """How far a rank may be off, as a share of the rows, in 99 of 100 cases; the published fit for this kind of sketch."""
    return 2.296 / k**0.9723


def profiles(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None, k: int = ACCURACY) -> DataFrame:
    """One row per group of ``by`` and numeric column: ``rows``, ``missing``, ``zeros``, ``low``, ``high`` and ``sketch``.

    Meant to be stored per topic and day: a day that arrives later adds its rows, and no day is read
    again. Null and NaN are missing. The aggregates are partial in every task, so a group that holds most rows costs one sketch a task.
    """
    columns = list(columns if columns is not None else [c for c in numeric_columns(df) if c not in by])
    if not columns:
        raise ValueError("there is no column to profile")
    cells = [F.struct(F.lit(c).alias("column"), F.when(~is_missing(df, c), number(df, c)).alias("value")) for c in columns]
    value = F.col("value")
    return df.select(*map(field, by), F.inline(F.array(*cells))).groupBy(*map(field, by), "column").agg(
        F.count("*").alias("rows"),
        F.count_if(value.isNull()).alias("missing"),
        F.count_if(value == 0).alias("zeros"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.kll_sketch_agg_double(value, k).alias("sketch"),
    )


def merged(kept: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored profiles brought together to fewer groups, ``by`` and the column; sums and extremes are exact."""
    return kept.groupBy(*map(field, by), "column").agg(
        *[F.sum(c).alias(c) for c in ("rows", "missing", "zeros")],
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def kept_quantiles(kept: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Adds ``quantiles``, an array in the order of ``probs``; null for a column without values."""
    if not probs or not all(0 <= p <= 1 for p in probs):
        raise ValueError("probabilities lie between 0 and 1")
    present = F.when(F.col("rows") > F.col("missing"), F.col("sketch"))
    return kept.withColumn("quantiles", F.kll_sketch_get_quantile_double(present, F.array(*[F.lit(float(p)) for p in probs])))
