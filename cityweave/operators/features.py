"""Encoding, filling, scaling, splitting, assembling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import RobustScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityweave.functions.columns import field, number
from cityweave.operators.quantiles import quantiles
from cityweave.session import materialised

# Up to this many levels, with this many bytes of text, are sent to every executor; more are joined by shuffle.
FEW_LEVELS = 100_000
FEW_BYTES = 64 * 1024 * 1024


def _number_rows(levels: DataFrame, order: list[Column]) -> DataFrame:
    """Levels with ``index`` 0.. in the given order.

    They are sorted across the cluster and stored; then each sorted part is numbered on its own, starting
    where the parts before it end.
    """
    parts = materialised(levels.orderBy(*order).withColumn("_part", F.spark_partition_id()), "levels")
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_size"))  # a row per task
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    numbered = parts.withColumn("_place", place).join(F.broadcast(starts), "_part")
    return numbered.withColumn("index", (F.col("_start") + F.col("_place") - 1).cast("bigint")).drop("_part", "_place", "_start")


def _encoded(df: DataFrame, column: str, output: str, order: list[Column], few: int) -> DataFrame:
    levels = df.where(field(column).isNotNull()).groupBy(field(column).alias("_level")).agg(F.count("*").alias("_rows"))
    indexed = materialised(_number_rows(levels, order).select("_level", F.col("index").alias(output)), "indexed")
    size = indexed.agg(F.count("*").alias("levels"), F.sum(F.octet_length(F.col("_level").cast("string"))).alias("bytes")).first()
    small = size["levels"] <= few and (size["bytes"] or 0) <= FEW_BYTES
    return df.join(F.broadcast(indexed) if small else indexed, field(column) == F.col("_level"), "left").drop("_level")


def label_encode(df: DataFrame, column: str, output: str | None = None, few: int = FEW_LEVELS) -> DataFrame:
    """Alphabetical number 0..k-1 of each text value; null stays null."""
    return _encoded(df, column, output or f"{column}_encoded", [F.col("_level")], few)


def string_index(df: DataFrame, column: str, output: str | None = None, few: int = FEW_LEVELS) -> DataFrame:
    """Number by falling frequency, ties alphabetical."""
    return _encoded(df, column, output or f"{column}_index", [F.col("_rows").desc(), F.col("_level")], few)


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and NaN become the mean of the present values."""
    means = df.agg(*[F.avg(number(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return df.withColumns({c: F.coalesce(number(df, c), F.lit(means[i])) for i, c in enumerate(columns)})


def mean_and_variance(
    df: DataFrame, columns: Sequence[str], filled: bool = False, weight: str | None = None
) -> dict[str, tuple[float, float]]:
    """Mean and population variance per column; with ``filled`` as if gaps held the mean.

    ``weight`` names a column that tells how often a row counts. Deviations are from the mean of a pass before,
    as a difference of sums would lose digits.
    """
    times = F.lit(1.0) if weight is None else field(weight).cast("double")
    values = [number(df, c) for c in columns]
    present = [F.sum(F.when(v.isNotNull(), times)) for v in values]
    first = [F.sum(times), *present, *[F.sum(v * times) for v in values]]
    rows, *sums = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(first)]).first()
    counts, totals = sums[: len(values)], sums[len(values) :]
    means = [total / n if n else 0.0 for total, n in zip(totals, counts, strict=True)]
    squares = [F.sum((v - F.lit(m)) * (v - F.lit(m)) * times) for v, m in zip(values, means, strict=True)]
    spreads = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(squares)]).first() if values else []
    return {
        c: (mean, square / (rows if filled else n)) if n else (0.0, 0.0)
        for c, mean, square, n in zip(columns, means, spreads, counts, strict=True)
    }


def centre_and_spread(
    df: DataFrame, columns: Sequence[str], filled: bool = False, weight: str | None = None
) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column keeps unit scale."""
    return {c: (mean, variance**0.5 or 1.0) for c, (mean, variance) in mean_and_variance(df, columns, filled, weight).items()}


def scaled(df: DataFrame, name: str, centre: float, spread: float) -> Column:
    return (number(df, name) - F.lit(float(centre))) / F.lit(float(spread))


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = centre_and_spread(df, columns)
    return df.withColumns({c: scaled(df, c, *stats[c]) for c in columns})


def robust_scale(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """(x - median) / interquartile range, unit scale where that range is 0."""
    found = quantiles(df, columns, [0.25, 0.5, 0.75], approximate)
    stats = {c: (q[1], (q[2] - q[0]) or 1.0) if q[1] is not None else (0.0, 1.0) for c, q in found.items()}
    return df.withColumns({c: scaled(df, c, *stats[c]) for c in columns})


def robust_scaler(source: str = "features", target: str = "scaled_features") -> RobustScaler:
    """The model's scaler: no centring, approximate quartiles."""
    return RobustScaler(inputCol=source, outputCol=target)


def robust_scale_ml(df: DataFrame, columns: Sequence[str], output: str = "scaled_features") -> DataFrame:
    wide = assemble_features(df, columns, "_raw_features")
    return robust_scaler("_raw_features", output).fit(wide).transform(wide).drop("_raw_features")


def random_split(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    first, second = df.randomSplit([train, 1 - train], seed)
    return first, second


def key_tenth(*keys: str) -> Column:
    """A number 0..9 that depends on the key alone."""
    text = F.concat_ws("|", *[field(k).cast("string") for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("bigint"), F.lit(10))


def hash_split(df: DataFrame, *keys: str, train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """A split by key: the same for every order and partitioning of the rows."""
    in_train = key_tenth(*keys) < train_tenths
    return df.where(in_train), df.where(~in_train)


def assembler(columns: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output)


def assemble_features(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Numeric columns as one vector."""
    return df.withColumn(output, array_to_vector(F.array(*[field(c).cast("double") for c in columns])))


def vector_values(df: DataFrame, column: str = "features") -> DataFrame:
    """The vector as an array of doubles."""
    return df.withColumn(column, vector_to_array(field(column)))
