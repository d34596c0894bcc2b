"""Profiling. Each report is one pass over the columns it needs, whatever their number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, StructType, TimestampNTZType, TimestampType

from cityweave.functions.columns import field, is_missing, long_form, number, numeric_columns, text_columns
from cityweave.functions.values import percent
from cityweave.operators.quantiles import fences, quantiles

BINS = 20
GRID = 200


def _report(df: DataFrame, columns: Sequence[str], measures: dict[str, list[Column]], finish) -> DataFrame:
    """Aggregate all measures of all columns at once, then give one row per column.

    ``finish(values)`` turns the aggregated measures of one column into named output columns.
    """
    aggregates, rows = [], []
    for i, c in enumerate(columns):
        values = {}
        for name, per_column in measures.items():
            alias = f"{name}_{i}"
            aggregates.append(per_column[i].alias(alias))
            values[name] = F.col(alias)
        rows.append(F.struct(F.lit(c).alias("column"), *[v.alias(k) for k, v in finish(values).items()]))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def profile_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def _comparable(value: Column, kind: DataType) -> Column:
    """A value as JSON tells it apart: one zero, clocks to the microsecond, at any depth."""
    if isinstance(kind, (DoubleType, FloatType)):
        return value + F.lit(0.0).cast(kind)
    if isinstance(kind, TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), value)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _comparable(x, kind.elementType))
    if isinstance(kind, StructType):
        inner = [_comparable(value.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind)]
        return F.when(value.isNotNull(), F.struct(*inner))
    return value


def profile_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows. Digests of the rows travel, not the rows."""
    row = F.to_json(F.struct(*[_comparable(field(f.name), f.dataType).alias(f"c{i}") for i, f in enumerate(df.schema)]))
    digests = df.select(F.unhex(F.sha2(row, 256)).alias("digest"), F.octet_length(row).alias("bytes"))
    groups = digests.groupBy("digest", "bytes").agg(F.count("*").alias("_copies"))
    return groups.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def profile_nulls(df: DataFrame) -> DataFrame:
    counts = [F.count(F.when(is_missing(df, c), 1)) for c in df.columns]
    return _report(df, df.columns, {"n": counts}, lambda v: {"nulls": v["n"]})


def profile_info(df: DataFrame) -> DataFrame:
    counts = [F.count(F.when(~is_missing(df, c), 1)) for c in df.columns]
    report = _report(df, df.columns, {"n": counts}, lambda v: {"non_null": v["n"]})
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    return report.withColumn("dtype", types[F.col("column")])


def profile_zeros(df: DataFrame) -> DataFrame:
    """Zeros per column, and their share of the present values. Text is never zero."""
    numeric = set(numeric_columns(df))
    zeros = [F.count(F.when(field(c) == 0, 1)) if c in numeric else F.lit(0).cast("bigint") for c in df.columns]
    present = [F.count(F.when(~is_missing(df, c), 1)) for c in df.columns]
    return _report(
        df,
        df.columns,
        {"zeros": zeros, "present": present},
        lambda v: {"zero_count": v["zeros"], "zero_percentage": percent(v["zeros"], v["present"])},
    )


def columns_by_type(df: DataFrame, kind: str = "number") -> DataFrame:
    """Only the numeric columns (``number``) or only the text columns (``object``)."""
    chosen = {"number": numeric_columns, "object": text_columns}[kind](df)
    return df.select(*[field(c) for c in chosen])


def _fences(df: DataFrame, columns: Sequence[str], approximate: bool) -> dict[str, tuple[float, float]]:
    found = quantiles(df, columns, [0.25, 0.75], approximate)
    return {c: fences(*q) for c, q in found.items() if q[0] is not None}


def _outside(df: DataFrame, name: str, fence: tuple[float, float] | None) -> Column:
    """Beyond the fences and present. The comparison stands alone, so that scans can use it."""
    if fence is None:
        return F.lit(False)
    value = field(name)
    beyond = (value < fence[0]) | (value > fence[1])
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        beyond = beyond & ~F.isnan(value)
    return beyond


def profile_outliers(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Values beyond 1.5 interquartile ranges per numeric column, and their share of the rows."""
    columns = list(columns or numeric_columns(df))
    limits = _fences(df, columns, approximate)
    outside = [F.count(F.when(_outside(df, c, limits.get(c)), 1)) for c in columns]
    return _report(
        df,
        columns,
        {"out": outside, "rows": [F.count("*")] * len(columns)},
        lambda v: {"num_outliers": v["out"], "percentage": percent(v["out"], v["rows"])},
    )


def iqr_outliers(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """The rows whose value lies beyond the fences. The fences are literals, so scans can skip."""
    return df.where(_outside(df, column, _fences(df, [column], approximate).get(column)))


def _ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """(n, min, max, sample standard deviation) per column with any value."""
    measures = []
    for c in columns:
        value = number(df, c)
        measures.append(F.struct(F.count(value), F.min(value), F.max(value), F.stddev_samp(value)))
    row = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures)]).first()
    return {c: tuple(row[i]) for i, c in enumerate(columns) if row[i][0]}


def _lookup(values: dict[str, float], key: Column) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(float(v)))])[key]


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = BINS) -> DataFrame:
    """Counts in ``bins`` equal-width bins per numeric column; the last bin is closed.

    Empty bins are listed with a count of 0. A constant column has one bin of width 0.
    """
    columns = list(columns or numeric_columns(df))
    ranges = _ranges(df, columns)
    low = {c: r[1] for c, r in ranges.items()}
    width = {c: (r[2] - r[1]) / bins for c, r in ranges.items()}
    if not ranges:
        return df.sparkSession.createDataFrame(
            [], "column string, bin int, bin_low double, bin_high double, count bigint"
        )
    start, step = _lookup(low, F.col("column")), _lookup(width, F.col("column"))
    slot = F.when(step > 0, F.least(F.floor((F.col("value") - start) / F.nullif(step, F.lit(0.0))), F.lit(bins - 1)))
    counts = (
        long_form(df, list(ranges))
        .groupBy("column", F.coalesce(slot, F.lit(0)).cast("int").alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    # A row per column and bin, whatever the data.
    last = F.when(step > 0, F.lit(bins - 1)).otherwise(0)
    every = df.sparkSession.createDataFrame([(c,) for c in ranges], "column string")
    every = every.withColumn("bin", F.explode(F.sequence(F.lit(0), last)))
    return every.join(counts, ["column", "bin"], "left").select(
        "column",
        "bin",
        (start + F.col("bin") * step).alias("bin_low"),
        (start + (F.col("bin") + 1) * step).alias("bin_high"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def kde_curve(
    df: DataFrame, columns: Sequence[str] | None = None, grid: int = GRID, mode: str = "exact", bins: int = 2000
) -> DataFrame:
    """Gaussian density of each numeric column at ``grid`` points from minimum to maximum.

    The bandwidth is Scott's, ``n**(-1/5)`` sample deviations. ``exact`` adds up every value at
    every point, as a vector of ``grid`` terms a value; the sums are partial in each task, so a vector per column leaves it.
    ``binned`` adds up the centres of ``bins`` fine bins instead, so its cost after one counting
    pass does not grow with the rows. ``height`` is the density on the scale of the 20-bin
    histogram.
    """
    columns = list(columns or numeric_columns(df))
    ranges = {c: r for c, r in _ranges(df, columns).items() if r[0] > 1 and r[3]}
    if not ranges:
        return df.sparkSession.createDataFrame([], "column string, point int, x double, density double, height double")
    key = F.col("column")
    low = _lookup({c: r[1] for c, r in ranges.items()}, key)
    step = _lookup({c: (r[2] - r[1]) / (grid - 1) for c, r in ranges.items()}, key)
    band = _lookup({c: r[3] * r[0] ** -0.2 for c, r in ranges.items()}, key)
    area = _lookup({c: r[0] * r[3] * r[0] ** -0.2 * 2.5066282746310002 for c, r in ranges.items()}, key)
    bar = _lookup({c: r[0] * (r[2] - r[1]) / BINS for c, r in ranges.items()}, key)

    if mode == "exact":
        weighted = long_form(df, list(ranges)).withColumn("weight", F.lit(1))
    elif mode == "binned":
        weighted = histogram(df, list(ranges), bins).select(
            "column", ((F.col("bin_low") + F.col("bin_high")) / 2).alias("value"), F.col("count").alias("weight")
        )
    else:
        raise ValueError("mode is exact or binned")
    per_row = weighted.select(key, "weight", "value", low.alias("low"), step.alias("step"), band.alias("band"))
    first, apart = (F.col("low") - F.col("value")) / F.col("band"), F.col("step") / F.col("band")
    scaled = per_row.select("column", F.col("weight").cast("double").alias("weight"), first.alias("first"), apart.alias("apart"))

    def term(at: Column) -> Column:
        away = F.col("first") + at * F.col("apart")
        return F.col("weight") * F.exp(-0.5 * away * away)

    terms = scaled.select("column", array_to_vector(F.transform(F.sequence(F.lit(0), F.lit(grid - 1)), term)).alias("terms"))
    mass = terms.groupBy("column").agg(vector_to_array(Summarizer.sum(F.col("terms"))).alias("mass"))
    return (
        mass.select("column", F.posexplode("mass").alias("point", "mass"))
        .select(
            "column",
            "point",
            (low + F.col("point") * step).alias("x"),
            (F.col("mass") / area).alias("density"),
            (F.col("mass") / area * bar).alias("height"),
        )
    )


def boxplot_stats(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Quartiles, whiskers (last values inside the fences) and number of fliers per column."""
    columns = list(columns or numeric_columns(df))
    found = {c: q for c, q in quantiles(df, columns, [0.25, 0.5, 0.75], approximate).items() if q[0] is not None}
    columns = [c for c in columns if c in found]
    if not columns:
        return df.sparkSession.createDataFrame(
            [],
            "column string, q1 double, median double, q3 double, whisker_low double, whisker_high double, fliers bigint",
        )
    limits = {c: fences(q[0], q[2]) for c, q in found.items()}
    inside = [F.when(~_outside(df, c, limits[c]), number(df, c)) for c in columns]
    key = F.col("column")
    report = _report(
        df,
        columns,
        {
            "low": [F.min(v) for v in inside],
            "high": [F.max(v) for v in inside],
            "out": [F.count(F.when(_outside(df, c, limits[c]), 1)) for c in columns],
        },
        lambda v: {"whisker_low": v["low"], "whisker_high": v["high"], "fliers": v["out"]},
    )
    return report.select(
        key,
        *[_lookup({c: q[i] for c, q in found.items()}, key).alias(n) for i, n in enumerate(("q1", "median", "q3"))],
        "whisker_low",
        "whisker_high",
        "fliers",
    )
