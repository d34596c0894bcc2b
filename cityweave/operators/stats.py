"""Group moments and one-way analysis of variance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.functions.columns import field
from cityweave.session import materialised


def group_moments(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Count, mean and sample variance of ``target`` for each level of each feature.

    One scan for all features; each task keeps one row per level, so large groups do not travel.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), field(c).cast("string").alias("level")) for c in features])
    return (
        df.select(F.inline(pairs), field(target).cast("double").alias("y"))
        .where(F.col("level").isNotNull() & F.col("y").isNotNull())
        .groupBy("feature", "level")
        .agg(
            F.count("*").alias("n"),
            F.avg("y").alias("mean"),
            F.coalesce(F.var_samp("y"), F.lit(0.0)).alias("variance"),
        )
    )


# From so many degrees of freedom within the groups on, F is a chi-square to seven digits, while the
# argument of the beta function is too close to 1 for a double.
MANY = 10**10


def _upper_tail(spark: SparkSession, f: float | None, d1: int, d2: int) -> float | None:
    """P(F > f), by the special functions of the library that Spark brings along."""
    if f is None or f <= 0:
        return None if f is None else 1.0
    special = spark._jvm.org.apache.commons.math3.special
    if d2 > MANY:
        return special.Gamma.regularizedGammaQ(d1 / 2, d1 * f / 2)
    return special.Beta.regularizedBeta(d2 / (d2 + d1 * f), d2 / 2, d1 / 2)


def anova_f(df: DataFrame, features: Sequence[str], target: str, level: float = 0.05) -> DataFrame:
    """One-way ANOVA of a numeric ``target`` across the levels of each text feature.

    A feature with a single level is left out. The statistic is null when no level repeats or
    when the target does not vary inside the levels.
    """
    groups = materialised(group_moments(df, features, target), "moments")  # a row per level, read twice
    # At most one row per feature, whatever the data.
    overall = groups.groupBy("feature").agg(
        F.count("*").alias("k"), F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand")
    )
    sums = (
        groups.join(F.broadcast(overall), "feature")
        .groupBy("feature", "k", "total")
        .agg(
            F.sum(F.col("n") * (F.col("mean") - F.col("grand")) * (F.col("mean") - F.col("grand"))).alias("between"),
            F.sum((F.col("n") - 1) * F.col("variance")).alias("within"),
        )
        .where("k > 1")
    )
    statistic = F.when(
        (F.col("total") > F.col("k")) & (F.col("within") > 0),
        (F.col("between") / (F.col("k") - 1)) / (F.col("within") / F.nullif(F.col("total") - F.col("k"), F.lit(0))),
    )
    tested = sums.select("feature", "k", F.col("total").alias("n"), statistic.alias("f_stat")).collect()  # a row per feature
    spark = df.sparkSession
    rows = []
    for row in tested:
        p = _upper_tail(spark, row.f_stat, row.k - 1, row.n - row.k)
        rows.append((*row, p, p is not None and p < level))
    return spark.createDataFrame(rows, "feature string, k bigint, n bigint, f_stat double, p_value double, significant boolean")


def significant_features(df: DataFrame, features: Sequence[str], target: str, level: float = 0.05) -> DataFrame:
    return anova_f(df, features, target, level).where("significant")
