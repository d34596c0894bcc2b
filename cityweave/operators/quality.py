"""Data-quality rules: evaluated and published, never a reason to stop a job."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cityweave.functions.columns import is_missing, quoted

_TESTS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "==": operator.eq}

# (measure, test, bound); measures: ColumnCount, RowCount, or ("Completeness", column).
DEFAULT_RULES = (("ColumnCount", ">", 0),)


def _measure(df: DataFrame, measure):
    if measure == "ColumnCount":
        return F.lit(float(len(df.columns)))
    if measure == "RowCount":
        return F.count("*").cast("double")
    if measure[0] == "Completeness":
        present = F.count(F.when(~is_missing(df, measure[1]), 1))
        return F.coalesce(present / F.nullif(F.count("*"), F.lit(0)), F.lit(1.0))
    raise ValueError(f"unknown measure: {measure}")


def _name(measure, test: str, bound) -> str:
    label = measure if isinstance(measure, str) else f"{measure[0]} {quoted(measure[1])}"
    return f"{label} {test} {bound}"


def evaluate_rules(df: DataFrame, rules: Sequence[tuple] = DEFAULT_RULES) -> DataFrame:
    """One row per rule: rule, outcome (Passed or Failed), actual. All rules share one pass."""
    measured = df.agg(
        F.count("*").alias("_rows"), *[_measure(df, m).alias(f"m{i}") for i, (m, _, _) in enumerate(rules)]
    )
    rows = [
        F.struct(
            F.lit(_name(m, test, bound)).alias("rule"),
            F.when(_TESTS[test](F.col(f"m{i}"), F.lit(float(bound))), "Passed").otherwise("Failed").alias("outcome"),
            F.col(f"m{i}").alias("actual"),
        )
        for i, (m, test, bound) in enumerate(rules)
    ]
    return measured.select(F.inline(F.array(*rows)))


def outcomes(spark: SparkSession, rules: Sequence[tuple], measured: Mapping[str, float]) -> DataFrame:
    """What ``evaluate_rules`` gives, from measures that were gathered by ``observed``."""
    rows = []
    for measure, test, bound in rules:
        actual = float(measured[_name(measure, test, bound)])
        rows.append((_name(measure, test, bound), "Passed" if _TESTS[test](actual, float(bound)) else "Failed", actual))
    return spark.createDataFrame(rows, "rule string, outcome string, actual double")


def observed(df: DataFrame, rules: Sequence[tuple] = DEFAULT_RULES, name: str | Observation = "quality") -> DataFrame:
    """The frame itself; the rules' measures are gathered while it is written, at no extra pass.

    Works on streams, where a query's progress reports them per batch under ``name``. With an ``Observation``
    the caller reads them after a batch write.
    """
    measures = [_measure(df, m).alias(_name(m, test, bound)) for m, test, bound in rules]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *measures)
