"""The jobs: three topics, combine, train, score. Each is one plan without a trip to the driver."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.functions.timeparts import split_report_time
from cityweave.functions.values import CITY_ALIASES, resolve_choice
from cityweave.operators.align import align_counted
from cityweave.operators.clean import clean_rows, dropna_any
from cityweave.operators.cluster import PollutionModel, fit_pollution
from cityweave.operators.features import hash_split
from cityweave.operators.flatten import drop_columns, flatten_air, flatten_traffic, flatten_weather, incident_time
from cityweave.operators.models import KINDS, Trained, load_model, score, train
from cityweave.session import materialised


def clean_air(raw: DataFrame, source_tz: str = "UTC") -> DataFrame:
    return raw.transform(flatten_air).transform(split_report_time, source_tz=source_tz).transform(clean_rows)


def clean_traffic(raw: DataFrame, source_tz: str = "UTC") -> DataFrame:
    """Incident times carry their zone, so ``source_tz`` is not used."""
    return raw.transform(flatten_traffic).transform(incident_time).transform(split_report_time).transform(clean_rows)


def clean_weather(raw: DataFrame, source_tz: str = "UTC") -> DataFrame:
    return (
        raw.transform(flatten_weather)
        .transform(drop_columns, "sunrise", "sunset", "country")
        .transform(split_report_time, source_tz=source_tz)
        .transform(clean_rows)
    )


TOPIC_JOBS: Mapping[str, Callable[..., DataFrame]] = {
    "air": clean_air,
    "traffic": clean_traffic,
    "weather": clean_weather,
}


def topic_job(raw: DataFrame, topic: str, source_tz: str = "UTC") -> DataFrame:
    """Raw records of a topic -> clean rows."""
    return TOPIC_JOBS[topic](raw, source_tz=source_tz)


def topic_jobs(raws: Mapping[str, DataFrame], source_tz: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """A named collection of raw frames -> a collection of clean frames with the same names."""
    zones = source_tz or {}
    return {topic: topic_job(raw, topic, zones.get(topic, "UTC")) for topic, raw in raws.items()}


def combine_job(
    traffic: DataFrame,
    weather: DataFrame,
    air: DataFrame,
    bucket_minutes: int = 1,
    aliases=CITY_ALIASES,
    model: PollutionModel | None = None,
    **clustering,
) -> DataFrame:
    """Clean topics -> aligned rows with a pollution level, without repeats and gaps.

    Combinations that repeat are one row that counts as often in the clustering, so nothing is left to
    remove after the join. Rows with gaps take part in the clustering and go afterwards. The level depends
    on the row alone, so it is worked out last, for the rows that stay. ``model`` gives levels without a fit.
    """
    if traffic.schema["length"].dataType.typeName() == "struct":
        traffic = traffic.withColumn("length", resolve_choice(traffic["length"]))
    aligned = align_counted(traffic, weather, air, bucket_minutes, aliases)
    if model is None:  # the fit and the levels pass over the rows
        aligned = materialised(aligned, "aligned")
        model = fit_pollution(aligned, weight="copies", **clustering)
    combined = model.label(dropna_any(aligned.drop("copies")))
    # Without the test the filter is not there to be pushed down, which would work out levels twice.
    return combined if model.names_all() else combined.where(F.col("pollution_level").isNotNull())


def train_job(combined: DataFrame, kind: str, split_keys: tuple[str, ...] = ("_id",), exclude=()) -> Trained:
    """80/20 split by key, fit, metrics of both parts."""
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    train_df, test_df = hash_split(materialised(combined, "to-train"), *split_keys)
    return train(train_df, test_df, kind, exclude)


def score_job(model: str | PipelineModel, rows: DataFrame, keep=()) -> DataFrame:
    """Score rows, batch or stream, with a model or the path of a saved one."""
    return score(load_model(model) if isinstance(model, str) else model, rows, keep)
