"""Batch sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation

from cityweave.operators.quality import DEFAULT_RULES, observed, outcomes
from cityweave.session import materialised

# Fixed value: records per upload of the incident feed.
UPLOAD_RECORDS = 100


def write_json(
    df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = (), max_records: int = 0
) -> None:
    """JSON lines. ``max_records`` bounds the records of a file; 0 is no bound.

    Rows of one folder are brought together before the write, so that a folder gets few files;
    the rebalance hint cuts a folder that holds much of the data into several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def write_documents(df: DataFrame, format: str, options: Mapping[str, str], mode: str = "append") -> None:
    """Write through any connector; where it goes and who may is the caller's to say."""
    df.write.format(format).options(**dict(options)).mode(mode).save()


def fan_out(
    df: DataFrame,
    json_path: str | None = None,
    documents: tuple[str, Mapping[str, str]] | None = None,
    rules: Sequence[tuple] = DEFAULT_RULES,
) -> DataFrame:
    """Document sink, quality rules and file sink of one frame that is computed once.

    The frame is stored in the shared folder; the rules' measures are gathered during that write, at
    no pass of their own. Returns the rule outcomes. A failed rule does not stop a write.
    """
    measured = Observation("quality")
    df = materialised(observed(df, rules, measured), "fan-out")
    if documents is not None:
        write_documents(df, *documents)
    if json_path is not None:
        write_json(df, json_path)
    return outcomes(df.sparkSession, rules, measured.get)
