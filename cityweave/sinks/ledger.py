"""Fan-out of a stream: several sinks and the quality rules, each batch once in every sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cityweave.operators.quality import DEFAULT_RULES, observed, outcomes
from cityweave.session import materialised

Sink = Callable[[DataFrame, int], None]
#: Name under which the ledger has the rules' outcomes.
RULES = "rules"


class Ledger:
    """Which sink has taken which batch: a folder per batch and sink, written after the sink has."""

    def __init__(self, path: str) -> None:
        self.path = path

    def taken(self, spark: SparkSession, batch_id: int) -> set[str]:
        try:
            rows = spark.read.schema("rows bigint, sink string").json(f"{self.path}/batch={batch_id}")
            return {row.sink for row in rows.select("sink").distinct().collect()}  # a row per sink
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return set()

    def note(self, spark: SparkSession, sink: str, batch_id: int, rows: int) -> None:
        entry = spark.range(1).select(F.lit(rows).cast("bigint").alias("rows"))
        entry.write.mode("overwrite").json(f"{self.path}/batch={batch_id}/sink={sink}")

    def entries(self, spark: SparkSession) -> DataFrame:
        """``batch``, ``sink`` and the number of ``rows`` that it took."""
        return spark.read.schema("rows bigint, batch bigint, sink string").json(self.path).select("batch", "sink", "rows")


def fan_out_sink(sinks: Mapping[str, Sink], path: str, rules: Sequence[tuple] = DEFAULT_RULES) -> Sink:
    """A ``foreachBatch`` sink that gives each batch to every sink and evaluates the rules on it.

    The batch is computed once, into the shared folder, and the rules' measures are gathered during that write. A sink that raises doesn't
    stop the others; the batch then fails, and when it is run again only the sinks that the ledger under ``path`` lacks get it. A sink
    that was cut off in the middle of its own write gets the batch again, so it should own a folder per batch, or replace by key, as the given
    number of the batch allows. Failed rules stop nothing. ``read_outcomes`` has the outcomes of each batch.
    """
    if RULES in sinks:
        raise ValueError(f"{RULES} is the name of the rules' outcomes")
    ledger = Ledger(f"{path}/ledger")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        taken = ledger.taken(spark, batch_id)
        if taken >= {RULES, *sinks}:
            return
        measured = Observation()
        rows = materialised(observed(batch, rules, measured), "fan-out")
        count = rows.count()  # from the files' footers
        if RULES not in taken:
            outcomes(spark, rules, measured.get).write.mode("overwrite").parquet(f"{path}/outcomes/batch={batch_id}")
            ledger.note(spark, RULES, batch_id, count)
        failed = []
        for name, sink in sinks.items():
            if name in taken:
                continue
            try:
                sink(rows, batch_id)
            except Exception as err:  # a sink may raise anything; the others get the batch all the same
                failed.append(err)
            else:
                ledger.note(spark, name, batch_id, count)
        if failed:
            raise failed[0]

    return write


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """``batch``, ``rule``, ``outcome`` and ``actual`` of every batch."""
    schema = "rule string, outcome string, actual double, batch bigint"
    return spark.read.schema(schema).parquet(f"{path}/outcomes").select("batch", "rule", "outcome", "actual")
