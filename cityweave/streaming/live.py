"""The latest row of each key as live state, and the quality rules' outcomes of each batch of a stream."""

from __future__ import annotations

import math
import threading
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener
from pyspark.sql.types import DataType, MapType, StructType

from cityweave.functions.columns import field
from cityweave.operators.quality import DEFAULT_RULES, observed, outcomes

_CUT = "_cut"


def _rank(value) -> tuple:
    """A sort key in Spark's order: null first, NaN last, nested values element by element."""
    if value is None:
        return (0,)
    if isinstance(value, float) and math.isnan(value):
        return (2,)
    if isinstance(value, (list, tuple)):
        return (1, [_rank(v) for v in value])
    return (1, value)


class _Latest(StatefulProcessor):
    """Keeps the greatest row of a key and gives it out whenever it has changed."""

    def __init__(self, keys: Sequence[str], ranked: Sequence[str], rest: StructType, out: Sequence[str], ttl_ms: int | None) -> None:
        self.keys, self.ranked, self.rest, self.out, self.ttl_ms = list(keys), list(ranked), rest, list(out), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("latest", self.rest, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.kept.get()
        best = None if known is None else tuple(known)
        mark, changed = best and _rank(best), False
        for row in rows:
            own = tuple(row[c] for c in self.ranked)
            rank = _rank(own)
            if mark is None or rank > mark:
                best, mark, changed = own, rank, True
        if changed:
            self.kept.update(best)
            found = {**dict(zip(self.keys, key, strict=False)), **dict(zip(self.ranked, best, strict=True))}
            yield Row(**{c: found[c] for c in self.out})

    def close(self) -> None:
        pass


def _has_map(kind: DataType) -> bool:
    inner = [f.dataType for f in kind.fields] if isinstance(kind, StructType) else [getattr(kind, "elementType", None)]
    return isinstance(kind, MapType) or any(_has_map(k) for k in inner if k is not None)


def live_latest(
    stream: DataFrame, key: str | Sequence[str], order: str, tie_break: Sequence[str] | None = None, ttl_ms: int | None = None, cuts: int = 1
) -> DataFrame:
    """The row with the greatest ``order`` for each key, as a stream of changes for the update mode.

    A key's row is held as state and comes out whenever a batch brought a greater one; ties go to the greatest other columns, as in
    ``latest_per_key``. A batch that brings nothing newer for a key gives nothing for it. A key that no batch has changed for ``ttl_ms`` of
    processing time is forgotten; a row of it, however old, is then the latest again. Null keys are a key, null orders the least.

    The rows of a key are read one by one in one task. With ``cuts`` they are dealt into so many parts by their values, each with a state of
    its own, so that a key with a third of all rows is spread over as many tasks; up to ``cuts`` rows per key and batch come out then, and
    a keyed sink such as ``upsert_sink`` has the last word. The state needs the RocksDB store, which ``start_upserts`` sets.
    """
    keys = [key] if isinstance(key, str) else list(key)
    lead = [order, *(tie_break or [])]
    ranked = [*lead, *sorted(c for c in stream.columns if c not in keys and c not in lead)]
    maps = [c for c in ranked if _has_map(stream.schema[c].dataType)]
    if maps:
        raise ValueError(f"maps have no order: {maps}")
    if _CUT in stream.columns:
        raise ValueError(f"{_CUT} is the name of the part")
    rest = StructType([stream.schema[c] for c in ranked])
    cut = F.pmod(F.xxhash64(*map(field, ranked)), F.lit(cuts)).cast("int")
    groups = stream.withColumn(_CUT, cut).groupBy(*map(field, keys), _CUT)
    return groups.transformWithState(
        statefulProcessor=_Latest(keys, ranked, rest, stream.columns, ttl_ms),
        outputStructType=stream.schema,
        outputMode="Update",
        timeMode="None" if ttl_ms is None else "ProcessingTime",
    )


class RuleLog(StreamingQueryListener):
    """Keeps the outcomes of the rules that ``watched`` put on a stream: a folder per batch under ``path``.

    A batch's measures come with the progress of its query, after its sink took it, at no extra pass. Progress of one batch that is reported twice
    replaces its own folder. If the driver is lost between the two, the outcomes of that one batch are missing; ``fan_out_sink`` has
    them without gaps, for a stored copy of each batch. Add it with ``spark.streams.addListener`` and remove it when it is done.
    """

    def __init__(self, spark: SparkSession, path: str, rules: Sequence[tuple] = DEFAULT_RULES, name: str = "quality") -> None:
        self.spark, self.path, self.rules, self.name = spark, path, rules, name
        self.failed: list[Exception] = []
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def watched(self, stream: DataFrame) -> DataFrame:
        """The stream itself, its measures gathered."""
        return observed(stream, self.rules, self.name)

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        measured = event.progress.observedMetrics.get(self.name)
        if measured is None:
            return
        try:
            rows = outcomes(self.spark, self.rules, measured.asDict())
            rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={event.progress.batchId}")
        except Exception as err:  # raised to the caller by ``wait``; a listener has nobody to raise to
            self.failed.append(err)

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, run: str, seconds: float = 60.0) -> None:
        """Until all progress of an ended run has been kept; events arrive some time after the end."""
        if not self._end(run).wait(seconds):
            raise TimeoutError(f"no end of {run} was reported")
        if self.failed:
            raise self.failed[0]


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """``batch``, ``rule``, ``outcome`` and ``actual`` of every batch."""
    return spark.read.schema("rule string, outcome string, actual double, batch bigint").parquet(path).select("batch", "rule", "outcome", "actual")
