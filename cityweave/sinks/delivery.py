"""Delivery in batches to a receiver that may refuse some records of a batch."""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from cityweave.functions.columns import field
from cityweave.sinks.files import UPLOAD_RECORDS

DELIVERED, PARKED = "delivered", "parked"
_REPORT = ("status", "tries", "error")


def _sent(send: Callable, records: list[str], tries: int, pause: float, arguments: dict) -> list[tuple[str, int, str | None]]:
    """Status, tries and last error of each record of one batch; only what was refused is sent again."""
    out: list[tuple[str, int, str | None]] = [(PARKED, tries, None)] * len(records)
    left = list(range(len(records)))
    for attempt in range(1, tries + 1):
        if attempt > 1 and pause:
            time.sleep(pause * 2 ** (attempt - 2))
        try:
            errors = send([records[k] for k in left], attempt=attempt, **arguments)
            if len(errors) != len(left):
                raise ValueError("the receiver has to answer for every record")
        except Exception as err:  # nothing is known to have arrived
            errors = [str(err) or type(err).__name__] * len(left)
        for k, error in zip(left, errors, strict=True):
            out[k] = (DELIVERED, attempt, None) if error is None else (PARKED, attempt, error)
        left = [k for k, error in zip(left, errors, strict=True) if error is not None]
        if not left:
            break
    return out


def deliver(
    df: DataFrame,
    send: str,
    path: str,
    tries: int = 3,
    batch_records: int = UPLOAD_RECORDS,
    pause: float = 1.0,
    arguments: Mapping[str, object] | None = None,
) -> DataFrame:
    """Sends every row as a JSON record and returns the rows with ``status``, ``tries`` and ``error``.

    ``send`` is ``module:function``, importable on the executors. It gets a list of at most ``batch_records`` records and
    ``attempt``, and answers with a list of as many errors, None for what it took. Refused records are sent again alone, after ``pause`` seconds that double
    from try to try, and parked after ``tries``. A call that raises has refused all its records.

    The report is written under ``path`` before it is returned, so looking at it sends nothing again, and a batch that runs again
    overwrites its own. A task that is lost and repeated sends its records again; receivers that need each record once go by its key.
    """
    taken = [c for c in df.columns if c in _REPORT]
    if taken:
        raise ValueError(f"columns named like the report's: {taken}")
    module, _, name = send.partition(":")
    given = dict(arguments or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        receiver = getattr(importlib.import_module(module), name)
        for batch in batches:
            for low in range(0, batch.num_rows, batch_records):
                part = batch.slice(low, batch_records)
                done = _sent(receiver, part.column(part.num_columns - 1).to_pylist(), tries, pause, given)
                report = [pa.array([d[k] for d in done], kind) for k, kind in enumerate((pa.string(), pa.int32(), pa.string()))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *report], [*part.schema.names[:-1], *_REPORT])

    schema = StructType([*df.schema.fields, *[StructField(c, t) for c, t in zip(_REPORT, (StringType(), IntegerType(), StringType()), strict=True)]])
    record = F.to_json(F.struct(*[field(c) for c in df.columns])).alias("record")
    df.select(*[field(c) for c in df.columns], record).mapInArrow(run, schema).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def delivery_sink(send: str, path: str, **options) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that delivers each batch; its report lies under ``path/batch=<id>``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        deliver(batch, send, f"{path}/batch={batch_id}", **options)

    return write
