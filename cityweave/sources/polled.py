"""A polled feed as a stream source.

Every interval each location is asked once, on an executor. A failing location gives a row with
an error text and does not stop the others.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

# Seconds between polls of one location.
POLL_SECONDS = {"air": 15, "weather": 15, "traffic": 60}


class Poll(InputPartition):
    def __init__(self, location: str, tick: int):
        super().__init__((location, tick))
        self.location, self.tick = location, tick


class PollReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.fetch = options["fetch"]
        self.locations = json.loads(options["locations"])
        self.arguments = json.loads(options.get("arguments") or "{}")
        self.interval = float(options.get("interval") or POLL_SECONDS[options["topic"]])
        self.history = (options.get("history") or "false").lower() == "true"
        self.first, self.last = (int(options[k]) if options.get(k) else None for k in ("first_tick", "last_tick"))

    def _now(self) -> int:
        return int(time.time() // self.interval)

    def initialOffset(self) -> dict:
        if self.first is not None:
            return {"tick": self.first - 1}
        return {"tick": self._now() - 1 if self.history else 0}

    def latestOffset(self) -> dict:
        return {"tick": self._now() if self.last is None else min(self.last, self._now())}

    def partitions(self, start: dict, end: dict) -> list[Poll]:
        if self.history:
            return [Poll(name, tick) for tick in range(start["tick"] + 1, end["tick"] + 1) for name in self.locations]
        # Missed ticks cannot be made up: a poll always gives the present state.
        return [Poll(name, end["tick"]) for name in self.locations] if end["tick"] > start["tick"] else []

    def read(self, partition: Poll) -> Iterator[tuple]:
        module, _, name = self.fetch.partition(":")
        stamp = time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime())
        when = {"tick": partition.tick} if self.history else {}
        try:
            body = getattr(importlib.import_module(module), name)(partition.location, **when, **self.arguments)
            yield partition.location, stamp, body, None, partition.tick
        except Exception as err:  # the caller's function may raise anything
            yield partition.location, stamp, None, str(err), partition.tick


class PolledFeed(DataSource):
    """``spark.readStream.format("polled_feed")`` with options

    - ``fetch``: ``module:function`` from location to JSON text, importable on the executors;
    - ``arguments``: JSON object of further arguments by name;
    - ``locations``: JSON list of location names;
    - ``interval``: seconds between polls; by default those of ``topic``, one of air, weather and traffic;
    - ``history``: ``true`` for a feed that can be asked for the past. The function also gets ``tick``, the number of the interval,
      and every tick is polled once for each location, those missed between two batches or restarts included;
    - ``first_tick``, ``last_tick``: ticks to begin and to end with.
    """

    @classmethod
    def name(cls) -> str:
        return "polled_feed"

    def schema(self) -> str:
        return "location string, report_time string, value string, error string, tick bigint"

    def streamReader(self, schema: StructType) -> PollReader:
        return PollReader(dict(self.options))
