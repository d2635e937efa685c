"""Paged REST resources as a Spark data source.

``spark.dataSource.register(PagedSource)``, then ``spark.read.format("paged").option("transport", "module:function")``.
The transport takes a dict of parameters and returns one page: {"results": [...], "next": {...} or None}. The values of
the option ``keys`` are read page by page in at most ``parallel`` partitions, which share the allowed rate between them;
``min_date`` and ``max_date`` are passed to the transport, so the server does the filtering. A column ``next_cursor`` holds,
as JSON, where a row's page ends; the option ``cursors`` (JSON, key to cursor) resumes there, and a key with a null cursor is done.
"""

from __future__ import annotations

import importlib
import json
import time
from collections import deque
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class RateLimit:
    """At most so many calls in each of several sliding windows, and a least gap between two calls."""

    def __init__(self, limits: dict[float, int], gap: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.limits, self.gap, self.clock, self.sleep = limits, gap, clock, sleep
        self.calls: deque[float] = deque()

    def wait(self) -> None:
        while True:
            now = self.clock()
            while self.calls and now - self.calls[0] >= max(self.limits, default=0):
                self.calls.popleft()
            waits = [self.gap - (now - self.calls[-1])] if self.calls else []
            for window, most in self.limits.items():
                recent = [t for t in self.calls if now - t < window]
                if len(recent) >= most:
                    waits.append(window - (now - recent[-most]))
            pause = max(waits, default=0)
            if pause <= 0:
                self.calls.append(now)
                return
            self.sleep(pause)


class ClientError(Exception):
    """The request itself is at fault; trying again is useless."""


class Throttled(Exception):
    """The server asks to slow down."""


def with_retries(call: Callable[[], dict], tries: int = 5, first: float = 1.0, throttled: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    for k in range(tries):
        try:
            return call()
        except ClientError:
            raise
        except Throttled:
            if k == tries - 1:
                raise
            sleep(throttled * 2**k)
        except Exception:
            if k == tries - 1:
                raise
            sleep(first * 2**k)
    raise AssertionError


class KeyPartition(InputPartition):
    def __init__(self, keys: list[str], share: int) -> None:
        self.keys, self.share = keys, share


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.names, self.options = schema.names, options
        self.perminute, self.perhour = int(options.get("perminute", 55)), int(options.get("perhour", 950))

    def partitions(self) -> list[KeyPartition]:
        keys = [k for k in self.options.get("keys", "").split(",") if k]
        n = max(1, min(int(self.options.get("parallel", 4)), len(keys), self.perminute, self.perhour))
        return [KeyPartition(keys[i::n], n) for i in range(n)]

    def read(self, partition: KeyPartition) -> Iterator[tuple]:
        module, _, name = self.options["transport"].partition(":")
        transport = getattr(importlib.import_module(module), name)
        # partitions run at the same time, so each has its part of the quota and waits so many times the gap
        n = partition.share
        limit = RateLimit({60.0: self.perminute // n, 3600.0: self.perhour // n}, float(self.options.get("gap", 1.1)) * n)
        given: dict = {"per_page": int(self.options.get("perpage", 100))}
        given |= {k: self.options[o] for k, o in (("min_date", "mindate"), ("max_date", "maxdate")) if o in self.options}
        starts = json.loads(self.options.get("cursors", "{}"))
        for key in partition.keys:
            cursor: dict | None = starts.get(key, {})
            while cursor is not None:
                limit.wait()
                page = with_retries(lambda: transport(given | {"key": key} | cursor))  # noqa: B023
                cursor = page.get("next") if page["results"] else None
                own = {"raw_json": json.dumps, "next_cursor": lambda _: json.dumps(cursor)}  # noqa: B023
                for row in page["results"]:
                    yield tuple(own[n](row) if n in own else row.get(n) for n in self.names)


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "raw_json string"

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, {k.lower(): v for k, v in self.options.items()})
