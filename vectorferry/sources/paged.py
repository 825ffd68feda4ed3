"""``paged`` data source: read a collection page by page through a pager.

A pager answers two questions: how many rows there are, and which rows are in
``[offset, offset + limit)``. Page ranges are spread over tasks, so executors
fetch in parallel; each fetch is retried, also when it hangs. A pager is a class named
in the option ``pager`` as ``module:Class`` and is given all options, whose names are not
case-sensitive. ``pagesPerTask`` and ``maxTasks`` bound the ranges.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from queue import Empty, Queue
from threading import Thread

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    CaseInsensitiveDict,
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)
from pyspark.sql.pandas.types import from_arrow_schema

FETCH_ATTEMPTS = 5
FETCH_TIMEOUT = 60.0  # seconds


@dataclass
class PageRange(InputPartition):
    start: int
    stop: int


def _within(call: Callable, seconds: float | None):
    """The result of a call, or ``TimeoutError`` if it takes longer; the call is then left behind."""
    if seconds is None:
        return call()
    answer: Queue = Queue()

    def run() -> None:
        try:
            answer.put((call(), None))
        except BaseException as error:
            answer.put((None, error))

    Thread(target=run, daemon=True).start()
    try:
        value, error = answer.get(timeout=seconds)
    except Empty:
        raise TimeoutError(f"no answer within {seconds} s") from None
    if error is not None:
        raise error
    return value


def with_retries(
    call: Callable, attempts: int = FETCH_ATTEMPTS, sleep: Callable[[float], None] = time.sleep,
    timeout: float | None = FETCH_TIMEOUT,
):
    """Call until it succeeds; waits 1, 2, 4, 8 s between five attempts of ``timeout`` seconds each."""
    for attempt in range(attempts):
        try:
            return _within(call, timeout)
        except Exception:
            if attempt == attempts - 1:
                raise
            sleep(2 ** attempt)


def _pager(options: Mapping[str, str], default: Callable | None = None):
    name = options.get("pager")
    if not name:
        if default is None:
            raise ValueError("option 'pager' must name a pager, module:Class")
        return default(options)
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)(options)


class _Pages:
    """Shared by the batch and the streaming reader."""

    def __init__(self, options: Mapping[str, str], default: Callable | None = None):
        self.options = CaseInsensitiveDict(dict(options))
        self.default = default
        self.page_size = int(self.options.get("pageSize", 1000))
        if self.page_size <= 0:
            raise ValueError("pageSize must be positive")
        self.pages_per_task = int(self.options.get("pagesPerTask", 64))
        self.max_tasks = int(self.options.get("maxTasks", 20_000))
        self.timeout = float(self.options.get("timeout", FETCH_TIMEOUT))

    def ask(self, call: Callable):
        return with_retries(call, timeout=self.timeout)

    def ranges(self, start: int, stop: int) -> list[PageRange]:
        """Whole pages per task; more than asked for if there would be too many tasks."""
        pages = -(-max(stop - start, 0) // self.page_size)
        step = self.page_size * max(self.pages_per_task, -(-pages // self.max_tasks))
        return [PageRange(a, min(a + step, stop)) for a in range(start, stop, step)]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        pager = self.ask(lambda: _pager(self.options, self.default))
        for offset in range(partition.start, partition.stop, self.page_size):
            limit = min(self.page_size, partition.stop - offset)
            yield from self.ask(lambda: list(pager.fetch(offset, limit)))


class PagedReader(_Pages, DataSourceReader):
    def partitions(self) -> list[PageRange]:
        stop = self.ask(lambda: _pager(self.options, self.default).count())
        return self.ranges(int(self.options.get("startOffset", 0)), stop)


class PagedStreamReader(_Pages, DataSourceStreamReader):
    """Offsets are row positions; a micro-batch takes all there is, spread over tasks.

    Spark asks a source like this only once for the end of an ``availableNow`` run, so a
    bound on micro-batches would leave rows behind.
    """

    def initialOffset(self) -> dict:
        return {"row": int(self.options.get("startOffset", 0))}

    def latestOffset(self) -> dict:
        stop = self.ask(lambda: _pager(self.options, self.default).count())
        return {"row": max(stop, self.initialOffset()["row"])}

    def partitions(self, start: dict, end: dict) -> list[PageRange]:
        return self.ranges(start["row"], end["row"])

    def commit(self, end: dict) -> None:
        pass


class PagedSource(DataSource):
    default: Callable | None = None

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self):
        return from_arrow_schema(_pager(self.options, type(self).default).schema(), prefer_timestamp_ntz=True)

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options, type(self).default)

    def streamReader(self, schema) -> PagedStreamReader:
        return PagedStreamReader(self.options, type(self).default)


def register_paged(spark: SparkSession, pager: Callable | None = None) -> None:
    """Make ``spark.read.format("paged")`` known; ``pager`` is used where no option names one.

    A pager given here travels with the query, so executors need not have its module.
    """
    spark.dataSource.register(type("PagedSource", (PagedSource,), {"default": pager}))
