"""A Spark data source that reads windows of detections from an HTTP API that answers with CSV.

    spark.dataSource.register(AreaSource)
    spark.read.format("detections_area").options(url="https://.../{key}/{source}/{bbox}/{days}/{date}", key=..., source=...,
                                                 start="2024-01-01", end="2024-01-31", bbox="...").load()

`windows` takes the place of `start` and `end` where they do not follow each other. A partition is one or more windows, so a lost task
fetches its windows again and nothing else. `parallel` partitions, 1 by default, share the pace that one client is allowed: each waits
`parallel` times `pace` seconds between its requests, and begins in its turn. They share one budget of requests too, which the API itself
counts: with the option `status`, a URL that tells how many are used and allowed, a task asks before its first window and then once in
`status_every` windows of all partitions together, and waits while the budget is nearly used up. A wait that has no end is an error.
"""

from __future__ import annotations

import csv
import io
import json
import math
import time
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from urllib.error import HTTPError, URLError
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..config import DEFAULT

# fixed values: the fields of an answer
COLUMNS = ("latitude", "longitude", "bright_ti4", "scan", "track", "acq_date", "acq_time", "satellite", "instrument", "confidence", "version", "bright_ti5", "frp", "daynight", "type")
# fixed values: seconds before each new attempt; answers that are worth one
WAITS = (2, 4, 8, 16, 32)
BUSY = {429, 500, 502, 503, 504}

Get = Callable[[str], tuple[int, str]]


class ApiError(RuntimeError):
    """The API refused, or stayed out of reach."""


def http_get(url: str) -> tuple[int, str]:
    """(status, body) of an answer; status 0 stands for none."""
    try:
        with urlopen(url, timeout=60) as answer:  # noqa: S310
            return answer.status, answer.read().decode()
    except HTTPError as refused:
        return refused.code, refused.read().decode(errors="replace")
    except (URLError, OSError) as lost:
        return 0, str(lost)


def fetch(url: str, key: str = "", *, get: Get = http_get, sleep: Callable[[float], None] = time.sleep, waits: tuple[float, ...] = WAITS) -> str:
    """The body of the first good answer; one attempt, and another after each of `waits`. Errors never show the key."""
    seen = []
    for wait in (0, *waits):
        if wait:
            sleep(wait)
        status, body = get(url)
        seen.append(status)
        if status == 200:
            return body
        if status not in BUSY | {0}:
            break
    shown = f"{url} answered {seen}, last with {body[:200]!r}"
    raise ApiError(shown.replace(key, "***") if key else shown)


def budget(url: str, get: Get = http_get) -> tuple[int, int] | None:
    """(used, allowed) requests, as the API's status page tells them; None if it does not."""
    status, body = get(url)
    try:
        told = json.loads(body) if status == 200 else {}
        return int(told["current_transactions"]), int(told["transaction_limit"])
    except (ValueError, KeyError, TypeError):
        return None


def hold_back(url: str, *, get: Get = http_get, sleep: Callable[[float], None] = time.sleep, share: float = 0.9, pause: float = 60.0, most_pauses: int = 60) -> None:
    """Returns when at most `share` of the allowed requests are used, or their number is not to be had."""
    for _ in range(most_pauses + 1):
        told = budget(url, get)
        if not told or told[0] <= share * told[1]:
            return
        sleep(pause)
    raise ApiError(f"{told[0]} of {told[1]} requests are still used after {most_pauses} pauses of {pause} seconds")


def parse(body: str) -> list[tuple]:
    """Rows as texts, in the order of COLUMNS; fields that an answer lacks are null. Extra fields are left out."""
    rows = csv.DictReader(io.StringIO(body.lstrip()))
    missing = {"latitude", "longitude", "acq_date"} - set(rows.fieldnames or ())
    if missing:
        raise ApiError(f"no CSV of detections, {sorted(missing)} not in {body[:200]!r}")
    return [tuple(row.get(c) or None for c in COLUMNS) for row in rows]


def availability(spark: SparkSession, url: str, key: str = "", get: Get = http_get) -> DataFrame:
    """(source, min_date, max_date) of the sources that the API offers."""
    rows = csv.DictReader(io.StringIO(fetch(url.format(key=key), key, get=get)))
    return spark.createDataFrame([(r["data_id"], date.fromisoformat(r["min_date"]), date.fromisoformat(r["max_date"])) for r in rows], "source string, min_date date, max_date date")


class Windows(InputPartition):
    """(first day, number of days) of the windows that a task fetches; its turn among the partitions, and how many they are."""

    def __init__(self, items: list[tuple[str, int]], turn: int = 0, of: int = 1):
        super().__init__(turn)
        self.items, self.turn, self.of = items, turn, of


class AreaReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        if "windows" in self.options:  # day:length of each, with commas between them
            items = [(w.split(":")[0], int(w.split(":")[1])) for w in self.options["windows"].split(",") if w]
        else:
            first, last = (date.fromisoformat(self.options[x]) for x in ("start", "end"))
            days = int(self.options.get("days", DEFAULT.days_per_request))
            begins = [first + timedelta(days=days * i) for i in range(max(0, math.ceil(((last - first).days + 1) / days)))]
            items = [(b.isoformat(), min(days, (last - b).days + 1)) for b in begins]
        parallel = max(1, min(int(self.options.get("parallel", 1)), len(items)))
        return [Windows(items[i::parallel], i, parallel) for i in range(parallel)]

    def read(self, partition: Windows) -> Iterator[tuple]:
        o = self.options
        key, pace = o.get("key", ""), float(o.get("pace", DEFAULT.request_interval_s))
        every = max(1, int(o.get("status_every", 20)) // partition.of)
        for i, (day, n) in enumerate(partition.items):
            time.sleep(pace * (partition.of if i else partition.turn))
            if "status" in o and i % every == 0:
                hold_back(o["status"].format(key=key), pause=float(o.get("pause", 60)))
            yield from parse(fetch(o["url"].format(key=key, source=o["source"], bbox=o.get("bbox", ""), days=n, date=day), key))


class AreaSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "detections_area"

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in COLUMNS)

    def reader(self, schema) -> DataSourceReader:
        return AreaReader(self.options)
