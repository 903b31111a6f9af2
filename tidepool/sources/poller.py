"""A polled source of derivative series: open interest, liquidations, funding, long-short ratio.

``spark.dataSource.register(Poller)``, then ``spark.read`` or ``spark.readStream`` with format ``tidepool-poller``. Each symbol and
series is one partition of a read, so a slow answer holds up no other. A stream's offset is the time up to which it has polled; a poll asks
again for the ``lookback`` before it, since points are published late, and :func:`points` drops what it has had before.

Options: ``symbols`` and ``series`` (comma-separated), ``lookback`` in seconds (3600), ``since`` and ``to`` in unix seconds; without
``to`` a poll is as of now. ``recorded`` is a folder, reachable from every executor, with answers saved as
``<series>/<symbol>.json``; another client is a class with the same ``fetch``, given to a subclass of :class:`Poller`.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SERIES = ("oi", "liqs", "funding", "bullbear")


class Recorded:
    """Answers saved as files: a list of {symbol, history: [{t, ..}]}."""

    def __init__(self, options: dict):
        self.folder = Path(options["recorded"])

    def fetch(self, series: str, symbol: str, start: int, end: int) -> list[dict]:
        path = self.folder / series / f"{symbol}.json"
        if not path.exists():
            return []
        return [p for item in json.loads(path.read_text()) if item["symbol"] == symbol for p in item.get("history", []) if start <= p["t"] <= end]


class Poll(InputPartition):
    def __init__(self, series: str, symbol: str, start: int, end: int):
        self.series, self.symbol, self.start, self.end = series, symbol, start, end


class _Reads:
    def __init__(self, options: dict, client: type):
        self.options, self.client = options, client
        self.lookback = int(options.get("lookback", 3600))

    def now(self) -> int:
        return int(self.options.get("to") or time.time())

    def polls(self, start: int, end: int) -> list[Poll]:
        split = lambda name, default: [x.strip() for x in (self.options.get(name) or default).split(",")]
        return [Poll(k, s, start, end) for k in split("series", ",".join(SERIES)) for s in split("symbols", "")]

    def read(self, partition: Poll) -> Iterator[tuple]:
        for p in self.client(self.options).fetch(partition.series, partition.symbol, partition.start, partition.end):
            yield partition.symbol, partition.series, int(p["t"]), json.dumps(p)


class PollReader(_Reads, DataSourceReader):
    def partitions(self) -> list[Poll]:
        end = self.now()
        return self.polls(int(self.options.get("since") or end - self.lookback), end)


class PollStream(_Reads, DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802
        return {"t": int(self.options.get("since") or self.now() - self.lookback)}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"t": self.now()}

    def partitions(self, start: dict, end: dict) -> list[Poll]:
        return self.polls(start["t"] - self.lookback, end["t"])

    def commit(self, end: dict) -> None:
        pass


class Poller(DataSource):
    client: type = Recorded

    @classmethod
    def name(cls) -> str:
        return "tidepool-poller"

    def schema(self) -> str:
        return "symbol string, series string, t long, point string"

    def reader(self, schema) -> DataSourceReader:
        return PollReader(dict(self.options), self.client)

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return PollStream(dict(self.options), self.client)


VALUES = "o double, lq double, s string, fr double, ls double"


def points(polled: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Each (symbol, series, t) once, with its time and values. In a stream the points of the last ``delay`` are remembered; it
    should be no shorter than the look-back, as older points are dropped."""
    rows = polled.select("symbol", "series", F.timestamp_seconds("t").alias("ts"), F.from_json("point", VALUES).alias("p"))
    if polled.isStreaming:
        rows = rows.withWatermark("ts", delay)
    return rows.dropDuplicates(["symbol", "series", "ts"]).select("symbol", "series", "ts", "p.*")
