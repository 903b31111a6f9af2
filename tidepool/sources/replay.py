"""A replaying stream source: the rows of a Parquet table in order of one column, some per batch.

It stands in for live feeds where there is no network: ``spark.dataSource.register(Replay)`` and
``spark.readStream.format("tidepool-replay").option("path", ...).option("order", "ts").option("rows", 500)``.
"""

from __future__ import annotations

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


class Slice(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


class Replay(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidepool-replay"

    def schema(self) -> str:
        return self.options["schema"]

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return ReplayReader(schema, self.options)


class ReplayReader(DataSourceStreamReader):
    """Offsets are row numbers in the order; every batch is one partition of ``rows`` rows."""

    def __init__(self, schema, options):
        self.names = schema.fieldNames()
        self.path, self.order, self.rows = options["path"], options["order"], int(options.get("rows", "1000"))
        self.at = 0

    def _total(self) -> int:
        import pyarrow.dataset as ds

        return ds.dataset(self.path).count_rows()

    def initialOffset(self) -> dict:  # noqa: N802
        return {"row": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        self.at = min(self.at + self.rows, self._total())
        return {"row": self.at}

    def partitions(self, start: dict, end: dict):
        self.at = max(self.at, end["row"])
        return [Slice(i, min(i + self.rows, end["row"])) for i in range(start["row"], end["row"], self.rows)]

    def read(self, partition: Slice):
        import pyarrow.dataset as ds

        table = ds.dataset(self.path).to_table(columns=self.names).sort_by(self.order)
        yield from table.slice(partition.start, partition.end - partition.start).to_batches()

    def commit(self, end: dict) -> None:
        pass
