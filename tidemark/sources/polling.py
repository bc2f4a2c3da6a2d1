"""A streaming source that polls a database table by a rising key.

Each micro-batch covers a half-open key range fixed when it is planned, so a
restarted query re-reads exactly the same rows. Tasks read disjoint parts of the
range over their own connections.

    spark.dataSource.register(PollingSource)
    spark.readStream.format("polling").schema(EVENT_TABLE).options(
        module="sqlite3", connect='{"database": "/shared/x.db"}', table="event", column="id").load()
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


class KeyRange(InputPartition):
    def __init__(self, start: int, stop: int):
        self.start = start
        self.stop = stop


class PollingSource(DataSource):
    """Options: ``module`` (a DB-API module), ``connect`` (its arguments as JSON), ``table``,
    ``column``, and optionally ``start`` (1) and ``range`` (keys a task reads, 100000): a
    long backlog makes more tasks, not longer ones."""

    @classmethod
    def name(cls) -> str:
        return "polling"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PollingReader(schema, dict(self.options))


class PollingReader(DataSourceStreamReader):
    def __init__(self, schema, options: dict[str, str]):
        # Option names reach a Python source in lower case.
        options = {k.lower(): v for k, v in options.items()}
        self.columns = list(schema.fieldNames())
        self.module = options["module"]
        self.arguments = json.loads(options["connect"])
        self.table = options["table"]
        self.column = options["column"]
        self.start = int(options.get("start", 1))
        self.width = int(options.get("range", 100_000))
        for name in [self.table, self.column, *self.columns]:
            if not name.replace("_", "").replace(".", "").isalnum():
                raise ValueError(f"not a plain name: {name!r}")

    def _connection(self):
        return importlib.import_module(self.module).connect(**self.arguments)

    def initialOffset(self) -> dict:
        return {"id": self.start}

    def latestOffset(self) -> dict:
        connection = self._connection()
        try:
            cursor = connection.cursor()
            cursor.execute(f"SELECT max({self.column}) FROM {self.table}")
            highest = cursor.fetchone()[0]
        finally:
            connection.close()
        return {"id": self.start if highest is None else max(self.start, int(highest) + 1)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        low, high = start["id"], end["id"]
        return [KeyRange(at, min(at + self.width, high)) for at in range(low, high, self.width)]

    def commit(self, end: dict) -> None:
        """Nothing to release: the table keeps its rows."""

    def read(self, partition: KeyRange) -> Iterator[tuple]:
        connection = self._connection()
        try:
            cursor = connection.cursor()
            # The bounds are integers, so they are safe to write into the statement
            # whatever placeholder style the module has.
            cursor.execute(
                f"SELECT {', '.join(self.columns)} FROM {self.table} "
                f"WHERE {self.column} >= {int(partition.start)} AND {self.column} < {int(partition.stop)}"
            )
            while rows := cursor.fetchmany(10_000):
                yield from map(tuple, rows)
        finally:
            connection.close()
