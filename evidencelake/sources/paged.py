"""A paged source: rows from pages that a function fetches, as a Python data source."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _Page(InputPartition):
    def __init__(self, number: int) -> None:
        self.number = number


def paged_source(name: str, schema: str, fetch: Callable[[int, int], tuple[int, list[tuple]]], size: int = 1000) -> type[DataSource]:
    """A data source class for ``spark.dataSource.register``; ``fetch(page, size)`` gives the total count and a page's rows (pages from 1)."""

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            total, _ = fetch(1, size)
            return [_Page(k + 1) for k in range(max(1, -(-total // size)))]

        def read(self, partition: _Page) -> Iterator[tuple]:
            yield from fetch(partition.number, size)[1]

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, _schema) -> DataSourceReader:
            return Reader()

    return Paged
