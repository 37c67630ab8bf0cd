"""A Python data source for paged feeds: NDJSON page files with sequence numbers, as a batch or a stream.

``spark.dataSource.register(FeedSource)``, then ``spark.readStream.format("feed").option("path", folder)``.
Pages are ``<first>-<last>.ndjson`` in a folder that every worker sees; the offset is the last sequence number read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "seq bigint, name string, deleted boolean"
_PAGE = re.compile(r"^(\d+)-(\d+)\.ndjson$")


class Page(InputPartition):
    def __init__(self, path: str, after: int, until: int):
        self.path, self.after, self.until = path, after, until


def pages(folder: str) -> list[tuple[int, int, str]]:
    """(first, last, path) of the folder's pages in order; a gap between pages is an error, not a skip."""
    found = sorted((int(m[1]), int(m[2]), os.path.join(folder, n)) for n in os.listdir(folder) if (m := _PAGE.match(n)))
    for (_, last, _), (first, _, path) in zip(found, found[1:], strict=False):
        if first > last + 1:
            raise ValueError(f"nothing between {last} and {path}")
    return found


def read_page(page: Page) -> Iterator[tuple]:
    with open(page.path, encoding="utf-8") as f:
        for line in f:
            if line.strip():
                row = json.loads(line)
                if page.after < row["seq"] <= page.until:
                    yield row["seq"], row.get("name"), bool(row.get("deleted"))


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self):
        return [Page(p, first - 1, last) for first, last, p in pages(self.folder)]

    def read(self, partition):
        return read_page(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, folder: str, start: int):
        self.folder, self.start = folder, start

    def initialOffset(self):
        return {"seq": self.start}

    def latestOffset(self):
        return {"seq": max([self.start, *(last for _, last, _ in pages(self.folder))])}

    def partitions(self, start, end):
        return [Page(p, max(first - 1, start["seq"]), min(last, end["seq"])) for first, last, p in pages(self.folder) if last > start["seq"] and first <= end["seq"]]

    def read(self, partition):
        return read_page(partition)


class FeedSource(DataSource):
    @classmethod
    def name(cls):
        return "feed"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"])

    def streamReader(self, schema):
        return _Stream(self.options["path"], int(self.options.get("startingSeq", "0")))
