"""Paged connectors as a Python data source that replays saved pages.

A saved harvest is a folder of numbered page files, each what one request returned.  A
folder is one partition, because a page names the next one; many folders (sets,
projects, categories) are read side by side.  Network access is left to whatever saves
the pages: a reader that cannot see the network can be tested and run anywhere.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

MAX_PAGES = 200
_TOKEN = re.compile(r"<(?:\w+:)?resumptionToken\b[^>]*>([^<]*)</", re.S)


class Folder(InputPartition):
    def __init__(self, path: str):
        self.path = path


def next_cursor(body: str) -> str:
    """The cursor that a page hands on: a resumption token, ``after_key`` or ``next``; empty at the end."""
    if body.lstrip().startswith("<"):
        found = _TOKEN.search(body)
        return found[1].strip() if found else ""
    page = json.loads(body)
    if not isinstance(page, dict):
        return ""
    cursor = page.get("after_key") or page.get("next") or ""
    return cursor if isinstance(cursor, str) else json.dumps(cursor, sort_keys=True)


class SavedPages(DataSource):
    """``spark.read.format("saved_pages").option("folders", "a,b").load()``: folder, page, body, cursor.

    A folder of more than ``max_pages``, a page that repeats its cursor, or a missing one
    that a cursor promises, stops the read with an error, as the harvest is not complete.
    """

    @classmethod
    def name(cls) -> str:
        return "saved_pages"

    def schema(self) -> StructType:
        return StructType([StructField("folder", StringType()), StructField("page", LongType()), StructField("body", StringType()), StructField("cursor", StringType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return SavedPagesReader(self.options)


class SavedPagesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folders = [f for f in options.get("folders", "").split(",") if f]
        self.max_pages = int(options.get("max_pages", MAX_PAGES))

    def partitions(self) -> list[Folder]:
        return [Folder(f) for f in self.folders]

    def read(self, partition: Folder) -> Iterator[tuple]:
        import pyarrow.fs as pafs

        uri = partition.path if "://" in partition.path else f"file://{partition.path}"
        fs, root = pafs.FileSystem.from_uri(uri)
        names = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(root)) if f.is_file)
        if len(names) > self.max_pages:
            raise ValueError(f"{partition.path}: {len(names)} pages are more than max_pages, {self.max_pages}")
        seen: set[str] = set()
        for page, name in enumerate(names):
            with fs.open_input_file(f"{root}/{name}") as source:
                body = source.read().decode("utf-8")
            cursor = next_cursor(body)
            if cursor and cursor in seen:
                raise ValueError(f"{partition.path}: page {page} hands on a cursor again")
            if cursor and page + 1 == len(names):
                raise ValueError(f"{partition.path}: the page after {page} is missing")
            seen.add(cursor)
            yield (partition.path, page, body, cursor)


def register(spark) -> None:
    spark.dataSource.register(SavedPages)
