"""Replies that come in pages, as a Spark data source with one partition a page."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from basalt.operators.best import first_per_key

#: Rows of a page and of all pages at most, unless the caller says otherwise. Fixed values.
PAGE, CAP = 25_000, 50_000
#: Fields that may identify a row, best first. Fixed values.
ROW_IDS = ("patric_id", "genome_id", "feature_id", "md5", "taxon_id", "id")


class Reply(NamedTuple):
    """One page: its rows, and the header that tells how many there are in all (null: not told)."""

    rows: list[dict]
    content_range: str | None = None


Fetch = Callable[[int, int], Reply]


def total_rows(content_range: str | None) -> int | None:
    """The total of ``items 0-24/97``; null where it is absent or a star."""
    found = re.search(r"/\s*(\d+)\s*$", content_range or "")
    return int(found[1]) if found else None


class TruncatedReply(Exception):
    """A full page without a total: what follows it cannot be told from nothing."""


def _checked(reply: Reply, start: int, count: int) -> int | None:
    total = total_rows(reply.content_range)
    if total is None and len(reply.rows) >= count:
        raise TruncatedReply(f"the page from row {start} is full and no total is known: the result may be cut off")
    return total


class _Page(InputPartition):
    def __init__(self, start: int, count: int, total: int | None) -> None:
        self.start, self.count, self.total = start, count, total


class _PageReader(DataSourceReader):
    def __init__(self, fetch: Fetch, page: int, cap: int) -> None:
        self.fetch, self.page, self.cap = fetch, page, cap

    def partitions(self) -> list[_Page]:
        """The pages, planned from the total that the first one tells."""
        count = min(self.page, self.cap)
        first = self.fetch(0, count)
        total = _checked(first, 0, count)
        if total is None:
            return [_Page(0, count, None)]
        rows = min(self.cap, total)
        # A page that is cut short by the server moves the next one up to where it ended.
        step = min(count, len(first.rows)) or count
        return [_Page(start, min(step, rows - start), total) for start in range(0, rows, step)] or [_Page(0, 0, total)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        reply = self.fetch(partition.start, partition.count)
        total = _checked(reply, partition.start, partition.count) if partition.total is None else partition.total
        if partition.total is not None and total_rows(reply.content_range) not in (None, total):
            raise TruncatedReply(f"the page from row {partition.start} tells another total than the first")
        if len(reply.rows) < partition.count and partition.total is not None and partition.start + len(reply.rows) < min(total, self.cap):
            raise TruncatedReply(f"the page from row {partition.start} has {len(reply.rows)} of {partition.count} rows")
        for k, row in enumerate(reply.rows[: partition.count]):
            key = next((f"{field}={row[field]}" for field in ROW_IDS if row.get(field)), None)
            yield partition.start + k, key, json.dumps(row)


def pages(spark: SparkSession, fetch: Fetch, page: int = PAGE, cap: int = CAP) -> DataFrame:
    """Rows (pos, key, row): what ``fetch(start, count)`` replies, page by page, each read by its own
    task; ``row`` is JSON. ``fetch`` runs on the driver for the first page and in tasks for all; it
    must reach the same replies everywhere, as from a shared folder.

    A full page without a total fails, since a truncated result that looks whole is worse than none;
    a short page without one is the end. No more than ``cap`` rows are asked for. Of rows that repeat
    an identity the first stays: a server that serves one page over and over adds nothing. Rows
    without any identity all stay."""

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "pages"

        def schema(self) -> str:
            return "pos long, key string, row string"

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return _PageReader(fetch, page, cap)

    spark.dataSource.register(Pages)
    raw = spark.read.format("pages").load()
    return raw.where("key is null").unionByName(first_per_key(raw.where("key is not null"), ["key"], [F.col("pos")]))


def fields(paged: DataFrame, schema: str) -> DataFrame:
    """The JSON rows of ``pages`` as columns, beside ``pos``."""
    return paged.select("pos", F.from_json("row", schema).alias("x")).select("pos", "x.*")


def _files(folder: str):
    """Arrow's file system of a folder, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder))


def folder_fetch(folder: str) -> Fetch:
    """Replies kept as ``<start>.json`` files of (headers, body) in a folder that all machines share,
    by any file system that Arrow knows; a missing file is an empty page."""

    def fetch(start: int, count: int) -> Reply:
        files, path = _files(folder)
        try:
            with files.open_input_stream(f"{path}/{start}.json") as f:
                held = json.loads(f.read())
        except FileNotFoundError:
            return Reply([], None)
        body = held.get("body")
        return Reply(body if isinstance(body, list) else [], (held.get("headers") or {}).get("content-range"))

    return fetch


def keep_pages(df: DataFrame, order: Column, folder: str, page: int) -> None:
    """Write the rows of a table as such a folder of replies: one file a page, named by the number of
    its first row, with the total in its header."""
    from basalt.operators.ranking import in_order

    placed = in_order(df, [order])
    total = placed.count()
    first = F.floor((F.col("place") - 1) / page) * page
    body = F.to_json(F.struct(*(c for c in df.columns)))

    def write(rows: Iterator) -> Iterator:
        import pandas as pd

        for frame in rows:
            for start, listed in zip(frame["start"], frame["body"]):
                files, path = _files(folder)
                files.create_dir(path, recursive=True)
                last = start + len(listed) - 1
                with files.open_output_stream(f"{path}/{start}.json") as out:
                    out.write(('{"headers": {"content-range": "items %d-%d/%d"}, "body": [%s]}' % (start, last, total, ", ".join(listed))).encode())
            yield pd.DataFrame({"n": [len(frame)]})

    listed = placed.select(first.cast("long").alias("start"), "place", body.alias("j")).groupBy("start").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "j"))), lambda x: x["j"]).alias("body"))
    listed.mapInPandas(write, "n long").agg(F.sum("n")).collect()
