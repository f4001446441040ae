"""Landed listing pages as a stream with offsets: a Python data source whose offset is the number of pages of each listing.

Pages lie as `<path>/<listing>/<page>.json`, numbered from 0, each a JSON array of cards. A listing is read up to its first
empty or missing page; what lies behind an empty page is never read. The offset is a plain count that Spark keeps in the
query's checkpoint, so a query that was stopped half way goes on with the next page: none is lost and none comes twice. Each
page is a partition of its own. The path may be any that Arrow's file systems open (local, HDFS, S3, ...).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "varzea_pages"
SCHEMA = "listing string, page long, position int, card string"


def file_system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def pages_of(path: str, known: dict[str, int]) -> dict[str, int]:
    """How many pages of each listing may be read: all up to the first that is empty or missing. `known` ones are not opened again."""
    from pyarrow import fs

    system, root = file_system(path)
    out = dict(known)
    for listing in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if listing.type != fs.FileType.Directory:
            continue
        there = {f.base_name: f for f in system.get_file_info(fs.FileSelector(listing.path))}
        page = out.get(listing.base_name, 0)
        while (f := there.get(f"{page}.json")) is not None and not (f.size < 64 and not cards_of(system, f.path)):
            page += 1
        out[listing.base_name] = page
    return out


def cards_of(system, path: str) -> list:
    with system.open_input_stream(path) as f:
        return json.loads(f.read() or b"[]")


class Page(InputPartition):
    def __init__(self, listing: str, page: int):
        self.listing, self.page = listing, page


class PageReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path, self.seen = path, {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        self.seen = pages_of(self.path, self.seen)
        return self.seen

    def partitions(self, start: dict, end: dict) -> list[Page]:
        return [Page(listing, page) for listing, upto in sorted(end.items()) for page in range(start.get(listing, 0), upto)]

    def read(self, partition: Page) -> Iterator[tuple]:
        system, root = file_system(self.path)
        for i, card in enumerate(cards_of(system, f"{root}/{partition.listing}/{partition.page}.json")):
            yield partition.listing, partition.page, i, json.dumps(card, ensure_ascii=False)


class PageSource(DataSource):
    """SQL name `varzea_pages`; the option `path` is the folder of listings."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> PageReader:
        return PageReader(self.options["path"])


def page_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream (listing, page, position, card) of the landed pages."""
    spark.dataSource.register(PageSource)
    return spark.readStream.format(NAME).option("path", path).load()


def land(cards: DataFrame, path: str) -> None:
    """Write pages of (listing, page, card, place) rows, a file for each page, its cards in order of place. A page goes with one row."""
    from pyspark.sql import functions as F

    body = F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("place", "card"))), lambda x: x["card"]))
    pages = cards.groupBy("listing", "page").agg(body.alias("body"))

    def write(rows) -> None:
        system, root = file_system(path)
        for r in rows:
            system.create_dir(f"{root}/{r['listing']}", recursive=True)
            with system.open_output_stream(f"{root}/{r['listing']}/{r['page']}.json") as f:
                f.write(r["body"].encode("utf-8"))

    pages.foreachPartition(write)


def land_empty(path: str, listing: str, page: int) -> None:
    """The page that ends a listing."""
    system, root = file_system(path)
    system.create_dir(f"{root}/{listing}", recursive=True)
    with system.open_output_stream(f"{root}/{listing}/{page}.json") as f:
        f.write(b"[]")
