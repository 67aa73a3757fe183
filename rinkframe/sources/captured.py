"""Captured answers of paged services, as a data source, and documents fetched by id.

    captured.pages(spark, folder)  # or spark.read.format("captured_pages").option("path", folder).load()

A folder holds one folder a division, with a file for each offset: <division>/<offset>.json. Each file is a
partition, and filters on division and offset are pushed down, so that other files are not listed for tasks.
`whole_pages` keeps what a client would have read: pages up to the first that is short or absent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

#: Documents that a task fetches at once, and ids that it holds.
AT_ONCE, HELD = 20, 500


@dataclass
class Page(InputPartition):
    division: str
    offset: int
    path: str

    def __post_init__(self) -> None:
        super().__init__(self.path)


class CapturedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "captured_pages"

    def schema(self) -> str:
        return "division string, page_offset long, json string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


_ORDER = {GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b}


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.kept = path, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on the folder's names decide which files are read; the others are left to Spark."""
        for f in filters:
            if getattr(f, "attribute", None) in (("division",), ("page_offset",)) and isinstance(f, (EqualTo, In, *_ORDER)):
                self.kept.append(f)
            else:
                yield f

    def _fits(self, page: Page) -> bool:
        for f in self.kept:
            value = page.division if f.attribute == ("division",) else page.offset
            if isinstance(f, In):
                good = value in f.value
            else:
                good = value == f.value if isinstance(f, EqualTo) else _ORDER[type(f)](value, f.value)
            if not good:
                return False
        return True

    def partitions(self) -> Sequence[InputPartition]:
        store, root = fs.FileSystem.from_uri(self.path)
        found = []
        for info in store.get_file_info(fs.FileSelector(root, recursive=True)):
            m = re.search(r"/([^/]+)/(\d+)\.json$", info.path)
            if info.is_file and m:
                page = Page(m[1], int(m[2]), info.path)
                if self._fits(page):
                    found.append(page)
        return sorted(found, key=lambda p: (p.division, p.offset)) or [Page("", -1, "")]

    def read(self, partition: Page) -> Iterator[tuple]:
        if partition.path:
            store, _ = fs.FileSystem.from_uri(self.path)
            with store.open_input_stream(partition.path) as f:
                yield partition.division, partition.offset, f.read().decode("utf-8", "replace")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """The pages of a folder: division, page_offset, json."""
    spark.dataSource.register(CapturedPages)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    return spark.read.format(CapturedPages.name()).option("path", folder).load()


def whole_pages(pages: DataFrame, games: str = "n_games", limit: int = 100, most: int = 5000) -> DataFrame:
    """Pages that a client reads: by `limit` from 0, up to the first that has fewer games or is absent, and to offset `most`.

    pages: division, page_offset and a column with the number of games.
    """
    pages = pages.where((F.col("page_offset") % limit == 0) & (F.col("page_offset") <= most))
    # A page is read when all before it are there and full: as many full ones before it as its offset says.
    full = pages.where(F.col(games) >= limit).groupBy("division").agg(F.array_sort(F.collect_set((F.col("page_offset") / limit).cast("long"))).alias("full_"))
    run = F.coalesce(F.get(F.filter(F.transform("full_", lambda x, i: F.when(x != i, i)), lambda i: i.isNotNull()), F.lit(0)), F.size("full_"))
    reach = full.select("division", run.alias("reach_"))
    return pages.join(reach, "division", "left").where(F.col("page_offset") <= F.coalesce("reach_", F.lit(0)) * limit).drop("reach_")


def fetch_documents(ids: DataFrame, folder: str, key: str = "game_id") -> DataFrame:
    """Documents <id>.json of a folder: the id and its JSON, null where there is none. Tasks fetch several at once."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)

        def one(name) -> str | None:
            if name is None:
                return None
            try:
                with store.open_input_stream(f"{root}/{name}.json") as f:
                    return f.read().decode("utf-8", "replace")
            except OSError:
                return None

        with ThreadPoolExecutor(AT_ONCE) as pool:
            for b in batches:
                for low in range(0, len(b), HELD):
                    part = b.column(0).slice(low, HELD)
                    yield pa.RecordBatch.from_arrays([part, pa.array(pool.map(one, part.to_pylist()), pa.string())], names=[key, "json"])

    kind = ids.schema[key].dataType.simpleString()
    return ids.select(key).mapInArrow(fetch, f"{key} {kind}, json string")
