"""Source plug-ins as Spark data sources.

A plug-in says how a batch of fetched pages becomes article rows (``parse``) and
which columns those rows have (``columns``); everything else is Spark's: one
partition per row group of the stored pages, Arrow batches in and out, column
pruning to what ``parse`` reads (``needs``), and lost partitions read again.

    class Mine(PageSource):
        columns = "url string, title string"
        needs = ("url", "html")

        @classmethod
        def name(cls): return "mine"

        def parse(self, pages): ...

    spark.dataSource.register(Mine)
    spark.read.format("mine").option("path", ".../pages.parquet").load()
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from presslens.functions.body_text import main_text


@dataclass
class RowGroup(InputPartition):
    """One row group of one file of stored pages."""

    path: str
    group: int


def _located(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


class _Reader(DataSourceReader):
    def __init__(self, source: PageSource):
        self.source, self.path = source, source.options["path"]

    def partitions(self) -> list[RowGroup]:
        fs, path = _located(self.path)
        files = ds.dataset(path, filesystem=fs, format="parquet").get_fragments()
        return [RowGroup(f.path, g.row_groups[0].id) for f in files for g in f.split_by_row_group()]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        fs, _ = _located(self.path)
        piece = ds.ParquetFileFormat().make_fragment(partition.path, filesystem=fs, row_groups=[partition.group])
        for batch in piece.to_batches(columns=list(self.source.needs), batch_size=256):
            if batch.num_rows:
                yield self.source.parse(batch)


class PageSource(DataSource):
    """Base of page plug-ins: subclasses give a name, ``columns``, ``needs`` and ``parse``."""

    columns = ""
    needs: tuple[str, ...] = ()

    def schema(self) -> str:
        return self.columns

    def reader(self, schema) -> DataSourceReader:
        if "path" not in self.options:
            raise ValueError(f"{self.name()}: the option path is missing")
        return _Reader(self)

    def parse(self, pages: pa.RecordBatch) -> pa.RecordBatch:
        raise NotImplementedError


class ArticlePages(PageSource):
    """Every stored page with the main text of its article."""

    columns = "page_id bigint, url string, body string"
    needs = ("page_id", "url", "html")

    @classmethod
    def name(cls) -> str:
        return "article_pages"

    def parse(self, pages: pa.RecordBatch) -> pa.RecordBatch:
        bodies = pa.array([main_text(h) for h in pages.column("html").to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays(
            [pages.column("page_id").cast(pa.int64()), pages.column("url").cast(pa.string()), bodies], ["page_id", "url", "body"])
