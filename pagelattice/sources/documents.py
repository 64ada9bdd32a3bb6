"""Python data sources for page files whose parsers are optional: one row for each page of a PDF or HWP file.

A backend is any importable object ``pages(path) -> iterable of dicts``; without one the source says
clearly that it is missing. Files that can't be read become a row with status 'unreadable' and a note.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, page_no int, status string, text string, width double, height double, image_ratio double, paths int, note string"


class BackendMissing(RuntimeError):
    pass


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict, default: str):
        self.paths = [p for p in options.get("paths", options.get("path", "")).split(",") if p]
        self.backend = options.get("backend", default)

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in self.paths]

    def read(self, partition: _File) -> Iterator[tuple]:
        module, _, name = self.backend.partition(":")
        try:
            pages = getattr(importlib.import_module(module), name or "pages")
        except (ImportError, AttributeError) as e:
            raise BackendMissing(f"backend {self.backend} is not installed") from e
        try:
            for k, page in enumerate(pages(partition.path), 1):
                yield (partition.path, k, "ok", page.get("text"), page.get("width"), page.get("height"), page.get("image_ratio"), page.get("paths"), page.get("note"))
        except Exception as e:  # noqa: BLE001 - errors are data here: the file is kept
            yield (partition.path, 1, "unreadable", None, None, None, None, None, f"{type(e).__name__}: {e}")


class PdfPages(DataSource):
    """``spark.read.format("pdf_pages").option("paths", ...)``"""

    @classmethod
    def name(cls) -> str:
        return "pdf_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, "pypdfium2_pages:pages")


class HwpPages(DataSource):
    """``spark.read.format("hwp_pages").option("paths", ...)``"""

    @classmethod
    def name(cls) -> str:
        return "hwp_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, "document_pages:pages")


def register(spark) -> None:
    spark.dataSource.register(PdfPages)
    spark.dataSource.register(HwpPages)
