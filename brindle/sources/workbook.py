"""Workbooks as a Spark data source: a partition a sheet, rows streamed from the archive's entry, files and sheets pruned.

``spark.dataSource.register(WorkbookSource)``, then ``spark.read.format("workbook").load(folder)``. The options ``files``
and ``sheets`` (JSON lists of paths and names) leave whole partitions out. With the option ``pushdown``, filters of a query
on ``file_path``, ``sheet_name`` and ``sheet_idx`` do so too; it is off by itself, as Spark 4.1 lets all scans of one
DataFrame share the filters that were pushed last: with it, a DataFrame is to be used once.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from brindle.sources import xlsx

#: Rows and characters of a batch at most. Files up to which the sheets are listed before the read starts; beyond, a
#: partition is a file and its task goes through the sheets.
ROWS, CHARACTERS, LISTED = 1_000, 1 << 20, 2_000


def located(path: str) -> tuple[files.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return files.FileSystem.from_uri(path)
    return files.LocalFileSystem(), os.path.abspath(path)


def reachable(path: str) -> bool:
    """Whether Python opens what Spark calls so."""
    try:
        system, at = located(path)
        return system.get_file_info(at).type != files.FileType.NotFound
    except Exception:  # a scheme that only Spark knows
        return False


def _uri(system: files.FileSystem, at: str, path: str) -> str:
    """As Spark names the file."""
    return f"file:{at}" if isinstance(system, files.LocalFileSystem) else f"{path.split('://')[0]}://{at}" if "://" in path else at


@dataclass
class Sheet(InputPartition):
    """A sheet of a file; with no entry the whole file, in whatever format it is."""

    file_path: str
    at: str
    index: int | None = None
    name: str | None = None
    entry: str | None = None


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return xlsx.CELLS

    def reader(self, schema) -> "WorkbookReader":
        kind = FilteringReader if self.options.get("pushdown", "false").lower() == "true" else WorkbookReader
        wanted = {c: set(json.loads(self.options[o])) for o, c in (("files", "file_path"), ("sheets", "sheet_name")) if o in self.options}
        return kind(self.options["path"], wanted)


class WorkbookReader(DataSourceReader):
    def __init__(self, path: str, wanted: dict[str, set] | None = None):
        self.path, self.wanted = path, wanted or {}

    def _wants(self, column: str, value) -> bool:
        return column not in self.wanted or value in self.wanted[column]

    def partitions(self) -> list[Sheet]:
        system, top = located(self.path)
        found = system.get_file_info(files.FileSelector(top, recursive=True)) if system.get_file_info(top).type == files.FileType.Directory else [system.get_file_info(top)]
        hidden = lambda p: any(x[:1] in "._" for x in os.path.relpath(p, top).split("/") if x != ".")
        paths = sorted(f.path for f in found if f.type == files.FileType.File and f.path.lower().endswith(xlsx.SUFFIXES) and not hidden(f.path))
        named = [(_uri(system, p, self.path), p) for p in paths]
        named = [(uri, p) for uri, p in named if self._wants("file_path", uri)]
        if len(named) > LISTED:
            return [Sheet(uri, p) for uri, p in named]
        out: list[Sheet] = []
        for uri, p in named:
            try:
                with system.open_input_file(p) as f:
                    sheets = xlsx.opened(f)[1]
            except Exception:  # no archive, or a broken one: its task says so
                out.append(Sheet(uri, p))
                continue
            out += [Sheet(uri, p, *s) for s in sheets if self._wants("sheet_idx", s[0]) and self._wants("sheet_name", s[1])]
            if not sheets:
                out.append(Sheet(uri, p))
        return out or [Sheet("", "")]

    def read(self, partition: Sheet) -> Iterator[pa.RecordBatch]:
        if not partition.at:
            return
        system, _ = located(self.path)
        rows, error = iter(()), None
        try:
            with system.open_input_file(partition.at) as f:
                if partition.entry is None:
                    with f:
                        rows = iter(xlsx.read_any(f.read()))
                    yield from self._batches(partition, rows)
                    return
                book, _ = xlsx.opened(f)
                shared = xlsx.shared_strings(book)
                for _ in xlsx.sheet_rows(book, partition.entry, shared):  # a sheet that breaks off gives no rows, so it is read
                    pass  # to its end before the first row leaves: twice the work, and memory for one row
                rows = ((partition.index, partition.name, n, cells) for n, cells in xlsx.sheet_rows(book, partition.entry, shared))
                yield from self._batches(partition, rows)
        except Exception as e:  # whatever is wrong with one file, the others are read
            error = f"{type(e).__name__}: {e}"
        if error:
            yield pa.RecordBatch.from_pylist([{"file_path": partition.file_path, "error": error}], xlsx._arrow_cells())

    def _batches(self, partition: Sheet, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        """Rows in batches; a sheet or file without any gives one row that names the file alone."""
        some, size, any_ = [], 0, False
        for i, name, n, cells in rows:
            if not (self._wants("sheet_idx", i) and self._wants("sheet_name", name)):
                continue
            some.append({"file_path": partition.file_path, "sheet_idx": i, "sheet_name": name, "row_idx": n, "cells": cells})
            size += sum(len(c) for c in cells if c)
            if len(some) >= ROWS or size >= CHARACTERS:
                yield pa.RecordBatch.from_pylist(some, xlsx._arrow_cells())
                some, size, any_ = [], 0, True
        if some or not any_:
            yield pa.RecordBatch.from_pylist(some or [{"file_path": partition.file_path}], xlsx._arrow_cells())


class FilteringReader(WorkbookReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and lists on the three columns are kept here; the rest is Spark's."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if column in ("file_path", "sheet_name", "sheet_idx") and values is not None:
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f


def read(spark: SparkSession, path: str, file_paths: list[str] | None = None, sheets: list[str] | None = None) -> DataFrame:
    """The cell rows of all workbooks below ``path``, or of those files and sheets of them alone."""
    spark.dataSource.register(WorkbookSource)
    chosen = {o: json.dumps(v) for o, v in (("files", file_paths), ("sheets", sheets)) if v is not None}
    return spark.read.format("workbook").options(**chosen).load(path)
