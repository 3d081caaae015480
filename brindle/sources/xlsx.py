"""Workbooks as cell rows, on the standard library's zip and XML readers; ``workbook`` has the data source over them."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from typing import IO
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.sources import xls

SUFFIXES = (".xlsx", ".xlsm", ".xls")
CELLS = "file_path string, sheet_idx int, sheet_name string, row_idx int, cells array<string>, error string"
#: Namespaces of the format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def column_of(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def opened(file: IO[bytes]) -> tuple[zipfile.ZipFile, list[tuple[int, str, str]]]:
    """The archive, of which the directory alone is read, and (index, name, entry) of its sheets. Raises where the file is no
    workbook of this format."""
    book = zipfile.ZipFile(file)
    rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")).iter(f"{_PKG}Relationship")}
    sheets = []
    for index, sheet in enumerate(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")):
        target = rels[sheet.get(f"{_REL}id")].lstrip("/")
        sheets.append((index, sheet.get("name"), target if target.startswith("xl/") else f"xl/{target}"))
    return book, sheets


def shared_strings(book: zipfile.ZipFile) -> list[str]:
    """The texts that cells refer to by number: the one part of a workbook that is held whole."""
    out: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        with book.open("xl/sharedStrings.xml") as f:
            top = None
            for event, el in ElementTree.iterparse(f, ("start", "end")):
                top = el if top is None else top
                if event == "end" and el.tag == f"{_MAIN}si":
                    out.append("".join(t.text or "" for t in el.iter(f"{_MAIN}t")))
                    top.clear()
    return out


def sheet_rows(book: zipfile.ZipFile, entry: str, shared: list[str]) -> Iterator[tuple[int, list[str | None]]]:
    """(row from 1, cells) of a sheet, as its entry is inflated; what has been given is forgotten. Empty rows before the
    first with a value are left out and rows counted from there."""
    first, number, parent = None, 0, None
    with book.open(entry) as f:
        for event, el in ElementTree.iterparse(f, ("start", "end")):
            if event == "start":
                parent = el if el.tag == f"{_MAIN}sheetData" else parent
                continue
            if el.tag != f"{_MAIN}row":
                continue
            number = int(el.get("r") or number + 1)
            cells: list[str | None] = []
            for c in el.findall(f"{_MAIN}c"):
                at = column_of(c.get("r")) if c.get("r") else len(cells)
                cells += [None] * (at - len(cells))
                cells.append(_value(c, shared))
            if parent is not None:
                parent.clear()
            if first is None and not any(v not in (None, "") for v in cells):
                continue
            first = first or number
            yield number - first + 1, cells


def read_workbook(content: bytes) -> Iterator[tuple[int, str, int, list[str | None]]]:
    """(sheet index, sheet name, row from 1, cells) of every sheet. Values as they are cached; of a merged range only the
    first cell has one. Raises where the content is no workbook of this format. Names that a workbook defines are never
    read, so broken ones do no harm."""
    book, sheets = opened(io.BytesIO(content))
    shared = shared_strings(book)
    for index, name, entry in sheets:
        for number, cells in sheet_rows(book, entry, shared):
            yield index, name, number, cells


def read_old_workbook(content: bytes) -> Iterator[tuple[int, str, int, list[str | None]]]:
    """The same of a workbook in the old binary format."""
    for index, (name, rows) in enumerate(xls.sheets(content)):
        first = None
        for number, cells in rows:
            if first is None and not any(v not in (None, "") for v in cells):
                continue
            first = first or number
            yield index, name, number - first + 1, cells


def read_any(content: bytes) -> list[tuple[int, str, int, list[str | None]]]:
    """All sheets by the first reader that can; where none can, the first one's error."""
    try:
        return list(read_workbook(content))
    except Exception as first:  # whatever it stumbles over, the other format is tried
        try:
            return list(read_old_workbook(content))
        except Exception:
            raise first from None


def _value(c: ElementTree.Element, shared: list[str]) -> str | None:
    kind, v = c.get("t"), c.find(f"{_MAIN}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
    if v is None or v.text is None:
        return None
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return "True" if v.text == "1" else "False"
    return re.sub(r"^(-?\d+)\.0+$", r"\1", v.text)


def read_cells(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """Cell rows of all workbooks below ``path``, or of the files ``only``: a partition a sheet where Python can open the
    files, else by Spark's own listing and reading. A file that cannot be read gives one row with an error."""
    from brindle.sources import workbook

    return workbook.read(spark, path, only) if workbook.reachable(path) else read_contents(spark, path, only)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, size_bytes, modified_at) of all workbooks below ``path``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where(F.lower(F.col("path")).rlike(r"\.(xlsx|xlsm|xls)$")).select(F.col("path").alias("file_path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"))


def digests(spark: SparkSession, path: str, only: DataFrame) -> DataFrame:
    """(file_path, size_bytes, modified_at, digest) of the files of ``only``, whose contents alone are read."""
    chosen = [r["file_path"] for r in only.select("file_path").collect()]  # a row a file that has changed
    if not chosen:
        return only.select("file_path", "size_bytes", "modified_at", F.lit("").alias("digest"))
    files = spark.read.format("binaryFile").load(chosen)
    return files.select(F.col("path").alias("file_path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"), F.sha2("content", 256).alias("digest"))


def read_contents(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """The same by way of whole files, for storage that only Spark reaches."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ok = F.lower(F.col("path")).rlike(r"\.(xlsx|xlsm|xls)$")
    if only is not None:
        files = files.join(F.broadcast(spark.createDataFrame([(p,) for p in only], "_path string")), F.col("path") == F.col("_path"), "left_semi")  # a row a file

    def run(batches):
        import pyarrow as pa

        schema = _arrow_cells()
        for batch in batches:
            for path_, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, error = [], None
                try:
                    rows = read_any(content.as_py())
                except Exception as e:  # whatever is wrong with one file, the others are read
                    error = f"{type(e).__name__}: {e}"
                if error or not rows:
                    yield pa.RecordBatch.from_pylist([{"file_path": path_, "error": error}], schema)
                else:
                    yield pa.RecordBatch.from_pylist([{"file_path": path_, "sheet_idx": i, "sheet_name": n, "row_idx": r, "cells": c} for i, n, r, c in rows], schema)

    return files.where(ok).select("path", "content").mapInArrow(run, CELLS)


def _arrow_cells():
    import pyarrow as pa

    return pa.schema([("file_path", pa.string()), ("sheet_idx", pa.int32()), ("sheet_name", pa.string()), ("row_idx", pa.int32()), ("cells", pa.list_(pa.string())), ("error", pa.string())])


def dimensions(cells: DataFrame) -> DataFrame:
    return cells.where("error is null and sheet_name is not null").groupBy("file_path", "sheet_idx", "sheet_name").agg(F.max("row_idx").alias("max_row"), F.max(F.size("cells")).alias("max_col"))


def unreadable(cells: DataFrame) -> DataFrame:
    """(file_path, error): the files that no reader could read."""
    return cells.where("error is not null").select("file_path", "error")


def inventory(spark: SparkSession, path: str, cells: DataFrame | None = None) -> DataFrame:
    """A row a sheet: file facts, dimensions, hints from the file's and from the sheet's name, the form guessed from the
    shape. Files that cannot be read have no row here: ``unreadable`` lists them."""
    from brindle.operators import classify

    sheets = dimensions(read_cells(spark, path) if cells is None else cells)
    facts = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file_path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"))
    by_file = sheets.groupBy("file_path").agg(F.count("*").alias("sheet_count"), F.collect_set("sheet_name").alias("names"), F.max("max_col").alias("widest"))
    file_hints, sheet_hints = classify.name_hints(F.element_at(F.split("file_path", "/"), -1)), classify.name_hints(F.col("sheet_name"))
    out = sheets.join(by_file, "file_path").join(facts, "file_path")
    kinds = ("model", "grade", "region", "date")
    hints = [F.coalesce(file_hints[k], sheet_hints[k]).alias(k) for k in kinds] + [sheet_hints[k].alias(f"sheet_{k}") for k in kinds]
    return out.select("file_path", "size_bytes", "modified_at", "sheet_count", "sheet_idx", "sheet_name", "max_row", "max_col", classify.guess(F.col("names"), F.col("widest")).alias("guess"), *hints)


def first_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of one workbook as a table of text: its first row names the columns."""
    cells = read_cells(spark, path).where("error is null and sheet_idx = 0")
    head = cells.where("row_idx = 1").first()
    names = [" ".join(c.split()) if c else f"Unnamed: {i}" for i, c in enumerate(head["cells"])] if head else []
    return cells.where("row_idx > 1").select(*(F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)))
