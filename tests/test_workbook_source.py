"""The workbook data source: a partition a sheet, pruning, streaming, errors."""

import gc
import tracemalloc
from collections import Counter

import pytest

from brindle.sources import workbook, xlsx
from tests.test_engine import old_workbook
from tests.test_engine import workbook as made


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("books")
    (d / "sub").mkdir()
    (d / "a.xlsx").write_bytes(made({"One": [["h", "k"], *[[f"v{i}", i] for i in range(2500)]], "Two": [[], [None], ["x", None, "z"]], "Empty": [[]]}))
    (d / "sub" / "b.XLSM").write_bytes(made({"One": [["b"]]}))
    (d / "old.xls").write_bytes(old_workbook({"Old": {(1, 0): "o"}}))
    (d / "bad.xlsx").write_bytes(b"PK no workbook")
    whole = made({"Cut": [["x" * 50] for _ in range(200)]})
    (d / "cut.xlsx").write_bytes(whole.replace(b"</sheetData>", b"</sheetDatb>") if b"</sheetData>" in whole else whole[:-40])
    (d / "_hidden.xlsx").write_bytes(made({"No": [["n"]]}))
    (d / "note.txt").write_text("no workbook")
    return str(d)


def key(r):
    return r.file_path, r.sheet_idx, r.sheet_name, r.row_idx, tuple(r.cells) if r.cells is not None else None


def test_same_rows_as_whole_files(spark, folder):
    got, want = xlsx.read_cells(spark, folder).collect(), xlsx.read_contents(spark, folder).collect()
    full = lambda rows: Counter(key(r) for r in rows if r.sheet_name is not None)
    assert full(got) == full(want) and len(full(got)) == 2501 + 1 + 1 + 1
    assert {r.file_path.rsplit("/", 1)[-1] for r in got if r.error} == {r.file_path.rsplit("/", 1)[-1] for r in want if r.error} == {"bad.xlsx", "cut.xlsx"}
    assert {r.file_path for r in got} == {r.file_path for r in want}


def test_partitions_and_pruning(folder):
    reader = workbook.FilteringReader(folder)
    assert len(reader.partitions()) == 3 + 1 + 1 + 1 + 1
    left = list(reader.pushFilters([workbook.EqualTo(("sheet_name",), "Two"), workbook.In(("sheet_idx",), (1, 2)), workbook.EqualTo(("row_idx",), 1)]))
    assert [f.attribute for f in left] == [("row_idx",)]
    named = [p for p in reader.partitions() if p.entry]
    assert [(p.name, p.index) for p in named] == [("Two", 1)]
    assert all(len(b) for p in named for b in reader.read(p)) and sum(len(b) for p in named for b in reader.read(p)) == 1
    by_file = workbook.FilteringReader(folder)
    list(by_file.pushFilters([workbook.EqualTo(("file_path",), f"file:{folder}/a.xlsx")]))
    assert len(by_file.partitions()) == 3


def test_pruning_in_spark(spark, folder):
    one = workbook.read(spark, folder, sheets=["One"])
    assert one.count() == 2502 + 2 and one.rdd.getNumPartitions() == 4  # two sheets, and two files that only their readers know
    assert one.where("sheet_name is not null").count() == 2502
    assert workbook.read(spark, folder, [f"file:{folder}/a.xlsx"], ["Two"]).collect()[0].cells == ["x", None, "z"]
    assert workbook.read(spark, folder, sheets=["None such"]).where("sheet_name is not null").count() == 0
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pushed = spark.read.format("workbook").option("pushdown", "true").load(folder).where("sheet_name = 'One' and row_idx > 1")
        assert pushed.count() == 2500 and pushed.rdd.getNumPartitions() == 4
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)


def test_two_uses_of_one_frame(spark, folder):
    """Filters of one use do not reach the other."""
    cells = xlsx.read_cells(spark, folder)
    every = cells.groupBy("file_path").count().withColumnRenamed("count", "n")
    got = cells.where("sheet_name = 'Two'").join(every, "file_path").collect()
    assert [r.n for r in got] == [2501 + 1 + 1]


def test_many_files_are_partitions(folder, monkeypatch):
    monkeypatch.setattr(workbook, "LISTED", 2)
    reader = workbook.FilteringReader(folder)
    list(reader.pushFilters([workbook.EqualTo(("sheet_name",), "One")]))
    parts = reader.partitions()
    assert len(parts) == 5 and all(p.entry is None for p in parts)
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist() if r["sheet_name"]]
    assert len(rows) == 2502 and {r["sheet_name"] for r in rows} == {"One"}


def test_memory_of_a_large_sheet(tmp_path):
    """A sheet above the batch size: memory holds a batch, not the sheet."""
    peak = {}
    for n in (4_000, 40_000):
        (tmp_path / "large.xlsx").write_bytes(made({"Large": [[f"{i}-{'x' * 60}", i, "y" * 60] for i in range(n)]}))
        reader = workbook.WorkbookReader(str(tmp_path))
        part = reader.partitions()[0]
        gc.collect()
        tracemalloc.start()
        batches, rows = 0, 0
        for b in reader.read(part):
            batches, rows = batches + 1, rows + len(b)
        peak[n] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == n and batches == n // workbook.ROWS
    assert peak[40_000] < 1.5 * peak[4_000] + (1 << 20)


def test_inventory_names_unreadable_files(spark, folder):
    cells = xlsx.read_cells(spark, folder)
    failed = {r.file_path.rsplit("/", 1)[-1]: r.error for r in xlsx.unreadable(cells).collect()}
    assert set(failed) == {"bad.xlsx", "cut.xlsx"} and all(failed.values())
    found = xlsx.inventory(spark, folder, cells)
    assert {(r.file_path.rsplit("/", 1)[-1], r.sheet_name, r.max_row) for r in found.collect()} == {("a.xlsx", "One", 2501), ("a.xlsx", "Two", 1), ("b.XLSM", "One", 1), ("old.xls", "Old", 1)}


def test_hints_of_file_and_sheet(spark, tmp_path):
    (tmp_path / "WSED7667M EUR 2024.3.5.xlsx").write_bytes(made({"Better-1 2023-11": [["x"]], "Plain": [["y"]]}))
    got = {r.sheet_name: r for r in xlsx.inventory(spark, str(tmp_path)).collect()}
    assert got["Better-1 2023-11"].asDict() | {} and (got["Better-1 2023-11"].model, got["Better-1 2023-11"].date, got["Better-1 2023-11"].sheet_date, got["Better-1 2023-11"].grade) == ("WSED7667M", "2024-03-05", "2023-11", "Better-1")
    assert (got["Plain"].sheet_grade, got["Plain"].grade, got["Plain"].region) == (None, None, "EUR")
